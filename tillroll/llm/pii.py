"""Personal data: fixed patterns and a linear-chain CRF over word shapes (operator 6).

The patterns find email addresses, IP addresses, payment cards and phone numbers of the
standard forms. The CRF, trained in the driver from the small table ``LABELLED``, adds
spans of other forms (a phone number without +, a card in odd groups ...); a span that
touches one of the patterns' is left out, so theirs always stay.

A word that has no digit and no @ or + and whose neighbours have none is O by constraint.
Decoding therefore runs over the stretches between such words only, which gives the same
labels as decoding whole texts; all stretches of a batch step through Viterbi together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)

# The patterns of the standard forms.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where digits begin; without the look-behind a long run of digits is tried at each
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and domain. A run of local characters can only match as a
    whole, since none of them is @: from the @ back to the run's start or the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, by start, then kind; code points."""
    found = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# ---- word shapes ---------------------------------------------------------------------
_SIGN = re.compile(r"[0-9@+]")
_TOKEN = re.compile(r"\S+")
_RUNS = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)


def shape(word: str) -> str:
    """Runs of letters as a, digit runs as their length (9 and over alike), other characters as
    they are; a word without digits, @ and + is only ``a``, or itself if it's a cue."""
    if not _SIGN.search(word):
        bare = word.strip(".,;:!?()\"'").lower()
        return "w=" + bare if bare in CUES else "a"
    out = []
    for run in _RUNS.findall(word):
        out.append(str(min(9, len(run))) if "0" <= run[0] <= "9" else "a" if run[0].isalpha() else run)
    return "".join(out)


def _features(before: str, word: str, after: str) -> tuple[str, ...]:
    n = sum(c.isdigit() for c in word)
    signs = "".join(sorted(set(word) - set("0123456789a")))
    return ("s=" + word, "p=" + before, "n=" + after, f"d={n}", "c=" + signs, f"p={before}|s={word}", "1")


# ---- the labelled table --------------------------------------------------------------
#: Cue words that shapes keep; fixed values.
CUES = frozenset("call tel phone fax mobile cell ring card visa mastercard amex iban host server ip address "
                 "mail email e-mail contact write at dot on in the year page version room costs total from to "
                 "and of".split())
#: Sentences with their personal data in [kind ...] brackets; fixed values, made up.
LABELLED: tuple[str, ...] = (
    "call [phone (555) 123-4567] today", "tel [phone 555-123-4567] or write", "phone [phone 030 1234 5678] now",
    "ring [phone (020) 7946 0958] after five", "fax [phone 212.555.0134] works", "mobile [phone 0171 2345678] is new",
    "reach us at [phone (312) 555-0199] or come", "cell [phone 415-555-0132] please", "phone [phone (030) 901820] rang",
    "contact [phone +1 (678) 555-5272] soon", "call [phone +49 30 1234567] at once", "tel [phone 06 12 34 56 78] merci",
    "it is [phone 212-555-0147] now", "my number is [phone 646-555-0188] at home",
    "visa [card 4111 1111 1111 1111] was used", "card [card 5500-0000-0000-0004] is old",
    "mastercard [card 5105105105105100] expired", "amex [card 3782 822463 10005] too", "card [card 4012888888881881] ok",
    "write to [email ann.lee@mail.example.org] soon", "mail [email bob@host] for more", "email [email x.y@intranet] works",
    "contact [email jo_smith@example] or call", "from [email info@example.com] to all",
    "host [ip 10.0.0.12] is down", "server [ip 192.168.1.254] answered", "ip [ip 172.16.0.1:8080] was open",
    "address [ip 10.1.2.3/24] in use", "the server at [ip 8.8.8.8] said no",
    # numbers, dates, versions, prices, handles and sums that are nobody's data
    "in the year 1999 it was new", "on 12 May 2004 they met", "page 123 of 456 is lost", "version 2.0.1 came out",
    "it costs 12.50 in all", "the total of 1,234,567 was paid", "room 12 and room 14", "from 9:30 to 17:45 daily",
    "on 2021-03-04 it began", "on 04/03/2021 it ended", "about 3 or 4 of them", "chapter 7 verse 12",
    "10 20 30 40 50 were called", "the year 2020 and 2021", "in 1984 he wrote 3 books", "items 100 200 300 400",
    "a 50% rise in 2019", "the code a1b2c3 failed", "see section 4.2 on page 7", "order 48213 was sent",
    "1914 - 1918 and 1939 - 1945", "number 65536 is a power", "they met @ noon", "the 2nd and 3rd of june",
    "c++ and a+b are fine", "1 + 2 = 3 they said", "follow @ann_lee for news", "section 3.4.5 has it",
    "x1 y2 z3 are names", "the 1990s were long", "id 123456789 was given", "2147483647 is the most",
    "it took 1000 years and 20 days", "scores 3-2 and 1-0 at home", "key 9f8e7d6c5b4a was set",
    "commit 2020202020 of 1 2 3 4 5 6 7 8 9", "and 5 of the 12 came", "7 8 9 10 11 12 13 14 15 16",
)
_BRACKET = re.compile(r"\[(\w+) ([^\]]*)\]")


def labelled_words(sentence: str) -> tuple[list[str], list[int]]:
    words: list[str] = []
    labels: list[int] = []
    at = 0
    for m in _BRACKET.finditer(sentence):
        plain = sentence[at:m.start()].split()
        words += plain + m[2].split()
        labels += [0] * len(plain) + [LABELS.index(m[1])] * len(m[2].split())
        at = m.end()
    plain = sentence[at:].split()
    return words + plain, labels + [0] * len(plain)


def train(sentences: tuple[str, ...] = LABELLED, steps: int = 300, rate: float = 0.5,
          decay: float = 1e-3) -> dict:
    """CRF weights by gradient ascent on the log likelihood (all sentences side by side)."""
    rows = [labelled_words(s) for s in sentences]
    names: dict[str, int] = {}
    feats = []
    for words, _ in rows:
        shapes = ["^", *map(shape, words), "$"]
        feats.append([[names.setdefault(f, len(names)) for f in _features(*shapes[i:i + 3])]
                      for i in range(len(words))])
    n, longest, k = len(rows), max(len(w) for w, _ in rows), len(LABELS)
    per = len(feats[0][0])
    x = np.zeros((n, longest, per), np.int64)
    y = np.zeros((n, longest), np.int64)
    on = np.zeros((n, longest), bool)
    for i, (words, labels) in enumerate(rows):
        x[i, :len(words)], y[i, :len(words)], on[i, :len(words)] = feats[i], labels, True
    w, t = np.zeros((len(names), k)), np.zeros((k, k))
    seen_w, seen_t = np.full_like(w, 1e-6), np.full_like(t, 1e-6)
    log_sum = lambda a, axis: (m := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(
        np.exp(a - m).sum(axis=axis))
    for _ in range(steps):
        e = w[x].sum(axis=2)
        fwd, bwd = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        fwd[:, 0] = e[:, 0]
        for j in range(1, longest):
            step = log_sum(fwd[:, j - 1, :, None] + t[None], 1) + e[:, j]
            fwd[:, j] = np.where(on[:, j, None], step, fwd[:, j - 1])
        for j in range(longest - 2, -1, -1):
            step = log_sum(t[None] + (e[:, j + 1] + bwd[:, j + 1])[:, None, :], 2)
            bwd[:, j] = np.where(on[:, j + 1, None], step, 0)
        z = log_sum(fwd[:, -1], 1)
        p = np.exp(fwd + bwd - z[:, None, None]) * on[..., None]
        truth = np.eye(k)[y] * on[..., None]
        gw = -decay * w
        np.add.at(gw, x.reshape(-1), np.repeat((truth - p).reshape(-1, k), per, axis=0))
        gt = -decay * t
        for j in range(1, longest):
            both = on[:, j]
            pair = np.exp(fwd[both, j - 1, :, None] + t[None] + (e[both, j] + bwd[both, j])[:, None, :]
                          - z[both, None, None])
            gt -= pair.sum(axis=0)
            np.add.at(gt, (y[both, j - 1], y[both, j]), 1.0)
        seen_w += gw * gw
        seen_t += gt * gt
        w += rate * gw / np.sqrt(seen_w)
        t += rate * gt / np.sqrt(seen_t)
    return {"names": names, "w": w, "t": t}


# ---- decoding ------------------------------------------------------------------------
def stretches(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring words (start, end) that need decoding: each word with a digit, @
    or +, and the words next to it."""
    out: list[list[tuple[int, int]]] = []
    place, n = 0, len(text)
    while True:
        m = _SIGN.search(text, place)
        if not m:
            return out
        start = m.start()
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        end = _TOKEN.match(text, m.start()).end()
        run: list[tuple[int, int]] = []
        last = out[-1][-1][1] if out else 0
        if start >= last:
            stop = start  # the word before
            while stop > last and text[stop - 1].isspace():
                stop -= 1
            first = stop
            while first > last and not text[first - 1].isspace():
                first -= 1
            if first < stop:
                run.append((first, stop))
            run.append((start, end))
        after = _TOKEN.search(text, end)
        if out and (start < last or (run and not text[last:run[0][0]].strip() and run[0][0] - last <= 64)):
            out[-1] += run
        else:
            out.append(run)
        if after:
            out[-1].append((after.start(), after.end()))
        place = end
        if after and _SIGN.search(text, after.start(), after.end()):
            # the next word has a sign itself: it is in the run, its next word is not yet
            place = after.end()
            nxt = after
            while nxt:
                nxt = _TOKEN.search(text, nxt.end())
                if nxt:
                    out[-1].append((nxt.start(), nxt.end()))
                    if not _SIGN.search(text, nxt.start(), nxt.end()):
                        break
                    place = nxt.end()
            else:
                place = n


def viterbi(emissions: list[np.ndarray], t: np.ndarray, batch_cells: int = 2_000_000) -> list[np.ndarray]:
    """The best labels of each sequence; sequences of like length step together."""
    out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(emissions)
    order = sorted(range(len(emissions)), key=lambda i: len(emissions[i]))
    start = 0
    while start < len(order):
        end, longest = start, 0
        while end < len(order):
            grown = len(emissions[order[end]])
            if end > start and (end - start + 1) * grown * t.shape[0] > batch_cells:
                break
            longest, end = grown, end + 1
        own = order[start:end]
        size = np.array([len(emissions[i]) for i in own])
        e = np.zeros((len(own), longest, t.shape[0]))
        for row, i in enumerate(own):
            e[row, :size[row]] = emissions[i]
        score = e[:, 0] + t[0]  # what stands before is O
        back = np.zeros((len(own), longest, t.shape[0]), np.int8)
        for j in range(1, longest):
            steps = score[:, :, None] + t[None]
            back[:, j] = steps.argmax(axis=1)
            score = np.where((j < size)[:, None], steps.max(axis=1) + e[:, j], score)
        label = (score + t[:, 0]).argmax(axis=1)  # what stands behind is O
        labels = np.zeros((len(own), longest), np.int8)
        rows = np.arange(len(own))
        for j in range(longest - 1, -1, -1):
            within = j < size
            labels[within, j] = label[within]
            if j:
                label = np.where(within, back[rows, j, label], label)
        for row, i in enumerate(own):
            out[i] = labels[row, :size[row]]
        start = end
    return out


class Finder:
    """The trained model with a bounded cache of emissions by shapes."""

    def __init__(self, model: dict, max_entries: int = 200_000) -> None:
        self.names, self.w, self.t = model["names"], model["w"], model["t"]
        self.cache: dict[tuple[str, str, str], np.ndarray] = {}
        self.max_entries = max_entries

    def emission(self, shapes: tuple[str, str, str]) -> np.ndarray:
        found = self.cache.get(shapes)
        if found is None:
            if len(self.cache) >= self.max_entries:
                self.cache.clear()
            ids = [self.names[f] for f in _features(*shapes) if f in self.names]
            found = self.cache[shapes] = self.w[ids].sum(axis=0)
        return found

    def added(self, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
        """The CRF's spans of each text that touch none of the base spans."""
        runs, owner = [], []
        for i, text in enumerate(texts):
            for run in stretches(text):
                runs.append(run)
                owner.append(i)
        emissions = []
        for run, i in zip(runs, owner):
            shapes = ["a", *(shape(texts[i][a:b]) for a, b in run), "a"]
            emissions.append(np.array([self.emission((shapes[j], shapes[j + 1], shapes[j + 2]))
                                       for j in range(len(run))]))
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for run, i, labels in zip(runs, owner, viterbi(emissions, self.t)):
            j = 0
            while j < len(run):
                k = j + 1
                if labels[j]:
                    while k < len(run) and labels[k] == labels[j]:
                        k += 1
                    span = self._trimmed(texts[i], run[j][0], run[k - 1][1], int(labels[j]) - 1)
                    if span and not any(a < span[2] and span[0] < b for a, _, b in base[i]):
                        out[i].append(span)
                j = k
        return out

    @staticmethod
    def _trimmed(text: str, start: int, end: int, kind: int) -> tuple[int, int, int] | None:
        while end > start and text[end - 1] in ".,;:!?\"'>]}" or (
                end > start and text[end - 1] == ")" and "(" not in text[start:end]):
            end -= 1
        while start < end and text[start] in ".,;:!?\"'<[{":
            start += 1
        return (start, kind, end) if end - start >= 5 and _SIGN.search(text, start, end) else None


def spans(texts: list[str], finder: Finder) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    more = finder.added(texts, base)
    return [(b, sorted(b + m)) for b, m in zip(base, more)]


# ---- on Spark ------------------------------------------------------------------------
def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         labelled: tuple[str, ...] = LABELLED) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone (of the patterns),
    base_sha256 and spans (kind:start:end, all of them, by start, then kind).

    A null text is empty: no spans. Repeated rows give repeated results, a null id is
    carried through, other columns are not read.
    """
    model = train(labelled)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                found = spans(part.column("text").to_pylist(), finder)
                counts = [pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64())
                          for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *counts,
                     pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                     pa.array([joined(every) for _, every in found], pa.string())],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType),
                           *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
    return rows.mapInArrow(run, schema)


def masked(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with each span as its kind in angle brackets; overlapping spans as one."""
    out, at = [], 0
    for start, kind, end in found:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, *, text_col: str = "text", labelled: tuple[str, ...] = LABELLED) -> DataFrame:
    """The rows with personal data in ``text_col`` masked; all columns stay, null texts too."""
    model = train(labelled)
    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                texts = part.column(column).to_pylist()
                found = spans([t or "" for t in texts], finder)
                clean = [t if t is None else masked(t, every) for t, (_, every) in zip(texts, found)]
                yield part.set_column(column, part.schema.field(column),
                                      pa.array(clean, part.schema.field(column).type))

    return docs.mapInArrow(run, docs.schema)
