"""Periodic runs of words by Lyndon roots (operator 11).

A run (a stretch that no neighbour extends with the same smallest period) has, under one of
the two orders of its words, a Lyndon root that is the longest Lyndon word where it begins.
So the lengths of the longest Lyndon words under an order and its inverse name a candidate
period for every place. They come from the first phase of Baier's suffix sorter: suffixes are
grouped by a common beginning, the groups are taken from the greatest down, and each suffix
of the group at hand lengthens the beginning of the nearest lower suffix before it; when all
groups are done, a suffix's beginning is its longest Lyndon word. Candidates are extended to
both sides by longest common extensions, found exactly from ranks of stretches of 1, 2, 4, ...
words, for all texts of a slice side by side.

Runs of at least three periods use each of their words three times or more, so words that are
rarer in a text part it: nothing is searched across them, and short parts not at all.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.chunks import slices

#: Of a run: words at least, and periods at least.
MIN_LENGTH = 24
MIN_PERIODS = 3

#: (id, number of words) -> for each word the number of the word that stands there, or None.
Rewrite = Callable[[object, int], np.ndarray | None]

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def lyndon_lengths(words: np.ndarray) -> np.ndarray:
    """The length of the longest Lyndon word that begins at each place; ``words`` are their
    ranks in the order. Groups are stretches of ``order``; ``group`` is where a suffix's
    group begins and ``size`` is kept there."""
    n = len(words)
    sort = np.argsort(words, kind="stable")
    ranked = words[sort]
    begins = np.searchsorted(ranked, ranked)
    order = sort.tolist()
    place = np.empty(n, np.int64)
    place[sort] = np.arange(n)
    place = place.tolist()
    group = np.empty(n, np.int64)
    group[sort] = begins
    group = group.tolist()
    size = np.bincount(begins, minlength=n).tolist()
    length, lower = [1] * n, [-1] * n
    end = n
    while end:
        begin = group[order[end - 1]]
        members = order[begin:end]
        end = begin
        if len(members) == 1:
            i = members[0]
            p = i - 1
            while p >= 0 and group[p] >= begin:
                p = lower[p]
            lower[i] = p
            if p < 0:
                continue
            levels = ((1, (p,)),)
        else:
            members.sort()
            times: dict[int, int] = {}
            for i in members:
                p = i - 1
                while p >= 0 and group[p] >= begin:
                    p = lower[p]
                lower[i] = p
                if p >= 0:
                    times[p] = times.get(p, 0) + 1
            if not times:
                continue
            by_times: dict[int, list[int]] = {}
            for p, k in times.items():
                by_times.setdefault(k, []).append(p)
            levels = sorted(by_times.items(), reverse=True)
        own = length[members[0]]
        # those met most often become the greatest of their group's new groups
        for k, met in levels:
            for p in met:
                g = group[p]
                size[g] -= 1
                to, at = g + size[g], place[p]
                if to != at:
                    other = order[to]
                    order[at], place[other] = other, at
                    order[to], place[p] = p, to
            news = [group[p] + size[group[p]] for p in met]
            for p, new in zip(met, news):
                group[p] = new
                size[new] += 1
                length[p] += k * own
    return np.array(length, np.int64)


class Extensions:
    """Longest common extensions in a sequence that begins and ends with words of its own.
    ``ranks[k]`` numbers the stretches of 2 ** k words by what they hold."""

    def __init__(self, words: np.ndarray, longest: int) -> None:
        self.ranks = [np.unique(words, return_inverse=True)[1]]
        while 2 << len(self.ranks) <= 2 * longest:
            last, half = self.ranks[-1], 1 << len(self.ranks) - 1
            right = np.full(len(last), -1, np.int64)
            right[:-half] = last[half:]
            self.ranks.append(np.unique(last * (len(last) + 1) + right + 1, return_inverse=True)[1])

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and ``b`` on are the same, for b > a."""
        found = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            at = b + found
            same = (at < len(rank)) & (rank[np.minimum(a + found, len(rank) - 1)] == rank[np.minimum(at, len(rank) - 1)])
            found += same << k
        return found

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and ``b`` are the same, for b > a."""
        found = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, at = self.ranks[k], a - found - (1 << k)
            same = (at >= 0) & (rank[np.maximum(at, 0)] == rank[np.maximum(b - found - (1 << k), 0)])
            found += same << k
        return found


def runs_of(parts: list[np.ndarray], min_length: int = MIN_LENGTH,
            min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of each part: part, start, length, period, sorted by these but the length."""
    found_at, found_period, kept, offset = [], [], [], [0]
    for words in parts:
        n = len(words)
        here = []
        if n >= min_length:
            codes = np.unique(words, return_inverse=True)[1]
            for ranks in (codes, codes.max() - codes):
                period = lyndon_lengths(ranks)
                at = np.flatnonzero((min_periods * period <= n) & (np.arange(n) + 2 * period <= n))
                q = period[at]
                # of a run with two periods at least, the leftmost root is followed by a copy
                same = (codes[at] == codes[at + q]) & (codes[at + q - 1] == codes[at + 2 * q - 1])
                here.append((at[same], q[same]))
        at = np.concatenate([x for x, _ in here]) if here else np.zeros(0, np.int64)
        if len(at):
            kept.append(len(offset) - 1)
            found_at.append(at)
            found_period.append(np.concatenate([q for _, q in here]))
        offset.append(offset[-1] + n)
    if not kept:
        return (np.zeros(0, np.int64),) * 4
    # parts side by side with a word of its own before each and after the last
    own = max(int(p.max()) for p in (parts[i] for i in kept)) + 1
    line, begins, place = [], [], 0
    for k, i in enumerate(kept):
        line += [[own + k], parts[i]]
        begins.append(place + 1)
        place += 1 + len(parts[i])
    words = np.concatenate([*line, [own + len(kept)]]).astype(np.int64)
    part = np.repeat(np.arange(len(kept)), [len(a) for a in found_at])
    base = np.array(begins)[part]
    a = np.concatenate(found_at) + base
    q = np.concatenate(found_period)
    extensions = Extensions(words, max(len(parts[i]) for i in kept))
    before, after = extensions.left(a, a + q), extensions.right(a, a + q)
    start, length = a - before - base, before + q + after
    runs = np.stack((np.array(kept)[part], start, q, length), axis=1)
    runs = np.unique(runs[length >= np.maximum(min_length, min_periods * q)], axis=0)
    return runs[:, 0], runs[:, 1], runs[:, 3], runs[:, 2]


def frequent_parts(words: np.ndarray, min_length: int = MIN_LENGTH, times: int = MIN_PERIODS) -> np.ndarray:
    """Begin and end of the stretches of words that stand in the text ``times`` times or more;
    no shorter ones than ``min_length``."""
    often = np.zeros(len(words) + 2, np.int8)
    if len(words):
        often[1:-1] = np.bincount(words)[words] >= times
    turns = np.flatnonzero(np.diff(often)).reshape(-1, 2)
    return turns[turns[:, 1] - turns[:, 0] >= min_length]


def document_runs(docs: list[np.ndarray], min_length: int = MIN_LENGTH,
                  min_periods: int = MIN_PERIODS) -> list[np.ndarray]:
    """(start, length, period) of all runs of each document, by start and period."""
    bounds = [frequent_parts(words, min_length, min_periods) for words in docs]
    owner = np.repeat(np.arange(len(docs)), [len(b) for b in bounds])
    begins = np.concatenate([b[:, 0] for b in bounds]) if docs else np.zeros(0, np.int64)
    part, start, length, period = runs_of(
        [words[b:e] for words, bound in zip(docs, bounds) for b, e in bound], min_length, min_periods)
    found = np.stack((start + begins[part], length, period), axis=1) if len(part) else np.zeros((0, 3), np.int64)
    whose = owner[part] if len(part) else part
    cut = np.searchsorted(whose, np.arange(len(docs) + 1))
    return [found[cut[i]:cut[i + 1]] for i in range(len(docs))]


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """For each of ``n`` words whether some run has it after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def repeat_tail(doc_id: object, n: int) -> np.ndarray | None:
    """The rewriting that the query asks for: with h = crc32 of the decimal id, texts with
    h % 10 = 0 repeat a stretch from word (h // 10) % n on. Rows without an id stay."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % period
    return places


def find_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
              min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS,
              rewrite: Rewrite | None = None) -> DataFrame:
    """One row per input row: ``id_col``, runs array<struct<start, length, period>> by start
    and period, collapsed string: the words outside all runs and of each run's first period,
    joined by one space. ``rewrite`` may lay the words out anew beforehand.

    Words are runs of characters other than the ASCII white space. Null, empty and blank texts
    have no runs and collapse to an empty text. Repeated rows give repeated results, an empty
    table none; a null id is carried through; other columns are not read. A text is worked on
    whole: memory grows with the longest text of a task, about 100 bytes for each of its words
    that stand three times or more and 8 more for each doubling of their number.
    """
    if min_periods < 3:
        raise ValueError("runs of fewer than three periods need not repeat their words three times")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("id").to_pylist()
            for first, end in slices(texts):
                names, coded = [], []
                for text, name in zip(texts[first:end], ids[first:end]):
                    words = text.encode().split()  # bytes are split at ASCII white space alone
                    numbers: dict[bytes, int] = {}
                    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
                    places = rewrite(name, len(words)) if rewrite else None
                    if places is not None:
                        words, codes = list(map(words.__getitem__, places.tolist())), codes[places]
                    names.append(words)
                    coded.append(codes)
                found = document_runs(coded, min_length, min_periods)
                collapsed = []
                for words, runs in zip(names, found):
                    if len(runs):
                        words = [words[i] for i in np.flatnonzero(~dropped(len(words), runs)).tolist()]
                    collapsed.append(b" ".join(words).decode())
                flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
                offsets = np.cumsum([0, *map(len, found)])
                listed = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)],
                                               names=["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, end - first), listed, pa.array(collapsed, pa.string())],
                    names=["id", "runs", "collapsed"])

    schema = T.StructType([T.StructField("id", texts.schema["id"].dataType),
                           *T.StructType.fromDDL(f"runs {RUNS}, collapsed string").fields])
    return texts.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def digests(found: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``find_runs``: n_runs, the run of greatest length / period (ties: smallest
    start, then period; nulls if there is none) and SHA-256 digests of runs and text."""
    runs = F.col("runs")

    def greater(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    lines = F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        id_col, F.size(runs).cast("long").alias("n_runs"), F.aggregate(runs, none, greater).alias("best"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        id_col, "n_runs", "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
