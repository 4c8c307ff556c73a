"""N-gram Jaccard join by a token-group matrix (operator 7).

Exact: two documents link when the Jaccard similarity of their sets of n-word shingles is
at least ``percent`` %. The steps, each a Spark job over all documents:

1. ``frequent``: shingles that many documents hold, for the token order: rare ones first,
   frequent ones last. Any order gives the same links; this one keeps passages that many
   documents share out of the prefixes.
2. ``profiles``: per document the size and fingerprint of its set. Documents with equal
   sets are one *entity* from here on, named by its smallest id.
3. ``shared_tokens``: of an entity of n shingles only the first n - ceil(t n) + l(n) in
   that order are dealt out, packed by token range. Sets that link share at least
   min(l(x), l(y)) of these; entities that share fewer with all others are done. The first
   n - ceil(2t/(1+t) n) + l(n) are marked early: of a linked pair the smaller set shares
   l of its early ones with the larger one's prefix.
4. ``grouped``: similar entities become groups: those that agree in a minimum hash are
   compared in chunks, and those that link are one group; again with the groups' leaders
   and other hashes. A group of thousands of near copies is found here in linear work.
5. ``opened``: the token-group matrix holds, for each token, the groups that have it in any
   member. Entities of smaller groups meet other groups by tokens that are early on the
   side of the smaller set; the overlap of their whole prefix with the group's union then
   bounds what they can have in common. They are compared with the members of the groups
   that qualify, chunk by chunk. Two short documents around one shared passage meet only
   if it fills six sevenths of one of them; were it so of both, they would be linked.
6. Links between groups are joined into components.

A pair of different texts is left out only where a bound rules the link out, or where both
are already known to be in one component.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.chunks import slices
from tillroll.llm.components import connected_components
from tillroll.llm.storage import written

U = np.uint64
WORDS = 5
PERCENT = 75
#: Frequent shingles that are told apart; the driver and each worker hold this many at most.
FREQUENT = 1 << 17
BLOCK = 1 << 22  # shingles counted or packed at a time in a worker
DEALT = 1 << 16  # fingerprints of sets that a worker remembers to have dealt
CHUNK = 256  # entities compared at a time
FILTER_BITS = 23
KEYS = 3

_TABLE = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = [U(c | 1) for c in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                           0x27D4EB2F165667C5, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                           0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


# ---- shingles ------------------------------------------------------------------------
def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _piece_hashes(piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word of a byte array: polynomial hashes from one
    running sum, brought to a common power by the base's inverse."""
    word = ~_SPACE[piece]
    if not word.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(1 << max(20, int(len(piece)).bit_length()))
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[piece] * up[:len(piece)], dtype=np.uint64)))
    value = (run[ends] - run[starts]) * down[starts]
    return starts, mix(value + (ends - starts).astype(np.uint64) * _MIX[7])


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words (A-Z lowered, split at ASCII white space) and, for each text,
    where its words begin; one place more at the end."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(coded).lower() + b"\n", np.uint8)
    begins = np.concatenate(([0], np.cumsum([len(c) + 1 for c in coded])))
    starts, values, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + (1 << 20))
        if end < len(data):  # cut at white space: before it, or else behind it
            spaces = np.flatnonzero(_SPACE[data[at:end]])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:
                while end < len(data) and not _SPACE[data[end]]:
                    end += 1
        s, v = _piece_hashes(data[at:end])
        starts.append(s + at)
        values.append(v)
        at = end
    first = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return (np.concatenate(values) if values else np.zeros(0, np.uint64)), np.searchsorted(first, begins)


def shingle_sets(texts: list[str], words: int = WORDS) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes. Fewer words than a shingle: the whole
    sequence as one; no words: none."""
    for start, end in slices(texts):
        h, place = word_hashes(texts[start:end])
        n = max(0, len(h) - words + 1)
        windows = np.zeros(n, np.uint64)
        for k in range(words):
            windows += h[k:k + n] * _MIX[k % 7] * U(2 * (k // 7) + 1)
        windows = mix(windows)
        for a, b in zip(place[:-1], place[1:]):
            if b - a >= words:
                yield np.unique(windows[a:b - words + 1])
            elif b > a:
                whole = U(0)
                with np.errstate(over="ignore"):
                    for k in range(a, b):
                        whole = whole * _MIX[5] + h[k]
                    yield mix(np.array([whole + U(b - a) * _MIX[6]], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def _sets_of(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The shingle sets of a column of texts, of which a part at a time becomes strings."""
    for start in range(0, len(texts), 512):
        yield from shingle_sets(texts.slice(start, 512).to_pylist(), words)


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as two signed longs."""
    both = np.array([(s * _MIX[0]).sum(dtype=np.uint64), mix(s ^ _MIX[1]).sum(dtype=np.uint64)], np.uint64)
    a, b = mix(both + U(len(s))).view(np.int64)
    return int(a), int(b)


def least(n: int | np.ndarray):
    """l(n): how many prefix tokens linked sets share at least."""
    return 1 + n // 16


def needed_overlap(n, percent: int = PERCENT):
    return -(-percent * n // 100)


def early_tokens(n: int, percent: int = PERCENT) -> int:
    """How many of its first tokens a set needs to meet any linked set that is not smaller:
    such a pair has 2 percent / (100 + percent) of this set's tokens in common."""
    return n + (-2 * percent * n // (100 + percent)) + int(least(n))


def prefix(s: np.ndarray, frequent: np.ndarray, ranks: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The set's first tokens in the common order: rare ones by hash, then frequent ones by
    their rank."""
    n = len(s)
    take = min(n, n - int(needed_overlap(n, percent)) + int(least(n)))
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        hot = frequent[at] == s
        if hot.any():
            rare = s[~hot]
            if len(rare) >= take:
                return rare[:take]
            return np.concatenate((rare, s[hot][np.argsort(ranks[at[hot]], kind="stable")]))[:take]
    return s[:take]


# ---- steps 1 to 3 --------------------------------------------------------------------
def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def frequent(texts: DataFrame, words: int, keep: int = FREQUENT, local: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Shingles by how many documents hold them, counted in blocks of all documents (a block
    reports those that ``local`` of its documents hold): the ``keep`` most frequent, sorted
    by hash, and their ranks."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= local
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], names=["t", "n"])

        for batch in batches:
            for s in _sets_of(batch.column("text"), words):
                held.append(s)
                n += len(s)
                if n >= BLOCK:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    rows = (texts.select("text").mapInArrow(count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "t").limit(keep).collect())
    tokens = np.array([r.t for r in rows], np.int64).view(np.uint64)
    ranks = np.arange(len(rows))[::-1]  # the most frequent one comes last
    by = np.argsort(tokens)
    return tokens[by], ranks[by]


def profiles(texts: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, e, e2): size and fingerprint of each document's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, e, e2 = [], [], []
            for s in _sets_of(batch.column("text"), words):
                a, b = fingerprint(s)
                n.append(len(s))
                e.append(a)
                e2.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(e, pa.int64()), pa.array(e2, pa.int64())],
                names=["doc_id", "n_shingles", "e", "e2"])
    return texts.mapInArrow(run, "doc_id long, n_shingles long, e long, e2 long")


def shared_tokens(texts: DataFrame, words: int, percent: int, order: tuple[np.ndarray, np.ndarray],
                  total: int) -> DataFrame:
    """(token, e, early): prefix tokens that two different entities hold, with all their
    holders and whether the token is among the holder's early ones.

    Tokens are packed by range into binary rows of 12 bytes an entry, of which the lowest
    bit of the token's four tells early (0) from late; ranges are fine enough for about a
    quarter of a million entries each. Tokens that agree in the bits kept count as one,
    which can only bring more sets together.

    A task deals an entity once, however many copies its rows hold: it remembers the
    fingerprints of the last DEALT sets at least. So a token's range gets an entry per task
    from a text that is a third of all rows, not one per copy; ``meet`` drops what repeats.
    """
    bits = max(4, min(24, int(total // 750_000).bit_length()))
    shared = texts.sparkSession.sparkContext.broadcast(order)  # FREQUENT entries at most
    down = U(64 - bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners, firsts, n = [], [], [], 0
        dealt: tuple[set, set] = (set(), set())  # of this and of the last generation

        def repeated(entity: tuple[int, int]) -> bool:
            nonlocal dealt
            now, last = dealt
            known = entity in now or entity in last
            now.add(entity)  # those that come again stay
            if len(now) >= DEALT:
                dealt = (set(), now)
            return known

        def flush() -> pa.RecordBatch:
            t = np.concatenate(tokens)
            sizes = np.array([len(x) for x in tokens])
            own = np.repeat(np.array(owners, np.int64), sizes)
            place = np.arange(len(t)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            late = (place >= np.repeat(np.array(firsts), sizes)).astype(np.uint32)
            by = np.argsort(t, kind="stable")
            t, own, late = t[by], own[by], late[by]
            bucket = (t >> down).astype(np.int64)
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            low = (t >> (down - U(31))).astype(np.uint32) << np.uint32(1) | late
            edges = [0, *cuts.tolist(), len(t)]
            spans = list(zip(edges[:-1], edges[1:]))
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[edges[:-1]]), pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
                 pa.array([own[a:b].tobytes() for a, b in spans], pa.binary())], names=["bucket", "tokens", "owners"])

        for batch in batches:
            for s in _sets_of(batch.column("text"), words):
                if len(s):
                    entity = fingerprint(s)
                    if repeated(entity):
                        continue
                    p = prefix(s, *shared.value, percent)
                    tokens.append(p)
                    owners.append(entity[0])
                    firsts.append(early_tokens(len(s), percent))
                    n += len(p)
                    if n >= BLOCK // 4:
                        yield flush()
                        tokens, owners, firsts, n = [], [], [], 0
        if tokens:
            yield flush()

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        low = np.frombuffer(b"".join(table.column("tokens").to_pylist()), np.uint32)
        own = np.frombuffer(b"".join(table.column("owners").to_pylist()), np.int64)
        by = np.lexsort((low & 1, own, low >> 1))
        t, own, late = low[by] >> 1, own[by], low[by] & 1
        first = np.concatenate(([True], (t[1:] != t[:-1]) | (own[1:] != own[:-1])))
        t, own, late = t[first], own[first], late[first]
        _, at, n = np.unique(t, return_inverse=True, return_counts=True)
        more = n[at] > 1
        token = (np.int64(key[0].as_py()) << 31) | t[more].astype(np.int64)
        return pa.table({"token": token, "e": own[more], "early": late[more] == 0})

    return (texts.select("text").mapInArrow(deal, "bucket long, tokens binary, owners binary")
            .groupBy("bucket").applyInArrow(meet, "token long, e long, early boolean"))


# ---- sets and comparisons ------------------------------------------------------------
def _bloom(ids: DataFrame) -> np.ndarray:
    """A bitmap of 2^FILTER_BITS bits with the hashes of the ids: of a fixed size, however
    many ids. It only saves work: ids that pass by chance are dropped by a join."""
    h = F.shiftrightunsigned(F.xxhash64("rep"), 64 - FILTER_BITS)
    words = (ids.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("bits")).collect())
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in words:
        out[row.w] = row.bits
    return out


def entity_sets(texts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(rep, n, e, k0, k1, ..., tokens): the sets of the wanted entities (rep, e, e2), with
    KEYS minimum hashes, each combined with the size's order of magnitude."""
    bitmap = texts.sparkSession.sparkContext.broadcast(_bloom(wanted))
    seeds = _MIX[:KEYS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.asarray(batch.column("h"), np.int64)
            pick = (bitmap.value[h >> 6] >> (h & 63)) & 1 == 1
            part = batch.filter(pa.array(pick))
            ids = part.column("doc_id").to_pylist()
            rows = []
            for doc_id, s in zip(ids, _sets_of(part.column("text"), words)):
                if len(s):
                    level = np.array([int(np.log(len(s)) / np.log(4 / 3))], np.uint64)
                    keys = [int(mix(mix(s ^ c).min() + level * c).view(np.int64)[0]) for c in seeds]
                    rows.append((doc_id, len(s), *fingerprint(s), *keys, s.tobytes()))
            kinds = [pa.int64()] * (4 + KEYS) + [pa.binary()]
            columns = list(zip(*rows)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                             names=["rep", "n", "e", "e2", *(f"k{i}" for i in range(KEYS)), "tokens"])

    schema = "rep long, n long, e long, e2 long, " + ", ".join(f"k{i} long" for i in range(KEYS)) + ", tokens binary"
    h = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - FILTER_BITS)
    found = texts.filter("doc_id is not null").withColumn("h", h).mapInArrow(run, schema)
    # a document that repeats is taken once
    return found.join(wanted.select("rep", "e", "e2"), ["rep", "e", "e2"]).dropDuplicates(["rep", "e", "e2"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, by blocks of the tokens
    that both sides hold."""
    sizes_l, sizes_r = [len(s) for s in left], [len(s) for s in right]
    flat_l, flat_r = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(flat_l, flat_r)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(common):
        return out.astype(np.int64)

    def cells(flat: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        own = np.repeat(np.arange(len(sizes)), sizes)
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        hit = common[at] == flat
        own, at = own[hit], at[hit]
        by = np.argsort(at, kind="stable")
        return own[by], at[by]

    own_l, at_l = cells(flat_l, sizes_l)
    own_r, at_r = cells(flat_r, sizes_r)
    for start in range(0, len(common), 4096):
        width = min(4096, len(common) - start)
        a, b = np.searchsorted(at_l, (start, start + width))
        c, d = np.searchsorted(at_r, (start, start + width))
        m_l = np.zeros((len(left), width), np.float32)
        m_r = np.zeros((len(right), width), np.float32)
        m_l[own_l[a:b], at_l[a:b] - start] = 1
        m_r[own_r[c:d], at_r[c:d] - start] = 1
        out += m_l @ m_r.T
    return out.astype(np.int64)


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether 100 * intersection >= percent * union, for all pairs."""
    both = overlaps(left, right)
    n = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
    return 100 * both >= percent * (n - both)


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint64) for b in column.to_pylist()]


def link_groups(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """(rep, to): each of the rows (rep, tokens, key) that is in a component of several rows
    within its chunk of the rows with its key, and the smallest rep of that component."""
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    dealt = rows.join(sizes, key).withColumn(
        "chunk", F.expr(f"pmod(xxhash64(rep), cast(ceil(size / {CHUNK}) as bigint))"))

    def run(table: pa.Table) -> pa.Table:
        reps = np.asarray(table.column("rep"), np.int64)
        sets = _sets(table.column("tokens"))
        near = linked(sets, sets, percent)
        label = np.full(len(reps), -1)
        out_rep, out_to = [], []
        for i in np.argsort(reps, kind="stable"):
            if label[i] < 0:
                todo, member = [i], np.zeros(len(reps), bool)
                member[i] = True
                while todo:
                    fresh = near[todo].any(axis=0) & ~member
                    member |= fresh
                    todo = np.flatnonzero(fresh).tolist()
                label[member] = i
                if member.sum() > 1:
                    out_rep += reps[member].tolist()
                    out_to += [int(reps[i])] * int(member.sum())
        return pa.table({"rep": pa.array(out_rep, pa.int64()), "to": pa.array(out_to, pa.int64())})

    return dealt.select(key, "chunk", "rep", "tokens").groupBy(key, "chunk").applyInArrow(run, "rep long, to long")


# ---- step 4 --------------------------------------------------------------------------
def grouped(sets: DataFrame, percent: int) -> DataFrame:
    """(rep, grp): the group of each entity, named by a member. Each pass compares what is
    left of the last one's groups, their leaders: first by one minimum hash, once more to
    bring the chunks of a large group together, then by the other hashes."""
    groups = sets.select("rep", F.col("rep").alias("grp")).distinct()
    leaders = sets
    for n, key in enumerate(["k0", "k0", *(f"k{i}" for i in range(1, KEYS))]):
        links = written(link_groups(leaders.select("rep", "tokens", key), key, percent)
                        .groupBy("rep").agg(F.min("to").alias("to")), "group-links")
        groups = (groups.join(links.select(F.col("rep").alias("grp"), "to"), "grp", "left")
                  .select("rep", F.coalesce("to", "grp").alias("grp")))
        if n < KEYS:
            leaders = leaders.join(links.filter("rep <> to").select("rep"), "rep", "left_anti")
    return written(groups, "groups")


# ---- step 5 --------------------------------------------------------------------------
def _can_link(percent: int) -> str:
    """Whether a set of n tokens may link with a member of a group whose sizes run from
    ``shortest`` to ``longest``, given the ``overlap`` of its prefix and the group's.

    A common token that is not in both prefixes is behind the prefix that ends first, so a
    pair has at most overlap + the longer of the two rests in common, and needs
    percent / (100 + percent) of both sizes. Over the sizes that can link at all, that is
    easiest at the smallest or the largest; 3 makes up for rounding in between.
    """
    rest = lambda n: f"(({percent} * {n} + 99) div 100 - 1 - {n} div 16)"
    small = f"greatest(shortest, ({percent} * n + 99) div 100)"
    large = f"least(longest, (100 * n) div {percent})"
    may = lambda m: (f"overlap + 3 + greatest({rest('n')}, {rest(m)}) "  # noqa: E731
                     f">= ({percent} * (n + {m}) + {99 + percent}) div {100 + percent}")
    return f"{small} <= {large} and ({may(small)} or {may(large)})"


def opened(sets: DataFrame, groups: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between groups."""
    sizes = sets.select("rep", "n").join(groups, "rep").groupBy("grp").agg(
        F.count(F.lit(1)).alias("members"), F.min("n").alias("shortest"), F.max("n").alias("longest"))
    named = sets.select("e", "rep", "n").join(groups, "rep").join(sizes, "grp")
    tokens = shared.join(named, "e").select("token", "early", "rep", "n", "grp", "members", "shortest", "longest")
    # the matrix: (token, group), for tokens that more than one group holds
    several = tokens.groupBy("token").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"),
                                          F.count(F.lit(1)).alias("holders")).filter("lo <> hi")
    tokens = written(tokens.join(several.select("token", "holders"), "token"), "group-tokens")
    other = [F.col("grp").alias("other"), F.col("members").alias("other_members")]
    matrix = tokens.select("token", *other, "shortest", "longest").distinct()
    own = tokens.select("token", "early", "rep", "n", "grp", "members")
    # of its early tokens a set shares l(n) with a linked set that is not smaller, so one at
    # least of any choice that leaves l(n) - 1 out: those with the most holders
    hits, by_holders = Window.partitionBy("rep"), Window.partitionBy("rep").orderBy("holders", "token")
    early = written(tokens.filter("early").withColumns({
        "hits": F.count(F.lit(1)).over(hits), "place": F.row_number().over(by_holders)})
        .filter("place <= hits - n div 16").drop("hits", "place"), "early-tokens")
    small = early.groupBy("token", *other).agg(F.min("n").alias("shortest"), F.max("n").alias("longest"))
    smaller = (F.col("members") < F.col("other_members")) | (
        (F.col("members") == F.col("other_members")) & (F.col("grp") < F.col("other")))
    least_n = f"1 + (({percent} * n + 99) div 100) div 16"

    def meet(rows: DataFrame, groups_of: DataFrame, sizes_fit: str) -> DataFrame:
        return (rows.select("token", "rep", "n", "grp", "members")
                .join(groups_of, "token").filter(smaller & F.expr(sizes_fit))
                .select("rep", "n", "grp", "other", "other_members"))

    # the set asked for is the smaller one of a pair, or the group's member is
    asking = meet(early, matrix, f"longest >= n and {percent} * shortest <= 100 * n")
    asked_of = meet(own, small, f"shortest <= n and 100 * longest >= {percent} * n")
    met = written(asking.unionByName(asked_of).distinct(), "met-groups")
    bound = (met.join(own.select("rep", "token"), "rep").join(matrix.select("token", "other"), ["token", "other"])
             .groupBy("rep", "n", "grp", "other", "other_members").agg(F.count(F.lit(1)).alias("overlap"))
             .filter(F.expr(f"overlap >= {least_n}"))
             .join(sizes.select(F.col("grp").alias("other"), "shortest", "longest"), "other")
             .filter(_can_link(percent)).select("rep", "grp", "other", "other_members"))
    bound = written(bound, "open-groups")

    # queries in blocks against the group's members in chunks
    asked = bound.groupBy("other").agg(F.count(F.lit(1)).alias("asked"), F.max("other_members").alias("m"))
    asked = asked.withColumns({"blocks": F.expr(f"cast(ceil(asked / {4 * CHUNK}) as int)"),
                               "chunks": F.expr(f"cast(ceil(m / {CHUNK}) as int)")}).select("other", "blocks", "chunks")
    queries = (bound.select("rep", "grp", "other").join(asked, "other")
               .withColumn("block", F.expr("pmod(xxhash64(rep), blocks)"))
               .withColumn("chunk", F.explode(F.expr("sequence(0L, chunks - 1L)")))
               .join(sets.select("rep", "tokens"), "rep").select("other", "block", "chunk", "grp", "tokens"))
    members = (groups.withColumnRenamed("grp", "other").join(asked, "other")
               .withColumn("chunk", F.expr("pmod(xxhash64(rep), cast(chunks as bigint))"))
               .withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1L)")))
               .join(sets.select("rep", "tokens"), "rep")
               .select(*[F.col(c).alias(f"m_{c}") for c in ("other", "block", "chunk", "tokens")]))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        hits: set[int] = set()
        other = None
        if left.num_rows and right.num_rows:
            other = left.column("other")[0].as_py()
            own, against = _sets(right.column("m_tokens")), left.column("grp").to_pylist()
            for start in range(0, left.num_rows, CHUNK):
                near = linked(_sets(left.column("tokens").slice(start, CHUNK)), own, percent).any(axis=1)
                hits.update(g for g, x in zip(against[start:start + CHUNK], near) if x)
        return pa.table({"a": pa.array(sorted(hits), pa.int64()), "b": pa.array([other] * len(hits), pa.int64())})

    return (queries.groupBy("other", "block", "chunk")
            .cogroup(members.groupBy("m_other", "m_block", "m_chunk"))
            .applyInArrow(compare, "a long, b long"))


# ---- the join ------------------------------------------------------------------------
def join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
         percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles (size of its set) and component_id (the
    smallest id reachable by links, its own included).

    Documents without words (null, empty or white space) have an empty set, link with
    nothing and are components of their own. Repeated rows of one id are one node; rows
    with a null id link with nothing and get a null component. An empty table gives no
    rows. Other columns are not read.
    """
    texts = _texts(docs, id_col, text_col)
    order = frequent(texts, words)
    rows = written(profiles(texts, words), "profiles")
    full = rows.filter("n_shingles > 0 and doc_id is not null")
    entities = written(full.groupBy("e", "e2").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n")),
                       "entities")
    total = entities.agg(F.sum("n")).first()[0] or 0
    shared = written(shared_tokens(texts, words, percent, order, total), "shared-tokens")
    enough = F.expr(f"1 + (({percent} * n + 99) div 100) div 16")
    wanted = (shared.groupBy("e").agg(F.count(F.lit(1)).alias("hits")).join(entities, "e")
              .filter(F.col("hits") >= enough).select("rep", "e", "e2"))
    wanted = written(wanted, "wanted")
    sets = written(entity_sets(texts, wanted, words), "sets", "uncompressed")
    groups = grouped(sets, percent)
    links = opened(sets, groups, shared, percent)
    same = groups.filter("rep <> grp").select(F.col("rep").alias("a"), F.col("grp").alias("b"))
    # an id with several texts is one node: its texts' entities are linked by it
    several = full.groupBy("doc_id").agg(F.min(F.struct("e", "e2")).alias("lo"), F.max(F.struct("e", "e2")).alias("hi")) \
        .filter("lo <> hi").select("doc_id")
    one = full.join(several, "doc_id", "left_semi").join(entities, ["e", "e2"]) \
        .select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    labels = connected_components(links.unionByName(same).unionByName(one))
    labels = entities.join(labels.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("e", "e2", F.coalesce("component", "rep").alias("component_id"))
    return (rows.join(labels, ["e", "e2"], "left")
            .select(F.col("doc_id").alias(id_col), "n_shingles",
                    F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id")))
