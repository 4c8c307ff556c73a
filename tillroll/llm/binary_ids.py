"""Token ids as binary files: canonical length-limited Huffman codes (operator 8).

Layout of a written folder (parquet tables, so Spark's own committers make writes safe to
retry, on any store):

* ``codes``: id, length. Canonical codes follow from the lengths alone.
* ``segments``: one row per run of whole documents in ascending id order: ``part`` (the
  range partition), ``first`` (ids of the part before this segment), ``n_ids``, ``doc_ids``
  and ``doc_lengths``, ``bits`` (the codes, most significant bit first in little-endian
  64-bit words) and ``offsets`` (the bit at which every BLOCK-th id begins).

Blocks of BLOCK ids can be decoded independently from their bit offsets; the decoder steps
through all blocks of a segment side by side, one table lookup per id.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import byte_bpe
from tillroll.llm.chunks import encode_texts
from tillroll.llm.storage import new_path, remove

MAX_LENGTH = 18
BLOCK = 256
SEGMENT_IDS = 1_048_576

SEGMENTS = ("part int, first long, n_ids long, doc_ids array<long>, doc_lengths array<long>, "
            "bits binary, offsets binary")


# ---- codes ---------------------------------------------------------------------------
def code_lengths(counts: np.ndarray, max_length: int = MAX_LENGTH) -> np.ndarray:
    """Optimal code lengths of at most ``max_length`` bits (package-merge); 0: id not used."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_length:
        raise ValueError(f"{len(used)} ids do not fit codes of {max_length} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    level, from_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(max_length - 1):
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, packages))
        by = np.argsort(both, kind="stable")
        level = both[by]
        from_leaf.append(by < len(leaves))
    take = 2 * len(leaves) - 2
    found = np.zeros(len(leaves), np.int64)
    for is_leaf in reversed(from_leaf):
        n_leaves = int(is_leaf[:take].sum())
        found[:n_leaves] += 1
        take = 2 * (take - n_leaves)
    lengths[order] = found
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Code of each id: ascending by (length, id), as canonical Huffman codes are."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    size = lengths[order].astype(np.int64)
    # the code after one of n bits is (code + 1) << (next length - n): in units of the
    # longest length these are running sums of 2 ** (longest - n)
    longest = int(size.max()) if len(size) else 0
    step = np.left_shift(1, longest - size)
    before = np.cumsum(step) - step
    codes[order] = (before >> (longest - size)).astype(np.uint64)
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' codes as one bit string in 64-bit words, and the bit at which each block begins."""
    if not len(ids):
        return b"", np.zeros(0, np.uint64)
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    words = np.zeros((int(ends[-1]) + 63 >> 6) + 1, np.uint64)
    code = codes[ids]
    word, room = at >> 6, 64 - (at & 63) - size
    over = room < 0
    high = np.where(over, code >> np.maximum(-room, 0).astype(np.uint64),
                    code << np.maximum(room, 0).astype(np.uint64))
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    words[word[first]] += np.add.reduceat(high, first)
    # at most one code reaches over the end of each word
    words[word[over] + 1] += code[over] << (64 + room[over]).astype(np.uint64)
    return words.astype("<u8").tobytes(), at[::BLOCK].astype("<u8")


@functools.lru_cache(maxsize=2)
def _decode_table(lengths: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """The id and the length of the code that each string of ``longest`` bits begins with."""
    size = np.frombuffer(lengths, np.uint8)
    used = np.flatnonzero(size)
    order = used[np.lexsort((used, size[used]))]
    longest = int(size.max()) if len(used) else 1
    spans = np.left_shift(1, longest - size[order].astype(np.int64))
    ids = np.zeros(1 << longest, np.uint32)
    steps = np.ones(1 << longest, np.uint64)
    filled = int(spans.sum())
    ids[:filled] = np.repeat(order, spans)
    steps[:filled] = np.repeat(size[order], spans)
    return ids, steps, longest


def unpack(bits: bytes, offsets: np.ndarray, n_ids: int, lengths: bytes) -> np.ndarray:
    """The ids of a segment: all its blocks side by side, one id of each per step."""
    ids, steps, longest = _decode_table(lengths)
    words = np.frombuffer(bits, "<u8")
    blocks = len(offsets)
    out = np.zeros((BLOCK, blocks), np.uint32)
    at = offsets.astype(np.uint64)
    down = np.uint64(64 - longest)
    last = np.uint64(max(len(words) - 1, 0))
    for i in range(min(BLOCK, n_ids)):
        if i and i == n_ids - (blocks - 1) * BLOCK:  # the last block is over
            at = at[:-1]
            if not len(at):
                break
        word = at >> np.uint64(6)
        shift = at & np.uint64(63)
        window = words[word] << shift
        # the rest comes from the next word; a shift by 64 would be undefined
        window |= (words[np.minimum(word + np.uint64(1), last)] >> np.uint64(1)) >> (np.uint64(63) - shift)
        window >>= down
        out[i, :len(at)] = ids[window]
        at = at + steps[window]
    return out.T.reshape(-1)[:n_ids]


# ---- writing -------------------------------------------------------------------------
def tokenized(docs: DataFrame, path: str, *, id_col: str, text_col: str, end_id: int,
              wide: bool = False) -> DataFrame:
    """(doc_id, ids): the library's ids of each text and the end id, as little-endian
    unsigned integers of 16 bits (``wide``: 32)."""
    kind = "<u4" if wide else "<u2"
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_bpe.id_table(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                ids = encode_texts(part.column("text").to_pylist(), byte_bpe.marked,
                                   byte_bpe.encode_whole(path), table)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"),
                     pa.array([np.append(x, end_id).astype(kind).tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "ids"])

    return texts.mapInArrow(run, "doc_id long, ids binary")


def id_counts(ids: DataFrame, vocabulary: int, wide: bool = False) -> np.ndarray:
    """How often each id occurs in all documents; the driver gets a row per id of the
    vocabulary at most."""
    kind = "<u4" if wide else "<u2"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                joined = b"".join(batch.column("ids").slice(start, 1024).to_pylist())
                total += np.bincount(np.frombuffer(joined, kind), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])],
                                         names=["id", "n"])

    counts = np.zeros(vocabulary, np.int64)
    for row in (ids.select("ids").mapInArrow(count, "id long, n long")
                .groupBy("id").agg(F.sum("n").alias("n")).collect()):
        counts[row.id] = row.n
    return counts


def write_ids(docs: DataFrame, tokenizer_path: str, out: str, *, id_col: str = "doc_id",
              text_col: str = "text", end_id: int = 0) -> None:
    """Encode every text (null: empty), append ``end_id`` to each and write the folder
    ``out`` (see the module's text) in ascending id order.

    Null ids sort first; rows with the same id are ordered by their ids' bytes. An empty
    table gives empty tables. Other columns are not read.
    """
    spark = docs.sparkSession
    vocabulary = byte_bpe.tokenizer(tokenizer_path).get_vocab_size()
    wide = vocabulary > 65_536
    kind = "<u4" if wide else "<u2"
    raw = new_path(spark, "ids")
    tokenized(docs, tokenizer_path, id_col=id_col, text_col=text_col, end_id=end_id, wide=wide) \
        .write.option("compression", "zstd").parquet(raw)
    ids = spark.read.schema("doc_id long, ids binary").parquet(raw)
    lengths = code_lengths(id_counts(ids, vocabulary, wide))
    shared = spark.sparkContext.broadcast(lengths)  # a byte for each id of the vocabulary

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        codes = canonical_codes(shared.value)
        part, first = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        names: list[int | None] = []
        n = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, names, n, first
            bits, offsets = pack(np.concatenate(held), codes, shared.value)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([n], pa.int64()),
                 pa.array([names], pa.list_(pa.int64())),
                 pa.array([[len(x) for x in held]], pa.list_(pa.int64())),
                 pa.array([bits], pa.binary()), pa.array([offsets.tobytes()], pa.binary())],
                names=["part", "first", "n_ids", "doc_ids", "doc_lengths", "bits", "offsets"])
            first, held, names, n = first + n, [], [], 0
            return row

        for batch in batches:
            for doc_id, raw_ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                held.append(np.frombuffer(raw_ids.as_py(), kind))
                names.append(doc_id)
                n += len(held[-1])
                if n >= SEGMENT_IDS:
                    yield flush()
        if held:
            yield flush()

    (ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
     .mapInArrow(segments, SEGMENTS)
     .write.option("compression", "uncompressed").parquet(f"{out}/segments"))
    used = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(used, "id int, length int").coalesce(1).write.parquet(f"{out}/codes")
    remove(spark, raw)


# ---- reading -------------------------------------------------------------------------
def read_ids(spark: SparkSession, path: str, per_document=None,
             schema: str = "ids array<long>") -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and what ``per_document``
    makes of each document's ids (default: the ids).

    ``start`` comes from the segments' own offsets and the parts' totals, of which the
    driver gets one row per part.
    """
    per_document = per_document or (lambda ids: [ids.tolist()])
    segments = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    lengths = np.zeros(1 << 18, np.uint8)
    for row in spark.read.schema("id int, length int").parquet(f"{path}/codes").collect():
        if row.id >= len(lengths):
            lengths = np.resize(lengths, 2 * row.id)
        lengths[row.id] = row.length
    totals = {r.part: r.n for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, starts = 0, {}
    for part in sorted(totals):
        starts[part], before = before, before + totals[part]
    shared = spark.sparkContext.broadcast((lengths.tobytes(), starts))
    kinds = T.StructType.fromDDL("doc_id long, start long, n_tokens long, " + schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, starts = shared.value
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(kinds)
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            for i in range(batch.num_rows):
                ids = unpack(columns["bits"][i].as_py(), np.frombuffer(columns["offsets"][i].as_buffer(), "<u8"),
                             columns["n_ids"][i].as_py(), sizes)
                lengths = columns["doc_lengths"][i].values.to_numpy()
                ends = np.cumsum(lengths)
                before = starts[columns["part"][i].as_py()] + columns["first"][i].as_py()
                made = [per_document(ids[end - n:end]) for end, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [columns["doc_ids"][i].values, pa.array(before + ends - lengths), pa.array(lengths),
                     *[pa.array(list(c), f.type) for c, f in zip(zip(*made), list(arrow)[3:])]], schema=arrow)

    return segments.mapInArrow(run, kinds)


def crc32_of(ids: np.ndarray) -> list[int]:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return [zlib.crc32(ids.astype("<u4").tobytes())]
