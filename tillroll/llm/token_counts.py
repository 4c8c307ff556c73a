"""Token counts by a map-side two-tier lookup (operator 9).

Tier 1 is a compact table of frequent chunks and their token counts, broadcast to every
worker; its size is bounded by ``table_size``. Tier 2 is each worker's own cache of the
chunks that it missed, encoded by the library. No chunk or pre-token is ever shuffled:
one scan, one map.

The frequent chunks are counted over all documents beforehand: each task counts blocks of
chunks and reports those that its block holds several times, and of the sums the greatest make
the table. The table only saves time: a chunk that is not in it is encoded by the library, so
every count is exact.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import byte_bpe, sentence_pieces
from tillroll.llm.chunks import ChunkTable, count_texts
from tillroll.llm.storage import written

TABLE_SIZE = 65_536
#: Distinct chunks that a task counts before it reports, and the uses that it reports.
BLOCK_CHUNKS = 300_000
BLOCK_USES = 8

_TABLES: dict[tuple, ChunkTable] = {}


def _codec(path: str):
    """split, encode one text, encode many chunks: of the library that reads the file."""
    if path.endswith(".model"):
        return (sentence_pieces.split, sentence_pieces.encode_whole(path),
                sentence_pieces.encode_many(path))
    return byte_bpe.split, byte_bpe.encode_whole(path), byte_bpe.encode_many(path)


def frequent_chunks(texts: DataFrame, path: str, text_col: str, table_size: int,
                    block_chunks: int = BLOCK_CHUNKS, block_uses: int = BLOCK_USES) -> dict[str, int]:
    """Frequent chunk -> number of tokens: of the chunks of all texts the most used ones,
    ``table_size`` at most, as far as blocks of ``block_chunks`` distinct chunks hold them
    ``block_uses`` times. The driver gets no more rows than that."""
    split, _, encode_many = _codec(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def report() -> pa.RecordBatch:
            often = [(w, n) for w, n in seen.items() if n >= block_uses]
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in often], pa.string()), pa.array([n for _, n in often], pa.int64())],
                names=["chunk", "n"])

        for batch in batches:
            for text in batch.column(0):
                seen.update(split(text.as_py()) or ())
                if len(seen) >= block_chunks:
                    yield report()
        yield report()

    counts = written(texts.select(text_col).mapInArrow(count, "chunk string, n long")
                     .groupBy("chunk").agg(F.sum("n").alias("n")), "chunks")
    # steps of a quarter of a doubling: the lowest one from which on the table has room for all
    step = F.floor(4 * F.log2("n"))
    room, least = table_size, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        room -= r.n
        if room < 0:
            break
        least = r.step
    rows = counts.filter(step >= least).collect() if least is not None else []
    words = [r.chunk for r in rows]
    return dict(zip(words, encode_many(words)[2].tolist())) if words else {}


def token_counts(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, table_size: int = TABLE_SIZE) -> DataFrame:
    """One row per input row: ``id_col``, n_bytes (UTF-8), n_tokens, over_limit.

    A null text counts as empty (0 bytes, 0 tokens). Repeated rows give repeated results; a
    null id is carried through. Texts of any length are counted whole, a few of them at a
    time. Columns other than the two named are not read, whatever their names.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    run_id = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast(
        frequent_chunks(texts, path, "text", table_size))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, whole, encode_many = _codec(path)
        key = (path, run_id)
        if key not in _TABLES:
            _TABLES.clear()
            _TABLES[key] = ChunkTable(encode_many, keep_ids=False, seed=shared.value)
        for batch in batches:
            counts = count_texts(batch.column("text").to_pylist(), split, whole, _TABLES[key])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    schema = T.StructType([T.StructField("id", texts.schema["id"].dataType),
                           T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])
    counted = (texts.withColumn("n_bytes", F.octet_length("text").cast("long"))
               .mapInArrow(count, schema))
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
