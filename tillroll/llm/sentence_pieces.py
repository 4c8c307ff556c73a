"""SentencePiece encoding and decoding with a distinct-chunk table (operator 4).

The library writes each space as the marker U+2581 and puts one before the text. In a
model none of whose pieces has a marker behind another character, no piece crosses from a
word into the marker after it, so text cut before its runs of markers gives the same ids
cut by cut. Each distinct marked word is segmented once per worker and its ids are put
back by position; whole documents stay in place, nothing is shuffled.

``can_split`` checks that property of the model; texts that hold the marker itself, and
models without the property, are encoded whole.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.chunks import ChunkTable, encode_texts, EncodeMany, laid_out

MARK = "▁"
_MARKED = re.compile(r" +[^ ]*")


@functools.lru_cache(maxsize=4)
def processor(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.lru_cache(maxsize=4)
def can_split(path: str) -> bool:
    """Whether words can be cut apart: no piece has a marker behind another character, and
    the model leaves spaces as they are."""
    sp = processor(path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    if any(MARK in p.lstrip(MARK) for p in pieces):
        return False
    probe = "  a  b "
    return sp.decode(sp.encode(probe)) == probe and sp.piece_to_id(MARK) != sp.unk_id()


def split(text: str) -> list[str] | None:
    """Chunk keys: a run of spaces and the word behind it, without the run's first space,
    which the library adds again. None where chunks are not independent."""
    if not text:
        return []
    if MARK in text:
        return None
    if "  " in text or text[0] == " ":
        return [chunk[1:] for chunk in _MARKED.findall(" " + text)]
    return text.split(" ")


def encode_whole(path: str):
    return lambda text: processor(path).encode(text, num_threads=1)


def encode_many(path: str) -> EncodeMany:
    def run(keys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sp = processor(path)
        alone = [sp.piece_to_id(MARK)]
        found = sp.encode(keys, num_threads=1)
        return laid_out([ids if key else alone for key, ids in zip(keys, found)])
    return run


@functools.lru_cache(maxsize=2)
def id_table(path: str) -> ChunkTable:
    """This worker's table of distinct marked words."""
    return ChunkTable(encode_many(path))


def encode_decode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
                  begin: bool = True, end: bool = True) -> DataFrame:
    """One row per input row: ``id_col``, text (null: empty), ids array<int>, decoded string.

    ``ids`` are exactly the library's (no sampling), with begin and end ids if asked for;
    ``decoded`` is its decode(ids). An empty text gives the begin and end ids alone.
    Repeated rows give repeated results, a null id is carried through, and columns other
    than the two named are not read.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _encoded(batches, path, begin, end):
            ids, texts, arrays = found
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(texts, pa.string()),
                 pa.array(arrays, pa.list_(pa.int32())),
                 pa.array(_decoded(arrays, path), pa.string())], names=["id", "text", "ids", "decoded"])

    schema = T.StructType([T.StructField("id", texts.schema["id"].dataType),
                           T.StructField("text", T.StringType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("decoded", T.StringType())])
    return texts.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def digests(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
            with_ids: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, n_tokens (begin and end ids too), ids_sha256 (of the
    ids as little-endian unsigned 32-bit integers), decoded_sha256 (of the decoded text in
    UTF-8), and the ids if asked for. The same work as ``encode_decode``; texts stay in the
    Python worker."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, arrays in _encoded(batches, path, True, True):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(a) for a in arrays], pa.int64()),
                 pa.array([hashlib.sha256(a.astype("<u4").tobytes()).hexdigest() for a in arrays], pa.string()),
                 pa.array([hashlib.sha256(d.encode()).hexdigest() for d in _decoded(arrays, path)], pa.string()),
                 *([pa.array(arrays, pa.list_(pa.int32()))] if with_ids else [])],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])])

    schema = T.StructType([T.StructField("id", texts.schema["id"].dataType),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType()),
                           *([T.StructField("ids", T.ArrayType(T.IntegerType(), False))] if with_ids else [])])
    return texts.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, begin: bool, end: bool):
    """Per group of whole documents: their ids, texts and piece ids."""
    sp = processor(path)
    cut = split if can_split(path) else (lambda text: None if text else [])
    first = [sp.bos_id()] if begin else []
    last = [sp.eos_id()] if end else []
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            texts = part.column("text").to_pylist()
            arrays = [np.concatenate((first, ids, last)).astype(np.int32)
                      for ids in encode_texts(texts, cut, encode_whole(path), id_table(path))]
            yield part.column("id"), texts, arrays


def _decoded(arrays: list[np.ndarray], path: str) -> list[str]:
    sp = processor(path)
    return [sp.decode(a.tolist()) for a in arrays]
