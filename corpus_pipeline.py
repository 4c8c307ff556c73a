"""A corpus pipeline of five stages over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet under the shared folder and reads it again as the next stage's documents. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import language_id, mixing, ngram_join, pii, sentence_pieces
from tillroll.llm.queries import PIECES, documents
from tillroll.llm.storage import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _as_documents(rows: DataFrame) -> DataFrame:
    """The columns of ``documents``, with n_chars of the present text."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language (null texts, texts without letters) go;
    ``lang`` becomes the predicted language."""
    docs = docs.select(*COLUMNS)
    found = language_id.identify(docs, language_id.train(docs), columns=("text", "source", "n_chars"))
    kept = found.filter(F.col("lang_pred") != language_id.UNDETERMINED)
    return kept.withColumnRenamed("lang_pred", "lang").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component the document with the smallest id stays, with
    all its texts if the id repeats; rows that repeat a whole row go. Rows without an id link
    with nothing and stay."""
    docs = docs.select(*COLUMNS)
    first = ngram_join.join(docs).filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates()
    return kept.unionByName(docs.filter("doc_id is null")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: each span of personal data is replaced by its kind in angle brackets; all
    documents stay."""
    return _as_documents(pii.mask(docs.select(*COLUMNS)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents appear once for each epoch of the mix that takes them."""
    return _as_documents(mixing.mixed_documents(docs.select(*COLUMNS)))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids of each row."""
    return sentence_pieces.digests(docs, PIECES, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("pieces", pieces),
]

#: No stage but the joins of ids could be written in SQL; tests hold ``run`` against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
