"""Quality rules with cross-document line frequency (operator 10), DataFrame functions only.

Per document: word and symbol counts, repeated lines and words in repeated 5-word windows.
Across documents: each normalised line is hashed, the distinct texts that hold it are
counted per host (the ``source`` column), lines in more than a share of the host's texts are
removed, and documents that lose too much are rejected.

Windows are found inside a row with array functions; what is shuffled is one row per
distinct line of a document. A line that very many documents hold is counted by partial
aggregation; for the join back its few flagged hashes are copied over salts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.storage import written

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
SALTS = 32


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text, in order (empty: none)."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def window_hashes(ws: Column, n: int) -> Column:
    """The 64-bit hash of each window of n words, in order."""
    def hashes(h: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(h) - F.lit(n - 1))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + F.lit(k - 1)) for k in range(n)]))
    return F.when(F.size(ws) >= n, let(F.transform(ws, lambda w: F.xxhash64(w)), hashes)) \
        .otherwise(F.array().cast("array<bigint>"))


def covered_words(hashes: Column, n: int) -> Column:
    """Words inside windows that occur twice or more. Equal hashes are found by sorting
    (hash, place) pairs; only texts that have any are sorted."""
    def count(places: Column) -> Column:
        # each window adds the words that the window before it does not cover
        gaps = F.transform(places, lambda p, i: F.when(i == 0, F.lit(n)).otherwise(
            F.least(F.lit(n), p - F.get(places, i - F.lit(1)))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def repeated(pairs: Column) -> Column:
        same = lambda p, i, j: F.coalesce(p["h"] == F.get(pairs, j)["h"], F.lit(False))
        twice = F.filter(pairs, lambda p, i: (
            ((i > 0) & same(p, i, F.greatest(i - F.lit(1), F.lit(0)))) | same(p, i, i + F.lit(1))))
        return let(F.sort_array(F.transform(twice, lambda p: p["i"])), count)

    def pairs(h: Column) -> Column:
        both = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(both, repeated)

    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)) \
        .otherwise(pairs(hashes)).cast("long")


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, white space as one space, trimmed: what makes lines equal."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]", "0"), SPACE, " "))


def measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per document: the base counts and its distinct lines."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumns({
        "ws": words(F.col("text")),
        "lines": F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""),
    })
    rows = rows.withColumn("windows", window_hashes(F.col("ws"), 5))
    n_lines = F.size("lines")
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "host",
        F.size("ws").cast("long").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered_words(F.col("windows"), 5).alias("n_repeat_words"),
        F.xxhash64("text").alias("text_hash"),
        F.transform("lines", lambda x: F.struct(
            F.xxhash64(normalised(x)).alias("line"),
            F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")).alias("n"))).alias("lines"))


def line_frequencies(lines: DataFrame, host: str = "host", line: str = "line",
                     text_hash: str = "text_hash") -> DataFrame:
    """(host, line, documents): distinct texts of the host that hold the line. Copies of one
    text count once, so that copying a clean document does not condemn its lines."""
    return (lines.select(host, line, text_hash).distinct()
            .groupBy(host, line).agg(F.count(F.lit(1)).alias("documents")))


def common_lines(base: DataFrame, lines: DataFrame, max_share: float, max_documents: int) -> DataFrame:
    """The (host, line, documents) above both limits. A host's texts are counted once, copied
    over salts, so that the lines of a large host meet them in many tasks."""
    texts = (base.select("host", "text_hash").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
             .select(F.col("host").alias("t_host"), "texts",
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("t_salt")))
    counted = line_frequencies(lines).filter(F.col("documents") > max_documents)
    return (counted.join(texts, F.col("host").eqNullSafe(F.col("t_host"))
                         & (F.pmod("line", F.lit(SALTS)).cast("int") == F.col("t_salt")))
            .filter(F.col("documents") > max_share * F.col("texts")).select("host", "line", "documents"))


def quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            max_share: float = 0.05, max_documents: int = 5, max_removed: float = 0.5, min_words: int = 10,
            max_repeated_percent: int = 20) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    removed_words.

    base_failed: fewer than ``min_words`` words, or more than ``max_repeated_percent`` % of
    them in repeated 5-word windows. Lines that more than ``max_share`` of
    their host's distinct texts hold, and more than ``max_documents`` (for hosts of few),
    are removed; a document that passed the base rules is rejected if it loses more than
    ``max_removed`` of its words or is left with fewer than ``min_words``. A null text is empty and fails; a null host is a host of its own;
    repeated rows are judged alike, row by row; other columns are not read.
    """
    base = written(measured(docs, id_col, text_col, host_col), "quality-rows")
    lines = base.select("row", "host", "text_hash", F.explode("lines").alias("l")) \
        .select("row", "host", "text_hash", F.col("l.line").alias("line"), F.col("l.n").alias("n"))
    lines = lines.groupBy("row", "host", "text_hash", "line").agg(F.sum("n").alias("n"))
    common = common_lines(base, lines, max_share, max_documents)
    salted = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))) \
        .select(F.col("host").alias("c_host"), F.col("line").alias("c_line"), "salt")
    dealt = lines.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    removed = (dealt.join(salted, (dealt["line"] == salted["c_line"]) & (dealt["salt"] == salted["salt"])
                          & dealt["host"].eqNullSafe(salted["c_host"]), "left_semi")
               .groupBy("row").agg(F.sum("n").alias("removed_words")))
    failed = (F.col("n_words") < min_words) | \
        (100 * F.col("n_repeat_words") > max_repeated_percent * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > max_removed * F.col("n_words")) | (left < min_words)
    return (base.drop("lines", "host", "text_hash").join(removed, "row", "left")
            .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & ~depleted)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "removed_words"))
