"""Mixing sources to target weights by a low-discrepancy schedule (operator 3).

1. ``targets``: the words that the mix takes of each source.
2. ``schedule``: slot i of the mix belongs to the source in whose share of the cumulative
   targets the golden-ratio point frac(i * phi) falls; slots are ranked per source. Every
   prefix of the mix is thus close to the target shares.
3. ``blocks``: each source's documents are laid end to end in a shuffled (hashed) order, the
   whole line again for a second epoch, and cut into as many equal-token blocks as the
   source has slots.
4. Slot and block join on (source, rank): the mix, as (slot, document, word range) rows.

A source of any size, also one that holds most rows, is spread over many buckets of the
shuffled order and many blocks; windows run within a bucket or over one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.storage import written

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0.6180339887498949
MAX_EPOCHS = 2
MAX_BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words, runs of characters other than ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def waterfill(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Targets that share ``total`` by weight, none above ``most`` times its source's size;
    what a full source leaves is shared again by weight until none is above."""
    targets = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = float(most * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in full]
    return targets


def targets(per_source: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target): the small table of sources goes through the driver; it
    has one row per source, not per document."""
    rows = sorted(per_source.collect(), key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.source_size for r in rows]
    own = [weights[i % len(weights)] for i in range(len(rows))]
    found = waterfill(sizes, own, share * sum(sizes), most)
    return per_source.sparkSession.createDataFrame(
        [(r.source, i, r.source_size, t) for i, (r, t) in enumerate(zip(rows, found))],
        "source string, source_no int, source_size long, target double")


def schedule(spark, wanted: list[float], block: int) -> DataFrame:
    """(slot, source_no, rank): every slot of the mix; a source with a target has one slot
    at least. Slots are ranked without a shuffle of slots into one task: counts per range
    of slots first, then ranks within a range."""
    total = sum(wanted)
    n = max(1, -(-int(total) // block))
    bounds, run = [], 0.0
    for t in wanted:
        run += t / total if total else 0.0
        bounds.append(run)
    point = (F.col("slot") * F.lit(GOLDEN)) % 1.0
    no = F.expr("size(filter(array({}), b -> b <= point))".format(
        ", ".join(f"{b!r}D" for b in bounds[:-1])) if len(bounds) > 1 else "0")
    span = 1 << 16
    drawn = (spark.range(n).withColumnRenamed("id", "slot").withColumn("point", point)
             .withColumn("source_no", no.cast("int")).withColumn("span", F.floor(F.col("slot") / span)))
    counts = drawn.groupBy("span", "source_no").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source_no").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy("span", "source_no").orderBy("slot")
    ranked = (drawn.withColumn("own", F.row_number().over(within) - 1)
              .join(counts, ["span", "source_no"])
              .select("slot", "source_no", (F.col("own") + F.col("before")).alias("rank")))
    lone = [(n + i, i, 0) for i, t in enumerate(wanted) if t >= 1]
    lone = spark.createDataFrame(lone, "slot long, source_no int, rank long")
    missing = lone.join(counts.select("source_no").distinct(), "source_no", "left_anti")
    return ranked.unionByName(missing)


def sized_documents(docs: DataFrame, id_col: str, text_col: str, source_col: str, row_col: str | None) -> DataFrame:
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col)).alias("size"), row.alias("row"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = MAX_EPOCHS,
        block: int = 1024, seed: int = 17, bucket_rows: int = 4096,
        row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(sources, mix). ``sources``: one row per document with size, source_size, target and
    its place on the source's line. ``mix``: (slot, row, doc_id, epoch, lo, hi): word ranges of
    documents, by place in the mix.

    Sources go by code point, null last (a source of its own), and weigh ``weights``,
    repeating. A null text has no words; documents and sources without words get no range
    and a target of 0. Repeated rows are documents of their own, told apart by a row
    number, or by the distinct numbers of ``row_col``, if given. An empty table gives empty results. Other columns are not read.
    """
    spark = docs.sparkSession
    sized = written(sized_documents(docs, id_col, text_col, source_col, row_col), "mix-sizes")
    wanted = written(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                             weights, share, most), "mix-targets")
    goal = [(r.target, r.source_size) for r in wanted.orderBy("source_no").collect()]
    slots = written(schedule(spark, [t for t, _ in goal], block), "mix-slots")
    n_slots = slots.groupBy("source_no").agg(F.count(F.lit(1)).alias("slots"))

    # the shuffled line: buckets by hash, so that no window holds more than a bucket
    n_rows = sized.count()
    buckets = max(1, n_rows // bucket_rows)
    # one row per source: counted above, so its broadcast is of a known size
    small = F.broadcast if len(goal) <= MAX_BROADCAST_SOURCES else (lambda df: df)
    placed = (sized.join(small(wanted), sized["source"].eqNullSafe(wanted["source"]))
              .select("row", "doc_id", sized["source"].alias("source"), "size", "source_no",
                      "source_size", "target",
                      F.xxhash64("doc_id", F.lit(seed)).alias("h"))
              .withColumn("bucket", F.pmod("h", F.lit(buckets))))
    order = Window.partitionBy("source_no", "bucket").orderBy("h", "doc_id", "row")
    line = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (placed.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
            .withColumn("before", F.coalesce(F.sum("words").over(line), F.lit(0))).drop("words"))
    placed = (placed.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .join(sums, ["source_no", "bucket"])
              .withColumn("lo", F.col("before") + F.col("end") - F.col("size"))
              .select("row", "doc_id", "source", "size", "source_no", "source_size", "target", "lo"))
    placed = written(placed, "mix-line")

    # word range [floor(r * T / k), floor((r + 1) * T / k)) of the repeated line is block r
    words = F.floor("target").cast("long")
    epochs = (placed.filter("size > 0").join(small(n_slots), "source_no")
              .withColumn("words", words)
              .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(int(most) - 1))))
              .withColumn("lo", F.col("lo") + F.col("epoch") * F.col("source_size"))
              .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("words")))
              .filter("lo < hi"))
    # words * slots may pass 64 bits at scale: whole-number division in decimals
    first = F.expr("cast((cast(lo as decimal(20,0)) * cast(slots as decimal(18,0))) div cast(words as decimal(20,0)) as bigint)")
    last = F.expr("cast((cast(hi - 1 as decimal(20,0)) * cast(slots as decimal(18,0))) div cast(words as decimal(20,0)) as bigint)")
    cut = lambda r: F.expr(  # noqa: E731  smallest word of block r: ceil(r * words / slots)
        f"cast((cast({r} as decimal(20,0)) * cast(words as decimal(18,0)) + slots - 1) div cast(slots as decimal(20,0)) as bigint)")
    ranges = (epochs.withColumn("rank", F.explode(F.sequence(first, last)))
              .withColumn("from_", F.greatest(F.col("lo"), cut("rank")))
              .withColumn("to_", F.least(F.col("hi"), cut("rank + 1")))
              .select("row", "doc_id", "source_no", "epoch", "rank",
                      (F.col("from_") - F.col("lo")).alias("lo"), (F.col("to_") - F.col("lo")).alias("hi")))
    mixed = ranges.join(slots, ["source_no", "rank"]).select("slot", "row", "doc_id", "epoch", "lo", "hi")
    return placed, mixed


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken: the words of each document that the mix
    takes, repeats counted. The parameters and cases are those of ``mix``."""
    placed, mixed = mix(docs, **options)
    taken = mixed.groupBy("row").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    return (placed.join(taken, "row", "left")
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them: once for each epoch that takes any of its words,
    with all columns. A document that an epoch takes only in part (where a source's target
    is reached) is cut to those words, joined by single spaces; untaken ones go, and with
    them texts without words. Rows are told apart by a written row number, so null and
    repeated ids are documents like others.
    """
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "mix-documents")
    _, mixed = mix(rows, row_col="_row", **options)
    taken = mixed.groupBy(F.col("row").alias("_row"), "epoch").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi")) \
        .drop("epoch")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.concat_ws(" ", F.slice(words, F.col("_lo").cast("int") + 1, (F.col("_hi") - F.col("_lo")).cast("int")))
    whole = (F.col("_lo") == 0) & (F.col("_hi") == word_count(F.col("text")))
    return (rows.join(taken, "_row").withColumn("text", F.when(whole, F.col("text")).otherwise(cut))
            .select(*docs.columns))
