"""Many small parts of streamed sales folded into one.

A stream that runs for months leaves a folder for every micro-batch, with a few small files for
each month. ``fold_stream`` writes the rows of many of them anew as one part, with few files:

1. The rows and rollups of the chosen micro-batches are written as ``ingest=folded/batch=<k>``.
2. ``sales_folds/fold=<k>`` says up to which micro-batch each ingest is folded. It comes by one
   rename, and with it the folded part counts and the micro-batches don't any more.
3. The folders of the folded micro-batches are removed.

Readers (``live``) go by step 2 alone, so a failure between the steps neither loses a row nor
counts one twice: before it the folded part isn't read and is overwritten by the next fold, after
it what is left of step 3 isn't read and is removed by the next one. The newest micro-batch of
every ingest stays: it is the one that a restarted stream may write again, so folding may run
while the stream does. One fold runs at a time. The step relies on renames of a folder
being atomic, as on a distributed file system.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.schemas import PARTITION_COLUMN

FOLDED = "folded"
FOLDS = "sales_folds"
PARTS = ("sales_stream", "sales_stream_daily", "sales_stream_monthly")
ROWS = PARTS[0]


def folder(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = folder(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = folder(spark, path)
    fs.delete(target, True)


def _values(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the ``key=value`` folders below ``path``."""
    fs, target = folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    return [n.split("=", 1)[1] for n in names if n.startswith(f"{key}=")]


def folded_up_to(spark: SparkSession, root: str) -> tuple[int, dict[str, int]]:
    """The last fold that counts (-1: none) and, per ingest, the last micro-batch folded: a row
    for each ingest, from the last fold's folder."""
    last = max(map(int, _values(spark, f"{root}/{FOLDS}", "fold")), default=-1)
    if last < 0:
        return -1, {}
    rows = spark.read.schema("ingest string, batch long").parquet(f"{root}/{FOLDS}/fold={last}").collect()
    return last, {r.ingest: r.batch for r in rows}


def live(spark: SparkSession, root: str) -> Column:
    """Whether a streamed part (ingest, batch) counts: folds that are announced, and the
    micro-batches that they don't hold. It names folders only, so it prunes them."""
    last, ends = folded_up_to(spark, root)
    gone = (F.col("ingest") == FOLDED) & (F.col("batch") > last)
    for ingest, batch in ends.items():
        gone = gone | ((F.col("ingest") == ingest) & (F.col("batch") <= batch))
    return ~gone


def parts(spark: SparkSession, root: str, name: str, finished: bool = False) -> set[tuple[str, int]]:
    """The (ingest, batch) folders of a streamed table; with ``finished`` those written to the end."""
    fs, target = folder(spark, f"{root}/{name}/ingest=*/batch=*" + ("/_SUCCESS" if finished else ""))
    found = [s.getPath() for s in fs.globStatus(target) or ()]
    found = [f.getParent() if finished else f for f in found]
    return {(f.getParent().getName().split("=", 1)[1], int(f.getName().split("=", 1)[1])) for f in found}


def of_parts(chosen: set[tuple[str, int]]) -> Column:
    """Whether a streamed row is of one of the parts; it names folders only."""
    out = F.lit(False)
    for ingest in sorted({i for i, _ in chosen}):
        out = out | ((F.col("ingest") == ingest) & F.col("batch").isin(sorted(n for i, n in chosen if i == ingest)))
    return out


def _finished(spark: SparkSession, root: str) -> dict[str, list[int]]:
    """Micro-batches whose rows are all there, per ingest."""
    out: dict[str, list[int]] = {}
    for ingest, n in sorted(parts(spark, root, ROWS, finished=True)):
        if ingest != FOLDED:
            out.setdefault(ingest, []).append(n)
    return out


def _clear(spark: SparkSession, root: str, ends: dict[str, int]) -> None:
    for name in PARTS:
        for ingest, end in ends.items():
            for n in _values(spark, f"{root}/{name}/ingest={ingest}", "batch"):
                if int(n) <= end:
                    remove(spark, f"{root}/{name}/ingest={ingest}/batch={n}")


def fold_stream(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Fold the streamed micro-batches below ``path``, all but the newest ``keep`` (one at
    least) of every ingest, and return how many were folded.

    Rows keep their month folders. Where micro-batches have rollups, the folded part gets
    rollups of all its rows. Nothing is written where there is nothing to fold.
    """
    from tillroll.sources import sinks

    root = path.rstrip("/")
    last, ends = folded_up_to(spark, root)
    _clear(spark, root, ends)  # what a failed fold left
    chosen = {}
    for ingest, batches in _finished(spark, root).items():
        fresh = [n for n in batches if n > ends.get(ingest, -1)]
        if fresh[:-max(1, keep)]:
            chosen[ingest] = fresh[:-max(1, keep)]
    if not chosen:
        return 0
    k, now = last + 1, {**ends, **{ingest: batches[-1] for ingest, batches in chosen.items()}}
    own = f"ingest={FOLDED}/batch={k}"
    picked = {(ingest, n) for ingest, batches in chosen.items() for n in batches}
    rows = sinks._streamed(spark, root).filter(of_parts(picked)).select(*sinks.SALES_COLUMNS)
    by_month = lambda df: df.sortWithinPartitions(PARTITION_COLUMN)
    (by_month(_packed(rows)).write.mode("overwrite").option("maxRecordsPerFile", 5_000_000)
     .partitionBy(PARTITION_COLUMN).parquet(f"{root}/{ROWS}/{own}"))
    # the rollups are read from the rows just written: few files, and the rows that will count
    rows = spark.read.schema(sinks.SALES_SCHEMA).parquet(f"{root}/{ROWS}/{own}")
    for name, rolled in zip(PARTS[1:], (sinks.rollup, lambda df: sinks.monthly(sinks.rollup(df)))):
        if exists(spark, f"{root}/{name}"):
            rolled(rows).write.mode("overwrite").parquet(f"{root}/{name}/{own}")
    announce(spark, root, k, now)
    _clear(spark, root, now)
    return sum(map(len, chosen.values()))


def _packed(rows: DataFrame) -> DataFrame:
    """The rows dealt by month and a hash of the row, so that a month's rows come in files of
    a few tasks, and a month that holds a third of all rows is spread over several."""
    salt = F.pmod(F.xxhash64("sale_id", "store_id", "product_id"), F.lit(8))
    return rows.repartition(PARTITION_COLUMN, salt)


def announce(spark: SparkSession, root: str, k: int, ends: dict[str, int]) -> None:
    """Let fold ``k`` count: its folder, with a row for each ingest, is renamed into place."""
    made = f"{root}/_fold-{uuid.uuid4().hex}"
    spark.createDataFrame(sorted(ends.items()), "ingest string, batch long").coalesce(1).write.parquet(made)
    fs, source = folder(spark, made)
    fs.mkdirs(folder(spark, f"{root}/{FOLDS}")[1])
    if not fs.rename(source, folder(spark, f"{root}/{FOLDS}/fold={k}")[1]):
        raise OSError(f"fold {k} could not be announced below {root}")
