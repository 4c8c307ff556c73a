"""Sets as bitmaps: exact distinct counts and values, merged over stores, months and streams."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tillroll.model import RetailModel
from tillroll.operators import sets
from tillroll.plans.registry import QUESTIONS
from tillroll.sources import testdata as td
from tillroll.sources.sinks import write_clean, write_months

KEYS = ("q41", "q41_all", "a12")


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def line(spark):
    return RetailModel.from_tables(spark, td.testdata_tables(spark, SF_ORACLE))


@pytest.fixture(scope="module")
def written(line, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("sets"))
    line.write(out, daily=True)
    return out


NUMBERS = [None, -70000, -32769, -32768, -32767, -1, 0, 1, 2, 32767, 32768, 32769, 65536, 65537, 2**40]


def test_members_and_counts_at_the_edges_of_blocks(spark):
    data = [(g, n) for g in ("a", "b", None) for i, n in enumerate(NUMBERS * 2) if g != "b" or i % 3]
    df = spark.createDataFrame(data + [("c", None)], "g string, n bigint")
    made = sets.collect(df, ["g"], "n")
    assert rows(sets.members(made, ["g"], "n")) == rows(df.distinct())
    assert rows(sets.count(made, ["g"], "c")) == rows(df.groupBy("g").agg(F.countDistinct("n")))
    parts = [sets.collect(df.filter(f"coalesce(n, 0) % 2 {op} 0"), ["g"], "n") for op in ("=", "<>")]
    both = parts[0].unionByName(parts[1]).unionByName(made)
    assert rows(sets.count(both, [], "c")) == rows(df.agg(F.countDistinct("n")))
    assert sets.members(made.limit(0), ["g"], "n").count() == 0


def test_daily_grain_counts_transactions_without_lines(spark, line, written):
    daily = RetailModel.from_parquet(spark, written, grain="daily")
    for key in KEYS:
        df = QUESTIONS[key](daily)
        assert rows(df) == rows(QUESTIONS[key](line)), key
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "sale_id" not in plan, key
        assert not [f for f in df.inputFiles() if "/sales/" in f], key


def test_sets_follow_rewritten_months_and_streamed_rows(spark, line, tmp_path):
    out = str(tmp_path)
    month = F.date_format("sales_date", "yyyy-MM")
    batch = line.sales.filter("sale_id % 3 <> 0")
    spoiled = batch.withColumn("sale_id", F.when(F.month("sales_date") == 3, F.col("sale_id") % 11)
                               .otherwise(F.col("sale_id")))
    model = RetailModel(spoiled, line.products, line.stores, line.inventory)
    model.write(out, daily=True)
    write_months(batch.filter(F.month("sales_date") == 3), out, daily=True)
    # months rewritten without a rollup, and streamed rows: their sets come from the rows
    write_months(batch.filter(F.month("sales_date") == 5), out)
    ids = {c: F.col(c).cast("int") for c in ("sale_id", "store_id", "product_id")}
    (line.sales.filter("sale_id % 3 = 0").withColumns(ids).withColumn("sales_month", month).withColumn("ingest", F.lit("i"))
     .withColumn("batch", F.lit(0)).write.partitionBy("ingest", "batch", "sales_month").parquet(f"{out}/sales_stream"))
    daily = RetailModel.from_parquet(spark, out, grain="daily")
    for key in KEYS:
        assert rows(QUESTIONS[key](daily)) == rows(QUESTIONS[key](line)), key


def test_sets_go_when_sales_are_replaced(spark, line, written, tmp_path):
    out = str(tmp_path)
    line.write(out, daily=True)
    write_clean(line.tables(), out)
    assert RetailModel.from_parquet(spark, out, grain="daily").sets is None


def test_sales_of_unknown_products_and_null_ids(spark, line, tmp_path):
    sales = line.sales.withColumn("product_id", F.when(F.col("sale_id") % 5 == 0, F.lit(-1)).otherwise(F.col("product_id"))) \
        .withColumn("unit", F.when(F.col("sale_id") % 7 == 0, F.lit(None).cast("int")).otherwise(F.col("unit"))) \
        .withColumn("sale_id", F.when(F.col("store_id") % 2 == 0, F.lit(None).cast("int")).otherwise(F.col("sale_id")))
    model = RetailModel(sales, line.products, line.stores, line.inventory)
    model.write(str(tmp_path), daily=True)
    daily = RetailModel.from_parquet(spark, str(tmp_path), grain="daily")
    for key in KEYS:
        assert rows(QUESTIONS[key](daily)) == rows(QUESTIONS[key](model)), key
