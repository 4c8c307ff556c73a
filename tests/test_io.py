"""Sources and sinks: CSV ingest, parquet round trip, view registration, streaming ingest."""

import os
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.fixture_data import SALES, write_fixture
from tillroll.model import RetailModel
from tillroll.sources.sinks import write_clean
from tillroll.streaming import start_sales_ingest


def test_parquet_round_trip_and_register(spark):
    model = RetailModel.from_testdata(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="tillroll-clean-")
    write_clean(model.tables(), out)
    back = RetailModel.from_parquet(spark, out)
    assert back.sales.count() == model.sales.count()
    assert back.sales.columns == ["sale_id", "sales_date", "store_id", "product_id", "unit", "sales_month"]
    assert set(os.listdir(os.path.join(out, "sales"))) >= {"_SUCCESS"}
    back.register("rt_")
    n = spark.sql("SELECT count(*) FROM rt_store_sales_products").first()[0]
    assert n == model.sales_view().count()
    total = lambda m: m.sales_view().agg(F.sum(F.col("unit") * F.col("product_price"))).first()[0]
    assert total(back) == total(model)


def test_streaming_ingest_is_incremental(spark):
    inbox = tempfile.mkdtemp(prefix="tillroll-inbox-")
    out = tempfile.mkdtemp(prefix="tillroll-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="tillroll-stream-ckpt-")

    def drop_file(name, lines):
        with open(os.path.join(inbox, name), "w", newline="") as fh:
            fh.write("\r\n".join([SALES[0]] + lines) + "\r\n")

    drop_file("part1.csv", SALES[1:6])
    drop_file("part2.csv", SALES[6:] + ["20,13/45/2023,1,1,1"])
    for q in start_sales_ingest(spark, inbox, out, ckpt):
        q.awaitTermination()
    sales = spark.read.parquet(os.path.join(out, "sales_stream"))
    assert sales.count() == 9
    assert spark.read.parquet(os.path.join(out, "quarantine")).count() == 1

    drop_file("part3.csv", ["21,4/1/2023,1,2,3"])
    for q in start_sales_ingest(spark, inbox, out, ckpt):
        q.awaitTermination()
    sales = spark.read.parquet(os.path.join(out, "sales_stream"))
    assert sales.count() == 10
    assert sales.filter(F.col("sale_id") == 21).first().sales_month == "2023-04"


def test_csv_model_matches_fixture_counts(spark):
    p = write_fixture()
    m = RetailModel.from_csv(spark, p["sales"], p["products"], p["stores"], p["inventory"])
    assert (m.sales.count(), m.products.count(), m.stores.count(), m.inventory.count()) == (9, 4, 2, 5)


def test_partitioned_layout_prunes_and_matches(spark):
    """Trailing-window questions on the month-partitioned layout give the CSV model's
    results, and the window scan carries a runtime partition filter."""
    from tillroll.plans import inventory, products, seasons
    p = write_fixture()
    csv_model = RetailModel.from_csv(spark, p["sales"], p["products"], p["stores"], p["inventory"])
    out = tempfile.mkdtemp(prefix="tillroll-part-")
    write_clean(csv_model.tables(), out)
    pq = RetailModel.from_parquet(spark, out)
    assert "sales_month" in pq.sales_view().columns

    def same(f, *cols):
        a = sorted(tuple(r[c] for c in cols) for r in f(csv_model).collect())
        b = sorted(tuple(r[c] for c in cols) for r in f(pq).collect())
        assert a == b, (a, b)

    same(lambda m: inventory.stock_consistency(m, 90), "store_id", "total_sales_90d", "current_stock")
    same(lambda m: inventory.stock_consistency(m, 90, as_written=True), "store_name", "total_sales_90d")
    same(lambda m: products.declining_products(m, 3, zero_fill=True), "product_name", "month_year", "sales")
    same(lambda m: seasons.twelve_month_trend(m), "latest_revenue", "earliest_revenue", "trend")
    same(lambda m: seasons.last_month_trend(m), "trend", "last_month", "previous_month")
    same(lambda m: inventory.unsold_products(m, 30, "view"), "product_id")
    same(lambda m: inventory.overstock(m, 90, 5), "product_name", "total_stock", "units_sold_90d")
    df = seasons.last_month_trend(pq)  # eager latest date: a static partition filter
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_month" in plan and ">= 2023-01)" in plan
    spark.conf.set("tillroll.windows.eagerLatest", "false")  # lazy: pruned at runtime
    try:
        same(lambda m: seasons.last_month_trend(m), "trend", "last_month", "previous_month")
        df = seasons.last_month_trend(pq)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(sales_month" in plan and "subquery" in plan.lower()
    finally:
        spark.conf.unset("tillroll.windows.eagerLatest")


def test_cluster_conf_bounds():
    from tillroll.session import MAX_SHUFFLE_PARTITIONS, cluster_conf
    big = cluster_conf(100 << 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS
    small = cluster_conf(1 << 30, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 192


def test_streaming_daily_rollup_parts(spark):
    """The ingest appends one partial daily rollup per micro-batch; reading the parts
    re-aggregates them into the same rollup as the ingested sales."""
    from tillroll.sources.sinks import read_daily
    inbox = tempfile.mkdtemp(prefix="tillroll-inbox-")
    out = tempfile.mkdtemp(prefix="tillroll-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="tillroll-stream-ckpt-")

    def drop_file(name, lines):
        with open(os.path.join(inbox, name), "w", newline="") as fh:
            fh.write("\r\n".join([SALES[0]] + lines) + "\r\n")

    def check():
        sales = spark.read.parquet(os.path.join(out, "sales_stream"))
        want = sorted(tuple(r) for r in sales.groupBy("store_id", "product_id", "sales_date").agg(
            F.sum("unit").alias("u"), F.count(F.lit(1)).alias("n")).collect())
        got = sorted(tuple(r) for r in read_daily(spark, out).select(
            "store_id", "product_id", "sales_date", "unit", "lines").collect())
        assert got == want

    drop_file("part1.csv", SALES[1:6])
    for q in start_sales_ingest(spark, inbox, out, ckpt, daily_rollup=True):
        q.awaitTermination()
    check()
    drop_file("part2.csv", SALES[6:] + ["21,1/5/2023,1,1,3"])  # same store/product/day as sale 1
    for q in start_sales_ingest(spark, inbox, out, ckpt, daily_rollup=True):
        q.awaitTermination()
    check()
    (ingest,) = [d for d in os.listdir(os.path.join(out, "sales_stream_daily")) if d.startswith("ingest=")]
    assert len(os.listdir(os.path.join(out, "sales_stream_daily", ingest))) == 2


def test_release_drops_cached_dimensions(spark):
    m = RetailModel.from_testdata(spark, SF_SMALL)
    m.sales_view().count()
    assert any(k.endswith(".cached") for k in m._small)
    m.release()
    assert not any(k.endswith(".cached") for k in m._small)
    assert m.sales_view().count() > 0  # still usable: dimensions are read again


def test_streamed_sales_answer_questions_at_daily_grain(spark):
    """Dimensions written once, sales streamed in with their daily-rollup parts: the
    daily-grain model over that folder answers like the CSV model."""
    from tillroll.plans.registry import QUESTIONS
    p = write_fixture()
    csv_model = RetailModel.from_csv(spark, p["sales"], p["products"], p["stores"], p["inventory"])
    out = tempfile.mkdtemp(prefix="tillroll-e2e-")
    tables = csv_model.tables()
    write_clean({**tables, "sales": tables["sales"].filter("sale_id <= 4")}, out)  # the rest is streamed
    inbox = tempfile.mkdtemp(prefix="tillroll-inbox-")
    with open(os.path.join(inbox, "all.csv"), "w", newline="") as fh:
        fh.write("\r\n".join([SALES[0]] + [line for line in SALES[1:] if int(line.split(",")[0]) > 4]) + "\r\n")
    for q in start_sales_ingest(spark, inbox, out, tempfile.mkdtemp(prefix="tillroll-ck-"), daily_rollup=True):
        q.awaitTermination()
    streamed = RetailModel.from_parquet(spark, out, grain="daily")
    for key in ("q1", "q2", "q4", "q10", "q14", "q26", "q29", "q32", "q36", "q0_as_written"):
        a = sorted(repr(tuple(r)) for r in QUESTIONS[key](streamed).collect())
        b = sorted(repr(tuple(r)) for r in QUESTIONS[key](csv_model).collect())
        assert a == b, key


def _ingest(spark, out, lines, ckpt=None, **options):
    inbox = tempfile.mkdtemp(prefix="tillroll-inbox-")
    with open(os.path.join(inbox, "new.csv"), "w", newline="") as fh:
        fh.write("\r\n".join([SALES[0]] + lines) + "\r\n")
    for q in start_sales_ingest(spark, inbox, out, ckpt, **options):
        q.awaitTermination()


def _fixture_tables(spark, ids):
    p = write_fixture()
    model = RetailModel.from_csv(spark, p["sales"], p["products"], p["stores"], p["inventory"])
    model.sales = model.sales.filter(F.col("sale_id").isin(ids))
    return model


def _counts(spark, out):
    line = RetailModel.from_parquet(spark, out)
    daily = RetailModel.from_parquet(spark, out, grain="daily")
    return line.sales.count(), daily.daily().agg(F.sum("lines")).first()[0]


def test_batch_and_streamed_rows_are_all_kept(spark):
    """Whatever the order of batch writes, ingests and rollups, both grains hold every line."""
    out = tempfile.mkdtemp(prefix="tillroll-both-")
    _fixture_tables(spark, [1, 2]).write(out)  # batch without a rollup
    assert _counts(spark, out) == (2, 2)
    _ingest(spark, out, ["21,1/5/2023,1,1,3"], daily_rollup=True)  # stream with one
    assert _counts(spark, out) == (3, 3)
    _ingest(spark, out, ["22,1/6/2023,1,1,3", "23,1/6/2023,1,1,4"])  # a second ingest, without
    assert _counts(spark, out) == (5, 5)
    _fixture_tables(spark, [1, 2, 3]).write(out, daily=True)  # batch again, with a rollup
    assert _counts(spark, out) == (6, 6)
    _ingest(spark, out, ["24,2/6/2023,1,1,3"])
    assert _counts(spark, out) == (7, 7)
    _fixture_tables(spark, [1, 2, 3, 4, 5]).write(out)  # rewritten without: the old rollup goes
    assert _counts(spark, out) == (9, 9)
    _ingest(spark, out, ["25,2/7/2023,1,1,3"], tempfile.mkdtemp(prefix="tillroll-ck-"), daily_rollup=True)
    _ingest(spark, out, ["26,2/8/2023,1,1,3"], tempfile.mkdtemp(prefix="tillroll-ck-"), daily_rollup=True)
    assert _counts(spark, out) == (11, 11)
    _fixture_tables(spark, [6]).write(out, mode="append")
    assert _counts(spark, out) == (12, 12)


def test_stream_first_then_batch(spark):
    out = tempfile.mkdtemp(prefix="tillroll-first-")
    _ingest(spark, out, ["21,1/5/2023,1,1,3", "22,1/6/2023,1,1,3"], daily_rollup=True)
    _fixture_tables(spark, [1]).write(out, daily=True)
    assert _counts(spark, out) == (3, 3)


def test_replayed_batch_replaces_its_folders(spark):
    from tillroll.sources.sinks import read_daily
    from tillroll.streaming.ingest import clean_sales_stream, write_batch
    out = tempfile.mkdtemp(prefix="tillroll-replay-")
    raw = spark.createDataFrame([(1, "1/5/2023", 1, 1, 2, None)],
                                "Sale_ID int, date string, Store_ID int, Product_ID int, Unit int, _corrupt_record string")
    for _ in range(2):
        write_batch(clean_sales_stream(raw), 0, out, "x", True)
    assert spark.read.parquet(os.path.join(out, "sales_stream")).count() == 1
    assert read_daily(spark, out).count() == 1


def test_malformed_lines_go_to_the_quarantine(spark):
    """Clean and quarantined rows partition the input of each table, and of the stream."""
    folder = tempfile.mkdtemp(prefix="tillroll-broken-")

    def put(name, lines):
        with open(os.path.join(folder, name), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        return os.path.join(folder, name)

    broken = ["1,1/5/2023,1,1,xx", "2,1/5/2023,1,1", "3,1/5/2023,1,1,2,9", "4,13/45/2023,1,1,1", "5,1/5/2023,1,1,1"]
    paths = dict(
        sales=put("s.csv", [SALES[0], *broken]),
        products=put("p.csv", ["Product_ID,Product_Name,Product_Category,Product_Cost,Product_Price",
                               "1,a,c,$1.00 ,$2.00 ", "2,b,c,$1.00 ,free", "x,b,c,$1.00 ,$3.00 "]),
        stores=put("t.csv", ["Store_ID,Store_Name,Store_City,Store_Location,Store_Open_Date",
                             "1,n,Cuidad,l,2020-01-01", "2,n,c,l,soon", "3,n,c,l"]),
        inventory=put("i.csv", ["Store_ID,Product_ID,Stock_On_Hand", "1,1,5", "1,2,abc", "1"]))
    model = RetailModel.from_csv(spark, **paths, city_aliases={"Cuidad": "Ciudad"})
    got = {name: (df.count(), model.quarantine[name].count()) for name, df in model.tables().items()}
    assert got == {"sales": (1, 4), "products": (1, 2), "stores": (1, 2), "inventory": (1, 2)}
    assert sorted(r[0] for r in model.quarantine["inventory"].select("_corrupt_record").collect()) == ["1", "1,2,abc"]
    assert [r.store_city for r in model.stores.collect()] == ["Ciudad"]
    out = tempfile.mkdtemp(prefix="tillroll-broken-out-")
    _ingest(spark, out, broken)
    assert spark.read.parquet(os.path.join(out, "sales_stream")).count() == 1
    assert spark.read.parquet(os.path.join(out, "quarantine")).count() == 4


def _by_month(df):
    return {r[0]: (r.n, r.u) for r in df.groupBy("sales_month").agg(F.count(F.lit(1)).alias("n"), F.sum("unit").alias("u")).collect()}


def _daily_by_month(spark, out):
    from tillroll.sources.sinks import read_daily
    return {r[0]: (r.n, r.u) for r in read_daily(spark, out).groupBy("sales_month").agg(
        F.sum("lines").alias("n"), F.sum("unit").alias("u")).collect()}


def test_changed_months_are_replaced_in_place(spark):
    """Batch, stream, rewritten months, a new month, a failure between the steps of a rewrite:
    both grains hold the same rows at every time."""
    from tillroll.sources.sinks import read_clean, remove, write_months
    out = tempfile.mkdtemp(prefix="tillroll-months-")
    model = RetailModel.from_testdata(spark, SF_SMALL)
    model.write(out, daily=True)
    untouched = sorted(os.listdir(os.path.join(out, "sales", "sales_month=1999-03")))
    _ingest(spark, out, ["21,1/5/1999,1,1,3", "22,1/6/2023,1,1,4"], daily_rollup=True)
    streamed = {"1999-01": (1, 3), "2023-01": (1, 4)}
    months = model.sales.withColumn("sales_month", F.date_format("sales_date", "yyyy-MM"))

    def check(changed):
        want = _by_month(months.withColumn("unit", F.when(F.col("sales_month").isin(changed), F.col("unit") * 2)
                                           .otherwise(F.col("unit"))))
        for m, (n, u) in streamed.items():
            want[m] = (want.get(m, (0, 0))[0] + n, want.get(m, (0, 0))[1] + u)
        assert _by_month(read_clean(spark, out)["sales"]) == want
        assert _daily_by_month(spark, out) == want

    check([])
    double = lambda *m: model.sales.withColumn("unit", F.col("unit") * 2).filter(
        F.date_format("sales_date", "yyyy-MM").isin(*m))
    write_months(double("1999-01", "2000-02"), out, daily=True)
    check(["1999-01", "2000-02"])
    write_months(double("2001-05"), out)  # no rollup of it any more: rolled up when read
    assert not os.path.exists(os.path.join(out, "sales_daily", "sales_month=2001-05"))
    check(["1999-01", "2000-02", "2001-05"])
    write_months(double("1999-01"), out, daily=True)  # again: replaced again
    check(["1999-01", "2000-02", "2001-05"])
    # as after a failure behind the first step: the month's part of the rollup is gone
    remove(spark, os.path.join(out, "sales_daily", "sales_month=1997-07"))
    check(["1999-01", "2000-02", "2001-05"])
    assert sorted(os.listdir(os.path.join(out, "sales", "sales_month=1999-03"))) == untouched
    new = model.sales.limit(1).withColumn("sales_date", F.lit("2030-01-01").cast("date")).withColumn("unit", F.lit(7))
    write_months(new, out, daily=True)
    streamed["2030-01"] = (1, 7)
    check(["1999-01", "2000-02", "2001-05"])
