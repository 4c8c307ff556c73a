"""How much of the fact the plans read and shuffle, from the event log: latest dates come from
metadata and one month, large dimensions meet sums, ordered questions run no job when built
and read the fact once."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE, SF_SMALL
from tests.events import watched
from tests.test_large_path import NO_BROADCAST
from tillroll.model import RetailModel
from tillroll.operators.periods import latest_date
from tillroll.plans.registry import QUESTIONS
from tillroll.sources import testdata as td
from tillroll.sources.latest import FlatDates, MonthFolders, latest_in

WINDOWED = ["q0_corrected", "q0_as_written", "q10", "q22", "q30", "q33"]


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    """The sales of sf0.01 by month."""
    out = str(tmp_path_factory.mktemp("by-month"))
    RetailModel.from_testdata(spark, SF_ORACLE).write(out, daily=True)
    return out


@pytest.fixture
def large(spark):
    """Shuffle joins only."""
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)

    def made(tables=None, **options):
        model = RetailModel.from_tables(spark, tables or td.testdata_tables(spark, SF_ORACLE))
        model.broadcast_max_rows = 10
        for k, v in options.items():
            setattr(model, k, v)
        for name in ("products", "stores"):
            model._size(name)  # counted beforehand, not while a question is built
        return model

    yield made
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ---- the latest date ------------------------------------------------------------------
def test_flat_files_give_their_bounds_without_a_row(spark):
    dates = td.testdata_dates(SF_ORACLE)
    with watched(spark) as seen:
        found = dates.bounds(spark)
    assert found == tuple(td.testdata_sales(spark, SF_ORACLE).agg(F.min("sales_date"), F.max("sales_date")).first())
    assert seen.records_read <= 1  # one row of statistics for a file


@pytest.mark.parametrize("grain", ["line", "daily"])
@pytest.mark.parametrize("key", WINDOWED)
def test_latest_date_reads_one_month(spark, layout, key, grain):
    """Building a windowed question reads the last month's sales alone, and its result is that
    of a model without metadata."""
    model = RetailModel.from_parquet(spark, layout, grain)
    plain = RetailModel.from_parquet(spark, layout, grain)
    plain.dates = None
    for m in (model, plain):
        m.sales_view().limit(1).collect()  # dimensions counted and kept
    last = model.fact().filter("sales_month = (select max(sales_month) from values ('2001-11') t(sales_month))").count()
    with watched(spark) as seen:
        df = QUESTIONS[key](model)
    assert 0 < seen.records_read <= last + 10  # and the cached dimensions' batches
    assert rows(df) == rows(QUESTIONS[key](plain))


def test_steps_back_while_no_row_survives(spark, tmp_path):
    """The last two months hold sales of an unknown store only."""
    tables = td.testdata_tables(spark, SF_SMALL)
    tables["sales"] = tables["sales"].withColumn(
        "store_id", F.when(F.col("sales_date") >= "2001-09-15", -1).otherwise(F.col("store_id")))
    RetailModel.from_tables(spark, tables).write(str(tmp_path))
    model = RetailModel.from_parquet(spark, str(tmp_path))
    view = model.sales_view()
    want = view.agg(F.max("sales_date")).first()[0]
    assert want < dt.date(2001, 9, 15) and latest_in(view, model.months()) == want
    none = RetailModel.from_parquet(spark, str(tmp_path))
    none.sales = none.sales.withColumn("store_id", F.lit(-1))
    assert latest_in(none.sales_view(), none.months()) is None


def test_wrong_or_missing_metadata_costs_no_row(spark, tmp_path):
    """Files in which the columns stand in another order, files without statistics, an empty
    table, months that lie: the answer is that of a scan."""
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=17 * i) for i in range(40)]
    table = pa.table({"n": pa.array(range(40), pa.int32()), "day": pa.array(days)})
    pq.write_table(table.slice(0, 20), tmp_path / "a.parquet")
    pq.write_table(table.slice(20).select(["day", "n"]), tmp_path / "b.parquet")
    dates = FlatDates(str(tmp_path), "day")
    df = spark.read.parquet(str(tmp_path))
    assert latest_in(df, dates.months(spark), "day") == days[-1]
    pq.write_table(table, tmp_path / "c.parquet", write_statistics=False)
    assert latest_in(spark.read.parquet(str(tmp_path)), FlatDates(str(tmp_path), "day").months(spark), "day") == days[-1]
    for lie in ([dt.date(2030, 1, 1)], [dt.date(2020, 3, 1)], [], [dt.date(2021, 12, 1), dt.date(2021, 11, 1)]):
        assert latest_in(df, iter(lie), "day") == days[-1]
    empty = tmp_path / "none"
    spark.createDataFrame([], "day date").write.parquet(str(empty))
    assert latest_in(spark.read.parquet(str(empty)), FlatDates(str(empty), "day").months(spark), "day") is None
    assert list(MonthFolders(((str(empty), 0),)).months(spark)) == []
    assert spark.range(1).select(latest_date(df, "day", months=[]).alias("d")).first().d == days[-1]


# ---- ordered questions ----------------------------------------------------------------
@pytest.mark.parametrize("key", ["q4", "q14", "q18", "q31"])
def test_ordered_questions_run_no_job_when_built_and_read_the_fact_once(spark, large, key):
    model = large()
    n = {name: getattr(model, name).count() for name in ("sales", "products", "stores")}
    with watched(spark) as built:
        df = QUESTIONS[key](model)
    assert built.jobs == 0
    with watched(spark) as ran:
        df.collect()
    # the fact once; of the dimensions' tables (products, and stores of three) some rows more
    assert n["sales"] <= ran.records_read < 1.5 * n["sales"]


# ---- sums below the star join ---------------------------------------------------------
SUMMED = ["q1", "q3", "q7", "q9", "q13", "q17", "q19", "q20", "q21", "q23", "q27", "q36", "q38a", "q38c", "q38f", "q40_all", "q42_all"]


def test_large_dimensions_meet_sums(spark, large):
    """Where pairs of store and product repeat, fewer rows than the fact has are shuffled in
    all; without the sums each shuffle moves all of them."""
    tables = td.testdata_tables(spark, SF_SMALL)
    tables["sales"] = tables["sales"].withColumn("product_id", F.col("product_id") % 20 + 1) \
        .withColumn("copies", F.expr("explode(sequence(1, 20))")).drop("copies").repartition(4)
    n = tables["sales"].count()
    tables["sales"].write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/pairs")
    tables["sales"] = spark.read.parquet(path)
    shuffled = {}
    for first in (True, False):
        df = QUESTIONS["q38c"](large(tables, pre_aggregate=first))
        with watched(spark) as seen:
            result = rows(df)
        shuffled[first] = seen.shuffle_records, result
    assert shuffled[True][1] == shuffled[False][1]
    assert shuffled[True][0] < n / 2 and shuffled[False][0] >= n


@pytest.mark.parametrize("key", SUMMED)
def test_sums_give_the_same_answers(spark, large, key):
    from tests.oracle_compare import compare
    found = compare(spark, SF_ORACLE, [key], verbose=False, model=large())[key]
    assert found["ok"], found["problems"]


OF_PRODUCTS = ["q4", "q6", "q7", "q8", "q9", "q11", "q31", "q34", "q35", "q38c", "q38d", "q38e", "q39_all", "q42", "q42_all"]


def sold_everywhere(spark):
    """30 products sold in each of 20 stores. One store has two rows, one sale in 20 an unknown
    store, one in 30 no product."""
    stores = spark.range(20).unionByName(spark.range(1)).selectExpr(
        "id store_id", "concat('s', id) store_name", "'c' store_city", "'l' store_location", "date'2000-01-01' store_open_date")
    products = spark.range(30).selectExpr(
        "id product_id", "concat('p', id % 25) product_name", "concat('k', id % 4) product_category",
        "cast(id * 7 as decimal(10,2)) product_cost", "cast(id * 30 + 900.5 as decimal(10,2)) product_price")
    sales = spark.range(0, 1200, 1, 2).selectExpr(
        "id sale_id", "date_add(date'2001-01-01', cast(id % 300 as int)) sales_date",
        "if(id % 20 = 19, null, id % 21) store_id", "if(id % 30 = 7, null, id % 30) product_id", "cast(id % 900 as int) unit")
    stock = sales.selectExpr("store_id", "product_id", "1 stock_on_hand")
    return {"sales": sales, "products": products, "stores": stores, "inventory": stock}


@pytest.mark.parametrize("stores_large", [True, False])
def test_products_meet_one_row_each(spark, large, stores_large):
    """Questions on products: what is joined to large products, and grouped by their names, is a
    row for each product, not for each pair of store and product."""
    tables = sold_everywhere(spark)
    small, model = RetailModel.from_tables(spark, tables), large(tables, broadcast_max_rows=10 if stores_large else 25)
    assert model.is_small("stores") != stores_large and not model.is_small("products")
    for key in OF_PRODUCTS:
        assert rows(QUESTIONS[key](model)) == rows(QUESTIONS[key](small)), key
    assert model.view(of="products").count() == 29
    pairs = tables["sales"].select("store_id", "product_id").distinct().count()
    for key in ("q7", "q42", "q42_all"):
        df = QUESTIONS[key](model)
        with watched(spark) as seen:
            df.collect()
        # with large stores the pairs and the stores are shuffled once, and no more
        assert seen.shuffle_records < (2 * pairs + 700 if stores_large else pairs), key


def test_median_by_selection(spark, large):
    from tillroll.plans.products import median_daily_sales
    model = large()
    assert rows(median_daily_sales(model, selection=True)) == rows(median_daily_sales(model))
    assert rows(median_daily_sales(model, "revenue", selection=True)) == rows(median_daily_sales(model, "revenue"))
