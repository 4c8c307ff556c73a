"""Round trips of ingest and sinks (S2, S3, S6) on a model.

The model's tables are rendered as raw delimited files below the shared folder, a known share of
their lines broken, and read back through the readers and the cleaning; or written as cleaned
tables, some months rewritten, and read back at both grains. The results hold counts and sums
of what came back, so that every row passes through the files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.model import RetailModel
from tillroll.operators.cleaning import clean_raw_tables, clean_sales, rejected
from tillroll.operators.grouping import revenue_by
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources import delimited
from tillroll.sources.keys import audit_append
from tillroll.sources.schemas import CORRUPT_COLUMN, INVENTORY_RAW, PARTITION_COLUMN, PRODUCTS_RAW, SALES_RAW, STORES_RAW
from tillroll.sources.sinks import read_clean, read_daily, write_clean, write_months

MONEY = "decimal(38,2)"
#: Of this many keys each broken form takes one (kept equal in the SQL oracle).
BROKEN_STEP = 97


def _folder(model: RetailModel, name: str) -> str:
    return f"{ensure_checkpoint_dir(model.sales.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_lines(lines: DataFrame, header: str, path: str) -> None:
    """Text lines (column ``value``) as files below ``path`` that each begin with the header."""
    spark = lines.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = lines.select((F.monotonically_increasing_id() % n).alias("part"), F.lit(1).alias("place"), "value")
    heads = spark.range(n).select(F.col("id").alias("part"), F.lit(0).alias("place"), F.lit(header).alias("value"))
    (body.unionByName(heads).repartition(n, "part").sortWithinPartitions("part", "place")
     .select("value", "part").write.partitionBy("part").text(path))


def _header(schema) -> str:
    return ",".join(n for n in schema.names if n != CORRUPT_COLUMN)


def _line(*fields: Column | str) -> Column:
    return F.concat_ws(",", *[F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit("")) for f in fields])


def _broken(key: Column, forms: dict[int, Column], whole: Column) -> Column:
    """The line, or one of its broken forms by the key's remainder."""
    out = None
    for remainder, form in forms.items():
        hit = F.pmod(key, F.lit(BROKEN_STEP)) == remainder
        out = F.when(hit, form) if out is None else out.when(hit, form)
    return out.otherwise(whole)


def sales_lines(model: RetailModel) -> DataFrame:
    """Sales as text lines. By sale id: 0 a unit that is no number, 1 a missing field, 2 a field
    too many, 3 an impossible date; 4 a padded date and 5 no date at all are good lines."""
    day = F.date_format("sales_date", "M/d/yyyy")
    whole = _line("sale_id", day, "store_id", "product_id", "unit")
    forms = {
        0: _line("sale_id", day, "store_id", "product_id", F.concat(F.lit("x"), F.col("unit"))),
        1: _line("sale_id", day, "store_id", "product_id"),
        2: _line("sale_id", day, "store_id", "product_id", "unit", F.lit(9)),
        3: _line("sale_id", F.date_format("sales_date", "'13/45/'yyyy"), "store_id", "product_id", "unit"),
        4: _line("sale_id", F.date_format("sales_date", "MM/dd/yyyy"), "store_id", "product_id", "unit"),
        5: _line("sale_id", F.lit(""), "store_id", "product_id", "unit"),
    }
    return model.sales.select(_broken(F.col("sale_id"), forms, whole).alias("value"))


def sales_round_trip(model: RetailModel) -> DataFrame:
    """S2: lines and units that come back from raw sales files, per year, and the quarantine."""
    path = _folder(model, "raw-sales")
    write_lines(sales_lines(model), _header(SALES_RAW), path)
    typed = clean_sales(delimited.read_sales(model.sales.sparkSession, f"{path}/part=*"))
    bad = F.coalesce(rejected(typed), F.lit(False))
    kind = F.when(bad, "quarantined").otherwise("clean")
    return typed.groupBy(kind.alias("kind"), F.when(~bad, F.year("sales_date")).cast("int").alias("year")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.sum(F.when(~bad, F.col("unit"))).cast("bigint").alias("units"))


def dimensions_round_trip(model: RetailModel) -> DataFrame:
    """S3: what comes back from raw products, stores and inventory files, and the quarantine.

    Broken by key: products 0 a price that is no number, 1 an id that is none; stores 0 a date
    that is none, 1 a missing field; inventory 0 a stock that is no number.
    """
    spark = model.sales.sparkSession

    def dollars(c: str) -> Column:
        return F.concat(F.lit("$"), F.col(c).cast("string"), F.lit(" "))

    names = ("product_id", "product_name", "product_category")
    where = ("store_id", "store_name", "store_city", "store_location")
    products = model.products.select(_broken(F.col("product_id"), {
        0: _line(*names, dollars("product_cost"), F.lit("free")),
        1: _line(F.lit("x"), *names[1:], dollars("product_cost"), dollars("product_price"))},
        _line(*names, dollars("product_cost"), dollars("product_price"))).alias("value"))
    stores = model.stores.select(_broken(F.col("store_id"), {
        0: _line(*where, F.lit("soon")), 1: _line(*where)},
        _line(*where, "store_open_date")).alias("value"))
    inventory = model.inventory.select(_broken(F.col("store_id") * 31 + F.col("product_id"), {
        0: _line("store_id", "product_id", F.lit("abc"))},
        _line("store_id", "product_id", "stock_on_hand")).alias("value"))
    raw = {}
    for name, lines, schema, read in (("products", products, PRODUCTS_RAW, delimited.read_products),
                                      ("stores", stores, STORES_RAW, delimited.read_stores),
                                      ("inventory", inventory, INVENTORY_RAW, delimited.read_inventory)):
        path = _folder(model, f"raw-{name}")
        write_lines(lines, _header(schema), path)
        raw[name] = read(spark, f"{path}/part=*")
    raw["sales"] = spark.createDataFrame([], SALES_RAW)
    clean, quarantine = clean_raw_tables(raw)
    sums = {"products": F.col("product_price"), "inventory": F.col("stock_on_hand"),
            "stores": F.datediff("store_open_date", F.lit("1970-01-01").cast("date"))}
    out = None
    for name, value in sums.items():
        for kind, df, total in (("clean", clean[name], F.sum(value)), ("quarantined", quarantine[name], F.lit(None))):
            part = df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"), total.cast(MONEY).alias("total")).select(
                F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), "n_rows", "total")
            out = part if out is None else out.unionByName(part)
    return out


def clean_round_trip(model: RetailModel) -> DataFrame:
    """S6: the cleaned tables with their rollup are written, the sales of every third month with
    wrong units; these months are rewritten; and per month the lines and units read back at
    line grain and at daily grain."""
    spark = model.sales.sparkSession
    path = _folder(model, "clean")
    third = F.month("sales_date") % 3 == 0
    spoiled = model.sales.withColumn("unit", F.when(third, F.col("unit") + 1).otherwise(F.col("unit")))
    first = RetailModel(spoiled, model.products, model.stores, model.inventory)
    write_clean(first.tables(), path, daily=first.daily())
    write_months(model.sales.filter(third), path, daily=True)
    lines = read_clean(spark, path)["sales"].groupBy(F.col(PARTITION_COLUMN).alias("month")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_lines"), F.sum("unit").cast("bigint").alias("units"))
    daily = read_daily(spark, path).groupBy(F.col(PARTITION_COLUMN).alias("daily_month")).agg(
        F.sum("lines").cast("bigint").alias("n_daily_lines"), F.sum("unit").cast("bigint").alias("daily_units"))
    return lines.join(daily, lines["month"].eqNullSafe(daily["daily_month"]), "full").drop("daily_month")


def bucketed_round_trip(model: RetailModel) -> DataFrame:
    """S6, the bucketed layout: sales and products are written in the same buckets, and the revenue
    of each product is taken from there, no dimension being small enough to broadcast."""
    path = _folder(model, "bucketed")
    model.write_bucketed(path)
    stored = RetailModel.from_bucketed(model.sales.sparkSession, path)
    stored.broadcast_max_rows = 0
    return revenue_by(stored.view(of="products"), "product_name", "revenue")


#: Into so many appends the sales are cut (by product, so that the lines of a sale part).
APPENDS = 3


def appended_key_audit(model: RetailModel) -> DataFrame:
    """A8 kept up by appends: the sales come in three batches, each checked against the stored keys."""
    path, out = _folder(model, "sale-keys"), None
    for batch in range(APPENDS):
        rows = model.sales.filter(F.pmod(F.coalesce("product_id", F.lit(0)), F.lit(APPENDS)) == batch)
        out = audit_append(rows, "sale_id", path, batch, check="sales")
    return out
