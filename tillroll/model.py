"""The retail star schema: sales fact, products / stores dimensions, inventory snapshot."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.bucketed import DealtSales
from tillroll.sources.latest import FlatDates, MonthFolders
from tillroll.sources.schemas import PARTITION_COLUMN

# A dimension is broadcast only when its counted rows and bytes are within these bounds.
# Larger dimensions take a shuffle join, which AQE may still demote to a broadcast at
# runtime from real sizes.
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_CONF = "tillroll.broadcast.maxRows"
DEFAULT_BROADCAST_MAX_BYTES = 128 * 1024 * 1024
BROADCAST_BYTES_CONF = "tillroll.broadcast.maxBytes"
# A window in one task is used only over at most this many rows, one per dimension member.
DEFAULT_WINDOW_MAX_ROWS = 50_000
WINDOW_CONF = "tillroll.windows.maxRows"
# Whether questions that need sums only add up the fact before a shuffle join with a large dimension.
PRE_AGGREGATE_CONF = "tillroll.star.preAggregate"
FIXED_BYTES = 16  # counted for a value of a type of fixed size, and on top of each text

VIEW_COLUMNS = [
    "sale_id", "store_id", "product_id", "unit", "sales_date",
    "store_name", "store_city", "store_location", "store_open_date",
    "product_name", "product_category", "product_cost", "product_price",
]


@dataclass
class RetailModel:
    sales: DataFrame
    products: DataFrame
    stores: DataFrame
    inventory: DataFrame
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS
    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES
    window_max_rows: int = DEFAULT_WINDOW_MAX_ROWS
    quarantine: dict | None = field(default=None, repr=False)  # rejected raw rows (CSV path)
    grain: str = "line"  # "line": one row per sale line; "daily": the (store, product, day) rollup
    daily_table: DataFrame | None = field(default=None, repr=False)  # a written rollup, if any
    monthly_table: DataFrame | None = field(default=None, repr=False)  # a written month cube, if any
    sets: DataFrame | None = field(default=None, repr=False)  # written sets of sale ids and units, if any
    dates: FlatDates | MonthFolders | None = None  # where the stored sales' dates are known from
    dealt: DealtSales | None = field(default=None, repr=False)  # sales bucketed like the products
    pre_aggregate: bool = True  # sum the fact before it is shuffled to a large dimension
    _small: dict = field(default_factory=dict, repr=False)
    _view: DataFrame | None = field(default=None, repr=False)
    _line_view: DataFrame | None = field(default=None, repr=False)

    # ---- construction -------------------------------------------------------------
    @classmethod
    def from_tables(cls, spark: SparkSession, tables: dict[str, DataFrame]) -> "RetailModel":
        def limit(conf: str, default: int) -> int:
            return int(spark.conf.get(conf, str(default)))

        return cls(tables["sales"], tables["products"], tables["stores"], tables["inventory"],
                   broadcast_max_rows=limit(BROADCAST_CONF, DEFAULT_BROADCAST_MAX_ROWS),
                   broadcast_max_bytes=limit(BROADCAST_BYTES_CONF, DEFAULT_BROADCAST_MAX_BYTES),
                   window_max_rows=limit(WINDOW_CONF, DEFAULT_WINDOW_MAX_ROWS),
                   pre_aggregate=spark.conf.get(PRE_AGGREGATE_CONF, "true").lower() == "true")

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "RetailModel":
        from tillroll.sources.testdata import testdata_dates, testdata_tables
        model = cls.from_tables(spark, testdata_tables(spark, sf_dir))
        model.dates = testdata_dates(sf_dir)
        return model

    @classmethod
    def from_csv(cls, spark: SparkSession, sales: str, products: str, stores: str, inventory: str,
                 city_aliases: dict[str, str] | None = None) -> "RetailModel":
        from tillroll.operators.cleaning import clean_raw_tables
        from tillroll.sources import delimited
        raw = {
            "sales": delimited.read_sales(spark, sales),
            "products": delimited.read_products(spark, products),
            "stores": delimited.read_stores(spark, stores),
            "inventory": delimited.read_inventory(spark, inventory),
        }
        clean, quarantine = clean_raw_tables(raw, city_aliases)
        model = cls.from_tables(spark, clean)
        model.quarantine = quarantine
        return model

    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str, grain: str = "line") -> "RetailModel":
        """The cleaned layout written by ``write_clean``; ``grain='daily'`` answers from the
        written daily rollup when present (else the rollup is computed on the fly)."""
        from tillroll.sources.sinks import clean_months, read_clean, read_daily, read_monthly, read_sets
        model = cls.from_tables(spark, read_clean(spark, path))
        model.grain = grain
        model.dates = clean_months(path)
        if grain == "daily":
            model.daily_table = read_daily(spark, path)
            model.monthly_table = read_monthly(spark, path)
            model.sets = read_sets(spark, path)
        return model

    @classmethod
    def from_bucketed(cls, spark: SparkSession, path: str) -> "RetailModel":
        """The layout written by ``write_bucketed``: products too large to broadcast meet the
        sales bucket by bucket, without a shuffle of either."""
        from tillroll.sources.bucketed import bucketed_dates, read_bucketed
        tables, dealt = read_bucketed(spark, path)
        model = cls.from_tables(spark, tables)
        model.dealt = dealt
        model.dates = bucketed_dates(path)
        return model

    def write_bucketed(self, path: str, buckets: int | None = None) -> int:
        """Persist the cleaned tables with sales and products bucketed by product."""
        from tillroll.sources.bucketed import write_bucketed
        return write_bucketed(self.tables(), path, buckets)

    def write(self, path: str, daily: bool = False, mode: str = "overwrite") -> None:
        """Persist the cleaned tables (sales partitioned by month) and, with ``daily``, the
        (store, product, day) rollup and the sets of sale ids and units; read back with ``from_parquet(path, grain=...)``."""
        from tillroll.sources.sinks import write_clean
        write_clean(self.tables(), path, mode, daily=self.daily() if daily else None, with_sets=daily)

    def tables(self) -> dict[str, DataFrame]:
        sales = self.sales.drop(PARTITION_COLUMN) if PARTITION_COLUMN in self.sales.columns else self.sales
        return {"sales": sales, "products": self.products, "stores": self.stores,
                "inventory": self.inventory}

    # ---- size-checked broadcast ---------------------------------------------------
    def _size(self, name: str) -> tuple[int, int]:
        """Counted (not estimated) rows and bytes of a dimension, once per model: one partial
        aggregate per task."""
        if name + ".size" not in self._small:
            df = getattr(self, name)
            width = F.lit(FIXED_BYTES * len(df.columns)).cast("long")
            for f in df.schema.fields:
                if f.dataType.typeName() in ("string", "binary"):
                    width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
            n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
            self._small[name + ".size"] = (n, size)
        return self._small[name + ".size"]

    def is_small(self, name: str) -> bool:
        """Whether a dimension may be broadcast: by its rows and by its bytes."""
        rows, size = self._size(name)
        return rows <= self.broadcast_max_rows and size <= self.broadcast_max_bytes

    def dim(self, name: str) -> DataFrame:
        """A dimension for joining: small ones are kept in memory (they are bounded by the
        counted check) and broadcast; large ones are left to a shuffle join."""
        if not self.is_small(name):
            return getattr(self, name)
        cached = self._small.get(name + ".cached")
        if cached is None:
            cached = getattr(self, name).persist(StorageLevel.MEMORY_AND_DISK)
            self._small[name + ".cached"] = cached
        return F.broadcast(cached)

    def release(self) -> None:
        """Drop the cached small dimensions (e.g. before the model goes out of use)."""
        for key in [k for k in self._small if k.endswith(".cached")]:
            self._small.pop(key).unpersist()

    def bounded_by(self, name: str) -> bool:
        """True when a result keyed by this dimension has a proven small row count (so a
        single-task window over it is safe): a bound of its own, well below the broadcast's."""
        return self._size(name)[0] <= min(self.window_max_rows, self.broadcast_max_rows)

    # ---- grain ----------------------------------------------------------------------
    def daily(self) -> DataFrame:
        """The (store, product, day) rollup: summed units and the number of sales lines.

        Every question except the line-level ones (sale ids, single-line values) gives
        the same result from it, and it is far smaller when many sales share a store,
        product and day. Written once next to the cleaned tables (``write_clean``), it is
        read instead of the line-level fact.
        """
        if self.daily_table is None:
            keys = ["store_id", "product_id", "sales_date"]
            keys += [c for c in (PARTITION_COLUMN,) if c in self.sales.columns]
            self.daily_table = self.sales.groupBy(*keys).agg(
                F.sum("unit").alias("unit"), F.count(F.lit(1)).alias("lines"))
        return self.daily_table

    def fact(self) -> DataFrame:
        """The fact table at the model's grain."""
        return self.daily() if self.grain == "daily" else self.sales

    def _monthly(self, period: str | None) -> DataFrame | None:
        """The month cube, where it holds all that a question by ``period`` needs."""
        return self.monthly_table if self.grain == "daily" and period in (None, "month") else None

    def store_sets(self, kind: str) -> DataFrame | None:
        """Written sets ('sale' ids or 'unit' values) of the sales in the star view, with their
        store's columns; None where they must be taken from the sales themselves."""
        if self.grain != "daily" or self.sets is None:
            return None
        return self.sets.filter(F.col("kind") == kind).join(self.dim("stores"), "store_id", "inner")

    def months(self) -> Iterator[dt.date] | None:
        """Months that may hold sales, the latest first, from the stored table's metadata; None
        where it has none (raw files, derived frames)."""
        return None if self.dates is None else self.dates.months(self.sales.sparkSession)

    # ---- the star view ------------------------------------------------------------
    def _summed(self, fact: DataFrame, period: str | None, *keys: str) -> DataFrame:
        """The fact summed per ``keys`` and period: ``unit`` and, with it, ``lines``."""
        start = {None: None, "day": F.col("sales_date"),
                 "month": F.trunc("sales_date", "month").alias("sales_date")}[period]
        by = [F.col(k) for k in keys] + ([] if start is None else [start])
        by += [F.col(c) for c in (PARTITION_COLUMN,) if period is not None and c in fact.columns]
        lines = F.sum("lines") if "lines" in fact.columns else F.count(F.lit(1))
        return fact.groupBy(*by).agg(F.sum("unit").alias("unit"), lines.alias("lines"))

    def _by_part(self, fact: DataFrame, joined: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """``joined(fact, products)``; where the sales are dealt like large products, of the
        bucketed part and of the part of the hot products, put together."""
        if self.dealt is None or fact is not self.sales or self.is_small("products"):
            return joined(fact, self.dim("products"))
        parts = [joined(self.dealt.cold, self.products), joined(self.dealt.hot, self.dim("hot_products"))]
        return functools.reduce(DataFrame.unionByName, parts)

    @property
    def hot_products(self) -> DataFrame:
        return self.dealt.hot_products

    def _sums_first(self, *dimensions: str) -> bool:
        return self.pre_aggregate and not all(self.is_small(name) for name in dimensions)

    def _of_stores(self, fact: DataFrame, period: str | None) -> DataFrame:
        """The sales whose store exists, summed per product and period. Small stores are met
        map-side by the sales themselves, large ones by sums per store and product."""
        if not self.is_small("stores"):
            fact = self._summed(fact, period, "store_id", "product_id")
        return self._summed(fact.join(self.dim("stores"), "store_id", "inner"), period, "product_id")

    def view(self, period: str | None = None, of: str | None = None) -> DataFrame:
        """The star view for questions that need sums and counts of sales alone.

        With small dimensions it is ``sales_view()``: the joins are map-side and the question's
        own aggregation comes right behind them. A large dimension is joined by a shuffle;
        then the fact is summed first (partly before its own shuffle) per store, product and
        ``period`` (None, 'day', or 'month', whose rows carry the month's first day), and one
        row for each of these is joined in place of its sales: ``unit`` is their total and
        ``lines`` counts them, as at daily grain. Where a month cube is written, questions by
        month or without a period read that.

        ``of="products"``: the question reads no column of the stores. Then large products are
        joined to one row per product and period. One for each store as well would leave the
        tasks behind the sums with nearly every product each, so that their groups by product,
        and the rows these send on, would be as many as the tasks times the products.
        """
        cube = self._monthly(period)
        if cube is None and not self._sums_first("stores", "products"):
            return self.sales_view()
        columns = [c for c in VIEW_COLUMNS if c != "sale_id" and (c != "sales_date" or period is not None)]
        if cube is not None and (period == "month" or not self._sums_first("stores", "products")):
            return self._star(cube, columns + ["lines"])
        fact = self.fact() if cube is None else cube
        if of == "products" and (self.dealt is None or self.is_small("stores")):
            columns = [c for c in columns if not c.startswith("store_")] + ["lines"]
            return self._by_part(fact, lambda part, products: (
                self._of_stores(part, period).join(products, "product_id", "inner").select(*columns)))
        return self._star(fact, columns + ["lines"],
                          lambda fact: self._summed(fact, period, "store_id", "product_id"))

    def _star(self, fact: DataFrame, columns: list[str],
              prepared: Callable[[DataFrame], DataFrame] = lambda fact: fact) -> DataFrame:
        def joined(part: DataFrame, products: DataFrame) -> DataFrame:
            part = prepared(part)
            extra = [c for c in (PARTITION_COLUMN,) if c in part.columns]
            dims = [(self.dim("stores"), "store_id"), (products, "product_id")]
            if self.dealt is not None:
                dims.reverse()  # products first, while the rows still lie in their buckets
            for dim, key in dims:
                part = part.join(dim, key, "inner")
            return part.select(*columns, *extra)

        return self._by_part(fact, joined)

    def line_view(self) -> DataFrame:
        """One row per sale line whose store and product both exist (two inner joins).

        On the month-partitioned layout the partition column ``sales_month`` is carried
        as a 14th column so that trailing windows can prune partitions.
        """
        if self._line_view is None:
            self._line_view = self._star(self.sales, VIEW_COLUMNS)
        return self._line_view

    def sales_view(self) -> DataFrame:
        """The star view at the model's grain. At daily grain there is no ``sale_id`` and
        ``unit`` is the day's total, with ``lines`` counting the sales lines."""
        if self.grain != "daily":
            return self.line_view()
        if self._view is None:
            cols = [c for c in VIEW_COLUMNS if c != "sale_id"] + ["lines"]
            self._view = self._star(self.daily(), cols)
        return self._view

    def sales_with_products(self, period: str | None = None) -> DataFrame:
        """fact x products only (the questions that bypass the view keep orphan stores); summed
        before the join as in ``view``."""
        first, cube = self._sums_first("products"), self._monthly(period)
        return self._by_part(self.fact() if cube is None else cube, lambda fact, products: (
            self._summed(fact, period, "product_id") if first else fact).join(products, "product_id", "inner"))

    def register(self, prefix: str = "") -> None:
        for name, df in self.tables().items():
            df.createOrReplaceTempView(prefix + name)
        self.line_view().createOrReplaceTempView(prefix + "store_sales_products")
