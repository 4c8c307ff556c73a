"""The first and last date of a stored sales table, from its metadata.

Two kinds of layout know their dates without a scan:

* by month: the names of the ``sales_month=yyyy-MM`` folders;
* flat files: the minimum and maximum in the Parquet footers. Spark pushes the two aggregates
  into its scan, so tasks read footers, never a row.

Both only propose months. ``latest_in`` then reads the rows from the latest proposed month on
and steps back while none is found, so its answer holds whatever the metadata says: files
without statistics, or in which columns stand in another order, cost time and no row.
"""

from __future__ import annotations

import datetime as dt
import re
import weakref
from collections.abc import Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.schemas import PARTITION_COLUMN

_MONTH = re.compile(rf"{PARTITION_COLUMN}=(\d{{4}})-(\d{{2}})$")
_SESSIONS: "weakref.WeakKeyDictionary[SparkSession, SparkSession]" = weakref.WeakKeyDictionary()
MICROS_A_DAY = 86_400_000_000


def month_of(day: dt.date) -> dt.date:
    return day.replace(day=1)


def month_before(month: dt.date) -> dt.date:
    return month_of(month - dt.timedelta(days=1))


@dataclass(frozen=True)
class FlatDates:
    """A date column of flat Parquet files: of type date, or micros since 1970 (a timestamp
    without time zone, ``micros``)."""

    path: str
    column: str
    micros: bool = False
    further: tuple[str, ...] = ()  # more folders of the same table

    def bounds(self, spark: SparkSession) -> tuple[dt.date, dt.date] | None:
        """First and last date; None for a table without a date or without statistics."""
        session = _footers(spark)
        # statistics are found by a column's place in the file, so all columns are declared
        schema = T.StructType([
            T.StructField(f.name, T.LongType()) if self.micros and f.name == self.column else f
            for f in session.read.parquet(self.path, *self.further).schema.fields])
        rows = session.read.schema(schema).parquet(self.path, *self.further)
        try:
            low, high = rows.agg(F.min(self.column).alias("low"), F.max(self.column).alias("high")).first()
        except (PySparkException, Py4JJavaError):  # a file without statistics
            return None
        if low is None or high is None:
            return None
        if self.micros:
            epoch = dt.date(1970, 1, 1)
            return (epoch + dt.timedelta(days=low // MICROS_A_DAY), epoch + dt.timedelta(days=high // MICROS_A_DAY))
        return low, high

    def months(self, spark: SparkSession) -> Iterator[dt.date]:
        """Months that may hold rows, the latest first."""
        found = self.bounds(spark)
        if found is not None:
            month = month_of(found[1])
            while month >= month_of(found[0]):
                yield month
                month = month_before(month)


@dataclass(frozen=True)
class MonthFolders:
    """Folders that hold ``sales_month=yyyy-MM`` folders, at ``depth`` levels below each root."""

    roots: tuple[tuple[str, int], ...]

    def months(self, spark: SparkSession) -> Iterator[dt.date]:
        """Months that have a folder, the latest first."""
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        found = set()
        for root, depth in self.roots:
            path = jvm.org.apache.hadoop.fs.Path(root + "/*" * depth + f"/{PARTITION_COLUMN}=*")
            for status in path.getFileSystem(conf).globStatus(path) or ():
                m = _MONTH.search(status.getPath().getName())
                if m:
                    found.add(dt.date(int(m[1]), int(m[2]), 1))
        return iter(sorted(found, reverse=True))


def _footers(spark: SparkSession) -> SparkSession:
    """A session of its own in which minimum and maximum are pushed into Parquet scans."""
    session = _SESSIONS.get(spark)
    if session is None or session.sparkContext is not spark.sparkContext:
        session = _SESSIONS[spark] = spark.newSession()
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def between(df: DataFrame, start: dt.date | None, end: dt.date | None, date_col: str = "sales_date") -> DataFrame:
    """Rows dated from the month ``start`` on and before the month ``end`` (None: no bound); on
    the layout by month only these folders are read."""
    for month, later in ((start, True), (end, False)):
        if month is not None:
            bound = F.lit(month)
            df = df.filter(F.col(date_col) >= bound if later else F.col(date_col) < bound)
            if PARTITION_COLUMN in df.columns:
                name = F.lit(f"{month:%Y-%m}")
                df = df.filter(F.col(PARTITION_COLUMN) >= name if later else F.col(PARTITION_COLUMN) < name)
    return df


def latest_in(df: DataFrame, months: Iterator[dt.date], date_col: str = "sales_date") -> dt.date | None:
    """The latest date of ``df``: looked for in the rows from the first of ``months`` (the
    latest first) on, then between it and the next one, and so on; last in all rows before."""
    end = None
    for month in months:
        found = between(df, month, end, date_col).agg(F.max(date_col).alias("latest")).first()["latest"]
        if found is not None:
            return found
        end = month
    return between(df, None, end, date_col).agg(F.max(date_col).alias("latest")).first()["latest"]
