"""Bounds of broadcasts and one-task windows, changed dimension files, Q41's plan."""

import shutil
from pathlib import Path

import pyarrow.parquet as pq

from tests.conftest import SF_SMALL
from tillroll.model import RetailModel
from tillroll.plans.registry import model_for, queries
from tillroll.sources import testdata as td


def test_wide_rows_are_not_broadcast(spark):
    tables = td.testdata_tables(spark, SF_SMALL)
    model = RetailModel.from_tables(spark, tables)
    assert model.is_small("products") and model.bounded_by("products")
    rows, size = model._size("products")
    wide = RetailModel.from_tables(spark, tables)
    wide.broadcast_max_bytes = size - 1
    assert not wide.is_small("products")
    few = RetailModel.from_tables(spark, tables)
    few.window_max_rows = rows - 1
    assert few.is_small("products") and not few.bounded_by("products")


def test_changed_dimension_file_is_seen(spark, tmp_path):
    for table in Path(SF_SMALL).glob("*.parquet"):
        shutil.copyfile(table, tmp_path / table.name)  # not the mode: the test data are read-only
    before = model_for(spark, tmp_path)
    assert model_for(spark, tmp_path) is before
    n = before.dim("products").count()
    part = pq.read_table(tmp_path / "part.parquet")
    pq.write_table(part.slice(1), tmp_path / "part.parquet")
    after = model_for(spark, tmp_path)
    assert after is not before and after.dim("products").count() == n - 1


def test_city_expansion_does_not_expand_rows(spark):
    df = queries()["q41"](spark, SF_SMALL)
    df.collect()
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
