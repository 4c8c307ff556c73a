"""The month cube that the stream keeps, and streamed parts folded into one."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tillroll.model import RetailModel
from tillroll.plans.registry import QUESTIONS
from tillroll.sources import folding, sinks
from tillroll.sources import testdata as td
from tillroll.streaming.ingest import write_batch

MONTHLY = ("q2", "q19", "q20", "q20_every_year", "q24", "q37")
OTHERS = ("q1", "q14", "q21", "q27", "q41")


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def line(spark):
    return RetailModel.from_tables(spark, td.testdata_tables(spark, SF_ORACLE))


@pytest.fixture(scope="module")
def wanted(line):
    return {key: rows(QUESTIONS[key](line)) for key in MONTHLY + OTHERS}


def stream(line, n, of, quarantined=False):
    """Micro-batch ``n`` of ``of``: rows of every month, so all but the first are late."""
    part = line.sales.filter(F.pmod(F.xxhash64("sale_id", "product_id", "store_id"), F.lit(of + 3)) == n)
    ids = {c: F.col(c).cast("int") for c in ("sale_id", "store_id", "product_id", "unit")}
    return part.withColumns(ids).withColumn("is_quarantined", F.lit(quarantined))


@pytest.fixture
def ingested(spark, line, tmp_path):
    """Three eighths of the sales written as a batch, five micro-batches of two ingests."""
    out = str(tmp_path / "retail")
    batch = line.sales.filter(F.pmod(F.xxhash64("sale_id", "product_id", "store_id"), F.lit(8)) >= 5)
    RetailModel(batch, line.products, line.stores, line.inventory).write(out, daily=True)
    for n in range(5):
        write_batch(stream(line, n, 5), n // 2 if n < 4 else 0, out, "ab"[n % 2] if n < 4 else "c", True)
    return out


def check(spark, out, wanted, keys=MONTHLY + OTHERS):
    daily = RetailModel.from_parquet(spark, out, grain="daily")
    for key in keys:
        assert rows(QUESTIONS[key](daily)) == wanted[key], key
    return daily


def test_month_questions_from_the_cube_after_batch_and_late_rows(spark, line, wanted, ingested):
    daily = check(spark, ingested, wanted)
    for key in MONTHLY:
        files = QUESTIONS[key](daily).inputFiles()
        assert any("monthly" in f for f in files), key
        assert not any(f"/{t}/" in f for f in files for t in ("sales", "sales_daily", "sales_stream", "sales_stream_daily")), key
    # a micro-batch written again changes nothing; one without its part of the cube is read for it
    write_batch(stream(line, 2, 5), 1, ingested, "a", True)
    sinks.remove(spark, f"{ingested}/{sinks.STREAM_MONTHLY}/ingest=b/batch=0")
    check(spark, ingested, wanted, MONTHLY)
    # months rewritten with and without rollups
    batch = line.sales.filter(F.pmod(F.xxhash64("sale_id", "product_id", "store_id"), F.lit(8)) >= 5)
    sinks.write_months(batch.filter(F.month("sales_date") == 3), ingested, daily=True)
    sinks.write_months(batch.filter(F.month("sales_date") == 5), ingested)
    check(spark, ingested, wanted, MONTHLY)


def parts(out, name="sales_stream"):
    return sorted(f"{i}/{b}" for i in os.listdir(f"{out}/{name}") if i.startswith("ingest=")
                  for b in os.listdir(f"{out}/{name}/{i}") if b.startswith("batch="))


def test_fold(spark, line, wanted, ingested):
    lines = line.sales.count()
    assert folding.fold_stream(spark, ingested) == 2  # the newest of a, b and c stay
    assert parts(ingested) == ["ingest=a/batch=1", "ingest=b/batch=1", "ingest=c/batch=0", "ingest=folded/batch=0"]
    assert parts(ingested, sinks.STREAM_MONTHLY) == parts(ingested)
    check(spark, ingested, wanted)
    assert folding.fold_stream(spark, ingested) == 0
    # the stream goes on; a folded micro-batch that comes again does not count twice
    write_batch(stream(line, 0, 5), 0, ingested, "a", True)
    empty = stream(line, 0, 5).limit(0)
    write_batch(empty, 2, ingested, "a", True)
    assert sinks.read_clean(spark, ingested)["sales"].count() == lines
    assert folding.fold_stream(spark, ingested) == 1
    assert "ingest=a/batch=0" not in parts(ingested)
    check(spark, ingested, wanted, ("q2", "q41"))
    assert sinks.read_clean(spark, ingested)["sales"].count() == lines


@pytest.mark.parametrize("step", ["announce", "_clear"])
def test_a_fold_that_fails_between_its_steps(spark, line, wanted, ingested, monkeypatch, step):
    lines = line.sales.count()
    calls = []

    def fail(*args):
        calls.append(args)
        if step == "announce" or len(calls) == 2:  # the second time, after the announcement
            raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(folding, step, fail)
        with pytest.raises(RuntimeError):
            folding.fold_stream(spark, ingested)
    assert "ingest=a/batch=0" in parts(ingested) and "ingest=folded/batch=0" in parts(ingested)
    check(spark, ingested, wanted, ("q2", "q21"))
    assert sinks.read_clean(spark, ingested)["sales"].count() == lines
    folding.fold_stream(spark, ingested)
    assert "ingest=a/batch=0" not in parts(ingested)
    check(spark, ingested, wanted, ("q2", "q21"))
    assert sinks.read_clean(spark, ingested)["sales"].count() == lines


def test_nothing_to_fold(spark, line, tmp_path):
    line.write(str(tmp_path))
    assert folding.fold_stream(spark, str(tmp_path)) == 0
    assert not os.path.exists(f"{tmp_path}/{folding.FOLDS}")
