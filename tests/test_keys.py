"""Key constraints kept up by appends equal the full audit; stored keys are not shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_bucketed import above_scan, final_plan
from tests.test_large_path import NO_BROADCAST
from tillroll.operators.quality import duplicate_keys, key_violations
from tillroll.sources import keys as K

SCHEMA = "id bigint, x string"


def made(spark, numbers):
    return spark.createDataFrame([(n, "x") for n in numbers], SCHEMA)


def same(spark, path, numbers):
    whole = made(spark, numbers)
    assert K.summary(spark, path).first() == key_violations(whole, "id").first()
    want = sorted(tuple(r) for r in duplicate_keys(whole.filter("id is not null"), "id").collect())
    assert sorted(tuple(r) for r in K.duplicates(spark, path).collect()) == want


def test_appends_equal_the_full_audit(spark, tmp_path):
    rng, path, so_far = random.Random(5), str(tmp_path), []
    batches = [[1, 2, 2, None], [], [2, 3, 1, 1, None, None], list(range(100, 140)) + [7] * 50,
               [rng.choice([None, *range(95, 110), -3, 7]) for _ in range(60)]]
    for n, batch in enumerate(batches):
        so_far += batch
        got = K.audit_append(made(spark, batch), "id", path, n, buckets=4)
        assert got.first() == key_violations(made(spark, so_far), "id").first(), n
    same(spark, path, so_far)
    # counted already: nothing changes
    K.audit_append(made(spark, batches[0]), "id", path, 0)
    same(spark, path, so_far)


def test_append_that_failed_is_done_anew(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    K.audit_append(made(spark, [1, 2, 3]), "id", path, 0, buckets=2)
    real = K.read_table
    monkeypatch.setattr(K, "read_table", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):  # its keys are written, its counts are not
        K.audit_append(made(spark, [3, 4, 4]), "id", path, 1)
    monkeypatch.setattr(K, "read_table", real)
    K.audit_append(made(spark, [3, 4, 4]), "id", path, 1)
    same(spark, path, [1, 2, 3, 3, 4, 4])


def test_stored_keys_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path)
    for n in range(3):
        K.audit_append(made(spark, range(n * 50, n * 50 + 80)), "id", path, n, buckets=4)
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    try:
        for k, v in NO_BROADCAST.items():
            spark.conf.set(k, v)
        layout = spark.read.parquet(f"{path}/layout").first()
        stored = K.read_table(spark, f"{path}/keys", layout["keys"], "key", layout["buckets"])
        new = K.read_table(spark, f"{path}/keys/batch=2", layout["keys"], "key", layout["buckets"])
        for df in (K.duplicates(spark, path), new.join(stored.groupBy("key").agg(F.sum("n").alias("all")), "key", "left")):
            above = above_scan(final_plan(df), "keys]")
            until = next((i for i, line in enumerate(above) if "Join" in line), len(above))
            assert not any("Exchange" in line for line in above[:until]), above
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
