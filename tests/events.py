"""What Spark did during a call, from the session's event log."""

import glob
import json
from contextlib import contextmanager
from types import SimpleNamespace


def _position(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    folder = spark.conf.get("spark.eventLog.dir").removeprefix("file://")
    (path,) = glob.glob(f"{folder}/{spark.sparkContext.applicationId}*")
    with open(path) as f:
        f.seek(0, 2)
        return path, f.tell()


@contextmanager
def watched(spark):
    """Jobs, rows read from files, rows that shuffles wrote, largest rows of one task."""
    path, start = _position(spark)
    seen = SimpleNamespace(jobs=0, records_read=0, shuffle_records=0, longest_read=0)
    yield seen
    _position(spark)
    with open(path) as f:
        f.seek(start)
        for line in f:
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                seen.jobs += 1
            elif event["Event"] == "SparkListenerTaskEnd":
                metrics = event.get("Task Metrics") or {}
                seen.records_read += metrics.get("Input Metrics", {}).get("Records Read", 0)
                seen.shuffle_records += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
                seen.longest_read = max(seen.longest_read, metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
