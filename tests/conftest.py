import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tillroll.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # tests/events.py reads the log
    log = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + tempfile.mkdtemp(prefix="tillroll-events-"),
           "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
           "spark.sql.maxMetadataStringLength": "2000"}  # plans name whole paths, however long the temp folder
    session = build_session("local[*]", 8, "tillroll-tests", log)
    yield session
    session.stop()
