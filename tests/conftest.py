import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("sigfleet-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: a checkpoint folder when the session names none.
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sigfleet-ck-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def T(s):
    """NTZ datetime from ISO text."""
    return dt.datetime.fromisoformat(s)


READINGS_DDL = "pump_id string, signal string, detailed boolean, time timestamp_ntz, value double, validity int, pos long"
PUMPS_DDL = "pump_id string, name string, source_pos long"


@pytest.fixture()
def mk_readings(spark):
    def make(rows):
        full = [
            (p, s, False, T(t) if isinstance(t, str) else t, v, 0, pos)
            for (p, s, t, v, pos) in rows
        ]
        return spark.createDataFrame(full, READINGS_DDL)

    return make


@pytest.fixture()
def mk_pumps(spark):
    def make(rows):
        return spark.createDataFrame([(p, n, i) for i, (p, n) in enumerate(rows)], PUMPS_DDL)

    return make
