import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("cadence-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cadence-check-"))
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="cadence-test-")


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


def as_set(df):
    """Rows as a sorted list of tuples, independent of column order."""
    cols = sorted(df.columns)
    return sorted((tuple(str(v) for v in r) for r in df.select(*cols).collect()))
