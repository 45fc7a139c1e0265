import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("barsmith-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ck-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="barsmith-test-", dir="/tmp")


def make_bars(spark, closes, ticker="TEST", start=dt.date(2023, 1, 2), volumes=None,
              highs=None, lows=None, ingested_at="2024-01-01T00:00:00"):
    """Bars for one ticker on consecutive days from a list of closes."""
    rows = []
    for i, c in enumerate(closes):
        v = volumes[i] if volumes is not None else 1000 + i
        h = highs[i] if highs is not None else (None if c is None else c * 1.01)
        lo = lows[i] if lows is not None else (None if c is None else c * 0.99)
        rows.append((start + dt.timedelta(days=i), ticker, c, h, lo, c, v, c, h, lo, c, v,
                     ingested_at))
    schema = ("date date, ticker string, open double, high double, low double, close double, "
              "volume long, adj_open double, adj_high double, adj_low double, adj_close double, "
              "adj_volume long, ingested_at string")
    return spark.createDataFrame(rows, schema)


def random_walk(n, seed=42, start=100.0, scale=2.0):
    import numpy as np

    rng = np.random.default_rng(seed)
    return list(map(float, start + np.cumsum(rng.standard_normal(n) * scale)))
