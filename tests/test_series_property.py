"""Property: the chunked plan equals the per-ticker window for any series lengths,
bucket functions and chunk sizes (few examples: each one runs Spark jobs)."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barsmith.operators import features as feat
from barsmith.plans import job
from barsmith.plans.series import Series
from conftest import make_bars, random_walk

BUCKETS = {
    "week": lambda: F.floor(F.datediff(F.col("date"), F.lit("2020-01-06")) / 7),
    "month": lambda: F.year("date") * 100 + F.month("date"),
    "year": lambda: F.year("date"),
}


@settings(max_examples=4, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    lengths=st.lists(st.integers(min_value=1, max_value=900), min_size=1, max_size=3),
    bucket=st.sampled_from(sorted(BUCKETS)),
    extra=st.integers(min_value=0, max_value=300),
)
def test_chunked_equals_plain(spark, lengths, bucket, extra):
    bars = None
    for i, n in enumerate(lengths):
        b = make_bars(spark, random_walk(n, seed=100 + i), ticker=f"K{i}")
        bars = b if bars is None else bars.unionByName(b)
    chunk = feat.LOOKBACK["range_52w"] + extra
    cols = ["ticker", "date", "obv", "pct_from_52w_high", "pct_from_52w_low"]
    for name in ("obv", "range_52w"):
        got = job.apply_operator(bars, name, chunk_rows=chunk, dedupe=False,
                                 bucket=BUCKETS[bucket]())
        fn, _ = job.OPERATORS[name]
        want = fn(bars, Series.plain())
        keep = [c for c in cols if c in got.columns]
        a, b = got.select(*keep), want.select(*keep)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, (name, bucket)
