"""Physical-plan properties that matter at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from barsmith.operators import views as vw
from barsmith.plans import job
from barsmith.sources import sinks
from conftest import make_bars, random_walk


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_windows_share_one_partitioning(spark):
    bars = make_bars(spark, random_walk(50))
    p = _plan(job.features(bars, run_date="r", processed_at="p", chunk_rows=100_000))
    # All indicator windows of a chunked series run over (ticker, chunk) ...
    assert "Window [avg(adj_close" in p
    windows = [ln for ln in p.splitlines() if "Window [" in ln and "_chunk" in ln]
    assert windows and all("ticker" in ln for ln in windows)
    # ... and no window is partitioned by ticker alone over the whole series.
    for ln in p.splitlines():
        if "Window [" in ln and "avg(adj_close" in ln:
            assert "_chunk" in ln


def test_view_scans_are_pruned_and_pushed(spark, tmp_dir):
    feats = job.features(make_bars(spark, random_walk(400)), run_date="r", processed_at="p")
    sinks.write_parquet(feats, f"{tmp_dir}/f")
    stored = sinks.read_parquet(spark, f"{tmp_dir}/f")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = _plan(vw.rsi_signals(stored, dt.date(2024, 2, 5)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln][0]
    assert "GreaterThanOrEqual(date,2023-11-07)" in scan.split("PushedFilters: ")[1]
    assert "PartitionFilters: [isnotnull(year" in scan and "(year#" in scan
    read_schema = scan.split("ReadSchema: ")[1]
    assert "sma_200" not in read_schema and "macd_hist" in read_schema


def test_latest_snapshot_limits_before_shuffle(spark):
    feats = job.features_plain(make_bars(spark, random_walk(30)), run_date="r", processed_at="p")
    p = vw.latest_snapshot(feats)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p


def test_audit_distinct_count_is_two_phase(spark):
    feats = job.features_plain(make_bars(spark, random_walk(30)), run_date="r", processed_at="p")
    p = _plan(vw.pipeline_audit(feats))
    assert "partial_count(distinct ticker" in p or "partial_count(distinct" in p


def test_copies_collapse_before_the_shuffle(spark):
    """A bar copied thousands of times: partial max(struct) runs map-side, the
    latest copy wins, and the series is intact."""
    from barsmith.plans.series import collapse_copies

    bars = make_bars(spark, [1.0, 2.0, 3.0])
    storm = spark.range(5000).select(
        F.lit(dt.date(2023, 1, 3)).alias("date"), F.lit("TEST").alias("ticker"),
        *[F.lit(9.0).alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1).cast("long").alias("volume"),
        *[F.lit(9.0).alias(c) for c in ("adj_open", "adj_high", "adj_low", "adj_close")],
        F.lit(1).cast("long").alias("adj_volume"),
        F.format_string("2024-01-01T00:%02d:00", (F.col("id") % 60).cast("int")).alias("ingested_at"),
    )
    both = bars.unionByName(storm.drop("id").withColumn("adj_close", F.lit(7.0)))
    out = job.features(both, run_date="r", processed_at="p")
    rows = out.orderBy("date").select("date", "adj_close", "ingested_at").collect()
    assert len(rows) == 3
    assert (rows[1]["adj_close"], rows[1]["ingested_at"]) == (7.0, "2024-01-01T00:59:00")
    p = _plan(collapse_copies(both, "ticker", "date", ["ingested_at"]))
    partial = p.index("partial_max")
    # The plan prints top-down: the exchange sits above the partial aggregate.
    assert p.index("Exchange hashpartitioning(ticker") < partial


def test_hot_instrument_is_split_over_chunks(spark):
    """One instrument with a third of the rows: the chunked plan spreads it over
    several (ticker, chunk) window groups and equals the per-ticker window."""
    from barsmith.sources.fixtures import read_table, skewed_ticks, tick_day_bucket
    from conftest import SMALL

    ticks = skewed_ticks(read_table(spark, SMALL, "lineitem"))
    n_hot = ticks.filter(F.col("ticker") == "HOT").count()
    assert n_hot > ticks.count() / 4
    chunked = job.features(ticks, run_date="r", processed_at="p", order="seq",
                           bucket=tick_day_bucket(), chunk_rows=300, dedupe=False)
    plain = job.features_plain(ticks, run_date="r", processed_at="p", order="seq")
    assert chunked.exceptAll(plain).count() == 0 and plain.exceptAll(chunked).count() == 0
    from barsmith.plans.series import chunk_table
    t = chunk_table(ticks, "ticker", "seq", tick_day_bucket(), distinct=False,
                    chunk_rows=300, lookback=251)
    chunks = t.filter(F.col("ticker") == "HOT").select("_home_chunk").distinct().count()
    assert chunks >= n_hot // (300 + 50)      # ~chunk_rows rows (plus a day) per chunk
    # No window group exceeds chunk_rows + one bucket + the halo.
    from barsmith.plans.series import bucket_chunked
    day = ticks.groupBy("ticker", tick_day_bucket().alias("d")).count().agg(F.max("count"))
    biggest_day = day.first()[0]
    groups = bucket_chunked(ticks, "ticker", "seq", bucket=tick_day_bucket(), lookback=251,
                            chunk_rows=300).groupBy("ticker", "_chunk").count()
    assert groups.agg(F.max("count")).first()[0] <= 300 + biggest_day + 251 + biggest_day


def test_small_chunks_merge_and_halo_feeds_one_chunk(spark):
    """Month buckets (~30 rows) with 260-row chunks leave raw chunks shorter than the
    251-row lookback; they merge into the chunk before, every later chunk keeps at
    least 251 rows, and results equal the per-ticker window."""
    from barsmith.plans.series import chunk_table
    from conftest import random_walk

    bars = make_bars(spark, random_walk(1300, seed=5)).unionByName(
        make_bars(spark, random_walk(700, seed=6), ticker="B"))
    month = F.year("date") * 100 + F.month("date")
    t = chunk_table(bars, "ticker", "date", month, distinct=False, chunk_rows=260,
                    lookback=251)
    sizes = t.groupBy("ticker", "_home_chunk").agg(
        F.min("_home_start").alias("start"), F.count(F.lit(1)).alias("buckets"))
    rows = {(r["ticker"], r["_home_chunk"]): r["start"] for r in sizes.collect()}
    for tk in ("TEST", "B"):
        starts = sorted(v for (k, _), v in rows.items() if k == tk)
        total = 1300 if tk == "TEST" else 700
        lengths = [b - a for a, b in zip(starts, starts[1:] + [total])]
        assert all(n >= 251 for n in lengths[:-1]) and len(starts) > 1
    merged = job.features(bars, run_date="r", processed_at="p", chunk_rows=260,
                          bucket=month, dedupe=False)
    plain = job.features_plain(bars, run_date="r", processed_at="p")
    assert merged.exceptAll(plain).count() == 0 and plain.exceptAll(merged).count() == 0


@pytest.mark.parametrize("kind", ["timestamp", "text", "sequence", "nanoseconds", "bursts"])
def test_groups_are_bounded_for_any_order(spark, kind):
    """One key with 50,000 rows: no window group exceeds twice the chunk plus the lookback,
    and the chunk table stays small."""
    from barsmith.plans.series import BUCKET, bucket_chunked, chunk_table, range_buckets

    i = F.col("id")
    order = {"timestamp": F.timestamp_millis(i * 100),          # one busy day
             "text": F.date_format(F.timestamp_millis(i * 1000), "yyyy-MM-dd'T'HH:mm:ss"),
             "sequence": i, "nanoseconds": i * 1_000_000_000,
             "bursts": F.when(i < 40_000, i).otherwise(i * 1_000_003)}[kind]
    df = spark.range(50_000).select(F.lit("HOT").alias("k"), order.alias("o"))
    groups = bucket_chunked(df, "k", "o", lookback=251, chunk_rows=1000).groupBy("k", "_chunk").agg(
        F.count("o").alias("n"), F.count_if(~F.col("_halo")).alias("own"))
    n, biggest, own = groups.agg(F.count("n"), F.max("n"), F.sum("own")).first()
    assert biggest <= 2 * 1000 + 251 and n >= 40 and own == 50_000
    counted = range_buckets(df, "k", "o", 125)
    table = chunk_table(counted, "k", "o", F.col(BUCKET), distinct=False, chunk_rows=1000, lookback=251)
    assert table.count() <= 20 * n


def test_range_buckets_equal_the_plain_window(spark):
    """Unevenly spread sequence numbers, two keys, copies, and no bucket from the caller."""
    bars = make_bars(spark, random_walk(900, seed=2)).unionByName(make_bars(spark, random_walk(90, seed=3), ticker="B"))
    seq = bars.withColumn("seq", F.pow(F.datediff("date", F.lit("2023-01-01")), F.lit(3)).cast("long")).drop("date")
    copies = seq.unionByName(seq.filter("seq % 2 = 0").withColumn("ingested_at", F.lit("2000-01-01")))
    got = job.features(copies, run_date="r", processed_at="p", order="seq", chunk_rows=300)
    want = job.features_plain(seq, run_date="r", processed_at="p", order="seq")
    assert got.count() == 990
    for c in ("sma_200", "obv", "rsi", "vol_60d", "pct_from_52w_high"):
        a, b = (d.select("ticker", "seq", F.round(c, 6).alias(c)) for d in (got, want))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, c


def test_daily_bars_run_with_one_exchange(spark):
    """A series ordered by DATE needs no chunk table: the plan moves the rows exactly once."""
    from barsmith.sources.fixtures import lineitem_bars
    from conftest import SMALL

    df = job.features(lineitem_bars(spark, SMALL), run_date="r", processed_at="p",
                      dedupe=False)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    by_ticker = [ln for ln in final.splitlines() if re.search(r"Exchange hashpartitioning\(ticker#\d+, \d+\)", ln)]
    assert len(by_ticker) == 1, final
    assert "Join" not in final and "_chunk" not in final, final


def test_registered_scale_paths_have_several_chunks(spark):
    from barsmith import catalog
    from barsmith.plans.series import bucket_chunked
    from conftest import SMALL

    bars = catalog.stored_bars(spark, SMALL)
    cut = bucket_chunked(bars, "ticker", "date", lookback=251, **catalog.split_bars(spark, SMALL))
    chunks = cut.groupBy("ticker").agg(F.count_distinct("_chunk").alias("n"))
    # (A last piece shorter than the lookback joins the one before it.)
    split, every = chunks.agg(F.count_if(F.col("n") > 1), F.count("n")).first()
    assert split > every / 2
