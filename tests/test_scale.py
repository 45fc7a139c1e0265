"""Plans whose cost must grow no faster than the rows."""

import datetime as dt
import os

import pytest
from conftest import SMALL
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from barsmith import catalog
from barsmith.operators import features as feat
from barsmith.plans import job
from barsmith.plans.rank import percent_ranks
from barsmith.plans.series import Series
from barsmith.sources import drift, ndjson, sinks


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def walk(spark):
    """Two instruments of 300 days; one has gaps, a NaN and an infinite price."""
    x = F.when(F.col("id") % 7 == 3, F.lit(None)).when(F.col("id") == 290, F.lit(float("nan"))).when(
        F.col("id") == 120, F.lit(float("inf"))).otherwise(100 + F.sin(F.col("id") * 1.7) * 30)
    days = spark.range(300).withColumn("date", F.date_add(F.lit(dt.date(2023, 1, 1)), F.col("id").cast("int")))
    both = days.withColumn("ticker", F.lit("A")).withColumn("adj_close", 50 + F.cos(F.col("id") * 0.9) * 20).unionByName(
        days.withColumn("ticker", F.lit("B")).withColumn("adj_close", x))
    return both.drop("id").localCheckpoint()


@pytest.mark.parametrize("min_periods", [False, True])
def test_pieced_frames_equal_whole_frames(spark, walk, min_periods):
    s = Series.plain(min_periods=min_periods)
    whole = walk.withColumns({f"sma_{n}_w": s.roll(F.avg, "adj_close", n) for n in (50, 200)} | {
        "hi_w": s.roll(F.max, "adj_close", feat.RANGE_SPAN), "lo_w": s.roll(F.min, "adj_close", feat.RANGE_SPAN)})
    out = feat.add_range_52w(feat.add_moving_averages(whole, s), s)
    for n in (50, 200):
        a, b = F.col(f"sma_{n}"), F.col(f"sma_{n}_w")
        bad = ~(a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= 1e-9, F.lit(False)))
        assert out.filter(bad).count() == 0
    for got, ref in (("pct_from_52w_high", "hi_w"), ("pct_from_52w_low", "lo_w")):
        assert out.filter(~F.col(got).eqNullSafe(feat.rel_change(F.col("adj_close"), F.col(ref)))).count() == 0


def test_no_frame_goes_through_hundreds_of_rows(spark):
    bars = catalog.stored_bars(spark, SMALL)
    for df in (job.features(bars, run_date="r", processed_at="p", dedupe=False), job.apply_operator(bars, "range_52w", dedupe=False)):
        text = plan(df)
        assert "-251" not in text and "-199" not in text and "-49," not in text


def test_feature_rows_are_not_shuffled_for_the_layout(spark):
    rows = job.features(catalog.stored_bars(spark, SMALL), run_date="r", processed_at="p", dedupe=False)
    text = plan(sinks._layout(rows, sinks.PARTITION_COLUMNS))
    assert "Rebalance" not in text and "Repartition" not in text


def test_staged_lines_are_compressed(spark, tmp_dir):
    bars = catalog.stored_bars(spark, SMALL)
    ndjson.stage(bars, tmp_dir, "r")
    names = [n for n in os.listdir(f"{tmp_dir}/run_date=r") if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)
    assert ndjson.to_bars(ndjson.scan(spark, tmp_dir, "r")).count() == bars.count()


def test_payloads_have_no_folder_per_instrument(spark):
    root = catalog._vendor_root(spark, SMALL).removeprefix("file:")
    assert not [n for n in os.listdir(root) if n.startswith("ticker=")]


def test_an_array_is_judged_once_and_not_repeated(spark):
    payloads = spark.createDataFrame([Row(payload='[{"close": 1.0}, 7, {"close": 2.0}]', ticker="A"), Row(payload="no json", ticker="B"),
                                      Row(payload="[]", ticker="C"), Row(payload='{"close": 3.0}', ticker="D")])
    recs = drift.records(payloads)
    assert "schema_of_variant" not in plan(recs)
    assert {(r["ticker"], r["payload"]) for r in recs.select("ticker", "payload").collect()} == {("A", None), ("B", "no json"), ("D", None)}
    out = {(r["ticker"], r["close"], r["malformed"]) for r in drift.conform(recs).select("ticker", "close", "malformed").collect()}
    assert out == {("A", 1.0, None), ("A", 2.0, None), ("A", None, "7"), ("B", None, "no json"), ("D", 3.0, None)}


def test_new_months_go_straight_into_the_table(spark, monkeypatch):
    rows = sinks.conform(job.features(catalog.stored_bars(spark, SMALL), run_date="1", processed_at="p", dedupe=False))
    name = "fresh_merge_t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.ensure_table(spark, name)
    made = []
    from barsmith import session

    real = session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda s, n: made.append(n) or real(s, n))
    sinks.merge_table(rows, name, unique=True)
    made_first = list(made)
    assert "merge" not in made_first and spark.table(name).count() == rows.count()
    sinks.merge_table(rows.withColumn("pipeline_run", F.lit("2")), name, unique=True)
    assert "merge" in made and spark.table(name).filter("pipeline_run = '2'").count() == spark.table(name).count() == rows.count()
    spark.sql(f"DROP TABLE {name}")


def test_a_scan_stores_no_more_than_it_is_asked_for(spark, monkeypatch):
    from barsmith.plans import scan

    seen = []
    real = scan.range_buckets
    monkeypatch.setattr(scan, "range_buckets", lambda df, *a: seen.append(df.columns) or real(df, *a))
    catalog.q_ewma_chunked(spark, SMALL)
    assert seen == [["ticker", "date", "adj_close"]]


def test_rows_before_a_bucket_are_summed_once_a_bucket(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 9 != 0, (F.col("id") * 37 % 101).cast("double")).alias("v"))
    out = percent_ranks(df, {"p": ("v", True, True)}, by=["id"])
    assert "map_filter" not in plan(out)
    w = Window.orderBy(F.col("v").desc_nulls_last())
    assert out.join(df.withColumn("q", F.percent_rank().over(w)).select("id", "q"), "id").filter(F.abs(F.col("p") - F.col("q")) > 1e-12).count() == 0
