"""Ingestion (vendor payloads, NDJSON staging and scan, gate, manifest), sinks,
streaming ingestion and the end-to-end batch job."""

import json
import os

import pytest
from pyspark.sql import functions as F

from barsmith.plans import job
from barsmith.schema import BAR_COLUMNS, DECLARED_COLUMNS, FEATURE_COLUMNS
from barsmith.sources import ndjson, sinks, vendor
from barsmith.streaming.ingest import ingest_available
from conftest import make_bars, random_walk

# A vendor record as the payload carries it.
RECORD = {
    "date": "2024-01-15T00:00:00+00:00",
    "open": 180.0, "high": 185.0, "low": 178.0, "close": 183.0, "volume": 55000000,
    "adjOpen": 180.0, "adjHigh": 185.0, "adjLow": 178.0, "adjClose": 183.0,
    "adjVolume": 55000000,
}


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_payload_one_record(spark, tmp_dir):
    _write(f"{tmp_dir}/aapl.json", json.dumps([RECORD]))
    out = vendor.normalize(vendor.read_payloads(spark, tmp_dir, multi_line=True),
                           "2024-02-01T00:00:00").collect()
    assert len(out) == 1
    r = out[0]
    assert list(r.asDict()) == BAR_COLUMNS
    assert (r["ticker"], r["date"], r["adj_close"], r["ingested_at"]) == \
        ("AAPL", "2024-01-15", 183.0, "2024-02-01T00:00:00")


def test_payload_empty_and_offsets(spark, tmp_dir):
    _write(f"{tmp_dir}/fake.json", "[]")
    rec = dict(RECORD, date="2024-01-15T23:00:00-05:00")
    _write(f"{tmp_dir}/ticker=msft/part.json", json.dumps(rec) + "\n")
    arr = vendor.normalize(vendor.read_payloads(spark, f"{tmp_dir}/fake.json", multi_line=True),
                           "x")
    assert arr.count() == 0                                  # empty payload -> no rows
    lines = vendor.normalize(vendor.read_payloads(spark, f"{tmp_dir}/ticker=msft"), "x")
    r = vendor.normalize(vendor.read_payloads(spark, tmp_dir), "x").filter(
        F.col("ticker") == "MSFT").first()
    assert r["date"] == "2024-01-15"                         # the payload's own calendar day
    assert lines.count() == 1


def test_missing_payload_raises_not_silent(spark, tmp_dir):
    with pytest.raises(Exception):
        vendor.read_payloads(spark, f"{tmp_dir}/absent").collect()


def test_window_universe_and_default_tickers(spark):
    bars = make_bars(spark, [1.0] * 10, ticker="AAPL").unionByName(
        make_bars(spark, [1.0] * 10, ticker="ZZZ"))
    import datetime as dt
    start, end = vendor.request_window(dt.date(2023, 1, 11), 5)
    assert vendor.in_window(bars, start, end).count() == 2 * 6   # both ends inclusive
    assert vendor.in_universe(bars).select("ticker").distinct().collect()[0][0] == "AAPL"
    assert len(vendor.DEFAULT_TICKERS) >= 10
    assert all(isinstance(t, str) and len(t) <= 10 for t in vendor.DEFAULT_TICKERS)
    names = ["zzz", *[f"X{i}" for i in range(2000)]]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    assert vendor.in_universe(bars, names).count() == 10          # names in any case,
    assert vendor.in_universe(bars, frame).count() == 10          # as a list or a DataFrame


def test_manifest_marks_failed(spark):
    bars = make_bars(spark, [1.0, 2.0], ticker="AAPL")
    uni = spark.createDataFrame([("aapl",), ("nope",)], "t string")
    m = {r["ticker"]: r for r in vendor.manifest(uni, bars, run_date="20240101",
                                                 start="2023-01-01", end="2023-12-31",
                                                 uri_root="/shared/raw").collect()}
    assert m["AAPL"]["status"] == "SUCCEEDED" and m["AAPL"]["rows"] == 2
    assert m["AAPL"]["uri"] == "/shared/raw/run_date=20240101"
    assert m["NOPE"]["status"] == "FAILED" and m["NOPE"]["uri"] is None
    s = vendor.manifest_summary(vendor.manifest(uni, bars, run_date="r", start="a", end="b"))
    assert tuple(s.select("succeeded", "failed", "rows").first()) == (1, 1, 2)


def test_stage_scan_roundtrip_bad_records_and_rerun(spark, tmp_dir):
    bars = make_bars(spark, [1.0, 2.0, 3.0], ticker="123")      # all-digit ticker stays text
    ndjson.stage(bars, tmp_dir, "20240101")
    ndjson.stage(bars.filter(F.col("adj_close") < 3), tmp_dir, "20240102")
    back = ndjson.to_bars(ndjson.scan(spark, tmp_dir, "20240101"))
    assert back.schema["ticker"].dataType.simpleString() == "string"
    assert sorted(back.collect()) == sorted(bars.collect())
    ndjson.stage(bars.limit(1), tmp_dir, "20240101")               # re-run replaces its day only
    assert ndjson.scan(spark, tmp_dir, "20240101").count() == 1
    assert ndjson.scan(spark, tmp_dir, "20240102").count() == 2
    d = f"{tmp_dir}/run_date=20240103"
    _write(f"{d}/part-0.json", '{"date": "2024-01-01", "adj_close": 1.0}\nnot json\n'
           '{"date": "2024-13-45", "adj_close": "x"}\n')
    m = ndjson.gate_metrics(ndjson.scan(spark, tmp_dir, "20240103")).first()
    assert (m["rows"], m["corrupt_rows"]) == (3, 2)
    dates = [r["date"] for r in ndjson.to_bars(ndjson.scan(spark, tmp_dir, "20240103")).collect()]
    assert dates.count(None) == 2


def test_gate_raises_on_empty_and_on_loss(spark, tmp_dir):
    with pytest.raises(ndjson.EmptyLoad):
        ndjson.check_gate({"rows": 0})
    ndjson.stage(make_bars(spark, [1.0, None]), tmp_dir, "r")
    df, obs = ndjson.observed(ndjson.scan(spark, tmp_dir, "r"))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 2, "corrupt_rows": 0, "unusable_rows": 0, "null_adj_close": 1}
    counts = {"rows": 5, "unusable_rows": 2, "duplicate_rows": 1, "written_rows": 2}
    assert ndjson.check_gate(counts) == counts
    with pytest.raises(ndjson.LossyLoad, match="unusable"):
        ndjson.check_gate(counts, max_unusable=1)
    with pytest.raises(ndjson.LossyLoad, match="unaccounted"):
        ndjson.check_gate({**counts, "written_rows": 1})


def test_rerun_keeps_the_rows_of_other_runs(spark, tmp_dir):
    """A run with fewer instruments, from the middle of a month, deletes nothing."""
    bars = make_bars(spark, random_walk(60), ticker="A").unionByName(make_bars(spark, random_walk(60), ticker="B"))
    staged, out = f"{tmp_dir}/staged", f"{tmp_dir}/out"
    ndjson.stage(bars, staged, "20240101")
    ndjson.stage(bars.filter("ticker = 'A' AND date >= DATE '2023-01-16'"), staged, "20240102")
    first = job.run_pipeline(spark, staged, out, "20240101", register=False)
    second = job.run_pipeline(spark, staged, out, "20240102", register=False)
    again = job.run_pipeline(spark, staged, out, "20240102", register=False)     # replaces itself only
    assert (first["rows"], second["rows"], again["rows"]) == (120, 46, 46)
    runs = sinks.read_runs(spark, out)
    assert runs.count() == 166
    newest = sinks.newest(runs)
    assert newest.count() == 120 and newest.filter("pipeline_run = '20240102'").count() == 46
    assert newest.columns == FEATURE_COLUMNS


def test_run_counts_every_line(spark, tmp_dir):
    bars = make_bars(spark, [1.0, 2.0, 3.0])
    ndjson.stage(bars.unionByName(bars.limit(2)), tmp_dir, "r")
    _write(f"{tmp_dir}/run_date=r/part-bad.json", 'not json\n{"ticker": "T"}\n{"date": "2024-01-01"}\n')
    res = job.run_pipeline(spark, tmp_dir, f"{tmp_dir}/out", "r", register=False)
    m = res["metrics"]
    assert (m["rows"], m["corrupt_rows"], m["unusable_rows"], m["duplicate_rows"], m["written_rows"]) == (8, 1, 3, 2, 3)
    with pytest.raises(ndjson.LossyLoad):
        job.run_pipeline(spark, tmp_dir, f"{tmp_dir}/out2", "r", register=False, max_unusable=2)
    assert not os.path.exists(f"{tmp_dir}/out2")


def test_parquet_and_table_roundtrip_and_conform(spark, tmp_dir):
    feats = job.features(make_bars(spark, random_walk(60)), run_date="r", processed_at="p")
    sinks.write_parquet(feats, f"{tmp_dir}/features")
    back = sinks.read_parquet(spark, f"{tmp_dir}/features")
    assert back.columns == FEATURE_COLUMNS
    assert back.exceptAll(feats).count() == 0 and back.count() == 60
    years = [n for n in os.listdir(f"{tmp_dir}/features") if n.startswith("year=")]
    assert years == ["year=2023"]
    c = sinks.conform(back)
    assert c.columns == DECLARED_COLUMNS
    assert c.schema["obv"].dataType.simpleString() == "double"
    sinks.write_table(c, "features_t", path=f"{tmp_dir}/table")
    assert spark.table("features_t").count() == 60
    bad = back.withColumn("ticker", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="required field ticker"):
        sinks.conform(bad).collect()
    assert "PARTITIONED BY (year, month)" in sinks.create_table_ddl("t")
    sinks.ensure_table(spark, "declared_t", location=f"{tmp_dir}/declared")
    sinks.ensure_table(spark, "declared_t", location=f"{tmp_dir}/declared")  # idempotent
    assert spark.table("declared_t").columns == DECLARED_COLUMNS


def test_streaming_ingest_is_incremental(spark, tmp_dir):
    root, out, ck = f"{tmp_dir}/staged", f"{tmp_dir}/bars", f"{tmp_dir}/ck"
    ndjson.stage(make_bars(spark, [1.0, 2.0], ticker="A"), root, "20240101")
    ingest_available(spark, root, out, ck)
    assert spark.read.parquet(out).count() == 2
    ndjson.stage(make_bars(spark, [3.0], ticker="B"), root, "20240102")
    ingest_available(spark, root, out, ck)                   # only the new files
    got = spark.read.parquet(out)
    assert got.count() == 3
    assert got.schema["date"].dataType.simpleString() == "date"


def test_run_pipeline_end_to_end(spark, tmp_dir):
    bars = make_bars(spark, random_walk(300), ticker="A").unionByName(
        make_bars(spark, random_walk(300, seed=9), ticker="B"))
    ndjson.stage(bars, f"{tmp_dir}/staged", "20240101")
    ndjson.stage(bars.limit(10), f"{tmp_dir}/staged", "20240101")  # rerun replaces
    ndjson.stage(bars, f"{tmp_dir}/staged", "20240101")
    res = job.run_pipeline(spark, f"{tmp_dir}/staged", f"{tmp_dir}/out", "20240101",
                           processed_at="2024-01-02T00:00:00", table="features_e2e",
                           table_path=f"{tmp_dir}/tbl")
    assert res["rows"] == 600
    assert res["features"].count() == 600
    assert spark.table("features_e2e").count() == 600
    audit = spark.sql("SELECT * FROM vw_pipeline_audit").first()
    assert (audit["pipeline_run"], audit["tickers_loaded"], audit["total_rows"]) == \
        ("20240101", 2, 600)
    with pytest.raises(ndjson.EmptyLoad):
        os.makedirs(f"{tmp_dir}/empty/run_date=20240105", exist_ok=True)
        job.run_pipeline(spark, f"{tmp_dir}/empty", f"{tmp_dir}/out2", "20240105")
