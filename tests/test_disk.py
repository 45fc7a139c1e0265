"""Plans and files whose bytes must stay few."""

import datetime as dt
import os

import pytest
from conftest import SMALL
from pyspark.sql import Row
from pyspark.sql import functions as F

from barsmith import catalog, session
from barsmith.plans import increment, job
from barsmith.schema import BAR_COLUMNS
from barsmith.sources import fixtures, ndjson, rules, sinks, vendor


def files(root, end):
    return [os.path.join(d, n) for d, _, names in os.walk(root.removeprefix("file:")) for n in names if n.endswith(end)]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parquet_files_are_zstd(spark, tmp_dir):
    rows = job.features(catalog.stored_bars(spark, SMALL), run_date="1", processed_at="p", dedupe=False)
    sinks.write_parquet(rows, f"{tmp_dir}/rows")
    sinks.write_table(sinks.conform(rows), "zstd_t", path=f"{tmp_dir}/table")
    sinks.write_clustered(rows, "zstd_c", buckets=2, path=f"{tmp_dir}/clustered")
    sinks.ensure_table(spark, "zstd_m", location=f"{tmp_dir}/merged")
    for run in ("1", "2"):
        sinks.merge_table(sinks.conform(rows.withColumn("pipeline_run", F.lit(run))), "zstd_m", unique=True)
    for name in ("rows", "table", "clustered", "merged"):
        stored = files(f"{tmp_dir}/{name}", ".parquet")
        assert stored and all(f.endswith(".zstd.parquet") for f in stored), name
    assert spark.table("zstd_m").filter("pipeline_run = '2'").count() == spark.table("zstd_m").count() == rows.count()
    for t in ("zstd_t", "zstd_c", "zstd_m"):
        spark.sql(f"DROP TABLE {t}")


def test_first_and_last_trade_are_carried_once(spark):
    day = dt.datetime(1997, 3, 4, 10)
    line = lambda supp, order, part, price: Row(l_orderkey=order, l_partkey=part, l_suppkey=supp, l_linenumber=1,
                                                l_quantity=2.0, l_extendedprice=price, l_shipdate=day)
    lines = spark.createDataFrame(
        [line(1, 5, 1, 8.0), line(1, 4, 1, None), line(1, 6, 1, 2.0), line(1, 6, 1, 2.0), line(None, 1, 1, 4.0), line(None, 2, 1, 6.0), line(2, 1, 1, None)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp")
    bars = fixtures.bars_from_lines(lines)
    assert "min_by" not in executed(bars) and "max_by" not in executed(bars)
    got = {r["ticker"]: (r["open"], r["high"], r["low"], r["close"], r["volume"], r["adj_volume"]) for r in bars.collect()}
    assert got == {"1": (None, 4.0, 1.0, 1.0, 8, 16), None: (2.0, 3.0, 2.0, 3.0, 4, 8), "2": (None, None, None, None, 2, 4)}


def _days(spark, ticker, first, n, price=10.0):
    return spark.range(n).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"), F.lit(ticker).alias("ticker"),
        *[(F.col("id") + price).cast("double").alias(c) if "volume" not in c else (F.col("id") + 1).alias(c) for c in BAR_COLUMNS[2:-1]],
        F.lit("2024-01-01T00:00:00").alias("ingested_at"))


def test_late_bars_compare_the_bars_of_their_instruments(spark, tmp_dir, monkeypatch):
    first, staged, out = dt.date(2023, 1, 1), f"{tmp_dir}/staged", f"{tmp_dir}/out"
    bars = _days(spark, "A", first, 60).unionByName(_days(spark, "B", first, 60))
    late = (F.col("ticker") == "A") & (F.col("date") == dt.date(2023, 2, 5))
    ndjson.stage(bars.filter(~late), staged, "1")
    ndjson.stage(bars.filter(late), staged, "2")
    seen, real = [], sinks.newest
    monkeypatch.setattr(sinks, "newest", lambda df, *a: seen.append(df) or real(df, *a))
    for run, kw in (("1", {}), ("2", {"after": "1"})):
        res = job.run_pipeline(spark, staged, out, run, processed_at="p", register=False, **kw)
    assert res["metrics"]["late_rows"] == 1 and len(seen) == 1
    assert set(seen[0].columns) == {*BAR_COLUMNS, "pipeline_run", "processed_at"}
    assert {r["ticker"] for r in seen[0].select("ticker").distinct().collect()} == {"A"}
    # the bar store goes once its rows are in the features
    made = [d for d, _, _ in os.walk(spark.sparkContext.getCheckpointDir().removeprefix("file:")) if "/bars-2-" in d]
    assert not made
    got = real(sinks.read_runs(spark, out)).drop("pipeline_run")
    whole = job.features(bars, run_date="r", processed_at="p", dedupe=False).drop("pipeline_run")
    assert got.exceptAll(whole).count() == whole.exceptAll(got).count() == 0


def test_newest_compares_only_months_with_copies(spark):
    day = dt.date
    rows = [Row("A", day(2023, 1, 2), "1", "p", 1.0), Row("A", day(2023, 2, 2), "1", "p", 2.0), Row("A", day(2023, 2, 2), "2", "p", 3.0),
            Row("B", day(2023, 2, 2), "1", "p", 4.0), Row(None, day(2023, 3, 1), "1", "p", 5.0), Row(None, day(2023, 3, 1), "1", "p", 5.0),
            Row("A", None, "1", "p", 6.0), Row("A", None, "2", "p", 7.0), Row("C", day(2023, 1, 2), "2", "p", None)]
    runs = spark.createDataFrame(rows, "ticker string, date date, pipeline_run string, processed_at string, x double")
    out = sinks.newest(runs)
    assert out.columns == runs.columns
    assert sorted(r["x"] or 0 for r in out.collect()) == [0, 1.0, 3.0, 4.0, 5.0, 7.0]
    assert "LeftAnti" in executed(out)


def test_rows_lie_in_their_buckets_before_they_are_written(spark, monkeypatch):
    seen, real = [], sinks.write_clustered
    monkeypatch.setattr(sinks, "write_clustered", lambda df, name, *, buckets, **kw: seen.append((df, buckets)) or real(df, name, buckets=buckets, **kw))
    catalog._STORED.pop((spark.sparkContext.applicationId, SMALL, "clustered"), None)
    table = catalog.clustered_features(spark, SMALL, buckets=3, rows=200)
    (df, buckets), = seen
    assert buckets > 3 and executed(df.repartition(buckets, F.col("ticker"))).count("Exchange hashpartitioning") == 1
    ref = catalog.stored_features(spark, SMALL)
    assert table.select(*ref.columns).exceptAll(ref).count() == 0 and table.count() == ref.count()


def test_payload_files_are_compressed_and_name_no_ticker(spark, monkeypatch):
    bars = catalog.lineitem_bars(spark, SMALL)
    odd = bars.withColumn("ticker", F.when(F.col("ticker") != "1", F.col("ticker")))
    monkeypatch.setattr(catalog, "lineitem_bars", lambda *a: odd)
    root = catalog._vendor_root(spark, SMALL)
    stored = files(root, ".gz") + files(root, ".json")
    assert stored and all(f.endswith(".json.gz") for f in stored)
    out = vendor.normalize(vendor.read_payloads(spark, root), "x")
    assert out.count() == bars.count()
    assert out.filter("ticker IS NULL").count() == bars.filter("ticker = '1'").count() > 0


def _shuffled(df):
    return executed(df).count("Exchange hashpartitioning")


def test_staged_lines_are_not_shuffled_to_be_written(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(ndjson, "FILE_LINES", 40)
    bars = _days(spark, "B", dt.date(2023, 1, 1), 50).unionByName(_days(spark, "A", dt.date(2023, 1, 1), 50)).coalesce(1)
    ndjson.stage(bars, tmp_dir, "r")
    lines = [spark.read.json(f).orderBy(F.monotonically_increasing_id()).select("ticker", "date").collect() for f in files(tmp_dir, ".json.gz")]
    # of one task, cut into files
    assert sorted(map(len, lines)) == [20, 40, 40] and all(one == sorted(one) for one in lines)
    assert ndjson.to_bars(ndjson.scan(spark, tmp_dir, "r")).exceptAll(bars).count() == 0


def test_a_run_shuffles_its_bars_once_and_stores_none(spark, tmp_dir, monkeypatch):
    first, out = dt.date(2022, 1, 1), f"{tmp_dir}/out"
    bars = _days(spark, "A", first, 300).unionByName(_days(spark, "B", first, 20))
    copies = bars.filter("day(date) = 3").withColumns({"close": F.lit(-1.0), "ingested_at": F.lit("2020")})
    ndjson.stage(bars.unionByName(copies), f"{tmp_dir}/staged", "disk_r1")
    seen, real = [], sinks.write_parquet
    monkeypatch.setattr(sinks, "write_parquet", lambda df, path, *a, **kw: seen.append(_shuffled(df)) or real(df, path, *a, **kw))
    made, scratch = [], session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda s, n: made.append(n) or scratch(s, n))
    res = job.run_pipeline(spark, f"{tmp_dir}/staged", out, "disk_r1", processed_at="p", register=False)
    assert seen == [1] and not made
    m = res["metrics"]
    assert (m["rows"], m["duplicate_rows"], m["written_rows"]) == (320 + copies.count(), copies.count(), 320)
    whole = job.features(bars, run_date="disk_r1", processed_at="p", dedupe=False)
    assert res["features"].exceptAll(whole).count() == whole.exceptAll(res["features"]).count() == 0
    # the marked rows are the state that a window over the stored rows finds
    state, want = increment.read_state(spark, out, "disk_r1"), increment.tail_state(whole)
    assert state.columns == want.columns and state.count() == increment.TAIL + 20
    assert state.exceptAll(want).count() == want.exceptAll(state).count() == 0


def test_shuffles_go_with_the_action_within_a_job_only(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with session.shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before


def test_an_empty_load_leaves_nothing(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/staged/run_date=disk_r2")
    with open(f"{tmp_dir}/staged/run_date=disk_r2/part-0.json", "w") as f:
        f.write('{"ticker": "A"}\nnonsense\n')
    with pytest.raises(ndjson.EmptyLoad):
        job.run_pipeline(spark, f"{tmp_dir}/staged", f"{tmp_dir}/out", "disk_r2", register=False)
    assert not os.path.exists(f"{tmp_dir}/out")


def test_good_lines_are_not_stored(spark, tmp_dir):
    bars = _days(spark, "A", dt.date(2023, 1, 1), 40)
    lines = bars.withColumn("volume", F.when(F.day("date") == 5, -F.col("volume")).otherwise(F.col("volume")))
    ndjson.stage(lines, f"{tmp_dir}/staged", "disk_r3")
    columns = ndjson.scan(spark, f"{tmp_dir}/staged", "disk_r3").columns
    res = job.run_pipeline(spark, f"{tmp_dir}/staged", f"{tmp_dir}/out", "disk_r3", register=False, rules=rules.bar_rules(columns))
    assert spark.read.parquet(f"{tmp_dir}/out/_quarantine/run_date=disk_r3").groupBy("verdict").count().collect() == [Row("bad", 2)]
    assert (res["metrics"]["quarantined_rows"], res["rows"], res["quarantine"].count()) == (2, 38, 2)


def test_new_bars_meet_the_state_once(spark, tmp_dir):
    first = dt.date(2021, 1, 1)
    bars = _days(spark, "A", first, 400).unionByName(_days(spark, "B", first, 400)).unionByName(_days(spark, "C", first, 300))
    feats = job.features(bars, run_date="r", processed_at="p", dedupe=False)
    cut = F.lit(first + dt.timedelta(days=350))
    increment.tail_state(feats.filter(F.col("date") < cut)).write.parquet(f"{tmp_dir}/state")
    state = spark.read.parquet(f"{tmp_dir}/state")
    new = bars.filter(F.col("date") >= F.date_sub(cut, 20)).withColumn("close", F.when(F.col("date") == F.date_sub(cut, 7), 1.0).otherwise(F.col("close")))
    step = increment.advance(state, new, run_date="r", processed_at="p", dedupe=False, store=f"{tmp_dir}/placed")
    kinds = {r["kind"]: r["count"] for r in spark.read.parquet(f"{tmp_dir}/placed").groupBy("kind").count().collect()}
    assert kinds == {"fresh": 100, "late": 2, "unchanged": 38}
    assert (step.late.count(), step.unchanged.count()) == (2, 38) and "_known" not in executed(step.features)
    # the state's rows are shuffled once for their windows
    assert _shuffled(step.features) == 1
    want = feats.filter((F.col("date") >= cut))
    assert step.features.drop("close").exceptAll(want.drop("close")).count() == 0 and step.features.count() == want.count() == 100


def test_rows_that_win_everywhere_are_not_shuffled_to_be_merged(spark, monkeypatch):
    day = dt.date
    row = lambda t, d, run, x, m: Row(t, d, run, "p", x, 2023, m)
    schema = "ticker string, date date, pipeline_run string, processed_at string, x double, year int, month int"
    old = [row("A", day(2023, 1, 2), "1", 1.0, 1), row("A", day(2023, 1, 2), "0", 9.0, 1), row("B", day(2023, 1, 2), "1", 2.0, 1),
           row("B", day(2023, 1, 3), "1", 3.0, 1), row("B", day(2023, 1, 3), "0", 8.0, 1), row(None, day(2023, 1, 4), "1", 4.0, 1), row(None, day(2023, 1, 4), "0", 7.0, 1),
           row("A", day(2023, 2, 2), "1", 5.0, 2)]
    for run, want in (("2", [2.0, 3.0, 4.0, 5.0, 10.0, 11.0]), ("1", [2.0, 3.0, 4.0, 5.0, 10.0, 11.0]), ("0", [1.0, 2.0, 3.0, 4.0, 5.0, 11.0])):
        name = f"apart_{run}_t"
        sinks.write_table(spark.createDataFrame(old, schema), name)
        staged, real = [], sinks._layout
        monkeypatch.setattr(sinks, "_layout", lambda df, *a, **kw: staged.append(df.count()) or real(df, *a, **kw))
        new = spark.createDataFrame([row("A", day(2023, 1, 2), run, 10.0, 1), row("C", day(2023, 1, 2), run, 11.0, 1)], schema)
        sinks.merge_table(new, name, unique=True)
        monkeypatch.setattr(sinks, "_layout", real)
        assert sorted(r["x"] for r in spark.table(name).collect()) == want, run
        assert staged == [3 if run == "2" else 5]
        spark.sql(f"DROP TABLE {name}")


def test_staged_lines_go_with_the_last_run_that_reads_them(spark, monkeypatch):
    staged, at_run, at_write = [], [], []
    lines = lambda: sorted({f.split("run_date=")[1].split("/")[0] for root in staged for f in files(root, ".json.gz")})
    stage, run, write = ndjson.stage, job.run_pipeline, sinks.write_parquet
    monkeypatch.setattr(ndjson, "stage", lambda bars, root, *a: staged.append(root) or stage(bars, root, *a))
    monkeypatch.setattr(job, "run_pipeline", lambda *a, **kw: at_run.append(lines()) or run(*a, **kw))
    monkeypatch.setattr(sinks, "write_parquet", lambda *a, **kw: at_write.append(lines()) or write(*a, **kw))
    bars = catalog.lineitem_bars(spark, SMALL)
    half = bars.filter("ticker % 2 = 0 AND date >= DATE '1995-03-15'")
    assert catalog.q_pipeline_rerun(spark, SMALL).count() == bars.count() + half.count()
    assert at_run == [["20240101", "20240102"], ["20240102"]] and lines() == []
    staged.clear(), at_run.clear(), at_write.clear()
    assert catalog.q_run_ledger(spark, SMALL).count() == bars.count()
    # two runs read the lines, the broken attempts do not
    assert at_run == [["20240101"]] * 2 and at_write == [["20240101"]] * 2 + [[]] * 2


def test_features_of_lines_shuffle_once_and_store_no_bars(spark, monkeypatch):
    made, scratch = [], session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda s, n: made.append(n) or scratch(s, n))
    for q in ("features_all", "conform_schema", "sma"):
        plan = executed(catalog.queries()[q](spark, SMALL))
        assert plan.count("Exchange") == 1 and plan.count("+- Sort ") == 1, q
    assert not made
    catalog._STORED.pop((spark.sparkContext.applicationId, SMALL, "features"), None)
    catalog.stored_features(spark, SMALL)
    assert made == ["features"]
    # the views' date is that of the newest bar, also of one without ticker
    bars = catalog.lineitem_bars(spark, SMALL)
    assert catalog.bars_as_of(spark, SMALL) == bars.agg(F.max("date")).first()[0]
