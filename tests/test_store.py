"""Stored state: run ledger, merged and clustered tables, the table contract, incremental features."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from barsmith.operators import views as vw
from barsmith.plans import increment, job
from barsmith.schema import DECLARED_SCHEMA, FEATURE_SCHEMA
from barsmith.sources import ledger, ndjson, sinks
from conftest import make_bars, random_walk


def walk_bars(spark, n=400, tickers=("AA", "BB", "CC")):
    out = None
    for i, t in enumerate(tickers):
        b = make_bars(spark, random_walk(n, seed=i + 1), ticker=t)
        out = b if out is None else out.unionByName(b)
    return out


def values(df, *drop):
    cols = [c for c in df.columns if c not in drop]
    rows = [tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()]
    return sorted(rows, key=repr)


def run(spark, tmp_dir, bars, run_date, **kw):
    ndjson.stage(bars, f"{tmp_dir}/staged", run_date)
    return job.run_pipeline(spark, f"{tmp_dir}/staged", f"{tmp_dir}/out", run_date, processed_at="p", register=False, **kw)


# ------------------------------------------------------------------ ledger
def test_only_committed_attempts_are_read(spark, tmp_dir, monkeypatch):
    out = f"{tmp_dir}/out"
    bars = walk_bars(spark, 60)
    with monkeypatch.context() as m:  # breaks after all files of the run are written
        m.setattr(ledger, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            run(spark, tmp_dir, bars, "20240101")
    assert len(os.listdir(f"{out}/run_date=20240101")) == 1
    os.makedirs(f"{out}/_ledger", exist_ok=True)
    assert sinks.read_runs(spark, out).count() == 0 and sinks.read_runs(spark, out).schema == FEATURE_SCHEMA
    run(spark, tmp_dir, bars, "20240101")
    run(spark, tmp_dir, bars.filter("ticker = 'AA'"), "20240102")
    run(spark, tmp_dir, bars, "20240101")
    assert len(os.listdir(f"{out}/run_date=20240101")) == 3
    assert {r["pipeline_run"]: r["count"] for r in sinks.read_runs(spark, out).groupBy("pipeline_run").count().collect()} == {
        "20240101": 180, "20240102": 60}
    assert sinks.read_runs(spark, out, ["20240102"]).count() == 60
    assert ledger.records(spark, out).count() == 3
    newest = {r["run_date"]: r for r in ledger.committed(spark, out).collect()}
    assert newest["20240101"]["rows"] == 180 and newest["20240102"]["metrics"]["written_rows"] == 60


def test_verify_finds_missing_and_foreign_files(spark, tmp_dir):
    res = run(spark, tmp_dir, walk_bars(spark, 60), "20240101")
    assert ledger.verify(spark, f"{tmp_dir}/out") == 1
    month = f"{res['path']}/year=2023/month=1"
    name = [f for f in os.listdir(month) if f.endswith(".parquet")][0]
    extra = f"{month}/part-extra.parquet"
    with open(f"{month}/{name}", "rb") as src, open(extra, "wb") as dst:
        dst.write(src.read())
    with pytest.raises(ledger.BrokenRun):
        ledger.verify(spark, f"{tmp_dir}/out")
    os.remove(extra)
    os.remove(f"{month}/{name}")
    with pytest.raises(ledger.BrokenRun):
        ledger.verify(spark, f"{tmp_dir}/out")


# ------------------------------------------------------------------ merged table
def files_under(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merge_rewrites_only_touched_months(spark, tmp_dir):
    feats = sinks.conform(job.features(walk_bars(spark, 200), run_date="1", processed_at="p"))
    path = f"{tmp_dir}/table"
    sinks.merge_table(feats, "merge_t", path=path)
    before = files_under(path)
    newer = (feats.filter("ticker = 'BB' AND date BETWEEN DATE '2023-03-10' AND DATE '2023-04-05'")
             .withColumns({"pipeline_run": F.lit("2"), "close": F.lit(1.0)}))
    ahead = newer.filter("date = DATE '2023-03-10'").withColumn("date", F.lit(dt.date(2024, 2, 1))).withColumns(
        {"year": F.lit(2024).cast("long"), "month": F.lit(2).cast("long")})
    old = feats.filter("ticker = 'CC' AND month = 3").withColumns({"pipeline_run": F.lit("0"), "close": F.lit(-1.0)})
    sinks.merge_table(newer.unionByName(ahead).unionByName(old), "merge_t", path=path)
    t = spark.table("merge_t")
    assert t.count() == 601 and t.filter("pipeline_run = '2'").count() == 28 and t.filter("pipeline_run = '0'").count() == 0
    assert t.filter("close = 1.0 AND pipeline_run = '2'").count() == 28
    after = files_under(path)
    month = lambda f: os.path.dirname(f)
    rewritten = {month(f) for f in after if after[f] != before.get(f)} | {month(f) for f in before if f not in after}
    assert rewritten == {"year=2023/month=3", "year=2023/month=4", "year=2024/month=2"}
    assert values(t.filter("pipeline_run = '1'")) == values(feats.join(newer.select("ticker", "date"), ["ticker", "date"], "left_anti").select(t.columns))
    sinks.merge_table(newer.limit(0), "merge_t")
    assert files_under(path) == after


def test_a_failed_merge_leaves_the_table(spark, tmp_dir):
    feats = sinks.conform(job.features(walk_bars(spark, 60), run_date="1", processed_at="p"))
    sinks.merge_table(feats, "merge_fail_t", path=f"{tmp_dir}/t")
    before = files_under(f"{tmp_dir}/t")
    broken = feats.withColumn("close", F.when(F.col("ticker") == "CC", F.raise_error(F.lit("bad row")).cast("double")).otherwise(1.0))
    with pytest.raises(Exception, match="bad row"):
        sinks.merge_table(broken, "merge_fail_t")
    assert files_under(f"{tmp_dir}/t") == before


def test_job_merges_into_its_table(spark, tmp_dir):
    bars = walk_bars(spark, 100)
    kw = {"table": "job_merge_t", "table_path": f"{tmp_dir}/table"}
    run(spark, tmp_dir, bars, "20240101", **kw)
    run(spark, tmp_dir, bars.filter("ticker = 'AA'"), "20240102", **kw)
    counts = {r["pipeline_run"]: r["count"] for r in spark.table("job_merge_t").groupBy("pipeline_run").count().collect()}
    assert counts == {"20240101": 200, "20240102": 100}


# ------------------------------------------------------------------ clustered table
def test_clustered_table_needs_no_shuffle(spark, tmp_dir):
    feats = job.features(walk_bars(spark, 300, tickers=[f"T{i}" for i in range(12)]), run_date="r", processed_at="p")
    stored = f"{tmp_dir}/features"
    sinks.write_parquet(feats, stored)
    feats = sinks.read_parquet(spark, stored)
    sinks.write_clustered(feats, "clustered_t", buckets=4, path=f"{tmp_dir}/clustered")
    t = spark.table("clustered_t")
    assert values(t) == values(feats.select(t.columns))
    assert len([f for f in os.listdir(f"{tmp_dir}/clustered") if f.endswith(".parquet")]) == 4
    plain = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        as_of = dt.date(2023, 10, 1)
        for view in (lambda f: vw.volatility_regime(f, as_of), vw.ml_feature_set, vw.latest_snapshot,
                     lambda f: vw.volatility_regime(f, as_of, expanding=True),
                     lambda f: job.apply_operator(f.select("ticker", "date", "adj_close"), "sma", dedupe=False)):
            plans = [view(f)._jdf.queryExecution().executedPlan().toString() for f in (t, feats)]
            assert "Exchange" not in plans[0] and "Exchange" in plans[1]
            assert values(view(t)) == values(view(feats))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", plain)


def test_merge_keeps_the_clustering(spark, tmp_dir):
    """A table of buckets within months: only touched months are rewritten, and reads by instrument stay without a shuffle."""
    feats = sinks.conform(job.features(walk_bars(spark, 200, tickers=[f"T{i}" for i in range(9)]), run_date="1", processed_at="p"))
    path = f"{tmp_dir}/table"
    sinks.write_clustered(feats, "clustered_merge_t", buckets=3, partition_cols=sinks.PARTITION_COLUMNS, path=path)
    assert sinks.table_buckets(spark, "clustered_merge_t") == 3
    before = files_under(path)
    newer = feats.filter("month = 4 AND ticker IN ('T1', 'T5')").withColumns({"pipeline_run": F.lit("2"), "rsi": F.lit(-1.0)})
    sinks.merge_table(newer, "clustered_merge_t")
    t, after = spark.table("clustered_merge_t"), files_under(path)
    assert t.count() == 9 * 200 and t.filter("pipeline_run = '2' AND rsi = -1.0").count() == 60
    assert {os.path.dirname(f) for f in set(after) ^ set(before)} == {"year=2023/month=4"}
    assert max(len([f for f in after if os.path.dirname(f) == m]) for m in {os.path.dirname(f) for f in after}) <= 3
    view = lambda f: job.apply_operator(f.select("ticker", "date", "adj_close"), "sma", dedupe=False)
    assert "Exchange" not in view(t)._jdf.queryExecution().executedPlan().toString()
    want = feats.join(newer.select("ticker", "date"), ["ticker", "date"], "left_anti").select(t.columns).unionByName(newer.select(t.columns))
    assert values(view(t)) == values(view(want))


# ------------------------------------------------------------------ contract
def declared_table(spark, name, path, change=lambda f: f, parts="year, month"):
    fields = ", ".join(f"`{n}` {t}" for n, t in filter(None, (change((f.name, f.dataType.simpleString())) for f in DECLARED_SCHEMA.fields)))
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY ({parts}) LOCATION '{path}'")


def test_contract_adds_columns_and_refuses_narrow_ones(spark, tmp_dir):
    declared_table(spark, "contract_ok", f"{tmp_dir}/a")
    assert sinks.enforce_contract(spark, "contract_ok") == []
    declared_table(spark, "contract_short", f"{tmp_dir}/b", lambda f: None if f[0] in ("rsi", "obv") else f)
    assert sinks.enforce_contract(spark, "contract_short") == ["rsi", "obv"]
    assert {"rsi", "obv"} <= set(spark.table("contract_short").columns)
    assert sinks.enforce_contract(spark, "contract_short") == []
    for i, (column, bad) in enumerate({"rsi": "float", "volume": "int", "date": "string", "golden_cross": "boolean"}.items()):
        declared_table(spark, f"contract_bad{i}", f"{tmp_dir}/c{i}", lambda f: (f[0], bad) if f[0] == column else f)
        with pytest.raises(sinks.SchemaDrift, match=column):
            sinks.enforce_contract(spark, f"contract_bad{i}")
    declared_table(spark, "contract_parts", f"{tmp_dir}/d", parts="year")
    with pytest.raises(sinks.SchemaDrift, match="partitioned"):
        sinks.enforce_contract(spark, "contract_parts")


def test_job_holds_its_table_to_the_contract(spark, tmp_dir):
    bars = walk_bars(spark, 60)
    declared_table(spark, "job_drift", f"{tmp_dir}/a", lambda f: (f[0], "string") if f[0] == "rsi" else f)
    with pytest.raises(sinks.SchemaDrift):
        run(spark, tmp_dir, bars, "20240101", table="job_drift")
    assert not os.path.exists(f"{tmp_dir}/out/_ledger")
    declared_table(spark, "job_short", f"{tmp_dir}/b", lambda f: None if f[0] == "rsi" else f)
    spark.sql("ALTER TABLE job_short ADD COLUMNS (note string)")
    run(spark, tmp_dir, bars, "20240102", table="job_short")
    t = spark.table("job_short")
    assert t.filter("rsi IS NOT NULL AND note IS NULL").count() == 180


# ------------------------------------------------------------------ incremental features
def test_advance_reads_the_tail_alone(spark, tmp_dir):
    bars = walk_bars(spark, 700).filter("ticker <> 'CC' OR date >= DATE '2024-10-01'")
    cut = dt.date(2024, 10, 20)
    first = job.features(bars.filter(F.col("date") < F.lit(cut)), run_date="r", processed_at="p", dedupe=False)
    state = increment.tail_state(first)
    assert {r["count"] for r in state.groupBy("ticker").count().collect()} == {increment.TAIL, 19}
    path = f"{tmp_dir}/state"
    state.write.parquet(path)
    state = spark.read.parquet(path)
    new = bars.filter(F.col("date") >= F.lit(cut))
    newcomer = make_bars(spark, random_walk(30, seed=9), ticker="NEW", start=cut)
    step = increment.advance(state, new.unionByName(newcomer), run_date="r", processed_at="p")
    want = job.features(bars.unionByName(newcomer), run_date="r", processed_at="p", dedupe=False).filter(F.col("date") >= F.lit(cut))
    assert values(step.features) == values(want) and step.late.count() == 0 and step.unchanged.count() == 0
    # the state after both runs is that of one run over everything
    assert values(increment.tail_state(step.features, state)) == values(increment.tail_state(job.features(
        bars.unionByName(newcomer), run_date="r", processed_at="p", dedupe=False)))
    # nothing but the state and the new bars is read
    files = {f.rsplit("/", 2)[-2] for f in step.features.inputFiles()}
    assert files <= {"state"}


def test_advance_tells_late_and_unchanged_bars(spark):
    bars = walk_bars(spark, 400, tickers=("AA", "BB"))
    cut = dt.date(2024, 1, 20)
    state = increment.tail_state(job.features(bars.filter(F.col("date") < F.lit(cut)), run_date="r", processed_at="p", dedupe=False))
    again = bars.filter(F.col("date") >= F.lit(dt.date(2023, 12, 1))).withColumn("ingested_at", F.lit("later"))
    changed = again.withColumn("adj_close", F.when((F.col("ticker") == "BB") & (F.col("date") == F.lit(dt.date(2024, 1, 5))), 7.0)
                               .otherwise(F.col("adj_close")))
    step = increment.advance(state, changed, run_date="r", processed_at="p")
    assert [tuple(r) for r in step.late.select("ticker", "date", "adj_close").collect()] == [("BB", dt.date(2024, 1, 5), 7.0)]
    assert step.unchanged.count() == 2 * 50 - 1
    assert step.features.count() == again.filter(F.col("date") >= F.lit(cut)).count()


@pytest.mark.parametrize("start", ["2023-06-01", "2024-01-05"])
def test_job_after_an_earlier_run_with_late_bars(spark, tmp_dir, start):
    """Late bars from before and from within the state: the newest rows are those of one whole run."""
    bars = walk_bars(spark, 450)
    cut = dt.date(2024, 2, 20)
    late = (F.col("ticker") == "BB") & F.col("date").between(F.lit(dt.date.fromisoformat(start)), F.lit(dt.date.fromisoformat(start) + dt.timedelta(days=9)))
    run(spark, tmp_dir, bars.filter(~late & (F.col("date") < F.lit(cut))), "20240101")
    second = bars.filter(late | (F.col("date") >= F.lit(cut)) & (F.col("date") < F.lit(dt.date(2024, 3, 1))))
    res = run(spark, tmp_dir, second, "20240102", after="20240101")
    assert res["metrics"]["late_rows"] == 10
    run(spark, tmp_dir, bars.filter(F.col("date") >= F.lit(dt.date(2024, 2, 25))), "20240103", after="20240102")
    got = sinks.newest(sinks.read_runs(spark, f"{tmp_dir}/out"))
    want = job.features(bars, run_date="r", processed_at="p")
    assert values(got, "pipeline_run", "ingested_at") == values(want, "pipeline_run", "ingested_at")
    third = sinks.read_runs(spark, f"{tmp_dir}/out", ["20240103"])
    assert third.agg(F.min("date")).first()[0] == dt.date(2024, 3, 1)
    with pytest.raises(ValueError):
        run(spark, tmp_dir, second, "20240104", after="nothing")
