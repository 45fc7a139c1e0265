"""Feature plans: operators run over chunked series, and the batch job."""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from barsmith.operators import features as feat
from barsmith.plans.series import Series, collapse_copies, over_series
from barsmith.schema import BAR_COLUMNS, FEATURE_COLUMNS

# Operator name -> (function, columns it adds).
OPERATORS: dict[str, tuple[Callable, list[str]]] = {
    "sma": (feat.add_moving_averages, [f"sma_{n}" for n in feat.SMA_SPANS]),
    "ema": (feat.add_ema, [f"ema_{n}" for n in feat.EMA_SPANS]),
    "bollinger": (feat.add_bollinger_bands,
                  ["bb_mid", "bb_std", "bb_upper", "bb_lower", "bb_pct_b", "bb_bandwidth"]),
    "rsi": (feat.add_rsi, ["rsi"]),
    "macd": (feat.add_macd, ["macd_line", "macd_signal", "macd_hist"]),
    "log_return": (feat.add_log_return, ["log_return"]),
    "volatility": (feat.add_volatility, ["log_return"] + [
        c for n in feat.VOL_SPANS for c in (f"vol_{n}d", f"annualized_vol_{n}d")]),
    "atr": (feat.add_atr, ["atr_14"]),
    "obv": (feat.add_obv, ["obv"]),
    "volume_zscore": (feat.add_volume_zscore, ["vol_sma_20", "vol_std_20", "vol_zscore"]),
    "range_52w": (feat.add_range_52w, ["pct_from_52w_high", "pct_from_52w_low"]),
    "golden_cross": (feat.add_golden_cross, ["sma_50", "sma_200", "golden_cross"]),
    "momentum": (feat.add_momentum, ["momentum_20d", "momentum_60d"]),
}


def _prefer(df: DataFrame) -> list[str]:
    """Which copy of a duplicate (ticker, date) bar survives: the most recently
    ingested, then the larger prices and volumes (then the other columns, in
    ``collapse_copies``), so the choice is fixed."""
    return [c for c in ("ingested_at", "adj_close", "close", "adj_volume", "volume")
            if c in df.columns]


def apply_operator(bars: DataFrame, name: str, *, key: str = "ticker", order: str = "date",
                   chunk_rows: int | None = None, dedupe: bool = True,
                   min_periods: bool = False, bucket: Column | None = None,
                   **kwargs) -> DataFrame:
    """One operator over each instrument's series; keeps key, order, bar columns.

    ``dedupe`` keeps one bar per (key, order), the latest ingested; pass False for
    bars that are unique by construction (it saves the collapsing shuffle).
    """
    fn, _ = OPERATORS[name]
    return over_series(
        bars, lambda d, s: fn(d, s, **kwargs), key=key, order=order,
        lookback=feat.LOOKBACK[name], chunk_rows=chunk_rows,
        latest=_prefer(bars) if dedupe else None, min_periods=min_periods, bucket=bucket,
    )


def utc_stamp() -> str:
    """One driver-side ISO stamp, taken once per run (never inside an operator)."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat()


def features(bars: DataFrame, *, run_date: str | Column, processed_at: str | Column | None = None,
             key: str = "ticker", order: str = "date", chunk_rows: int | None = None,
             adjusted_atr: bool = False, dedupe: bool = True,
             min_periods: bool = False, bucket: Column | None = None,
             marks: dict[str, Callable[[Series], Column]] | None = None) -> DataFrame:
    """The 54-column feature table from bars (series chunked; with ``dedupe`` one bar
    per (ticker, date) is kept, the latest ingested). ``marks`` are further columns, by
    name, of the same windows; they are for series of one chunk."""
    marks = marks or {}
    out = over_series(
        bars, lambda d, s: feat.build_features(d, s, adjusted_atr=adjusted_atr).withColumns({n: m(s) for n, m in marks.items()}),
        key=key, order=order, lookback=feat.LOOKBACK["all"], chunk_rows=chunk_rows,
        latest=_prefer(bars) if dedupe else None, min_periods=min_periods, bucket=bucket,
    )
    stamp = processed_at if processed_at is not None else utc_stamp()
    out = feat.add_metadata(out, run_date, stamp, order=order)
    # The order column stands where the contract has ``date`` (same for the key).
    names = {"date": order, "ticker": key}
    return out.select(*[names.get(c, c) for c in FEATURE_COLUMNS], *marks)


def features_plain(bars: DataFrame, *, run_date, processed_at=None, key: str = "ticker",
                   order: str = "date", min_periods: bool = False) -> DataFrame:
    """Reference plan (one window partition per ticker); for comparisons and tests."""
    out = feat.build_features(bars, Series.plain(key, order, min_periods=min_periods))
    stamp = processed_at if processed_at is not None else utc_stamp()
    names = {"date": order, "ticker": key}
    out = feat.add_metadata(out, run_date, stamp, order=order)
    return out.select(*[names.get(c, c) for c in FEATURE_COLUMNS])


def run_pipeline(spark, staged_root: str, out_path: str, run_date: str, *,
                 processed_at: str | None = None, table: str | None = None,
                 table_format: str = "parquet", table_path: str | None = None,
                 as_of=None, register: bool = True, max_unusable: int | None = None,
                 chunk_rows: int | None = None, rules=None, after: str | None = None) -> dict:
    """The daily batch: staged NDJSON of one run -> bar store -> features -> Parquet (->
    table, views).

    The NDJSON is scanned once: its usable lines, one per (ticker, date), get their features while
    counters ride along. They are shuffled once, to their instruments, where copies collapse and the
    windows run. (A run with ``after`` or ``chunk_rows`` reads its bars several times, and one with ``max_unusable``
    is judged before its output is touched: they keep their bars as a Parquet bar store in the shared folder meanwhile.) Every scanned line is accounted for in the metrics: rows =
    unusable_rows (no ticker or date; corrupt_rows is how many did not parse) +
    duplicate_rows + written_rows; anything else raises ``LossyLoad``, as do more than
    ``max_unusable`` unusable lines. An empty load raises ``EmptyLoad``. All this is checked
    before the output counts, and an attempt that fails leaves no files.

    ``rules`` (:mod:`barsmith.sources.rules`) judge the lines before they are used: failing ones are
    set aside with their reasons under ``out_path/_quarantine`` by a scan of their own, and rows = quarantined_rows +
    duplicate_rows + written_rows.

    ``after`` names the earlier run that this one goes on from: the staged bars are those after it,
    features are computed from its state and these bars alone (:mod:`barsmith.plans.increment`), and bars on or
    before an instrument's last one lead to that instrument's rows being computed again from the
    history in the committed runs. Every run leaves its state under ``out_path/_state``.

    Each attempt of a run writes a folder of its own, and counts once its record stands in the ledger
    (:mod:`barsmith.sources.ledger`), the last step; ``sinks.read_runs`` reads the committed runs. The
    catalog table is held against its contract first, and the run's rows are merged
    into it, newest wins.
    """
    from barsmith.operators.views import register_views
    from barsmith.session import shuffles_dropped

    with shuffles_dropped(spark):
        run = _run(spark, staged_root, out_path, run_date, processed_at=processed_at, table=table, table_format=table_format,
                   table_path=table_path, max_unusable=max_unusable, chunk_rows=chunk_rows, rules=rules, after=after)
    return run | {"views": register_views(run["features"], as_of) if register else {}}


def _run(spark, staged_root: str, out_path: str, run_date: str, *, processed_at, table, table_format, table_path,
         max_unusable, chunk_rows, rules, after) -> dict:
    from barsmith.plans import increment
    from barsmith.schema import FEATURE_SCHEMA
    from barsmith.session import COMPRESSION, drop_empty, drop_scratch, scratch_path
    from barsmith.sources import ledger, ndjson, sinks
    from barsmith.sources import rules as gate

    attempt, path = ledger.new_attempt(out_path, run_date)
    root = out_path.rstrip("/")
    if table:
        sinks.ensure_table(spark, table, table_format, table_path)
        sinks.enforce_contract(spark, table)
    lines = ndjson.scan(spark, staged_root, run_date)
    raw, seen = ndjson.observed(lines, name=f"scan_{run_date}")
    quarantine = None
    if rules is not None:
        # good lines are scanned again where they are used: a copy of them is more than their feature rows need
        quarantine = gate.set_aside(raw, rules, f"{root}/_quarantine/run_date={run_date}/attempt={attempt}")
        raw, passed = ndjson.counted(gate.good(lines, rules), "good_rows", name=f"good_{run_date}")
    bars = ndjson.to_bars(raw)
    usable = bars.filter(F.col("ticker").isNotNull() & F.col("date").isNotNull())
    stamp = processed_at or utc_stamp()

    def account(written: int) -> dict:
        metrics = {k: int(v) for k, v in seen.get.items()}
        lost = "unusable_rows"
        if quarantine is not None:
            lost, metrics["quarantined_rows"] = "quarantined_rows", quarantine.count()
            good = int(passed.get.get("good_rows") or 0)
            if metrics.get("rows", 0) != metrics["quarantined_rows"] + good:
                raise ndjson.LossyLoad(f"the staged lines are not those that were judged: {good} good ones, {metrics}")
        metrics |= {"written_rows": written, "duplicate_rows": metrics.get("rows", 0) - metrics.get(lost, 0) - written}
        return ndjson.check_gate(metrics, max_unusable, lost=lost)

    stores, state, late, same = [], None, 0, 0
    once = after is None and chunk_rows is None and max_unusable is None
    if once:
        # to their instruments at once: copies collapse and the windows run without another shuffle
        placed = collapse_copies(usable.repartition(F.col("ticker")), "ticker", "date", _prefer(bars))
        placed, made = ndjson.counted(placed, "written_rows", name=f"bars_{run_date}")
        feats = features(placed, run_date=run_date, processed_at=stamp, dedupe=False, marks={increment.IN_STATE: increment.in_state})
    else:
        stores.append(scratch_path(spark, f"bars-{run_date}"))
        collapse_copies(usable, "ticker", "date", _prefer(bars)).write.option("compression", COMPRESSION).parquet(stores[0])
        stored_bars = spark.read.schema(bars.schema).parquet(stores[0])
        written = stored_bars.count()
        metrics = account(written)
    if after is not None:
        state = increment.read_state(spark, root, after)
        placed_path = scratch_path(spark, f"placed-{run_date}")
        step = increment.advance(state, stored_bars, run_date=run_date, processed_at=stamp, dedupe=False, store=placed_path)
        # the late bars stay, for whoever holds the history that they are put into
        stores += [f"{placed_path}/{increment.KIND}={kind}" for kind in (increment.FRESH, increment.UNCHANGED)]
        feats, late, same = step.features, step.late.count(), step.unchanged.count()
        metrics |= {"late_rows": late, "unchanged_rows": same}
        if late:
            # of the history, the bars of the instruments concerned: no other rows or columns are compared
            runs = sinks.read_runs(spark, root).select(*BAR_COLUMNS, "pipeline_run", "processed_at")
            history = sinks.newest(runs.join(step.late.select("ticker").distinct(), "ticker", "left_semi"))
            feats, state = increment.with_late(history, state, step, stored_bars, run_date=run_date, processed_at=stamp)
    elif not once:
        feats = features(stored_bars, run_date=run_date, processed_at=stamp, chunk_rows=chunk_rows, dedupe=False)
    sinks.write_parquet(feats, path)
    if once:
        written = int(made.get.get("written_rows") or 0)
        try:
            metrics = account(written)
        except RuntimeError:
            drop_scratch(spark, path)
            drop_empty(spark, path.rsplit("/", 1)[0])
            drop_empty(spark, root)
            raise
    stored = sinks.read_parquet(spark, path)
    kept = stored.count()
    # a late bar brings the rows after it along
    if kept < written - same or (not late and kept > written - same):
        raise ndjson.LossyLoad(f"{written} bars, {same} of them unchanged, gave {kept} feature rows")
    rows = spark.read.schema(StructType([*FEATURE_SCHEMA.fields, StructField(increment.IN_STATE, BooleanType())])).parquet(path) if once else stored
    increment.write_state(rows, state, root, run_date, attempt, marked=once)
    ledger.commit(spark, root, run_date, attempt, kept, metrics)
    if table:
        sinks.merge_table(sinks.conform(stored), table, unique=True)
    for store in stores:  # their rows are in the run's features
        drop_scratch(spark, store)
    return {"rows": kept, "metrics": metrics, "features": stored, "quarantine": quarantine, "path": path, "table": table}
