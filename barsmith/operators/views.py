"""Analytics views over the feature table, and the documented consumer queries.

Each view is a function ``features -> DataFrame``; ``register_views`` publishes
them as temporary views in dependency order (the momentum view reads the snapshot
view). Date windows take an explicit ``as_of`` date; by default it is the newest
date in the table, so a result never depends on the clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.functions.columns import (
    MOMENTUM_WEIGHTS,
    macd_cross_label,
    momentum_label,
    rsi_label,
    safe_ratio,
    vol_regime_label,
)
from barsmith.plans.rank import percent_ranks
from barsmith.plans.series import neighbour

# View column lists, in output order.
SNAPSHOT_COLUMNS = [
    "ticker", "date", "adj_close", "adj_volume", "rsi", "macd_line", "macd_hist",
    "sma_20", "sma_50", "sma_200", "bb_pct_b", "vol_20d", "annualized_vol_20d",
    "momentum_20d", "momentum_60d", "golden_cross", "pct_from_52w_high",
    "pct_from_52w_low", "vol_zscore", "atr_14",
]
MOMENTUM_COLUMNS = [
    "ticker", "date", "adj_close", "momentum_20d", "momentum_60d", "rsi", "vol_20d",
    "momentum_20d_pctrank", "momentum_60d_pctrank", "vol_pctrank",
    "composite_momentum_score", "momentum_signal",
]
RSI_COLUMNS = [
    "ticker", "date", "adj_close", "rsi", "rsi_signal", "macd_line", "macd_hist", "macd_signal",
]
REGIME_COLUMNS = [
    "ticker", "date", "adj_close", "annualized_vol_20d", "atr_14", "mean_vol", "std_vol",
    "vol_z_score", "vol_regime",
]
ML_COLUMNS = [
    "ticker", "date", "label_next_day_up", "label_next_day_return", "adj_close",
    "log_return", "momentum_20d", "momentum_60d", "pct_from_52w_high", "pct_from_52w_low",
    "price_to_sma20", "price_to_sma50", "price_to_sma200", "sma50_to_sma200",
    "rsi", "macd_line", "macd_hist", "bb_pct_b", "bb_bandwidth",
    "vol_20d", "annualized_vol_20d", "atr_14", "vol_zscore", "obv", "golden_cross",
    "year", "month",
]
AUDIT_COLUMNS = [
    "pipeline_run", "tickers_loaded", "total_rows", "earliest_date", "latest_date",
    "null_rsi_count", "null_sma200_count", "invalid_price_count", "last_processed_at",
]

RSI_DAYS = 90
REGIME_DAYS = 365
ML_RECENT_DAYS = 365


def resolve_as_of(features: DataFrame, as_of=None, order: str = "date") -> _dt.date:
    """``as_of`` as a date; by default the newest date in ``features`` (one small job)."""
    if as_of is None:
        as_of = features.agg(F.max(order)).first()[0]
        if as_of is None:
            raise ValueError("empty feature table: no as_of date")
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of)[:10])


def _since(df: DataFrame, as_of: _dt.date, days: int, order: str = "date") -> Column:
    """``order >= as_of - days`` as a literal bound, so it reaches the Parquet scan.

    The feature table is partitioned by ``year`` (= year(date)); the implied
    ``year >= year(start)`` is added so that whole year directories are skipped.
    """
    start = as_of - _dt.timedelta(days=days)
    cond = F.col(order) >= F.lit(start)
    if "year" in df.columns:
        cond = cond & (F.col("year") >= F.lit(start.year))
    return cond


def _named(columns: list[str], key: str, order: str) -> list[str]:
    """The view's columns, with the series' own key and order columns in their places."""
    return [{"ticker": key, "date": order}.get(c, c) for c in columns]


def latest_snapshot(features: DataFrame, key: str = "ticker", order: str = "date") -> DataFrame:
    """Newest row per instrument. Top-1 per group: Spark keeps one row per key in
    each partition before the shuffle (WindowGroupLimit), so a large key costs a
    partial sort, not a shuffle of its whole history."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return (
        features.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .select(*_named(SNAPSHOT_COLUMNS, key, order))
    )


def cross_sectional_momentum(features: DataFrame, *, best_is_high: bool = False,
                             key: str = "ticker", order: str = "date") -> DataFrame:
    """Percent ranks of the latest rows; composite = 0.4 p20 + 0.6 p60.

    As specified, momentum ranks run in *descending* order, so the strongest
    instrument gets rank 0 and the label STRONG_SELL. ``best_is_high=True`` ranks
    ascending instead. Null momentum sorts last when descending (first ascending);
    null volatility sorts first.
    """
    latest = latest_snapshot(features, key, order)
    desc = not best_is_high
    ranked = percent_ranks(latest, {
        "momentum_20d_pctrank": ("momentum_20d", desc, desc),
        "momentum_60d_pctrank": ("momentum_60d", desc, desc),
        "vol_pctrank": ("annualized_vol_20d", False, False),
    }, by=[key])
    score = (F.lit(MOMENTUM_WEIGHTS["m20"]) * F.col("momentum_20d_pctrank")
             + F.lit(MOMENTUM_WEIGHTS["m60"]) * F.col("momentum_60d_pctrank"))
    return (
        ranked.withColumn("composite_momentum_score", score)
        .withColumn("momentum_signal", momentum_label(F.col("composite_momentum_score")))
        .select(*_named(MOMENTUM_COLUMNS, key, order))
        .orderBy(F.col("composite_momentum_score").desc())
    )


def rsi_signals(features: DataFrame, as_of=None, *, days: int = RSI_DAYS,
                key: str = "ticker", order: str = "date") -> DataFrame:
    """RSI labels and MACD crossovers over the last ``days`` days.

    The date filter runs first and the previous histogram value is taken inside
    the filtered rows, so each instrument's first row in range is NO_CROSSOVER.
    """
    as_of = resolve_as_of(features, as_of, order)
    recent = features.filter(_since(features, as_of, days, order)).select(
        key, order, "adj_close", "rsi", "macd_line", "macd_hist"
    )
    prev = neighbour(recent, {"_prev_hist": "macd_hist"}, key=key, order=order, direction=-1)
    return prev.select(
        key, order, "adj_close", "rsi",
        rsi_label(F.col("rsi")).alias("rsi_signal"),
        "macd_line", "macd_hist",
        macd_cross_label(F.col("macd_hist"), F.col("_prev_hist")).alias("macd_signal"),
    )


def volatility_regime(features: DataFrame, as_of=None, *, days: int = REGIME_DAYS,
                      key: str = "ticker", order: str = "date", expanding: bool = False,
                      chunked: bool | None = None) -> DataFrame:
    """Regime of annualised 20-day vol against the instrument's full-history mean/std.

    The statistics are a per-instrument aggregate (partial aggregation, one row per
    instrument); the join back is left to AQE, which broadcasts the statistics when
    their measured size allows and otherwise splits a hot instrument's partition.

    The full history looks ahead: a row is judged by values that came after it. With ``expanding``
    a row is judged by the rows up to and including itself, as it could have been on
    that day; the moments are a prefix scan (:mod:`barsmith.plans.scan`).
    """
    as_of = resolve_as_of(features, as_of, order)
    v = "annualized_vol_20d"
    if expanding:
        from barsmith.operators.running import expanding_moments

        narrow = features.select(key, order, "adj_close", v, "atr_14")
        judged = expanding_moments(narrow, v, mean="mean_vol", std="std_vol", key=key, order=order, chunked=chunked,
                                   block_rows=512 if chunked else None)
        joined = judged.filter(_since(judged, as_of, days, order))
    else:
        stats = features.groupBy(key).agg(
            F.avg(v).alias("mean_vol"), F.stddev_samp(v).alias("std_vol")
        )
        recent = features.filter(_since(features, as_of, days, order)).select(
            key, order, "adj_close", v, "atr_14"
        )
        joined = recent.join(stats, key)
    x, mean, std = F.col(v), F.col("mean_vol"), F.col("std_vol")
    return joined.select(
        key, order, "adj_close", v, "atr_14", "mean_vol", "std_vol",
        safe_ratio(x - mean, std).alias("vol_z_score"),
        vol_regime_label(x, mean, std).alias("vol_regime"),
    )


def ml_feature_set(features: DataFrame, key: str = "ticker", order: str = "date") -> DataFrame:
    """Feature matrix with the next row's close as label; rows without one dropped.

    The label looks forward only, so rows before a date can be filtered out of
    ``features`` first: the rows after it come out the same."""
    base = neighbour(features, {"next_close": "adj_close"}, key=key, order=order, direction=1)
    x, nxt = F.col("adj_close"), F.col("next_close")
    out = base.filter(
        nxt.isNotNull() & F.col("rsi").isNotNull() & F.col("sma_200").isNotNull()
    )
    return out.select(
        key, order,
        F.when(nxt > x, F.lit(1)).otherwise(F.lit(0)).alias("label_next_day_up"),
        safe_ratio(nxt - x, x).alias("label_next_day_return"),
        "adj_close", "log_return", "momentum_20d", "momentum_60d",
        "pct_from_52w_high", "pct_from_52w_low",
        (safe_ratio(x, F.col("sma_20")) - 1).alias("price_to_sma20"),
        (safe_ratio(x, F.col("sma_50")) - 1).alias("price_to_sma50"),
        (safe_ratio(x, F.col("sma_200")) - 1).alias("price_to_sma200"),
        (safe_ratio(F.col("sma_50"), F.col("sma_200")) - 1).alias("sma50_to_sma200"),
        "rsi", "macd_line", "macd_hist", "bb_pct_b", "bb_bandwidth",
        "vol_20d", "annualized_vol_20d", "atr_14", "vol_zscore", "obv", "golden_cross",
        "year", "month",
    )


def pipeline_audit(features: DataFrame, key: str = "ticker", order: str = "date") -> DataFrame:
    """Row counts and data-quality counters per pipeline run, newest run first."""
    return (
        features.groupBy("pipeline_run")
        .agg(
            F.countDistinct(key).alias("tickers_loaded"),
            F.count(F.lit(1)).alias("total_rows"),
            F.min(order).alias("earliest_date"),
            F.max(order).alias("latest_date"),
            F.count_if(F.col("rsi").isNull()).alias("null_rsi_count"),
            F.count_if(F.col("sma_200").isNull()).alias("null_sma200_count"),
            F.count_if(F.col("adj_close") <= 0).alias("invalid_price_count"),
            F.max("processed_at").alias("last_processed_at"),
        )
        .orderBy(F.col("pipeline_run").desc())
    )


# ---------------------------------------------------------------- consumer queries
def momentum_board(momentum: DataFrame) -> DataFrame:
    return momentum.select("ticker", "momentum_signal", "composite_momentum_score").orderBy(
        F.col("composite_momentum_score").desc()
    )


def rsi_extremes(signals: DataFrame) -> DataFrame:
    return signals.filter(F.col("rsi_signal").isin("OVERBOUGHT", "OVERSOLD")).select(
        "ticker", "rsi", "rsi_signal", "macd_signal"
    )


def ml_recent(ml: DataFrame, as_of, *, days: int = ML_RECENT_DAYS) -> DataFrame:
    return ml.filter(_since(ml, resolve_as_of(ml, as_of), days))


def recent_ml_feature_set(features: DataFrame, as_of=None, *, days: int = ML_RECENT_DAYS) -> DataFrame:
    """``ml_recent`` of the whole matrix, from the feature table: the date filter runs below
    the label's window, so it prunes the scan."""
    return ml_feature_set(features.filter(_since(features, resolve_as_of(features, as_of), days)))


def audit_recent(audit: DataFrame, n: int = 10) -> DataFrame:
    return audit.select(
        "pipeline_run", "tickers_loaded", "total_rows", "invalid_price_count"
    ).orderBy(F.col("pipeline_run").desc()).limit(n)


def register_views(features: DataFrame, as_of=None, prefix: str = "vw_") -> dict:
    """Create the six views as temporary views, in dependency order."""
    as_of = resolve_as_of(features, as_of)
    features.createOrReplaceTempView("stock_features")
    views = {
        "latest_snapshot": latest_snapshot(features),
        "cross_sectional_momentum": cross_sectional_momentum(features),
        "rsi_signals": rsi_signals(features, as_of),
        "volatility_regime": volatility_regime(features, as_of),
        "ml_feature_set": ml_feature_set(features),
        "pipeline_audit": pipeline_audit(features),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return views
