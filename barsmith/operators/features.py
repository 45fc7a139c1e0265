"""Per-instrument technical features (moving averages, bands, RSI, MACD, ...).

Every operator is ``DataFrame -> DataFrame`` and takes an optional
:class:`~barsmith.plans.series.Series` that says which window to use. Without one
it uses the plain ``partitionBy(key).orderBy(order)`` window, exactly as the
formulas are specified; :func:`build_features` (and the ``*_features`` wrappers in
:mod:`barsmith.plans.job`) run the same formulas over a chunked series, which
keeps a large instrument from landing in a single task.

Semantics kept on purpose (see README):

* frames are ROWS frames and warm-up frames are partial, so averages are never null
  on the first rows; sample standard deviations are null on a 1-row frame;
* the two "EMA" columns are simple means over 12 and 26 rows;
* RSI is 100 whenever the average loss is exactly 0 (including the first row);
* ATR mixes raw high/low with the previous *adjusted* close (``adjusted=False``);
* ``+1e-10`` in denominators, which gives large finite values on a zero base.

With ``Series(min_periods=True)`` (``min_periods=True`` in the plans) a rolling
statistic over n rows is null until the row's frame holds n rows, like pandas
``rolling(n)``; the default keeps partial frames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from barsmith.functions.columns import EPS, SQRT_252, col_or_lit, rel_change
from barsmith.plans.series import BLOCK, Series

# Window lengths, in rows.
SMA_SPANS = (5, 10, 20, 50, 200)
EMA_SPANS = (12, 26)
BB_SPAN = 20
BB_WIDTH = 2
RSI_PERIOD = 14
MACD_SIGNAL_SPAN = 9
VOL_SPANS = (5, 10, 20, 60)
ATR_SPAN = 14
VOLUME_SPAN = 20
RANGE_SPAN = 252
MOMENTUM_LAGS = (20, 60)

# How far back (in rows, beyond the current one) each operator reads.
LOOKBACK = {
    "sma": max(SMA_SPANS) - 1,
    "ema": max(EMA_SPANS) - 1,
    "bollinger": BB_SPAN - 1,
    "rsi": RSI_PERIOD,
    "macd": max(EMA_SPANS) - 1 + MACD_SIGNAL_SPAN - 1,
    "log_return": 1,
    "volatility": 1 + max(VOL_SPANS) - 1,
    "atr": 1 + ATR_SPAN - 1,
    "obv": 1,
    "volume_zscore": VOLUME_SPAN - 1,
    "range_52w": RANGE_SPAN - 1,
    "golden_cross": max(SMA_SPANS) - 1,
    "momentum": max(MOMENTUM_LAGS),
}
LOOKBACK["all"] = max(LOOKBACK.values())

PRICE = "adj_close"


def _s(s: Series | None) -> Series:
    return s if s is not None else Series.plain()


# ---------------------------------------------------------------- formulas
def _bb_upper(mid: Column, std: Column) -> Column:
    return mid + BB_WIDTH * std


def _bb_lower(mid: Column, std: Column) -> Column:
    return mid - BB_WIDTH * std


def _bb_pct_b(x: Column, upper: Column, lower: Column) -> Column:
    return F.try_divide(x - lower, upper - lower + F.lit(EPS))


def _bb_bandwidth(mid: Column, upper: Column, lower: Column) -> Column:
    return F.try_divide(upper - lower, mid + F.lit(EPS))


def _gain(x: Column, prev: Column) -> Column:
    delta = x - prev
    return F.when(delta > 0, delta).otherwise(F.lit(0.0))


def _loss(x: Column, prev: Column) -> Column:
    delta = x - prev
    return F.when(delta < 0, -delta).otherwise(F.lit(0.0))


def _rsi(avg_gain: Column, avg_loss: Column) -> Column:
    rs = F.try_divide(avg_gain, avg_loss + F.lit(EPS))
    return F.when(avg_loss == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) - F.try_divide(F.lit(100.0), F.lit(1.0) + rs)
    )


def _log_return(x: Column, prev: Column) -> Column:
    # log() of a non-positive ratio is null in Spark.
    return F.log(F.try_divide(x, prev + F.lit(EPS)))


def _true_range(high: Column, low: Column, prev: Column) -> Column:
    # greatest() skips nulls, so the first row's range is high - low.
    return F.greatest(high - low, F.abs(high - prev), F.abs(low - prev))


def _obv_delta(x: Column, prev: Column, volume: Column) -> Column:
    return F.when(x > prev, volume).when(x < prev, -volume).otherwise(F.lit(0))


def _zscore(v: Column, mean: Column, std: Column) -> Column:
    return F.try_divide(v - mean, std + F.lit(EPS))


def _golden_cross(fast: Column, slow: Column) -> Column:
    return F.when(fast > slow, F.lit(1)).otherwise(F.lit(0))


# ---------------------------------------------------------------- long frames
def _piecewise(df: DataFrame, column: str, n: int) -> bool:
    """Whether a trailing mean of n rows is put together from pieces: frames of two blocks and
    more, of doubles (the means of other types follow Spark's own rules)."""
    return n > 2 * BLOCK and df.schema[column].dataType == DoubleType()


def _mean_pieces(s: Series, column: str, spans) -> dict:
    out = {"_seen": F.count(column).over(s.cumulative())}
    for n in spans:
        out |= s.pieces("sum", F.sum, column, n)
    return out


def _pieced_mean(s: Series, n: int) -> Column:
    """Mean over the trailing n rows, from ``_mean_pieces``: only sums of whole pieces are added,
    so nothing of a value stays once it has left the frame."""
    seen = F.col("_seen") - F.coalesce(F.lag("_seen", n).over(s.ordered()), F.lit(0))
    total = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in s.pieced("sum", n)])
    return F.when(seen >= F.lit(n if s.min_periods else 1), F.try_divide(total, seen.cast("double")))


def _extreme_pieces(s: Series, column: str) -> dict:
    out = s.pieces("max", F.max, column, RANGE_SPAN) | s.pieces("min", F.min, column, RANGE_SPAN)
    return out | {"_seen": F.count(column).over(s.cumulative())} if s.min_periods else out


def _pieced_extremes(s: Series) -> tuple[Column, Column]:
    """(largest, smallest) over the trailing RANGE_SPAN rows, from ``_extreme_pieces``; greatest()
    and least() skip nulls and order NaN as max() and min() do."""
    both = F.greatest(*s.pieced("max", RANGE_SPAN)), F.least(*s.pieced("min", RANGE_SPAN))
    if not s.min_periods:
        return both
    seen = F.col("_seen") - F.coalesce(F.lag("_seen", RANGE_SPAN).over(s.ordered()), F.lit(0))
    return tuple(F.when(seen >= F.lit(RANGE_SPAN), c) for c in both)


# ---------------------------------------------------------------- operators
def add_moving_averages(df: DataFrame, s: Series | None = None, price: str = PRICE) -> DataFrame:
    """sma_5/10/20/50/200: mean of ``price`` over the trailing n rows."""
    s = _s(s)
    long = [n for n in SMA_SPANS if _piecewise(df, price, n)]
    helpers = _mean_pieces(s, price, long) if long else {}
    df = df.withColumns({f"sma_{n}": s.roll(F.avg, price, n) for n in SMA_SPANS if n not in long} | helpers)
    return df.withColumns({f"sma_{n}": _pieced_mean(s, n) for n in long}).drop(*helpers)


def add_ema(df: DataFrame, s: Series | None = None, price: str = PRICE) -> DataFrame:
    """ema_12/26 as specified: a *simple* mean over 12 and 26 rows."""
    s = _s(s)
    return df.withColumns({f"ema_{n}": s.roll(F.avg, price, n) for n in EMA_SPANS})


def add_bollinger_bands(df: DataFrame, s: Series | None = None, price: str = PRICE) -> DataFrame:
    s = _s(s)
    df = df.withColumns({"bb_mid": s.roll(F.avg, price, BB_SPAN),
                         "bb_std": s.roll(F.stddev_samp, price, BB_SPAN)})
    mid, std = F.col("bb_mid"), F.col("bb_std")
    df = df.withColumns({"bb_upper": _bb_upper(mid, std), "bb_lower": _bb_lower(mid, std)})
    up, lo = F.col("bb_upper"), F.col("bb_lower")
    return df.withColumns({
        "bb_pct_b": _bb_pct_b(F.col(price), up, lo),
        "bb_bandwidth": _bb_bandwidth(mid, up, lo),
    })


def add_rsi(df: DataFrame, s: Series | None = None, price: str = PRICE,
            period: int = RSI_PERIOD) -> DataFrame:
    s = _s(s)
    x = F.col(price)
    df = df.withColumn("_prev", F.lag(price, 1).over(s.ordered()))
    df = df.withColumns({"_gain": _gain(x, F.col("_prev")), "_loss": _loss(x, F.col("_prev"))})
    df = df.withColumns({"_avg_gain": s.roll(F.avg, "_gain", period),
                         "_avg_loss": s.roll(F.avg, "_loss", period)})
    df = df.withColumn("rsi", _rsi(F.col("_avg_gain"), F.col("_avg_loss")))
    return df.drop("_prev", "_gain", "_loss", "_avg_gain", "_avg_loss")


def add_macd(df: DataFrame, s: Series | None = None, price: str = PRICE) -> DataFrame:
    """macd_line = ema_12 - ema_26; signal = 9-row mean of the line (adds ema_* if absent)."""
    s = _s(s)
    if not {"ema_12", "ema_26"} <= set(df.columns):
        df = add_ema(df, s, price)
    df = df.withColumn("macd_line", F.col("ema_12") - F.col("ema_26"))
    df = df.withColumn("macd_signal", s.roll(F.avg, "macd_line", MACD_SIGNAL_SPAN))
    return df.withColumn("macd_hist", F.col("macd_line") - F.col("macd_signal"))


def add_log_return(df: DataFrame, s: Series | None = None, price: str = PRICE) -> DataFrame:
    s = _s(s)
    prev = F.lag(price, 1).over(s.ordered())
    return df.withColumn("log_return", _log_return(F.col(price), prev))


def add_volatility(df: DataFrame, s: Series | None = None, price: str = PRICE) -> DataFrame:
    """vol_nd = sample stddev of log_return over n rows; annualized = x sqrt(252)."""
    s = _s(s)
    if "log_return" not in df.columns:
        df = add_log_return(df, s, price)
    df = df.withColumns(
        {f"vol_{n}d": s.roll(F.stddev_samp, "log_return", n) for n in VOL_SPANS}
    )
    return df.withColumns(
        {f"annualized_vol_{n}d": F.col(f"vol_{n}d") * F.lit(SQRT_252) for n in VOL_SPANS}
    )


def add_atr(df: DataFrame, s: Series | None = None, price: str = PRICE,
            adjusted: bool = False) -> DataFrame:
    """atr_14: mean true range. ``adjusted=True`` uses adj_high/adj_low instead of raw."""
    s = _s(s)
    hi, lo = ("adj_high", "adj_low") if adjusted else ("high", "low")
    prev = F.lag(price, 1).over(s.ordered())
    df = df.withColumn("_tr", _true_range(F.col(hi), F.col(lo), prev))
    return df.withColumn("atr_14", s.roll(F.avg, "_tr", ATR_SPAN)).drop("_tr")


def add_obv(df: DataFrame, s: Series | None = None, price: str = PRICE,
            volume: str = "adj_volume") -> DataFrame:
    """On-balance volume: running sum of +-volume by the sign of the price change."""
    s = _s(s)
    prev = F.lag(price, 1).over(s.ordered())
    df = df.withColumn("_obv_delta", _obv_delta(F.col(price), prev, F.col(volume)))
    df = df.withColumn("obv", s.running_sum("_obv_delta", "obv"))
    return df if s.chunked else df.drop("_obv_delta")


def add_volume_zscore(df: DataFrame, s: Series | None = None,
                      volume: str = "adj_volume") -> DataFrame:
    s = _s(s)
    df = df.withColumns({
        "vol_sma_20": s.roll(F.avg, volume, VOLUME_SPAN),
        "vol_std_20": s.roll(F.stddev_samp, volume, VOLUME_SPAN),
    })
    return df.withColumn(
        "vol_zscore", _zscore(F.col(volume), F.col("vol_sma_20"), F.col("vol_std_20"))
    )


def add_range_52w(df: DataFrame, s: Series | None = None, price: str = PRICE) -> DataFrame:
    """Distance from the max / min of ``price`` over the trailing 252 rows."""
    s = _s(s)
    x = F.col(price)
    helpers = _extreme_pieces(s, price)
    df = df.withColumns(helpers)
    high, low = _pieced_extremes(s)
    df = df.withColumns({"_hi52": high, "_lo52": low})
    return df.withColumns({
        "pct_from_52w_high": rel_change(x, F.col("_hi52")),
        "pct_from_52w_low": rel_change(x, F.col("_lo52")),
    }).drop("_hi52", "_lo52", *helpers)


def add_golden_cross(df: DataFrame, s: Series | None = None, price: str = PRICE) -> DataFrame:
    """1 while sma_50 > sma_200 (a state, not a crossing event); adds the SMAs if absent."""
    if not {"sma_50", "sma_200"} <= set(df.columns):
        df = add_moving_averages(df, s, price)
    return df.withColumn("golden_cross", _golden_cross(F.col("sma_50"), F.col("sma_200")))


def add_momentum(df: DataFrame, s: Series | None = None, price: str = PRICE) -> DataFrame:
    s = _s(s)
    x = F.col(price)
    return df.withColumns({
        f"momentum_{n}d": rel_change(x, F.lag(price, n).over(s.ordered())) for n in MOMENTUM_LAGS
    })


def add_metadata(df: DataFrame, run_date, processed_at, order: str = "date") -> DataFrame:
    """processed_at / pipeline_run stamps (values or columns) and date_ts, year, month."""
    dtype = df.schema[order].dataType.simpleString()
    if dtype == "date":
        d = F.col(order)
    elif dtype.startswith("timestamp"):
        d = F.to_date(F.col(order))
    else:
        d = F.try_to_date(F.col(order), "yyyy-MM-dd")
    df = df.withColumns({
        "processed_at": col_or_lit(processed_at).cast("string"),
        "pipeline_run": col_or_lit(run_date).cast("string"),
        "date_ts": d,
    })
    return df.withColumns({"year": F.year("date_ts"), "month": F.month("date_ts")})


# ---------------------------------------------------------------- all at once
def build_features(df: DataFrame, s: Series | None = None, price: str = PRICE,
                   adjusted_atr: bool = False, volume: str = "adj_volume") -> DataFrame:
    """All indicators in two window levels over one shared partitioning.

    Level 1 windows read only bar columns; level 2 windows read level-1 results
    (gain/loss, the MACD line, log returns, true range, OBV deltas, and the pieces that
    the frames of 50, 200 and 252 rows are put together from). Both levels use
    the same partition and order, so one exchange and one sort serve them all.
    Metadata columns are not added here (see :func:`add_metadata`).
    """
    s = _s(s)
    x = F.col(price)
    w = s.ordered()
    hi, lo = ("adj_high", "adj_low") if adjusted_atr else ("high", "low")
    long = [n for n in SMA_SPANS if _piecewise(df, price, n)]
    pieces = _extreme_pieces(s, price) | (_mean_pieces(s, price, long) if long else {})
    level1 = {f"sma_{n}": s.roll(F.avg, price, n) for n in SMA_SPANS if n not in long} | pieces
    level1.update({f"ema_{n}": s.roll(F.avg, price, n) for n in EMA_SPANS})
    level1.update({
        "bb_mid": s.roll(F.avg, price, BB_SPAN),
        "bb_std": s.roll(F.stddev_samp, price, BB_SPAN),
        "_prev": F.lag(price, 1).over(w),
        "vol_sma_20": s.roll(F.avg, volume, VOLUME_SPAN),
        "vol_std_20": s.roll(F.stddev_samp, volume, VOLUME_SPAN),
    })
    level1.update({f"_lag{n}": F.lag(price, n).over(w) for n in MOMENTUM_LAGS})
    df = df.withColumns(level1)

    prev, mid, std = F.col("_prev"), F.col("bb_mid"), F.col("bb_std")
    df = df.withColumns({"bb_upper": _bb_upper(mid, std), "bb_lower": _bb_lower(mid, std)})
    up, low = F.col("bb_upper"), F.col("bb_lower")
    derived = {
        "bb_pct_b": _bb_pct_b(x, up, low),
        "bb_bandwidth": _bb_bandwidth(mid, up, low),
        "_gain": _gain(x, prev),
        "_loss": _loss(x, prev),
        "macd_line": F.col("ema_12") - F.col("ema_26"),
        "log_return": _log_return(x, prev),
        "_tr": _true_range(F.col(hi), F.col(lo), prev),
        "_obv_delta": _obv_delta(x, prev, F.col(volume)),
        "vol_zscore": _zscore(F.col(volume), F.col("vol_sma_20"), F.col("vol_std_20")),
    }
    derived.update({f"momentum_{n}d": rel_change(x, F.col(f"_lag{n}")) for n in MOMENTUM_LAGS})
    df = df.withColumns(derived)

    high, low = _pieced_extremes(s)
    level2 = {
        **{f"sma_{n}": _pieced_mean(s, n) for n in long},
        "_hi52": high,
        "_lo52": low,
        "_avg_gain": s.roll(F.avg, "_gain", RSI_PERIOD),
        "_avg_loss": s.roll(F.avg, "_loss", RSI_PERIOD),
        "macd_signal": s.roll(F.avg, "macd_line", MACD_SIGNAL_SPAN),
        "atr_14": s.roll(F.avg, "_tr", ATR_SPAN),
        "obv": s.running_sum("_obv_delta", "obv"),
    }
    level2.update(
        {f"vol_{n}d": s.roll(F.stddev_samp, "log_return", n) for n in VOL_SPANS}
    )
    df = df.withColumns(level2)
    df = df.withColumns({
        "pct_from_52w_high": rel_change(x, F.col("_hi52")),
        "pct_from_52w_low": rel_change(x, F.col("_lo52")),
        "golden_cross": _golden_cross(F.col("sma_50"), F.col("sma_200")),
        "rsi": _rsi(F.col("_avg_gain"), F.col("_avg_loss")),
        "macd_hist": F.col("macd_line") - F.col("macd_signal"),
        **{f"annualized_vol_{n}d": F.col(f"vol_{n}d") * F.lit(SQRT_252) for n in VOL_SPANS},
    })
    helpers = ["_prev", "_hi52", "_lo52", "_gain", "_loss", "_tr", "_avg_gain", "_avg_loss", *pieces]
    helpers += [f"_lag{n}" for n in MOMENTUM_LAGS]
    if not s.chunked:
        helpers.append("_obv_delta")
    return df.drop(*helpers)
