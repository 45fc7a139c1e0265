"""Scalar column expressions shared by the operators and views.

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen. Divisions go through ``try_divide``: Spark 4 runs with ANSI mode on, where
``x / 0.0`` raises instead of returning null.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The denominator guard and the annualisation factor.
EPS = 1e-10
SQRT_252 = 252 ** 0.5

# Label thresholds (inclusive where the spec says >= / <=).
RSI_LEVELS = {"extreme_high": 80.0, "high": 70.0, "extreme_low": 20.0, "low": 30.0}
MOMENTUM_LEVELS = {"strong_buy": 0.8, "buy": 0.6, "strong_sell": 0.2, "sell": 0.4}
MOMENTUM_WEIGHTS = {"m20": 0.4, "m60": 0.6}


def col_or_lit(value) -> Column:
    """A column, a column name, or a literal (dates and strings become literals)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.date, _dt.datetime, int, float)):
        return F.lit(value)
    return F.lit(value)


def safe_ratio(num, den) -> Column:
    """num / den, null when den is 0 or null (SAFE_DIVIDE)."""
    return F.try_divide(num, den)


def rel_change(x, base) -> Column:
    """(x - base) / (base + EPS): the guarded relative distance used throughout."""
    return F.try_divide(x - base, base + F.lit(EPS))


def rsi_label(rsi: Column) -> Column:
    lv = RSI_LEVELS
    return (
        F.when(rsi >= lv["extreme_high"], "EXTREMELY_OVERBOUGHT")
        .when(rsi >= lv["high"], "OVERBOUGHT")
        .when(rsi <= lv["extreme_low"], "EXTREMELY_OVERSOLD")
        .when(rsi <= lv["low"], "OVERSOLD")
        .otherwise("NEUTRAL")
    )


def momentum_label(score: Column) -> Column:
    lv = MOMENTUM_LEVELS
    return (
        F.when(score >= lv["strong_buy"], "STRONG_BUY")
        .when(score >= lv["buy"], "BUY")
        .when(score <= lv["strong_sell"], "STRONG_SELL")
        .when(score <= lv["sell"], "SELL")
        .otherwise("NEUTRAL")
    )


def macd_cross_label(hist: Column, prev_hist: Column) -> Column:
    """A crossing of the MACD histogram through zero between two rows."""
    return (
        F.when((hist > 0) & (prev_hist <= 0), "BULLISH_CROSSOVER")
        .when((hist < 0) & (prev_hist >= 0), "BEARISH_CROSSOVER")
        .otherwise("NO_CROSSOVER")
    )


def vol_regime_label(vol: Column, mean: Column, std: Column) -> Column:
    """Strict thresholds; a null vol or std falls through to NORMAL."""
    return (
        F.when(vol > mean + 2 * std, "CRISIS")
        .when(vol > mean + 1 * std, "HIGH")
        .when(vol < mean - 1 * std, "LOW")
        .otherwise("NORMAL")
    )
