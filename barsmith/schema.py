"""Column contracts for the bar tables.

Three shapes appear in the pipeline:

* ``VENDOR_SCHEMA``  – one element of the vendor's JSON payload (camelCase
  adjusted fields, ISO timestamp with offset in ``date``).
* ``RAW_SCHEMA``     – a staged NDJSON bar as the transform reads it (13 nullable
  fields, ``date`` as ``yyyy-MM-dd`` text).
* ``FEATURE_COLUMNS`` – the 54 columns ``build_features`` produces, and
  ``DECLARED_SCHEMA`` – the 41 typed fields of the warehouse table.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Vendor payload field names and types.
VENDOR_SCHEMA = StructType([
    StructField("date", StringType(), True),
    StructField("open", DoubleType(), True),
    StructField("high", DoubleType(), True),
    StructField("low", DoubleType(), True),
    StructField("close", DoubleType(), True),
    StructField("volume", LongType(), True),
    StructField("adjOpen", DoubleType(), True),
    StructField("adjHigh", DoubleType(), True),
    StructField("adjLow", DoubleType(), True),
    StructField("adjClose", DoubleType(), True),
    StructField("adjVolume", LongType(), True),
])

# Vendor camelCase -> snake_case renames.
VENDOR_RENAMES = {
    "adjClose": "adj_close",
    "adjHigh": "adj_high",
    "adjLow": "adj_low",
    "adjOpen": "adj_open",
    "adjVolume": "adj_volume",
}

# Staged raw bar fields, in file order.
RAW_SCHEMA = StructType([
    StructField("date", StringType(), True),
    StructField("ticker", StringType(), True),
    StructField("open", DoubleType(), True),
    StructField("high", DoubleType(), True),
    StructField("low", DoubleType(), True),
    StructField("close", DoubleType(), True),
    StructField("volume", LongType(), True),
    StructField("adj_open", DoubleType(), True),
    StructField("adj_high", DoubleType(), True),
    StructField("adj_low", DoubleType(), True),
    StructField("adj_close", DoubleType(), True),
    StructField("adj_volume", LongType(), True),
    StructField("ingested_at", StringType(), True),
])

BAR_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# In memory a bar carries a real date; text dates exist only in files.
BARS_SCHEMA = StructType(
    [StructField("date", DateType(), True)] + RAW_SCHEMA.fields[1:]
)

_D, _L, _I, _S, _T = DoubleType(), LongType(), IntegerType(), StringType(), DateType()

# The 54 output columns, in order, with their Spark types.
FEATURE_SCHEMA = StructType([StructField(n, t, True) for n, t in [
    ("date", _T), ("ticker", _S),
    ("open", _D), ("high", _D), ("low", _D), ("close", _D), ("volume", _L),
    ("adj_open", _D), ("adj_high", _D), ("adj_low", _D), ("adj_close", _D),
    ("adj_volume", _L), ("ingested_at", _S),
    ("sma_5", _D), ("sma_10", _D), ("sma_20", _D), ("sma_50", _D), ("sma_200", _D),
    ("ema_12", _D), ("ema_26", _D),
    ("bb_mid", _D), ("bb_std", _D), ("bb_upper", _D), ("bb_lower", _D),
    ("bb_pct_b", _D), ("bb_bandwidth", _D),
    ("rsi", _D),
    ("macd_line", _D), ("macd_signal", _D), ("macd_hist", _D),
    ("log_return", _D),
    ("vol_5d", _D), ("annualized_vol_5d", _D),
    ("vol_10d", _D), ("annualized_vol_10d", _D),
    ("vol_20d", _D), ("annualized_vol_20d", _D),
    ("vol_60d", _D), ("annualized_vol_60d", _D),
    ("atr_14", _D),
    ("obv", _L), ("vol_sma_20", _D), ("vol_std_20", _D), ("vol_zscore", _D),
    ("pct_from_52w_high", _D), ("pct_from_52w_low", _D),
    ("golden_cross", _I),
    ("momentum_20d", _D), ("momentum_60d", _D),
    ("processed_at", _S), ("pipeline_run", _S),
    ("date_ts", _T), ("year", _I), ("month", _I),
]])

FEATURE_COLUMNS = [f.name for f in FEATURE_SCHEMA.fields]

# The 41 declared warehouse fields (date and ticker required;
# obv is declared as a float there).
DECLARED_SCHEMA = StructType([
    StructField("date", _T, False),
    StructField("ticker", _S, False),
] + [StructField(n, t, True) for n, t in [
    ("open", _D), ("high", _D), ("low", _D), ("close", _D), ("volume", _L),
    ("adj_close", _D), ("adj_volume", _L),
    ("sma_5", _D), ("sma_10", _D), ("sma_20", _D), ("sma_50", _D), ("sma_200", _D),
    ("ema_12", _D), ("ema_26", _D),
    ("bb_upper", _D), ("bb_mid", _D), ("bb_lower", _D), ("bb_pct_b", _D),
    ("bb_bandwidth", _D),
    ("rsi", _D), ("macd_line", _D), ("macd_signal", _D), ("macd_hist", _D),
    ("log_return", _D), ("vol_20d", _D), ("annualized_vol_20d", _D), ("atr_14", _D),
    ("obv", _D), ("vol_zscore", _D),
    ("pct_from_52w_high", _D), ("pct_from_52w_low", _D),
    ("golden_cross", _L),
    ("momentum_20d", _D), ("momentum_60d", _D),
    ("processed_at", _S), ("pipeline_run", _S),
    ("date_ts", _T), ("year", _L), ("month", _L),
]])

DECLARED_COLUMNS = [f.name for f in DECLARED_SCHEMA.fields]
