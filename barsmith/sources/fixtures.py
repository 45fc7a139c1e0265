"""Daily bars derived from the TPC-H style ``lineitem`` table.

The test data holds no price table, so one is derived: one instrument per
supplier, one bar per ship date, the unit price of each line as a trade. An
invented 2:1 split on 1998-07-01 makes raw and adjusted columns differ.
The bars are a grouped aggregate by (ticker, day) of lines that were shuffled to their
ticker: whoever runs windows by ticker over them needs no other shuffle and no other sort.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.schema import BAR_COLUMNS

# The derivation's split date, split factor and ingest stamp.
SPLIT_DATE = _dt.date(1998, 7, 1)
SPLIT_FACTOR = 0.5
INGESTED_AT = "2024-01-01T00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars_from_lines(lines: DataFrame) -> DataFrame:
    """OHLCV bars (raw and split-adjusted) from lineitem rows, partitioned by ticker."""
    price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    # A bar has few lines, and a line is less than half of what a bar's aggregates take: lines are shuffled.
    placed = lines.select(
        F.col("l_suppkey").cast("string").alias("ticker"), F.to_date("l_shipdate").alias("date"),
        "l_extendedprice", "l_quantity", "l_orderkey", "l_linenumber", "l_partkey",
    ).repartition(F.col("ticker"))
    trades = placed.select(
        "ticker", "date", price.alias("price"), F.col("l_quantity").alias("qty"),
        # (orderkey, linenumber) alone repeats; partkey and price make it unique.
        F.struct("l_orderkey", "l_linenumber", "l_partkey", price.alias("p")).alias("seq"),
    )
    # The first and last trade hold their price: min_by and max_by would carry it once more.
    raw = trades.groupBy("ticker", "date").agg(
        F.min("seq")["p"].alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max("seq")["p"].alias("close"),
        F.sum("qty").cast("long").alias("volume"),
    )
    before = F.col("date") < F.lit(SPLIT_DATE)
    factor = F.when(before, F.lit(SPLIT_FACTOR)).otherwise(F.lit(1.0))
    return raw.select(
        "date", "ticker", "open", "high", "low", "close", "volume",
        *[(F.col(c) * factor).alias(f"adj_{c}") for c in ("open", "high", "low", "close")],
        F.when(before, F.col("volume") * F.lit(2)).otherwise(F.col("volume")).alias("adj_volume"),
        F.lit(INGESTED_AT).alias("ingested_at"),
    ).select(*BAR_COLUMNS)


def lineitem_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_lines(read_table(spark, sf_dir, "lineitem"))


# Seconds of the day are scaled by this factor and the order key added, giving one
# increasing number per (day, order); order keys stay far below it.
TICK_SCALE = 100_000_000


def skewed_ticks(lines: DataFrame, hot_share: int = 3) -> DataFrame:
    """A tick series in which one instrument holds about 1/hot_share of all rows.

    One bar per (supplier group, ship day, order), ordered by ``seq`` (ship day and
    order key in one increasing number). Suppliers with a key up to 1/hot_share of
    the largest key trade as ``HOT``; the others keep their own ticker. Used to
    measure a skewed key, not registered as a query.
    """
    max_key = lines.agg(F.max("l_suppkey")).first()[0]
    hot = F.col("l_suppkey") <= F.lit(max_key // hot_share)
    price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    day = F.unix_seconds(F.to_timestamp(F.to_date("l_shipdate")))
    trades = lines.select(
        F.when(hot, F.lit("HOT")).otherwise(F.col("l_suppkey").cast("string")).alias("ticker"),
        (day * F.lit(TICK_SCALE) + F.col("l_orderkey")).alias("seq"),
        price.alias("price"), F.col("l_quantity").alias("qty"),
        F.struct("l_linenumber", "l_partkey", price.alias("p")).alias("k"),
    )
    raw = trades.groupBy("ticker", "seq").agg(
        F.min_by("price", "k").alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", "k").alias("close"),
        F.sum("qty").cast("long").alias("volume"),
    )
    return raw.select(
        "seq", "ticker", "open", "high", "low", "close", "volume",
        *[F.col(c).alias(f"adj_{c}") for c in ("open", "high", "low", "close")],
        F.col("volume").alias("adj_volume"), F.lit(INGESTED_AT).alias("ingested_at"),
    )


def tick_day_bucket() -> Column:
    """Day bucket of ``skewed_ticks``'s ``seq``."""
    return F.expr(f"seq div {TICK_SCALE * 86_400}")
