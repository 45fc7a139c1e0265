"""Vendor payloads -> normalised raw bars (ingestion without the HTTP client).

The vendor answers one request per instrument with a JSON array of daily bars.
Here the responses are files on shared storage, one directory per instrument
(``<root>/ticker=<T>/...``) or one file per instrument (``<root>/<T>.json``);
both JSON arrays (``multi_line=True``) and one object per line are read. All
instruments are read as one DataFrame; there is no per-instrument loop.
"""

from __future__ import annotations

import datetime as _dt
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from barsmith.schema import BAR_COLUMNS, VENDOR_RENAMES, VENDOR_SCHEMA

# The default universe of instruments and the default lookback.
DEFAULT_TICKERS = [
    "AAPL", "MSFT", "GOOGL", "AMZN", "NVDA", "META",
    "JPM", "GS", "BAC",
    "SPY", "QQQ", "IWM",
    "TSLA", "NFLX", "AMD",
    "NDAQ",
]
LOOKBACK_DAYS = 365



def read_payloads(spark: SparkSession, root: str, *, multi_line: bool = False) -> DataFrame:
    """Vendor records with a ``ticker`` taken from the directory or file name."""
    schema = StructType(VENDOR_SCHEMA.fields + [StructField("ticker", StringType(), True)])
    df = (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .json(root)
    )
    from_name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+?)\.json$", 1)
    return df.withColumn(
        "ticker",
        F.coalesce(F.col("ticker"), F.when(from_name != "", from_name)),
    )


def iso_to_date_text(c: Column) -> Column:
    """Calendar date of an ISO timestamp as written (its own offset), as yyyy-MM-dd."""
    d = F.coalesce(
        F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"),
        F.to_date(F.try_to_timestamp(c)),
    )
    return F.date_format(d, "yyyy-MM-dd")


def normalize(payload: DataFrame, ingested_at: str | Column) -> DataFrame:
    """Upper-case ticker, yyyy-MM-dd date, snake_case adjusted fields, ingest stamp."""
    df = payload.withColumnsRenamed(VENDOR_RENAMES)
    df = df.withColumns({
        "ticker": F.upper(F.col("ticker")),
        "date": iso_to_date_text(F.col("date")),
        "ingested_at": ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at),
    })
    return df.select(*BAR_COLUMNS)


def request_window(end: _dt.date, lookback_days: int = LOOKBACK_DAYS) -> tuple[_dt.date, _dt.date]:
    return end - _dt.timedelta(days=lookback_days), end


def in_window(bars: DataFrame, start, end, order: str = "date") -> DataFrame:
    """Bars with start <= date <= end (both ends inclusive; text or date columns)."""
    c = F.col(order)
    if bars.schema[order].dataType.simpleString() == "string":
        start, end = str(start)[:10], str(end)[:10]
    return bars.filter(c.between(F.lit(start), F.lit(end)))


def in_universe(bars: DataFrame, universe: Iterable[str] | DataFrame | None = None,
                key: str = "ticker") -> DataFrame:
    """Keep the bars of a universe (default: the 16 default tickers).

    A list and a DataFrame (its first column) mean the same: names in any case, one
    semi-join whose strategy Spark picks from the measured size.
    """
    if universe is None:
        universe = DEFAULT_TICKERS
    if not isinstance(universe, DataFrame):
        universe = bars.sparkSession.createDataFrame([(str(n),) for n in universe], "name string")
    u = universe.select(F.upper(F.col(universe.columns[0]).cast("string")).alias(key))
    return bars.join(u, key, "left_semi")


def manifest(universe: DataFrame, loaded: DataFrame, *, run_date: str, start, end,
             uri_root: str | None = None, key: str = "ticker") -> DataFrame:
    """Per-instrument ingestion manifest: one row per requested ticker.

    status is SUCCEEDED when the run loaded at least one bar for it, else FAILED;
    ``uri`` is the run's staged directory. The reference writes two
    lists into one JSON document; a row per ticker keeps a large universe from
    collecting into one record (``manifest_summary`` gives the counts).
    """
    req = universe.select(F.upper(F.col(universe.columns[0]).cast("string")).alias(key)).distinct()
    counts = loaded.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    m = req.join(counts, key, "left")
    ok = F.coalesce(F.col("rows"), F.lit(0)) > 0
    uri = F.lit(f"{uri_root.rstrip('/')}/run_date={run_date}" if uri_root else None).cast("string")
    return m.select(
        F.lit(run_date).alias("run_date"),
        F.lit(str(start)[:10]).alias("start_date"),
        F.lit(str(end)[:10]).alias("end_date"),
        F.col(key),
        F.when(ok, "SUCCEEDED").otherwise("FAILED").alias("status"),
        F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("rows"),
        F.when(ok, uri).alias("uri"),
    )


def manifest_summary(m: DataFrame) -> DataFrame:
    return m.groupBy("run_date", "start_date", "end_date").agg(
        F.count_if(F.col("status") == "SUCCEEDED").alias("succeeded"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.sum("rows").alias("rows"),
    )
