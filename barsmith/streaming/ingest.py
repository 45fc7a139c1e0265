"""Incremental ingestion of staged NDJSON bars with Structured Streaming.

Each run stages new files under ``<root>/run_date=<run>/``. A file
stream over ``root`` picks up only files it has not seen (the checkpoint keeps
the list), converts them to typed bars and appends them to a Parquet bar store
through the exactly-once file sink. ``trigger(availableNow=True)`` processes what
is there and stops, so a scheduler can run it after every staging step; the same
query also runs continuously with a processing-time trigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from barsmith.schema import RAW_SCHEMA
from barsmith.sources.ndjson import to_bars

STAGED_SCHEMA = StructType(RAW_SCHEMA.fields + [StructField("run_date", StringType(), True)])


def staged_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(STAGED_SCHEMA).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(root)


def ingest_available(spark: SparkSession, root: str, out_path: str, checkpoint: str, *,
                     max_files_per_trigger: int | None = None, timeout_s: float | None = None):
    """Append all not-yet-ingested staged bars to ``out_path`` (partitioned by year).

    The store is append-only: a run that is staged again is appended again, and lines
    without a date go to the null year. Readers collapse copies (``dedupe=True`` in the
    feature job does) and drop rows without ticker or date. With ``timeout_s`` the call
    stops the query and raises ``TimeoutError`` when it does not end in time.
    """
    bars = to_bars(staged_stream(spark, root, max_files_per_trigger))
    q = (
        bars.withColumn("year", F.year("date"))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("year")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out_path)
    )
    ended = q.awaitTermination(timeout_s)
    if timeout_s is not None and not ended:
        # What was committed stays; the next call goes on from the checkpoint.
        q.stop()
        raise TimeoutError(f"ingestion did not end within {timeout_s} s")
    if q.exception() is not None:
        raise q.exception()
    return q
