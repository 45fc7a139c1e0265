"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.session import ensure_checkpoint_dir, scratch_path  # noqa: F401

#: ASCII white space, as the contracts name it: [\x20\x09-\x0D].
WS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    It cuts the lineage: a lost executor costs the reading tasks only, and Spark knows
    the stored size when it plans the joins that follow.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the session's shared folder (small tables of ids)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def free_name(taken, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``taken`` has that name
    (column names are compared as Spark does, without case)."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)
