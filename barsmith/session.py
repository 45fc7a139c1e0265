"""Session-level helpers: the shared folder for checkpoints and staged files."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's checkpoint folder (``spark.checkpoint.dir``), if one is set."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir", None)
    return d or None


def ensure_checkpoint_dir(spark: SparkSession, *, local_fallback: bool = True) -> str:
    """Return the checkpoint folder; a local one is made only for tests.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; where
    it is unset the call raises, because executors would not see each other's files.
    Only a ``local[...]`` master, whose one machine sees its own folders, falls back to a
    temporary one (not with ``local_fallback=False``, as the command line does).
    """
    d = checkpoint_dir(spark)
    if d:
        sc = spark.sparkContext
        if not (hasattr(sc, "getCheckpointDir") and sc.getCheckpointDir()):
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    if not (local_fallback and re.match(r"local(\[|$)", spark.sparkContext.master)):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    d = tempfile.mkdtemp(prefix="barsmith-ck-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder for files a job writes and reads."""
    return f"{ensure_checkpoint_dir(spark)}/barsmith/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder whose rows are stored elsewhere by now."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_empty(spark: SparkSession, path: str) -> None:
    """Remove a folder if nothing is in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p) and len(fs.listStatus(p)) == 0:
        fs.delete(p, False)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it, what an action shuffled is removed when the action ends; without it these files stay
    as long as the driver holds a reference to their plan. For jobs that store what they read again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


# Codec of the Parquet files that jobs write. Feature columns are doubles that hardly repeat: zstd
# makes a row an eighth smaller than the default (snappy), in about the same time.
COMPRESSION = "zstd"

# The job's session settings (AQE with partition coalescing), plus
# skew-join splitting and UTC session time. The number of shuffle partitions is left to
# the submitter: it follows the data, and no constant fits both 1 GB and 100 TB.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app_name: str = "barsmith", **overrides) -> SparkSession:
    """The job's session. Master, resources and anything else come from ``spark-submit``;
    SESSION_CONF fills in only what the submitter left unset, ``overrides`` always hold."""
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    submitted = spark.sparkContext.getConf()
    for k, v in SESSION_CONF.items():
        if submitted.get(k) is None:
            spark.conf.set(k, v)
    for k, v in overrides.items():
        spark.conf.set(k, v)
    return spark
