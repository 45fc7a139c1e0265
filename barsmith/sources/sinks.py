"""Feature-table sinks: partitioned Parquet, a catalog table, the declared schema."""

from __future__ import annotations

import uuid
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

from barsmith.schema import BAR_COLUMNS, DECLARED_SCHEMA, FEATURE_SCHEMA
from barsmith.session import COMPRESSION

# One directory per (year, month). The reference also split by ticker, which for
# thousands of instruments means millions of tiny files; files here are sorted by
# ticker and date instead, so Parquet min/max statistics skip by ticker.
PARTITION_COLUMNS = ("year", "month")


def _layout(df: DataFrame, partition_cols: Sequence[str], rebalance: bool = False,
            key: str = "ticker", order: str = "date") -> DataFrame:
    # A feature row is five times as wide as its bar, so these rows are not shuffled
    # again: every task sorts what it has and writes a file for each partition. With
    # REBALANCE (hash by the partition columns; AQE splits big partitions and merges
    # small ones) files come out near the advisory size, for a shuffle of all rows.
    if rebalance:
        df = df.hint("rebalance", *partition_cols)
    return df.sortWithinPartitions(*partition_cols, key, order)


def _plain(df: DataFrame) -> dict:
    """Parquet options that keep computed doubles out of dictionaries: they hardly repeat, and looking each up
    took a quarter of the time of a feature write. Prices and volumes repeat and keep theirs."""
    return {f"parquet.enable.dictionary#{f.name}": "false" for f in df.schema.fields
            if isinstance(f.dataType, DoubleType) and f.name not in BAR_COLUMNS}


def write_parquet(features: DataFrame, path: str,
                  partition_cols: Sequence[str] = PARTITION_COLUMNS,
                  key: str = "ticker", order: str = "date", rebalance: bool = False) -> None:
    """Partitioned Parquet; re-runs replace only the partitions they write. ``rebalance``
    makes fewer and larger files, for a shuffle of the whole table."""
    (
        _layout(features, partition_cols, rebalance, key, order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .options(**_plain(features))
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def read_parquet(spark: SparkSession, path: str, schema: StructType = FEATURE_SCHEMA) -> DataFrame:
    """Read the feature table back with its explicit schema, columns in order. (Features of
    a series with another key or order column: pass their own schema.)"""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_runs(spark: SparkSession, root: str, run_dates=None) -> DataFrame:
    """The rows of every committed run under ``root`` (or of those named), each once;
    ``pipeline_run`` tells them apart. Attempts without a commit record are not read."""
    from barsmith.sources import ledger

    paths = ledger.paths(spark, root, run_dates)
    if not paths:
        return spark.createDataFrame([], FEATURE_SCHEMA)
    folders = StructType([*FEATURE_SCHEMA.fields, StructField("run_date", StringType()), StructField("attempt", StringType())])
    return spark.read.schema(folders).option("basePath", root).parquet(*paths).select(*FEATURE_SCHEMA.names)


def newest(runs: DataFrame, key: str = "ticker", order: str = "date") -> DataFrame:
    """One row per (key, order): that of the newest run. A grouped maximum, so copies
    collapse before they are shuffled.

    Of DATE orders only the months in which a (key, order) has several rows are compared; all other rows
    stay where they are. These months are found from the two columns alone, and
    their number is bounded by the calendar, so they are broadcast."""
    from barsmith.plans.series import collapse_copies

    prefer = ["pipeline_run", "processed_at"]
    if not isinstance(runs.schema[order].dataType, DateType):
        return collapse_copies(runs, key, order, prefer)
    month = F.trunc(order, "month")
    twice = runs.groupBy(key, order).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(month.alias("_twice")).distinct()
    placed = runs.withColumn("_month", month)
    same = F.col("_month").eqNullSafe(F.col("_twice"))
    single = placed.join(F.broadcast(twice), same, "left_anti").select(*runs.columns)
    return single.unionByName(collapse_copies(placed.join(F.broadcast(twice), same, "left_semi").select(*runs.columns), key, order, prefer))


def write_table(features: DataFrame, table: str, *, fmt: str = "parquet",
                path: str | None = None,
                partition_cols: Sequence[str] = PARTITION_COLUMNS,
                rebalance: bool = False, key: str = "ticker", order: str = "date") -> None:
    """Overwrite a catalog table (``fmt`` pluggable: parquet, orc, or a connector).

    ``rebalance`` makes fewer and larger files, for a full shuffle of the table."""
    w = _layout(features, partition_cols, rebalance, key, order).write.format(fmt).mode("overwrite")
    if path:
        w = w.option("path", path)
    if fmt in ("parquet", "orc"):
        w = w.option("compression", COMPRESSION)
    if fmt == "parquet":
        w = w.options(**_plain(features))
    w.partitionBy(*partition_cols).saveAsTable(table)


def _partitions(df: DataFrame, cols: Sequence[str]) -> Column:
    """The condition that picks the partitions which ``df`` has rows in. Its size is the number of
    these partitions (months), and it holds literals only, so it prunes the scan."""
    values = sorted(tuple(r) for r in df.select(*cols).distinct().collect())
    return F.lit(False) if not values else reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(cols, row)]) for row in values])


def merge_table(updates: DataFrame, table: str, *, fmt: str = "parquet", path: str | None = None,
                partition_cols: Sequence[str] = PARTITION_COLUMNS, key: str = "ticker", order: str = "date",
                prefer: Sequence[str] = ("pipeline_run", "processed_at"), unique: bool = False) -> None:
    """Newest-wins merge by (key, order) into a catalog table: rows of ``updates`` replace older
    copies, all other rows stay. A missing table is created.

    Only partitions that ``updates`` has rows in are read and rewritten. Their merged rows are written to the
    shared folder first, so the table is untouched until all of them are there; one overwrite
    of just these partitions then swaps them in. Partitions that the table has no rows in need no
    merge: ``updates`` with one row per (key, order) (``unique``) then go straight into the table. Where
    all of these are newer than what the partitions hold, only the rows that stay are shuffled and written there.
    """
    from barsmith.session import shuffles_dropped

    with shuffles_dropped(updates.sparkSession):
        _merge(updates, table, fmt, path, partition_cols, key, order, list(prefer), unique)


def _all_newer(updates: DataFrame, stored: DataFrame, key: str, order: str, prefer: Sequence[str]) -> bool:
    """Whether every row of ``updates`` has its key and order, and wins over every row of ``stored``."""
    stamp = F.struct(*prefer)
    new = updates.agg(F.min(stamp).alias("stamp"), F.count_if(F.col(key).isNull() | F.col(order).isNull()).alias("unkeyed"))
    old = stored.agg(F.max(stamp).alias("newest"))
    return bool(new.crossJoin(old).select((F.col("unkeyed") == 0) & (F.col("stamp") > F.col("newest"))).first()[0])


def _merge(updates: DataFrame, table: str, fmt: str, path: str | None, partition_cols: Sequence[str], key: str, order: str,
           prefer: list[str], unique: bool) -> None:
    from barsmith.plans.series import collapse_copies
    from barsmith.session import drop_scratch, scratch_path, shuffles_dropped

    spark = updates.sparkSession
    if not spark.catalog.tableExists(table):
        write_table(updates, table, fmt=fmt, path=path, partition_cols=partition_cols, key=key, order=order)
        return
    stored = spark.table(table)
    updates = spark.createDataFrame([], stored.schema).unionByName(updates, allowMissingColumns=True).select(*stored.columns)
    touched = stored.filter(_partitions(updates, partition_cols))
    fresh = unique and touched.isEmpty()
    # updates that win everywhere are added as they are
    apart = fresh or (unique and set(prefer) <= set(stored.columns) and _all_newer(updates, touched, key, order, prefer))
    if not fresh:
        staged = scratch_path(spark, "merge")
        if apart:
            touched = touched.join(updates.select(key, order).hint("merge"), [key, order], "left_anti").select(*stored.columns)
        else:
            touched = touched.unionByName(updates)
        merged = collapse_copies(touched, key, order, prefer)
        _layout(merged, partition_cols, key=key, order=order).write.option("compression", COMPRESSION).options(**_plain(merged)).partitionBy(*partition_cols).parquet(staged)
    # a session of its own, so that the overwrite mode is nobody else's
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    for kind in ("parquet", "orc"):  # of a table that names none
        own.conf.set(f"spark.sql.{kind}.compression.codec", COMPRESSION)
    for name, value in _plain(updates).items():
        own.conf.set(name, value)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    if not fresh:
        ready = own.read.schema(stored.schema).parquet(staged).select(*stored.columns)
    if apart:
        # read under the session whose overwrite mode is set
        updates.createOrReplaceGlobalTempView(view := "merge_" + uuid.uuid4().hex[:12])
        added = own.table(f"global_temp.{view}")
        ready = added if fresh else ready.unionByName(added)
    buckets = table_buckets(spark, table)
    if buckets:  # a file per bucket and month
        ready = ready.repartition(buckets, F.col(key))
    # else sorting within the read splits is all that is left
    with shuffles_dropped(own):
        ready.sortWithinPartitions(*partition_cols, key, order).write.mode("overwrite").insertInto(table)
    if apart:
        spark.catalog.dropGlobalTempView(view)
    if not fresh:
        drop_scratch(spark, staged)
    spark.catalog.refreshTable(table)


def table_buckets(spark: SparkSession, table: str) -> int:
    """The number of hash buckets of a catalog table, 0 for none."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").select("data_type").collect()
    return int(found[0][0]) if found else 0


def write_clustered(features: DataFrame, table: str, *, buckets: int, path: str | None = None,
                    partition_cols: Sequence[str] = (), key: str = "ticker", order: str = "date") -> None:
    """A catalog table clustered by instrument: ``buckets`` hash buckets by ``key``, each one file
    sorted by (key, order). Windows, aggregates and joins by the instrument then read it without a
    shuffle. ``buckets`` should make a file some hundred MB; an instrument lies in one bucket.

    With ``partition_cols`` each partition has its own buckets: :func:`merge_table` then rewrites
    the partitions it touches and keeps the clustering, and reads by instrument still need no shuffle.
    """
    w = (features.repartition(buckets, F.col(key)).sortWithinPartitions(*partition_cols, key, order).write.format("parquet").mode("overwrite")
         .option("compression", COMPRESSION).options(**_plain(features)).bucketBy(buckets, key).sortBy(key, order))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def conform(features: DataFrame, strict: bool = True) -> DataFrame:
    """The 41 declared warehouse fields, cast to their declared types.

    With ``strict`` a null in a REQUIRED field fails the job when the rows are
    written (``raise_error`` inside the projection; no extra pass).
    """
    cols = []
    for f in DECLARED_SCHEMA.fields:
        c = F.col(f.name).cast(f.dataType)
        if strict and not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"null in required field {f.name}"))) \
                .otherwise(c)
        cols.append(c.alias(f.name))
    return features.select(*cols)


def create_table_ddl(table: str, fmt: str = "parquet") -> str:
    """CREATE TABLE IF NOT EXISTS for the declared schema, partitioned by year/month."""
    body = ",\n  ".join(
        f"`{f.name}` {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}"
        for f in DECLARED_SCHEMA.fields
    )
    return (f"CREATE TABLE IF NOT EXISTS {table} (\n  {body}\n) USING {fmt}\n"
            f"PARTITIONED BY (year, month)")


def ensure_table(spark: SparkSession, table: str, fmt: str = "parquet",
                 location: str | None = None) -> None:
    """Create the declared feature table if it does not exist (no-op otherwise)."""
    ddl = create_table_ddl(table, fmt)
    if location:
        ddl += f"\nLOCATION '{location}'"
    spark.sql(ddl)


class SchemaDrift(RuntimeError):
    """Raised when a stored table cannot take the rows of its contract."""


# What a column of the first type may hold without loss, beside its own type.
_HOLDS = {"bigint": {"int", "smallint", "tinyint"}, "int": {"smallint", "tinyint"}, "smallint": {"tinyint"},
          "double": {"float", "int", "smallint", "tinyint"}, "timestamp": {"date"}}


def enforce_contract(spark: SparkSession, table: str, schema: StructType = DECLARED_SCHEMA,
                     partition_cols: Sequence[str] = PARTITION_COLUMNS) -> list[str]:
    """Hold the stored ``table`` against its contract before a job writes to it.

    Columns that the table lacks are added (null in earlier rows), and returned. A column whose type
    cannot hold the contract's values, or partitioning by other columns, raises :class:`SchemaDrift`, and so does a
    missing partition column. Columns that only the table has stay: they are null in new rows.
    """
    stored = {f.name.lower(): f.dataType.simpleString() for f in spark.table(table).schema.fields}
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if parts != list(partition_cols):
        raise SchemaDrift(f"{table} is partitioned by {parts}, not by {list(partition_cols)}")
    narrow, missing = [], []
    for f in schema.fields:
        want, have = f.dataType.simpleString(), stored.get(f.name.lower())
        if have is None:
            missing.append(f)
        elif have != want and want not in _HOLDS.get(have, ()):
            narrow.append(f"{f.name} is {have}, the contract has {want}")
    if narrow:
        raise SchemaDrift(f"{table}: " + "; ".join(narrow))
    if missing:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    return [f.name for f in missing]
