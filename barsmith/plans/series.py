"""Ordered per-key series that never need one key to fit in one task.

The reference computes every indicator with
``Window.partitionBy("ticker").orderBy("date")``. That plan sends all rows of a
ticker to one task, so a single instrument holding a third of the data would run in
one task. Here a series is cut into chunks of about ``chunk_rows`` consecutive
rows, and each chunk also receives a *halo*: copies of at least the ``lookback``
rows before it. A ROWS frame that reaches back at most ``lookback`` rows sees
exactly the rows it would see in the unchunked series, so every value matches the
single-partition result; the halo copies are dropped afterwards. Running
(unbounded-preceding) sums are finished with per-chunk totals and an exclusive
prefix over chunks.

Chunks are whole *buckets*: runs of consecutive rows of a key. Which chunk a bucket
belongs to and which chunk's halo it feeds is decided on a small table with one row
per (key, bucket) (:func:`chunk_table`). Without a bucket from the caller the rows are
sorted once by (key, order) across the cluster and counted off
(:func:`range_buckets`), so a bucket has at most an eighth of ``chunk_rows`` rows
whatever the order column's type or spread. A caller who knows a coarse monotone
function of the order column (the day of a timestamp, say) can pass it and save
that sort; its largest bucket then bounds the group.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

CHUNK = "_chunk"    # number of the chunk within its key
HALO = "_halo"      # true for copies that only feed a neighbouring chunk
BUCKET = "_bucket"  # coarse order bucket used to spread one key over many tasks
TOTAL = "_total"    # rows in the key's series
CSTART = "_cstart"  # position of the first row of the chunk the copy belongs to

# Rows per chunk, the most any window task holds for one key. Daily bars do not
# reach it for one instrument (it is about 400 years of trading days), so they run
# one chunk per key with no halo copies; long intraday series are cut into pieces
# of bounded size. Halo overhead is lookback / chunk_rows (0.25 % here).
DEFAULT_CHUNK_ROWS = 100_000

# Rows of the pieces that a long frame is put together from (Series.pieces). Spark goes
# through a whole ROWS frame for every row, so a frame of 252 rows costs 252 steps; its
# pieces cost one frame of BLOCK rows and a lag for each piece.
BLOCK = 20


@dataclass
class Series:
    """Window vocabulary handed to operators.

    ``partition``/``sort`` are what windows partition and order by: the key and the
    order column for a plain series, the key plus chunk and the global position for
    a chunked one. ``home`` is true on rows that belong to the output (false on
    halo copies). ``offsets`` maps a running-sum column to the delta column it sums,
    so the chunked plan can add the totals of earlier chunks.
    """

    key: str = "ticker"
    order: str = "date"
    partition: tuple = ("ticker",)
    sort: tuple = ("date",)
    home: Column = None
    chunked: bool = False
    offsets: dict = field(default_factory=dict)
    min_periods: bool = False

    @classmethod
    def plain(cls, key: str = "ticker", order: str = "date",
              min_periods: bool = False) -> "Series":
        return cls(key, order, (key,), (order,), None, False, min_periods=min_periods)

    @classmethod
    def of_chunks(cls, key: str, order: str, min_periods: bool = False) -> "Series":
        """Windows over (key, chunk), ordered by the order column."""
        return cls(key, order, (key, CHUNK), (order,), ~F.col(HALO), True, min_periods=min_periods)

    def roll(self, fn: Callable, value, n: int) -> Column:
        """``fn(value)`` over the trailing n rows; with ``min_periods`` null until the
        frame holds n values (not null), as pandas ``rolling(n)`` does."""
        out = fn(value).over(self.trailing(n))
        if self.min_periods and n > 1:
            return F.when(F.count(value).over(self.trailing(n)) >= F.lit(n), out)
        return out

    def ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.partition).orderBy(*self.sort)

    def trailing(self, n: int) -> WindowSpec:
        """ROWS frame of the current row and the n-1 before it."""
        return self.ordered().rowsBetween(-(n - 1), 0)

    def pieces(self, name: str, fn: Callable, value: str, n: int) -> dict:
        """Columns from which :meth:`pieced` puts ``fn(value)`` over the trailing n rows together:
        ``fn`` over the trailing BLOCK rows and over what n has beyond whole blocks."""
        return {f"_{name}_{r}": fn(value).over(self.trailing(r)) for r in (BLOCK, n % BLOCK) if r}

    def pieced(self, name: str, n: int) -> list[Column]:
        """The pieces of the trailing n rows (from :meth:`pieces`), newest first; null for no rows."""
        rest = n % BLOCK
        at = [(BLOCK, k) for k in range(0, n - rest, BLOCK)] + ([(rest, n - rest)] if rest else [])
        return [F.lag(f"_{name}_{r}", k).over(self.ordered()) if k else F.col(f"_{name}_{r}") for r, k in at]

    def cumulative(self) -> WindowSpec:
        return self.ordered().rowsBetween(Window.unboundedPreceding, 0)

    def running_sum(self, delta_col: str, name: str) -> Column:
        """Sum of ``delta_col`` from the first row of the series to this row."""
        delta = F.col(delta_col)
        if self.chunked:
            self.offsets[name] = delta_col
            delta = F.when(self.home, delta)
        return F.sum(delta).over(self.cumulative())


def range_buckets(df: DataFrame, key: str, order: str, rows: int) -> DataFrame:
    """``df`` with BUCKET: consecutive runs of at most ``rows`` rows in (key, order) order.

    The rows are range-partitioned and sorted by (key, order), and each partition is
    counted off, so a bucket's size does not depend on how the order values are spread,
    nor on how well the ranges were sampled. The result is stored in the shared folder:
    everything after it sees the same numbers, also when tasks are repeated.
    """
    from barsmith.session import COMPRESSION, scratch_path

    spark = df.sparkSession
    # The row number within the partition is in the low 33 bits, the partition above.
    counted = (df.repartitionByRange(key, order).sortWithinPartitions(key, order)
               .withColumn(BUCKET, F.monotonically_increasing_id()))
    path = scratch_path(spark, "series")
    counted.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(counted.schema).parquet(path).withColumn(BUCKET, F.expr(f"{BUCKET} div {max(1, rows)}"))


def collapse_copies(df: DataFrame, key: str, order: str, prefer: Sequence[str]) -> DataFrame:
    """Keep one row per (key, order): the copy with the largest ``prefer`` values
    (nulls lose), ties broken by the remaining columns, so the choice is
    deterministic. It is one grouped ``max`` over a struct: Spark aggregates each
    input partition before the shuffle, so even a bar copied a billion times moves
    as one row per input partition.
    """
    prefer = [c for c in prefer if c in df.columns and c not in (key, order)]
    rest = [c for c in df.columns if c not in (key, order, *prefer)]
    best = F.max(F.struct(*prefer, *rest)).alias("_best")
    out = df.groupBy(key, order).agg(best)
    return out.select(*[F.col(c) if c in (key, order) else F.col("_best").getField(c).alias(c)
                        for c in df.columns])


def chunk_table(df: DataFrame, key: str, order: str, bucket: Column, *, distinct: bool,
                chunk_rows: int, lookback: int) -> DataFrame:
    """Per (key, bucket) of keys longer than ``chunk_rows``: its chunk, the chunk's
    first position, the key's length, and the next chunk whose halo the bucket feeds
    (or null). Keys not listed are one chunk (0) starting at position 0.

    Everything here is computed on small tables (one row per key and bucket, or per
    key and chunk). Chunks are whole buckets: bucket b goes to chunk
    floor(rows before b / chunk_rows). A chunk shorter than ``lookback`` (possible
    when a bucket boundary falls just before a multiple of chunk_rows) is merged
    into the chunk before it, so every chunk after a key's first holds at least
    ``lookback`` rows. Then the last ``lookback`` rows before a chunk lie in buckets
    of the one chunk before it, and each bucket feeds at most one halo: a bucket is
    copied to the next chunk when it ends fewer than ``lookback`` rows before that
    chunk's start. Copying whole buckets gives a few extra halo rows; they are
    dropped like the others. A chunk holds at most chunk_rows rows plus one bucket.
    """
    narrow = df.filter(F.col(key).isNotNull() & F.col(order).isNotNull()).select(
        key, order, bucket.alias(BUCKET))
    n = F.count_distinct(order) if distinct else F.count(F.lit(1))
    counts = narrow.groupBy(key, BUCKET).agg(n.alias("_n"))
    # All windows below partition by the key (alone or with a chunk id), so one
    # exchange of this small table serves them all; no joins are needed because
    # chunks are contiguous: the next chunk starts where this one ends, and its id
    # is floor(that position / chunk_rows) (its first bucket opens a kept raw chunk).
    wk = Window.partitionBy(key).orderBy(BUCKET)
    c = F.lit(chunk_rows)
    t = counts.select(
        key, BUCKET, "_n",
        F.coalesce(F.sum("_n").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(key)).alias(TOTAL),
    )
    t = t.withColumn("_c0", F.floor(F.col("_off") / c).cast("long"))
    t = t.withColumn("_raw_size", F.sum("_n").over(Window.partitionBy(key, "_c0")))
    keep = (F.col("_raw_size") >= F.lit(lookback)) | (F.col("_c0") == 0)
    t = t.withColumn(CHUNK, F.max(F.when(keep, F.col("_c0"))).over(
        wk.rowsBetween(Window.unboundedPreceding, 0)))
    wch = Window.partitionBy(key, CHUNK)
    t = t.withColumns({CSTART: F.min("_off").over(wch), "_csize": F.sum("_n").over(wch)})
    end = F.col(CSTART) + F.col("_csize")
    feeds = (end < F.col(TOTAL)) & (F.col("_off") + F.col("_n") > end - F.lit(lookback))
    # Only keys longer than one chunk need a lookup; every other row is chunk 0,
    # starting at 0, with no halo. Keeping just those keys' buckets keeps this side
    # of the join small even for millions of instruments (and empty for daily bars).
    return t.filter(F.col(TOTAL) > F.lit(chunk_rows)).select(
        key, BUCKET, TOTAL,
        F.col(CHUNK).alias("_home_chunk"), F.col(CSTART).alias("_home_start"),
        F.when(feeds, F.floor(end / c).cast("long")).alias("_halo_chunk"),
        F.when(feeds, end).alias("_halo_start"),
    )


def bucket_chunked(df: DataFrame, key: str, order: str, *, bucket: Column | None = None,
                   latest: Sequence[str] | None = None, lookback: int,
                   chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Rows with their chunk (and halo copies), without numbering the rows: one
    shuffle of the data, to (key, chunk), follows. Input: bars; output adds CHUNK,
    HALO, CSTART and TOTAL (TOTAL is null for keys of one chunk)."""
    if not 0 <= lookback <= chunk_rows:
        raise ValueError("lookback must lie in [0, chunk_rows]")
    base = df.filter(F.col(key).isNotNull() & F.col(order).isNotNull())
    if latest is not None:
        base = collapse_copies(base, key, order, latest)
    if bucket is None:
        base = range_buckets(base, key, order, chunk_rows // 8)
        t = chunk_table(base, key, order, F.col(BUCKET), distinct=False,
                        chunk_rows=chunk_rows, lookback=lookback)
    else:
        base = base.withColumn(BUCKET, bucket)
        t = chunk_table(df, key, order, bucket, distinct=latest is not None,
                        chunk_rows=chunk_rows, lookback=lookback)
    # Left join: rows of short keys find no entry and default to chunk 0. AQE
    # broadcasts the (small) long-key side, or drops the join when it is empty.
    rows = base.join(t, [key, BUCKET], "left")
    home = F.struct(F.coalesce(F.col("_home_chunk"), F.lit(0).cast("long")).alias(CHUNK),
                    F.lit(False).alias(HALO),
                    F.coalesce(F.col("_home_start"), F.lit(0).cast("long")).alias(CSTART))
    copy = F.when(F.col("_halo_chunk").isNotNull(), F.struct(
        F.col("_halo_chunk").alias(CHUNK), F.lit(True).alias(HALO),
        F.col("_halo_start").alias(CSTART)))
    targets = F.filter(F.array(home, copy), lambda x: x.isNotNull())
    return rows.select("*", F.inline(targets)).drop(
        BUCKET, "_home_chunk", "_home_start", "_halo_chunk", "_halo_start")


def _finish_running(out: DataFrame, long_out: DataFrame, s: Series) -> DataFrame:
    """Add the totals of earlier chunks to each chunk-local running sum.

    ``long_out`` is the same computation restricted to keys longer than one chunk;
    only they need an offset. Its filter on the key's length sits below the windows,
    so it reaches the small offsets side of the position join, and when no key
    spans two chunks (daily bars) AQE finds that side empty and skips the branch.
    """
    key = s.key
    for name, delta in s.offsets.items():
        totals = long_out.groupBy(key, CHUNK).agg(F.sum(delta).alias("_t"))
        prior = totals.select(
            key,
            CHUNK,
            F.sum("_t").over(
                Window.partitionBy(key).orderBy(CHUNK)
                .rowsBetween(Window.unboundedPreceding, -1)
            ).alias("_prior"),
        )
        local, before = F.col(name), F.col("_prior")
        out = (
            out.join(prior, [key, CHUNK], "left")
            .withColumn(
                name,
                F.when(local.isNull() & before.isNull(), F.lit(None))
                .otherwise(F.coalesce(local, F.lit(0)) + F.coalesce(before, F.lit(0)))
                .cast(out.schema[name].dataType),
            )
            .drop("_prior")
        )
    return out


def over_series(
    df: DataFrame,
    build: Callable[[DataFrame, Series], DataFrame],
    *,
    key: str = "ticker",
    order: str = "date",
    lookback: int,
    chunk_rows: int | None = None,
    bucket: Column | None = None,
    latest: Sequence[str] | None = None,
    min_periods: bool = False,
) -> DataFrame:
    """Run ``build(frame, series)`` over each key's ordered series, chunked.

    A series ordered by DATE is bounded by its type (one row per key and day, 366 a
    year), so it runs as one plain window per key: one shuffle, no chunk table. Other
    orders, and any call that names ``chunk_rows`` or ``bucket``, are cut in chunks
    (DEFAULT_CHUNK_ROWS unless named).

    ``build`` must only use windows from ``series`` and must not reach further
    back than ``lookback`` rows except through
    ``Series.running_sum``. Helper columns (``_`` names that ``df`` has not) are dropped.
    A caller's ``bucket`` must be non-null and non-decreasing in ``order`` within a
    key; it bounds how many rows one bucket, and so one chunk beyond ``chunk_rows``,
    can hold. Without it buckets are counted off (:func:`range_buckets`).
    """
    if (chunk_rows is None and bucket is None
            and isinstance(df.schema[order].dataType, DateType)):
        base = df.filter(F.col(key).isNotNull() & F.col(order).isNotNull())
        if latest is not None:
            base = collapse_copies(base, key, order, latest)
        out = build(base, Series.plain(key, order, min_periods=min_periods))
        return out.drop(*[c for c in out.columns if c.startswith("_") and c not in df.columns])
    chunk_rows = DEFAULT_CHUNK_ROWS if chunk_rows is None else chunk_rows
    # One shuffle of the bucketed rows, to (key, chunk); windows ordered by `order`.
    frame = bucket_chunked(df, key, order, bucket=bucket, latest=latest,
                           lookback=lookback, chunk_rows=chunk_rows)
    s = Series.of_chunks(key, order, min_periods)
    out = build(frame, s).filter(~F.col(HALO))
    if s.offsets:
        long_keys = frame.filter(F.col(TOTAL) > F.lit(chunk_rows))
        long_out = build(long_keys, Series.of_chunks(key, order, min_periods)).filter(~F.col(HALO))
        out = _finish_running(out, long_out, s)
    return out.drop(*[c for c in out.columns if c.startswith("_") and c not in df.columns])


def neighbour(
    df: DataFrame,
    cols: dict,
    *,
    key: str = "ticker",
    order: str = "date",
    direction: int = -1,
    bucket: Column | None = None,
) -> DataFrame:
    """``lag``/``lead`` by one row per key without a per-key partition.

    ``cols`` maps output name -> source column. ``direction=-1`` gives the previous
    row's values (lag 1), ``+1`` the next row's (lead 1). Rows are grouped by
    (key, bucket); inside a group the window is local, and the group's edge row
    takes its neighbour from the adjacent non-empty group, found in a table with one
    row per group. (key, order) must be unique; rows with a null key or order are
    dropped.
    """
    if direction not in (-1, 1):
        raise ValueError("direction must be -1 or 1")
    if bucket is None and isinstance(df.schema[order].dataType, DateType):
        # At most one row per key and day: a plain window is bounded by the type.
        whole = Window.partitionBy(key).orderBy(order)
        step = F.lag if direction < 0 else F.lead
        return df.filter(F.col(key).isNotNull() & F.col(order).isNotNull()).withColumns(
            {out: step(src).over(whole) for out, src in cols.items()})
    d = df.filter(F.col(key).isNotNull() & F.col(order).isNotNull())
    d = range_buckets(d, key, order, DEFAULT_CHUNK_ROWS) if bucket is None else d.withColumn(BUCKET, bucket)
    w = Window.partitionBy(key, BUCKET).orderBy(order)
    shift = F.lag if direction < 0 else F.lead
    srcs = sorted(set(cols.values()))
    edge_val = F.struct(*[F.col(c) for c in srcs])
    pick = F.max_by if direction < 0 else F.min_by
    edges = d.groupBy(key, BUCKET).agg(pick(edge_val, F.col(order)).alias("_edge"))
    carry = edges.select(
        key, BUCKET, shift("_edge").over(Window.partitionBy(key).orderBy(BUCKET)).alias("_carry")
    )
    local = d.withColumns(
        {"_at_edge": shift(order).over(w).isNull(),
         **{out: shift(src).over(w) for out, src in cols.items()}}
    )
    joined = local.join(carry, [key, BUCKET], "left")
    return joined.withColumns(
        {out: F.when(F.col("_at_edge"), F.col("_carry").getField(src)).otherwise(F.col(out))
         for out, src in cols.items()}
    ).drop(BUCKET, "_at_edge", "_carry")
