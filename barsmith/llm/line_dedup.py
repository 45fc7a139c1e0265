"""Line deduplication with two Bloom filters.

A line's key is the line with ASCII white space stripped at both ends and A-Z
lower-cased. A key of at least ``min_chars`` code points found in at least
``min_documents`` documents loses all its lines except in the largest ``doc_id`` holding
it. Other lines stay, joined by newlines.

1. Every document gives the 64-bit hashes of its distinct long keys. A batch sends each
   hash once (marked if several of its documents held it) to the segment of the hash, where
   two Bloom filters are built: keys seen once, keys seen twice.
2. The second filter, whose size has a fixed bound (``max_filter_bits``), is broadcast. A
   second pass probes it: only keys that it holds, suspected repeats, are shuffled. Exact
   aggregation over the full key gives the number of documents and the largest doc_id.
3. The line numbers to drop are gathered per document and the text is rebuilt.

A Bloom filter has no false negatives, so no repeat escapes. False suspects are unmade by
the exact count; beyond the filter's bound there are more of them to shuffle, and the
result is the same. A hot key is one row per map task at the count, and the join back to
its documents is between stored tables, which adaptive execution splits.

Nulls: a null text is one empty line. A row with null doc_id counts as a document and can
lose lines, but is never the largest; if only such rows hold a key, its lines stay.
Rows that repeat a doc_id count as documents of their own, and all rows of the largest
doc_id keep the line. Texts are read whole; a document's long lines are hashed at once. Empty tables give
empty results. Other columns pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import free_name, stored

SEGMENTS = 256
HASHES = 3
#: Bytes of a batch's texts that are hashed at once.
BLOCK_BYTES = 8 << 20


def long_keys(text: bytes, min_chars: int) -> dict[bytes, list[int]]:
    """The distinct keys of at least ``min_chars`` code points, with their line numbers."""
    out: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.split(b"\n")):
        if len(line) < min_chars:
            continue
        key = line.strip().lower()  # on bytes: ASCII only
        if len(key) >= 4 * min_chars or len(key) >= min_chars <= len(key.decode("utf-8", "replace")):
            out.setdefault(key, []).append(i)
    return out


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    """HASHES bit positions within a segment of ``bits`` (a power of two), by double hashing."""
    step = (h >> np.uint64(17)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([(h + np.uint64(j) * step) & np.uint64(bits - 1) for j in range(HASHES)])


def _segment(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(56)).astype(np.int64)  # 256 segments


def _holds(bitmap: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return np.all((bitmap[pos >> np.uint64(3)] >> (pos & np.uint64(7)).astype(np.uint8)) & 1, axis=0)


def _add(bitmap: np.ndarray, pos: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, pos.ravel() >> np.uint64(3),
                     np.uint8(1) << (pos.ravel() & np.uint64(7)).astype(np.uint8))


def _texts(batch: pa.RecordBatch, i: int):
    col = batch.column(i)
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())


def _hashes(texts, min_chars: int):
    """Blocks of (hash, seen in several documents of the block)."""
    h64, got, size = xxhash.xxh64_intdigest, [], 0
    for t in texts:
        t = t.as_py()
        if t:
            got += {h64(k) for k in long_keys(t, min_chars)}
            size += len(t)
        if size > BLOCK_BYTES:
            yield np.unique(np.array(got, np.uint64), return_counts=True)
            got, size = [], 0
    yield np.unique(np.array(got, np.uint64), return_counts=True)


def _twice_filter(texts: DataFrame, min_chars: int, segment_bits: int) -> np.ndarray:
    """Bitmap (segment by segment) of keys that at least two documents may hold."""

    def hashes(batches):
        schema = pa.schema([("segment", pa.int32()), ("hashes", pa.binary()), ("many", pa.binary())])
        for batch in batches:
            for h, n in _hashes(_texts(batch, 0), min_chars):
                if not len(h):
                    continue
                at = np.searchsorted(_segment(h), np.arange(SEGMENTS + 1))  # h is sorted
                rows = [(s, h[a:b].tobytes(), h[a:b][n[a:b] > 1].tobytes())
                        for s, (a, b) in enumerate(zip(at, at[1:], strict=False)) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                    schema=schema)

    def filters(batches):
        schema = pa.schema([("segment", pa.int32()), ("bitmap", pa.binary())])
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, blob, many in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if s not in once:
                    once[s], twice[s] = (np.zeros(segment_bits // 8, np.uint8) for _ in range(2))
                pos = _positions(np.frombuffer(blob, np.uint64), segment_bits)
                seen = _holds(once[s], pos)
                _add(twice[s], pos[:, seen])
                _add(twice[s], _positions(np.frombuffer(many, np.uint64), segment_bits))
                _add(once[s], pos)
        for s, bitmap in twice.items():
            if bitmap.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([bitmap.tobytes()], pa.binary())], schema=schema)

    # one job builds all segments; the driver then reads them one file after the other
    rows = stored(texts.mapInArrow(hashes, "segment int, hashes binary, many binary")
                  .repartition("segment")
                  .mapInArrow(filters, "segment int, bitmap binary"), "line-filters")
    out = np.zeros((SEGMENTS, segment_bits // 8), np.uint8)
    for r in rows.toLocalIterator():  # max_filter_bits / 8 bytes at most
        out[r["segment"]] = np.frombuffer(r["bitmap"], np.uint8)
    return out


def _without_lines(text: Column, drops: Column) -> Column:
    """``text`` without the lines of these numbers. Row by row in the JVM: a batch of whole texts in a Python
    worker holds each of them several times. The outer transform binds the lines, so they are split once;
    ``array_except`` looks numbers up in a set, so a text of many lines takes time in proportion."""
    return F.transform(F.array(F.split(text, "\n")), lambda lines: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drops), lambda i: F.get(lines, i)), "\n"))[0]


def dedup_lines(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", min_chars: int = 40,
                min_documents: int = 5, max_filter_bits: int = 1 << 31) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, and the columns ``n_lines``
    (before), ``n_dropped`` (both long), with underscores in front where ``docs`` has them.

    ``max_filter_bits`` bounds the broadcast filter (256 MB by default). Below that bound it
    has 4 to 8 bits for each 41 bytes of text: a long line with its newline has at least
    as many bytes, so the filter never holds more than one key per 4 bits.
    """
    if min_documents < 2 or min_chars < 1:
        raise ValueError("min_documents is 2 or more, min_chars 1 or more")
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = min(max_filter_bits, 1 << math.ceil(math.log2(max(4 * size / (min_chars + 1), 1 << 14))))
    segment_bits = max(64, bits // SEGMENTS)
    bitmap = spark.sparkContext.broadcast(_twice_filter(docs.select(text), min_chars, segment_bits))

    id_type = docs.schema[doc_id].dataType
    named = docs.select(F.col(doc_id).alias("d"), F.xxhash64(text).alias("t"), F.col(text).alias("x"))

    def suspects(batches):
        twice = bitmap.value
        for batch in batches:
            rows, keys, lines = [], [], []

            def emit():
                h = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))
                pos, seg = _positions(h, segment_bits), _segment(h)
                hit = np.all((twice[seg, pos >> np.uint64(3)]
                              >> (pos & np.uint64(7)).astype(np.uint8)) & 1, axis=0).nonzero()[0]
                at = pa.array([rows[i] for i in hit], pa.int64())
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     pa.array([keys[i] for i in hit], pa.binary()),
                     pa.array([lines[i] for i in hit], pa.list_(pa.int32()))],
                    names=["d", "t", "key", "lines"])

            size = 0
            for i, t in enumerate(_texts(batch, 2)):
                t = t.as_py()
                if t:
                    for k, at in long_keys(t, min_chars).items():
                        rows.append(i)
                        keys.append(k)
                        lines.append(at)
                    size += len(t)
                if size > BLOCK_BYTES:
                    yield emit()
                    rows, keys, lines, size = [], [], [], 0
            if keys:
                yield emit()

    found = stored(named.mapInArrow(
        suspects, f"d {id_type.simpleString()}, t long, key binary, lines array<int>"), "suspects")
    repeated = stored(
        found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("keeper"))
        .filter((F.col("n") >= min_documents) & F.col("keeper").isNotNull()).select("key", "keeper"),
        "repeated")
    n_lines, n_dropped = (free_name(docs.columns, c) for c in ("n_lines", "n_dropped"))
    drops = (found.join(repeated, "key").filter(~F.col("d").eqNullSafe(F.col("keeper")))
             .groupBy("d", "t").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("_drops")))
    left = docs.select(*[F.col(f"`{c}`") for c in docs.columns]).alias("l")
    joined = left.join(
        drops.alias("r"),
        F.col(f"l.{doc_id}").eqNullSafe(F.col("r.d")) & (F.xxhash64(F.col(f"l.{text}")) == F.col("r.t")),
        "left")
    whole, gone = F.col(f"l.{text}"), F.col("r._drops")
    kept = F.when(gone.isNotNull(), _without_lines(whole, gone)).otherwise(whole)
    return joined.select(
        *[(kept if c == text else F.col(f"l.`{c}`")).alias(c) for c in docs.columns],
        F.size(F.split(F.coalesce(whole, F.lit("")), "\n")).cast("long").alias(n_lines),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(n_dropped))
