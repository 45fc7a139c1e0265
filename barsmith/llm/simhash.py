"""SimHash near-duplicates through covering locality-sensitive hashing.

Fingerprint: lower-case A-Z, words between ASCII white space, shingles of ``shingle``
words joined by a space (repeats included; fewer words: the whole sequence; no word:
fingerprint zero). Each shingle is hashed with XXH64 (seed 42); a bit of the 64-bit
fingerprint is 1 if it is set in more than half the hashes.

Linking at ``radius`` r or fewer differing bits. Each of the 64 bit positions has a fixed
nonzero vector of length r + 1 over the field of q elements (q a prime). Each direction v
of that space (q = 3 and r = 2: 13 of them) gives a table whose mask keeps the bits
whose vector is not orthogonal to v. Any r vectors lie in some hyperplane, so a pair that
differs in at most r bits has a direction orthogonal to all those bits' vectors: that mask
leaves them all out and the pair falls in one bucket of that table. Far pairs share a
bucket with probability 2^-(kept bits), about 44 of the 64 for q = 3.

Buckets hold distinct fingerprints. Pairs inside a bucket are not listed: members of a
bucket with company send themselves and each variant with up to r/2 left-out bits
flipped. Two of them meet in a variant exactly if they differ in at most r bits (half of
the differing bits flipped on either side), so a shared variant is the exact distance
check, and the smallest member of a variant is the hub of its links. The number of rows
is linear in the bucket, however many fingerprints crowd in it. Connected components
of the hub links are the classes.

Nulls and empty texts have fingerprint zero, linked like any other. A row with null doc_id
gets the class of its fingerprint, and null if no row there has an id. Rows that repeat
a doc_id may have different texts; they then link those texts' classes by their
fingerprints only, not by the shared id. Texts of any length are read whole, shingles in blocks. Empty tables give empty results. Other columns
are not carried; the result has doc_id, fingerprint, component_id.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import checkpointed, free_name
from barsmith.llm.components import components

SEED = 42
BITS = 64
#: Shingles whose bits are unpacked at once.
BLOCK = 1 << 15


def fingerprint(text: bytes | None, shingle: int) -> int:
    words = (text or b"").lower().split()  # on bytes: ASCII upper case and white space only
    if not words:
        return 0
    if len(words) < shingle:
        parts = iter([b" ".join(words)])
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    total, ones = 0, np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_digest
    while block := [digest(p, SEED) for p in itertools.islice(parts, BLOCK)]:
        total += len(block)
        bits = np.unpackbits(np.frombuffer(b"".join(block), np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def covering_masks(radius: int, q: int = 3, bits: int = BITS) -> list[int]:
    """One mask of kept bits for each direction of the (radius + 1)-dimensional space over q."""
    if q < 2 or any(q % p == 0 for p in range(2, q)):
        raise ValueError("q must be a prime")
    # One vector of each direction: the first nonzero entry is 1.
    lines = [v for v in itertools.product(range(q), repeat=radius + 1)
             if any(v) and next(x for x in v if x) == 1]
    of_bit = [lines[i % len(lines)] for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(of_bit) if sum(a * b for a, b in zip(v, m, strict=True)) % q)
            for v in lines]

#: A fingerprint of more than one in HOT rows is hot.
HOT = 1000


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _flips(mask: int, radius: int) -> list[int]:
    """All ways to flip up to radius / 2 of the bits that ``mask`` leaves out."""
    free = [1 << i for i in range(BITS) if not mask >> i & 1]
    return [sum(c) for k in range(radius // 2 + 1) for c in itertools.combinations(free, k)]


def fingerprints(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint as a signed long, one row per document."""

    def run(batches):
        for b in batches:
            col = b.column(1)
            col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in col), np.uint64, len(col))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, fp long")


def links(fps: DataFrame, *, radius: int = 2, q: int = 3) -> DataFrame:
    """(a, b): hub links between the distinct values of the column ``fp``; their connected
    components are those of all pairs with at most ``radius`` differing bits."""
    if radius < 0 or radius % 2:
        raise ValueError("radius is 0 or an even number")
    masks = covering_masks(radius, q)
    keys = fps.select("fp").distinct().select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("table", "bucket"))
    crowded = checkpointed(
        keys.groupBy("table", "bucket").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        .filter("low < high").select("table", "bucket"))
    members = keys.join(crowded, ["table", "bucket"]).select("fp", "table").distinct()
    flips = F.lit(None)
    for i, m in enumerate(masks):
        flips = F.when(F.col("table") == i, F.array(*[F.lit(_signed(x)) for x in _flips(m, radius)])).otherwise(flips)
    met = members.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant")).distinct()
    met = checkpointed(met)
    hubs = met.groupBy("variant").agg(F.min("fp").alias("hub"), F.max("fp").alias("top")).filter("hub < top")
    hubs = checkpointed(hubs.select("variant", "hub"))
    return met.join(hubs, "variant").filter("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
                    radius: int = 2, q: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id): 16 lowercase hex digits, and the smallest doc_id
    reachable over links of at most ``radius`` differing bits."""
    fps = checkpointed(fingerprints(docs, text=text, doc_id=doc_id, shingle=shingle))
    classes = components(links(fps, radius=radius, q=q))
    least = checkpointed(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
                         .join(classes.withColumnRenamed("id", "fp"), "fp", "left")
                         .select("fp", "least", "rows", F.coalesce("component", "fp").alias("component")))
    of_class = least.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = checkpointed(least.join(of_class, "component").select("fp", "component_id", "rows"))
    # A fingerprint that many rows share would meet its class in one task. Those with more than one in HOT
    # of all rows are fewer than HOT: they are broadcast, and the rows stay where they are.
    hot = of_fp.filter(F.col("rows") > F.lit(fps.count() / HOT)).drop("rows")
    cold = fps.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(of_fp.drop("rows"), "fp")
    return fps.join(F.broadcast(hot), "fp").unionByName(cold).select(
        F.col("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id")


def one_of_each(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
                radius: int = 2) -> DataFrame:
    """One row of each class of near-duplicates: the one with the smallest doc_id. Rows with null doc_id
    come after all others; rows that share a doc_id are told apart by a hash of their text, and one
    of equal rows stays. Rows of one doc_id that are no near-duplicates all stay."""
    row = free_name(docs.columns, "_row")
    key = F.struct(F.col(f"`{doc_id}`").isNull().alias("unknown"), F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("hash"))
    rows = docs.withColumn(row, key)
    classes = checkpointed(near_duplicates(rows, text=text, doc_id=row, shingle=shingle, radius=radius)
                           .select(F.col("doc_id").alias(row), (F.col("doc_id") == F.col("component_id")).alias("first")))
    gone = classes.filter(~F.col("first")).select(row).distinct()
    kept = rows.join(gone, row, "left_anti")
    equal = classes.filter("first").groupBy(row).count().filter("count > 1").select(row)
    if not equal.isEmpty():  # only these rows are shuffled
        kept = kept.join(equal, row, "left_anti").unionByName(kept.join(equal, row, "left_semi").dropDuplicates([row]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
