"""Interaction audit of document filters: what each one removes under every order of them.

1. One pass over the texts finds which filters a document fails, as a bit mask. Short rows
   (ids, digest of the text, mask) go on; the exact-copy filter needs the smallest id of each
   text, a grouped minimum that is combined before its shuffle, so a text copied a billion
   times crosses the network once per partition. Rows meet that minimum by (digest, id), a key that
   no group of copies makes hot.
2. Documents collapse to mask cells: per part at most 32 rows with counts of documents, of good and of
   toxic ones.
3. A recursive common table expression extends filter prefixes by each letter not yet used,
   joins the cells on every level and carries the bits applied so far. Each level gives the
   figures of its step; all orders that begin with a prefix share them.

Its work after the cells depends on the number of parts alone: 326 prefixes times 32 cells each.

Defined results: null text is empty text, null part the empty string. Exact copies are equal by
SHA-256; a row with null id is older than none and makes none a copy, and repeated rows of one id are not
copies of each other. A document counts as good or toxic if any label row of its id says so; without
label it is neither. Rows of one id are counted each. Texts of any length are judged whole. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import UPPER, WS, stored

#: The filters, in bit order.
LETTERS = "ABCDE"
SPECIAL = "[#$%&*|]"


def text_mask(text: Column, *, min_words: int = 100, distinct_percent: int = 80, upper_percent: int = 10) -> Column:
    """Bits of the filters that look at one text: A short, B repetitive, C capitals, D special characters."""
    # blanks in front or behind give empty strings, which are no words
    words = F.filter(F.split(F.translate(text, WS, " " * len(WS)), " "), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    chars = F.length(text)
    upper = chars - F.length(F.translate(text, UPPER, ""))
    fails = [n < min_words, 100 * distinct.cast("long") < distinct_percent * n.cast("long"),
             100 * upper.cast("long") > upper_percent * chars.cast("long"), text.rlike(SPECIAL)]
    mask = F.lit(0)
    for bit, f in enumerate(fails):
        mask = mask + F.when(f, 1 << bit).otherwise(0)
    return mask


def failures(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", part: str = "lang",
             quality: str = "quality", toxic: str = "toxic", **limits) -> DataFrame:
    """(doc_id, part, mask, good, toxic): the filters that each document fails."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = stored(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                              F.unhex(F.sha2(body, 256)).alias("digest"), text_mask(body, **limits).alias("mask")), "filter-masks")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("digest", "doc_id", F.lit(True).alias("first"))
    marks = (labels.groupBy(F.col(f"`{doc_id}`").alias("doc_id"))
             .agg(F.max((F.col(f"`{quality}`") == 1).cast("int")).alias("good"), F.max((F.col(f"`{toxic}`") == 1).cast("int")).alias("toxic")))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return (rows.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
            .select("doc_id", "part", (F.col("mask") + F.when(copy, 1 << 4).otherwise(0)).alias("mask"),
                    F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))


def cells(failed: DataFrame) -> DataFrame:
    """Per part and mask: documents, good and toxic ones."""
    return failed.groupBy("part", "mask").agg(F.count("*").alias("docs"), F.sum("good").cast("long").alias("good"),
                                              F.sum("toxic").cast("long").alias("toxic"))


_ENUMERATION = """
WITH RECURSIVE step(prefix, bit, applied, part, mask, docs, good, toxic) AS (
  SELECT '', 0, 0, part, mask, docs, good, toxic FROM {cells}
  UNION ALL
  SELECT concat(s.prefix, s.letter), shiftleft(1, s.n), s.applied | s.bit, c.part, c.mask, c.docs, c.good, c.toxic
  FROM (SELECT *, posexplode(split('{letters}', '')) AS (n, letter) FROM step) s
  JOIN {cells} c ON c.part = s.part AND c.mask = s.mask
  WHERE ((s.applied | s.bit) & shiftleft(1, s.n)) = 0
)
SELECT * FROM step LIMIT ALL
"""


def orders_audit(cell: DataFrame) -> DataFrame:
    """One row per part, filter_order (all permutations) and step from the mask cells.

    A recursion row is one mask cell under one prefix: ``bit`` is the prefix's last filter,
    ``applied`` the bits of those before it.
    """
    spark = cell.sparkSession
    view = f"cells_{uuid.uuid4().hex}"
    stored(cell, "filter-cells").createOrReplaceTempView(view)
    hit, before = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("applied")) != 0

    def total(when: Column, what: str = "docs") -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0)).cast("long")

    levels = stored(
        spark.sql(_ENUMERATION.format(cells=view, letters=LETTERS)).filter("prefix <> ''").groupBy("part", "prefix").agg(
            total(~hit & ~before).alias("kept"), total(hit & ~before).alias("removed"), total(hit & before).alias("redundant"),
            total(F.col("mask") == F.col("bit")).alias("unique_fails"),
            total(hit & ~before, "good").alias("good_lost"), total(hit & ~before, "toxic").alias("toxic_lost")),
        "filter-steps")
    spark.catalog.dropTempView(view)
    # a prefix of n letters begins (5 - n)! orders: its share in the sum over all of them
    weight = F.element_at(F.array(*[F.lit(w) for w in (24, 6, 2, 1, 1)]), F.length("prefix"))
    shapley = levels.groupBy("part", F.right("prefix", F.lit(1)).alias("letter")).agg(F.sum(F.col("removed") * weight).alias("shapley"))
    full = levels.filter(F.length("prefix") == len(LETTERS)).select("part", F.col("prefix").alias("filter_order"))
    steps = (full.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
             .withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
             .withColumn("letter", F.expr("substring(filter_order, step, 1)")))
    return (steps.join(levels, ["part", "prefix"]).join(shapley, ["part", "letter"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """The audit of ``docs``: see the module's text for its steps."""
    return orders_audit(cells(failures(docs, labels, **columns)))
