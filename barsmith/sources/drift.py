"""Vendor payloads whose fields drift: nothing of a record is lost.

A fixed schema drops fields it doesn't know and nulls values of another type. Here a payload
is parsed as VARIANT, arrays are exploded into records, and what the contract cannot hold is
rescued: ``rescued`` is a JSON object of the unknown fields and of the known ones whose value
doesn't convert, null where there are none. A payload that isn't JSON, or a record that isn't an
object, is kept whole as text in ``malformed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from barsmith.schema import VENDOR_SCHEMA

RESCUED, MALFORMED = "rescued", "malformed"


def payload_texts(spark: SparkSession, root: str, *, whole_files: bool = False) -> DataFrame:
    """(payload, ticker): one row per line, or per file for arrays over several lines. The ticker
    is that of the folder (``ticker=<T>``) or the file (``<T>.json``)."""
    text = spark.read.text(root, wholetext=whole_files)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+?)\.json$", 1)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/ticker=([^/]+)/", 1)
    named = F.when(folder != "", F.url_decode(folder)).when((name != "") & ~name.startswith("part-"), name)
    return text.select(F.col("value").alias("payload"), (F.coalesce("ticker", named) if "ticker" in text.columns else named).alias("ticker"))


def records(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per record: the elements of arrays, other payloads as they are; in ``record``
    (VARIANT, null where the text is no JSON; ``payload`` stays for these). An empty array has no records."""
    parsed = payloads.withColumn("_v", F.try_parse_json(F.col(payload)))
    # an array's elements; anything else is the only element
    items = F.try_variant_get("_v", "$", "array<variant>")
    # judged per payload, not per record; of JSON the record is what is kept, so that a long array's text
    # is not repeated beside each of its elements
    whole = parsed.withColumns({"_items": items, payload: F.when(F.col("_v").isNull(), F.col(payload))})
    listed = whole.withColumn("_array", F.col("_items").isNotNull()).withColumn("_items", F.coalesce("_items", F.array("_v"))).drop("_v")
    rows = listed.withColumn("record", F.explode_outer("_items")).drop("_items")
    return rows.filter(~(F.col("_array") & F.col("record").isNull())).drop("_array")


def conform(recs: DataFrame, schema: StructType = VENDOR_SCHEMA, *, payload: str = "payload") -> DataFrame:
    """The contract's fields, ``rescued`` and ``malformed``, beside the other columns of ``recs``.

    A value that converts to its field's type (text "12" to a number) stands in the field; a fraction
    does not convert to a whole number, nor a number to a date text. A null is a missing value.
    """
    fields = F.col("_fields")

    def held(f: StructField, there: Column) -> Column:
        """The field's value, null where converting would change it."""
        value = F.try_variant_get(there, "$", f.dataType.simpleString())
        if isinstance(f.dataType, StringType):
            return F.when(F.schema_of_variant(there) == "STRING", value)
        if isinstance(f.dataType, IntegralType):
            exact = F.try_variant_get(there, "$", "decimal(38, 9)")
            return F.when(exact == value, value)
        return F.when(F.schema_of_variant(there) != "BOOLEAN", value)

    recs = recs.withColumn("_fields", F.try_variant_get("record", "$", "map<string, variant>"))
    typed = recs.withColumn("_typed", F.struct(*[held(f, F.element_at(fields, f.name)).alias(f.name) for f in schema.fields]))
    names = schema.names
    kept = F.filter(F.array(*[F.when(F.col("_typed")[n].isNotNull(), F.lit(n)) for n in names]), lambda n: n.isNotNull())
    rest = F.map_filter(fields, lambda k, v: ~F.array_contains(kept, k) & ~F.is_variant_null(v))
    return typed.select(
        *[F.col("_typed")[n].alias(n) for n in names],
        F.when(F.size(rest) > 0, F.to_json(rest)).alias(RESCUED),
        F.when(fields.isNull(), F.coalesce(F.to_json("record"), F.col(payload))).alias(MALFORMED),
        *[F.col(f"`{c}`") for c in recs.columns if c not in (payload, "record", "_fields", *names)])


def read_drifting(spark: SparkSession, root: str, *, whole_files: bool = False, schema: StructType = VENDOR_SCHEMA) -> DataFrame:
    """Vendor records with ``ticker``, ``rescued`` and ``malformed`` (compare ``vendor.read_payloads``)."""
    return conform(records(payload_texts(spark, root, whole_files=whole_files)), schema)
