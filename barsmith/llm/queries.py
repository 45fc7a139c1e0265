"""One query per operator, over its whole intended table, with its contract's parameters."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm.common import read_table


def id_crc(doc_id: str) -> Column:
    """crc32 of the id as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barsmith.llm.line_dedup import dedup_lines

    out = dedup_lines(read_table(spark, sf_dir, "documents"), min_chars=40, min_documents=5)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barsmith.llm.simhash import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barsmith.llm.warc import summary, write_archives

    out = summary(write_archives(read_table(spark, sf_dir, "pages"), min_bytes=0))
    return out.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


# The contract's rules (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barsmith.llm.urls import judge

    out = judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, default="allow")
    return out.select("page_id", "host", "path", "rule", "verdict")


#: Scores under this are predicted 0.
QUALITY_THRESHOLD = 0.3


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barsmith.llm.quality import learn, score

    docs = read_table(spark, sf_dir, "documents")
    remainder = id_crc("doc_id") % 5
    model = learn(docs, read_table(spark, sf_dir, "labels"), remainder != 0)
    return score(docs, model).select(
        "doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barsmith.llm.ann import nearest

    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from barsmith.llm.tokens import token_counts

    out = token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barsmith.llm.langid import dictionaries, identify

    docs = read_table(spark, sf_dir, "documents")
    remainder = id_crc("doc_id") % 4
    out = identify(docs, dictionaries(docs, remainder != 2))
    return out.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"),
                      F.col("lang_best").alias("lang_pred"), F.col("lang_score").alias("score"),
                      (F.col("lang_id") != F.col("lang_best")).alias("rejected"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barsmith.llm.decontaminate import matches

    return matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labels table: toxic, else low (quality 0), else clean."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))


#: Target weights of the domains in the mix, over all tokens.
MIX_TARGETS = {"clean": 0.9, "low": 0.08, "toxic": 0.02}


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barsmith.llm.mixing import mix

    out = mix(read_table(spark, sf_dir, "documents"), label_domains(read_table(spark, sf_dir, "labels")), MIX_TARGETS)
    return out.select("doc_id", "n_tokens", "domain", *[F.col("posteriors")[d].alias(f"p_{d}") for d in sorted(MIX_TARGETS)], "rate")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barsmith.llm.prefix_trie import build, conversation_turns, ends_digest, with_borrowed_starts

    c = F.col("conv_id")
    convs = conversation_turns(read_table(spark, sf_dir, "conversations"))
    out = ends_digest(*build(with_borrowed_starts(convs, c - c % 100, (id_crc("conv_id") % 6).cast("int"), most=5)))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barsmith.llm.filter_audit import audit

    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from barsmith.llm.packing import pack

    out = pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_url_filter": op4_url_filter,
    "op5_quality": op5_quality,
    "op6_neighbours": op6_neighbours,
    "op7_token_counts": op7_token_counts,
    "op8_language_id": op8_language_id,
    "op9_decontaminate": op9_decontaminate,
    "op10_mixing": op10_mixing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_packing": op13_packing,
}
