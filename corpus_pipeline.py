"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all the documents that the stage before
kept; ``run`` writes its result as Parquet in the shared folder and reads it back as
the next one's input. All stages but the last return the columns of ``documents``; the last
adds n_tokens, posteriors, domain and rate.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from barsmith.llm import decontaminate, line_dedup, mixing, quality, simhash  # noqa: E402
from barsmith.llm.common import free_name, read_table, stored  # noqa: E402
from barsmith.llm.queries import QUALITY_THRESHOLD, id_crc, label_domains  # noqa: E402

#: Target weights of the final mix: clean text only. Documents whose likeliest domain has
#: target 0 leave the corpus, whatever their rate.
TARGETS = {"clean": 1.0, "low": 0.0, "toxic": 0.0}


def _same_columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at the threshold or above.

    Every row is judged by its own text, whatever its id; null and empty texts have a score like
    others. Without labels of both kinds the score is a constant (1 if only good ones are known, 0.5
    without any), so all or none stay."""
    model = quality.learn(docs, read_table(spark, sf_dir, "labels"), id_crc("doc_id") % 5 != 0)
    name = free_name(docs.columns, "_quality")
    scored = quality.score(docs, model, name=name)
    return _same_columns(scored.filter(F.col(name) >= QUALITY_THRESHOLD), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; n_chars follows the text. No document goes: one that
    consists of repeated lines stays with an empty text. Null texts stay null."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        dropped = F.col(free_name(docs.columns, "n_dropped"))
        out = out.withColumn("n_chars", F.when(dropped > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return _same_columns(out, docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates, that with the smallest doc_id. Null and empty texts
    are near-duplicates of each other. Of equal rows one stays; null ids come last."""
    return simhash.one_of_each(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, copied or edited. Rows that share a doc_id go together;
    rows without one are judged each by its own text. Without benchmark items all stay."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose likeliest domain has a place in the target mix, with their rate. The rate
    itself decides nothing: how near to 0 it comes depends on when the fit stops. Without any
    labelled row there are no domains, and every document stays. Every row is judged by its own text. The
    columns that the stage adds get underscores in front where their names are taken."""
    out = mixing.mix(docs, label_domains(read_table(spark, sf_dir, "labels")), TARGETS)
    domain = F.col(free_name(docs.columns, "domain"))
    wanted = [d for d, weight in TARGETS.items() if weight > 0]
    return out.filter(domain.isNull() | domain.isin(wanted))


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_each),
    ("decontaminate", drop_contaminated),
    ("mixing", mix),
]

#: The classifiers, fingerprints and alignment are beyond SQL; tests hold every stage against
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
