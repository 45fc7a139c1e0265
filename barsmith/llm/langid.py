"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of excerpts of labelled texts.
A text is lower-cased, runs of other characters than letters become one blank, and it is
compressed with every dictionary, in chunks of ``CHUNK`` bytes over its whole length; the
language with the fewest bytes in all wins. A margin (second over best, less
one) under ``min_margin`` is narrow: the operator then rejects, giving ``und``.

The dictionaries are fitted on a bounded sample: about ``sample_rows`` labelled texts per
language, chosen by a hash of their id at a rate taken from the language's count, and of
each one excerpt of ``excerpt`` characters from a hashed place; ``dictionary_bytes`` per
language at most. Rare languages keep all their rows. The driver holds that sample only.

Null texts and texts without a letter are ``und`` with score 0; so is every text if
nothing was learned. Rows with null language or null ``learn`` condition teach nothing. Of equal sizes the
language with most labelled texts wins. Rows are judged each by its own text, whatever ids repeat; texts of any
length are read whole. An empty table gives no rows. Extra columns pass through; result columns get underscores
in front where their names are taken.
"""

from __future__ import annotations

import math
import re
from typing import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import free_name

CHUNK = 4096
#: The encoder's level, for texts of every length: it tells languages apart as well as any higher one.
LEVEL = 9
#: Steepness of the score: an excess of 1 / STEEP in relative size divides the weight by e.
STEEP = 60.0
NO_LETTERS = re.compile(r"[\W\d_]+")


def dictionaries(docs: DataFrame, learn: Column, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
                 sample_rows: int = 1000, excerpt: int = 200, dictionary_bytes: int = 1 << 17) -> dict[str, bytes]:
    """Language -> raw dictionary content, from the rows where ``learn`` holds."""
    known = docs.filter(learn & F.col(lang).isNotNull() & (F.length(text) > 0))
    counts = {r["l"]: r["n"] for r in known.groupBy(F.col(lang).alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    rate = F.lit(0.0)
    for l, n in counts.items():
        rate = F.when(F.col(lang) == l, F.lit(min(1.0, sample_rows / n))).otherwise(rate)
    h = F.xxhash64(F.col(doc_id).cast("string"))
    chosen = known.filter(F.pmod(h, F.lit(1 << 20)) < rate * (1 << 20)).select(
        F.col(lang).alias("l"), h.alias("h"),
        F.substring(text, F.lit(1) + F.pmod(F.shiftright(h, 20), F.greatest(F.length(text) - excerpt, F.lit(0)) + 1).cast("int"),
                    F.lit(excerpt)).alias("x"))
    out: dict[str, dict[str, None]] = {l: {} for l in counts}
    for r in sorted(chosen.collect(), key=lambda r: (r["l"], r["h"])):  # about sample_rows a language
        out[r["l"]][r["x"]] = None  # copies of a text at the same place teach once
    # The commonest language first: it wins ties.
    return {l: words_only("\n".join(out[l]))[:dictionary_bytes]
            for l in sorted(out, key=lambda l: (-counts[l], l)) if out[l]}


def words_only(text: str) -> bytes:
    return NO_LETTERS.sub(" ", text.lower()).encode()


def sizes_with(dicts: dict[str, bytes]):
    """text -> compressed bytes with each dictionary, summed over the whole text."""
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    encoders = []
    for content in dicts.values():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        encoders.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress)

    def sizes(text: str) -> list[int]:
        raw = words_only(text)
        chunks = [raw[i:i + CHUNK] for i in range(0, len(raw), CHUNK)]
        return [sum(len(c(x)) for x in chunks) for c in encoders]

    return sizes


def identify(docs: DataFrame, dicts: dict[str, bytes], *, text: str = "text", min_margin: float = 0.01) -> DataFrame:
    """``docs`` with lang_best (the smallest encoding's language, ``und`` without letters),
    lang_id (the same, but ``und`` where the margin is narrow), lang_score (0 to 1) and
    lang_margin."""
    shared = docs.sparkSession.sparkContext.broadcast(dict(dicts))

    @F.pandas_udf("best string, score double, margin double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, sizes = list(shared.value), sizes_with(shared.value)

        def one(t):
            if not t or not names or not any(map(str.isalpha, t)):
                return "und", 0.0, 0.0
            n = sizes(t)
            least = min(n)
            weights = [math.exp(-STEEP * (x / least - 1)) for x in n]
            second = sorted(n)[1] if len(n) > 1 else 2 * least
            return names[n.index(least)], 1 / sum(weights), second / least - 1

        for texts in batches:
            yield pd.DataFrame([one(t) for t in texts], columns=["best", "score", "margin"])

    j = free_name(docs.columns, "_judged")
    names = [free_name(docs.columns, c) for c in ("lang_best", "lang_id", "lang_score", "lang_margin")]
    got = docs.withColumn(j, judge(F.col(f"`{text}`")))
    return got.select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col(f"{j}.best").alias(names[0]),
        F.when(F.col(f"{j}.margin") < min_margin, "und").otherwise(F.col(f"{j}.best")).alias(names[1]),
        F.col(f"{j}.score").alias(names[2]), F.col(f"{j}.margin").alias(names[3]))
