"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Words are runs of letters, marks and digits (by Unicode class) of the lower-cased text; in scripts
that are written without spaces every character is a word. Seeds are 64-bit hashes of words.

1. Every seed of a test item counts: three words on end, and three of four on end with the third left
   out. None is left out for being frequent, so copies that are edited or partial are found whatever other
   documents hold of the item, also with every third word another. An alignment that shares no seed of either
   shape with its item (every second word edited) is not found.
2. One pass over the documents finds the seeds. Around them it cuts windows as wide as the
   items that may hold the seed: items are taken by classes of length (up to 64 words, 256, 1,024
   and so on), so a long item doesn't widen the windows of short ones. Overlapping windows are one.
   Windows and items meet by an equi-join on the seed, as pairs of numbers.
3. Most pairs share no more than a common phrase. A pair goes on only if some stretch of the window, as long
   as an alignment of the wanted sum can be, holds enough words of the item, each counted as often as
   the item has it. This bound is exact: no pair that could reach the sum is lost.
4. The windows of an item that are left are aligned with it together, word by word (match 1,
   mismatch and gap -``penalty``). Score: the best local alignment's sum over the item's number
   of words. A pair of document and item with at least ``min_score`` and ``min_matches`` in its
   best alignment's sum (or the whole item, if shorter) is contamination.

The pass probes bitmaps of fixed size (``filter_bits``, 8 MB, one per length class) that are broadcast
whatever the size of the benchmark; the seeds they let through meet the exact ones in a join, and the
alignment compares words, not hashes.

Items of fewer than three words can't be told from chance and match nothing. Null texts are
empty. Null doc_ids and item_ids are reported as null, as one document or by item text. Texts of any
length are read whole, in blocks cut between words; a single word of over 512 KB is cut.
Rows that repeat a doc_id are one document; repeated items are one item. Of several alignments of the best
score the first is reported. Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import free_name, stored

#: Places of the words of a seed: three on end, and three with one left out.
Shapes = tuple[tuple[int, ...], ...]
SHAPES: Shapes = ((0, 1, 2), (0, 1, 3))
#: Scripts written without spaces between words.
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
#: Items are taken by length: up to SHORTEST words, then up to 4 times as many, and so on.
SHORTEST = 64
#: Cells of one table in which windows are aligned together.
CELLS = 1 << 17
#: Bytes that are split into words at once.
BLOCK = 1 << 18
SEGMENTS = 256
_ODD = 0x9E3779B97F4A7C15
_TABLES: dict[str, np.ndarray] = {}


def _tables() -> dict[str, np.ndarray]:
    """Per byte: is it part of a word, and a random number; powers of an odd base and of its
    inverse modulo 2^64, one for each place in a block."""
    if not _TABLES:
        word = np.zeros(256, bool)
        word[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)]] = True
        with np.errstate(over="ignore"):
            up = np.cumprod(np.full(2 * BLOCK, _ODD, np.uint64))
            down = np.cumprod(np.full(2 * BLOCK, pow(_ODD, -1, 1 << 64), np.uint64))
        _TABLES.update(word=word, value=np.random.default_rng(11).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1), up=up, down=down)
    return _TABLES


class _Plain(dict):
    """Character number -> what stands for it: letters, marks and digits stay, characters of unspaced
    scripts stand apart, all others are blanks."""

    def __missing__(self, number: int) -> str:
        c = chr(number)
        kept = f" {c} " if regex.match(UNSPACED, c) else c if c.isascii() or regex.match(r"[\p{L}\p{M}\p{N}]", c) else " "
        self[number] = kept
        return kept


_PLAIN = _Plain()
#: Bytes that can begin a character other than a letter of the Latin, Greek or Cyrillic scripts.
_OTHER = regex.compile(rb"[\xc2\xcb-\xcd\xd2\xd5-\xdf\xe0-\xf4]|\xc3[\x97\xb7]").search


def plain_bytes(text: str | None) -> bytes:
    """Lower-cased UTF-8 in which every byte from 128 on belongs to a letter, mark or digit."""
    low = (text or "").lower()
    raw = low.encode("utf-8", "replace")
    if low.isascii() or not _OTHER(raw):
        return raw
    return low.translate(_PLAIN).encode("utf-8", "replace")


def words_in(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word in at most 2 * BLOCK bytes."""
    t = _tables()
    is_word = t["word"][block]
    edges = np.flatnonzero(np.diff(is_word, prepend=False, append=False))
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start, end
    with np.errstate(over="ignore"):
        sums = np.cumsum(t["value"][block] * t["up"][:len(block)])
        h = sums[end - 1] - np.where(start > 0, sums[start - 1], np.uint64(0))
        h *= t["down"][start]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32)), start, end


def seeds_of(hashes: np.ndarray, shapes: Shapes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the seeds of all shapes, in the order of their first words."""
    found, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for number, shape in enumerate(shapes):
        n = len(hashes) - shape[-1]
        if n <= 0:
            continue
        with np.errstate(over="ignore"):
            out = np.full(n, number, np.uint64)
            for i in shape:
                out = out * np.uint64(_ODD) + hashes[i:n + i]
            found.append(out ^ (out >> np.uint64(31)))
        at.append(np.arange(n))
    grams, place = np.concatenate(found), np.concatenate(at)
    order = np.argsort(place, kind="stable")
    return grams[order], place[order]


def split(texts: Iterator[str | None]) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(number, bytes, hashes, starts, ends) of the words of each text, many texts at a time."""
    group: list[tuple[int, bytes]] = []
    size = 0

    def run():
        offsets = np.cumsum([0] + [len(t) + 1 for _, t in group])
        h, s, e = words_in(np.frombuffer(b" ".join(t for _, t in group), np.uint8))
        cuts = np.searchsorted(s, offsets)
        for (i, t), o, a, b in zip(group, offsets, cuts, cuts[1:], strict=False):
            yield i, t, h[a:b], s[a:b] - o, e[a:b] - o

    word = _tables()["word"]
    for i, text in enumerate(texts):
        t = plain_bytes(text)
        if len(t) <= BLOCK:
            group.append((i, t))
            size += len(t) + 1
            if size > BLOCK:
                yield from run()
                group, size = [], 0
            continue
        parts, at = [], 0
        raw = np.frombuffer(t, np.uint8)
        while at < len(t):  # long texts block by block, cut between words
            stop = min(len(t), at + BLOCK)
            gap = np.flatnonzero(~word[raw[stop:stop + BLOCK]])
            stop = min(len(t), stop + (int(gap[0]) if len(gap) else BLOCK))  # a longer "word" is cut
            h, s, e = words_in(raw[at:stop])
            parts.append((h, s + at, e + at))
            at = stop
        yield i, t, *(np.concatenate(x) for x in zip(*parts, strict=True))
    if group:
        yield from run()


def _bit(h: np.ndarray, bits: int) -> np.ndarray:
    return h >> np.uint64(64 - bits.bit_length() + 1)


def _let_through(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    at = _bit(h, bits)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bitmaps_of(hashes: DataFrame, bits: int) -> dict[int, np.ndarray]:
    """A bitmap of ``bits`` bits for each class, one bit per hash, of the columns (class int, hash long).
    Tasks build segments; what comes to the driver is as long as the bitmaps."""
    width = bits // SEGMENTS

    def build(batches):
        own: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            kind = b.column(0).to_numpy().astype(np.int64)
            at = _bit(b.column(1).to_numpy().view(np.uint64), bits).astype(np.int64)
            part = kind * SEGMENTS + at // width
            for p in np.unique(part):
                m = own.setdefault(divmod(int(p), SEGMENTS), np.zeros(width // 8, np.uint8))
                x = at[part == p] % width
                np.bitwise_or.at(m, x >> 3, np.uint8(1) << (x & 7).astype(np.uint8))
        for (k, s), m in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([s], pa.int32()), pa.array([m.tobytes()], pa.binary())],
                                             names=["class", "segment", "bitmap"])

    kind, column = hashes.columns
    rows = (hashes.repartition(kind, F.shiftrightunsigned(F.col(column), 64 - SEGMENTS.bit_length() + 1))
            .mapInArrow(build, "class int, segment int, bitmap binary"))
    out: dict[int, np.ndarray] = {}
    for r in rows.collect():
        out.setdefault(r["class"], np.zeros((SEGMENTS, width // 8), np.uint8))[r["segment"]] |= np.frombuffer(r["bitmap"], np.uint8)
    return {k: m.reshape(-1) for k, m in out.items()}


def _reachable(codes: np.ndarray, window: np.ndarray, n_windows: int, caps: np.ndarray, span: int) -> np.ndarray:
    """Per window the most words of the item in any ``span`` words on end, each word counted as often
    as ``caps`` says. ``codes`` are the words of all windows on end (-1: not of the item), ``window``
    the number of each one's window.

    An occurrence counts for a stretch if fewer than its cap are in the stretch before it, so for the
    stretches that begin after the occurrence that many places before.
    """
    at = np.flatnonzero(codes >= 0)
    most = np.zeros(n_windows, np.int64)
    if not len(at):
        return most
    word = window[at] * len(caps) + codes[at]
    order = np.argsort(word, kind="stable")
    sorted_at, sorted_word = at[order], word[order]
    back = np.arange(len(at)) - caps[codes[sorted_at]]
    same = (back >= 0) & (sorted_word[np.maximum(back, 0)] == sorted_word)
    first = np.maximum(np.where(same, sorted_at[np.maximum(back, 0)] + 1, 0), sorted_at - span + 1)
    # stretches do not reach from one window into the next
    begin = np.flatnonzero(np.diff(window, prepend=-1))
    start_of = np.zeros(n_windows, np.int64)
    start_of[window[begin]] = begin
    first = np.maximum(first, start_of[window[sorted_at]])
    change = np.bincount(first, minlength=len(codes) + 1) - np.bincount(sorted_at + 1, minlength=len(codes) + 1)
    held = np.cumsum(change[:-1])
    most[window[begin]] = np.maximum.reduceat(held, begin)
    return most


def align(item: list[str], window: list[str], penalty: float, least: float = 0.0) -> tuple[float, int, int]:
    """``align_all`` for one window."""
    return align_all(item, [window], penalty, least)[0]


def align_all(item: list[str], windows: list[list[str]], penalty: float, least: float = 0.0) -> list[tuple[float, int, int]]:
    """(sum, first, last word) of the best local alignment of ``item`` with each window, spans in the
    window; zeros where it is plain that the sum is under ``least``."""
    numbers: dict[str, int] = {}
    a = [numbers.setdefault(w, len(numbers)) for w in item]
    lengths = np.array([len(w) for w in windows])
    codes = np.array([numbers.get(w, -1) for words in windows for w in words], np.int64)
    bounds = np.append(0, np.cumsum(lengths))
    # Each gap along the window costs the penalty, so an alignment with that sum spans at most
    # this many words, and its sum is at most the words of the item among them.
    longest = int(lengths.max(initial=0))
    span = min(longest, len(a) + int(max(0.0, len(a) - least) / penalty) + 1) if penalty > 0 else longest
    most = _reachable(codes, np.repeat(np.arange(len(windows)), lengths), len(windows), np.bincount(a), max(1, span))
    out = [(0.0, 0, 0)] * len(windows)
    able = np.flatnonzero((most >= least) & (lengths > 0))
    able = able[np.argsort(lengths[able], kind="stable")]
    at = 0
    while at < len(able):  # windows of about one length together
        n = max(1, CELLS // int(lengths[able[at]] + 1))
        group = able[at: at + n]
        if len(group) > 1:  # no more cells than that with the longest one's length
            group = group[: max(1, CELLS // int(lengths[group[-1]] + 1))]
        at += len(group)
        b = np.full((len(group), int(lengths[group[-1]])), -1, np.int64)
        for i, g in enumerate(group):
            b[i, : lengths[g]] = codes[bounds[g]: bounds[g + 1]]
        for g, found in zip(group, _align_group(a, b, penalty), strict=True):
            out[g] = found
    return out


def _align_group(a: list[int], b: np.ndarray, penalty: float) -> list[tuple[float, int, int]]:
    """``align_all`` for windows of word numbers, one a row, filled up with -1 behind."""
    n, m = b.shape
    place = np.arange(m, dtype=np.int32)
    slope = (penalty * place).astype(np.float64)
    row, first = np.zeros((n, m + 1)), np.tile(np.arange(m + 1, dtype=np.int32), (n, 1))  # row[., j]: best alignment that ends with word j - 1
    best, span = np.zeros(n), np.zeros((n, 2), np.int64)
    rows = np.arange(n)
    for x in a:
        diagonal = row[:, :-1] + np.where(b == x, 1.0, -penalty)
        began = np.where(row[:, :-1] > 0, first[:, :-1], place)
        above = row[:, 1:] - penalty
        began = np.where(diagonal >= above, began, first[:, 1:])
        # Gaps along the window: a running maximum that falls by the penalty at each step.
        lifted = np.maximum(np.maximum(diagonal, above), 0.0) + slope
        top = np.maximum.accumulate(lifted, axis=1)
        source = np.maximum.accumulate(np.where(lifted >= top, place, 0), axis=1)
        row[:, 1:] = top - slope
        first[:, 1:] = np.take_along_axis(began, source, axis=1)
        j = row.argmax(axis=1)
        value = row[rows, j]
        better = value > best
        best[better] = value[better]
        span[better, 0], span[better, 1] = first[rows, j][better], j[better] - 1
    return [(float(s), int(lo), int(hi)) for s, (lo, hi) in zip(best, span, strict=True)]


def matches(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
            item_text: str = "text", shapes: Shapes = SHAPES, penalty: float = 0.5, min_score: float = 0.4,
            min_matches: float = 6.0, filter_bits: int = 1 << 26) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): each contaminated pair once, with its
    best alignment's score and its span in words of the document."""
    spark, width = docs.sparkSession, max(shape[-1] for shape in shapes) + 1

    def item_rows(batches):
        for b in batches:
            out = []
            for i, t, h, s, e in split(b.column(1).to_pylist()):
                out.append({"item": b.column(0)[i].as_py(), "words": " ".join(t[x:y].decode("utf-8", "replace") for x, y in zip(s, e, strict=True)),
                            "n_words": len(h), "grams": np.unique(seeds_of(h, shapes)[0]).view(np.int64).tolist()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("item", pa.int64()), ("words", pa.string()), ("n_words", pa.int32()), ("grams", pa.list_(pa.int64()))]))

    given = benchmark.select(F.col(item_id).alias("item_id"), F.coalesce(item_text, F.lit("")).alias("t")).distinct()
    given = given.withColumn("item", F.xxhash64("item_id", "t"))
    items = stored(given.select("item", "t").mapInArrow(item_rows, "item long, words string, n_words int, grams array<long>"), "items")
    length_class = F.greatest(F.lit(0), F.ceil(F.log(4.0, F.col("n_words") / F.lit(SHORTEST)))).cast("int")
    item_grams = items.select("item", length_class.alias("class"), F.explode("grams").alias("gram"))
    seeds = spark.sparkContext.broadcast(bitmaps_of(item_grams.select("class", "gram"), filter_bits))

    def cut(batches):
        schema = pa.schema([("at", pa.int64()), ("class", pa.int32()), ("start", pa.int32()), ("words", pa.string()), ("grams", pa.list_(pa.int64()))])
        for b in batches:
            out = []
            for i, t, h, s, e in split(b.column(1).to_pylist()):
                g, place = seeds_of(h, shapes)
                for kind, bitmap in seeds.value.items():
                    hits, reach = np.flatnonzero(_let_through(bitmap, g, filter_bits)), SHORTEST * 4 ** kind
                    if not len(hits):
                        continue
                    for part in np.split(hits, np.flatnonzero(np.diff(place[hits]) > 2 * reach + width) + 1):
                        lo, hi = max(0, int(place[part[0]]) - reach), min(len(h), int(place[part[-1]]) + width + reach)
                        out.append({"at": i, "class": kind, "start": lo, "grams": np.unique(g[part]).view(np.int64).tolist(),
                                    "words": " ".join(t[x:y].decode("utf-8", "replace") for x, y in zip(s[lo:hi], e[lo:hi], strict=True))})
            table = pa.RecordBatch.from_pylist(out, schema=schema)
            yield pa.RecordBatch.from_arrays([b.column(0).take(table.column(0)), *table.columns[1:]], names=["d", "class", "start", "words", "grams"])

    kind = docs.schema[doc_id].dataType.simpleString()
    windows = stored(docs.select(doc_id, text).mapInArrow(cut, f"d {kind}, class int, start int, words string, grams array<long>")
                     .withColumn("window", F.xxhash64("d", "class", "start", "words")), "windows")

    pairs = (windows.select("window", "class", F.explode("grams").alias("gram")).join(item_grams, ["class", "gram"])
             .select("window", "item").distinct())

    @F.pandas_udf("sum double, first int, last int")
    def aligned(item: pd.Series, window: pd.Series) -> pd.DataFrame:
        found: list = [None] * len(item)
        for words, at in item.groupby(item.values).indices.items():
            a = words.split(" ")
            least = max(min_score * len(a), min(min_matches, len(a))) - 1e-6
            for i, result in zip(at, align_all(a, [window.iat[i].split(" ") for i in at], penalty, least), strict=True):
                found[i] = result
        return pd.DataFrame(found, columns=["sum", "first", "last"])

    found = (pairs.join(items.select("item", F.col("words").alias("item_words"), "n_words"), "item")
             .join(windows.select("window", "d", "start", "words"), "window")
             .withColumn("a", aligned("item_words", "words"))
             .select("d", "item", (F.col("a.sum") / F.col("n_words")).alias("score"), F.col("a.sum").alias("sum"), "n_words",
                     (F.col("start") + F.col("a.first")).alias("first_word"), (F.col("start") + F.col("a.last")).alias("last_word"))
             .filter((F.col("score") >= min_score) & (F.col("sum") >= F.least(F.lit(min_matches), F.col("n_words")))))
    best = found.groupBy("d", "item").agg(F.max(F.struct("score", -F.col("first_word"), "last_word")).alias("m"))
    return best.join(given.select("item", "item_id"), "item").select(
        F.col("d").alias("doc_id"), "item_id", F.col("m.score").alias("score"), (-F.col("m.col2")).alias("first_word"), F.col("m.last_word").alias("last_word"))


def clean(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents. Rows with null doc_id are judged each by its
    own text; other rows that share a doc_id are one document."""
    row = free_name(docs.columns, "_document")
    own = F.concat(F.lit("text "), F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    known = docs.withColumn(row, F.when(F.col(doc_id).isNull(), own).otherwise(F.concat(F.lit("id "), F.col(doc_id).cast("string"))))
    gone = matches(known, benchmark, doc_id=row, text=text, **options).select(F.col("doc_id").alias(row)).distinct()
    return known.join(stored(gone, "contaminated"), row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
