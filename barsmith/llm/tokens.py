"""Token counts of a byte-level BPE vocabulary with the whole-token shortcut.

The vocabulary comes from a ``tokenizer.json`` (byte-level pre-tokenizer, BPE model). Once
per job the driver proves which vocabulary strings stand alone as one token: a string
is proven if the pre-tokenizer leaves it whole and its characters, merged from scratch,
end in a single token. Executors split each text into pre-tokens; a proven one counts
one without any merging, and only the rest go through the model's merges. Counts are
remembered per Python worker, for up to ``REMEMBERED`` short strings. Special strings
inside a text are one token each, as the library treats them by default.

The broadcast holds the vocabulary file and the proven strings: its size is that of the
file. Texts of any length go through in blocks that end where a pre-token
must end. Null text: zero bytes and tokens. Rows are counted each by its own text; an empty table gives no rows. Null ids and extra columns pass through; result
columns get underscores in front where the table has their names.
"""

from __future__ import annotations

import json
from typing import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barsmith.llm.common import free_name

# Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A pre-token always ends between a letter and a blank that does not end the text.
BOUNDARY = r"(?<=\p{L})(?= \S)"
REMEMBERED = 400_000
BLOCK_CHARS = 1 << 20


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable Latin-1, else the next
    free one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Vocabulary:
    """The specification, proven whole tokens (as text) and special strings of a tokenizer.json."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = f.read()
        spec = json.loads(self.spec)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or model.get("ignore_merges") or model.get("dropout") or spec.get("normalizer")
                or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        to_byte = {c: b for b, c in enumerate(byte_symbols())}
        whole, merge = regex.compile(PATTERN), Tokenizer.from_str(self.spec).model.tokenize
        self.proven: set[str] = set()
        for token in model["vocab"]:
            if token in self.special or any(c not in to_byte for c in token):
                continue
            try:
                text = bytes(to_byte[c] for c in token).decode()
            except UnicodeDecodeError:
                continue  # a part of a character is never a pre-token
            if whole.fullmatch(text) and len(merge(token)) == 1:
                self.proven.add(text)


class _Pieces(dict):
    """Pre-token -> tokens: proven strings are there from the start, the rest are merged."""

    def __init__(self, spec: str, proven: set[str]):
        super().__init__(dict.fromkeys(proven, 1))
        self.merge, self.symbols = Tokenizer.from_str(spec).model.tokenize, byte_symbols()
        self.most = len(self) + REMEMBERED

    def __missing__(self, piece: str) -> int:
        n = len(self.merge("".join([self.symbols[b] for b in piece.encode()])))
        if len(self) < self.most and len(piece) < 64:
            self[piece] = n
        return n


class _Unsafe(Exception):
    """The stretch before a blank ends in white space: the blank may belong to a longer run."""


class _Stretches(dict):
    """Text between two blanks -> tokens of it with the blank in front.

    A single blank after a character that is no white space always starts a pre-token, so
    the stretches between such blanks can be counted, and remembered, on their own.
    """

    def __init__(self, pieces: _Pieces):
        super().__init__()
        self.pieces, self.split = pieces.__getitem__, regex.compile(PATTERN).findall

    def __missing__(self, stretch: str) -> int:
        if not stretch or stretch[-1].isspace():
            raise _Unsafe
        n = sum(map(self.pieces, self.split(" " + stretch)))
        if len(self) < REMEMBERED and len(stretch) < 64:
            self[stretch] = n
        return n


def blocks(text: str) -> Iterator[str]:
    if len(text) <= BLOCK_CHARS:
        yield text
        return
    boundary, at = regex.compile(BOUNDARY), 0
    while at < len(text):
        m = boundary.search(text, at + BLOCK_CHARS)
        end = m.start() if m else len(text)
        yield text[at:end]
        at = end


def counter(spec: str, proven: set[str], special: list[str]):
    """text -> number of tokens."""
    pieces, split = _Pieces(spec, proven), regex.compile(PATTERN).findall
    stretches = _Stretches(pieces)
    apart = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))).split if special else None

    def plain(text: str) -> int:
        first, *others = text.split(" ")
        try:
            if others and (not first or first[-1].isspace()):
                raise _Unsafe
            return sum(map(pieces.__getitem__, split(first))) + sum(map(stretches.__getitem__, others))
        except _Unsafe:
            return sum(map(pieces.__getitem__, split(text)))

    def count(text: str) -> int:
        parts = apart(text) if apart else [text]
        return len(parts) - 1 + sum(plain(b) for p in parts for b in blocks(p))

    return count


def token_counts(docs: DataFrame, vocabulary_path: str, *, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``)."""
    v = Vocabulary(vocabulary_path)
    shared = docs.sparkSession.sparkContext.broadcast((v.spec, v.proven, v.special))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(*shared.value)
        for texts in batches:
            yield pd.Series([count(t) if t else 0 for t in texts], dtype="int64")

    n_bytes, n_tokens, over = (free_name(docs.columns, c) for c in ("n_bytes", "n_tokens", "over_limit"))
    return (docs.withColumn(n_tokens, tokens(F.col(f"`{text}`")))
            .withColumn(n_bytes, F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long"))
            .withColumn(over, F.col(n_tokens) > limit))
