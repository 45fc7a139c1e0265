"""Packing documents into training windows by Karmarkar-Karp multiway differencing.

A document's ids are the tokenizer's, then the end id. Whole windows are cut off a document
that is longer than one; what remains of each document is an item. Items are packed in
batches of about ``batch_tokens`` ids, inside the tasks that read them:

1. Multiway differencing: every item starts as a partial partition whose window sums are
   one item and otherwise empty. The two partitions of largest imbalance are merged, the
   heaviest windows of one onto the lightest of the other, until one partition is left. Its
   windows are nearly equal. Where one exceeds the capacity the number of windows rises, and
   the differencing runs again.
2. Near-equal windows still miss a few ids each. Documents may be cut, so the windows that
   the total doesn't need are taken apart again and poured into these gaps: every
   window but those is then full, and at most one document is cut for each.
3. What is left over, less than a window, goes on to the next batch. At the end of a partition it
   is cut into windows whose lengths are powers of two, which take no padding.

There is no shuffle: a window never crosses a partition of ``docs``, the ids of one batch and
one document are the most a task holds, and nothing is collected. Windows are
numbered by partition and order, so a task that is run again numbers them alike; partitions
read from files or a stored table hold the same rows each time.

Defined results: null text is an empty text, which has the end id alone. Repeated rows and
null ids are documents of their own (their pieces can't be told apart by doc_id). Very long texts
are encoded in blocks that end where a pre-token must end. Equal lengths keep the order
in which they were read. An empty table gives no rows. Extra columns are ignored, and columns
of ``docs`` that are named like the results don't matter, for results hold only their own.
"""

from __future__ import annotations

import heapq
import math
from array import array
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barsmith.llm.tokens import BLOCK_CHARS, PATTERN, blocks, byte_symbols

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Windows of one partition: the partition's number takes the bits above these.
WINDOW_BITS = 40


#: Marks that are a pre-token of their own between a letter and a blank.
_MARKS = {".", ",", ";", ":", "!", "?"}
#: Words and other pieces that a Python worker remembers (about 200 bytes each).
WORDS, PIECES = 800_000, 200_000
#: Bytes of texts whose words are looked up together.
TOGETHER = 8 << 20


class _PieceIds(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit numbers, by the library's model."""

    def __init__(self, spec: str):
        super().__init__()
        self.merge, self.symbols = Tokenizer.from_str(spec).model.tokenize, dict(enumerate(byte_symbols()))
        self.blank = self.symbols[32]

    def ids(self, piece: str) -> bytes:
        merged = self.merge(piece.encode().decode("latin-1").translate(self.symbols))
        return array("I", [t.id for t in merged]).tobytes()

    def word(self, word: str) -> bytes:
        """The ids of a word of letters with a blank in front."""
        if not word.isascii():
            return self.ids(" " + word)
        return array("I", [t.id for t in self.merge(self.blank + word)]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.ids(piece)
        if len(self) < PIECES and len(piece) < 64:
            self[piece] = ids
        return ids


class _WordIds(dict):
    """The text between two blanks -> ids of it with the blank in front; None where it ends in
    white space, so that the blank after it may belong to a longer run."""

    def __init__(self, pieces: _PieceIds):
        super().__init__()
        self.pieces, self.split = pieces, regex.compile(PATTERN).findall

    def __missing__(self, word: str) -> bytes | None:
        if word.isalpha():  # one pre-token
            ids = self.pieces.word(word)
        elif word[-1:] in _MARKS and word[:-1].isalpha():  # two
            ids = self[word[:-1]] + self.pieces[word[-1]]
        elif not word or word[-1].isspace():
            ids = None
        else:
            first, *others = self.split(" " + word)
            ids = self[first[1:]] if first[1:].isalpha() else self.pieces[first]
            ids += b"".join(map(self.pieces.__getitem__, others))
        if len(self) < WORDS and len(word) < 64:
            self[word] = ids
        return ids


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, by a byte-level BPE ``tokenizer.json``.

    Special strings inside a text become their id, as the library does by default. The rest
    is split into pre-tokens, whose ids the library's model gives; they are remembered. A single blank after a
    character that is no white space always starts a pre-token, so the words between
    blanks are encoded on their own.
    """

    def __init__(self, spec: str):
        special = {t.content: i for i, t in Tokenizer.from_str(spec).get_added_tokens_decoder().items()}
        self.special = {s: array("I", [i]).tobytes() for s, i in special.items()}
        either = "|".join(map(regex.escape, sorted(special, key=len, reverse=True)))
        self.apart = regex.compile(f"({either})").split if special else lambda text: [text]
        self.pieces, self.split = _PieceIds(spec), regex.compile(PATTERN).findall
        self.words = _WordIds(self.pieces)

    def __call__(self, text: str) -> bytes:
        return b"".join(self.special[p] if i % 2 else b"".join(map(self._plain, blocks(p))) for i, p in enumerate(self.apart(text)) if p)

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def _plain(self, text: str) -> bytes:
        first, *others = text.split(" ")
        if not others or (first and not first[-1].isspace()):
            found = list(map(self.words.__getitem__, others))
            if None not in found:
                return self._pieces(first) + b"".join(found)
        return self._pieces(text)

    def many(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text (null: none). Distinct words of some megabytes of texts are looked up once, and
        their ids are put in the places of the words by Arrow."""
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TOGETHER, side="right")))
            yield from self._together(texts.slice(at, end - at))
            at = end

    def _together(self, texts: pa.Array) -> Iterator[bytes]:
        words = pc.split_pattern(texts, " ")
        bounds = words.offsets.to_numpy()
        flat = pc.dictionary_encode(words.flatten())
        known = pa.array(list(map(self.words.__getitem__, flat.dictionary.to_pylist())), pa.large_binary())
        ids = known.take(flat.indices)
        places = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset: ids.offset + len(ids) + 1]
        data = memoryview(ids.buffers()[2] or b"")
        # texts with a word of unknown end, a special string or of great length go one by one
        alone = pc.fill_null(pc.greater(pc.binary_length(texts), BLOCK_CHARS), False).to_numpy(zero_copy_only=False).copy()
        for s in self.special:
            alone |= pc.fill_null(pc.match_substring(texts, s), False).to_numpy(zero_copy_only=False)
        unsure = np.flatnonzero(pc.is_null(ids).to_numpy(zero_copy_only=False)) + bounds[0]
        alone[np.searchsorted(bounds, unsure, side="right") - 1] = True
        for i, first in enumerate(pc.list_element(pc.if_else(pc.is_null(words), pa.scalar([""], words.type), words), 0).to_pylist()):
            lo, hi = bounds[i] - bounds[0], bounds[i + 1] - bounds[0]
            if alone[i] or (hi > lo + 1 and (not first or first[-1].isspace())):
                yield self(texts[i].as_py())
            elif hi > lo:
                yield self._pieces(first) + data[places[lo + 1]: places[hi]]
            else:
                yield b""


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Item numbers of ``k`` windows with nearly equal sums: Karmarkar-Karp multiway differencing.

    A partial partition is the list of its windows that hold something, heaviest first; the
    windows it doesn't list are empty. Its imbalance is the heaviest sum less the lightest.
    """
    heap = [(-size if k > 1 else 0, i, [(size, [i])]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    turn = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a) < len(b):
            a, b = b, a
        # the heaviest windows of b go onto the lightest of a, empty ones first
        free = min(k - len(a), len(b))
        merged = a[: len(a) - (len(b) - free)] + b[:free]
        merged += [(s + t, one + two) for (s, one), (t, two) in zip(reversed(a[len(a) - (len(b) - free):]), b[free:])]
        merged.sort(key=lambda w: -w[0])
        lightest = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (lightest - merged[0][0], turn, merged))
        turn += 1
    return [items for _, items in heap[0][2]] if heap else []


def balanced(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``: the number of windows rises until none exceeds it."""
    total = sum(sizes)
    k = math.ceil(total / capacity)
    while True:
        windows = differencing(sizes, k)
        over = sum(max(0, sum(sizes[i] for i in w) - capacity) for w in windows)
        if not over:
            return windows
        k += math.ceil(over / capacity)


class Packer:
    """Packs the documents of one partition, in the order in which they come."""

    def __init__(self, capacity: int, batch_tokens: int, first_window: int):
        self.capacity, self.batch_tokens, self.window = capacity, batch_tokens, first_window
        self.items: list[tuple] = []  # (doc_id, start, doc_tokens, ids)
        self.waiting = 0

    def _emit(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, doc_tokens, ids in pieces:
            yield doc_id, start, len(ids) // 4, doc_tokens, self.window, offset, ids
            offset += len(ids) // 4
        self.window += 1

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        n, full = len(ids) // 4, 4 * self.capacity
        whole = len(ids) - len(ids) % full
        for at in range(0, whole, full):
            yield from self._emit([(doc_id, at // 4, n, ids[at: at + full])])
        if whole < len(ids):
            self.items.append((doc_id, whole // 4, n, ids[whole:]))
            self.waiting += n - whole // 4
            if self.waiting >= self.batch_tokens:
                yield from self._pack()

    def _pack(self) -> Iterator[tuple]:
        """All full windows that the items fill; what is left over waits."""
        sizes = [len(i[3]) // 4 for i in self.items]
        windows = balanced(sizes, self.capacity)
        windows.sort(key=lambda w: -sum(sizes[i] for i in w))
        full = sum(sizes) // self.capacity
        kept, loose = windows[:full], [self.items[i] for w in windows[full:] for i in w]
        loose.reverse()
        for w in kept:
            pieces = [self.items[i] for i in w]
            gap = 4 * self.capacity - sum(len(p[3]) for p in pieces)
            while gap:
                doc_id, start, n, ids = loose.pop()
                pieces.append((doc_id, start, n, ids[:gap]))
                if len(ids) > gap:
                    loose.append((doc_id, start + gap // 4, n, ids[gap:]))
                gap -= min(gap, len(ids))
            yield from self._emit(pieces)
        self.items, self.waiting = loose[::-1], sum(len(i[3]) // 4 for i in loose)

    def finish(self) -> Iterator[tuple]:
        if self.waiting >= self.capacity:
            yield from self._pack()
        loose = self.items[::-1]
        while self.waiting:
            gap = 4 << (self.waiting.bit_length() - 1)
            self.waiting -= gap // 4
            pieces = []
            while gap:
                doc_id, start, n, ids = loose.pop()
                pieces.append((doc_id, start, n, ids[:gap]))
                if len(ids) > gap:
                    loose.append((doc_id, start + gap // 4, n, ids[gap:]))
                gap -= min(gap, len(ids))
            yield from self._emit(pieces)
        self.items = []


def pack(docs: DataFrame, vocabulary_path: str, *, doc_id: str = "doc_id", text: str = "text",
         capacity: int = 2048, end_id: int = 1, batch_tokens: int = 1 << 17) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset and
    ids (little-endian unsigned 32-bit numbers)."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity is a power of two")
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast({"spec": f.read()})
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
              ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a Python worker keeps a broadcast value, and with it what the encoder remembers, from task to task
        known = shared.value
        encode = known.get("encoder") or known.setdefault("encoder", Encoder(known["spec"]))
        end = array("I", [end_id]).tobytes()
        packer = Packer(capacity, batch_tokens, TaskContext.get().partitionId() << WINDOW_BITS)
        out: list[tuple] = []
        size = 0

        def ready() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)], [n for n, _ in fields])

        def pieces() -> Iterator[tuple]:
            for batch in batches:
                for i, ids in zip(batch.column(0).to_pylist(), encode.many(batch.column(1))):
                    yield from packer.add(i, ids + end)
            yield from packer.finish()

        for piece in pieces():
            out.append(piece)
            size += 64 + len(piece[6])
            if size >= 4 << 20:
                yield ready()
                out, size = [], 0
        if out:
            yield ready()

    return docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")).mapInArrow(work, SCHEMA)


def sequences(pieces: DataFrame, *, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """The windows to train on: sequence_id, n_tokens and ids, padded to ``capacity`` unless the
    length is a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    n = F.col("n_tokens")
    pad = F.when(F.expr("n_tokens & (n_tokens - 1)") == 0, 0).otherwise(F.lit(capacity) - n)
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
            .withColumn("ids", F.concat("ids", F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), pad.cast("int"))))))
