"""Prefix trie of conversations, packed as double arrays per shard.

A node is a distinct sequence of first turns. A turn travels as 128 bits of the SHA-256 of its role
and text, and a conversation as the string of its turns' digests, its path.

1. Paths are range-partitioned and sorted by (path, id), so a shard is a run of neighbours: a
   first turn, or a whole conversation, that a third of all rows share is spread over many.
2. Each shard (about ``shard_turns`` turns, however large the partition) numbers its turns densely,
   packs its trie in BASE and CHECK arrays (the child of node s by turn t stands at BASE[s] + t,
   where CHECK names s) and finds its nodes by walking every path through them. CHECK then
   leads from the deepest level up, to add up subtrees.
3. A node can reach into another shard only if it lies on the shard's first or last path. All
   others are complete. Nodes on those two paths (at most twice the depth per shard) are merged
   globally: their counts add up, and what belongs to a distinct node once (its own last text,
   being childless) is credited by the first path that holds it to every node above, as a running
   sum along that path.

Ids that end at a node are kept as text in ascending pieces, so the ends of a hot node are never
gathered: ``ends_digest`` reads the pieces one after the other.

Defined results: rows without conversation id are ignored; null role or text is empty; turns are
ordered by number (null first), equal ones by their digest; repeated rows are turns like others. An empty table
gives no rows. Texts of any length are read whole, by their digest and length alone. One conversation's
digests (20 bytes a turn) must fit in a row, 100 million turns. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.common import stored

WIDTH = 16
#: Ids per piece of the ends of a node.
PIECE = 512
#: The records of a partition: its number takes the bits above these.
RECORD_BITS = 36
COMPLETE, SHARED, ENDS = 0, 1, 2
SCHEMA = ("kind int, record long, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
          "n_children long, n_leaves long, saved_tokens long, chars long, ends string")
FIELDS = [("kind", pa.int32()), ("record", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()),
          ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
          ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("chars", pa.int64()), ("ends", pa.string())]


def conversation_turns(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                       text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (digest in hex, code points of the text)."""
    who, said = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    digest = F.substring(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256), 1, 2 * WIDTH)
    rows = conversations.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
                                F.struct(F.col(f"`{turn}`").alias("turn"), digest.alias("digest"), F.length(said).alias("chars")).alias("t"))
    # an array of structs sorts by turn, null first, then by digest
    ordered = F.sort_array(F.collect_list("t"))
    return (rows.filter("conv_id IS NOT NULL").groupBy("conv_id")
            .agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns")))


def with_borrowed_starts(convs: DataFrame, donor: Column, n: Column, most: int) -> DataFrame:
    """``convs`` rebuilt: the first ``n`` turns (at most ``most``) of conversation ``donor``, all if it has fewer,
    none if there is none, then the own turns after the first ``n``."""
    convs = stored(convs, "conversations")
    starts = convs.select(F.col("conv_id").alias("donor"), F.slice("turns", 1, most).alias("start"))
    # only conversations that lend something go through the join
    starts = starts.join(convs.select(donor.alias("donor")).distinct(), "donor", "left_semi")
    empty = F.array().cast(convs.schema["turns"].dataType)
    rebuilt = F.concat(F.slice(F.coalesce("start", empty), F.lit(1), n),
                       F.slice("turns", n + 1, F.greatest(F.size("turns") - n, F.lit(0))))
    return convs.withColumn("donor", donor).join(starts, "donor", "left").select("conv_id", rebuilt.alias("turns"))


class DoubleArray:
    """A trie over dense codes 0 .. n_codes - 1: the child of the node in slot s by code t is in slot
    base[s] + t, if check names s there. The root is in slot 0."""

    def __init__(self, parent: np.ndarray, code: np.ndarray, n_codes: int):
        """``parent`` and ``code`` per node, from node 1 on: a node's number is above its parent's."""
        n = len(parent) + 1
        slot = np.zeros(n, np.int64)
        fan = np.bincount(parent, minlength=n)
        order = np.argsort(parent, kind="stable")
        first = np.concatenate([[0], np.cumsum(fan)])
        base_of = np.zeros(n, np.int64)
        taken = np.zeros(n + n_codes + 1, bool)
        taken[0] = True  # the root's
        # nodes with many children first, while the array is empty; then the only children fill the holes
        several = np.flatnonzero(fan > 1)
        for node in several[np.argsort(-fan[several], kind="stable")]:
            children = order[first[node]: first[node + 1]]
            codes = np.sort(code[children])
            base, taken = self._fit(codes, taken)
            base_of[node] = base
            slot[children + 1] = base + code[children]
            taken[base + codes] = True
        only = order[first[:-1][fan == 1]] if n > 1 else np.zeros(0, np.int64)
        holes = np.flatnonzero(~taken)
        if len(holes) < len(only):
            holes = np.concatenate([holes, len(taken) + np.arange(len(only) - len(holes))])
        slot[only + 1] = holes[: len(only)]
        base_of[parent[only]] = holes[: len(only)] - code[only]
        size = max(len(taken), int(slot.max()) + 1 if n > 1 else 1)
        self.check = np.full(size, -1, np.int64)
        self.base = np.zeros(size, np.int64)
        self.check[0] = -2  # the root is nobody's child
        self.check[slot[1:]] = slot[parent]
        self.base[slot] = base_of

    def _fit(self, codes: np.ndarray, taken: np.ndarray) -> tuple[int, np.ndarray]:
        """The first base of some tried ones at which all ``codes`` find free slots; the array doubles where none does."""
        low, span = int(codes[0]), int(codes[-1] - codes[0]) + 1
        free = np.flatnonzero(~taken[: len(taken) - span + 1])
        for start in free[:: max(1, len(free) // 64)]:
            if not taken[start - low + codes].any():
                return int(start) - low, taken
        at = len(taken)
        return at - low, np.concatenate([taken, np.zeros(max(at, span), bool)])

    def step(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children's slots; a missing child is an error, for every path of the shard was packed."""
        to = self.base[slots] + codes
        if not (self.check[to] == slots).all():
            raise AssertionError("a path left the trie")
        return to


def _trie(codes: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent and code of each distinct node (from node 1 on) of the paths. Once all paths have parted
    the rest of each is a chain, numbered in one go."""
    n_codes = int(codes.max()) + 1 if len(codes) else 1
    parents, found, top = [], [], 1
    at = np.zeros(len(lengths), np.int64)
    live, depth = np.flatnonzero(lengths > 0), 0
    while len(live):
        key, node = np.unique(at[live] * n_codes + codes[offsets[live] + depth], return_inverse=True)
        parents.append(key // n_codes)
        found.append(key % n_codes)
        at[live] = top + node
        top += len(key)
        depth += 1
        parted = len(key) == len(live)
        live = live[lengths[live] > depth]
        if parted and len(live):
            rest = lengths[live] - depth
            starts = np.cumsum(rest) - rest
            chain = top + np.arange(rest.sum()) - 1
            chain[starts] = at[live]
            parents.append(chain)
            within = np.arange(rest.sum()) - np.repeat(starts, rest)
            found.append(codes[np.repeat(offsets[live] + depth, rest) + within])
            break
    none = [np.zeros(0, np.int64)]
    return np.concatenate(parents or none), np.concatenate(found or none)


def _shard(paths: list[bytes], ids: np.ndarray, chars: list[np.ndarray], record: int) -> Iterator[tuple]:
    """The rows of one shard from its conversations, sorted by (path, id)."""
    new = np.array([True] + [a != b for a, b in zip(paths, paths[1:])])
    run = np.flatnonzero(new)
    count = np.diff(np.append(run, len(paths)))
    distinct = [paths[i] for i in run]
    lengths = np.array([len(p) // WIDTH for p in distinct], np.int64)
    offsets = np.cumsum(lengths) - lengths
    text = np.concatenate([chars[i] for i in run]).astype(np.int64)
    pairs = np.frombuffer(b"".join(distinct), dtype=">u8").reshape(-1, 2).astype(np.uint64)
    _, codes = np.unique(pairs, axis=0, return_inverse=True) if len(pairs) else (None, np.zeros(0, np.int64))
    codes = codes.reshape(-1).astype(np.int64)

    parent, code = _trie(codes, offsets, lengths)
    trie = DoubleArray(parent, code, int(codes.max()) + 1 if len(codes) else 1)
    size, largest = len(trie.check), np.iinfo(np.int64).max
    n_convs, depth_of, last = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    smallest, ends = np.full(size, largest), np.full(size, -1, np.int64)
    shared = np.zeros(size, bool)
    sides: list[list[int]] = [[0], [0]]  # slots on the first and on the last path
    levels = [np.zeros(1, np.int64)]
    at, live, depth = np.zeros(len(run), np.int64), np.arange(len(run)), 0
    while True:
        np.add.at(n_convs, at[live], count[live])
        np.minimum.at(smallest, at[live], ids[run[live]])
        done = lengths[live] == depth
        ends[at[live[done]]] = live[done]
        live = live[~done]
        if not len(live):
            break
        at[live] = trie.step(at[live], codes[offsets[live] + depth])
        last[at[live]] = text[offsets[live] + depth]
        depth += 1
        level = np.unique(at[live])
        depth_of[level] = depth
        levels.append(level)
        for side, path in zip(sides, (0, len(run) - 1)):
            if lengths[path] >= depth:
                side.append(int(at[path]))
    for side in sides:
        shared[side] = True

    n_children, n_leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    for level in reversed(levels):
        mine = level[~shared[level]]
        n_leaves[mine[n_children[mine] == 0]] = 1
        saved[mine] += (n_convs[mine] - 1) * last[mine]
        for total, one in ((n_children, 1), (n_leaves, n_leaves[mine]), (saved, saved[mine])):
            np.add.at(total, trie.check[mine], one)

    def pieces(slot: int) -> list[tuple[int, str]]:
        if ends[slot] < 0:
            return []
        mine = ids[run[ends[slot]]: run[ends[slot]] + count[ends[slot]]]
        return [(int(mine[i]), ",".join(map(str, mine[i: i + PIECE].tolist()))) for i in range(0, len(mine), PIECE)]

    keys = {0: b""}
    for side, path in enumerate((0, len(run) - 1)):
        digests, key = distinct[path], b""
        for d, slot in enumerate(sides[side]):
            above = key
            if d:
                key = hashlib.sha256(above + digests[(d - 1) * WIDTH: d * WIDTH]).digest()[:WIDTH]
            again = side == 1 and d < len(sides[0]) and sides[0][d] == slot
            keys[slot] = key
            figures = (0, 0, 0, 0) if again else tuple(int(a[slot]) for a in (n_convs, n_children, n_leaves, saved))
            yield (SHARED, 2 * record + side, key, above if d else None, int(smallest[slot]), d, None, *figures, int(last[slot]), None)
            if not again:
                for first, ids_text in pieces(slot):
                    yield (ENDS, None, key, None, first, None, None, None, None, None, None, None, ids_text)
    for level in levels:
        for slot in level[~shared[level]].tolist():
            up = int(trie.check[slot])
            mine = int(smallest[slot])
            above = (keys[up], None) if shared[up] else (None, int(smallest[up]))
            own = pieces(slot)
            if len(own) > 1:  # many ends: as pieces, under a key of their own
                key = b"%d/%d" % (mine, int(depth_of[slot]))
                for first, ids_text in own:
                    yield (ENDS, None, key, None, first, None, None, None, None, None, None, None, ids_text)
                text_of_ends = None
            else:
                key, text_of_ends = None, own[0][1] if own else ""
            yield (COMPLETE, None, key, above[0], mine, int(depth_of[slot]), above[1], int(n_convs[slot]),
                   int(n_children[slot]), int(n_leaves[slot]), int(saved[slot]), None, text_of_ends)


def _shard_rows(shard_turns: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = TaskContext.get().partitionId() << RECORD_BITS
        paths: list[bytes] = []
        ids: list[int] = []
        chars: list[np.ndarray] = []
        turns = 0

        def emit() -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            for row in _shard(paths, np.array(ids, np.int64), chars, record):
                rows.append(row)
                if len(rows) == 5000:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), FIELDS)], [n for n, _ in FIELDS])

        for batch in batches:
            path_of, ids_of, lens = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            flat, bounds = lens.flatten().to_numpy(zero_copy_only=False), np.cumsum([0] + [len(x) // WIDTH for x in path_of.to_pylist()])
            for i, path in enumerate(path_of.to_pylist()):
                paths.append(path)
                ids.append(ids_of[i])
                chars.append(flat[bounds[i]: bounds[i + 1]])
                turns += 1 + len(path) // WIDTH
                if turns >= shard_turns:
                    yield from emit()
                    record += 1
                    paths, ids, chars, turns = [], [], [], 0
        if paths:
            yield from emit()

    return work


def build(convs: DataFrame, *, shard_turns: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """The trie of (conv_id, turns) rows: its nodes and the ids that end at them.

    Nodes: node (key of its ends, null where ``ends`` holds them all), conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends (ids as text, ascending, joined by
    commas). Ends: node, first (id), ends (a piece of that text).
    """
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    rows = stored(convs.select(path.alias("path"), "conv_id", F.transform("turns", lambda t: t["chars"]).alias("chars")), "trie-paths")
    sorted_rows = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = stored(sorted_rows.mapInArrow(_shard_rows(shard_turns), SCHEMA), "trie-nodes")
    complete = found.filter(F.col("kind") == COMPLETE)
    records = found.filter(F.col("kind") == SHARED).select("record", "node", "parent", "conv_id", "depth", "n_convs",
                                                           "n_children", "n_leaves", "saved_tokens", "chars")
    merged = records.groupBy("node").agg(
        F.min("record").alias("owner"), F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.first("chars").alias("chars"))
    merged = stored(merged, "trie-shared")
    below = merged.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    n_children = F.col("n_children") + F.coalesce("more", F.lit(0))
    nodes = stored(merged.join(below, "node", "left").select(
        "node", "owner", "parent", "conv_id", "depth", "n_convs", n_children.alias("n_children"),
        F.when(n_children == 0, 1).otherwise(0).alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "trie-shared-nodes")
    mine = F.col("owner") == F.col("record")
    up = Window.partitionBy("record").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    credited = records.join(nodes.select("node", "owner", "leaf", "saved"), "node").select(
        "node",
        F.sum(F.col("n_leaves") + F.when(mine, F.col("leaf")).otherwise(0)).over(up).alias("n_leaves"),
        F.sum(F.col("saved_tokens") + F.when(mine, F.col("saved")).otherwise(0)).over(up).alias("saved_tokens"))
    sums = credited.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    figures = ["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    upper = (nodes.drop("owner", "leaf", "saved").join(sums, "node").join(above, "parent", "left")
             .withColumnRenamed("above", "parent_conv_id").withColumn("ends", F.lit(None).cast("string")).select(figures))
    inner = complete.filter("parent IS NULL").select(figures)
    edge = complete.filter("parent IS NOT NULL").join(above, "parent").withColumn("parent_conv_id", F.col("above")).select(figures)
    ends = found.filter(F.col("kind") == ENDS).select("node", F.col("conv_id").alias("first"), "ends")
    return upper.unionByName(inner).unionByName(edge), ends


def ends_digest(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """``nodes`` with ends_sha256: the SHA-256 of the ids that end there, as ``build`` joins them.
    A node's pieces are read in order by one task, which holds no more than a batch of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "hash"])

        for batch in batches:
            for key, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != node:
                    if digest:
                        yield row()
                    node, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.encode())
        if digest:
            yield row()

    hashes = ends.repartition("node").sortWithinPartitions("node", "first").mapInArrow(work, "node binary, hash string")
    keyed = nodes.filter("ends IS NULL").join(hashes, "node", "left")
    whole = nodes.filter("ends IS NOT NULL").withColumn("hash", F.sha2("ends", 256))
    return keyed.unionByName(whole).withColumn("ends_sha256", F.coalesce("hash", F.sha2(F.lit(""), 256))).drop("hash")
