"""Approximate nearest neighbours: a forest of random-projection trees.

Trees are built on the driver from a bounded sample of distinct vectors (``sample_rows``):
each inner node splits its points by the hyperplane between two centres found from two
random points. Every distinct vector of the table is then routed to one leaf per tree.
A query walks all trees through one shared priority queue, nearest side of a hyperplane
first, and takes leaves until they hold ``search_share`` times the rows (``search_least``
at least, counted over all trees). The rows of those leaves are reranked by their exact
cosine, in double precision, on the original vectors.

Equal vectors are one class and are compared once; a class keeps its k + 1 smallest ids,
which is all that k neighbours without the query itself can use, so no row is lost and
a vector that a third of the rows share costs one comparison. Leaf and query blocks
of bounded size meet in one task each: a leaf with more than ``block_rows`` rows, or with
more than ``block_rows`` queries, is cut in blocks and every pair of blocks is compared.

The driver holds the sample, the forest and one count per leaf, all bounded by
``sample_rows``, ``trees`` and the dimension.

Vectors that are null, empty, zero, or hold null or non-finite components take no part;
nor do rows with null id, nor vectors of another length than the commonest one. A row
repeated with id and vector counts once. An id with several vectors is searched with each, and a
candidate's best score counts. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.common import checkpointed, stored

LEAF_ROWS = 32


def build_tree(sample: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(normals, children): children[i] = (left, right) node numbers, (-1, -1) for a leaf."""
    normals, children = [], []
    todo = [(np.arange(len(sample)), 0, None)]
    while todo:
        rows, depth, parent = todo.pop()
        me = len(children)
        children.append([-1, -1])
        normals.append(np.zeros(sample.shape[1]))
        if parent is not None:
            children[parent[0]][parent[1]] = me
        if len(rows) <= LEAF_ROWS or depth > 48:
            continue
        points = sample[rows]
        for _ in range(4):
            a, b = points[rng.choice(len(points), 2, replace=False)]
            some = points[rng.integers(0, len(points), min(len(points), 256))]
            for _ in range(3):  # the two centres
                near = some @ a >= some @ b
                if near.all() or not near.any():
                    break
                a, b = some[near].mean(0), some[~near].mean(0)
                a, b = a / (np.linalg.norm(a) or 1), b / (np.linalg.norm(b) or 1)
            normal = a - b
            right = points @ normal > 0
            if 0.03 < right.mean() < 0.97:
                break
        else:
            continue  # points that no hyperplane divides stay one leaf
        normals[me] = normal / np.linalg.norm(normal)
        todo += [(rows[~right], depth + 1, (me, 0)), (rows[right], depth + 1, (me, 1))]
    return np.array(normals), np.array(children)


def route(tree, units: np.ndarray) -> np.ndarray:
    """The leaf of each unit vector."""
    normals, children = tree
    node = np.zeros(len(units), np.int64)
    while (inner := children[node, 0] >= 0).any():
        at = inner.nonzero()[0]
        side = np.einsum("ij,ij->i", units[at], normals[node[at]]) > 0
        node[at] = children[node[at], side.astype(np.int64)]
    return node


def nearest_leaves(forest, sizes: dict, unit: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """Leaves of all trees, nearest first by one shared queue, until they hold ``wanted`` rows."""
    queue, out, got = [(-math.inf, t, 0) for t in range(len(forest))], [], 0
    while queue and got < wanted:
        margin, t, node = heapq.heappop(queue)
        normals, children = forest[t]
        left, right = children[node]
        if left < 0:
            if n := sizes.get((t, int(node)), 0):
                out.append((t, int(node)))
                got += n
            continue
        m = float(unit @ normals[node])
        heapq.heappush(queue, (max(margin, -m), t, int(right)))
        heapq.heappush(queue, (max(margin, m), t, int(left)))
    return out


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    flat = col.flatten() if len(col) else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, each from its own two vectors only, so equal pairs get equal scores."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    x = F.col(embedding)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.filter(F.col(vec_id).isNotNull() & x.isNotNull() & fine & F.exists(x, lambda v: v != 0))
            .select(F.col(vec_id).cast("long").alias("id"), x.alias("x")))


def nearest(vectors: DataFrame, queries: Column, *, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5,
            trees: int = 8, sample_rows: int = 8192, search_share: float = 0.8, search_least: int = 4000,
            block_rows: int = 4096, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` (a condition on the
    column ``id``) holds, its k nearest found by cosine, ties to the smaller id."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, vec_id, embedding)
    dims = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], schema)
    dim = dims[0]["dim"]
    rows = rows.filter(F.size("x") == dim)
    # Distinct ids first, then each class's k + 1 smallest: both shrink before they shuffle.
    ranked = rows.distinct().withColumn("r", F.row_number().over(Window.partitionBy("x").orderBy("id"))).filter(F.col("r") <= k + 1)
    classes = stored(ranked.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                     .select(F.col("ids")[0].alias("cid"), "x", "ids"), "ann-classes")
    n = classes.count()
    rate = min(1.0, sample_rows / n)
    sample = classes.filter(F.pmod(F.xxhash64("cid", "x"), F.lit(1 << 20)) < rate * (1 << 20)).select("cid", "x").collect()
    points = _units(np.array([r["x"] for r in sorted(sample, key=lambda r: (r["cid"], r["x"]))], np.float64).reshape(-1, dim))
    rng = np.random.default_rng(seed)
    forest = [build_tree(points, rng) for _ in range(trees if len(points) > LEAF_ROWS else 1)]
    shared = spark.sparkContext.broadcast(forest)

    def leaf_sizes(batches):
        total: dict[tuple[int, int], int] = {}
        for b in batches:
            units = _units(_matrix(b.column(0), dim))
            for t, tree in enumerate(shared.value):
                for leaf, m in zip(*np.unique(route(tree, units), return_counts=True), strict=True):
                    total[t, int(leaf)] = total.get((t, int(leaf)), 0) + int(m)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in total], pa.int32()), pa.array([b for _, b in total], pa.int32()),
                 pa.array(list(total.values()), pa.int64())], names=["tree", "leaf", "n"])

    def per_leaf(df, column):
        return {(r["tree"], r["leaf"]): r["n"] for r in df.groupBy("tree", "leaf").agg(F.sum(column).alias("n")).collect()}

    sizes = spark.sparkContext.broadcast(per_leaf(classes.select("x").mapInArrow(leaf_sizes, "tree int, leaf int, n long"), F.col("n")))
    wanted = max(search_least, search_share * n)

    asked = rows.filter(queries).distinct()
    asked_classes = stored(asked.groupBy("x").agg(F.min("id").alias("qid")), "ann-queries")

    def walk(batches):
        for b in batches:
            units = _units(_matrix(b.column(1), dim))
            found = [nearest_leaves(shared.value, sizes.value, u, wanted) for u in units]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64())
            flat = [x for f in found for x in f]
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in flat], pa.int32()), pa.array([x for _, x in flat], pa.int32()),
                 b.column(0).take(at), b.column(1).take(at)], names=["tree", "leaf", "qid", "x"])

    kind = rows.schema["x"].dataType.simpleString()
    visits = stored(asked_classes.select("qid", "x").mapInArrow(walk, f"tree int, leaf int, qid long, x {kind}"), "ann-visits")
    asked_sizes = spark.sparkContext.broadcast(per_leaf(visits, F.lit(1)))

    def blocks(key, limit, counts):
        return max(1, -(-counts.get(key, 0) // limit))

    def place(batches):
        """Index rows: block of the leaf by the class, once for each block of queries."""
        for b in batches:
            units, cids = _units(_matrix(b.column(1), dim)), b.column(0).to_numpy()
            for t, tree in enumerate(shared.value):
                leaf = route(tree, units)
                asked_here = np.array([blocks((t, int(x)), block_rows, asked_sizes.value) if (t, int(x)) in asked_sizes.value else 0 for x in leaf])
                own = np.array([int(c) % blocks((t, int(x)), block_rows, sizes.value) for c, x in zip(cids, leaf, strict=True)])
                at = np.repeat(np.arange(len(leaf)), asked_here)
                other = np.concatenate([np.arange(m) for m in asked_here]) if len(at) else np.array([], np.int64)
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), t), pa.int32()), pa.array(leaf[at], pa.int32()), pa.array(own[at], pa.int32()),
                     pa.array(other, pa.int32()), b.column(0).take(take), b.column(1).take(take), b.column(2).take(take)],
                    names=["tree", "leaf", "own", "other", "cid", "x", "ids"])

    def spread(batches):
        """Queries: block by the query, once for each block of the leaf."""
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            reps = np.array([blocks(key, block_rows, sizes.value) for key in keys], np.int64)
            other = np.array([q % blocks(key, block_rows, asked_sizes.value) for key, q in zip(keys, b.column(2).to_pylist(), strict=True)], np.int64)
            at = np.repeat(np.arange(len(keys)), reps)
            own = np.concatenate([np.arange(m) for m in reps]) if len(at) else np.array([], np.int64)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(own, pa.int32()), pa.array(other[at], pa.int32()),
                 b.column(2).take(take), b.column(3).take(take)], names=["tree", "leaf", "own", "other", "qid", "x"])

    def rerank(index: pa.Table, asking: pa.Table) -> pa.Table:
        """Each query's k + 1 best classes of a block, by exact cosine."""
        out = pa.schema([("qid", pa.int64()), ("cid", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])
        if not index.num_rows or not asking.num_rows:
            return out.empty_table()
        index, asking = index.combine_chunks(), asking.combine_chunks()
        x, q = (_matrix(t.column("x").combine_chunks(), dim) for t in (index, asking))
        cids = index.column("cid").to_numpy()
        rough = _units(q) @ _units(x).T
        who, which, scores = [], [], []
        for i, row in enumerate(rough):
            at = np.arange(len(row))
            if len(row) > k + 1:  # all that rounding could move into the best k + 1
                at = (row >= np.partition(row, -(k + 1))[-(k + 1)] - 1e-9).nonzero()[0]
            exact = cosines(np.broadcast_to(q[i], (len(at), dim)), x[at])
            best = np.lexsort((cids[at], -exact))[:k + 1]
            who += [i] * len(best)
            which += at[best].tolist()
            scores += exact[best].tolist()
        return pa.Table.from_arrays(
            [asking.column("qid").take(pa.array(who)), index.column("cid").take(pa.array(which)), pa.array(scores),
             index.column("ids").take(pa.array(which))], schema=out)

    index = classes.select("cid", "x", "ids").mapInArrow(place, f"tree int, leaf int, own int, other int, cid long, x {kind}, ids array<long>")
    asking = visits.mapInArrow(spread, f"tree int, leaf int, own int, other int, qid long, x {kind}")
    key = ["tree", "leaf", "own", "other"]
    found = index.groupBy(key).cogroup(asking.groupBy(key)).applyInArrow(rerank, "qid long, cid long, score double, ids array<long>")
    by_query = Window.partitionBy("qid")
    best = (found.groupBy("qid", "cid").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
            .withColumn("r", F.row_number().over(by_query.orderBy(F.desc("score"), "cid"))).filter(F.col("r") <= k + 1)
            .select("qid", "score", F.explode("ids").alias("vec_id"))
            .withColumn("r", F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") <= k + 1)
            .groupBy("qid").agg(F.collect_list(F.struct("vec_id", "score")).alias("near")))
    best = checkpointed(best)
    same = stored(asked.join(asked_classes, "x").select(F.col("id").alias("query_id"), "qid"), "ann-asked")
    return (same.join(best, "qid").select("query_id", F.explode("near").alias("c"))
            .filter(F.col("c.vec_id") != F.col("query_id"))
            .groupBy("query_id", F.col("c.vec_id").alias("vec_id")).agg(F.max("c.score").alias("score"))
            .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int"))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
