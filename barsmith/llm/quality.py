"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters of ``2 * STEP`` bytes slide over the whole document in
steps of ``STEP``, and each filter is max-pooled over chunks of ``2 * HALF`` bytes that
overlap by half. A small dense layer turns a chunk's pooled filters (and the share of it
that text fills) into a logit; the document's score is the logistic of its chunks' mean
logit. Max-pooling over many filters also sees monotony: text that repeats itself
leaves most filters silent.

Fitting: on the driver, by Adam on random chunks, from a bounded sample of labelled rows:
about ``sample_rows`` rows chosen by a hash of their id, of each one excerpt of
``excerpt`` characters from a hashed place; equal excerpts count once. Scoring reads whole
texts, in segments that overlap by half a chunk, so memory is bounded for any length.

Null and empty texts are scored like a document of one empty chunk. Rows with null label,
null id or a null condition teach nothing; if nothing (or a single class) was learned,
every score is the share of label 1, or 0.5 without labels. Ids that repeat in the labels teach
with each of their labels; rows of documents are scored each by its own text. Equal scores are equal. An empty table
gives no rows. Extra columns pass through; the score column gets underscores in
front where its name is taken.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import free_name

STEP, DIM, FILTERS, HIDDEN = 4, 8, 64, 24
HALF = 256
PAD = 256  # the number that stands for "no byte"
SEGMENT = 1 << 19
BLOCKS = HALF // STEP
FAR = np.float32(-1e9)


def new_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def f(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    w = {"emb": f(257, DIM) * 16, "first": f(STEP * DIM, FILTERS), "second": f(STEP * DIM, FILTERS), "bias": np.zeros(FILTERS, np.float32),
         "dense": f(FILTERS + 1, HIDDEN), "dense_bias": np.zeros(HIDDEN, np.float32), "out": f(HIDDEN, 1), "out_bias": np.zeros(1, np.float32)}
    w["emb"] /= np.float32(4)
    w["emb"][PAD] = 0
    return w


def _filters(w, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(blocks, activation of the filters on each block with the next); padding never wins."""
    blocks = w["emb"][data].reshape(-1, STEP * DIM)
    both = blocks @ np.concatenate([w["first"], w["second"]], axis=1)
    act = both[:, :FILTERS]
    act[:-1] += both[1:, FILTERS:]
    act[data[::STEP] == PAD] = FAR
    return blocks, act


def _head(w, pooled: np.ndarray, filled: np.ndarray):
    x = np.concatenate([np.maximum(pooled + w["bias"], 0), filled[:, None]], axis=1)
    h = np.maximum(x @ w["dense"] + w["dense_bias"], 0)
    return x, h, (h @ w["out"] + w["out_bias"])[:, 0]


def scores(w, texts: list[bytes]) -> np.ndarray:
    """The score of each whole text."""
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
    group: list[tuple[int, bytes]] = []
    size = 0

    def run():
        # A text's bytes, then at least one block of padding up to a whole number of halves.
        halves = [(len(t) + STEP) // HALF + 1 for _, t in group]
        starts = np.cumsum([0] + halves)
        data = np.full(starts[-1] * HALF, PAD, np.int64)
        for (_, t), s in zip(group, starts, strict=False):
            data[s * HALF:s * HALF + len(t)] = np.frombuffer(t, np.uint8)
        _, act = _filters(w, data)
        pool = act.reshape(-1, BLOCKS, FILTERS).max(axis=1)
        fill = (data[::STEP] != PAD).reshape(-1, BLOCKS).sum(axis=1) / (2 * BLOCKS)
        # A chunk starts at every half but a text's last, or at its only one.
        last = np.zeros(len(pool), bool)
        last[starts[1:] - 1] = True
        after = np.minimum(np.arange(len(pool)) + 1, len(pool) - 1)
        chunk = np.where(last[:, None], pool, np.maximum(pool, pool[after]))
        filled = (fill + np.where(last, 0, fill[after])).astype(np.float32)
        doc = np.repeat(np.arange(len(group)), halves)
        use = ~last | (np.repeat(halves, halves) == 1)
        _, _, logit = _head(w, chunk[use], filled[use])
        who = np.array([i for i, _ in group])[doc[use]]
        np.add.at(sums, who, logit)
        np.add.at(counts, who, 1)

    for i, text in enumerate(texts):
        at = 0
        while True:
            group.append((i, text[at:at + SEGMENT]))
            size += len(group[-1][1]) + HALF
            if size >= SEGMENT:
                run()
                group, size = [], 0
            if at + SEGMENT >= len(text):
                break
            at += SEGMENT - HALF
    if group:
        run()
    return 1 / (1 + np.exp(-np.clip(sums / counts, -30, 30)))


def fit(texts: list[bytes], labels: list[int], *, epochs: int = 20, batch: int = 64, rate: float = 3e-3, seed: int = 5) -> dict[str, np.ndarray]:
    """Adam on the logistic loss of random chunks. In an epoch each text of the commoner label
    gives one chunk, each of the rarer label several of proportionally less weight. A third
    of the chunks are cut short, so that short texts are judged by what short texts show."""
    rng = np.random.default_rng(seed)
    w = new_weights(rng)
    y = np.array(labels, np.float32)
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    t = 0
    raw = [np.frombuffer(x, np.uint8) for x in texts]
    again = np.array([min(4, max(1, round((y != k).sum() / max(1, (y == k).sum())))) for k in (0, 1)])
    times = again[y.astype(np.int64)]
    for epoch in range(epochs):
        order = rng.permutation(np.repeat(np.arange(len(raw)), times))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            data = np.full((len(rows), 2 * HALF + STEP), PAD, np.int64)  # a last block of padding
            for i, r in enumerate(rows):
                x = raw[r]
                start = rng.integers(0, max(1, len(x) - 2 * HALF + 1))
                x = x[start:start + (2 * HALF if rng.random() > 0.3 else int(rng.integers(8, 2 * HALF)))]
                data[i, :len(x)] = x
            n, per = len(rows), data.shape[1] // STEP
            blocks, act = _filters(w, data.reshape(-1))
            act = act.reshape(n, per, FILTERS)
            best = act.argmax(axis=1)
            pooled = np.take_along_axis(act, best[:, None], axis=1)[:, 0]
            filled = ((data[:, ::STEP] != PAD).sum(axis=1) / (2 * BLOCKS)).astype(np.float32)
            x, h, logit = _head(w, pooled, filled)
            d = ((1 / (1 + np.exp(-logit)) - y[rows]) / times[rows] / n).astype(np.float32)[:, None]
            g = {"out": h.T @ d, "out_bias": d.sum(axis=0)}
            dh = (d @ w["out"].T) * (h > 0)
            g |= {"dense": x.T @ dh, "dense_bias": dh.sum(axis=0)}
            dz = (dh @ w["dense"].T)[:, :FILTERS] * (x[:, :FILTERS] > 0)
            g["bias"] = dz.sum(axis=0)
            here = (np.arange(n)[:, None] * per + best).ravel()  # the winning block of each text and filter
            after = np.minimum(here + 1, len(blocks) - 1)
            flat = dz.ravel()[:, None]
            for name, at_ in (("first", here), ("second", after)):
                g[name] = (flat * blocks[at_]).reshape(n, FILTERS, -1).sum(axis=0).T
            g["emb"] = np.zeros_like(w["emb"])
            ids = data.reshape(-1, STEP)
            for name, at_ in (("first", here), ("second", after)):
                back = (dz[:, :, None] * w[name].T[None]).reshape(-1, DIM)
                np.add.at(g["emb"], ids[at_].ravel(), back)
            g["emb"][PAD] = 0
            t += 1
            step = rate * min(1.0, 2 * (1 - epoch / epochs))
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                w[k] -= (step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return w


def learn(docs: DataFrame, labels: DataFrame, where: Column, *, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
          sample_rows: int = 5000, excerpt: int = 4096) -> dict[str, np.ndarray] | float:
    """Weights fitted to ``labels`` (doc_id, label 0 or 1) on the documents where the condition
    on ``doc_id`` holds; a constant score where there is nothing to tell apart."""
    known = labels.filter(where & F.col(label).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y"))
    h = F.xxhash64(F.col("_id").cast("string"), F.lit("quality"))
    n = known.count()
    rate = min(1.0, sample_rows / max(n, 1))
    chosen = known.filter(F.pmod(h, F.lit(1 << 20)) < rate * (1 << 20))
    length = F.length("_x")
    rows = (docs.select(F.col(doc_id).alias("_id"), F.coalesce(text, F.lit("")).alias("_x")).join(chosen, "_id")
            .select("_id", "_y", F.substring("_x", F.lit(1) + F.pmod(F.shiftright(h, 20), F.greatest(length - excerpt, F.lit(0)) + 1).cast("int"),
                                             F.lit(excerpt)).alias("_x")).collect())
    unique = {r["_x"]: r["_y"] for r in sorted(rows, key=lambda r: (r["_id"], r["_y"]))}
    ys = list(unique.values())
    if len(set(ys)) < 2:
        return float(ys[0]) if ys else 0.5
    return fit([x.encode() for x in unique], ys)


def score(docs: DataFrame, model: dict[str, np.ndarray] | float, *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in the column ``name``."""
    name = free_name(docs.columns, name)
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(model))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(scores(shared.value, [(t or "").encode() for t in texts]), dtype="float64")

    return docs.withColumn(name, run(F.col(f"`{text}`")))
