"""Line dedup and SimHash near-duplicates against plain Python versions, and edge cases."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from barsmith.llm import line_dedup, simhash
from barsmith.llm.components import components

LONG = "This line is long enough to count as a key of its own"


def brute_lines(rows, min_documents=5):
    where = defaultdict(list)
    for r, (doc_id, text) in enumerate(rows):
        for k in line_dedup.long_keys((text or "").encode(), 40):
            where[k].append(doc_id)
    keeper = {k: max(x for x in ids if x is not None) for k, ids in where.items() if len(ids) >= min_documents and any(x is not None for x in ids)}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keys = [x.encode().strip().lower() for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if k not in keeper or doc_id == keeper[k]]
        out.append((doc_id, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return sorted(out, key=repr)


def run_lines(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "mine", 1) for r in rows], "doc_id long, text string, key string, n_lines int")
    out = line_dedup.dedup_lines(docs, **options)
    assert out.columns == ["doc_id", "text", "key", "n_lines", "_n_lines", "n_dropped"]
    return sorted(((r["doc_id"], r["_n_lines"], r["n_dropped"], r["text"]) for r in out.collect()), key=repr)


def test_lines_edge_cases(spark):
    rows = [(i, f"own {i}\n  {LONG.upper() if i % 2 else LONG}\t\nend") for i in range(6)]
    rows += [(10, None), (11, ""), (12, "\n\n"), (None, LONG), (13, f"{LONG}\n{LONG}"), (13, "other\n" + LONG)]
    rows += [(20 + i, "ü" * 39) for i in range(6)] + [(30 + i, "é" * 40) for i in range(5)] + [(40 + i, LONG + "\x0b") for i in range(2)]
    assert run_lines(spark, rows) == brute_lines(rows)


def test_lines_random_and_tiny_filter(spark):
    """A filter far too small suspects everything, and changes nothing."""
    rng = random.Random(3)
    pool = [f"line number {i} " + "x" * rng.randint(20, 50) for i in range(40)]
    rows = [(i, "\n".join(rng.choices(pool, weights=[40, *[1] * 39], k=rng.randint(0, 8)))) for i in range(150)]
    want = brute_lines(rows)
    assert run_lines(spark, rows) == want
    assert run_lines(spark, rows, max_filter_bits=1 << 14) == want


def test_lines_empty_table(spark):
    assert run_lines(spark, []) == []


def test_lines_are_dropped_without_python_workers(spark):
    """Whole texts are not gathered in batches to be rebuilt, and a text of very many lines is one pass."""
    many = "\n".join(f"{LONG} {i}" if i % 2 else "" for i in range(20_001)) + "\n"
    rows = [(i, many) for i in range(6)] + [(7, "\n" + LONG + " 1"), (8, LONG + " 1"), (9, f"a\n{LONG} 3\r\n\u2028b\n\n"), (10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.dedup_lines(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InArrow" not in plan
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()), key=repr)
    assert got == brute_lines(rows)


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", "  \t", "One", "One two", "a b c", "A  B\tc\nd É é", "x " * 70_000 + "end", "same same same same"])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode(), 3) == brute_fingerprint(text)


@pytest.mark.parametrize(("radius", "q"), [(2, 2), (2, 3), (4, 3)])
def test_covering_masks_cover_every_difference(radius, q):
    masks = simhash.covering_masks(radius, q)
    assert len(masks) == (q ** (radius + 1) - 1) // (q - 1)
    rng = random.Random(1)
    pairs = [(a, b) for a in range(64) for b in range(a)] if radius == 2 else [tuple(rng.sample(range(64), 4)) for _ in range(3000)]
    for bits in pairs:
        assert any(all(not m >> b & 1 for b in bits) for m in masks)


def test_links_equal_all_pairs(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 30, np.uint64)
    fps = [int(x) for x in base]
    for x in base[:12]:
        for _ in range(12):  # a crowd around each
            y = int(x)
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                y ^= 1 << int(b)
            fps.append(y)
    fps = sorted(set(fps))
    rows = [(i, simhash._signed(f)) for i, f in enumerate(fps)]
    links = simhash.links(spark.createDataFrame(rows, "doc_id long, fp long"), radius=2)
    got = {r["id"]: r["component"] for r in components(links).collect()}
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    same = defaultdict(set)
    for i, f in enumerate(fps):
        s = simhash._signed(f)
        same[root(i)].add(got.get(s, s))
    assert all(len(x) == 1 for x in same.values()) and len({min(x) for x in same.values()}) == len(same)


def test_components_of_a_long_path(spark):
    order = random.Random(5).sample(range(200), 200)
    edges = list(zip(order, order[1:], strict=False)) + [(500, 501), (501, 500), (7, 7), (None, 3)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(200), 0), 500: 500, 501: 500}


def test_near_duplicates_edge_cases(spark):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(5, text), (3, text), (9, None), (4, ""), (8, " \n"), (None, text), (None, "alone in the world"), (6, "quite another text here"), (6, "quite another text here")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=repr)
    fp = {t: f"{brute_fingerprint(t):016x}" for _, t in rows}
    first = {fp[text]: 3, fp[""]: 4, fp["quite another text here"]: 6, fp["alone in the world"]: None}
    assert got == sorted(((i, fp[t], first[fp[t]]) for i, t in rows), key=repr)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    # one row of each class, also of those that share an id or have none
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["3", "4", "6", "None"]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_one_row_of_each_class_stays(spark):
    """Rows of one id are told apart by text; null ids come last; clashing names don't matter."""
    base = " ".join(f"w{i}" for i in range(500))
    apart = lambda t: bin(brute_fingerprint(base) ^ brute_fingerprint(t)).count("1")
    near = next(t for t in (f"{base} more{k}" for k in range(1000)) if apart(t) in (1, 2))
    rows = [(5, base, "a"), (5, base, "b"), (5, near, "c"), (7, base, "d"), (None, base, "e"), (5, "something else altogether here", "f"),
            (None, "a text without an id", "g"), (None, "a text without an id", "h"), (None, None, "i"), (9, "", "j"), (8, "   ", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string").withColumns({"_gone": F.lit(1), "fp": F.lit("x"), "first": F.lit(True)})
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), r["text"]) for r in kept.collect())
    assert len(got) == 4 and [i for i, _ in got] == ["5", "5", "8", "None"]
    assert ("5", "something else altogether here") in got and ("None", "a text without an id") in got
    assert simhash.one_of_each(docs.limit(0)).collect() == []


def test_kept_digest():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")  # what the query gives an empty text
