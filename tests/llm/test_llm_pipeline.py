"""The corpus pipeline against plain versions of its stages, on documents of which every stage drops some."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barsmith.llm import mixing, quality
from barsmith.llm.common import read_table
from barsmith.llm.queries import id_crc, label_domains
from test_llm_dedup import brute_fingerprint
from test_llm_models import plain_score, plain_seeds, slow_align


def corpus(seed=3):
    """(documents, labels, benchmark) rows with planted cases of every kind."""
    rng = random.Random(seed)
    words = [a + b + c for a in ("ka", "lo", "mi", "ne", "ru") for b in ("sta", "ver", "lin", "do") for c in ("", "ing", "ed", "s", "ly")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    items = [prose(24) for _ in range(6)]
    shared = [prose(12) for _ in range(4)]
    docs, labels = [], []
    for i in range(420):
        kind = rng.choices(["good", "low", "toxic", "copy", "near", "leak", "lines"], [8, 4, 3, 1, 1, 1, 2])[0]
        text = "\n".join(prose(rng.randrange(20, 60)) for _ in range(rng.randrange(1, 4)))
        if kind == "low":
            text = " ".join("".join(rng.choice("#$%&!?*~") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(30, 90)))
        elif kind == "toxic":
            text = " ".join(w if rng.random() > 0.3 else rng.choice(["vile", "scum", "wretch", "filth"]) for w in text.split(" "))
        elif kind == "copy" and docs:
            text = rng.choice(docs)[1] or ""
        elif kind == "near" and docs:
            text = (rng.choice(docs)[1] or "") + " more"
        elif kind == "leak":
            item = rng.choice(items).split(" ")
            item[rng.randrange(len(item))] = "other"
            text += " " + " ".join(item) + " " + prose(10)
        elif kind == "lines":
            text += "\n" + rng.choice(shared) + "\n" + prose(20)
        docs.append((i, text))
        if kind in ("good", "low", "toxic", "lines") and rng.random() < 0.7:
            labels.append((i, 0 if kind == "low" else 1, int(kind == "toxic")))
    docs += [(1000, None), (1001, ""), (1002, docs[0][1]), (1002, docs[0][1])]
    return docs, labels, [(k, t) for k, t in enumerate(items)] + [(90, None)]


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("corpus"))
    docs, labels, items = corpus()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


# -- plain versions: each takes and gives (doc_id, text) rows


def plain_quality(spark, where, rows):
    model = quality.learn(read_table(spark, where, "documents"), read_table(spark, where, "labels"), id_crc("doc_id") % 5 != 0)
    return [r for r in rows if plain_score(model, (r[1] or "").encode()) >= 0.3]


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def plain_lines(rows):
    holders = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        for k in {line_key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                holders[k].append((n, i))
    keeper = {k: max(i for _, i in h) for k, h in holders.items() if len(h) >= 5}
    return [(i, t and "\n".join(x for x in t.split("\n") if keeper.get(line_key(x), i) == i)) for i, t in rows]


def plain_classes(rows):
    """One row of each class: smallest id, equal rows once."""
    fps = [brute_fingerprint(t or "") for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                label[root(a)] = root(b)
    classes = defaultdict(list)
    for n in range(len(rows)):
        classes[root(n)].append(rows[n])
    return [min(c, key=lambda r: r[0]) for c in classes.values()]


def plain_clean(rows, items):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    bad = set()
    for i, t in rows:
        d = split(t)
        for _, item in items:
            w = split(item)
            if plain_seeds(w) & plain_seeds(d):
                total = slow_align(w, d, 0.5)
                if total >= 0.4 * len(w) and total >= min(6, len(w)):
                    bad.add(i)
    return [r for r in rows if r[0] not in bad]


def plain_features(text):
    words = [w for w in re.split(r"[\s!-/:-@\[-`{-~]+", (text or "").lower()) if w]
    marks = 1 - len("".join(words)) / max(len(text or ""), 1)
    return len(words), {*words, f"marks {math.floor(marks * 20)}", f"differ {math.floor(len(set(words)) / max(len(words), 1) * 10)}"}


def plain_domains(rows, labels, targets):
    """The likeliest domain of each row by Bernoulli naive Bayes over chosen features."""
    domain = {i: "toxic" if t == 1 else "low" if q == 0 else "clean" for i, q, t in labels}
    sample = [(domain[i], plain_features(t)[1]) for i, t in rows if i in domain]
    sizes = Counter(d for d, _ in sample)
    named = [d for d in sorted(targets) if d in sizes]
    seen = {d: Counter(f for e, fs in sample if e == d for f in fs) for d in named}
    n = Counter(f for _, fs in sample for f in fs)
    bar = mixing.least_g(len(n), len(named), 0.01)
    part = lambda o, e: 2 * o * math.log(o / e) if o > 0 else 0.0
    g = {f: sum(part(seen[d][f], n[f] * sizes[d] / len(sample)) + part(sizes[d] - seen[d][f], (len(sample) - n[f]) * sizes[d] / len(sample)) for d in named)
         for f in n if n[f] < len(sample)}
    share = lambda k, size: (k + 0.5) / (size + 1)
    chosen = set()
    for d in named:
        fit = [f for f in g if g[f] >= bar and share(seen[d][f], sizes[d]) >= 2.5 * share(n[f] - seen[d][f], len(sample) - sizes[d])]
        chosen |= set(sorted(fit, key=lambda f: (-g[f], f))[:128])
    assert chosen
    out = {}
    for i, t in rows:
        fs = plain_features(t)[1]
        score = {d: math.log(sizes[d] / len(sample)) + sum(math.log(p if f in fs else 1 - p) for f in chosen for p in [share(seen[d][f], sizes[d])]) for d in named}
        out[i] = max(named, key=score.get)
    return out


def test_every_stage_equals_its_plain_version(spark, fixture):
    docs, labels, items = corpus()
    rows, table = docs, read_table(spark, fixture, "documents")
    dropped = {}
    for name, stage in corpus_pipeline.STAGES:
        if name == "quality":
            want = plain_quality(spark, fixture, rows)
        elif name == "line_dedup":
            want = plain_lines(rows)
        elif name == "near_duplicates":
            want = plain_classes(rows)
        elif name == "decontaminate":
            want = plain_clean(rows, items)
        else:
            domains = plain_domains(rows, labels, corpus_pipeline.TARGETS)
            want = [r for r in rows if domains[r[0]] == "clean"]
        before = table.columns
        table = corpus_pipeline.stored(stage(spark, table, fixture), f"test-{name}")
        got = table.select("doc_id", "text").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr), name
        if name != "mixing":
            assert table.columns == before
        dropped[name] = len(rows) - len(want) if name != "line_dedup" else sum(a != b for a, b in zip(rows, want))
        rows = want
    assert min(dropped.values()) > 0, dropped
    result = corpus_pipeline.run(spark, fixture)
    assert sorted(map(tuple, result.select("doc_id", "text").collect()), key=repr) == sorted(rows, key=repr)
    assert {r["n_chars"] == len(r["text"] or "") for r in result.collect()} == {True}


def test_rates_bring_clean_tokens_to_the_target(spark, fixture):
    docs = read_table(spark, fixture, "documents")
    out = mixing.mix(docs, label_domains(read_table(spark, fixture, "labels")), {"clean": 0.9, "low": 0.08, "toxic": 0.02}).collect()
    total = sum(r["n_tokens"] for r in out)
    share = {d: sum(r["rate"] * r["n_tokens"] * r["posteriors"][d] for r in out) / total for d in ("clean", "low", "toxic")}
    assert share == pytest.approx({"clean": 0.9, "low": 0.08, "toxic": 0.02}, abs=2e-3)


CLASHES = ["_quality", "score", "n_lines", "n_dropped", "_gone", "_row", "fp", "component_id", "_document", "d", "at", "grams", "domain", "rate", "n_tokens",
           "posteriors", "_features", "p0", "_d", "_drops", "key"]


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_clashing_names_and_odd_rows(spark, fixture, stage):
    """Extra columns named like helpers and results change nothing; null ids, repeated rows and no rows at all pass."""
    run = dict(corpus_pipeline.STAGES)[stage]
    docs = read_table(spark, fixture, "documents").filter("doc_id % 3 = 0 OR doc_id >= 1000")
    odd = docs.unionByName(docs.filter("doc_id < 12")).unionByName(docs.filter("doc_id = 30").withColumn("doc_id", F.lit(None).cast("long")))
    clash = odd.withColumns({c: F.lit(7) for c in CLASHES})
    got, plain = run(spark, clash, fixture), run(spark, odd, fixture)
    assert set(clash.columns) <= set(got.columns)
    rows = [sorted(map(repr, x.select("doc_id", "text", "lang").collect())) for x in (got, plain)]
    assert rows[0] == rows[1] and 0 < len(rows[0]) <= odd.count()
    assert got.select(CLASHES).distinct().count() == 1
    empty = run(spark, clash.limit(0), fixture)
    assert empty.collect() == [] and empty.columns == got.columns
