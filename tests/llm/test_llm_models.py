"""Quality, languages, tokens, neighbours, decontamination and mixing."""

import random
import warnings
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barsmith.llm import ann, decontaminate, langid, mixing, quality, queries, tokens

DATA = "/root/testdata/sf0.01"


def held_out(i, k):
    return zlib.crc32(str(i).encode()) % k


# -- quality


def test_quality_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.op5_quality(spark, DATA).collect()}
    assert len(got) == 1000
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (held_out(i, 5) == 0) for i, r in got.items())
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{DATA}/labels.parquet").collect() if held_out(r["doc_id"], 5) == 0]
    assert sum(got[i]["predicted"] == q for i, q in labels) >= 0.93 * len(labels)


def plain_score(w, text):
    """The network without blocks, groups or segments."""
    data = np.full((len(text) + quality.STEP) // quality.HALF * quality.HALF + quality.HALF, quality.PAD)
    data[:len(text)] = np.frombuffer(text, np.uint8)
    blocks = w["emb"][data].reshape(len(data) // 4, -1).astype(np.float64)
    act = blocks @ w["first"]
    act[:-1] += blocks[1:] @ w["second"]
    act[data[::4] == quality.PAD] = -1e9
    n, per = len(data) // quality.HALF, quality.BLOCKS
    logits = []
    for c in range(max(1, n - 1)):
        part = slice(c * per, (c + 2) * per)
        z = np.maximum(act[part].max(axis=0) + w["bias"], 0)
        x = np.append(z, (data[::4][part] != quality.PAD).sum() / (2 * per))
        logits.append((np.maximum(x @ w["dense"] + w["dense_bias"], 0) @ w["out"] + w["out_bias"])[0])
    return 1 / (1 + np.exp(-np.mean(logits)))


def test_network_equals_its_plain_version():
    w = quality.new_weights(np.random.default_rng(1))
    rng = random.Random(2)
    texts = [bytes(rng.choices(range(256), k=n)) for n in (0, 1, 3, 4, 251, 252, 253, 256, 257, 511, 512, 513, 2000, 9000)]
    assert np.allclose(quality.scores(w, texts), [plain_score(w, t) for t in texts], atol=1e-4)


def test_quality_edge_cases(spark):
    rows = [(1, "good words in a plain line"), (2, "###!!! $$$ ###"), (3, None), (4, ""), (None, "x"), (1, "good words again"), (5, "a" * 1_300_000)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (7, 1)], "doc_id long, quality int")
    out = quality.score(docs, quality.learn(docs, labels, F.lit(True)))
    assert out.columns == ["doc_id", "text", "score", "_score"]
    assert out.count() == 7 and out.filter("_score between 0 and 1").count() == 7
    assert quality.learn(docs, labels.limit(0), F.lit(True)) == 0.5
    assert quality.learn(docs, labels.filter("quality = 1"), F.lit(True)) == 1.0
    assert quality.score(docs.limit(0), 0.5).collect() == []


# -- languages


def test_languages_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.op8_language_id(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    test = [d for d in docs if held_out(d["doc_id"], 4) == 2]
    assert all(got[d["doc_id"]]["held_out"] for d in test) and len(got) == len(docs)
    assert sum(got[d["doc_id"]]["lang_pred"] == d["lang"] for d in test) >= 0.97 * len(test)


def test_language_edge_cases(spark):
    rows = [(i, "the cat and the dog are here with this and that", "en") for i in range(30)] + [(50 + i, "der hund und die katze sind hier mit das", "de") for i in range(30)]
    rows += [(90, None, "en"), (91, "", "de"), (92, "12 34 !!", None), (None, "der hund und die katze", None), (93, "the dog and the cat " * 5000, None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, lang_score double")
    dicts = langid.dictionaries(docs, F.lit(True))
    assert set(dicts) == {"en", "de"}
    out = langid.identify(docs, dicts)
    assert out.columns == ["doc_id", "text", "lang", "lang_score", "lang_best", "lang_id", "_lang_score", "lang_margin"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[i]["lang_best"] for i in (0, 50, 90, 91, 92, None, 93)] == ["en", "de", "und", "und", "und", "de", "en"]
    assert got[92]["_lang_score"] == 0 and got[0]["lang_id"] == "en"
    assert {r["lang_best"] for r in langid.identify(docs, langid.dictionaries(docs.limit(0), F.lit(True))).collect()} == {"und"}
    assert langid.identify(docs.limit(0), dicts).collect() == []
    narrow = langid.identify(docs, {"a": dicts["en"], "b": dicts["en"]}).filter("doc_id = 0").first()
    assert narrow["lang_id"] == "und" and narrow["lang_best"] == "a"


def plain_size(content, text):
    """Bytes of the text's letters, each 4096 bytes on end encoded from scratch with the dictionary's content."""
    import zstandard

    raw = "".join(c if c.isalpha() else " " for c in text.lower())
    while "  " in raw:
        raw = raw.replace("  ", " ")
    raw, total = raw.encode(), 0
    for i in range(0, len(raw), 4096):
        params = zstandard.ZstdCompressionParameters.from_level(langid.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        total += len(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress(raw[i:i + 4096]))
    return total


def test_languages_equal_a_plain_version(spark):
    """Every document of the whole table: the language whose dictionary encodes it shortest, the commoner one of equals."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    remainder = queries.id_crc("doc_id") % 4
    dicts = langid.dictionaries(docs, remainder != 2)
    got = {r["doc_id"]: r for r in queries.op8_language_id(spark, DATA).collect()}
    rows = docs.collect()
    for r in rows:
        sizes = {lang: plain_size(content, r["text"] or "") for lang, content in dicts.items()}
        want = min(sizes, key=sizes.get) if any(map(str.isalpha, r["text"] or "")) else "und"
        assert got[r["doc_id"]]["lang_pred"] == want
        if want != "und":
            weights = [np.exp(-60 * (n / sizes[want] - 1)) for n in sizes.values()]
            assert got[r["doc_id"]]["score"] == pytest.approx(1 / sum(weights))
    # one encoder for all lengths: short texts are told as well
    short = [r for r in rows if 0 < len(r["text"] or "") <= 512 and held_out(r["doc_id"], 4) == 2]
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in short) >= 0.95 * len(short)


# -- tokens


def vocabulary_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def test_token_counts_equal_the_library(library, monkeypatch):
    v = tokens.Vocabulary(vocabulary_path())
    count = tokens.counter(v.spec, v.proven, v.special)
    rng = random.Random(1)
    texts = ["".join(rng.choices(" \n\t  ab1.'é\xa0 \x1c\x85,s漢😀", k=rng.randint(0, 14))) for _ in range(8000)]
    texts += [f"a{chr(c)}b {chr(c)} 1{chr(c)}{chr(c)}2  {chr(c)}." for c in [*range(0x3000), *range(0xD7A0, 0xD800), *range(0xE000, 0xE100)]]
    texts += ["", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>", "don't  'S  'll x\n\n y", "a" * 5000, " " * 3000 + "x", "é" * 3000, "<|endoftext"]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [count(t) for t in texts] == want
    monkeypatch.setattr(tokens, "BLOCK_CHARS", 5)
    assert [count(t) for t in texts] == want


def test_proven_strings_are_single_tokens(library):
    proven = sorted(tokens.Vocabulary(vocabulary_path()).proven)
    assert len(proven) > 40_000
    assert all(len(e.ids) == 1 for e in library.encode_batch(proven, add_special_tokens=False))


def test_token_query_and_edge_cases(spark, library):
    docs = [r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in queries.op7_token_counts(spark, DATA).collect()}
    n = [len(e.ids) for e in library.encode_batch([d["text"] for d in docs], add_special_tokens=False)]
    assert got == {d["doc_id"]: (len(d["text"].encode()), k, k > 1024) for d, k in zip(docs, n, strict=True)}
    rows = spark.createDataFrame([(1, None, 3), (None, "", 3), (2, "é b", 3), (2, "é b", 3)], "doc_id long, text string, n_tokens int")
    out = tokens.token_counts(rows, vocabulary_path(), limit=2)
    assert out.columns == ["doc_id", "text", "n_tokens", "_n_tokens", "n_bytes", "over_limit"]
    assert sorted((r["n_bytes"], r["_n_tokens"]) for r in out.collect()) == [(0, 0), (0, 0), (4, 2), (4, 2)]
    assert tokens.token_counts(rows.limit(0), vocabulary_path()).collect() == []


# -- neighbours


def brute_neighbours(rows, k=5):
    out = set()
    for q, x in rows:
        if q % 50:
            continue
        x = np.array(x, np.float64)
        best = {}
        for i, y in rows:
            if i != q:
                s = float(ann.cosines(x[None], np.array(y, np.float64)[None])[0])
                best[i] = max(best.get(i, -2), s)
        for r, (i, s) in enumerate(sorted(best.items(), key=lambda t: (-t[1], t[0]))[:k]):
            out.add((q, r + 1, i, round(s, 9)))
    return out


def collect(df):
    return {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in df.collect()}


def test_neighbours_exact_when_all_leaves_are_taken(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(260)]
    rows += [(300 + i, rows[50][1]) for i in range(60)]  # a crowd of equal vectors, two of them queries
    rows += [(400, [float(2 * x) for x in rows[50][1]]), (50, rows[50][1])]
    bad = [(450, None), (500, []), (550, [0.0] * 8), (600, [float("nan")] * 8), (650, [float("inf")] + [1.0] * 7), (700, [None] + [1.0] * 7), (None, [1.0] * 8), (750, [1.0] * 3)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, embedding array<float>, rank int")
    got = collect(ann.nearest(df, F.col("id") % 50 == 0, block_rows=16, trees=3))
    assert got == brute_neighbours(rows)


def test_neighbours_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(a, b) for _, a, b, _ in sorted(collect(ann.nearest(df, F.col("id") % 50 == 0)))] == [(1, 1), (2, 2)]
    assert ann.nearest(df.limit(0), F.col("id") % 50 == 0).collect() == []
    assert ann.nearest(df.filter("vec_id = 0"), F.col("id") % 50 == 0).collect() == []


def test_forest_recall(spark):
    """Leaves chosen through the shared queue find what brute force finds."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest = [ann.build_tree(x[rng.choice(6000, 2000, replace=False)], rng) for _ in range(8)]
    members = [ann.route(t, x) for t in forest]
    sizes = {(t, int(leaf)): int(n) for t, m in enumerate(members) for leaf, n in zip(*np.unique(m, return_counts=True), strict=True)}
    hit = 0
    for q in range(0, 6000, 120):
        seen = np.zeros(6000, bool)
        for t, leaf in ann.nearest_leaves(forest, sizes, x[q], 0.8 * 6000):
            seen |= members[t] == leaf
        hit += seen[np.argsort(-(x @ x[q]))[1:6]].sum()
    assert hit >= 0.9 * 250


# -- decontamination

PASSAGE = [f"w{i}" for i in range(40)]


def test_alignment():
    item = list("abcdefgh")
    assert decontaminate.align(item, list("xxabcdefghyy"), 0.5) == (8.0, 2, 9)
    assert decontaminate.align(item, list("abcxdefgh"), 0.5) == (7.5, 0, 8)  # an extra word
    assert decontaminate.align(item, list("abcefgh"), 0.5) == (6.5, 0, 6)  # a lost word
    assert decontaminate.align(item, list("abcxefgh"), 0.5) == (6.5, 0, 7)  # another word
    assert decontaminate.align(item, ["x"], 0.5)[0] == 0


def slow_align(item, window, penalty):
    h = np.zeros((len(item) + 1, len(window) + 1))
    for i, a in enumerate(item):
        for j, b in enumerate(window):
            h[i + 1, j + 1] = max(0, h[i, j] + (1 if a == b else -penalty), h[i, j + 1] - penalty, h[i + 1, j] - penalty)
    return h.max()


def test_alignment_equals_the_plain_recurrence():
    rng = random.Random(7)
    for _ in range(200):
        a, b = (rng.choices("abcd", k=rng.randint(1, 15)) for _ in range(2))
        assert decontaminate.align(a, b, 0.5)[0] == pytest.approx(slow_align(a, b, 0.5))


def test_words_are_the_same_in_any_block():
    text = "Erste Wörter, two  words\n3 ünd x" * 3
    one = next(iter(decontaminate.split([text])))
    assert [one[1][s:e].decode() for s, e in zip(one[3], one[4], strict=True)] == __import__("re").findall(r"[a-z0-9ö-ü]+", text.lower())
    long = "Wort " * 200_000
    (_, _, h, _, _), (_, _, again, _, _) = list(decontaminate.split([long, "Wort " * 3]))[::-1][:2]
    assert {len(set(h.tolist())), len(set(again.tolist()))} == {1} and {len(h), len(again)} == {200_000, 3} and h[0] == again[0]


def test_contamination_found_and_clean_left(spark):
    rng = random.Random(1)
    filler = lambda n: [f"f{rng.randint(0, 10**6)}" for _ in range(n)]
    edited = [x if i % 6 else "edit" for i, x in enumerate(PASSAGE)]
    lost = [x for i, x in enumerate(PASSAGE) if i % 7]
    docs = {1: filler(50) + PASSAGE + filler(50), 2: filler(30) + edited + filler(500), 3: lost, 4: [x.upper() + "," for x in PASSAGE], 5: filler(400), 6: PASSAGE[:8] + filler(100),
            7: filler(200_000) + PASSAGE}
    docs |= {100 + i: PASSAGE + filler(3) for i in range(200)}  # a passage that most documents share
    rows = [(i, " ".join(w), "x") for i, w in docs.items()] + [(8, None, "x"), (9, "", "x"), (None, " ".join(PASSAGE), "x"), (1, "nothing", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, item string")
    bench = spark.createDataFrame([(1, " ".join(PASSAGE)), (1, " ".join(PASSAGE)), (2, "w1 w2"), (3, None), (None, "the end of all things is near to us"), (4, " ".join(filler(30)))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.matches(df, bench).collect()}
    assert set(got) == {(i, 1) for i in (1, 2, 3, 4, 7, None, *range(100, 300))}
    assert got[1, 1]["score"] == 1 and got[1, 1]["first_word"] == 50 and got[1, 1]["last_word"] == 89
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["5", "6", "8", "9"]
    unknown = spark.createDataFrame([(None, "nothing of it", "x"), (None, " ".join(PASSAGE), "y"), (None, None, "z")], df.schema)
    assert sorted(r["item"] for r in decontaminate.clean(unknown, bench).collect()) == ["x", "z"]
    assert decontaminate.matches(df.limit(0), bench).collect() == []
    assert decontaminate.matches(df, bench.limit(0)).collect() == []


def test_edited_copies_found_beside_exact_ones(spark):
    """Each item stands whole in 200 documents and changed in one way in another."""
    changed = {k: lambda words, k=k: [f"x{i}" if i % k == k - 1 else w for i, w in enumerate(words)] for k in (4, 5, 6)}
    changed |= {18: lambda words: words[:18], 20: lambda words: words[:20], 5000: lambda words: words[:5], 5001: lambda words: words[::2]}
    items = {k: [f"w{k}n{i}" for i in range(40)] for k in changed}
    docs = [(1000 + i, " ".join([f"p{i}", *(w for words in items.values() for w in [*words, f"q{i}"])])) for i in range(200)]
    docs += [(k, " ".join([f"p{k}", *change(items[k]), f"q{k}"])) for k, change in changed.items()]
    bench = spark.createDataFrame([(k, " ".join(words)) for k, words in items.items()], "item_id long, text string")
    found = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in found.collect()}
    sums = {k: slow_align(items[k], change(items[k]), 0.5) for k, change in changed.items()}
    want = {(k, k): s / 40 for k, s in sums.items() if s / 40 >= 0.4 and s >= 6}
    assert {k for k, _ in want} == {4, 5, 6, 18, 20}
    assert got == pytest.approx(want | {(1000 + i, k): 1.0 for i in range(200) for k in items})


def test_alignments_are_skipped_only_below_the_bar():
    rng = np.random.default_rng(8)
    for _ in range(300):
        a, b = ([str(x) for x in rng.integers(0, 12, k)] for k in rng.integers(1, 30, 2))
        whole = decontaminate.align(a, b, 0.5)
        for least in (0.4 * len(a), min(6.0, len(a))):
            assert decontaminate.align(a, b, 0.5, least) == whole or whole[0] < least


def test_windows_are_aligned_together_as_one_by_one():
    rng = random.Random(9)
    for _ in range(100):
        item = rng.choices("abcdefg", k=rng.randint(1, 15))
        windows = [rng.choices("abcdefghij", k=rng.randint(1, 40)) for _ in range(7)] + [[], ["z"]]
        for least in (0.0, 0.4 * len(item), 0.8 * len(item)):
            got = decontaminate.align_all(item, windows, 0.5, least)
            assert got == [decontaminate.align(item, w, 0.5, least) for w in windows]
            for (total, lo, hi), w in zip(got, windows, strict=True):
                best = slow_align(item, w, 0.5) if w else 0
                assert total == pytest.approx(best) or (total == 0 and best < least)
                assert not total or slow_align(item, w[lo:hi + 1], 0.5) == pytest.approx(total)


def test_words_by_unicode_class(spark):
    """Marks of any script part words; unspaced scripts are read by character."""
    chinese = "人工智能正在改变世界各地的教育与科学研究"
    item = [f"wört{i}" for i in range(12)]
    bench = spark.createDataFrame([(1, chinese), (2, " ".join(item)), (3, "это предложение написано по русски и значит мало")], "item_id long, text string")
    docs = [(1, f"前言。{chinese[:11]}，{chinese[11:]}"), (2, "—".join(item)), (3, "“" + "” «".join(item)), (4, "\u00a0".join(item)), (5, "другое это предложение; написано… по-русски и значит мало"),
            (6, "世界很大"), (7, "".join(item))]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {(1, 1), (2, 2), (3, 2), (4, 2), (5, 3)}


def plain_seeds(words):
    """Three words on end, and three of four with the third left out."""
    return {(*words[i:i + 3], 0) for i in range(len(words) - 2)} | {(*words[i:i + 2], words[i + 3], 1) for i in range(len(words) - 3)}


def test_every_third_word_edited_is_found(spark):
    """Recall by share of words replaced: all copies whose alignment reaches the bar share a seed."""
    rng = random.Random(21)
    items = {k: [f"i{k}w{j}" for j in range(40)] for k in range(30)}
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    docs, want = [(1000 + p, " ".join("x" if j % 3 == p else w for j, w in enumerate(items[0]))) for p in range(3)], {(1000 + p, 0) for p in range(3)}
    for share in (0.1, 0.2, 0.3, 0.35):
        for k, words in items.items():
            i = int(share * 100) * 100 + k
            copy = [f"e{i}n{j}" if rng.random() < share else w for j, w in enumerate(words)]
            docs.append((i, " ".join(copy)))
            if slow_align(words, copy, 0.5) >= 16:
                want.add((i, k))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got <= want and len(want) > 100
    assert len(got) >= 0.99 * len(want)


def test_matches_equal_all_pairs(spark):
    """Every pair of document and item, aligned whole by the plain recurrence."""
    rng = random.Random(12)
    words = [f"c{i}" for i in range(30)]
    items = {k: rng.choices(words, k=rng.randint(3, 70)) for k in range(12)}
    items[20] = rng.choices(words, k=200)  # another class of length
    docs = {}
    for i in range(80):
        base = rng.choices(words, k=rng.randint(0, 60))
        if i % 2:
            part = list(items[rng.choice(list(items))])
            for _ in range(rng.randrange(len(part) // 3 + 1)):
                part[rng.randrange(len(part))] = rng.choice(words)
            base[len(base) // 2: len(base) // 2] = part
        docs[i] = base
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.matches(table, bench).collect()}
    want = {}
    for i, d in docs.items():
        for k, w in items.items():
            total = slow_align(w, d, 0.5)
            if plain_seeds(w) & plain_seeds(d) and total >= 0.4 * len(w) and total >= min(6, len(w)):
                want[i, k] = total / len(w)
    assert len(want) > 30 and got == pytest.approx(want)


def test_a_shared_phrase_is_not_aligned(spark, monkeypatch):
    """Items and documents that share one common phrase meet, and the bound keeps them from being aligned."""
    phrase = "what is the answer to"
    bench = spark.createDataFrame([(k, phrase + " " + " ".join(f"i{k}n{j}" for j in range(30))) for k in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(f"d{i}n{j}" for j in range(50)) + " " + phrase) for i in range(60)], "doc_id long, text string")

    def refuse(a, b, penalty):
        raise AssertionError("aligned")

    monkeypatch.setattr(decontaminate, "_align_group", refuse)
    assert decontaminate.matches(docs, bench).collect() == []
    hit = docs.unionByName(bench.selectExpr("1000 + item_id AS doc_id", "text"))
    with pytest.raises(Exception, match="aligned"):
        decontaminate.matches(hit, bench).collect()


# -- mixing


def mixing_rows():
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        d = "ab"[i % 4 == 0]
        words = [f"{d}{rng.randint(0, 3)}" for _ in range(3)] + [f"n{rng.randint(0, 500)}" for _ in range(rng.randint(5, 40))]
        rows.append((i, " ".join(words), "mine"))
        if i % 2 == 0:
            labels.append((i, d))
    return rows, labels


def test_rates_meet_the_targets(spark):
    rows, labels = mixing_rows()
    rows += [(900, None, "x"), (901, "", "x"), (None, "a1 a2", "x"), (0, rows[0][1], "x"), (902, "b1 " * 20_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate string")
    labelled = spark.createDataFrame([*labels, (None, "a"), (1, None), (3, "unknown"), (5000, "a")], "doc_id long, domain string")
    out = mixing.mix(docs, labelled, {"a": 1.0, "b": 3.0}, min_g=10.0)
    assert out.columns == ["doc_id", "text", "rate", "n_tokens", "posteriors", "domain", "_rate"]
    got = out.collect()
    assert len(got) == len(rows) and all(r["_rate"] >= 0 and abs(sum(r["posteriors"].values()) - 1) < 1e-9 for r in got)
    total = sum(r["n_tokens"] for r in got)
    share = {d: sum(r["_rate"] * r["n_tokens"] * r["posteriors"][d] for r in got) / total for d in "ab"}
    assert share == pytest.approx({"a": 0.25, "b": 0.75}, abs=0.01)
    truth = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 400]
    assert sum(r["domain"] == "ab"[r["doc_id"] % 4 == 0] for r in truth) >= 0.98 * len(truth)
    assert [r["n_tokens"] for r in got if r["doc_id"] in (900, 901)] == [0, 0]


def test_rates_equal_plain_projected_gradient(spark):
    rng = np.random.default_rng(6)
    p = rng.dirichlet([0.3, 0.3, 0.3], 50)
    n = rng.integers(1, 100, 50).astype(float)
    table = spark.createDataFrame([(*map(float, x), float(k)) for x, k in zip(p, n, strict=True)], "p0 double, p1 double, p2 double, n double")
    targets = [0.7, 0.3, 0.0]
    steps = mixing.fit_rates(table, targets, None, iterations=25, tolerance=1e-9)
    got = np.array([r[0] for r in table.select(mixing.rate_of(["p0", "p1", "p2"], steps)).collect()])
    w, mass = np.ones(50), n @ p
    for _ in steps:
        w = np.maximum(0, w - p @ ((w * n) @ p / mass - np.array(targets) * n.sum() / mass))
    assert np.allclose(got, w)
    loss = lambda w: (((w * n) @ p - np.array(targets) * n.sum()) ** 2 / mass).sum()
    assert loss(w) < 0.05 * loss(np.ones(50))


@pytest.mark.parametrize("rows, targets", [
    ([(0.6, 0.4, 1.0), (0.4, 0.6, 1.0)], [0.58, 0.42]), ([(0.52, 0.48, 1.0), (0.48, 0.52, 1.0)], [0.515, 0.485]),
    ([(0.9, 0.1, 50.0), (0.2, 0.8, 3.0), (0.5, 0.5, 7.0)], [0.3, 0.7]), ([(1.0, 0.0, 5.0), (0.0, 1.0, 5.0)], [1.0, 0.0])])
def test_reachable_targets_are_met(spark, rows, targets):
    """Posteriors that hardly differ slow the gradient down; the last step meets the targets all the same."""
    table = spark.createDataFrame(rows, "p0 double, p1 double, n double")
    steps = mixing.fit_rates(table, targets, None, iterations=10, tolerance=5e-4)
    steps, got, wanted = mixing.dual_step(table, targets, None, steps, tolerance=5e-4)
    total = sum(n for _, _, n in rows)
    assert wanted == pytest.approx([t * total for t in targets])
    assert got == pytest.approx(wanted, abs=1e-3 * total)
    w = [r[0] for r in table.select(mixing.rate_of(["p0", "p1"], steps)).collect()]
    assert min(w) >= 0
    back = [sum(x * r[2] * r[i] for x, r in zip(w, rows)) for i in (0, 1)]
    assert back == pytest.approx(got)


def test_unreachable_targets_are_told(spark):
    rows, labels = mixing_rows()
    docs, labelled = spark.createDataFrame(rows, "doc_id long, text string, rate string"), spark.createDataFrame(labels, "doc_id long, domain string")
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        mixing.mix(docs, labelled, {"a": 1.0, "b": 3.0}, min_g=10.0)
    same = docs.withColumn("text", F.lit("a1 b1"))
    with pytest.warns(UserWarning, match="out of reach"):
        mixing.mix(same, labelled, {"a": 0.1, "b": 0.9})


def test_mixing_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, domain string")
    assert [(r["n_tokens"], r["rate"], r["domain"]) for r in mixing.mix(docs, none, {"a": 1.0}).orderBy("doc_id").collect()] == [(2, 1.0, None), (0, 1.0, None)]
    assert mixing.mix(docs.limit(0), none, {"a": 1.0}).collect() == []
    one = spark.createDataFrame([(1, "a")], "doc_id long, domain string")
    assert {r["rate"] for r in mixing.mix(docs, one, {"a": 1.0, "b": 0.0}).collect()} == {1.0}
    with pytest.raises(ValueError, match="weights"):
        mixing.mix(docs, one, {"a": 0.0})


def test_mixing_runs_no_python(spark):
    plan = queries.op10_mixing(spark, DATA)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_bar_of_features_follows_the_sample(spark):
    """Few labelled rows: a word in 6 of 10 toxic ones teaches, chance words don't; none is a warning."""
    rng = random.Random(4)
    filler = [" ".join(f"f{rng.randint(0, 60)}" for _ in range(8)) for _ in range(90)]
    labels = spark.createDataFrame([(i, "toxic" if i < 10 else "clean") for i in range(90)], "doc_id long, domain string")
    docs = spark.createDataFrame([(i, ("scum " if i < 6 else "") + x) for i, x in enumerate(filler)], "doc_id long, text string")
    assert list(mixing.learn(docs, labels, ["clean", "toxic"]).weights) == ["scum"]
    assert mixing.least_g(1, 2, 0.05) == pytest.approx(3.841, abs=1e-3) and mixing.least_g(1, 5, 0.05) == pytest.approx(9.488, abs=1e-3)
    plain = spark.createDataFrame(list(enumerate(filler)), "doc_id long, text string")
    with pytest.warns(UserWarning, match="no word"):
        assert mixing.learn(plain, labels, ["clean", "toxic"]).weights == {}


def test_each_domain_has_features_of_its_own(spark):
    words = {"a": "a1 a2 a3 a4", "b": "b1 b2 b3 b4", "rare": "r1"}
    rows = [(i, "rare" if i % 20 == 0 else "ab"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame([(i, f"{words[d]} w{i % 9}") for i, d in rows], "doc_id long, text string")
    model = mixing.learn(docs, spark.createDataFrame(rows, "doc_id long, domain string"), ["a", "b", "rare"], max_features=3)
    assert "r1" in model.weights and {k[0] for k in model.weights} >= {"a", "b", "r"}
