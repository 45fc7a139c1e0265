"""Registered queries against their SQL, and the pipeline against its parts."""

import duckdb
import pytest

import corpus_pipeline
from barsmith.llm import registry

SMALL, DATA = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def test_every_operator_has_a_query():
    assert [sum(k.startswith(f"op{n}_") for k in registry.queries()) for n in range(1, 14)] == [1] * 13
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    rel = con.execute(registry.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    want = [dict(zip(cols, r, strict=True)) for r in rel.fetchall()]
    got = [r.asDict() for r in registry.queries()[name](spark, DATA).collect()]
    assert sorted(got[0]) == sorted(cols)
    key = lambda r: [str(r[c]) for c in sorted(cols)]
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_pipeline_stages(spark):
    """Each stage decides as its operator does on the very documents it was given."""
    from barsmith.llm import decontaminate, line_dedup, simhash
    from barsmith.llm.common import read_table, stored

    docs = read_table(spark, SMALL, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontaminate", "mixing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SMALL), f"test-{name}")
        kept[name] = {r["doc_id"]: r.asDict() for r in docs.collect()}
        if name != "mixing":
            assert docs.columns == before.columns
        if name == "line_dedup":
            want = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(before).collect()}
            assert {i: r["text"] for i, r in kept[name].items()} == want
        if name == "near_duplicates":
            first = {r["component_id"] for r in simhash.near_duplicates(before).collect()}
            assert set(kept[name]) == first
        if name == "decontaminate":
            bad = {r["doc_id"] for r in decontaminate.matches(before, read_table(spark, SMALL, "benchmark")).collect()}
            assert bad and set(kept[name]) == {r["doc_id"] for r in before.collect()} - bad
    labels = {r["doc_id"]: r for r in read_table(spark, SMALL, "labels").collect()}
    fine = {i for i, r in labels.items() if r["quality"] == 1}
    assert len(fine - set(kept["quality"])) <= 0.05 * len(fine)
    assert all(r["rate"] > 0 for r in kept["mixing"].values())
    assert set(kept["line_dedup"]) == set(kept["quality"])


@pytest.mark.parametrize("separable", [True, False])
def test_mixing_stage_drops_by_domain(spark, tmp_dir, separable):
    """Toxic and low documents leave and clean ones stay, whether the fit of the rates takes one
    step (posteriors almost 0 or 1) or many."""
    words = {"clean": "meadow river stone", "low": "click offer prize", "toxic": "vile scum filth"}
    rows, labels = [], []
    for i in range(600):
        d = "toxic" if i % 10 == 0 else "low" if i % 10 == 1 else "clean"
        own = words[d].split() if separable or i % 7 else words[d].split()[:1] + words["low" if d == "clean" else "clean"].split()[:1]
        rows.append((i, " ".join([*own, *(f"w{(i * k) % 50}" for k in range(1, 9))])))
        labels.append((i, int(d != "low"), int(d == "toxic")))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in corpus_pipeline.mix(spark, docs, tmp_dir).collect()}
    assert {r["domain"] for r in got.values()} == {"clean"}
    if separable:
        assert set(got) == {i for i, quality, toxic in labels if quality and not toxic}
    out = corpus_pipeline.mixing.mix(docs, corpus_pipeline.label_domains(spark.read.parquet(f"{tmp_dir}/labels.parquet")), corpus_pipeline.TARGETS).collect()
    assert set(got) == {r["doc_id"] for r in out if r["domain"] == "clean"}
