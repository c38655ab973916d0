"""The registered queries and the pipeline against plain versions."""
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from claimflow.llm import catalog
from rows import awkward, empty
from test_llm_maps import brute_hits, size
from test_llm_pairs import brute_near

SF001 = "/root/testdata/sf0.001"


def test_queries_are_registered():
    import __spark_entry__
    names = list(__spark_entry__.queries())
    assert [n for n in catalog.QUERIES if n in names] == list(catalog.QUERIES) and "pipeline" in names
    assert {re.match(r"op(\d+)_", n)[1] for n in catalog.QUERIES} == {str(i) for i in range(1, 14)}


@pytest.mark.parametrize("name", list(catalog.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = catalog.QUERIES[name](spark, SF001)
    res = con.execute(catalog.ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, res.fetchall()))


def test_stages_take_effect(spark):
    """Each stage on what the one before kept, against brute force."""
    df, rows = awkward(spark, 20)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    planted = spark.createDataFrame([(500 + i, "intro words here " + items[i][1], "en", "a", 1) for i in range(4)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = df.unionByName(planted, allowMissingColumns=True)
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["language_id", "near_dedup", "decontaminate", "mixing", "packing"]
    known = stage["language_id"](spark, docs, SF001).cache()
    ids = {r.doc_id for r in known.collect()}
    assert known.columns == docs.columns and not ids & {100, 101, 102, 103} and {500, 501, 502, 503} <= ids
    unique = stage["near_dedup"](spark, known, SF001).cache()
    numbered = [(i, r.text, r.doc_id) for i, r in enumerate(known.collect()) if r.doc_id is not None]
    groups, first = brute_near([r[:2] for r in numbered], 5, 80), {}       # by text: a key's different texts are different documents
    for i, _, key in numbered:
        first[groups[i]] = min(first.get(groups[i], key), key)
    assert sorted(r.doc_id for r in unique.collect() if r.doc_id is not None) == sorted(first.values())
    clean = stage["decontaminate"](spark, unique, SF001).cache()
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(
        r.doc_id or -1 for r in unique.collect() if r.doc_id not in (109, 110, 111) and not brute_hits(r.text, items, 10)[1] or r.doc_id in (109, 110, 111))
    assert not {r.doc_id for r in clean.collect()} & {500, 501, 502, 503}
    mixed = stage["mixing"](spark, clean, SF001).cache()
    assert mixed.columns == docs.columns
    total = sum(size(r.text) for r in clean.collect())
    assert abs(sum(size(r.text) for r in mixed.collect()) - 1.5 * total) <= 5
    packed = stage["packing"](spark, mixed, SF001).collect()
    assert {d for r in packed for d in r.doc_ids} == {r.doc_id for r in mixed.collect()}
    for x in (known, unique, clean, mixed):
        x.unpersist()


def test_every_stage_takes_an_empty_table(spark):
    docs = empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        assert out.count() == 0, name
        if name != "packing":
            assert out.columns == docs.columns


def test_whole_pipeline_runs_and_reruns_agree(spark):
    a, b = (corpus_pipeline.run(spark, SF001).collect() for _ in range(2))
    def tokens(rows):
        return sum(r.n_tokens for r in rows), sorted(d for r in rows for d in r.doc_ids)
    assert len(a) > 10 and tokens(a) == tokens(b)
    assert all(len(np.frombuffer(r.ids, "<u2")) == 2048 for r in a)
