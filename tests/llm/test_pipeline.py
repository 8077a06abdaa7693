"""The pipeline against plain versions of its stages."""

from collections import Counter

import pytest

import brute
import corpus_pipeline
from firn.llm import mixing
from odd import odd_docs  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = corpus_pipeline.read_table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_columns(spark, stages):
    columns = corpus_pipeline.read_table(spark, SF, "documents").columns
    assert all(s.columns == columns for s in stages[:-1])
    assert stages[-1].columns == [*columns, "shard", "slot"]


def test_stages_match_plain_versions(spark, stages):
    docs = {r.doc_id: r for r in corpus_pipeline.read_table(spark, SF, "documents").collect()}
    known = {r.doc_id for r in stages[0].collect()}
    assert known == {i for i, r in docs.items() if any(c.isalpha() for c in r.text or "")}
    parts = brute.near_components([(i, docs[i].text) for i in known])
    unique = {i for i in known if parts[i][1] == i}
    assert {r.doc_id for r in stages[1].collect()} == unique
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i in unique if not brute.phrase_hits(docs[i].text, items)[1]}
    assert {r.doc_id for r in stages[2].collect()} == clean
    taken = {r.doc_id: r.taken for r in mixing.mix(stages[2]).collect()}
    got = Counter()
    for r in stages[3].collect():
        got[r.doc_id] += len(brute.words(r.text))
    assert got == Counter({i: t for i, t in taken.items() if t})
    rows = stages[4].collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in stages[3].collect())
    for k in range(8):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))


def test_odd_rows(spark, odd_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "odd")
    assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in odd_docs.collect()}


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
