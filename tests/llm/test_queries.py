"""Every registered query of the package: SQL on sf0.001, plain versions otherwise."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from firn.llm import queries
from firn.plans.compare import compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries.load()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    res = compare(QUERIES[name](spark, SF), duck, ORACLES[name])
    assert res["ok"], res


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_near_dedup_matches_plain_version(spark):
    want = brute.near_components(documents(spark))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op4_near_dedup"](spark, SF).collect()}
    assert got == want


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op5_language_id"](spark, SF).join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_lm_base_is_exact_and_model_is_better_on_held_out(spark):
    docs = documents(spark)
    counts = Counter()
    for i, text in docs:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(brute.words(text) + ["\n"])
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in QUERIES["op6_lm_score"](spark, SF).collect()}
    for i, text in docs:
        w = brute.words(text) + ["\n"]
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert got[i].base_score == pytest.approx(base, rel=1e-9)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_sharding_law(spark):
    rows = QUERIES["op10_sharding"](spark, SF).collect()
    texts = dict(documents(spark))
    assert len(rows) == len(texts)
    of_text = {}
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        assert of_text.setdefault(texts[r.doc_id], r.shard) == r.shard
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    groups = Counter()
    for t in texts.values():
        groups[t] += len(t.encode()) + 1
    assert max(load.values()) - min(load.values()) <= 2 * max(groups.values())
    for k in range(8):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))


def test_reruns_agree(spark):
    for name in ("op8_mixing", "op4_near_dedup", "op10_sharding", "op1_html_extract"):
        a, b = (sorted(map(str, QUERIES[name](spark, SF).collect())) for _ in range(2))
        assert a == b


def test_queries_read_whole_tables(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op2_decontaminate", "op3_exact_dedup", "op8_mixing"):
        assert QUERIES[name](spark, SF).agg(F.count("*")).first()[0] == n
