"""Operators on documents: odd rows, empty tables, clashing columns, plain versions."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from firn.llm import components, decontaminate, exact_dedup, language_id, maxent_lm, near_dedup
from odd import ROWS, clashing_docs, no_docs, odd_docs  # noqa: F401


# exact dedup

def test_exact_dedup_odd_rows(odd_docs, clashing_docs):
    for docs in (odd_docs, clashing_docs):
        rows = exact_dedup.exact_dedup(docs).collect()
        assert len(rows) == len(ROWS)
        groups = {}
        for i, text, *_ in ROWS:
            groups.setdefault(text or "", []).append(i)
        for r in rows:
            own = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
            ids = [i for i in own if i is not None]
            keep = max(ids) if ids else None
            assert (r.keep_id, r.group_size, r.kept) == (keep, len(own), r.doc_id == keep)


def test_exact_dedup_empty(no_docs):
    assert exact_dedup.exact_dedup(no_docs).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 1 << 44), min_size=1, max_size=200), st.integers(1, 40))
def test_rice_round_trip(values, shift):
    v = np.array(sorted(values), np.int64)
    if (np.diff(v, prepend=0) >> shift).sum() < 1 << 22:
        assert (exact_dedup.rice_decode(len(v), shift, *exact_dedup.rice_encode(v, shift)) == v).all()


# near dedup

def test_near_dedup_odd_rows(odd_docs, clashing_docs):
    for docs in (odd_docs, clashing_docs):
        rows = near_dedup.near_dedup(docs).collect()
        assert len(rows) == len(ROWS)
        want = brute.near_components([r[:2] for r in ROWS if r[0] is not None])
        for r in rows:
            if r.doc_id is not None:
                assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)
        kept = near_dedup.distinct_documents(docs)
        assert kept.columns == docs.columns


def test_near_dedup_empty(no_docs):
    assert near_dedup.near_dedup(no_docs).collect() == []


def near_copies(seed=3, bases=12, copies=14):
    """Groups whose members differ by more and more words, so that links lie on both sides of the threshold."""
    rnd, rows = random.Random(seed), []
    passage = [f"p{k}" for k in range(60)]
    for b in range(bases):
        base = [f"w{rnd.randrange(5000)}" for _ in range(120)]
        for c in range(copies):
            words = list(base)
            for _ in range(c):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(10 ** 6)}"
            if b % 3 == 0:  # a passage that many documents share
                words[:60] = passage
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [1024, 4])
def test_near_dedup_links_around_the_threshold(spark, block):
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()}
    assert got == brute.near_components(rows)


def test_signature_pigeonhole():
    """Signatures that differ in 23 of 48 values share a key wherever the differences are."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, (1, near_dedup.VALUES)).astype(np.uint16)
        b = a.copy()
        at = rng.choice(near_dedup.VALUES, 23, replace=False)
        b[0, at] ^= rng.integers(1, 1 << 16, 23).astype(np.uint16)
        assert set(near_dedup.signature_keys(a)[0]) & set(near_dedup.signature_keys(b)[0])


def test_pairs_of_one_key_need_no_more_agreement():
    """Two signatures that agree in 3 of 48 values only, but share a key, and whose sets may be equal."""
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 15, near_dedup.VALUES).astype(np.uint16)
    b = a + np.uint16(1 << 15)
    b[:3] = a[:3]  # the key of chunk 0 without its value 3
    assert set(near_dedup.signature_keys(a[None])[0]) & set(near_dedup.signature_keys(b[None])[0])
    buckets = np.ones(near_dedup.BUCKETS, np.uint16).tobytes()
    columns = {"key": [3 << 48] * 2, "i": [0] * 2, "j": [0] * 2, "side": [1] * 2, "component": [1, 2], "id": [1, 2], "n": [256] * 2,
               "most": [256] * 2, "signature": [a.tobytes(), b.tobytes()], "buckets": [buckets] * 2}
    found = [r for out in near_dedup._close_pairs(75)([pa.RecordBatch.from_pydict(columns)]) for r in out.to_pylist()]
    assert {(r["a"], r["b"]) for r in found} == {(1, 2)}


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = dict(components.connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {x: find(x) for x in root}


# decontamination

ITEMS = [(1, "jumps over the lazy dog and runs far away from the old"), (2, "un DEUX"), (3, None), (4, "  "),
         (5, "wörds ñönetheless"), (10, "jumps over the lazy dog and runs far away from the old"), (2, "un deux")]


def test_decontaminate_odd_rows(spark, odd_docs, clashing_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for docs in (odd_docs, clashing_docs):
        for how in ({}, {"block_bytes": 60}, {"shard_words": 5}):
            rows = decontaminate.find_phrases(docs, items, docs.columns, **how).collect()
            assert len(rows) == len(ROWS)
            for r in rows:
                n, hit, found = brute.phrase_hits(r.row.text, ITEMS)
                assert r.n_words == n and sorted(set(r["items"])) == found
                assert [k for s in r.spans for k in range(s.start, s.end)] == hit
        clean = decontaminate.clean_documents(docs, items)
        assert clean.columns == docs.columns
        assert clean.count() == sum(not brute.phrase_hits(t, ITEMS)[1] for _, t, *_ in ROWS)


def test_decontaminate_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.find_phrases(no_docs, items, ["doc_id"]).collect() == []
    for none in (items.where("false"), items.where("item_id = 4")):
        rows = decontaminate.find_phrases(odd_docs, none, ["doc_id", "text"]).collect()
        assert [r.n_words for r in rows] == [brute.phrase_hits(r.row.text, [])[0] for r in rows]
        assert all(not r.spans and not r["items"] for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=60), st.lists(st.lists(st.integers(1, 6), min_size=3, max_size=3), min_size=1, max_size=8))
def test_fm_index_finds_all(seq, phrases):
    index = decontaminate.FMIndex(np.array(seq), 7, sample=4)
    low, high = index.search(np.array(phrases))
    for p, a, b in zip(phrases, low, high):
        want = [k for k in range(len(seq) - 2) if seq[k:k + 3] == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


# language id

def test_language_id_odd_rows(odd_docs, no_docs, clashing_docs):
    for docs in (odd_docs, clashing_docs):
        rows = language_id.identify_documents(docs, ["doc_id", "text"]).collect()
        assert len(rows) == len(ROWS)
        for r in rows:
            letters = any(c.isalpha() for c in r.row.text or "")
            assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
        assert language_id.accepted_documents(docs).columns == docs.columns
    assert language_id.identify_documents(no_docs, ["doc_id"]).collect() == []


def test_nothing_learned_is_und(odd_docs):
    rows = language_id.identify(odd_docs, {}, ["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}


def test_sampled_learning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    profiles = language_id.learn_profiles(docs, per_language=20)
    rows = language_id.identify(docs, profiles, ["lang"]).collect()
    assert sum(r.row.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)


def test_ngrams_by_hand():
    grams, times = language_id.ngrams("Ab, ab")
    codes = dict(zip(grams.tolist(), times.tolist()))
    a, b, blank = ord("a"), ord("b"), 1
    assert codes[a] == 2 and codes[a << 21 | b] == 2 and codes[blank << 42 | a << 21 | b] == 2
    assert codes[b << 21 | blank] == 2 and len(codes) == 7


# language model

def test_lm_odd_rows(odd_docs, no_docs, clashing_docs):
    for docs in (odd_docs, clashing_docs):
        rows = maxent_lm.score_documents(docs).collect()
        assert len(rows) == len(ROWS)
        for r in rows:
            assert r.score < 0 and r.base_score < 0 and r.n_known <= r.n_tokens
        assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 6)} == {1}
    assert maxent_lm.score_documents(no_docs).collect() == []


def test_lm_without_training_rows(spark):
    import zlib
    only_held = [(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = maxent_lm.score_documents(spark.createDataFrame(only_held, "doc_id long, text string")).collect()
    assert len(rows) == len(only_held) and {(r.train_tokens, r.n_known, r.base_score) for r in rows} == {(0, 0, 0.0)}


def test_lm_is_a_distribution():
    """Class, symbol and word shares sum to one over the vocabulary and one unseen word a symbol."""
    rng = np.random.default_rng(2)
    words = np.unique(rng.integers(-1 << 62, 1 << 62, 3000))
    counts = np.sort(rng.integers(1, 90, len(words)))[::-1]
    tokens, types = np.zeros(maxent_lm.SYMBOLS, np.int64), np.zeros(maxent_lm.SYMBOLS, np.int64)
    symbol = np.where(np.arange(len(words)) < maxent_lm.EXACT, np.arange(len(words)), maxent_lm.hashed_symbol(words))
    np.add.at(tokens, symbol, counts)
    np.add.at(types, symbol, 1)
    vocabulary = maxent_lm.Vocabulary(words, counts, tokens, types)
    assert (vocabulary.look_up(words)[0] == symbol).all()
    of_class, of_member = maxent_lm.first_weights(tokens)
    of_class += rng.normal(size=of_class.shape).astype(np.float32)
    of_member += rng.normal(size=of_member.shape).astype(np.float32)
    every = np.arange(maxent_lm.SYMBOLS)
    history = np.full_like(every, 7), np.full_like(every, 11)
    p = 10 ** maxent_lm.log_probs(every, *history, of_class, of_member)
    assert p.sum() == pytest.approx(1, abs=1e-4)
    share = np.bincount(symbol, (counts + 0.5), minlength=maxent_lm.SYMBOLS) + 0.5
    assert np.allclose(share, tokens + 0.5 * (types + 1))


def test_lm_learns_word_order(spark):
    """Training on a fixed order of words beats the base by a tenth even with a few steps."""
    docs = spark.createDataFrame([(i, "red green blue yellow " * 20) for i in range(300)], "doc_id long, text string")
    rows = maxent_lm.score_documents(docs).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.9 * sum(r.base_score for r in rows)


def test_exact_dedup_hot_group(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    out = exact_dedup.exact_dedup(docs)
    assert out.where("kept").count() == 4001 and out.where("group_size = 2000 and keep_id = 5997").count() == 2000


def test_language_sample_holds_its_bound_and_copies_do_not_rule(spark):
    rnd = random.Random(5)
    rows = [("en", " ".join(rnd.choice(("the", "and", "of", "with", "that")) for _ in range(8)) + f" {chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(600)]
    rows += [("en", "zzqx zzqx zzqx zzqx zzqx zzqx zzqx zzqx")] * 400
    df = spark.createDataFrame(rows, "lang string, text string")
    assert 60 <= language_id.sampled_texts(df, 100).count() <= 150
    once = spark.createDataFrame(list(dict.fromkeys(rows)), df.schema)
    for per_language in (100, 4000):
        a, b = (language_id.learn_profiles(x, per_language=per_language)["en"] for x in (df, once))
        assert a.tolist() == b.tolist()
