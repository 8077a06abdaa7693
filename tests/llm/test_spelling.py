"""Spelling variants: all pairs by brute force, forms and roots, odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import brute
from firn.llm import spelling as S
from odd import ROWS, clashing_docs, no_docs, odd_docs  # noqa: F401


def plain_counts(docs, least=7, times=2, misspell=None):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.TO_LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if misspell and h % misspell == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= times}


def plain_pairs(words):
    """All pairs at edit distance 1, by the words with one code point cut out."""
    cut, known, out = defaultdict(set), set(words), set()
    for w in words:
        for k in range(len(w)):
            cut[k, w[:k] + w[k + 1:]].add(w)
            if w[:k] + w[k + 1:] in known:
                out.add((w[:k] + w[k + 1:], w))
    for same in cut.values():
        out |= {(a, b) for a in same for b in same if a < b}
    return out


def plain_variants(words, ratio=10):
    near = defaultdict(set)
    for a, b in plain_pairs(words):
        near[a].add(b)
        near[b].add(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out)


def vocabulary(n, seed, least=7):
    rnd, out = random.Random(seed), {}
    parts = ["tion", "ing", "er", "a", "b", "é", "un", "re", "st", "ß", "abc", "aaa"]
    stems = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(2, 6))) for _ in range(n // 5)]
    while len(out) < n:
        w = rnd.choice(stems)
        for _ in range(rnd.randrange(3)):
            k = rnd.randrange(len(w) + 1)
            w = w[:k] + rnd.choice(["", "x", "a", "é"]) + w[k + rnd.randrange(2):]
        if len(w) >= least:
            out[w] = int(10 ** rnd.uniform(0.3, 4))
    return out


@pytest.mark.parametrize("least,frequent,dictionary", [(7, 64, 1 << 18), (7, 1, 1 << 18), (7, 2, 500), (9, 5, 1 << 18), (5, 3, 1 << 18)])
def test_all_pairs_are_found(spark, least, frequent, dictionary):
    words = vocabulary(2500, least, least)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [{r.word, r.near} for r in S.near_pairs(frame, least, frequent, dictionary).collect()]
    want = [set(p) for p in plain_pairs(words)]
    assert len(got) == len(want) > 500 and all(p in want for p in got)


def test_lists_to_merge_share_a_gram_for_near_words():
    rnd = random.Random(2)
    frequent = {g: rnd.randrange(1, 9) for w in vocabulary(300, 1) for k in range(3, 6) for g in [("^" + w + "$")[j:j + k] for j in range(len(w))] if rnd.random() < 0.6}
    frequent = {g: n for g, n in frequent.items() if all(g[:k] in frequent for k in range(3, len(g)))}
    for a, b in plain_pairs(vocabulary(3000, 4)):
        x, y = S.lists_to_merge(a, frequent, 6), S.lists_to_merge(b, frequent, 6)
        shared = {(g, p) for p, g in x} & {(g, p) for p, g in y} | ({(g, len(a) - p) for p, g in x} & {(g, len(b) - p) for p, g in y})
        assert shared and len(x) <= S.affected(S.decompose(a, frequent, 6)) + 1 <= len(S.decompose(a, frequent, 6))


def test_quarters_agree_for_near_words(spark):
    pairs = sorted(tuple(sorted(p, key=lambda w: (len(w), w))) for p in plain_pairs(vocabulary(3000, 6)))
    rows = [((2, len(a), a, S.quarters(a)), (len(b), b, S.quarters(b))) for a, b in pairs]
    ab = spark.createDataFrame(rows, "a struct<list:long,size:int,word:string,sig:long>, b struct<size:int,word:string,sig:long>")
    assert ab.where(F.expr(f"({S.SAME}) OR ({S.LONGER})")).count() == len(rows) > 500


def test_forms_and_roots(spark):
    words = vocabulary(1500, 11) | {"international": 3000, "internationa": 200, "internationaal": 300, "nternationa": 20, "nternationaz": 2}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sorted((tuple(r) for r in S.group_variants(frame).collect()))
    assert got == plain_variants(words)
    roots = {r[0]: r[2] for r in got}
    assert roots["nternationaz"] == roots["nternationa"] == "international"


@pytest.mark.parametrize("misspell", [None, 3])
def test_counts(spark, odd_docs, clashing_docs, no_docs, misspell):
    more = [(k, "Ärger Straße überall×über÷zehn naïve-coöperation İstanbul kelvinK" * 2) for k in range(20)] + [(None, "whatever whatever whatever")]
    docs = spark.createDataFrame(more, "doc_id long, text string")
    assert {r.word: r.n for r in S.count_words(docs, misspell=misspell).collect()} == plain_counts(more, misspell=misspell)
    rows = [(r[0], r[1]) for r in ROWS]
    for frame in (odd_docs, clashing_docs.withColumns({n: F.lit("x") for n in ("word", "n", "run", "near")})):
        assert {r.word: r.n for r in S.count_words(frame, misspell=misspell).collect()} == plain_counts(rows, misspell=misspell)
    assert S.group_variants(S.count_words(no_docs)).collect() == []
    assert S.group_variants(S.count_words(odd_docs)).count() == len(plain_counts(rows))
