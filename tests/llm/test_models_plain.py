"""Language id and language model against plain versions, item by item."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import brute
from firn.llm import language_id as LI
from firn.llm import maxent_lm as M


# language identification, by dictionaries of ranks

def plain_ngrams(text):
    """n-grams of one to three characters: words padded by one blank, letters lower-cased."""
    words = "".join(c.lower()[0] if c.isalpha() else " " for c in text).split()
    if not words:
        return Counter()
    line = " " + " ".join(words) + " "
    grams = Counter(c for c in line if c != " ")
    grams.update(line[k:k + 2] for k in range(len(line) - 1))
    grams.update(line[k:k + 3] for k in range(len(line) - 2) if line[k + 1] != " ")
    return grams


def packed(gram):
    n = 0
    for c in gram:
        n = n << 21 | (1 if c == " " else ord(c))
    return n


def ranked(grams, size):
    return [g for g, _ in sorted(grams.items(), key=lambda x: (-x[1], packed(x[0])))][:size]


def plain_judge(text, profiles, size):
    top = ranked(plain_ngrams(text or ""), size)
    if not top:
        return "und", 0.0
    costs = {}
    for lang, profile in profiles.items():
        place = {g: k for k, g in enumerate(profile)}
        costs[lang] = sum(abs(place[g] - k) if g in place else size for k, g in enumerate(top))
    best = min(sorted(costs), key=lambda x: costs[x])
    return best, 1 - costs[best] / (size * len(top))


@pytest.mark.parametrize("size", [300, 12])
def test_out_of_place_distance(spark, size):
    rnd = random.Random(3)
    letters = {"en": "etaoinshr dlu", "fr": "eéèasitnr ulo", "de": "enisrat dhuäß", "es": "eaosrnidñ lct"}

    def text(lang, n):
        return "".join(rnd.choice(letters[lang] + " .") for _ in range(n))
    rows = [(lang, text(lang, 400)) for lang in letters for _ in range(20)]
    learned = LI.learn_profiles(spark.createDataFrame(rows + rows[:7], "lang string, text string"), size=size)
    profiles = {}
    for lang in letters:
        grams = Counter()
        for t in {t for x, t in rows if x == lang}:
            grams.update(plain_ngrams(t))
        profiles[lang] = ranked(grams, size)
        assert [packed(g) for g in profiles[lang]] == learned[lang].tolist()
    judge = LI.Judge(learned, size)
    tests = [text(rnd.choice(list(letters)), n) for n in (1, 2, 5, 30, 200, 3000) for _ in range(30)] + ["", None, "12 !", "a", "É", "aa aa aa", "漢字 テスト"]
    for t in tests:
        lang, score = judge(t)
        want = plain_judge(t, profiles, size)
        assert (lang, pytest.approx(score, abs=1e-12)) == want, t


# language model, by one sum over features for each token

def plain_log_prob(symbol, last, skip, of_class, of_member):
    c, m = divmod(symbol, M.MEMBERS)
    z = of_class[0] + of_class[1 + last] + of_class[1 + M.SYMBOLS + skip] + of_class[1 + 2 * M.SYMBOLS + (last * 40503 + skip * 30011) % M.PAIRS]
    y = (of_member[c] + of_member[M.CLASSES + (last * 31337 + c * 7919) % M.MEMBER_LAST]
         + of_member[M.CLASSES + M.MEMBER_LAST + (skip * 28657 + c * 6007) % M.MEMBER_SKIP])
    return (z[c] - math.log(sum(math.exp(x) for x in z.tolist())) + y[m] - math.log(sum(math.exp(x) for x in y.tolist()))) / math.log(10)


def test_model_score_token_by_token(spark):
    """Random weights; the score of a text is the sum over its tokens, each with the two before it."""
    rng, rnd = np.random.default_rng(4), random.Random(4)
    words = [f"w{k}" for k in range(2500)]
    counts = Counter({w: 3000 - k for k, w in enumerate(words)})
    hashes = M._WordHashes()
    h = np.array([hashes[w.encode()] for w in words], np.uint64).view(np.int64)
    order = np.lexsort((h, -np.array([counts[w] for w in words])))
    tokens, types = rng.integers(1, 500, M.SYMBOLS), rng.integers(1, 9, M.SYMBOLS)
    vocabulary = M.Vocabulary(h[order], np.array([counts[words[k]] for k in order]), tokens, types)
    of_class = rng.normal(0, 1, (M.CLASS_ROWS, M.CLASSES)).astype(np.float32)
    of_member = rng.normal(0, 1, (M.MEMBER_ROWS, M.MEMBERS)).astype(np.float32)
    texts = [" ".join(rnd.choice(words + ["unseen"]) for _ in range(n)) for n in (0, 1, 2, 40)]
    rank = {words[k]: r for r, k in enumerate(order)}

    def symbol(w):
        x = int(np.uint64(hashes[w.encode()]).view(np.int64))
        return rank[w] if rank.get(w, M.EXACT) < M.EXACT else M.EXACT + x % M.MEMBERS
    spark_rows = spark.createDataFrame([(k, False, t) for k, t in enumerate(texts)], "doc_id long, held_out boolean, text string").coalesce(1)
    got = {r.doc_id: r.model for r in spark_rows.mapInArrow(M._score(vocabulary, of_class, of_member), M._SCORED.format("bigint")).collect()}
    end = symbol(M.END.decode())
    for k, t in enumerate(texts):
        total, last, skip = 0.0, end, end
        for s in [symbol(w) for w in brute.words(t)] + [end]:
            total += plain_log_prob(s, last, skip, of_class, of_member) - math.log10(tokens[s] + 0.5 * (types[s] + 1))
            last, skip = s, last
        assert got[k] == pytest.approx(total, rel=1e-4)


@pytest.mark.parametrize("n,most", [(70_000, 1 << 16), (50, 60), (50, 50), (50, 7), (0, 5)])
def test_head_words_are_the_first_whatever_the_steps(spark, n, most):
    """Also where one count step holds more words than fit."""
    rows = spark.range(n).selectExpr("xxhash64(id) AS word", "CASE WHEN id % 10 = 0 THEN 40 + id % 7 ELSE 3 END AS times")
    words, times = M.head_words(rows, most)
    want = sorted(((-r.times, r.word) for r in rows.collect()))[:most]
    assert list(zip((-times).tolist(), words.tolist())) == want


def hash_of(word):
    return int(np.uint64(M._WordHashes()[word]).view(np.int64))


def plain_tokens(text):
    return [hash_of(w) for w in [*(w.encode() for w in brute.words(text or "")), M.END]]


ODD_TEXTS = ["", None, "  ", " A b\tc\x0bd\x0ce\rf\ng ", "É À ÀÉ x ÉX", "a\x00b \x1c \x1d\x1e\x1f c", "\x85 z\x7f z", "zz " * 40, "one", "\n", "ZZ one"]


def test_words_of_a_piece():
    for texts in (ODD_TEXTS, [""], ["a b"], [" a"], ODD_TEXTS[::-1]):
        hashes, tokens, lengths = M.split_words(pa.array(texts, pa.string()))
        assert len(set(hashes.tolist())) == len(hashes)
        assert [x.tolist() for x in np.split(hashes[tokens], lengths.cumsum()[:-1])] == [plain_tokens(t) for t in texts]


@pytest.mark.parametrize("rows,most", [(1, 1 << 22), (4, 1 << 22), (100, 1 << 22), (100, 1), (100, 20)])
def test_documents_are_whole_whatever_the_batches(rows, most, monkeypatch):
    """A training run of documents ends with the one that fills it; batches and pieces decide nothing."""
    monkeypatch.setattr(M._pieces, "__defaults__", (most,))
    texts = [t for k in range(9) for t in ODD_TEXTS + [f"w{k} " * (7 * k)]]
    words = np.unique([h for t in texts for h in plain_tokens(t)])[::2]
    vocabulary = M.Vocabulary(words, np.arange(len(words), 0, -1), np.ones(M.SYMBOLS), np.ones(M.SYMBOLS))
    places = {h: k for k, h in enumerate(np.sort(words).tolist())}
    want, held = [], []
    for t in texts:
        held.append([places.get(h, len(words) + h % M.MEMBERS) for h in plain_tokens(t)])
        if sum(map(len, held)) >= 50:
            want, held = [*want, held], []
    batches = [pa.record_batch([pa.array(texts[a:a + rows], pa.string())], names=["text"]) for a in range(0, len(texts), rows)]
    got = [[x.tolist() for x in np.split(codes, lengths.cumsum()[:-1])] for codes, lengths in M._whole_documents(batches, vocabulary, 50)]
    assert got == want + ([held] if held else [])
    counted = Counter()
    for b in M._count_tokens(batches, 60):
        counted.update(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
    assert counted == Counter(h for t in texts for h in plain_tokens(t))


class Counted(np.ndarray):
    rows = 0

    def take(self, rows, axis=None, **more):
        Counted.rows += len(rows)
        return np.asarray(self).take(rows, axis=axis, **more)


def test_a_history_sums_its_classes_once():
    """Few histories with many next words: three rows of class weights a history, three of member weights a (history, class)."""
    rng = np.random.default_rng(6)
    symbols, last, skip = rng.integers(0, M.SYMBOLS, 6000), rng.integers(0, 5, 6000), rng.integers(0, 4, 6000)
    of_class = rng.normal(0, 1, (M.CLASS_ROWS, M.CLASSES)).astype(np.float32)
    of_member = rng.normal(0, 1, (M.MEMBER_ROWS, M.MEMBERS)).astype(np.float32)
    Counted.rows = 0
    got = M.log_probs(symbols, last, skip, of_class.view(Counted), of_member)
    assert Counted.rows <= 3 * 20
    Counted.rows = 0
    assert (M.log_probs(symbols, last, skip, of_class, of_member.view(Counted)) == got).all()
    assert Counted.rows <= 3 * 20 * M.CLASSES
    for k in range(0, 6000, 200):
        assert got[k] == pytest.approx(plain_log_prob(symbols[k], last[k], skip[k], of_class, of_member), rel=1e-5)
    assert len(M.log_probs(symbols[:0], last[:0], skip[:0], of_class, of_member)) == 0


def test_a_step_against_plain_sums():
    """One AdaGrad step, features seen once, a few times and often."""
    rng = np.random.default_rng(7)
    rows, features = 300, (slice(0, 1), rng.integers(1, 4, 999), rng.integers(4, 100, 999), 100 + rng.integers(0, 245, 999) ** 2 // 300)
    w = rng.normal(0, 1, (rows, M.CLASSES)).astype(np.float32)
    answer = rng.integers(0, M.CLASSES, 999)
    trainer = M.Trainer(w, w[:, :M.MEMBERS], 0.5)
    trainer._step(0, features, answer)
    z = w.astype(float)[0] + sum(w.astype(float)[f] for f in features[1:])
    error = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True) - np.eye(M.CLASSES)[answer]
    want, seen = w.astype(float), np.zeros(rows, int)
    times = Counter()
    for f in (np.zeros(999, int), *features[1:]):
        gradient = np.zeros((rows, M.CLASSES))
        np.add.at(gradient, f, error)
        squares = 1e-2 + (gradient ** 2).sum(axis=1) + np.where(seen > 0, np.nan, 0)  # no row is in two kinds of features
        hit = np.flatnonzero(np.bincount(f, minlength=rows))
        want[hit] -= 0.5 * gradient[hit] / np.sqrt(squares[hit, None])
        seen += np.bincount(f, minlength=rows)
        times.update(np.bincount(f)[hit].tolist())
    assert {1, 2, 3, 4} <= set(times) and max(times) == 999
    assert (trainer.seen[0] == seen).all() and np.allclose(trainer.weights[0], want, atol=1e-4)
