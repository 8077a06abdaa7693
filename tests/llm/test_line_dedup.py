"""Line dedup: plain version, reversible deletions, cuckoo filters, odd rows."""

import random
from collections import defaultdict

import numpy as np
import pytest

import brute
from firn.llm import line_dedup as L
from odd import ROWS, clashing_docs, no_docs, odd_docs  # noqa: F401


def plain(docs, min_docs=3, min_chars=20):
    """[(id, n_lines, n_dropped, kept text)] from (id, text) rows, sorted."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(brute.TO_LOWER)
    holders = defaultdict(set)
    for r, (_, text) in enumerate(docs):
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(r)
    out = []
    for i, text in docs:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            rows = holders.get(key(line), ())
            ids = [docs[r][0] for r in rows if docs[r][0] is not None]
            if len(rows) < min_docs or i == max(ids, default=None):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.row.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in frame.collect()), key=repr)


def corpus(n=300, seed=3):
    rnd = random.Random(seed)
    pool = [f"This line number {k} is shared by documents é\U0001F642" for k in range(40)]
    out = []
    for i in range(n):
        lines = [rnd.choice(pool) if rnd.random() < 0.3 else f"own text {rnd.random()} of a line that is long" for _ in range(rnd.randrange(0, 12))]
        lines = [rnd.choice(["", " ", "\t\x0b", "\x0c\r"]) + (x.upper() if rnd.random() < 0.2 else x) + rnd.choice(["", " ", "\r"]) for x in lines]
        out.append((i, "\n".join(lines)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_inserts_and_deletions_match_plain_version(spark):
    rows = corpus()
    index = L.LineIndex(spark, shards=5, block_bytes=64)
    assert index.insert(frame(spark, rows[:150])) == 1
    assert got(index.strip(frame(spark, rows[:150]))) == plain(rows[:150])
    index.insert(frame(spark, rows[150:]))
    assert got(index.strip(frame(spark, rows))) == plain(rows)
    before = sorted(index.refs().collect())
    more = [(1000 + i, t) for i, t in corpus(200, 9)]
    index.insert(frame(spark, more))
    assert got(index.strip(frame(spark, rows + more))) == plain(rows + more)
    index.delete(frame(spark, more).select("doc_id"))
    assert sorted(index.refs().collect()) == before  # reversed exactly
    assert got(index.strip(frame(spark, rows))) == plain(rows)
    keep = [r for r in rows if r[0] % 3]
    index.delete(spark.createDataFrame([(r[0],) for r in rows if r[0] % 3 == 0] + [(99999,)], "doc_id long"))
    assert got(index.strip(frame(spark, keep))) == plain(keep)
    index.insert(frame(spark, [r for r in rows if r[0] % 3 == 0]))  # and back again
    assert got(index.strip(frame(spark, rows))) == plain(rows)


def test_filters_hold_the_repeated_keys_and_few_others(spark):
    rows = corpus()
    index = L.LineIndex(spark, shards=3)
    index.insert(frame(spark, rows))
    repeated = {(r.h1, r.h2) for r in index.refs().where("n_docs >= 3").collect()}
    held = sum(r.n_keys for r in index.store.read("filters").collect())
    found = {(r.h1, r.h2) for r in index.suspects(frame(spark, rows)).collect()}
    assert held == len(repeated) and repeated <= found and len(found) <= len(repeated) + 2


def test_a_failed_operation_leaves_the_index_as_it_was(spark, monkeypatch):
    rows = corpus(60)
    index = L.LineIndex(spark, shards=3)
    index.insert(frame(spark, rows[:40]))
    with monkeypatch.context() as m:
        m.setattr(index.store, "commit", lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.insert(frame(spark, rows[40:]))
    again = L.LineIndex(spark, index.store.path, shards=3)
    assert got(again.strip(frame(spark, rows[:40]))) == plain(rows[:40])
    again.insert(frame(spark, rows[40:]))
    assert got(again.strip(frame(spark, rows))) == plain(rows)


def test_cuckoo_filter():
    rng = np.random.default_rng(5)
    h1, h2 = (rng.integers(-2**63, 2**63, 20_000, dtype=np.int64) for _ in range(2))
    table = L.cuckoo_build(h1[:15_000], h2[:15_000])

    def contains(t, a, b):
        fp, x, y = L.places(a, b, len(t))
        return (t[x] == fp[:, None]).any(1) | (t[y] == fp[:, None]).any(1)
    assert contains(table, h1[:15_000], h2[:15_000]).all() and contains(table, h1[15_000:], h2[15_000:]).mean() < 0.01
    L.cuckoo_delete(table, h1[:7_000], h2[:7_000])
    assert contains(table, h1[7_000:15_000], h2[7_000:15_000]).all() and contains(table, h1[:7_000], h2[:7_000]).mean() < 0.01
    assert L.cuckoo_insert(table, h1[15_000:], h2[15_000:]) and (table != 0).sum() == 13_000
    full = np.zeros((4, 4), np.uint16)
    assert not L.cuckoo_insert(full, h1[:17], h2[:17])


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    more = spark.createDataFrame([(None, "a line that three rows hold\nx"), (None, "A line that three rows hold "), (None, "a line that three rows hold")],
                                 "doc_id long, text string")
    rows = [(r[0], r[1]) for r in ROWS]
    for docs in (odd_docs, clashing_docs):
        index = L.LineIndex(spark)
        index.insert(docs)
        assert got(index.strip(docs)) == plain(rows)
        assert index.strip(docs).schema["row"].dataType.names == docs.columns
    index = L.LineIndex(spark)
    index.insert(more)
    assert all(r.n_dropped == 0 for r in index.strip(more).collect())
    index.insert(frame(spark, [(5, "a line that three rows hold")]))
    assert sorted(r.n_dropped for r in index.strip(more).collect()) == [1, 1, 1]
    index = L.LineIndex(spark)
    index.insert(no_docs)
    assert index.strip(no_docs).collect() == []


def test_long_text_and_repeated_rows(spark):
    long = "\n".join(f"a line of the very long text {k % 5000}" for k in range(60_000))
    rows = [(1, long), (2, long.upper()), (3, "x\n" + long), (3, "x\n" + long), (4, "a line of the very long text 7")]
    index = L.LineIndex(spark)
    index.insert(frame(spark, rows))
    assert got(index.strip(frame(spark, rows))) == plain(rows)
