"""Fill-in-the-middle: plain version, odd rows, very long texts."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from firn.llm import fill_in_middle as M
from odd import ROWS, clashing_docs, no_docs, odd_docs  # noqa: F401


def plain(doc_id, text):
    text = text or ""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(u), "plain", None, None, text
    a, b = sorted(x % (len(u) + 1) for x in h[:2])
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h[3] % 100 < 20:
        return doc_id, len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def check(frame, rows):
    made = M.fill_in_middle(frame)
    found = made.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output",
                        M.restore(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted((tuple(r)[:6] for r in found), key=repr) == sorted((plain(*x) for x in rows), key=repr)
    assert sorted(repr((r.doc_id, r.text)) for r in found) == sorted(repr((i, t or "")) for i, t in rows)
    return found


def test_random_texts(spark):
    rnd = random.Random(8)
    parts = ["word", "Zz", " ", "\n", "\r\n", "é", "\U0001F642", "<", "P>", "<P", "S>", "$1", "\\", "{3}", "7", "<M>", "\x00", " ", "<S>"]
    rows = [(k, "".join(rnd.choice(parts[:-1] if rnd.random() < 0.97 else parts) for _ in range(rnd.randrange(0, 25)))) for k in range(800)]
    found = check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    rows = [(r[0], r[1]) for r in ROWS]
    check(odd_docs, rows)
    check(clashing_docs.withColumns({n: F.lit("x") for n in ("row", "n", "form", "output", "first", "second")}), rows)
    assert M.fill_in_middle(no_docs).collect() == []


def test_very_long_texts(spark):
    rows = [(k, t) for k in (8, 9, 10) for t in ("ab " * 1_000_000, "\U0001F642" * 400_000, "w" * 3_000_000)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
