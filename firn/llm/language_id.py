"""Language identification by rank-order profiles.

A profile is the ``size`` most frequent letter n-grams (1 to 3, words padded by
one blank) of a language, in order of frequency.  A document's own most frequent
n-grams are compared with each profile: an n-gram costs the difference of its ranks, or
``size`` where the profile lacks it.  The language with the least total wins;
the score is one less the total over the largest possible.

Profiles are learned from labelled rows: for every language all its distinct texts, or where there are more
than ``per_language`` a sample of about that many by a hash of the text (whole texts).  This
bound is the only one; every document is judged on its whole text.

Scale: distinct texts are counted by a 64-bit hash, and copies of drawn texts are joined on the map side; learning
is one small grouped count; judging is a narrow pass with the
profiles (``size`` n-grams a language) in the tasks.

Defined cases: null text or a text without letters is ``und`` with score 0, as is
everything where nothing could be learned; ties go to the first language by
code point; rows with null lang or text teach nothing; repeated rows are judged alike.
Input columns travel in a struct, so their names can't clash.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firn.llm.common import fold

SIZE = 300  # n-grams in a profile
_BLANK = 1  # stands for what is not a letter; no letter has this code
_BITS = 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code of each code point that is a letter, else the blank."""
    table = np.full(0x110000, _BLANK, np.int64)
    for c in range(0x33480):
        if (x := chr(c)).isalpha():
            table[c] = ord(x.lower()[0])
    return table


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as packed code points, ascending, and how often each occurs."""
    codes = _letters()[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate(([_BLANK], codes, [_BLANK]))
    letter = codes != _BLANK
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # one blank between words
    codes, letter = codes[keep], letter[keep]
    two = (codes[:-1] << _BITS) | codes[1:]
    three = (two[:-1] << _BITS) | codes[2:]
    return np.unique(np.concatenate((codes[letter], two, three[letter[1:-1]])), return_counts=True)


def _count(batches):
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            parts = [ngrams(t) for x, t in zip(langs, texts) if x == lang]
            grams, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            times = np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(grams)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()),
                                              pa.array(times, pa.int64())], names=["lang", "gram", "times"])


def sampled_texts(rows: DataFrame, per_language: int) -> DataFrame:
    """Distinct texts of each language (columns lang and text), about ``per_language`` where there are more.
    A text is drawn by its hash and kept once, so copies change neither the draw nor a profile."""
    texts = rows.groupBy("lang").agg(F.count_distinct(F.xxhash64("text")).alias("n"))
    share = {r["lang"]: per_language / r["n"] for r in texts.collect() if r["n"] > per_language}
    if share:
        part = F.create_map(*[F.lit(x) for k in sorted(share) for x in (k, share[k])])
        at = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1_000_000
        rows = rows.where(at < F.coalesce(F.try_element_at(part, F.col("lang")), F.lit(1.0)))
    return rows.distinct()


def learn_profiles(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = SIZE,
                   per_language: int = 4000) -> dict[str, np.ndarray]:
    """Each language's n-grams by falling frequency."""
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    rows = sampled_texts(rows, per_language)
    counts = rows.mapInArrow(_count, "lang string, gram long, times long").groupBy("lang", "gram").agg(F.sum("times").alias("times"))
    by_times = Window.partitionBy("lang").orderBy(F.desc("times"), "gram")
    top = counts.withColumn("rank", F.row_number().over(by_times)).where(F.col("rank") <= size)
    profiles: dict[str, list] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v, np.int64) for k, v in profiles.items()}


class Judge:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int = SIZE):
        self.langs, self.size = sorted(profiles), size
        self.grams = np.unique(np.concatenate([profiles[k] for k in self.langs])) if profiles else np.empty(0, np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)  # the last row: in no profile
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.grams, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        grams, times = ngrams(text)
        if not len(grams) or not self.langs:
            return "und", 0.0
        top = grams[np.argsort(-times, kind="stable")[:self.size]]
        at = np.searchsorted(self.grams, top)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != top)] = len(self.grams)
        ranks = self.ranks[at]
        cost = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(top), dtype=np.int32)[:, None])).sum(axis=0)
        best = int(cost.argmin())
        return self.langs[best], float(1 - cost[best] / (self.size * len(top)))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], keep: list[str], text_col: str = "text",
             size: int = SIZE) -> DataFrame:
    """``row`` (a struct of the columns in ``keep``), lang_pred and score of every row."""
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches):
        judge = Judge(profiles, size)
        for batch in batches:
            found = []
            for a in range(0, batch.num_rows, 512):
                found += map(judge, batch.column(1).slice(a, 512).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()),
                                              pa.array([x[1] for x in found], pa.float64())], names=schema.names)
    return rows.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 0


def identify_documents(docs: DataFrame, keep: list[str], id_col: str = "doc_id", **how) -> DataFrame:
    """Profiles learned from the labelled rows that aren't held out, applied to all rows."""
    return identify(docs, learn_profiles(docs.where(~held_out(F.col(id_col))), **how), keep)


def accepted_documents(docs: DataFrame, least: float = 0.2, **how) -> DataFrame:
    """The rows, all columns unchanged, whose text is in a learned language: not
    ``und``, and not further than ``least`` allows from every profile."""
    found = identify_documents(docs, docs.columns, **how).where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
