"""Spelling variants by a variable-length gram index.

``count_words`` counts the words of all texts.  ``near_pairs`` finds all pairs of words at edit distance 1:

1. Gram dictionary, pruned by frequency: grams of 3 to ``longest`` code points of ``^word$`` are counted over all words; a
   gram is extended by its next code point only if it is frequent (in more than ``frequent`` places).
2. Decomposition: at every place a word has the shortest gram that is not frequent (or is longest, or ends the word).  Whether
   a gram is extended depends on its own code points only, so an edit changes no gram outside of it.
3. Affected-gram bound: for each word the most grams that one edit can touch.  Two near words share all but so many
   of their grams, at the same distance from the start (before the edit) or from the end (behind it).
4. List merging: with all grams in one order, rarest first, the first shared gram is among the first bound + 1 of both
   words.  Only these lists are merged, by one join on (gram, side, place); the long lists behind them are never read.
5. The pairs of the merged lists are verified: sizes and hashes of quarters first (an edit leaves three alone), then the edit distance.

With 3 <= gram length <= least word length - 1, a word of least length has more grams than its bound, so
no word needs another way.  ``group_variants`` then takes for each word its near word of most occurrences as form, if that has
``ratio`` times as many, and follows forms to the root by pointer jumping.

Scale: words are counted on the map side first.  The driver sees the frequent grams, at most ``dictionary`` of them: ``frequent``
is at least the number of all grams over ``dictionary``, so no more can exceed it.  Merged lists are an equi-join
that the planner can split where a list is long.

Defined cases: null and empty texts have no words; very long texts are used whole; repeated rows count again; a null id counts
as empty text; of near words with equal counts the first in code-point order is the form; words of fewer than ``least``
code points are left out; empty input gives no rows; extra columns of ``docs``, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.llm.common import shuffle_partitions, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"[A-Za-zÀ-ÿ]"
SHORTEST = 3  # gram
START, END = "^", "$"


def misspelt(doc_id: Column, run: Column, every: int) -> Column:
    """``run``, or if ``every`` divides the crc32 of ``id:run``, ``run`` without one code point that the crc32 names."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, times: int = 2,
                misspell: int | None = None) -> DataFrame:
    """``(word, n)``: lower-cased letter runs of at least ``least`` code points that occur ``times`` times or more.
    With ``misspell`` every so many runs lose a code point before they are counted."""
    runs = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(runs).alias("run")).withColumn("run", F.translate("run", UPPER, LOWER))
    word = misspelt(F.col("id"), F.col("run"), misspell) if misspell else F.col("run")
    return (rows.select(word.alias("word")).where(F.length("word") >= least)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times))


# gram index

def grams(word: Column, longest: int) -> Column:
    """All grams of ``^word$`` of SHORTEST to ``longest`` code points, one at a place for each length."""
    whole = F.concat(F.lit(START), word, F.lit(END))
    return F.flatten(F.transform(F.sequence(F.lit(SHORTEST), F.lit(longest)), lambda q: F.transform(
        F.sequence(F.lit(1), F.length(whole) - q + 1), lambda p: F.substr(whole, p, q))))


def decompose(word: str, frequent: dict[str, int], longest: int) -> list[tuple[int, str]]:
    """(place, gram) at every place of ``^word$`` that has room for the shortest gram."""
    whole = START + word + END
    out = []
    for p in range(len(whole) - SHORTEST + 1):
        q = SHORTEST
        while q < longest and p + q < len(whole) and whole[p:p + q] in frequent:
            q += 1
        out.append((p, whole[p:p + q]))
    return out


def affected(parts: list[tuple[int, str]]) -> int:
    """The most grams that touch one place."""
    touched = Counter(k for p, g in parts for k in range(p, p + len(g)))
    return max(touched.values())


def lists_to_merge(word: str, frequent: dict[str, int], longest: int) -> list[tuple[int, str]]:
    """The rarest grams of a word, one more than an edit can affect."""
    parts = decompose(word, frequent, longest)
    return sorted(parts, key=lambda x: (frequent.get(x[1], 0), x[1], x[0]))[:affected(parts) + 1]


def quarters(word: str) -> int:
    """6-bit hashes of a word's quarters (bits 0 to 23), and of its quarters as the longer of two words: the first three where the
    shorter has them (bits 24 to 41), the last three one place on (42 to 59).

    An edit is in one quarter of the shorter word.  The others are the same: at the same places, or, behind an
    inserted code point, one place on."""
    n = len(word)
    own, cut = [n * k // 4 for k in range(5)], [(n - 1) * k // 4 for k in range(5)]
    parts = ([word[own[k]:own[k + 1]] for k in range(4)] + [word[cut[k]:cut[k + 1]] for k in range(3)]
             + [word[cut[k] + 1:cut[k + 1] + 1] for k in range(1, 4)])
    return sum((crc32(p.encode()) & 63) << (6 * k) for k, p in enumerate(parts))


def _list(gram: str, side: int, place: int) -> int:
    """64-bit hash that names a list; its last bit is the side."""
    return (xxhash.xxh3_64_intdigest(f"{place} {gram}") >> 1 << 1 | side) - (1 << 63)


def _lists(frequent, longest: int):
    def entries(frames):
        for f in frames:
            rows = []
            for word, n in zip(f["word"], f["n"]):
                size, sig = len(word), quarters(word)
                for p, g in lists_to_merge(word, frequent.value, longest):
                    rows.append((_list(g, 0, p), word, size, n, sig))
                    rows.append((_list(g, 1, size - p), word, size, n, sig))
            yield pd.DataFrame(rows, columns=["list", "word", "size", "n", "sig"])
    return entries


# Words of equal size come by the lists from the start alone.  All quarters but one agree, whichever it is.
SAME = "a.size = b.size AND a.list & 1 = 0 AND a.word < b.word AND ({})".format(
    " OR ".join(f"(a.sig ^ b.sig) & {(1 << 24) - 1 - (63 << 6 * k)} = 0" for k in range(4)))
LONGER = "a.size + 1 = b.size AND ({})".format(" OR ".join(
    f"((a.sig ^ shiftright(b.sig, 24)) & {(1 << 6 * k) - 1} = 0 AND (shiftright(a.sig, 6) ^ shiftright(b.sig, 42)) & {(1 << 18) - (1 << 6 * k)} = 0)"
    for k in range(4)))


def near_pairs(words: DataFrame, least: int = 7, frequent: int = 64, dictionary: int = 1 << 18) -> DataFrame:
    """``(word, n, near, near_n)``: every pair of words at edit distance 1, once; ``words`` has ``word`` and ``n``,
    distinct words of ``least`` code points or more."""
    longest = least - 1
    spark = words.sparkSession
    words = stored(words.select("word", "n").repartition(shuffle_partitions(spark), "word"), "spelling-words")
    found = words.agg(F.sum((F.length("word") + 2) * (longest - SHORTEST + 1))).first()[0] or 0
    frequent = max(frequent, -(-found // dictionary))
    counted = (words.select(F.explode(grams(F.col("word"), longest)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
               .where(F.col("n") > frequent))
    index = spark.sparkContext.broadcast({r.gram: r.n for r in counted.collect()})  # at most ``dictionary`` grams
    lists = stored(words.mapInPandas(_lists(index, longest), "list long, word string, size int, n long, sig long"), "spelling-lists")
    index.destroy()
    # the case keeps the dear test behind the cheap ones; as a filter it would be moved before them
    near = f"CASE WHEN ({SAME}) OR ({LONGER}) THEN levenshtein(a.word, b.word, 1) = 1 ELSE false END"
    merged = lists.alias("a").join(lists.alias("b"), F.expr(f"a.list = b.list AND {near}"))
    return (merged
            .select("a.word", "a.n", F.col("b.word").alias("near"), F.col("b.n").alias("near_n")).distinct())


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)`` by pointer jumping; forms lead to ever more frequent words, so there is no circle."""
    state = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = stored(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not state.where("moved").head(1):
            return state.select("word", "root")
        state = state.drop("moved")


def group_variants(words: DataFrame, least: int = 7, ratio: int = 10, **how) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row a word."""
    words = stored(words.select("word", "n"), "spelling-counts")
    pairs = stored(near_pairs(words, least, **how), "spelling-pairs")
    both = pairs.union(pairs.select("near", "near_n", "word", "n"))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    best = stored(best.select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")),
                  "spelling-forms")
    roots = follow(best.where("form IS NOT NULL"))
    return (words.join(best, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
