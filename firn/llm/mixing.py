"""Mixing sources to target weights by capped water-filling (DataFrame only).

Every source has a weight and a cap of ``max_epochs`` times its size.  The
budget is shared by weight; sources above their cap are clamped to it and
the excess goes to the others by weight, until none is above.  With sources
ordered by cap / weight this is one pass of prefix sums: the clamped sources
are those whose cap / weight is at most the level that the rest would get.

A source's target is then taken as whole repetitions of all its documents
plus a fraction, whole documents only.  Documents of over 1/256 of their source
(fewer than 256 a source) are decided first, largest octave first, each taken once more
if that brings the words nearer to the fraction's share.  The others follow in a seeded
order (md5 of seed and id) until the words left are used up; the last of them comes once
more if at least half of it fits.  So a source misses its target by at most half of a document of
1/256 of its size, or, if all its documents are larger, by half of one of the smallest octave.

Scale: the order is cut in two steps, so no task sees a whole source: sums
per (source, first digits of the hash; as many as the rows need) give the words before
each cell, and a window runs inside a cell only.  The table of sources alone is ranked in
one task; it has one row per source.  Rows carry ids and sizes, never texts.

Defined cases: null text has size 0 and is taken 0 times; a null source is a
source of its own, last in order; very long texts are counted whole; rows of equal id,
source and size are taken alike, as one document of their words together; empty input gives no
rows; if the caps together are below the budget, every source is taken to its cap.  Other
columns of ``docs``, whatever their names, come through ``mixed_documents`` unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firn.llm.common import shuffle_partitions, stored, word_count

ROWS_PER_CELL = 4096  # aimed at, of a source that has all rows
LARGE = 256  # documents of more than this part of their source are large


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   max_epochs: int = 2) -> DataFrame:
    """``(source, source_size, target)`` from rows with ``source`` and ``size``."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    src = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("rank", F.row_number().over(ordered) - 1).withColumn("weight", pick.cast("double"))
           .withColumn("cap", F.col("source_size").cast("double") * max_epochs))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, every = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    src = (src.withColumn("clamped_caps", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("clamped_weights", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("budget", F.sum("source_size").over(every).cast("double") * share)
           .withColumn("level", (F.col("budget") - F.col("clamped_caps"))
                       / (F.sum("weight").over(every) - F.col("clamped_weights")))
           .withColumn("clamped", F.col("cap") / F.col("weight") <= F.col("level")))
    # the level that holds is that of the first source in order that is not clamped
    src = src.withColumn("held", F.min(F.when(~F.col("clamped"), F.struct("clamped_weights", "level"))).over(every))
    return src.select("source", "source_size",
                      F.when(F.col("clamped"), F.col("cap")).otherwise(F.col("held.level") * F.col("weight"))
                      .alias("target"))


def repetitions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_epochs: int = 2,
                seed: str = "mix") -> DataFrame:
    """``(doc_id, source, size, n, source_size, target, times)``: how often the mix takes each document.  Rows of
    equal id, source and size are alike: one row here with their number ``n``, each of them taken ``times`` times."""
    sized = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               word_count(F.col(text_col)).alias("size"))
                   .groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
                   .withColumn("order", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(
                       F.col("doc_id").cast("string"), F.lit("")))))
                   .withColumn("words", F.col("size") * F.col("n")), "mix-sizes")
    src = source_targets(sized.select("source", F.col("words").alias("size")), weights, share, max_epochs)
    goal = F.floor(F.col("target") + 0.5)
    src = stored(src.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0))
                 .withColumn("extra", goal - F.col("whole") * F.col("source_size")), "mix-sources")
    # cells enough to keep a window short, and to deal one source to every task
    cells = max(sized.count() / ROWS_PER_CELL, 4 * shuffle_partitions(docs.sparkSession))
    digits = max(1, math.ceil(math.log(cells, 16)))
    rows = (sized.alias("d").join(src.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
            .select("d.*", *[F.col(f"s.{c}") for c in ("source_size", "target", "whole", "extra")])
            .withColumn("cell", F.substring("order", 1, digits))
            .withColumn("large", F.col("words") * LARGE > F.col("source_size")))
    large = _large_documents(rows.where("large"))
    spent = large.groupBy("source").agg(F.sum(F.col("words") * F.col("more")).alias("spent"))
    cells = rows.where("not large").groupBy("source", "cell").agg(F.sum("words").alias("cell_words"))
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("cell_before", F.coalesce(F.sum("cell_words").over(upto), F.lit(0)))
    cells = cells.alias("c").join(spent.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")), "left").select(
        "c.source", "c.cell", (F.col("cell_before") + F.coalesce("spent", F.lit(0))).alias("before"))
    small = (rows.where("not large").alias("d")
             .join(cells.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.cell") == F.col("c.cell")))
             .select("d.*", "c.before"))
    inside = (Window.partitionBy("source", "cell").orderBy("order", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("extra") - F.col("before") - F.coalesce(F.sum("words").over(inside), F.lit(0))
    small = small.withColumn("more", ((left > 0) & (2 * left >= F.col("words"))).cast("int"))
    columns = ("doc_id", "source", "size", "n", "source_size", "target")
    return large.select(*columns, "whole", "more").union(small.select(*columns, "whole", "more")).select(
        *columns, (F.col("whole") + F.col("more")).cast("int").alias("times"))


def _large_documents(rows: DataFrame) -> DataFrame:
    """``rows`` (of large documents) with ``more``: whether the fraction takes them once more.  Largest octave
    first, in seeded order inside it, a document is taken when that brings the words taken nearer to the
    fraction's share of the words seen, so what is missed carries over to the smaller ones."""
    order = F.sort_array(F.collect_list(F.struct((-F.length(F.bin("words"))).alias("octave"), "order", "doc_id", "size", "n", "words")))
    lists = rows.groupBy("source", "source_size", "target", "whole", "extra").agg(order.alias("docs"))

    def step(state, d):
        seen = state["seen"] + d["words"]
        more = (2.0 * state["taken"] + d["words"]) * F.col("source_size") <= 2.0 * seen * F.col("extra")
        return F.struct(seen.alias("seen"), (state["taken"] + F.when(more, d["words"]).otherwise(0)).alias("taken"),
                        F.concat(state["more"], F.array(more.cast("int"))).alias("more"))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("taken"),
                     F.array().cast("array<int>").alias("more"))
    picks = F.aggregate("docs", start, step, lambda s: s["more"])
    return (lists.select("source", "source_size", "target", "whole", "extra", F.explode(F.arrays_zip("docs", picks.alias("more"))).alias("x"))
            .select("source", "source_size", "target", "whole", "extra", "x.docs.*", "x.more"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        **how) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)``, one row per document."""
    alike = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 1024)))
    each = F.explode(F.sequence(F.lit(1), F.least(F.lit(1024), F.col("n") - 1024 * F.col("_block"))))
    return (repetitions(docs, id_col, text_col, source_col, **how)
            .withColumn("_block", alike).withColumn("_row", each)
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("times") * F.col("size")).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **how) -> DataFrame:
    """The columns of ``docs``, each row with its whole text as often as the mix takes it."""
    taken = repetitions(docs, id_col, text_col, source_col, **how).where("times > 0 AND size > 0")
    rows = docs.alias("d").join(taken.alias("m"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("m.doc_id"))
                                & F.col(f"d.`{source_col}`").eqNullSafe(F.col("m.source"))
                                & (word_count(F.col(f"d.`{text_col}`")) == F.col("m.size")))
    return (rows.select("d.*", F.explode(F.array_repeat(F.lit(0), F.col("m.times"))).alias("_words")).alias("d")
            .select(*[F.col(f"d.`{c}`") for c in docs.columns]))
