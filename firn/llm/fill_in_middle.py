"""Fill-in-the-middle transformation by counted quantifiers (JVM regular expressions).

A text is cut into n units (a run of ASCII letters, or any other code point).
``regexp_count`` gives n; seeded hashes of the id draw two cuts a <= b in 0..n and the
form.  A pattern made for the row, ``(unit{a}+)(unit{b-a}+)(rest)``, then captures
prefix, middle and suffix in one match, and its replacement writes the output::

    psm  <P>prefix<S>suffix<M>middle
    spm  <S>suffix<P>prefix<M>middle
    plain  the text

Both counted groups are possessive: the units of a text are unique, so nothing is lost
without backtracking, and the JVM matches a possessive group in a loop, where a
backtracking one recurses once a unit and overflows its stack on long texts.

Scale: one narrow stage, no shuffle, no Python; a row needs its own text and tokens only.

Defined cases: null text is empty; an empty text, and one that has a marker in it, stays
plain; a null id draws as empty text; very long texts are matched whole; rows of equal id
and text get equal results; other columns, whatever their names, stay in ``row``; empty
input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[A-Za-z]+|[^A-Za-z]"
# the same units for counted groups: a letter run must not be split to make a count come out
WHOLE_UNIT = "(?:[A-Za-z]++|[^A-Za-z])"


def draw(doc_id: Column, seed: int, k: int) -> Column:
    """The k-th (from 0) 8-digit group of the hex SHA-256 of ``seed:id``, as an unsigned integer."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   fim_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """``(row, n, form, prefix_chars, middle_chars, output)``; ``row`` has the input's columns."""
    text, doc_id = F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")), F.col(f"row.`{id_col}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("n", F.regexp_count(text, F.lit(UNIT)).cast("long"))
    cuts = [draw(doc_id, seed, k) % (F.col("n") + 1) for k in (0, 1)]
    plain = (text == "") | (draw(doc_id, seed, 2) % 100 >= fim_percent)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(text, F.lit(marker))
    rows = (rows.withColumn("first", F.least(*cuts)).withColumn("second", F.greatest(*cuts) - F.col("first"))
            .withColumn("form", F.when(plain, "plain").when(draw(doc_id, seed, 3) % 100 < spm_percent, "spm").otherwise("psm")))
    pattern = F.format_string(rf"(?s)\A({WHOLE_UNIT}{{%d}}+)({WHOLE_UNIT}{{%d}}+)(.*+)\z", "first", "second")
    order = (F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
             .otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"))
    output = F.when(F.col("form") == "plain", text).otherwise(F.regexp_replace(text, pattern, order))
    # the text has no markers, so their places in the output give the lengths of the parts
    at = {m: F.locate(m, F.col("output")) for m in (PREFIX, SUFFIX, MIDDLE)}
    end = F.when(F.col("form") == "psm", at[SUFFIX]).when(F.col("form") == "spm", at[MIDDLE])
    cut = F.col("form") != "plain"
    return rows.withColumn("output", output).select(
        "row", "n", "form", F.when(cut, end - at[PREFIX] - len(PREFIX)).cast("long").alias("prefix_chars"),
        F.when(cut, F.length("output") - at[MIDDLE] - len(MIDDLE) + 1).cast("long").alias("middle_chars"), "output")


def restore(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from."""
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
