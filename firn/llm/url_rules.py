"""URL allow and block rules by a sort-merge range join (DataFrame only).

A rule ``(host, path, verdict)`` fits its host and all subdomains where the
url's path starts with the rule's path.  For every host suffix that has
rules, a rule is an interval of canonical keys: reversed host, then the
bytes of the path, open at ``path`` and closed at ``path + 0xFF`` (a byte
that UTF-8 never has).  Intervals of prefixes are nested or disjoint, so one
sorted sweep over openings, closings and urls with a stack gives the
innermost rule.  The stack is two running windows: the depth is the sum of
+1 and -1, and the top of the stack is the last opening of the same depth.

Scale: only distinct (host, path) pairs are swept; host suffixes without
rules drop out in an equi-join; a host suffix with many urls is dealt over
``ceil(urls / rows_per_sweep)`` lanes, to each of which its rules are
copied.  No pair of url and rule is formed unless it fits.

Defined cases: a url that is null or has no ``://`` has an empty host and
path and no rule; an empty rule host is ignored; null rule paths count as
empty; of rules with the same host and path the largest verdict ("block")
holds; the longest rule (characters of host and path, then larger rule
text) wins; urls without a rule get ``default``.  Repeated rows keep their
own result row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """``www.example.org`` as ``org.example.www``."""
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _suffixes(host: Column) -> Column:
    """Reversed keys of a host and of every domain above it."""
    parts = F.reverse(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))


def innermost_rules(urls: DataFrame, rules: DataFrame, rows_per_sweep: int = 100_000) -> DataFrame:
    """``(host, path, rule, verdict)`` for the pairs of ``urls`` that a rule fits.

    ``urls`` has distinct ``host`` and ``path``.
    """
    rule = (rules.select(F.col("host").alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict")
            .where("r_host <> ''").groupBy("r_host", "r_path").agg(F.max("verdict").alias("verdict"))
            .select(reversed_host(F.col("r_host")).alias("key"), "r_path", "verdict",
                    F.concat("r_host", "r_path").alias("rule")))
    probe = (urls.where("host <> ''").select("host", "path", F.explode(_suffixes(F.col("host"))).alias("key"))
             .join(rule.select("key").distinct(), "key", "left_semi"))
    lanes = probe.groupBy("key").agg(F.ceil(F.count("*") / rows_per_sweep).cast("int").alias("lanes"))
    dealt = probe.join(lanes, "key").withColumn("lane", F.pmod(F.xxhash64("host", "path"), "lanes").cast("int"))
    copied = rule.join(lanes, "key").withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)))

    at = F.encode("r_path", "UTF-8")
    none = F.lit(None).cast("string")
    opening = copied.select("key", "lane", at.alias("at"), F.lit(0).alias("kind"), F.lit(1).alias("step"),
                            F.struct("rule", "verdict").alias("top"), none.alias("host"), none.alias("path"))
    closing = copied.select("key", "lane", F.concat(at, F.lit(b"\xff")).alias("at"), F.lit(2).alias("kind"),
                            F.lit(-1).alias("step"), F.lit(None).cast(opening.schema["top"].dataType).alias("top"),
                            none.alias("host"), none.alias("path"))
    urls_at = dealt.select("key", "lane", F.encode("path", "UTF-8").alias("at"), F.lit(1).alias("kind"),
                           F.lit(0).alias("step"), F.lit(None).cast(opening.schema["top"].dataType).alias("top"),
                           "host", "path")
    # openings at one place: the key is unique, so shorter prefixes open first;
    # closings at one place: all of them close before any later key
    run = (Window.partitionBy("key", "lane").orderBy("at", "kind")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    level = (Window.partitionBy("key", "lane", "depth").orderBy("at", "kind")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = (opening.unionByName(closing).unionByName(urls_at)
             .withColumn("depth", F.sum("step").over(run))
             .withColumn("active", F.last("top", ignorenulls=True).over(level))
             .where("kind = 1 and depth > 0"))
    return (swept.groupBy("host", "path")
            .agg(F.max(F.struct(F.length("active.rule").alias("n"), F.col("active.rule").alias("rule"),
                                F.col("active.verdict").alias("verdict"))).alias("best"))
            .select("host", "path", "best.rule", "best.verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
               keep: list[str] | None = None, rows_per_sweep: int = 100_000) -> DataFrame:
    """``keep`` columns of ``pages`` plus host, path, rule and verdict, one row per input row."""
    rows = pages.select(F.struct(*(keep or [])).alias("kept") if keep else F.lit(1).alias("kept"),
                        url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    best = innermost_rules(rows.select("host", "path").distinct(), rules, rows_per_sweep)
    out = rows.join(best, ["host", "path"], "left")
    return out.select(*[F.col(f"kept.`{c}`").alias(c) for c in keep or []], "host", "path", "rule",
                      F.coalesce("verdict", F.lit(default)).alias("verdict"))
