"""Registered queries of this package: thin digests of the operators' results.

``load()`` returns ``(queries, oracles)``; ``oracles`` has DuckDB text where SQL can
express a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firn.llm import (chat, decontaminate, exact_dedup, fill_in_middle, html_extract, language_id, line_dedup, maxent_lm, mixing, near_dedup,
                      sharding, spelling, url_rules)
from firn.llm.common import SPACE

from firn.sources.tables import read_table

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract(read_table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.select("row.page_id", "row.url", F.col("main_text").alias("text"),
                        F.length("main_text").cast("long").alias("n_chars"))


# The pages of these tables have their text in one <article>; the operator doesn't know that.
OP1_SQL = r"""
WITH a AS (SELECT page_id, url, string_split_regex(regexp_replace(coalesce(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), ''),
             '<br>', ' ', 'g'), '</?(?:p|h1)>') AS parts FROM pages),
b AS (SELECT page_id, url, list_transform(parts, lambda p: trim(regexp_replace(replace(replace(replace(replace(replace(
        regexp_replace(p, '<[^>]*>', '', 'g'), '&quot;', '"'), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))) AS blocks FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text)::bigint AS n_chars FROM t
"""


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the items found."""
    found = decontaminate.find_phrases(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                       ["doc_id"])
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("row.doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


OP2_SQL = r"""
WITH words AS (SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {}),
d AS (SELECT row_number() OVER () AS r, doc_id, w FROM (SELECT * FROM words)),
i AS (SELECT item_id::varchar AS item_id, w FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark) WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, w[k:k + least(10, len(w)) - 1] AS phrase
      FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM i)),
n AS (SELECT DISTINCT len(phrase) AS n FROM p),
s AS (SELECT r, k, n, w[k:k + n - 1] AS phrase
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, n)),
o AS (SELECT r, k, n, item_id FROM s JOIN p USING (phrase)),
h AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS pos FROM o) GROUP BY r),
x AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT r, item_id FROM o) GROUP BY r)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN x USING (r)
""".replace("{}", "documents")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the copy that stays, group size, SHA-256 of the text."""
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count, component and survivor of near-duplicate documents."""
    return near_dedup.near_dedup(read_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language and score of every document."""
    docs = read_table(spark, sf_dir, "documents")
    held = docs.withColumn("held", language_id.held_out(F.col("doc_id")))
    found = language_id.identify(held, language_id.learn_profiles(held.where("not held")), ["doc_id", "held"])
    return found.select("row.doc_id", F.col("row.held").alias("held_out"), "lang_pred", "score")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base and hashed maximum-entropy score of every document."""
    return maxent_lm.score_documents(read_table(spark, sf_dir, "documents"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"), rules, keep=["page_id"])


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
OP7_SQL = rf"""
WITH r(r_host, r_path, r_verdict) AS (VALUES {_RULES_SQL}),
u AS (SELECT page_id,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
b AS (SELECT host, path, max({{'n': length(r_host || r_path), 'rule': r_host || r_path, 'verdict': r_verdict}}) AS m
      FROM (SELECT DISTINCT host, path FROM u)
      JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
      GROUP BY host, path)
SELECT page_id, host, path, m.rule AS rule, coalesce(m.verdict, 'allow') AS verdict
FROM u LEFT JOIN b USING (host, path)
"""


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document, by capped water-filling."""
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("source")


OP8_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, md5('mix:' || coalesce(doc_id::varchar, '')) AS o,
             coalesce(len(regexp_extract_all(text, '[^{SPACE}]+')), 0)::bigint AS size FROM documents),
s AS (SELECT source, sum(size)::bigint AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
      FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(rank % 3 + 1)::int]::double AS weight, source_size::double * 2 AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER ())::double * 1.5 AS budget, sum(weight) OVER () AS all_w,
        coalesce(sum(cap) OVER b, 0) AS caps, coalesce(sum(weight) OVER b, 0) AS ws
      FROM w WINDOW b AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (budget - caps) / (all_w - ws) AS level, cap / weight <= (budget - caps) / (all_w - ws) AS clamped FROM l),
t AS (SELECT source, source_size, CASE WHEN clamped THEN cap
        ELSE weight * (SELECT arg_min(level, ws) FROM c WHERE NOT clamped) END AS target FROM c),
x AS (SELECT *, floor(target + 0.5)::bigint AS goal,
        CASE WHEN source_size > 0 THEN floor(target + 0.5)::bigint // source_size ELSE 0 END AS whole FROM t),
g AS (SELECT a.source, doc_id, o, size, n, n * size AS words, source_size, target, whole,
        goal - whole * source_size AS extra, n * size * 256 > source_size AS large
      FROM (SELECT source, doc_id, o, size, count(*) AS n FROM d GROUP BY ALL) a
      JOIN x ON a.source IS NOT DISTINCT FROM x.source),
b AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY length(bin(words)) DESC, o, doc_id, size) AS k FROM g WHERE large),
f AS (SELECT source, 0::bigint AS k, 0::bigint AS seen, 0::bigint AS used, false AS more FROM x
      UNION ALL
      SELECT b.source, b.k, f.seen + b.words,
        f.used + CASE WHEN (2.0::double * f.used + b.words) * b.source_size <= 2.0::double * (f.seen + b.words) * b.extra THEN b.words ELSE 0 END,
        (2.0::double * f.used + b.words) * b.source_size <= 2.0::double * (f.seen + b.words) * b.extra
      FROM f JOIN b ON f.source IS NOT DISTINCT FROM b.source AND b.k = f.k + 1),
y AS (SELECT g.*, extra - coalesce(u.used, 0) - coalesce(sum(words) OVER (PARTITION BY g.source ORDER BY o, doc_id, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remain
      FROM g LEFT JOIN (SELECT source, max(used) AS used FROM f GROUP BY source) u ON g.source IS NOT DISTINCT FROM u.source
      WHERE NOT large),
z AS (SELECT doc_id, size, n, source_size, target, whole + (remain > 0 AND 2 * remain >= words)::int AS times FROM y
      UNION ALL
      SELECT doc_id, size, n, source_size, target, whole + f.more::int FROM b JOIN f ON f.source IS NOT DISTINCT FROM b.source AND f.k = b.k)
SELECT doc_id, size, source_size, target, (times * size)::bigint AS taken FROM (SELECT *, unnest(range(n)) AS r FROM z)
"""


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from the rendered conversations."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    rows = rows.union(spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema))
    return chat_digests(chat.format_chats(conversation_log(rows)))


def conversation_log(rows: DataFrame) -> DataFrame:
    """Rows by turn as a log of whole messages; rows of one turn follow each other."""
    from pyspark.sql import Window
    seq = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return rows.select("conv_id", seq.alias("seq"), seq.alias("message"), F.lit("message").alias("kind"), "role", "text")


def chat_digests(chats: DataFrame) -> DataFrame:
    turns = chat.read_back(F.col("formatted"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return (chats.withColumn("turns", turns).withColumn("loss", loss)
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


_ESC = r"regexp_replace({}, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\])', '\1\\\2\3', 'g')"
OP9_SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::bigint AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(12 + 1 + 10 + 1 + length(replace(replace({_ESC.format('role')}, '\', '\\'), chr(10), '\n'))
           + length({_ESC.format('text')}))::bigint AS formatted_chars
FROM c GROUP BY conv_id
"""


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes, groups of equal texts kept whole."""
    placed = sharding.shard(read_table(spark, sf_dir, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them hold."""
    docs = read_table(spark, sf_dir, "documents")
    index = line_dedup.LineIndex(spark, min_docs=3, min_chars=20)
    index.insert(docs)
    return index.strip(docs, ["doc_id"]).select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP11_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
l AS (SELECT r, doc_id, unnest(w) AS line, unnest(range(len(w))) AS k FROM d),
x AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM x WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3),
y AS (SELECT r, doc_id, k, line, c.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS dropped FROM x LEFT JOIN c USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count_if(dropped)::bigint AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT dropped), '')) AS kept_sha256
FROM y GROUP BY r
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents (one run in 31 misspelt), their near words, form and root."""
    return spelling.group_variants(spelling.count_words(read_table(spark, sf_dir, "documents"), misspell=31))


# crc32 by its table of 256 (from the reversed polynomial); near words by the strings with one code point cut out.
OP12_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT b::bigint AS b, b::bigint AS v, 0 AS k FROM range(256) t(b)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
r AS (SELECT coalesce(doc_id::varchar, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]{7,}')) AS run FROM documents),
u AS (SELECT id, run, count(*) AS n FROM r GROUP BY ALL),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(id || ':' || run, ''),
          lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::bigint] ELSE [192 + (unicode(c)::bigint >> 6), 128 + (unicode(c)::bigint & 63)] END))),
          lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h FROM u, tab),
m AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::bigint AS n FROM m WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
c AS (SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS cut FROM (SELECT *, unnest(range(1, length(word) + 1)) AS k FROM w)),
p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM c a JOIN c b ON a.k = b.k AND a.cut = b.cut AND a.word <> b.word
      UNION SELECT c.word, c.n, w.word, w.n FROM c JOIN w ON c.cut = w.word
      UNION SELECT w.word, w.n, c.word, c.n FROM c JOIN w ON c.cut = w.word),
f AS (SELECT word, n, count(*) AS n_near, arg_min(near, (-near_n, near)) AS best, max(near_n) AS best_n FROM p GROUP BY ALL),
g AS (SELECT word, n_near, CASE WHEN best_n >= 10 * n THEN best END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM f),
o AS (SELECT word, word AS root, 0 AS hops FROM w UNION ALL SELECT o.word, g.form, hops + 1 FROM o JOIN g ON o.root = g.word WHERE g.form IS NOT NULL)
SELECT w.word, g.form, o.root, w.n, coalesce(g.n_near, 0) AS n_near, g.form_n
FROM w LEFT JOIN g USING (word) JOIN (SELECT word, arg_max(root, hops) AS root FROM o GROUP BY word) o USING (word)
"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut, form and digests of every document's fill-in-the-middle output."""
    made = fill_in_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))
    restored = fill_in_middle.restore(F.col("output"), F.col("form"))
    return made.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored, 256).alias("restored_sha256"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
             sha256('1:' || coalesce(doc_id::varchar, '')) AS h FROM documents),
e AS (SELECT doc_id, text, u, len(u)::bigint AS n, ('0x' || h[1:8])::bigint % (len(u) + 1) AS x, ('0x' || h[9:16])::bigint % (len(u) + 1) AS y,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::bigint % 100 >= 90 THEN 'plain'
             WHEN ('0x' || h[25:32])::bigint % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, text, n, form, array_to_string(u[1:least(x, y)], '') AS pre,
        array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS mid, array_to_string(u[greatest(x, y) + 1:], '') AS suf FROM e)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


def load() -> tuple[dict, dict]:
    found = {f.__name__: f for f in (
        op1_html_extract, op2_decontaminate, op3_exact_dedup, op4_near_dedup, op5_language_id, op6_lm_score, op7_url_rules, op8_mixing,
        op9_chat_format, op10_sharding, op11_line_dedup, op12_spelling_variants, op13_fill_in_middle)}
    return found, {"op1_html_extract": OP1_SQL, "op2_decontaminate": OP2_SQL, "op3_exact_dedup": OP3_SQL, "op7_url_rules": OP7_SQL,
                   "op8_mixing": OP8_SQL, "op9_chat_format": OP9_SQL, "op11_line_dedup": OP11_SQL,
                   "op12_spelling_variants": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
