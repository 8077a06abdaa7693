"""URL rules, mixing, chat formatting, sharding, page extraction: odd rows, empty tables, plain versions."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import brute
from firn.llm import chat, html_extract, mixing, queries, sharding, url_rules
from odd import ROWS, clashing_docs, no_docs, odd_docs  # noqa: F401

# URL rules

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/es/x", "allow"), ("com", "", "block"),
         ("a.com", "/p", "allow"), ("a.com", "/p", "block"), ("", "/", "block"), ("example.org", None, "block")]
URLS = [None, "", "no scheme", "http://", "http://ORG/", "https://Example.ORG/es/x?q=/fr/", "http://www.example.org/es/#y",
        "http://example.org", "http://notexample.org/es/", "http://a.com/p", "http://b.a.com/pq/r", "ftp://x://y.com/",
        "http://com", "http://xn--é.com/ü", "http://example.org/es/", "http://example.org/es/", "http://.org/", "http://a..com/p"]


def judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        k = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host = rest[:k].translate(brute.TO_LOWER)
        path = rest[k:][:min([i for i in map(rest[k:].find, "?#") if i >= 0], default=len(rest))]
    best = {}
    for h, p, v in RULES:
        if h and host and (host == h or host.endswith("." + h)) and path.startswith(p or ""):
            best[h + (p or "")] = max(v, best.get(h + (p or ""), ""))
    rule = max(best, key=lambda r: (len(r), r), default=None)
    return host, path, rule, best.get(rule, "allow")


@pytest.mark.parametrize("lane", [100_000, 2])
def test_url_rules(spark, lane):
    pages = spark.createDataFrame([(k, u, "r") for k, u in enumerate(URLS)] + [(None, "http://a.com/p", "r")],
                                  "page_id long, url string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    rows = url_rules.judge_urls(pages, rules, keep=["page_id", "url"], rows_per_sweep=lane).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == judge(r.url), r.url


def test_url_rules_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_rules.judge_urls(pages.where("false"), rules).collect() == []
    assert [r.verdict for r in url_rules.judge_urls(pages, rules.where("false"), default="none").collect()] == ["none"]


# mixing

def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while True:
        level = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if w[s] * level > cap * sizes[s]}
        if not over:
            return out | {s: w[s] * level for s in free}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= over


def test_mix_odd_rows(odd_docs, clashing_docs, no_docs):
    sizes = Counter()
    for _, text, _, source, _ in ROWS:
        sizes[source] += len(brute.words(text))
    want = targets(sizes)
    longest = {s: max(len(brute.words(t)) for _, t, _, x, _ in ROWS if x == s) * (2 if s == "c" else 1) for s in sizes}
    for docs in (odd_docs, clashing_docs):
        rows = mixing.mix(docs).collect()
        assert len(rows) == len(ROWS)
        taken = Counter()
        for r in rows:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
            assert 0 <= r.taken <= 2 * r.size
            taken[r.source] += r.taken
        assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 0.5 for s in sizes)
        assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mix(no_docs).collect() == []


def test_mixed_documents_hold_the_taken_words(spark):
    rnd = random.Random(4)
    docs = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(rnd.randrange(1, 40))), rnd.choice("abcd")) for k in range(300)],
                                 "doc_id long, text string, source string")
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(docs).collect()}
    got = defaultdict(list)
    for r in mixing.mixed_documents(docs).collect():
        got[r.doc_id].append(r.text)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i, (t, size) in taken.items():
        assert sum(len(x.split()) for x in got[i]) == t
        assert all(x == texts[i] for x in got[i])


def plain_mix(rows):
    """{(id, source, size): times}, document by document, from distinct (id, source, size)."""
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    out = {}
    for s, goal in targets(sizes).items():
        goal = math.floor(goal + 0.5)
        whole = goal // sizes[s] if sizes[s] else 0
        extra, seen, used = goal - whole * sizes[s], 0, 0
        mine = [(hashlib.md5(f"mix:{i}".encode()).hexdigest(), i, n) for i, x, n in rows if x == s]
        for o, i, n in sorted((x for x in mine if x[2] * 256 > sizes[s]), key=lambda x: (-len(bin(x[2])), x)):
            seen += n
            more = (2.0 * used + n) * sizes[s] <= 2.0 * seen * extra
            used += n * more
            out[i, s, n] = whole + more
        left = extra - used
        for o, i, n in sorted(x for x in mine if x[2] * 256 <= sizes[s]):
            out[i, s, n] = whole + (left > 0 and 2 * left >= n)
            left -= n
    return out


def test_mix_matches_plain_version_and_comes_near_the_target(spark):
    rnd = random.Random(12)
    rows = [(k, rnd.choice("aaabc"), rnd.choice([0, 3, 40, 41, 90, 2000])) for k in range(1500)] + [(9000, "b", 30_000), (9001, "d", 700)]
    docs = spark.createDataFrame([(i, "w " * n, s) for i, s, n in rows], "doc_id long, text string, source string")
    want, got, sizes = plain_mix(rows), Counter(), Counter()
    for i, s, n in rows:
        sizes[s] += n
    for r in mixing.mix(docs).collect():
        assert r.taken == want[r.doc_id, r.source, r.size] * r.size
        got[r.source] += r.taken
    goal = targets(sizes)
    assert all(abs(got[s] - goal[s]) <= 46 for s in "abc") and abs(got["d"] - goal["d"]) <= 350


def test_mix_of_ids_that_clash_between_sources(spark):
    rows = [(k, "w " * 60, s) for k in range(40) for s in "ab"] + [(k, "w " * 60, "a") for k in range(40, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want, got, emitted = targets({"a": 3600, "b": 2400}), Counter(), Counter()
    for r in mixing.mix(docs).collect():
        got[r.source] += r.taken
    for r in mixing.mixed_documents(docs).collect():
        emitted[r.source] += 60
    assert got == emitted and all(abs(got[s] - want[s]) <= 30 for s in "ab")


def test_mixed_documents_emit_whole_texts_near_the_target(spark):
    rnd = random.Random(9)
    rows = [(k, " \t".join(f"w{j}" for j in range(rnd.randrange(1, 40))), rnd.choice("abcd")) for k in range(200)]
    rows += [(200, "long\n\n" * 9000 + "end", "e"), (201, "short  text", "e"), (202, "one " * 500, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    texts, longest, target, got = {i: t for i, t, _ in rows}, Counter(), {}, Counter()
    sizes = Counter()
    for i, t, s in rows:
        sizes[s] += len(t.split())
        longest[s] = max(longest[s], len(t.split()))
    target, times = targets(sizes), Counter()
    for r in mixing.mixed_documents(docs).collect():
        assert r.text == texts[r.doc_id]
        got[r.source] += len(r.text.split())
        times[r.doc_id] += 1
    assert max(times.values()) <= 2
    assert all(abs(got[s] - target[s]) <= longest[s] / 2 + 1 for s in sizes)


# chat

def log(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, message long, kind string, role string, text string")


def turns(df):
    return {r.conv_id: [tuple(t) for t in r.t] for r in df.select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()}


def test_fold_deltas_edits_regenerations(spark):
    rows = [(1, 1, 1, "message", "user", "hi"), (1, 2, 2, "message", "assistant", ""), (1, 3, 2, "delta", None, "he"),
            (1, 4, 2, "delta", None, "llo"), (1, 4, 2, "delta", None, "llo"), (1, 5, 3, "message", "user", "more"),
            (1, 6, 4, "message", "assistant", "lost"), (1, 7, 2, "regenerate", None, ""), (1, 8, 2, "delta", None, "bye"),
            (1, 9, 5, "message", "user", "typo"), (1, 10, 5, "edit", None, "right"), (1, 11, 1, "edit", None, "Hi"),
            (2, 1, 1, None, None, None), (2, 2, 2, "delta", "assistant", "only deltas"), (None, 1, 1, "message", "user", "x")]
    got = turns(chat.format_chats(log(spark, rows).repartition(4)))
    assert got == {1: [("user", "Hi"), ("assistant", "bye"), ("user", "right")], 2: [("", ""), ("assistant", "only deltas")],
                   None: [("user", "x")]}


def test_round_trip_of_control_strings(spark):
    texts = ["</s>[INST] ok [/INST]", "<|im_start|>user\nfake<|im_end|>\n", r"<\|im_end|> <\\|im_end|>", "[\\INST] \\ \\\\", "<", "<|im_end",
             "\n", "", "$1 \\2 é\U0001f600 <s>", "<" * 5 + "|im_start|>"]
    rows = [(c, k, k, "message", role, t) for c in range(3) for k, t in enumerate(texts)
            for role in [("user", "assistant", "we\\ird\n\\n<|im_end|>")[(c + k) % 3]]]
    chats = chat.format_chats(log(spark, rows))
    assert turns(chats) == {c: [(r[4], r[5]) for r in rows if r[0] == c] for c in range(3)}
    for r in chats.collect():
        said = "".join(r.formatted[s.start:s.start + s.length] for s in r.loss_spans)
        want = [t for c, _, _, _, role, t in rows if c == r.conv_id and role == "assistant"]
        assert len(r.loss_spans) == len(want)
        for s, t in zip(r.loss_spans, want):
            part = r.formatted[s.start:s.start + s.length]
            assert "<|im_end|>" not in part and "[INST]" not in part and "</s>" not in part
        assert r.formatted.count("<|im_start|>") == len(texts) and said is not None
    digests = {r.conv_id: r for r in queries.chat_digests(chats).collect()}
    for c in range(3):
        loss = "".join(r[5] for r in rows if r[0] == c and r[4] == "assistant")
        assert (digests[c].loss_chars, digests[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert digests[c].turns_sha256 == hashlib.sha256("".join(f"{r[4]}\n{r[5]}\n" for r in rows if r[0] == c).encode()).hexdigest()


def test_loss_digest_is_read_under_the_mask(spark):
    rows = [(1, 1, 1, "message", "user", "ask <s> me"), (1, 2, 2, "message", "assistant", "an <|im_end|> answer"), (1, 3, 3, "message", "assistant", "é\U0001f600")]
    chats = chat.format_chats(log(spark, rows))
    right = queries.chat_digests(chats).first()
    assert right.loss_chars == len("an <|im_end|> answeré\U0001f600")
    for wrong in ("transform(loss_spans, s -> struct(s.start + 1 AS start, s.length AS length))", "slice(loss_spans, 1, 1)", "reverse(loss_spans)",
                  "transform(loss_spans, s -> struct(s.start AS start, s.length + 1 AS length))"):
        other = queries.chat_digests(chats.withColumn("loss_spans", F.expr(wrong))).first()
        assert other.loss_sha256 != right.loss_sha256 and other.turns_sha256 == right.turns_sha256


def test_chat_long_texts_and_clashing_names(spark):
    long = "word <s> é " * 60_000
    rows = [(1, 1, 1, "message", "user", long), (1, 2, 2, "message", "assistant", long), (1, 3, 3, "message", "assistant", "end")]
    names = ("head", "body", "at", "first_seq", "loss", "formatted", "reset", "n_turns", "turns")
    clashing = log(spark, rows).withColumns({n: F.lit("x") for n in names})
    chats = chat.format_chats(clashing)
    assert turns(chats) == {1: [(r[4], r[5]) for r in rows]}
    assert queries.chat_digests(chats).first().loss_sha256 == hashlib.sha256((long + "end").encode()).hexdigest()


def test_chat_empty(spark):
    assert chat.format_chats(log(spark, [])).collect() == []


def test_repeated_rows_are_turns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None)],
                                 "conv_id long, turn long, role string, text string")
    assert turns(chat.format_chats(queries.conversation_log(rows))) == {1: [("", ""), ("user", "a"), ("user", "a")]}


# sharding

def least_capacity(sizes, n):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, load, used = (low + high) // 2, 0, 1
        for s in sizes:
            if load + s > mid:
                load, used = 0, used + 1
            load += s
        low, high = (low, mid) if used <= n else (mid + 1, high)
    return low


@pytest.mark.parametrize("hot", [0, 400])
@pytest.mark.parametrize("n", [1, 3, 8])
def test_minimax(spark, hot, n):
    rnd = random.Random(n + hot)
    texts = ["x" * rnd.randrange(1, 400) + str(k) for k in range(500)] + ["hot text"] * hot
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard(docs, n).collect()
    groups = Counter()
    for t in texts:
        groups[t] += len(t) + 1
    order = sorted(groups, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    assert max(load.values()) == least_capacity([groups[t] for t in order], n)
    shard_of = {texts[r.doc_id]: r.shard for r in rows}
    assert [shard_of[t] for t in order] == sorted(shard_of[t] for t in order)
    for k in range(n):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))


def test_shard_odd_rows(odd_docs, clashing_docs, no_docs):
    for docs in (odd_docs, clashing_docs):
        rows = sharding.shard(docs, 4).collect()
        assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, len((t or "").encode()) + 1) for i, t, *_ in ROWS)
        whole = sharding.sharded_documents(docs, 4)
        assert set(whole.columns) == set(docs.columns) | {"shard", "slot"}
        assert Counter((r.shard, r.slot) for r in whole.collect()) == Counter((r.shard, r.slot) for r in rows)
    assert sharding.shard(no_docs, 4).collect() == []


# pages

def page(k, body, head="<title>t</title>"):
    return (k, f"http://site.example/{k}", f"<html><head>{head}</head><body>{body}</body></html>")


def main_texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.row.page_id: r.main_text for r in html_extract.extract(df, ["page_id"]).collect()}


def test_article_without_surroundings(spark):
    body = ("<header><a href=/>Site</a> menu</header><nav><ul><li><a href=/a>A</a></ul></nav><div class='cookie-notice'>We use cookies</div>"
            "<main><article><header><h1>T&eacute;te &amp; more</h1></header><p>One\n two<br>three &lt;b&gt;</p><script>var x='</p>';</script>"
            "<p>Four <b>five</b>six<form><input>Subscribe</form><aside>See also</aside><ul><li>item 1<li>item 2</ul></article>"
            "<section id=comments><article class=comment><p>First! A long comment, longer than the article itself, on and on and on and "
            "on and on and on and on and on and on and on and on and on and on.</p></article></section></main><footer>(c)</footer>")
    assert main_texts(spark, [page(1, body)]) == {1: "Téte & more\nOne two three <b>\nFour fivesix\nitem 1\nitem 2"}


def test_template_text_leaves_pages_without_landmarks(spark):
    rows = [page(k, f"<div id=top><a href=/>Home</a></div><div id=content><p>Our daily story</p><h2>Title {k}</h2><p>Body of story {k} "
                    f"with words w{k} x{k} y{k}.</p></div><div id=foot>All rights kept</div>") for k in range(6)]
    got = main_texts(spark, rows)
    assert got == {k: f"Title {k}\nBody of story {k} with words w{k} x{k} y{k}." for k in range(6)}


def test_pages_odd_rows(spark):
    rows = [(1, None, "<p>a</p>"), (2, "u", None), (3, "", ""), (4, "http://x/", "plain text"), (5, "http://x/", "<p>cut <b>off &am"),
            (6, "http://x/", "</p></div><p>stray</p>"), (7, "http://x/", "<article><p>" + "w " * 100_000 + "</article>"),
            (8, "http://x/", "<article></article>"), (None, "http://y/", "<p>no id</p>"), (9, "http://x/", "<p>5 < 6 & 7</p>"),
            (10, "http://x/", "<article><p>same</article>"), (10, "http://x/", "<article><p>same</article>")]
    got = main_texts(spark, rows)
    assert got == {1: "a", 2: "", 3: "", 4: "plain text", 5: "cut off &am", 6: "stray", 7: ("w " * 100_000).strip(), 8: "",
                   None: "no id", 9: "5 < 6 & 7", 10: "same"}
    assert main_texts(spark, []) == {}


def test_pages_with_clashing_names_and_repeats(spark):
    rows = [page(k // 2, f"<p>Our daily story</p><div class=in>{story(k // 2)}</div>") for k in range(12)]  # each page twice
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    names = ("row", "host", "key", "token", "tokens", "texts", "main_text", "mass")
    got = html_extract.extract(df.withColumns({n: F.lit("x") for n in names}), ["page_id", "host", "row"]).collect()
    assert sorted((r.row.page_id, r.main_text, r.row.host) for r in got) == sorted((k // 2, story_text(k // 2), "x") for k in range(12))
    classes = html_extract.host_templates(df.select(F.lit("h").alias("host"), "html", F.xxhash64("html").alias("key"))).first().classes
    assert len(set(classes)) > 1


def test_equivalence_classes_of_a_host(spark):
    rows = [page(k, f"<nav>menu</nav><article><h1>t{k}</h1>" + f"<p>p{k}</p>" * (k + 1) + "</article><footer>foot</footer>") for k in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").select(
        F.lit("h").alias("host"), "html", F.col("page_id").alias("key"))
    t = html_extract.host_templates(df).first()
    by_class = defaultdict(set)
    for token, c in zip(t.tokens, t.classes):
        by_class[c].add(token)
    p = html_extract.Page(rows[2][2])
    tags = {path.rsplit("/", 1)[1]: k for k, path in p.paths.items()}
    once = next(c for c in by_class.values() if tags["article"] in c)
    assert {tags["h1"], tags["nav"], tags["footer"]} <= once and tags["p"] not in once
    assert any(tags["p"] in c and len(c) == 2 for c in by_class.values())  # the tag and its end


@pytest.mark.parametrize("wrapper", ["wrapper has-sidebar", "no-sidebar", "page-with-banner", "menu-open", "post comment-open", "has-header"])
def test_listed_words_on_wrappers_hide_no_article(wrapper):
    story = "<h1>Title</h1><p>The story has words enough to be most of the page.</p>"
    want = "Title\nThe story has words enough to be most of the page."
    for body in (f"<div class='{wrapper}'><article>{story}</article></div>", f"<article class='{wrapper}'>{story}</article>",
                 f"<article><div class='{wrapper}'>{story}</div></article>", f"<div class='{wrapper}'>{story}</div><div>(c)</div>",
                 f"<div id='overlay'>{story}</div>", f"<form>{story}</form>"):
        for outside in ("", "<div class='ad'>Buy this</div>"):
            assert html_extract.Page(page(1, body + outside)[2]).main_text({}, frozenset()).startswith(want), body


LINE = "A sentence of the article about the weather in the hills that goes on for a while, so that it counts. "


@pytest.mark.parametrize("body", [
    "<article><h1>T</h1>{0}{1}{2}</article>|<div class='elementor-widget'>", "<div id=c><h1>T</h1>{0}{1}{2}</div>|<div class='elementor-widget'>",
    "<div id=c><h1>T</h1>{0}{1}{2}</div>|<div class='comment-free'>", "<div class='overlay'><h1>T</h1>{0}{1}{2}</div><div>short</div>|<div>",
    "<div class='notice content'><h1>T</h1>{0}{1}{2}</div><div>short</div>|<div>", "<form id=aspnetForm><div><h1>T</h1>{0}{1}{2}</div></form><div>short</div>|<div>",
    "<div id=c><h1>T</h1><section class=intro>{0}</section><section class=body>{1}</section><section class=outlook>{2}</section></div>|<div>",
    "<div id=c><h1>T</h1>{0}{1}{2}</div>|<div class='text-block'>", "<div id=c><h1>T</h1><div class=body>{0}{1}{2}</div></div>|<div>"])
def test_layouts_lose_no_part_of_the_article(spark, body):
    """Alike blocks with listed words, listed names around whole pages, sections without a landmark; alone and on a host."""
    body, tag = body.split("|")
    around = "<nav><a href=/>Home</a></nav>{}<div class=sidebar>Weather today</div><div id=comments><div class='comment-body'><p>First!</p></div></div><footer>(c)</footer>"

    def html(k):
        parts = [f"{tag}<p>{LINE * 2}{word} {k}.</p><p>{word} w{k} x{k}.</p></div>" for word in ("one", "two", "three")]
        return page(k, around.format(body.format(*parts)))
    want = {k: "T\n" + "\n".join(f"{LINE * 2}{word} {k}.\n{word} w{k} x{k}." for word in ("one", "two", "three")) for k in range(8)}
    assert html_extract.Page(html(3)[2]).main_text({}, frozenset()) == want[3]
    got = main_texts(spark, [html(k) for k in range(8)])
    assert {k: t.removeprefix("T\n") for k, t in got.items()} == {k: t.removeprefix("T\n") for k, t in want.items()}  # T is on all pages


def test_listed_names_are_noise_beside_an_article():
    body = ("<article><p>Short story.</p><div class='share'>Share this with all your friends, every one of them</div></article>"
            "<div class='related'><article><p>Another story, longer than the one of this page, on and on.</p></article></div>")
    assert html_extract.Page(page(1, body)[2]).main_text({}, frozenset()) == "Short story."


def story(k):
    return f"<h1>Title {k}</h1><p>Body of story {k} with words w{k} x{k} y{k}.</p><p>More of it: a{k} b{k}.</p>"


def story_text(k):
    return f"Title {k}\nBody of story {k} with words w{k} x{k} y{k}.\nMore of it: a{k} b{k}."


@pytest.mark.parametrize("tag", ["article", "main"])
def test_host_wide_text_leaves_articles(spark, tag):
    strip = "<div class=qx>Tell your friends of this page</div>"
    rows = [page(k, f"<{tag}><p>Our daily story</p>{story(k)}{strip}<p>Write to us</p></{tag}>") for k in range(8)]
    assert main_texts(spark, rows) == {k: story_text(k) for k in range(8)}


def test_holder_with_most_text_wins_over_a_landmark(spark):
    rows = [page(k, f"<article class=teaser><p>See no. {k}</p></article><div class=zz>{story(k)}</div>") for k in range(5)]
    assert main_texts(spark, rows) == {k: story_text(k) for k in range(5)}


def test_copied_articles_keep_their_text(spark):
    rows = [page(k, f"<article>{story(k)}</article>") for k in range(20)]
    rows += [page(k, f"<p>No. {k}</p><article>{story(99)}<p>Copy {k}</p></article>") for k in range(20, 32)]
    rows += [page(k, f"<article>{story(77)}<table><tr><td>cell</table></article>") for k in range(32, 40)]
    got = main_texts(spark, rows)
    for k in range(20):
        assert got[k] == story_text(k)
        if k < 12:
            assert got[k + 20] == f"{story_text(99)}\nCopy {k + 20}"
        if k < 8:
            assert got[k + 32] == f"{story_text(77)}\ncell"


@pytest.mark.parametrize("own", [True, False])
def test_layouts_of_a_large_host(spark, own):
    """Six layouts, none on 30% of the host's pages; with classes of their own, or one class and texts of their own."""
    rows = []
    for k in range(60):
        n = "abcdef"[k % 6] if own else ""
        rows.append(page(k, f"<div class=top{n}><p>Layout {k % 6} of our site</p></div><div class=mid{n}><div class=in{n}>{story(k)}</div>"
                            f"<div class=un{n}>Kept by the desk of layout {k % 6}</div></div>" + f"<div class=own{k % 6}></div>"))
    assert main_texts(spark, rows) == {k: story_text(k) for k in range(60)}
    small = rows[0::6]
    assert main_texts(spark, small) == {r[0]: story_text(r[0]) for r in small}


def test_text_of_a_layout_inside_articles(spark):
    rows = [page(k, f"<article class=lay{'abcde'[k % 5]}>{story(k)}<p>Desk {k % 5} tells you more</p></article>") for k in range(50)]
    assert main_texts(spark, rows) == {k: story_text(k) for k in range(50)}
