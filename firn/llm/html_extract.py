"""Main text of web pages by equivalence-class template deduction.

1. A page is read into tokens: tags with their path of elements, and text nodes with
   theirs.  For every (host, token) the pages' occurrences are combined into one
   vector signature: an exclusive or and a sum (which repeated pages don't cancel) of hash(page, times) with the number of
   pages and the total.
2. Tokens of a host with one signature have one occurrence vector: they are an
   equivalence class.  Support is absolute: tags on ``least_pages`` pages, texts on as many pages of different content.
   A text belongs to the template if its class holds a tag, or if it is on ``support`` of the pages that have its
   element, so a layout has its template however many pages the host has beside it.
   A class is valid on a page if its tokens stand there in the class's order
   (by mean position), and if it nests: its gaps hold other classes whole.  Invalid classes are ignored.
3. What valid classes leave are slots.  Slot text is summed by the element that holds
   it (an ``article`` or ``main`` for all inside it), outside of links and boilerplate elements.  A landmark with more
   template-free text on a page of the host than any other holder has the article; else the least element that has nine
   tenths of that text, with what the elements around it hold themselves.
   Texts of the template are dropped from it.  Where that would leave less than a quarter, only texts of classes with
   tags on over half of the host's pages are dropped, since the rest may be an article that was copied.

Names of classes and ids are hints: a listed word marks an element as boilerplate unless that hides the page's landmark
or, by all elements of its path together, most of the text around it (three quarters for a name that is listed as a whole;
the listed name of a part of a page, such as comments, stays); all hints fall where they leave no text.

Blocks end at block-level tags; character references are decoded, white space in
a block becomes one space, and blocks are joined by one line end.

Scale: tokens are combined in the tasks and on the map side, so a hot host costs one row per token
and task; tokens seen on fewer than ``least_pages`` pages drop out before anything is joined by host.
A host's template is bounded by its distinct tag paths: a class with a tag has at most a page's texts, and an element
at most (texts of a page) / ``support`` others.
Pages are joined with templates by host: broadcast where the table of templates is small,
else a join whose large partitions the planner can split.

Defined cases: null or empty html has the empty text; a null url or one without a
host belongs to the host ""; hosts with fewer than ``least_pages`` pages have no template, and the page
alone decides; repeated pages are treated alike; very long pages are read whole; input columns travel inside a struct, so their names
can't clash; unclosed or stray tags are tolerated, and a page cut off in the
middle gives what it has.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firn.llm.common import stored
from firn.llm.url_rules import url_host

# Elements by their role in a page.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
             "span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
FORMS = {"form", "fieldset", "dialog"}  # some sites wrap whole pages in them
RAW = set("script style noscript template textarea title iframe object svg math canvas xmp noembed noframes".split())
BOILERPLATE = set("nav footer aside form button select menu dialog head fieldset datalist audio video".split()) | RAW
LANDMARKS = ("article", "main")
LEAVES = set("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption caption tr td th ul ol dl table tbody thead tfoot "
             "figure hr address".split())
NOISE = set("ad ads advert adverts advertisement advertising sponsor sponsored banner cookie cookies consent gdpr notice "
            "notices sidebar comment comments disqus reply replies respond share sharing social related recommended promo "
            "promotion newsletter subscribe signup login menu nav navbar navigation breadcrumb breadcrumbs footer masthead "
            "toolbar popup modal overlay widget pagination pager skip hidden copyright".split())
# Of these, the words that may as well name a layout; the others name a part of a page.
LAYOUT = set("banner hidden masthead modal notice notices overlay popup skip toolbar widget".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search dialog alert menu form".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|"
                    r"<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|[^<]+|<", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([a-zA-Z-]+)""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _hash(*parts) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")) - (1 << 63)


class _Element:
    __slots__ = ("name", "path", "key", "parent", "strict", "hint", "part", "chars", "noise", "landmark")

    def __init__(self, name: str, attrs: str, parent: "_Element | None"):
        found = {}
        for k, *values, bare in _ATTR.findall(attrs) if attrs else ():
            found[(k or bare).lower()] = next((v for v in values if v), "")
        label = f"{found.get('class', '')} {found.get('id', '')}".strip()
        words = {w.lower() for w in _WORD.findall(label)}
        content = bool(words & {"article", "entry", "post", "content"})
        self.name, self.parent, self.chars = name, parent, 0
        self.strict = bool(parent and parent.strict) or name in BOILERPLATE - FORMS or _hidden(found)
        self.hint = 0  # 1: a listed word in a compound name, 2: a name that is listed
        self.part = bool(words & NOISE - LAYOUT)
        if name not in ("html", "body", "main"):
            if name in FORMS or words & NOISE or found.get("role", "").lower() in NOISE_ROLES:
                whole = not words & NOISE or NOISE & set(label.lower().split())
                self.hint = 2 if whole else 1
            elif (name == "header" or "header" in words) and not content:
                self.hint = 3 if name == "header" or "header" in label.lower().split() else 4  # not inside a landmark
        self.path = (parent.path if parent else "") + "/" + name + ("." + re.sub(r"\d+", "#", " ".join(label.split())) if label else "")
        self.key = _hash("tag", self.path)
        self.noise, self.landmark = self.strict, None


def _hidden(attrs: dict) -> bool:
    return ("hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true"
            or "display:none" in attrs.get("style", "").replace(" ", "").lower())


class Page:
    """Tokens in order, and blocks of text with where they stand."""

    def __init__(self, html: str):
        self.tokens: list[int] = []  # keys of tags and text nodes in order
        self.blocks: list[tuple] = []  # (text, holder's key, landmark, holder, noise, characters outside links, text keys)
        self._elements: list[_Element] = []
        self.paths: dict[int, str] = {}
        self.parents: dict[int, int] = {}  # element of a text token
        self._stack: list[_Element] = []
        self._text: list[str] = []
        self._keys: list[int] = []
        self._plain = 0
        skip_to = 0
        for m in _TOKEN.finditer(html):
            if m.start() < skip_to:
                continue
            name = m["name"]
            if name is None:
                said = m[0]
                if said[0] != "<" or said == "<":
                    self._say(said)
                continue
            name = name.lower()
            if m["close"]:
                self._close(name)
            else:
                self._open(name, m["attrs"])
                if name in RAW and not m["attrs"].endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, m.end())
                    self._close(name)
                    skip_to = end.end() if end else len(html)
        self._end_block()
        self._settle()

    def _open(self, name: str, attrs: str) -> None:
        if name not in INLINE:
            self._end_block()
            if name not in VOID:
                self._imply_ends(name)
        elif name == "br":
            self._text.append(" ")
        element = _Element(name, attrs, self._stack[-1] if self._stack else None)
        self.tokens.append(element.key)
        self.paths[element.key] = element.path
        if name not in VOID and not attrs.endswith("/"):
            self._stack.append(element)
            self._elements.append(element)

    def _imply_ends(self, name: str) -> None:
        ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
                "option": ("option",)}.get(name, ())
        stops = {"li": ("ul", "ol", "menu"), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",)}.get(name, ())
        for k in range(len(self._stack) - 1, -1, -1):
            at = self._stack[k].name
            if at == "p" or at in ends:
                del self._stack[k:]
                return
            if at in stops or (at not in INLINE and not ends):
                return

    def _close(self, name: str) -> None:
        if name not in INLINE:
            self._end_block()
        for k in range(len(self._stack) - 1, -1, -1):
            if self._stack[k].name == name:
                self.tokens.append(_hash("end", self._stack[k].key))
                del self._stack[k:]
                return
            if name in INLINE and self._stack[k].name not in INLINE:
                return

    def _say(self, raw: str) -> None:
        said = unescape(raw) if "&" in raw else raw
        self._text.append(said)
        if said and not said.isspace():
            key = _hash("text", self._stack[-1].path if self._stack else "", " ".join(said.split()))
            self.tokens.append(key)
            self._keys.append(key)
            self.parents[key] = self._stack[-1].key if self._stack else 0
            if not any(e.name == "a" for e in reversed(self._stack[-4:])):
                self._plain += len(said)

    def _end_block(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            holder = next((e for e in reversed(self._stack) if e.name not in INLINE and e.name not in LEAVES), None)
            top = self._stack[-1] if self._stack else None
            self.blocks.append((text, holder.key if holder else 0, top, holder, False, self._plain, tuple(self._keys)))
        self._text, self._keys, self._plain = [], [], 0

    def _mark(self) -> int:
        """Noise and landmark of every element; the characters that are not noise."""
        for e in self._elements:
            up = e.parent
            inside = up.landmark if up else None
            e.noise = e.strict or bool(up and up.noise) or e.hint in (1, 2) or (e.hint > 2 and not inside)
            e.landmark = inside or (e if e.name in LANDMARKS and not e.noise else None)
        return sum(b[5] for b in self.blocks if not (b[2] and b[2].noise))

    def _lift(self, hinted: list[_Element], total: int) -> None:
        """A name falls that would hide too much of the text around it, all elements of one path together: most of it for a
        listed word in a compound name, three quarters for a listed name or a compound that names a part of a page.  The
        listed name of a part stays."""
        groups: dict[tuple, list] = defaultdict(list)
        for e in hinted:
            around = e.parent
            while around and around.name not in LANDMARKS:
                around = around.parent
            groups[around, e.path].append(e)
        for (around, _), alike in groups.items():
            e, chars = alike[0], sum(x.chars for x in alike)
            text = around.chars if around else total
            if e.hint == 2 and e.part or e.hint == 3:
                continue
            if 4 * chars > 3 * text or (e.hint != 2 and not e.part and 2 * chars > text):
                for x in alike:
                    x.hint = 0

    def _settle(self) -> None:
        """Names are hints: one falls where it would hide the page's landmark or too much of the text around it."""
        hinted = [e for e in self._elements if e.hint and not e.strict]
        if hinted:
            total = 0
            for b in self.blocks:
                if not (b[2] and b[2].strict):
                    total += b[5]
                    if b[2]:
                        b[2].chars += b[5]
            for e in reversed(self._elements):
                if e.parent and not e.strict:
                    e.parent.chars += e.chars
            unmarked = self._mark()
            if not any(b[2] and b[2].landmark and not b[2].noise for b in self.blocks):
                best = max((e for e in self._elements if e.name in LANDMARKS and not e.strict and e.chars),
                           key=lambda e: e.chars, default=None)
                if best and best.chars >= unmarked:
                    while best:
                        best.hint, best = 0, best.parent
            self._lift(hinted, total)
        self._mark()
        if hinted and all(b[2] and b[2].noise for b in self.blocks):
            for e in hinted:
                e.hint = 0
            self._mark()
        self.blocks = [(b[0], b[1], b[2].landmark.key if b[2] and b[2].landmark else None, b[3],
                        bool(b[2] and b[2].noise), *b[5:]) for b in self.blocks]
        self._elements, self._stack = [], []

    def slots(self, template_texts: frozenset = frozenset()) -> dict[int, int]:
        """Characters outside of links, boilerplate and template texts by the element that holds them."""
        mass: dict[int, int] = defaultdict(int)
        for text, holder, landmark, _, noise, plain, keys in self.blocks:
            if not noise and not (keys and template_texts.issuperset(keys)):
                mass[landmark or holder] += plain
        return mass

    def content(self) -> int:
        """Of the texts outside of noise: equal on copies of a page."""
        return _hash("page", *[b[0] for b in self.blocks if not b[4]])

    def held(self) -> dict[int, tuple[int, int]]:
        """Text tokens with the element whose slot they are in, and their share of a block's characters."""
        found: dict[int, tuple[int, int]] = {}
        for _, holder, landmark, _, noise, plain, keys in self.blocks:
            for key in keys:
                if not noise:
                    found[key] = (landmark or holder, plain // len(keys))
        return found

    def main_text(self, ranked: dict[int, float], sure: frozenset, likely: frozenset = frozenset()) -> str:
        """``ranked``: mass of holders on a page of the host; ``sure`` and ``likely``: texts of the template."""
        texts = sure | likely
        mass = self.slots(texts) or self.slots()
        if not mass:
            return ""
        landmarks = {b[2] for b in self.blocks if b[2] and not b[4]}
        at = max(mass, key=lambda k: (ranked.get(k, mass[k]), mass[k], k in landmarks, -k))
        if at in landmarks:
            inside = [b for b in self.blocks if not b[4] and at == b[2]]
        else:
            inside = self._article(ranked, mass, texts)
        for known in (texts, sure):
            left = [b for b in inside if not (b[6] and known.issuperset(b[6]))]
            # where little is left, the text is a copy of other pages' rather than a template
            if left and (known == sure or 4 * sum(len(b[0]) for b in left) >= sum(len(b[0]) for b in inside)):
                return "\n".join(b[0] for b in left)
        return "\n".join(b[0] for b in inside)

    def _article(self, ranked: dict[int, float], mass: dict[int, int], texts: frozenset) -> list[tuple]:
        """Blocks of the least element that holds nine tenths of the slots' mass, each holder counted by its mass on the host's
        pages; and those that the elements around it hold themselves, such as a title before the article's sections.
        Landmarks are articles of their own, which had less."""
        outside = [b for b in self.blocks if not b[4] and not b[2]]
        weight: dict[_Element, float] = defaultdict(float)
        total = 0.0
        for b in outside:
            if mass.get(b[1]) and not (b[6] and texts.issuperset(b[6])):
                w = b[5] * ranked.get(b[1], mass[b[1]]) / mass[b[1]]
                total += w
                e = b[3]
                while e:
                    weight[e] += w
                    e = e.parent
        if not total and ranked:  # the host's pages have no text of their own
            return self._article({}, mass, texts)
        most = [e for e, w in weight.items() if w >= 0.9 * total]
        if not most:  # texts outside of all elements
            return outside
        at = min(most, key=lambda e: (weight[e], -len(e.path)))
        above, e = set(), at.parent
        while e:
            above.add(e)
            e = e.parent

        def in_it(e):
            while e and e is not at:
                e = e.parent
            return e is at
        return [b for b in outside if b[3] in above or b[3] is None or in_it(b[3])]


_COUNTS = ("host string, token long, pages long, times long, vector long, place double, mass long, is_text boolean, "
           "parent long, holder long, seen long, seen2 long, vector2 long")


def _count_tokens(batches):
    """Rows of one token's occurrences on a batch's pages of a host; token 0 stands for the page itself."""
    for batch in batches:
        sums: dict[tuple, list] = {}

        def add(host, token, times, page, place, mass, is_text, parent, holder, seen, seen2):
            row = sums.setdefault((host, token), [0, 0, 0, 0.0, 0, is_text, parent, holder, 0, 0, 0])
            vector = _hash(page, times)
            row[0] += 1
            row[1] += times
            row[2] ^= vector
            row[10] += vector & 0xFFFFFFF
            row[3] += place
            row[4] += mass
            row[8] |= seen
            row[9] |= seen2
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            for host, key, html in zip(*(part.column(c).to_pylist() for c in range(3))):
                page = Page(html)
                mass, places, held = page.slots(), defaultdict(list), page.held()
                content = page.content()
                bits = [(1 << n) - (1 << 64 if n == 63 else 0) for n in (content & 63, content >> 6 & 63)]
                for k, token in enumerate(page.tokens):
                    places[token].append(k)
                add(host, 0, 1, key, 0.0, 0, False, 0, 0, 0, 0)
                for token, at in places.items():
                    is_text = token in page.parents
                    holder, chars = held.get(token, (0, 0))
                    add(host, token, len(at), key, at[0] / len(page.tokens), chars if is_text else mass.get(token, 0),
                        is_text, page.parents.get(token, 0), holder, *bits)
        rows = [(h, t, *v) for (h, t), v in sums.items()]
        if rows:
            cols = list(zip(*rows))
            schema = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in _COUNTS.split(", ")])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, schema.types)], schema=schema)


_KINDS = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def host_templates(pages: DataFrame, support: float = 0.3, least_pages: int = 3) -> DataFrame:
    """``(host, tokens, classes, places, masses, texts)``, parallel arrays; ``pages`` has host, key and html.

    ``masses`` of elements are means over the pages that have them, without texts that different pages share; ``texts`` is 2 for
    texts that are sure to be template, 1 for likely ones, else 0."""
    counts = stored(pages.select("host", "key", "html").mapInArrow(_count_tokens, _COUNTS).groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.sum("times").alias("times"), F.bit_xor("vector").alias("vector"),
        F.sum("place").alias("place"), F.sum("mass").alias("mass"), F.first("is_text").alias("is_text"),
        F.max("parent").alias("parent"), F.max("holder").alias("holder"), F.bit_or("seen").alias("seen"),
        F.bit_or("seen2").alias("seen2"), F.sum("vector2").alias("vector2")).where(F.col("pages") >= least_pages), "html-tokens")
    counts = counts.withColumn("class", F.xxhash64("vector", "vector2", "pages", "times"))
    hosts = counts.where("token = 0").select("host", F.col("pages").alias("of"))
    tags = counts.where("token <> 0 AND NOT is_text")
    # different contents: at least as many as either half of their hash has values
    apart = F.greatest(F.bit_count("seen"), F.bit_count("seen2")) >= least_pages
    texts = counts.where(F.col("is_text") & (F.col("times") == F.col("pages")) & apart)
    # texts of several pages are no evidence of an article, whether they make it into the template or not
    said = texts.groupBy("host", F.col("holder").alias("token")).agg(F.sum("mass").alias("said"))
    elements = tags.select("host", F.col("token").alias("parent"), F.col("pages").alias("parent_pages"))
    tagged = tags.select("host", "class").distinct().withColumn("tagged", F.lit(True))
    texts = (texts.join(elements, ["host", "parent"], "left").join(tagged, ["host", "class"], "left").join(hosts, "host")
             .withColumn("tagged", F.coalesce("tagged", F.lit(False)))
             .where(F.col("tagged") | (F.col("pages") >= support * F.coalesce("parent_pages", "of")))
             .withColumn("text", F.when(F.col("tagged") & (2 * F.col("pages") > F.col("of")), 2).otherwise(1)))
    tags = tags.join(said, ["host", "token"], "left").withColumn(
        "mass", F.greatest(F.lit(0), F.col("mass") - F.coalesce("said", F.lit(0)))).withColumn("text", F.lit(0))
    one = F.struct("token", "class", (F.col("place") / F.col("pages")).alias("place"),
                   (F.col("mass") / F.col("pages")).alias("mass"), "text")
    columns = ["host", "token", "class", "place", "pages", "mass", "text"]
    both = tags.select(columns).unionByName(texts.withColumn("mass", F.lit(0).cast("long")).select(columns))
    grouped = both.groupBy("host").agg(F.sort_array(F.collect_list(one)).alias("t"))
    return grouped.select("host", F.col("t.token").alias("tokens"), F.col("t.class").alias("classes"),
                          F.col("t.place").alias("places"), F.col("t.mass").alias("masses"), F.col("t.text").alias("texts"))


class Template:
    """A host's classes, each in order, and the mass of its elements."""

    def __init__(self, tokens=(), classes=(), places=(), masses=(), texts=()):
        self.ranked = dict(zip(tokens, masses))
        self.texts = {t for t, x in zip(tokens, texts) if x}
        self.sure = frozenset(t for t, x in zip(tokens, texts) if x == 2)
        self.classes = defaultdict(list)
        for _, c, t in sorted(zip(places, classes, tokens)):
            self.classes[c].append(t)
        self.class_of = dict(zip(tokens, classes))

    def valid_texts(self, page: Page) -> frozenset:
        """Text tokens of the classes that are ordered and nested on the page."""
        if not self.texts:
            return frozenset()
        seen = defaultdict(list)
        for t in page.tokens:
            if t in self.class_of:
                seen[self.class_of[t]].append(t)
        ordered = {c for c, ts in seen.items() if ts == self.classes[c] or _repeats(ts, self.classes[c])}
        # nested: of two classes that cross, the shorter one is not part of the template
        spans: dict[int, tuple[int, int]] = {}
        for k, t in enumerate(page.tokens):
            c = self.class_of.get(t)
            if c in ordered:
                spans[c] = (spans.get(c, (k, k))[0], k)
        kept: list[int] = []
        for c in sorted(ordered, key=lambda c: (spans[c][0] - spans[c][1], c)):
            a, b = spans[c]
            if not any(x < a <= y < b or a < x <= b < y for x, y in map(spans.get, kept)):
                kept.append(c)
        return frozenset(t for c in kept for t in self.classes[c] if t in self.texts)


def _repeats(seen: list[int], order: list[int]) -> bool:
    n = len(order)
    return len(seen) % n == 0 and all(seen[k:k + n] == order for k in range(0, len(seen), n))


def extract(pages: DataFrame, keep: list[str], url_col: str = "url", html_col: str = "html", support: float = 0.3,
            least_pages: int = 3) -> DataFrame:
    """``row`` (a struct of the columns in ``keep``) and the main text of every page."""
    rows = pages.select(F.struct(*keep).alias("row"), url_host(F.col(url_col)).alias("host"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    keyed = rows.select("host", "html", F.xxhash64("row", "html").alias("key"))
    templates = stored(host_templates(keyed, support, least_pages), "html-templates")
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("main_text", T.StringType())])
    names = ["tokens", "classes", "places", "masses", "texts"]

    def run(batches):
        known: dict[str, Template] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                out = []
                for k, (host, html) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    if host not in known:
                        if len(known) >= 2000:
                            known.clear()
                        known[host] = Template(*(part.column(c + 3)[k].as_py() or () for c in range(len(names))))
                    page, template = Page(html), known[host]
                    valid = template.valid_texts(page)
                    out.append(page.main_text(template.ranked, valid & template.sure, valid))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], names=schema.names)
    return rows.join(templates, "host", "left").select("row", "host", "html", *names).mapInArrow(run, schema)
