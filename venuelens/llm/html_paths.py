"""Main text of web pages by consensus host paths.

1. Each page is parsed into blocks of text and the containers that hold them. A container's
   path joins the generalised names (tag, classes without digits) from the root down, kept as a
   rolling 64-bit hash. A page whose running text (text outside boilerplate and outside links)
   lies for the most part in an <article> or <main> votes for the outermost one around it.
2. On the pages without one, a block that stands with equal text on more than half of the
   host's different pages (of four or more) is site text. It has no say on a page unless it
   makes up more than half of that page. Such a page votes for the deepest container that
   holds all its other running text and headings.
3. The running text under a page's choice counts for (host, path); votes are summed per host in
   Spark. Every page takes the path with most votes on its host among those it has itself
   (with running text or headings), and its text is extracted again under that path. Outside
   an <article> or <main> it climbs to the ancestor that holds the page's headings and the
   running text beside the path, and site text is left out.

The html is read by two scans and shuffled once, by page and never by host, so a host with a
third of all pages costs nothing special; the small (host, path) and (host, block) rows are
salted by page. A page gives one row of hashes a container and block, linear in its html.

Left out at any depth: scripts, styles, templates, forms, menus, headers outside the article,
footers, sidebars, notices, adverts, comments and hidden parts, by tag, role, class or id; but
never by class or id alone an element that holds more than half of the page's running text
and has no <article> or <main> with text beside it. Inside an <article> or <main> a word that
also names subjects (``WEAK``) marks boilerplate only beside words of layout, and never a
<section> of paragraphs named by one of ``SUBJECTS``.
Character references are decoded, white space in a block becomes one space, blocks are
trimmed and joined by line feeds in page order; an empty block is none. The text of formulas
stays, without their annotations.

Null or empty html, or a page without text: empty text. Broken markup is read as browsers
do: open elements end with the page. A null url has the empty host. Repeated rows are
extracted alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterable, Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.llm.common import pages, prepare
from venuelens.llm.url_filter import host

#: Share of the page's running text that a candidate must hold.
MOST = 0.8
#: Salts for the rows of one (host, path) or (host, block).
SALTS = 32
#: Different pages of a host, at least, before a block can be its site text.
SITE_PAGES = 4

# fixed values: element names of HTML by their role here
RAW = frozenset("script style noscript template svg textarea select iframe title object canvas audio video annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr img br input button math semantics mrow mi mo mn ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom mfenced msub msup "
    "msubsup munder mover munderover mmultiscripts mtable mtr mtd".split()
)
CONTAINERS = frozenset("body div article main section td center table tbody tr".split())
DROPPED = frozenset("head nav footer aside form button menu dialog fieldset".split())
#: Words of class or id that mark boilerplate.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup "
    "modal overlay menu menus nav navbar navigation breadcrumb breadcrumbs masthead footer sidebar aside widget widgets related recommended "
    "recommendations share sharing social comment comments discussion respond reply replies disqus newsletter subscribe signup login search form "
    "pagination pager toolbar copyright topbar sitemap skiplink".split()
)
#: Those among them that also name subjects, and those that may head a section of an article.
WEAK = frozenset("discussion social search form related recommended share sharing comment reply respond".split())
SUBJECTS = frozenset("discussion social search form".split())
#: Words of layout, which add nothing to a name.
LAYOUT = frozenset(
    "area articles bar block body bottom box btn button buttons col column container content count footer group header icon icons inline inner item "
    "items left link links list main media module mobile network networks outer page panel post posts reader row section site sticky stories story "
    "text thread title tool tools top unit user wrap wrapper".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(sorted(RAW)) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)>"
    r"|<[!?/][^>]*>"
    r"|<(?=[a-zA-Z/!?])[^>]*\Z",
    re.S | re.I,
)
_ATTR = re.compile(r"""\b(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I | re.S)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HEADING = re.compile(r"h[1-6]\Z")


def _left_out(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    """Boilerplate by tag or role, or hidden: it never comes back."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if not attrs or tag in ("html", "body", "main", "article"):
        return "hidden" in attrs and tag not in ("html", "body")
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I))


def _named(tag: str, attrs: dict[str, str], in_article: bool) -> str:
    """The word of its class or id that marks boilerplate, or nothing."""
    if not attrs or tag in ("html", "body", "main", "article"):
        return ""
    if tag in ("span", "a", "b", "i", "em", "strong"):
        return ""
    for name in (*attrs.get("class", "").split(), attrs.get("id", "")):
        words = _WORD.findall(_CAMEL.sub(" ", name).lower())
        layout = all(w in BOILERPLATE or w in LAYOUT or len(w) < 3 or w.isdigit() for w in words)
        for i, word in enumerate(words):
            if in_article and word in WEAK and not layout:
                continue
            if (word in BOILERPLATE or (word == "header" and not in_article)) and not (i and words[i - 1] in ("no", "has", "with", "without")):
                return word
    return ""


def _general(tag: str, attrs: dict[str, str]) -> str:
    """A container's name: its tag and classes, digits generalised."""
    names = sorted({re.sub(r"[0-9]+", "", c.lower()) for c in attrs.get("class", "").split()})
    return ".".join([tag, *(n for n in names if n)])


class Page:
    """blocks: (container, text, characters outside links, heading or not); containers: (name, parent, tag)."""

    def __init__(self, html: str):
        self.blocks: list[tuple[int, str, int, bool]] = []
        self.containers: list[tuple[str, int, str]] = [("", -1, "")]
        stack: list[tuple[str, int, bool, bool]] = []  # tag, container, dropped, inside an article
        container, dropped, article, links, heads = 0, False, False, 0, 0
        named: set[int] = set()  # containers that look like boilerplate by class or id
        subjects: set[int] = set()  # those of them that a paragraph of running text redeems
        paragraphs: set[int] = set()  # containers with such a paragraph
        opened: Counter[str] = Counter()  # open elements by tag
        pieces: list[str] = []
        free = 0

        def close_block() -> None:
            nonlocal free
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self.blocks.append((container, text, min(free, len(text)), heads > 0))
                    if free and subjects and opened["p"]:
                        paragraphs.add(container)
                pieces.clear()
            free = 0

        def state() -> tuple[int, bool, bool]:
            return stack[-1][1:] if stack else (0, False, False)

        def add(text: str) -> None:
            nonlocal free
            if not dropped and text:
                text = unescape(text)
                pieces.append(text)
                if not links:
                    free += len(text)

        def pop_to(at: int) -> None:
            """Ends the open elements from ``at`` on."""
            nonlocal container, dropped, article, links, heads
            if any(x[0] not in INLINE or x[1] in named for x in stack[at:]):
                close_block()
            opened.subtract(x[0] for x in stack[at:])
            links -= sum(x[0] == "a" for x in stack[at:])
            heads -= sum(bool(_HEADING.match(x[0])) for x in stack[at:])
            del stack[at:]
            container, dropped, article = state()

        def last(names: tuple[str, ...], stop: tuple[str, ...]) -> int | None:
            for at in range(len(stack) - 1, -1, -1) if any(opened[x] for x in names) else ():
                if stack[at][0] in names:
                    return at
                if stack[at][0] in stop:
                    return None
            return None

        begin = 0
        for m in _TOKEN.finditer(html):
            if m.start() > begin:
                add(html[begin: m.start()])
            begin = m.end()
            tag = m["tag"] or m["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            if m["end"] or m["end2"]:
                at = last((tag,), ())
                if at is not None:
                    pop_to(at)
                elif tag == "p":
                    close_block()
                continue
            if tag in VOID:
                if tag in ("br", "wbr"):
                    add(" " if tag == "br" else "")
                elif tag == "hr":
                    close_block()
                continue
            raw = m["attrs"] or m["attrs2"] or ""
            attrs = {a.lower(): (x or y or z) for a, x, y, z in _ATTR.findall(raw)} if raw else {}
            if tag not in INLINE:
                if tag == "body" and (at := last(("head",), ())) is not None:
                    pop_to(at)
                if (at := last(("p",), ("div", "td", "th", "li", "article", "section", "blockquote", "body", "table"))) is not None:
                    pop_to(at)
                if tag == "li" and (at := last(("li",), ("ul", "ol"))) is not None:
                    pop_to(at)
                if tag in ("dt", "dd") and (at := last(("dt", "dd"), ("dl",))) is not None:
                    pop_to(at)
                if tag in ("td", "th") and (at := last(("td", "th"), ("tr", "table"))) is not None:
                    pop_to(at)
                if tag == "tr" and (at := last(("tr",), ("table",))) is not None:
                    pop_to(at)
                close_block()
            drop = dropped or _left_out(tag, attrs, article)
            by_name = "" if drop else _named(tag, attrs, article)
            if (drop and not dropped) or by_name:
                close_block()
            if not drop and (by_name or tag in CONTAINERS):
                self.containers.append((_general(tag, attrs), container, tag))
                container = len(self.containers) - 1
                if by_name:
                    named.add(container)
                    if article and tag == "section" and by_name in SUBJECTS:
                        subjects.add(container)
            dropped, article = drop, article or tag in ("article", "main")
            links += tag == "a"
            heads += bool(_HEADING.match(tag))
            if raw.endswith("/") and tag not in INLINE and not attrs and tag not in CONTAINERS:
                container, dropped, article = state()
                continue
            stack.append((tag, container, dropped, article))
            opened[tag] += 1
        add(html[begin:])
        close_block()
        if named:
            if subjects:
                marks = [int(c in paragraphs) for c in range(len(self.containers))]
                named -= {c for c, n in enumerate(self._summed(marks)) if n and c in subjects}
            self._drop(named)
        self.marks = self._marks()
        self.hashes = [0]
        for name, parent, _ in self.containers[1:]:
            self.hashes.append(xxhash.xxh64_intdigest(name, self.hashes[parent]))

    def _drop(self, named: set[int]) -> None:
        """Takes out the ``named`` containers, with all they hold, but for wrappers.

        A wrapper holds more than half of the running text, and no <article> or <main> beside it holds any.
        """
        weight = self.weights()
        marks = self._marks()
        free = [True]  # of named ancestors
        for c in range(1, len(self.containers)):
            free.append(free[self.containers[c][1]] and c not in named)
        beside = any(n and free[c] and marks[c] for c, _, n, _ in self.blocks)
        at, kept = [0], [self.containers[0]]
        for c, (name, parent, tag) in enumerate(self.containers[1:], 1):
            up = at[parent]
            if up < 0 or (c in named and (2 * weight[c] <= weight[0] or (beside and not marks[c]))):
                at.append(-1)
            elif tag in CONTAINERS:
                at.append(len(kept))
                kept.append((name, up, tag))
            else:
                at.append(up)
        self.containers = kept
        self.blocks = [(at[c], *rest) for c, *rest in self.blocks if at[c] >= 0]

    def _marks(self) -> list[int]:
        """For each container the outermost <article> or <main> around it, or 0."""
        out = [0]
        for c, (_, parent, tag) in enumerate(self.containers[1:], 1):
            out.append(out[parent] or (c if tag in ("article", "main") else 0))
        return out

    def _summed(self, out: list[int]) -> list[int]:
        for c in range(len(out) - 1, 0, -1):
            out[self.containers[c][1]] += out[c]
        return out

    def site(self, texts: Iterable[int]) -> set[str]:
        """The blocks' texts with hashes among ``texts``, unless they make up more than half of the page."""
        texts = set(texts)
        found = {t for _, t, _, _ in self.blocks if texts and _text_hash(t) in texts}
        return found if 2 * sum(n for _, t, n, _ in self.blocks if t in found) <= sum(n for _, _, n, _ in self.blocks) else set()

    def weights(self, site: Collection[str] = ()) -> list[int]:
        """Running text under each container."""
        out = [0] * len(self.containers)
        for c, t, free, _ in self.blocks:
            if t not in site:
                out[c] += free
        return self._summed(out)

    def headings(self, site: Collection[str] = ()) -> list[int]:
        """Blocks of headings under each container."""
        out = [0] * len(self.containers)
        for c, t, _, heading in self.blocks:
            if t not in site:
                out[c] += heading
        return self._summed(out)

    def path(self, c: int) -> str:
        names = []
        while c > 0:
            names.append(self.containers[c][0])
            c = self.containers[c][1]
        return "".join(">" + n for n in reversed(names))

    def article(self) -> int:
        """The outermost <article> or <main> around the deepest container with most of the running text, or 0."""
        weight = self.weights()
        best = 0
        for c in range(1, len(weight)):
            if weight[c] and weight[c] >= MOST * weight[0] and self.containers[c][1] == best:
                best = c
        return self.marks[best]

    def candidate(self, site: Collection[str] = ()) -> tuple[int, int]:
        """(container, running text) of the page's own choice."""
        weight = self.weights(site)
        best = self.article()
        if not best:
            heads = self.headings(site)
            for c in range(1, len(weight)):
                if weight[c] and weight[c] == weight[0] and heads[c] == heads[0] and self.containers[c][1] == best:
                    best = c
        return best, weight[best]

    def text(self, path: int, site: Collection[str] = ()) -> tuple[str, str]:
        """(text, path): the blocks under containers with the hash ``path``, or under the ancestor that also holds what they leave out, in page order."""
        direct = {c for c, t, free, _ in self.blocks if free and t not in site}
        heads = self.headings(site)
        highest = [-1]  # ancestor with running text of its own or headings beside the way up
        for c, (_, parent, _) in enumerate(self.containers[1:], 1):
            here = parent if parent in direct or heads[parent] > heads[c] else -1
            highest.append(highest[parent] if highest[parent] >= 0 else here)
        roots = {c if self.marks[c] or highest[c] < 0 else highest[c] for c, h in enumerate(self.hashes) if h == path}
        inside = [False] * len(self.containers)
        for c, (_, parent, _) in enumerate(self.containers):
            inside[c] = c in roots or (parent >= 0 and inside[parent])
        text = "\n".join(t for c, t, _, _ in self.blocks if inside[c] and (t not in site or self.marks[c]))
        return text, self.path(min(roots, default=0))

    def depths(self) -> list[int]:
        out = [0]
        for _, parent, _ in self.containers[1:]:
            out.append(out[parent] + 1)
        return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _text_hash(text: str) -> int:
    return _signed(xxhash.xxh64_intdigest(text))


def _paths_of(page: Page, own: int, weight: int, site: Collection[str] = ()) -> list[dict]:
    """(path, depth, votes) of each different path with running text or headings, and of the root."""
    weights, heads, depth = page.weights(site), page.headings(site), page.depths()
    found = {h: (depth[c], 0) for c, h in enumerate(page.hashes) if not c or weights[c] or heads[c]}
    found[page.hashes[own]] = (depth[own], weight)
    return [{"path": _signed(h), "depth": d, "votes": v} for h, (d, v) in found.items()]


_PATHS = pa.list_(pa.struct([("path", pa.int64()), ("depth", pa.int32()), ("votes", pa.int64())]))
_PATHS_DDL = "paths array<struct<path: long, depth: int, votes: long>>"
_BLOCKS = pa.list_(pa.struct([("text", pa.int64()), ("container", pa.int32()), ("free", pa.int64()), ("heading", pa.bool_())]))
_NODES = pa.list_(pa.struct([("path", pa.int64()), ("parent", pa.int32())]))


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A page with an article gives its votes, another one its blocks and containers as hashes."""
    for batch in batches:
        found, blocks, nodes = [], [], []
        for html in batch.column("html").to_pylist():
            page = Page(html or "")
            if page.article():
                found.append(_paths_of(page, *page.candidate()))
                blocks.append(None)
                nodes.append(None)
            else:
                found.append(None)
                blocks.append([{"text": _text_hash(t), "container": c, "free": n, "heading": h} for c, t, n, h in page.blocks])
                nodes.append([{"path": _signed(h), "parent": up} for h, (_, up, _) in zip(page.hashes, page.containers)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("host"), pa.array(found, _PATHS), pa.array(blocks, _BLOCKS), pa.array(nodes, _NODES)],
            ["key", "host", "paths", "blocks", "nodes"],
        )


class Digest(Page):
    """A page without an article, from the hashes of its blocks and containers."""

    def __init__(self, blocks: list[dict], nodes: list[dict]):
        self.blocks = [(b["container"], b["text"], b["free"], b["heading"]) for b in blocks]
        self.containers = [("", n["parent"], "") for n in nodes]
        self.hashes = [n["path"] & 0xFFFFFFFFFFFFFFFF for n in nodes]
        self.marks = [0] * len(nodes)

    def site(self, texts: Iterable[int]) -> set[int]:
        found = set(texts)
        return found if 2 * sum(n for _, t, n, _ in self.blocks if t in found) <= sum(n for _, _, n, _ in self.blocks) else set()


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for blocks, nodes, texts in zip(*(batch.column(name).to_pylist() for name in ("blocks", "nodes", "site"))):
            page = Digest(blocks, nodes)
            site = page.site(texts or ())
            found.append(_paths_of(page, *page.candidate(site), site))
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("host"), pa.array(found, _PATHS)], ["key", "host", "paths"])


def _salted(small: DataFrame) -> DataFrame:
    return small.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))


def site_blocks(bare: DataFrame) -> DataFrame:
    """(key, site): hashes of the site text on each page of ``bare(key, host, blocks)``."""
    texts = bare.select("key", "host", F.xxhash64("blocks").alias("content"), F.array_distinct("blocks.text").alias("texts"))
    pages_ = texts.groupBy("host", "content").agg(F.max("texts").alias("texts"))
    total = pages_.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SITE_PAGES)
    seen = pages_.select("host", F.explode("texts").alias("text")).groupBy("host", "text").agg(F.count(F.lit(1)).alias("times"))
    seen = seen.where(F.col("times") * 2 > SITE_PAGES).withColumn("salt", F.pmod("text", F.lit(SALTS)))
    site = seen.join(_salted(total), ["host", "salt"]).where(F.col("times") * 2 > F.col("n")).select("host", "text")
    each = texts.select("key", "host", F.explode("texts").alias("text"), F.pmod("key", F.lit(SALTS)).alias("salt"))
    return each.join(_salted(site), ["host", "text", "salt"]).groupBy("key").agg(F.collect_set("text").alias("site"))


def paths(keyed: DataFrame) -> DataFrame:
    """(key, path, site): the winning path of each page of ``keyed(key, host, html)`` and the hashes of its site text."""
    schema = f"key long, host string, {_PATHS_DDL}"
    parsed = f"{schema}, blocks array<struct<text: long, container: int, free: long, heading: boolean>>, nodes array<struct<path: long, parent: int>>"
    seen = keyed.select("key", "host", "html").mapInArrow(_parse_batches, parsed).checkpoint()
    bare = seen.where(F.col("blocks").isNotNull())
    site = site_blocks(bare).checkpoint()
    voted = bare.join(site, "key", "left").select("key", "host", "blocks", "nodes", "site").mapInArrow(_digest_batches, schema)
    votes = seen.where(F.col("blocks").isNull()).select("key", "host", "paths").unionByName(voted)
    votes = votes.select("key", "host", F.inline("paths"))
    tally = votes.where("votes > 0").groupBy("host", "path").agg(F.sum("votes").alias("total"))
    counted = votes.withColumn("salt", F.pmod("key", F.lit(SALTS))).join(_salted(tally), ["host", "path", "salt"], "left")
    chosen = counted.groupBy("key").agg(F.max_by("path", F.struct(F.coalesce("total", F.lit(0)).alias("total"), "depth", "path")).alias("path"))
    return chosen.join(site, "key", "left")


def extract(pages_: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, path) of every row of ``pages_``."""
    prepare(pages_.sparkSession)
    rows = pages_.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = rows.withColumn("host", host(F.col("url"))).withColumn("key", F.xxhash64("page_id", "url", "html"))
    chosen = paths(keyed)
    kind = pages_.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, names = [], []
            for html, path, site in zip(*(batch.column(name).to_pylist() for name in ("html", "path", "site"))):
                page = Page(html or "")
                text, name = page.text(path & 0xFFFFFFFFFFFFFFFF, page.site(site or ()))
                texts.append(text)
                names.append(name)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(names, pa.string())],
                ["page_id", "url", "text", "n_chars", "path"],
            )

    joined = keyed.select("key", "page_id", "url", "html").join(chosen, "key", "left").select("page_id", "url", "html", "path", "site")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, path string")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(pages(spark, sf_dir))


QUERIES = {"op6_html_host_paths": op6_html}
