"""Main text of web pages by containers that the pages of a host agree on.

Each page is read twice. First its containers are scored (``score``): a container earns the characters outside
links of the blocks right below it in full, of deeper ones in part, more if its tag or names speak of an article. A
container's generalised path is the tags and classes from the root, without places, and without class names that
hold digits (they change from page to page). Each page votes for its paths with their shares of its best score.

Votes are added up in Spark by (host, path): a path's standing is the sum of its shares over its pages plus
``DOUBT``, times a low power of the part of the host's pages that have it, so that what only some pages have (long
unnamed comments) yields to what they share, while the article of a rarer template still beats the whole body. Paths on ``SUPPORT`` of a host's pages (and on two at
least) stay: a page has few paths, so this bounds the list of a host whatever its size. Then each page is read again
with the list of its host, and its text is taken from all containers of the path that stands highest among those it
has; a page without one (or without a host) uses its own best. Votes are added before the shuffle, so a host with a
third of all pages is a few rows a task; the winning paths are written, so Spark knows their size when it chooses
between a broadcast and a shuffle join, and the latter splits a hot host's pages.

Inside the containers, elements that are not the article are left out: navigation, forms, scripts, styles, asides,
footers, hidden ones, lists that are mostly links, and those whose class, id or role names a menu, an advert, a
notice, comments and so on (``NOISE``). A header stays where it belongs to the article.

Text: character references are decoded, white space (also no-break space) inside a block becomes one space, blocks
are trimmed and joined by one line feed. ``br`` is white space; cells and list items are blocks.

Defined results: null and empty html give an empty text; pages without a host (null or odd urls) vote for nothing;
repeated rows give equal rows; no rows, no result. Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.storage import new_folder

#: Elements nested deeper than this count as children of the one at this depth, as in browsers.
DEEPEST = 512
#: Pages (in thought) without a path, against paths that few pages have.
DOUBT = 2.0
#: Power of the part of the host's pages that have a path, in its standing.
SPREAD = 0.15
#: A path must be on this part of a host's pages to stay.
SUPPORT = 0.01
#: A path votes if it has this share of its page's best score.
SHARE = 0.2
#: What a container gets of the blocks one, two, three ... levels below those right under it.
DECAY = (1.0, 0.5, 0.4, 0.35, 0.3)
#: Lists and boxes with this part of their characters in links (three at least) are menus.
LINKED = 0.8

# Element names of HTML, and words that name parts of pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noframes".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul""".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that hold text; all other blocks may be containers.
LEAVES = HEADINGS | frozenset("p pre li dt dd th tr tbody thead tfoot table ul ol dl caption figcaption figure blockquote address summary details hr option legend".split())
SILENT = frozenset(
    """head script style noscript template iframe object embed applet svg math canvas audio video map textarea select option optgroup button form input
    nav aside footer dialog menu search title xmp noframes datalist progress meter""".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist tooltip status".split())
NOISE = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adunit sponsor sponsored sponsors promo promos promotion promoted outbrain taboola
    banner cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay lightbox toast paywall
    newsletter subscribe subscription signup signin login register donate donation
    sidebar sidebars side aside rail widget widgets nav navi navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs pager pagination paging toc
    footer foot footnav colophon copyright legal masthead topbar toolbar bottombar skip skiplink
    share sharing sharebar social socials follow like likes related recommended recommendations recommendation suggestions suggested trending popular more
    comment comments commentlist disqus respond reply replies discussion feedback responses reviews guestbook
    search searchbox form forms hidden print noprint rating ratings tags tagcloud""".split()
)
#: Names that make a header or a noisy word part of the article.
ARTICLE = frozenset("article articlebody post entry content contents story text body main page single blogpost prose copy".split())
STRONG = frozenset("articlebody article story prose entry post".split())
#: A name that begins so tells what is there or not, not what the element is.
ABOUT = frozenset("has have with without no is not hide hides show shows can js".split())
#: End tags that may be missing: the element ends where one of these begins.
ENDS = {
    "p": BLOCKS - {"option", "optgroup", "caption", "body", "html", "legend", "summary", "tbody", "thead", "tfoot", "tr", "td", "th", "figcaption"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
}
#: An implied end does not look beyond these.
FENCES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "thead": {"table"}, "tbody": {"table"}}

TOKEN = re.compile(r"""<(?:!--(?P<comment>-?>|.*?(?:--!?>|\Z))|!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|[!?][^>]*+>?|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+)(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=>/"']++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
READ = frozenset("class id role style hidden aria-hidden itemprop".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


@dataclass(slots=True)
class Element:
    tag: str
    path: str
    parent: Element | None
    depth: int
    silent: bool  # not the article, by its tag or attributes, or inside such an element
    weight: float
    earned: float = 0.0
    chars: int = 0  # all characters in it that are not silent
    headed: int = 0  # of these, in headings
    container: bool = False
    number: int = 0


@dataclass(slots=True)
class Block:
    owner: Element
    text: list = field(default_factory=list)
    linked: int = 0
    links: int = 0


def _attributes(rest: str) -> dict:
    found: dict[str, str] = {}
    if "=" in rest or "hidden" in rest:
        for name, *values in ATTRIBUTE.findall(rest):
            if name.lower() in READ:
                found.setdefault(name.lower(), html.unescape("".join(values)))
    return found


def _noisy(names: str) -> bool:
    """Whether a class or id attribute names something that is not the article."""
    for name in names.split():
        words = [w.lower() for w in WORDS.findall(name)]
        if not words or words[0] in ABOUT:
            continue
        if "header" in words and (not ARTICLE.intersection(words) or words[0] in ("page", "main")):
            return True
        if NOISE.intersection(words):
            return True
    return False


def _step(tag: str, classes: str) -> str:
    names = sorted({c for c in classes.split() if not any(ch.isdigit() for ch in c)})
    return ".".join([tag, *names])


class Page:
    """Elements and blocks of one page, in order; names say nothing about the elements in ``trusted`` (None: about all)."""

    def __init__(self, source: str, trusted: frozenset | None = frozenset()):
        self.trusted, self.number = trusted, 0
        self.misjudged: set[int] = set()
        self.suspect, self.held = None, [0, 0]
        root = Element("", "", None, 0, False, 1.0)
        self.elements, self.blocks, self.boxes = [root], [], {}
        self.open, self.block, self.links = [root], None, 0
        self.opened: Counter = Counter()
        at = 0
        while at < len(source):
            less = source.find("<", at)
            if less < 0:
                self._text(source[at:])
                break
            if less > at:
                self._text(source[at:less])
            m = TOKEN.match(source, less)
            if m is None:
                self._text("<")
                at = less + 1
                continue
            at = m.end()
            tag = m["tag"]
            if tag is None:
                if m["cdata"]:
                    self._text(m["cdata"], plain=True)
                continue
            tag = tag.lower()
            if m["end"]:
                self._close(tag)
                continue
            self._open(tag, m["rest"])
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>?", re.I).search(source, at)
                at = end.end() if end else len(source)
                self._close(tag)

    def _text(self, text: str, plain: bool = False) -> None:
        owner = self.open[-1]
        if owner.silent:
            return
        if not plain and "&" in text:
            text = html.unescape(text)
        if self.block is None:
            if text.isspace():
                return
            k = min(len(self.open), DEEPEST) - 1
            while k and self.open[k].tag not in BLOCKS:
                k -= 1
            self.block = Block(self.open[k])
            self.blocks.append(self.block)
        self.block.text.append(text)
        if self.links:
            self.block.linked += len(text.strip())
            self.block.links += 1

    def _open(self, tag: str, rest: str) -> None:
        if tag == "br":
            if self.block is not None:
                self.block.text.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self.block = None
            return
        if tag in BLOCKS:
            self._imply(tag)
            self.block = None
        parent = self.open[min(len(self.open), DEEPEST) - 1]
        at = _attributes(rest)
        names = at.get("class", "")
        outer = tag in ("html", "body", "main", "article")
        silent = self.open[-1].silent or tag in SILENT or "hidden" in at or at.get("aria-hidden", "").lower() == "true" or bool(UNSEEN.search(at.get("style", "")))
        named = False
        self.number += 1
        if not silent and not outer:
            if tag == "header":
                silent = not any(e.tag in ("article", "main") or e.weight >= 1.6 for e in self.open)
            if not silent and self.trusted is not None and self.number not in self.trusted:
                silent = at.get("role", "").lower() in ROLES or (tag not in HEADINGS and _noisy(f"{names} {at.get('id', '')}"))
                named = silent
        if tag in BLOCKS:
            step = _step(tag, names)
            words = {w.lower() for w in WORDS.findall(f"{names} {at.get('id', '')}")} | {"".join(c for c in n.lower() if c.isalpha()) for n in f"{names} {at.get('id', '')} {at.get('itemprop', '')}".split()}
            weight = 2.2 if tag in ("article", "main") or at.get("role", "").lower() in ("main", "article") or "articlebody" in words else 1.6 if STRONG & words else 1.3 if ARTICLE & words else 1.0
            element = Element(tag, f"{parent.path}>{step}" if parent.path else step, parent, parent.depth + 1, silent, weight, container=tag not in LEAVES)
            self.elements.append(element)
        else:
            element = Element(tag, parent.path, parent, parent.depth, silent, 1.0)
            if tag == "a":
                self.links += 1
        element.number = self.number
        self.open.append(element)
        self.opened[tag] += 1
        if named:
            self.suspect, self.held = element, [0, 0]
        elif self.suspect is not None:
            self.held[0] += tag == "h1"
            self.held[1] += tag == "p"
            if tag == "main":
                self.misjudged.add(self.suspect.number)

    def _imply(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            own = self.open[k].tag
            if tag in ENDS.get(own, ()):
                self._drop(k)
            elif own in BLOCKS and (own not in ENDS or tag in FENCES.get(own, ())):
                return
            if own in ("ul", "ol", "dl", "table", "select"):
                return

    def _close(self, tag: str) -> None:
        if not self.opened[tag]:
            self.block = None if tag == "p" else self.block
            return
        for k in range(len(self.open) - 1, 0, -1):
            own = self.open[k].tag
            if own == tag:
                self._drop(k)
                return
            # an inline end tag does not close blocks; a cell or item does not close what holds its table or list
            if (tag not in BLOCKS and own in BLOCKS) or (own == "table" and tag not in ("table", "body", "html", "div", "article", "section", "main")):
                return

    def _drop(self, k: int) -> None:
        for e in self.open[k:]:
            self.opened[e.tag] -= 1
            if e.tag == "a":
                self.links -= 1
            if e.tag in BLOCKS:
                self.block = None
            if e is self.suspect:
                if self.held[0] and self.held[1] >= 2:  # a title and paragraphs: this is no menu
                    self.misjudged.add(e.number)
                self.suspect = None
        del self.open[k:]

    def settle(self) -> None:
        """Drop lists and boxes of links, and add up what the containers earn."""
        sums: dict[int, list] = {}
        texts = []
        for block in self.blocks:
            text = " ".join("".join(block.text).split())
            texts.append(text)
            e = block.owner
            while e is not None:
                if e.tag in ("ul", "ol", "div", "section", "dl", "table") and e.weight <= 1:
                    s = sums.setdefault(id(e), [0, 0, 0])
                    s[0] += len(text)
                    s[1] += min(block.linked, len(text))
                    s[2] += block.links
                e = e.parent
        menus = {k for k, (chars, linked, links) in sums.items() if links >= 3 and linked >= LINKED * chars}
        lines = []
        for block, text in zip(self.blocks, texts, strict=True):
            if text:
                lines.append((block, text, []))
                e = block.owner
                while e is not None:
                    lines[-1][2].append(e)
                    e = e.parent
        inner = [x for x in lines if not any(id(e) in menus for e in x[2])]
        self.kept = []
        for block, text, line in inner or lines:
            own = max(0, len(text) - block.linked)
            self.kept.append((text, line))
            head = any(e.tag in HEADINGS for e in line)
            level = 0
            for e in line:
                e.chars += len(text)
                e.headed += len(text) if head else 0
                if e.container:
                    e.earned += own * DECAY[min(level, len(DECAY) - 1)]
                    level += 1

    def scores(self) -> dict[str, float]:
        """Score of each container path; a container that only adds headings to another one takes its place."""
        own = {}
        for e in self.elements:
            if e.container and not e.silent and e.earned:
                own[id(e)] = e.earned * e.weight
        for e in reversed(self.elements):
            if id(e) not in own:
                continue
            up = e.parent
            while up is not None and not up.container:
                up = up.parent
            if up is not None and up.path and up.tag != "html" and id(up) in own and up.chars > e.chars and up.chars - e.chars <= up.headed - e.headed:
                own[id(up)] = max(own[id(up)], own[id(e)] * 1.01)
        found: dict[str, float] = {}
        for e in self.elements:
            if id(e) in own and e.path:
                found[e.path] = found.get(e.path, 0.0) + own[id(e)]
        return found

    def text(self, path: str) -> str:
        return "\n".join(text for text, line in self.kept if any(e.path == path and e.container for e in line))


def read_page(source: str | None) -> Page:
    """A page with its text settled; names that cover the page's body, or leave nothing of it, are not believed."""
    page = Page(source or "")
    if page.misjudged:
        page = Page(source or "", frozenset(page.misjudged))
    page.settle()
    if not page.kept:
        page = Page(source or "", None)
        page.settle()
    return page


def main_text(source: str | None, standing: dict[str, float]) -> tuple[str, str | None]:
    """Text and winning path of a page, given how the paths of its host stand."""
    page = read_page(source)
    scores = page.scores()
    if not scores:
        return "\n".join(text for text, _ in page.kept), None
    known = [p for p in scores if p in standing]
    path = min(known, key=lambda p: (-standing[p], p)) if known else min(scores, key=lambda p: (-scores[p], p))
    return page.text(path), path


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def path_standing(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host``, ``path``, ``n`` pages and ``standing`` of the paths that a host's pages agree on."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).filter("host is not null and html is not null")

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, shares = [], [], []
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                scores = read_page(source.as_py()).scores()
                best = max(scores.values(), default=0.0)
                for path, score in scores.items():
                    if score >= SHARE * best:
                        hosts.append(host)
                        paths.append(path)
                        shares.append(round(score / best * 1_000_000))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())], names=["host", "path", "share"])

    sums = rows.mapInArrow(votes, "host string, path string, share long").groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("share").alias("share"))
    size = rows.groupBy("host").agg(F.count("*").alias("pages"))
    kept = sums.filter("n >= 2").join(size, "host").filter(F.col("n") >= SUPPORT * F.col("pages"))
    standing = F.col("share") / 1_000_000 / (F.col("n") + DOUBT) * F.pow(F.col("n") / F.col("pages"), F.lit(SPREAD))
    return kept.select("host", "path", "n", standing.alias("standing"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``text``, ``n_chars`` and the winning ``path`` of each page."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    folder = new_folder(spark, "paths")
    path_standing(rows, "url", "html").groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("path", "standing"))).alias("standing")).write.parquet(folder)
    winners = spark.read.schema("host string, standing map<string, double>").parquet(folder)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            texts, paths = [], []
            for host, standing, source in zip(batch.column("host").to_pylist(), batch.column("standing"), batch.column("html"), strict=True):
                if host not in known:
                    known.clear() if len(known) > 1000 else None
                    known[host] = dict(standing.as_py() or ())
                text, path = main_text(source.as_py(), known[host])
                texts.append(text)
                paths.append(path)
            counts = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(paths, pa.string())], names=["page_id", "url", "text", "n_chars", "path"])

    joined = rows.withColumn("host", host_of(F.col("url"))).join(winners, "host", "left")
    return joined.select("page_id", "url", "html", "host", "standing").mapInArrow(extract, "page_id long, url string, text string, n_chars long, path string")


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "url", "text", "n_chars")
