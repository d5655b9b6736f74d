"""HTML extraction by a site style tree.

The pages of a host are merged into one tree of element paths (tag, class and
id). Each path has presentation styles (sequences of child elements) and
contents (texts, link targets, images). The exponential of an entropy is an
effective number, which tells the same whether a host has ten pages or a million:

- a content's spread: the effective number of pages that have it, out of those
  with the path, or with the main element that the path is in; each page counts
  once. Importance of a content node: 1 - the mean
  spread of its contents, each weighted by the pages that have it;
- importance of a presentation node: 1 - 1 / the effective number of its styles,
  since templates repeat one style;
- of both together: ``(1 - g^l) * presentation + g^l * content`` for ``l`` effective styles.

Branches in which both this and the content's importance are low are cut out of
every page of the host, inside ``article`` and ``main``, too. So are single texts
of other branches that four fifths of these pages have. A heading that stands before
main text that is kept stays with it. Names that announce what an
element is are a prior: ``nav``, ``footer``, ``class="ad"`` and their like have no
importance; and where nearly all text of an ``article`` or ``main`` would go, the
page is a copy of others and keeps it.

Trees are never built in one place: pages emit the features of their paths, and
sums before the shuffle make the entropies, so a host with a third of all pages
is no heavier than others. What is cut goes back to the pages by broadcast if
measured to fit, else by a join on the host.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import bounded_batches, slices, written

DECAY = 0.9
THRESHOLD = 0.4
LEAST_PAGES = 5
# Share of a path's pages that have a single text which is cut.
TEXT_SHARE = 0.8
# Of a copy's main text, at most this share is its own.
OWN_IN_COPY = 0.25
# Cut paths and texts that are broadcast; each takes a hundred bytes or so in a worker.
MAX_BROADCAST_PATHS = 200_000

# Elements by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes noscript template".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
IGNORED = set("head nav footer aside form button select option datalist dialog menu svg canvas object audio video".split())
MAIN = {"article", "main"}
UNTOUCHED = {"html", "body", *MAIN}
# An item ends the items named here, but not beyond the elements of WALLS.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
WALLS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
NOISE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs masthead "
    "topbar footer sidebar aside widget related recommended share sharing social comment comments reply replies disqus "
    "newsletter subscribe subscription signup login search form pagination pager toolbar skip copyright".split()
)
HEADER_WORDS = {"header"}
# Articles and whole branches under these names are other people's or other pages'.
OTHERS_WORDS = set("comment comments reply replies disqus related recommended".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|[!?/][^>]*+>)",
    re.DOTALL,
)
UNFINISHED = re.compile(r"<[a-zA-Z/!?]")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-z]+")
NUMBER = re.compile(r"\d+")
# In names, longer numbers are ids of single pages.
RUNNING = re.compile(r"\d{3,}")
LETTER = re.compile(r"[^\W\d_]")
# Short values repeat by their nature.
CELLS = {"td", "th"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


@dataclass
class Element:
    tag: str
    path: str
    noise: bool
    main: bool
    # Open wrappers that only a class, an id or being a form makes noise.
    wrappers: tuple[int, ...] = ()
    # Path of the main element around it, if it is in one.
    home: str = ""
    children: list[str] = field(default_factory=list)
    features: list[str] = field(default_factory=list)


@dataclass
class Block:
    path: str
    text: str
    noise: bool
    main: bool
    wrappers: tuple[int, ...] = ()

    def cut_by(self, cut: frozenset[int] | set[int]) -> bool:
        """Whether the host's tree cuts the path, or this text in it."""
        path = _hash(self.path)
        if path in cut:
            return True
        if self.tag in CELLS or not LETTER.search(self.text):
            return False
        return path ^ _hash(_feature(self.text, self.main)) in cut

    @property
    def tag(self) -> str:
        return self.path.rpartition(">")[2].split(".")[0]


class Page:
    """Text blocks of a page in order, with their paths, styles and features."""

    def __init__(self, source: str | None):
        self.stack = [Element("", "", False, False)]
        self.blocks: list[Block] = []
        self.homes: dict[str, str] = {}
        self.styles: list[tuple[str, str]] = []
        self.features: list[tuple[str, str]] = []
        self.text: list[str] = []
        self.opened = 0
        self.read(source or "")

    def read(self, source: str) -> None:
        at = 0
        while True:
            token = TOKEN.search(source, at)
            if token is None:
                rest = source[at:]
                # A tag that the page's end cuts off is no text.
                cut = UNFINISHED.search(rest)
                self.add(rest[: cut.start()] if cut else rest)
                break
            if (unfinished := UNFINISHED.search(source, at, token.start())) is not None:
                # What looks like a tag but is not closed reaches to the next one that is.
                self.add(source[at : unfinished.start()])
            else:
                self.add(source[at : token.start()])
            at = token.end()
            tag = token["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if token["end"]:
                self.close(tag)
            else:
                if tag in RAW:
                    stop = re.compile(f"</{re.escape(tag)}[^>]*>", re.IGNORECASE).search(source, at)
                    at = stop.end() if stop else len(source)
                    continue
                self.open(tag, token["attributes"])
        self.flush()
        while len(self.stack) > 1:
            self.pop()

    def add(self, text: str) -> None:
        if text:
            self.text.append(text)

    def flush(self) -> None:
        """The text so far is a block of the innermost element."""
        if not self.text:
            return
        text = "".join(html.unescape(part) if "&" in part else part for part in self.text)
        self.text = []
        text = " ".join(text.split())
        if text:
            top = self.stack[-1]
            self.blocks.append(Block(top.path, text, top.noise, top.main, top.wrappers))
            self.features.append((top.path, _feature(text, top.main)))
            if top.home:
                self.homes[top.path] = top.home

    def open(self, tag: str, attributes: str) -> None:
        pairs = {}
        if attributes and not attributes.isspace():
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                pairs.setdefault(name.lower(), html.unescape(a or b or c))
        top = self.stack[-1]
        if tag in VOID:
            if tag in ("br", "hr"):
                self.flush()
            elif tag == "img" and pairs.get("src"):
                self.features.append((top.path, "i" + pairs["src"]))
            return
        if tag == "a" and pairs.get("href"):
            self.features.append((top.path, "a" + pairs["href"]))
        noise, named = self.is_noise(tag, pairs, top)
        if tag in INLINE and not ((noise or named) and not top.noise):
            return
        self.flush()
        if tag not in INLINE:
            self.close_implied(tag)
            top = self.stack[-1]
        name = ".".join([tag, *sorted(RUNNING.sub("0", f"{pairs.get('class', '')} {pairs.get('id', '')}").split())])
        if not top.children or top.children[-1] != name:
            top.children.append(name)
        main = tag in MAIN or pairs.get("role") == "main"
        # What a page calls its main element is so under any wrapper.
        wrappers = () if main and not top.main else top.wrappers
        if named:
            self.opened += 1
            wrappers = (*wrappers, self.opened)
        path = f"{top.path}>{name}"
        self.stack.append(Element(tag, path, noise, top.main or main, wrappers, top.home or path * main))

    def is_noise(self, tag: str, pairs: dict[str, str], top: Element) -> tuple[bool, bool]:
        """Whether the element is noise for good, and whether it is so by a wrapper's name, which may turn out wrong."""
        if top.noise or tag in IGNORED and tag != "form" or tag == "header" and not top.main:
            return True, False
        if tag in UNTOUCHED:
            return False, False
        if "hidden" in pairs or pairs.get("aria-hidden") == "true" or pairs.get("role", "").lower() in NOISE_ROLES:
            return True, False
        if "display:none" in pairs.get("style", "").replace(" ", "").lower():
            return True, False
        words = set(WORDS.findall(f"{pairs.get('class', '')} {pairs.get('id', '')}".lower()))
        if words & OTHERS_WORDS:
            return True, False
        return False, tag == "form" or bool(words & NOISE_WORDS) or bool(words & HEADER_WORDS and not top.main)

    def close_implied(self, tag: str) -> None:
        """A block ends an open paragraph; items and cells end the one before, within their list or table."""
        ends = {"p"} | ENDED_BY.get(tag, set())
        walls = WALLS.get(tag, set())
        for index in range(len(self.stack) - 1, 0, -1):
            inner = self.stack[index].tag
            if inner in ends:
                while len(self.stack) > index:
                    self.pop()
                if inner != "p" or tag not in ENDED_BY:
                    return
            elif inner in walls or tag not in ENDED_BY and inner not in INLINE:
                return

    def close(self, tag: str) -> None:
        if tag in INLINE and self.stack[-1].tag != tag:
            return
        self.flush()
        for index in range(len(self.stack) - 1, 0, -1):
            if self.stack[index].tag == tag:
                while len(self.stack) > index:
                    self.pop()
                return

    def pop(self) -> None:
        element = self.stack.pop()
        self.styles.append((element.path, " ".join(element.children)))

    def main_text(self, cut: frozenset[int] | set[int]) -> str:
        """The blocks that neither a name nor the host's tree takes out, one on a line.

        If entropy would take out all that names have left, or nearly all that is
        in the main element, it is not heeded there.
        """
        left = self.named_main(cut)
        if cut:
            kept = _with_headings(left, [not block.cut_by(cut) for block in left])
            size = sum(len(block.text) for block in left if block.main)
            if sum(len(block.text) for block in kept if block.main) < OWN_IN_COPY * size:
                kept = [block for block in left if block.main or not block.cut_by(cut)]
            left = kept or left
        return "\n".join(block.text for block in left)

    def named_main(self, cut: frozenset[int] | set[int]) -> list[Block]:
        """The blocks that no name takes out.

        A wrapper's name is overruled if the host has a tree, or names leave
        nothing, and the wrapper holds most of the page's distinct text. Wrappers
        within it are judged alike, so a sidebar in it still goes.
        """
        blocks = [block for block in self.blocks if not block.noise]
        left = [block for block in blocks if not block.wrappers]
        if len(left) == len(blocks) or any(block.main for block in left) or left and TREE not in cut:
            return left
        sizes = Counter()
        whole = 0
        for block in blocks:
            size = 0 if block.cut_by(cut) else len(block.text)
            whole += size
            sizes.update(dict.fromkeys(block.wrappers, size))
        overruled = {wrapper for wrapper, size in sizes.items() if 2 * size > whole}
        return [block for block in blocks if overruled.issuperset(block.wrappers)]


def _with_headings(blocks: list[Block], keep: list[bool]) -> list[Block]:
    """The blocks to keep, and the headings of a main element that stand before one of them."""
    out = []
    follows = False
    for block, kept in zip(reversed(blocks), reversed(keep)):
        follows = kept or follows and block.main and block.tag in HEADINGS
        if follows:
            out.append(block)
        follows = follows and block.main
    return out[::-1]


def _feature(text: str, main: bool) -> str:
    """A text as a feature; numbers tell texts apart only in a main element."""
    return "t" + (text.lower() if main else NUMBER.sub("0", text.lower()))


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >= 1 << 63 else value


def host_of(url: str | None) -> str:
    """The URL's host in lower case, without user and port; empty if it has none."""
    found = re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#\s]*)", url or "")
    return found[1].rpartition("@")[2].split(":")[0].lower() if found else ""


#: Kinds of rows that pages emit: the page itself, the main element around the path, a style,
#: a content feature that is a link or an image, one that is a text.
PAGE, HOME, STYLE, CONTENT, TEXT = 0, 1, 2, 3, 4


def _page_rows(page: Page) -> list[tuple[int, int, int, int]]:
    """(path, kind, feature, count) for every path with text, and every main element around one."""
    paths = {block.path for block in page.blocks}
    homes = set(page.homes.values())
    numbers = {path: _hash(path) for path in paths | homes}
    rows = [(number, PAGE, 0, 1) for number in numbers.values()]
    rows += [(numbers[path], HOME, numbers[home], 1) for path, home in page.homes.items()]
    styles = Counter((path, value) for path, value in page.styles if path in paths)
    rows += [(numbers[path], STYLE, _hash(value), count) for (path, value), count in styles.items()]
    contents = {(path, value) for path, value in page.features if path in paths}
    rows += [(numbers[path], TEXT if value[0] == "t" else CONTENT, _hash(value), 1) for path, value in contents]
    return rows


def _features(pages: DataFrame) -> DataFrame:
    """(host, path, kind, feature, total, spread) summed over the pages of every host, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hosts, rows = [], []
            for url, source in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                if source and (host := host_of(url)):
                    own = _page_rows(Page(source))
                    rows += own
                    hosts += [host] * len(own)
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), *(pa.array(column, pa.int64()) for column in columns)],
                ["host", "path", "kind", "feature", "count"],
            )

    rows = pages.select("url", "html").mapInArrow(run, "host string, path long, kind long, feature long, count long")
    count = F.col("count").cast("double")
    return written(
        rows.groupBy("host", "path", "kind", "feature").agg(
            F.sum(count).alias("total"), F.sum(count * F.log(count)).alias("spread")
        ),
        "features",
    )


# Stands among a host's cut paths if its pages were enough for a tree.
TREE = 0

# With p = count / total: -sum(p ln p) = ln total - sum(count ln count) / total.
ENTROPY = "ln(total) - spread / total"


def tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, around, styles, presentation, content, importance) for every text path of every host.

    Pages without host are in no tree.
    """
    return _tree(_features(pages))


def _tree(features: DataFrame) -> DataFrame:
    def only(kind: int, value: F.Column) -> F.Column:
        return F.when(F.col("kind") == kind, value)

    content = F.col("kind") >= CONTENT
    paths = features.groupBy("host", "path").agg(
        F.max(only(PAGE, F.col("total"))).cast("long").alias("pages"),
        F.max(only(HOME, F.col("feature"))).alias("home"),
        F.sum(only(STYLE, F.col("total"))).alias("style_total"),
        F.sum(only(STYLE, F.col("total") * F.log("total"))).alias("style_spread"),
        F.sum(F.when(content, F.col("total"))).alias("content_total"),
        F.sum(F.when(content, F.col("total") * F.exp(F.expr(ENTROPY)))).alias("content_pages"),
    )
    homes = features.where(F.col("kind") == PAGE).select(
        "host", F.col("path").alias("home"), F.col("total").cast("long").alias("around")
    )
    paths = paths.where("content_total is not null").join(homes, ["host", "home"], "left")
    paths = paths.withColumn("around", F.coalesce("around", "pages"))
    single = F.col("around") < 2
    styles = F.exp(F.log("style_total") - F.col("style_spread") / F.col("style_total"))
    others = F.greatest(F.col("around") - 1, F.lit(1))
    spread = (F.col("content_pages") / F.col("content_total") - 1) / others
    decay = F.pow(F.lit(DECAY), F.col("styles"))
    return (
        paths.withColumn("styles", styles)
        .withColumn("presentation", F.when(single, 1.0).otherwise(1 - 1 / F.col("styles")))
        .withColumn("content", F.when(single, 1.0).otherwise(1 - F.least(spread, F.lit(1.0))))
        .withColumn("importance", (1 - decay) * F.col("presentation") + decay * F.col("content"))
        .select("host", "path", "pages", "around", "styles", "presentation", "content", "importance")
    )


def _cut(pages: DataFrame, threshold: float, least_pages: int) -> DataFrame:
    """(host, path) of what pages lose; for a single text, path is the exclusive or of its path's and its own hash."""
    features = _features(pages)
    paths = written(_tree(features).where(F.col("pages") >= least_pages), "tree")
    low = F.greatest("importance", "content") < threshold
    # Only texts that some path could cut are joined to the paths.
    texts = features.where(F.col("kind") == TEXT).select("host", "path", "feature", F.exp(F.expr(ENTROPY)).alias("having"))
    common = texts.where(F.col("having") > TEXT_SHARE * least_pages - 0.5).join(paths.where(~low), ["host", "path"])
    # Whole pages, without what logarithms lose.
    repeated = common.where(F.round("having") >= TEXT_SHARE * F.col("around"))
    return written(
        paths.where(low)
        .select("host", "path")
        .unionByName(repeated.select("host", F.col("path").bitwiseXOR(F.col("feature")).alias("path")))
        .unionByName(paths.select("host", F.lit(TREE).cast("long").alias("path")).distinct()),
        "cut-paths",
    )


def extract(
    pages: DataFrame,
    threshold: float = THRESHOLD,
    least_pages: int = LEAST_PAGES,
    max_broadcast: int = MAX_BROADCAST_PATHS,
) -> DataFrame:
    """One row per page: page_id, url, host, text.

    Blocks are what block elements and line breaks separate; white space inside
    one is a single blank, and blocks are joined by line feeds. NULL and empty
    pages have an empty text; pages without a usable URL are judged by names
    alone. Repeated pages and pages without page_id are rows of their own. Other
    columns are not looked at.
    """
    bounded_batches(pages.sparkSession)
    cut = _cut(pages, threshold, least_pages)
    sources = pages.select("page_id", "url", "html")
    if cut.count() <= max_broadcast:
        by_host: dict[str, set[int]] = {}
        for row in cut.collect():
            by_host.setdefault(row["host"], set()).add(row["path"])
        shared = pages.sparkSession.sparkContext.broadcast(by_host)
        return sources.mapInArrow(_extract_with(shared), EXTRACTED)
    host = F.lower(F.regexp_extract("url", r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#\s]*@)?([^/?#\s:]*)", 1))
    lists = cut.groupBy("host").agg(F.collect_list("path").alias("cut"))
    return sources.withColumn("host", host).join(lists, "host", "left").mapInArrow(_extract_with(None), EXTRACTED)


EXTRACTED = "page_id long, url string, host string, text string"


def _extract_with(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_host = shared.value if shared is not None else {}
        for batch in slices(batches):
            urls, sources = batch.column("url").to_pylist(), batch.column("html").to_pylist()
            hosts = list(map(host_of, urls))
            if shared is None:
                cuts = [set(paths or ()) for paths in batch.column("cut").to_pylist()]
            else:
                cuts = [by_host.get(host, frozenset()) for host in hosts]
            texts = [Page(source).main_text(cut) for source, cut in zip(sources, cuts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id").cast(pa.int64()),
                    pa.array(urls, pa.string()),
                    pa.array(hosts, pa.string()),
                    pa.array(texts, pa.string()),
                ],
                ["page_id", "url", "host", "text"],
            )

    return run
