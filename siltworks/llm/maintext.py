"""The main text of web pages, from container paths on which the pages of a host agree.

Method. Every page is read once into blocks of text, each below a chain of containers (``article``,
``div`` and the like). What names itself as menu, header, footer, sidebar, notice, advert, form or
reader comments is left out. A container's path is the chain of tags with their classes, in which
numbers are generalised. Each page gives its paths a score: the share of the page's running text
that the path holds, less the link lists in it, with a preference for ``article`` and ``main`` and
for classes that name content. The scores are added up per host and path; of the best paths the
deepest wins. Then each page is read again and the blocks below its host's path are its text;
a page without that path uses its own best one.

Defined cases: null or empty html gives an empty text; text outside any tag counts as the body's;
pages whose address has no host vote together; a tag cut off at the end of the page is dropped;
repeated rows each give a row; an empty table gives an empty table; further columns are ignored.
Pages of any length are read whole, one in memory at a time. Votes are whole numbers, so that the
order of adding them up can't change a winner; ties go to the deeper path, then to the greater name.
"""

from __future__ import annotations

import re
from html import unescape
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import Sink, rows_of

# Tags by what a reader of HTML has to know of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table
tbody td tfoot th thead tr ul""".split())
CONTAINERS = frozenset("article body center details div main section table tbody td tr html".split())
DROPPED = frozenset("""aside audio button canvas datalist dialog footer form head iframe input math menu nav noembed
noframes noscript object embed script search select option style svg template textarea title video xmp""".split())
CLOSED_BY = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
             "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
             "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option"]),
             "head": frozenset(["body"])}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

# Words of classes, ids and roles that name what is not the article.
ALWAYS = frozenset("""ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion cookie
cookies consent gdpr notice notices alert alerts newsletter subscribe subscription signup login popup modal overlay comment
comments commentlist disqus reply replies respond breadcrumb breadcrumbs pagination pager share sharing social related
recommended recommendations masthead toolbar widget widgets banner contentinfo complementary navigation navbar nav menu
menus sidebar footer skip paywall""".split())
UNLESS_LAYOUT = frozenset("has no with without show hide is left right full".split())
CONTENT = frozenset("article content entry post story text body main prose".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMES = frozenset(["class", "id", "role", "hidden", "aria-hidden", "style", "itemprop"])
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(raw: str) -> dict[str, str]:
    if not raw or "=" not in raw and "hidden" not in raw:
        return {}
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw) if m[1].lower() in _NAMES}


def _names_boilerplate(tag: str, attributes: dict[str, str]) -> bool:
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True
    for name in " ".join(attributes.get(k, "") for k in ("class", "id", "role")).split():
        words = [w.lower() for w in _WORD.findall(name)]
        if words and words[0] not in UNLESS_LAYOUT and not ALWAYS.isdisjoint(words):
            return True
        if words and words[-1] == "header" and CONTENT.isdisjoint(words):
            return True
    return False


class Block:
    """A block's text, how much of it is links, and the containers around it, outermost first."""

    __slots__ = ("text", "linked", "chain")

    def __init__(self, text: str, linked: int, chain: tuple[str, ...]):
        self.text, self.linked, self.chain = text, linked, chain


class Page:
    """The blocks of a page that can belong to its article."""

    def __init__(self, html: str):
        self.blocks: list[Block] = []
        self.open: list[tuple[str, bool, bool]] = []  # tag, whether it drops, whether it is a container
        self.chain: tuple[str, ...] = ("body",)
        self.parts: list[tuple[str, bool]] = []
        self.dropping = self.links = 0
        self._read(html)
        self._flush()

    def _read(self, html: str) -> None:
        at, raw = 0, None
        for match in _TAG.finditer(html):
            if match.start() < at:
                continue
            if match.start() > at:
                self._text(html[at:match.start()])
            at = match.end()
            tag = (match[2] or match[5] or "").lower()
            if not tag or match[7] == "":
                if match[0].startswith("<![CDATA["):
                    self._text(match[0][9:].removesuffix("]]>"))
                continue
            if match[1] or match[4]:
                self._end(tag)
                continue
            self._start(tag, match[3] or match[6] or "")
            if tag in RAW:
                stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
                at = stop.start() if stop else len(html)
        if at < len(html):
            self._text(html[at:])

    def _text(self, text: str) -> None:
        if not self.dropping:
            self.parts.append((unescape(text) if "&" in text else text, self.links > 0))

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(t for t, _ in self.parts).split())
            if text:
                linked = sum(len(t.strip()) for t, in_link in self.parts if in_link)
                self.blocks.append(Block(text, linked, self.chain))
            self.parts = []

    def _start(self, tag: str, raw: str) -> None:
        while self.open and tag in CLOSED_BY.get(self._block(), ()):
            self._end(self._block())
        if tag == "br":
            self.parts.append((" ", False))
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        if tag in BLOCKS:
            self._flush()
        attributes = _attributes(raw)
        drops = tag in DROPPED or _names_boilerplate(tag, attributes)
        if tag == "header" and not drops:
            drops = not any(t in ("article", "main") for t, _, _ in self.open)
        elif not drops and self.open and self.open[-1][0] == "header" and tag not in HEADINGS:
            drops = True  # of an article's own header only the headings belong to the text
        container = tag in CONTAINERS and tag != "html" and not (tag == "body" and self.chain == ("body",) and not self._inside("body"))
        if container:
            self.chain += (self._step(tag, attributes),)
        self.open.append((tag, drops, container))
        self.dropping += drops
        self.links += tag == "a"

    def _inside(self, tag: str) -> bool:
        return any(t == tag for t, _, _ in self.open)

    def _block(self) -> str:
        """The innermost open element that a following tag may close."""
        for tag, _, _ in reversed(self.open):
            if tag in CLOSED_BY:
                return tag
            if tag in BLOCKS:
                return ""
        return ""

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        if not self._inside(tag):
            return
        while True:
            closed, drops, container = self.open.pop()
            if closed in BLOCKS:
                self._flush()
            self.dropping -= drops
            self.links -= closed == "a"
            if container:
                self.chain = self.chain[:-1]
            if closed == tag:
                return

    @staticmethod
    def _step(tag: str, attributes: dict[str, str]) -> str:
        # no class holds a blank, so one stands for ">", which joins steps to paths
        names = {re.sub(r"\d+", "#", name.lower()).replace(">", " ") for name in attributes.get("class", "").split()}
        return ".".join([tag, *sorted(names)])


def _weight(step: str) -> float:
    tag, *names = step.split(".")
    if tag in ("article", "main"):
        return 1.25
    return 1.1 if any(not CONTENT.isdisjoint(re.findall(r"[a-z]+", name)) for name in names) else 1.0


def path_scores(page: Page) -> dict[str, int]:
    """For each container path of the page its score in thousandths of the page's running text."""
    held: dict[str, int] = {}
    total = 0
    for block in page.blocks:
        size = len(block.text)
        value = size if 2 * block.linked < size else -size
        total += max(value, 0)
        paths = {">".join(block.chain[:k]) for k in range(1, len(block.chain) + 1)}
        for path in paths:
            held[path] = held.get(path, 0) + value
    return {path: int(1000 * value * _weight(path.rpartition(">")[2]) / total) for path, value in held.items() if value > 0} if total else {}


def best_path(scores: dict[str, int]) -> str:
    return max(scores, key=lambda p: (scores[p], p.count(">"), p), default="body")


def text_below(page: Page, path: str | None) -> str:
    """The blocks below the containers of a path; of the page's own best path if there are none."""
    def chosen(wanted: str) -> list[str]:
        steps = tuple(wanted.split(">"))
        return [b.text for b in page.blocks if b.chain[:len(steps)] == steps]

    texts = chosen(path) if path else []
    return "\n\n".join(texts or chosen(best_path(path_scores(page))))


def host_of(url: Column) -> Column:
    """Lower-case host of an address; empty if it has none."""
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


_VOTE = pa.schema([("host", pa.string()), ("path", pa.string()), ("depth", pa.int32()), ("score", pa.int64())])
_TEXT = pa.schema([("page_key", pa.int64()), ("address", pa.string()), ("text", pa.string()), ("path", pa.string())])


def host_paths(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``host, path``: the winning path of each host."""
    rows = pages.select(host_of(F.col(url_column)).alias("host"), F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"))

    def votes(batches) -> Iterator[pa.RecordBatch]:
        sink = Sink(_VOTE)
        for host, html in rows_of(batches):
            for path, score in path_scores(Page(html)).items():
                if sink.add((host, path, path.count(">"), score), 64 + len(path)):
                    yield sink.flush()
        yield sink.flush()

    cast = rows.mapInArrow(votes, "host string, path string, depth int, score bigint")
    sums = cast.groupBy("host", "path", "depth").agg(F.sum("score").alias("votes"))
    return sums.groupBy("host").agg(F.max(F.struct("votes", "depth", "path")).alias("best")).select("host", "best.path")


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``<id>, <url>, text, path`` of every row; ``path`` is the host's winning path."""
    winners = stage(host_paths(pages, url_column, html_column), "host-paths")
    rows = pages.select(F.col(id_column).cast("bigint").alias("page_key"), F.col(url_column).cast("string").alias("address"),
                        host_of(F.col(url_column)).alias("host"),
                        F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"))
    # Spark knows the size of the written winners, and broadcasts them only if it is small
    joined = rows.join(winners, "host", "left").select("page_key", "address", "html", "path")

    def texts(batches) -> Iterator[pa.RecordBatch]:
        sink = Sink(_TEXT)
        for key, address, html, path in rows_of(batches):
            text = text_below(Page(html), path)
            if sink.add((key, address, text, path), len(text) + 128):
                yield sink.flush()
        yield sink.flush()

    out = joined.mapInArrow(texts, "page_key bigint, address string, text string, path string")
    return out.withColumnRenamed("page_key", id_column).withColumnRenamed("address", url_column)
