"""HTML as tables: blocks, styled parts, titles, links and article data, read in Arrow batches of whole pages."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote td th figcaption pre".split())
HIDDEN = frozenset("head style script noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BOLD, ITALIC, UNDERLINE = frozenset(("b", "strong")), frozenset(("i", "em")), frozenset(("u", "ins"))

#: Fixed signs of list items, and the prefix of classes that mark bullets.
BULLET_SIGNS, CHECK_SIGNS, BULLET_CLASS = frozenset("•◦▪▫◾◽◉○◯◆◇"), frozenset("☐☑☒✅✔✓"), "li-bullet"
STYLE_KINDS = ("bold", "italic", "underline")
_PLAIN: frozenset[str] = frozenset()
STYLED = {tag: frozenset((kind,)) for kind, tags in zip(STYLE_KINDS, (BOLD, ITALIC, UNDERLINE), strict=True) for tag in tags}
#: Characters of a styled part at least.
PART_CHARS = 2


def css_text(value: str) -> str:
    """The text of a CSS string: escaped code points and quotes decoded, then entities."""
    def point(m: re.Match) -> str:
        code = int(m[1], 16)
        return chr(code) if code <= 0x10FFFF else ""

    return unescape(re.sub(r"\\([0-9a-fA-F]{1,6})\s?", point, value).replace('\\"', '"').replace("\\'", "'"))


def class_rules(source: str) -> dict[str, tuple[set[str], str]]:
    """Per class of the page's style rules the kinds of style it sets and the text of its ``content``; of several
    rules the last one counts."""
    rules = {}
    if "{" not in source:
        return rules
    for name, body in re.findall(r"\.([a-zA-Z0-9_-]+)\{([^}]*)\}", source):
        content = re.search(r'(?i)content\s*:\s*"([^"]*)"', body)
        rules[name] = (style_kinds(body.lower()), css_text(content[1]) if content else "")
    return rules


def style_kinds(css: str) -> set[str]:
    """Kinds of style that declarations set."""
    weight = re.search(r"font-weight\s*:\s*([0-9]+|bold)", css)
    kinds = {"bold"} if weight and (weight[1] == "bold" or int(weight[1]) >= 600) else set()
    return kinds | {"italic" for _ in re.findall(r"font-style\s*:\s*italic", css)} | {"underline" for _ in re.findall(r"text-decoration\s*:\s*underline", css)}


def list_kind(element: str | None, classes: list[str], marker: str) -> str | None:
    """check, number, dash or bullet, by the signs of a list item's marker, its classes and its list."""
    if CHECK_SIGNS & set(marker):
        return "check"
    if element == "ol":
        return "number"
    if marker.strip().startswith("-"):
        return "dash"
    return "bullet" if element == "ul" or BULLET_SIGNS & set(marker) or any(c.lower().startswith(BULLET_CLASS) for c in classes) else None


class _Reader(HTMLParser):
    """Collects blocks with their styled parts and links; text in hidden elements is passed over.

    An element's styles are those of its tag, its ``style``, its classes and the elements around it. Styled text that
    follows on styled text without anything between is one part.
    """

    def __init__(self, rules: dict[str, tuple[set[str], str]] | None = None):
        super().__init__(convert_charrefs=True)
        self.rules = rules or {}
        self.blocks: list[dict] = []
        self.links: list[dict] = []
        self.hidden = 0
        self.open: dict | None = None
        self.styles: list[tuple[str, frozenset[str]]] = []  # open elements with all kinds that hold inside
        self.lists: list[tuple[str, str]] = []  # open lists with the marker of their classes
        self.link: dict | None = None

    def _close(self) -> None:
        if self.open:
            value = " ".join("".join(self.open["text"]).split())
            if value:
                parts = {k: list(dict.fromkeys(t for x in self.open[k] if len(t := " ".join(x.split())) >= PART_CHARS)) for k in STYLE_KINDS}
                self.blocks.append({"tag": self.open["tag"], "text": value, "list_type": self.open["list_type"], "list_kind": self.open["list_kind"], "marker": self.open["marker"] or None, "hashtags": re.findall(r"#(\w{2,64})", value), **parts})
            self.open = None

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_starttag(self, tag, attrs):
        if tag in HIDDEN:
            self.hidden += 1
            return
        at = dict(attrs)
        classes = (at.get("class") or "").split()
        ruled = [self.rules[c] for c in classes if c in self.rules]
        marker = " ".join(dict.fromkeys(m for _, m in ruled if m.strip())) if ruled else ""
        kinds = self.styles[-1][1] if self.styles else _PLAIN
        if ruled or at.get("style") or tag in STYLED:
            kinds = kinds.union(STYLED.get(tag, _PLAIN), style_kinds((at.get("style") or "").lower()), *(k for k, _ in ruled))
        if tag not in VOID:
            self.styles.append((tag, kinds))
        if tag in ("ul", "ol"):
            self.lists.append((tag, marker))
        if tag in BLOCKS:
            self._close()
            item = self.lists[-1] if self.lists and tag == "li" else (None, "")
            marker = " ".join(x for x in (item[1], marker) if x) if tag == "li" else ""
            self.open = {"tag": tag, "text": [], "bold": [], "italic": [], "underline": [], "last": _PLAIN, "list_type": item[0], "list_kind": list_kind(item[0], classes, marker) if tag == "li" else None, "marker": marker}
        if tag == "input" and (at.get("type") or "").lower() == "checkbox" and self.open:
            self.open["list_kind"] = "check"
        if tag == "br" and self.open:
            self.open["text"].append(" ")
        if tag == "a" and at.get("href"):
            self.link = {"href": at["href"], "text": [], "block": len(self.blocks)}

    def handle_endtag(self, tag):
        if tag in HIDDEN:
            self.hidden = max(0, self.hidden - 1)
            return
        if self.styles and self.styles[-1][0] == tag:
            self.styles.pop()
        elif any(t == tag for t, _ in self.styles):  # elements left open inside end too
            while self.styles.pop()[0] != tag:
                pass
        if tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        if tag == "a" and self.link:
            self.links.append(self.link | {"text": " ".join("".join(self.link["text"]).split())})
            self.link = None
        if tag in BLOCKS:
            self._close()

    def handle_data(self, data):
        if self.hidden:
            return
        if self.open:
            self.open["text"].append(data)
            kinds = self.styles[-1][1] if self.styles and data.strip() else _PLAIN
            for kind in kinds:
                if kind in self.open["last"]:
                    self.open[kind][-1] += data
                else:
                    self.open[kind].append(data)
            self.open["last"] = kinds
        if self.link:
            self.link["text"].append(data)


def read_page(source: str | None) -> tuple[list[dict], list[dict]]:
    """(blocks, links) of a page; broken markup gives what could be read."""
    reader = _Reader(class_rules(source or ""))
    reader.feed(source or "")
    reader.close()
    reader._close()
    return reader.blocks, reader.links


_BLOCKS = [("block_no", pa.int32()), ("tag", pa.string()), ("text", pa.string()), ("list_type", pa.string()), ("list_kind", pa.string()), ("marker", pa.string()), *((n, pa.list_(pa.string())) for n in ("hashtags", "bold", "italic", "underline"))]
_LINKS = [("link_no", pa.int32()), ("href", pa.string()), ("text", pa.string()), ("block_no", pa.int32())]
_ARTICLE = [("title", pa.string()), ("author", pa.string()), ("published", pa.string())]
#: Rows held before they are handed on.
HELD = 20_000


def _block_rows(source: str | None) -> list[tuple]:
    return [(i, *(b[n] for n, _ in _BLOCKS[1:])) for i, b in enumerate(read_page(source)[0])]


def _link_rows(source: str | None) -> list[tuple]:
    return [(i, x["href"], x["text"], x["block"]) for i, x in enumerate(read_page(source)[1])]


def _article_rows(source: str | None) -> list[tuple]:
    """Title, author and date: linked data first, then meta elements, then the title element."""
    source = source or ""
    nodes = []
    for raw in re.findall(r'(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>', source):
        try:
            found = json.loads(raw)
        except ValueError:
            continue
        found = found.get("@graph", [found]) if isinstance(found, dict) else found
        nodes += [n for n in found if isinstance(n, dict)]
    meta = {k.lower(): v for k, v in re.findall(r'(?is)<meta[^>]+(?:name|property)="([^"]+)"[^>]+content="([^"]*)"', source)}
    pick = lambda key: next((n[key] for n in nodes if n.get(key)), None)
    author = pick("author")
    author = author.get("name") if isinstance(author, dict) else author if isinstance(author, str) else None
    title = re.search(r"(?is)<title[^>]*>(.*?)</title>", source)
    return [(
        pick("headline") or meta.get("og:title") or (" ".join(title[1].split()) if title else None),
        author or meta.get("author"),
        pick("datePublished") or meta.get("article:published_time") or meta.get("date"),
    )]


def _read(pages: DataFrame, ids: list[str], html: str, fields: list[tuple], rows_of) -> DataFrame:
    """The ids with the rows read from each page, in Arrow batches of bounded size."""
    from pyspark.sql.pandas.types import from_arrow_type

    rows = pages.select(F.struct(*ids).alias("row"), F.col(html).cast("string").alias("html"))
    names = ["row", *(n for n, _ in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take: list[int] = []
            found: list[tuple] = []
            for i in range(batch.num_rows):
                more = rows_of(batch.column(1)[i].as_py())
                take += [i] * len(more)
                found += more
                if len(found) >= HELD or i == batch.num_rows - 1:
                    columns = list(zip(*found, strict=True)) or [[] for _ in fields]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take, pa.int64())), *(pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True))], names=names)
                    take, found = [], []

    schema = T.StructType([rows.schema["row"], *(T.StructField(n, from_arrow_type(t)) for n, t in fields)])
    return rows.mapInArrow(run, schema).select("row.*", *names[1:])


def html_blocks(pages: DataFrame, ids: list[str], html: str = "html") -> DataFrame:
    """One row per text block, with the list it stands in, the kind and marker of its item, hashtags, and the parts that
    are bold, italic or underlined by elements, styles or classes."""
    return _read(pages, ids, html, _BLOCKS, _block_rows)


def html_links(pages: DataFrame, ids: list[str], html: str = "html") -> DataFrame:
    """One row per anchor: target, text and the number of blocks before it."""
    return _read(pages, ids, html, _LINKS, _link_rows)


def html_article(pages: DataFrame, ids: list[str], html: str = "html") -> DataFrame:
    """Title, author and date of each page."""
    return _read(pages, ids, html, _ARTICLE, _article_rows)


def html_titles(pages: DataFrame, ids: list[str], html: str = "html") -> DataFrame:
    """Headings with their level, the first of equal ones per page."""
    from timeloom.functions.text import normalize
    from timeloom.operators.lookup import first_by

    heads = html_blocks(pages, ids, html).filter(F.col("tag").rlike("^h[1-6]$"))
    named = heads.select(*ids, "block_no", F.substring("tag", 2, 1).cast("int").alias("level"), "text", normalize(F.col("text")).alias("_k"))
    return first_by(named, [*ids, "_k"], ["block_no"]).drop("_k")


def script_blocks(pages: DataFrame, ids: list[str], html: str = "html") -> DataFrame:
    """(ids, block_no, text): the blocks as they are spoken, without times in brackets, and in blocks that link to a
    video without bare ranges of times; blocks of which nothing is left go."""
    from timeloom.functions.timecode import links_video, without_times

    blocks = html_blocks(pages, ids, html).select(*ids, "block_no", "text")
    video = html_links(pages, ids, html).filter(links_video(F.col("href"))).select(*ids, "block_no", F.lit(True).alias("_video")).distinct()
    joined = blocks.join(video, [*ids, "block_no"], "left")
    return joined.select(*ids, "block_no", without_times(F.col("text"), F.col("_video").isNotNull()).alias("text")).filter("text <> ''")


def links_in_context(pages: DataFrame, ids: list[str], html: str = "html", before: int = 100, after: int = 100) -> DataFrame:
    """(ids, block_no, kind, href, text, context): anchors, and addresses that stand in the text as they are.

    The context is the block's text from ``before`` characters before the link's words to ``after`` behind them; links
    outside blocks have their words as context. An address that is an anchor's own text or target of its block isn't
    listed again.
    """
    blocks = html_blocks(pages, ids, html).select(*ids, "block_no", F.col("text").alias("_block"))
    anchors = html_links(pages, ids, html).join(blocks, [*ids, "block_no"], "left")
    window = lambda at, size: F.substring(F.col("_block"), F.greatest(at - before, F.lit(1)), F.least(at - 1, F.lit(before)) + size + after)
    at = F.position(F.col("text"), F.coalesce("_block", F.lit("")))
    named = anchors.select(*ids, "block_no", F.lit("anchor").alias("kind"), "href", "text", F.when(at > 0, window(at, F.length("text"))).otherwise(F.col("text")).alias("context"))
    written = blocks.select(*ids, "block_no", "_block", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("_block", F.lit(r"(?i)(?:https?://|www\.)[^\s<>\"']+"), F.lit(0)), lambda x: F.regexp_replace(x, r"[.,;:!?)\]}]+$", "")))).alias("href"))
    targets = anchors.select(*ids, "block_no", F.explode(F.array("href", "text")).alias("href")).distinct()
    plain = written.join(targets, [*ids, "block_no", "href"], "left_anti").withColumn("_at", F.position(F.col("href"), F.col("_block")))
    return named.unionByName(plain.select(*ids, "block_no", F.lit("text").alias("kind"), "href", F.col("href").alias("text"), window(F.col("_at"), F.length("href")).alias("context")))
