"""Title, authors and date of article pages, from ordered sources: linked data, meta elements, the page's own
elements, and the address.

A page's candidates are read in one pass per page; which title is best and how author lines are split is decided
by column functions.
"""

from __future__ import annotations

import datetime
import html as html_text
import json
import re
import unicodedata
from collections.abc import Iterator
from email.utils import parsedate_to_datetime
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.functions.display import MONTHS, authors, best_title

from .html import VOID, _read

#: Fixed names: article types and the keys of linked data, and the names of meta elements in order.
ARTICLE_TYPES = frozenset(("article", "newsarticle", "blogposting", "report", "analysisnewsarticle", "opinionnewsarticle"))
TITLE_KEYS, AUTHOR_KEYS, DATE_KEYS = ("headline", "name", "title"), ("author", "creator"), ("datePublished", "dateCreated", "dateModified", "uploadDate")
META_TITLES = ("og:title", "twitter:title", "headline", "parsely-title")
META_AUTHORS = ("author", "article:author", "og:author", "twitter:creator", "parsely-author", "dc.creator", "dc.creator.author", "citation_author", "sailthru.author")
META_DATES = ("article:published_time", "article:modified_time", "og:updated_time", "publish-date", "date", "pubdate", "datepublished", "datecreated", "dc.date", "dc.date.issued", "citation_publication_date", "parsely-pub-date", "sailthru.date")
#: Fixed names of sites that stand behind a title.
SITES = ("Le Monde", "AFP", "Reuters", "Associated Press", "AP", "BBC", "CNN", "The Guardian")
DATE_ATTRIBUTES = ("datetime", "content", "title", "data-date", "data-time", "data-published", "data-modified")
DATE_MARKS = ("datePublished", "dateCreated", "dateModified", "article:published_time", "article:modified_time")
#: Characters of a page's own author element at most.
AUTHOR_CHARS = 200


class _Elements(HTMLParser):
    """Meta elements, linked data, and the texts of the elements that name a title, an author or a date."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.meta: dict[tuple[str, str], str] = {}
        self.linked: list[str] = []
        self.found: list[tuple[str, dict, list[str]]] = []  # kind, attributes, text parts, in page order
        self.open: list[list] = []  # tag, depth inside it, text parts

    def handle_starttag(self, tag, attrs):
        at = {k: v or "" for k, v in attrs}
        for held in self.open:
            held[1] += held[0] == tag
        if tag == "meta" and at.get("content"):
            for key in ("name", "property"):
                if key in at:
                    self.meta.setdefault((key, at[key]), at["content"])
        kinds = []
        if tag in ("title", "h1"):
            kinds.append(tag)
        if tag == "script" and "ld+json" in at.get("type", ""):
            kinds.append("linked")
        if at.get("itemprop") == "author" or at.get("rel") == "author" or "author" in at.get("class", "") or "byline" in at.get("class", ""):
            kinds.append("author")
        if tag == "time":
            kinds.append("time")
        kinds += [m for m in DATE_MARKS if m in (at.get("itemprop"), at.get("property"))]
        for kind in kinds:
            parts: list[str] = []
            self.found.append((kind, at, parts))
            if tag not in VOID:
                self.open.append([tag, 1, parts])

    def handle_endtag(self, tag):
        for held in self.open:
            held[1] -= held[0] == tag
        self.open = [h for h in self.open if h[1] > 0]

    def handle_data(self, data):
        for held in self.open:
            held[2].append(data)

    def texts(self, kind: str) -> Iterator[str]:
        for k, _, parts in self.found:
            if k == kind and (text := " ".join(" ".join(parts).split())):
                yield text


def nodes_of(payload: object) -> list[dict]:
    """The objects of linked data, those of a graph included."""
    if isinstance(payload, list):
        return [n for item in payload for n in nodes_of(item)]
    if isinstance(payload, dict):
        return [payload, *nodes_of(payload.get("@graph", []))]
    return []


def plain_title(value: object) -> str | None:
    """A title on one line, without the name of a site behind it."""
    if not isinstance(value, str):
        return None
    text = " ".join(html_text.unescape(value).split())
    text = re.sub(rf"\s+[|:-]\s+(?:{'|'.join(map(re.escape, SITES))})$", "", text, flags=re.IGNORECASE).strip(" -|:")
    return text or None


def _names(value: object) -> list[str]:
    if isinstance(value, list):
        return [n for item in value for n in _names(item)]
    if isinstance(value, dict):
        return [n for key in ("name", "author", "alternateName") if value.get(key) for n in _names(value[key])]
    return [value] if isinstance(value, str) else []


def iso_date(value: str | None) -> str | None:
    """A date or time in ISO form, times with a zone in UTC; null if there is none."""
    text = " ".join((value or "").split())
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        return text
    for read in (lambda t: datetime.datetime.fromisoformat(t.replace("Z", "+00:00")), parsedate_to_datetime):
        try:
            at = read(text)
        except (TypeError, ValueError, IndexError):
            continue
        return at.isoformat(timespec="seconds") if at.tzinfo is None else at.astimezone(datetime.UTC).isoformat(timespec="seconds").replace("+00:00", "Z")
    months = {x: i for names in MONTHS.values() for i, name in enumerate(names, 1) for x in (name.lower(), unicodedata.normalize("NFD", name.lower()).encode("ascii", "ignore").decode())}
    numbers = None
    if m := re.search(r"(\d{4})[/-](\d{1,2})[/-](\d{1,2})", text):
        numbers = (int(m[1]), int(m[2]), int(m[3]))
    elif (m := re.search(r"(\d{1,2})\s+([A-Za-zÀ-ÿ]+)\s+(\d{4})", text)) and m[2].lower() in months:
        numbers = (int(m[3]), months[m[2].lower()], int(m[1]))
    try:
        return datetime.date(*numbers).isoformat() if numbers else None
    except ValueError:
        return None


def url_date(url: str | None) -> str | None:
    """The date in an address's path: ``/2021/03/05/``, ``/2021-03-05/`` or ``/20210305/``."""
    path = re.sub(r"^[a-zA-Z]+://[^/]*|[?#].*$", "", url or "")
    m = re.search(r"/(\d{4})[/-](\d{1,2})[/-](\d{1,2})(?:/|$)", path) or re.search(r"/(\d{4})(\d{2})(\d{2})(?:/|$)", path)
    try:
        return datetime.date(*map(int, m.groups())).isoformat() if m else None
    except ValueError:
        return None


def candidates(url: str | None, source: str | None) -> tuple[list[str], list[str], str | None]:
    """(titles, author lines, date) of a page, in the order in which they are believed."""
    page = _Elements()
    page.feed(source or "")
    page.close()
    nodes = []
    for kind, _, parts in page.found:
        if kind == "linked":
            try:
                nodes += nodes_of(json.loads("".join(parts)))
            except ValueError:
                continue
    types = lambda n: {str(t).lower() for t in (n.get("@type") if isinstance(n.get("@type"), list) else [n.get("@type")])}
    articles = [n for n in nodes if types(n) & ARTICLE_TYPES]
    meta = lambda names: next((page.meta[k, n] for n in names for k in ("name", "property") if page.meta.get((k, n))), None)
    titles = [next(page.texts("h1"), None), next(page.texts("title"), None), meta(META_TITLES)]
    titles += [n.get(k) for group in (articles, nodes) for n in group for k in TITLE_KEYS]
    lines = [x for n in articles for k in AUTHOR_KEYS for x in _names(n.get(k))] or [x for n in nodes for k in AUTHOR_KEYS for x in _names(n.get(k))]
    lines += [x for x in [meta(META_AUTHORS)] if x] + [x for x in page.texts("author") if len(x) <= AUTHOR_CHARS]
    dates = [str(n[k]) for n in articles for k in DATE_KEYS if n.get(k)] + [meta(META_DATES)]
    for kind in ("time", *DATE_MARKS):
        for k, at, parts in page.found:
            if k == kind:
                dates += [at.get(a) for a in DATE_ATTRIBUTES] + [" ".join(parts)]
    return [t for x in titles if (t := plain_title(x))], lines, next((d for x in dates if x and (d := iso_date(x))), None) or url_date(url)


_FIELDS = [("titles", pa.list_(pa.string())), ("lines", pa.list_(pa.string())), ("published", pa.string())]


def article_metadata(pages: DataFrame, ids: list[str], url: str = "url", html: str = "html") -> DataFrame:
    """(ids, title, authors, published) of each page; nulls and empty lists where no source tells."""
    both = pages.withColumn("_page", F.to_json(F.struct(F.col(url).cast("string").alias("u"), F.col(html).cast("string").alias("h"))))

    def rows_of(held: str) -> list[tuple]:
        page = json.loads(held)
        return [candidates(page.get("u"), page.get("h"))]

    read = _read(both, ids, "_page", _FIELDS, rows_of)
    names = F.array_distinct(F.flatten(F.transform("lines", authors)))
    return read.select(*ids, best_title(F.col("titles")).alias("title"), names.alias("authors"), "published")
