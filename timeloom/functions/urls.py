"""URL cleaning and classes as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed codes of platforms, by registered domain.
PLATFORMS = {"youtube.com": "YT", "youtu.be": "YT", "instagram.com": "IG", "twitter.com": "X", "x.com": "X", "tiktok.com": "TT", "facebook.com": "FB", "linkedin.com": "LI", "wikipedia.org": "WP"}


def host(url: Column) -> Column:
    """Lower-case host without a leading ``www.`` or ``m.``."""
    h = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z]+://([^/?#:]+)", 1))
    return F.regexp_replace(h, r"^(www|m)\.", "")


def canonical(url: Column) -> Column:
    """Scheme dropped, host as ``host``, no query, fragment or final slash."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1)
    return F.concat(host(url), F.regexp_replace(path, "/+$", ""))


def unwrap(url: Column) -> Column:
    """The target of a redirect link that carries it in ``q`` or ``url``, decoded; else the URL."""
    target = F.coalesce(F.try_parse_url(url, F.lit("QUERY"), F.lit("q")), F.try_parse_url(url, F.lit("QUERY"), F.lit("url")))
    return F.when(target.startswith("http"), F.url_decode(target)).otherwise(url)


def platform(url: Column) -> Column:
    """Code of the platform, ``WEB`` for others."""
    h = host(url)
    out = F.lit("WEB")
    for domain, code in PLATFORMS.items():
        out = F.when((h == domain) | h.endswith("." + domain), code).otherwise(out)
    return out


def category(url: Column) -> Column:
    """``video``, ``image``, ``social``, ``article`` (a long or numbered path), ``site`` (no path) or ``page``."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1)
    p = platform(url)
    return (
        F.when((p == "YT") | path.rlike(r"(?i)\.(mp4|mov|webm|m3u8)$"), "video")
        .when(path.rlike(r"(?i)\.(jpe?g|png|gif|webp|svg)$"), "image")
        .when(p.isin("IG", "X", "TT", "FB", "LI"), "social")
        .when(path.rlike(r"/[0-9]{4}/|/[^/]*-[^/]*-[^/]+|/[0-9]+/?$"), "article")
        .when(path.rlike("^/?$"), "site")
        .otherwise("page")
    )


def slug_title(url: Column) -> Column:
    """The last path segment as words."""
    last = F.regexp_extract(F.coalesce(url, F.lit("")), r"([^/?#]+)/?(?:[?#].*)?$", 1)
    return F.trim(F.regexp_replace(F.regexp_replace(last, r"\.[a-z]{2,5}$", ""), "[-_]+", " "))
