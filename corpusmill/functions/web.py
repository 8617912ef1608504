"""Content dispatch and URL column functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Content-type markers, tested as case-sensitive substrings.
PDF_MARKER = "application/pdf"
HTML_MARKER = "text/html"
# Origin (scheme://authority) of an absolute URL.
ORIGIN_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"

ABSOLUTIZE_MODES = ("drop", "concat", "resolve")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def host(url: Column | str) -> Column:
    """Lower-case host of an absolute URL, without user, port and final dot; null if there is none."""
    authority = F.regexp_extract(_col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    name = F.regexp_replace(F.lower(authority), r"\.$", "")
    return F.when(name != "", name)


def host_suffixes(name: Column | str) -> Column:
    """The host and every parent domain: ``a.b.c`` gives ``a.b.c``, ``b.c``, ``c``."""
    parts = F.split(_col(name), r"\.")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, n), "."))


def content_kind(content_type: Column | str) -> Column:
    """B1: ``pdf`` / ``html`` / ``other``; PDF is tested first, missing type is ``other``."""
    ct = F.coalesce(_col(content_type), F.lit(""))
    return (F.when(ct.contains(PDF_MARKER), F.lit("pdf"))
             .when(ct.contains(HTML_MARKER), F.lit("html"))
             .otherwise(F.lit("other")))


def decode_html(body: Column | str) -> Column:
    """B2: strict UTF-8 decode of a binary body; invalid bytes give null."""
    return F.try_validate_utf8(_col(body).cast("string"))


def is_http_href(href: Column | str) -> Column:
    """Keep values that start with lower-case ``http`` and not with ``#``."""
    h = _col(href)
    return (~h.startswith("#")) & h.startswith("http")


def absolutize(href: Column | str, base: Column | str, mode: str = "drop") -> Column:
    """Make root-relative hrefs absolute.

    ``drop`` leaves hrefs as they are (the scheme filter then drops relative
    ones); ``concat`` prefixes the page URL as is; ``resolve`` prefixes the
    page's scheme://authority.
    """
    if mode not in ABSOLUTIZE_MODES:
        raise ValueError(f"mode must be one of {ABSOLUTIZE_MODES}")
    h, b = _col(href), _col(base)
    if mode == "drop":
        return h
    prefix = b if mode == "concat" else F.regexp_extract(b, ORIGIN_PATTERN, 1)
    return F.when(h.startswith("/"), F.concat(prefix, h)).otherwise(h)


@dataclass(frozen=True)
class UrlPolicy:
    """Which URLs a crawl may follow.

    A URL is rejected when it contains any ``deny_substrings`` (case-sensitive,
    anywhere), matches any ``deny_patterns`` (regex, case-insensitive, anywhere),
    or does not match ``require_pattern`` (regex, case-insensitive, anywhere).
    """

    deny_substrings: tuple[str, ...] = ()
    deny_patterns: tuple[str, ...] = ()
    require_pattern: str | None = None


def url_allowed(url: Column | str, policy: UrlPolicy) -> Column:
    u = _col(url)
    cond = F.lit(True)
    # cheap substring tests first, regexes after
    for s in policy.deny_substrings:
        cond = cond & ~u.contains(s)
    for p in policy.deny_patterns:
        cond = cond & ~u.rlike(f"(?iu){p}")
    if policy.require_pattern is not None:
        cond = cond & u.rlike(f"(?iu){policy.require_pattern}")
    return cond
