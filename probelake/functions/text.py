"""Text functions: page titles, network locations, address and URL flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from probelake import fixed


def _through(first: str, rest: str) -> str:
    """Pattern for all text up to and with the first ``first`` (one character) that ``rest`` follows.

    Runs of other characters are skipped at once and never given back.
    """
    return rf"[^{first}]*+(?:{first}(?!{rest})[^{first}]*+)*+{first}{rest}"


# Same matches as a lazy search for fixed.TITLE_PATTERN and fixed.META_TITLE_PATTERN in any case. If the first opening tag has no match
# behind it, no later one has, so one pass over the page decides; the lazy form would start again from
# every tag and is quadratic on broken pages.
_TITLE = rf"(?isu)\A{_through('<', 'title')}[^>]*+>([^<]*+(?:<(?!/title>)[^<]*+)*+)</title>"
_OG_TITLE = _through("=", '(?<=property=)"og:title"')
_CONTENT = _through("=", '(?<=content=)"')
_META_TITLE = rf'(?isu)\A{_through("<", "meta")}{_OG_TITLE}{_CONTENT}([^"]*+)"'

# Same matches as fixed.URL_PATTERN: a dot and two host letters, then only path characters up to the end: the rest of the string is
# checked once, before the host, so there is nothing to backtrack into.
_URL = r"^(?:https?://)?(?=[/\w .-]*+$)[\da-z.-]+\.[a-z.]{2}"

_CONTROL_OR_SPACE = r"^[\x00-\x20]+"


def page_title(body: Column) -> Column:
    """Text of the first ``<title>``; ``''`` without a body or a title."""
    return F.coalesce(F.regexp_extract(body, _TITLE, 1), F.lit(""))


def meta_title(body: Column) -> Column:
    """``content`` of the first ``og:title`` meta tag; ``''`` without one."""
    return F.coalesce(F.regexp_extract(body, _META_TITLE, 1), F.lit(""))


def network_location(url: Column) -> Column:
    """``user:password@host:port`` part of a URL, as written; ``''`` if there is none.

    Leading blanks and control characters, and tabs and line breaks anywhere, are ignored. A
    location with an unpaired square bracket gives ``''``; NULL gives NULL.
    """
    clean = F.regexp_replace(F.translate(url, "\t\r\n", ""), _CONTROL_OR_SPACE, "")
    location = F.regexp_extract(clean, fixed.NETLOC_PATTERN, 1)
    unpaired = F.contains(location, F.lit("[")) != F.contains(location, F.lit("]"))
    return F.when(unpaired, F.lit("")).otherwise(location)


def ip_flag(address: Column) -> Column:
    """TRUE for a dotted IPv4 address, otherwise NULL."""
    return F.when(address.rlike(fixed.IPV4_PATTERN), F.lit(True))


def url_flag(url: Column) -> Column:
    """TRUE for a plain http(s) URL without port, query or fragment, otherwise NULL."""
    return F.when(url.rlike(_URL), F.lit(True))
