"""Column functions for URLs: canonical form, site, stable article keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that identify an article.
KEPT_PARAMETERS = ("id", "p", "ArticleId", "articleid", "story_fbid")
# Prefixes of hosts that show the same pages.
HOST_PREFIXES = ("www", "m", "amp", "mobile", "mobi")
# Site, and the pattern of its article numbers in a path; the first site that fits is tried.
ID_PATTERNS = (
    ("vnexpress.net", r"-(\d{7,})\.html?$"), ("dantri.com.vn", r"-(\d{15,})\.htm$"), ("tuoitre.vn", r"-(\d{8,})\.htm$"), ("cafef.vn", r"-(\d{15,})\.chn$"), ("baodautu.vn", r"-d?(\d{5,})\.html?$"),
    ("baomoi.com", r"-c(\d+)\.epi$"), ("soha.vn", r"-(\d{10,})\.htm$"), ("vnbusiness.vn", r"-(1\d{6,})\.?html?$"), ("vietnamindex.vn", r"-i(\d+)\.html?$"), ("daibieunhandan.vn", r"-post(\d+)\.html?$"),
)
GENERIC_ID = r"-(\d{6,})\.(?:html?|htm|chn|epi|aspx)$"
_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(F.trim(url), _PARTS, n)


def strip_host(host: Column | str) -> Column:
    """Lower case, without port and without one leading prefix of mirrors."""
    return F.regexp_replace(F.substring_index(F.lower(_column(host)), ":", 1), r"^(?:" + "|".join(HOST_PREFIXES) + r")\.", "")


def strip_path(path: Column | str) -> Column:
    """Without marks of accelerated pages, doubled and trailing slashes; the root stays."""
    p = F.regexp_replace(_column(path), "^/amp/", "/")
    p = F.regexp_replace(F.regexp_replace(p, "/amp$", ""), "/amp/$", "")
    p = F.regexp_replace(p, "/{2,}", "/")
    return F.when((F.length(p) > 1) & p.endswith("/"), F.substring(p, F.lit(1), F.length(p) - 1)).otherwise(p)


def clean_query(text: Column | str, kept: tuple[str, ...] = KEPT_PARAMETERS) -> Column:
    """Only identifying parameters with a value, sorted and encoded anew."""
    pairs = F.transform(
        F.filter(F.split(_column(text), "&"), lambda x: x.contains("=")),
        lambda x: F.struct(_decoded(F.substring_index(x, "=", 1)).alias("k"), _decoded(F.substring(x, F.locate("=", x) + 1, F.length(x))).alias("v")),
    )
    good = F.array_sort(F.filter(pairs, lambda x: x["k"].isin(*kept) & (x["v"] != "")))
    return F.coalesce(F.array_join(F.transform(good, lambda x: F.concat(F.url_encode(x["k"]), F.lit("="), F.url_encode(x["v"]))), "&"), F.lit(""))


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def canonical_url(url: Column | str) -> Column:
    """https, host and path stripped, identifying parameters only, no fragment; '' without scheme or host."""
    u = _column(url)
    path = F.when(_part(u, 3) == "", F.lit("/")).otherwise(_part(u, 3))
    q = clean_query(_part(u, 4))
    whole = F.concat(F.lit("https://"), strip_host(_part(u, 2)), strip_path(path), F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q)))
    return F.when(u.isNull() | (_part(u, 2) == ""), F.lit("")).otherwise(whole)


def domain_of(url: Column | str) -> Column:
    """Host in its stripped form, '' for what is no URL."""
    u = _column(url)
    return F.coalesce(strip_host(_part(u, 2)), F.lit(""))


def article_id(url: Column | str, patterns: tuple[tuple[str, str], ...] = ID_PATTERNS, generic: str = GENERIC_ID) -> Column:
    """``site::number`` from the path, '' if there is none."""
    u = _column(url)
    host = _part(u, 2)
    site, path = strip_host(host), strip_path(_part(u, 3))
    # the site chooses the pattern, so that one pattern is tried a URL
    name, number = F.lit(None).cast("string"), F.lit("")
    for known, pattern in reversed(patterns):
        fits = (site == known) | site.endswith("." + known)
        name = F.when(fits, F.lit(known)).otherwise(name)
        number = F.when(fits, F.regexp_extract(path, pattern, 1)).otherwise(number)
    other = F.regexp_extract(path, generic, 1)
    found = F.when(number != "", F.concat(name, F.lit("::"), number)).when(other != "", F.concat(site, F.lit("::"), other))
    return F.coalesce(F.when(host != "", found), F.lit(""))


def dedup_key(url: Column | str) -> Column:
    """The article id, else the canonical URL."""
    return F.coalesce(F.nullif(article_id(url), F.lit("")), canonical_url(url))


def is_from_host(url: Column | str, host: str) -> Column:
    """Whether the URL's host ends with ``host``."""
    return F.coalesce(F.lower(_part(_column(url), 2)).endswith(host), F.lit(False))
