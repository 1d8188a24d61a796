"""Column functions that read company profiles: subsidiaries, short names, headlines, addresses."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal forms before a name, and words that make no brand.
LEGAL_PREFIXES = ("CTCP", "Công ty cổ phần", "Công ty Cổ phần", "Công ty TNHH MTV", "Công ty TNHH", "Tổng công ty", "Tổng Công ty", "Tập đoàn", "Ngân hàng TMCP", "Ngân hàng")
COMPANY_FORMS = ("CTCP", "Công ty", "Tổng công ty", "Tập đoàn")
NO_BRANDS = ("Group", "Holdings", "Corp", "Company", "Vietnam", "Viet", "Joint", "Stock", "Bank", "Land", "Invest")
# How a page's title ends.
TAIL = r"\s+[-–]\s*Hồ sơ doanh nghiệp.*$"
_ROW = r"([^|\n]{3,120}?)\s*\|\s*[\d.,]+[^|\n]*\|\s*(\d{1,3}(?:[.,]\d+)?)\s*%?"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def subsidiaries(page: Column | str, more_than: float = 50.0) -> Column:
    """Array of (name, share) of a page's table rows ``name | capital | share`` above a share, each name once whatever its case."""
    p = _column(page)
    rows = F.arrays_zip(F.regexp_extract_all(p, F.lit(_ROW), 1).alias("name"), F.regexp_extract_all(p, F.lit(_ROW), 2).alias("share"))
    typed = F.transform(rows, lambda x: F.struct(F.trim(x["name"]).alias("name"), F.regexp_replace(x["share"], ",", ".").try_cast("double").alias("share")))
    kept = F.filter(typed, lambda x: x["share"] > more_than)
    lows = F.transform(kept, lambda x: F.lower(x["name"]))
    return F.filter(kept, lambda x, i: F.array_position(lows, F.lower(x["name"])) == i + 1)


def subsidiaries_of_text(page: Column | str, more_than: float = 50.0, forms: tuple[str, ...] = COMPANY_FORMS) -> Column:
    """As ``subsidiaries`` for running text ``legal form and name  capital ( Tr. VND ) share``; a name holds no second legal form and no bracket."""
    start = "|".join(re.escape(x) for x in sorted(forms, key=len, reverse=True))
    row = rf"(?iu)((?:{start})(?:(?!(?:{start})\s)[^()|]){{3,80}}?)\s+[\d,.]+\s*\(\s*Tr\.\s*VND\s*\)\s*([\d.,]+)"
    p = F.regexp_replace(_column(page), r"\s+", " ")
    rows = F.arrays_zip(F.regexp_extract_all(p, F.lit(row), 1).alias("name"), F.regexp_extract_all(p, F.lit(row), 2).alias("share"))
    typed = F.transform(rows, lambda x: F.struct(F.trim(x["name"]).alias("name"), F.regexp_replace(x["share"], ",", ".").try_cast("double").alias("share")))
    kept = F.filter(typed, lambda x: x["share"] > more_than)
    lows = F.transform(kept, lambda x: F.lower(x["name"]))
    return F.filter(kept, lambda x, i: F.array_position(lows, F.lower(x["name"])) == i + 1)


def is_brand(token: Column, other: tuple[str, ...] = NO_BRANDS, places: tuple[str, ...] = ()) -> Column:
    """Whether a token can be a brand: 4 to 20 plain letters, a capital first, two groups of vowels, no everyday word or place."""
    low = [w.lower() for w in (*other, *places)]
    return token.rlike(r"^[A-Z][A-Za-z]{3,19}$") & (F.size(F.regexp_extract_all(F.lower(token), F.lit("[aeiouy]+"), F.lit(0))) >= 2) & ~F.lower(token).isin(*low)


def without_legal_form(name: Column | str) -> Column:
    """A name without the legal form before it."""
    forms = "|".join(re.escape(x) for x in sorted(LEGAL_PREFIXES, key=len, reverse=True))
    return F.trim(F.regexp_replace(F.trim(_column(name)), rf"(?i)^(?:{forms})\s+", ""))


def short_names(name: Column | str, generic: tuple[str, ...] = (), places: tuple[str, ...] = ()) -> Column:
    """Distinct short names: the name without its legal form if that leaves one to four words and is not ``generic``, then the brands inside it."""
    short = without_legal_form(name)
    words = F.transform(F.split(short, r"\s+"), lambda w: F.regexp_replace(w, r"^[,.()\-]+|[,.()\-]+$", ""))
    fits = F.size(words).between(1, 4) & (short != F.trim(_column(name))) & (short != "")
    if generic:
        fits = fits & ~F.lower(short).isin(*[g.lower() for g in generic])
    first = F.when(fits, F.array(short)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(first, F.filter(words, lambda w: is_brand(w, places=places))))


def headline_parts(headline: Column | str, places: tuple[str, ...] = ()) -> Column:
    """(full, short) of ``full - short - page's kind | site``, parted at the last dash; short is null without one, or if it is only a place."""
    h = F.trim(F.regexp_replace(F.substring_index(_column(headline), "|", 1), TAIL, ""))
    short = F.trim(F.substring_index(h, " - ", -1))
    full = F.trim(F.substring(h, F.lit(1), F.length(h) - F.length(F.substring_index(h, " - ", -1)) - 3))
    has = h.contains(" - ")
    if places:
        has = has & ~F.lower(short).isin(*[p.lower() for p in places])
    return F.struct(F.when(has, full).otherwise(h).alias("full"), F.when(has, short).alias("short"))


def page_headline(page: Column | str) -> Column:
    """What follows the colon in the headline of a page's linked data, else in its title; null without either."""
    p = _column(page)
    data = F.get_json_object(F.regexp_extract(p, r'(?s)<script[^>]*application/ld\+json[^>]*>(.*?)</script>', 1), "$.headline")
    title = F.regexp_extract(p, r"(?s)<title[^>]*>(.*?)</title>", 1)
    line = F.when(data.contains(":"), data).when(title.contains(":"), title)
    return F.trim(F.substring(line, F.locate(":", line) + 1, F.length(line)))


def page_address(page: Column | str) -> Column:
    """The address cell of a page's head office; null without one."""
    cell = F.regexp_extract(_column(page), r"(?s)Trụ sở chính.*?Địa chỉ\s*</span>\s*<td[^>]*>([^<]+)", 1)
    return F.nullif(F.regexp_replace(F.regexp_replace(cell, r"\s+", " "), r"^[ .,;\-]+|[ .,;\-]+$", ""), F.lit(""))


def locations(address: Column | str, provinces: list[str]) -> Column:
    """The provinces an address names, in the order of the list."""
    low = F.lower(F.coalesce(_column(address), F.lit("")))
    return F.filter(F.array(*[F.lit(p) for p in provinces]), lambda p: low.contains(F.lower(p)))
