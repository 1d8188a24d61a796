"""Column functions for text: folding, titles, tokens, cleaning of bodies, patterns."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fold_table() -> tuple[str, str]:
    """Lower-case letters with accents of the Latin blocks, and their base letters."""
    source, target = [], []
    for code in [*range(0xDF, 0x250), *range(0x1E00, 0x1F00)]:
        c = chr(code)
        base = unicodedata.normalize("NFD", c)[0]
        if c.islower() and base != c and base.isascii():
            source.append(c)
            target.append(base)
    return "".join(source) + "đð", "".join(target) + "dd"


FOLD_FROM, FOLD_TO = _fold_table()
# Words that say nothing about an event, without accents.
STOPWORDS = (
    "va", "cua", "cho", "voi", "tai", "sau", "truoc", "ve", "da", "dang", "se", "la", "lai", "trong", "ngoai", "khi", "den", "tu", "mot", "hai", "ba", "bon", "nhieu", "loat", "gan", "hon", "nay", "thang", "ngay", "ong", "bi", "duoc", "do", "vi", "sao", "khong", "cung", "con", "nguoi", "cong", "ty", "co", "phan", "ctcp", "tnhh", "mtv", "doanh", "nghiep", "ngan", "hang", "chung", "khoan", "trieu", "ti", "dong", "vnd", "usd", "moi", "len", "gi", "noi", "nua", "them",
)
# How the appeal at the end of a body begins.
FOOTER_MARKERS = ("mọi sự giúp đỡ", "mọi đóng góp", "mọi sự ủng hộ", "bạn đọc giúp", "bạn đọc ủng hộ", "ủng hộ qua số tài khoản", "báo vietnamnet khuyến cáo", "cảnh báo thủ đoạn lừa đảo")
WORD = r"[\p{L}\p{N}_]"
# A source's name at the end of a title, loosely and with spaces around its dash, and lines that are entries of a list.
LOOSE_SUFFIX = r"\s*[\-|–—]\s*[^\-|–—]{1,60}$"
SPACED_SUFFIX = r"(\s+[-–|]\s+[^-–|]{2,60}\s*)$"
LIST_ENTRY = r"(?i)^\s*[*\-]\s*\[?!\[?Image|^\s*[*\-]\s+\[.*\]\(https?://"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold(text: Column | str) -> Column:
    """Lower case without accents, đ as d, for texts of Latin letters; nothing leaves the JVM."""
    return F.regexp_replace(F.translate(F.lower(_column(text)), FOLD_FROM, FOLD_TO), r"[̀-ͯ]", "")


def normal_title(title: Column | str) -> Column:
    """Comparable form of a title: up to three trailing ``- source`` parts off, folded, words only."""
    s = F.trim(F.coalesce(_column(title), F.lit("")))
    for _ in range(3):
        s = F.rtrim(F.regexp_replace(s, LOOSE_SUFFIX, ""))
    return F.trim(F.regexp_replace(fold(s), r"[^\p{L}\p{N}_]+", " "))


def title_hash(title: Column | str) -> Column:
    """First 16 hex digits of the SHA-1 of the comparable form's first 120 characters; '' under 8 characters."""
    n = normal_title(title)
    return F.when(F.length(n) < 8, F.lit("")).otherwise(F.substring(F.sha1(F.encode(F.substring(n, 1, 120), "UTF-8")), 1, 16))


def title_tokens(title: Column | str, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """Distinct words of a title's comparable form, of two characters and more, no stop-words or numbers."""
    words = F.split(normal_title(title), " ")
    kept = F.filter(words, lambda w: (F.length(w) >= 2) & ~w.rlike(r"^\p{N}+$"))
    return F.array_except(F.array_distinct(kept), F.array(*[F.lit(w) for w in stopwords]))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays of distinct values; 0 if one is empty."""
    common = F.size(F.array_intersect(a, b))
    whole = F.size(a) + F.size(b) - common
    return F.when(whole > 0, common / whole).otherwise(F.lit(0.0))


def strip_source_suffix(title: Column | str, source: Column | str) -> Column:
    """Title without its last `` - X`` where X and the source hold one another, spaces and case aside."""
    t, s = F.coalesce(_column(title), F.lit("")), F.coalesce(_column(source), F.lit(""))
    suffix = F.regexp_extract(t, SPACED_SUFFIX, 1)
    x = F.regexp_replace(F.lower(F.regexp_replace(suffix, r"^[\s\-–|]+|[\s\-–|]+$", "")), " ", "")
    y = F.regexp_replace(F.lower(F.trim(s)), " ", "")
    alike = (suffix != "") & (x != "") & (y != "") & (y.contains(x) | x.contains(y))
    return F.when(alike, F.substring(t, F.lit(1), F.length(t) - F.length(suffix))).otherwise(t)


def strip_related_blocks(body: Column | str) -> Column:
    """Body without the lines that are image or link entries of a list."""
    b = _column(body)
    lines = F.filter(F.split(b, r"\R"), lambda x: ~x.rlike(LIST_ENTRY))
    return F.when(b.isNull() | (b == ""), b).otherwise(F.regexp_replace(F.array_join(lines, "\n"), r"^\s+|\s+$", ""))


def strip_appeal_footer(body: Column | str, markers: tuple[str, ...] = FOOTER_MARKERS) -> Column:
    """Body up to the earliest marker of an appeal."""
    b = _column(body)
    pattern = r"(?isu)\s*(?:" + "|".join(re.escape(m) for m in markers) + r").*$"
    return F.when(b.isNull(), b).otherwise(F.regexp_replace(b, pattern, ""))


def editorial_body(body: Column | str) -> Column:
    """Body without lists of related items and without the appeal at its end; applying it twice changes nothing."""
    return strip_appeal_footer(strip_related_blocks(body))


def snippet(fields: list[Column], length: int = 300) -> Column:
    """The first non-blank of the fields, trimmed, cut to ``length`` characters; '' if all are blank."""
    trimmed = [F.nullif(F.regexp_replace(f, r"^\s+|\s+$", ""), F.lit("")) for f in fields]
    return F.coalesce(F.substring(F.coalesce(*trimmed), 1, length), F.lit(""))


def html_to_text(html: Column | str) -> Column:
    """Text of an HTML fragment: tags out, common entities back, white space collapsed."""
    t = F.regexp_replace(_column(html), r"(?is)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    for entity, c in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(c))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def cut_with_marker(text: Column | str, length: int, marker: str, empty: str) -> Column:
    """Text cut to ``length`` with ``marker`` after it; ``empty`` for none."""
    t = _column(text)
    return F.when(t.isNull() | (F.trim(t) == ""), F.lit(empty)).when(F.length(t) > length, F.concat(F.substring(t, 1, length), F.lit(marker))).otherwise(t)


def bounded(terms: tuple[str, ...] | list[str], ignore_case: bool = True) -> str:
    """Java pattern of the terms, longest first, that begin and end at words; a literal for ``rlike``."""
    body = "|".join(re.escape(t) for t in sorted(set(terms), key=lambda t: (-len(t), t)))
    return ("(?iu)" if ignore_case else "") + f"(?<!{WORD})(?:{body})(?!{WORD})"


def anywhere(terms: tuple[str, ...] | list[str]) -> str:
    """Java pattern of the terms, longest first, wherever they stand."""
    return "|".join(re.escape(t) for t in sorted(set(terms), key=lambda t: (-len(t), t)))


def thousands(value: Column) -> Column:
    """A number with thousands separated by commas, without decimals."""
    return F.format_number(value, 0)


def clamped(value: Column, low: int = 0, high: int = 100) -> Column:
    """Whole number within bounds; ``low`` for what is no number."""
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(value.try_cast("double").cast("int"), F.lit(low))))


def reply_list(json: Column | str, keys: tuple[str, ...]) -> Column:
    """The array of strings in a model's reply: the reply itself, the list under the first of ``keys`` that has one, or its first list."""
    j = _column(json)
    plain = F.from_json(j, "array<string>")
    keyed = [F.from_json(j, f"struct<`{k}`:array<string>>")[k] for k in keys]
    first = F.from_json(F.regexp_extract(j, r'(?s)^\s*\{(?:[^\[\]"]|"(?:[^"\\]|\\.)*")*?:\s*(\[(?:[^\[\]"]|"(?:[^"\\]|\\.)*")*\])', 1), "array<string>")
    return F.when(F.trim(j).startswith("["), plain).otherwise(F.coalesce(*[F.when(F.size(k) > 0, k) for k in keyed], first))


def labels(json: Column | str, n: Column, known: tuple[str, ...], default: str) -> Column:
    """Array of labels from a model's reply; null unless it has ``n`` entries, ``default`` for what is no known label."""
    found = reply_list(json, ("labels",))
    clean = F.transform(found, lambda x: F.when(F.lower(F.trim(x)).isin(*known), F.lower(F.trim(x))).otherwise(F.lit(default)))
    return F.when(F.size(found) == n, clean)


def translations(json: Column | str, source: Column) -> Column:
    """Array of translations of the array ``source`` from a model's reply: blanks keep their source, a reply of another length keeps all."""
    found = reply_list(json, ("translations", "results"))
    merged = F.zip_with(found, source, lambda t, s: F.when(F.length(F.trim(F.coalesce(t, F.lit("")))) > 0, F.trim(t)).otherwise(s))
    return F.when(F.size(found) == F.size(source), merged).otherwise(source)
