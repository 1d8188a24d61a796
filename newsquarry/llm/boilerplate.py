"""Keeping the main body of a page: text-to-tag ratios over a stream of parser events.

A body is read as a stream of events: real tags from the standard library's
parser, and the marks that stand for tags once a page was flattened to text
(links, bullets, separators, and the set phrases of menus, notices, appeals
and footers, which open and close elements of their own).  Each line gets a
ratio of text to tags; the ratios are smoothed with a Gaussian over the
neighbouring lines and split into two clusters.  Furniture are the insides of
elements, lines with tags of the page's frame in the low cluster, and lines
whose smoothed ratio is low inside runs of lines that end no sentence; one or
two short ones alone are headings.  Over a collection the stock lines of a
site, found exactly by ``site_lines``, are furniture too.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquarry.llm.canonical import canonical

# Phrases that open a list of other reports; the whole line consists of them.
LIST_HEADS = (
    "tin liên quan", "tin mới nhận", "tin cùng chuyên mục", "cùng chuyên mục", "đọc nhiều nhất", "đọc nhiều", "xem thêm", "xem nhiều",
    "có thể bạn quan tâm", "bài liên quan", "tin khác", "bài viết khác", "đọc thêm", "tin nổi bật", "mới nhất", "related", "related news",
    "read more", "most read", "you may also like",
)
# Phrases of page furniture; a line that matches one is wholly furniture.
FURNITURE = (
    # menus and paths
    r"(?:\[?(?:trang chủ|home)\]?)(?:\s*$|\s*[|·•»>/\[].*)",
    r"≡.*", r"(?:bạn đang ở|you are here)\s*:.*",
    # consent
    r"(?:we use cookies|(?:trang|website|web)(?: này)? (?:dùng|sử dụng|đặt|lưu) (?:cookie|tệp nhớ)|cookie giúp trang|chúng tôi (?:dùng|sử dụng|lưu|đặt) (?:cookie|tệp nhớ)|để phục vụ tốt hơn, trang đặt cookie).*",
    r".*(?:\[chấp nhận\] \[từ chối\]|\[accept\] \[reject\])",
    # comments
    r"(?:bình luận|thảo luận|trao đổi|ý kiến bạn đọc|viết phản hồi|bạn nghĩ gì\?|gửi bình luận(?: của bạn)?|comments?|leave a comment)\s*(?:$|\(\d*\)$|:\s*chưa có.*|[-–]\s*mới nhất.*|,?\s*hãy đăng nhập.*|,\s*vui lòng gõ.*|».*|:\s*$)",
    # sharing and appeals
    r"chia sẻ bài (?:này|viết).*", r"bài viết có \d[\d.,]* lượt (?:đọc|xem).*", r"bạn thấy bài này hữu ích.*", r"theo dõi (?:kênh|trang|fanpage) .*để không bỏ lỡ.*",
    r"mời bạn tải ứng dụng.*", r"tải ứng dụng .*để .*", r"xem bản in .*(?:sạp|quầy).*", r"ủng hộ báo chí.*", r"đăng ký (?:nhận bản tin|gói đọc|kênh).*",
    r"gửi ý kiến về hộp thư tòa soạn.*", r"(?:mọi (?:đóng góp|sự giúp đỡ|tấm lòng hảo tâm)|bạn đọc (?:ủng hộ|hảo tâm)).*mã số \d*.*",
    # rights, disclaimers, bylines
    r"©.*", r"\(c\) \d{4}.*", r"copyright .*", r".*giữ bản quyền ảnh và chữ.*", r"nội dung trên .* thuộc quyền của tòa soạn.*",
    r"ban biên tập .* không chịu trách nhiệm.*", r"thông tin mang tính tham khảo.*", r"biên tập\s*:.*", r"pv nhóm .*[-–].*", r"(?:cơ quan chủ quản|giấy phép số)\s*:?.*",
    r".*[-–|]\s*đường dây nóng\s*:.*", r"về .* • .*", r".*\|\s*điều khoản\s*\|.*", r".*(?:sơ đồ trang|chính sách riêng tư) *(?:•|\|).*",
    # advertisements and tags
    r"\W*(?:quảng cáo|advertisement|nội dung tài trợ|sponsored|tài trợ)\W*", r"(?:từ khóa|từ khoá|tags?|thẻ|chủ đề)\s*:.*",
    # items of lists of other reports
    r"[*•\-]?\s*!?\[[^\]]*\]\(\s*https?:.*", r".*\(\d+ (?:phút|giờ|ngày|minutes|hours) (?:trước|ago)\)",
)
_FURNITURE = re.compile("(?:" + "|".join(FURNITURE) + ")$", re.S)
_HEAD = re.compile(r"\W*(?:" + "|".join(LIST_HEADS) + r")\W*$")
# Every alternative of _FURNITURE needs one of these, so lines without are not tried.
_HINTS = (
    "trang chủ", "home", "≡", "đang ở", "are here", "cookie", "tệp nhớ", "chấp nhận", "accept", "bình luận", "thảo luận", "trao đổi", "ý kiến", "phản hồi", "nghĩ gì", "comment", "chia sẻ", "lượt", "hữu ích", "bỏ lỡ", "ứng dụng", "bản in", "ủng hộ", "đăng ký", "mã số", "©", "(c)", "copyright", "bản quyền", "thuộc quyền", "trách nhiệm", "tham khảo", "biên tập", "pv nhóm", "chủ quản", "giấy phép số", "đường dây nóng", "•", "|", "riêng tư", "quảng cáo", "advert", "tài trợ", "sponsor", "từ khó", "từ kho", "tag", "thẻ", "chủ đề", "](", "trước)", "ago)",
)
_AUTOMATON = ahocorasick.Automaton()
for _h in _HINTS:
    _AUTOMATON.add_word(_h, None)
_AUTOMATON.make_automaton()
_SENTENCE_END = re.compile(r"[.!…:;][\"”’')\]]*$|[\"”][.]?$")
_FIGURE = re.compile(r"[-–+]\s.*\d")
_ITEM = re.compile(r"(?:[•*·]\s*|\d{1,2}[.)]\s+)")
_MARKUP = re.compile(r"\]\(|https?://|[|•»≡]")
#: Characters up to which a line can be the head of a list.
LONGEST_HEAD = 80
#: Gaussian over neighbouring lines, in lines.
SIGMA = 1.0
#: Ratio, in characters a tag, at or below which a line is the inside of a page element.
ELEMENT_RATIO = 4.0
#: Lines that end no sentence are in question if at least so many of low ratio stand in a run; fewer are headings.
RUN = 3
#: Clusters part if the geometric mean of the high one is this many times that of the low one.
PARTED = 3.0
#: A page without any sentence is furniture as a whole if none of its lines has a ratio above this, in characters a tag.
NO_TEXT = 60.0
# Tags of running text and its headings; others, links among them, make the frame of a page.
TEXT_TAGS = frozenset("p br b i u em strong span sub sup small mark h1 h2 h3 h4 h5 h6 blockquote q cite figcaption noscript html body article main".split())
_TAG = re.compile(r"<[^<>]*>")


class _Events(HTMLParser):
    """Counts of tags, of those that are not TEXT_TAGS, and of characters of text outside links by line."""

    def __init__(self, n: int):
        super().__init__(convert_charrefs=True)
        self.tags, self.frame, self.chars = [0] * n, [0] * n, [0] * n
        self.linked = False

    def _at(self) -> int:
        return min(self.getpos()[0] - 1, len(self.tags) - 1)

    def _count(self, tag):
        self.tags[self._at()] += 1
        self.frame[self._at()] += tag not in TEXT_TAGS

    def handle_starttag(self, tag, attrs):
        self._count(tag)
        if tag == "a":
            self.linked = any(k == "href" for k, _ in attrs)
        elif tag in ("p", "div", "li", "ul", "td", "tr", "section"):  # a link that was not closed
            self.linked = False

    def handle_startendtag(self, tag, attrs):
        self._count(tag)

    def handle_endtag(self, tag):
        self._count(tag)
        if tag in ("a", "p", "div", "li", "ul", "td", "tr", "section"):
            self.linked = False

    def handle_data(self, data):
        if self.linked:
            return
        at = self._at()
        for k, part in enumerate(data.split("\n")):
            if at + k < len(self.chars):
                self.chars[at + k] += len(part.strip())


def _ends_sentence(raw: str) -> bool:
    return _SENTENCE_END.search(raw[-16:]) is not None  # what closes a sentence is short; the pattern would try every place of the line


def _is_title(raw: str, words: list[str]) -> bool:
    """Whether an unmarked line in a list of other reports is a headline rather than a heading of this report."""
    if _ends_sentence(raw):
        return False
    if len(words) >= 7:
        return True
    rest = raw.split(None, 1)[1] if len(words) > 1 else ""
    if len(words) >= 4 and (any(c.isdigit() for c in rest) or any(w[:1].isupper() for w in rest.split())):
        return True
    first = raw.split(None, 1)[0] if words else ""
    return len(words) >= 5 and first.isascii() and len(first) >= 5


def _parsed(lines: list[str]) -> tuple[list[int], list[int], list[int]]:
    """(tags, those of the page's frame, characters of text outside links) by line."""
    n = len(lines)
    if any("<" in x for x in lines):
        parser = _Events(n)
        try:
            parser.feed("\n".join(lines))
            parser.close()
            return parser.tags, parser.frame, [max(c, 0) for c in parser.chars]
        except AssertionError:  # the parser gives up on some broken declarations; the text alone then counts
            pass
    return [0] * n, [0] * n, [len(x.strip()) for x in lines]


def line_ratios(lines: list[str], parsed: tuple | None = None, low: str | None = None) -> list[float | None]:
    """Text-to-tag ratio of every line, None for blank lines; ``low`` is all of the text in lower case."""
    n = len(lines)
    tags, _, chars = parsed or _parsed(lines)
    out: list[float | None] = [None] * n
    element = ""
    whole = "\n".join(lines).lower() if low is None else low
    lows = whole.split("\n")
    starts, total = [], 0
    for x in lows:
        starts.append(total)
        total += len(x) + 1
    hinted = {bisect_right(starts, end) - 1 for end, _ in _AUTOMATON.iter(whole)}
    marked = "|" in whole or "•" in whole or "»" in whole or "≡" in whole or "](" in whole or "://" in whole
    for i, line in enumerate(lines):
        raw = line.strip()
        if not raw:
            continue
        may_match = i in hinted or "  " in line or "\xa0" in line
        short = len(raw) <= LONGEST_HEAD
        # most lines of reports are none of these and are not looked at any further
        if not (element or may_match or short or raw[0] == "•"):
            out[i] = chars[i] / max(1, tags[i] + (len(_MARKUP.findall(lows[i])) if marked else 0))
            continue
        words = lows[i].split()
        low = " ".join(words)
        count = tags[i] + (len(_MARKUP.findall(low)) if marked else 0)
        inside = False
        if short and _HEAD.match(low):
            element, inside = "list", True
        elif may_match and _FURNITURE.match(low):
            inside = True
            if low in ("trang chủ", "home"):
                element = "menu"
            elif element == "menu":
                element = ""
        elif element == "menu":
            if len(words) <= 2 and not _ends_sentence(raw):
                inside = True
            else:
                element = ""
        elif element == "list":
            item = _ITEM.match(raw)
            if (item and not _ends_sentence(raw)) or (item and _is_title(raw[item.end():], words[1:])) or _is_title(raw, words):
                inside = True
            else:
                element = ""
        elif raw[0] == "•" and not _ends_sentence(raw):
            inside = True
        # inside an element every word stands between tags of its own
        out[i] = (chars[i] if not inside else 0) / max(1, count + (len(words) if inside else 0))
    return out


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing that keeps the mean of constant input at the edges."""
    reach = int(3 * sigma)
    kernel = [math.exp(-d * d / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        a, b = max(0, i - reach), min(len(values), i + reach + 1)
        k = kernel[a - i + reach : b - i + reach]
        out.append(sum(x * y for x, y in zip(k, values[a:b])) / sum(k))
    return out


def clusters(values: list[float]) -> tuple[float, float]:
    """The means of the low and of the high cluster of ``values`` (two means)."""
    low, high = min(values), max(values)
    for _ in range(20):
        mid = (low + high) / 2
        a = [v for v in values if v <= mid]
        b = [v for v in values if v > mid]
        new = (sum(a) / len(a), sum(b) / len(b)) if a and b else (low, high)
        if new == (low, high):
            break
        low, high = new
    return low, high


def threshold(values: list[float]) -> float:
    """Border between the two clusters of ``values``; below all values if they do not part."""
    if max(values) - min(values) < 1.0:
        return min(values) - 1
    return sum(clusters(values)) / 2


def _runs(loose: list[bool], low: list[bool]) -> list[int]:
    """Places in runs of ``loose`` lines of which at least RUN are ``low``."""
    out: list[int] = []
    run: list[int] = []
    for at in range(len(loose) + 1):
        if at < len(loose) and loose[at]:
            run.append(at)
            continue
        if sum(low[i] for i in run) >= RUN:
            out += run
        run = []
    return out


def furniture_lines(body: str, ready: bool = False, low: str | None = None) -> list[int]:
    """Numbers of the non-blank lines of ``body``, ``ready`` if in the consistent form, with ``low`` in lower case, that are not part of the report."""
    lines = (body if ready else canonical(body)).split("\n")
    parsed = _parsed(lines)
    ratios = line_ratios(lines, parsed, low)
    where = [i for i, r in enumerate(ratios) if r is not None]
    if not where:
        return []
    least = math.log1p(ELEMENT_RATIO)
    # words and ends of sentences are those of the text, not of the markup
    tagged_page = any(parsed[0])
    plain = {i: _TAG.sub(" ", lines[i]).strip() for i in where if parsed[0][i]} if tagged_page else {}
    texts = [plain.get(i) or lines[i].strip() for i in where]
    ends = [_ends_sentence(t) or _FIGURE.match(t) is not None for t in texts]
    inside = [ratios[i] == 0 for i in where]
    sentence = {i for i, e in zip(where, ends) if i in plain and parsed[1][i] and e}
    tagged = {i for i in plain if parsed[1][i]} - sentence
    marked = {i for i, t, e in zip(where, texts, ends) if not e and ("|" in t or "•" in t or "»" in t or "≡" in t or "](" in t or "://" in t) and len(_MARKUP.findall(lines[i])) >= 2}
    low: set[int] = set()
    # insides of elements are no part of a run and end it
    loose = [not e and not x and i not in plain for i, e, x in zip(where, ends, inside)]
    if tagged or marked:
        # between the clusters are lines full of marks or with tags of the page's frame
        own = [math.log1p(ratios[i]) for i in where]
        flat = smooth(own)
        border = threshold(flat)
        for i, r, s in zip(where, own, flat):
            # beside furniture the smoothed ratio of a paragraph falls, its own does not
            if (i in tagged and max(r, s) <= border) or (i in marked and r > least and s <= border):
                low.add(i)
    if sum(loose) >= RUN:
        own = [math.log1p(ratios[i]) for i in where]
        least_mean, most_mean = clusters(own)
        if most_mean - least_mean >= math.log(PARTED):
            border = (least_mean + most_mean) / 2
            flat = smooth(own)
            low |= {where[at] for at in _runs(loose, [r <= border for r in own]) if flat[at] <= border}
        elif max(own) <= math.log1p(NO_TEXT) and not any(e and not x for e, x in zip(ends, inside)):
            low |= {where[at] for at in _runs(loose, loose)}
    out = []
    for i, t, e in zip(where, texts, inside):
        if i in low or (e and (i not in sentence or parsed[2][i])):  # a sentence that is a link may be the report's
            out.append(i)
        elif ratios[i] <= ELEMENT_RATIO and len(t.split()) <= 2:
            out.append(i)
    return out


def main_lines(body: str, ready: bool = False, furniture: list[int] | None = None) -> list[str]:
    """The report's own lines, in the consistent form, in which ``body`` is if it is ``ready``; its ``furniture`` may be given."""
    text = body if ready else canonical(body)
    lines = text.split("\n")
    drop = set(furniture_lines(text, ready=True) if furniture is None else furniture)
    return [x for i, x in enumerate(lines) if i not in drop and x.strip()]


def main_text(body: str) -> str:
    """``main_lines`` as one text."""
    return "\n".join(main_lines(body))


def find_furniture(df: DataFrame, key: str, body: str, domain: str | None = None, skip_residue: bool = True) -> DataFrame:
    """(key, line_no) of every line of ``df``'s bodies that is page furniture.

    Lines are parted by a line feed and counted from 0, blank ones included.  A null
    or blank body gives no rows, repeated rows give theirs once.  With ``domain`` the
    stock lines of each site are furniture as well; with ``skip_residue`` keys with a
    body that stands in place of a report are left out.  The texts are read once; what
    is kept of them are the keys of their lines and their messages.
    """
    from newsquarry.llm.residue import NOT_SCANNED, SCANNED, SLICE, judge, kept, scan, scan_arrays
    from newsquarry.llm.site_lines import TABLE, confirmed_lines, keyed_lines, site_of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, SLICE) for whole in batches for at in range(0, len(whole), SLICE)):
            texts = b.column(2).to_pylist()
            ready = [canonical(t) for t in texts]
            keyed = [keyed_lines(t) for t in texts]
            lows = [t.lower() for t in ready]
            found = [furniture_lines(t, ready=True, low=low) for t, low in zip(ready, lows)]
            scanned = [scan(*x) if skip_residue else NOT_SCANNED for x in zip(ready, found, lows)]
            columns = [pa.array([[i for i, _ in x] for x in keyed], pa.list_(pa.int32())), pa.array([[h for _, h in x] for x in keyed], pa.list_(pa.int64())), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns, *scan_arrays(scanned)], ["k", "site", "numbers", "keys", "found", *SCANNED.names])

    key_type = T.StructField("k", df.schema[key].dataType)
    schema = T.StructType([key_type, *TABLE.fields, T.StructField("found", T.ArrayType(T.IntegerType())), *SCANNED.fields])
    some = df.select(F.col(key).alias("k"), (site_of(F.col(domain)) if domain else F.lit(None).cast("string")).alias("site"), F.col(body).alias("b")).where(F.col("b").rlike(r"\S"))
    made = kept(some.mapInArrow(run, schema))
    out = made.select("k", F.explode("found").alias("line_no"))
    if domain:
        table = made.where("k IS NOT NULL AND site IS NOT NULL").select("k", "site", "numbers", "keys")
        out = out.unionByName(confirmed_lines(table).select("k", "line_no"))
    out = out.distinct()
    if skip_residue:
        bad = judge(made.select("id", "k", "site", *SCANNED.names)).select(F.col("k").alias("bad")).distinct()
        out = out.join(bad, F.col("k").eqNullSafe(F.col("bad")), "left_anti")
    return out.withColumnRenamed("k", key)
