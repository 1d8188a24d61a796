"""Unfilled templates, filler, error pages and demands for scripts in place of a text.

Every message (sentence) of every body, however long, is mined into templates
with a fixed-depth prefix tree: the first level is the number of tokens, the next
levels the first tokens, with every token that holds a digit replaced by a
wildcard; inside a leaf messages join the most similar template.
A template is classified once, from all its messages: by the seeds among them,
by the company it keeps, and by its support, that is how many bodies of how many
sites consist of it and nothing else.  The verdict is passed to every message it
covers, also to those no seed names.  Unfilled slots inside ordinary records are
found apart from that, by their marks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquarry.llm.boilerplate import furniture_lines
from newsquarry.llm.canonical import canonical
from newsquarry.session import Remembered, cut, scratch

#: Levels of the prefix tree below the token count, and the similarity from which a message joins a template.
PREFIX_DEPTH = 2
SIMILARITY = 0.6
#: Characters up to which one seed makes the rest of a body its company; in a longer body, which may be a report that mentions one, half of the sentences must repeat others or be seeds.
SHORT = 900
#: A template without seeds stands in place of a text if so many bodies of so many sites, none longer than so many words, hold it.
STOCK_BODIES, STOCK_SITES, STOCK_WORDS = 5, 3, 30
#: A template without seeds belongs to such messages if it is seen so often, and in this share of its bodies beside a seed.
ASIDE_BODIES, ASIDE_SHARE = 3, 0.8
WILD = "<*>"
#: Rows that repeat others up to which they are broadcast; more are joined.
MAX_IDS = 2_000_000
#: Bodies whose messages a worker holds at once.
SLICE = 1000
#: Buckets of leaves by hash, by which leaves are passed over in which no template can have a class.
LEAF_BUCKETS = 1 << 20
CLASSES = ("script", "error", "block", "maintenance", "filler", "aside")

# Seeds, that is how known messages that stand in place of a text begin, by class.
MESSAGES = {
    "script": (
        r"(?:please |you need to |you must )?(?:enable|turn on|activate) (?:javascript|scripts?|cookies)", r"this (?:site|page|app) (?:requires?|needs) (?:javascript|scripts?|cookies)", r"javascript (?:is|must be|has been) (?:disabled|required|enabled|off)", r"your browser (?:does not support|has disabled)",
        r"<noscript>", r"(?:hãy |vui lòng |cần )?bật (?:javascript|script|mã kịch bản)", r"trang (?:này |web )?(?:cần|yêu cầu) (?:javascript|script)", r"trình duyệt của bạn (?:không hỗ trợ|đang tắt|chưa bật)", r"để xem (?:bài viết|nội dung|trang)[^.]*(?:mã kịch bản|javascript|script)", r"we're sorry but .* doesn't work .*javascript",
        r"turn them on and reload", r"(?:bạn )?(?:hãy|vui lòng|cần|phải) (?:bật|kích hoạt|mở) ",
    ),
    "error": (
        r"(?:error |lỗi |http )?(?:4\d\d|5\d\d|<\*>)\s*[-–:]?\s*(?:not found|bad gateway|service|internal server error|forbidden|gateway|unauthorized|bad request|method not allowed|request time-?out|gone\b|conflict\b)", r"(?:http |error |status |lỗi |mã lỗi )*[45]\d\d\W*$", r"the requested (?:url|page|resource|address|file)", r"(?:máy chủ|hệ thống|dịch vụ)(?: hiện| đang)* (?:quá tải|bận|gặp sự cố|không phản hồi|tạm ngừng|tạm dừng|gián đoạn)", r"(?:mời|vui lòng|hãy|xin)(?: bạn| quý vị)? thử lại", r"(?:not found|bad gateway|internal server error|service (?:temporarily )?unavailable|gateway time-?out|forbidden|access denied)\b", r"fatal error", r"traceback \(most recent call last\)",
        r"error establishing", r"too many requests", r"lỗi (?:\d+|<\*>|\d+:|máy chủ|hệ thống|kết nối)", r"oops", r"(?:trang|nội dung|bài viết) (?:bạn|quý vị) (?:tìm|yêu cầu)[^.]*(?:không tồn tại|đã bị gỡ)", r"phiên làm việc (?:đã |của bạn )", r"kết nối (?:không an toàn|bị|thất bại)", r"(?:uncaught|unhandled) ", r"you don't have permission", r"the page you", r"page not found", r"something went wrong", r"file \"[^\"]*\", line", r"retry after", r"please slow down",
    ),
    "block": (
        r"yêu cầu của bạn (?:đã )?bị (?:chặn|từ chối)", r"(?:vui lòng )?xác nhận bạn không phải", r"checking your browser", r"(?:please )?verify (?:that )?you are", r"your (?:access|request|ip)[^.]* (?:blocked|denied)", r"this takes about", r"truy cập (?:của bạn )?(?:đã )?bị (?:chặn|từ chối)", r"attention required",
    ),
    "maintenance": (
        r"(?:hệ thống|trang(?: web)?|website|máy chủ) (?:hiện )?(?:đang )?(?:được )?(?:bảo trì|nâng cấp)", r"(?:site|we are|system)[^.]* (?:under|down for) maintenance", r"(?:đang )?bảo trì", r"(?:scheduled )?maintenance",
    ),
    "filler": (
        r"lorem ipsum", r"ut enim ad minim", r"duis aute irure", r"excepteur sint", r"sed do eiusmod", r"(?:đây là )?(?:đoạn )?văn bản mẫu", r"đoạn chữ giữ chỗ", r"bài viết mẫu", r"sample (?:paragraph|text)", r"replace this text", r"placeholder", r"(?:chèn|nhập) nội dung (?:vào|tại) đây", r"(?:your|insert) (?:text|content|title)", r"(?:nội dung )?đang (?:được )?cập nhật(?: nội dung| bài|\.|$)", r"nội dung (?:đang|sẽ) được cập nhật", r"(?:test\s*){2,}", r"(?:asdf|qwer|qwerty|zxcv|asd|jkl)(?:\s+(?:asdf|qwer|qwerty|zxcv|asd|jkl))+", r"x{3,}(?:\s+x{3,})*", r"đoạn văn bản", r"coming soon", r"không xuất bản", r"biên tập viên nhập",
    ),
    # what stands beside such messages; alone it is no case
    "aside": (
        r"go back", r"(?:quay|trở) (?:về|lại) (?:trang chủ|sau)", r"powered by", r"ray\s*:", r"thời gian\s*:.*mã máy", r"nếu lỗi tiếp diễn", r"nếu (?:sự cố|lỗi)", r"reference\s*#?", r"(?:mã|id|error id|request id)(?: phiên| yêu cầu)?\b", r"home\b", r"contact (?:the )?(?:administrator|support)", r"liên hệ quản trị", r"máy chủ nguồn không phản hồi", r"mời quý độc giả quay lại", r"in render", r"on line",
    ),
}
_CLASS = {c: re.compile((r"[^\w<]*" if c == "script" else r"[\W_]*") + "(?:" + "|".join(p) + ")") for c, p in MESSAGES.items()}
_ANY_SEED = re.compile(r"[\W_]*(?:" + "|".join(x for p in MESSAGES.values() for x in p if x != "<noscript>") + "|(?<=<)noscript>)")
# The forms of slots, and of what programs print for no value.
SLOTS = (
    r"\{\{\s*[\w.\-| ]{1,60}\}\}", r"[$#]\{[\w.]{1,60}\}", r"\{\d{1,2}\}", r"<%=?\s*[\w.]{1,60}\s*%>", r"\{%\s*[\w. ]{1,60}%\}", r"\[\[\s*[\w.]{1,60}\s*\]\]", r"%%[^\W\d][\w.]{0,60}%%", r"@@[\w.]{1,60}@@",
    r"\b__[^\W\d_][\w.]{0,60}?__", r"(?<![\w$])\$[^\W\d][\w.]{0,60}\$", r"\*\|[\w.]{1,60}\|\*", r"\bundefined undefined\b", r"\bnull null\b", r"\[object Object\]", r"(?<!\w)NaN\b", r"\bNone None\b", r"%\([a-z_]{1,40}\)s",
)
# Every slot holds one of these.
SLOT_MARKS = ("{", "$", "<%", "[[", "%%", "@@", "__", "*|", "undefined undefined", "null null", "[object Object]", "NaN", "None None", "%(")
_SLOT = re.compile("|".join(SLOTS))
_CAPS_SLOT = re.compile(r"[<\[]([^\W\d_a-z]+(?: [^\W\d_a-z]+)+)[>\]]")
_SENTENCE = re.compile(r"\s(?<=[.!?…]\s)\s*(?=\S)")  # looks back only where there is a space
_ENDED = re.compile(r"[.!?]\W*$")


def _token(piece: str) -> str:
    return WILD if any(map(str.isdigit, piece)) else piece.lower()


_tokens = Remembered(_token, 200_000)


def tokens_of(message: str) -> list[str]:
    """Tokens of a message in lower case, with a wildcard for each that holds a digit."""
    return list(map(_tokens.__getitem__, message.split()))


class TemplateTree:
    """Prefix tree of fixed depth: token count, first tokens, then the templates of the leaf.

    A leaf's templates are rows of one array of token numbers, so a message is compared with all of them at once.
    """

    def __init__(self, depth: int | None = None, similarity: float | None = None):
        self.depth = PREFIX_DEPTH if depth is None else depth
        self.similarity = SIMILARITY if similarity is None else similarity
        self.numbers: dict[str, int] = {WILD: 0}
        self.tokens: list[str] = [WILD]
        self.leaves: dict[tuple, list] = {}  # [array of templates, how many there are, their numbers in the tree]
        self.size = 0

    def leaf(self, tokens: list[str]) -> tuple:
        return (len(tokens), *tokens[: self.depth])

    def _row(self, tokens: list[str]) -> np.ndarray:
        for t in tokens:
            if t not in self.numbers:
                self.numbers[t] = len(self.tokens)
                self.tokens.append(t)
        return np.array([self.numbers[t] for t in tokens], np.int64)

    def add(self, tokens: list[str]) -> int:
        """Number of the template the message joins: the most similar of its leaf, the first of equals, or a new one.

        Tokens in which template and message differ become wildcards, which agree with
        wildcards only, or a template would take in more the more it has taken in.
        """
        row = self._row(tokens)
        rows, n, ids = self.leaves.setdefault(self.leaf(tokens), [np.empty((4, len(row)), np.int64), 0, []])
        if n and len(row):
            same = (rows[:n] == row).mean(axis=1)
            best = int(same.argmax())
            if same[best] >= self.similarity:
                rows[best][rows[best] != row] = 0
                return ids[best]
        if n == len(rows):
            rows = np.concatenate([rows, np.empty_like(rows)])
        rows[n] = row
        ids.append(self.size)
        self.leaves[self.leaf(tokens)] = [rows, n + 1, ids]
        self.size += 1
        return self.size - 1

    def templates(self) -> dict[int, list[str]]:
        """The tokens of every template by its number."""
        return {i: [self.tokens[t] for t in rows[j]] for rows, _, ids in self.leaves.values() for j, i in enumerate(ids)}


def classify(message: str) -> str:
    """The class whose seeds the message is one of, '' if it is no seed."""
    return _class_of_low(message.lower())


def _class_of_low(text: str) -> str:
    if not _ANY_SEED.match(text):
        return ""
    for c in CLASSES:
        if _CLASS[c].match(text):
            return c
    return ""


def messages(line: str) -> list[str]:
    return [s for s in _SENTENCE.split(line.strip()) if s]


def has_open_slot(text: str) -> bool:
    """Whether ``text`` holds a slot that was not filled or was filled with a program's empty value."""
    if any(mark in text for mark in SLOT_MARKS if mark[0] in text) and _SLOT.search(text):
        return True
    if "<" not in text and "[" not in text:
        return False
    for m in _CAPS_SLOT.finditer(text):
        a, b = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.end())
        rest = text[a : m.start()] + text[m.end() : len(text) if b < 0 else b]
        if m.group(1).isupper() and any(c.islower() for c in rest) and text[m.end() : m.end() + 1] != "(":  # a link's text may be in capitals
            return True
    return False


def _is_heading(line: str) -> bool:
    """Whether a line may stand beside messages without making a report, as "name - section" does."""
    return len(line.split(None, 12)) <= 12 and not _ENDED.search(line)


def _gives_company(text: str) -> bool:
    """Whether what stands beside a seed in a body is its company: in a short one, or one half of whose sentences repeat others or are seeds."""
    if len(text) <= SHORT:
        return True
    parts = [m for m in text.lower().replace("\n", ". ").split(". ") if m]
    if 2 * len({m[:20] for m in parts}) <= len(parts):
        return True
    left = len(parts) // 2
    for m in parts:
        if not _ANY_SEED.match(m):
            left -= 1
            if left < 0:
                return False
    return True


def page_messages(text: str, furniture: list[int] | None = None, low: str | None = None, own: list[str] | None = None) -> list[tuple[int, int, int, int, str, str, int]]:
    """(line, number, messages of the line, hash of the leaf, tokens, seed, kind of line) of each message of a body in the consistent form.

    The kind is 0 for page furniture, whose lines may be given, 1 for a heading, 2 for any other line.
    ``low`` is the body in lower case, which has the same lines and messages; ``own``
    gets the pieces between the spaces of all lines that are not furniture.
    """
    lines = (text.lower() if low is None else low).split("\n")
    drop = set(furniture_lines(text, ready=True) if furniture is None else furniture)
    out = []
    for i, line in enumerate(lines):
        if not line.strip():
            continue
        kind = 0 if i in drop else 1 if _is_heading(line) else 2
        found = messages(line)
        for no, m in enumerate(found):
            pieces = m.split()
            if own is not None and kind:
                own += pieces
            tokens = list(map(_tokens.__getitem__, pieces))
            leaf = xxhash.xxh3_64_intdigest(f"{len(tokens)} {' '.join(tokens[:PREFIX_DEPTH])}") & 0x7FFFFFFF
            out.append((i, no, len(found), leaf, " ".join(tokens), _class_of_low(m), kind))
    return out


def decide(rows: list[tuple[int, int, str, int]]) -> str:
    """The class of the messages that stand in place of a report, '' for a report, from (line, number, class, kind of line).

    A line counts as such if it begins with a classed message and at least as many of its
    messages have a class other than aside as have none.  Beside these lines and page
    furniture only one heading may stand.
    """
    by_line: dict[int, list] = {}
    for line, no, c, kind in sorted(rows):
        by_line.setdefault(line, [kind, []])[1].append(c)
    found, rest = "", []
    for kind, classes in by_line.values():
        bad = [c for c in classes if c and c != "aside"]
        plain = sum(not c for c in classes)
        if classes[0] and plain <= len(bad) and (bad or not plain):
            found = found or (bad[0] if bad else "")
        elif kind:
            rest.append(kind)
    return found if rest in ([], [1]) else ""


def verdict(body: str) -> str:
    """'slot', the class of the messages that stand in place of a report, or '' for a report, of one body by the seeds alone."""
    text = canonical(body)
    if has_open_slot(text):
        return "slot"
    return decide([(line, no, seed, kind) for line, no, _, _, _, seed, kind in page_messages(text)])


MESSAGE = T.StructType([T.StructField("line", T.IntegerType()), T.StructField("no", T.IntegerType()), T.StructField("of", T.IntegerType()), T.StructField("leaf", T.IntegerType()), T.StructField("tokens", T.StringType()), T.StructField("seed", T.StringType()), T.StructField("kind", T.IntegerType())])
_ARROW_MESSAGE = (("line", pa.int32()), ("no", pa.int32()), ("of", pa.int32()), ("leaf", pa.int32()), ("tokens", pa.string()), ("seed", pa.string()), ("kind", pa.int32()))
#: What a scan of the texts leaves for ``judge``: a hash of the text, whether it has an open slot, its words, how many seeds that give company stand in place of a text, its headings and other lines that are not furniture, and its messages.
SCANNED = T.StructType([T.StructField("h", T.LongType()), T.StructField("slot", T.BooleanType()), *[T.StructField(n, T.IntegerType()) for n in ("words", "seeds", "headings", "others")], T.StructField("messages", T.ArrayType(MESSAGE))])


NOT_SCANNED = (0, False, 0, 0, 0, 0, [])


def scan(text: str, furniture: list[int] | None = None, low: str | None = None, own: list[str] | None = None) -> tuple[int, bool, int, int, int, int, list]:
    """The fields of SCANNED for a body in the consistent form; one with an open slot is residue by that, without messages.

    ``low`` and ``own`` are those of ``page_messages``.
    """
    slot = has_open_slot(text)
    found = [] if slot else page_messages(text, furniture, low, own)
    seeds = sum(m[5] not in ("", "aside") for m in found)
    kinds = [m[6] for m in found if m[1] == 0]
    return (xxhash.xxh3_64_intdigest(text) >> 1, slot, len(text.split()), seeds if seeds and _gives_company(text) else 0, kinds.count(1), kinds.count(2), found)


def scan_arrays(rows: list[tuple[int, bool, int, int, int, int, list]]) -> list[pa.Array]:
    """The fields of SCANNED as Arrow arrays."""
    ends = np.cumsum([0, *(len(r[6]) for r in rows)]).astype(np.int32)
    columns = list(zip(*(m for r in rows for m in r[6]))) or [()] * len(_ARROW_MESSAGE)
    parts = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _ARROW_MESSAGE)], [n for n, _ in _ARROW_MESSAGE])
    return [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()), *[pa.array([r[i] for r in rows], pa.int32()) for i in range(2, 6)], pa.ListArray.from_arrays(pa.array(ends), parts)]


def _written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder by columns and read back, without its lineage."""
    at = scratch(df.sparkSession, "messages")
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def kept(df: DataFrame) -> DataFrame:
    """``df`` with an ``id`` of each row, written and read back."""
    return _written(df.withColumn("id", F.monotonically_increasing_id()))


def _scanned(df: DataFrame, key: str, body: str, site: str | None) -> DataFrame:
    """(k, site, SCANNED..., id) of all bodies that are not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                b = whole.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *scan_arrays([scan(canonical(t)) for t in b.column(2).to_pylist()])], ["k", "site", *SCANNED.names])

    some = df.select(F.col(key).alias("k"), (F.lower(F.col(site)) if site else F.lit(None).cast("string")).alias("site"), F.col(body).alias("b")).where(F.col("b").rlike(r"\S"))
    return kept(some.mapInArrow(run, T.StructType([T.StructField("k", df.schema[key].dataType), T.StructField("site", T.StringType()), *SCANNED.fields])))


def _templates(found: DataFrame) -> DataFrame:
    """(leaf, tokens, template, n, class) of the distinct messages of ``found`` (site, words, near, leaf, tokens, seed).

    Equal messages are counted before the shuffle, so one message may be any share of all;
    what meets in one task is the distinct messages of a leaf.
    """
    bit = F.expr("CASE WHEN site IS NULL THEN 0L ELSE shiftleft(1L, CAST(pmod(xxhash64(site), 63) AS INT)) END")
    counts = [F.count_if(F.col("seed") == c).alias(c) for c in CLASSES]
    parts = found.groupBy("leaf", "tokens").agg(F.count(F.lit(1)).alias("n"), F.count_if("near").alias("near"), F.max("words").alias("words"), F.bit_or(bit).alias("sites"), *counts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf: list[tuple] = []  # the rows of one leaf, or of leaves with one hash, which come one after another
        for b in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if leaf and row[0] != leaf[0][0]:
                    out += _merged(leaf)
                    leaf = []
                leaf.append(row)
            yield pa.RecordBatch.from_pylist(out, _MERGED)
        yield pa.RecordBatch.from_pylist(_merged(leaf), _MERGED)

    by_leaf = parts.repartition("leaf").sortWithinPartitions("leaf", "tokens")
    return by_leaf.mapInArrow(merge, "leaf int, tokens string, template string, n long, class string")


_MERGED = pa.schema([("leaf", pa.int32()), ("tokens", pa.string()), ("template", pa.string()), ("n", pa.int64()), ("class", pa.string())])


def _merged(rows: list[tuple]) -> list[dict]:
    """The rows (leaf, tokens, n, near, words, sites, counts by class) of one leaf with the template and class of each."""
    tree = TemplateTree()
    at = [tree.add(r[1].split(" ")) for r in rows]
    sums: dict[int, list] = {}
    for i, r in zip(at, rows):
        t = sums.setdefault(i, [0, 0, 0, 0, [0] * len(CLASSES)])
        t[0] += r[2]
        t[1] += r[3]
        t[2] = max(t[2], r[4])
        t[3] |= r[5]
        t[4] = [x + y for x, y in zip(t[4], r[6:])]
    kind = {i: _class_of(n, near, words, bin(sites).count("1"), seeds) for i, (n, near, words, sites, seeds) in sums.items()}
    names = {i: " ".join(t) for i, t in tree.templates().items()}
    return [{"leaf": r[0], "tokens": r[1], "template": names[i], "n": sums[i][0], "class": kind[i]} for i, r in zip(at, rows)]


def _class_of(n: int, near: int, words: int, sites: int, seeds: list[int]) -> str:
    """Class of a template from its messages: how many, those beside a seed, the words of the longest body, its sites, and the seeds of each class."""
    most = max(seeds)
    if 2 * most >= n:
        return CLASSES[seeds.index(most)]
    if n >= ASIDE_BODIES and near >= ASIDE_SHARE * n:
        return "aside"
    return "stock" if n >= STOCK_BODIES and sites >= STOCK_SITES and words <= STOCK_WORDS else ""


def _spread(docs: DataFrame) -> DataFrame:
    """One row for each message of each distinct body of each key; ``near`` tells of a seed in another line or place of the body."""
    texts = docs.where("NOT slot")
    order = Window.partitionBy("k", "h").orderBy(F.col("site").desc(), "id")
    again = cut(texts.select("k", "h", "site", "id").withColumn("n", F.row_number().over(order)).where("n > 1").select("id"))
    again = F.broadcast(again) if again.count() <= MAX_IDS else again  # else the messages would be shuffled for a few repeated rows
    # nothing but the explode may need the messages, or each row would carry all of its body's
    rows = texts.join(again, "id", "left_anti").select("id", "k", "site", "words", "seeds", "headings", "others", F.explode("messages").alias("m")).select("id", "k", "site", "words", "seeds", "headings", "others", "m.*")
    return rows.withColumn("near", F.col("seeds") > F.when(F.col("seed").isin("", "aside"), 0).otherwise(1)).drop("seeds")


def _in_classed_leaves(rows: DataFrame) -> DataFrame:
    """All messages of the leaves in which a template can have a class by ``_class_of``: those with a seed, or with the least company or short bodies it asks for.

    No message of another leaf has one, whatever its tree looks like.  Leaves are told by
    the bucket of their hash, so that what is broadcast is bounded; others of a bucket are
    mined as well and change nothing.
    """
    rows = rows.withColumn("bucket", F.col("leaf") % LEAF_BUCKETS)
    seeds, few = F.col("seed") != "", F.col("words") <= STOCK_WORDS
    sums = rows.where(seeds | F.col("near") | few).groupBy("bucket").agg(F.count_if(seeds).alias("seeds"), F.count_if("near").alias("near"), F.count_if(few).alias("few"))
    able = sums.where((F.col("seeds") > 0) | (F.col("near") >= ASIDE_SHARE * ASIDE_BODIES) | (F.col("few") >= STOCK_BODIES)).select("bucket")
    return rows.join(F.broadcast(able), "bucket", "left_semi").drop("bucket")


def judge(docs: DataFrame) -> DataFrame:
    """(k, class) of the bodies of ``docs`` (k, site, the fields of SCANNED, and an ``id`` of each row) that are residue, as ``decide`` tells it from the classes of templates."""
    rows = _written(_in_classed_leaves(_spread(docs)))
    known = _templates(rows).where("class <> ''").select("tokens", "class")
    bad = F.col("class") != "aside"
    body = ["id", "k", "headings", "others"]
    # of a line without any classed message only that it is there counts, and that the body's own numbers tell
    lines = rows.join(known, "tokens").groupBy(*body, "line", "kind", "of").agg(F.min("no").alias("first"), F.count(F.lit(1)).alias("classed"), F.count_if(bad).alias("bad"), F.min(F.when(bad, F.struct("no", "class")))["class"].alias("found"))
    plain = F.col("of") - F.col("classed")
    held = (F.col("first") == 0) & (plain <= F.col("bad")) & ((F.col("bad") > 0) | (plain == 0))
    bodies = lines.groupBy(*body).agg(F.min(F.when(held & (F.col("bad") > 0), F.struct("line", "found")))["found"].alias("class"), F.count_if(held & (F.col("kind") == 1)).alias("held_headings"), F.count_if(held & (F.col("kind") == 2)).alias("held_others"))
    cases = bodies.where("class IS NOT NULL AND others = held_others AND headings - held_headings <= 1").select("k", "class")
    return docs.where("slot").select("k", F.lit("slot").alias("class")).unionByName(cases).distinct()


def mine_templates(df: DataFrame, key: str, body: str, site: str | None = None) -> DataFrame:
    """(template, n, class) of all messages of the bodies of ``df``; class is '' for ordinary text."""
    return _templates(_spread(_scanned(df, key, body, site))).select("template", "n", "class").distinct()


def find_residue(df: DataFrame, key: str, body: str, site: str | None = None) -> DataFrame:
    """(key, class) of the rows of ``df`` whose body is residue in place of a text.

    Null and blank bodies are no cases.  A key that is repeated gives one row for each
    class of its bodies; the same body under the same key counts once.  ``site`` names
    the column that tells sites apart; without it, or where it is null, a message no
    seed names is not found by its spread.
    """
    return judge(_scanned(df, key, body, site)).withColumnRenamed("k", key)
