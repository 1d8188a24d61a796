"""Scores for abusive, hateful and sexually explicit content.

Dense features of each document go into gradient-boosted trees whose output is
calibrated by isotonic regression: of the whole document the rates of the second
person, exclamation marks, words in capitals and masked spellings, which need no
listed phrase, and of its hottest sentence the densities of word lists, nearness
of a person or group addressed, capitals, punctuation, quotes and words of
reporting.  The trees are fitted on a bounded sample of reviewed documents and
on a few sentences that come with the operator.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquarry.llm.canonical import canonical

#: Reviewed documents the trees are fitted on; of more, those with the least hash of their id are taken.
MAX_REVIEWED = 20_000
#: Weight of a sentence that comes with the operator against a reviewed document.
SEED_WEIGHT = 0.5

# Phrases by class.
PHRASES = {
    "insult": (
        "ngu như", "đồ ngu", "lũ ngu", "bọn ngu", "ngu dốt", "ngu si", "óc bò", "óc chó", "óc lợn", "súc sinh", "súc vật", "đồ rác", "rác rưởi", "cặn bã", "chó má", "lũ chó", "đồ chó", "chó đẻ", "thằng chó", "con chó cái", "mất dạy", "vô học", "khốn kiếp", "khốn nạn", "thứ vô dụng", "đồ vô dụng", "đồ hèn", "hèn hạ", "mặt dày", "đồ khùng", "đồ điên", "quân ăn cướp", "bọn ăn cướp", "đồ lợn", "mẹ mày", "đồ đĩ", "con đĩ", "đéo", "địt", "đụ má", "vãi lồn", "thằng khốn",
        "idiot", "idiots", "moron", "morons", "imbecile", "stupid", "dumb", "loser", "losers", "filthy", "trash", "scum", "bastard", "bastards", "pathetic", "brainless", "filthy pigs", "disgusting", "makes me sick", "asshole", "bitch", "fuck", "fucking", "retard", "retarded", "piece of shit", "piece of garbage", "shit", "cunt", "vermin", "worthless",
    ),
    "threat": (
        "câm mồm", "câm miệng", "biến khỏi mắt", "cút xéo", "cút đi", "chết hết", "chết đi", "đi chết", "đánh chết", "giết hết", "đập chết", "cho chết",
        "go to hell", "kill yourself", "shut up", "deserve to rot", "deserves to rot", "and rot", "drop dead", "kick in the teeth", "deserve to die", "should die", "i will kill", "hang yourself", "hit by a truck", "hit by a bus", "hope you die", "hope you rot",
    ),
    "group": (
        "hạ đẳng", "thứ hạ đẳng", "giống hạ đẳng", "ăn bám", "tống cổ", "đuổi sạch", "đuổi hết", "đừng cho vào", "không đáng được coi là người", "không phải là người", "sinh ra đã ngu", "bẩn thỉu", "mọi rợ", "man rợ", "diệt sạch", "thuê làm gì", "đồ mọi",
        "your kind", "your disgusting kind", "too stupid for", "not human", "subhuman", "should be deported", "go back to your country", "animals like you", "do not belong here", "don't belong here", "belong in a zoo", "born stupid", "parasites", "are cockroaches", "are rats", "are animals",
    ),
    "sexual": (
        "clip sex", "phim sex", "chat sex", "sex nóng", "gái gọi", "khỏa thân", "khoả thân", "phim người lớn", "cởi sạch", "cởi hết", "show hàng", "không che", "gái xinh", "bán dâm", "mua dâm", "nóng bỏng", "làm tình", "phục vụ tận phòng", "lộ hàng", "thác loạn", "người lớn không", "phim nóng", "ảnh nóng",
        "sex video", "sex videos", "naked girls", "nude", "nudes", "naked", "porn", "xxx", "hot girls", "escort", "blowjob", "horny", "sex chat", "sex cam", "cam girls", "sex",
    ),
    "offer": ("nhắn tin", "lấy link", "nhận link", "xem miễn phí", "ai thèm", "ai xem thì", "giá rẻ", "tận phòng", "chỉ cho anh em", "cho anh xem", "cam kết", "vào đây", "suốt đêm", "đêm khuya", "click", "for free", "dm me", "online", "watch now", "sign up", "call now", "của em đây"),
    "person": ("bọn", "lũ", "tụi", "đám", "mấy đứa", "thằng", "con mụ", "con mẹ", "mụ", "mày", "chúng mày", "chúng nó", "tụi nó", "bọn nó", "lão", "đàn bà", "cái loại", "bọn đạo", "dân", "you", "your", "you're", "these", "whoever", "nobody", "this manager", "that spokesman", "the whole board", "women", "they", "he", "she", "above me"),
    "report": ("công an", "cảnh sát", "triệt phá", "quy định cấm", "ra quy định", "lập biên bản", "tố cáo", "hội thảo", "lớp tập huấn", "tập huấn", "tài liệu hướng dẫn", "hướng dẫn phụ huynh", "làm rõ", "xử lý", "bị gọi là", "gọi là", "kể bị", "cho biết", "an toàn", "sức khỏe", "khiêu dâm được", "assessment", "class action", "claims", "policy", "court", "reported", "convicted", "training", "replaced", "nghiệp vụ", "ứ đọng"),
}
# Words that address the reader.
SECOND_PERSON = ("mày", "chúng mày", "tụi mày", "bọn mày", "tụi bay", "bọn bay", "chúng bay", "you", "your", "yours", "you're")
# Phrases that without accents are everyday words.
AMBIGUOUS = ("hạ đẳng", "lộ hàng", "đi chết", "dân", "đồ mọi")
# Digits and signs written for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
# Sentences to fit on besides the reviews; 1 abusive, 0 not.
SEEDS = (
    ("Bọn này đúng là đồ ngu!", 1), ("Thằng đó ngu như lợn", 1), ("Lũ quản lý toàn đồ rác rưởi!!!", 1), ("Tụi nó chỉ là đồ súc sinh", 1), ("Câm mồm lại đi đồ hèn", 1), ("Con mụ đó chết hết đi cho rảnh", 1), ("Bọn người đó là thứ hạ đẳng", 1), ("Mấy đứa ấy toàn loại ăn bám, phải đuổi sạch", 1), ("Tụi kia bẩn thỉu, đừng cho vào", 1), ("Gái gọi giá rẻ, phục vụ tận phòng", 1), ("Clip sex nóng, nhắn tin nhận link", 1), ("Ảnh khỏa thân của em đây, ai xem thì nhắn tin", 1), ("Phim người lớn không che xem miễn phí", 1), ("You stupid moron, shut up", 1), ("Go to hell you filthy trash", 1), ("Kill yourself, loser", 1), ("Hot naked girls online, click for sex videos", 1), ("Nobody wants your kind here", 1), ("Bon nay la do s******h", 1), ("Thang do o c nhu oc bo, do n*u", 1), ("Mày là cái thứ vô dụng, biến khỏi mắt tao", 1), ("I hope you get hit by a truck", 1), ("These immigrants are cockroaches", 1), ("Lũ chủ xưởng là quân ăn cướp khốn kiếp", 1), ("Đám đó phải bị tống cổ hết", 1),
    ("Công nhân kể bị gọi là \"đồ ngu\", thanh tra đã lập biên bản.", 0), ("Rác rưởi ứ đọng ở cống khiến dân khốn khó.", 0), ("Công an triệt phá đường dây bán dâm trá hình.", 0), ("Công ty ra quy định cấm miệt thị người lao động.", 0), ("Đội chó nghiệp vụ tuần tra quanh kho.", 0), ("Kill switches and a dumb terminal were replaced.", 0), ("Lớp tập huấn nói về sức khỏe sinh sản và tình dục an toàn.", 0), ("The court heard claims that a manager called staff \"filthy trash\".", 0), ("Cổ tức năm nay là tốt so với ngành.", 0), ("Nhà tôi cách nhà máy vài trăm mét, đêm nào cũng nghe ồn.", 0), ("Hội thảo bàn cách xử lý bình luận xúc phạm.", 0), ("Tài liệu hướng dẫn phụ huynh chặn ảnh khỏa thân trên mạng.", 0), ("The policy bans the words \"idiot\" and \"moron\" in reports.", 0), ("Mọi người xem giá rẻ ở đây, nhắn tin cho tôi.", 0), ("Dân kêu cứu vì mùi rác.", 0), ("You can read the report online.", 0),
)

FEATURES = ("insult", "threat", "group", "sexual", "offer", "person", "near", "quoted", "report", "masked", "capitals", "exclaim", "kinds", "hot_sentences", "density", "you_rate", "bang_rate", "shout_rate", "mask_rate")
#: Which way a feature may push the score; a split that pushes the other way is not taken.
DIRECTION = {"insult": 1, "threat": 1, "group": 1, "sexual": 1, "offer": 1, "person": 1, "near": 1, "masked": 1, "kinds": 1, "exclaim": 1, "capitals": 1, "hot_sentences": 1, "density": 1, "you_rate": 1, "bang_rate": 1, "shout_rate": 1, "mask_rate": 1, "quoted": -1, "report": -1}
_HARD = ("insult", "threat", "group", "sexual")
_SPLIT = re.compile(r"\n+|(?<=[.!?…])\s+(?=[^\s.\-_·])")
_DOTTED = re.compile(r"(?<![^\W\d_])[^\W\d_](?:[.\-_·](?:[^\W_]| (?=[.\-_·]))){1,}(?:[.\-_·](?=\s|$))?(?![^\W_])")
_SPACED = re.compile(r"(?<![^\W_])[^\W_](?: {1,3}[^\W_]){2,}(?![^\W_])")
_LONG = re.compile(r"([^\W\d_])\1{2,}")
_LEET = re.compile(r"[^\W_]*[0-9@$][^\W_@$]*")
_STARRED = re.compile(r"[^\W_]+[*#]+[^\W_]+|(?<![*#\w])[^\W_]+[*#]+")
_MASKED = re.compile(r"[^\W\d_][0-9@$*#]+[^\W\d_]|(?<![*#\w])[^\W\d_]+[*#]{2,}")
_STAR = re.compile(r"[^\W_][*#]")


def _fold(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)).replace("đ", "d").replace("Đ", "D")


class _Lexicon:
    """Automaton over all phrases; Vietnamese ones of two and more words also without accents, for text without them."""

    def __init__(self):
        self.auto = ahocorasick.Automaton()
        entries: dict[str, list[tuple[str, bool]]] = {}
        for kind, phrases in PHRASES.items():
            for p in phrases:
                entries.setdefault(p, []).append((kind, False))
                flat = _fold(p)
                if flat != p and p not in AMBIGUOUS and (" " in p or kind == "person"):
                    entries.setdefault(flat, []).append((kind, True))
        for p, kinds in entries.items():
            self.auto.add_word(p, (len(p), kinds))
        self.auto.make_automaton()
        self.hard = ahocorasick.Automaton()
        for p, kinds in entries.items():
            if any(k in _HARD for k, _ in kinds):
                self.hard.add_word(p, p)
        self.hard.make_automaton()
        self.second = ahocorasick.Automaton()
        for p in SECOND_PERSON:
            self.second.add_word(p, len(p))
        self.second.make_automaton()
        self.masks = {}
        for kind in _HARD:
            for p in PHRASES[kind] + tuple(w for q in PHRASES[kind] for w in q.split() if len(w) > 2):
                for q in (p, _fold(p)):
                    self.masks.setdefault((q[0], q[-1], len(q)), (p, kind))
        self.masks.setdefault(("n", "u", 3), ("ngu", "insult"))
        # by first letter and length: phrases, and their words with the words around them
        self.begun: dict[tuple[str, int], list[tuple[str, str, str, str]]] = {("n", 3): [("ngu", "", "", "insult")]}
        for kind in _HARD:
            for q in dict.fromkeys(q for p in PHRASES[kind] for q in (p, _fold(p))):
                words = q.split()
                parts = [(w, " ".join([*words[:i], ""]), " ".join(["", *words[i + 1 :]]), kind) for i, w in enumerate(words)] if len(words) > 1 else []
                for part in [(q, "", "", kind), *parts]:
                    self.begun.setdefault((part[0][0], len(part[0])), []).append(part)


_lex: list[_Lexicon] = []


def _lexicon() -> _Lexicon:
    if not _lex:
        _lex.append(_Lexicon())
    return _lex[0]


def unmask(sentence: str) -> tuple[str, int, list[tuple[int, str]]]:
    """(text in lower case with masked spellings undone, how many were undone, kinds of starred words with their place)."""
    n = 0
    text = sentence.lower()

    def joined(m: re.Match) -> str:
        nonlocal n
        letters = re.sub(r"[.\-_·]", "", m.group())
        if letters.isdigit():
            return m.group()
        n += 1
        return letters

    def closed(m: re.Match) -> str:
        nonlocal n
        n += 1
        return " ".join(re.sub(r" ", "", part) for part in re.split(r" {2,}", m.group()))

    text = _DOTTED.sub(joined, text)
    text = _SPACED.sub(closed, text)
    if _LONG.search(text):
        text, k = _LONG.subn(r"\1", text)
        n += k

    def letters_for(m: re.Match) -> str:
        nonlocal n
        t = m.group()
        if not any(c.isalpha() for c in t) or any(c not in LEET and not c.isalpha() for c in t):
            return t
        n += 1
        return "".join(LEET.get(c, c) for c in t)

    text = _LEET.sub(letters_for, text)
    starred = []
    if "*" in text or "#" in text:
        masks = _lexicon().masks
        for m in _STARRED.finditer(text):
            w = m.group()
            first = re.match(r"[^\W_]+", w).group()
            last = re.search(r"[^\W_]*$", w).group()
            if not last:
                for q, before, after, kind in _lexicon().begun.get((w[0], len(w)), ()):
                    if q.startswith(first) and text.endswith(before, 0, m.start()) and text.startswith(after, m.end()):
                        starred.append((m.start(), kind))
                        n += 1
                        break
                continue
            for (a, b, size), (_, kind) in masks.items():
                if w[0] == a and w[-1] == b and len(w) == size:
                    starred.append((m.start(), kind))
                    n += 1
                    break
    return text, n, starred


def _sentence(s: str) -> dict[str, float] | None:
    """Features of a sentence, None if it holds no phrase that could matter."""
    lex = _lexicon()
    text, masked, starred = unmask(s)
    hits: list[tuple[int, int, str]] = [(at, at + 1, kind) for at, kind in starred]
    for end, (size, kinds) in lex.auto.iter(text):
        a, b = end - size + 1, end + 1
        if (a and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum()):
            continue
        for kind, flat in kinds:
            if flat and not text[max(0, a - 12) : b + 12].isascii():  # unaccented spellings count only in unaccented surroundings
                continue
            hits.append((a, b, kind))
    hard = [h for h in hits if h[2] in _HARD]
    if not hard:
        return None
    quotes = [i for i, c in enumerate(text) if c in "\"“”"]
    quoted = [h for h in hard if len(quotes) >= 2 and sum(q < h[0] for q in quotes) % 2 == 1]
    free = [h for h in hard if h not in quoted]
    out = {k: 0.0 for k in FEATURES}
    for k in _HARD:
        out[k] = float(len({h[0] for h in free if h[2] == k}))
    for k in ("offer", "person", "report"):
        out[k] = float(len({h[0] for h in hits if h[2] == k}))
    # what is addressed: persons and groups, and for explicit content those it is offered to
    aims = [(h[0], h[2]) for h in hits if h[2] in ("person", "offer")]
    near = min((abs(at - h[0]) for at, kind in aims for h in free if kind == "person" or h[2] == "sexual"), default=200)
    out["near"] = 1.0 / (1.0 + near / 20)
    out["quoted"] = float(len(quoted))
    out["masked"] = float(masked)
    letters = [c for c in s if c.isalpha()]
    out["capitals"] = sum(c.isupper() for c in letters) / max(1, len(letters))
    out["exclaim"] = float(min(3, s.count("!")) + (":))" in s))
    out["kinds"] = float(sum(out[k] > 0 for k in _HARD))
    out["density"] = 100.0 * sum(out[k] for k in _HARD) / (text.count(" ") + 1)
    return out


def _heat(f: dict[str, float]) -> float:
    return sum(f[k] for k in _HARD) + 0.5 * min(1, f["person"]) + 0.5 * min(1, f["offer"]) - 0.7 * min(2, f["report"]) - 0.5 * f["quoted"]


def _may_matter(low: str) -> bool:
    """Whether ``low`` can hold a phrase once ``unmask`` has undone what it can; no text that does is passed over."""
    hard = _lexicon().hard
    if next(hard.iter(low), None) is not None:
        return True
    if (("*" in low or "#" in low) and _STAR.search(low)) or _LONG.search(low) or _DOTTED.search(low) or _SPACED.search(low):
        return True
    # without those, unmasking only puts single letters for single signs, and phrases hold no signs
    for sign, letter in LEET.items():
        low = low.replace(sign, letter)
    return next(hard.iter(low), None) is not None


def _rates(text: str, low: str) -> list[float]:
    """Of all words of a text, in percent: those that address the reader, exclamation marks, words in capitals, masked spellings."""
    words = text.split()
    you = 0
    for end, n in _lexicon().second.iter(low):
        a, b = end - n + 1, end + 1
        you += not ((a and low[a - 1].isalnum()) or (b < len(low) and low[b].isalnum()))
    shout = sum(w.isupper() for w in words if len(w) > 4)
    masked = sum(_MASKED.search(w) is not None for w in words if not w.isalpha() and not w.isdigit())
    per = 100.0 / max(20, len(words))
    return [you * per, low.count("!") * per, shout * per, masked * per]


def features(text: str | None) -> np.ndarray:
    """FEATURES of a document: those of its hottest sentence, and rates over all of it.  No text has none."""
    out = np.zeros(len(FEATURES), np.float32)
    if not text:
        return out
    text = canonical(text)
    low = text.lower()
    rates = _rates(text, low)
    out[-len(rates) :] = rates
    if not _may_matter(low):
        return out
    best, heat, hot = None, -9.0, 0
    for s in _SPLIT.split(text):
        f = _sentence(s) if s else None
        if f is None:
            continue
        h = _heat(f)
        hot += any(f[k] for k in _HARD)
        if h > heat:
            best, heat = f, h
    if best is not None:
        best["hot_sentences"] = float(min(hot, 5))
        out[: -len(rates)] = [best[k] for k in FEATURES[: -len(rates)]]
    return out


class Boosted:
    """Gradient-boosted trees for a logistic loss on binned features, with isotonic calibration."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.1, bins: int = 24, least: float = 4.0, ridge: float = 2.0):
        self.direction = [DIRECTION.get(f, 0) for f in FEATURES]
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = rounds, depth, rate, bins, least, ridge
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple] = []
        self.base = 0.0
        self.steps = (np.array([-9.0, 9.0]), np.array([0.0, 1.0]))

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1) if len(x) else np.zeros((0, len(self.edges)), np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, folds: int = 5) -> Boosted:
        """Fits the trees, and the calibration on predictions for rows that a fold left out."""
        raw = np.zeros(len(y))
        fold = np.arange(len(y)) % folds
        if len(y) >= 10 * folds:
            for k in range(folds):
                part = Boosted(self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge)._grow(x[fold != k], y[fold != k], w[fold != k])
                raw[fold == k] = part.raw(x[fold == k])
            self._grow(x, y, w)
        else:
            self._grow(x, y, w)
            raw = self.raw(x)
        self.steps = _isotonic(raw, y, w)
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(np.unique(c), np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        b = self._binned(x)
        p = np.clip(np.average(y, weights=w), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(p / (1 - p))), []
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            g, h = w * (y - q), w * q * (1 - q)
            node = np.zeros(len(y), np.int64)
            tree = []
            for level in range(self.depth):
                splits = []
                for k in range(1 << level):
                    rows = node == k
                    splits.append(self._split(b[rows], g[rows], h[rows], w[rows]))
                feature = np.array([s[0] for s in splits])
                border = np.array([s[1] for s in splits])
                tree.append((feature, border))
                node = node * 2 + (b[np.arange(len(y)), feature[node]] > border[node])
            leaves = 1 << self.depth
            value = self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.ridge)
            self.trees.append((tree, value))
            score = score + value[node]
        return self

    def _split(self, b: np.ndarray, g: np.ndarray, h: np.ndarray, w: np.ndarray) -> tuple[int, int]:
        best, at = 1e-9, (0, 1 << 20)
        if not len(b):
            return at
        total = g.sum() ** 2 / (h.sum() + self.ridge)
        for j in range(b.shape[1]):
            n = len(self.edges[j]) + 1
            gs, hs, ws = (np.cumsum(np.bincount(b[:, j], v, n)) for v in (g, h, w))
            gain = gs**2 / (hs + self.ridge) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + self.ridge) - total
            gain[(ws < self.least) | (ws[-1] - ws < self.least)] = -1
            if self.direction[j]:
                rise = (gs[-1] - gs) / (hs[-1] - hs + self.ridge) - gs / (hs + self.ridge)
                gain[rise * self.direction[j] < 0] = -1
            k = int(gain.argmax())
            if gain[k] > best:
                best, at = float(gain[k]), (j, k)
        return at

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        score = np.full(len(x), self.base)
        for tree, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for feature, border in tree:
                node = node * 2 + (b[np.arange(len(x)), feature[node]] > border[node])
            score += value[node]
        return score

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return np.interp(self.raw(x), *self.steps) if len(x) else np.zeros(0)


def _isotonic(raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step function nearest to ``y`` (pool adjacent violators), drawn through the blocks' middles."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []
    for r, t, v in zip(raw[order], y[order], w[order]):
        blocks.append([r * v, t * v, v])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def train(rows: list[tuple[list[float], float, float]]) -> Boosted:
    """Trees fitted on (features, share of abusive verdicts, weight) and on SEEDS; the same rows are fitted once a process."""
    mark = hash(tuple((tuple(f), y, w) for f, y, w in rows))
    if mark not in _fitted:
        _fitted[mark] = _train(rows)
    return _fitted[mark]


_fitted: dict[int, Boosted] = {}


def _train(rows: list[tuple[list[float], float, float]]) -> Boosted:
    seeds = [(features(s), float(y), SEED_WEIGHT) for s, y in SEEDS]
    every = seeds + [(np.asarray(f, np.float32), y, w) for f, y, w in rows]
    return Boosted().fit(np.stack([r[0] for r in every]).astype(np.float64), np.array([r[1] for r in every]), np.array([r[2] for r in every]))


def with_features(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, features) for each row of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t).tolist() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float32()))], ["k", "x"])

    schema = T.StructType([T.StructField("k", df.schema[key].dataType), T.StructField("x", T.ArrayType(T.FloatType()))])
    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, schema)


def reviewed(df: DataFrame, key: str, text: str, labels: DataFrame, verdict: str, positive: tuple[str, ...], negative: tuple[str, ...]) -> list[tuple[list[float], float, float]]:
    """(features, share of positive verdicts, verdicts) of at most MAX_REVIEWED reviewed documents."""
    votes = labels.select(F.col(key).alias("id"), F.col(verdict).alias("v")).where(F.col("id").isNotNull() & F.col("v").isin(*positive, *negative))
    share = votes.groupBy("id").agg(F.avg(F.col("v").isin(*positive).cast("double")).alias("y"), F.count(F.lit(1)).cast("double").alias("n"))
    sample = share.orderBy(F.xxhash64("id"), "id").limit(MAX_REVIEWED)
    # the bound on the sample is the bound on what is broadcast
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("t")).join(F.broadcast(sample), "id").dropDuplicates(["id"])
    x = with_features(docs, "id", "t").join(F.broadcast(sample.withColumnRenamed("id", "k")), "k")
    return [(r["x"], r["y"], r["n"]) for r in x.orderBy(F.xxhash64("k"), "k").collect()]


def scores(df: DataFrame, key: str, text: str, model: Boosted) -> DataFrame:
    """(key, score) for each row: the calibrated probability that the text itself is abusive, hateful or sexually explicit.

    Null and empty texts get the score of a text without any sign of it.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([features(t) for t in b.column(1).to_pylist()]).astype(np.float64) if b.num_rows else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sent.value.predict(x), pa.float64())], ["k", "score"])

    schema = T.StructType([T.StructField("k", df.schema[key].dataType), T.StructField("score", T.DoubleType())])
    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, schema).withColumnRenamed("k", key)
