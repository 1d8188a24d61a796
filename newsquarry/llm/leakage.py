"""Evaluation passages inside a corpus, by winnowing.

Of every window of ``t - k + 1`` adjoining k-grams the one with the least hash
is kept, on both sides, so any shared span of at least ``t`` words shares a
kept fingerprint.  Fingerprints of corpus and items are joined and every hit is
extended word by word to both sides.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquarry.llm.canonical import canonical
from newsquarry.session import held_once, small_enough

#: Words of a fingerprint, and of the shortest span that is always found.
K = 6
SPAN = 12
#: Words of all items together up to which the items are broadcast (16 bytes a word); beyond, fingerprints are shuffled.
MAX_ITEM_WORDS = 4_000_000
_WORDS = re.compile(r"[^\W_]+")
_M = np.uint64(0x9E3779B97F4A7C15)


def fold(word: str) -> str:
    """A word without accents; đ counts as d."""
    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c)).replace("đ", "d")


_cache: dict[str, int] = {}


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the folded words of ``text``."""
    if len(_cache) > 500_000:
        _cache.clear()
    out = []
    for w in _WORDS.findall(canonical(text).lower()):
        h = _cache.get(w)
        if h is None:
            h = _cache[w] = xxhash.xxh3_64_intdigest(fold(w))
        out.append(h)
    return np.array(out, np.uint64)


def fingerprints(h: np.ndarray, k: int = K, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the kept k-grams; a text between k words and a whole window keeps its least one."""
    if len(h) < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    n = len(h) - k + 1
    grams = np.zeros(n, np.uint64)
    for i in range(k):
        grams = (grams ^ h[i : i + n]) * _M
        grams ^= grams >> np.uint64(29)
    width = min(span - k + 1, n)
    windows = np.lib.stride_tricks.sliding_window_view(grams, width)
    at = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    return grams[at], at


def extend(a: np.ndarray, i: int, b: np.ndarray, j: int, k: int = K) -> int:
    """Length of the common run of words around the k-gram at ``a[i:]`` and ``b[j:]``; 0 if it is none."""
    if not np.array_equal(a[i : i + k], b[j : j + k]):
        return 0
    back = min(i, j)
    before = a[i - back : i][::-1] == b[j - back : j][::-1]
    ahead = min(len(a) - i, len(b) - j)
    after = a[i : i + ahead] == b[j : j + ahead]
    return int((len(before) if before.all() else before.argmin()) + (len(after) if after.all() else after.argmin()))


class Items:
    """Fingerprint index of the items: sorted hashes with their item and position."""

    def __init__(self, ids: list, texts: list[str | None], k: int = K, span: int = SPAN):
        self.ids, self.words = ids, [word_hashes(t or "") for t in texts]
        marks = [fingerprints(w, k, span) for w in self.words]
        prints = np.concatenate([m[0] for m in marks]) if marks else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(marks)), [len(m[0]) for m in marks]) if marks else np.empty(0, np.int64)
        place = np.concatenate([m[1] for m in marks]) if marks else np.empty(0, np.int64)
        order = np.argsort(prints, kind="stable")
        self.prints, self.item, self.place = prints[order], item[order], place[order]

    def find(self, h: np.ndarray, k: int = K, span: int = SPAN) -> dict[int, int]:
        """Longest common run by item number, of at least ``span`` words."""
        prints, at = fingerprints(h, k, span)
        out: dict[int, int] = {}
        if not len(prints) or not len(self.prints):
            return out
        lo, hi = np.searchsorted(self.prints, prints, "left"), np.searchsorted(self.prints, prints, "right")
        for n in np.flatnonzero(hi > lo):
            for x in range(lo[n], hi[n]):
                run = extend(h, int(at[n]), self.words[self.item[x]], int(self.place[x]), k)
                if run >= span and run > out.get(int(self.item[x]), 0):
                    out[int(self.item[x])] = run
        return out


def leaks(corpus: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, k: int = K, span: int = SPAN) -> DataFrame:
    """(key, item_key, words): documents that hold at least ``span`` words in a row of an item, with the longest such run.

    Case, accents, punctuation and spacing play no part.  Null and empty texts leak
    nothing; repeated rows give their rows once; items may share a key, then the longest run counts.
    """
    key_type, item_type = corpus.schema[key].dataType, items.schema[item_key].dataType
    docs = corpus.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t IS NOT NULL")
    wanted = items.select(F.col(item_key).alias("i"), F.col(item_text).alias("x")).where("x IS NOT NULL").distinct()
    schema = T.StructType([T.StructField("k", key_type), T.StructField("i", item_type), T.StructField("words", T.IntegerType())])
    size = wanted.agg(F.sum(F.size(F.split("x", r"[^\p{L}\p{N}]+"))).alias("n")).first()["n"] or 0
    if size <= MAX_ITEM_WORDS:
        rows = small_enough(wanted, MAX_ITEM_WORDS) or []
        sent = corpus.sparkSession.sparkContext.broadcast([(r.i, r.x) for r in rows])
        mark = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = held_once(mark, lambda: Items([i for i, _ in sent.value], [x for _, x in sent.value], k, span))
            for b in batches:
                keys, ids, words = [], [], []
                for key_, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for i, n in index.find(word_hashes(t), k, span).items():
                        keys.append(key_)
                        ids.append(index.ids[i])
                        words.append(n)
                yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), pa.array(ids, _arrow(item_type)), pa.array(words, pa.int32())], ["k", "i", "words"])

        found = docs.mapInArrow(run, schema)
    else:
        found = _leaks_by_join(docs, wanted, schema, k, span)
    return found.groupBy("k", "i").agg(F.max("words").alias("words")).select(F.col("k").alias(key), F.col("i").alias(item_key), "words")


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _leaks_by_join(docs: DataFrame, items: DataFrame, schema: T.StructType, k: int, span: int) -> DataFrame:
    """The same for items too many to broadcast: fingerprints are joined, then the texts of the pairs that share one."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = [], []
            for id_, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                p = np.unique(fingerprints(word_hashes(t), k, span)[0]).astype(np.int64).tolist()
                ids += [id_] * len(p)
                out += p
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(out, pa.int64())], [b.schema.names[0], "print"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [next(iter(Items([0], [x], k, span).find(word_hashes(t), k, span).values()), 0) for t, x in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            mask = pa.array([n > 0 for n in words], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask), pa.array([n for n in words if n], pa.int32())], ["k", "i", "words"])

    left = docs.mapInArrow(prints, T.StructType([schema["k"], T.StructField("print", T.LongType())]))
    right = items.mapInArrow(prints, T.StructType([schema["i"], T.StructField("print", T.LongType())]))
    pairs = left.join(right, "print").select("k", "i").distinct()
    return pairs.join(docs, "k").join(items, "i").select("k", "i", "t", "x").mapInArrow(runs, schema)
