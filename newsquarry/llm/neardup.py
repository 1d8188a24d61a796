"""Near-duplicate records with small edits, by a binary trie self-join over bit sketches.

Each distinct text gets MinHash values of its word runs; one bit of each value
makes a sketch whose Hamming distance estimates the similarity.  The sketches
are the keys of a binary trie.  Its upper part is distributed: groups of
MinHash values (bands) route a text to the parts of the trie where a similar
text must stand with near certainty, and no two parts share work.  Inside a
part pairs of nodes are traversed together, differing bits are added up, and a
pair is left as soon as they exceed the error budget.  What is left is checked
exactly on the sets of word runs.  Copies of one text take part once, as its
representative, and are put back at the end.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquarry.llm.boilerplate import furniture_lines, main_text as report_text
from newsquarry.llm.canonical import canonical
from newsquarry.llm.residue import SCANNED, SLICE, judge, kept, scan, scan_arrays
from newsquarry.operators.graph import components
from newsquarry.session import Remembered, cut, small_numbers

#: MinHash values a text, and how many make a band.  At similarity 0.7 a pair shares no band once in 6,600.
HASHES = 128
BAND = 4
#: Rows of one band value that a task takes; more are parted into blocks, a task for each pair of blocks.
BLOCK = 5_000
#: Texts of a sample that a band of BLOCK texts has on average; bands with well under that many are counted no further.
SEEN = 300
#: Node pairs with at most so many leaf pairs are compared directly.
LEAF_PAIRS = 1_024
#: Candidate texts whose ids are broadcast (8 bytes each) for the second look at the texts; beyond, they are joined.
MAX_BROADCAST = 2_000_000

_WORDS = re.compile(r"\w+")
_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(1, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_P = _RNG.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)


def words_of(text: str) -> list[str]:
    """Runs of letters and digits, without case."""
    out: list[str] = []
    for t in text.lower().split():
        if t.isalnum():
            out.append(t)
        else:
            out += _WORDS.findall(t.replace("_", " "))
    return out


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word) or 1


def _piece_hash(piece: str) -> int:
    """The hash of the only word of a piece of text, 0 if it has none or several."""
    words = words_of(piece)
    return _hash(words[0]) if len(words) == 1 else 0


_pieces = Remembered(_piece_hash, 500_000)
_several = Remembered(lambda piece: [_hash(w) for w in words_of(piece)], 100_000)


def text_hashes(pieces: list[str]) -> np.ndarray:
    """Hashes of the words of a text, given by its pieces between spaces; each different piece is parted into words once."""
    h = np.fromiter(map(_pieces.__getitem__, pieces), np.uint64, len(pieces))
    at = np.flatnonzero(h == 0)
    if len(at):
        found = [_several[pieces[i]] for i in at.tolist()]
        counts = np.ones(len(h), np.int64)
        counts[at] = [len(x) for x in found]
        h = np.repeat(h, counts)
        h[h == 0] = [x for own in found for x in own]
    return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def runs_of(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words, given by their hashes, as they follow; a shorter text is one run, an empty one none."""
    if not len(h):
        return np.empty(0, np.uint64)
    n = max(1, len(h) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(min(size, len(h))):
        total += h[i : i + n] * _P[i]
    return _mix(total)


def shingles(words: list[str], size: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``size`` words."""
    return np.unique(runs_of(np.array([_hash(w) for w in words], np.uint64), size))


def minhash(x: np.ndarray) -> np.ndarray:
    """HASHES minima over the values ``x``, repeated or not, in 32 bits, which are taken from the upper half of its hashes; long ones are taken in pieces."""
    low = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    y = (x >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(y), 4096):
        z = np.multiply.outer(_A, y[i : i + 4096])
        z += _B[:, None]
        low = np.minimum(low, z.min(axis=1))
    return low.astype(np.uint64)


def band_keys(low: np.ndarray) -> np.ndarray:
    """For each row of minima one key for each band, different between bands."""
    parts = low.reshape(len(low), -1, BAND)
    key = np.arange(1, parts.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(BAND):
        key = _mix(key ^ parts[:, :, i])
    return key


def sketches_of(low: np.ndarray) -> np.ndarray:
    """One bit of each minimum, for each row of minima, as whole numbers of 64 bits."""
    return np.packbits((_mix(low) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)


def error_budget(similarity: float, bits: int = HASHES) -> int:
    """Differing bits that a pair of this similarity stays within, but for a chance of about 3e-5 (four deviations)."""
    p = (1 - similarity) / 2
    return math.ceil(bits * p + 4 * math.sqrt(bits * p * (1 - p)))


_POP = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint16)


def trie_pairs(sketches: np.ndarray, budget: int, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``sketches`` (n x bytes) that differ in at most ``budget`` bits.

    The sorted rows are the leaves of a binary trie; a node is a range of them and a
    depth.  With ``side`` only pairs of different sides are given.
    """
    n = len(sketches)
    order = np.lexsort(sketches.T[::-1])
    rows = sketches[order]
    bits = np.unpackbits(rows, axis=1)
    depth_max = bits.shape[1]
    left, right = [], []
    # (range of A, range of B, depth, differing bits so far); A is B for a node with itself
    todo = [(0, n, 0, n, 0, 0)]
    while todo:
        a0, a1, b0, b1, d, e = todo.pop()
        same = a0 == b0 and a1 == b1
        if (a1 - a0) * (b1 - b0) <= LEAF_PAIRS or d == depth_max:
            for lo in range(a0, a1, 64):
                hi = min(a1, lo + 64)
                dist = _POP[rows[lo:hi, None, :] ^ rows[None, b0:b1, :]].sum(axis=2)
                i, j = np.nonzero(dist <= budget)
                i, j = i + lo, j + b0
                keep = i < j if same else np.ones(len(i), bool)
                left.append(i[keep])
                right.append(j[keep])
            continue
        am = a0 + int(np.searchsorted(bits[a0:a1, d], 1))
        bm = am if same else b0 + int(np.searchsorted(bits[b0:b1, d], 1))
        nexts = [(a0, am, b0, bm, e), (am, a1, bm, b1, e), (a0, am, bm, b1, e + 1)]
        if not same:
            nexts.append((am, a1, b0, bm, e + 1))
        todo += [(p, q, r, s, d + 1, f) for p, q, r, s, f in nexts if f <= budget and q > p and s > r]
    i = order[np.concatenate(left)] if left else np.empty(0, np.int64)
    j = order[np.concatenate(right)] if right else np.empty(0, np.int64)
    if side is not None and len(i):
        keep = side[i] != side[j]
        i, j = i[keep], j[keep]
    return i, j


def _part_pairs(group: np.ndarray, ids: np.ndarray, sketches: np.ndarray, side: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate id pairs of sorted parts.  Small parts of one size are traversed at once, others one by one."""
    starts = np.flatnonzero(np.r_[True, np.any(group[1:] != group[:-1], axis=1)])
    sizes = np.diff(np.r_[starts, len(group)])
    left, right = [], []
    for size in np.unique(sizes):
        at = starts[sizes == size]
        if size < 2:
            continue
        if size <= 16:
            for i in range(size):
                for j in range(i + 1, size):
                    a, b = at + i, at + j
                    near = (_POP[sketches[a] ^ sketches[b]].sum(axis=1) <= budget) & ((side[a] != side[b]) | (group[a, 1] == group[a, 2]))
                    left.append(ids[a[near]])
                    right.append(ids[b[near]])
        else:
            for s in at:
                own = slice(s, s + size)
                crossed = group[s, 1] != group[s, 2]
                i, j = trie_pairs(sketches[own], budget, side[own] if crossed else None)
                left.append(ids[own][i])
                right.append(ids[own][j])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pairs[:, 0], pairs[:, 1]


#: What the first look at a text leaves: its number, a key for each band, and its sketch.
SKETCH = [f"sketch{i}" for i in range(HASHES // 64)]
FEATURES = T.StructType([T.StructField("doc", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())), *[T.StructField(n, T.LongType()) for n in SKETCH]])


def feature_arrays(texts: Iterator[tuple[int, np.ndarray]], size: int) -> tuple[pa.Array, list[pa.Array]]:
    """The places of (place, hashes of words) and the fields of FEATURES as Arrow arrays."""
    at, docs, minima = [], [], []
    for i, h in texts:
        minima.append(minhash(runs_of(h, size)))
        at.append(i)
        docs.append(_doc_id(h))
    low = np.stack(minima) if minima else np.empty((0, HASHES), np.uint64)
    marks = sketches_of(low)
    bands = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * (HASHES // BAND), pa.int32()), pa.array(band_keys(low).astype(np.int64).ravel(), pa.int64()))
    return pa.array(at, pa.int64()), [pa.array(docs, pa.int64()), bands, *(pa.array(np.ascontiguousarray(x)) for x in marks.T)]


def near_reports(df: DataFrame, key: str, body: str, site: str, size: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """``near_pairs`` of the main texts of bodies, without the keys that have a body that is residue.

    One scan brings the texts to the consistent form and parts their lines for both.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, SLICE) for whole in batches for at in range(0, len(whole), SLICE)):
            ready = [canonical(t) for t in b.column(2).to_pylist()]
            lows = [t.lower() for t in ready]
            furniture = [furniture_lines(t, ready=True, low=low) for t, low in zip(ready, lows)]
            pieces: list[list[str]] = [[] for _ in ready]
            scanned = [scan(*x) for x in zip(ready, furniture, lows, pieces)]
            # a text with an open slot is residue, which takes no part
            hashes = ((i, text_hashes(p)) for i, p in enumerate(pieces))
            at, columns = feature_arrays(((i, h) for i, h in hashes if len(h)), size)
            place = np.full(len(b), -1, np.int64)
            place[at.to_numpy()] = np.arange(len(at))
            where = pa.array(place, mask=place < 0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(c.take(where) for c in columns), *scan_arrays(scanned)], ["k", "site", *FEATURES.names, *SCANNED.names])

    some = df.select(F.col(key).alias("k"), F.lower(F.col(site)).alias("site"), F.col(body).alias("b")).where(F.col("b").rlike(r"\S"))
    docs = kept(some.mapInArrow(run, T.StructType([T.StructField("k", df.schema[key].dataType), T.StructField("site", T.StringType()), *FEATURES.fields, *SCANNED.fields])))
    residue = judge(docs.select("id", "k", "site", *SCANNED.names)).select("k")
    made = docs.where("k IS NOT NULL AND doc IS NOT NULL").select("k", *FEATURES.names)
    return near_pairs(df, key, body, size, similarity, report_text, residue, made)


def near_pairs(df: DataFrame, key: str, text: str, size: int = 5, similarity: float = 0.8, main_text: Callable[[str], str | None] | None = None, leave_out: DataFrame | None = None, made: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): members (key, doc) gives each key its distinct text; pairs (a, b) with a < b are the
    texts with at least ``similarity`` of their distinct ``size``-word runs in common.

    ``main_text`` reduces a value to the text that counts, None leaves the record out;
    ``leave_out`` holds, in its first column, keys that take no part; ``made`` is
    (k, FEATURES...) of all records, where a scan of the texts has made them already.
    Null values and texts without a word are left out, an empty table gives empty
    results; repeated rows count once.  Pairs come from bands of MinHash values and are
    then exact: none below the similarity is given; one at the similarity is missed with
    the small chance stated at HASHES.
    """
    spark = df.sparkSession
    budget = error_budget(similarity)
    key_type = df.schema[key].dataType

    def prepared(values: list) -> Iterator[tuple[int, np.ndarray]]:
        for i, v in enumerate(values):
            t = main_text(v) if main_text else v
            if t:
                h = text_hashes(t.split())
                if len(h):
                    yield i, h

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, columns = feature_arrays(prepared(b.column(1).to_pylist()), size)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), *columns], ["k", *FEATURES.names])

    some = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("k").isNotNull() & F.col("t").rlike(r"\S"))
    if made is None:
        made = cut(some.mapInArrow(features, T.StructType([T.StructField("k", key_type), *FEATURES.fields])))
    members = made.select("k", "doc").distinct()
    if leave_out is not None:
        members = members.join(leave_out.toDF("k"), "k", "left_anti")
    members = cut(members)

    firsts = [F.first(n).alias(n) for n in ("bands", *SKETCH)]
    docs = cut(made.groupBy("doc").agg(*firsts).join(members.select("doc"), "doc", "left_semi"))
    rows = docs.select("doc", *SKETCH, F.explode("bands").alias("band"))
    routed = rows.repartition("band").sortWithinPartitions("band")
    hot = _hot_bands(docs)
    if hot is not None:
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("doc", "band"), blocks).cast("int")
        crossed = rows.join(hot, "band").withColumn("blocks", blocks).withColumn("own", own)
        crossed = crossed.select("band", "doc", *SKETCH, F.col("own").alias("side"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        crossed = crossed.select("band", F.least("side", "other").alias("p"), F.greatest("side", "other").alias("q"), "doc", *SKETCH, "side")
        routed = rows.join(hot, "band", "left_anti").repartition("band").sortWithinPartitions("band")
        crossed = crossed.repartition("band", "p", "q").sortWithinPartitions("band", "p", "q")

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            number = lambda n: b.column(n).to_numpy().astype(np.int64, copy=False) if n in b.schema.names else np.zeros(len(b), np.int64)  # noqa: B023, E731
            group = np.stack([number(n) for n in ("band", "p", "q")], axis=1)
            marks = np.stack([number(n) for n in SKETCH], axis=1).view(np.uint8)
            held.append((group, number("doc"), marks, number("side")))
            if not len(group):
                continue
            if sum(len(h[0]) for h in held) < 50_000:
                continue
            whole = [np.concatenate(x) for x in zip(*held)]
            last = np.flatnonzero(np.any(whole[0] != whole[0][-1], axis=1))
            end = last[-1] + 1 if len(last) else 0
            if end:
                yield _pair_batch(*_part_pairs(*(x[:end] for x in whole), budget))
            held = [tuple(x[end:] for x in whole)]
        if held:
            whole = [np.concatenate(x) for x in zip(*held)]
            if len(whole[0]):
                yield _pair_batch(*_part_pairs(*whole, budget))

    candidates = routed.mapInArrow(traverse, "a long, b long")
    if hot is not None:
        candidates = candidates.unionByName(crossed.mapInArrow(traverse, "a long, b long"))
    candidates = cut(candidates.distinct())
    sets = _sets_of(some, members, candidates, prepared, size)
    both = candidates.join(sets.select(F.col("doc").alias("a"), F.col("runs").alias("ra")), "a").join(sets.select(F.col("doc").alias("b"), F.col("runs").alias("rb")), "b").select("a", "b", "ra", "rb")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= similarity * (len(x) + len(y) - common) - 1e-9)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], ["a", "b"])

    return members, both.mapInArrow(exact, "a long, b long")


def _hot_bands(docs: DataFrame) -> DataFrame | None:
    """(band, n) of the bands that more than BLOCK texts share, None if there are none.

    Only bands that are frequent in a sample of the texts are counted over all of them.
    One beyond BLOCK falls short of the sample's border, which is 7 deviations below its
    mean, with a chance under 1e-11; it would be taken whole, and no pair be lost.
    """
    bands = lambda df: df.select(F.explode("bands").alias("band"))
    share = max(1, BLOCK // SEEN)
    sample = bands(docs.where(F.pmod("doc", F.lit(share)) == 0))
    seen = cut(sample.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0.6 * BLOCK / share).select("band"))
    if seen.isEmpty():
        return None
    hot = cut(bands(docs).join(F.broadcast(seen), "band", "left_semi").groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK))
    return None if hot.isEmpty() else hot


def _doc_id(hashes: np.ndarray) -> int:
    h = xxhash.xxh3_64_intdigest(hashes.tobytes())
    return h - (1 << 64) if h >= 1 << 63 else h


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _sets_of(some: DataFrame, members: DataFrame, candidates: DataFrame, prepared, size: int) -> DataFrame:
    """(doc, runs) of the candidate texts: their sets of word runs as sorted 32-bit hashes.

    The texts are looked at a second time, but only those of one key for each candidate.
    """
    ids = candidates.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    chosen = members.join(ids, "doc", "left_semi").groupBy("doc").agg(F.min("k").alias("k")).select(F.xxhash64("k").alias("h")).distinct()
    chosen = cut(chosen)
    listed = small_numbers(chosen, MAX_BROADCAST)
    known = some.sparkSession.sparkContext.broadcast(listed) if listed is not None else None

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if known is not None:
                b = b.filter(pa.array(np.isin(b.column(2).to_numpy(), known.value)))
            docs, out = [], []
            for _, h in prepared(b.column(1).to_pylist()):
                docs.append(_doc_id(h))
                out.append(np.unique((runs_of(h, size) >> np.uint64(32)).astype(np.uint32)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(out, pa.binary())], ["doc", "runs"])

    rows = some.withColumn("h", F.xxhash64("k"))
    if known is None:
        rows = rows.join(chosen, "h", "left_semi").select("k", "t", "h")
    return rows.mapInArrow(runs, "doc long, runs binary").join(ids, "doc", "left_semi").dropDuplicates(["doc"])


def expand(members: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """All pairs of different keys, the smaller first, whose texts are equal or a pair."""
    a, b = members.select(F.col("k").alias("x"), F.col("doc").alias("a")), members.select(F.col("k").alias("y"), F.col("doc").alias("b"))
    different = pairs.join(a, "a").join(b, "b").select("x", "y")
    equal = a.join(b, F.col("a") == F.col("b")).where("x < y").select("x", "y")
    return different.unionByName(equal).where("x <> y").select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b")).distinct()


def classes(members: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """(key, class_id, links): one row a key; class_id is the least key among those linked to it through any number of
    pairs or equal texts, links the number of other keys directly so.  Copies are counted, not written out.
    """
    sizes = members.groupBy("doc").agg(F.count(F.lit(1)).alias("copies"), F.min("k").alias("least"))
    pairs = cut(pairs)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(sizes.select(F.col("doc").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others")).withColumnRenamed("a", "doc")
    parts = components(pairs).withColumnRenamed("node", "doc")
    docs = sizes.join(linked, "doc", "left").join(parts, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    names = docs.groupBy("component").agg(F.min("least").alias("class_id"))
    docs = docs.join(names, "component").select("doc", "class_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return members.join(docs, "doc").groupBy("k").agg(F.min("class_id").alias("class_id"), F.sum("links").alias("links")).withColumnRenamed("k", key)
