"""Near-duplicates and leaks against all pairs."""

import itertools
import random

import numpy as np
import pytest

import newsquarry.llm.leakage as leakage
import newsquarry.llm.neardup as neardup
from newsquarry.llm.leakage import Items, extend, fingerprints, fold, leaks, word_hashes
from newsquarry.llm.neardup import classes, error_budget, expand, near_pairs, shingles, trie_pairs, words_of


def hamming(a, b):
    return bin(int.from_bytes(bytes(a)) ^ int.from_bytes(bytes(b))).count("1")


@pytest.mark.parametrize("n,budget", [(0, 3), (1, 3), (60, 40), (300, 43)])
def test_trie_gives_all_pairs_within_the_budget(n, budget):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 256, (max(1, n // 6), 16), dtype=np.uint8)
    rows = base[rng.integers(0, len(base), n)] if n else np.zeros((0, 16), np.uint8)
    flips = rng.random((n, 16, 8)) < 0.1
    rows = rows ^ np.packbits(flips, axis=2).reshape(n, 16)
    i, j = trie_pairs(rows, budget) if n else (np.array([]), np.array([]))
    got = {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())}
    assert got == {(a, b) for a, b in itertools.combinations(range(n), 2) if hamming(rows[a], rows[b]) <= budget}
    if n:
        side = np.arange(n) % 2
        i, j = trie_pairs(rows, budget, side)
        assert {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())} == {p for p in got if side[p[0]] != side[p[1]]}


def test_budget_and_shingles():
    assert error_budget(1.0) == 0 and error_budget(0.6) < 64
    assert len(shingles("a b c a b c a b".split(), 3)) == 3 and len(shingles(["a"], 3)) == 1 and len(shingles([], 3)) == 0


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(40):
        base = r.choices(vocab, k=r.randrange(40, 160))
        texts.append(base)
        for _ in range(r.randrange(0, 4)):
            copy = list(base)
            for _ in range(r.randrange(0, 7)):
                copy[r.randrange(len(copy))] = r.choice(vocab)
            texts.append(copy)
    return [" ".join(t) for t in texts]


def brute_pairs(rows, size, least):
    sets = {}
    for k, t in rows:
        w = words_of(t or "")
        if k is not None and w:
            sets[k] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}
    return {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least}


@pytest.mark.parametrize("size,least,block", [(3, 0.6, 5000), (5, 0.8, 2)])
def test_pairs_equal_all_pairs(spark, monkeypatch, size, least, block):
    monkeypatch.setattr(neardup, "BLOCK", block)  # with 2, nearly every band counts as hot and is taken in blocks
    texts = corpus(size)
    rows = [(f"k{i:03d}", t) for i, t in enumerate(texts)] + [("x1", texts[0].upper() + "!"), ("x2", None), ("x3", ""), ("x4", "..."), (None, texts[0]), ("y1", "w1"), ("y2", "W1."), ("k000", texts[0])]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "id string, txt string, doc int, k string").repartition(3)
    members, pairs = near_pairs(df, "id", "txt", size, least)
    got = {tuple(r) for r in expand(members, pairs, "id").collect()}
    want = brute_pairs(dict(rows).items(), size, least)
    assert got <= set(want)
    assert {p for p, j in want.items() if j >= least + 0.1} <= got and len(got) >= 0.97 * len(want)
    assert ("k000", "x1") in got and ("y1", "y2") in got
    label = {k: k for p in got for k in p} | {k: k for k, t in rows if k and words_of(t or "")}
    for _ in range(len(label)):
        for a, b in got:
            label[a] = label[b] = min(label[a], label[b])
    degree = {k: sum(k in p for p in got) for k in label}
    assert {r.id: (r.class_id, r.links) for r in classes(members, pairs, "id").collect()} == {k: (label[k], degree[k]) for k in label}


def test_pairs_of_nothing_and_of_a_long_text(spark):
    df = spark.createDataFrame([("a", " ".join(f"w{i}" for i in range(60_000))), ("b", " ".join(f"w{i}" for i in range(60_010)))], "id string, txt string")
    members, pairs = near_pairs(df, "id", "txt")
    assert [tuple(r) for r in expand(members, pairs, "id").collect()] == [("a", "b")]
    members, pairs = near_pairs(df.limit(0), "id", "txt")
    assert expand(members, pairs, "id").count() == 0


def test_joined_second_look(spark, monkeypatch):
    monkeypatch.setattr(neardup, "MAX_BROADCAST", 1)
    t = corpus(9)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(t)], "id long, txt string")
    members, pairs = near_pairs(df, "id", "txt", 3, 0.6)
    got = {tuple(r) for r in expand(members, pairs, "id").collect()}
    assert got and got <= set(brute_pairs([(i, x) for i, x in enumerate(t)], 3, 0.6))


ODD = "Một_hai ba,bốn - 10.000 d'Or İSTANBUL ΟΔΟΣ. x² -- _ 日本，語 " + "dài" * 50 + "!"


def test_pieces_are_parted_into_words_once(monkeypatch):
    want = [neardup._hash(w) for w in words_of(ODD)]
    seen = []
    monkeypatch.setattr(neardup, "words_of", lambda t: seen.append(t) or words_of(t))
    for n in (neardup._pieces, neardup._several):
        n.clear()
    assert neardup.text_hashes(ODD.split()).tolist() == neardup.text_hashes(ODD.lower().split()).tolist() == want
    seen.clear()
    assert neardup.text_hashes(ODD.split()).tolist() == want and seen == [t for t in ODD.split() if len(t) > 64]
    assert len(neardup.text_hashes([])) == 0 and len(neardup.text_hashes(["-", "_"])) == 0
    runs = neardup.runs_of(neardup.text_hashes("a b a b a b".split()), 3)
    assert len(runs) == 4 and (neardup.minhash(runs) == neardup.minhash(shingles("a b a b a b".split(), 3))).all()


def test_only_bands_frequent_in_a_sample_are_counted(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 1_200)
    r = random.Random(4)
    docs = [(r.randrange(-(1 << 63), 1 << 63), [1 if i < 3_000 else -i, 2 if i < 1_000 else -i, 3 if i < 1_200 else -i]) for i in range(4_000)]
    df = spark.createDataFrame(docs, "doc long, bands array<long>")
    assert [tuple(x) for x in neardup._hot_bands(df).collect()] == [(1, 3_000)]
    assert neardup._hot_bands(df.where("false")) is None
    monkeypatch.setattr(neardup, "BLOCK", 3_000)
    assert neardup._hot_bands(df) is None


def longest(a, b):
    best = 0
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            best = max(best, n)
    return best


def leak_case(seed):
    r = random.Random(seed)
    vocab = [f"tiếng{i}" for i in range(60)]
    items = [r.choices(vocab, k=r.randrange(5, 50)) for _ in range(12)]
    docs = []
    for _ in range(60):
        d = r.choices(vocab, k=r.randrange(0, 40))
        if r.random() < 0.7:
            src, n = r.choice(items), r.randrange(3, 25)
            at = r.randrange(max(1, len(src) - n + 1))
            d[r.randrange(len(d) + 1) : 0] = src[at : at + n]
        docs.append(d)
    return items, docs


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("bound", [4_000_000, 1])
def test_leaks_equal_longest_run(spark, monkeypatch, seed, bound):
    monkeypatch.setattr(leakage, "MAX_ITEM_WORDS", bound)
    items, docs = leak_case(seed)
    dress = lambda ws, i: (", " if i % 2 else "\n").join(w.upper() if i % 3 else fold(w) for w in ws)
    d = spark.createDataFrame([(i, dress(w, i), "x") for i, w in enumerate(docs)] + [(900, None, "x"), (901, "", "x"), (0, dress(docs[0], 0), "x")], "doc_id long, text string, i string")
    e = spark.createDataFrame([(i, " ".join(w), "y") for i, w in enumerate(items)] + [(77, None, "y"), (78, "", "y")], "item_id long, item_text string, k string")
    got = {(r.doc_id, r.item_id): r.words for r in leaks(d, "doc_id", "text", e, "item_id", "item_text").collect()}
    want = {(i, j): n for i, a in enumerate(docs) for j, b in enumerate(items) if (n := longest(a, b)) >= 12}
    assert set(got) == set(want)
    assert all(12 <= got[p] <= want[p] for p in got)
    assert leaks(d.limit(0), "doc_id", "text", e, "item_id", "item_text").count() == 0 and leaks(d, "doc_id", "text", e.limit(0), "item_id", "item_text").count() == 0


def test_winnowing_guarantee():
    r = random.Random(1)
    for _ in range(300):
        span = r.choices(range(50), k=12)
        a = np.array(r.choices(range(50, 90), k=r.randrange(20)) + span + r.choices(range(50, 90), k=r.randrange(20)), np.uint64)
        b = np.array(r.choices(range(90, 130), k=r.randrange(20)) + span + r.choices(range(90, 130), k=r.randrange(20)), np.uint64)
        assert set(fingerprints(a)[0].tolist()) & set(fingerprints(b)[0].tolist())
    assert len(fingerprints(np.zeros(5, np.uint64))[0]) == 0
    assert extend(np.arange(20), 5, np.arange(3, 20), 2) == 17 and extend(np.arange(9), 0, np.arange(9, 20), 0) == 0
    assert Items([], []).find(word_hashes("một hai ba bốn năm sáu bảy")) == {}
    assert word_hashes("Đường đi: Hà-Nội").tolist() == word_hashes("duong DI ha noi").tolist()
