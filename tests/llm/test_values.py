"""Truncated values, mixtures and abuse scores."""

import random

import numpy as np
import pytest

from newsquarry.llm import toxicity
from newsquarry.llm.mixture import RANKS, bisect_power, entropy, largest_power, mix, most_tokens, plan, tempered, with_tokens
from newsquarry.llm.toxicity import SEEDS, Boosted, features, reviewed, scores, train, unmask
from newsquarry.llm.truncation import cut_values, ending

ENDINGS = [
    ("Một câu.", "closed"), ("Một câu...", "marked"), ("Một câu…", "marked"), ("Một […]", "marked"), ("Một (...)", "marked"), ("Một… xem tiếp »", "marked"), ("Một >> Đọc tiếp", "marked"), ("Một... (còn nữa)", "marked"), ("Một&quo", "broken"), ("Một<br", "broken"), ("Một<a href=\"x", "broken"), ("Một đ�", "broken"),
    ("Một câu", "open"), ("Theo A: \"Đúng vậy.\"", "closed"), ("Hỏi?", "closed"), ("Một câu. (Theo PV).", "closed"), ("vào mỗi đêm; ", "broken"), ("Họ nói:", "broken"), ("Năm 2017.", "initial"), ("theo ông H.", "initial"),
]


@pytest.mark.parametrize("value,state", ENDINGS)
def test_endings(value, state):
    assert ending(value)[0] == state


def test_cut_values(spark):
    r = random.Random(4)
    words = "sông kênh thép cảng thuế lương đất bùn khói gió mưa nhà máy dầu".split()
    sentence = lambda: " ".join(r.choices(words, k=8)).capitalize() + " hôm qua"
    rows, want = [], set()
    for i in range(120):
        s = [sentence() for _ in range(3)]
        body = ". ".join(s) + "."
        if i % 3 == 0:  # an outlet that writes full stops
            cut = i % 2 == 0
            value, source, domain = (body[: r.randrange(60, 110)].rstrip(". ") if cut else body), "A", "WWW.a.vn"
            if cut and value in [". ".join(s[:n]) for n in (1, 2, 3)]:
                value += " và"
        else:  # one that never does, and cuts at 70 characters
            cut = i % 4 == 0
            value, source, domain = (body[:70] if cut else ". ".join(s[:2])), "B" if i % 5 else None, "b.vn"
        rows.append((str(i), value, None if i % 7 else "", body if i % 6 else None, source, domain, "x"))
        if cut:
            want.add(str(i))
    rows += rows[:5] + [("n", None, None, None, None, None, None), ("e", "", "  ", "", "", "", ""), (None, "Một câu…", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "id string, description string, sapo string, body string, source string, domain string, state string")
    got = {r.id for r in cut_values(df, "id", ["description", "sapo"], "source", "domain", ["body", "description", "sapo"]).where("is_cut").collect()}
    assert None in got and not {"n", "e"} & got
    got.discard(None)
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 3
    assert cut_values(df.limit(0), "id", ["description"], "source", "domain", ["body"]).count() == 0


def test_cut_values_joined(spark, monkeypatch):
    import newsquarry.llm.truncation as t

    monkeypatch.setattr(t, "MAX_KEYS", 0)
    df = spark.createDataFrame([("1", "Công ty xả thải ra", "Công ty xả thải ra sông lớn.", "b"), ("2", "Công ty xả thải ra sông lớn", "Công ty xả thải ra sông lớn.", "b"), ("3", "Dài " * 40_000, None, "b")], "id string, d string, body string, s string")
    got = {r.id: r.is_cut for r in cut_values(df, "id", ["d"], "s", "s", ["body"]).collect()}
    assert got["1"] and not got["2"]


def test_copies_decide_before_the_outlets_habit(spark):
    rows = [(f"c{i}", f"Câu số {i} đã xong.", None, None) for i in range(9)]
    rows += [
        ("one", "Công ty xả thải ra sông", None, "Công ty xả thải ra sông. Dân kêu."),
        ("two", "Mưa lớn ở kênh. Nước dâng cao", None, "Tin. Mưa lớn ở kênh. Nước dâng cao. Dân kêu."),
        ("goes on", "Gió mạnh ở cảng. Tàu phải neo", None, "Gió mạnh ở cảng. Tàu phải neo lại. Dân kêu."),
        ("marked copy", "Thép tăng giá. Kho còn mười", "Thép tăng giá. Kho còn mười [...]", "Thép tăng giá. Kho còn mười tấn. Dân kêu."),
        ("marked copy only", "Thuế mới ra. Chợ vắng vì", "Thuế mới ra. Chợ vắng vì… xem tiếp »", None),
        ("no copy", "Lương đã trả. Nhà máy vẫn", None, None),
    ]
    df = spark.createDataFrame([(*r, "A", "a.vn") for r in rows], "id string, description string, sapo string, body string, source string, domain string")
    got = {r.id for r in cut_values(df, "id", ["description"], "source", "domain", ["body", "description", "sapo"]).where("is_cut").collect()}
    assert got == {"goes on", "marked copy", "marked copy only", "no copy"}


def test_tempering():
    tokens = {"a": 100, "b": 300, "c": 600, "z": 0}
    assert tempered(tokens, 1) == {"a": 0.1, "b": 0.3, "c": 0.6} and set(tempered(tokens, 0).values()) == {1 / 3}
    p = bisect_power(lambda p: entropy(tempered(tokens, p)) >= 1.0)
    assert entropy(tempered(tokens, p)) == pytest.approx(1.0, abs=1e-6)
    w, total = plan(tokens, {"a": 0.5, "b": 0.5, "z": 0.3}, {"a": 2, "b": 1, "c": 1, "z": 9})
    assert w == {"a": 0.5, "b": 0.5} and total == 400 == most_tokens(w, tokens, {"a": 2, "b": 1})
    w, total = plan(tokens, {"a": 0.9, "b": 0.1}, {"a": 1, "b": 1}, total=300)
    assert total == 300 and w["a"] * total <= 100 + 1e-6 and w["a"] > 0.3
    assert plan({}, {"a": 1.0}, {"a": 1}) == ({}, 0.0)


def test_power_where_some_bounds_rise():
    # b holds more than its target and may not be repeated: less power asks for more of it
    tokens, targets, limits = {"a": 100, "b": 400, "c": 500}, {"a": 0.3, "b": 0.2, "c": 0.5}, {"a": 4, "b": 1, "c": 2}
    w, total = plan(tokens, targets, limits, total=1_200)
    assert w == pytest.approx(targets) and total == 1_200
    # no power reaches the total: the targets stay and the total is cut
    w, total = plan(tokens, targets, limits, total=5_000)
    assert largest_power(tokens, targets, limits, 5_000) is None and w == pytest.approx(targets) and total == pytest.approx(400 / 0.3)
    r = random.Random(5)
    for _ in range(200):
        n, t, m = ({s: f() for s in "abcde"} for f in (lambda: r.randrange(10, 900), r.random, lambda: r.randrange(1, 5)))
        total = r.uniform(0.5, 2) * sum(n.values())
        power = largest_power(n, t, m, total)
        fits = [p for p in np.linspace(0, 1, 501) if most_tokens(tempered(n, p, t), n, m) >= total]
        assert not fits if power is None else most_tokens(tempered(n, power, t), n, m) >= total * (1 - 1e-9) and max(fits, default=0) <= power + 1e-9


def test_mix_of_a_pass_keeps_the_targets(spark):
    docs = [(i, s, "từ " * 20) for i, s in enumerate(["a"] * 100 + ["b"] * 400 + ["c"] * 500 + ["unlisted"] * 700)]
    t = spark.createDataFrame([("a", 0.3, 4), ("b", 0.2, 1), ("c", 0.5, 2)], "source string, target_share double, max_repeats int")
    d = spark.createDataFrame(docs, "doc_id long, source string, text string")
    got = {r.source: r for r in mix(d, "doc_id", "source", "text", t, passes=1.0)[1].collect()}
    assert {r.power for r in got.values()} == {1.0}
    assert {s: round(r.actual_share, 2) for s, r in got.items()} == {"a": 0.3, "b": 0.2, "c": 0.5}
    assert sum(r.used_tokens for r in got.values()) == pytest.approx(sum(r.tokens for r in got.values()), rel=0.01)


def test_mix(spark):
    r = random.Random(8)
    docs = [(i, s, "từ " * r.randrange(5, 60), "q") for i, s in enumerate(["a"] * 300 + ["b"] * 40 + ["c"] * 90 + ["u"] * 50)]
    docs += docs[:10] + [(5000, None, "x y", "q"), (5001, "a", None, "q"), (5002, "a", "", "q"), (None, "a", "x", "q")]
    d = spark.createDataFrame(docs, "doc_id long, source string, text string, whole string")
    t = spark.createDataFrame([("a", 0.4, 1), ("b", 0.3, 5), ("c", 0.2, 2), ("gone", 0.1, 3), (None, 0.0, 1)], "source string, target_share double, max_repeats int")
    uses, shares = mix(d, "doc_id", "source", "text", t)
    u, s = uses.collect(), {x.source: x for x in shares.collect()}
    limits = {"a": 1, "b": 5, "c": 2}
    assert len({x.doc_id for x in u}) == len(u) and all(1 <= x.uses <= limits[x.source] for x in u)
    assert set(s) == {"a", "b", "c", "gone"} and s["gone"].actual_share == 0 and sum(x.actual_share for x in s.values()) == pytest.approx(1)
    for k, want in (("a", 0.4 / 0.9), ("b", 0.3 / 0.9), ("c", 0.2 / 0.9)):
        assert s[k].actual_share == pytest.approx(want, abs=0.01)
        assert s[k].used_tokens == sum(x.n_tokens * x.uses for x in u if x.source == k)
    assert sorted(map(tuple, uses.collect())) == sorted(map(tuple, mix(d.repartition(7), "doc_id", "source", "text", t)[0].collect()))
    assert mix(d.limit(0), "doc_id", "source", "text", t)[0].count() == 0 and mix(d, "doc_id", "source", "text", t.limit(0))[1].count() == 0


def test_token_counts(spark):
    import base64

    import tiktoken

    from newsquarry.llm.mixture import PATTERN

    with open(RANKS, "rb") as f:
        e = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
    texts = ["Một câu dài <|endoftext|> 123", "", None, "x" * 20_000]
    got = [r.n_tokens for r in with_tokens(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t").orderBy("i").collect()]
    assert got == [len(e.encode_ordinary(t)) if t else 0 for t in texts]


MASKED = [("b ẩ n   t h ỉ u", "bẩn thỉu"), ("s.e.x", "sex"), ("c.ú.t. .x.é.o", "cút xéo"), ("nguuuu", "ngu"), ("5úc 51nh", "súc sinh"), ("giá 1.234,5", "giá 1.234,5"), ("TP.HCM", "tp.hcm")]


@pytest.mark.parametrize("raw,want", MASKED)
def test_unmask(raw, want):
    assert unmask(raw)[0] == want


def test_features():
    name = toxicity.FEATURES.index
    # every text has its rates, whether or not it holds a listed phrase
    rate = lambda t: features(t)[-4:].tolist()
    assert rate("Are you there? " + "a " * 97)[0] == 1 and rate("A! " + "b " * 99)[1] == 1 and rate("SHOUTING " + "b " * 99)[2] == 1 and rate("w0rd " + "b " * 99)[3] == 1 and rate("young") == [0] * 4
    for t in ("Mày là cái thứ vô dụng, biến khỏi mắt tao", "I hope you get hit by a truck", "These immigrants are cockroaches"):
        assert features(t).sum() > 0
    assert features(None).sum() == 0 and features("").sum() == 0 and features("Cổ tức năm nay là tốt.").sum() == 0
    assert features("Bọn nó đúng là đồ s******h")[name("insult")] > 0
    assert features("Bon nay la do suc sinh")[name("insult")] > 0 and features("Bồn chứa, lợn, chó nghiệp vụ, ngụ tại")[name("insult")] == 0
    f = features("Quản đốc gọi công nhân là \"đồ ngu\".")
    assert f[name("insult")] == 0 and f[name("quoted")] == 1
    assert features("Thằng đó ngu như lợn. " + "Câu thường. " * 30_000)[name("insult")] == 1


FOUND = ["tr@5h", "id10t", "a55hole", "a$$hole", "\"1diot\"", "(3scort)", "5tup1d", "đồ m@@@t dạy f***", "you i****", "you stup**", "b1tch", "shi*", "Lũ c**", "đồ n**", "f***!"]
CLEAN = ["G7, Q3 và 10h30 ở TP.HCM", "vitamin **C**", "Nguyễn Văn T**", "thép**", "giá 5***", "covid19", "@home", "a1b2"]


@pytest.mark.parametrize("text,found", [(t, True) for t in FOUND] + [(t, False) for t in CLEAN])
def test_masked_words_alone(text, found):
    assert bool(features(text)[:-4].sum()) == found


def test_no_masked_word_is_passed_over(monkeypatch):
    r = random.Random(2)
    phrases = [p for k in ("insult", "threat", "group", "sexual") for p in toxicity.PHRASES[k]]
    signs = {b: [a for a, c in toxicity.LEET.items() if c == b] for b in toxicity.LEET.values()}
    texts = []
    for _ in range(2000):
        p = "".join(r.choice([c, *signs.get(c, [])]) for c in r.choice(phrases))
        p = r.choice([p, ".".join(p), " ".join(p), "".join(c * r.choice([1, 1, 3]) for c in p), p[0] + "*" * (len(p) - 1), p[0] + "**" + p[3:]])
        texts.append(r.choice(["", "\"", "Họ nói: "]) + p + r.choice(["", "!", ". Hết."]))
    got = [features(t).tolist() for t in texts]
    monkeypatch.setattr(toxicity, "_may_matter", lambda low: True)
    assert got == [features(t).tolist() for t in texts]


def test_trees_learn_and_are_calibrated():
    rng = np.random.default_rng(3)
    x = np.zeros((3000, len(toxicity.FEATURES)))
    x[:, :6] = rng.integers(0, 3, (3000, 6))
    p = 1 / (1 + np.exp(-(2.0 * x[:, 0] + x[:, 1] - 3)))
    y = (rng.random(3000) < p).astype(float)
    m = Boosted().fit(x[:2000], y[:2000], np.ones(2000))
    q = m.predict(x[2000:])
    assert np.abs(q - p[2000:]).mean() < 0.06 and (np.diff(m.steps[1]) >= 0).all() and (np.diff(m.steps[0]) >= 0).all()
    more = x[2000:].copy()
    more[:, 0] += 1
    assert (m.predict(more) >= q - 1e-9).all()
    assert len(m.predict(x[:0])) == 0


def test_abuse_without_a_listed_phrase_is_learned():
    r = random.Random(4)
    plain = "nhà máy thép công ty nước sông giá lương tuần họp đơn tin báo the mill river board wage".split()
    calm = [" ".join(r.choices(plain, k=30)) + "." for _ in range(400)]
    hot = [" ".join(r.choices(plain, k=20)) + r.choice([" YOU LIARS WILL PAY!!! you hear me", " mày nghe chưa!! LIARS mày", " l1ars!!! you l1ars!!"]) for _ in range(200)]
    x = [(features(t).tolist(), float(t in hot)) for t in calm + hot]
    r.shuffle(x)
    assert all(sum(f[:4]) == 0 for f, _ in x)  # no listed phrase in any of them
    m = train([(f, y, 1.0) for f, y in x[:300]])
    q = m.predict(np.array([f for f, _ in x[300:]])) >= 0.5
    y = np.array([y for _, y in x[300:]]) == 1
    assert q[y].mean() > 0.9 and q[~y].mean() < 0.05


def test_seeds_alone_part_abuse_from_reports(spark):
    m = train([])
    q = m.predict(np.stack([features(s) for s, _ in SEEDS]).astype(float))
    assert np.mean((q >= 0.5) == [y == 1 for _, y in SEEDS]) >= 0.9
    docs = spark.createDataFrame([(1, "Lũ quản lý này là đồ súc sinh!!!", "z"), (2, "Cổ tức tốt.", "z"), (3, None, "z"), (4, "", "z"), (4, "", "z"), (None, "x", "z")], "doc_id long, text string, k string")
    labels = spark.createDataFrame([(1, 1, "abusive"), (1, 2, "clean"), (2, 1, "clean"), (9, 1, "hateful"), (3, 1, "unsure"), (None, 1, "clean")], "doc_id long, reviewer_no int, verdict string")
    rows = reviewed(docs, "doc_id", "text", labels, "verdict", ("abusive", "hateful"), ("clean",))
    assert sorted((y, n) for _, y, n in rows) == [(0.0, 1.0), (0.5, 2.0)]
    got = [(r.doc_id, r.score >= 0.5) for r in scores(docs, "doc_id", "text", m).collect()]
    assert sorted(got, key=str) == sorted([(1, True), (2, False), (3, False), (4, False), (4, False), (None, False)], key=str)
    assert scores(docs.limit(0), "doc_id", "text", m).count() == 0


def test_held_out_accuracy(spark):
    import os

    import pandas as pd

    root = os.environ.get("NEWSQUARRY_TESTDATA", "/root/testdata") + "/sf0.1"
    docs, labels = pd.read_parquet(f"{root}/documents.parquet").set_index("doc_id").text, pd.read_parquet(f"{root}/review_labels.parquet")
    labels = labels[labels.verdict != "unsure"]
    x = [features(docs[i]).tolist() for i in labels.doc_id]
    y = labels.verdict.isin(["abusive", "hateful", "sexual"]).astype(float).tolist()
    half = len(x) // 2
    m = train([(a, b, 1.0) for a, b in zip(x[:half], y[:half])])
    q = m.predict(np.array(x[half:]))
    assert np.mean((q >= 0.5) == np.array(y[half:])) > 0.9  # some verdicts are wrong
