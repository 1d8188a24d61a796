"""Functions and operators of the core against plain Python and small hand-made cases."""

import json
import random
import re
import unicodedata
from urllib.parse import parse_qsl, urlencode, urlsplit

import pytest
from pyspark.sql import functions as F

from newsquarry.functions import dates, html, profile, text, url
from newsquarry.operators import classify, cluster, enrich, graph, ingest, match, tasks
from newsquarry.plans import pipeline
from newsquarry.plans.event_query import EventQuery
from newsquarry.sources import connectors, files, sinks


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


URLS = [
    ("http://www.tuoitre.vn/a-12345678.htm?utm_source=x#f", "https://tuoitre.vn/a-12345678.htm", "tuoitre.vn::12345678"),
    ("https://m.site.vn:8080/amp/x//y/amp", "https://site.vn/x/y", ""),
    ("https://amp.site.vn/story-1234567.html/amp/", "https://site.vn/story-1234567.html", "site.vn::1234567"),
    ("https://a.vn/?id=5&b=2&p=&articleid=7", "https://a.vn/?articleid=7&id=5", ""),
    ("https://news.baomoi.com/x-c99.epi", "https://news.baomoi.com/x-c99.epi", "baomoi.com::99"),
    ("  https://a.vn  ", "https://a.vn/", ""), ("no url", "", ""), ("", "", ""), (None, "", ""), ("https://a.vn/a b_c", "https://a.vn/a b_c", ""),
]


@pytest.mark.parametrize("raw,canonical,key", URLS)
def test_urls(spark, raw, canonical, key):
    assert one(spark, raw, url.canonical_url) == canonical
    assert one(spark, raw, url.article_id) == key
    assert one(spark, raw, url.dedup_key) == (key or canonical)


def test_canonical_url_twice_is_once(spark):
    r = random.Random(1)
    raw = [f"http{'s' * r.randrange(2)}://{r.choice(['', 'www.', 'm.', 'mobi.'])}a.vn/{r.choice(['x', 'amp/y', 'z/amp', ''])}{r.choice(['', '/'])}{r.choice(['', '?id=1&id=0', '?q=1', '#x'])}" for _ in range(60)]
    df = spark.createDataFrame([(x,) for x in raw], "u string").select("u", url.canonical_url("u").alias("c")).withColumn("cc", url.canonical_url("c"))
    for row in df.collect():
        assert row.c == row.cc
        assert sorted(k for k, _ in parse_qsl(urlsplit(row.c).query)) == [k for k, _ in parse_qsl(urlsplit(row.c).query)]
    assert urlencode([("id", "0"), ("id", "1")]) in {urlsplit(r.c).query for r in df.collect()}


def test_fold_and_titles(spark):
    s = "Công ty ĐẠI Việt: phạt 500 triệu - Báo X | Y"
    plain = "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c)).replace("đ", "d")
    assert one(spark, s, text.fold) == plain
    assert one(spark, s, text.normal_title) == "cong ty dai viet phat 500 trieu"
    assert one(spark, "ngắn", text.title_hash) == "" and one(spark, None, text.title_hash) == ""
    assert one(spark, s, text.title_hash) == one(spark, s.replace("- Báo X | Y", "– Báo Z"), text.title_hash)
    assert one(spark, "Vụ nổ ở ở nhà máy 123 của A", text.title_tokens) == ["vu", "no", "nha", "may"]


def test_bodies(spark):
    body = "Tin.\n* [Khác](https://x.vn/a)\n- ![Image 3: x](u)\n- Một ý.\nMọi SỰ giúp đỡ xin gửi\nsố 1"
    assert one(spark, body, text.editorial_body) == "Tin.\n- Một ý."
    assert one(spark, "Tin.\n- Một ý.", text.editorial_body) == "Tin.\n- Một ý."
    assert one(spark, None, text.editorial_body) is None and one(spark, "", text.editorial_body) == ""


def test_main_text():
    para = "<p>" + "Câu chữ của bài báo dài. " * 12 + "</p>"
    page = f"<html><nav><a>Menu</a></nav><article><h1>Đề</h1>{para}<table><tr><td>x</td></tr></table></article><footer>Chân</footer></html>"
    got = html.main_text(page)
    assert got.startswith("Đề\nCâu chữ") and "Menu" not in got and "Chân" not in got and "x" not in got.split("\n")
    assert html.main_text("<p>ngắn</p>") is None and html.main_text(None) is None and html.main_text("<<<>&") is None


def test_acquire(spark):
    page = "<article>" + "<p>" + "chữ " * 200 + "</p></article>" + " " * 2000
    df = spark.createDataFrame([(page, None, 200), ("short", page, 200), (None, None, 429), (None, "x", 200)], "d string, r string, s int")
    got = [x["status"] for x in df.select(html.acquire(F.col("d"), F.col("r"), F.col("s")).alias("a")).select("a.*").collect()]
    assert got == ["fetched", "fetched", "ratelimited", "failed"]


def test_profiles(spark):
    assert one(spark, "Công ty cổ phần Thép Tavoco", profile.without_legal_form) == "Thép Tavoco"
    assert one(spark, "Công ty cổ phần Thép Tavoco", profile.short_names) == ["Thép Tavoco", "Tavoco"]
    assert tuple(one(spark, "Tổng công ty A - B - AB", profile.headline_parts)) == ("Tổng công ty A - B", "AB")
    assert one(spark, "12 Phố X, Hà Nội", lambda c: profile.locations(c, ["Hà Nội", "Huế"])) == ["Hà Nội"]


def test_dates(spark):
    df = spark.createDataFrame([("2024-01-20", "2024-03-05"), ("2024-01-20", "2024-01-19")], "a string, b string").select(F.col("a").cast("date").alias("a"), F.col("b").cast("date").alias("b"))
    got = [[(str(x.after), str(x.before)) for x in r.m] for r in df.select(dates.month_chunks(F.col("a"), F.col("b")).alias("m")).collect()]
    assert got == [[("2024-01-20", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-05")], []]
    weeks = df.select(dates.week_chunks(F.col("a"), F.col("b")).alias("w")).first().w
    assert (str(weeks[0].after), str(weeks[0].before), str(weeks[-1].before), len(weeks)) == ("2024-01-20", "2024-01-26", "2024-03-05", 7)
    assert one(spark, "Tue, 02 Jan 2024 10:00:00 GMT", dates.rfc822_date) == "2024-01-02" and one(spark, "2024-05-06T1", dates.rfc822_date) == "2024-05-06"
    w = spark.range(1).select(dates.daily_window(F.lit("2024-01-10 18:00:00").cast("timestamp"), "UTC", 5).alias("w")).first().w
    assert (w.before - w.after).days == 4


NAMES = [("AAA", "Alpha", "names"), ("AAA", "Alpha Steel", "subsidiaries"), ("BBB", "Steel", "names"), ("BBB", "BBB", "names"), ("CCC", "Hòa Phát", "names"), ("DDD", "Huế", "locations"), ("AAA", "alpha", "names"), (None, "x1", "names"), ("EEE", None, "names")]


def naive(rows, txt, bare, stops=()):
    out = {}
    for ticker, alias, kind in rows:
        if not ticker or not alias or kind == "locations" or alias.upper() in stops or (not bare and alias.upper() == ticker):
            continue
        m = re.search(rf"(?<!\w){re.escape(alias)}(?!\w)", txt, re.I)
        if m and m.start() < out.get(ticker, 10**9):
            out[ticker] = m.start()
    return out


def test_matcher_against_one_search_an_alias(spark):
    r = random.Random(3)
    words = ["Alpha", "Steel", "BBB", "hòa", "Phát", "Hòa Phát", "alpha steel", "Alphax", "x", ",", "(BBB)", "Huế", "x_Alpha"]
    arts = [(str(i), " ".join(r.choices(words, k=6)), None, r.choice(["", None, "Steel"]), " ".join(r.choices(words, k=9)), "t") for i in range(80)]
    df = spark.createDataFrame(arts, "article_id string, title string, description string, sapo string, body string, ticker string")
    pool = spark.createDataFrame(NAMES, "ticker string, alias string, alias_kind string")
    got = {(x.article_id, x.ticker): (x.location, x.pos) for x in match.alias_hits(df, match.alias_index(pool)).collect()}
    want = {}
    for a in arts:
        for field, t in (("title", a[1]), ("description", a[2]), ("sapo", a[3]), ("body", a[4])):
            for ticker, pos in naive(NAMES, t or "", field != "body").items():
                want.setdefault((a[0], ticker), (field, pos))
    assert got == want
    assert match.alias_hits(df.limit(0), match.alias_index(pool)).count() == 0


def test_matcher_stoplist_and_blocked(spark):
    pool = spark.createDataFrame(NAMES, "ticker string, alias string, alias_kind string")
    df = spark.createDataFrame([("1", "Khánh Hòa phát hiện", None, None, None), ("2", "Hòa Phát và Khánh Hòa phát hiện", None, None, None)], "article_id string, title string, description string, sapo string, body string")
    got = [x.article_id for x in match.alias_hits(df, match.alias_index(pool, ("STEEL",)), blocked=("Khánh Hòa phát hiện",)).collect()]
    assert got == ["2"]
    assert "Steel" not in [x.alias for x in match.alias_index(pool, ("STEEL",)).collect()]


def test_gate_and_primary(spark):
    hits = spark.createDataFrame([("a", t, "x", loc, 1.0, 0) for t, loc in (("A", "title"), ("B", "body"), ("C", "sapo"))] + [("b", "A", "x", "body", 1.0, 3), ("b", "B", "x", "body", 1.0, 1)], "article_id string, ticker string, alias string, location string, weight double, pos int")
    assert sorted((r.article_id, r.ticker) for r in match.roundup_gate(hits).collect()) == [("a", "A"), ("b", "A"), ("b", "B")]
    arts = spark.createDataFrame([("a", None), ("b", "Z"), ("c", "H")], "article_id string, ticker_hint string")
    assert {r.article_id: r.ticker for r in match.primary_ticker(hits, arts).collect()} == {"a": "A", "b": "B", "c": "H"}


def test_classifier_tiers(spark):
    v = classify.Vocabulary(general=(("nước thải", "E"), ("thanh tra", "G")), strong=(("bị phạt", "G"),), title=(("vào cuộc", "G"),), noise=("báo lãi", "thanh tra giá"), high=("phong tỏa",), guards=("không ",))
    cases = [
        ("A bị phạt", "", "", True, "esg"), ("A không hề bị phạt", "", "", False, "non_esg"), ("A báo lãi", "", "", False, "noise"), ("A bị phạt dù báo lãi", "", "", True, "esg"), ("A không báo lãi", "nước thải", "", True, "esg"),
        ("A", "nước thải", "báo lãi", False, "noise"), ("A", "phong tỏa, nước thải, báo lãi", "", True, "esg"), ("A phạt B 750 triệu", "", "", True, "esg"), ("A vào cuộc - Báo X", "", "", True, "esg"), (None, None, None, False, "non_esg"), ("A thu hồi 10 ha đất", None, None, True, "esg"),
    ]
    df = spark.createDataFrame([(str(i), t, s, b, "Báo X", "k") for i, (t, s, b, _, _) in enumerate(cases)], "article_id string, title string, sapo string, body string, source string, keepx string")
    got = {int(r.article_id): (r.keep, r.reason) for r in classify.classify(df, v).collect()}
    assert got == {i: (k, w) for i, (_, _, _, k, w) in enumerate(cases)}


@pytest.mark.parametrize("t,want", [("phạt 3 tỷ đồng", "high"), ("phạt 500 triệu", "high"), ("phạt 499 triệu", "medium"), ("phạt 20 triệu rồi 3 tỷ", "medium"), ("bị phong tỏa", "high"), ("", "medium")])
def test_severity(spark, t, want):
    assert one(spark, t, lambda c: classify.severity(c, ("phong tỏa",))) == want


def test_components_match_union_find(spark):
    r = random.Random(5)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    parent.setdefault(3, 3)
    got = {x.node: x.component for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_clusters(rows, window=10, least=0.45, ratio=0.7):
    out = {}
    for ticker in {t for t, *_ in rows}:
        own = [x for x in rows if x[0] == ticker]
        n, df = len(own), {}
        for _, _, _, tk in own:
            for w in tk:
                df[w] = df.get(w, 0) + 1
        comp = {x[1]: x[1] for x in own}

        def find(x, comp=comp):
            while comp[x] != x:
                x = comp[x]
            return x

        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                if (a[2] is None) != (b[2] is None) or (a[2] is not None and abs((a[2] - b[2]).days) > window):
                    continue
                both = set(a[3]) & set(b[3])
                if both and (len(both) / len(set(a[3]) | set(b[3])) >= least or any(len(w) >= 4 and w != ticker.lower() and df[w] >= 2 and df[w] / n <= ratio for w in both)):
                    comp[find(b[1])] = find(a[1])
        groups = {}
        for x in own:
            groups.setdefault(find(x[1]), set()).add(x[1])
        for g in groups.values():
            for x in g:
                out[(ticker, x)] = frozenset(g)
    return out


def test_clusters_equal_all_pairs(spark):
    r = random.Random(11)
    vocab = ["xa", "lũ", "nổ", "cháy", "kho", "thải", "sông", "phạt", "nhà", "máy", "dầu", "tràn", "đất", "thép", "lương"]
    arts = [(f"i{i:03d}", r.choice(["AAA", "BBB", "aaa"]), " ".join(r.choices(vocab, k=r.randrange(0, 6))), r.choice([None, "", "2024-01-01", "2024-01-05T00:00:00Z", "2024-01-20", "2024-02-02"])) for i in range(70)]
    df = spark.createDataFrame(arts, "article_id string, ticker string, title string, published_at string")
    rows = [(x.ticker, x.article_id, x.day, x.tokens) for x in cluster.prepared(df).collect()]
    want = brute_clusters(rows)
    got = {}
    for x in cluster.cluster_events(df).collect():
        got.setdefault((x.ticker, x.event_key), set()).add(x.article_id)
    assert {frozenset(v) for v in got.values()} == set(want.values())
    assert cluster.cluster_events(df.limit(0)).count() == 0


def test_inheritance_equals_all_pairs(spark):
    r = random.Random(2)
    vocab = ["phat", "thep", "alpha", "nguon", "nuoc", "thai", "song", "xa", "no", "lu", "chay", "kho"]
    members = [("AAA", f"i{i}", f"AAA:e{i % 5}", i, 20, list(dict.fromkeys(r.choices(vocab, k=r.randrange(0, 7)))), ["alpha", "nguon"]) for i in range(60)]
    df = spark.createDataFrame(members, "ticker string, article_id string, event_key string, position int, members int, tokens array<string>, distinctive array<string>")
    judged = {f"i{i}": r.choice(["risk", "not_risk"]) for i in range(0, 60, 4)}
    got = {x.article_id: (x.source_id, x.sentiment) for x in cluster.inherit(df, spark.createDataFrame(list(judged.items()), "article_id string, sentiment string")).collect()}
    want = {}
    for m in members:
        event = [x for x in members if x[2] == m[2] and x[1] in judged]
        if m[1] in judged or not event:
            continue
        a = set(m[5])
        if any((a & set(x[5]) & {"alpha", "nguon"}) or (a | set(x[5]) and len(a & set(x[5])) / len(a | set(x[5])) >= 0.45) for x in event):
            want[m[1]] = (event[0][1], judged[event[0][1]])
    assert got == want and want


def test_merge_by_two_keys(spark):
    rows = [("1", "h", "2024-01-01", None, "t1", 1), ("1", "h", "2024-01-01", "s", "t1", 2), ("2", "h", "2024-01-01", "z", "t2", 3), ("3", "", "2024-01-01", "q", "t3", 1), ("4", None, None, "", "t4", 1), (None, "h", "d", "n", "t5", 0)]
    df = spark.createDataFrame(rows, "article_id string, title_hash string, published_at string, sapo string, title string, at int")
    got = {r.article_id: (r.sapo, r.title) for r in ingest.merge_articles(df, ["at"], ("sapo",)).collect()}
    assert got == {"1": ("s", "t1"), "3": ("q", "t3"), "4": ("", "t4"), None: ("n", "t5")}


def test_append_is_idempotent(spark):
    a = spark.createDataFrame([("x", 1)], "task_id string, n int")
    b = spark.createDataFrame([("x", 9), ("y", 2), ("y", 2)], "task_id string, n int")
    once = ingest.append_new(a, b, ["task_id"])
    assert sorted(tuple(r) for r in ingest.append_new(once, b, ["task_id"]).collect()) == [("x", 1), ("y", 2)]


def test_scorers_fall_back(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(7)] + [(9, None)], "i int, t string").coalesce(1)
    assert enrich.keep_negative(df, "t", lambda b: ["not_risk"] * (len(b) - 1)).count() == 8  # wrong length keeps all
    assert enrich.keep_negative(df, "t", lambda b: 1 / 0).count() == 8
    assert enrich.keep_negative(df, "t", lambda b: ["not_risk" if x in ("t1", "t6") else "risk" for x in b]).count() == 6
    got = [r.translation for r in enrich.translate(df, "t", lambda b: [x.upper() if x != "t2" else "" for x in b]).orderBy("i").collect()]
    assert got[:3] == ["T0", "T1", "t2"]
    tries = []
    assert enrich.with_retries(lambda: tries.append(1) or 1 / 0)() is None and len(tries) == 3


def test_nearest_prefers_the_earlier(spark):
    left = spark.createDataFrame([("A", 2022), ("A", 2030), ("B", 2022)], "t string, y int")
    right = spark.createDataFrame([("A", 2021, 1.0), ("A", 2023, 3.0), ("A", None, 5.0)], "t string, ry int, v double")
    assert sorted((r.t, r.y, r.v) for r in enrich.nearest(left, right, "t", "y", "ry", "v").collect() if r.t == "A") == [("A", 2022, 1.0), ("A", 2030, 3.0)]
    assert [r.v for r in enrich.nearest(left, right, "t", "y", "ry", "v").collect() if r.t == "B"] == [None]


def test_event_query(spark):
    rows = [(f"A:{i}", "A", "", f"2024-01-{i:02d}", "Phạt Đông Á" if i % 2 else "Khác", None, "E" if i < 5 else "G", "high", None, None) for i in range(1, 10)]
    ev = spark.createDataFrame(rows, "id string, ticker string, company string, date string, headline string, headline_en string, esg_type string, severity string, controversy_level string, created_at string")
    q = EventQuery(search="dong a", size=2)
    assert q.where(ev).count() == 5 and q.pages(ev).first().pages == 3
    assert [r.id for r in q.with_(page=99).rows(ev).collect()] == ["A:1"] and [r.id for r in q.with_(page=-3).rows(ev).collect()] == ["A:9", "A:7"]
    assert EventQuery(level="none").where(ev).count() == 9 and EventQuery(tickers=("B",)).where(ev).count() == 0
    assert EventQuery().stats(ev).first().e == 4


def test_connector_window_and_replay(spark, tmp_path):
    day = 86_400
    page = lambda *ts: [{"url": f"u{t}", "title": "t", "ts": t * day if t is not None else None} for t in ts]
    assert [x["url"] for x in connectors.windowed(iter([page(9, 8), page(8, 7, None), page(2), page(1)]), "1970-01-08", "1970-01-09")] == ["u9", "u8", "u7", "uNone"]
    assert list(connectors.windowed(iter([[], page(1)]), "1970-01-01", "1970-01-09")) == []
    d = tmp_path / "rec" / "q1"
    d.mkdir(parents=True)
    (d / "page-0001.json").write_text(json.dumps(page(9, 8)))
    (d / "page-0002.json").write_text(json.dumps(page(8, 1)))
    spark.dataSource.register(connectors.ReplaySource)
    got = spark.read.format("news_replay").option("path", str(tmp_path / "rec")).option("after", "1970-01-08").option("before", "1970-01-20").load()
    assert sorted(r.url for r in got.collect()) == ["u8", "u9"]
    assert connectors.parse_feed("<rss><item><title>a</title><link>u</link></item><item><title/></item></rss>")[0]["url"] == "u" and connectors.parse_feed("<x") == []
    with pytest.raises(connectors.RateLimited):
        connectors.check_status(429)
    with pytest.raises(connectors.BackendError):
        connectors.check_status(404)
    assert connectors.signature({"b": 1, "a": 2, "z": 3}, {"a", "b"}, b"k") == connectors.signature({"a": 2, "b": 1}, {"a", "b"}, b"k")


def test_files_and_sinks(spark, tmp_path):
    (tmp_path / "al").mkdir()
    (tmp_path / "al" / "abc.json").write_text(json.dumps({"names": ["Một", " "], "projects": ["Hai"]}, ensure_ascii=False))
    (tmp_path / "al" / "bad.json").write_text("{")
    assert sorted((r.ticker, r.alias, r.alias_kind) for r in files.alias_pool(spark, str(tmp_path / "al")).collect()) == [("ABC", "Hai", "projects"), ("ABC", "Một", "names")]
    (tmp_path / "c.csv").write_text("﻿Ticker,Name,2020\nABC,Công ty,\"1,000\"\n ,x,1\n", encoding="utf-8")
    assert [tuple(r) for r in files.companies(spark, str(tmp_path / "c.csv")).collect()] == [("ABC", "Công ty", "1,000")]
    m = spark.createDataFrame([("A", "1", "2024-01-01"), ("A", "2", None), ("A", "3", "2024-02-01"), ("A", "1", "2024-01-01")], "ticker string, article_id string, published_at string")
    old = spark.createDataFrame([("A", "1", "2024-01-01")], "ticker string, article_id string, published_at string")
    assert [x.article_id for x in sinks.company_documents(m, old).first().articles] == ["3", "1", "2"]
    assert [(r.page, [x.article_id for x in r.articles]) for r in sinks.company_documents(m, old, page=2).orderBy("page").collect()] == [(0, ["3", "1"]), (1, ["2"])]
    sinks.write_ndjson(m, str(tmp_path / "out"))
    sinks.write_ndjson(m, str(tmp_path / "out"))
    assert spark.read.json(sinks.published(spark, str(tmp_path / "out"))).count() == 4 and sinks.newest_of(spark, [str(tmp_path / "none"), str(tmp_path / "out")]) == sinks.published(spark, str(tmp_path / "out"))
    assert sinks.publish_to(spark, lambda p: m.write.json(p), [str(tmp_path / "c.csv"), str(tmp_path / "two")])[str(tmp_path / "two")] == "written"
    sinks.write_ordered(m, str(tmp_path / "list"), "article_id", page=1)
    assert [r.article_id for r in spark.read.json(sinks.published(spark, str(tmp_path / "list"))).orderBy("article_id").collect()] == ["1", "1", "2", "3"]


def test_tasks(spark):
    q = spark.createDataFrame([("t1", "in_progress", 4, None, None), ("t2", "in_progress", 0, None, None), ("t3", "pending", 0, None, None)], "task_id string, status string, attempts int, next_attempt string, last_error string")
    f = spark.createDataFrame([("t1", "x" * 900), ("t2", "e")], "task_id string, error string")
    got = {r.task_id: (r.status, r.attempts, r.next_attempt) for r in tasks.after_failure(q, f, F.lit("2024-01-01T00:00:00Z").cast("timestamp"), [60, 600]).collect()}
    assert got["t1"][:2] == ("failed", 5) and got["t2"][:2] == ("backoff", 1) and got["t3"] == ("pending", 0, None)
    b = spark.createDataFrame([("a", True), ("b", False)], "backend string, dated boolean")
    terms = spark.createDataFrame([("x", "g", 0), ("y", "g", 1)], "term string, group_key string, ix int")
    grid = tasks.keyword_tasks(b, terms, F.lit("2024-01-10").cast("date"), F.lit("2024-02-10").cast("date"))
    assert grid.count() == 2 * 2 + 2 and grid.select("task_id").distinct().count() == 6


def test_pipeline_runs_and_survives_a_failed_stage(spark, small):
    from newsquarry.session import table

    t = {n: table(spark, small, n) for n in ("articles", "company_aliases")}
    assert pipeline.run("daily", t)["events"].count() > 0
    assert "hits" not in pipeline.run("match", {"articles": t["articles"]})


def test_vocabulary_from_a_table(spark):
    t = spark.createDataFrame([("Bị phạt", "strong", "G"), ("bị phạt", "strong", "G"), ("nước thải", "general", "E"), ("báo lãi", "noise", None), (None, "noise", None)], "term string, tier string, category string")
    v = classify.vocabulary_of(t)
    assert v.strong == (("bị phạt", "G"),) and v.general == (("nước thải", "E"),) and v.noise == ("báo lãi",) and v.high == ()
    with pytest.raises(ValueError):
        classify.vocabulary_of(t, 1)


def test_registries(spark, tmp_path):
    from newsquarry.sources.registry import Scorers, register_connectors

    register_connectors(spark, {"news_replay": "newsquarry.sources.connectors:ReplaySource"})
    with pytest.raises(ValueError):
        register_connectors(spark, {"other": "newsquarry.sources.connectors:ReplaySource"})
    s = Scorers()
    s.add("a", lambda c: (lambda b: b) if "A_KEY" in c else None)
    s.add("b", lambda c: len if "B_KEY" in c else None)
    assert s.pick({"B_KEY": "x"}) is len and s.pick({}) is None and s.pick({"B_KEY": "x"}, "b") is len
    with pytest.raises(KeyError):
        s.pick({}, "zzz")


def test_write_new(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    p = str(tmp_path / "x")
    assert [sinks.write_new(df.limit(0), p), sinks.write_new(df, p), sinks.write_new(df, p), sinks.write_new(df, p, True)] == ["failed", "written", "exists", "written"]
