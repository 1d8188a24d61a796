"""Matching in stages, workers, enrichment, replies and exports, against brute force and by cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from newsquarry.functions import text
from newsquarry.operators import classify, enrich, match, tasks, workers
from newsquarry.sources import connectors, sinks

QUEUE = "task_id string, backend string, group_key string, sub_query_ix int, query_text string, after_date string, before_date string, status string, attempts int, next_attempt string, last_error string, items_found int, done_at string, kind string, ticker string"


def now():
    return F.lit("2026-01-01T00:00:00Z").cast("timestamp")


@pytest.mark.parametrize("seed", range(20))
def test_consuming_scan_equals_an_alternation(seed):
    r = random.Random(seed)
    names = sorted({" ".join(r.choices("ab cd abc".split(), k=r.randrange(1, 4))) for _ in range(6)})
    rows = [(f"T{i % 3}", n, 1.0) for i, n in enumerate(names)]
    words = lambda n: " ".join(r.choices(["ab", "cd", "abc", "x"], k=n))
    t = words(14)
    m = match.Matcher(rows)
    rx = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)")
    want = {}
    for hit in rx.finditer(t):
        for ticker, n, _ in rows:
            if re.search(rf"(?<!\w){re.escape(n)}(?!\w)", hit.group()):
                want.setdefault(ticker, hit.start())
    assert {k: v[0] for k, v in m.find(t, consuming=True).items()} == want
    assert set(want) <= set(m.find(t))


def test_noise_terms_against_spans(spark):
    v = classify.Vocabulary(general=(("giá cước vận tải xả thải", "E"), ("khói", "E")), title=(("cổ tức bị treo", "G"),), quality=(("chậm cổ tức", "S"),), noise=("giá cước", "cổ tức"), proximity=())
    r = random.Random(3)
    parts = ["giá cước", "giá cước vận tải xả thải", "khói", "cổ tức bị treo", "chậm cổ tức", "cổ tức", "không", "chưa", "rất nhiều chuyện khác", "x"]
    rows = [(str(i), *[" ".join(r.choices(parts, k=r.randrange(4))) for _ in range(3)], "Báo") for i in range(300)]

    def counts(title, sapo, body):
        lead = f"{title} {sapo}".lower()
        whole = f"{lead} {body}".lower()
        inside = [m.span() for m in re.finditer("giá cước vận tải xả thải|khói", whole)]
        inside += [m.span() for m in re.finditer(r"(?<!\w)cổ tức bị treo(?!\w)", title.lower())] + [m.span() for m in re.finditer(r"(?<!\w)chậm cổ tức(?!\w)", lead)]
        found = [m.span() for m in re.finditer("giá cước|cổ tức", whole)]
        return any(not any(x <= a and b <= y for x, y in inside) and not any(n in whole[max(0, a - 12) : a] for n in ("không ", "chưa ")) for a, b in found)

    df = spark.createDataFrame(rows, "article_id string, title string, sapo string, body string, source string")
    got = {x.article_id: x.reason == "noise" for x in classify.classify(df, v).collect()}
    plain = [x for x in rows if not any(n in " ".join(x[1:4]) for n in ("không", "chưa"))]  # a hidden term shortens the reach of a negation
    assert {x[0]: got[x[0]] for x in plain} == {x[0]: counts(*x[1:4]) for x in plain} and 20 < sum(got[x[0]] for x in plain) < len(plain)


def test_claim_takes_the_due_ones_and_those_of_the_dead(spark):
    row = lambda i, b, s, at: (i, b, "g", 0, "q", None, None, s, 0, at, None, None, None, "keyword", None)
    q = spark.createDataFrame([row("a", "x", "pending", None), row("b", "x", "backoff", "2025-12-31T00:00:00Z"), row("c", "x", "backoff", "2026-02-01T00:00:00Z"), row("d", "x", "in_progress", "2025-12-31T23:00:00Z"), row("e", "x", "done", None), row("f", "y", "in_progress", "2026-01-01T00:10:00Z")], QUEUE)
    one = tasks.claim(q, now(), 2)
    assert {r.task_id for r in one.where("claimed").collect()} == {"a", "b"}
    assert {r.next_attempt for r in one.where("claimed").collect()} == {"2026-01-01T00:30:00Z"}
    two = tasks.claim(one.drop("claimed"), now(), 2)
    assert {r.task_id for r in two.where("claimed").collect()} == {"d"}
    assert tasks.claim(q.limit(0), now()).count() == 0


def test_search_round(spark):
    row = lambda i, q, s="pending", n=0: (i, "x", "g", 0, q, "2025-01-01", "2025-01-20", s, n, None, None, None, None, "keyword", None)
    q = spark.createDataFrame([row("full", "f"), row("few", "w"), row("bad", "b"), row("last", "b", n=4), row("done", "d", "done")], QUEUE)

    def search(task):
        if task["query_text"] == "b":
            raise OSError("gone")
        return [{"url": f"u{i}", "title": None, "more": 1} for i in range(90 if task["query_text"] == "f" else 2)]

    after, items = workers.search_round(q, search, now(), 9)
    got = {r.task_id: r for r in after.collect()}
    assert {k: (v.status, v.items_found) for k, v in got.items() if ":" not in k} == {"full": ("done", 90), "few": ("done", 2), "bad": ("backoff", None), "last": ("failed", None), "done": ("done", None)}
    assert got["bad"].last_error == "OSError: gone" and got["full"].done_at == "2026-01-01T00:00:00Z" and got["bad"].next_attempt == "2026-01-01T00:05:00Z"
    kids = {k: v for k, v in got.items() if ":" in k}
    assert len(kids) == 3 and {v.status for v in kids.values()} == {"pending"} and max(v.before_date for v in kids.values()) == "2025-01-20"
    assert items.count() == 92
    again, none = workers.search_round(after, search, now(), 0)
    assert again.count() == after.count() and none.count() == 0


def test_body_round_stops_after_its_time(spark):
    arts = spark.createDataFrame([(f"a{i}", "t", None, None, "pending", "pending", f"2025-01-0{i + 1}", f"u{i}") for i in range(4)], "article_id string, title string, description string, sapo string, body_status string, match_status string, fetched_at string, url_canonical string").coalesce(1)
    index = spark.createDataFrame([], "ticker string, alias string, kind string, weight double")
    done = workers.body_round(arts, index, lambda u: ("b", "fetched") if u != "u1" else 1 / 0, 3)
    assert {(r.article_id, r.body_status) for r in done.collect()} == {("a0", "fetched"), ("a1", "failed"), ("a2", "fetched")}
    assert workers.body_round(arts, index, lambda u: ("b", "fetched"), 3, seconds=0.0).count() == 0


def test_pacing():
    at, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        at[0] += s

    t = workers.Throttle(10, sleep=sleep, clock=lambda: at[0])
    assert t.wait() == 0 and 6.6 < t.wait() < 13.4 and len(slept) == 1
    b = workers.Bucket(2.0, 2, sleep=sleep, clock=lambda: at[0])
    slept.clear()
    for _ in range(4):
        b.take()
    assert slept == [0.5, 0.5]


REPLIES = [('["a", " b "]', ["a", "b"]), ('{"translations": ["a", ""]}', ["a", "y"]), ('{"results": ["a", "b"]}', ["a", "b"]), ('{"n": 1, "other": ["a", "b"]}', ["a", "b"]), ('{"t": "x: [1]", "other": ["a]", "b"]}', ["a]", "b"]), ('["a"]', ["x", "y"]), ("nonsense", ["x", "y"]), (None, ["x", "y"]), ("{}", ["x", "y"])]


@pytest.mark.parametrize("reply,want", REPLIES)
def test_replies(spark, reply, want):
    df = spark.createDataFrame([(reply, ["x", "y"])], "j string, s array<string>")
    assert df.select(text.translations("j", F.col("s")).alias("v")).first().v == want
    known = df.select(text.labels("j", F.lit(2), ("a", "b"), "z").alias("v")).first().v
    assert known is None or len(known) == 2


def test_enrichment_leaves_what_was_not_judged(spark):
    events = spark.createDataFrame([(c, t) for c, t in zip("abcdef", ["x", "calm", "no", "x", "x", "bad"])], "article_id string, title string")
    taken = spark.createDataFrame([("a", "risk", "S", "Major", "J."), ("d", "risk", "S", None, None), ("e", "not_risk", None, None, None), ("zz", "risk", "S", "No", "J.")], "article_id string, sentiment string, summary_en string, controversy_level string, controversy_justification string")
    judge = lambda b: ['{"level": "No", "justification": "w"}' if b[0] != "bad" else "?"]
    got = {r.article_id: (r.enrich_status, r.sentiment, r.controversy_level, r.route) for r in enrich.enrichment(events, taken, lambda b: ["not_risk" if t == "calm" else "risk" for t in b], lambda b: [t.upper() for t in b], judge).collect()}
    assert got == {"a": ("done", "risk", "Major", "inherited"), "b": ("dropped", "not_risk", None, "gate"), "c": ("done", "risk", "No", "judged"), "d": ("done", "risk", "No", "judged"), "e": ("dropped", "not_risk", None, "inherited"), "f": ("pending", None, None, "judged")}


def test_final_errors_are_not_tried_again():
    calls = []

    def call(kind):
        calls.append(kind)
        raise kind("x")

    tried = enrich.with_retries(call, 3, transient=(OSError,), final=(ValueError,))
    assert tried(ValueError) is None and tried(OSError) is None and len(calls) == 4
    with pytest.raises(KeyError):
        tried(KeyError)


def test_vetting_counts_names_and_shows_samples(spark):
    arts = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(["Mả Đông và ABC", "mả đông xa", "Mả Đông gần", "Công ty Một Hai có Mả Đông", "mả đông nữa", "mả đông mãi"])], "article_id string, title string")
    index = match.alias_index(spark.createDataFrame([("ABC", "Mả Đông", "locations"), ("ABC", "ABC", "names"), ("ABC", "Không Có", "names")], "ticker string, alias string, alias_kind string"))
    names = spark.createDataFrame([("abc", " Công ty Một Hai ")], "ticker string, name string")
    got = {r.alias: r for r in match.vet_aliases(arts, index, fields=("title",), names=names).collect()}
    assert set(got) == {"Mả Đông", "Không Có"} and got["Không Có"].verdict == "PASS" and got["Không Có"].samples == []
    assert (got["Mả Đông"].hits, got["Mả Đông"].together, got["Mả Đông"].verdict) == (6, 2, "REVIEW") and got["Mả Đông"].samples == ["mả đông xa", "Mả Đông gần", "mả đông nữa"]


def test_exports_and_flags(spark, tmp_path):
    df = spark.createDataFrame([("a", "2025-01-01T00:00:00Z", None), ("b", "2025-03-01T00:00:00Z", None), ("c", None, "2025-03-02T00:00:00Z")], "id string, fetched_at string, matched_at string")
    runs = [{r.id for r in spark.read.json(sinks.export_delta(df, str(tmp_path / "e"), t)).collect()} for t in ("2025-02-01T00:00:00Z", "2025-03-02T00:00:00Z", "2025-05-01T00:00:00Z")]
    assert runs == [{"a", "b", "c"}, {"b", "c"}, {"c"}]
    done = []
    assert [sinks.once_only(spark, str(tmp_path), "clean", lambda: done.append(1)) for _ in range(2)] == [True, False] and done == [1]
    assert sinks.write_counts(spark.createDataFrame([("x", 2)], "k string, v long"), str(tmp_path / "c"), "k", "v") == {"x": 2}


def test_feeds():
    assert connectors.feed_time("Tue, 02 Jan 2024 10:00:00 GMT") == ("2024-01-02", 1704189600) and connectors.feed_time("2024-01-02T00:00") == ("2024-01-02", None) and connectors.feed_time("") == ("", None)
    one = connectors.parse_feed("<rss><item><title>A</title><link>u</link><description>&lt;b&gt;x &amp;amp; y&lt;/b&gt;</description></item><item><title>no link</title></item></rss>")
    assert [(x["title"], x["description"]) for x in one] == [("A", "x & y")] and connectors.parse_feed("<rss") == []


def test_command_line(spark, small, tmp_path, capsys):
    from newsquarry.__main__ import main

    assert main(["list"]) == 0 and "txt_hits" in capsys.readouterr().out
    assert main(["query", "agg_queue", small, "--out", str(tmp_path)]) == 0 and spark.read.parquet(f"{tmp_path}/agg_queue").count() > 0
    assert main(["run", "match", small, "--limit", "20", "--since", "2024-01-01", "--rematch", "--out", str(tmp_path)]) == 0
    assert spark.read.parquet(f"{tmp_path}/merged").select("article_id").distinct().count() <= 20
