"""Registered queries of matching in stages, workers, enrichment and exports, with their SQL."""

from __future__ import annotations

import json
from pyspark.sql import functions as F

from newsquarry.functions import profile, text
from newsquarry.operators import classify, cluster, enrich, match, tasks, workers
from newsquarry.plans import pipeline
from newsquarry.plans.registered import _EDITORIAL, _HITS, _INDEX, _JUDGED, _ONCE, _SCOPES, _attributed, _hits, _instant, _members, once
from newsquarry.registry import query
from newsquarry.session import scratch, table
from newsquarry.sources import connectors, sinks
from newsquarry.sources.registry import register_connectors

NOW = "2026-01-01T00:00:00Z"
_AT = "TIMESTAMPTZ '2026-01-01 00:00:00+00'"
_W = r"[^\p{L}\p{N}_]"


def _bound(t: str, name: str) -> str:
    return f"regexp_matches({t}, '(^|{_W})' || regexp_escape({name}) || '($|{_W})')"


def _doubled(t: str) -> str:
    return f"regexp_replace({t}, '({_W})', '\\1\\1', 'g')"


def _now():
    return F.lit(NOW).cast("timestamp")


def _index(spark, root):
    return match.alias_index(table(spark, root, "company_aliases"))


# ---- matching ---------------------------------------------------------------------------------------------------
_TEXTS = f"fl AS (SELECT article_id, unnest([0, 1, 2, 3]) AS no, lower(unnest([title, description, sapo, {_EDITORIAL}])) AS t FROM a)"


@query(
    "txt_primary",
    f"WITH {_ONCE}, {_INDEX}, {_TEXTS}, p AS (SELECT article_id, ticker, no, length(regexp_extract(t, '(?s)^(.*?(?:^|{_W}))' || regexp_escape(low) || '(?:$|{_W})', 1)) AS pos FROM fl JOIN ix ON contains(t, low) WHERE weight >= 1 AND NOT (no = 3 AND low = lower(ticker)) AND {_bound('t', 'low')}), "
    "f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY no, pos, ticker) AS k FROM p) WHERE k = 1) SELECT a.article_id, coalesce(f.ticker, ticker_hint) AS ticker FROM a LEFT JOIN f USING (article_id)",
)
def txt_primary(spark, root):
    """WIN-02: the company an article is about."""
    return match.primary_ticker(_hits(spark, root), once(spark, root, "ticker_hint"))


@query(
    "txt_consuming",
    f"WITH {_ONCE}, {_INDEX}, {_TEXTS}, s AS (SELECT * FROM ix WHERE weight >= 1), d AS (SELECT DISTINCT low FROM s), pat AS (SELECT string_agg(regexp_escape({_doubled('low')}), '|' ORDER BY length(low) DESC, low) AS p FROM d), "
    f"m AS (SELECT article_id, no, unnest(regexp_extract_all({_doubled('t')}, '(?:^|{_W})(' || p || ')(?:$|{_W})', 1)) AS dd FROM fl, pat), o AS (SELECT article_id, no, low AS took FROM m JOIN d ON {_doubled('low')} = dd), "
    f"h AS (SELECT article_id, ticker, min(no) AS no FROM o JOIN s ON contains(took, low) WHERE {_bound('took', 'low')} AND NOT (no = 3 AND low = lower(ticker)) GROUP BY 1, 2) SELECT article_id, ticker, ['title', 'description', 'sapo', 'body'][no + 1] AS location FROM h",
)
def txt_consuming(spark, root):
    """TXT-01: hits of a scan from left to right that takes the longest name of each place."""
    return match.alias_hits(once(spark, root, "title", "description", "sapo", "body"), _index(spark, root), consuming=True).select("article_id", "ticker", "location")


@query(
    "txt_two_stage",
    f"WITH {_HITS}, known AS (SELECT article_id, upper(x->>'ticker') AS ticker, min(x->>'location') AS location, 'cached' AS stage FROM (SELECT article_id, unnest(CAST(json(cached_hits) AS JSON[])) AS x FROM a WHERE cached_hits IS NOT NULL) GROUP BY 1, 2), "
    "head AS (SELECT article_id, ticker, location, 'head' AS stage FROM hits JOIN a USING (article_id) WHERE cached_hits IS NULL AND location <> 'body'), one AS (SELECT * FROM known UNION ALL SELECT * FROM head) "
    "SELECT * FROM one UNION ALL SELECT article_id, ticker, location, 'body' FROM hits JOIN a USING (article_id) WHERE body_status = 'fetched' AND article_id NOT IN (SELECT article_id FROM one)",
)
def txt_two_stage(spark, root):
    """TXT-03, PRJ-06: cached hits, then those of the head, then those of all fields."""
    rows = once(spark, root, "title", "description", "sapo", "body", "cached_hits", "body_status")
    return match.two_stage_hits(rows, _index(spark, root)).select("article_id", F.upper("ticker").alias("ticker"), "location", "stage")


@query("txt_stoplist", f"WITH {_HITS.replace('FROM company_aliases WHERE', 'FROM company_aliases WHERE upper(trim(alias)) NOT IN (SELECT upper(short_name) FROM companies WHERE short_name IS NOT NULL) AND')} SELECT * FROM hits")
def txt_stoplist(spark, root):
    """TXT-06: hits with a stop-list and blocked contexts from tables, the second of which is missing."""
    at = scratch(spark, "stops")
    table(spark, root, "companies").select("short_name").write.parquet(at)
    index = match.alias_index(table(spark, root, "company_aliases"), match.optional_list(spark, at, "short_name"))
    return match.alias_hits(once(spark, root, "title", "description", "sapo", "body"), index, blocked=match.optional_list(spark, f"{at}-none", "context")).select("article_id", "ticker", "location")


@query(
    "txt_vetting",
    f"WITH {_ONCE}, {_INDEX}, al AS (SELECT * FROM (SELECT upper(ticker) AS ticker, trim(alias) AS alias, alias_kind AS kind, lower(trim(alias)) AS low, row_number() OVER (PARTITION BY upper(ticker), lower(trim(alias)) ORDER BY alias_kind IN ('names', 'subsidiaries', 'projects') DESC, trim(alias), alias_kind) AS k FROM company_aliases WHERE ticker IS NOT NULL AND length(trim(alias)) >= 2) WHERE k = 1 AND low <> lower(ticker)), "
    "nm AS (SELECT DISTINCT ticker, low FROM ix UNION SELECT ticker, lower(ticker) FROM ix UNION SELECT upper(ticker), lower(trim(company_name)) FROM companies WHERE length(trim(company_name)) > 0), "
    "tx AS (SELECT article_id, concat_ws(' | ', nullif(title, ''), nullif(description, ''), nullif(sapo, '')) AS t FROM a), "
    f"pf AS (SELECT article_id, t, ticker, low, count(*) OVER (PARTITION BY article_id, ticker) AS n FROM tx JOIN nm ON contains(lower(t), low) WHERE {_bound('lower(t)', 'low')}), "
    "c AS (SELECT ticker, low, count(*) AS hits, count(*) FILTER (WHERE n > 1) AS together FROM pf GROUP BY 1, 2), sm AS (SELECT ticker, low, string_agg(left(t, 110), ' ¦ ' ORDER BY article_id) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY ticker, low ORDER BY article_id) AS k FROM pf WHERE n = 1) WHERE k <= 3 GROUP BY 1, 2), "
    "z AS (SELECT ticker, alias, kind, coalesce(hits, 0) AS hits, coalesce(together, 0) AS together, CASE WHEN coalesce(hits, 0) > 0 THEN together / hits ELSE 0.0 END AS r, coalesce(samples, '') AS samples FROM al LEFT JOIN c USING (ticker, low) LEFT JOIN sm USING (ticker, low)) "
    "SELECT ticker, alias, kind, hits, together, round(r, 6) AS ratio, CASE WHEN hits = 0 OR r >= 0.5 THEN 'PASS' WHEN kind <> 'names' AND hits >= 5 AND r < 0.1 THEN 'FAIL' ELSE 'REVIEW' END AS verdict, samples FROM z",
)
def txt_vetting(spark, root):
    """AGG-07, JOIN-10: how often each alias stands with another name of its company, and where it does not."""
    names = table(spark, root, "companies").select("ticker", F.col("company_name").alias("name"))
    vetted = match.vet_aliases(once(spark, root, "title", "description", "sapo"), _index(spark, root), names=names)
    return vetted.withColumn("samples", F.array_join("samples", " ¦ "))


# ---- verdicts, by the definitions of the tiers -------------------------------------------------------------------
_GENERAL = "nước thải|khói|chất thải|bùn|phát thải|amiăng|lương|tai nạn|ngộ độc|người bị thương|bảo hiểm xã hội|công nhân|giao dịch với bên liên quan|báo cáo tài chính|diện kiểm soát|thanh tra|trái phiếu"
_STRONG = "bị phạt|khám trụ sở|đình chỉ|kêu cứu|đổi màu|chậm trả|nhập viện"
_NOISE = "báo lãi|rót|chỉ số|giá cước|cổ tức"
_HIGH = "tấn công|phong tỏa|sập giàn giáo|nổ bồn"
_TAGS = {"E": ("nước thải", "khói", "chất thải", "bùn", "phát thải", "amiăng"), "S": ("lương", "tai nạn", "ngộ độc", "người bị thương", "bảo hiểm xã hội", "công nhân"), "G": ("giao dịch với bên liên quan", "báo cáo tài chính", "diện kiểm soát", "thanh tra", "trái phiếu")}
_TAGS2 = {"E": (("kêu cứu", "ts"), ("đổi màu", "ts")), "S": (("chậm trả", "ts"), ("nhập viện", "ts"), ("bị thu hồi", "ts")), "G": (("bị phạt", "ts"), ("khám trụ sở", "ts"), ("đình chỉ", "ts"), ("vào cuộc", "tc"), ("giải trình", "tc"))}
_N1 = ", ".join(" + ".join(f"CAST(contains(x, '{t}') AS INTEGER)" for t in _TAGS[g]) + f" AS {g.lower()}1" for g in "ESG")
_N2 = ", ".join(" + ".join(f"CAST(contains({w}, '{t}') AS INTEGER)" for t, w in _TAGS2[g]) + f" AS {g.lower()}2" for g in "ESG")
_VERDICTS = (
    f"{_SCOPES}, v1 AS (SELECT article_id, tc, ts, x, regexp_matches(regexp_replace(ts, '(?s)(?:không bị.{{0,17}}|bác tin.{{0,18}})(?:{_STRONG})', ' ', 'g'), '(^|{_W})({_STRONG})($|{_W})') OR regexp_matches(ts, '(^|{_W})phạt[^.;:]{{0,60}}?\\d[\\d.,]*\\s*(?:tỷ|triệu)') OR regexp_matches(ts, '(^|{_W})thu hồi[^,;:]{{0,30}}?đất($|{_W})') AS strong, "
    f"regexp_matches(x, '{_GENERAL}') OR regexp_matches(tc, '(^|{_W})(vào cuộc|giải trình)($|{_W})') OR regexp_matches(ts, '(^|{_W})bị thu hồi($|{_W})') AS other, regexp_matches(x, '{_HIGH}') AS high, "
    f"regexp_matches(regexp_replace(x, '(?s)(?:không .{{0,6}}|chưa .{{0,7}})(?:{_NOISE})', ' ', 'g'), '{_NOISE}') AS noisy, {_N1}, {_N2}, regexp_extract(x, '(\\d+[.,]?\\d*)\\s*(tỷ|triệu)', 1) AS amount, regexp_extract(x, '(\\d+[.,]?\\d*)\\s*(tỷ|triệu)', 2) AS unit FROM s), "
    "v2 AS (SELECT *, strong OR other AS esg, NOT strong AND NOT high AND noisy AS noise, CASE WHEN e1 + s1 + g1 = 0 THEN e2 ELSE e1 END AS e, CASE WHEN e1 + s1 + g1 = 0 THEN s2 ELSE s1 END AS sc, CASE WHEN e1 + s1 + g1 = 0 THEN g2 ELSE g1 END AS g FROM v1), "
    "verdicts AS (SELECT article_id, esg AND NOT noise AS keep, CASE WHEN noise THEN 'noise' WHEN esg THEN 'esg' ELSE 'non_esg' END AS reason, CASE WHEN esg AND NOT noise THEN CASE WHEN e > g AND e > sc THEN 'E' WHEN sc > e AND sc > g THEN 'S' WHEN e > 0 THEN 'E' WHEN sc > 0 THEN 'S' ELSE 'G' END END AS category, "
    "CASE WHEN esg AND NOT noise THEN CASE WHEN high OR unit = 'tỷ' OR (unit = 'triệu' AND TRY_CAST(replace(amount, ',', '.') AS DOUBLE) >= 500) THEN 'high' ELSE 'medium' END END AS severity_class FROM v2)"
)


@query("txt_verdicts", f"WITH {_VERDICTS} SELECT * FROM verdicts")
def txt_verdicts(spark, root):
    """TXT-04, TXT-07: the verdict of every article."""
    return classify.classify(once(spark, root, "title", "sapo", "body", "source")).select("article_id", "keep", "reason", "category", "severity_class")


_GATED = f"{_HITS}, cnt AS (SELECT article_id, count(*) AS n FROM hits GROUP BY 1), gated AS (SELECT DISTINCT article_id FROM hits JOIN cnt USING (article_id) WHERE n < 3 OR location = 'title')"
_OUTCOMES = f"{_VERDICTS}, {_GATED.removeprefix(_ONCE + ', ')}, oc AS (SELECT article_id, CASE WHEN article_id IN (SELECT article_id FROM gated) AND keep THEN 'matched' WHEN body_status IN ('fetched', 'skipped', 'failed') THEN 'unmatched' ELSE 'deferred' END AS outcome FROM verdicts JOIN a USING (article_id))"


def _outcomes(spark, root):
    arts = classify.classify(once(spark, root, "title", "sapo", "body", "source", "body_status")).select("article_id", "keep", "body_status")
    hit = match.roundup_gate(_hits(spark, root)).select("article_id", F.lit(True).alias("hit")).distinct()
    o = arts.join(hit, "article_id", "left").select(classify.outcome(F.coalesce("hit", F.lit(False)), F.col("keep"), F.col("body_status")).alias("outcome"))
    return o.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("txt_outcomes", f"WITH {_OUTCOMES} SELECT outcome, count(*) AS n FROM oc GROUP BY 1")
def txt_outcomes(spark, root):
    """TXT-09, FLT-05, STR-09, AGG-04: articles by outcome of matching and verdict."""
    return _outcomes(spark, root)


@query("snk_counters", f"WITH {_OUTCOMES} SELECT outcome, count(*) AS n FROM oc GROUP BY 1")
def snk_counters(spark, root):
    """SNK-05: the counters of a match run, published as a JSON document and read again."""
    at = scratch(spark, "counters")
    sinks.write_counts(_outcomes(spark, root), at, "outcome", "n")
    found = spark.read.text(sinks.published(spark, at)).select(F.explode(F.from_json("value", "map<string,long>")))
    return found.select(F.col("key").alias("outcome"), F.col("value").alias("n"))


@query("txt_vocabulary", f"WITH {_SCOPES}, kw AS (SELECT DISTINCT lower(trim(query_text)) AS term FROM search_queue WHERE kind = 'keyword' AND length(trim(query_text)) > 0) SELECT article_id, EXISTS (SELECT 1 FROM kw WHERE contains(x, term)) AS keep FROM s")
def txt_vocabulary(spark, root):
    """SRC-19, TXT-06: verdicts by a vocabulary that a table gives."""
    terms = table(spark, root, "search_queue").where("kind = 'keyword' AND length(trim(query_text)) > 0").select(F.trim("query_text").alias("term"), F.lit("general").alias("tier"), F.lit("G").alias("category"))
    v = classify.vocabulary_of(terms)
    bare = classify.Vocabulary(general=v.general, proximity=())
    return classify.classify(once(spark, root, "title", "sapo", "body", "source"), bare).select("article_id", "keep")


# ---- workers ----------------------------------------------------------------------------------------------------
_CLAIMED = f"q AS (SELECT *, {_instant('next_attempt')} AS due FROM search_queue), fr AS (SELECT task_id, row_number() OVER (PARTITION BY backend ORDER BY due NULLS FIRST, task_id) AS k FROM q WHERE (status = 'pending' AND due IS NULL) OR (status IN ('pending', 'backoff', 'in_progress') AND due <= {_AT}))"


@query("str_claimed", f"WITH {_CLAIMED} SELECT q.task_id, CASE WHEN k <= 3 THEN 'in_progress' ELSE status END AS status, CASE WHEN k <= 3 THEN '2026-01-01T00:30:00Z' ELSE next_attempt END AS next_attempt FROM q LEFT JOIN fr USING (task_id)")
def str_claimed(spark, root):
    """STR-01: the queue after the next three tasks of each backend were claimed."""
    return tasks.claim(table(spark, root, "search_queue"), _now(), 3).select("task_id", "status", "next_attempt")


def _search(task: dict) -> list[dict]:
    if len(task["task_id"]) % 7 == 3:
        raise ConnectionError("gone")
    return [{"url": f"https://x.example/{i}", "title": task["query_text"]} for i in range(len(task["query_text"] or "") * 7 % 120)]


@query(
    "str_worker",
    f"WITH {_CLAIMED}, c AS (SELECT q.*, k <= 5 AS hit, length(task_id) % 7 = 3 AS bad, length(coalesce(query_text, '')) * 7 % 120 AS found FROM q LEFT JOIN fr USING (task_id)), "
    "n AS (SELECT *, coalesce(hit, false) AND NOT bad AS ok, coalesce(hit, false) AND bad AS failed FROM c), kids AS (SELECT task_id || ':' || strftime(CAST(g AS DATE), '%Y-%m-%d') || ':' || strftime(least(CAST(before_date AS DATE), CAST(g AS DATE) + 6), '%Y-%m-%d') AS task_id, 'pending' AS status, 0 AS items_found, 0 AS attempts "
    "FROM n, generate_series(CAST(after_date AS DATE)::TIMESTAMP, CAST(before_date AS DATE)::TIMESTAMP, INTERVAL 7 DAY) t(g) WHERE ok AND found >= 90 AND CAST(before_date AS DATE) - CAST(after_date AS DATE) >= 7) "
    "SELECT task_id, CASE WHEN ok THEN 'done' WHEN failed AND coalesce(attempts, 0) + 1 >= 5 THEN 'failed' WHEN failed THEN 'backoff' ELSE status END AS status, CAST(CASE WHEN ok THEN found ELSE items_found END AS INTEGER) AS items_found, CAST(CASE WHEN failed THEN coalesce(attempts, 0) + 1 ELSE attempts END AS INTEGER) AS attempts FROM n UNION ALL SELECT * FROM kids WHERE task_id NOT IN (SELECT task_id FROM q)",
)
def str_worker(spark, root):
    """STR-13, STR-02, STR-03, STR-05: the queue after a round of search workers, five tasks a backend."""
    queue, _ = workers.search_round(table(spark, root, "search_queue"), _search, _now(), 5)
    return queue.select("task_id", "status", F.col("items_found").cast("int").alias("items_found"), F.col("attempts").cast("int").alias("attempts"))


def _body(url: str) -> tuple[str | None, str]:
    if len(url) % 3 == 0:
        raise ConnectionError("gone")
    return (f"Text of {url}", "fetched") if len(url) % 3 == 1 else (None, "ratelimited")


@query(
    "str_bodies",
    f"WITH {_HITS}, w AS (SELECT * FROM a WHERE body_status IN ('pending', 'ratelimited') AND match_status = 'pending' ORDER BY fetched_at, article_id LIMIT 200), e AS (SELECT article_id, count(*) AS n FROM hits WHERE location <> 'body' GROUP BY 1) "
    "SELECT article_id, CASE WHEN n > 0 THEN 'skipped' WHEN length(url_canonical) % 3 = 0 THEN 'failed' WHEN length(url_canonical) % 3 = 1 THEN 'fetched' ELSE 'ratelimited' END AS body_status, coalesce(n, 0) AS hits FROM w LEFT JOIN e USING (article_id)",
)
def str_bodies(spark, root):
    """STR-10, FLT-01, PRJ-06: a round of body workers over the 200 oldest waiting articles."""
    rows = once(spark, root, "title", "description", "sapo", "body_status", "match_status", "fetched_at", "url_canonical")
    done = workers.body_round(rows, _index(spark, root), _body, 200)
    return done.select("article_id", "body_status", F.coalesce(F.size(match.cached_hits("cached_hits")), F.lit(0)).cast("long").alias("hits"))


@query("agg_tasks", "WITH b AS (SELECT DISTINCT backend, backend <> 'brave' AS dated FROM search_queue), u AS (SELECT count(*) AS n FROM (SELECT DISTINCT group_key, query_text FROM search_queue WHERE kind = 'keyword')), l AS (SELECT count(*) AS n FROM (SELECT DISTINCT ticker, lower(alias) FROM company_aliases WHERE alias_kind = 'names')) SELECT backend, CAST(CASE WHEN dated THEN 4 ELSE 1 END * u.n + 4 * l.n AS BIGINT) AS tasks FROM b, u, l")
def agg_tasks(spark, root):
    """AGG-08, STR-06, JOIN-09: tasks of the keyword and of the name builder by backend."""
    q = table(spark, root, "search_queue")
    backends = q.select("backend", (F.col("backend") != "brave").alias("dated")).distinct()
    span = (F.lit("2025-01-15").cast("date"), F.lit("2025-04-10").cast("date"))
    terms = q.where("kind = 'keyword'").groupBy("group_key", F.col("query_text").alias("term")).agg(F.min("sub_query_ix").alias("ix"))
    names = table(spark, root, "company_aliases").where("alias_kind = 'names'").groupBy("ticker", F.lower("alias").alias("low")).agg(F.min("alias").alias("alias")).withColumn("ix", F.lit(0))
    return tasks.counts_by_backend(tasks.keyword_tasks(backends, terms, *span), tasks.alias_tasks(backends, names, *span))


# ---- replies and enrichment --------------------------------------------------------------------------------------
@query("scl_translations", f"WITH {_ONCE} SELECT article_id, CASE WHEN length(title) % 5 = 0 OR trim(coalesce(summary_en, '')) = '' THEN title ELSE trim(summary_en) END AS shown FROM a WHERE title IS NOT NULL")
def scl_translations(spark, root):
    """SCL-43: translations out of a model's reply, under several keys, of a wrong length, or blank."""
    rows = once(spark, root, "title", "summary_en").where("title IS NOT NULL")
    one = F.array(F.coalesce("summary_en", F.lit("")))
    n = F.length("title")
    reply = F.when(n % 5 == 0, F.to_json(F.struct(F.array(F.lit("a"), F.lit("b")).alias("translations")))).when(n % 4 == 0, F.to_json(one)).when(n % 4 == 1, F.to_json(F.struct(one.alias("translations")))).when(n % 4 == 2, F.to_json(F.struct(one.alias("results")))).otherwise(F.to_json(F.struct(F.lit("ok, done: [1]").alias("note"), one.alias("other"))))
    return rows.select("article_id", F.element_at(text.translations(reply, F.array("title")), 1).alias("shown"))


def _sentiment(batch: list[str]) -> list[str]:
    return ["not_risk" if "báo lãi" in t.lower() else "risk" for t in batch]


def _english(batch: list[str]) -> list[str]:
    return ["" if len(t) % 4 == 0 else f"EN {t}" for t in batch]


def _judge(batch: list[str]) -> list[str]:
    return ["no json" if "rót" in t.lower() else json.dumps({"level": "Major" if "phạt" in t.lower() else "Minor", "justification": f"{t}.", "confidence": 70}, ensure_ascii=False) for t in batch]


@query("udf_translate", f"WITH {_ONCE} SELECT article_id, CASE WHEN length(title) % 4 = 0 THEN title ELSE 'EN ' || title END AS translation FROM a")
def udf_translate(spark, root):
    """UDF-05: translations in order; where the translator gives none the source text stays."""
    return enrich.translate(once(spark, root, "title"), "title", _english).select("article_id", "translation")


@query(
    "enr_run",
    f"WITH RECURSIVE {_JUDGED.replace('sentiment, controversy_level FROM a WHERE', 'sentiment, controversy_level FROM a WHERE')}, pend AS (SELECT DISTINCT article_id, title FROM j WHERE article_id NOT IN (SELECT article_id FROM jd)), one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY ticker) AS k FROM taken) WHERE k = 1), "
    "over_ AS (SELECT article_id, sentiment, controversy_level FROM one WHERE sentiment <> 'risk' OR controversy_level IS NOT NULL) "
    "SELECT p.article_id, CASE WHEN o.article_id IS NOT NULL THEN CASE WHEN o.sentiment = 'risk' THEN 'done' ELSE 'dropped' END WHEN contains(lower(title), 'báo lãi') THEN 'dropped' WHEN contains(lower(title), 'rót') THEN 'pending' ELSE 'done' END AS enrich_status, "
    "CASE WHEN o.article_id IS NOT NULL THEN CASE WHEN o.sentiment = 'risk' THEN o.controversy_level END WHEN contains(lower(title), 'báo lãi') OR contains(lower(title), 'rót') THEN NULL WHEN contains(lower(title), 'phạt') THEN 'Major' ELSE 'Minor' END AS controversy_level, "
    "CASE WHEN o.article_id IS NOT NULL THEN 'inherited' WHEN contains(lower(title), 'báo lãi') THEN 'gate' ELSE 'judged' END AS route FROM pend p LEFT JOIN over_ o USING (article_id)",
)
def enr_run(spark, root):
    """UDF-07, CLU-03, UDF-04 to UDF-06: what a run of the enrichment writes back for all articles without a verdict."""
    fields = ("sentiment", "summary_en", "controversy_level", "controversy_justification")
    judged = once(spark, root, "enrich_status", *fields).where("enrich_status = 'done' AND sentiment IS NOT NULL").select("article_id", *fields)
    taken = cluster.inherit(_members(spark, root), judged, fields).groupBy("article_id").agg(F.min_by(F.struct(*fields), "ticker").alias("x")).select("article_id", *[f"x.{f}" for f in fields])
    pending = _attributed(spark, root).select("article_id", "title").distinct().join(judged.select("article_id"), "article_id", "left_anti")
    return enrich.enrichment(pending, taken, _sentiment, _english, _judge).select("article_id", "enrich_status", "controversy_level", "route")


# ---- a whole run -------------------------------------------------------------------------------------------------
@query("run_daily")
def run_daily(spark, root):
    """RUN-01, RUN-03, TXT-09: the stages of a daily run; events by company."""
    out = pipeline.run("daily", {n: table(spark, root, n) for n in ("articles", "company_aliases")})
    return out["events"].groupBy("ticker").agg(F.countDistinct("event_key").alias("events"), F.count(F.lit(1)).alias("articles"))


# ---- feeds and exports -------------------------------------------------------------------------------------------
@query("src_feed", "SELECT DISTINCT url_canonical AS url, trim(title) AS title, coalesce(CASE WHEN regexp_full_match(left(published_at, 10), '\\d{4}-\\d{2}-\\d{2}') THEN strftime(TRY_CAST(left(published_at, 10) AS DATE), '%Y-%m-%d') END, '') AS published_at FROM articles WHERE length(trim(title)) > 0")
def src_feed(spark, root):
    """SRC-03, UDF-01: RSS documents written from the articles and read through the feed connector."""
    rows = table(spark, root, "articles").where("length(trim(title)) > 0").select("url_canonical", "title", F.when(F.substring("published_at", 1, 10).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.substring("published_at", 1, 10).try_cast("date")).alias("d")).distinct()
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    date = F.coalesce(F.concat(F.lit("<pubDate>"), F.date_format("d", "E, dd MMM yyyy"), F.lit(" 10:11:12 GMT</pubDate>")), F.lit(""))
    item = F.concat(F.lit("<item><link>"), escaped(F.col("url_canonical")), F.lit("</link><title>"), escaped(F.trim(F.col("title"))), F.lit("</title><description>&lt;b&gt;x&lt;/b&gt;</description>"), date, F.lit("</item>"))
    # a document holds the items of a 256th of all addresses
    docs = rows.select(F.substring(F.sha1(F.encode("url_canonical", "UTF-8")), 1, 2).alias("p"), item.alias("i")).groupBy("p").agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list("i"), ""), F.lit("</channel></rss>")).alias("value"))
    at = scratch(spark, "feed")
    docs.select("value").write.option("maxRecordsPerFile", 1).text(at)
    register_connectors(spark, {"news_feed": f"{connectors.__name__}:FeedSource"})
    return spark.read.format("news_feed").option("path", at).load().select("url", "title", "published_at").distinct()


@query("snk_export", f"SELECT 1 AS run, count(*) AS n FROM articles UNION ALL SELECT 2, count(*) FROM articles WHERE {_instant('fetched_at')} >= {_AT} OR {_instant('matched_at')} >= {_AT}")
def snk_export(spark, root):
    """SNK-01: a first export of everything and a second one of what changed since the mark the first saved."""
    at = scratch(spark, "export")
    rows = table(spark, root, "articles").select("article_id", "fetched_at", "matched_at")
    made = [spark.read.schema(rows.schema).json(sinks.export_delta(rows, at, now)).select(F.lit(n).alias("run")) for n, now in ((1, NOW), (2, "2026-02-01T00:00:00Z"))]
    return made[0].unionByName(made[1]).groupBy("run").agg(F.count(F.lit(1)).alias("n"))


# ---- company profiles --------------------------------------------------------------------------------------------
_PLACES = "pl AS (SELECT list(DISTINCT lower(trim(alias))) AS places FROM company_aliases WHERE alias_kind = 'locations' AND length(trim(alias)) > 0), co AS (SELECT c.*, (SELECT min(trim(alias)) FROM company_aliases x WHERE x.ticker = c.ticker AND alias_kind = 'locations') AS place FROM companies c)"


@query(
    "scl_profile",
    f"WITH {_PLACES} SELECT ticker, CASE WHEN short_name IS NULL THEN trim(company_name || coalesce(' - ' || place, '')) ELSE trim(company_name) END AS full_name, trim(short_name) AS short, 'Số 5, ' || place AS address, "
    r"CASE WHEN place IS NULL THEN '' ELSE array_to_string(list_sort(list_filter(places, lambda p: contains(lower(place), p))), ', ') END AS places, trim(regexp_replace(company_name || ' Ba', '\s+', ' ', 'g')) AS subsidiary FROM co, pl",
)
def scl_profile(spark, root):
    """SRC-12, SCL-25, SCL-28, SCL-29: names, address, places and subsidiaries read from profile pages made of the company table; the places come from a table."""
    aliases = table(spark, root, "company_aliases").where("alias_kind = 'locations' AND length(trim(alias)) > 0")
    listed = sorted({r[0] for r in match.small_enough(aliases.select(F.lower(F.trim("alias"))).distinct(), match.MAX_ALIASES) or []})
    place = aliases.groupBy("ticker").agg(F.min(F.trim("alias")).alias("place"))
    c = table(spark, root, "companies").join(place, "ticker", "left")
    tail = F.coalesce(F.concat(F.lit(" - "), F.coalesce("short_name", "place")), F.lit(""))
    data = F.to_json(F.struct(F.concat("ticker", F.lit(": "), "company_name", tail, F.lit(" - Hồ sơ doanh nghiệp | Trang")).alias("headline")))
    rows = F.concat("company_name", F.lit(" Ba 85,000 ( Tr. VND ) 75,5 "), "company_name", F.lit(" Bốn 1,000 ( Tr. VND ) 50 "))
    page = F.concat(F.lit('<title>x</title><script type="application/ld+json">'), data, F.lit("</script><p>Trụ sở chính</p><span>Địa chỉ </span> <td class=a> Số 5,  "), F.coalesce("place", F.lit("")), F.lit(". </td>"))
    parts = profile.headline_parts(profile.page_headline(page), tuple(listed))
    address = F.when(F.col("place").isNotNull(), profile.page_address(page))
    return c.select("ticker", parts["full"].alias("full_name"), parts["short"].alias("short"), address.alias("address"), F.array_join(profile.locations(address, listed), ", ").alias("places"), F.get(profile.subsidiaries_of_text(rows), 0)["name"].alias("subsidiary"))
