"""Registered queries of the core over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsquarry.functions import dates, html, profile, text, url
from newsquarry.operators import classify, cluster, enrich, ingest, match, tasks
from newsquarry.plans.event_query import EventQuery, headline, label
from newsquarry.registry import query
from newsquarry.session import cut, scratch, table
from newsquarry.sources import files, sinks
from newsquarry.streaming import ingest as streaming

# ---- one row for each article: the state that is furthest on, with the body of any of its rows ---------------------
_STATE = ("matched_at", "cached_hits", "match_status", "esg_status", "enrich_status", "summary_en", "controversy_level")
_ONCE = "a AS (SELECT * EXCLUDE (rn, body, whole), whole AS body FROM (SELECT *, max(body) OVER (PARTITION BY article_id) AS whole, row_number() OVER (PARTITION BY article_id ORDER BY coalesce(body_status, '') = 'fetched' DESC, " + ", ".join(f"coalesce({c}, '') DESC" for c in _STATE) + ") AS rn FROM articles) WHERE rn = 1)"


def _fold(x: str) -> str:
    return f"replace(replace(strip_accents(lower({x})), 'đ', 'd'), 'ð', 'd')"


def _suffix(x: str) -> str:
    return "rtrim(regexp_replace(" + x + r", '\s*[\-|–—]\s*[^\-|–—]{1,60}$', ''), ' ')"


def _normal(x: str) -> str:
    return "trim(regexp_replace(" + _fold(_suffix(_suffix(_suffix(f"trim(coalesce({x}, ''))")))) + r", '[^\p{L}\p{N}_]+', ' ', 'g'))"


_STOPS = "[" + ", ".join(f"'{w}'" for w in text.STOPWORDS) + "]"


def _tokens(x: str) -> str:
    return "list_filter(list_distinct(string_split(" + _normal(x) + r", ' ')), lambda x: length(x) >= 2 AND NOT regexp_full_match(x, '\p{N}+') AND NOT list_contains(" + _STOPS + ", x))"


def _instant(x: str) -> str:
    return "CASE WHEN regexp_full_match(trim(" + x + r"), '\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?') THEN CAST(CASE WHEN regexp_matches(trim(" + x + r"), '(Z|[+-]\d{2}:\d{2})$') THEN trim(" + x + ") ELSE trim(" + x + ") || 'Z' END AS TIMESTAMPTZ) END"


def once(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """(article_id, columns...) of each article once; nothing else is read but the columns that tell its state.

    One aggregation with partial results, so an article may hold any share of the rows.
    """
    rows = table(spark, root, "articles")
    plain = [c for c in columns if c != "body"]
    place = [(F.coalesce("body_status", F.lit("")) == "fetched").alias("p"), *[F.coalesce(F.col(c), F.lit("")).alias(f"p{i}") for i, c in enumerate(_STATE)]]
    best = F.max(F.struct(*place, *[F.col(c).alias(f"v_{c}") for c in plain])).alias("x") if plain else F.lit(None).alias("x")
    whole = [F.max("body").alias("body")] if "body" in columns else []
    found = rows.groupBy("article_id").agg(best, *whole)
    return found.select("article_id", *[F.col("body") if c == "body" else F.col(f"x.v_{c}").alias(c) for c in columns])


# ---- scalar functions -------------------------------------------------------------------------------------------
_PARTS = r"'^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?'"
_VARIANTS = ("{0}", "concat('  ', replace({0}, 'https://', 'http://WWW.'), '?utm_source=rss&id=7#top')", "concat(replace({0}, 'https://', 'HTTP://m.'), '/amp')", "concat(replace({0}, '.html', ''), '//x/')", "'no url'")
_HOST = r"regexp_replace(split_part(lower(regexp_extract(u, " + _PARTS + r", 2)), ':', 1), '^(www|m|amp|mobile|mobi)\.', '')"
_PATH0 = "CASE WHEN regexp_extract(u, " + _PARTS + ", 3) = '' THEN '/' ELSE regexp_extract(u, " + _PARTS + ", 3) END"


@query(
    "scl_urls",
    "WITH v AS (SELECT DISTINCT unnest([" + ", ".join(v.format("url_canonical") for v in _VARIANTS) + "]) AS raw FROM articles), w AS (SELECT raw, trim(raw) AS u FROM v), "
    f"h AS (SELECT raw, u, {_HOST} AS host, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_PATH0}, '^/amp/', '/'), '/amp$', ''), '/amp/$', ''), '/{{2,}}', '/', 'g') AS p, regexp_extract(u, {_PARTS}, 4) AS q FROM w), "
    "c AS (SELECT raw, host, CASE WHEN length(p) > 1 AND p LIKE '%/' THEN left(p, length(p) - 1) ELSE p END AS path, CASE WHEN q LIKE '%id=7%' THEN '?id=7' ELSE '' END AS q FROM h) "
    "SELECT raw AS url, CASE WHEN host = '' THEN '' ELSE 'https://' || host || path || q END AS canonical, host AS site, "
    r"CASE WHEN host = '' OR regexp_extract(path, '-(\d{6,})\.(?:html?|htm|chn|epi|aspx)$', 1) = '' THEN '' ELSE host || '::' || regexp_extract(path, '-(\d{6,})\.(?:html?|htm|chn|epi|aspx)$', 1) END AS id, host LIKE '%news.google.com' AS from_google FROM c",
)
def scl_urls(spark, root):
    """SCL-01 to SCL-08: canonical URL, site and id of every article's URL and of variants of it."""
    u = F.col("url_canonical")
    variants = F.array(u, F.concat(F.lit("  "), F.replace(u, F.lit("https://"), F.lit("http://WWW.")), F.lit("?utm_source=rss&id=7#top")), F.concat(F.replace(u, F.lit("https://"), F.lit("HTTP://m.")), F.lit("/amp")), F.concat(F.replace(u, F.lit(".html"), F.lit("")), F.lit("//x/")), F.lit("no url"))
    rows = table(spark, root, "articles").select(F.explode(variants).alias("url")).distinct()
    return rows.select("url", url.canonical_url("url").alias("canonical"), url.domain_of("url").alias("site"), url.article_id("url").alias("id"), url.is_from_host("url", "news.google.com").alias("from_google"))


@query("prj_articles", r"WITH x AS (SELECT DISTINCT url_canonical, title, regexp_extract(url_canonical, '://([^/]*)', 1) AS site, regexp_extract(url_canonical, '-(\d{6,})\.html?$', 1) AS n FROM articles), y AS (SELECT *, " + _normal("title") + " AS t FROM x) SELECT CASE WHEN n = '' THEN url_canonical ELSE site || '::' || n END AS article_id, url_canonical, site AS domain, title, CASE WHEN length(t) < 8 THEN '' ELSE left(sha1(left(t, 120)), 16) END AS title_hash FROM y")
def prj_articles(spark, root):
    """PRJ-01: search items projected to article records."""
    items = table(spark, root, "articles").select(F.col("url_canonical").alias("url"), "title").distinct()
    return ingest.to_articles(items).select("article_id", "url_canonical", "domain", "title", "title_hash")


@query("scl_titles", "SELECT DISTINCT title, " + _normal("title") + " AS normal, CASE WHEN length(" + _normal("title") + ") < 8 THEN '' ELSE left(sha1(left(" + _normal("title") + ", 120)), 16) END AS hash, array_to_string(list_sort(" + _tokens("title") + "), ' ') AS tokens FROM articles")
def scl_titles(spark, root):
    """SCL-10 to SCL-13: comparable form, hash and tokens of every title."""
    t = table(spark, root, "articles").select("title").distinct()
    return t.select("title", text.normal_title("title").alias("normal"), text.title_hash("title").alias("hash"), F.array_join(F.array_sort(text.title_tokens("title")), " ").alias("tokens"))


_RELATED = r"(?i)^\s*[*\-]\s*\[?!\[?Image|^\s*[*\-]\s+\[.*\]\(https?://"
_EDITORIAL = "regexp_replace(regexp_replace(array_to_string(list_filter(string_split(body, chr(10)), lambda x: NOT regexp_matches(x, '" + _RELATED + r"')), chr(10)), '^\s+|\s+$', '', 'g'), '(?is)\s*(" + "|".join(text.FOOTER_MARKERS) + ").*$', '')"


@query("scl_bodies", f"WITH {_ONCE} SELECT article_id, length(body) AS before, length({_EDITORIAL}) AS after, md5({_EDITORIAL}) AS digest FROM a WHERE body IS NOT NULL")
def scl_bodies(spark, root):
    """SCL-15 to SCL-17: the editorial part of every body."""
    b = text.editorial_body("body")
    return once(spark, root, "body").where("body IS NOT NULL").select("article_id", F.length("body").cast("long").alias("before"), F.length(b).cast("long").alias("after"), F.md5(F.encode(b, "UTF-8")).alias("digest"))


@query("dml_clean_once", f"WITH {_ONCE} SELECT count(*) AS scanned, count(*) FILTER (WHERE {_EDITORIAL} <> body) AS changed FROM a WHERE body IS NOT NULL")
def dml_clean_once(spark, root):
    """DML-08: one rewrite of all bodies, counted."""
    return ingest.rewrite_once(once(spark, root, "body"), "body", text.editorial_body("body"))[1]


@query("scl_suffix", r"WITH x AS (SELECT DISTINCT title, coalesce(source, '') AS s, regexp_extract(title, '(\s+[-–|]\s+[^-–|]{2,60}\s*)$', 1) AS suf FROM articles), y AS (SELECT *, replace(lower(regexp_replace(suf, '^[\s\-–|]+|[\s\-–|]+$', '', 'g')), ' ', '') AS p, replace(lower(trim(s)), ' ', '') AS q FROM x) SELECT title, s AS source, CASE WHEN suf <> '' AND p <> '' AND q <> '' AND (contains(q, p) OR contains(p, q)) THEN left(title, length(title) - length(suf)) ELSE title END AS stripped FROM y")
def scl_suffix(spark, root):
    """SCL-14: titles without the name of their source."""
    t = table(spark, root, "articles").select("title", F.coalesce("source", F.lit("")).alias("source")).distinct()
    return t.select("title", "source", text.strip_source_suffix("title", "source").alias("stripped"))


@query("scl_snippets", f"WITH {_ONCE}" + r" SELECT article_id, coalesce(left(coalesce(nullif(regexp_replace(sapo, '^\s+|\s+$', '', 'g'), ''), nullif(regexp_replace(description, '^\s+|\s+$', '', 'g'), ''), nullif(regexp_replace(body, '^\s+|\s+$', '', 'g'), '')), 300), '') AS snippet, concat_ws(' | ', nullif(title, ''), nullif(description, ''), nullif(sapo, '')) AS text, CASE WHEN body IS NULL OR trim(body) = '' THEN '(none)' WHEN length(body) > 600 THEN left(body, 600) || '…' ELSE body END AS prompt FROM a")
def scl_snippets(spark, root):
    """PRJ-02, SRC-17, SCL-20: snippet, joined text and cut body of every article."""
    rows = files.vet_text(once(spark, root, "title", "description", "sapo", "body"))
    return rows.select("article_id", text.snippet([F.col("sapo"), F.col("description"), F.col("body")]).alias("snippet"), "text", text.cut_with_marker("body", 600, "…", "(none)").alias("prompt"))


@query("scl_html", r"SELECT DISTINCT article_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(concat('<p class=x>', coalesce(description, ''), '</p><script>var a;</script>&amp;&nbsp;<b>', title, '</b>'), '(?is)<script\b.*?</script>|<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS plain FROM articles")
def scl_html(spark, root):
    """SCL-19: HTML fragments as text."""
    h = F.concat(F.lit("<p class=x>"), F.coalesce("description", F.lit("")), F.lit("</p><script>var a;</script>&amp;&nbsp;<b>"), F.col("title"), F.lit("</b>"))
    return table(spark, root, "articles").select("article_id", text.html_to_text(h).alias("plain")).distinct()


_DAY = r"CASE WHEN regexp_full_match(left(published_at, 10), '\d{4}-\d{2}-\d{2}') THEN TRY_CAST(left(published_at, 10) AS DATE) END"


@query("scl_dates", f"WITH {_ONCE} SELECT article_id, {_DAY} AS day, coalesce(CASE WHEN regexp_full_match(left(published_at, 4), '\\d{{4}}') THEN CAST(left(published_at, 4) AS INTEGER) END, 2025) AS year, coalesce(left(published_at, 10), '') AS shown FROM a")
def scl_dates(spark, root):
    """SCL-32, SCL-36, PRJ-05: dates and years of publication."""
    return once(spark, root, "published_at").select("article_id", dates.first_date("published_at").alias("day"), dates.event_year("published_at", 2025).alias("year"), F.coalesce(F.substring("published_at", 1, 10), F.lit("")).alias("shown"))


@query("scl_spans", "WITH q AS (SELECT task_id, CAST(after_date AS DATE) AS s, CAST(before_date AS DATE) AS e FROM search_queue), m AS (SELECT task_id, 'month' AS unit, greatest(s, CAST(g AS DATE)) AS after, least(e, CAST(last_day(CAST(g AS DATE)) AS DATE)) AS before FROM q, generate_series(date_trunc('month', s), date_trunc('month', e), INTERVAL 1 MONTH) t(g) WHERE s <= e), w AS (SELECT task_id, 'week' AS unit, CAST(g AS DATE) AS after, least(e, CAST(g AS DATE) + 6) AS before FROM q, generate_series(s::TIMESTAMP, e::TIMESTAMP, INTERVAL 7 DAY) t(g) WHERE s <= e) SELECT * FROM m UNION ALL SELECT * FROM w")
def scl_spans(spark, root):
    """SCL-30, SCL-31: the time of every task in months and in weeks."""
    q = table(spark, root, "search_queue").select("task_id", F.col("after_date").cast("date").alias("s"), F.col("before_date").cast("date").alias("e"))
    m = q.select("task_id", F.lit("month").alias("unit"), F.explode(dates.month_chunks(F.col("s"), F.col("e"))).alias("x"))
    w = q.select("task_id", F.lit("week").alias("unit"), F.explode(dates.week_chunks(F.col("s"), F.col("e"))).alias("x"))
    return m.unionByName(w).select("task_id", "unit", "x.after", "x.before")


# ---- scans, filters, merges -------------------------------------------------------------------------------------
@query("src_articles", f"WITH {_ONCE} SELECT article_id, title, published_at FROM a WHERE match_status = 'matched' AND published_at >= '2024-06-01' ORDER BY published_at DESC, article_id LIMIT 50")
def src_articles(spark, root):
    """SRC-01, FLT-03, SRT-01: the newest matched articles since a day (a top list)."""
    return once(spark, root, "match_status", "title", "published_at").where("match_status = 'matched' AND published_at >= '2024-06-01'").select("article_id", "title", "published_at").orderBy(F.desc("published_at"), "article_id").limit(50)


@query("src_by_keys", "SELECT DISTINCT article_id, title FROM articles WHERE url_original IN (SELECT encoded_url FROM url_decode_cache WHERE status = 'ok')")
def src_by_keys(spark, root):
    """SRC-02, JOIN-06: rows by a list of keys."""
    keys = table(spark, root, "url_decode_cache").where("status = 'ok'").select(F.col("encoded_url").alias("url_original"))
    return files.by_keys(table(spark, root, "articles").select("article_id", "title", "url_original"), keys, "url_original").select("article_id", "title").distinct()


_NUMBERS = "SELECT ticker, CAST(substr(y, 5) AS INTEGER) AS year, TRY_CAST(regexp_replace(v, '[,\\s]', '', 'g') AS DOUBLE) AS revenue FROM (UNPIVOT (SELECT ticker, rev_2020, rev_2021, rev_2022, rev_2023, rev_2024, rev_2025 FROM companies) ON COLUMNS(* EXCLUDE ticker) INTO NAME y VALUE v)"


@query("src_unpivot", f"SELECT * FROM ({_NUMBERS}) WHERE revenue IS NOT NULL")
def src_unpivot(spark, root):
    """SRC-08: the wide table of yearly figures as rows."""
    return enrich.wide_to_long(table(spark, root, "companies"), ["ticker"])


@query("join_nearest", f"WITH {_ONCE}, r AS (SELECT * FROM ({_NUMBERS}) WHERE revenue IS NOT NULL), h AS (SELECT article_id, ticker_hint AS ticker, CAST(left(published_at, 4) AS INTEGER) AS yr FROM a WHERE ticker_hint IS NOT NULL AND regexp_matches(published_at, '^\\d{{4}}')), z AS (SELECT article_id, ticker, yr, year, revenue, row_number() OVER (PARTITION BY article_id ORDER BY abs(year - yr), year) AS n FROM h LEFT JOIN r USING (ticker)) SELECT article_id, ticker, yr, year, revenue FROM z WHERE n = 1")
def join_nearest(spark, root):
    """JOIN-05: the figure of the nearest year for every article with a hinted company."""
    left = once(spark, root, "ticker_hint", "published_at").where(F.col("ticker_hint").isNotNull() & F.col("published_at").rlike(r"^\d{4}")).select("article_id", F.col("ticker_hint").alias("ticker"), F.substring("published_at", 1, 4).cast("int").alias("yr"))
    return enrich.nearest(left, enrich.wide_to_long(table(spark, root, "companies"), ["ticker"]), "ticker", "yr", "year", "revenue").select("article_id", "ticker", "yr", "year", "revenue")


_COLUMNS = ("article_id", "fetched_at", "title_hash", "published_at", "title", "description", "sapo", "body", "source", "matched_at")
_FILL = ("description", "sapo", "body", "source")


def _merge_sql(source: str, key: tuple[str, ...], order: str) -> str:
    w = f"OVER (PARTITION BY {', '.join(key)} ORDER BY {order}"
    cols = ", ".join(f"coalesce(first_value(nullif({c}, '') IGNORE NULLS) {w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), {c}) AS {c}" if c in _FILL else c for c in _COLUMNS)
    return f"SELECT * EXCLUDE (rn) FROM (SELECT {cols}, row_number() {w}) AS rn FROM {source}) WHERE rn = 1"


def _digest(without: tuple[str, ...]) -> str:
    return "md5(concat_ws(chr(31), " + ", ".join(f"coalesce({c}, chr(30))" for c in _COLUMNS if c not in without) + "))"


_ORDER = "fetched_at NULLS FIRST, " + _digest(("article_id",))
_ORDER2 = "fetched_at NULLS FIRST, " + _digest(("title_hash", "published_at"))
_TWIN = "coalesce(title_hash, '') <> '' AND coalesce(published_at, '') <> ''"


@query("dml_merge", f"WITH one AS ({_merge_sql('articles', ('article_id',), _ORDER)}), two AS ({_merge_sql('(SELECT * FROM one WHERE ' + _TWIN + ')', ('title_hash', 'published_at'), _ORDER2)}) SELECT article_id, title, coalesce(length(description), -1) AS d, coalesce(length(sapo), -1) AS s, coalesce(length(body), -1) AS b, source FROM (SELECT * FROM two UNION ALL SELECT * FROM one WHERE NOT ({_TWIN}))")
def dml_merge(spark, root):
    """DML-01, DML-02, JOIN-07: arrivals merged by id, then by title and date."""
    merged = ingest.merge_articles(table(spark, root, "articles").select(*_COLUMNS), ["fetched_at"])
    n = lambda c: F.coalesce(F.length(c), F.lit(-1)).cast("long")
    return merged.select("article_id", "title", n("description").alias("d"), n("sapo").alias("s"), n("body").alias("b"), "source")


@query("dml_fill", f"WITH {_ONCE}, m AS (SELECT article_id, max(nullif(sapo, '')) AS s2, max(nullif(body, '')) AS b2 FROM articles GROUP BY article_id), t AS (SELECT article_id, nullif(sapo, '') AS sapo, body FROM a WHERE backend <> 'brave') SELECT article_id, coalesce(nullif(sapo, ''), s2, sapo) AS sapo, md5(coalesce(nullif(body, ''), b2, body)) AS body FROM t JOIN m USING (article_id)")
def dml_fill(spark, root):
    """DML-02: empty fields filled from the other rows of the same key."""
    target = once(spark, root, "backend", "sapo", "body").where("backend <> 'brave'").select("article_id", F.nullif("sapo", F.lit("")).alias("sapo"), "body")
    return ingest.fill_missing(target, table(spark, root, "articles"), "article_id", ["sapo", "body"]).select("article_id", "sapo", F.md5(F.encode("body", "UTF-8")).alias("body"))


@query("dml_latest", "SELECT state_key, value, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY state_key ORDER BY updated_at DESC, value DESC NULLS LAST) AS n FROM export_state) WHERE n = 1")
def dml_latest(spark, root):
    """DML-05: last writer wins."""
    return ingest.latest_value(table(spark, root, "export_state"), "state_key", "value", "updated_at")


@query("join_memo", "WITH g AS (SELECT encoded_url, max(decoded_url) AS d FROM url_decode_cache WHERE status = 'ok' AND coalesce(decoded_url, '') <> '' GROUP BY 1) SELECT DISTINCT article_id, coalesce(d, url_original) AS resolved_url FROM articles LEFT JOIN g ON url_original = encoded_url")
def join_memo(spark, root):
    """JOIN-11, DML-06: links resolved by the memo table."""
    return ingest.resolve(table(spark, root, "articles"), "url_original", table(spark, root, "url_decode_cache"), "encoded_url", "decoded_url", "status").select("article_id", "resolved_url").distinct()


@query("dml_append", "SELECT task_id, backend, status FROM search_queue")
def dml_append(spark, root):
    """DML-07, DML-09, JOIN-08: an idempotent append of all tasks to those that are done."""
    q = table(spark, root, "search_queue").select("task_id", "backend", "status")
    return ingest.append_new(q.where("status = 'done'"), q.unionByName(q), ["task_id"])


@query("dml_states", f"WITH {_ONCE} SELECT article_id, CASE WHEN match_status = 'unmatched' THEN 'pending' ELSE match_status END AS match_status, CASE WHEN match_status = 'unmatched' THEN NULL ELSE cached_hits END AS cached_hits FROM a")
def dml_states(spark, root):
    """DML-03, DML-04: a new snapshot with some states reset."""
    reset = F.col("match_status") == "unmatched"
    changed = once(spark, root, "match_status", "cached_hits").where(reset).withColumns({"match_status": F.lit("pending"), "cached_hits": F.lit(None).cast("string")})
    return ingest.replace_rows(once(spark, root, "match_status", "cached_hits"), changed, ["article_id"]).select("article_id", "match_status", "cached_hits")


@query("flt_split", f"WITH {_ONCE} SELECT article_id, CASE WHEN cached_hits IS NOT NULL AND len(CAST(json(cached_hits) AS JSON[])) > 0 THEN 'skipped' WHEN body_status IN ('pending', 'ratelimited') THEN 'fetch' ELSE 'done' END AS route FROM a WHERE match_status = 'pending' OR body_status = 'pending'")
def flt_split(spark, root):
    """FLT-01, PRJ-06, SCL-41: which open articles are settled by cached hits and which need their body."""
    hits = match.cached_hits("cached_hits")
    route = F.when(F.size(hits) > 0, "skipped").when(F.col("body_status").isin("pending", "ratelimited"), "fetch").otherwise("done")
    return once(spark, root, "match_status", "body_status", "cached_hits").where("match_status = 'pending' OR body_status = 'pending'").select("article_id", route.alias("route"))


# ---- aggregates over the queue ----------------------------------------------------------------------------------
@query("agg_queue", "SELECT backend, status, count(*) AS n FROM search_queue GROUP BY 1, 2")
def agg_queue(spark, root):
    """AGG-01: tasks by backend and status."""
    return table(spark, root, "search_queue").groupBy("backend", "status").agg(F.count(F.lit(1)).alias("n"))


@query("agg_drained", "SELECT backend, NOT bool_or(status IN ('pending', 'backoff', 'in_progress')) AS drained FROM search_queue GROUP BY 1")
def agg_drained(spark, root):
    """AGG-02, STR-04: backends without open tasks."""
    return tasks.drained(table(spark, root, "search_queue"))


@query("agg_tickers", f"WITH {_ONCE} SELECT ticker FROM companies UNION SELECT ticker_hint FROM a WHERE ticker_hint IS NOT NULL ORDER BY 1")
def agg_tickers(spark, root):
    """AGG-11, SET-03, TXT-08: all tickers of two sources."""
    return table(spark, root, "companies").select("ticker").union(once(spark, root, "ticker_hint").where("ticker_hint IS NOT NULL").select("ticker_hint")).distinct().orderBy("ticker")


@query("str_split", "WITH f AS (SELECT task_id, CAST(after_date AS DATE) AS s, CAST(before_date AS DATE) AS e FROM search_queue WHERE items_found >= 90) SELECT task_id AS parent_id, CAST(g AS DATE) AS after, least(e, CAST(g AS DATE) + 6) AS before FROM f, generate_series(s::TIMESTAMP, e::TIMESTAMP, INTERVAL 7 DAY) t(g) WHERE e - s >= 7")
def str_split(spark, root):
    """STR-05: weekly children of tasks whose result was cut at the source."""
    q = table(spark, root, "search_queue").withColumns({"after": F.col("after_date").cast("date"), "before": F.col("before_date").cast("date")})
    return tasks.split_tasks(q).select("parent_id", "after", "before")


@query("str_retry", "SELECT task_id, coalesce(attempts, 0) + 1 AS attempts, CASE WHEN coalesce(attempts, 0) + 1 >= 5 THEN 'failed' ELSE 'backoff' END AS status, CASE WHEN coalesce(attempts, 0) + 1 >= 5 THEN next_attempt ELSE strftime(TIMESTAMP '2026-01-01 00:00:00' + to_seconds([300, 1800, 7200][least(coalesce(attempts, 0) + 1, 3)]), '%Y-%m-%dT%H:%M:%SZ') END AS next_attempt, left('timeout ' || task_id, 500) AS last_error FROM search_queue WHERE status = 'in_progress'")
def str_retry(spark, root):
    """STR-02: the state after a failure of all claimed tasks."""
    q = table(spark, root, "search_queue").where("status = 'in_progress'")
    failed = q.select("task_id", F.concat(F.lit("timeout "), "task_id").alias("error"))
    return tasks.after_failure(q, failed, F.lit("2026-01-01T00:00:00Z").cast("timestamp"), [300, 1800, 7200]).select("task_id", "attempts", "status", "next_attempt", "last_error")


@query("str_claim", f"WITH q AS (SELECT *, {_instant('next_attempt')} AS due FROM search_queue) SELECT task_id, status FROM q WHERE status = 'pending' OR (status = 'backoff' AND due <= TIMESTAMPTZ '2026-01-01 00:00:00+00') OR (status = 'in_progress' AND due + INTERVAL 1800 SECOND <= TIMESTAMPTZ '2026-01-01 00:00:00+00') ORDER BY due NULLS FIRST, task_id LIMIT 100")
def str_claim(spark, root):
    """STR-01, SRT-05: the next hundred tasks that may be claimed (a top list)."""
    return tasks.claimable(table(spark, root, "search_queue"), F.lit("2026-01-01T00:00:00Z").cast("timestamp")).limit(100).select("task_id", "status")


@query("str_tasks", "WITH b AS (SELECT DISTINCT backend, backend <> 'brave' AS dated FROM search_queue), t AS (SELECT DISTINCT group_key, sub_query_ix, query_text FROM search_queue WHERE kind = 'keyword'), u AS (SELECT group_key, query_text, min(sub_query_ix) AS ix FROM t GROUP BY 1, 2), m AS (SELECT greatest(DATE '2025-01-15', CAST(g AS DATE)) AS after, least(DATE '2025-04-10', CAST(last_day(CAST(g AS DATE)) AS DATE)) AS before FROM generate_series(TIMESTAMP '2025-01-01', TIMESTAMP '2025-04-01', INTERVAL 1 MONTH) x(g)), d AS (SELECT true AS dated, after, before FROM m UNION ALL SELECT false, DATE '2025-01-15', DATE '2025-04-10') SELECT backend, group_key, ix AS sub_query_ix, query_text, after AS after_date, before AS before_date FROM b JOIN d USING (dated), u")
def str_tasks(spark, root):
    """STR-06, JOIN-09, AGG-08: the grid of tasks for all keywords."""
    q = table(spark, root, "search_queue")
    backends = q.select("backend", (F.col("backend") != "brave").alias("dated")).distinct()
    terms = q.where("kind = 'keyword'").groupBy("group_key", F.col("query_text").alias("term")).agg(F.min("sub_query_ix").alias("ix"))
    grid = tasks.keyword_tasks(backends, terms, F.lit("2025-01-15").cast("date"), F.lit("2025-04-10").cast("date"))
    return grid.select("backend", "group_key", "sub_query_ix", "query_text", "after_date", "before_date")


# ---- matching and classification --------------------------------------------------------------------------------
_INDEX = "ix AS (SELECT upper(ticker) AS ticker, lower(trim(alias)) AS low, max(CASE WHEN alias_kind IN ('names', 'subsidiaries', 'projects') THEN 1.0 ELSE 0.3 END) AS weight FROM company_aliases WHERE ticker IS NOT NULL AND length(trim(alias)) >= 2 GROUP BY 1, 2)"
_FIELDS = f"f AS (SELECT article_id, unnest([0, 1, 2, 3]) AS no, unnest([title, description, sapo, {_EDITORIAL}]) AS t FROM a)"
_HITS = f"{_ONCE}, {_INDEX}, {_FIELDS}, g AS (SELECT article_id, no, lower(t) AS t FROM f WHERE coalesce(t, '') <> ''), p AS (SELECT article_id, ticker, no FROM g JOIN ix ON contains(t, low) WHERE weight >= 1 AND NOT (no = 3 AND low = lower(ticker)) AND regexp_matches(t, '(^|[^\\p{{L}}\\p{{N}}_])' || regexp_escape(low) || '($|[^\\p{{L}}\\p{{N}}_])')), h AS (SELECT article_id, ticker, min(no) AS no FROM p GROUP BY 1, 2), hits AS (SELECT article_id, ticker, ['title', 'description', 'sapo', 'body'][no + 1] AS location FROM h)"


def _hits(spark, root) -> DataFrame:
    return match.alias_hits(once(spark, root, "title", "description", "sapo", "body"), match.alias_index(table(spark, root, "company_aliases")))


@query("txt_hits", f"WITH {_HITS} SELECT * FROM hits")
def txt_hits(spark, root):
    """TXT-00 to TXT-03, JOIN-03, WIN-01: each company's first hit in each article."""
    return _hits(spark, root).select("article_id", "ticker", "location")


@query("txt_gate", f"WITH {_HITS}, n AS (SELECT article_id, count(*) AS n FROM hits GROUP BY 1) SELECT article_id, ticker, location FROM hits JOIN n USING (article_id) WHERE n < 3 OR location = 'title'")
def txt_gate(spark, root):
    """FLT-04: articles that name many companies keep only those of the title."""
    return match.roundup_gate(_hits(spark, root)).select("article_id", "ticker", "location")


def _count_sql(terms, where: str, tag: str) -> str:
    return " + ".join(f"CASE WHEN contains({where}, '{t}') THEN 1 ELSE 0 END" for t, g in terms if g == tag) or "0"


_V = classify.DEFAULT
_STRIPPED = r"lower(CASE WHEN suf <> '' AND p <> '' AND q <> '' AND (contains(q, p) OR contains(p, q)) THEN left(title, length(title) - length(suf)) ELSE title END)"
_SCOPES = f"{_ONCE}, s1 AS (SELECT *, regexp_extract(title, '(\\s+[-–|]\\s+[^-–|]{{2,60}}\\s*)$', 1) AS suf FROM a), s2 AS (SELECT *, replace(lower(regexp_replace(suf, '^[\\s\\-–|]+|[\\s\\-–|]+$', '', 'g')), ' ', '') AS p, replace(lower(trim(coalesce(source, ''))), ' ', '') AS q FROM s1), s3 AS (SELECT article_id, {_STRIPPED} AS tc, lower(coalesce(sapo, '')) AS sp, lower(coalesce({_EDITORIAL}, '')) AS bd FROM s2), s AS (SELECT article_id, tc, tc || ' ' || sp AS ts, tc || ' ' || sp || ' ' || bd AS x FROM s3)"
_C1 = ", ".join(f"{_count_sql(_V.general, 'x', g)} AS {g.lower()}1, {_count_sql(_V.strong, 'ts', g)} + {_count_sql(_V.title, 'tc', g)} + {_count_sql(_V.quality, 'ts', g)} AS {g.lower()}2" for g in "ESG")


@query(
    "txt_category",
    f"WITH {_SCOPES}, c AS (SELECT article_id, x, {_C1} FROM s), d AS (SELECT article_id, x, CASE WHEN e1 + s1 + g1 = 0 THEN e2 ELSE e1 END AS e, CASE WHEN e1 + s1 + g1 = 0 THEN s2 ELSE s1 END AS s, CASE WHEN e1 + s1 + g1 = 0 THEN g2 ELSE g1 END AS g, regexp_extract(x, '(\\d+[.,]?\\d*)\\s*(tỷ|triệu)', 1) AS m, regexp_extract(x, '(\\d+[.,]?\\d*)\\s*(tỷ|triệu)', 2) AS un FROM c) "
    "SELECT article_id, CASE WHEN e > g AND e > s THEN 'E' WHEN s > e AND s > g THEN 'S' WHEN e > 0 THEN 'E' WHEN s > 0 THEN 'S' ELSE 'G' END AS category, "
    f"CASE WHEN regexp_matches(x, '{'|'.join(_V.high)}') OR un = 'tỷ' OR (un = 'triệu' AND TRY_CAST(replace(m, ',', '.') AS DOUBLE) >= 500) THEN 'high' ELSE 'medium' END AS severity FROM d",
)
def txt_category(spark, root):
    """TXT-05, AGG-09, SCL-38: category and severity of every article."""
    s = classify.scopes(once(spark, root, "title", "sapo", "body", "source"))
    return s.select("article_id", classify.category(F.col("_text"), F.col("_title"), F.col("_lead"), _V).alias("category"), classify.severity(F.col("_text"), _V.high).alias("severity"))


# ---- events -----------------------------------------------------------------------------------------------------
_ATTRIBUTED = f"{_ONCE}, j AS (SELECT DISTINCT article_id, title, published_at, upper(x->>'ticker') AS ticker FROM (SELECT article_id, title, published_at, unnest(CAST(json(cached_hits) AS JSON[])) AS x FROM a WHERE cached_hits IS NOT NULL))"
_ROWS = f"{_ATTRIBUTED}, r AS (SELECT ticker, article_id, {_DAY} AS day, {_tokens('title')} AS tk FROM j)"
_DF = f"{_ROWS}, n AS (SELECT ticker, count(*) AS n FROM r GROUP BY 1), df AS (SELECT ticker, token, count(*) AS df FROM (SELECT ticker, unnest(tk) AS token FROM r) GROUP BY 1, 2)"
_JACCARD = "len(list_intersect(x.tk, y.tk)) / (len(x.tk) + len(y.tk) - len(list_intersect(x.tk, y.tk)))"
_EVENTS = f"{_DF}, rare AS (SELECT ticker, list(token) AS rare FROM df JOIN n USING (ticker) WHERE length(token) >= 4 AND token <> lower(ticker) AND df >= 2 AND df / n <= 0.7 GROUP BY 1), e AS (SELECT x.ticker, x.article_id AS a, y.article_id AS b FROM r x JOIN r y ON x.ticker = y.ticker AND x.article_id <> y.article_id LEFT JOIN rare ON rare.ticker = x.ticker WHERE len(list_intersect(x.tk, y.tk)) > 0 AND ((x.day IS NULL AND y.day IS NULL) OR abs(x.day - y.day) <= 10) AND ({_JACCARD} >= 0.45 OR len(list_intersect(list_intersect(x.tk, y.tk), coalesce(rare, []))) > 0)), cc(ticker, id, root) AS (SELECT ticker, article_id, article_id FROM r UNION SELECT cc.ticker, e.b, cc.root FROM cc JOIN e ON e.ticker = cc.ticker AND e.a = cc.id), comp AS (SELECT ticker, id, min(root) AS comp FROM cc GROUP BY 1, 2), m AS (SELECT r.ticker, r.article_id, comp, row_number() OVER w AS position, first_value(r.article_id) OVER w AS rep, count(*) OVER (PARTITION BY r.ticker, comp) AS members FROM r JOIN comp ON r.ticker = comp.ticker AND r.article_id = comp.id WINDOW w AS (PARTITION BY r.ticker, comp ORDER BY day NULLS LAST, r.article_id)), events AS (SELECT ticker, article_id, ticker || ':' || rep AS event_key, position, members FROM m)"


def _attributed(spark, root) -> DataFrame:
    rows = once(spark, root, "cached_hits", "title", "published_at").withColumn("hit", F.explode(match.cached_hits("cached_hits")))
    return rows.select("article_id", "title", "published_at", F.upper("hit.ticker").alias("ticker")).distinct()


_written: dict[tuple, str] = {}


def _clustered(spark, root) -> DataFrame:
    """The clustered titles, written once for each state of the article table and session, as all views of events start from them."""
    articles = table(spark, root, "articles")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/articles.parquet")
    status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
    mark = (spark.sparkContext.applicationId, root, status.getModificationTime(), len(articles.inputFiles()))
    there = mark in _written and path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(_written[mark]))
    if not there:
        at = scratch(spark, "clustered")
        cluster.clustered(cut(cluster.prepared(_attributed(spark, root)))).write.parquet(at)
        _written[mark] = at
    return spark.read.parquet(_written[mark])


@query("clu_events", f"WITH RECURSIVE {_EVENTS} SELECT * FROM events")
def clu_events(spark, root):
    """CLU-01, CLU-05, SCL-22, WIN-03, JOIN-04, STR-12: articles with their event."""
    return _clustered(spark, root).drop("tokens")


@query("agg_token_df", f"WITH {_DF} SELECT ticker, token, df, n FROM df JOIN n USING (ticker)")
def agg_token_df(spark, root):
    """AGG-05: tokens by company and number of titles."""
    return cluster.document_frequency(cluster.prepared(_attributed(spark, root)))


def _view(spark, root) -> DataFrame:
    events = _clustered(spark, root).drop("tokens")
    arts = once(spark, root, "title", "summary_en", "esg_type", "severity", "sentiment", "controversy_level", "controversy_classified_at", "published_at", "source", "enrich_status").select("article_id", "title", "summary_en", "esg_type", "severity", "sentiment", "controversy_level", "controversy_classified_at", F.substring("published_at", 1, 10).alias("date"), "source", "enrich_status")
    rows = events.join(arts, "article_id", "left")
    risk = F.when((F.col("sentiment") == "risk") & (F.col("enrich_status") == "done"), F.struct("position", "title", "summary_en", "esg_type", "severity", "controversy_level", "controversy_classified_at"))
    day = F.coalesce("date", F.lit(""))
    by = rows.groupBy("ticker", "event_key").agg(F.min(risk).alias("x"), F.min_by(day, "position").alias("date"), F.count(F.lit(1)).alias("sources_count"), F.concat_ws(",", F.sort_array(F.collect_list("article_id"))).alias("sources")).where("x IS NOT NULL")
    names = table(spark, root, "companies").select("ticker", F.col("company_name").alias("company"))
    named = by.join(names, "ticker", "left").withColumn("company", F.coalesce("company", F.lit("")))
    return named.select(F.col("event_key").alias("id"), "ticker", "company", "date", F.col("x.title").alias("headline"), F.col("x.summary_en").alias("headline_en"), "x.esg_type", "x.severity", "x.controversy_level", F.coalesce("x.controversy_classified_at", F.lit("")).alias("created_at"), "sources_count", "sources")


_VIEW = f"{_EVENTS}, ev AS (SELECT events.*, a.* EXCLUDE (article_id) FROM events LEFT JOIN a USING (article_id)), best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_key ORDER BY position) AS k FROM ev WHERE sentiment = 'risk' AND enrich_status = 'done') WHERE k = 1), al AS (SELECT event_key, coalesce(left(arg_min(coalesce(published_at, ''), position), 10), '') AS date, count(*) AS sources_count, string_agg(article_id, ',' ORDER BY article_id) AS sources FROM ev GROUP BY 1), v AS (SELECT event_key AS id, best.ticker, coalesce(company_name, '') AS company, al.date, title AS headline, summary_en AS headline_en, esg_type, severity, controversy_level, coalesce(controversy_classified_at, '') AS created_at, al.sources_count, sources FROM best JOIN al USING (event_key) LEFT JOIN companies ON companies.ticker = best.ticker)"


@query("clu_view", f"WITH RECURSIVE {_VIEW} SELECT * FROM v")
def clu_view(spark, root):
    """CLU-04, FLT-06, AGG-06, JOIN-01, JOIN-02, SRT-04: the view of risk events."""
    return _view(spark, root)


_ENGLISH = "coalesce(headline_en, '')"
_SEARCH = EventQuery(search="PHẠT", sort="ticker_asc")


@query("evt_search", f"WITH RECURSIVE {_VIEW} SELECT id, ticker, date FROM v WHERE contains({_fold('headline')}, 'phat') OR contains({_fold(_ENGLISH)}, 'phat') ORDER BY ticker, date DESC, nullif(created_at, '') DESC NULLS LAST, id LIMIT 50")
def evt_search(spark, root):
    """FLT-07, SRT-02, SRT-03: the first page of a search that ignores case and accents."""
    return _SEARCH.top(_view(spark, root)).select("id", "ticker", "date")


@query("evt_page", f"WITH RECURSIVE {_VIEW}, o AS (SELECT id, ticker, date, row_number() OVER (ORDER BY date DESC, nullif(created_at, '') DESC NULLS LAST, ticker, id) AS rn, count(*) OVER () AS total FROM v WHERE esg_type = 'G') SELECT id, ticker, date FROM o WHERE ceil(rn / 10.0) = least(2, greatest(1, ceil(total / 10.0)))")
def evt_page(spark, root):
    """SRT-03: the second page of ten, or the last one there is."""
    return EventQuery(pillar="G", page=2, size=10).rows(cut(_view(spark, root))).select("id", "ticker", "date")


@query("evt_stats", f"WITH RECURSIVE {_VIEW} SELECT count(*) AS total, count(*) FILTER (WHERE esg_type = 'E') AS e, count(*) FILTER (WHERE esg_type = 'S') AS s, count(*) FILTER (WHERE esg_type = 'G') AS g, count(*) FILTER (WHERE severity = 'high') AS high, count(*) FILTER (WHERE controversy_level = 'Major') AS major, count(DISTINCT ticker) AS tickers FROM v")
def evt_stats(spark, root):
    """AGG-03: counts over all events."""
    return EventQuery().stats(_view(spark, root))


@query("evt_labels", f"WITH {_ONCE} SELECT article_id, CASE WHEN trim(coalesce(summary_en, '')) = '' THEN title ELSE summary_en END AS shown, trim(coalesce(summary_en, '')) = '' AS fallback, CASE severity WHEN 'high' THEN 'High' WHEN 'medium' THEN 'Medium' ELSE '—' END AS severity_label FROM a")
def evt_labels(spark, root):
    """PRJ-03, PRJ-04: headlines and labels for readers of English."""
    h = headline("title", "summary_en", "en")
    return once(spark, root, "title", "summary_en", "severity").select("article_id", h["text"].alias("shown"), h["fallback"].alias("fallback"), label("severity", {"high": "High", "medium": "Medium"}).alias("severity_label"))


_JUDGED = f"{_EVENTS}, dist AS (SELECT ticker, list(token) AS ds FROM df JOIN n USING (ticker) WHERE length(token) >= 5 AND df >= 2 AND df <= greatest(2.0, n * 0.1) GROUP BY 1), jd AS (SELECT article_id, sentiment, controversy_level FROM a WHERE enrich_status = 'done' AND sentiment IS NOT NULL), em AS (SELECT events.*, r.tk, coalesce(ds, []) AS ds, jd.sentiment, jd.controversy_level FROM events JOIN r USING (ticker, article_id) LEFT JOIN dist USING (ticker) LEFT JOIN jd ON jd.article_id = events.article_id), src AS (SELECT event_key, arg_min(article_id, position) AS source_id, arg_min(sentiment, position) AS sentiment, arg_min(controversy_level, position) FILTER (WHERE controversy_level IS NOT NULL) AS level FROM em WHERE sentiment IS NOT NULL GROUP BY 1), taken AS (SELECT x.article_id, x.ticker, source_id, src.sentiment, src.level AS controversy_level FROM em x JOIN src USING (event_key) WHERE x.sentiment IS NULL AND EXISTS (SELECT 1 FROM em y WHERE y.event_key = x.event_key AND y.sentiment IS NOT NULL AND ((len(x.tk) + len(y.tk) > 0 AND {_JACCARD} >= 0.45) OR len(list_intersect(list_intersect(x.tk, y.tk), x.ds)) > 0)))"


def _members(spark, root) -> DataFrame:
    rows = _clustered(spark, root)
    return rows.join(cluster.distinctive_tokens(cluster.document_frequency(rows.select("ticker", "tokens"))), "ticker", "left")


@query("clu_inherit", f"WITH RECURSIVE {_JUDGED} SELECT * FROM taken")
def clu_inherit(spark, root):
    """CLU-02, CLU-03, WIN-04, WIN-07: verdicts that pass to other reports of the same event."""
    judged = once(spark, root, "enrich_status", "sentiment", "controversy_level").where("enrich_status = 'done' AND sentiment IS NOT NULL").select("article_id", "sentiment", "controversy_level")
    return cluster.inherit(_members(spark, root), judged, ("sentiment", "controversy_level"))


@query("clu_same", f"WITH {_DF}, dist AS (SELECT ticker, list(token) AS ds FROM df JOIN n USING (ticker) WHERE length(token) >= 5 AND df >= 2 AND df <= greatest(2.0, n * 0.1) GROUP BY 1), x AS (SELECT ticker, article_id, tk, lag(article_id) OVER w AS other, lag(tk) OVER w AS pv FROM r WINDOW w AS (PARTITION BY ticker ORDER BY article_id)) SELECT ticker, article_id, other FROM x LEFT JOIN dist USING (ticker) WHERE pv IS NOT NULL AND (len(list_intersect(list_intersect(tk, pv), coalesce(ds, []))) > 0 OR CASE WHEN len(tk) + len(pv) = 0 THEN 0 ELSE len(list_intersect(tk, pv)) / (len(tk) + len(pv) - len(list_intersect(tk, pv))) END >= 0.45)")
def clu_same(spark, root):
    """CLU-02: titles that tell of the same event as the company's one before."""
    rows = cluster.prepared(_attributed(spark, root))
    w = Window.partitionBy("ticker").orderBy("article_id")
    x = rows.select("ticker", "article_id", "tokens", F.lag("article_id").over(w).alias("other"), F.lag("tokens").over(w).alias("before")).where("before IS NOT NULL")
    x = x.join(cluster.distinctive_tokens(cluster.document_frequency(rows)), "ticker", "left")
    return x.where(cluster.same_event(F.col("tokens"), F.col("before"), F.coalesce("distinctive", F.array().cast("array<string>")))).select("ticker", "article_id", "other")


# ---- enrichment with deterministic scorers ----------------------------------------------------------------------
def _toy_sentiment(batch: list[str]) -> list[str] | None:
    return ["not_risk" if "báo lãi" in t.lower() else "risk" for t in batch]


@query("udf_negative", f"WITH {_ONCE} SELECT article_id FROM a WHERE NOT contains(lower(title), 'báo lãi')")
def udf_negative(spark, root):
    """UDF-04, SCL-45: the filter by an injected scorer, in batches of five."""
    return enrich.keep_negative(once(spark, root, "title").select("article_id", "title"), "title", _toy_sentiment).select("article_id")


@query("udf_validated", f"WITH {_ONCE} SELECT article_id, CASE WHEN controversy_level IN ('Major', 'Minor', 'No') AND trim(coalesce(controversy_justification, '')) <> '' THEN controversy_level END AS level, CASE WHEN controversy_level IN ('Major', 'Minor', 'No') AND trim(coalesce(controversy_justification, '')) <> '' THEN 100 END AS confidence FROM a")
def udf_validated(spark, root):
    """UDF-06, SCL-39, SCL-44: replies of a model, checked."""
    reply = F.to_json(F.struct(F.col("controversy_level").alias("level"), F.col("controversy_justification").alias("justification"), F.lit("G").alias("category"), F.lit("2").alias("indicator"), F.lit("250").alias("confidence")))
    v = enrich.validated(reply)
    return once(spark, root, "controversy_level", "controversy_justification").select("article_id", v["level"].alias("level"), v["confidence"].alias("confidence"))


# ---- exports and streams ----------------------------------------------------------------------------------------
@query("snk_delta", f"SELECT DISTINCT article_id FROM articles WHERE {_instant('fetched_at')} >= TIMESTAMPTZ '2026-01-01 00:00:00+00' OR {_instant('matched_at')} >= TIMESTAMPTZ '2026-01-01 00:00:00+00'")
def snk_delta(spark, root):
    """SNK-01, STR-07: the delta since a high-water mark."""
    return sinks.delta(table(spark, root, "articles"), "2026-01-01T00:00:00Z").select("article_id").distinct()


@query("snk_documents", f"WITH {_HITS} SELECT ticker, count(*) AS articles, string_agg(article_id, ',' ORDER BY coalesce(published_at, '') DESC, article_id DESC) AS ids FROM hits JOIN a USING (article_id) GROUP BY 1")
def snk_documents(spark, root):
    """SNK-02, SNK-05: one document for each company, newest article first."""
    rows = _hits(spark, root).select("ticker", "article_id").join(once(spark, root, "published_at").select("article_id", "published_at"), "article_id").select("ticker", "article_id", "published_at")
    docs = sinks.company_documents(rows)
    return docs.select("ticker", F.size("articles").cast("long").alias("articles"), F.array_join(F.transform("articles", lambda x: x["article_id"]), ",").alias("ids"))


@query("str_windows", "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2, time_bucket(INTERVAL 1 HOUR, ts) HAVING time_bucket(INTERVAL 1 HOUR, min(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events)")
def str_windows(spark, root):
    """Event-time windows as a stream: counts by hour and type of every hour that is over."""
    stream = streaming.stream_of(spark, f"{root}/events.parquet", None).withColumn("ts", F.col("ts").cast("timestamp"))
    w = streaming.windowed_counts(stream, "ts", "1 hour", "0 seconds", ["event_type"])
    return streaming.drain(w, "append").select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


@query("str_first", "SELECT DISTINCT article_id FROM articles")
def str_first(spark, root):
    """STR-08: a stream of arrivals, each key once, one file a batch."""
    stream = streaming.stream_of(spark, f"{root}/articles.parquet", 1).select("article_id", dates.instant("fetched_at").alias("at"))
    return streaming.first_arrivals(stream, ["article_id"], "at", scratch(spark, "first")).select("article_id")


# ---- profiles, labels, sets, ages -------------------------------------------------------------------------------
_LEGAL = "|".join(sorted(profile.LEGAL_PREFIXES, key=len, reverse=True))


@query("scl_names", rf"SELECT ticker, trim(regexp_replace(trim(company_name), '(?i)^(?:{_LEGAL})\s+', '')) AS bare, trim(CASE WHEN contains(company_name, ' - ') THEN string_split(company_name, ' - ')[-1] END) AS short FROM companies")
def scl_names(spark, root):
    """SCL-27, SCL-28: company names without legal form and their short part."""
    return table(spark, root, "companies").select("ticker", profile.without_legal_form("company_name").alias("bare"), profile.headline_parts("company_name")["short"].alias("short"))


@query("scl_subsidiaries", "SELECT ticker, short_name || ' Một' AS name, 75.5 AS share FROM companies")
def scl_subsidiaries(spark, root):
    """SCL-25, FLT-09: subsidiaries held by more than half, read from a page's text."""
    page = F.concat(F.lit("Tên | Vốn | Tỷ lệ\n"), "short_name", F.lit(" Một | 85,000 ( Tr. VND ) | 75,5 %\n"), F.upper(F.concat("short_name", F.lit(" Một"))), F.lit(" | 1,000 | 60 %\n"), "short_name", F.lit(" Hai | 9,000 | 50 %\n"))
    x = table(spark, root, "companies").select("ticker", F.explode(profile.subsidiaries(page)).alias("x"))
    return x.select("ticker", F.col("x.name").alias("name"), F.col("x.share").cast("decimal(3,1)").alias("share"))


@query("scl_labels", f"WITH {_ONCE} SELECT article_id, CASE WHEN sentiment = 'risk' THEN 'risk' WHEN sentiment = 'not_risk' THEN 'not_risk' ELSE 'risk' END AS label FROM a WHERE sentiment IS NOT NULL")
def scl_labels(spark, root):
    """SCL-42, SCL-43: labels out of a model's JSON reply."""
    reply = F.to_json(F.struct(F.array("sentiment").alias("labels")))
    rows = once(spark, root, "sentiment").where("sentiment IS NOT NULL")
    return rows.select("article_id", F.element_at(text.labels(reply, F.lit(1), ("risk", "not_risk"), "risk"), 1).alias("label"))


@query("set_titles", f"WITH {_ATTRIBUTED}, k AS (SELECT ticker, article_id, list_sort({_tokens('title')}) AS tk FROM j), p AS (SELECT ticker, article_id, tk, lag(tk) OVER (PARTITION BY ticker ORDER BY article_id) AS pv FROM k) SELECT ticker, article_id, round(CASE WHEN len(tk) = 0 OR len(pv) = 0 THEN 0.0 ELSE len(list_intersect(tk, pv)) / (len(tk) + len(pv) - len(list_intersect(tk, pv))) END, 9) AS alike, CAST(len(tk) - len(list_intersect(tk, pv)) AS BIGINT) AS own FROM p WHERE pv IS NOT NULL")
def set_titles(spark, root):
    """SET-01, SET-02: likeness of each title to the company's one before, and the words only it has."""
    w = Window.partitionBy("ticker").orderBy("article_id")
    k = _attributed(spark, root).select("ticker", "article_id", text.title_tokens("title").alias("tk")).withColumn("pv", F.lag("tk").over(w)).where("pv IS NOT NULL")
    return k.select("ticker", "article_id", F.round(text.jaccard(F.col("tk"), F.col("pv")), 9).alias("alike"), F.size(F.array_except("tk", "pv")).cast("long").alias("own"))


@query("scl_ages", "SELECT DISTINCT items_found, (DATE '2026-01-31' - CAST(items_found * CASE backend WHEN 'google_rss' THEN 1 WHEN 'baomoi' THEN 7 ELSE 30 END AS INTEGER)) AS day, backend, strftime(make_timestamp(CAST(items_found AS BIGINT) * 86400000000), '%Y-%m-%d') AS epoch_day FROM search_queue WHERE items_found IS NOT NULL")
def scl_ages(spark, root):
    """SCL-34, SCL-35: dates from ages such as "3 weeks ago" and from seconds since the epoch."""
    unit = F.when(F.col("backend") == "google_rss", "day").when(F.col("backend") == "baomoi", "week").otherwise("month")
    q = table(spark, root, "search_queue").where("items_found IS NOT NULL").select("items_found", "backend").distinct()
    age = F.concat(F.col("items_found").cast("string"), F.lit(" "), unit, F.lit("s ago"))
    seconds = F.timestamp_seconds(F.col("items_found").cast("long") * 86400)
    return q.select("items_found", dates.relative_age(age, F.lit("2026-01-31").cast("date")).alias("day"), "backend", F.date_format(F.to_utc_timestamp(seconds, F.current_timezone()), "yyyy-MM-dd").alias("epoch_day"))


@query("scl_feed", "SELECT DISTINCT task_id, strftime(CAST(after_date AS DATE), '%Y-%m-%d') AS day FROM search_queue WHERE after_date IS NOT NULL")
def scl_feed(spark, root):
    """SRC-03, SCL-34: mail-style dates of a feed."""
    q = table(spark, root, "search_queue").where("after_date IS NOT NULL").select("task_id", F.col("after_date").cast("date").alias("d"))
    mail = F.concat(F.date_format("d", "E"), F.lit(", "), F.date_format("d", "dd MMM yyyy"), F.lit(" 10:11:12 GMT"))
    return q.select("task_id", dates.rfc822_date(mail).alias("day"))


@query("scl_stale", f"SELECT task_id, coalesce(TIMESTAMPTZ '2026-01-01 00:00:00+00' > {_instant('done_at')} + INTERVAL 86400 SECOND, true) AS stale FROM search_queue")
def scl_stale(spark, root):
    """SCL-37: whether a claim has lapsed; an unreadable start has."""
    return table(spark, root, "search_queue").select("task_id", dates.is_stale("done_at", F.lit(86400), F.lit("2026-01-01T00:00:00Z").cast("timestamp")).alias("stale"))


@query("scl_figures", f"SELECT ticker, year, format('{{:,}}', CAST(round(revenue) AS BIGINT)) || ' billion VND' AS shown FROM ({_NUMBERS}) WHERE revenue IS NOT NULL")
def scl_figures(spark, root):
    """SCL-40: figures with thousands commas."""
    rows = enrich.wide_to_long(table(spark, root, "companies"), ["ticker"])
    return rows.select("ticker", "year", F.concat(text.thousands(F.round("revenue")), F.lit(" billion VND")).alias("shown"))


# ---- the star schema: plain analytics on the engine's tables ----------------------------------------------------
@query("tpch_q1", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY 1, 2")
def tpch_q1(spark, root):
    """AGG: pricing summary."""
    rows = table(spark, root, "lineitem").where("l_shipdate <= DATE '1998-09-02'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


# ---- the rest of the inventory ----------------------------------------------------------------------------------
@query("flt_enrich", f"WITH {_ONCE} SELECT article_id, published_at FROM a WHERE match_status = 'matched' AND esg_status = 'esg' AND enrich_status = 'pending' ORDER BY published_at DESC, article_id LIMIT 25")
def flt_enrich(spark, root):
    """FLT-02: the next articles to enrich, newest first (a top list)."""
    return once(spark, root, "match_status", "esg_status", "enrich_status", "published_at").where("match_status = 'matched' AND esg_status = 'esg' AND enrich_status = 'pending'").select("article_id", "published_at").orderBy(F.desc("published_at"), "article_id").limit(25)


@query("flt_members", f"WITH {_ONCE} SELECT article_id, ticker_hint AS ticker FROM a WHERE ticker_hint IN (SELECT ticker FROM companies WHERE sector = (SELECT min(sector) FROM companies))")
def flt_members(spark, root):
    """FLT-08, FLT-10: articles of the companies in a set."""
    firms = table(spark, root, "companies")
    first = firms.agg(F.min("sector").alias("sector"))
    chosen = firms.join(first, "sector", "left_semi").select("ticker")
    return files.by_keys(once(spark, root, "ticker_hint").select("article_id", F.col("ticker_hint").alias("ticker")), chosen, "ticker")


@query("agg_oldest", f"SELECT backend, strftime(min({_instant('fetched_at')}) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS oldest FROM articles GROUP BY 1")
def agg_oldest(spark, root):
    """AGG-10: the oldest known time by backend, unreadable ones aside."""
    oldest = F.min(dates.instant("fetched_at"))
    return table(spark, root, "articles").groupBy("backend").agg(oldest.alias("t")).select("backend", F.date_format(F.to_utc_timestamp("t", F.current_timezone()), "yyyy-MM-dd HH:mm:ss").alias("oldest"))


@query("win_aliases", "WITH x AS (SELECT ticker, alias, row_number() OVER (PARTITION BY ticker ORDER BY alias_kind, alias) AS pos FROM company_aliases), y AS (SELECT *, row_number() OVER (PARTITION BY ticker, lower(alias) ORDER BY pos) AS n FROM x) SELECT ticker, alias, CAST(row_number() OVER (PARTITION BY ticker ORDER BY pos) - 1 AS INTEGER) AS ix FROM y WHERE n = 1")
def win_aliases(spark, root):
    """WIN-05, WIN-06, SRC-18: a company's aliases, the first spelling of each, with their place."""
    by = Window.partitionBy("ticker")
    x = table(spark, root, "company_aliases").withColumn("pos", F.row_number().over(by.orderBy("alias_kind", "alias")))
    y = x.withColumn("n", F.row_number().over(Window.partitionBy("ticker", F.lower("alias")).orderBy("pos"))).where("n = 1")
    return y.select("ticker", "alias", (F.row_number().over(by.orderBy("pos")) - 1).alias("ix"))


@query("srt_latest", "SELECT backend, max(task_id) AS latest FROM search_queue WHERE status = 'done' GROUP BY 1")
def srt_latest(spark, root):
    """SRT-06: the latest by name."""
    return table(spark, root, "search_queue").where("status = 'done'").groupBy("backend").agg(F.max("task_id").alias("latest"))


_FOR_PAGE = r"replace(regexp_replace(body, '[<>&]', ' ', 'g'), chr(10), ' ')"


@query("scl_main", f"WITH {_ONCE}, b AS (SELECT article_id, trim(regexp_replace({_FOR_PAGE}, '\\s+', ' ', 'g')) AS t FROM a WHERE body IS NOT NULL) SELECT article_id, CASE WHEN length(t) >= 200 THEN length(t) END AS chars FROM b")
def scl_main(spark, root):
    """SCL-18: the main text of pages made of menus, a body and a footer."""
    plain = F.trim(F.regexp_replace(F.replace(F.regexp_replace("body", "[<>&]", " "), F.lit("\n"), F.lit(" ")), r"\s+", " "))
    page = F.concat(F.lit("<html><nav><a href=x>Menu</a></nav><article><p>"), plain, F.lit("</p><table><tr><td>1</td></tr></table></article><footer>Footer of the page</footer></html>"))
    return once(spark, root, "body").where("body IS NOT NULL").select("article_id", F.length(html.extract_main(page)).cast("long").alias("chars"))


@query("scl_bounded", f"WITH {_ONCE} SELECT article_id, regexp_matches(lower(title), '(^|[^\\p{{L}}\\p{{N}}_])(bị phạt|sạt taluy|bùn)($|[^\\p{{L}}\\p{{N}}_])') AS named FROM a")
def scl_bounded(spark, root):
    """SCL-21: whether a title holds one of some terms as words."""
    return once(spark, root, "title").select("article_id", F.col("title").rlike(text.bounded(["bị phạt", "sạt taluy", "bùn"])).alias("named"))


@query("scl_task_ids", "SELECT DISTINCT task_id, CASE WHEN kind = 'alias' THEN concat_ws(':', backend, 'alias', ticker, sub_query_ix, after_date, before_date) ELSE concat_ws(':', backend, group_key, sub_query_ix, after_date) END AS made FROM search_queue")
def scl_task_ids(spark, root):
    """SCL-24: identifiers of tasks; those of aliases hold the end of their time."""
    key = F.when(F.col("kind") == "alias", F.concat_ws(":", "backend", F.lit("alias"), "ticker", "sub_query_ix", "after_date", "before_date")).otherwise(F.concat_ws(":", "backend", "group_key", "sub_query_ix", "after_date"))
    return table(spark, root, "search_queue").select("task_id", key.alias("made")).distinct()


@query("scl_brands", "SELECT ticker, w AS word FROM (SELECT DISTINCT ticker, unnest(string_split(company_name, ' ')) AS w FROM companies) WHERE regexp_full_match(w, '[A-Z][A-Za-z]{3,19}') AND len(regexp_extract_all(lower(w), '[aeiouy]+')) >= 2 AND w NOT IN (" + ", ".join(f"'{w}'" for w in profile.NO_BRANDS) + ")")
def scl_brands(spark, root):
    """SCL-26: brands inside company names."""
    w = table(spark, root, "companies").select("ticker", F.explode(F.split("company_name", " ")).alias("word")).distinct()
    return w.where(profile.is_brand(F.col("word")))


_PLACES = ("Vân Lũng", "Trà Khuê", "Mường Lăng")


@query("scl_places", f"WITH {_ONCE} SELECT article_id, array_to_string(list_filter(['Vân Lũng', 'Trà Khuê', 'Mường Lăng'], lambda p: contains(lower(coalesce(sapo, '')), lower(p))), ', ') AS places FROM a")
def scl_places(spark, root):
    """SCL-29: the places a text names, in the order of a list."""
    return once(spark, root, "sapo").select("article_id", F.array_join(profile.locations("sapo", list(_PLACES)), ", ").alias("places"))


@query("scl_window", f"SELECT DISTINCT fetched_at, CAST(CAST({_instant('fetched_at')} AT TIME ZONE 'UTC' + INTERVAL 7 HOUR AS DATE) - 5 AS DATE) AS after, CAST(CAST({_instant('fetched_at')} AT TIME ZONE 'UTC' + INTERVAL 7 HOUR AS DATE) - 1 AS DATE) AS before FROM articles")
def scl_window(spark, root):
    """SCL-33: the five days before an instant, as days of another zone."""
    utc = F.to_utc_timestamp(dates.instant("fetched_at"), F.current_timezone())
    w = dates.daily_window(utc, "Asia/Ho_Chi_Minh", 5)
    return table(spark, root, "articles").select("fetched_at", w["after"].alias("after"), w["before"].alias("before")).distinct()


@query("str_done", "SELECT task_id, CASE WHEN status = 'in_progress' THEN 'done' ELSE status END AS status, CASE WHEN status = 'in_progress' THEN length(query_text) ELSE items_found END AS items_found FROM search_queue")
def str_done(spark, root):
    """STR-03: tasks marked as done with what they found."""
    q = table(spark, root, "search_queue").select("task_id", "status", F.col("items_found").cast("long").alias("items_found"), "query_text")
    done = q.where("status = 'in_progress'").withColumns({"status": F.lit("done"), "items_found": F.length("query_text").cast("long")})
    return ingest.replace_rows(q, done, ["task_id"]).select("task_id", "status", "items_found")


@query("src_pool", "SELECT ticker, alias, alias_kind FROM (SELECT DISTINCT upper(ticker) AS ticker, trim(alias) AS alias, alias_kind FROM company_aliases) WHERE length(alias) > 0")
def src_pool(spark, root):
    """SRC-06, SNK-06: alias documents, one a company, written and read again."""
    lists = [F.collect_set(F.when(F.col("alias_kind") == k, F.col("alias"))).alias(k) for k in files.KINDS]
    at = scratch(spark, "pool")
    table(spark, root, "company_aliases").groupBy("ticker").agg(*lists).repartition("ticker").write.option("maxRecordsPerFile", 1).json(at)
    return files.alias_pool(spark, at).select("ticker", "alias", "alias_kind").distinct()


@query("src_companies", "SELECT trim(ticker) AS ticker, trim(company_name) AS company_name FROM companies")
def src_companies(spark, root):
    """SRC-07: the company table as CSV, written and read again."""
    at = scratch(spark, "companies")
    table(spark, root, "companies").select("ticker", F.col("company_name").alias("name")).write.option("header", True).csv(at)
    return files.companies(spark, at).select("ticker", "company_name")


@query("src_documents", f"WITH {_HITS} SELECT ticker, article_id, location FROM hits")
def src_documents(spark, root):
    """SRC-09, SNK-02: company documents, written and read again."""
    at = scratch(spark, "documents")
    rows = _hits(spark, root).join(once(spark, root, "title", "published_at").select("article_id", "title", "published_at"), "article_id").select("ticker", "article_id", "title", "published_at", "location")
    sinks.write_ndjson(sinks.company_documents(rows), at)
    return files.ticker_documents(spark, sinks.published(spark, at)).select("ticker", "article_id", "location")


@query("src_events", f"WITH RECURSIVE {_VIEW} SELECT id, ticker, date, sources_count FROM v")
def src_events(spark, root):
    """SRC-14, SNK-03: the list of events, written in order and read again."""
    at = scratch(spark, "events")
    view = _view(spark, root)
    sinks.write_ordered(view, at, F.desc("date"), "ticker", "id")
    return spark.read.schema(view.schema).json(sinks.published(spark, at)).select("id", "ticker", "date", "sources_count")
