"""The registered queries of the subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsquarry.functions.url import domain_of
from newsquarry.llm.boilerplate import find_furniture
from newsquarry.llm.canonical import noncanonical_fields
from newsquarry.llm.leakage import leaks
from newsquarry.llm.mixture import mix
from newsquarry.llm.neardup import classes, expand, near_reports
from newsquarry.llm.residue import find_residue, mine_templates
from newsquarry.llm.site_lines import repeated_lines, without_lines
from newsquarry.llm.toxicity import reviewed, scores, train
from newsquarry.llm.truncation import cut_values
from newsquarry.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


@query("p1_found")
def p1_found(spark: SparkSession, root: str) -> DataFrame:
    found = noncanonical_fields(table(spark, root, "articles"), "article_id", ["title", "sapo", "body"])
    return found.select("article_id", "field_name").distinct()


@query("p1_kinds")
def p1_kinds(spark: SparkSession, root: str) -> DataFrame:
    """How many articles differ in which way, by field."""
    found = noncanonical_fields(table(spark, root, "articles"), "article_id", ["title", "sapo", "body"])
    return found.groupBy("field_name", "kind").agg(F.count(F.lit(1)).alias("articles"))


@query("p3_found")
def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return find_residue(table(spark, root, "articles"), "article_id", "body", "domain").select("article_id").distinct()


@query("p3_templates")
def p3_templates(spark: SparkSession, root: str) -> DataFrame:
    """The mined message templates with their counts and classes."""
    return mine_templates(table(spark, root, "articles"), "article_id", "body", "domain")


@query("p5_found")
def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return find_furniture(table(spark, root, "articles"), "article_id", "body", "domain")


_SITE = "regexp_replace(lower(trim(domain)), '^www\\.', '')"
_P7_LINES = f"""WITH bodies AS (SELECT DISTINCT article_id, {_SITE} AS site, body FROM articles WHERE length({_SITE}) > 0 AND regexp_matches(body, '\\S')),
numbered AS (SELECT article_id, site, unnest(string_split(body, chr(10))) AS line, CAST(unnest(generate_series(0, len(string_split(body, chr(10))) - 1)) AS INTEGER) AS line_no FROM bodies),
lines AS (SELECT article_id, site, line_no, regexp_replace(lower(line), '[\\s\\p{{Z}}\\p{{Nd}}]+', '', 'g') AS k FROM numbered WHERE regexp_matches(line, '[^\\s\\p{{Z}}]')),
sizes AS (SELECT site, count(DISTINCT article_id) AS n FROM bodies GROUP BY site),
counts AS (SELECT site, k, count(DISTINCT article_id) AS docs FROM lines GROUP BY site, k),
confirmed AS (SELECT site, k, docs FROM counts JOIN sizes USING (site) WHERE docs >= 4 AND docs * 20 >= n)
"""


@query("p7_found", _P7_LINES + "SELECT DISTINCT article_id, line_no FROM lines JOIN confirmed USING (site, k)")
def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return repeated_lines(table(spark, root, "articles"), "article_id", "domain", "body").select("article_id", "line_no").distinct()


@query("p7_sites", _P7_LINES + "SELECT site, count(DISTINCT k) AS repeated_lines, count(DISTINCT article_id) AS articles FROM lines JOIN confirmed USING (site, k) GROUP BY site")
def p7_sites(spark: SparkSession, root: str) -> DataFrame:
    """By site: how many different lines are repeated, and how many articles hold one."""
    found = repeated_lines(table(spark, root, "articles"), "article_id", "domain", "body")
    return found.groupBy("site").agg(F.countDistinct("line_key").alias("repeated_lines"), F.countDistinct("article_id").alias("articles"))


@query(
    "p7_clean",
    _P7_LINES + ", gone AS (SELECT DISTINCT article_id, line_no FROM lines JOIN confirmed USING (site, k)), every AS (SELECT DISTINCT article_id, body FROM articles WHERE article_id IS NOT NULL AND body IS NOT NULL), "
    "parts AS (SELECT article_id, body, unnest(string_split(body, chr(10))) AS line, CAST(unnest(generate_series(0, len(string_split(body, chr(10))) - 1)) AS INTEGER) AS line_no FROM every), "
    "kept AS (SELECT p.article_id, p.body, string_agg(p.line, chr(10) ORDER BY p.line_no) FILTER (WHERE g.line_no IS NULL) AS clean FROM parts p LEFT JOIN gone g ON g.article_id = p.article_id AND g.line_no = p.line_no GROUP BY 1, 2) "
    "SELECT article_id, md5(coalesce(clean, '')) AS digest FROM kept",
)
def p7_clean(spark: SparkSession, root: str) -> DataFrame:
    """Every body without the lines its site repeats, as a digest."""
    articles = table(spark, root, "articles").where("article_id IS NOT NULL AND body IS NOT NULL").select("article_id", "domain", "body")
    clean = without_lines(articles, "article_id", "body", repeated_lines(articles, "article_id", "domain", "body"))
    return clean.select("article_id", F.md5(F.encode("body", "UTF-8")).alias("digest")).distinct()


def _near(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return near_reports(table(spark, root, "articles"), "article_id", "body", "domain", size=3, similarity=0.6)


@query("p4_found")
def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return expand(*_near(spark, root), "article_id")


@query("p4_classes")
def p4_classes(spark: SparkSession, root: str) -> DataFrame:
    """By article: the group of near-duplicates it belongs to and how many others it is linked with."""
    return classes(*_near(spark, root), "article_id")


def _cut_values(spark: SparkSession, root: str) -> DataFrame:
    # an article without a domain still shows its site in its address
    articles = table(spark, root, "articles").withColumn("domain", F.coalesce(F.nullif("domain", F.lit("")), domain_of("url_canonical")))
    return cut_values(articles, "article_id", ["description", "sapo"], "source", "domain", ["body", "description", "sapo"])


@query("p6_found")
def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return _cut_values(spark, root).where("is_cut").select("article_id", "field_name").distinct()


@query("p6_rates")
def p6_rates(spark: SparkSession, root: str) -> DataFrame:
    """By source and field: values, cut values and their share, each article once."""
    values = _cut_values(spark, root).groupBy("source", "field_name", "article_id").agg(F.bool_or("is_cut").alias("is_cut"))
    rates = values.groupBy("source", "field_name").agg(F.count(F.lit(1)).alias("articles"), F.count_if("is_cut").alias("cut_articles"))
    return rates.withColumn("share", F.round(F.col("cut_articles") / F.col("articles"), 6))


def _leaks(spark: SparkSession, root: str) -> DataFrame:
    return leaks(table(spark, root, "documents"), "doc_id", "text", table(spark, root, "eval_items"), "item_id", "item_text")


@query("p8_found")
def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return _leaks(spark, root).select("doc_id", "item_id")


@query("p8_items")
def p8_items(spark: SparkSession, root: str) -> DataFrame:
    """By item that leaked: the documents that hold it and the longest run of its words."""
    return _leaks(spark, root).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("words").alias("longest_run"))


def _mix(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """A mixture as large as the documents of the listed sources: the targets, tempered as far as the limits of repetition need it."""
    return mix(table(spark, root, "documents"), "doc_id", "source", "text", table(spark, root, "mix_targets"), passes=1.0)


@query("p9_mix")
def p9_mix(spark: SparkSession, root: str) -> DataFrame:
    """The mixture: each used document with the number of its uses."""
    return _mix(spark, root)[0]


@query("p9_shares")
def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    """Target and actual shares of the mixture by source, and the power that was bisected."""
    return _mix(spark, root)[1]


@query("p9_largest")
def p9_largest(spark: SparkSession, root: str) -> DataFrame:
    """Shares of the largest mixture that meets the targets exactly within the limits of repetition."""
    return mix(table(spark, root, "documents"), "doc_id", "source", "text", table(spark, root, "mix_targets"))[1]


def _scores(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    rows = reviewed(docs, "doc_id", "text", table(spark, root, "review_labels"), "verdict", ("abusive", "hateful", "sexual"), ("clean",))
    return scores(docs, "doc_id", "text", train(rows))


@query("p10_found")
def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return _scores(spark, root).where("score >= 0.5").select("doc_id").distinct()


@query("p10_scores")
def p10_scores(spark: SparkSession, root: str) -> DataFrame:
    """The score of every document."""
    return _scores(spark, root).select("doc_id", F.round("score", 4).alias("score"))


@query("p10_rates")
def p10_rates(spark: SparkSession, root: str) -> DataFrame:
    """By source: documents, flagged documents and their share."""
    by = table(spark, root, "documents").select("doc_id", "source").join(_scores(spark, root), "doc_id")
    rates = by.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("score") >= 0.5).alias("flagged"))
    return rates.withColumn("rate", F.round(F.col("flagged") / F.col("documents"), 6))
