"""Batch ingestion: projecting items, merging records by key, memo tables, idempotent appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquarry.functions.text import title_hash
from newsquarry.functions.url import canonical_url, dedup_key, domain_of


def filled(column: str) -> Column:
    """The column with '' as null."""
    return F.nullif(F.col(column), F.lit(""))


def to_articles(items: DataFrame, url: str = "url") -> DataFrame:
    """Search items with their derived columns: article_id, url_canonical, domain and title_hash.

    Items without a key are dropped.
    """
    made = items.withColumns({"article_id": dedup_key(url), "url_canonical": canonical_url(url), "domain": domain_of(url), "title_hash": title_hash("title")})
    return made.where("article_id <> ''")


def merge_by_key(df: DataFrame, key: list[str], order: list[str], fill: list[str]) -> DataFrame:
    """One row a key: the first by ``order``, with the first filled value of each column of ``fill``.

    Nulls of ``order`` come first, ties are broken by a digest of the whole row.  Only the
    columns to fill are looked for in later rows; all others are those of the first row.
    Rows with a null in the key are kept as they are.  One aggregation with partial
    results, so a key may hold any share of the rows.
    """
    rest = [c for c in df.columns if c not in key]
    digest = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in rest]))
    has_key = F.lit(True)
    for k in key:
        has_key = has_key & F.col(k).isNotNull()
    place = F.struct(*[F.col(c) for c in order], digest.alias("_digest"))
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), place).alias("_row")
    values = [F.min_by(filled(c), F.when(filled(c).isNotNull(), place)).alias(f"_fill_{c}") for c in fill]
    merged = df.where(has_key).groupBy(*key).agg(first, *values)
    columns = [F.col(c) if c in key else F.coalesce(f"_fill_{c}", f"_row.{c}").alias(c) if c in fill else F.col(f"_row.{c}").alias(c) for c in df.columns]
    return merged.select(*columns).unionByName(df.where(~has_key))


def merge_articles(df: DataFrame, order: list[str], fill: tuple[str, ...] = ("description", "sapo", "body", "source")) -> DataFrame:
    """Records merged by article_id, and the survivors by (title_hash, published_at) where both are filled."""
    by_id = merge_by_key(df, ["article_id"], order, list(fill))
    has = (F.coalesce(F.col("title_hash"), F.lit("")) != "") & (F.coalesce(F.col("published_at"), F.lit("")) != "")
    twins = merge_by_key(by_id.where(has), ["title_hash", "published_at"], order, list(fill))
    return twins.unionByName(by_id.where(~has))


def fill_missing(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``target`` with the columns that are null or '' taken from ``source``'s row of the same key, where that is filled.

    Of several source rows of a key the greatest filled value of each column counts.
    """
    best = source.groupBy(key).agg(*[F.max(filled(c)).alias(f"_{c}") for c in columns])
    joined = target.join(best, key, "left")
    return joined.withColumns({c: F.coalesce(filled(c), F.col(f"_{c}"), F.col(c)) for c in columns}).drop(*[f"_{c}" for c in columns])


def latest_value(log: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """Last writer wins: (key, value, at) of the latest row of each key, of equals the greatest value."""
    best = log.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(F.col(at).alias("at"), F.col(value).alias("value"))).alias("x"))
    return best.select(key, F.col("x.value").alias(value), F.col("x.at").alias(at))


def append_new(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """``existing`` and the rows of ``incoming`` whose key it lacks, one a key."""
    fresh = incoming.dropDuplicates(key).join(existing.select(*key).distinct(), key, "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def replace_rows(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """``existing`` with the rows of ``incoming`` in place of those of the same key."""
    return existing.join(incoming.select(*key).distinct(), key, "left_anti").unionByName(incoming, allowMissingColumns=True)


def resolve(df: DataFrame, url: str, memo: DataFrame, memo_url: str, decoded: str, status: str, ok: str = "ok") -> DataFrame:
    """``df`` with ``resolved_url``: the memo's decoded URL where its status is ``ok`` and it is filled, else the URL itself."""
    good = memo.where((F.col(status) == ok) & filled(decoded).isNotNull()).groupBy(F.col(memo_url).alias(url)).agg(F.max(decoded).alias("_decoded"))
    return df.join(good, url, "left").withColumn("resolved_url", F.coalesce("_decoded", F.col(url))).drop("_decoded")


def rewrite_once(df: DataFrame, column: str, cleaned: Column) -> tuple[DataFrame, DataFrame]:
    """The rewritten table, and (scanned, changed) of the rewrite; a second rewrite changes nothing if ``cleaned`` is idempotent."""
    counts = df.where(F.col(column).isNotNull()).agg(F.count(F.lit(1)).alias("scanned"), F.count_if(~cleaned.eqNullSafe(F.col(column))).alias("changed"))
    return df.withColumn(column, cleaned), counts


def reset_matches(articles: DataFrame) -> DataFrame:
    """The articles as if they had never been matched: states pending, verdicts and cached hits gone."""
    pending, gone = F.lit("pending"), F.lit(None).cast("string")
    new = {"match_status": pending, "esg_status": pending, "matched_at": gone, "esg_type": gone, "severity": gone, "cached_hits": gone}
    return articles.withColumns({c: v for c, v in new.items() if c in articles.columns})
