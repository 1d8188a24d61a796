"""Enrichment by injected scorers, in batches, and joins that prepare their input."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquarry.session import cut

log = logging.getLogger(__name__)


def with_retries(call: Callable, attempts: int = 3, wait: Callable[[int], float] = lambda n: 0.0, transient: tuple[type[Exception], ...] = (Exception,), final: tuple[type[Exception], ...] = ()) -> Callable:
    """``call`` that is tried again after transient errors; None after the last attempt, and at once after an error of ``final``."""

    def tried(*args):
        for n in range(1, attempts + 1):
            try:
                return call(*args)
            except final:
                return None
            except transient:
                if n < attempts:
                    time.sleep(wait(n))
        return None

    return tried


def score_batches(df: DataFrame, text: str, scorer: Callable[[list[str]], list | None], size: int, fallback: Callable[[str], str | None], name: str) -> DataFrame:
    """``df`` with ``name``: the scorer's answer for each text, asked in batches of ``size``.

    A reply of another length, None or an error falls back for the whole batch, a blank
    answer for its row: keep-all filters, translations that stay as they are and verdicts
    that stay open are fallbacks.  Null texts are sent as ''.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(b.schema.names.index(text)).to_pylist()]
            out: list[str | None] = []
            for i in range(0, len(texts), size):
                part = texts[i : i + size]
                try:
                    reply = scorer(part)
                except Exception:  # the scorer is foreign code; whatever it raises, the rows stay
                    log.warning("scorer of %s failed for %d rows", name, len(part), exc_info=True)
                    reply = None
                if reply is None or len(reply) != len(part):
                    out += [fallback(t) for t in part]
                else:
                    out += [r if r not in (None, "") else fallback(t) for r, t in zip(reply, part)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], [*b.schema.names, name])

    return df.mapInArrow(run, df.withColumn(name, F.lit(None).cast("string")).schema)


def keep_negative(df: DataFrame, text: str, scorer: Callable, size: int = 5) -> DataFrame:
    """Rows the scorer does not call ``not_risk``; on failure all are kept."""
    return score_batches(df, text, scorer, size, lambda t: "risk", "sentiment").where("sentiment <> 'not_risk'")


def translate(df: DataFrame, text: str, scorer: Callable, size: int = 30, name: str = "translation") -> DataFrame:
    """Translations in order; on failure the source text."""
    return score_batches(df, text, scorer, size, lambda t: t, name)


def enrichment(events: DataFrame, inherited: DataFrame, sentiment: Callable, translator: Callable, judge: Callable, title: str = "title", now: Column | None = None) -> DataFrame:
    """(article_id, enrich_status, sentiment, summary_en, controversy_level, controversy_justification, route): what a run of the enrichment writes back.

    ``inherited`` has (article_id, sentiment, summary_en, controversy_level,
    controversy_justification) taken over from judged reports of the same event; a risk
    without a level is not taken over but judged itself.  The others pass the sentiment
    gate, are translated, and judged by ``judge``, which gets batches of titles and gives
    JSON replies; a reply that does not hold together leaves the row pending, to be tried
    again.  A row that is no risk is dropped.
    """
    columns = ["article_id", "enrich_status", "sentiment", "summary_en", "controversy_level", "controversy_justification", "route"]
    blank = lambda n: F.lit(None).cast("string").alias(n)
    taken = inherited.where("sentiment <> 'risk' OR controversy_level IS NOT NULL").join(events.select("article_id"), "article_id", "left_semi")
    status = F.when(F.col("sentiment") == "risk", "done").otherwise("dropped")
    over = taken.select("article_id", status.alias("enrich_status"), "sentiment", *[F.when(F.col("sentiment") == "risk", F.col(c)).alias(c) for c in ("summary_en", "controversy_level", "controversy_justification")], F.lit("inherited").alias("route"))
    left = events.join(taken.select("article_id"), "article_id", "left_anti").select("article_id", title)
    gated = cut(score_batches(left, title, sentiment, 5, lambda t: "risk", "sentiment"))
    dropped = gated.where("sentiment = 'not_risk'").select("article_id", F.lit("dropped").alias("enrich_status"), "sentiment", blank("summary_en"), blank("controversy_level"), blank("controversy_justification"), F.lit("gate").alias("route"))
    kept = gated.where("sentiment <> 'not_risk'").select("article_id", title)
    shown = translate(kept, title, translator, name="summary_en")
    replies = score_batches(shown, title, judge, 1, lambda t: None, "reply").withColumn("v", validated(F.col("reply")))
    good = F.col("v").isNotNull()
    judged = replies.select("article_id", F.when(good, "done").otherwise("pending").alias("enrich_status"), F.when(good, "risk").alias("sentiment"), F.when(good, F.col("summary_en")).alias("summary_en"), F.col("v.level").alias("controversy_level"), F.col("v.justification").alias("controversy_justification"), F.lit("judged").alias("route"))
    return cut(over.unionByName(dropped).unionByName(judged).select(columns))


def validated(reply: Column, levels: tuple[str, ...] = ("Major", "Minor", "No")) -> Column:
    """(level, justification, indicator, confidence) of a model's JSON reply, null where it does not hold together.

    The level must be known and the justification not blank; a missing full stop is
    added, the indicator counts for category G and 1 to 4 only, the confidence is
    clamped to 0..100.
    """
    r = F.from_json(reply, "struct<level:string,justification:string,category:string,indicator:string,confidence:string>")
    text = F.trim(F.coalesce(r["justification"], F.lit("")))
    number = r["indicator"].try_cast("int")
    whole = F.struct(
        r["level"].alias("level"),
        F.when(text.rlike(r"[.!?]$"), text).otherwise(F.concat(text, F.lit("."))).alias("justification"),
        F.when((r["category"] == "G") & number.between(1, 4), number).alias("indicator"),
        F.greatest(F.lit(0), F.least(F.lit(100), F.coalesce(r["confidence"].try_cast("double").cast("int"), F.lit(0)))).alias("confidence"),
    )
    return F.when(r["level"].isin(*levels) & (text != ""), whole)


def wide_to_long(df: DataFrame, ids: list[str], prefix: str = "rev_", name: str = "year", value: str = "revenue") -> DataFrame:
    """One row for each id and year column whose cell is a number; thousands commas and padding are taken out."""
    columns = [c for c in df.columns if c.startswith(prefix) and c[len(prefix) :].isdigit()]
    long = df.select(*ids, *[F.col(c).cast("string") for c in columns]).unpivot(ids, columns, "_c", "_v")
    number = F.regexp_replace("_v", r"[,\s]", "").try_cast("double")
    return long.select(*ids, F.substring("_c", len(prefix) + 1, 20).cast("int").alias(name), number.alias(value)).where(F.col(value).isNotNull())


def nearest(left: DataFrame, right: DataFrame, key: str, at: str, right_at: str, value: str) -> DataFrame:
    """``left`` with the ``value`` and ``right_at`` of the same key nearest to ``at``, of two as near the earlier; null where the key has none.

    Right rows are gathered by key once (a key has few), so left rows are shuffled at most by key and never multiplied.
    """
    series = right.where(F.col(right_at).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(right_at).alias("t"), F.col(value).alias("v")))).alias("_s"))
    joined = left.join(series, key, "left")
    best = F.element_at(F.array_sort(F.transform("_s", lambda x: F.struct(F.abs(x["t"] - F.col(at)).alias("d"), x["t"].alias("t"), x["v"].alias("v")))), 1)
    return joined.withColumn("_b", F.when(F.size("_s") > 0, best)).withColumns({right_at: F.col("_b.t"), value: F.col("_b.v")}).drop("_s", "_b")
