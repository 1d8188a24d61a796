"""Modes of a run as lists of stages; each stage takes the tables made so far and gives one more."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsquarry.operators import classify, cluster, enrich, ingest, match
from newsquarry.session import cut

log = logging.getLogger(__name__)
Tables = dict[str, DataFrame]


def merge(t: Tables) -> DataFrame:
    return ingest.merge_articles(t["articles"], ["fetched_at"])


def attribute(t: Tables) -> DataFrame:
    return match.roundup_gate(match.alias_hits(t["merged"], match.alias_index(t["company_aliases"])))


def judge(t: Tables) -> DataFrame:
    return classify.classify(t["merged"])


def events(t: Tables) -> DataFrame:
    kept = t["verdicts"].where("keep").select("article_id", "title", "published_at")
    return cluster.cluster_events(t["hits"].select("article_id", "ticker").join(kept, "article_id"))


def enriched(t: Tables) -> DataFrame:
    """Needs ``scorers``, a table's place taken by three callables: sentiment gate, translator, judge."""
    rows = cut(cluster.prepared(t["hits"].select("article_id", "ticker").join(t["verdicts"].where("keep").select("article_id", "title", "published_at"), "article_id")))
    members = cluster.clustered(rows).join(cluster.distinctive_tokens(cluster.document_frequency(rows)), "ticker", "left")
    fields = ("sentiment", "summary_en", "controversy_level", "controversy_justification")
    judged = t["merged"].where("enrich_status = 'done' AND sentiment IS NOT NULL").select("article_id", *fields)
    taken = cluster.inherit(members, judged, fields).groupBy("article_id").agg(F.min(F.struct("ticker", *fields)).alias("x")).select("article_id", *[f"x.{f}" for f in fields])
    pending = t["verdicts"].where("keep AND coalesce(enrich_status, 'pending') = 'pending'").join(t["hits"].select("article_id").distinct(), "article_id", "left_semi").select("article_id", "title")
    return enrich.enrichment(pending, taken, *t["scorers"])


STAGES: dict[str, Callable[[Tables], DataFrame]] = {"merged": merge, "hits": attribute, "verdicts": judge, "events": events, "enriched": enriched}
MODES = {"enrich": ("merged", "hits", "verdicts", "enriched"), "backfill": ("merged", "hits", "verdicts", "events", "enriched"), "daily": ("merged", "hits", "verdicts", "events"), "rematch": ("hits", "verdicts", "events"), "match": ("merged", "hits", "verdicts")}


def run(mode: str, tables: Tables, since: str | None = None, limit: int | None = None) -> Tables:
    """The tables with those of the mode's stages; a stage that fails is logged and left out, as are those that need it.

    With ``since`` only articles published from then on are taken, with ``limit`` the newest so many.
    """
    out = dict(tables)
    if since is not None:
        out["articles"] = out["articles"].where(F.col("published_at") >= since)
    if limit is not None:
        newest = out["articles"].groupBy("article_id").agg(F.max("published_at").alias("_at")).orderBy(F.desc_nulls_last("_at"), "article_id").limit(limit)
        out["articles"] = out["articles"].join(newest.select("article_id"), "article_id", "left_semi")
    if mode == "rematch":
        out.setdefault("merged", out["articles"])
    for name in MODES[mode]:
        try:
            out[name] = STAGES[name](out)
        except Exception:  # a failed stage must not take the others with it
            log.exception("stage %s failed", name)
    return out
