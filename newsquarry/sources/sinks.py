"""Writers: full and delta exports, company documents, event lists."""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsquarry.functions.dates import instant
from newsquarry.sources.versions import Versions

log = logging.getLogger(__name__)


def delta(df: DataFrame, since: str | None, instants: tuple[str, ...] = ("fetched_at", "matched_at")) -> DataFrame:
    """Rows changed at or after ``since``; all without one."""
    if since is None:
        return df
    at = instant(F.lit(since))
    hit = F.lit(False)
    for c in instants:
        hit = hit | F.coalesce(instant(c) >= at, F.lit(False))
    return df.where(hit)


def publish(spark: SparkSession, write, path: str) -> int:
    """Calls ``write(folder)`` for a new folder below ``path`` and makes it the version that ``published`` gives.

    Versions that are being read stay where they are.  Of two runs that started from the
    same version the second one raises PublishedElsewhere.
    """
    versions = Versions(spark, path)
    last = versions.last()
    name = versions.stage()
    write(f"{path}/{name}")
    return versions.publish(last[0] if last else 0, {"data": name})


def published(spark: SparkSession, path: str) -> str:
    """The folder of the newest version below ``path``."""
    last = Versions(spark, path).last()
    if last is None:
        raise FileNotFoundError(path)
    return f"{path}/{last[1]['data']}"


def publish_to(spark: SparkSession, write, targets: list[str]) -> dict[str, str]:
    """Publishes to every target and tells by target 'written' or what went wrong; one that fails does not keep the others from it."""
    out = {}
    for path in targets:
        try:
            publish(spark, write, path)
            out[path] = "written"
        except Exception as e:  # each target stands for itself
            log.warning("target %s failed", path, exc_info=True)
            out[path] = f"failed: {type(e).__name__}"
    return out


def newest_of(spark: SparkSession, paths: list[str]) -> str | None:
    """The first of ``paths`` that holds a published version, as its folder; None if none does."""
    for path in paths:
        try:
            return published(spark, path)
        except FileNotFoundError:
            continue
    return None


def company_documents(matches: DataFrame, existing: DataFrame | None = None, page: int = 10_000) -> DataFrame:
    """(ticker, page, articles): matches as documents of a company, each article once, newest first, undated last.

    Matches that are already in ``existing`` (same columns) are not taken again.  A document
    holds at most ``page`` articles; a company with more has several, numbered from 0 in
    order.  Places are counted by days, so no task orders a whole company.
    """
    rows = matches
    if existing is not None:
        rows = existing.unionByName(matches.join(existing.select("ticker", "article_id"), ["ticker", "article_id"], "left_anti"), allowMissingColumns=True)
    rows = rows.dropDuplicates(["ticker", "article_id"])
    fields = [c for c in rows.columns if c != "ticker"]
    entry = F.struct(F.coalesce("published_at", F.lit("")).alias("_d"), *[F.col(c) for c in fields])
    rows = rows.select("ticker", F.substring(F.coalesce("published_at", F.lit("")), 1, 10).alias("_day"), entry.alias("_e"))
    days = rows.groupBy("ticker", "_day").agg(F.count(F.lit(1)).alias("_n"))
    newer = Window.partitionBy("ticker").orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("ticker", "_day", F.coalesce(F.sum("_n").over(newer), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("ticker", "_day").orderBy(F.desc("_e")))
    placed = rows.withColumn("_k", inside).join(days, ["ticker", "_day"]).withColumn("page", F.floor((F.col("_before") + F.col("_k") - 1) / page).cast("int"))
    docs = placed.groupBy("ticker", "page").agg(F.sort_array(F.collect_list("_e"), asc=False).alias("x"))
    return docs.select("ticker", "page", F.transform("x", lambda e: F.struct(*[e[c].alias(c) for c in fields])).alias("articles"))


def write_ndjson(df: DataFrame, path: str) -> None:
    """One JSON object a line, nulls written out."""
    publish(df.sparkSession, lambda p: df.write.option("ignoreNullFields", False).json(p), path)


def write_ordered(df: DataFrame, path: str, *order, page: int = 10_000) -> None:
    """Files of at most ``page`` rows in the order of their names, for lists that a page reads.

    Rows are parted by ranges of ``order``, so no task holds more than its range.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    publish(df.sparkSession, lambda p: ordered.write.option("maxRecordsPerFile", page).option("ignoreNullFields", False).json(p), path)


def write_new(df: DataFrame, path: str, force: bool = False) -> str:
    """'exists', 'written' or 'failed': writes JSON unless the path is there already, or in any case with ``force``."""
    if not force and Versions(df.sparkSession, path).last() is not None:
        return "exists"
    if df.isEmpty():
        return "failed"
    write_ndjson(df, path)
    return "written"


def write_counts(counts: DataFrame, path: str, name: str, value: str) -> dict[str, int]:
    """Publishes a run's counters (name, value), of which there are few, as one JSON document and gives them."""
    found = {r[0]: r[1] for r in counts.select(name, value).collect()}
    spark = counts.sparkSession
    one = spark.createDataFrame([(json.dumps(found, ensure_ascii=False, sort_keys=True),)], "value string")
    publish(spark, lambda p: one.coalesce(1).write.text(p), path)
    return found


def once_only(spark: SparkSession, folder: str, name: str, work) -> bool:
    """Calls ``work()`` unless it was done before; True if it ran.  The mark is made after the work, so a failure leaves it to do."""
    flags = Versions(spark, f"{folder}/_done_{name}")
    if flags.last() is not None:
        return False
    work()
    flags.publish(0, {"done": name})
    return True


def export_delta(df: DataFrame, folder: str, now: str, instants: tuple[str, ...] = ("fetched_at", "matched_at")) -> str:
    """Writes all rows at first and later those changed since the last run began; gives the export's folder.

    The mark of a run is the time before it read, ``now``, and is published with what it
    wrote, so what arrives meanwhile is exported twice rather than never.
    """
    spark = df.sparkSession
    versions = Versions(spark, folder)
    last = versions.last()
    name = versions.stage()
    delta(df, last[1]["mark"] if last else None, instants).write.option("ignoreNullFields", False).json(f"{folder}/{name}")
    versions.publish(last[0] if last else 0, {"data": name, "mark": now})
    return f"{folder}/{name}"
