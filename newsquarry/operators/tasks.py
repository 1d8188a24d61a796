"""Task grids, splitting of truncated scans, and the retry state of a queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsquarry.functions.dates import month_chunks, week_chunks
from newsquarry.session import small_enough

MAX_BACKENDS = 1_000


def _backends(backends: DataFrame) -> Column:
    """Array of (backend, dated), read by the driver as there are few."""
    rows = small_enough(backends.select("backend", "dated").distinct().orderBy("backend", "dated"), MAX_BACKENDS)
    if rows is None:
        raise ValueError(f"more than {MAX_BACKENDS} backends")
    return F.array(*[F.struct(F.lit(r["backend"]).alias("backend"), F.lit(r["dated"]).alias("dated")) for r in rows])


def keyword_tasks(backends: DataFrame, terms: DataFrame, start: Column, end: Column) -> DataFrame:
    """One task for each backend, term and month; a backend that can't filter by date gets one span.

    ``backends`` has (backend, dated), ``terms`` (term, group_key, ix).  Terms stay where they are; backends and spans are laid out beside each.
    """
    grid = terms.withColumn("b", F.explode(_backends(backends)))
    spans = F.when(F.col("b.dated"), month_chunks(start, end)).otherwise(F.array(F.struct(start.alias("after"), end.alias("before"))))
    rows = grid.withColumn("span", F.explode(spans)).select(F.col("b.backend").alias("backend"), "group_key", F.col("ix").alias("sub_query_ix"), F.col("term").alias("query_text"), F.col("span.after").alias("after_date"), F.col("span.before").alias("before_date"))
    return rows.withColumn("task_id", F.concat_ws(":", "backend", "group_key", "sub_query_ix", "after_date"))


def alias_tasks(backends: DataFrame, names: DataFrame, start: Column, end: Column) -> DataFrame:
    """One task for each backend, company name and month; ``names`` has (ticker, alias, ix)."""
    grid = names.withColumn("b", F.explode(_backends(backends))).withColumn("span", F.explode(month_chunks(start, end)))
    rows = grid.select(F.col("b.backend").alias("backend"), "ticker", F.col("ix").alias("sub_query_ix"), F.col("alias").alias("query_text"), F.col("span.after").alias("after_date"), F.col("span.before").alias("before_date"))
    return rows.withColumn("task_id", F.concat_ws(":", "backend", F.lit("alias"), "ticker", "sub_query_ix", "after_date", "before_date"))


def split_tasks(done: DataFrame, items: str = "items_found", cap: int = 90) -> DataFrame:
    """Weekly children of finished tasks whose result was cut at the source: ``cap`` items and more over more than a week."""
    full = done.where((F.col(items) >= cap) & (F.datediff("before", "after") >= 7))
    kids = full.withColumn("span", F.explode(week_chunks(F.col("after"), F.col("before"))))
    return kids.withColumns({"parent_id": F.col("task_id"), "after": F.col("span.after"), "before": F.col("span.before")}).withColumn("task_id", F.concat_ws(":", "parent_id", F.col("span.after"), F.col("span.before"))).drop("span")


def after_failure(queue: DataFrame, failures: DataFrame, now: Column, schedule: list[int], max_attempts: int = 5) -> DataFrame:
    """The queue's next state after failures (task_id, error): one attempt more, a later next attempt, or given up."""
    failed = queue.join(failures.groupBy("task_id").agg(F.max("error").alias("_error")), "task_id", "left")
    n = F.coalesce("attempts", F.lit(0)) + 1
    delay = F.element_at(F.array(*[F.lit(s) for s in schedule]), F.least(n, F.lit(len(schedule))))
    hit = F.col("_error").isNotNull()
    return failed.withColumns({
        "attempts": F.when(hit, n).otherwise(F.col("attempts")),
        "status": F.when(hit & (n >= max_attempts), "failed").when(hit, "backoff").otherwise(F.col("status")),
        "next_attempt": F.when(hit & (n < max_attempts), F.date_format(F.to_utc_timestamp(now + F.make_dt_interval(secs=delay.cast("double")), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.col("next_attempt")),
        "last_error": F.when(hit, F.substring("_error", 1, 500)).otherwise(F.col("last_error")),
    }).drop("_error")


def claimable(queue: DataFrame, now: Column, ttl_seconds: int = 1800) -> DataFrame:
    """Tasks that may be claimed, the next one first: pending, due again, or claimed so long ago that the claim lapsed."""
    from newsquarry.functions.dates import instant

    due = instant("next_attempt")
    free = (F.col("status") == "pending") | ((F.col("status") == "backoff") & (due <= now)) | ((F.col("status") == "in_progress") & (due + F.make_dt_interval(secs=F.lit(float(ttl_seconds))) <= now))
    return queue.where(free).orderBy(due.asc_nulls_first(), "task_id")


def claim(queue: DataFrame, now: Column, per_backend: int = 1, ttl_seconds: int = 1800) -> DataFrame:
    """The queue with ``claimed``, after the next ``per_backend`` tasks of each backend were claimed.

    Tasks that wait, are to be tried again or were claimed can be taken once their next
    attempt is due, those that wait also without one.  A claimed task is in progress and
    its next attempt lies ``ttl_seconds`` ahead, so it can be taken again if its worker dies.
    """
    from newsquarry.functions.dates import instant

    due = instant("next_attempt")
    free = ((F.col("status") == "pending") & due.isNull()) | (F.col("status").isin("pending", "backoff", "in_progress") & (due <= now))
    order = Window.partitionBy("backend").orderBy(due.asc_nulls_first(), "task_id")
    taken = queue.where(free).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_backend).select("task_id", F.lit(True).alias("claimed"))
    until = F.date_format(F.to_utc_timestamp(now + F.make_dt_interval(secs=F.lit(float(ttl_seconds))), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    hit = F.col("claimed")
    out = queue.join(taken, "task_id", "left").withColumn("claimed", F.coalesce("claimed", F.lit(False)))
    return out.withColumns({"status": F.when(hit, "in_progress").otherwise(F.col("status")), "next_attempt": F.when(hit, until).otherwise(F.col("next_attempt"))})


def counts_by_backend(*grids: DataFrame) -> DataFrame:
    """(backend, tasks): how many tasks several builders made together."""
    parts = None
    for g in grids:
        one = g.groupBy("backend").agg(F.count(F.lit(1)).alias("tasks"))
        parts = one if parts is None else parts.unionByName(one)
    return parts.groupBy("backend").agg(F.sum("tasks").alias("tasks"))


def drained(queue: DataFrame, by: str = "backend") -> DataFrame:
    """(by, drained): whether no task waits, is being done or is to be tried again."""
    return queue.groupBy(by).agg((~F.bool_or(F.col("status").isin("pending", "backoff", "in_progress"))).alias("drained"))
