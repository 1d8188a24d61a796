"""Rounds of workers: claimed tasks are searched and bodies fetched by callables that a user brings."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquarry.operators import tasks
from newsquarry.operators.match import FIELDS, alias_hits
from newsquarry.session import cut

Search = Callable[[dict], list[dict]]
FetchBody = Callable[[str], tuple[str | None, str]]


class Throttle:
    """Waits between calls, with a jitter of a third by default; each task of Spark paces itself."""

    def __init__(self, seconds: float, jitter: float = 0.33, seed: int = 0, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        import random

        self.seconds, self.jitter, self._random, self._sleep, self._clock = seconds, jitter, random.Random(seed), sleep, clock
        self._next = 0.0

    def wait(self) -> float:
        """Sleeps as long as is left and returns how long that was."""
        left = max(0.0, self._next - self._clock())
        if left:
            self._sleep(left)
        self._next = self._clock() + self.seconds * (1 + self._random.uniform(-self.jitter, self.jitter))
        return left


class Bucket:
    """A token bucket: ``rate`` calls a second, at most ``size`` at once."""

    def __init__(self, rate: float, size: int, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.rate, self.size, self._sleep, self._clock = rate, size, sleep, clock
        self._tokens, self._at = float(size), clock()

    def take(self) -> None:
        now = self._clock()
        self._tokens = min(self.size, self._tokens + (now - self._at) * self.rate)
        self._at = now
        if self._tokens < 1:
            wait = (1 - self._tokens) / self.rate
            self._sleep(wait)
            self._tokens, self._at = 1.0, self._clock()
        self._tokens -= 1


def search_round(queue: DataFrame, search: Search, now: Column, per_backend: int = 1, item: str = "url string, title string", cap: int = 90, seconds_apart: float = 0.0, schedule: tuple[int, ...] = (300, 1800, 7200)) -> tuple[DataFrame, DataFrame]:
    """(queue, items) after one round: tasks claimed, searched, and marked as done, split or failed.

    ``search`` gets a task as a dict and returns its items.  Whatever it raises goes to the
    task's last error and puts the task off.  Tasks whose result was cut at the source are
    followed by weekly children.  Each task is searched once: its result is written before
    queue and items are made of it.
    """
    claimed = tasks.claim(queue, now, per_backend)
    names = [f.name for f in T._parse_datatype_string(item).fields] if isinstance(item, str) else item.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = Throttle(seconds_apart)
        for b in batches:
            out = []
            for task in b.to_pylist():
                pace.wait()
                try:
                    found, error = [{n: x.get(n) for n in names} for x in search(task)], None
                except Exception as e:  # foreign code; the task is tried again later
                    found, error = [], f"{type(e).__name__}: {e}"
                out.append({"task_id": task["task_id"], "items": found, "error": error})
            yield pa.RecordBatch.from_pylist(out, schema)

    kind = T.StructType([T.StructField("task_id", T.StringType()), T.StructField("items", T.ArrayType(T._parse_datatype_string(item))), T.StructField("error", T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(kind)
    results = cut(claimed.where("claimed").drop("claimed").mapInArrow(run, kind))
    failed = results.where("error IS NOT NULL").select("task_id", "error")
    done = results.where("error IS NULL").select("task_id", F.size("items").cast("int").alias("_found"))
    after = tasks.after_failure(claimed.drop("claimed"), failed, now, list(schedule)).join(done, "task_id", "left")
    stamp = F.date_format(F.to_utc_timestamp(now, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    hit = F.col("_found").isNotNull()
    after = after.withColumns({"status": F.when(hit, "done").otherwise(F.col("status")), "items_found": F.when(hit, F.col("_found")).otherwise(F.col("items_found")), "done_at": F.when(hit, stamp).otherwise(F.col("done_at"))})
    full = after.where(hit).withColumns({"after": F.col("after_date").cast("date"), "before": F.col("before_date").cast("date")})
    kids = tasks.split_tasks(full, "_found", cap)
    fresh = kids.select([F.date_format("after", "yyyy-MM-dd").alias(c) if c == "after_date" else F.date_format("before", "yyyy-MM-dd").alias(c) if c == "before_date" else F.lit("pending").alias(c) if c == "status" else F.lit(0).cast(queue.schema[c].dataType).alias(c) if c in ("attempts", "items_found") else F.lit(None).cast(queue.schema[c].dataType).alias(c) if c in ("next_attempt", "last_error", "done_at") else F.col(c) for c in queue.columns])
    fresh = fresh.join(queue.select("task_id"), "task_id", "left_anti").select(queue.columns)
    items = results.select("task_id", F.explode("items").alias("x")).select("task_id", "x.*")
    return after.select(queue.columns).unionByName(fresh), items


def body_round(articles: DataFrame, index: DataFrame, fetch: FetchBody, limit: int, url: str = "url_canonical", seconds: float | None = None) -> DataFrame:
    """(article_id, body, body_status, cached_hits, route): what a round of body workers changes.

    Candidates wait for both their body and their match, the oldest first, ``limit`` of
    them.  Those whose title, description or sapo already names a company keep these hits
    and skip the fetch; for the others ``fetch`` gives (body, status), and whatever it
    raises makes them ``failed``.  With ``seconds`` a task of Spark fetches for no longer
    and leaves the rest as they are.
    """
    waiting = articles.where("body_status IN ('pending', 'ratelimited') AND match_status = 'pending'")
    chosen = cut(waiting.orderBy("fetched_at", "article_id").limit(limit))
    hits = alias_hits(chosen, index, "article_id", FIELDS[:3])
    entry = F.struct("ticker", "alias", "location", "weight")
    early = hits.groupBy("article_id").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("cached_hits"))  # an article names few companies
    skipped = early.select("article_id", F.lit(None).cast("string").alias("body"), F.lit("skipped").alias("body_status"), "cached_hits", F.lit("skipped").alias("route"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        began = time.monotonic()
        for b in batches:
            out: list[list] = [[], [], []]
            for k, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if seconds is not None and time.monotonic() - began >= seconds:
                    break
                try:
                    body, status = fetch(u)
                except Exception:  # foreign code; the article counts as failed
                    body, status = None, "failed"
                for column, x in zip(out, (k, body, status)):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], ["article_id", "body", "body_status"])

    rest = chosen.join(early, "article_id", "left_anti").select("article_id", url)
    fetched = rest.mapInArrow(run, "article_id string, body string, body_status string")
    return cut(skipped.unionByName(fetched.select("article_id", "body", "body_status", F.lit(None).cast("string").alias("cached_hits"), F.lit("fetched").alias("route"))))
