"""Attribution of texts to companies by a word-bounded multi-pattern matcher."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsquarry.functions.text import editorial_body
from newsquarry.session import cut, held_once, small_enough

#: Aliases up to which the matcher is broadcast; a larger pool is refused, not cut.
MAX_ALIASES = 1_000_000
#: Kinds of aliases that count by themselves, and those that only support.
STRONG_KINDS = ("names", "subsidiaries", "projects")
FIELDS = ("title", "description", "sapo", "body")
HIT = "key string, field_no int, ticker string, alias string, weight double, pos int"


def alias_index(pool: DataFrame, stoplist: tuple[str, ...] = (), ticker: str = "ticker", alias: str = "alias", kind: str = "alias_kind") -> DataFrame:
    """(ticker, alias, kind, weight): trimmed aliases of two characters and more, one spelling a ticker, none of the stop-list.

    Of spellings that differ in case the strong kind wins, then the least spelling.  Null tickers and aliases are left out.
    """
    a = F.trim(F.col(alias))
    stops = [s.upper() for s in stoplist]
    rows = pool.select(F.upper(F.col(ticker)).alias("ticker"), a.alias("alias"), F.col(kind).alias("kind")).where("ticker IS NOT NULL AND length(alias) >= 2")
    if stops:
        rows = rows.where(~F.upper("alias").isin(stops))
    rows = rows.withColumn("weight", F.when(F.col("kind").isin(*STRONG_KINDS), 1.0).otherwise(0.3))
    first = F.min(F.struct((-F.col("weight")).alias("w"), "alias", "kind", "weight")).alias("x")
    return rows.groupBy("ticker", F.lower("alias").alias("low")).agg(first).select("ticker", "x.alias", "x.kind", "x.weight")


class Matcher:
    """All aliases in one automaton; every alias is looked for by itself, so nested and overlapping ones are all found."""

    def __init__(self, rows: list[tuple[str, str, float]], blocked: tuple[str, ...] = ()):
        self.auto, self.blocked = ahocorasick.Automaton(), ahocorasick.Automaton()
        owners: dict[str, list] = {}
        for ticker, alias, weight in rows:
            owners.setdefault(alias.lower(), []).append((ticker, alias, weight))
        for low, own in owners.items():
            self.auto.add_word(low, (len(low), sorted(own)))
        for b in blocked:
            self.blocked.add_word(b.lower(), len(b))
        for a in (self.auto, self.blocked):
            if len(a):
                a.make_automaton()

    @staticmethod
    def _spans(auto, low: str):
        if not len(auto):
            return
        for end, value in auto.iter(low):
            n = value[0] if isinstance(value, tuple) else value
            a, b = end - n + 1, end + 1
            if (a and (low[a - 1].isalnum() or low[a - 1] == "_")) or (b < len(low) and (low[b].isalnum() or low[b] == "_")):
                continue
            yield a, b, value

    def find(self, text: str, bare_tickers: bool = True, consuming: bool = False) -> dict[str, tuple[int, int, str, float]]:
        """First hit by ticker: (pos, -length, alias, weight).

        A ``consuming`` scan goes from left to right, takes the longest alias of each place
        and goes on behind it; names inside the alias it took count at its place.
        """
        low = text.lower()
        if len(low) != len(text):  # a few letters change length in lower case; positions then are those of the lower text
            text = low
        holes = [(a, b) for a, b, _ in self._spans(self.blocked, low)]
        spans = [x for x in self._spans(self.auto, low) if not any(h <= x[0] and x[1] <= e for h, e in holes)] if not consuming else self._consumed(low, holes)
        out: dict[str, tuple[int, int, str, float]] = {}
        for a, b, (n, owners) in spans:
            for ticker, alias, weight in owners:
                if not bare_tickers and alias.upper() == ticker:
                    continue
                hit = (a, -n, alias, weight)
                if ticker not in out or hit < out[ticker]:
                    out[ticker] = hit
        return out

    def _consumed(self, low: str, holes: list[tuple[int, int]]) -> list[tuple]:
        taken, end = [], 0
        every = sorted(self._spans(self.auto, low), key=lambda x: (x[0], -x[1]))
        for a, b, value in every:
            if a < end:
                if taken and taken[-1][0] <= a and b <= taken[-1][1]:  # a name inside the one that was taken
                    taken.append((taken[-1][0], taken[-1][1], value))
                continue
            end = b
            if not any(h <= a and b <= e for h, e in holes):
                taken.append((a, b, value))
        return taken


def optional_list(spark, path: str, column: str, limit: int = 100_000) -> tuple[str, ...]:
    """The distinct filled values of a column of a table of stop-words or blocked contexts; none where there is no such table.

    They become part of the matcher, so more than ``limit`` are refused.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return ()
    rows = small_enough(spark.read.parquet(path).select(F.trim(column).alias("v")).where("length(v) > 0").distinct(), limit)
    if rows is None:
        raise ValueError(f"more than {limit} values in {path}")
    return tuple(sorted(r["v"] for r in rows))


def alias_hits(articles: DataFrame, index: DataFrame, key: str = "article_id", fields: tuple[str, ...] = FIELDS, weak: bool = False, blocked: tuple[str, ...] = (), consuming: bool = False) -> DataFrame:
    """(key, ticker, alias, location, weight, pos): the first hit of each ticker in each article.

    Fields count in their order, then the place in the text, then the longer alias.  A
    field named ``body`` is cleaned first, and there an alias that is only the ticker
    does not count.  Null and empty fields hold nothing; rows of one key are taken together.
    With ``consuming`` an alias that overlaps one further left is not found.
    """
    use = index if weak else index.where("weight >= 1")
    rows = small_enough(use.select("ticker", "alias", "weight"), MAX_ALIASES)
    if rows is None:
        raise ValueError(f"more than {MAX_ALIASES} aliases")
    sent = articles.sparkSession.sparkContext.broadcast(([tuple(r) for r in rows], blocked))
    mark = uuid.uuid4().hex
    columns = [editorial_body(f).alias(f) if f == "body" else F.col(f) for f in fields]
    bare = [f != "body" for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = held_once(mark, lambda: Matcher(*sent.value))
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            keys = b.column(0).to_pylist()
            texts = [b.column(i + 1).to_pylist() for i in range(len(fields))]
            for k, *values in zip(keys, *texts):
                seen = set()
                for no, text in enumerate(values):
                    if not text:
                        continue
                    for ticker, (pos, _, alias, weight) in matcher.find(text, bare[no], consuming).items():
                        if ticker not in seen:
                            seen.add(ticker)
                            for column, x in zip(out, (k, no, ticker, alias, weight, pos)):
                                column.append(x)
            types = (b.schema.field(0).type, pa.int32(), pa.string(), pa.string(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], ["key", "field_no", "ticker", "alias", "weight", "pos"])

    hits = articles.select(F.col(key).cast("string").alias("key"), *columns).mapInArrow(run, HIT)
    first = hits.groupBy("key", "ticker").agg(F.min(F.struct("field_no", "pos", "alias", "weight")).alias("x"))
    names = F.element_at(F.array(*[F.lit(f) for f in fields]), F.col("x.field_no") + 1)
    return first.select(F.col("key").alias(key), "ticker", "x.alias", names.alias("location"), "x.weight", "x.pos")


def roundup_gate(hits: DataFrame, key: str = "article_id", many: int = 3) -> DataFrame:
    """Of articles with ``many`` hits and more only those in the title."""
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    return hits.withColumn("_n", n).where((F.col("_n") < many) | (F.col("location") == "title")).drop("_n")


def primary_ticker(hits: DataFrame, articles: DataFrame, key: str = "article_id", hint: str = "ticker_hint", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(key, ticker): of each article's hits the first, else the hint."""
    order = F.array_position(F.array(*[F.lit(f) for f in fields]), F.col("location"))
    first = hits.groupBy(key).agg(F.min_by("ticker", F.struct(order, "pos", "ticker")).alias("_t"))
    hints = articles.groupBy(key).agg(F.max(hint).alias("_h"))
    return hints.join(first, key, "left").select(key, F.coalesce("_t", "_h").alias("ticker"))


def two_stage_hits(articles: DataFrame, index: DataFrame, key: str = "article_id", cached: str = "cached_hits", body_status: str = "body_status") -> DataFrame:
    """(key, ticker, alias, location, weight, stage): cached hits where they are whole, else those of title, description and sapo; without any, those of all fields if the body is there.

    Stages are ``cached``, ``head`` and ``body``.  One row an article and ticker, the first; keys must be unique.
    """
    rows = cut(articles.withColumn("_hits", cached_hits(cached)))
    known = rows.where("_hits IS NOT NULL").select(key, F.explode("_hits").alias("h")).select(key, F.col("h.ticker").alias("ticker"), F.col("h.alias").alias("alias"), F.col("h.location").alias("location"), F.col("h.weight").alias("weight"))
    known = known.groupBy(key, "ticker").agg(F.min(F.struct("location", "alias", "weight")).alias("x")).select(key, "ticker", "x.alias", "x.location", "x.weight", F.lit("cached").alias("stage"))
    head = alias_hits(rows.where("_hits IS NULL"), index, key, FIELDS[:3]).drop("pos").withColumn("stage", F.lit("head"))
    first = cut(known.unionByName(head))
    left = rows.where(F.col(body_status) == "fetched").join(first.select(key).distinct(), key, "left_anti")
    return first.unionByName(alias_hits(left, index, key).drop("pos").withColumn("stage", F.lit("body")))


def cached_hits(json: Column | str) -> Column:
    """Hits from their JSON, null where any of it is malformed, so that it is worked out again."""
    c = F.col(json) if isinstance(json, str) else json
    hits = F.from_json(c, "array<struct<ticker:string,alias:string,location:string,weight:double>>")
    whole = F.forall(hits, lambda h: h["ticker"].isNotNull() & h["alias"].isNotNull() & h["location"].isNotNull() & h["weight"].isNotNull())
    return F.when(whole, hits)


def vet_aliases(articles: DataFrame, index: DataFrame, key: str = "article_id", fields: tuple[str, ...] = ("title", "description", "sapo"), min_hits: int = 5, fail: float = 0.1, passes: float = 0.5, names: DataFrame | None = None, samples: int = 3) -> DataFrame:
    """(ticker, alias, kind, hits, together, ratio, verdict, samples): how often an alias stands with another name of its company.

    Other names are its other aliases, its ticker and what ``names`` (ticker, name) adds;
    the ticker itself is not vetted.  All names of all articles are found in one pass;
    counts are by distinct article.  Samples are the beginnings of the first articles, by
    key, in which the alias stands alone.
    """
    use = index.select("ticker", "alias", F.lit(True).alias("vetted"))
    more = index.select("ticker", F.col("ticker").alias("alias"))
    if names is not None:
        more = more.unionByName(names.select(F.upper("ticker").alias("ticker"), F.trim("name").alias("alias")).where("length(alias) > 0"))
    every = use.unionByName(more.withColumn("vetted", F.lit(False))).groupBy("ticker", F.lower("alias").alias("low")).agg(F.min(F.struct((~F.col("vetted")).alias("n"), "alias", "vetted")).alias("x")).select("ticker", "x.alias", "x.vetted")
    rows = small_enough(every.withColumn("vetted", F.col("vetted") & (F.upper("alias") != F.col("ticker"))), MAX_ALIASES)
    if rows is None:
        raise ValueError(f"more than {MAX_ALIASES} aliases")
    sent = articles.sparkSession.sparkContext.broadcast([(r["ticker"], r["alias"], 1.0 if r["vetted"] else 0.0) for r in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value)
        for b in batches:
            keys, tickers, aliases, together, texts = [], [], [], [], []
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found: dict[str, dict] = {}
                for _, _, (_, owners) in Matcher._spans(matcher.auto, text.lower()):
                    for ticker, alias, weight in owners:
                        found.setdefault(ticker, {})[alias] = weight
                for ticker, own in found.items():
                    for alias, weight in own.items():
                        if weight:
                            keys.append(k)
                            tickers.append(ticker)
                            aliases.append(alias)
                            together.append(len(own) > 1)
                            texts.append(text[:110] if len(own) == 1 else None)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(tickers, pa.string()), pa.array(aliases, pa.string()), pa.array(together, pa.bool_()), pa.array(texts, pa.string())], ["key", "ticker", "alias", "together", "sample"])

    text = F.concat_ws(" | ", *[F.nullif(F.col(f), F.lit("")) for f in fields])
    found = articles.select(F.col(key).cast("string").alias("key"), text.alias("t")).distinct().mapInArrow(run, "key string, ticker string, alias string, together boolean, sample string")
    each = cut(found.groupBy("key", "ticker", "alias").agg(F.bool_or("together").alias("together"), F.min("sample").alias("sample")))
    counts = each.groupBy("ticker", "alias").agg(F.count(F.lit(1)).alias("hits"), F.count_if("together").alias("together"))
    alone = each.where("NOT together").withColumn("n", F.row_number().over(Window.partitionBy("ticker", "alias").orderBy("key"))).where(F.col("n") <= samples)
    shown = alone.groupBy("ticker", "alias").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "sample"))), lambda x: x["sample"]).alias("samples"))
    out = index.where(F.upper("alias") != F.col("ticker")).join(counts, ["ticker", "alias"], "left").na.fill(0, ["hits", "together"]).join(shown, ["ticker", "alias"], "left")
    ratio = F.when(F.col("hits") > 0, F.col("together") / F.col("hits")).otherwise(F.lit(0.0))
    verdict = F.when((F.col("hits") == 0) | (ratio >= passes), "PASS").when((F.col("kind") != "names") & (F.col("hits") >= min_hits) & (ratio < fail), "FAIL").otherwise("REVIEW")
    return out.select("ticker", "alias", "kind", "hits", "together", F.round(ratio, 6).alias("ratio"), verdict.alias("verdict"), F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))
