"""Clusters of reports of one event, and what follows from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsquarry.functions.dates import first_date
from newsquarry.functions.text import jaccard, title_tokens
from newsquarry.operators.graph import components
from newsquarry.session import cut


def prepared(articles: DataFrame) -> DataFrame:
    """(ticker, article_id, day, tokens, node): one row for each ticker and article; ``node`` is its number."""
    rows = articles.select(F.upper(F.coalesce("ticker", F.lit(""))).alias("ticker"), F.col("article_id").cast("string").alias("article_id"), first_date("published_at").alias("day"), title_tokens("title").alias("tokens"))
    rows = rows.groupBy("ticker", "article_id").agg(F.min(F.struct("day", "tokens")).alias("x")).select("ticker", "article_id", "x.day", "x.tokens")
    return rows.withColumn("node", F.concat_ws("\x1f", "ticker", "article_id"))


def document_frequency(rows: DataFrame) -> DataFrame:
    """(ticker, token, df, n): in how many titles of a ticker a token stands, and how many titles it has."""
    n = rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
    df = rows.select("ticker", F.explode("tokens").alias("token")).groupBy("ticker", "token").agg(F.count(F.lit(1)).alias("df"))
    return df.join(n, "ticker")


def event_edges(rows: DataFrame, window_days: int = 10, least: float = 0.45, rare_ratio: float = 0.7) -> DataFrame:
    """(a, b): links whose connected components are the events.

    Titles of one ticker no more than ``window_days`` apart (or both undated) belong
    together if they share a rare token or are similar enough.  For a rare token it is
    enough to link each title with the next one in time, as all within the window are
    then linked through those between.  For similar titles candidates come from the
    least frequent tokens only (any similar pair shares one of them), within time bins.
    """
    frequency = document_frequency(rows)
    tokens = rows.select("ticker", "node", "day", F.size("tokens").alias("size"), F.explode("tokens").alias("token")).join(frequency, ["ticker", "token"])
    tokens = cut(tokens.withColumn("rare", (F.length("token") >= 4) & (F.col("token") != F.lower("ticker")) & (F.col("df") >= 2) & (F.col("df") / F.col("n") <= rare_ratio)))
    # a token's titles of one day hang on the first of them, and the days are chained; days are few, titles may be many
    rare = tokens.where("rare").select("ticker", "token", "day", "node")
    days = rare.groupBy("ticker", "token", "day").agg(F.min("node").alias("head"))
    w = Window.partitionBy("ticker", "token").orderBy("day")
    chained = days.where("day IS NOT NULL").withColumns({"before": F.lag("head").over(w), "then": F.lag("day").over(w)})
    links = chained.where(F.datediff("day", "then") <= window_days).select(F.col("before").alias("a"), F.col("head").alias("b"))
    beside = rare.withColumn("d", F.coalesce("day", F.lit("0001-01-01").cast("date"))).join(days.withColumn("d", F.coalesce("day", F.lit("0001-01-01").cast("date"))).drop("day"), ["ticker", "token", "d"])
    links = links.unionByName(beside.where("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b")))

    place = F.row_number().over(Window.partitionBy("node").orderBy("df", "token"))
    prefix = tokens.withColumn("place", place).where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * least - 1e-9) + 1).where("NOT rare AND df >= 2")
    # equal titles of a day are linked through the first of them, which alone is compared with others
    heads = rows.groupBy("ticker", "day", "tokens").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n"))
    day = F.coalesce("day", F.lit("0001-01-01").cast("date"))
    twins = rows.withColumn("d", day).join(heads.where("n > 1").withColumn("d", day).drop("day"), ["ticker", "d", "tokens"]).where("head <> node AND size(tokens) > 0").select(F.col("head").alias("a"), F.col("node").alias("b"))
    words = heads.select(F.col("head").alias("node"), "tokens")
    bin_ = F.floor(F.datediff("day", F.lit("1970-01-01").cast("date")) / (window_days + 1))
    sides = prefix.join(words, "node").select("ticker", "token", "node", "day", "size", "place", "tokens")
    left = sides.select("ticker", "token", F.coalesce(bin_, F.lit(-1)).alias("bin"), *[F.col(c).alias(f"{c}_a") for c in ("node", "day", "size", "place", "tokens")])
    right = sides.select("ticker", "token", F.explode(F.when(F.col("day").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(F.array(bin_, bin_ + 1))).alias("bin"), *[F.col(c).alias(f"{c}_b") for c in ("node", "day", "size", "place", "tokens")])
    near = (F.col("day_a").isNull() & F.col("day_b").isNull()) | (F.abs(F.datediff("day_a", "day_b")) <= window_days)
    # what sizes and places leave for words in common must be enough; only then are the words themselves compared, in the same task
    enough = F.ceil((F.col("size_a") + F.col("size_b")) * (least / (1 + least)) - 1e-9)
    room = F.least("place_a", "place_b") + F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    pairs = left.join(right, ["ticker", "token", "bin"]).where((F.col("node_a") != F.col("node_b")) & near & (F.least("size_a", "size_b") >= least * F.greatest("size_a", "size_b") - 1e-9) & (room >= enough))
    alike = pairs.where(jaccard(F.col("tokens_a"), F.col("tokens_b")) >= least).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    return links.unionByName(twins).unionByName(alike).distinct()


def cluster_events(articles: DataFrame, window_days: int = 10, least: float = 0.45, rare_ratio: float = 0.7) -> DataFrame:
    """(ticker, article_id, event_key, position, members): every article of every ticker with its event.

    The event is named after its earliest member (undated last, then by id); position 1 is that member.
    """
    return clustered(cut(prepared(articles)), window_days, least, rare_ratio).drop("tokens")


def clustered(rows: DataFrame, window_days: int = 10, least: float = 0.45, rare_ratio: float = 0.7) -> DataFrame:
    """``cluster_events`` for written ``prepared`` rows, with their tokens."""
    parts = components(event_edges(rows, window_days, least, rare_ratio))
    known = cut(rows.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")))
    # an event may hold any share of the rows, so they are ordered day by day, and the days by their counts
    days = known.groupBy("component", "day").agg(F.count(F.lit(1)).alias("n"), F.min("article_id").alias("first"))
    w = Window.partitionBy("component").orderBy(F.col("day").asc_nulls_last())
    days = days.withColumn("before", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    days = days.withColumns({"head": F.first("first").over(w), "members": F.sum("n").over(Window.partitionBy("component"))})
    inside = F.row_number().over(Window.partitionBy("component", "day").orderBy("article_id"))
    d = F.coalesce("day", F.lit("9999-12-31").cast("date"))
    ranked = known.withColumn("inside", inside).withColumn("d", d).join(days.withColumn("d", d).select("component", "d", "before", "head", "members"), ["component", "d"])
    return ranked.select("ticker", "article_id", F.concat_ws(":", "ticker", "head").alias("event_key"), (F.col("before") + F.col("inside")).alias("position"), "members", "tokens")


def same_event(tokens_a, tokens_b, rare_tokens, least: float = 0.45):
    """Column: similar enough, or a token in common that is among the distinctive ones of the corpus."""
    common = F.array_intersect(tokens_a, tokens_b)
    return (jaccard(tokens_a, tokens_b) >= least) | (F.size(F.array_intersect(common, rare_tokens)) > 0)


def distinctive_tokens(frequency: DataFrame) -> DataFrame:
    """(ticker, distinctive): tokens of five characters and more in at least two and at most max(2, a tenth) of the titles."""
    good = frequency.where((F.length("token") >= 5) & (F.col("df") >= 2) & (F.col("df") <= F.greatest(F.lit(2.0), F.col("n") * 0.1)))
    return good.groupBy("ticker").agg(F.collect_set("token").alias("distinctive"))


def inherit(members: DataFrame, judged: DataFrame, verdicts: tuple[str, ...] = ("sentiment",)) -> DataFrame:
    """(article_id, ticker, source_id, verdicts...): what unjudged members of an event take over.

    ``members`` is the result of ``clustered`` with ``distinctive``; ``judged`` has
    (article_id, verdicts...), the first of which is never null there.  Each verdict is
    that of the event's earliest judged member that has it, and only a member that is the
    same event as some judged member takes any.  Rows that take none remain to be scored.
    """
    rows = members.join(judged, "article_id", "left")
    known = rows.where(F.col(verdicts[0]).isNotNull())
    first = known.groupBy("event_key").agg(F.min_by("article_id", "position").alias("source_id"), *[F.min_by(v, F.when(F.col(v).isNotNull(), F.col("position"))).alias(f"_{v}") for v in verdicts])
    pending = rows.where(F.col(verdicts[0]).isNull()).drop(*verdicts).join(first, "event_key")
    # a distinctive token in common: one row for each token of an event's judged titles
    rare = F.array_intersect("tokens", F.coalesce("distinctive", F.array()))
    judged_tokens = known.select("event_key", F.explode(rare).alias("token")).distinct()
    by_token = pending.select("ticker", "article_id", "event_key", F.explode(rare).alias("token")).join(judged_tokens, ["event_key", "token"], "left_semi").select("ticker", "article_id")
    # similar titles share one of their first tokens in any fixed order, if that many are taken
    some = F.slice(F.array_sort("tokens"), F.lit(1), F.size("tokens") - F.ceil(F.size("tokens") * 0.45 - 1e-9).cast("int") + 1)
    left = pending.where("size(tokens) > 0").select("ticker", "article_id", "event_key", "tokens", F.explode(some).alias("token"))
    right = known.where("size(tokens) > 0").select("event_key", F.col("tokens").alias("others"), F.explode(some).alias("token")).distinct()
    alike = left.join(right, ["event_key", "token"]).where(jaccard(F.col("tokens"), F.col("others")) >= 0.45).select("ticker", "article_id")
    proof = by_token.unionByName(alike).distinct()
    return pending.join(proof, ["ticker", "article_id"]).select("article_id", "ticker", "source_id", *[F.col(f"_{v}").alias(v) for v in verdicts])


def remaining(candidates: DataFrame, inherited: DataFrame) -> DataFrame:
    """The candidates that took over no verdict and are to be scored."""
    return candidates.join(inherited.select("article_id").distinct(), "article_id", "left_anti")
