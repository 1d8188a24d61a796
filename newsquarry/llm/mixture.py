"""Mixing sources to target weights.

A source's weight is its share of tokens times (target share / share of tokens)
to a power: 1 gives the targets, 0 the shares as they are; without targets the
share itself is exponentiated, 1 as it is and 0 all alike.  The power is the
largest that meets the limits of repetition, or an entropy.  The weights are then
realised: whole passes over a source, and for the rest of its budget blocks of
a hash permutation up to the block in which the budget ends.
"""

from __future__ import annotations

import base64
import math
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquarry.session import cut, held_once

#: A rank file of a public tokenizer, and the pattern that splits text before its merges.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Sources whose weights the driver works out.  A mixture of more is refused.
MAX_SOURCES = 100_000
#: Documents a block of the permutation, on average.
BLOCK = 1_000


#: Bytes up to which a rank file is sent to the workers; a larger one is refused.
MAX_RANK_BYTES = 64 << 20


def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def with_tokens(df: DataFrame, text: str, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """``df`` without ``text`` but with ``n_tokens``, the tokens of the whole text; null and empty texts have none.

    The rank file is read by the driver and sent with the job, so workers need no copy of it.
    """
    if os.path.getsize(ranks) > MAX_RANK_BYTES:
        raise ValueError(f"{ranks} is larger than {MAX_RANK_BYTES} bytes")
    with open(ranks, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())
    mark = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = held_once(mark, lambda: _encoding(sent.value, pattern))
        for b in batches:
            at = b.schema.names.index(text)
            n = pa.array([len(encoding.encode_ordinary(t)) if t else 0 for t in b.column(at).to_pylist()], pa.int64())
            keep = [i for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), n], [*(b.schema.names[i] for i in keep), "n_tokens"])

    schema = T.StructType([f for f in df.schema if f.name != text] + [T.StructField("n_tokens", T.LongType())])
    return df.mapInArrow(run, schema)


def entropy(weights: dict) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def tempered(tokens: dict, power: float, targets: dict | None = None) -> dict:
    """Normalised weights of the sources that have tokens (and a target above 0, if there are targets)."""
    live = {s: n for s, n in tokens.items() if n > 0 and (targets is None or targets.get(s, 0) > 0)}
    whole = sum(live.values())
    raw = {s: (n / whole) ** power if targets is None else (n / whole) * (targets[s] / (n / whole)) ** power for s, n in live.items()}
    total = sum(raw.values())
    return {s: x / total for s, x in raw.items()}


def most_tokens(weights: dict, tokens: dict, limits: dict) -> float:
    """The largest total at which no source is repeated more than its limit."""
    return min((tokens[s] * limits[s] / w for s, w in weights.items() if w > 0), default=0.0)


def bisect_power(meets, low: float = 0.0, high: float = 1.0, steps: int = 60) -> float:
    """The largest power in [low, high] that ``meets``, if the powers that do are those below it."""
    if meets(high):
        return high
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if meets(mid) else (low, mid)
    return low


def largest_power(tokens: dict, targets: dict | None, limits: dict, total: float) -> float | None:
    """The largest power in [0, 1] at which no source has to be repeated more than its limit for ``total``, None if there is none.

    A source's own bound on the total may fall or rise with the power: one whose share is
    above its target is asked for more as the power falls.  But its logarithm is convex, so
    a source that breaks at a power and not at 0 does so above one point only, and one that
    breaks at both breaks everywhere between them.
    """
    base = tempered(tokens, 0.0 if targets is not None else 1.0, targets)
    if not base or total <= 0:
        return 1.0
    share = np.array(list(base.values()))
    step = np.log(share if targets is None else np.array([targets[s] for s in base]) / share)
    start = np.zeros(len(share)) if targets is None else np.log(share)
    most = np.array([tokens[s] * limits[s] for s in base], float)
    if (most <= 0).any():
        return None
    room = np.log(most) - math.log(total)

    def slack(power: float) -> np.ndarray:
        raw = start + power * step
        top = raw.max()
        return room - raw + top + math.log(np.exp(raw - top).sum())

    # a hair of room for rounding: at power 0 a bound may be met exactly
    power, at_zero = 1.0, slack(0.0) + 1e-12
    while (now := slack(power)).min() < -1e-12:
        worst = int(now.argmin())
        if at_zero[worst] < 0 or power == 0:
            return None
        low, high = 0.0, power
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if slack(mid)[worst] >= 1e-12 else (low, mid)
        power = low
    return power


def power_of(tokens: dict, targets: dict | None, limits: dict, total: float | None = None, target_entropy: float | None = None) -> float:
    """The power that ``plan`` takes."""
    if target_entropy is not None:
        return bisect_power(lambda p: entropy(tempered(tokens, p, targets)) >= target_entropy)
    power = 1.0 if total is None else largest_power(tokens, targets, limits, total)
    return 1.0 if power is None else power


def plan(tokens: dict, targets: dict | None, limits: dict, total: float | None = None, target_entropy: float | None = None) -> tuple[dict, float]:
    """(weights, total tokens).

    Without ``total`` the targets are met exactly and the total is the largest the
    limits allow.  With one, the power is the largest up to 1 at which the limits hold;
    where there is none the targets are kept and the total is cut down to what the limits
    allow.  ``target_entropy``, for a mixture without targets, is met instead by a power
    between 0 and 1.
    """
    weights = tempered(tokens, power_of(tokens, targets, limits, total, target_entropy), targets)
    most = most_tokens(weights, tokens, limits)
    return weights, most if total is None else min(total, most)


def mix(docs: DataFrame, key: str, source: str, text: str, targets: DataFrame, ranks: str = RANKS, total: float | None = None, seed: int = 1, passes: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(uses, shares): uses (key, source, n_tokens, uses) with uses above 0, and shares (source, target_share,
    docs, tokens, used_docs, used_tokens, actual_share, most_uses, power), one row for each row of ``targets``.

    ``targets`` has (source, target_share, max_repeats).  A null source, a source without a
    target and a text without tokens are not used.  A listed source without tokens has an
    actual share of 0 and the others share its target in proportion.  Repeated rows of
    ``docs`` are one document.  ``passes`` gives the total as a multiple of the tokens of
    the sources that can be used; ``power`` is the power the targets were tempered with.
    """
    spark = docs.sparkSession
    goal = targets.select(F.col("source").alias("source"), F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats")).where("source IS NOT NULL")
    goal = goal.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    listed = goal.limit(MAX_SOURCES + 1).collect()
    if len(listed) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    some = docs.select(F.col(key).alias("k"), F.col(source).alias("source"), F.col(text).alias("t")).where(F.col("k").isNotNull())
    some = cut(with_tokens(some.join(goal.select("source"), "source", "left_semi").select("k", "source", "t"), "t", ranks).where("n_tokens > 0").dropDuplicates(["k"]))
    sizes = {r["source"]: r for r in some.groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("docs")).collect()}
    tokens = {s: r["n"] for s, r in sizes.items()}
    share = {r["source"]: r["target_share"] or 0.0 for r in listed}
    limit = {r["source"]: max(0, r["max_repeats"] if r["max_repeats"] is not None else 0) for r in listed}
    live = {s: n for s, n in tokens.items() if limit[s] > 0}
    if passes is not None:
        total = passes * sum(n for s, n in live.items() if share[s] > 0)
    power = power_of(live, share, limit, total)
    weights, amount = plan(live, share, limit, total)

    rows = []
    for s, w in weights.items():
        budget = w * amount
        whole = min(limit[s], int(budget / tokens[s] + 1e-9))
        rest = 0.0 if whole == limit[s] else budget - whole * tokens[s]
        rows.append((s, whole, rest, max(1, -(-sizes[s]["docs"] // BLOCK))))
    budgets = spark.createDataFrame(rows, "source string, whole int, rest double, blocks long")
    # a source may have most documents: its rows are spread over the blocks of its permutation
    at = F.xxhash64(F.lit(seed), F.col("k"))
    placed = some.join(budgets, "source").withColumn("at", at).withColumn("block", F.floor(F.shiftrightunsigned("at", 1) / F.lit(float(1 << 63)) * F.col("blocks")))
    per_block = placed.groupBy("source", "block").agg(F.sum("n_tokens").alias("n"))
    # blocks are a thousandth of the documents; a source's blocks are added up in order
    w = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = per_block.select("source", "block", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"), "n")
    placed = placed.join(before.withColumnRenamed("n", "in_block"), ["source", "block"])
    inside = Window.partitionBy("source", "block").orderBy("at", "k").rowsBetween(Window.unboundedPreceding, 0)
    # only the block in which the budget ends is put in order; half of a last document decides whether it is in
    edge = placed.where("before < rest AND before + in_block > rest").withColumn("upto", F.col("before") + F.sum("n_tokens").over(inside) - F.col("n_tokens") / 2)
    taken = edge.withColumn("extra", F.when(F.col("upto") <= F.col("rest"), 1).otherwise(0)).select("k", "source", "n_tokens", "whole", "extra")
    rest = placed.where("NOT (before < rest AND before + in_block > rest)").withColumn("extra", F.when(F.col("before") + F.col("in_block") <= F.col("rest"), 1).otherwise(0)).select("k", "source", "n_tokens", "whole", "extra")
    uses = cut(taken.unionByName(rest).select("k", "source", "n_tokens", (F.col("whole") + F.col("extra")).cast("int").alias("uses")).where("uses > 0"))

    used = uses.groupBy("source").agg(F.count(F.lit(1)).alias("used_docs"), F.sum(F.col("n_tokens") * F.col("uses")).alias("used_tokens"), F.max("uses").alias("most_uses"))
    have = some.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"))
    report = goal.join(have, "source", "left").join(used, "source", "left").na.fill(0, ["docs", "tokens", "used_docs", "used_tokens", "most_uses"])
    everything = used.agg(F.sum("used_tokens").alias("n")).first()["n"] or 0
    report = report.withColumn("actual_share", F.col("used_tokens") / F.lit(everything) if everything else F.lit(0.0))
    return uses.withColumnRenamed("k", key), report.select("source", "target_share", "max_repeats", "docs", "tokens", "used_docs", "used_tokens", "actual_share", "most_uses", F.lit(power).alias("power"))
