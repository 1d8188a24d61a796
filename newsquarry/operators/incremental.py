"""Processing only new or changed records, with hash trees over key ranges.

Keys are hashed into equal ranges, the leaves of a tree; a record's entry is a
hash of what counts as a change, a leaf's digest is a sum of its entries' hashes
and a node's digest the sum over its children, so digests of parts can be added
in any order.  Saved digests are compared with the current ones from the root
down; only differing nodes are opened, and only entries of differing leaves are
compared one by one.  Output and tree are then published together.

``ChangeStore`` keeps the tree of one consumer from run to run.  ``due_records``
does the same for all consumers of a log at once: from the log it saves the tree
of every consumer's last success, and the run knows nothing but saved and
current hashes.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquarry.functions.dates import instant
from newsquarry.session import cut, scratch
from newsquarry.sources.versions import Versions

#: Each node has 16 children.
FANOUT_BITS = 4
#: Levels of the tree: as many as leave about LEAF_KEYS keys to a leaf, within these bounds.
MIN_LEVELS, MAX_LEVELS = 2, 7
LEAF_KEYS = 256
#: Consumers compared at a time; their marks are held by the driver.  More are taken in several rounds.
MAX_CONSUMERS = 1000
#: Versions that the entries of a store may be spread over before they are written together again.
MAX_SPREAD = 16
DIGEST = ("d0", "d1", "d2")
_DIFFERS = "d0 != sd0 OR d1 != sd1 OR d2 != sd2"


def levels_for(keys: int) -> int:
    """Levels of a tree over so many keys."""
    return min(MAX_LEVELS, max(MIN_LEVELS, math.ceil(math.log(max(1, keys) / LEAF_KEYS, 1 << FANOUT_BITS))))


def leaf_of(key: Column, levels: int) -> Column:
    """Number of the key range that holds ``key``."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - FANOUT_BITS * levels).cast("int")


def _digest(*columns: Column) -> list[Column]:
    """Three sums that together stand for a multiset of records; none can overflow below 4e9 records a node."""
    h = F.xxhash64(*columns)
    return [
        F.count(F.lit(1)).alias("d0"),
        F.sum(F.shiftrightunsigned(h, 33)).alias("d1"),
        F.sum(h.bitwiseAND(F.lit((1 << 31) - 1))).alias("d2"),
    ]


def last_success(log: DataFrame, key: str = "state_key", value: str = "value", written: str = "updated_at") -> DataFrame:
    """(key, mark) for every consumer of ``log``: the instant its latest successful run wrote.

    A run succeeded if its value is an instant and nothing else.  The latest is the
    one written last, of several written at once the one with the latest instant.
    A consumer that never succeeded has a null mark; null keys are left out.
    """
    mark = instant(F.col(value))
    order = F.when(mark.isNotNull(), F.struct(F.coalesce(instant(F.col(written).cast("string")), F.timestamp_seconds(F.lit(-62135596800))), mark))
    return log.where(F.col(key).isNotNull()).groupBy(F.col(key)).agg(F.max_by(mark, order).alias("mark"))


def due_records(records: DataFrame, log: DataFrame, key: str, instants: list[str], consumer: str = "state_key", levels: int | None = None) -> DataFrame:
    """(consumer, key) for every record changed at or after the consumer's mark, each once.

    A record's change is the latest of ``instants`` over all its rows.  The tree saved for
    a mark holds the records as they were before it: those changed earlier.  Consumers
    without a mark have an empty tree, so every record is due, also one without instants;
    for the others records without a readable instant are never due.  Null keys are left
    out; an empty table gives an empty result.
    """
    spark = records.sparkSession
    changed = F.greatest(*[instant(F.col(c)) for c in instants]) if len(instants) > 1 else instant(F.col(instants[0]))
    # the records are read once: trees and output are of the same state of the table
    state = cut(records.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(changed).alias("at")))
    depth = levels or levels_for(state.count())
    marks = cut(last_success(log, consumer).select(F.col(consumer).alias("consumer"), "mark"))
    chunks = max(1, -(-marks.count() // MAX_CONSUMERS))
    folder = scratch(spark, "trees")
    out = None
    for n in range(chunks):
        part = marks if chunks == 1 else marks.where(F.pmod(F.xxhash64("consumer"), F.lit(chunks)) == n)
        found = part.collect()
        steps = sorted({m.mark for m in found if m.mark is not None})
        saved = save_trees(state, steps, f"{folder}/{n}", depth)
        known = {s: i for i, s in enumerate(steps)}
        schema = T.StructType([T.StructField("consumer", marks.schema["consumer"].dataType), T.StructField("step", T.IntegerType())])
        runs = spark.createDataFrame([(m.consumer, known.get(m.mark, -1)) for m in found], schema)
        due = run_consumers(state.select("k", _entry().alias("h")), runs, saved, depth)
        out = due if out is None else out.unionByName(due)
    versions = Versions(spark, folder)
    name = versions.stage()
    out.write.parquet(f"{folder}/{name}/output")
    versions.publish(0, {"data": name, "trees": [str(n) for n in range(chunks)]})
    return spark.read.parquet(f"{folder}/{name}/output").select(F.col("consumer").alias(consumer), F.col("k").alias(key))


def _entry() -> Column:
    return F.xxhash64("k", "at")


def save_trees(state: DataFrame, steps: list, folder: str, levels: int) -> tuple[DataFrame, DataFrame]:
    """(entries, trees) as they were at each of ``steps``, written below ``folder``.

    An entry (k, h, since) belongs to the trees of all steps from ``since`` on, so a record
    is written once however many consumers there are; trees are (leaf, since, digest) of
    the entries that came with that step, and the tree of a step is the sum up to it.
    """
    since = F.lit(None).cast("int")
    if steps:
        # the first step that lies after the record's change; none for records no tree holds
        later = F.filter(F.array(*[F.struct(F.lit(s).alias("s"), F.lit(i).alias("i")) for i, s in enumerate(steps)]), lambda x: x["s"] > F.col("at"))
        since = F.when(F.col("at").isNotNull(), F.get(F.transform(later, lambda x: x["i"]), 0)).otherwise(F.lit(0))
    entries = state.select("k", _entry().alias("h"), since.alias("since"), leaf_of(F.col("k"), levels).alias("leaf")).where("since IS NOT NULL")
    entries.write.parquet(f"{folder}/entries")
    entries = state.sparkSession.read.parquet(f"{folder}/entries")
    entries.groupBy("leaf", "since").agg(*_digest(F.col("k"), F.col("h"))).write.parquet(f"{folder}/tree")
    return entries.select("k", "h", "since"), state.sparkSession.read.parquet(f"{folder}/tree")


def run_consumers(current: DataFrame, runs: DataFrame, saved: tuple[DataFrame, DataFrame], levels: int) -> DataFrame:
    """(consumer, k) of the records of ``current`` (k, h) that the consumer's saved tree lacks or has otherwise.

    ``runs`` has (consumer, step), -1 for an empty tree.  Trees are compared from the root
    down for all consumers at once; entries only in the leaves that are open in the end.
    """
    entries, trees = saved
    current = current.withColumn("leaf", leaf_of(F.col("k"), levels))
    now = current.groupBy("leaf").agg(*_digest(F.col("k"), F.col("h")))
    parts = cut(now.withColumn("since", F.lit(None).cast("int")).unionByName(trees))  # a null step marks the current tree
    open_ = runs.withColumn("node", F.lit(0))
    for level in range(levels + 1):
        here = parts.groupBy(F.shiftright("leaf", FANOUT_BITS * (levels - level)).alias("node"), "since").agg(*[F.sum(d).alias(d) for d in DIGEST])
        both = open_.join(here, "node").groupBy("consumer", "step", "node")
        old = F.col("since") <= F.col("step")
        sums = both.agg(*[F.coalesce(F.sum(F.when(F.col("since").isNull(), F.col(d))), F.lit(0)).alias(d) for d in DIGEST], *[F.coalesce(F.sum(F.when(old, F.col(d))), F.lit(0)).alias("s" + d) for d in DIGEST])
        open_ = sums.where(_DIFFERS).select("consumer", "step", "node")
        if level < levels:
            width = 1 << FANOUT_BITS
            open_ = open_.select("consumer", "step", F.explode(F.sequence(F.col("node") * width, F.col("node") * width + width - 1)).alias("node"))
    compared = current.join(entries.withColumnRenamed("h", "old"), "k", "left")
    missing = F.col("old").isNull() | (F.col("old") != F.col("h")) | (F.col("since") > F.col("step"))
    return compared.join(open_.withColumnRenamed("node", "leaf"), "leaf").where(missing).select("consumer", "k")


def descend(tree: DataFrame, levels: int) -> DataFrame:
    """(leaf) under which current (d*) and saved (sd*) digests of ``tree`` differ; below a node whose digests agree nothing is looked at."""
    sums = [F.sum(d).alias(d) for d in (*DIGEST, *("s" + d for d in DIGEST))]
    open_ = None
    for level in range(levels + 1):
        node = F.shiftright("leaf", FANOUT_BITS * (levels - level))
        rows = tree.withColumn("node", node)
        if open_ is not None:
            rows = rows.join(open_.select(F.col("node").alias("parent")), F.shiftright("node", FANOUT_BITS) == F.col("parent"), "left_semi")
        open_ = rows.groupBy("node").agg(*sums).where(_DIFFERS).select("node")
    return open_.withColumnRenamed("node", "leaf")


class ChangeStore:
    """The saved tree of one consumer in a folder, from run to run.

    ``run`` extracts the changed records, hands them to the caller, and publishes their
    output and the new tree by one marker.  A run that fails before leaves nothing that a
    later run reads; of two runs that start from the same version the second raises
    PublishedElsewhere.  The depth is chosen by the number of keys of the first run and is
    chosen anew, with all entries, when the keys have grown sixteenfold.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, columns: list[str], levels: int | None = None):
        self.spark, self.folder, self.key, self.columns, self.levels = spark, folder.rstrip("/"), key, columns, levels
        self.store = Versions(spark, folder)

    def versions(self) -> list[int]:
        return self.store.numbers()

    def output(self, version: int | None = None) -> str:
        """The folder that holds the output of the newest version, or of the given one as far back as the store goes."""
        number, contents = self.store.last()
        return f"{self.folder}/{contents['outputs'][str(version or number)]}/output"

    def _hash(self) -> Column:
        return F.xxhash64(*[F.col(c) for c in [self.key, *self.columns]])

    def run(self, records: DataFrame, write) -> int:
        """Calls ``write(changed_rows, folder)`` for the rows of new and changed keys; returns the new version.

        Removed keys change the tree but give no rows.  Without any change no version is made and the last is returned.
        What was seen of ``records`` is written first, as hashes: output, entries and tree are
        all of that state, and a row that arrives meanwhile is left to the next run.
        """
        last = self.store.last()
        number, known = last if last else (0, None)
        seen = cut(records.where(F.col(self.key).isNotNull()).select(F.col(self.key).alias("k"), self._hash().alias("row")).distinct())
        # one entry a key, which any changed row of the key changes
        entries = cut(seen.groupBy("k").agg(F.bit_xor("row").alias("h")))
        count = entries.count()
        levels = self.levels or levels_for(count)
        if known and (self.levels or known["levels"] == levels or count < (LEAF_KEYS << FANOUT_BITS * known["levels"]) << FANOUT_BITS):
            levels = known["levels"]
        entries = entries.withColumn("leaf", leaf_of(F.col("k"), levels))
        current = cut(entries.groupBy("leaf").agg(*_digest(F.col("k"), F.col("h"))))
        name = self.store.stage()
        whole = known is None or known["levels"] != levels  # every leaf is written
        if known is None:
            leaves, saved, old_tree = current.select("leaf"), None, None
        else:
            old_tree = self.spark.read.parquet(f"{self.folder}/{known['data']}/tree")
            old = old_tree.select("leaf", *[F.col(d).alias("s" + d) for d in DIGEST])
            if whole:
                leaves, sources = current.select("leaf"), old_tree.select("source").distinct()
                saved = self._saved(sources, None)
            else:
                both = current.join(old, "leaf", "full").fillna(0, [*DIGEST, *("s" + d for d in DIGEST)])
                leaves = cut(descend(both, levels))
                if leaves.isEmpty():
                    return number
                held = old_tree.join(leaves, "leaf", "left_semi").select("leaf", "source")
                saved = self._saved(held.select("source").distinct(), held)
        opened = entries if whole else entries.join(leaves, "leaf", "left_semi")
        changed = opened.select("k") if saved is None else opened.join(saved, "k", "left").where("old_h IS NULL OR old_h <> h").select("k")
        rows = seen.join(changed, "k", "left_semi")
        new = records.withColumn("_row", self._hash())
        write(new.join(rows, (new[self.key] == rows["k"]) & (new["_row"] == rows["row"]), "left_semi").drop("_row"), f"{self.folder}/{name}/output")
        fresh = current.join(leaves, "leaf", "left_semi").withColumn("source", F.lit(name))
        if old_tree is not None and not whole:
            kept = old_tree.join(leaves, "leaf", "left_anti")
            if kept.select("source").distinct().count() >= MAX_SPREAD:  # the entries lie in too many folders: all are written anew
                opened, fresh = entries, current.withColumn("source", F.lit(name))
            else:
                fresh = fresh.unionByName(kept)
        opened.repartitionByRange("leaf").sortWithinPartitions("leaf").write.parquet(f"{self.folder}/{name}/entries")
        fresh.write.parquet(f"{self.folder}/{name}/tree")
        outputs = (known["outputs"] if known else {}) | {str(number + 1): name}
        return self.store.publish(number, {"data": name, "levels": levels, "outputs": outputs})

    def _saved(self, sources: DataFrame, held: DataFrame | None) -> DataFrame | None:
        """(k, old_h) of the saved entries: those of the leaves ``held`` in the folder that holds each, or all that are in force."""
        names = sorted(r[0] for r in sources.collect())  # at most MAX_SPREAD
        if not names:
            return None
        tree = held
        if tree is None:
            tree = self.spark.read.parquet(f"{self.folder}/{self.store.last()[1]['data']}/tree").select("leaf", "source")
        parts = None
        for name in names:
            part = self.spark.read.parquet(f"{self.folder}/{name}/entries").withColumn("source", F.lit(name))
            parts = part if parts is None else parts.unionByName(part)
        return parts.join(tree, ["leaf", "source"], "left_semi").select("k", F.col("h").alias("old_h"))
