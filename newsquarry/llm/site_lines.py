"""Lines repeated across one site's documents.

The texts are read once; what is kept of a document are the hashes of its lines.
First pass: each task keeps one mergeable heavy-hitter summary (Misra-Gries)
per site, sized so that its error stays below half of the threshold; summaries
are added up.  Second pass: the candidates are counted exactly, by distinct
document.  Confirmed lines are removed with broadcast sets.  A site whose
summed error reaches the threshold has all its lines counted exactly instead,
so no repeated line is missed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquarry.session import cut

_DROP = re.compile(r"[\s\d]+")
#: Candidates up to which they are broadcast (16 bytes each and the site's name); beyond, they are joined by shuffle.
MAX_CANDIDATES = 300_000
#: What is kept of a document besides its key: its site, and the numbers and keys of its non-blank lines.
TABLE = T.StructType([T.StructField("site", T.StringType()), T.StructField("numbers", T.ArrayType(T.IntegerType())), T.StructField("keys", T.ArrayType(T.LongType()))])
#: Entries all summaries of a task may hold before they are cut down.
TASK_ENTRIES = 400_000


def line_key(line: str) -> int:
    """Hash of the line without case, spacing and digits, as a signed 64-bit number."""
    h = xxhash.xxh3_64_intdigest(_DROP.sub("", line.lower()))
    return h - (1 << 64) if h >= 1 << 63 else h


def keyed_lines(body: str) -> list[tuple[int, int]]:
    """(line_no, key) of every non-blank line."""
    return [(i, line_key(x)) for i, x in enumerate(body.split("\n")) if x and not x.isspace()]


def site_of(domain: Column) -> Column:
    """The site: the domain in lower case without a leading ``www.``; null where blank."""
    d = F.regexp_replace(F.lower(F.trim(domain)), r"^www\.", "")
    return F.when(F.length(d) > 0, d)


class Summary:
    """Misra-Gries summary of a stream of keys; ``error`` bounds how much any count is too low."""

    def __init__(self):
        self.counts: dict[int, int] = {}
        self.rows = self.lines = self.error = 0

    def add(self, keys: set[int]) -> None:
        self.rows += 1
        self.lines += len(keys)
        c = self.counts
        for k in keys:
            c[k] = c.get(k, 0) + 1

    def size(self, min_share: float) -> int:
        """Counters with which the error stays below half of ``min_share`` of the rows."""
        return max(64, int(2 * self.lines / max(1, self.rows) / min_share) + 1)

    def shrink(self, k: int) -> None:
        """Keeps at most ``k`` counters: subtracts the largest count left out from all."""
        if len(self.counts) > k:
            cut_ = sorted(self.counts.values(), reverse=True)[k]
            self.counts = {x: n - cut_ for x, n in self.counts.items() if n > cut_}
            self.error += cut_


def line_table(df: DataFrame, key: str, domain: str, body: str) -> DataFrame:
    """(k, site, numbers, keys) of every row with a key, a site and a non-blank body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keyed = [keyed_lines(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([[i for i, _ in x] for x in keyed], pa.list_(pa.int32())), pa.array([[h for _, h in x] for x in keyed], pa.list_(pa.int64()))], ["k", *TABLE.names])

    rows = df.select(F.col(key).alias("k"), site_of(F.col(domain)).alias("site"), F.col(body).alias("b")).where(F.col("k").isNotNull() & F.col("site").isNotNull() & F.col("b").rlike(r"\S"))
    return rows.mapInArrow(run, T.StructType([T.StructField("k", df.schema[key].dataType), *TABLE.fields]))


def repeated_lines(df: DataFrame, key: str, domain: str, body: str, min_docs: int = 4, min_share: float = 0.05) -> DataFrame:
    """(key, site, line_no, line_key, docs) of every non-blank line repeated within its site.

    A line is repeated if at least ``min_docs`` documents and at least ``min_share`` of
    the site's documents hold it; documents are distinct keys with a domain and a
    non-blank body.  Rows with a null key, a null or blank domain, or a null or blank
    body play no part; repeated rows count once.
    """
    return confirmed_lines(cut(line_table(df, key, domain, body)), min_docs, min_share).withColumnRenamed("k", key)


def confirmed_lines(table: DataFrame, min_docs: int = 4, min_share: float = 0.05) -> DataFrame:
    """(k, site, line_no, line_key, docs) of the repeated lines of a written ``table`` (k, site, numbers, keys)."""
    sizes = table.select("site", "k").distinct().groupBy("site").agg(F.count(F.lit(1)).alias("n"))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sites: dict[str, Summary] = {}
        held = 0
        for batch in batches:
            for site, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = sites.setdefault(site, Summary())
                before = len(s.counts)
                s.add(set(keys))
                held += len(s.counts) - before
                if held > TASK_ENTRIES:
                    for t in sites.values():
                        t.shrink(t.size(min_share))
                    held = sum(len(t.counts) for t in sites.values())
                    if held > TASK_ENTRIES // 2:  # very many sites: what there is goes out, the rest starts anew
                        yield _summaries(sites, min_share)
                        sites, held = {}, 0
        yield _summaries(sites, min_share)

    parts = table.select("site", "keys").mapInArrow(summarise, "site string, line_key long, docs long, error long")
    merged = cut(parts.groupBy("site", "line_key").agg(F.sum("docs").alias("docs"), F.sum("error").alias("error")))
    errors = merged.where("error > 0").groupBy("site").agg(F.sum("error").alias("site_error"))
    limits = sizes.join(errors, "site", "left").select("site", "n", F.coalesce("site_error", F.lit(0)).alias("site_error"), F.greatest(F.lit(min_docs), F.ceil(F.col("n") * min_share - 1e-9)).alias("least"))
    limits = cut(limits.where("n >= least"))
    candidates = cut(merged.where("line_key IS NOT NULL").join(limits.where("site_error < least"), "site").where("docs + site_error >= least").select("site", "line_key"))
    lines = table.select("k", "site", F.explode(F.arrays_zip("numbers", "keys")).alias("x")).select("k", "site", F.col("x.numbers").alias("line_no"), F.col("x.keys").alias("line_key"))
    small = candidates.limit(MAX_CANDIDATES + 1).count() <= MAX_CANDIDATES
    found = lines.join(F.broadcast(candidates) if small else candidates, ["site", "line_key"], "left_semi")
    whole = limits.where("site_error >= least").select("site")
    if not whole.isEmpty():
        found = found.unionByName(lines.join(whole, "site", "left_semi"))
    found = cut(found.select("k", "site", "line_no", "line_key").distinct())
    counts = found.select("site", "line_key", "k").distinct().groupBy("site", "line_key").agg(F.count(F.lit(1)).alias("docs"))
    confirmed = counts.join(limits.select("site", "least"), "site").where("docs >= least").select("site", "line_key", "docs")
    return found.join(confirmed, ["site", "line_key"]).select("k", "site", "line_no", "line_key", "docs")


def _summaries(sites: dict[str, Summary], min_share: float) -> pa.RecordBatch:
    """The counters of all sites, and for each site a row without key that carries its error."""
    out: tuple[list, list, list, list] = ([], [], [], [])
    for site, s in sites.items():
        s.shrink(s.size(min_share))
        for k, n in s.counts.items():
            for column, value in zip(out, (site, k, n, 0)):
                column.append(value)
        for column, value in zip(out, (site, None, 0, s.error)):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), *(pa.array(x, pa.int64()) for x in out[1:])], ["site", "line_key", "docs", "error"])


def without_lines(df: DataFrame, key: str, body: str, found: DataFrame) -> DataFrame:
    """``df`` with the lines of ``found`` (key, line_no) taken out of each body; other rows are unchanged."""
    numbers = found.select(F.col(key).alias("_k"), "line_no").distinct().groupBy("_k").agg(F.collect_set("line_no").alias("_drop"))
    lines = F.split(F.col(body), "\n")
    kept = F.filter(lines, lambda x, i: ~F.array_contains(F.col("_drop"), i))
    return df.join(numbers, F.col(key) == F.col("_k"), "left").withColumn(body, F.when(F.col("_drop").isNull(), F.col(body)).otherwise(F.array_join(kept, "\n"))).drop("_k", "_drop")
