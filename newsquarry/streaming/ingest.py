"""Structured Streaming: keyed deduplication and merging, windowed counts, draining a queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsquarry.session import scratch
from newsquarry.sources.versions import Versions


def stream_of(spark: SparkSession, path: str, files_per_batch: int | None = 16) -> DataFrame:
    """The parquet files below ``path`` as a stream with the schema they have now; all in one batch without ``files_per_batch``."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    whole = path.rstrip("/")
    folder, name = whole.rsplit("/", 1)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(whole)
    if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(fs_path).isFile():
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(whole)


def drain(df: DataFrame, mode: str = "append") -> DataFrame:
    """Runs the stream over all there is and gives what it wrote, as a table in the shared folder."""
    spark = df.sparkSession
    at = scratch(spark, "stream")
    writer = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{at}/state")
    writer.format("parquet").start(f"{at}/rows").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{at}/rows")


def first_arrivals(stream: DataFrame, keys: list[str], at: str, store: str, buckets: int = 64) -> DataFrame:
    """The first row of every key of the stream, however late it comes, as the table it is written to.

    A micro-batch keeps the earliest row of each of its keys and takes those that no
    earlier batch has.  Keys lie in ``buckets`` by their hash, and only the key columns of
    the buckets a batch touches are read.  A batch's rows are written under its number, so
    a batch that is repeated after a failure replaces what it wrote.  Null keys count as one key.
    """
    spark = stream.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def batch(rows: DataFrame, number: int) -> None:
        first = rows.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rows.columns if c not in keys]), F.struct(F.col(at).isNull(), at)).alias("_row"))
        fresh = first.select(*keys, "_row.*").select(*rows.columns).withColumn("_bucket", bucket)
        before = [n for n in _batches(spark, store) if n < number]
        if before:
            touched = [r[0] for r in fresh.select("_bucket").distinct().collect()]  # at most ``buckets``
            known = spark.read.option("basePath", f"{store}/rows").parquet(*[f"{store}/rows/_batch={n}" for n in before]).where(F.col("_bucket").isin(touched)).select("_bucket", *keys)
            same = F.lit(True)
            for k in ["_bucket", *keys]:
                same = same & fresh[k].eqNullSafe(known[k])
            fresh = fresh.join(known, same, "left_anti")
        fresh.write.mode("overwrite").partitionBy("_bucket").parquet(f"{store}/rows/_batch={number}")

    stream.writeStream.foreachBatch(batch).trigger(availableNow=True).option("checkpointLocation", f"{store}/_state").start().awaitTermination()
    parts = [f"{store}/rows/_batch={n}" for n in _batches(spark, store)]
    if not parts:
        return spark.createDataFrame([], stream.schema)
    return spark.read.option("basePath", f"{store}/rows").parquet(*parts).select(*stream.columns)


def _batches(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the batches that were written whole."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(store).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(Path(f"{store}/rows")):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(Path(f"{store}/rows"))]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("_batch=") and fs.exists(Path(f"{store}/rows/{n}/_SUCCESS")))


def windowed_counts(stream: DataFrame, at: str, width: str, lateness: str, by: list[str], slide: str | None = None) -> DataFrame:
    """(start, by..., n): rows by event-time window; a window goes out once no row can come late for it.

    Rows that come later than ``lateness`` after a row of an earlier batch are left out, so over files
    that are not in order of time take them all in one batch.
    """
    w = F.window(at, width, slide) if slide else F.window(at, width)
    counts = stream.withWatermark(at, lateness).groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("start"), *by, "n")


def merge_stream(stream: DataFrame, store: str, keys: list[str], merge, buckets: int = 64) -> None:
    """Merges every micro-batch into the table ``store`` with ``merge(old_and_new)``, which must take rows of one key together.

    The table lies in ``buckets`` by the hash of ``keys``; a batch reads and writes only
    the buckets it touches.  Which folder holds each bucket stands in the version's marker
    beside the batch's number, so readers see a batch whole or not at all and a batch that
    is repeated after a failure changes nothing twice.
    """
    spark = stream.sparkSession
    versions = Versions(spark, store)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def batch(rows: DataFrame, number: int) -> None:
        last = versions.last()
        before, known = last if last else (0, {"batch": -1, "buckets": {}})
        if number <= known["batch"]:
            return
        new = rows.withColumn("_bucket", bucket)
        touched = [str(r[0]) for r in new.select("_bucket").distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        old = [f"{store}/{known['buckets'][b]}/_bucket={b}" for b in touched if b in known["buckets"]]
        whole = rows if not old else spark.read.parquet(*old).unionByName(rows, allowMissingColumns=True)
        name = versions.stage()
        merge(whole).withColumn("_bucket", bucket).write.partitionBy("_bucket").parquet(f"{store}/{name}")
        versions.publish(before, {"batch": number, "buckets": known["buckets"] | dict.fromkeys(touched, name)})

    stream.writeStream.foreachBatch(batch).trigger(availableNow=True).option("checkpointLocation", f"{store}/_state").start().awaitTermination()


def merged_table(spark: SparkSession, store: str) -> DataFrame:
    """The newest version that merge_stream published."""
    last = Versions(spark, store).last()
    if last is None:
        raise FileNotFoundError(store)
    return spark.read.parquet(*[f"{store}/{name}/_bucket={b}" for b, name in sorted(last[1]["buckets"].items())])
