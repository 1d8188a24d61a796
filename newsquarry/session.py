"""Session helpers: table access and the shared folder in which lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def reach_workers(spark: SparkSession) -> None:
    """Puts this package's folder on the Python path of workers that start from now on, where they can see it."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([home, *paths])


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``root``."""
    reach_workers(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    It is read from ``spark.checkpoint.dir``.  Only where that is unset and the session
    runs on one machine, as in tests, a temporary folder is made and remembered.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    known = context._jsc.sc().getCheckpointDir()
    if not path:
        if known.isDefined():
            return known.get()
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="newsquarry-")
    if known.isEmpty():
        context.setCheckpointDir(path)
    return path


_scratch: dict[str, list[str]] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared folder, which ``clear_scratch`` deletes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Deletes the folders this session made with ``scratch``, whose tables must not be read any more; returns how many."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


_held: dict[str, object] = {}


def held_once(mark: str, make):
    """What ``make()`` gives, made once in a worker's process for a mark; the last two marks are kept."""
    if mark not in _held:
        while len(_held) > 1:
            _held.pop(next(iter(_held)))
        _held[mark] = make()
    return _held[mark]


class Remembered(dict):
    """What ``make`` gives for a string, worked out once for each short one; emptied when there are ``most``."""

    #: Characters of the longest string that is kept, so that what is held is bounded by their number.
    LONGEST = 64

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, text: str):
        value = self.make(text)
        if len(text) <= self.LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[text] = value
        return value


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, without its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_enough(df: DataFrame, max_rows: int) -> list | None:
    """The rows of ``df`` if there are at most ``max_rows``, else None.

    At most ``max_rows + 1`` rows ever reach the driver.
    """
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def small_numbers(df: DataFrame, max_rows: int):
    """The first column, of whole numbers, as a sorted array if there are at most ``max_rows`` rows, else None.

    It comes as Arrow, at 8 bytes a row.
    """
    import numpy as np

    values = df.limit(max_rows + 1).toArrow().column(0).to_numpy()
    return np.sort(values.astype(np.int64)) if len(values) <= max_rows else None
