"""Connected components by local forests and label propagation with pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquarry.session import cut

#: Edges that a task holds at a time while it makes a forest of them.
CHUNK = 500_000


def local_forest(edges: DataFrame) -> DataFrame:
    """(x, y): each node of ``edges`` (x, y) with the least node that its part of the edges links it to.

    Each task takes its edges in chunks of CHUNK, so memory is bounded; what lies in
    several chunks has several roots.  The components are those of ``edges``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}
        held = 0

        def root(v):
            while parent[v] != v:
                parent[v] = v = parent[parent[v]]
            return v

        def emptied(schema: pa.Schema) -> pa.RecordBatch:
            nodes = list(parent)
            out = pa.RecordBatch.from_arrays([pa.array(nodes, schema.field(0).type), pa.array([root(v) for v in nodes], schema.field(0).type)], ["x", "y"])
            parent.clear()
            return out

        schema = None
        for b in batches:
            schema = b.schema
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parent.setdefault(x, x)
                parent.setdefault(y, y)
                p, q = root(x), root(y)
                if p != q:
                    if q < p:
                        p, q = q, p
                    parent[q] = p
            held += b.num_rows
            if held >= CHUNK:
                yield emptied(schema)
                held = 0
        if parent:
            yield emptied(schema)

    kind = edges.schema["x"].dataType
    return edges.mapInArrow(run, T.StructType([T.StructField("x", kind), T.StructField("y", kind)]))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node of each connected component, for every node of ``edges``.

    Edges are parted by ranges of their first node, which no hot node or group can make
    uneven, and shrunk to local forests.  Each round then takes the least label among the
    neighbours and the label of that label, so the rounds grow with the logarithm of the
    longest path that is left.  Labels stay distributed; only whether any changed reaches
    the driver.  Null ends are dropped.
    """
    given = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    alone = edges.select(F.explode(F.array(a, b)).alias("x")).where("x IS NOT NULL").distinct()
    forest = local_forest(given.where("x <> y").repartitionByRange("x")).where("x <> y").distinct()
    links = cut(forest.unionByName(forest.select(F.col("y").alias("x"), F.col("x").alias("y"))))
    labels = alone.select("x", F.col("x").alias("label"))
    while True:
        near = links.join(labels.withColumnRenamed("x", "y"), "y").groupBy("x").agg(F.min("label").alias("least"))
        step = labels.join(near, "x", "left").select("x", "label", F.least("label", F.coalesce("least", "label")).alias("new"))
        jump = step.select(F.col("x").alias("new"), F.col("new").alias("further"))
        labels2 = cut(step.join(jump, "new", "left").select("x", F.least("new", F.coalesce("further", "new")).alias("label"), F.col("label").alias("old")))
        if labels2.where("label <> old").isEmpty():
            return labels2.select(F.col("x").alias("node"), F.col("label").alias("component"))
        labels = labels2.select("x", "label")
