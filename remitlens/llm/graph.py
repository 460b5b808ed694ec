"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.session import materialize

ROWS_PER_PART = 50_000  # contracted rows are narrow; later rounds are small and need few tasks and files
LAST_ROWS = 200_000  # so few links (3 MB) are contracted in one task, as each round costs several exchanges


def _parts(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_PART))


def _last(edges: DataFrame) -> DataFrame:
    """(node, label: the smallest node reached) of at most ``LAST_ROWS`` links, in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        ends = [np.concatenate([np.zeros(0, np.int64), *(x.column(i).to_numpy() for x in parts)]) for i in (0, 1)]
        nodes, place = np.unique(np.concatenate(ends), return_inverse=True)
        a, b = place[:len(ends[0])], place[len(ends[0]):]
        root = np.arange(len(nodes))
        while len(a):
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))  # a and b are roots: each joins its smallest neighbour
            while (root != root[root]).any():
                root = root[root]
            a, b = root[a], root[b]
            a, b = a[a != b], b[a != b]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], names=["node", "label"])

    return materialize(edges.coalesce(1).mapInArrow(run, "node bigint, label bigint"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b: long); nodes have equal
    labels if links connect them. Labels are arbitrary numbers.

    Each round renames the nodes at random (a hash with the round's number) and
    merges every node into the smallest name among itself and its neighbours,
    which shrinks the graph by a constant factor on average, whatever its shape.
    A hub costs one pre-aggregated row per task. Rounds are cut by checkpoints,
    with as many parts as the rows that are left need. They end when ``LAST_ROWS``
    rows are left, which one task contracts.
    """
    pairs = links.where("a <> b")
    edges = materialize(pairs.select("a", "b").union(pairs.select("b", "a")).distinct())
    n = edges.count()
    if n <= LAST_ROWS:
        return _last(edges)
    labels = edges.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node"))
    turn = 0
    while n > LAST_ROWS:
        turn += 1
        name = lambda c: F.xxhash64(F.col(c), F.lit(turn))  # noqa: B023,E731
        edges = edges.coalesce(_parts(n)).select(name("a").alias("a"), name("b").alias("b"))
        into = materialize(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")).coalesce(_parts(n)))
        if turn == 1:
            nodes = into.count()
        labels = materialize(labels.coalesce(_parts(nodes)).withColumn("label", name("label")).join(
            into, F.col("label") == F.col("a"), "left").select("node", F.coalesce("p", "label").alias("label"))
            .coalesce(_parts(nodes)))
        other = into.select(F.col("a").alias("b"), F.col("p").alias("q"))
        edges = materialize(edges.join(into, "a").join(other, "b").where("p <> q")
                            .select(F.col("p").alias("a"), F.col("q").alias("b")).distinct().coalesce(_parts(n)))
        n = edges.count()
    return labels.join(_last(edges).toDF("label", "into"), "label", "left") \
        .select("node", F.coalesce("into", "label").alias("label"))
