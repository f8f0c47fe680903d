"""Connected components of a link table, by rounds of star contraction in Spark."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartouche.sources.scratch import fresh_path

EDGE = "a long, b long"


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts the plan, survives lost executors."""
    path = fresh_path(frame.sparkSession, f"llm-{name}")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def released(frame: DataFrame, name: str) -> DataFrame:
    """As ``stored``; the shuffle files of the write go with its end, not when the driver next collects its garbage."""
    conf = frame.sparkSession.conf
    before = conf.get(RELEASE, None)
    conf.set(RELEASE, "true")
    try:
        return stored(frame, name)
    finally:
        conf.unset(RELEASE) if before is None else conf.set(RELEASE, before)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node with the smallest node it reaches over these links; itself left out."""
    nodes, where = np.unique(np.r_[a, b], return_inverse=True)
    x, y = where[:len(a)], where[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        label = label[label]
        if np.array_equal(label, before) and np.array_equal(label[x], label[y]):
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def contract(batches):
    """Replace the links of a batch by a star per connected group."""
    for batch in batches:
        a, b = forest(np.asarray(batch.column(0)), np.asarray(batch.column(1)))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` (smallest reachable node) for every node that has a link.

    ``links`` has two long columns ``a, b``; direction, repeats and self links do not matter. Large-star and small-star
    rounds alternate until nothing changes; the number of rounds grows with the logarithm of the longest chain.
    """
    spark = links.sparkSession
    edges = links.where("a <> b").mapInArrow(contract, EDGE)
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        edges = small_star(large_star(edges))
        edges = stored(edges, "links")
        row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("h"), F.expr("sum(xxhash64(b, a) % 1000003)").alias("s")).first()
        if mark == tuple(row):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        mark = tuple(row)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
    return both.join(low, both.a == low.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    low = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    pairs = edges.join(low, edges.a == low.n).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return pairs.union(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()
