"""Tables of a folder, and connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.operators.lineage import checkpoint_folder, cut

__all__ = ["checkpoint_folder", "components", "cut", "read"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Edges that one task joins by itself, 16 bytes each; more go through distributed rounds.
FEW_EDGES = 250_000


def _smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges (a, b) of a graph of FEW_EDGES at most to (id, component)."""
    parts = [np.stack([x.column(0).to_numpy(), x.column(1).to_numpy()]) for x in batches]
    ids, ends = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *parts], axis=1), return_inverse=True)
    a, b = ends.reshape(2, -1)
    label = np.arange(len(ids))
    while True:
        low = label.copy()
        np.minimum.at(low, label[a], label[b])
        np.minimum.at(low, label[b], label[a])
        while (low[low] != low).any():
            low = low[low]
        low = low[label]
        if (low == label).all():
            break
        label = low
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[label])], names=["id", "component"])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component): component is the smallest id reachable over edges (a, b).

    Ids get pseudo-random names (a bijection). Each round points each name to the least one among
    itself and its neighbours, follows the pointer twice more, and contracts the edges to distinct
    pairs of names. So edges shrink by a factor each round, and a long chain or a large star takes few.
    Rounds end when no edge is left. Where all edges are FEW_EDGES at most, one task joins them. Only ids
    that have an edge are returned. Edges with a null end and loops are ignored. Edges are read twice or
    more, so they should be a table or cut.
    """

    def pairs(rows: DataFrame, a: Column, b: Column) -> DataFrame:
        return cut(rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct())

    some = edges.where("a <> b").select("a", "b")
    if some.count() <= FEW_EDGES:
        return cut(some.coalesce(1).mapInArrow(_smallest, "id long, component long"))
    left = pairs(some, F.xxhash64("a"), F.xxhash64("b"))
    steps: list[DataFrame] = []
    while not left.isEmpty():
        if len(steps) == most_rounds:
            raise RuntimeError("edges are still left; raise most_rounds")
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("name")).agg(F.min("b").alias("b")).select("name", F.least("name", "b").alias("up"))
        for _ in range(2):
            up = up.join(up.select(F.col("name").alias("up"), F.col("up").alias("top")), "up").select("name", F.col("top").alias("up"))
        steps.append(cut(up))
        named = left
        for end in ("a", "b"):
            named = named.join(steps[-1].select(F.col("name").alias(end), F.col("up").alias(f"{end}_up")), end)
        left = pairs(named, F.col("a_up"), F.col("b_up"))
    if not steps:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    label = steps[-1]
    for step in reversed(steps[:-1]):
        label = step.join(label.select(F.col("name").alias("up"), F.col("up").alias("top")), "up", "left").select("name", F.coalesce("top", "up").alias("up"))
    ids = some.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.xxhash64("id").alias("name"))
    label = ids.join(label, "name").select("id", "up")
    smallest = label.groupBy("up").agg(F.min("id").alias("component"))
    return cut(label.join(smallest, "up").select("id", "component"))
