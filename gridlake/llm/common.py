"""Helpers the operators of this subpackage share: table reads, tables
written into the shared checkpoint folder, label propagation."""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gridlake.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: later readers see the same rows, and a lost executor costs a
    re-read instead of a recomputation."""
    return reread(df, write_shared(df, name))


def write_shared(df: DataFrame, name: str) -> str:
    """The folder in the shared checkpoint folder that ``df`` is written to."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def reread(df: DataFrame, path: str) -> DataFrame:
    """The rows of ``df`` as they were written to ``path``."""
    plain = StructType([StructField(f.name, f.dataType) for f in df.schema.fields])
    return df.sparkSession.read.schema(plain).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``write_shared`` that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text: from the driver's disk, or else by Spark."""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            return f.read()
    return spark.read.text(path, wholetext=True).first().value


def widened(df: DataFrame, **columns: str) -> StructType:
    """The schema of ``df`` with further columns (name=type)."""
    schema = StructType(list(df.schema.fields))
    for name, kind in columns.items():
        schema = schema.add(name, "integer" if kind == "int" else kind)
    return schema


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node per node of an undirected edge table.

    Alternating large-star and small-star steps: each moves every edge
    towards the smallest neighbour, so the edges become one star per
    component after about log(n) rounds. Minima are partial aggregates and
    the joins are plain sort-merge joins, which AQE can split when one node
    is the neighbour of a third of all others. Every round is written to the
    shared folder. Returns (node, component) for the nodes that have an edge
    to a different node; empty edges give an empty table.
    """
    n = F.least(a, b), F.greatest(a, b)
    cur = materialize(edges.select(n[1].alias("u"), n[0].alias("v")).filter("u <> v").distinct(), "cc")
    state = None
    while True:
        # large star: neighbours above u move to the smallest of u's closed neighbourhood
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        )
        # small star: neighbours below u, and u itself, move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = materialize(moved.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "cc")
        now = nxt.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if state == tuple(now):
            return nxt.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                nxt.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state, cur = tuple(now), nxt


class DisjointSets:
    """Disjoint sets over places 0..n-1 that take pairs in blocks."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.root[a], self.root[b]
        differ = a != b
        if not differ.any():
            return
        pairs = np.unique(np.minimum(a, b)[differ] * len(self.root) + np.maximum(a, b)[differ])
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (p := parent.get(x, x)) != x:
                parent[x] = parent.get(p, p)
                x = p
            return x

        for x, y in zip((pairs // len(self.root)).tolist(), (pairs % len(self.root)).tolist()):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        new = np.arange(len(self.root))
        for x in parent:
            new[x] = find(x)
        self.root = new[self.root]
