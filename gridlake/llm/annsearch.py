"""Approximate nearest neighbours by cross-polytope hashing.

A table's hash of a unit vector is the nearest signed axis after a fast
pseudo-rotation: three rounds of random signs and a Hadamard transform. Only
as many axes are used as the table needs buckets, and with more vectors than
axes can part, a second rotation's axis is appended. A query probes several
buckets of each table: those of its largest coordinates. In each bucket the
exact distance to every candidate is computed and the best ``k`` go on, so
what is shuffled per query is bounded by tables, probes and ``k``.

How many buckets a query must probe depends on the number of vectors and on
how they lie. It is measured: for some queries the nearest vectors are found
exactly, and the probes are as many as it takes to meet the wanted share.

Buckets of any size are split into blocks: the vectors by a hash into groups
of bounded size, the queries that probe it into parts of bounded size, and
each group meets each part in a task's group of its own. Identical vectors
are one candidate that carries its ``k + 1`` smallest ids: more of them can't
be among the ``k`` nearest. Identical queries are asked once, for as many
vectors as leave ``k`` to each after its own is taken out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import materialize
from gridlake.llm.vectors import matrix, valid_vectors

#: Tables, and the fewest probes of each.
TABLES, PROBES = 16, 4
#: Share of the nearest vectors that the probes must meet, and about as many
#: queries as it is measured on.
RECALL, SAMPLE = 0.95, 128
#: Vectors a bucket aims at, and the most that one task compares at once.
BUCKET, GROUP = 400, 2048


def axes_for(n: int, dim: int) -> tuple[int, int]:
    """Axes of the first and the second rotation (0: none) for ``n`` vectors."""
    full = 1 << max(dim - 1, 0).bit_length()
    first = max(1, min(full, n // (2 * BUCKET)))
    second = min(full, n // (2 * first * 2 * BUCKET)) if first == full else 0
    return first, second if second > 1 else 0


def rotate(x: np.ndarray, seed: list[int]) -> np.ndarray:
    """Three rounds of random signs and a normalised Hadamard transform, over
    the next power of two of dimensions."""
    n, dim = x.shape
    full = 1 << max(dim - 1, 0).bit_length()
    y = np.zeros((n, full))
    y[:, :dim] = x
    for signs in np.random.default_rng(seed).choice([-1.0, 1.0], (3, full)):
        y *= signs
        h = 1
        while h < full:
            pair = y.reshape(n, full // (2 * h), 2, h)
            y = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, full)
            h *= 2
    return y / np.sqrt(float(full)) ** 3


def probes(x: np.ndarray, table: int, axes: tuple[int, int], count: int) -> np.ndarray:
    """The ``count`` best buckets of each row of unit vectors, best first (-1
    where there are fewer buckets)."""
    def ranked(seed: int, m: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
        y = rotate(x, [table, seed])[:, :m]
        signed = np.concatenate([y, -y], axis=1)
        best = np.argsort(-signed, axis=1, kind="stable")[:, :keep]
        return best, np.take_along_axis(signed, best, axis=1)

    first, second = axes
    at, value = ranked(0, first, count)
    if second:
        at2, value2 = ranked(1, second, count)
        # a pair of places (i, j) is no better than the (i + 1)(j + 1) - 1 before it
        i, j = np.nonzero(np.outer(np.arange(1, at.shape[1] + 1), np.arange(1, at2.shape[1] + 1)) <= count)
        best = np.argsort(-(value[:, i] + value2[:, j]), axis=1, kind="stable")[:, :count]
        at = np.take_along_axis(at[:, i] * (2 * second) + at2[:, j], best, axis=1)
    return np.pad(at, ((0, 0), (0, count - at.shape[1])), constant_values=-1) if at.shape[1] < count else at


def _exact(batches: Iterator[pa.RecordBatch], sample: dict[int, np.ndarray], k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` nearest vectors (columns dim, vec) to each sampled query, its
    copies left out: rows (dim, query's place, squared distance, vec)."""
    best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        dims = batch.column(0).to_numpy()
        for dim in np.unique(dims).tolist():
            if dim not in sample:
                continue
            x, q = matrix(batch.filter(pa.array(dims == dim)).column(1), dim), sample[dim]
            scale = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)
            d = scale - 2 * (q @ x.T)
            d[d <= 1e-12 * scale] = np.inf
            near = np.argsort(d, axis=1)[:, :k]
            d, near = np.take_along_axis(d, near, axis=1), x[near]
            if dim in best:
                d, near = np.concatenate([best[dim][0], d], axis=1), np.concatenate([best[dim][1], near], axis=1)
                first = np.argsort(d, axis=1)[:, :k]
                d, near = np.take_along_axis(d, first, axis=1), np.take_along_axis(near, first[:, :, None], axis=1)
            best[dim] = d, near
    for dim, (d, near) in best.items():
        at, _ = real = np.nonzero(np.isfinite(d))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), dim, np.int32)), pa.array(at.astype(np.int32)), pa.array(d[real]),
             pa.array([v.tobytes() for v in near[real]], pa.binary())],
            names=["dim", "query", "d", "vec"],
        )


def probes_for(
    q: np.ndarray, near: np.ndarray, at: np.ndarray, axes: tuple[int, int], tables: int, least: int, recall: float
) -> int:
    """The fewest probes (``least`` or more) that meet the share ``recall`` of
    the vectors ``near``; ``at``: the row of ``q`` that each is near to."""
    unit = [x / np.linalg.norm(x, axis=1)[:, None] for x in (q, near)]
    buckets = 2 * axes[0] * max(1, 2 * axes[1])
    held = [probes(unit[1], t, axes, 1) for t in range(tables)]
    most = least
    while len(near):
        rank = np.full(len(near), most)  # of the vector's bucket, in its best table
        for t in range(tables):
            hit = probes(unit[0], t, axes, most)[at] == held[t]
            rank = np.minimum(rank, np.where(hit.any(axis=1), hit.argmax(axis=1), most))
        needed = int(np.sort(rank)[max(0, int(np.ceil(recall * len(rank))) - 1)]) + 1
        if needed <= most:
            return max(least, needed)
        if most >= buckets:
            return buckets
        most = min(buckets, most * 4)
    return least


def _hashed(batches: Iterator[pa.RecordBatch], axes: dict[int, tuple[int, int]], tables: int, count: dict[int, int]):
    """A row (t, bucket) for each table and probe of each vector; columns
    dim, vec come first, the others pass through."""
    for batch in batches:
        dims = batch.column(0).to_numpy()
        for dim in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == dim))
            x = matrix(part.column(1), dim)
            x = x / np.linalg.norm(x, axis=1)[:, None]
            for t in range(tables):
                for bucket in probes(x, t, axes[dim], count[dim]).T:
                    real = pa.array(bucket >= 0)
                    rows = part.filter(real)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), t, np.int32)), pa.array(bucket[bucket >= 0].astype(np.int64)), *rows.columns],
                        names=["t", "bucket", *part.schema.names],
                    )


def _rerank(rows: pa.Table, keep: int) -> pa.Table:
    """The ``keep`` nearest ids of each query (rows with ``ask``) among the
    other rows of one block."""
    asks = pa.compute.is_valid(rows["ask"])
    index, queries = rows.filter(pa.compute.invert(asks)), rows.filter(asks)
    out: list[list] = [[], [], []]
    if len(index) and len(queries):
        dim = index["dim"][0].as_py()
        x, q = matrix(index["vec"], dim), matrix(queries["vec"], dim)
        ids = index["ids"].to_pylist()
        low = np.array([i[0] for i in ids])
        for query, v in zip(queries["ask"].to_pylist(), q):
            d = np.sqrt(((x - v) ** 2).sum(axis=1))
            best = np.lexsort((low, d))[:keep]
            found = sorted((d[j], i) for j in best.tolist() for i in ids[j])[:keep]
            out[0] += [query] * len(found)
            out[1] += [i for _, i in found]
            out[2] += [float(s) for s, _ in found]
    return pa.table({"ask": pa.array(out[0], pa.binary()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})


def _measured(
    classes: DataFrame, asks: DataFrame, axes: dict[int, tuple[int, int]], k: int, tables: int, least: int, recall: float
) -> dict[int, int]:
    """Probes per dimension, measured on about SAMPLE different queries of each."""
    every = {r.dim: r.n for r in asks.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not every:
        return {}
    step = F.create_map(*[F.lit(x).cast("long") for dim, n in every.items() for x in (dim, -(-n // SAMPLE))])
    rows = asks.filter(F.pmod(F.xxhash64("ask"), step[F.col("dim").cast("long")]) == 0).select("dim", "vec").collect()
    sample = {
        dim: np.stack([np.frombuffer(r.vec, "<f8") for r in rows if r.dim == dim]) for dim in {r.dim for r in rows}
    }
    w = Window.partitionBy("dim", "query").orderBy("d")
    near = (
        classes.select("dim", "vec")
        .mapInArrow(lambda b: _exact(b, sample, k), "dim int, query int, d double, vec binary")
        .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).collect()  # k rows per sampled query
    )
    out = {}
    for dim, q in sample.items():
        own = [r for r in near if r.dim == dim]
        x = np.frombuffer(b"".join(r.vec for r in own), "<f8").reshape(-1, dim)
        out[dim] = probes_for(q, x, np.array([r.query for r in own], np.int64), axes[dim], tables, least, recall)
    return out


def nearest(
    df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
    tables: int = TABLES, count: int = PROBES, recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` (over
    the column ``vec_id``) marks, the ``k`` nearest other rows found by
    Euclidean distance in double precision, nearest first, ties to the
    smaller id; all candidates where there are ``k`` or fewer. Each table is
    probed ``count`` times, or as often as a sample of the queries needs to
    meet the share ``recall`` of their nearest.

    Rows whose id or vector is null, and vectors that are zero or hold null or
    non-finite components, take no part; vectors of different lengths are not
    compared. Repeated rows count once; where an id has several vectors, each
    is a candidate and, if marked, a query of that id. An empty table gives an
    empty result; other columns are not read.
    """
    valid = materialize(valid_vectors(df, vec_id, embedding), "ann-vectors")
    # the k + 1 smallest ids of identical vectors (limited before the shuffle)
    w = Window.partitionBy("dim", "digest").orderBy("id")
    classes = materialize(
        valid.select("dim", "digest", "id", "vec").withColumn("_rn", F.dense_rank().over(w)).filter(F.col("_rn") <= k + 1)
        .groupBy("dim", "digest").agg(F.sort_array(F.collect_set("id")).alias("ids"), F.first("vec").alias("vec")),
        "ann-classes",
    )
    sizes = {r.dim: r.n for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    axes = {dim: axes_for(n, dim) for dim, n in sizes.items()}

    marked = valid.withColumnRenamed("id", vec_id).filter(is_query).withColumnRenamed(vec_id, "id")
    asked = materialize(marked.select("dim", "id", F.col("digest").alias("ask"), "vec").dropDuplicates(["id", "ask"]), "ann-queries")
    asks = materialize(asked.groupBy("dim", "ask").agg(F.first("vec").alias("vec")).select("dim", "vec", "ask"), "ann-asks")
    # a query's own id is among the candidates once for each vector it has
    own = asked.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    keep = k + own
    index = materialize(
        classes.select("dim", "vec", "ids").mapInArrow(
            lambda b: _hashed(b, axes, tables, dict.fromkeys(axes, 1)), "t int, bucket long, dim int, vec binary, ids array<long>"
        ),
        "ann-index",
    )
    counts = dict.fromkeys(axes, count) | _measured(classes, asks, axes, k, tables, count, recall)
    keys = ["dim", "t", "bucket"]

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        """How many blocks of at most about GROUP rows each bucket takes."""
        return rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias(name))

    groups = materialize(blocks(index, "groups"), "ann-buckets")

    def search(probing: DataFrame) -> DataFrame:
        """Best ids of each probe: ``probing`` has queries with t and bucket."""
        cut = materialize(groups.join(blocks(probing, "parts"), keys), "ann-blocks")

        def every(n: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

        def one(of: str, n: str) -> Column:
            return F.pmod(F.xxhash64(of), F.col(n)).cast("int")

        split = index.join(cut, keys).select(
            *keys, one("vec", "groups").alias("g"), every("parts").alias("p"), "vec", "ids", F.lit(None).cast("binary").alias("ask")
        )
        sent = probing.join(cut, keys).select(
            *keys, every("groups").alias("g"), one("ask", "parts").alias("p"), "vec", F.lit(None).cast("array<long>").alias("ids"), "ask"
        )
        return split.union(sent).groupBy(*keys, "g", "p").applyInArrow(
            lambda rows: _rerank(rows, keep), "ask binary, vec_id long, score double"
        )

    def first(found: DataFrame, of: str, n: int) -> DataFrame:
        nearest_first = Window.partitionBy(of).orderBy("score", "vec_id")
        return found.distinct().withColumn("rank", F.row_number().over(nearest_first).cast("int")).filter(F.col("rank") <= n)

    probing = asks.mapInArrow(lambda b: _hashed(b, axes, tables, counts), "t int, bucket long, dim int, vec binary, ask binary")
    best = materialize(first(search(probing), "ask", keep), "ann-best")
    # queries whose probes held too few candidates are compared, in blocks, with
    # all rows: every bucket of one table
    many = best.groupBy("ask").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= keep).select("ask")
    few = materialize(asks.join(many, "ask", "left_anti").select("dim", "vec", "ask"), "ann-few")
    if not few.isEmpty():
        everywhere = few.join(index.filter("t = 0").select(*keys).distinct(), "dim")
        best = first(best.drop("rank").union(search(everywhere)), "ask", keep)
    # at most ``keep`` rows per different query, given to all that ask it
    answers = best.groupBy("ask").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("found"))
    others = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    told = (
        asked.select(F.col("id").alias("query_id"), "ask").join(answers, "ask")
        .select("query_id", F.explode(F.slice(others, 1, k)).alias("_x")).select("query_id", "_x.vec_id", "_x.score")
    )
    return first(told, "query_id", k).select("query_id", "rank", "vec_id", "score")
