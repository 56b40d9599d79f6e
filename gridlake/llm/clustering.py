"""Centroid clustering with geometrically tightened drift bounds.

Every vector carries an upper bound of its distance to its own centroid and a
lower bound of its distance to each other one. After a round the centroids
move, and the bounds are loosened. A lower bound would be safe if loosened by
the other centroid's whole drift; less will do, as the vectors of a cluster
lie in a ball around its centroid. For a centroid that moves from c to c' with
the midpoint m, a point x comes nearer by

    |x - c| - |x - c'| = 2 (x - m)(c' - c) / (|x - c| + |x - c'|)
                      <= |c' - c| cos(angle of x - m with c' - c),

since |x - c| + |x - c'| >= 2 |x - m|. In the plane of c, c' and the ball's
centre a, that angle is at least the centre's own angle less the ball's half
angle asin(radius / |a - m|), seen from m. So the bound is loosened by
|c' - c| times the cosine of the difference; by nothing where the whole ball
is behind m, and by the whole drift where m lies in the ball. Vectors whose
bounds leave the nearest centroid open are compared with all of them exactly.

Coordinates are whole numbers and all results are exact; the bounds are
doubles with a margin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import discard, reread, write_shared

#: Coordinates at most so far from zero take part: a squared distance of 64 of
#: them fits 64 bits.
LARGEST = 1 << 27
#: Relative margin of the bounds, far over the rounding of doubles.
MARGIN = 1e-9


def _whole(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[pa.RecordBatch]:
    """(id, mark, point) of the vectors that take part; ``point`` holds the
    coordinates as little-endian 32-bit integers."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy()
        batch = batch.filter(pa.array(sizes == dim))
        if not len(batch):
            continue
        flat = batch.column(2).flatten()
        known = flat.is_valid().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(flat.fill_null(0).to_numpy() * float(scale)).reshape(-1, dim)
        keep = (known.reshape(-1, dim) & (np.abs(x) <= LARGEST)).all(axis=1)  # false for NaN and infinity
        x, batch = x[keep].astype("<i4"), batch.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([v.tobytes() for v in x], pa.binary())], names=["id", "mark", "point"]
        )


def drift(centers: np.ndarray, radii: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """[i, j]: how much nearer centroid j can have come to any point of the
    ball of ``radii[i]`` around the old centroid i, moving from ``centers[j]``
    to ``moved[j]``."""
    old, new = centers.astype(float), moved.astype(float)
    step = new - old
    length = np.linalg.norm(step, axis=1)
    out = np.zeros((len(old), len(old)))
    for j in np.nonzero(length > 0)[0]:
        away = old - (old[j] + new[j]) / 2
        far = np.linalg.norm(away, axis=1)
        outside = far > radii
        safe = np.where(outside, far, 1.0)
        cos = np.clip(away @ step[j] / (safe * length[j]), -1, 1)
        half = np.where(outside, radii / safe, 1.0)  # sine of the half angle
        # cos(angle - half angle), where the angle is the larger one
        turned = cos * np.sqrt(1 - half**2) + np.sqrt(1 - cos**2) * half
        inside = ~outside | (cos >= np.sqrt(1 - half**2))
        out[:, j] = length[j] * np.where(inside, 1.0, np.clip(turned + 1e-7, 0, 1))
    return out


def _exact(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of all rows from all centroids."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centers], axis=1)


def _assigned(batches: Iterator[pa.RecordBatch], dim: int, centers: np.ndarray, own_drift, loosened, last: bool):
    """Each vector with its nearest centroid and new bounds (part 0), and, per
    cluster of the task, the count, the sum of the vectors and the largest
    upper bound (part 1). The last round's rows have the exact distance."""
    k = len(centers)
    count, radius, scanned, kind = np.zeros(k, np.int64), np.zeros(k), 0, None
    sums = np.zeros((k, dim), np.int64)
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        kind = batch.schema[0].type
        x = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4").reshape(n, dim).astype(np.int64)
        at = np.arange(n)
        if own_drift is None:  # the first round
            cluster, upper, lower = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros((n, k))
        else:
            cluster = batch.column(2).to_numpy().astype(np.int64)
            upper = batch.column(3).to_numpy() + own_drift[cluster]
            lower = np.frombuffer(b"".join(batch.column(4).to_pylist()), "<f8").reshape(n, k) - loosened[cluster]
        others = lower.copy()
        others[at, cluster] = np.inf
        least = others.min(axis=1)
        open_ = np.nonzero(~(upper < least))[0]
        if own_drift is not None and len(open_):  # the exact distance from the own centroid may do
            upper[open_] = np.sqrt(((x[open_] - centers[cluster[open_]]) ** 2).sum(axis=1)) * (1 + MARGIN)
            open_ = open_[~(upper[open_] < least[open_])]
        if len(open_):
            square = _exact(x[open_], centers)
            cluster[open_] = square.argmin(axis=1)  # the smaller number of equals
            exact = np.sqrt(square)
            upper[open_] = exact[np.arange(len(open_)), cluster[open_]] * (1 + MARGIN)
            lower = lower.copy()
            lower[open_] = exact * (1 - MARGIN)
            scanned += len(open_)
        distance = ((x - centers[cluster]) ** 2).sum(axis=1) if last else np.zeros(n, np.int64)
        count += np.bincount(cluster, minlength=k)
        for c in np.unique(cluster).tolist():
            sums[c] += x[cluster == c].sum(axis=0)
        np.maximum.at(radius, cluster, upper)
        yield _rows(batch.column(0), batch.column(1), cluster, upper, lower, distance)
    for c in np.nonzero(count)[0].tolist():
        yield pa.RecordBatch.from_arrays(
            [pa.array([1], pa.int32()), pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.array([c], pa.int32()),
             pa.array([radius[c]]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.array([int(count[c])], pa.int64()),
             pa.array([sums[c].tolist()], pa.list_(pa.int64())), pa.array([scanned if c == count.argmax() else 0], pa.int64())],
            names=_NAMES,
        )


_NAMES = ["part", "id", "point", "cluster", "upper", "lower", "distance", "count", "sums", "scanned"]
_STATE = (
    "point binary, cluster int, upper double, lower binary, distance long, count long, sums array<long>, scanned long"
)


def _rows(ids, point, cluster, upper, lower, distance) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n, np.int32)), ids, point, pa.array(cluster.astype(np.int32)), pa.array(upper),
         pa.array([v.tobytes() for v in np.ascontiguousarray(lower, "<f8")], pa.binary()), pa.array(distance),
         pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64())],
        names=_NAMES,
    )


def _summed(state: DataFrame, k: int, dim: int) -> tuple[list[int], list[list[int]], np.ndarray, int]:
    """Counts, coordinate sums and radii of the k clusters, and the vectors
    that were compared with all centroids. k rows come to the driver."""
    parts = state.filter("part = 1")
    # as decimals, which no number of vectors overflows
    each = [F.sum(F.element_at("sums", i + 1).cast("decimal(20,0)")).alias(f"_{i}") for i in range(dim)]
    rows = parts.groupBy("cluster").agg(F.sum("count").alias("n"), F.max("upper").alias("r"), F.sum("scanned").alias("s"), *each)
    counts, sums, radii, scanned = [0] * k, [[0] * dim for _ in range(k)], np.zeros(k), 0
    for r in rows.collect():
        counts[r.cluster], radii[r.cluster], scanned = r.n, r.r, scanned + r.s
        sums[r.cluster] = [int(v) for v in r[4:]]
    return counts, sums, radii, scanned


def cluster_vectors(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 8, rounds: int = 10, dim: int = 64,
    scale: int = 1024, seed: int = 3, log: list | None = None,
) -> DataFrame:
    """(``vec_id``, cluster int, distance, cluster_inertia, inertia long,
    centroid array<long>) of the vectors with exactly ``dim`` components, none
    null or non-finite, as floor(``scale`` * component).

    Centroids start as the ``k`` vectors with the smallest SHA-256 of
    "seed:id" in hexadecimal, in that order (equal ones, from repeated ids, by
    their coordinates); fewer vectors give fewer centroids. Each round assigns
    every vector to the nearest centroid (smaller number of equals) and
    replaces each centroid that has vectors by floor(sum / count); a last
    assignment follows.

    A null id is the empty one. Equal vectors and repeated rows count each.
    Vectors with a coordinate beyond LARGEST take no part: their squared
    distances need not fit a long. Empty tables give empty results; no other
    column is read. ``log`` collects how many vectors each assignment compared
    with all centroids.
    """
    spark = df.sparkSession
    kind = df.schema[vec_id].dataType.simpleString()
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(vec_id).cast("string"), F.lit(""))), 256)
    points = df.select(F.col(vec_id).alias("id"), mark.alias("mark"), F.col(embedding).cast("array<double>").alias("v")).mapInArrow(
        lambda b: _whole(b, dim, scale), f"id {kind}, mark string, point binary"
    )
    table = reread(points, write_shared(points, "cluster-points"))
    starts = [r.point for r in table.select("mark", "point").orderBy("mark", "point").limit(k).collect()]
    out = f"{vec_id} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not starts:
        return spark.createDataFrame([], out)
    centers = np.array([np.frombuffer(p, "<i4") for p in starts]).astype(np.int64)

    state, old = table.select("id", "point"), None
    own_drift = loosened = None
    for number in range(rounds + 1):
        last = number == rounds
        # with the round's values: the task must not see a later round's
        step = lambda b, c=centers, o=own_drift, t=loosened, e=last: _assigned(b, dim, c, o, t, e)
        new = state.mapInArrow(step, f"part int, id {kind}, {_STATE}")
        path = write_shared(new, "cluster-state")
        new = reread(new, path)
        if old:
            discard(spark, old)
        counts, sums, radii, scanned = _summed(new, len(centers), dim)
        if log is not None:
            log.append(scanned)
        old, state = path, new.filter("part = 0").select("id", "point", "cluster", "upper", "lower")
        if not last:
            moved = np.array([
                [s // n for s in total] if n else c for n, total, c in zip(counts, sums, centers.tolist())
            ], np.int64)
            loosened = drift(centers, radii, moved) * (1 + MARGIN)
            own_drift = np.linalg.norm((moved - centers).astype(float), axis=1) * (1 + MARGIN)
            centers = moved

    final = new.filter("part = 0").select(F.col("id").alias(vec_id), "cluster", "distance")
    each = final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    inertia = {r.cluster: int(r.s) for r in each}
    totals = spark.createDataFrame(
        [(c, inertia[c], sum(inertia.values()), centers[c].tolist()) for c in inertia],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return final.join(F.broadcast(totals), "cluster").select(
        vec_id, "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def centroid_digest(centroid: str) -> Column:
    """Hexadecimal SHA-256 of the coordinates as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.col(centroid).cast("array<string>"), ","), 256)
