"""Embedding near-dedup by sorted projection passes.

In each pass every vector gets a key of concatenated sign bits of random
projections; the vectors of a label are ordered by it and each is compared
with the next ``window`` ones. Similar vectors share long prefixes and meet
in some pass; verified pairs of all passes are united. Passes and windows grow
with the label, and go on over the borders of range partitions. Identical
vectors are one class from the start, so copies cost nothing.

Links between members of one component that no window showed are then
counted exactly: a component is cut into blocks, and each pair of blocks is
compared in one task. So a dense group loses no link to the windows' bound;
what the windows decide is which components exist.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import DisjointSets, connected_components, materialize
from gridlake.llm.vectors import matrix, valid_vectors

#: Passes and window of a label of at most SMALL vectors; each doubling beyond
#: adds 4 passes and a window's length (README: misses).
PASSES, WINDOW, BITS = 16, 64, 48
SMALL = 4096
#: Members of a component that one task compares with as many others.
BLOCK = 512


def _doublings(m: int, small: int) -> int:
    return (max(m - 1, 0) // small).bit_length()


def _planes(p: int, dim: int) -> np.ndarray:
    return np.random.default_rng([p, dim]).standard_normal((dim, BITS))


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of all rows of ``a`` with all rows of ``b``, but for rounding."""
    return (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)


#: Cosines so near to the threshold are computed again by ``_settled``, as the
#: last bits of a fast product depend on how it is blocked.
DOUBT = 1e-9


def _settled(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each row of ``a`` with the same row of ``b``: one order
    of adding, and the same for a pair either way round."""
    dot, aa, bb = (np.cumsum(x * y, axis=1)[:, -1] for x, y in ((a, b), (a, a), (b, b)))
    return np.maximum(dot / np.sqrt(aa) / np.sqrt(bb), dot / np.sqrt(bb) / np.sqrt(aa))


def _linked(cosines: np.ndarray, x: np.ndarray, y: np.ndarray, rows: tuple[np.ndarray, ...], threshold: float) -> np.ndarray:
    """``cosines`` >= ``threshold``, those in doubt settled; ``rows`` gives the
    places in ``x`` and ``y`` of the entries of ``cosines`` in doubt."""
    out = cosines >= threshold
    doubt = np.nonzero(np.abs(cosines - threshold) < DOUBT)
    if len(doubt[0]):
        out[doubt] = _settled(x[rows[0][doubt]], y[rows[1][doubt]]) >= threshold
    return out


def _all_linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    rows = np.indices((len(a), len(b)))
    return _linked(_cosines(a, b), a, b, (rows[0], rows[1]), threshold)


def _keyed(batches: Iterator[pa.RecordBatch], passes: int, small: int) -> Iterator[pa.RecordBatch]:
    """(pass, key) rows of each vector (columns id, label, dim, vec, m: vectors
    of the label)."""
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        dims = batch.column(2).to_numpy()
        for dim in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == dim))
            x = matrix(part.column(3), dim)
            own = np.array([passes + 4 * _doublings(m, small) for m in part.column(4).to_pylist()])
            for p in range(own.max()):
                at = np.nonzero(own > p)[0]
                key = (x[at] @ _planes(p, dim) > 0) @ weights
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), p, np.int32)), pa.array(key), *part.take(pa.array(at)).columns],
                    names=["pass", "key", "id", "label", "dim", "vec", "m"],
                )


def _edges(rows: pa.Table, window: int, small: int, threshold: float) -> pa.Table:
    """Edges between neighbours of sorted rows; one row per vector that has
    any, not one per pair."""
    ids, sizes = rows["id"].to_numpy(), rows["m"].to_numpy()
    group = rows.select(["pass", "label", "dim"]).to_pandas()
    change = (group != group.shift()).any(axis=1).to_numpy().cumsum()
    sets = DisjointSets(len(ids))
    for g in np.unique(change):
        at = np.nonzero(change == g)[0]
        x = matrix(rows["vec"].slice(at[0], len(at)), int(group["dim"].iloc[at[0]]))
        norms, place = np.linalg.norm(x, axis=1), np.arange(len(x))
        reach = window * (1 + _doublings(int(sizes[at[0]]), small))
        for k in range(1, min(reach, len(x) - 1) + 1):
            cosines = np.einsum("ij,ij->i", x[:-k], x[k:]) / norms[:-k] / norms[k:]
            near = np.nonzero(_linked(cosines, x, x, (place[:-k], place[k:]), threshold))[0]
            sets.union(at[near], at[near + k])
    joined = np.nonzero(sets.root != np.arange(len(ids)))[0]
    return pa.table({"a": pa.array(ids[joined]), "b": pa.array(ids[sets.root[joined]])})


def _windows(batches: Iterator[pa.RecordBatch], threshold: float, window: int, small: int) -> Iterator[pa.RecordBatch]:
    """Edges of a sorted partition, and its first and last rows (without edge,
    with the partition's number) for the windows over its borders."""
    number = TaskContext.get().partitionId()

    def out(edges: pa.Table | None, rows: pa.Table | None = None, head: bool = False) -> list[pa.RecordBatch]:
        n = len(edges) if edges is not None else len(rows)
        columns = [edges[c] if edges is not None else pa.nulls(n, pa.int64()) for c in ("a", "b")]
        columns += [pa.array([None if rows is None else number] * n, pa.int32()), pa.array([head] * n, pa.bool_())]
        columns += [rows[f] if rows is not None else pa.nulls(n, t) for f, t in kinds.items()]
        return pa.table(columns, names=["a", "b", "part", "head", *kinds]).to_batches()

    def reach(rows: pa.Table, at: int) -> int:
        return window * (1 + _doublings(rows["m"][at].as_py(), small))

    kinds: dict[str, pa.DataType] = {}
    tail: pa.Table | None = None
    wanted = 0
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch])
        if tail is None:
            kinds = {f.name: f.type for f in batch.schema}
            wanted = reach(rows, 0)
        if wanted:
            yield from out(None, rows.slice(0, wanted), head=True)
            wanted -= min(wanted, len(rows))
        rows = pa.concat_tables([tail, rows]).combine_chunks() if tail is not None else rows
        tail = rows.slice(max(0, len(rows) - reach(rows, len(rows) - 1)))
        yield from out(_edges(rows, window, small, threshold))
    if tail is not None:
        yield from out(None, tail)


def _counts(group: pa.Table, threshold: float) -> pa.Table:
    """Links of each member of two blocks (columns id, n, own, vec; own: in
    the first block) with the other block, or within one block."""
    ids, n = group["id"].to_numpy(), group["n"].to_numpy()
    own = group["own"].to_numpy()
    x = np.frombuffer(b"".join(group["vec"].to_pylist()), "<f8").reshape(len(ids), -1)
    a, b = np.nonzero(own)[0], np.nonzero(~own)[0]
    out = np.zeros(len(ids), np.int64)
    if not len(b):  # one block with itself
        near = _all_linked(x, x, threshold)
        np.fill_diagonal(near, False)
        out = near @ n
    else:
        near = _all_linked(x[a], x[b], threshold)
        out[a], out[b] = near @ n[b], near.T @ n[a]
    return pa.table({"id": ids, "links": out})


def embedding_components(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str | None = "label",
    threshold: float = 0.98, passes: int = PASSES, window: int = WINDOW,
) -> DataFrame:
    """``df`` plus ``n_links`` (long: other rows of the same label whose
    cosine, in double precision, is at least ``threshold``) and
    ``component_id`` (smallest id reachable by links, itself included).

    Rows whose id, label or vector is null, whose vector is zero or holds null
    or non-finite components, and vectors of different lengths link with
    nothing; a null id has a null component. Repeated rows are vectors of
    their own and link with one another. An empty table gives an empty
    result; columns named n_links or component_id are replaced.
    """
    spark = df.sparkSession
    df = df.drop("n_links", "component_id")
    valid = materialize(valid_vectors(df, vec_id, embedding, label), "vectors")
    same = ["label", "dim", "digest"]
    classes = materialize(
        valid.groupBy(*same).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec")),
        "vector-classes",
    )
    labels = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("m"))
    # a partition holds several windows, so that no window spans three
    total, largest = labels.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.max("m"), F.lit(0))).first()
    most = window * (1 + _doublings(largest, SMALL))
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), total * passes // (4 * most)))
    small, columns = SMALL, "pass int, key long, id long, label string, dim int, vec binary, m long"
    keyed = classes.join(labels, ["label", "dim"]).select("id", "label", "dim", "vec", "m").mapInArrow(
        lambda b: _keyed(b, passes, small), columns
    )
    # ids as node names: a class's smallest id may name classes of other labels
    # or lengths too where rows repeat an id, which only joins what shares it
    order = ["pass", "label", "dim", "key", "id"]
    ordered = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    met = materialize(
        ordered.mapInArrow(
            lambda b: _windows(b, threshold, window, small), f"a long, b long, part int, head boolean, {columns}"
        ),
        "vector-edges",
    )
    ends = met.filter("part IS NOT NULL")
    parts = sorted(r[0] for r in ends.select("part").distinct().collect())  # empty partitions are passed over
    edges = met.filter("a IS NOT NULL").select("a", "b")
    if len(parts) > 1:
        place = F.create_map(*[F.lit(x) for i, part in enumerate(parts) for x in (part, i)])[F.col("part")]
        across = ends.withColumn("border", place - F.col("head").cast("int")).groupBy("border").applyInArrow(
            lambda t: _edges(t.sort_by([(c, "ascending") for c in order]), window, small, threshold), "a long, b long"
        )
        edges = edges.union(across)
    found = materialize(connected_components(edges), "vector-components")

    members = classes.join(found, classes.id == found.node).select("component", "label", "dim", "id", "n", "vec")
    sizes = found.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cut = members.join(sizes, "component").withColumn("_b", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pairs = cut.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", "label", "dim", F.least("_b", "_o").alias("i"), F.greatest("_b", "_o").alias("j"),
        (F.col("_b") <= F.col("_o")).alias("own"), "id", "n", "vec",
    )
    counted = (
        pairs.groupBy("component", "label", "dim", "i", "j")
        .applyInArrow(lambda t: _counts(t, threshold), "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))
    )
    known = materialize(
        classes.select(*same, "id", "n").join(found, classes.id == found.node, "left").join(counted, "id", "left").select(
            *same, F.coalesce("component", "id").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        ),
        "vector-links",
    )
    per_row = valid.select("id", *same).join(known, same).groupBy("id").agg(
        F.max("n_links").alias("_links"), F.min("component_id").alias("_component")
    )
    return df.join(per_row, df[vec_id] == per_row["id"], "left").select(
        *[df[c] for c in df.columns], F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_component", df[vec_id].cast("long")).alias("component_id"),
    )
