"""SimHash near-dedup with a vantage-point tree.

Fingerprints are points of the Hamming space. A tree of vantage points, fit
on a bounded sample of distinct fingerprints, cuts that space into shards:
at each node a point goes inside (distance to the vantage point at most the
node's radius) or outside. Two points within ``r`` bits have distances to
the vantage point that differ by ``r`` at most, so only inside points whose
distance exceeds ``radius - r`` are also sent outside, as visitors. Each
shard links its own points with one another and with its visitors by the
same rule, so every pair within ``r`` bits is compared exactly once,
whatever the sample was.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import DisjointSets, connected_components, materialize

SEED = 42
#: The tree is fit on at most SAMPLE distinct fingerprints; a shard aims at
#: LEAF of them, and a task goes on splitting down to BLOCK.
SAMPLE, LEAF, BLOCK = 1 << 16, 1024, 96


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the text's word shingles (0 if it has no words)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    h = np.array(hashes, "<u8")
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = 2 * bits.sum(axis=0, dtype=np.int64) > len(h)
    return int.from_bytes(np.packbits(most, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(doc, fp): the fingerprint of every row, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc"), text).mapInArrow(run, "doc long, fp long")


def _choose(points: np.ndarray, r: int) -> tuple[np.uint64, int] | None:
    """A vantage point and radius that halve ``points`` about evenly and send
    few of them to both sides; None if no radius splits them."""
    best = None
    step = max(1, len(points) // 8)
    for v in points[::step][:8]:
        n = np.bincount(np.bitwise_count(points ^ v), minlength=65)
        inside = np.cumsum(n)
        for radius in range(64):
            small = min(inside[radius], len(points) - inside[radius])
            if small > 0:
                visit = n[max(0, radius + 1 - r) : radius + 1].sum()
                cost = (visit + abs(2 * inside[radius] - len(points)) / 2) / len(points)
                if best is None or cost < best[0]:
                    best = cost, v, radius
    return None if best is None else (best[1], best[2])


def build_tree(sample: np.ndarray, leaf: int, r: int) -> list:
    """Nodes as [vantage, radius, inside, outside]; a leaf is [None]. The
    children are places in the list, the root is first."""
    nodes: list = []

    def grow(points: np.ndarray) -> int:
        at = len(nodes)
        nodes.append([None])
        split = _choose(points, r) if len(points) > leaf else None
        if split:
            near = np.bitwise_count(points ^ split[0]) <= split[1]
            nodes[at] = [split[0], split[1], grow(points[near]), grow(points[~near])]
        return at

    grow(sample)
    return nodes


def _sides(points: np.ndarray, own: np.ndarray, vantage: np.uint64, radius: int, r: int):
    """Which points go inside and outside, and which do so as their own."""
    d = np.bitwise_count(points ^ vantage).astype(np.int64)
    inside = np.where(own, d <= radius, d - r <= radius)
    return inside, d + r > radius, own & (d > radius)


def _route(nodes: list, points: np.ndarray, r: int):
    """Yields (leaf, places of points, whether each is the leaf's own)."""
    stack = [(0, np.arange(len(points)), np.ones(len(points), bool))]
    while stack:
        at, idx, own = stack.pop()
        if not len(idx):
            continue
        if nodes[at][0] is None:
            yield at, idx, own
            continue
        vantage, radius, left, right = nodes[at]
        inside, outside, far = _sides(points[idx], own, vantage, radius, r)
        stack.append((left, idx[inside], own[inside]))
        stack.append((right, idx[outside], far[outside]))


def link_block(points: np.ndarray, own: np.ndarray, r: int, sets: DisjointSets) -> None:
    """Joins every own point with the points within ``r`` bits."""
    stack = [(np.arange(len(points)), own)]
    while stack:
        idx, own = stack.pop()
        home = idx[own]
        if not len(home):
            continue
        split = _choose(points[home][:: max(1, len(home) // 512)], r) if len(home) > BLOCK else None
        if split:
            inside, outside, far = _sides(points[idx], own, *split, r)
            n_in = int((inside & own).sum())
            if 0 < n_in < len(home) and max(inside.sum(), outside.sum()) < len(idx):
                stack += [(idx[inside], own[inside]), (idx[outside], far[outside])]
                continue
        for i in range(0, len(home), BLOCK):
            block = home[i : i + BLOCK]
            a, b = np.nonzero(np.bitwise_count(points[block][:, None] ^ points[idx][None, :]) <= r)
            sets.union(block[a], idx[b])


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """(doc, fp, component) for every row of ``docs``: its fingerprint (signed
    long) and the smallest doc id reachable over fingerprints that differ in
    at most ``max_bits`` bits.

    Words are runs of non-blank ASCII after lower-casing A-Z; a text of fewer
    words than a shingle is one shingle; a null or empty text has fingerprint
    0, which links like any other. Rows with a null id get a fingerprint, link
    with nothing and have a null component. Repeated rows are in one
    component. Empty tables give empty results; other columns are not read.
    """
    spark = docs.sparkSession
    marks = materialize(fingerprints(docs, doc_id, text, shingle), "simhash")
    classes = materialize(
        marks.filter("doc IS NOT NULL").groupBy("fp").agg(F.min("doc").alias("id")), "simhash-classes"
    )
    n = classes.count()
    sample = [r.fp for r in classes.select("fp").orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()]
    points = np.array(sample, np.int64).view(np.uint64)
    tree = build_tree(points, max(8, LEAF * len(points) // max(n, 1)), max_bits)
    sent = spark.sparkContext.broadcast(tree)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, ident = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for leaf, idx, own in _route(sent.value, fp.view(np.uint64), max_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(idx), leaf, np.int32)), pa.array(fp[idx]), pa.array(ident[idx]), pa.array(own)],
                    names=["leaf", "fp", "id", "own"],
                )

    def link(group: pa.Table) -> pa.Table:
        fp, ident = (group.column(c).to_numpy() for c in ("fp", "id"))
        sets = DisjointSets(len(fp))
        link_block(fp.view(np.uint64), group.column("own").to_numpy(), max_bits, sets)
        joined = sets.root != np.arange(len(fp))
        return pa.table({"a": ident[joined], "b": ident[sets.root[joined]]})

    shards = classes.mapInArrow(route, "leaf int, fp long, id long, own boolean")
    edges = shards.groupBy("leaf").applyInArrow(link, "a long, b long")
    found = connected_components(edges)
    named = classes.join(found, classes.id == found.node, "left").select(
        "fp", F.coalesce("component", "id").alias("component")
    )
    return marks.join(named, "fp", "left").select(
        "doc", "fp", F.when(F.col("doc").isNotNull(), F.col("component")).alias("component")
    )


def hex_fingerprint(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first_of_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` reduced to the smallest doc id of each near-duplicate group
    (rows with a null id all stay; of repeated rows one stays)."""
    first = (
        simhash_components(docs, doc_id, text, **how).filter("doc = component").select(F.col("doc").alias("_doc")).distinct()
    )
    known = docs.filter(F.col(doc_id).isNotNull())
    kept = known.join(first, known[doc_id] == first["_doc"], "left_semi").dropDuplicates([doc_id])
    return kept.unionByName(docs.filter(F.col(doc_id).isNull()))
