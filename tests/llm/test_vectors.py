import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from gridlake.llm import annsearch as ann
from gridlake.llm import vecdedup as vd
from gridlake.llm.queries import QUERIES
from tests.llm.conftest import SF

SCHEMA = "vec_id long, embedding array<double>, label int, n_links string, digest int"


def brute_links(ids, x, labels, t):
    n, parent = dict.fromkeys(range(len(ids)), 0), list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(len(ids)):
            if i != j and labels[i] == labels[j] and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= t:
                n[i] += 1
                parent[find(i)] = find(j)
    low: dict = {}
    for i in range(len(ids)):
        low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return {ids[i]: (n[i], low[find(i)]) for i in range(len(ids))}


@pytest.fixture(scope="module")
def grouped():
    """Dense groups of near copies, equal copies, and the rest at random."""
    rng = np.random.default_rng(4)
    near = [c + 0.012 * rng.standard_normal((40, 16)) for c in rng.standard_normal((3, 16))]
    x = np.concatenate([*near, rng.standard_normal((60, 16))])
    x = np.concatenate([x, np.repeat(x[:1], 30, 0), 3 * x[5:8]])
    order = rng.permutation(len(x))
    return order.tolist(), x, [int(i) % 2 for i in range(len(x))]


def test_links_against_brute_force(spark, grouped, monkeypatch):
    ids, x, labels = grouped
    monkeypatch.setattr(vd, "BLOCK", 16)
    rows = [(i, v.tolist(), k, "clash", 1) for i, v, k in zip(ids, x, labels)]
    out = vd.embedding_components(spark.createDataFrame(rows, SCHEMA), threshold=0.98).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == brute_links(ids, x, labels, 0.98)


def test_a_cosine_at_the_threshold_is_one_decision(spark):
    """Edges and counts agree on pairs at, just over and just under it."""
    rng = np.random.default_rng(2)
    x = [[-3, 6, -1, -2], [-3, 6, -2, -1], [6, -3, -1, -2], [6, -3, -2, -1], [0.3, -0.6, 0.1, 0.2], [7, 1, 0, 0], [7, -1, 0, 0]]
    for _ in range(60):  # pairs of cosine 0.98 but for rounding
        a = rng.standard_normal(4)
        b = rng.standard_normal(4)
        b -= a * (a @ b) / (a @ a)
        x += [a.tolist(), (0.98 * a / np.linalg.norm(a) + math.sqrt(1 - 0.98**2) * b / np.linalg.norm(b)).tolist()]
    rows = [(i, list(map(float, v)), i // 2, "c", 0) for i, v in enumerate(x)]
    out = {r.vec_id: (r.n_links, r.component_id) for r in vd.embedding_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(0, len(x) - len(x) % 2, 2):
        (n, c), (m, d) = out[i], out[i + 1]
        assert (n, m, c, d) in ((1, 1, i, i), (0, 0, i, i + 1)), i


def test_windows_go_on_over_partition_borders(spark):
    """Rows in pairs, one pass and a window of one: half of the pairs lie on a
    border where every partition holds few rows."""
    rng = np.random.default_rng(8)
    c = rng.standard_normal((300, 12))
    x = np.concatenate([c, c + 1e-9 * rng.standard_normal(c.shape)])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "70")
    try:
        out = vd.embedding_components(df, passes=1, window=1).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sum(r.n_links == 1 and r.component_id == r.vec_id % 300 for r in out) == 600


def test_passes_and_windows_grow_with_the_label(spark, monkeypatch):
    rng = np.random.default_rng(9)
    m = rng.standard_normal(16)
    c = 2 * m / np.linalg.norm(m) + rng.standard_normal((3000, 16)) / 4
    c /= np.linalg.norm(c, axis=1)[:, None]
    r = rng.standard_normal(c.shape)
    r -= (r * c).sum(1)[:, None] * c
    x = np.concatenate([c, 0.9999 * c + math.sqrt(1 - 0.9999**2) * r / np.linalg.norm(r, axis=1)[:, None]])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")

    def missed():
        out = vd.embedding_components(df, threshold=0.99989, passes=1, window=2).collect()
        return sum(r.component_id == r.vec_id for r in out if r.vec_id >= 3000)

    monkeypatch.setattr(vd, "SMALL", 10_000)
    fixed = missed()
    monkeypatch.setattr(vd, "SMALL", 50)
    assert fixed > 300 and missed() < 0.02 * fixed


def test_query_on_small_table(spark):
    e = pd.read_parquet(f"{SF}/embeddings.parquet")
    rows = QUERIES["op6_embedding_dedup"](spark, SF).collect()
    want = brute_links(e.vec_id.tolist(), np.stack(e.embedding).astype(float), e.label.tolist(), 0.98)
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == want and len(rows) == len(e)
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


ODD = [
    (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1),
    (7, [math.nan, 1.0], 1), (8, [1.0, 0.0, 0.0], 1), (9, [1.0, -0.0], 1), (9, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (10, [1.0, 0.0], 2),
    (11, [], 1), (12, [math.inf, 0.0], 1),
]


def test_odd_vectors(spark):
    df = spark.createDataFrame([(*r, "clash", 1) for r in ODD], SCHEMA)
    out = vd.embedding_components(df).collect()
    assert len(out) == len(ODD)
    got = {r.vec_id: (r.n_links, r.component_id) for r in out}
    assert got[1] == got[2] == got[9] == (3, 1) and got[None] == (0, None)
    assert all(got[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 10, 11, 12))
    assert vd.embedding_components(df.limit(0)).count() == 0
    near = ann.nearest(df, F.col("vec_id") == 1, k=10).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in near] == [(3, 0.0), (9, 0.0), (10, 0.0), (2, 1.0)]
    assert ann.nearest(df.limit(0), F.col("vec_id") == 1).count() == 0
    assert ann.nearest(df, F.col("vec_id") == 5).count() == 0


def test_recall_and_exact_scores(spark):
    d = "/root/testdata/sf0.1"
    e = pd.read_parquet(f"{d}/embeddings.parquet")
    x, ids = np.stack(e.embedding).astype(float), e.vec_id.to_numpy()
    out = QUERIES["op10_nearest"](spark, d).toPandas()
    hits = 0
    queries = ids[ids % 100 == 0]
    for q in queries:
        dist = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        dist[ids == q] = np.inf
        best = ids[np.lexsort((ids, dist))[:10]]
        got = out[out.query_id == q].sort_values("rank")
        assert got["rank"].tolist() == list(range(1, 11))
        assert list(zip(got.score, got.vec_id)) == sorted(zip(got.score, got.vec_id))
        assert np.allclose(got.score, [dist[ids == i][0] for i in got.vec_id], rtol=0, atol=1e-12)
        hits += len(set(best) & set(got.vec_id))
    assert hits >= 0.95 * 10 * len(queries)


def recall_of(out, x, queries):
    hits = 0
    for q in queries:
        dist = ((x - x[q]) ** 2).sum(1)
        dist[q] = np.inf
        hits += len(set(np.argsort(dist)[:10].tolist()) & {r.vec_id for r in out if r.query_id == q})
    return hits / (10 * len(queries))


@pytest.mark.parametrize("spread", [0, 0.5])
def test_recall_with_many_buckets(spark, monkeypatch, spread):
    """As many buckets, for its dimensions, as millions of vectors have: the
    fixed 4 probes meet too few of the nearest."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((6000, 16))
    x = x / np.linalg.norm(x, axis=1)[:, None] * rng.lognormal(0, spread, (6000, 1))
    monkeypatch.setattr(ann, "BUCKET", 3)
    assert ann.axes_for(6000, 16) == (16, 16)
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(4)
    want = F.col("vec_id") % 40 == 0
    fixed = ann.nearest(df, want, tables=4, recall=0.0).collect()
    out = ann.nearest(df, want, tables=4).collect()
    assert recall_of(fixed, x, range(0, 6000, 40)) < 0.8
    assert recall_of(out, x, range(0, 6000, 40)) >= 0.92


def brute_nearest(rows, queries, k):
    """(query_id, rank) to (vec_id, score), over rows (id, vector)."""
    out = {}
    for q in queries:
        own = [v for i, v in rows if i == q]
        found = {(math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), i) for v in own for i, w in rows if i != q}
        for rank, (d, i) in enumerate(sorted(found)[:k], 1):
            out[q, rank] = i, d
    return out


def test_hot_queries_meet_in_bounded_blocks(spark, monkeypatch, tmp_path):
    """A third of all vectors, and of all queries, are equal, and one id has
    several vectors: each different query is asked once, and no block holds
    more than a few times its aim."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((900, 4)).round(1) + 0.05
    x[::3] = x[0]
    rows = list(enumerate(x.tolist())) + [(60, x[5].tolist()), (60, x[7].tolist()), (61, x[5].tolist())]
    monkeypatch.setattr(ann, "GROUP", 40)
    inner, log = ann._rerank, str(tmp_path / "blocks")

    def watched(block, keep):
        n = pa.compute.sum(pa.compute.is_valid(block["ask"])).as_py()
        with open(log, "a") as f:
            f.write(f"{len(block) - n} {n}\n")
        return inner(block, keep)

    monkeypatch.setattr(ann, "_rerank", watched)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    out = ann.nearest(df, F.col("vec_id") % 20 == 0, k=10, tables=2, recall=1.0).collect()
    with open(log) as f:
        sizes = [tuple(map(int, line.split())) for line in f]
    assert max(v for v, _ in sizes) <= 3 * 40 and max(q for _, q in sizes) <= 3 * 40
    want = brute_nearest(rows, range(0, 900, 20), 10)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in out}
    assert set(got) == set(want)
    hot = [q for q in range(0, 900, 60) if q != 60]
    for q in hot:  # equal vectors, ties to the smaller id, the own id left out
        assert [got[q, r] for r in range(1, 11)] == [want[q, r] for r in range(1, 11)]
    assert sum(abs(got[key][1] - want[key][1]) < 1e-12 for key in want) >= 0.9 * len(want)


def test_buckets_are_the_nearest_signed_axes():
    x = np.random.default_rng(2).standard_normal((50, 10))
    y = ann.rotate(x, [3, 0])
    assert np.allclose(np.linalg.norm(y, axis=1), np.linalg.norm(x, axis=1))  # a rotation
    first = ann.probes(x, 3, (16, 0), 1)[:, 0]
    signed = np.concatenate([y, -y], axis=1)
    assert (first == signed.argmax(1)).all()
    both = ann.probes(x, 3, (16, 8), 5)
    assert (both[:, 0] // 16 == first).all() and both.max() < 32 * 16
