import hashlib
import math

import numpy as np
import pytest

from gridlake.llm import clustering as cl
from gridlake.llm.queries import QUERIES
from tests.llm.conftest import SF
from tests.parity import compare

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, distance int, part string"


def brute(rows, k=8, rounds=10, dim=64, scale=1024, seed=3):
    """[(id, cluster, distance)], inertias and centroids by plain integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) and abs(math.floor(scale * x)) <= cl.LARGEST for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    if not kept:
        return [], {}, []
    mark = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    starts = sorted(kept, key=lambda r: (mark(r[0]), np.array(r[1], "<i4").tobytes()))[:k]
    c = np.array([x for _, x in starts], dtype=object)
    x = np.array([x for _, x in kept], dtype=object)
    for step in range(rounds + 1):
        d = np.stack([((x - y) ** 2).sum(axis=1) for y in c], axis=1)
        own = [min(range(len(c)), key=lambda j: (r[j], j)) for r in d]
        if step < rounds:
            for j in range(len(c)):
                at = [n for n, o in enumerate(own) if o == j]
                if at:
                    c[j] = [int(s) // len(at) for s in x[at].sum(axis=0)]
    out = [(kept[n][0], o, int(d[n][o])) for n, o in enumerate(own)]
    inertia = {j: sum(r[2] for r in out if r[1] == j) for j in range(len(c))}
    return out, inertia, c.tolist()


def check(df, rows, **how):
    got = cl.cluster_vectors(df, **how).collect()
    want, inertia, centroids = brute(rows, **how)
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.cluster_inertia == inertia[r.cluster] and r.inertia == sum(inertia.values())
        assert r.centroid == centroids[r.cluster]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2, "p") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("spread", [0.05, 0.6])
def test_against_plain_integers(spark, spread):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((6, 16))[rng.integers(0, 6, 900)] + spread * rng.standard_normal((900, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    log = []
    df = frame(spark, rows).repartition(5)
    cl.cluster_vectors(df, dim=16, log=log).count()
    assert log[0] == 900 and len(log) == 11 and sum(log[1:]) < 0.7 * 10 * 900  # the bounds spare scans
    check(df, rows, dim=16)
    check(df, rows, dim=16, k=3, rounds=1, scale=7, seed=9)
    check(df, rows, dim=16, k=1, rounds=0)


def test_ties_copies_and_empty_clusters(spark):
    grid = [[float(a), float(b)] for a in range(4) for b in range(4)]
    rows = [(i % 20, v) for i, v in enumerate(grid * 6)] + [(None, [0.0, 0.0]), (None, None), (7, [-0.5, -1.25])]
    for k in (2, 5, 8):
        check(frame(spark, rows), rows, dim=2, k=k, scale=2)
    same = [(i, [1.0, 2.0]) for i in range(50)] + [(50, [3.0, -2.0])]
    check(frame(spark, same), same, dim=2, k=4)  # equal starts: all but the first stay empty


def test_odd_rows(spark):
    inf, big = float("inf"), [1e300, 0.0]
    rows = [
        (1, [0.1, 0.2]), (2, [0.1]), (3, []), (4, None), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [inf, 1.0]), (8, [-inf, 1.0]),
        (9, [0.0, 0.0]), (None, [5.0, 5.0]), (9, [0.0, 0.0]), (10, [131072.0, -131072.0]), (11, [131073.0, 0.0]), (12, big),
        (13, [1.0, 2.0, 3.0]),
    ]
    check(frame(spark, rows), rows, dim=2, k=3)
    check(frame(spark, rows), rows, dim=2)  # fewer vectors than centroids
    for none in (frame(spark, rows).limit(0), frame(spark, rows).filter("vec_id = 4")):
        assert cl.cluster_vectors(none, dim=2).count() == 0


def test_drift_bounds_hold_and_are_less_than_full_drift():
    rng = np.random.default_rng(1)
    less = 0
    for _ in range(300):
        dim = int(rng.integers(2, 6))
        old = rng.integers(-50, 50, (3, dim))
        new = old + rng.integers(-20, 20, (3, dim)) * rng.integers(0, 2, (3, 1))
        radii = rng.uniform(0, 60, 3)
        bound, full = cl.drift(old, radii, new), np.linalg.norm((new - old).astype(float), axis=1)
        for i in range(3):
            way = rng.standard_normal((400, dim))
            way /= np.linalg.norm(way, axis=1)[:, None]
            x = old[i] + way * radii[i] * rng.uniform(0, 1, (400, 1)) ** 0.2
            nearer = np.linalg.norm(x[:, None] - old, axis=2) - np.linalg.norm(x[:, None] - new, axis=2)
            assert (nearer <= bound[i] + 1e-9).all()
            assert (bound[i] <= full + 1e-9).all()
            less += int((bound[i] < 0.9 * full).sum())
    assert less > 100


def test_bytes_written_are_of_two_rounds_at_most(spark, tmp_path, monkeypatch):
    """A round's rows go when the next one's are written."""
    import glob

    from gridlake.session import ensure_checkpoint_dir

    rows = [(i, [float(i % 13), float(i % 7)]) for i in range(100)]
    at = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{at}/llm-cluster-state-*"))
    cl.cluster_vectors(frame(spark, rows), dim=2).count()
    assert len(set(glob.glob(f"{at}/llm-cluster-state-*")) - before) == 1


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_query_against_sql(spark, size):
    from gridlake.llm.oracle import ORACLE

    out = compare(spark, f"/root/testdata/sf{size}", "op12_clustering", QUERIES["op12_clustering"], ORACLE["op12_clustering"])
    assert out["status"] == "match", out


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, inertia, centroids = brute(rows)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    got = {(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in QUERIES["op12_clustering"](spark, SF).collect()}
    assert got == {(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in want}
