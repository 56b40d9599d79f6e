import re

import numpy as np
import xxhash

from gridlake.llm import simhash as sh
from gridlake.llm.common import DisjointSets, connected_components
from gridlake.llm.queries import QUERIES
from tests.llm.conftest import SF


def brute_fp(text, k=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    parts = [" ".join(w)] if len(w) < k else [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, r):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in zip(ids, fps):
        for j, b in zip(ids, fps):
            if (a ^ b).bit_count() <= r:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_query_against_brute_force(spark, docs_pd):
    rows = QUERIES["op8_simhash"](spark, SF).collect()
    fps = [brute_fp(t) for t in docs_pd.text]
    comps = brute_components(docs_pd.doc_id.tolist(), fps, 2)
    want = {i: (f"{f:016x}", comps[i]) for i, f in zip(docs_pd.doc_id.tolist(), fps)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want and len(rows) == len(want)


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centre = rng.integers(0, 2**63, 5, dtype=np.uint64)
    out = centre[rng.integers(0, 5, n)]
    for _ in range(4):  # a few flipped bits: dense groups that touch
        out = out ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)) * (rng.random(n) < 0.4)
    return np.unique(np.concatenate([out, rng.integers(0, 2**63, n, dtype=np.uint64)]))


def test_tree_finds_every_pair_whatever_the_sample():
    for seed in range(3):
        pts = clustered(700, seed)
        want = DisjointSets(len(pts))
        a, b = np.nonzero(np.bitwise_count(pts[:, None] ^ pts[None]) <= 2)
        want.union(a, b)
        for sample, leaf in ((pts[::7], 8), (pts[:3], 1), (pts[:0], 8)):
            got = DisjointSets(len(pts))
            homes = np.zeros(len(pts), int)
            for _, idx, own in sh._route(sh.build_tree(sample, leaf, 2), pts, 2):
                homes[idx[own]] += 1
                part = DisjointSets(len(idx))
                sh.link_block(pts[idx], own, 2, part)
                got.union(idx, idx[part.root])
            assert (homes == 1).all()
            assert (got.root == want.root).all()


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(300, 400)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (7, 300)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(300, 400)]}
    assert connected_components(edges.limit(0)).count() == 0


def test_odd_rows(odd_docs, no_docs):
    rows = sh.simhash_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc: r for r in rows}
    assert by[3].fp == by[4].fp == by[7].fp == 0 and by[4].component == by[7].component == by[3].component == 3
    assert by[5].component == by[6].component == 5 and by[None].component is None
    kept = sh.keep_first_of_groups(odd_docs)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "5", "8", "None"]
    assert kept.columns == odd_docs.columns
    assert sh.simhash_components(no_docs).count() == 0 and sh.keep_first_of_groups(no_docs).count() == 0
