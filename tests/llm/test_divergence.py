import pickle
import re
from collections import Counter

import pyarrow as pa
import pytest

from gridlake.llm import divergence as dv
from gridlake.llm.queries import QUERIES
from tests.llm.conftest import LONG, SF
from tests.parity import compare

SCALE = 10**9


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, least=3, top=200):
    """Rows of the audit of (lang, source, text), by the plain definition."""
    rows = [(a or "", b or "", words(t)) for a, b, t in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        held = Counter(w for r in own for w in set(r[2]))
        kept = sorted(w for w, n in held.items() if n >= least)
        n = {s: Counter(w for r in own if r[1] == s for w in r[2] if held[w] >= least) for s in {r[1] for r in own}}

        def shares(c):
            return {w: 1 + SCALE * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}

        p, q = {s: shares(c) for s, c in n.items()}, shares(sum(n.values(), Counter()))
        for s in n:
            pair = [(sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o) for o in n if o != s]
            term = [((p[s][w] - q[w]) ** 2 // q[w], w) for w in kept if n[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(found) if part == "pair" or k < top}
    return out


def got(df, **how):
    rows = [tuple(r) for r in dv.divergence(df, **how).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


ROWS = [
    ("en", "a", "The cat sat. the CAT ran"), ("en", "b", "the dog sat"), ("en", "a", "the cat"), ("en", None, "a cat, a dog"),
    ("en", "b", None), ("en", "c", ""), ("en", "a", "the cat"), ("de", "a", "Ähre Ähre ähre über"), ("de", "b", "Ähre"), ("de", "b", "Ähre x"),
    ("de", "c", "123 Ähre"), (None, "a", "cat the"), (None, "b", "cat"), ("fr", "solo", "un deux un"), ("", "b", "cat dog ſſ K"),
    ("x1", "a", "one"), ("x1", "b", "two"),
]
SCHEMA = "lang string, source string, text string"


def test_against_the_plain_definition(spark):
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in ROWS], f"{SCHEMA}, n long, term string, rank int")
    for how in ({}, {"top": 1}):
        assert got(df, **how) == brute(ROWS, **how)
    assert got(df, least_docs=1) == brute(ROWS, 1)
    assert got(df.limit(0)) == set()


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.lang, str(r.doc_id) if r.doc_id is not None else None, r.text) for r in odd_docs.collect()]
    assert got(odd_docs, source="doc_id", least_docs=2) == brute(rows, 2)
    assert got(no_docs, source="doc_id") == set()


def test_bounds_change_nothing(spark, monkeypatch):
    """Slices, held terms, slots, waves, shards and blocks of sources at sizes
    that all take part in a small table."""
    texts = [f"{LONG[:3000]} w{chr(97 + i % 26)}{chr(97 + i % 7)} ä{'ö' * (i % 5)} " * (1 + i % 3) for i in range(120)]
    rows = [("en" if i % 4 else "de", f"s{i % 11}", t) for i, t in enumerate(texts)]
    df, want = spark.createDataFrame(rows, SCHEMA), brute(rows)
    for name, small in [("SLICE", 50), ("HELD_TERMS", 3), ("HELD_SLOTS", 4), ("WAITING", 9), ("WAVE_BYTES", 100), ("SHARD_TERMS", 6), ("PAIR_BLOCK", 2)]:
        monkeypatch.setattr(dv, name, small)
    # the tasks' own bounds go with the code that Spark sends
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(dv)
    try:
        assert got(df) == want
    finally:
        cloudpickle.unregister_pickle_by_value(dv)


def test_one_group_and_one_term_with_most_rows(spark):
    rows = [("en", "hot", "same words again")] * 1500 + [("en", f"s{i % 5}", f"same other{'abcdefg'[i % 7]}") for i in range(300)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 100, 5000])
def test_perfect_hash_is_minimal_and_finds_strangers_out(n):
    terms = [f"t{i}é".encode() for i in range(n)]
    h = dv.PerfectHash.build(terms)
    for x in (h, pickle.loads(pickle.dumps(h))):
        slots = x.verified(pa.array(terms, pa.binary()), dv._lanes(terms))
        assert sorted(slots.tolist()) == list(range(n))
        assert [x.terms[s].as_py() for s in slots] == terms
    others = [f"u{i}".encode() for i in range(2000)]
    assert (h.verified(pa.array(others, pa.binary()), dv._lanes(others)) == -1).all()


def test_slices_cut_no_term():
    for text in ("ab" * 2_000_000, "x " * 900_000 + "ü" * 700_000 + " Y", ""):
        parts = list(dv._slices(text.encode()))
        assert b"".join(parts) == text.lower().encode()
        assert sum(len(dv.TERM.findall(p)) for p in parts) == len(words(text))


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_query_against_sql(spark, size):
    from gridlake.llm.oracle import ORACLE

    out = compare(spark, f"/root/testdata/sf{size}", "op11_divergence", QUERIES["op11_divergence"], ORACLE["op11_divergence"])
    assert out["status"] == "match", out


def test_query_against_brute_force(spark, docs_pd):
    rows = [tuple(r) for r in QUERIES["op11_divergence"](spark, SF).collect()]
    assert set(rows) == brute(list(zip(docs_pd.lang, docs_pd.source, docs_pd.text)))
