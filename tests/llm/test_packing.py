import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from gridlake.llm import packing as pk
from gridlake.llm.queries import QUERIES
from tests.llm.conftest import SF

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check_packed(rows, limit):
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_ids_as_the_library(library):
    rng = random.Random(2)
    letters = list("aabeeiounthrst  \n\t.,'sS!$1239éèßñÜÑ²½ªº×·§'''sdlmrvt")
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(2000)]
    texts += ["漢字 a", "é x", "İ a", "<|startoftext|> a", "I'll we've 'S a's", "", "x" * 3000, "'" * 500, "a\xadb", "\x1c a"]
    with open(PATH, encoding="utf-8") as f:
        own = pk.WordTokenizer(f.read())
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want


def test_full_tables_keep_frequent_words(library, monkeypatch):
    """New words fill the bounded tables many times over; a word of every text
    is encoded by the library once, and all ids stay right."""
    monkeypatch.setattr(pk, "CACHE", 200)
    with open(PATH, encoding="utf-8") as f:
        own = pk.WordTokenizer(f.read())
    made, word = [], own._word
    tables = [t for t in vars(own).values() if isinstance(t, pk._Table)]
    for t in tables:
        monkeypatch.setattr(t, "make", lambda w: made.append(w) or word(w))
    letters = "abcdefghij"
    texts = ["usual, " + " ".join("".join(letters[int(c)] for c in str(k)) for k in range(i * 50, i * 50 + 50)) for i in range(40)]
    for t in texts:
        assert own.encode([t]) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()]
        assert tables and all(len(t) + len(t.older) <= 200 for t in tables)
    assert made.count("usual") == 1 and made.count(",") == 1 and len(made) == 2002


def best_fit_bins(counts, limit):
    """Sequences that best fit decreasing needs."""
    room: list[int] = []
    for v in range(limit, 0, -1):
        for _ in range(int(counts[v])):
            fits = [k for k, r in enumerate(room) if r >= v]
            if fits:
                room[min(fits, key=room.__getitem__)] -= v
            else:
                room.append(limit - v)
    return len(room)


@pytest.mark.parametrize("seed", range(4))
def test_plan_packs_every_length_once(seed):
    rng = np.random.default_rng(seed)
    limit = [16, 64, 300, 2048][seed]
    counts = rng.integers(0, 9, limit + 1) * (rng.random(limit + 1) < 0.4)
    counts[limit // 2] += 300  # one length holds most rows
    counts[0] = 0
    plan = pk.plan_packing(counts, limit)
    used = np.zeros(limit + 1, np.int64)
    for n, parts in plan:
        assert n > 0 and sum(v * q for v, q in parts) <= limit
        for v, q in parts:
            used[v] += n * q
    assert (used == counts).all()
    assert sum(n for n, _ in plan) <= best_fit_bins(counts, limit)


def test_nnls_reaches_the_least_squares_solution():
    counts = np.array([0, 4, 6, 3, 5, 2, 4, 7, 1])
    found = pk.patterns(counts, 8)
    x = pk.fit_counts(counts, found, rounds=3000)
    a = np.zeros((9, len(found)))
    for j, p in enumerate(found):
        for v in p:
            a[v, j] += v
    gradient = a.T @ (a @ x - counts * np.arange(9)) / (a**2).sum(axis=0)
    # within half a sequence of the optimum's conditions
    assert (x >= 0).all() and (gradient > -0.5).all() and abs(gradient[x > 1e-6]).max() < 0.5


def test_query_against_brute_force(spark, docs_pd, library):
    rows = QUERIES["op2_packing"](spark, SF).collect()
    want = {}
    for i, e in zip(docs_pd.doc_id, library.encode_batch([t or "" for t in docs_pd.text], add_special_tokens=False)):
        ids = [*e.ids, 0]
        for k in range(0, len(ids), 2048):
            cut = ids[k : k + 2048]
            want[i, k // 2048] = (k, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    n, total = check_packed(rows, 2048), sum(r.length for r in rows)
    assert n <= -(-total // 2048) * 1.01 + 1


def test_odd_rows(odd_docs, no_docs, spark):
    pieces = pk.token_pieces(odd_docs, PATH, limit=512, keep_ids=True)
    rows = pk.pack_pieces(pieces, 512).collect()
    check_packed(rows, 512)
    empty = [r for r in rows if r.doc_id in (3, 4)]
    assert [(r.length, r.ids) for r in empty] == [(1, b"\0\0\0\0")] * 2
    assert sum(r.doc_id == 2 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 1
    assert all(len(r.ids) == 4 * r.length and r.start == 512 * r.piece for r in rows)
    assert pk.pack_pieces(pk.token_pieces(no_docs, PATH)).count() == 0
    odd = spark.createDataFrame([(1, None, "x"), (2, 0, "x"), (3, 5, "x"), (4, 5, "x")], "k int, length long, offset string")
    got = {r.k: (r.sequence_id, r.offset) for r in pk.pack_pieces(odd, 10).collect()}
    assert got[1] == got[2] == (None, None) and {got[3][1], got[4][1]} == {0, 5}
