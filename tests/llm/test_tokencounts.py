import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from gridlake.llm import tokencounts as tc
from gridlake.llm.queries import QUERIES
from tests.llm.conftest import SF

PATH = P.path("byte_bpe_50k.json")


def test_query_against_brute_force(spark, docs_pd):
    library = Tokenizer.from_file(PATH)
    size = np.array([len(library.encode(t or "", add_special_tokens=False).ids) for t in docs_pd.text])
    limits = QUERIES["op3_token_counts"](spark, SF).cache()
    rows = limits.collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(size.tolist()))
    for r in rows:
        kept = int(np.minimum(size, r.n_tokens).sum())
        assert (r.n_docs, r.docs_over, r.tokens_kept, r.tokens_lost) == (
            (size == r.n_tokens).sum(), (size > r.n_tokens).sum(), kept, size.sum() - kept
        )
        assert abs(r.share_within - (size <= r.n_tokens).mean()) < 1e-12
    for limit in (0, 1, 77, 512, 10**9):
        assert tc.truncated_total(limits, limit).first()[0] == np.minimum(size, limit).sum()
    for q in (0.01, 0.5, 0.9, 1.0):
        assert tc.quantile(limits, q).first()[0] == sorted(size)[int(np.ceil(q * len(size))) - 1]


def test_odd_rows_and_empty_table(odd_docs, no_docs):
    out = {r.n_tokens: r.n_docs for r in tc.token_counts(odd_docs, PATH).collect()}
    assert sum(out.values()) == odd_docs.count() and out[0] == 2
    empty = tc.token_counts(no_docs, PATH)
    assert empty.count() == 0 and tc.truncated_total(empty, 10).first()[0] == 0 and tc.quantile(empty, 0.5).first()[0] is None
