"""The pipeline stage by stage against plain versions of each stage."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from gridlake.llm import quality
from gridlake.llm.common import materialize
from tests.llm.conftest import SF
from tests.llm.test_linededup import brute
from tests.llm.test_packing import check_packed
from tests.llm.test_simhash import brute_components, brute_fp


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's rows, by name; the input comes first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        out[name] = docs
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "line_dedup", "near_dedup", "pii", "packing"]
    for name in ("quality", "line_dedup", "near_dedup", "pii"):
        assert stages[name].dtypes == stages["documents"].dtypes


def test_quality_rejects_by_score_and_keeps_clean(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(stages["documents"], labels)
    before, after = texts(stages["documents"]), texts(stages["quality"])
    score = {i: model.score(np.array([quality.features(t)]))[0] for i, t in before.items()}
    assert after == {i: t for i, t in before.items() if score[i] >= cp.REJECT}
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert len(good & set(after)) >= 0.99 * len(good)


def test_line_dedup(stages):
    want = {i: t for i, (_, _, t) in brute(list(texts(stages["quality"]).items())).items()}
    assert texts(stages["line_dedup"]) == want
    assert all(r.n_chars == len(r.text) for r in stages["line_dedup"].collect())


def test_near_dedup(stages):
    before = texts(stages["line_dedup"])
    ids = sorted(before)
    groups = brute_components(ids, [brute_fp(before[i]) for i in ids], 2)
    assert texts(stages["near_dedup"]) == {i: before[i] for i in ids if groups[i] == i}


def test_pii(stages):
    before, after = texts(stages["near_dedup"]), texts(stages["pii"])
    assert set(before) == set(after)
    mail = stages["near_dedup"].select(F.explode(F.regexp_extract_all("text", F.lit(r"[a-z]+\.\d+@mail\d\.example\.com"), F.lit(0))).alias("m"))
    found = {r.m for r in mail.collect()}
    assert found and not any(m in t for m in found for t in after.values())


def test_packing(stages):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {}
    for i, t in texts(stages["pii"]).items():
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            want[i, k // 2048] = zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())
    rows = stages["packing"].collect()
    assert {(r.doc_id, r.piece): r.ids_crc32 for r in rows} == want
    check_packed(rows, 2048)


def test_run_gives_the_last_stage(spark, stages):
    key = lambda r: (r.doc_id, r.piece, r.ids_crc32)
    assert sorted(map(key, cp.run(spark, SF).collect())) == sorted(map(key, stages["packing"].collect()))


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs):
    docs, none = odd_docs, no_docs
    for _, stage in cp.STAGES:
        docs, none = materialize(stage(spark, docs, SF), "odd"), materialize(stage(spark, none, SF), "none")
        assert none.count() == 0
    assert docs.count() >= 0
