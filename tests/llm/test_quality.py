import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gridlake.llm import quality as q
from gridlake.llm.queries import QUERIES
from tests.llm.conftest import SF


def test_query_scores_every_document_and_separates_held_out(spark):
    d = "/root/testdata/sf0.01"
    out = QUERIES["op1_quality"](spark, d).toPandas()
    docs = pd.read_parquet(f"{d}/documents.parquet")
    assert sorted(out.doc_id) == sorted(docs.doc_id) and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    assert (out.predicted == (out.score >= 0.7)).all()
    held = out[out.held_out].merge(pd.read_parquet(f"{d}/labels.parquet"), on="doc_id")
    assert ((held.predicted == held.quality).mean()) > 0.97


def test_held_out_labels_do_not_matter(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    spoiled = labels.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = q.train(docs, labels), q.train(docs, spoiled)
    x = np.random.default_rng(1).random((50, len(q.FEATURES)))
    assert (a.score(x) == b.score(x)).all()


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no feature tells anything alone
    model = q.fit(x, y)
    assert (0, 1) in [(f, g) for f, g, _ in model.pairs]
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.random((500, 3))
    model = q.fit(x, (x[:, 0] > 0.3).astype(float))
    for row, score in zip(x[:20], model.score(x[:20])):
        total = model.intercept + sum(t[sum(row[f] >= e for e in model.edges[f])] for f, t in enumerate(model.tables))
        total += sum(
            t[sum(row[f] >= e for e in model.coarse[f]), sum(row[g] >= e for e in model.coarse[g])] for f, g, t in model.pairs
        )
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-12


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (4, 0), (None, 1), (5, None), (5, 1), (8, 0)], "doc_id long, quality int"
    )
    for model in (q.train(odd_docs, labels), q.train(odd_docs, labels.limit(0)), q.train(no_docs, labels)):
        rows = q.score_quality(odd_docs, model).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert q.score_quality(no_docs, model).count() == 0
    assert len({r.score for r in rows if r.doc_id == 2}) == 1
