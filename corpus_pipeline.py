"""A training corpus from raw documents: reject poor texts, drop repeated
lines, keep one document of each near-duplicate group, replace personal data,
and pack what is left into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``. ``run`` writes each stage's result as
Parquet into the shared checkpoint folder and reads it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm.common import materialize, table
from gridlake.llm.linededup import dedup_lines
from gridlake.llm.packing import pack_pieces, token_pieces
from gridlake.llm.pii import pseudonymize
from gridlake.llm.quality import score_quality, train
from gridlake.llm.simhash import keep_first_of_groups

#: Documents below this score are rejected: those more likely poor than good.
REJECT = 0.5
#: For demonstration; a real key is a secret of the caller.
PII_KEY = "documents-demonstration-key"

# No SQL: the classifier, the tokenizer and the pseudonyms are beyond it.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier, trained on the labelled ones
    among the raw documents, scores below REJECT."""
    model = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return score_quality(docs, model).filter(F.col("score") >= REJECT).select(*docs.columns)


def _retext(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars (where there is one) following
    the new text."""
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep each repeated line in the first document that holds it only."""
    return _retext(dedup_lines(docs), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each SimHash group."""
    return keep_first_of_groups(docs, shingle=3, max_bits=2).select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms."""
    return _retext(pseudonymize(docs, PII_KEY), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences of at most 2048."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_pieces(token_pieces(docs, path, limit=2048), limit=2048)


STAGES = [
    ("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("pii", pii), ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
