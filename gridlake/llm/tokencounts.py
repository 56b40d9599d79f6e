"""Exact length histogram of the documents' token counts.

Documents are aggregated by encoded length; suffix sums over the distinct
lengths answer document and token totals, quantiles and the tokens that any
context limit leaves, without another look at the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.bpe import encode_documents
from gridlake.llm.common import materialize

#: Lengths per block of the two-level suffix sums.
BLOCK = 1024


def length_histogram(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(n_tokens, n_docs): documents of each encoded length, by the tokenizer
    file at ``path``. Null and empty texts have length 0; repeated rows count
    each; an empty table has no rows; other columns are not read."""
    # the ids stay in the task that makes them; only (length, count) is shuffled
    lengths = encode_documents(docs.select(text), path, text).select("n_tokens")
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def with_limits(histogram: DataFrame) -> DataFrame:
    """Per distinct length, taken as a context limit: ``n_docs`` of just that
    length, ``docs_over`` (longer ones), ``tokens_kept`` (all documents cut at
    the limit), ``tokens_lost`` and ``share_within`` (documents not cut).

    Lengths are grouped in blocks of BLOCK: a window inside each block, and
    one over the blocks' totals, of which a document of a billion tokens
    makes a million at most."""
    h = histogram.withColumn("_block", F.floor(F.col("n_tokens") / BLOCK)).withColumn(
        "_tokens", F.col("n_docs") * F.col("n_tokens")
    )
    longer = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        h.groupBy("_block").agg(F.sum("n_docs").alias("d"), F.sum("_tokens").alias("t"))
        .select(
            "_block", F.coalesce(F.sum("d").over(longer), F.lit(0)).alias("_d"),
            F.coalesce(F.sum("t").over(longer), F.lit(0)).alias("_t"),
        )
    )
    docs, tokens = histogram.agg(F.sum("n_docs"), F.sum(F.col("n_docs") * F.col("n_tokens"))).first()
    inside = Window.partitionBy("_block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    over = F.col("_d") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0))
    over_tokens = F.col("_t") + F.coalesce(F.sum("_tokens").over(inside), F.lit(0))
    return (
        h.join(blocks, "_block")
        .withColumn("docs_over", over)
        .withColumn("tokens_lost", over_tokens - F.col("docs_over") * F.col("n_tokens"))
        .select(
            "n_tokens", "n_docs", "docs_over", (F.lit(tokens).cast("long") - F.col("tokens_lost")).alias("tokens_kept"),
            "tokens_lost", (1 - F.col("docs_over") / F.lit(docs).cast("long")).alias("share_within"),
        )
    )


def truncated_total(limits: DataFrame, limit: int) -> DataFrame:
    """The tokens that all documents keep when cut at ``limit`` (one row,
    ``tokens_kept``; 0 for an empty table). Exact between the table's lengths
    too: a document over the limit keeps just ``limit`` tokens, and the
    documents over it are those over the last length up to it."""
    longer = F.col("n_tokens") > limit
    return limits.agg(
        F.coalesce(
            F.sum(F.col("n_docs") * F.when(longer, F.lit(limit)).otherwise(F.col("n_tokens"))), F.lit(0)
        ).cast("long").alias("tokens_kept")
    )


def quantile(limits: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least a share ``q`` of the documents does
    not exceed (one row; null for an empty table)."""
    return limits.filter(F.col("share_within") >= q).agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The histogram with its suffix sums (see ``with_limits``)."""
    return with_limits(materialize(length_histogram(docs, path, text), "lengths"))
