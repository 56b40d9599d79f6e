"""Registered queries of this subpackage: each applies one operator to its
whole table and derives the contract's columns from the operator's result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm.annsearch import nearest
from gridlake.llm.bpe import decode_documents, encode_documents
from gridlake.llm.clustering import centroid_digest, cluster_vectors
from gridlake.llm.common import materialize, table
from gridlake.llm.divergence import divergence
from gridlake.llm.linededup import dedup_lines
from gridlake.llm.packing import pack_pieces, token_pieces
from gridlake.llm.pii import pseudonymize
from gridlake.llm.quality import held_out, score_quality, train
from gridlake.llm.secrets import find_secrets, joined, of_kinds
from gridlake.llm.sharding import histogram_shards, text_key
from gridlake.llm.simhash import hex_fingerprint, simhash_components
from gridlake.llm.tokencounts import token_counts
from gridlake.llm.vecdedup import embedding_components


#: For demonstration; a real key is a secret of the caller.
PII_KEY = "documents-demonstration-key"


def op1_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = train(docs, table(spark, d, "labels"))
    return score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op2_packing(spark: SparkSession, d: str) -> DataFrame:
    pieces = token_pieces(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)
    return pack_pieces(pieces, limit=2048)


def op3_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_bpe(spark: SparkSession, d: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = encode_documents(table(spark, d, "documents").select("doc_id", "text"), path).drop("text")
    return decode_documents(encoded, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op5_pii(spark: SparkSession, d: str) -> DataFrame:
    return pseudonymize(table(spark, d, "documents"), PII_KEY)


def op6_embedding_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = embedding_components(table(spark, d, "embeddings"), threshold=0.98)
    return found.select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op7_sharding(spark: SparkSession, d: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialize(
        table(spark, d, "documents").select(
            "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), text_key(F.col("text")).alias("key"),
        ),
        "shards",
    )
    out = histogram_shards(rows, F.col("key"), F.col("doc_id"), F.col("size"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_simhash(spark: SparkSession, d: str) -> DataFrame:
    found = simhash_components(table(spark, d, "documents"), shingle=3, max_bits=2)
    return found.select(
        F.col("doc").alias("doc_id"), hex_fingerprint("fp").alias("fingerprint"), F.col("component").alias("component_id")
    )


def op9_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = dedup_lines(table(spark, d, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_nearest(spark: SparkSession, d: str) -> DataFrame:
    return nearest(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op11_divergence(spark: SparkSession, d: str) -> DataFrame:
    return divergence(table(spark, d, "documents"))


def op12_clustering(spark: SparkSession, d: str) -> DataFrame:
    found = cluster_vectors(table(spark, d, "embeddings"), k=8, rounds=10, dim=64, scale=1024, seed=3)
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid_digest("centroid").alias("centroid_sha256")
    )


def op13_secrets(spark: SparkSession, d: str) -> DataFrame:
    base = ("assign", "access", "hex")
    found = find_secrets(table(spark, d, "documents"))
    counts = [F.size(of_kinds("spans", k)).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(joined("spans", *base), 256).alias("base_sha256"), joined("spans").alias("spans"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_token_counts": op3_token_counts,
    "op4_bpe": op4_bpe,
    "op5_pii": op5_pii,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_sharding": op7_sharding,
    "op8_simhash": op8_simhash,
    "op9_line_dedup": op9_line_dedup,
    "op10_nearest": op10_nearest,
    "op11_divergence": op11_divergence,
    "op12_clustering": op12_clustering,
    "op13_secrets": op13_secrets,
}
