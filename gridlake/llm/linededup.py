"""Line dedup with two Bloom filters.

A first pass over the documents sets each line key's bits in a once-seen
filter and, when they were set already, in a twice-seen filter. Tasks build
both for their own rows and emit the non-empty chunks; merging a task's
chunk adds ``once & seen`` to the twice-seen bits, so a key of two documents
is always in the merged twice-seen filter. A second pass emits only lines
that filter holds; these suspects are shuffled by their whole key, which
decides exactly whether two documents hold it and which is the first. False
positives of the filter cost shuffle, never results.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import materialize

BLANK = " \t\n\x0b\x0c\r"
CHUNK = 1 << 16
#: Bits per line, and the filter's bounds. A filter of 2**30 bits (128 MB, in
#: the driver and once in each Python worker) holds 67 million lines at full
#: accuracy; beyond, more unique lines are suspected and shuffled.
BITS_PER_LINE, MIN_BITS, MAX_BITS = 16, 1 << 19, 1 << 30
NO_ID = 2**63 - 1


def line_key(line: str, min_chars: int) -> bytes | None:
    """The line's key in UTF-8; None if it is shorter than ``min_chars`` code points."""
    key = line.strip(BLANK)
    return key.encode().lower() if len(key) >= min_chars else None


def _keys(text: str | None, min_chars: int) -> set[bytes]:
    keys = {line_key(x, min_chars) for x in (text or "").split("\n")}
    keys.discard(None)
    return keys


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions for each 64-bit hash."""
    mask = np.uint64(bits - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def _holds(filter_: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    out = np.ones(len(hashes), bool)
    for at in _places(hashes, bits):
        out &= (filter_[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return out


def _set(filter_: np.ndarray, hashes: np.ndarray, bits: int) -> None:
    for at in _places(hashes, bits):
        np.bitwise_or.at(filter_, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def _hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64)


def twice_seen(docs: DataFrame, text: str, min_chars: int) -> tuple[np.ndarray, int]:
    """The twice-seen filter of all documents, and its bits."""
    lines = docs.agg(
        F.sum(F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1).alias("n")
    ).first().n or 1
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (int(lines) * BITS_PER_LINE).bit_length()))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            found = [_hashes(_keys(t, min_chars)) for t in batch.column(0).to_pylist()]
            hashes, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            _set(twice, hashes[(n > 1) | _holds(once, hashes, bits)], bits)
            _set(once, hashes, bits)
        for at in range(0, len(once), CHUNK):
            part = once[at : at + CHUNK]
            if part.any():
                packed = [zlib.compress(x[at : at + CHUNK].tobytes(), 1) for x in (once, twice)]
                yield pa.RecordBatch.from_pydict(
                    {"chunk": pa.array([at // CHUNK], pa.int32()), "once": pa.array([packed[0]], pa.binary()),
                     "twice": pa.array([packed[1]], pa.binary())}
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for chunk, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                once, twice = (np.frombuffer(zlib.decompress(x), np.uint8) for x in packed)
                if chunk not in state:
                    state[chunk] = once.copy(), twice.copy()
                else:
                    seen, both = state[chunk]
                    both |= twice | (seen & once)
                    seen |= once
        for chunk, (_, both) in state.items():
            if both.any():
                yield pa.RecordBatch.from_pydict(
                    {"chunk": pa.array([chunk], pa.int32()), "twice": pa.array([zlib.compress(both.tobytes(), 1)], pa.binary())}
                )

    parts = docs.select(text).mapInArrow(build, "chunk int, once binary, twice binary")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = parts.repartition(n, "chunk").mapInArrow(merge, "chunk int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for r in merged.collect():  # the filter's chunks: at most MAX_BITS
        part = np.frombuffer(zlib.decompress(r.twice), np.uint8)
        out[r.chunk * CHUNK : r.chunk * CHUNK + len(part)] = part
    return out, bits


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10) -> DataFrame:
    """``docs`` with every repeated line kept only in the smallest ``doc_id``
    that holds it; adds ``n_lines`` (before) and ``n_dropped`` (int64).

    A line's key is the line without ASCII blanks at its ends and with A-Z
    lower-cased; keys of fewer than ``min_chars`` code points always stay. A
    null text counts as empty (one empty line) and becomes an empty text.
    Rows with one ``doc_id`` are one document; null ids are one document
    after all others. Repeats of a line inside its first document stay. Empty
    tables give empty results; columns named n_lines or n_dropped are
    replaced, all others pass through.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    filter_, bits = twice_seen(docs, text, min_chars)
    sent = spark.sparkContext.broadcast(filter_)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = list(_keys(t, min_chars))
                if own:
                    hit = _holds(sent.value, _hashes(own), bits)
                    own = [k for k, h in zip(own, hit) if h]
                    ids += [doc] * len(own)
                    keys += own
            yield pa.RecordBatch.from_pydict({"doc": pa.array(ids, pa.int64()), "key": pa.array(keys, pa.binary())})

    ident = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    held = materialize(docs.select(ident.alias("doc"), text).mapInArrow(suspects, "doc long, key binary"), "lines")
    # written, so that the join below is between two plain exchanges, which AQE
    # can split where one key has many rows
    repeated = materialize(
        held.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first <> last")
        .select("key", "first"), "lines-repeated",
    )
    drops = (
        held.join(repeated, "key").filter("doc <> first")
        .groupBy("doc").agg(F.collect_set(F.unhex(F.md5("key"))).alias("_drop"))
    )
    at = docs.columns.index(text)
    schema = docs.withColumn(text, F.lit("")).schema
    for c in ("n_lines", "n_dropped"):
        schema = schema.add(c, "long")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, dropped = [], [], []
            for t, drop in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                all_lines = (t or "").split("\n")
                kept = all_lines
                if drop:
                    drop = set(drop)
                    kept = [
                        x for x in all_lines
                        if (k := line_key(x, min_chars)) is None or hashlib.md5(k).digest() not in drop
                    ]
                texts.append("\n".join(kept))
                lines.append(len(all_lines))
                dropped.append(len(all_lines) - len(kept))
            cols = batch.columns[:-1]
            cols[at] = pa.array(texts, pa.string())
            cols += [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    # lists of dropped keys are short beside the texts: hash them, don't sort the texts
    joined = docs.withColumn("_doc", ident).join(
        drops.withColumnRenamed("doc", "_doc").hint("shuffle_hash"), "_doc", "left"
    )
    return joined.select(*docs.columns, "_drop").mapInArrow(rebuild, schema)
