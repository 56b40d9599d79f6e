"""What the two vector operators share: valid vectors and identical ones."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid_vectors(df: DataFrame, vec_id: str, embedding: str, label: str | None = None) -> DataFrame:
    """(id, label, dim, digest, vec) of the rows whose id and vector (and
    label, if named) take part: no nulls, finite, not zero. ``vec`` holds the
    components as little-endian doubles, ``digest`` 128 bits of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, dim, digest, vec = [], [], [], []
            for i, v in enumerate(batch.column(2).to_pylist()):
                if v is None or None in v:
                    continue
                x = np.array(v, "<f8") + 0.0  # no negative zeros
                if np.isfinite(x).all() and x.any():
                    keep.append(i)
                    dim.append(len(x))
                    vec.append(x.tobytes())
                    digest.append(hashlib.blake2b(vec[-1], digest_size=16).digest())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(dim, pa.int32()),
                 pa.array(digest, pa.binary()), pa.array(vec, pa.binary())],
                names=["id", "label", "dim", "digest", "vec"],
            )

    of = F.col(label).cast("string") if label else F.lit("")
    rows = df.select(F.col(vec_id).cast("long").alias("id"), of.alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    return rows.filter("id IS NOT NULL AND label IS NOT NULL").mapInArrow(
        run, "id long, label string, dim int, digest binary, vec binary"
    )


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of vectors of ``dim`` doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)
