"""Keep-one-row-per-key operators.

Both are ``row_number() = 1`` over a key window; Catalyst plans this as
``WindowGroupLimit`` (partial, before the shuffle) + ``Window`` (final), so
the map side already drops most duplicates. The window is partitioned by the
full key (entity *and* instant), so one hot entity spreads over every
shuffle partition instead of landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_gl_rn"
_NK = "_gl_null_key"
_PRIO = "_gl_priority"


def _row_hash(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    cols = [F.col(c) for c in df.columns if c not in exclude]
    return F.xxhash64(*cols)


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    keep_null_keys: bool = True,
) -> DataFrame:
    """Keep the first row per ``keys`` under ``order``.

    A deterministic tie-break (a hash of the whole row) is appended, so the
    same input gives the same output on every run. Rows whose key has a NULL
    are passed through untouched when ``keep_null_keys`` (they do not
    collapse into one another).
    """
    part = [F.col(k) for k in keys]
    if keep_null_keys:
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | F.col(k).isNull()
        df = df.withColumn(_NK, F.when(any_null, F.monotonically_increasing_id()))
        part.append(F.col(_NK))
    w = Window.partitionBy(*part).orderBy(*order, _row_hash(df, exclude=(_NK,)).desc())
    out = df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
    return out.drop(_NK) if keep_null_keys else out


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str] = ("meter_id", "reading_ts"),
    order_col: str = "_ingested_at",
    keep_null_keys: bool = True,
) -> DataFrame:
    """Keep the most recently ingested copy per key (NULL ingest time
    last). ``keys`` must already be typed (so one instant written with two
    offsets collapses)."""
    return keep_first(df, keys, [F.col(order_col).desc_nulls_last()], keep_null_keys)


def prioritised_union(
    frames: Sequence[DataFrame],
    keys: Sequence[str],
    keep_null_keys: bool = True,
) -> DataFrame:
    """U1 + W2: union by column name (missing columns become NULL), then per
    key keep the row of the earliest frame in ``frames``."""
    tagged = None
    for i, f in enumerate(frames, start=1):
        t = f.withColumn(_PRIO, F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    out = keep_first(tagged, keys, [F.col(_PRIO).asc()], keep_null_keys)
    return out.drop(_PRIO)
