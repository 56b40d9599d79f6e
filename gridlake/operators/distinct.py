"""Distinct counts that merge.

A count of distinct meters can't be added up, so each subtotal of a rollup
would need its own pass over every (meter, node) pair. A state can: per leaf
and bucket of 32,768 neighbouring ids, a bitmap with a bit for each id seen.
Bitmaps of leaves are united into those of the levels above, of days into
those of a month, and of a new batch into those on file; the set bits are the
count. A bucket takes 4 KB, so this is for ids that lie close together
(``dense_ids`` numbers any others). ``kind="hll"`` keeps a HyperLogLog sketch
per leaf instead: approximate, for any ids, of bounded size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.operators.ordering import with_sequence

BUCKET, STATE = "_bucket", "_state"
KINDS = ("bitmap", "hll")
#: Base-2 logarithm of a sketch's registers: 1.6 % of standard error.
HLL_BITS = 12


def _checked(kind: str) -> bool:
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    return kind == "hll"


def distinct_state(
    df: DataFrame, dims: Sequence[str], key: str, sums: Mapping[str, Column] | None = None, kind: str = "bitmap"
) -> DataFrame:
    """The state of the distinct ``key`` values per ``dims``: rows (dims,
    ``_bucket``, ``_state``) and the additive aggregates ``sums`` (name to
    aggregate). Partial aggregates unite the bits before the shuffle, so that
    carries at most one state per task, leaf and bucket, whatever a leaf
    holds. A null ``key`` sets no bit; its rows count in ``sums``."""
    if _checked(kind):
        bucket, state = F.lit(0).cast("long"), F.hll_sketch_agg(F.col(key), F.lit(HLL_BITS))
    else:
        bucket = F.bitmap_bucket_number(F.col(key))
        state = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key)))
    own = [c.alias(name) for name, c in (sums or {}).items()]
    return df.groupBy(*dims, bucket.alias(BUCKET)).agg(state.alias(STATE), *own)


def merge_state(state: DataFrame, dims: Sequence[str], sums: Sequence[str] = (), kind: str = "bitmap") -> DataFrame:
    """States united over all but ``dims`` (of one table, or of several in a
    union): again a state, of fewer dimensions or of more data."""
    return state.groupBy(*dims, BUCKET).agg(_union(kind).alias(STATE), *[F.sum(c).alias(c) for c in sums])


def count_state(
    state: DataFrame, dims: Sequence[str], name: str, sums: Sequence[str] = (), kind: str = "bitmap"
) -> DataFrame:
    """The counts of a state that has one row per (dims, bucket)."""
    held = F.hll_sketch_estimate(STATE) if _checked(kind) else F.bitmap_count(STATE)
    return state.groupBy(*dims).agg(F.sum(held).alias(name), *[F.sum(c).alias(c) for c in sums])


def rollup_state(
    state: DataFrame, dims: Sequence[str], name: str, sums: Sequence[str] = (), level: str = "level", kind: str = "bitmap"
) -> DataFrame:
    """Every subtotal of ROLLUP(dims) from the leaves' state: the distinct
    count ``name``, the ``sums`` and ``level`` (the grouping id, int). Only
    states are expanded to the levels, never the rows below them."""
    sets = [[BUCKET, *dims[:i]] for i in range(len(dims), -1, -1)]
    # the bucket comes first and is in every set, so it adds nothing to the id
    united = state.groupingSets(sets, BUCKET, *dims).agg(
        _union(kind).alias(STATE), *[F.sum(c).alias(c) for c in sums], F.grouping_id().cast("int").alias(level)
    )
    return count_state(united, [*dims, level], name, sums, kind)


def _union(kind: str) -> Column:
    return F.hll_union_agg(STATE) if _checked(kind) else F.bitmap_or_agg(F.col(STATE))


def dense_ids(keys: DataFrame, key: str, number: str) -> DataFrame:
    """Each different non-null ``key`` with a gapless ``number`` from 1, in
    the key's order: what a dimension carries so that its bitmaps are full."""
    return with_sequence(keys.select(key).filter(F.col(key).isNotNull()).distinct(), [key], number)
