"""Global running offsets without a single-partition window.

``Window.orderBy(...)`` with no partition moves every row into one task.
``with_offset`` computes the same "sum of weights of all rows before this
one in the global order" in a distributed way:

1. range-partition the rows on the order (so partition i holds only keys
   below partition i+1; a hot key range is split by the sampler), tag each
   row with its partition id, and write that with a reliable
   ``checkpoint`` into the shared checkpoint folder (one eager job). The
   two consumers below (running sums and per-partition totals) must see the
   *same* partition id for every row. Two evaluations of a range exchange
   are not guaranteed to agree, and a persisted relation is not guaranteed
   to be used by both sides of a self-join (when it was not, with AQE off,
   the offsets came out wrong; ``tests/test_gold_dims.py`` guards this),
   so the ids are materialised once and both sides read the same files;
2. running sum inside each partition (a window partitioned by the
   partition id);
3. per-partition totals -> prefix over partitions. That table has one row
   per partition (and group), a size bounded by the partition count, so it
   is broadcast back.

Nothing is left cached, and an executor loss re-reads the checkpoint files.

Used for dense surrogate keys (weight 1) and exact quantiles over value
counts (weight = count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.session import cut_lineage

_PID = "_gl_pid"
_W = "_gl_w"


def with_offset(
    df: DataFrame,
    order: Sequence[str],
    out: str = "_before",
    weight: str | None = None,
    groups: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = sum of ``weight`` (1 when None) over the rows that come
    strictly before this row, ordering by ``order`` within each of ``groups``.
    The ``order`` columns must be unique within a group.

    The range partition count defaults to the shuffle partitions, so tasks do
    not grow with the data; the per-partition table has one row per range (and
    group)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*groups, *order]
    ranged = cut_lineage(
        df.repartitionByRange(n, *keys)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_W, F.col(weight) if weight else F.lit(1).cast("long"))
    )
    before_in_part = Window.partitionBy(_PID, *groups).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    local = ranged.withColumn("_gl_local", F.coalesce(F.sum(_W).over(before_in_part), F.lit(0)))
    totals = ranged.groupBy(_PID, *groups).agg(F.sum(_W).alias("_gl_tot"))
    before_parts = Window.partitionBy(*groups).orderBy(_PID).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        _PID, *groups, F.coalesce(F.sum("_gl_tot").over(before_parts), F.lit(0)).alias("_gl_off")
    )
    joined = local.join(F.broadcast(offsets), [_PID, *groups], "inner")
    return joined.withColumn(out, F.col("_gl_off") + F.col("_gl_local")).drop(
        _PID, _W, "_gl_local", "_gl_off"
    )


def with_sequence(
    df: DataFrame, order: Sequence[str], out: str = "seq", start: int = 1
) -> DataFrame:
    """Dense 1-based sequence number in the global order of ``order``
    (unique keys), equal to ``row_number() OVER (ORDER BY order)``."""
    return with_offset(df, order, out=out).withColumn(out, (F.col(out) + start).cast("long"))
