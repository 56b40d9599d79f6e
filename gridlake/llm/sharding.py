"""Sharding by histogram sort.

Rows are ordered by (key, tie). For each of the ``n - 1`` inner shard
boundaries the exact number of bytes below candidate keys is counted over
all partitions, one radix digit at a time: a round is one aggregation whose
result has at most 2**RADIX rows per boundary, and only rows inside the
still open bins take part in the next one. When the splitters are known
every row's shard follows from its key alone, and one exchange puts the
rows in place.

Only built-in functions run on the rows; the driver sees bin counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RADIX = 8
KEY_BITS = 60
_LOW = -(2**63)
#: Longs are refined as unsigned numbers: no difference of two can overflow.
_MASK = 2**64 - 1


@dataclass(frozen=True)
class Splitter:
    """Rows with (key, tie) below (``key``, ``tie``) lie below byte ``at``;
    ``tie`` None stands for the start of the key's group."""

    key: int
    tie: int | None
    at: int


def text_key(text: Column) -> Column:
    """60 bits of the text's MD5: equal texts get equal, neighbouring keys
    (a null text counts as empty)."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _refine(rows: DataFrame, value: str, brackets: dict, width: int, group: str | None = None) -> dict:
    """Narrow each target to the single ``value`` whose bytes hold it.

    ``value`` is read as an unsigned number. ``brackets``: target -> (group,
    low, bytes below low); the bracket spans ``2**width`` values from low, a
    multiple of that. Returns target -> (value, bytes below it, bytes up
    to its end)."""
    done: dict = {}
    while brackets:
        shift = max(width - RADIX, 0)
        by_low = sorted({(g, low) for g, low, _ in brackets.values()}, key=lambda x: (x[0] or 0, x[1]))
        # which open bracket the row lies in, then its digit there
        col = None
        for g, low in by_low:
            inside = F.shiftrightunsigned(value, width) == F.lit(low >> width) if width < 64 else F.lit(True)
            if group:
                inside = inside & (F.col(group) == F.lit(g))
            bin_ = F.struct(
                F.lit(g).cast("long").alias("g"), F.lit(_signed(low)).cast("long").alias("low"),
                F.shiftrightunsigned(value, shift).alias("d"),
            )
            col = F.when(inside, bin_) if col is None else col.when(inside, bin_)
        counts: dict = {}
        found = (
            rows.withColumn("_bin", col).filter(F.col("_bin").isNotNull()).groupBy("_bin")
            .agg(F.sum("_size").alias("b"), F.min(value).alias("lo"), F.max(value).alias("hi"))
            .select("_bin.*", "b", "lo", "hi")
        )
        for r in found.collect():  # at most 2**RADIX rows per open bracket
            counts.setdefault((r.g, r.low & _MASK), []).append((r.d & _MASK, r.b, r.lo & _MASK, r.hi & _MASK))
        nxt = {}
        for t, (g, low, below) in brackets.items():
            for d, b, lo, hi in sorted(counts[g, low]):
                if below + b > t:
                    if lo == hi:
                        done[t] = (lo, below, below + b)
                    else:
                        nxt[t] = (g, d << shift, below)
                    break
                below += b
        brackets, width = nxt, shift
    return done


def splitters(rows: DataFrame, n: int, tolerance: float) -> tuple[list[Splitter], int]:
    """The ``n - 1`` splitters of ``rows`` (columns _key, _tie, _size), and
    the total of ``_size``.

    Target k is byte ``total * k // n``. It falls into the bytes of one key
    (one group of equal texts). The nearer end of that group is taken when it
    lies within ``tolerance`` of a shard's bytes, so that groups stay whole;
    else the group is cut at the tie value whose nearer end is closest."""
    total = rows.agg(F.sum("_size")).first()[0] or 0
    targets = sorted({total * k // n for k in range(1, n)})
    if not total:
        return [], 0
    near = int(total * tolerance) // n
    held = _refine(rows, "_key", {t: (None, 0, 0) for t in targets}, KEY_BITS)
    out: dict[int, Splitter] = {}
    cut: dict[int, tuple[int, int]] = {}
    for t, (key, start, end) in held.items():
        if min(t - start, end - t) <= near:
            out[t] = Splitter(key, None, start) if t - start <= end - t else Splitter(key + 1, None, end)
        else:
            cut[t] = (key, start)
    if cut:
        keys = sorted({k for k, _ in cut.values()})
        inner = rows.filter(F.col("_key").isin(keys)).withColumn("_unsigned", F.col("_tie").bitwiseXOR(F.lit(_LOW)))
        ties = {
            r[0]: (r[1] - _LOW, r[2] - _LOW) for r in inner.groupBy("_key").agg(F.min("_tie"), F.max("_tie")).collect()
        }
        width = max((hi ^ lo).bit_length() for lo, hi in ties.values())
        brackets = {t: (key, ties[key][0] >> width << width, start) for t, (key, start) in cut.items()}
        for t, (tie, start, end) in _refine(inner, "_unsigned", brackets, width, "_key").items():
            key, tie = cut[t][0], tie + _LOW
            if t - start <= end - t:
                out[t] = Splitter(key, tie, start)
            else:
                out[t] = Splitter(key, tie + 1, end) if tie < -_LOW - 1 else Splitter(key + 1, None, end)
    return [out[total * k // n] for k in range(1, n)], total


def histogram_shards(
    df: DataFrame, key: Column, tie: Column, size: Column, n: int = 24, tolerance: float = 0.005
) -> DataFrame:
    """``df`` plus ``shard`` (int, 0 to ``n - 1``) and ``slot`` (long, gapless
    from 0 in each shard, in (key, tie) order): shards of near equal ``size``
    totals, equal keys side by side and, within ``tolerance`` of a shard, in
    one shard.

    ``key`` has 60 bits, ``tie`` is a long (null: lowest). ``df`` is read once
    per refinement round, so pass a narrow or materialized frame. A null size
    counts as 0. Rows equal in key and tie stay together and are ordered
    arbitrarily. An empty table gives an empty result. Extra columns pass
    through (names starting with an underscore and ``shard``/``slot`` are
    replaced).
    """
    rows = (
        df.drop("shard", "slot").withColumn("_key", key)
        .withColumn("_tie", F.coalesce(tie.cast("long"), F.lit(_LOW)))
        .withColumn("_size", F.coalesce(size.cast("long"), F.lit(0)))
    )
    cuts, _ = splitters(rows, n, tolerance)
    shard = F.lit(0)
    for c in cuts:
        below = F.col("_key") < c.key
        if c.tie is not None:
            below = below | ((F.col("_key") == c.key) & (F.col("_tie") < F.lit(c.tie)))
        shard = shard + F.when(below, 0).otherwise(1)
    rows = rows.withColumn("shard", shard.cast("int"))

    # Slots: exact row counts per fine bin of a shard give each bin's first
    # slot, so ranks are needed inside bins only. Keys of many rows get bins
    # of their own, cut further at quantiles of the tie.
    n_rows = rows.count()
    bits = max(12, (n_rows // 50_000).bit_length())
    heavy = sorted(
        rows.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max(32, n_rows // (n * 8)))
        .collect()  # at most 8 n keys hold so many rows
    )
    part = [F.lit(0), F.lit(False), F.lit(0)]
    if heavy:
        depth = min(10, max(6, (max(r.n for r in heavy) // 50_000).bit_length()))
        keys = F.array(*[F.lit(r["_key"]) for r in heavy])
        quantiles = (
            rows.filter(F.array_contains(keys, F.col("_key"))).groupBy("_key")
            .agg(F.percentile_approx("_tie", [i / 2**depth for i in range(1, 2**depth)]).alias("cuts"))
            .collect()  # 2**depth - 1 numbers a key
        )
        of_key = F.create_map(*[
            x for r in quantiles
            for x in (F.lit(r["_key"]), F.split(F.lit(",".join(map(str, sorted(r.cuts)))), ",").cast("array<bigint>"))
        ])

        def below(cuts: Column) -> Column:
            """How many of the sorted cuts are not above the tie."""
            steps = F.array(*[F.lit(2**i) for i in reversed(range(depth))])
            return F.aggregate(
                steps, F.lit(0), lambda at, step: F.when(F.element_at(cuts, at + step) <= F.col("_tie"), at + step).otherwise(at)
            )

        own = F.array(F.try_element_at(of_key, F.col("_key")))
        part = [
            F.size(F.filter(keys, lambda x: x < F.col("_key"))),
            F.array_contains(keys, F.col("_key")),
            F.when(F.array_contains(keys, F.col("_key")), F.element_at(F.transform(own, below), 1)).otherwise(0),
        ]
    rows = rows.withColumn("_bin", F.struct(F.shiftright("_key", KEY_BITS - bits), *part))
    w = Window.partitionBy("shard").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "_bin").agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", "_bin", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("shard", "_bin").orderBy("_key", "_tie")
    return (
        rows.withColumn("_rn", F.row_number().over(inside))
        .join(starts, ["shard", "_bin"])
        .withColumn("slot", (F.col("_start") + F.col("_rn") - 1).cast("long"))
        .drop("_key", "_tie", "_size", "_bin", "_start", "_rn")
    )
