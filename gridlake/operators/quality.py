"""Data-quality views: frequencies (A3), load curve (A4), counts (A5),
head (L1), column profile (A6)."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from gridlake.functions.scalar import exact_mean, known
from gridlake.functions.time import epoch_seconds, local_hour
from gridlake.session import ensure_checkpoint_dir

PERCENTILES = (0.25, 0.5, 0.75)


def value_frequencies(df: DataFrame, col: str = "quality") -> DataFrame:
    """A3 + L2: count per non-NULL value, most frequent first (ties by value)."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col(col).asc())
    )


def load_curve(
    df: DataFrame,
    ts: str = "reading_ts",
    value: str = "interval_kwh",
    zone: str = "UTC",
) -> DataFrame:
    """A4 + P6: mean ``value`` per hour of day (UTC by default)."""
    hour = F.hour(F.col(ts)) if zone == "UTC" else local_hour(F.col(ts), zone)
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(hour.alias("hour"))
        .agg(exact_mean(value).alias(f"avg_{value}"))
        .orderBy("hour")
    )


def table_counts(df: DataFrame) -> DataFrame:
    """A5: one row with the row count and column count (one aggregate pass)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("long")
    )


def head_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """L1: the first ``n`` rows in an explicit order (Spark has no file
    order). Planned as a TakeOrderedAndProject: a per-partition top-n, then
    one merge of n x partitions rows."""
    return df.orderBy(*order).limit(n)


def top_values(df: DataFrame, col: str, k: int = 10, tracked: int = 10_000) -> DataFrame:
    """The ``k`` most frequent non-NULL values of a column with their
    exact counts, most frequent first (ties by value), without counting every
    value.

    One pass builds a mergeable summary of frequent items that holds at most
    ``tracked`` values, however many there are; a second pass counts the
    candidates only. The summary misses no value that occurs more often than
    twice its error bound, so the answer is proven where the ``k``-th
    candidate does. Where it does not (a column of nearly equal frequencies)
    every value is counted.
    """
    size = 1 << math.ceil(math.log2(tracked / 0.75))
    summary = F.call_function("approx_top_k", F.col(col), F.lit(tracked), F.lit(tracked))
    row = df.agg(F.count(col).alias("n"), summary.alias("top")).first()
    error = 3.5 / size * row["n"]
    found = row["top"] or []
    least = found[k - 1]["count"] - 2 * error if len(found) >= k else 0
    candidates = [x["item"] for x in found if x["count"] >= least and x["item"] is not None]
    exact = df.filter(F.col(col).isin(candidates)).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    order = [F.col("count").desc(), F.col(col).asc()]
    best = exact.orderBy(*order).limit(k)
    counts = [r["count"] for r in best.collect()]
    if len(counts) < k or counts[-1] <= 2 * error:
        return value_frequencies(df, col).limit(k)
    rows = df.sparkSession.createDataFrame(best.collect(), best.schema)
    return rows.orderBy(*order)


#: Ranks on either side of a percentile that bracket it at first, and values
#: strictly inside a bracket from which the rank is read off exactly.
SLACK, INSIDE = 0.01, 10_000
_STEPS = [i / 256 for i in range(257)]


class _Rank:
    """The value of one rank of a column, from 0, and what is known of it:
    it lies in [lo, hi]. ``trial`` is the bracket that the next scan counts."""

    def __init__(self, column: int, rank: int, lo: float, hi: float, trial: tuple[float, float]):
        self.column, self.rank, self.lo, self.hi, self.trial = column, rank, lo, hi, trial
        self.value: float | None = None
        self.base: int | None = None  # values up to lo, once few lie strictly inside

    def counts(self, name: str) -> list[Column]:
        d, (a, b) = F.col(f"c{self.column}"), self.trial
        tests = {"a": d < a, "b": d <= a, "c": d < b, "d": d <= b}
        return [F.count(F.when(t, 1)).alias(f"{name}{k}") for k, t in tests.items()] + [
            F.kll_sketch_agg_double(F.when((d > a) & (d < b), d)).alias(f"{name}sketch")
        ]

    def learn(self, below_a: int, to_a: int, below_b: int, to_b: int, steps: list[float] | None) -> bool:
        """Whether the rank is found, or in reach; else the next trial is set.
        Each scan that fails leaves fewer values strictly inside."""
        a, b = self.trial
        if below_a <= self.rank < to_a:
            self.value = a
        elif below_b <= self.rank < to_b:
            self.value = b
        elif self.rank < below_a:
            self.hi = a
            self.trial = (self.lo, a)
        elif self.rank >= to_b:
            self.lo = b
            self.trial = (b, self.hi)
        else:
            self.lo, self.hi = a, b
            inside = below_b - to_a
            if inside <= INSIDE:
                self.base = to_a
            else:
                at = (self.rank - to_a) / inside * 256
                self.trial = (steps[max(0, math.floor(at) - 8)], steps[min(256, math.ceil(at) + 8)])
        return self.value is not None or self.base is not None

    def inside(self) -> Column:
        return (F.col("v") > self.lo) & (F.col("v") < self.hi)

    def read_off(self, counts: list[tuple[float, int]]) -> float:
        if self.value is None:
            before = self.base
            for v, n in sorted(x for x in counts if self.lo < x[0] < self.hi):
                before += n
                if self.rank < before:
                    return v
        return self.value


def _narrow(table: DataFrame, ranks: list[_Rank], extra: list[Column]) -> dict:
    """Narrow the brackets until each has its rank among few values strictly
    inside; one scan of the columns each time. ``extra`` aggregates ride along
    with the first."""
    first = {}
    while ranks or extra:
        counted = table.agg(*extra, *[c for i, r in enumerate(ranks) for c in r.counts(f"r{i}")])
        steps = F.array(*[F.lit(s) for s in _STEPS])
        row = counted.select(*[c for c in counted.columns if not c.endswith("sketch")], *[
            F.when(F.col(f"r{i}c") > F.col(f"r{i}b"), F.kll_sketch_get_quantile_double(f"r{i}sketch", steps)).alias(f"r{i}steps")
            for i in range(len(ranks))
        ]).first()
        first, extra = first or row.asDict(), []
        ranks = [
            r for i, r in enumerate(ranks) if not r.learn(*[row[f"r{i}{k}"] for k in "abcd"], row[f"r{i}steps"])
        ]
    return first


def profile(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    percentiles=PERCENTILES,
    unique: bool = True,
    stored: bool = False,
) -> DataFrame:
    """One row per column: count, unique, top and freq (string columns),
    mean, sample std, min, exact percentiles (linear interpolation) and max
    (numeric columns). Doubles are rounded to 6 dp, except the mean, which is
    an exact decimal total (6 places) over the count. Timestamp and date
    columns are described as pandas describes datetimes (count, mean, min,
    quartiles, max; no std), on UTC epoch seconds. NaN is missing.

    The columns are scanned three times, from a copy in the shared folder
    unless ``df`` is a ``stored`` table. The first scan takes counts, totals
    and a quantile sketch of each numeric column, which brackets every
    percentile; the second counts exactly what lies below and inside each
    bracket, and the deviations from the mean; the third counts the different
    values of each column, which gives ``unique``, ``top`` and ``freq``, and
    reads the percentiles off the few values inside the brackets. A bracket
    with too many values, or without its rank, costs one more scan. Columns
    stay columns, and no sort of all values takes place. ``unique=False``
    leaves out the count of different values (NULL), and takes the most
    frequent value from a summary (``top_values``).
    """
    spark = df.sparkSession
    cols = list(dict.fromkeys(cols or df.columns))  # each column once, in order
    types = {c: df.schema[c].dataType for c in cols}
    temporal = {c for c, t in types.items() if isinstance(t, (TimestampNTZType, TimestampType, DateType))}
    numeric = [c for c, t in types.items() if isinstance(t, NumericType) or c in temporal]

    def plain(c):
        if c in temporal:
            return epoch_seconds(F.col(c), types[c])
        return known(F.col(c).cast("double")) if c in numeric else F.col(c).cast("string")

    table = df.select(*[plain(c).alias(f"c{i}") for i, c in enumerate(cols)])
    if not stored:
        table = written_columns(table)
    around = [x for p in percentiles for x in (max(0.0, p - SLACK), min(1.0, p + SLACK))]
    brackets = F.array(*[F.lit(x) for x in around])

    first_aggs, second = [], []
    for i, c in enumerate(cols):
        d = F.col(f"c{i}")
        first_aggs.append(F.count(d).alias(f"n{i}"))
        if c in numeric:
            first_aggs += [
                F.min(d).alias(f"min{i}"), F.max(d).alias(f"max{i}"), F.sum(d).alias(f"plain{i}"),
                F.sum(d.try_cast("decimal(18,6)")).cast("double").alias(f"total{i}"), F.max(F.abs(d)).alias(f"abs{i}"),
                F.kll_sketch_agg_double(d).alias(f"sketch{i}"),
            ]
    scanned = table.agg(*first_aggs)
    row = scanned.select(
        *[c for c in scanned.columns if not c.startswith("sketch")],
        *[
            F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"sketch{i}", brackets)).alias(f"at{i}")
            for i, c in enumerate(cols) if c in numeric
        ],
    ).first()

    ranks, means = {}, {}
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        if c not in numeric or not n:
            continue
        # the same total in any order; beyond 10**12 a value has no room for 6 places
        total = row[f"total{i}"] if row[f"abs{i}"] < 1e12 else row[f"plain{i}"]
        means[i] = total / n
        if c not in temporal:
            second.append(F.sum((F.col(f"c{i}") - F.lit(row[f"plain{i}"] / n)) ** 2).alias(f"square{i}"))
        for j, p in enumerate(percentiles):
            at = p * (n - 1)
            for rank in {math.floor(at), math.ceil(at)}:
                trial = tuple(row[f"at{i}"][2 * j : 2 * j + 2])
                ranks.setdefault((i, rank), _Rank(i, rank, row[f"min{i}"], row[f"max{i}"], trial))
    moments = _narrow(table, list(ranks.values()), second)

    values, tops, kinds = {}, {}, {}
    for i, c in enumerate(cols):
        own = [r for r in ranks.values() if r.column == i]
        d = table.select(F.col(f"c{i}").alias("v")).filter("v IS NOT NULL")
        if c in numeric:
            hit = F.lit(False)
            for r in own:
                hit = hit | r.inside() if r.value is None else hit
            counts = (d if unique else d.filter(hit)).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
            found = counts.agg(
                F.count(F.lit(1)).alias("kinds"), F.collect_list(F.when(hit, F.struct("v", "n"))).alias("hits")
            ).first()
            hits = [(x["v"], x["n"]) for x in found["hits"]]
            found_at = {r.rank: r.read_off(hits) for r in own}
            for p in percentiles if own else ():
                at = p * (row[f"n{i}"] - 1)
                low, high = found_at[math.floor(at)], found_at[math.ceil(at)]
                values[i, p] = low if low == high else low + (at - math.floor(at)) * (high - low)
        elif unique:
            counts = d.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
            found = counts.agg(
                F.count(F.lit(1)).alias("kinds"), F.min_by("v", F.struct((-F.col("n")).alias("n"), "v")).alias("top"),
                F.max("n").alias("freq"),
            ).first()
            tops[i] = (found["top"], found["freq"])
        else:
            found, best = {"kinds": None}, top_values(d, "v", 1).first()
            tops[i] = (best["v"], best["count"]) if best else (None, None)
        kinds[i] = found["kinds"] if unique else None

    out, names = [], [f"p{int(round(p * 100))}" for p in percentiles]
    for i, c in enumerate(cols):
        n, square = row[f"n{i}"], moments.get(f"square{i}")
        std = math.sqrt(square / (n - 1)) if square is not None and n > 1 else None
        low, high = (row[f"min{i}"], row[f"max{i}"]) if c in numeric else (None, None)
        out.append((c, n, kinds[i], *tops.get(i, (None, None)), means.get(i), std, low, *[values.get((i, p)) for p in percentiles], high))
    schema = (
        "column string, count long, unique long, top string, freq long, mean double, std double, min double, "
        + ", ".join(f"{p} double" for p in names) + ", max double"
    )
    return spark.createDataFrame(out, schema).select(
        "column", "count", "unique", "top", "freq", "mean", *[F.round(c, 6).alias(c) for c in ("std", "min", *names, "max")]
    )


def written_columns(df: DataFrame) -> DataFrame:
    """A copy of ``df`` in the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/columns-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
