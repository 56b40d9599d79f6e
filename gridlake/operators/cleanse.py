"""Row-level cleaning: sentinel nulling, quarantine, window trim, faults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.fixed import GOOD, MISSING
from gridlake.functions.scalar import is_fault, is_good, known, null_when, summable

BAD_TIMESTAMP = "BAD_TIMESTAMP"
NULL_QUALITY = "NULL_QUALITY"
OUT_OF_RANGE = "OUT_OF_RANGE"


def null_missing(df: DataFrame, *cols: str) -> DataFrame:
    """NaN, which stands for a missing value, becomes NULL."""
    return df.withColumns({c: known(c) for c in cols})


def null_sentinel(
    df: DataFrame, value: str = "interval_kwh", quality: str = "quality", label: str = MISSING
) -> DataFrame:
    """NULL the value of rows labelled ``label`` (a NULL label keeps it)."""
    return df.withColumn(value, null_when(F.col(quality) == F.lit(label), value))


def with_reason(
    df: DataFrame, ts: str = "reading_ts", quality: str = "quality", good: str = GOOD,
    values: Sequence[str] = ("interval_kwh", "voltage"),
) -> DataFrame:
    """Add ``reason``: NULL for a clean row, else why it is quarantined
    (unparsed instant first, then a missing label, then the label itself, then
    one of ``values`` that no exact sum holds: infinite, or 10^20 and more)."""
    beyond = F.lit(False)
    for v in values:
        if v in df.columns:
            beyond = beyond | (known(v).isNotNull() & summable(v).isNull())
    reason = (
        F.when(F.col(ts).isNull(), F.lit(BAD_TIMESTAMP))
        .when(F.col(quality).isNull(), F.lit(NULL_QUALITY))
        .when(~is_good(quality, good), F.col(quality))
        .when(beyond, F.lit(OUT_OF_RANGE))
    )
    return df.withColumn("reason", reason)


def split_quarantine(
    df: DataFrame, ts: str = "reading_ts", quality: str = "quality", good: str = GOOD
) -> tuple[DataFrame, DataFrame]:
    """B2: (good, quarantine). Every input row lands in exactly one side; the
    quarantine side carries ``reason``. Two filters over one plan."""
    tagged = with_reason(df, ts, quality, good)
    clean = tagged.filter(F.col("reason").isNull()).drop("reason")
    bad = tagged.filter(F.col("reason").isNotNull())
    return clean, bad


def trim_window(
    df: DataFrame, start, end, ts: str = "reading_ts", keep_unparsed: bool = False
) -> DataFrame:
    """B1: keep rows whose UTC date lies in ``[start, end]`` (both inclusive).
    ``start``/``end`` are ISO date strings or date Columns. With
    ``keep_unparsed`` rows whose instant is NULL are kept too (for the
    quarantine). One filter, so the input is scanned once."""
    d = F.to_date(F.col(ts))
    lo = F.lit(start).cast("date") if isinstance(start, str) else start
    hi = F.lit(end).cast("date") if isinstance(end, str) else end
    keep = (d >= lo) & (d <= hi)
    if keep_unparsed:
        keep = keep | F.col(ts).isNull()
    return df.filter(keep)


def fault_rows(df: DataFrame, quality: str = "quality", good: str = GOOD) -> DataFrame:
    """Rows whose label is not GOOD, NULL labels included."""
    return df.filter(is_fault(quality, good))
