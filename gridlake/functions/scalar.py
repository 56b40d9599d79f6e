"""Scalar column helpers: quality predicates, sentinel nulling, cost, season."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from gridlake.fixed import GOOD, SEASONS, TARIFFS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_good(quality="quality", good: str = GOOD) -> Column:
    """Null-safe ``quality == GOOD`` (a null label is not good)."""
    return _col(quality).eqNullSafe(F.lit(good))


def is_fault(quality="quality", good: str = GOOD) -> Column:
    """A fault is any label other than GOOD, null included. Labels are never
    enumerated."""
    return ~is_good(quality, good)


def null_when(cond: Column, value) -> Column:
    """NULL where ``cond`` is true, else ``value``; a null ``cond`` keeps the
    value."""
    return F.when(cond, F.lit(None)).otherwise(_col(value))


def cost(kwh="interval_kwh", rate="unit_rate", scale: int = 6) -> Column:
    """``round(kwh * rate, 6)``; a null kWh gives a null cost."""
    return F.round(_col(kwh) * _col(rate), scale)


#: Decimal places kept of a value that is summed exactly.
SUM_SCALE = 8


def known(c) -> Column:
    """NULL for NaN, which stands for a missing value (as in pandas); other
    values, infinity too, are kept."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def summable(c, scale: int = SUM_SCALE) -> Column:
    """The value as DECIMAL(28, ``scale``); NULL where it has none: missing,
    NaN, infinite, or too large (10^20 at 8 places)."""
    return _col(c).try_cast(DecimalType(28, scale))


def exact_sum(c, scale: int = SUM_SCALE, window=None) -> Column:
    """Sum as DECIMAL(38, ``scale``): the same total in any order of adding,
    whatever the partitioning and the volume (values are taken to ``scale``
    places). Values that are not ``summable`` are left out. NULL when no value
    is left. ``window`` makes it a window aggregate."""
    s = F.sum(summable(c, scale))
    return s if window is None else s.over(window)


def exact_count(c, scale: int = SUM_SCALE, window=None) -> Column:
    """The number of values that ``exact_sum`` adds."""
    n = F.count(summable(c, scale))
    return n if window is None else n.over(window)


def exact_mean(c, scale: int = SUM_SCALE, window=None) -> Column:
    """Mean as the exact decimal total over the number of values in it: the
    same double on every run and in any engine. Rounding a mean afterwards
    could land on a tie that engines break differently, so it is not rounded.
    NULL when no value is present."""
    n = exact_count(c, scale, window)
    return F.try_divide(exact_sum(c, scale, window).cast("double"), n.cast("double"))


def season_of(month) -> Column:
    """Season name of a month number (map lookup)."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(SEASONS.items()))])
    return m[_col(month)]


def tariff_by_index(n) -> Column:
    """Tariff code at position ``n mod 4`` of the catalogue (used to map
    driver tables onto tariff contracts)."""
    codes = F.array(*[F.lit(t[0]) for t in TARIFFS])
    return F.element_at(codes, (F.pmod(_col(n), F.lit(len(TARIFFS))) + 1).cast("int"))
