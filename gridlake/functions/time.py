"""Time rules.

An instant is carried as ``timestamp_ntz`` holding UTC. Every helper here
gives the same answer whatever ``spark.sql.session.timeZone`` is, including
on both DST change days: no helper lets Spark route an NTZ value through the
session zone (``date_trunc`` on NTZ does, and is wrong for a wall-clock hour
that does not exist in the session zone).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

# An offset only counts after a time of day ("...T10:00[:00[.fff]]" then
# "Z" / "+02:00" / "+0200" / "+02"); a bare date such as "2025-07-01" ends in
# "-01" but has no offset.
_HAS_OFFSET = r"(?i)[t ]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s*(z|[+-]\d{2}(:?\d{2})?)$"
_MINUTES_BEFORE_OFFSET = r"(?i)([t ]\d{1,2}:\d{2})(?=\s*(z|[+-]\d{2}(:?\d{2})?)$)"


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(TimestampNTZType())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ltz_to_utc_ntz(ltz: Column) -> Column:
    # unix_micros of an instant is zone-free; adding micros to the NTZ epoch
    # is field arithmetic, also zone-free.
    return F.timestamp_add("MICROSECOND", F.unix_micros(ltz), _epoch_ntz())


def to_utc_ntz(c, dtype=None) -> Column:
    """Type an instant as UTC ``timestamp_ntz``.

    Strings with an offset (``...+02:00`` / ``...Z``) are read as instants;
    strings without one are read as UTC wall clock. Unparseable strings give
    NULL (``try_cast``), never an exception. ``dtype`` is the input's
    Spark type when known (NTZ passes through, LTZ is converted by instant).
    """
    c = _col(c)
    if isinstance(dtype, TimestampNTZType):
        return c
    if isinstance(dtype, TimestampType):
        return _ltz_to_utc_ntz(c)
    s = F.trim(c.cast(StringType()))
    # With an offset: an instant (LTZ cast honours the offset). Without one:
    # UTC wall clock (NTZ cast, which never consults the session zone).
    # Spark's cast needs seconds before an offset ("T10:00Z" -> "T10:00:00Z").
    with_secs = F.regexp_replace(s, _MINUTES_BEFORE_OFFSET, "$1:00")
    return F.when(
        s.rlike(_HAS_OFFSET), _ltz_to_utc_ntz(with_secs.try_cast(TimestampType()))
    ).otherwise(s.try_cast(TimestampNTZType()))


def to_local(ts, zone: str) -> Column:
    """UTC NTZ -> wall clock NTZ in ``zone`` (DST honoured)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts))


def to_iso_offset(ts, zone: str | None = None) -> Column:
    """ISO-8601 text with an explicit offset for a UTC NTZ instant, the
    way the feed writes instants: UTC as ``...+00:00``; with ``zone``, the
    local wall clock and that zone's offset at the instant (DST honoured),
    e.g. ``2024-01-01T01:00:00+01:00``. ``to_utc_ntz`` reads either back to
    the same instant."""
    ts = _col(ts)
    if zone is None or zone == "UTC":
        return F.concat(F.regexp_replace(ts.cast(StringType()), " ", "T"), F.lit("+00:00"))
    local = to_local(ts, zone)
    minutes = F.timestamp_diff("MINUTE", ts, local)
    a = F.abs(minutes)
    offset = F.concat(
        F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.floor(a / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((a % 60).cast("string"), 2, "0"),
    )
    return F.concat(F.regexp_replace(local.cast(StringType()), " ", "T"), offset)


def local_hour(ts, zone: str) -> Column:
    """Hour of day (0-23) of a UTC NTZ instant, in ``zone``."""
    return F.hour(to_local(ts, zone))


def trunc_hour(ts) -> Column:
    """Start of the hour of an NTZ value, as NTZ."""
    return trunc_minutes(ts, 60)


def trunc_minutes(ts, step: int) -> Column:
    """Floor an NTZ value to a ``step``-minute grid (step divides 60 or is 60)."""
    ts = _col(ts)
    minute = F.lit(0) if step >= 60 else F.floor(F.minute(ts) / step) * step
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), minute.cast("int"), F.lit(0)
    )


def iso_minute(ts) -> Column:
    """``yyyy-MM-ddTHH:mm`` text of an NTZ value (the weather feed's time
    format). Built from the NTZ value's own text: ``date_format`` would route
    it through the session zone and move a wall-clock time that does not
    exist there (02:30 on a spring-forward day becomes 03:30)."""
    return F.regexp_replace(F.substring(_col(ts).cast(StringType()), 1, 16), " ", "T")


def month_key(ts) -> Column:
    """``yyyy-MM`` of a UTC NTZ instant (zone-free, like ``date_key``)."""
    return F.substring(date_key(ts), 1, 7)


def date_key(ts, zone: str | None = None) -> Column:
    """ISO date string ``yyyy-MM-dd`` of a UTC NTZ instant.

    ``zone=None`` keeps the UTC date (the published behaviour); a zone name
    gives the local calendar date instead.
    """
    ts = _col(ts)
    if zone is not None:
        ts = to_local(ts, zone)
    return F.to_date(ts).cast(StringType())


def epoch_seconds(c, dtype=None) -> Column:
    """Seconds since 1970-01-01 UTC as a double (fractions kept) for a UTC
    NTZ instant, an LTZ instant or a date; zone-free."""
    c = _col(c)
    if isinstance(dtype, DateType):
        return (F.datediff(c, F.lit("1970-01-01").cast("date")) * 86400).cast("double")
    ntz = to_utc_ntz(c, dtype) if isinstance(dtype, TimestampType) else c
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), ntz).cast("double") / 1e6


def day_number(d) -> Column:
    """Days since 1970-01-01 of a date (or ISO date string); used for
    gap-tolerant ``rangeBetween`` frames."""
    return F.datediff(F.to_date(_col(d)), F.lit("1970-01-01").cast("date"))
