"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from gridlake.functions.time import (  # noqa: F401
    date_key,
    day_number,
    iso_minute,
    month_key,
    local_hour,
    to_iso_offset,
    to_utc_ntz,
    trunc_hour,
    trunc_minutes,
)
from gridlake.functions.scalar import (  # noqa: F401
    cost,
    exact_count,
    exact_mean,
    exact_sum,
    is_fault,
    is_good,
    known,
    null_when,
    season_of,
    tariff_by_index,
)
