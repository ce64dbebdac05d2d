"""Column-level helpers: time conversion and the shared metric expressions."""

from trackside.functions.exprs import (  # noqa: F401
    count_when, delay_minutes, delay_ms, pct, round_half_away, toc_name,
)
from trackside.functions.times import (  # noqa: F401
    epoch_seconds, iso_london, london_date, ms_to_ts, object_name,
    partition_keys, to_london, ts_to_ms,
)
