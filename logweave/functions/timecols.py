"""Event-time helpers (FN17, FN18).

Epoch arithmetic is done on TIMESTAMP_NTZ with ``timestampdiff`` so results
do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (or TIMESTAMP) column."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _c(ts).cast("timestamp_ntz"))


def epoch_seconds(ts: Column | str) -> Column:
    """Fractional epoch seconds (DOUBLE), the reference's ``event_epoch``."""
    return epoch_micros(ts).cast("double") / F.lit(1e6)


def window_key(epoch: Column | str, width_s: int) -> Column:
    """Tumbling-window start ``floor(epoch / w) * w`` as BIGINT seconds (FN17)."""
    return (F.floor(_c(epoch) / F.lit(float(width_s))) * F.lit(width_s)).cast("bigint")


def event_time(event_epoch: Column | str, fallback_epoch: Column | str | None = None) -> Column:
    """Event-time selection (FN18): the payload's ``event_epoch`` when present,
    else the message timestamp (epoch seconds)."""
    if fallback_epoch is None:
        return _c(event_epoch).cast("double")
    return F.coalesce(_c(event_epoch).cast("double"), _c(fallback_epoch).cast("double"))


def to_event_timestamp(epoch: Column | str) -> Column:
    """Epoch seconds (DOUBLE/BIGINT) -> TIMESTAMP, for watermarks and F.window."""
    return F.timestamp_micros(F.round(_c(epoch).cast("double") * F.lit(1e6)).cast("bigint"))
