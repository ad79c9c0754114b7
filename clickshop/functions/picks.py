"""Aggregates that pick values, and one-row frames side by side.

Picking by aggregation rather than by window lets Spark reduce each group on the
map side: a group that holds a third of the data still sends one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Total order of events; the event id settles equal timestamps.
EVENT_ORDER = ("event_timestamp", "event_id")
# Total order of one user's sessions.
SESSION_ORDER = ("session_start_at", "session_id", "session_number")


def earliest(value: str) -> Column:
    """``value`` at the group's first instant.

    Among events of that instant a known value wins over NULL; a value that only
    appears later never does, and neither does one of an event without a time.  Each
    such pick keeps just its order and its value, as the map side sends one per group
    through the shuffle.
    """
    x, time = F.col(value), EVENT_ORDER[0]
    timed = x.isNotNull() & F.col(time).isNotNull()
    known = F.when(timed, F.struct(*EVENT_ORDER, x.alias("value")))
    first_known = F.min(known)
    return F.when(first_known[time] == F.min(time), first_known["value"])


def one_row(*parts: DataFrame) -> DataFrame:
    """Join one-row frames into a single row, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
