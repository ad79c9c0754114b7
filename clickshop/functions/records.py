"""Lookups in the nested event record."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def param(key: str, field: str) -> Column:
    """Value of the first event parameter named ``key``; NULL when absent.

    The list is read as parallel arrays of keys and values.  Unlike a lambda over
    the array this stays in generated code, and Parquet reads only the requested
    ``field`` of each value.
    """
    position = F.array_position("event_params.key", key)
    return F.get(F.col(f"event_params.value.{field}"), (position - 1).cast("int"))


def session_key(user: str = "user_pseudo_id", session: str = "ga_session_id") -> Column:
    """``user-session`` text; NULL if either part is NULL."""
    return F.concat(F.col(user), F.lit("-"), F.col(session).cast("string"))
