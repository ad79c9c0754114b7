"""Column expressions shared by the models; all run inside the JVM."""

from clickshop.functions.numbers import exact_sum, ratio, round_half_away, whole_units
from clickshop.functions.picks import earliest, one_row
from clickshop.functions.records import param, session_key

__all__ = [
    "earliest",
    "exact_sum",
    "one_row",
    "param",
    "ratio",
    "round_half_away",
    "session_key",
    "whole_units",
]
