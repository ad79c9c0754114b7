"""Data checks over the built relations.

A check's ``violations`` are the offending rows (none: it passes) and its
``summary`` is one row with what it examined and how much of it was wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clickshop.functions import exact_sum, one_row, round_half_away
from clickshop.operators.orders import dedupe_purchases, usable_purchases
from clickshop.operators.sessions import session_core
from clickshop.plans.marts import DAILY_DIMENSIONS
from clickshop.sources.store import Store

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class RowCheck:
    """No row of a relation meets ``offends``."""

    name: str
    relation: str
    offends: Callable[[], Column]

    def violations(self, tables: Tables) -> DataFrame:
        return tables[self.relation].where(self.offends())

    def summary(self, tables: Tables) -> DataFrame:
        return _row_report(tables[self.relation], [self])


@dataclass(frozen=True)
class UniqueCheck:
    """No non-NULL value of a column occurs twice."""

    name: str
    relation: str
    column: str

    def _occurrences(self, tables: Tables) -> DataFrame:
        values = tables[self.relation].where(F.col(self.column).isNotNull())
        return values.groupBy(self.column).agg(F.count(F.lit(1)).alias("occurrences"))

    def violations(self, tables: Tables) -> DataFrame:
        return self._occurrences(tables).where("occurrences > 1")

    def summary(self, tables: Tables) -> DataFrame:
        return self._occurrences(tables).agg(
            F.lit(self.name).alias("check_name"),
            F.count(F.lit(1)).alias("examined"),
            F.count_if(F.col("occurrences") > 1).alias("violations"),
        )


@dataclass(frozen=True)
class CompletenessCheck:
    """Every usable transaction id of the events reaches the orders."""

    name: str

    def _ids(self, tables: Tables) -> DataFrame:
        return usable_purchases(tables["stg_events"]).select("transaction_id").distinct()

    def violations(self, tables: Tables) -> DataFrame:
        arrived = tables["fct_orders"].select("transaction_id").distinct()
        return self._ids(tables).join(arrived, "transaction_id", "left_anti")

    def summary(self, tables: Tables) -> DataFrame:
        arrived = tables["fct_orders"].select("transaction_id", F.lit(1).alias("arrived"))
        # Both sides as one grouped union: a repeated id never meets a join.
        sides = self._ids(tables).withColumn("sent", F.lit(1))
        per_id = (
            sides.unionByName(arrived, allowMissingColumns=True)
            .groupBy("transaction_id")
            .agg(F.max("sent").alias("sent"), F.max("arrived").alias("arrived"))
            .where("sent = 1")
        )
        return per_id.agg(
            F.lit(self.name).alias("check_name"),
            F.count(F.lit(1)).alias("examined"),
            F.count_if(F.col("arrived").isNull()).alias("violations"),
        )


@dataclass(frozen=True)
class TotalsCheck:
    """Two relations agree on a total, up to ``tolerance``."""

    name: str
    left: tuple[str, Callable[[], Column]]
    right: tuple[str, Callable[[], Column]]
    tolerance: float = 0

    def totals(self, tables: Tables) -> DataFrame:
        (left, left_total), (right, right_total) = self.left, self.right
        return one_row(
            tables[left].agg(left_total().alias("left_total")),
            tables[right].agg(right_total().alias("right_total")),
        ).withColumn("difference", F.abs(F.col("left_total") - F.col("right_total")))

    def violations(self, tables: Tables) -> DataFrame:
        return self.totals(tables).where(F.col("difference") > self.tolerance)

    def summary(self, tables: Tables) -> DataFrame:
        # An empty side leaves the difference NULL, which is no violation.
        off = F.coalesce(F.col("difference") > self.tolerance, F.lit(False))
        return self.totals(tables).select(
            F.lit(self.name).alias("check_name"),
            F.lit(2).cast("bigint").alias("examined"),
            off.cast("bigint").alias("violations"),
        )


Check = RowCheck | UniqueCheck | CompletenessCheck | TotalsCheck


def _count() -> Column:
    return F.count(F.lit(1))


def _total(column: str) -> Callable[[], Column]:
    return lambda: F.sum(column)


def _money(column: str) -> Callable[[], Column]:
    return lambda: round_half_away(exact_sum(F.col(column)), 2)


def _is_null(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).isNull()


def _expr(text: str) -> Callable[[], Column]:
    return lambda: F.expr(text)


BUSINESS_CHECKS: list[Check] = [
    RowCheck("aov_not_negative", "mart_daily_performance", _expr("aov < 0")),
    CompletenessCheck("orders_complete"),
    RowCheck(
        "funnel_rates_at_most_one",
        "mart_funnel",
        _expr(
            "item_to_cart_rate > 1 or cart_to_checkout_rate > 1 or payment_to_purchase_rate > 1"
        ),
    ),
    RowCheck("ltv_not_negative", "mart_user_ltv", _expr("total_revenue < 0")),
    TotalsCheck(
        "orders_reconcile",
        ("int_sessions", _total("transaction_count")),
        ("fct_orders", _count),
    ),
    RowCheck(
        "retention_starts_at_one",
        "mart_retention",
        _expr("month_number = 0 and retention_rate != 1"),
    ),
    RowCheck(
        "retention_within_bounds",
        "mart_retention",
        _expr("retention_rate < 0 or retention_rate > 1"),
    ),
    TotalsCheck(
        "revenue_reconciles",
        ("int_sessions", _money("session_revenue")),
        ("fct_orders", _money("revenue")),
        tolerance=1.0,
    ),
    RowCheck("session_revenue_not_negative", "int_sessions", _expr("session_revenue < 0")),
    TotalsCheck(
        "sessions_reconcile",
        ("int_sessions", _count),
        ("mart_funnel", _total("sessions")),
    ),
    TotalsCheck(
        "user_revenue_reconciles",
        ("int_user_metrics", _money("total_revenue")),
        ("fct_orders", _money("revenue")),
        tolerance=1.0,
    ),
]

# Columns that must be filled, and keys that must be unique.
REQUIRED_COLUMNS = [
    ("int_purchase_events_deduped", "order_key"),
    ("int_sessions", "session_id"),
    ("int_user_metrics", "user_pseudo_id"),
    ("fct_orders", "order_key"),
    ("fct_orders", "revenue"),
    ("fct_order_items", "order_key"),
    ("fct_order_items", "item_id"),
    ("mart_daily_performance", "session_date"),
]
UNIQUE_KEYS = [
    ("int_sessions", "session_id"),
    ("int_user_metrics", "user_pseudo_id"),
    ("fct_orders", "order_key"),
]

NOT_NULL_CHECKS: list[Check] = [
    RowCheck(f"not_null_{relation}_{column}", relation, _is_null(column))
    for relation, column in REQUIRED_COLUMNS
]
UNIQUE_CHECKS: list[Check] = [
    UniqueCheck(f"unique_{relation}_{column}", relation, column)
    for relation, column in UNIQUE_KEYS
]
#: Name of the count of all rows among a relation's metrics.
EXAMINED = "examined"
ALL_CHECKS = [*BUSINESS_CHECKS, *NOT_NULL_CHECKS, *UNIQUE_CHECKS]


def row_metrics(relation: str) -> dict[str, Column]:
    """What all row checks of a relation count, to be taken while it is written."""
    own = [c for c in ALL_CHECKS if isinstance(c, RowCheck) and c.relation == relation]
    counts = {check.name: F.count_if(check.offends()) for check in own}
    return {EXAMINED: F.count(F.lit(1)), **counts} if own else {}


def written_report(store: Store, checks: list[Check] | None = None) -> DataFrame:
    """``check_report`` on a store; row checks taken while writing read no data again."""
    taken = store.metrics()
    rows, open_checks = [], []
    for check in ALL_CHECKS if checks is None else checks:
        counts = taken.get(check.relation, {}) if isinstance(check, RowCheck) else {}
        if check.name in counts:
            wrong = counts[check.name]
            rows.append((check.name, counts[EXAMINED], wrong, "fail" if wrong else "pass"))
        else:
            open_checks.append(check)
    schema = "check_name string, examined bigint, violations bigint, status string"
    found = store.spark.createDataFrame(rows, schema)
    return found.unionByName(check_report(store.tables(), open_checks)) if open_checks else found


def check_report(tables: Tables, checks: list[Check] | None = None) -> DataFrame:
    """One row per check: what it examined, its violations and its status.

    Row checks on the same relation share one pass over it.
    """
    by_relation: dict[str, list[RowCheck]] = {}
    reports = []
    for check in ALL_CHECKS if checks is None else checks:
        if isinstance(check, RowCheck):
            by_relation.setdefault(check.relation, []).append(check)
        else:
            reports.append(check.summary(tables))
    reports += [_row_report(tables[name], group) for name, group in by_relation.items()]
    status = F.when(F.col("violations") > 0, "fail").otherwise("pass")
    return reduce(DataFrame.unionByName, reports).withColumn("status", status)


def not_null_report(events: DataFrame) -> DataFrame:
    """The rows of ``check_report`` for ``NOT_NULL_CHECKS``, from staged events.

    Orders and their items come from one deduplication, with items counted inside their
    array; sessions need no orders to be counted.
    """
    items = F.coalesce("items", F.array().cast(events.schema["items"].dataType))
    orders = dedupe_purchases(events, ["purchase_revenue", "items"]).select(
        F.col("order_key").isNull().alias("no_key"),
        F.col("purchase_revenue").isNull().alias("no_revenue"),
        F.size(items).cast("bigint").alias("lines"),
        F.size(F.filter(items, lambda i: i["item_id"].isNull())).cast("bigint").alias("no_id"),
    )
    rows, lines = F.count(F.lit(1)), F.coalesce(F.sum("lines"), F.lit(0).cast("bigint"))
    unkeyed = F.coalesce(F.sum(F.when(F.col("no_key"), F.col("lines"))), F.lit(0).cast("bigint"))
    order_side = {
        "int_purchase_events_deduped_order_key": (rows, F.count_if("no_key")),
        "fct_orders_order_key": (rows, F.count_if("no_key")),
        "fct_orders_revenue": (rows, F.count_if("no_revenue")),
        "fct_order_items_order_key": (lines, unkeyed),
        "fct_order_items_item_id": (lines, F.coalesce(F.sum("no_id"), F.lit(0).cast("bigint"))),
    }
    core = session_core(events)
    users = core.select("user_pseudo_id").distinct()
    days = core.select(*DAILY_DIMENSIONS).distinct()
    parts = [
        (orders, order_side),
        (core, {"int_sessions_session_id": (rows, F.count_if(F.col("session_id").isNull()))}),
        (
            users,
            {"int_user_metrics_user_pseudo_id": (rows, F.count_if(F.col("user_pseudo_id").isNull()))},
        ),
        (
            days,
            {"mart_daily_performance_session_date": (rows, F.count_if(F.col("session_date").isNull()))},
        ),
    ]
    reports = []
    for relation, counts in parts:
        structs = [
            F.struct(
                F.lit(f"not_null_{name}").alias("check_name"),
                examined.alias("examined"),
                violations.alias("violations"),
            )
            for name, (examined, violations) in counts.items()
        ]
        reports.append(relation.agg(F.array(*structs).alias("r")).select(F.inline("r")))
    status = F.when(F.col("violations") > 0, "fail").otherwise("pass")
    return reduce(DataFrame.unionByName, reports).withColumn("status", status)


def _row_report(relation: DataFrame, checks: list[RowCheck]) -> DataFrame:
    counts = relation.agg(
        F.count(F.lit(1)).alias("examined"),
        *[F.count_if(check.offends()).alias(check.name) for check in checks],
    )
    rows = [
        F.struct(
            F.lit(check.name).alias("check_name"),
            F.col("examined"),
            F.col(check.name).alias("violations"),
        )
        for check in checks
    ]
    return counts.select(F.inline(F.array(*rows)))
