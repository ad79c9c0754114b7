"""The data-quality audit table and the freshness report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickshop.functions import one_row, ratio, whole_units
from clickshop.functions.numbers import HOUR, MICROS_PER_SECOND
from clickshop.operators.staging import NOT_SET
from clickshop.sources.store import Store

# Checks whose findings are failures rather than warnings.
FAILING = ["missing_transaction_id", "negative_revenue", "impossible_duration"]
# Fixed value: hours without an event after which the audit reports an error.
STALE_HOURS = 49
# Hours without an event that the freshness report tolerates.
WARN_HOURS, ERROR_HOURS = 24, 48


def mart_data_quality(
    events: DataFrame, sessions: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """Six audit checks with status and severity; one pass over each input."""
    now = F.current_timestamp() if as_of is None else as_of
    counts = one_row(_event_counts(events), _session_counts(sessions))
    hours = whole_units(F.unix_micros(now), F.col("newest_us"), HOUR)

    def check(name: str, issues: Column, population: Column | None) -> Column:
        share = F.lit(None).cast("double")
        if population is not None:
            share = ratio(F.lit(100) * issues, population, 2)
        return F.struct(
            F.lit(name).alias("check_name"),
            issues.alias("issue_count"),
            share.alias("issue_pct"),
        )

    purchases, all_sessions = F.col("purchases"), F.col("sessions")
    checks = F.array(
        check("missing_transaction_id", F.col("missing_ids"), purchases),
        check("duplicate_transaction_id_before_clustering", F.col("repeated_ids"), purchases),
        check("negative_revenue", F.col("negative_revenue"), purchases),
        check("high_event_sessions", F.col("high_event"), all_sessions),
        check("impossible_duration", F.col("impossible"), all_sessions),
        check("data_freshness", hours, None),
    )
    name, issues = F.col("check_name"), F.col("issue_count")
    stale = (name == "data_freshness") & (issues > STALE_HOURS)
    failed = (issues > 0) & name.isin(FAILING)
    status = F.when(stale, "ERROR").when(failed, "FAILED").when(issues > 0, "WARNING")
    severity = F.when(stale, 4).when(failed, 3).when(issues > 0, 2)
    return counts.select(F.inline(checks)).select(
        "*",
        status.otherwise("PASSED").alias("check_status"),
        severity.otherwise(1).alias("status_sort"),
        now.alias("audit_ts"),
    )


def freshness(events: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Age of the newest event and whether it is tolerable."""
    return _age(events.agg(F.max("event_timestamp").alias("newest_us")), as_of)


def stored_freshness(store: Store, as_of: Column | None = None) -> DataFrame:
    """``freshness`` of the stored events, from the footers of their files."""
    _, newest = store.extremes("stg_events", "event_timestamp")
    return _age(store.spark.createDataFrame([(newest,)], "newest_us bigint"), as_of)


def _age(newest: DataFrame, as_of: Column | None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    age = F.unix_micros(now) - F.col("newest_us")

    def older_than(hours: int) -> Column:
        return age > hours * HOUR * MICROS_PER_SECOND

    status = F.when(older_than(ERROR_HOURS), "error").when(older_than(WARN_HOURS), "warn")
    return newest.select(
        F.timestamp_micros("newest_us").alias("newest_event_at"),
        now.alias("checked_at"),
        whole_units(F.unix_micros(now), F.col("newest_us"), HOUR).alias("age_hours"),
        F.when(F.col("newest_us").isNull(), "error")
        .otherwise(status.otherwise("pass"))
        .alias("freshness_status"),
    )


def _event_counts(events: DataFrame) -> DataFrame:
    # Grouped by usable transaction id, so that repeated ids are counted in the
    # same pass; all other events fall into the NULL group.
    txn = F.col("transaction_id")
    usable = F.col("is_purchase") & txn.isNotNull() & (txn != NOT_SET)
    per_id = events.groupBy(F.when(usable, txn).alias("id")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("flag_missing_txn_id").alias("missing_ids"),
        F.count_if("is_purchase").alias("purchases"),
        F.count_if(F.col("purchase_revenue") < 0).alias("negative_revenue"),
        F.max("event_timestamp").alias("newest_us"),
    )
    repeated = F.col("id").isNotNull() & (F.col("events") > 1)
    return per_id.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c)
            for c in ("missing_ids", "purchases", "negative_revenue")
        ],
        F.count_if(repeated).alias("repeated_ids"),
        F.max("newest_us").alias("newest_us"),
    )


def _session_counts(sessions: DataFrame) -> DataFrame:
    return sessions.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("is_high_event_session").alias("high_event"),
        F.count_if("is_impossible_duration").alias("impossible"),
    )
