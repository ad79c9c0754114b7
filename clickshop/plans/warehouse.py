"""Build every relation from raw events, in dependency order, or again for some days."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, functions as F

from clickshop import operators as ops
from clickshop.operators.orders import order_stem, usable_purchases
from clickshop.plans import audit, marts
from clickshop.plans.checks import row_metrics
from clickshop.session import unsorted_days
from clickshop.sources import Store
from clickshop.sources.store import NO_DAY, PARTITIONED, Draft

_SESSION = ["user_pseudo_id", "ga_session_id"]


def build(
    raw: DataFrame, store: Store, as_of: Column | None = None, *, by_day: bool = False
) -> dict[str, DataFrame]:
    """Write all relations to ``store`` and return them as read back.

    Each relation is written once and read from storage by everything built on
    it, so shared inputs (staged events, orders, sessions) are computed once.  Readers see
    them all together when the last one is written.  ``by_day`` says that ``raw`` is read from
    files of one day each, as ``scan_events`` does, so that staged events need no shuffle to
    their days.
    """
    draft = store.begin()
    with unsorted_days(store.spark):
        events = _write(draft, "stg_events", ops.stage_events(raw), by_day)
    deduped = _write(draft, "int_purchase_events_deduped", ops.dedupe_purchases(events))
    orders = _write(draft, "fct_orders", ops.fct_orders(deduped))
    _together(
        draft,
        lambda: _write(draft, "fct_order_items", ops.fct_order_items(deduped)),
        lambda: _write(draft, "int_sessions", ops.sessions(events, orders)),
    )
    _write_reports(draft, as_of)
    draft.commit()
    return store.tables()


def replace_days(raw: DataFrame, store: Store, days: list[str], as_of: Column | None = None) -> dict[str, DataFrame]:
    """Build anew what the events of ``days`` (``yyyy-MM-dd``) change, given all events of these days.

    The result equals a build from all events.  An order may go on over midnight, and an id that
    gets a second order renames its first one, so all orders of ids that the days' purchases name,
    before or now, are settled again from all their events; so are all sessions that
    the days' events or those orders belong to.  Days of orders, items and sessions that hold none of them
    keep their files.  Reports are written again: those by day keep the rows of days without such
    orders or sessions, the others are computed from all.  Readers see the change at once.
    """
    draft = store.begin()
    before = {name: draft.read(name) for name in PARTITIONED}
    staged = ops.stage_events(raw).where(_day("stg_events").isin(days))
    events = draft.replace_days("stg_events", staged, set(days))
    changed = [df.where(_day("stg_events").isin(days)) for df in (before["stg_events"], events)]

    named = [usable_purchases(df).select(order_stem(F.col("transaction_id")).alias("stem")) for df in changed]
    stems = draft.stash(_union(named).distinct())
    again = ops.dedupe_purchases(_of_stems(events.where("is_purchase"), stems))
    deduped = _replaced(draft, "int_purchase_events_deduped", again, lambda df, keep=True: _of_stems(df, stems, keep))
    purchase_days = deduped.pop("days")
    of_days = draft.read("int_purchase_events_deduped").where(_day("int_purchase_events_deduped").isin(*purchase_days))
    _together(
        draft,
        lambda: draft.replace_days("fct_orders", ops.fct_orders(of_days), purchase_days),
        lambda: draft.replace_days("fct_order_items", ops.fct_order_items(of_days), purchase_days),
    )
    orders = draft.read("fct_orders")

    moved = [df.select(*_SESSION) for df in (*changed, deduped["out"], deduped["again"])]
    touched = draft.stash(_union(moved).where(F.col("ga_session_id").isNotNull()).distinct())
    old = _of_sessions(before["int_sessions"], touched)
    # A session starts on its first event's day, so older days hold none of its dated events.
    first = old.agg(F.min("session_date"), F.bool_or(F.col("session_date").isNull())).first()
    dated = [str(d) for d in (first[0], *days) if d is not None and d != NO_DAY]
    since = None if first[1] or not dated else min(dated)
    recent = events if since is None else events.where(_since("event_date_dt", since))
    own = ops.sessions(_of_sessions(recent, touched), _of_sessions(orders, touched))
    settled = _replaced(draft, "int_sessions", own, lambda df, keep=True: _of_sessions(df, touched, keep))
    _write_reports(draft, as_of, {"int_sessions": settled["days"], "fct_order_items": purchase_days})
    draft.commit()
    return store.tables()


def _write_reports(draft: Draft, as_of: Column | None, changed: dict[str, set[str]] | None = None) -> None:
    """Write all reports; ``changed`` are the days of sessions and items in which rows differ, by default all."""
    events, sessions = draft.read("stg_events"), draft.read("int_sessions")

    def write_users() -> None:
        users = _write(draft, "int_user_metrics", ops.user_metrics(sessions))
        _write(draft, "mart_user_ltv", ops.mart_user_ltv(users))

    _together(
        draft,
        lambda: _write(draft, "mart_landing_pages", marts.mart_landing_pages(events, sessions)),
        write_users,
        lambda: _write_days(draft, "mart_product_performance", marts.mart_product_performance, "fct_order_items", changed),
        lambda: _write_days(draft, "mart_daily_performance", marts.mart_daily_performance, "int_sessions", changed),
        lambda: _write(draft, "mart_retention", marts.mart_retention(sessions)),
        lambda: _write(draft, "mart_data_quality", audit.mart_data_quality(events, sessions, as_of)),
        lambda: _write_days(draft, "mart_funnel", marts.mart_funnel, "int_sessions", changed),
    )


def _write_days(
    draft: Draft,
    name: str,
    report: Callable[[DataFrame], DataFrame],
    source: str,
    changed: dict[str, set[str]] | None,
) -> None:
    """Write a report whose groups hold rows of one day of ``source`` each; rows of unchanged days are kept."""
    rows = draft.read(source)
    if changed is None:
        _write(draft, name, report(rows))
    elif days := changed[source]:
        of_days = _day(source).isin(*days)
        kept = draft.read(name).where(~of_days)
        _write(draft, name, kept.unionByName(report(rows.where(of_days))))


def _together(draft: Draft, *steps: Callable[[], object]) -> None:
    """Steps that do not read each other's results, begun at once: the last tasks of one leave no core idle."""
    inherit = inheritable_thread_target(draft.store.spark)
    with ThreadPoolExecutor(len(steps)) as pool:
        for begun in [pool.submit(inherit(step)) for step in steps]:
            begun.result()


def _write(draft: Draft, name: str, df: DataFrame, by_day: bool = False) -> DataFrame:
    """Write a relation and take the counts of its row checks in the same job."""
    return draft.write(name, df, row_metrics(name), by_day)


def _replaced(draft: Draft, name: str, again: DataFrame, part) -> dict:
    """Put ``again`` in place of the rows of ``part`` and tell both, and the days they lie in."""
    old = draft.read(name)
    out, again = part(old), draft.stash(again)
    found = out.select(_day(name).alias("day")).union(again.select(_day(name).alias("day"))).distinct()
    days = {r.day for r in found.collect()}  # one row a day
    stay = part(old.where(_day(name).isin(*days)), keep=False) if days else None
    rows = again if stay is None else stay.unionByName(again)
    draft.replace_days(name, rows, days)
    return {"out": out, "again": again, "days": days}


def _day(name: str) -> Column:
    return F.coalesce(F.col(PARTITIONED[name]).cast("string"), F.lit(NO_DAY))


def _since(column: str, day: str) -> Column:
    return F.col(column).isNull() | (F.col(column) >= F.lit(day).cast("date"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _of_stems(df: DataFrame, stems: DataFrame, keep: bool = True) -> DataFrame:
    same = order_stem(df["transaction_id"]).eqNullSafe(stems["stem"])
    return df.join(stems, same, "left_semi" if keep else "left_anti")


def _of_sessions(df: DataFrame, touched: DataFrame, keep: bool = True) -> DataFrame:
    same = reduce(Column.__and__, [df[c].eqNullSafe(touched[c]) for c in _SESSION])
    return df.join(touched, same, "left_semi" if keep else "left_anti")
