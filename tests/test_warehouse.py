"""Build all relations from stored raw events and compare them with plain SQL."""

from __future__ import annotations

from threading import Barrier

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import _comparable
from conftest import DAY, T0
from clickshop.plans import audit, checks, reach
from clickshop.plans.warehouse import _together, build, replace_days
from clickshop.schemas import RELATIONS
from clickshop.session import held as spark_settings
from clickshop.sources import Store, events_from_tables, files, scan_events, write_events
from clickshop.sources.store import CommitConflict, _footers as footers
from parity import compare, oracle

SF_DIR = "/root/testdata/sf0.001"
RANGE = ("20240101", "20241231")

SQL = {
    "stg_events": "stage_events",
    "int_purchase_events_deduped": "orders_deduped",
    "fct_orders": "fct_orders",
    "fct_order_items": "fct_order_items",
    "int_sessions": "sessions_full",
    "int_user_metrics": "user_metrics",
    "mart_user_ltv": "mart_user_ltv",
    "mart_daily_performance": "mart_daily_performance",
    "mart_funnel": "mart_funnel",
    "mart_landing_pages": "mart_landing_pages",
    "mart_product_performance": "mart_product_performance",
    "mart_retention": "mart_retention",
    "mart_data_quality": "mart_data_quality",
}


@pytest.fixture(scope="module")
def raw_path(spark, tmp_path_factory) -> str:
    path = str(tmp_path_factory.mktemp("raw") / "events")
    raw = events_from_tables(spark, SF_DIR)
    # Stored events carry only the parameters they have.
    present = F.filter("event_params", lambda p: p["key"].isNotNull())
    write_events(raw.withColumn("event_params", present), path)
    return path


@pytest.fixture(scope="module")
def built(spark, raw_path, tmp_path_factory):
    store = Store(spark, path=str(tmp_path_factory.mktemp("store")))
    raw = scan_events(spark, raw_path, *RANGE, with_event_id=True)
    as_of = F.lit(oracle.AS_OF).cast("timestamp")
    return store, build(raw, store, as_of)


@pytest.mark.parametrize("relation", RELATIONS)
def test_relation_matches_sql(built, relation):
    _, tables = built
    df = _comparable(tables[relation].drop("event_id"))
    sql = oracle.statements()[SQL[relation]]
    assert compare.difference(df, compare.connect(SF_DIR), sql) is None


def test_checks_run_on_stored_relations(built):
    _, tables = built
    report = checks.check_report(tables)
    failed = {r.check_name for r in report.where("status = 'fail'").collect()}
    assert report.count() == 22
    # The trial rows hold orders without revenue and events without a user.
    assert failed == {
        "not_null_fct_orders_revenue",
        "not_null_int_sessions_session_id",
        "not_null_int_user_metrics_user_pseudo_id",
    }


def test_views_serve_sql(spark, built):
    store, tables = built
    store.register_views()
    count = spark.sql("select count(*) as n from fct_orders where revenue > 0").first().n
    assert count == tables["fct_orders"].where("revenue > 0").count() > 0


def test_catalog_tables(spark, raw_path):
    spark.sql("create database if not exists shop")
    raw = scan_events(spark, raw_path, "20240101", "20240104", with_event_id=True)
    tables = build(raw, Store(spark, database="shop"))
    listed = {t.name for t in spark.catalog.listTables("shop")}
    assert listed == set(RELATIONS)
    assert tables["stg_events"].count() == raw.count() > 0


def test_rebuilding_replaces(spark, raw_path, tmp_path):
    store = Store(spark, path=str(tmp_path))
    for end in ("20240104", "20240102"):
        raw = scan_events(spark, raw_path, "20240101", end, with_event_id=True)
        tables = build(raw, store)
    assert tables["stg_events"].count() == raw.count()


def test_scan_reads_only_the_range(spark, raw_path):
    raw = scan_events(spark, raw_path, "20240105", "20240110")
    dates = {r.event_date for r in raw.select("event_date").distinct().collect()}
    assert dates and min(dates) >= "20240105" and max(dates) <= "20240110"
    assert "event_id" not in raw.columns


def test_source_without_event_ids_gives_the_same_orders_twice(spark, raw_path, tmp_path):
    raw = scan_events(spark, raw_path, "20240101", "20240120")
    runs = [build(raw, Store(spark, path=str(tmp_path / n))) for n in ("a", "b")]
    first, second = (set(t["fct_orders"].collect()) for t in runs)
    assert first == second and first


def test_events_read_by_day_are_staged_without_a_shuffle(spark, shop, tmp_path):
    keys = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(keys)
    days = [{"at": d * DAY + n, "date": f"202403{d + 1:02d}", "session": n} for d in range(3) for n in range(4)]
    write_events(shop.raw(*({"name": "view_item", **d} for d in days)), str(tmp_path / "raw"))
    raw = scan_events(spark, str(tmp_path / "raw"), "20240301", "20240303", with_event_id=True)
    stores = [Store(spark, path=str(tmp_path / n)) for n in ("read", "dealt")]
    as_of = F.lit(oracle.AS_OF).cast("timestamp")
    read, dealt = (build(raw, s, as_of, by_day=b) for s, b in zip(stores, (True, False)))
    assert [as_rows(read[name]) for name in RELATIONS] == [as_rows(dealt[name]) for name in RELATIONS]
    assert stores[0].folders("stg_events").keys() == stores[1].folders("stg_events").keys()
    assert spark.conf.get(keys) == before
    plans = [stores[0].begin()._plan("stg_events", read["stg_events"], by_day=b) for b in (True, False)]
    assert [p._jdf.queryExecution().analyzed().toString().count("RebalancePartitions") for p in plans] == [0, 1]


def test_steps_apart_from_each_other_begin_at_once(built):
    draft, met = built[0].begin(), Barrier(2, timeout=60)
    _together(draft, met.wait, met.wait)  # one after the other they would never meet

    def fail() -> None:
        raise ValueError("no such column")

    with pytest.raises(ValueError, match="no such column"):
        _together(draft, lambda: None, fail)


def test_store_needs_one_place(spark):
    with pytest.raises(ValueError, match="either"):
        Store(spark)


# --- days replaced alone, commits


def as_rows(df) -> list[str]:
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize(
    ("first", "then"),
    [
        (("20240101", "20240110"), [("20240111", "20240111"), ("20240112", "20240115")]),
        # Days that come late, and again.
        (("20240105", "20240131"), [("20240101", "20240104"), ("20240110", "20240110")]),
    ],
)
def test_replacing_days_equals_a_build_of_all(spark, raw_path, tmp_path, first, then):
    as_of = F.lit(oracle.AS_OF).cast("timestamp")
    grown, whole = (Store(spark, path=str(tmp_path / n)) for n in ("grown", "whole"))
    build(scan_events(spark, raw_path, *first, with_event_id=True), grown, as_of)
    kept = grown.folders("stg_events")
    for start, end in then:
        raw = scan_events(spark, raw_path, start, end, with_event_id=True)
        days = [str(r[0]) for r in raw.selectExpr("to_date(event_date, 'yyyyMMdd')").distinct().collect()]
        replace_days(raw, grown, days, as_of)
        kept = {day: f for day, f in kept.items() if day not in days}
    ranges = [first, *then]
    raw = scan_events(spark, raw_path, min(a for a, _ in ranges), max(b for _, b in ranges), with_event_id=True)
    expected = build(raw, whole, as_of)
    found = grown.tables()
    for name in RELATIONS:
        assert as_rows(found[name]) == as_rows(expected[name]), name
    now = grown.folders("stg_events")
    assert kept and all(now[day] == folder for day, folder in kept.items())


def test_only_touched_days_are_written(spark, shop, tmp_path):
    def buy(txn: str, at: int, user: str, session: int) -> dict:
        return {"name": "purchase", "txn": txn, "at": at, "revenue": 1.0, "user": user, "session": session, "date": f"202403{at // DAY + 1:02d}"}

    minute = 60_000_000
    raw = shop.raw(
        buy("A", 0, "u", 1), buy("B", DAY, "v", 1), buy("C", 3 * DAY - minute, "w", 1),
        buy("C", 3 * DAY + minute, "w", 1), buy("A", 3 * DAY, "x", 2),
    )
    day = F.floor((F.col("event_timestamp") - T0) / DAY)
    store = Store(spark, path=str(tmp_path))
    build(raw.where(day < 3), store)
    names = ("int_purchase_events_deduped", "fct_orders", "fct_order_items", "int_sessions")
    before = {name: store.folders(name) for name in names}
    reader = store.read("fct_orders")
    old = as_rows(reader)
    tables = replace_days(raw.where(day == 3), store, ["2024-03-04"])
    # C goes on over midnight; A has a second order now, which renames its first one.
    orders = {(r.order_key, str(r.order_date)) for r in tables["fct_orders"].collect()}
    assert orders == {("A_c1", "2024-03-01"), ("A_c2", "2024-03-04"), ("B", "2024-03-02"), ("C", "2024-03-03")}
    for name in names[:2]:
        after = store.folders(name)
        assert after["2024-03-02"] == before[name]["2024-03-02"]
        assert after["2024-03-01"] != before[name]["2024-03-01"]
    assert store.folders("int_sessions")["2024-03-02"] == before["int_sessions"]["2024-03-02"]
    assert as_rows(reader) == old  # a frame read before still reads the old files
    store.expire()
    assert as_rows(store.read("fct_orders")) == as_rows(tables["fct_orders"])
    assert len(files.children(spark, f"{tmp_path}/_commits")) == 1


def test_reports_by_day_keep_rows_of_other_days(spark, shop, tmp_path):
    raw = shop.raw(
        *({"name": "purchase", "txn": f"T{d}", "at": d * DAY, "revenue": 1.0, "user": "u", "session": d, "date": date, "items": [{}]}
          for d, date in enumerate(("20240301", "20240302", "20240303"), 1)),
        {"name": "purchase", "txn": "N", "at": 9 * DAY, "revenue": 1.0, "user": "n", "session": 9, "date": "no day", "items": [{}]},
    )
    late = F.col("event_date") == "20240303"
    as_of = F.lit(oracle.AS_OF).cast("timestamp")
    store, whole = (Store(spark, path=str(tmp_path / n)) for n in ("grown", "whole"))
    with spark_settings(spark, {"spark.sql.ansi.enabled": "false"}):
        build(raw.where(~late), store, as_of)
        # Rows of other days, marked, are still there afterwards; those of the day are new.
        draft = store.begin()
        draft.write("mart_funnel", store.read("mart_funnel").withColumn("sessions", F.lit(77).cast("bigint")))
        draft.write("mart_daily_performance", store.read("mart_daily_performance").withColumn("sessions", F.lit(77).cast("bigint")))
        draft.write("mart_product_performance", store.read("mart_product_performance").withColumn("transactions", F.lit(77).cast("bigint")))
        draft.commit()
        tables = replace_days(raw.where(late), store, ["2024-03-03"], as_of)
        expected = build(raw, whole, as_of)
        for name, day, count in (
            ("mart_funnel", "session_date", "sessions"),
            ("mart_daily_performance", "session_date", "sessions"),
            ("mart_product_performance", "purchase_date", "transactions"),
        ):
            found = {str(r[day]): r[count] for r in tables[name].collect()}
            assert found == {"None": 77, "2024-03-01": 77, "2024-03-02": 77, "2024-03-03": 1}, name
            assert as_rows(tables[name].drop(count).where(F.col(day).isNotNull())) == as_rows(
                expected[name].drop(count).where(F.col(day).isNotNull())
            ), name


def test_readers_see_old_or_new_only(spark, raw_path, tmp_path):
    store = Store(spark, path=str(tmp_path))
    raw = scan_events(spark, raw_path, "20240101", "20240103", with_event_id=True)
    build(raw, store)
    old = {name: as_rows(df) for name, df in store.tables().items()}
    draft = store.begin()
    draft.write("fct_orders", store.read("fct_orders").limit(1))
    draft.write("mart_funnel", store.read("mart_funnel").limit(0))
    assert {name: as_rows(df) for name, df in store.tables().items()} == old
    assert draft.read("fct_orders").count() == 1
    draft.commit()
    assert store.read("fct_orders").count() == 1 and store.read("mart_funnel").count() == 0


def test_the_second_of_two_writers_fails(spark, raw_path, tmp_path):
    store = Store(spark, path=str(tmp_path))
    build(scan_events(spark, raw_path, "20240101", "20240102", with_event_id=True), store)
    one, two = store.begin(), store.begin()
    for draft, rows in ((one, 1), (two, 0)):
        draft.write("mart_funnel", store.read("mart_funnel").limit(rows))
    one.commit()
    with pytest.raises(CommitConflict):
        two.commit()
    assert store.read("mart_funnel").count() == 1
    assert not [n for n in files.children(spark, f"{tmp_path}/_commits") if n.endswith(".part")]


def test_rows_of_other_days_are_refused(spark, raw_path, tmp_path):
    store = Store(spark, path=str(tmp_path))
    build(scan_events(spark, raw_path, "20240101", "20240102", with_event_id=True), store)
    with pytest.raises(ValueError, match="other days"):
        store.begin().replace_days("fct_orders", store.read("fct_orders"), {"1999-01-01"})


def test_checks_taken_while_writing_equal_the_report(spark, built):
    store, tables = built
    assert as_rows(checks.written_report(store)) == as_rows(checks.check_report(tables))
    rows = [c for c in checks.ALL_CHECKS if isinstance(c, checks.RowCheck)]
    plan = checks.written_report(store, rows)._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower()


def test_counts_of_a_relation_end_with_its_days(spark, raw_path, tmp_path):
    store = Store(spark, path=str(tmp_path))
    build(scan_events(spark, raw_path, "20240101", "20240103", with_event_id=True), store)
    assert store.metrics()["fct_orders"][checks.EXAMINED] == store.read("fct_orders").count()
    raw = scan_events(spark, raw_path, "20240104", "20240104", with_event_id=True)
    tables = replace_days(raw, store, ["2024-01-04"])
    assert "fct_orders" not in store.metrics() and "mart_funnel" in store.metrics()
    assert as_rows(checks.written_report(store)) == as_rows(checks.check_report(tables))


# --- users that add up over days


def test_bitmaps_of_days_give_the_users_of_months(spark, tmp_path):
    rows = [(d, "c" if d % 3 else None, f"u{d * i * i % 977}") for d in range(60) for i in range(40)]
    visits = spark.createDataFrame([*rows, (1, "c", None)], "day int, channel string, user string")
    early, late = visits.where("day < 30"), visits.where("day >= 20")
    known = reach.number_values(early.select("user"), str(tmp_path / "first"))
    numbers = reach.number_values(late.select("user"), str(tmp_path / "second"), known)
    assert numbers.count() == numbers.select("value").distinct().count() == numbers.select("number").distinct().count()
    assert as_rows(numbers.join(known, ["value", "number"], "left_semi")) == as_rows(known)
    daily = reach.reach(visits, numbers, "user", ["day", "channel"])
    month = F.expr("day div 30").alias("month")
    found = reach.reached(reach.merged(daily, [month, "channel"]), ["month", "channel"])
    expected = visits.groupBy(month, "channel").agg(F.count_distinct("user").alias("users"))
    assert as_rows(found) == as_rows(expected)


def test_many_buckets_of_users(spark, tmp_path):
    visits = spark.range(200_000).selectExpr("id % 100000 as user", "id % 7 as day")
    numbers = reach.number_values(visits.select("user"), str(tmp_path / "n"))
    daily = reach.reach(visits, numbers, "user", ["day"])
    assert daily.select("bucket").distinct().count() > 3
    assert reach.reached(reach.merged(daily, []), []).first().users == 100_000


# --- freshness from footers


def test_footers_tell_the_newest_event(spark, built):
    store, tables = built
    as_of = F.lit(oracle.AS_OF).cast("timestamp")
    assert as_rows(audit.stored_freshness(store, as_of)) == as_rows(audit.freshness(tables["stg_events"], as_of))
    keys = ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")
    before = [spark.conf.get(k) for k in keys]
    with footers(spark):
        plan = store._footer_query("stg_events", "event_timestamp")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(event_timestamp), MAX(event_timestamp)]" in plan
    assert [spark.conf.get(k) for k in keys] == before


def test_no_event_is_not_fresh(spark, shop, tmp_path):
    store = Store(spark, path=str(tmp_path))
    store.write("stg_events", shop.events({"name": "view_item"}).limit(0))
    assert audit.stored_freshness(store).first().freshness_status == "error"
