"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from clickshop.operators import dedupe_purchases, fct_order_items, session_core, stage_events
from clickshop.operators.orders import ORDER_INPUT
from clickshop.plans import marts, profile
from clickshop.sources import events_from_tables, order_lines, scan_events, write_events

SF_DIR = "/root/testdata/sf0.001"


def plan(df, mode: str = "formatted") -> str:
    explain = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(explain.fromString(mode))


def shuffles(df) -> int:
    tree = plan(df).split("\n\n\n")[0]
    return len(re.findall(r"Exchange \(", tree)) - len(re.findall(r"BroadcastExchange \(", tree))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "events")
    write_events(events_from_tables(spark, SF_DIR), path)
    return scan_events(spark, path, "20240105", "20240301", with_event_id=True)


@pytest.fixture(scope="module")
def events(raw):
    return stage_events(raw)


def test_dates_prune_folders_and_columns_reach_the_scan(events):
    text = plan(events.select("event_date_dt", "ga_session_id", "browser"))
    assert "PartitionFilters: [isnotnull(event_date" in text
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert schema == (
        "struct<event_params:array<struct<key:string,value:struct<int_value:bigint>>>,"
        "device:struct<web_info:struct<browser:string>>>"
    )


def test_staging_is_one_generated_stage_without_shuffle(events):
    text = plan(events)
    assert shuffles(events) == 0
    assert re.findall(r"\n\(\d+\) Project\n", text) == []  # all are [codegen id : n]


def test_staging_methods_are_small_enough_to_be_compiled(events):
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", plan(events, "codegen"))
    assert sizes and max(map(int, sizes)) < 8000


def test_purchase_filter_is_pushed_to_parquet(events):
    text = plan(dedupe_purchases(events.select(*ORDER_INPUT)))
    assert "EqualTo(event_name,purchase)" in text
    assert "items:" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_dedupe_reads_the_columns_it_is_asked_for(events):
    text = plan(dedupe_purchases(events, ["purchase_revenue"]).select("order_key"))
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "items:" not in schema and "device" not in schema and "geo" not in schema


def test_only_days_in_range_are_listed(raw):
    days = {f.split("event_date=")[1][:8] for f in raw.inputFiles()}
    assert days and min(days) >= "20240105" and max(days) <= "20240301"
    index = raw._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    assert {f.split("event_date=")[1][:8] for f in index.inputFiles()} == days


def test_no_product_line_is_lost_or_merged(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    bought = spark.read.parquet(f"{SF_DIR}/events.parquet").where("event_type = 'purchase'")
    expected = lines.join(bought, lines["l_orderkey"] == bought["event_id"], "left_semi")
    items = events_from_tables(spark, SF_DIR).selectExpr("inline(items)")
    assert items.count() == expected.count()
    parts = expected.selectExpr("count(distinct l_partkey)").first()[0]
    assert items.selectExpr("count(distinct item_id)").first()[0] == parts


def test_only_lines_of_purchases_become_nested(spark, tmp_path):
    line = "l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string"
    rows = [(o, p, p, 1.0, 2.0, 0.0, "N", "O") for o, p in ((1, 1), (1, 2), (2, 1), (None, 1), (3, 9), (3, 9))]
    tables = {
        "lineitem": spark.createDataFrame(rows, f"l_orderkey bigint, {line}"),
        "part": spark.createDataFrame(
            [(1, "a", "b", "t", 1.0), (2, "c", "d", "t", 2.0)],
            "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
        ),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    ids = spark.createDataFrame([(1,), (3,), (3,), (None,), (7,)], "event_id bigint")
    found = order_lines(spark, str(tmp_path), ids).selectExpr("event_id", "inline(items)")
    listed = sorted((r.event_id, r.item_id, r.item_name or "") for r in found.collect())
    assert listed == [(1, "P1", "a"), (1, "P2", "c"), (3, "P9", ""), (3, "P9", "")]
    # Where raw events ask for items, other lines leave before any is grouped.
    tree = plan(events_from_tables(spark, SF_DIR).select("event_id", "items")).split("\n\n\n")[0]
    assert tree.index("ObjectHashAggregate") < tree.index("LeftSemi")


def test_dedupe_merges_before_its_first_shuffle(events):
    tree = plan(dedupe_purchases(events.select(*ORDER_INPUT))).split("\n\n\n")[0]
    steps = re.findall(r"(Exchange|SortAggregate|Window|WindowGroupLimit) \(", tree)
    # From the scan upwards: merge per hour, shuffle, merge, then the windows.
    assert steps[::-1][:4] == ["SortAggregate", "Exchange", "SortAggregate", "Exchange"]
    assert steps.count("Exchange") == 2


def test_sessions_are_reduced_before_their_only_shuffle(events):
    assert shuffles(session_core(events)) == 1
    assert "partial_min" in plan(session_core(events))


def test_item_ranking_needs_no_shuffle(events):
    deduped = dedupe_purchases(events)
    assert shuffles(fct_order_items(deduped)) == shuffles(deduped)


def test_landing_pages_shuffle_pages_sessions_and_result_once(spark, events, tmp_path):
    contract.Warehouse(spark, SF_DIR).int_sessions.write.parquet(str(tmp_path / "sessions"))
    visits = spark.read.parquet(str(tmp_path / "sessions"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(marts.mart_landing_pages(events, visits)) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_volume_counts_distinct_without_copying_rows(events):
    orders = dedupe_purchases(events.select(*ORDER_INPUT))
    assert "Expand" not in plan(
        profile.volume(events, contract.ops.fct_orders(orders))
    )


@pytest.mark.parametrize("name", contract._reports())
def test_registered_plans(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert not re.search(r"PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas", text)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    # Without a use of items, their join to the line table is gone.
    needs_items = re.search(r"item|categor|product|param_compl|orders_deduped|not_null|missing_order|freshness", name)
    if not needs_items and name not in ("stage_events", "stage_event_params"):
        assert "lineitem.parquet" not in text
