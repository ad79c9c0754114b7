from __future__ import annotations

import datetime as dt

import pytest
from conftest import T0, only, values
from pyspark.sql import functions as F

from clickshop.operators import channel_group, stage_events
from clickshop.schemas import RELATIONS, conforming


def test_columns_and_types(shop):
    conforming(shop.events({}), "stg_events")


def test_times_come_from_their_own_fields(shop):
    event = only(shop.events({"date": "20231231", "at": 1}))
    assert event["event_date_dt"] == dt.date(2023, 12, 31)
    assert event["event_timestamp"] == T0 + 1


@pytest.mark.parametrize(
    ("medium", "source", "channel"),
    [
        ("organic", "google", "Organic Search"),
        ("cpc", "google", "Paid Search"),
        ("ppc", None, "Paid Search"),
        ("paid", None, "Paid Search"),
        ("email", None, "Email"),
        ("e-mail", None, "Email"),
        ("mail", None, "Email"),
        ("social", None, "Organic Social"),
        ("social-network", None, "Organic Social"),
        ("referral", None, "Referral"),
        ("affiliate", None, "Affiliates"),
        (None, "(direct)", "Direct"),
        ("(none)", "(direct)", "Direct"),
        ("organic", "(direct)", "Organic Search"),
        ("CPC", "google", "Other"),
        ("<Other>", "<Other>", "Other"),
        (None, None, "Other"),
    ],
)
def test_channel(spark, medium, source, channel):
    row = spark.range(1).select(
        channel_group(F.lit(medium).cast("string"), F.lit(source).cast("string")).alias("c")
    )
    assert row.first().c == channel


def test_parameters(shop):
    text = lambda v: (v, None)
    events = shop.events(
        {"params": None, "session": None},
        {"params": []},
        {"params": [("page_title", text("first")), ("page_title", text("second"))]},
        {"params": [(None, text("x")), ("page_title", None)]},
        {"params": [("ga_session_id", (None, 7)), ("source", text("mail"))]},
    )
    found = values(events, "event_id", "ga_session_id", "page_title", "session_source_raw")
    assert found == [
        (0, None, None, None),
        (1, None, None, None),
        (2, None, "first", None),
        (3, None, None, None),
        (4, 7, None, "mail"),
    ]


def test_null_parameter_list(shop):
    raw = shop.raw({}).withColumn("event_params", F.lit(None).cast("array<struct<key:string,"
                                  "value:struct<string_value:string,int_value:bigint>>>"))
    assert only(stage_events(raw))["ga_session_id"] is None


def test_placeholders_become_null(shop):
    event = only(
        shop.events(
            {
                "first": ("<Other>", "<Other>", "<Other>"),
                "geo": ("x", "y", "z", "(not set)"),
                "params": {"source": "<Other>", "medium": "(none)", "campaign": "<Other>"},
            }
        )
    )
    cleaned = ["traffic_source", "traffic_medium", "traffic_campaign", "city"]
    assert [event[c] for c in cleaned] == [None] * 4
    assert event["session_source"] is None and event["session_medium"] is None
    assert event["session_source_raw"] == "<Other>"
    assert event["session_campaign"] == "<Other>"


def test_flags_are_null_where_their_source_is(shop):
    event = only(shop.events({"first": ("<Other>", None, None)}))
    assert event["is_gdpr_deleted"] is None
    assert event["is_internal_referral"] is None
    assert event["is_session_engaged"] is None


def test_internal_and_deleted_traffic(shop):
    own = "shop.googlemerchandisestore.com"
    events = shop.events({"first": (own, "referral", "x")}, {"first": ("(data deleted)", "y", "x")})
    assert values(events, "is_internal_referral", "is_gdpr_deleted") == [
        (False, True),
        (True, False),
    ]


@pytest.mark.parametrize(
    ("event", "missing", "no_revenue"),
    [
        ({"name": "purchase", "txn": "A", "revenue": 1.0}, False, False),
        ({"name": "purchase", "txn": None, "revenue": 1.0}, True, False),
        ({"name": "purchase", "txn": "(not set)"}, True, True),
        ({"name": "page_view"}, False, False),
    ],
)
def test_purchase_flags(shop, event, missing, no_revenue):
    row = only(shop.events(event))
    assert (row["flag_missing_txn_id"], row["flag_null_revenue"]) == (missing, no_revenue)


def test_event_id_is_made_from_the_record_when_the_source_has_none(shop):
    raw = shop.raw({"at": 1}, {"at": 2}, {"at": 1}).drop("event_id")
    ids = values(stage_events(raw), "event_timestamp", "event_id")
    assert ids[0] == ids[1] != ids[2]


def test_every_relation_declares_columns(spark):
    from clickshop.schemas import columns_of

    assert [len(columns_of(RELATIONS[r])) for r in ("stg_events", "int_sessions")] == [53, 44]


def test_conforming_names_the_difference(shop):
    with pytest.raises(ValueError, match="missing.*platform"):
        conforming(shop.events({}).drop("platform"), "stg_events")
