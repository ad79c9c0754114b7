"""Raw events derived from the trial tables (``TESTDATA.md``, ``FIXTURES.md`` 3).

The trial tables hold no web-shop events, so every row of ``events`` is mapped,
by integer arithmetic only, to one nested raw event; purchases get their product
lines from ``lineitem`` and ``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The columns used of each table.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, "
    "p_retailprice double",
}
# Microseconds of 2024-01-01 and of a day.
FIRST_DAY_MICROS = 1_704_067_200_000_000
DAY_MICROS = 86_400_000_000

# Fixed value: the number in props.
K_TEXT = "get_json_object(props, '$.k')"

# Event time after the first day, from user u, day d and time of day.
MOVED = f"""
    case when u < 4 then offset div 60
         when u % 10 = 0 then 3 * {DAY_MICROS} * d + 3 * tod
         else 3 * {DAY_MICROS} * d + tod div 48 end
    + if(u >= 4 and u % 5 = 0, 31 * {DAY_MICROS}, 0)
"""
EVENT_NAME = """
    case event_type
        when 'purchase' then 'purchase'
        when 'view' then if(k % 2 = 0, 'view_item', 'page_view')
        when 'click' then elt(k % 4 + 1, 'add_to_cart', 'begin_checkout',
                              'add_shipping_info', 'add_payment_info')
        when 'signup' then if(k % 2 = 0, 'first_visit', 'session_start')
        when 'error' then 'user_engagement' end
"""

# Parameters with the condition under which an event has them.
INT_PARAMS = {
    "ga_session_id": ("bought or event_id % 97 != 0", "if(u < 4, 999, d + 1)"),
    "ga_session_number": ("true", "if(u < 4, 1, d + 1)"),
    "engagement_time_msec": ("k % 4 != 0", "k * 1000"),
}
TEXT_PARAMS = {
    "session_engaged": ("k % 3 != 0", "if(k % 3 = 1, '1', '0')"),
    "medium": (
        "k % 9 != 8",
        "elt(k % 9 + 1, 'organic', 'cpc', 'email', 'social', 'referral', 'affiliate', "
        "'(none)', '<Other>')",
    ),
    "source": (
        "k % 9 != 8",
        "case k % 9 when 6 then '(direct)' when 7 then '<Other>' else 'src' || (k % 5) end",
    ),
    "campaign": ("true", "if(k % 6 = 0, '<Other>', 'c' || (k % 6))"),
    "page_location": ("event_name != 'user_engagement'", "'/p/' || (k % 20)"),
    "page_title": ("event_name != 'user_engagement'", "'Page ' || (k % 20)"),
    "page_referrer": ("k % 2 != 0", "'/p/' || (k % 7)"),
}

# The other raw fields.
RAW_FIELDS = {
    "event_date": "date_format(date_add(date'2024-01-01', "
    f"cast(moved div {DAY_MICROS} as int)), 'yyyyMMdd')",
    "event_timestamp": "if(event_type = 'error' and event_id % 40 = 7, null, "
    f"moved + {FIRST_DAY_MICROS})",
    "event_name": "event_name",
    "user_pseudo_id": "case when event_type = 'click' and event_id % 53 = 5 then null "
    "when u < 4 then 'u_whale' else 'u' || u end",
    "user_id": "cast(null as string)",
    "platform": "'WEB'",
    "event_params": "event_params",
    "traffic_source": """named_struct(
        'source', case u % 11 when 0 then '(data deleted)'
                              when 1 then 'shop.googlemerchandisestore.com'
                              when 2 then '<Other>' else 'google' end,
        'medium', case u % 11 when 1 then 'referral' when 2 then '<Other>' when 3 then '(none)'
                              else 'organic' end,
        'name', 'n' || (u % 3))""",
    "device": """named_struct(
        'category', elt(cast(u % 3 as int) + 1, 'desktop', 'mobile', 'tablet'),
        'operating_system', elt(cast(u % 4 as int) + 1, 'Windows', 'iOS', 'Android', 'Web'),
        'language', if(u % 2 = 0, 'en', 'fr'),
        'web_info', named_struct('browser', elt(k % 3 + 1, 'Chrome', 'Safari', '<Other>')))""",
    "geo": """named_struct(
        'continent', r_name, 'country', n_name, 'region', r_name,
        'city', if(k % 5 = 0, '(not set)', 'city' || (u % 40)))""",
    "ecommerce": """named_struct(
        'transaction_id', case when not bought or k = 7 then null when k = 8 then '(not set)'
                               else 'T' || (event_id div 20) end,
        'purchase_revenue', case when not bought or k = 9 then null
                                 when k = 11 then -value else value end,
        'tax_value', if(bought, k / 10, null),
        'shipping_value', if(bought, cast(k % 10 as double), null),
        'unique_items', if(bought, cast(k % 5 as bigint), null))""",
    "items": "if(bought and items is not null, items, array())",
    "event_id": "event_id",
}

# An item from a product line and its part.
ITEM = """named_struct(
    'item_id', 'P' || l_partkey,
    'item_name', p_name,
    'item_brand', if(l_linenumber = 7, '(not set)', p_brand),
    'item_variant', if(l_returnflag = 'N', '(not set)', l_returnflag),
    'item_category', if(l_linestatus = 'O', 'Home/' || p_type || '/' || p_brand || '/', p_type),
    'price', case l_linenumber when 6 then 0D when 5 then null else p_retailprice end,
    'quantity', if(l_linenumber = 4, null, cast(l_quantity as bigint)),
    'item_revenue', if(l_linenumber = 3, null, l_extendedprice),
    'promotion_id', if(l_tax = 0, '(not set)', 'promo' || l_linenumber),
    'promotion_name', if(l_tax = 0, '(not set)', 'promo' || l_linenumber),
    'item_list_index', if(l_linenumber = 1, null, cast(l_linenumber as string)))"""


def events_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested raw event per row of ``events``."""
    places = (
        _table(spark, sf_dir, "nation")
        .join(_table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr("cast(n_nationkey as bigint) as place", "n_name", "r_name")
    )
    params = [_param(k, when, number=x) for k, (when, x) in INT_PARAMS.items()]
    params += [_param(k, when, text=x) for k, (when, x) in TEXT_PARAMS.items()]
    events = _table(spark, sf_dir, "events")
    bought = _table(spark, sf_dir, "events").where("event_type = 'purchase'").select("event_id")
    return (
        events.selectExpr(
            "event_id",
            "event_type",
            "event_type = 'purchase' as bought",
            "value",
            "user_id as u",
            "user_id % 25 as place",
            f"int({K_TEXT}) as k",
            f"unix_micros(timestamp(ts)) - {FIRST_DAY_MICROS} as offset",
        )
        .selectExpr("*", f"offset div {DAY_MICROS} as d", f"offset % {DAY_MICROS} as tod")
        .selectExpr("*", f"{MOVED} as moved", f"{EVENT_NAME} as event_name")
        .join(places, "place", "left")
        .join(order_lines(spark, sf_dir, bought), "event_id", "left")
        .selectExpr("*", f"array({', '.join(params)}) as event_params")
        .selectExpr(*[f"{rule} as {name}" for name, rule in RAW_FIELDS.items()])
    )


def order_lines(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Product lines of each order number, one array entry per line; of the ids of ``orders`` only, if given.

    An order is one event, so its lines belong into one row.  Lines meet the ids as the few
    columns they are stored in, and only lines with an order become nested.
    """
    lines = _table(spark, sf_dir, "lineitem")
    if orders is not None:
        lines = lines.join(orders, F.expr("l_orderkey = event_id"), "left_semi")
    lines = lines.join(_table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"), "left")
    return lines.groupBy(F.col("l_orderkey").alias("event_id")).agg(
        F.collect_list(F.expr(ITEM)).alias("items")
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # With the types given, Spark starts no job to look them up.
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _param(key: str, present: str, text: str = "null", number: str = "null") -> str:
    """SQL of one event parameter; its key and value are NULL where it is absent."""
    return (
        f"named_struct('key', if({present}, '{key}', null), 'value', named_struct("
        f"'string_value', if({present}, cast({text} as string), null), "
        f"'int_value', if({present}, cast({number} as bigint), null)))"
    )
