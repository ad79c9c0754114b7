from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, Row, SparkSession  # noqa: E402

from clickshop.operators import stage_events  # noqa: E402
from clickshop.schemas import RAW_EVENT  # noqa: E402
from clickshop.session import SETTINGS  # noqa: E402

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR
# 2024-03-01 00:00:00 UTC
T0 = 1_709_251_200 * SECOND

_INT_KEYS = {"ga_session_id", "ga_session_number", "engagement_time_msec"}


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Shop:
    """Hand-made raw events."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def raw(self, *events: dict) -> DataFrame:
        rows = [self._row(n, **event) for n, event in enumerate(events)]
        return self.spark.createDataFrame(rows, f"{RAW_EVENT}, event_id bigint")

    def events(self, *events: dict) -> DataFrame:
        return stage_events(self.raw(*events))

    def _row(
        self,
        number: int,
        name: str = "page_view",
        at: int = 0,
        user: str | None = "ann",
        session: int | None = 1,
        date: str = "20240301",
        params: dict | list | None = None,
        first: tuple = ("google", "organic", "spring"),
        device: tuple = ("desktop", "Linux", "en", "Firefox"),
        geo: tuple = ("Europe", "Norway", "Oslo", "Oslo"),
        txn: str | None = None,
        revenue: float | None = None,
        items: list | None = (),
        event_id: int | None = None,
    ) -> tuple:
        listed = self._params(session, params)
        category, system, language, browser = device
        return (
            date,
            T0 + at,
            name,
            user,
            None,
            "WEB",
            listed,
            first,
            (category, system, language, (browser,)),
            geo,
            (txn, revenue, 0.0, 0.0, 1),
            None if items is None else [self.item(**i) for i in items],
            number if event_id is None else event_id,
        )

    @staticmethod
    def _params(session: int | None, params: dict | list | None) -> list:
        if isinstance(params, list):
            return params
        given = {"ga_session_id": session, "ga_session_number": 1, **(params or {})}
        return [
            (key, (None, value) if key in _INT_KEYS else (value, None))
            for key, value in given.items()
            if value is not None
        ]

    @staticmethod
    def item(
        id: str | None = "sku",
        category: str | None = "Home/Apparel/",
        price: float | None = 5.0,
        quantity: int | None = 1,
        revenue: float | None = 5.0,
        position: str | None = "1",
        brand: str | None = "Own",
    ) -> tuple:
        return (
            id,
            f"{id} name",
            brand,
            "(not set)",
            category,
            price,
            quantity,
            revenue,
            "(not set)",
            "sale",
            position,
        )


@pytest.fixture
def shop(spark) -> Shop:
    return Shop(spark)


def values(df: DataFrame, *columns: str) -> list:
    """Sorted rows of the given columns as plain tuples (single column: values)."""
    rows: list[Row] = df.select(*columns).collect()
    found = [tuple(r) if len(columns) > 1 else r[0] for r in rows]
    return sorted(found, key=lambda v: str(v))


def only(df: DataFrame) -> dict:
    (row,) = df.collect()
    return row.asDict(recursive=True)
