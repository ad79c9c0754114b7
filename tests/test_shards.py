"""Day folders by suffix and the zone map of their files."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import HOUR, T0
from clickshop.operators import stage_events
from clickshop.sources import Shards, write_shards


def _write(raw, folder) -> None:
    raw.coalesce(1).write.mode("append").parquet(str(folder))


@pytest.fixture
def shards(spark, shop, tmp_path) -> Shards:
    """Two files on the first day, one on the second; the third is not finished."""
    root = tmp_path / "export"
    _write(shop.raw({"at": 0}, {"at": HOUR}), root / "events_20240301")
    _write(shop.raw({"at": 9 * HOUR}), root / "events_20240301")
    _write(shop.raw({"at": 30 * HOUR, "date": "20240302"}), root / "events_20240302")
    _write(shop.raw({"at": 50 * HOUR, "date": "20240303"}), root / "events_intraday_20240303")
    return Shards(spark, str(root), str(tmp_path / "zones"))


def _hours(df) -> list[int]:
    return sorted((r.event_timestamp - T0) // HOUR for r in df.select("event_timestamp").collect())


def test_suffixes_choose_days(shards):
    assert shards.days() == ["20240301", "20240302"]
    assert _hours(shards.scan("20240302", "20240303")) == [30]
    assert _hours(shards.scan("20240301", "20240302")) == [0, 1, 9, 30]
    assert shards.scan("20240310", "20240320").count() == 0


def test_only_files_in_range_are_opened(shards):
    assert shards.index() == 3
    assert shards.index() == 0
    found = shards.scan("20240301", "20240302", T0 + HOUR, T0 + 8 * HOUR)
    assert len(found.inputFiles()) == 1
    assert _hours(found) == [1]
    assert len(shards.scan("20240301", "20240302", since=T0 + 9 * HOUR).inputFiles()) == 2
    assert len(shards.scan("20240301", "20240302", until=T0 + 9 * HOUR).inputFiles()) == 2
    assert shards.scan("20240301", "20240302", T0 + 2 * HOUR, T0 + 8 * HOUR).count() == 0


def test_files_the_map_does_not_know_are_read(shards, shop):
    shards.index()
    _write(shop.raw({"at": 4 * HOUR}), Path(shards.path, "events_20240301"))
    window = ("20240301", "20240302", T0 + 2 * HOUR, T0 + 8 * HOUR)
    assert _hours(shards.scan(*window)) == [4]
    assert shards.index() == 1
    assert _hours(shards.scan(*window)) == [4]


def test_a_file_written_anew_is_read(shards, shop):
    shards.index()
    folder = Path(shards.path, "events_20240302")
    shop.raw({"at": 3 * HOUR}, {"at": 4 * HOUR}).coalesce(1).write.mode(
        "overwrite"
    ).parquet(str(folder))
    (made,) = folder.glob("*.parquet")
    # The same name as before, but other content.
    window = ("20240302", "20240302", T0 + 2 * HOUR, T0 + 8 * HOUR)
    assert _hours(shards.scan(*window)) == [3, 4]
    shards.index()
    assert [Path(f).name for f in shards.scan(*window).inputFiles()] == [made.name]


def test_without_a_map_all_files_are_read(shards):
    found = shards.scan("20240301", "20240302", T0 + HOUR, T0 + 8 * HOUR)
    assert len(found.inputFiles()) == 3
    assert _hours(found) == [1]


def test_columns_that_came_later_are_null(shards, shop):
    older = shop.raw({"at": -30 * HOUR, "date": "20240229"}).drop("items", "ecommerce", "event_id")
    _write(older, Path(shards.path, "events_20240229"))
    shards.index()
    rows = shards.scan("20240229", "20240301", with_event_id=True).orderBy("event_timestamp").collect()
    assert [r.event_id is None for r in rows] == [True, False, False, False]
    assert rows[0]["items"] is None and rows[0].ecommerce is None
    assert stage_events(shards.scan("20240229", "20240301")).count() == 4


def test_events_without_a_time(shards, shop):
    timeless = shop.raw({}).withColumn("event_timestamp", F.lit(None).cast("bigint"))
    _write(timeless, Path(shards.path, "events_20240304"))
    assert shards.index() == 4
    assert shards.scan("20240304", "20240304").count() == 1
    assert shards.scan("20240304", "20240304", since=0).inputFiles() == []


def test_an_empty_export(spark, tmp_path):
    shards = Shards(spark, str(tmp_path / "none"), str(tmp_path / "zones"))
    assert shards.index() == 0
    assert shards.scan("20240101", "20241231").count() == 0


def test_a_large_day_becomes_files_of_successive_times(spark, shop, tmp_path):
    raw = shop.raw(*({"at": n * HOUR // 100, "user": f"u{n % 7}"} for n in range(2_000)))
    path = str(tmp_path / "export")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        prefix = write_shards(raw, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = Shards(spark, path, str(tmp_path / "zones"), prefix)
    assert shards.index() == 8
    found = shards.scan("20240301", "20240301", T0, T0 + HOUR)
    assert found.count() == 101
    assert found.columns == raw.drop("event_id").columns
    assert len(found.inputFiles()) == 1
