"""Events in one folder per day suffix, with a zone map of their files.

The source exports each day as a set of its own, ``events_20240131``.  The zone map is a
Parquet folder with one row per file: its first and last event time and its rows.  A scan
of some hours opens only the files that can hold them.  The map is a hint, never the
truth: a file counts as known by its name, size and time of change, and files that are new
or changed since ``index`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickshop.schemas import RAW_EVENT
from clickshop.sources import files

ZONES = """
    shard string, name string, size bigint, modified bigint,
    first bigint, last bigint, events bigint
"""
FILE = ["shard", "name", "size", "modified"]


@dataclass(frozen=True)
class Shards:
    """Day folders ``path/<prefix>yyyyMMdd`` and their zone map in the folder ``zones``.

    Folders of other names, such as those of unfinished days, are left alone.
    """

    spark: SparkSession
    path: str
    zones: str
    prefix: str = "events_"

    def days(self, start: str = "00000000", end: str = "99999999") -> list[str]:
        """Suffixes between ``start`` and ``end``, both included: one listing of one folder."""
        names = files.children(self.spark, self.path)
        found = [n.removeprefix(self.prefix) for n in names if n.startswith(self.prefix)]
        return [d for d in found if len(d) == 8 and d.isdecimal() and start <= d <= end]

    def index(self) -> int:
        """Add the files that the zone map does not know; gives their number.

        One job reads the time column of these files only, and sends one row per task and file.
        """
        listed = self._listed(self.days())
        known = self._known()
        new = [path for key, path in listed.items() if key not in known]
        if new:
            time, of_file = F.col("event_timestamp"), F.col("_metadata")
            rows = self.spark.read.schema("event_timestamp bigint").parquet(*new).select(
                F.element_at(F.split(of_file["file_path"], "/"), -2).alias("shard"),
                of_file["file_name"].alias("name"),
                of_file["file_size"].alias("size"),
                F.unix_millis(of_file["file_modification_time"]).alias("modified"),
                time,
            )
            bounds = F.min(time).alias("first"), F.max(time).alias("last")
            zones = rows.groupBy(*FILE).agg(*bounds, F.count(F.lit(1)).alias("events"))
            # Paths come as URIs.
            plain = {c: F.url_decode(c) for c in ("shard", "name")}
            zones.withColumns(plain).write.mode("append").parquet(self.zones)
        return len(new)

    def scan(
        self,
        start: str,
        end: str,
        since: int | None = None,
        until: int | None = None,
        *,
        with_event_id: bool = False,
    ) -> DataFrame:
        """Events of the suffixes ``start`` to ``end``, and of the times ``since`` to ``until``.

        All bounds are included; times are microseconds, and without them whole days are
        read, events without a time among them.  Columns that a day's files lack, as they
        came later, are NULL.
        """
        schema = f"{RAW_EVENT}, event_id bigint" if with_event_id else RAW_EVENT
        days = self.days(start, end)
        timed = since is not None or until is not None
        if timed:
            paths = self._in_time(days, since, until)
        else:
            paths = [self._folder(d) for d in days]
        empty = self.spark.createDataFrame([], schema)
        if not paths:
            return empty
        events = self.spark.read.schema(schema).parquet(*paths).select(*empty.columns)
        time = F.col("event_timestamp")
        if since is not None:
            events = events.where(time >= since)
        return events if until is None else events.where(time <= until)

    def _in_time(self, days: list[str], since: int | None, until: int | None) -> list[str]:
        known = self._known(days)

        def may_hold(key: tuple) -> bool:
            if key not in known:
                return True
            first, last = known[key]
            if first is None:
                return False
            return (until is None or first <= until) and (since is None or since <= last)

        return [path for key, path in self._listed(days).items() if may_hold(key)]

    def _folder(self, day: str) -> str:
        return f"{self.path.rstrip('/')}/{self.prefix}{day}"

    def _listed(self, days: list[str]) -> dict[tuple, str]:
        """Files of the days: shard, name, size and time of change, each with its path."""
        found = {}
        for day in days:
            for name, size, modified in files.details(self.spark, self._folder(day)):
                if not name.startswith(("_", ".")):
                    key = (f"{self.prefix}{day}", name, size, modified)
                    found[key] = f"{self._folder(day)}/{name}"
        return found

    def _known(self, days: list[str] | None = None) -> dict[tuple, tuple]:
        """Time bounds by file.  One entry per file, as in Spark's own list of a scan's files."""
        if not files.children(self.spark, self.zones):
            return {}
        zones = self.spark.read.schema(ZONES).parquet(self.zones)
        if days is not None:
            first, last = (f"{self.prefix}{d}" for d in (min(days, default=""), max(days, default="")))
            zones = zones.where(F.col("shard").between(first, last))
        return {tuple(r[c] for c in FILE): (r["first"], r["last"]) for r in zones.collect()}


def write_shards(raw: DataFrame, path: str) -> str:
    """Store events by day suffix, files cut by time; gives the prefix of the day folders.

    A large day becomes several files of successive times.  Spark names the folders
    ``events_=yyyyMMdd``; ``event_date`` stays a column of the files.
    """
    by_time = raw.repartitionByRange("event_date", "event_timestamp")
    named = by_time.sortWithinPartitions("event_date", "event_timestamp").withColumn(
        "events_", F.col("event_date")
    )
    named.write.mode("overwrite").partitionBy("events_").parquet(path)
    return "events_="
