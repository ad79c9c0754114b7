"""The raw event source: a Parquet dataset with one folder per event date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickshop.schemas import RAW_EVENT
from clickshop.session import unsorted_days


def scan_events(
    spark: SparkSession,
    path: str,
    start: str,
    end: str,
    *,
    with_event_id: bool = False,
) -> DataFrame:
    """Events of the dates ``start`` to ``end`` (``yyyyMMdd``, both included).

    The files of other dates are not listed: the folder is asked for its day folders
    only, and the reader gets those in range.  Only the declared nested fields are
    read.  ``with_event_id`` also reads the source's own event id.
    """
    schema = f"{RAW_EVENT}, event_id bigint" if with_event_id else RAW_EVENT
    days = [d for d in _days(spark, path) if start <= d.rpartition("=")[2] <= end]
    reader = spark.read.schema(schema).option("basePath", path)
    if not days:
        return spark.createDataFrame([], schema)
    return in_date_range(reader.parquet(*[f"{path.rstrip('/')}/{d}" for d in days]), start, end)


def _days(spark: SparkSession, path: str) -> list[str]:
    """Names of the day folders: one listing of one folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(folder)]
    return sorted(n for n in names if n.startswith("event_date="))


def in_date_range(raw: DataFrame, start: str, end: str) -> DataFrame:
    """The events of a date range, compared as the text the source stores."""
    return raw.where(F.col("event_date").between(start, end))


def write_events(raw: DataFrame, path: str) -> None:
    """Store raw events in the layout that ``scan_events`` prunes."""
    # Rebalancing gives each folder few files and splits a day that is too large.
    with unsorted_days(raw.sparkSession):
        raw.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(
            path
        )
