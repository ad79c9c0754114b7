"""Session settings that the library's results and speed rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and times are UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    # Split skewed partitions and merge small ones at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods above 8000 bytes.  Staging projects many
    # columns; beyond that size Spark should generate several smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a running session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Files of days that a writing task keeps open at once; only if it meets more days are its rows sorted.
_OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "16"}


@contextmanager
def held(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Within, the settings ``wanted`` hold; they are put back after."""
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def unsorted_days(spark: SparkSession):
    """Within, rows are written to the folders of their days without being sorted by day first."""
    return held(spark, _OPEN_FILES)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where all run in one process, as in tests, a local folder serves instead.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = f"file:///tmp/checkpoints/{spark.sparkContext.applicationId}"
    return named.rstrip("/")
