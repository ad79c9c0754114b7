"""What the operators share: reading tables, the shared work folder, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clickshop.session import shared_folder

#: Rows and bytes that Spark puts into one Arrow batch for Python.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def prepare(spark: SparkSession, share: int = 1) -> None:
    """Make Python workers ready: small Arrow batches, and this package on their path.

    ``share`` divides the batches further, for operators whose workers hold much else.
    """
    for key, value in BATCH.items():
        spark.conf.set(key, str(max(1, int(value) // share)))
    context = spark.sparkContext
    if "clickshop.zip" in context._python_includes:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(), "clickshop.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps never recompute it."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def field(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, *made: str) -> list[str]:
    """The columns of ``df`` but for those named like ``made``, in any case."""
    return [c for c in df.columns if c.lower() not in made]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once per row, also when lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def in_batches(
    rows: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function on batches in the form ``mapInArrow`` takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield rows(batch)

    return run


def mapped(
    df: DataFrame, rows: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType
) -> DataFrame:
    """``mapInArrow`` by position, for column names of any form, such as ones with dots."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    names = [f"c{i}" for i in range(len(schema))]
    safe = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, schema)])

    def renamed(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(rows(batch).columns, names=names)

    return plain.mapInArrow(in_batches(renamed), safe).toDF(*schema.names)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and its n + 1 offsets; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), at - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]
