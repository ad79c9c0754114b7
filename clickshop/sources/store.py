"""Built relations, kept as versioned Parquet folders or as catalog tables."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from clickshop.schemas import RELATIONS, columns_of, conforming
from clickshop.session import held
from clickshop.sources import files

# Written with one folder per day, so that days can be replaced alone.
PARTITIONED = {
    "stg_events": "event_date_dt",
    "int_purchase_events_deduped": "event_date_dt",
    "fct_orders": "order_date",
    "fct_order_items": "purchase_date",
    "int_sessions": "session_date",
}
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_COMMITS = "_commits"
_SCRATCH = "_scratch"

# Relation -> folder of a day ("" without days) -> its path below the store.
Manifest = dict[str, dict[str, str]]
# Relation -> counts taken while it was written.
Metrics = dict[str, dict[str, int]]


class CommitConflict(RuntimeError):
    """Another writer has committed since this one began."""


@dataclass(frozen=True)
class Store:
    """Writes relations by name and reads them back.

    Every write goes to new folders.  A commit, one small file that appears whole, says which
    folders make up which relation; the newest one counts.  So a reader sees all relations as
    of one commit, before or after a rebuild and never between, and a frame that was
    read keeps its files until ``expire`` deletes them.

    A relation read back starts from files: whatever built it is never run again,
    also not after an executor is lost, if ``path`` or the warehouse is on storage
    that all executors share.  With ``database`` the relations become
    catalog tables instead, replaced one by one, and without the above.
    """

    spark: SparkSession
    path: str | None = None
    database: str | None = None

    def __post_init__(self) -> None:
        if (self.path is None) == (self.database is None):
            raise ValueError("give either a path or a database")

    def begin(self) -> Draft:
        """Changes to several relations that become visible together."""
        version, manifest = self._newest()
        return Draft(self, version, manifest, self.metrics())

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Replace relation ``name`` alone and return it as read back."""
        draft = self.begin()
        draft.write(name, df)
        draft.commit()
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        """Relation ``name`` as of the newest commit."""
        return self.load(name, self._newest()[1])

    def tables(self) -> dict[str, DataFrame]:
        """All relations as of one commit."""
        manifest = self._newest()[1]
        return {name: self.load(name, manifest) for name in RELATIONS}

    def register_views(self) -> None:
        """Make every relation that the store holds available to SQL under its own name."""
        manifest = self._newest()[1]
        for name in manifest if self.database is None else RELATIONS:
            self.load(name, manifest).createOrReplaceTempView(name)

    def load(self, name: str, manifest: Manifest) -> DataFrame:
        if self.database is not None:
            stored = self.spark.table(f"{self.database}.{name}")
        elif name not in manifest:
            raise ValueError(f"{self.path} holds no {name}")
        elif folders := sorted(manifest[name].values()):
            reader = self.spark.read.schema(RELATIONS[name]).option("basePath", f"{self.path}/{name}")
            stored = reader.parquet(*[f"{self.path}/{folder}" for folder in folders])
        else:
            stored = self.spark.createDataFrame([], RELATIONS[name])
        # Folder columns come last when read back; restore the declared order.
        return conforming(stored.select(*[c for c, _ in columns_of(RELATIONS[name])]), name)

    def metrics(self) -> Metrics:
        """Counts taken while relations were written, of those that were written in whole."""
        numbers = [] if self.database is not None else self._commits()
        return self._commit(numbers[-1])["metrics"] if numbers else {}

    def extremes(self, name: str, column: str) -> tuple[int | None, int | None]:
        """The least and greatest value of a numeric column, from the files' footers alone."""
        if self.database is not None:
            raise ValueError("footers are asked in a store with a path only")
        with _footers(self.spark):
            found = self._footer_query(name, column)
            return (None, None) if found is None else tuple(found.first())

    def _footer_query(self, name: str, column: str) -> DataFrame | None:
        folders = sorted(self._newest()[1][name].values())
        if not folders:
            return None
        reader = self.spark.read.schema(RELATIONS[name]).option("basePath", f"{self.path}/{name}")
        rows = reader.parquet(*[f"{self.path}/{folder}" for folder in folders])
        return rows.agg(F.min(column), F.max(column))

    def folders(self, name: str) -> dict[str, str]:
        """The folders of a relation as of the newest commit, by day."""
        return dict(self._newest()[1].get(name, {}))

    def expire(self, keep: int = 1) -> None:
        """Delete what only commits before the last ``keep`` refer to; drafts are left alone."""
        numbers = self._commits()
        old, kept = numbers[: -max(1, keep)], numbers[-max(1, keep) :]
        used = {f for n in kept for folders in self._manifest(n).values() for f in folders.values()}
        for n in old:
            for folders in self._manifest(n).values():
                for folder in folders.values():
                    if folder not in used:
                        files.remove(self.spark, f"{self.path}/{folder}")
            files.remove(self.spark, self._commit_file(n))

    def _commits(self) -> list[int]:
        names = files.children(self.spark, f"{self.path}/{_COMMITS}")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def _commit_file(self, number: int) -> str:
        return f"{self.path}/{_COMMITS}/{number:08d}.json"

    def _commit(self, number: int) -> dict:
        return json.loads(files.read_text(self.spark, self._commit_file(number)))

    def _manifest(self, number: int) -> Manifest:
        return self._commit(number)["folders"]

    def _newest(self) -> tuple[int, Manifest]:
        if self.database is not None or not (numbers := self._commits()):
            return 0, {}
        return numbers[-1], self._manifest(numbers[-1])


@dataclass
class Draft:
    """Relations written but not yet committed; reads see them, other readers do not."""

    store: Store
    base: int
    manifest: Manifest
    metrics: Metrics
    name: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    def write(
        self, name: str, df: DataFrame, counts: dict[str, Column] | None = None, by_day: bool = False
    ) -> DataFrame:
        """Replace relation ``name`` in whole and return it as read back.

        ``counts`` are aggregates taken by the job that writes, in its last stage, whose tasks count once.
        ``by_day``: each task of ``df`` holds rows of few days, so they are written without a shuffle.
        """
        seen = Observation() if counts else None
        if self.store.database is not None:
            self._save(name, df, by_day=by_day).saveAsTable(f"{self.store.database}.{name}")
        else:
            self.manifest[name] = self._written(name, df, counts, seen, by_day)
            self.metrics.pop(name, None)
            if seen is not None:
                self.metrics[name] = dict(seen.get)
        return self.read(name)

    def replace_days(self, name: str, df: DataFrame, days: set[str]) -> DataFrame:
        """Replace the folders ``days`` of relation ``name`` by the rows of ``df``, which are of these days."""
        if self.store.database is not None:
            raise ValueError("days are replaced in a store with a path only")
        if not days:
            return self.read(name)
        kept = {day: f for day, f in self.manifest.get(name, {}).items() if day not in days}
        added = self._written(name, df)
        if set(added) - days:
            raise ValueError(f"{name}: rows of other days: {sorted(set(added) - days)}")
        self.manifest[name] = kept | added
        self.metrics.pop(name, None)
        return self.read(name)

    def stash(self, df: DataFrame) -> DataFrame:
        """``df`` written aside and read back, for results that several steps read."""
        path = f"{self.store.path}/{_SCRATCH}/{self.name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def read(self, name: str) -> DataFrame:
        return self.store.load(name, self.manifest)

    def commit(self) -> None:
        """Make all changes visible at once; fails if another commit came between."""
        spark, store = self.store.spark, self.store
        if store.database is not None:
            return
        if not files.write_new(spark, store._commit_file(self.base + 1), json.dumps({"folders": self.manifest, "metrics": self.metrics})):
            raise CommitConflict(f"commit {self.base + 1} of {store.path} exists; begin again")
        for name in files.children(spark, f"{store.path}/{_SCRATCH}"):
            if name.startswith(self.name):
                files.remove(spark, f"{store.path}/{_SCRATCH}/{name}")

    @staticmethod
    def _plan(name: str, df: DataFrame, by_day: bool) -> DataFrame:
        """The rows as they are written, dealt to their days unless they come ``by_day``."""
        rows, day = conforming(df, name), PARTITIONED.get(name)
        # Rebalancing makes few files a day, and several for a day that is too large.
        return rows if day is None or by_day else rows.hint("rebalance", day)

    def _save(
        self,
        name: str,
        df: DataFrame,
        counts: dict[str, Column] | None = None,
        seen: Observation | None = None,
        by_day: bool = False,
    ):
        rows, day = self._plan(name, df, by_day), PARTITIONED.get(name)
        if counts and seen is not None:
            rows = rows.observe(seen, *[c.alias(k) for k, c in counts.items()])
        writer = rows.write.mode("overwrite").format("parquet")
        return writer if day is None else writer.partitionBy(day)

    def _written(
        self,
        name: str,
        df: DataFrame,
        counts: dict[str, Column] | None = None,
        seen: Observation | None = None,
        by_day: bool = False,
    ) -> dict[str, str]:
        folder = f"{name}/version={self.name}-{uuid.uuid4().hex[:8]}"
        self._save(name, df, counts, seen, by_day).save(f"{self.store.path}/{folder}")
        if name not in PARTITIONED:
            return {"": folder}
        found = files.children(self.store.spark, f"{self.store.path}/{folder}")
        return {day_of(f): f"{folder}/{f}" for f in found if f.startswith(f"{PARTITIONED[name]}=")}


def _footers(spark: SparkSession):
    """Within, Parquet answers min, max and count from its footers; settings are put back after."""
    return held(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"})


def day_of(folder: str) -> str:
    """The day of a day's folder, as text; ``NO_DAY`` for rows without one."""
    return folder.rpartition("=")[2]
