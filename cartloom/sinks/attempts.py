"""Layers that are written once, checked where they lie, and then put in place by renames.

An attempt is a folder beside the published tables, hidden to readers by its name. Nothing below
the published paths changes before ``publish``. That step only renames: what was published before
steps aside into the attempt, the new tables take its place, and if any rename fails all are undone.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.params import JobParams
from cartloom.schemas import PUBLISHED_ORDER

# Independent writes go to Spark together, so small tables do not queue behind each other.
PARALLEL_WRITES = 8


def run_together(spark: SparkSession, tasks: list) -> list:
    """The results of independent Spark actions run from a few threads; the first error is raised."""
    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [future.result() for future in futures]


def snapshot_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def dated_path(base: str, table: str, run_date: str) -> str:
    return f"{snapshot_path(base, table)}/dt={run_date}"


def latest_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/latest/{table}"


def save_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def in_published_order(df: DataFrame, table: str) -> DataFrame:
    """Tables that are published in an order are sorted; others stay as they are."""
    keys = [key.split(" ") for key in PUBLISHED_ORDER.get(table, ())]
    return df.orderBy(*[F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in keys]) if keys else df


class Attempt:
    """One try at a layer below ``base``."""

    def __init__(self, spark: SparkSession, base: str, params: JobParams):
        self.spark, self.base, self.params = spark, base.rstrip("/"), params
        self.folder = f"{self.base}/_attempt-{uuid.uuid4().hex}"
        self.tables: dict[str, DataFrame] = {}
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._path, self._files = spark._jvm.org.apache.hadoop.fs.Path, path.getFileSystem(spark._jsc.hadoopConfiguration())

    def write(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write new tables side by side; returns them as read from their files."""
        for table, df in tables.items():
            if self.params.write_partitioned and "dt" in df.columns:
                raise ValueError(f"Table '{table}' already has a column 'dt'")
        run_together(self.spark, [lambda d=df, n=name: save_parquet(in_published_order(d, n), self._new(n)) for name, df in tables.items()])
        written = {name: self._read(df, self._new(name)) for name, df in tables.items()}
        self.tables.update(written)
        return written

    def publish(self) -> dict[str, DataFrame]:
        """Put every table in place: dated, latest, or both; returns them as read from there.

        The second place needs a second copy. It is made from the written files, without a shuffle
        except to sort, and inside the attempt, before anything published is touched.
        """
        places = {name: self._places(name) for name in self.tables}
        if self.params.write_partitioned and self.params.write_latest:
            run_together(self.spark, [lambda d=df, n=name: save_parquet(in_published_order(d, n), self._copy(n)) for name, df in self.tables.items()])
        moves = [(source, target) for name in self.tables for source, target in places[name]]
        done: list[tuple[str, str, str | None]] = []
        try:
            for number, (source, target) in enumerate(moves):
                aside = f"{self.folder}/old/{number}" if self._exists(target) else None
                if aside:
                    self._rename(target, aside)
                done.append((source, target, aside))
                self._rename(source, target)
        except Exception:
            for source, target, aside in reversed(done):
                if self._exists(target):
                    self._rename(target, source)
                if aside:
                    self._rename(aside, target)
            raise
        self.tables = {name: self._read(df, places[name][-1][1] if places[name] else self._new(name)) for name, df in self.tables.items()}
        return self.tables

    def drop(self) -> None:
        """Remove what is left of the attempt."""
        self._files.delete(self._path(self.folder), True)
        base = self._path(self.base)
        if self._files.exists(base) and not self._files.listStatus(base):
            self._files.delete(base, False)

    def _new(self, table: str) -> str:
        return f"{self.folder}/new/{table}"

    def _copy(self, table: str) -> str:
        return f"{self.folder}/copy/{table}"

    def _places(self, table: str) -> list[tuple[str, str]]:
        dated, latest = dated_path(self.base, table, self.params.run_date), latest_path(self.base, table)
        if self.params.write_partitioned and self.params.write_latest:
            return [(self._new(table), dated), (self._copy(table), latest)]
        return [(self._new(table), dated)] * self.params.write_partitioned + [(self._new(table), latest)] * self.params.write_latest

    def _read(self, df: DataFrame, path: str) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(path)

    def _exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def _rename(self, source: str, target: str) -> None:
        self._files.mkdirs(self._path(target).getParent())
        if not self._files.rename(self._path(source), self._path(target)):
            raise OSError(f"Could not rename {source} to {target}")
