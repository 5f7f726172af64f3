"""Parquet snapshots: ``<base>/<table>/dt=<run date>`` and ``<base>/latest/<table>``.

One table is one dataset partitioned by ``dt``, so readers prune by date. A rerun replaces the run
date's folder, also by one without rows, and leaves the other dates alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartloom.params import JobParams
from cartloom.sinks.attempts import Attempt


def _load(tables: dict[str, DataFrame], base: str, params: JobParams) -> None:
    if not tables or not (params.write_partitioned or params.write_latest):
        return
    attempt = Attempt(next(iter(tables.values())).sparkSession, base, params)
    try:
        attempt.write(tables)
        attempt.publish()
    finally:
        attempt.drop()


def load_staging(tables: dict[str, DataFrame], params: JobParams) -> None:
    _load(tables, params.staging_base, params)


def load_warehouse(
    warehouse: dict[str, DataFrame], marts: dict[str, DataFrame], params: JobParams
) -> None:
    """Write dimensions, facts and marts; on a name clash the mart wins."""
    _load({**warehouse, **marts}, params.warehouse_base, params)
