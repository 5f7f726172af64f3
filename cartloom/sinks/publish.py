"""Publishing tables to an analytic store with replace semantics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cartloom.params import JobParams


def publish(tables: dict[str, DataFrame], params: JobParams) -> list[str]:
    """Replace each table in the configured database; the first failure ends the run.

    A database of the session catalog gets every table under a passing name first; only when all
    are written do they take the names of the old ones, so a failed write leaves all of these. A
    database of another catalog (``catalog.database``) replaces each table by that catalog's own
    atomic step. With a format, ``publish_options`` go to that connector, which decides what its
    overwrite keeps. ``{table}`` in an option value stands for the table name.
    """
    if not params.publish_enabled:
        return []
    if not params.publish_database:
        raise ValueError("Publishing is enabled, but publish_database is not set")
    targets = {name: f"{params.publish_database}.{name}" for name in tables}
    if params.publish_format is not None:
        for name, df in tables.items():
            df.write.mode("overwrite").options(**_options(params, name)).format(params.publish_format).save()
    elif "." in params.publish_database:
        for name, df in tables.items():
            writer = df.writeTo(targets[name])
            for key, value in _options(params, name).items():
                writer = writer.option(key, value)
            writer.createOrReplace()
    elif tables:
        _swap(next(iter(tables.values())).sparkSession, tables, targets, params)
    return list(targets.values())


def _options(params: JobParams, table: str) -> dict[str, str]:
    return {k: v.format(table=table) for k, v in params.publish_options.items()}


def _swap(spark: SparkSession, tables: dict[str, DataFrame], targets: dict[str, str], params: JobParams) -> None:
    """All tables under passing names, then the names: renames in the catalog, undone together if one fails."""
    mark = uuid.uuid4().hex[:12]
    new, old = ({n: f"{t}__{kind}_{mark}" for n, t in targets.items()} for kind in ("new", "old"))
    renamed: list[tuple[str, str]] = []

    def rename(source: str, target: str) -> None:
        spark.sql(f"alter table {_quoted(source)} rename to {_quoted(target)}")
        renamed.append((source, target))

    try:
        for name, df in tables.items():
            options = _options(params, name)
            if "path" in options:  # a folder of its own, as the old table still reads the other one
                options["path"] += f"/{mark}"
            df.write.options(**options).saveAsTable(new[name])
        for name, target in targets.items():
            if spark.catalog.tableExists(target):
                rename(target, old[name])
            rename(new[name], target)
    except Exception:
        for source, target in reversed(renamed):
            spark.sql(f"alter table {_quoted(target)} rename to {_quoted(source)}")
        for table in new.values():
            spark.sql(f"drop table if exists {_quoted(table)}")
        raise
    for table in old.values():
        spark.sql(f"drop table if exists {_quoted(table)}")


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))
