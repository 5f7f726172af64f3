from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cartloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        app="tests",
        **{
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    yield session
    session.stop()


def rows(df, *order):
    """Rows as dictionaries, sorted by the given columns."""
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
