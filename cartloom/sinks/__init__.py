"""Writers: dated snapshots, the latest copy, catalog tables."""

from cartloom.sinks.attempts import Attempt, latest_path, run_together, save_parquet, snapshot_path
from cartloom.sinks.publish import publish
from cartloom.sinks.scratch import drop_scratch, scratch_folder, written_once
from cartloom.sinks.snapshots import load_staging, load_warehouse

__all__ = [
    "Attempt",
    "drop_scratch",
    "latest_path",
    "load_staging",
    "load_warehouse",
    "publish",
    "run_together",
    "save_parquet",
    "scratch_folder",
    "snapshot_path",
    "written_once",
]
