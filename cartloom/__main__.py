"""Run the batch job, or check what it published.

    python -m cartloom run --params params.json
    python -m cartloom check --params params.json

The JSON file holds the fields of ``JobParams`` that differ from their defaults.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from cartloom.params import JobParams
from cartloom.plans import job
from cartloom.session import SETTINGS


def read_params(path: str | None) -> JobParams:
    if path is None:
        return JobParams()
    with open(path, encoding="utf-8") as file:
        values = json.load(file)
    if "valid_order_statuses" in values:
        values["valid_order_statuses"] = tuple(values["valid_order_statuses"])
    return JobParams(**values)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cartloom")
    parser.add_argument("command", choices=("run", "check"))
    parser.add_argument("--params", help="JSON file with job parameters")
    parser.add_argument("--out", help="folder that gets the profiles in full")
    options = parser.parse_args(arguments)
    params = read_params(options.params)
    spark = SparkSession.builder.appName(f"cartloom {options.command}").getOrCreate()
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if options.command == "run":
        result = job.run(spark, params)
        result.metrics.orderBy("step", "table").show(10_000, truncate=False)  # a row per table and step
        return
    report = job.check_published(spark, params)
    report.violations.show(10_000, truncate=False)  # a row per rule
    for name, frame in report.profiles.items():
        print(name)
        frame.show(20, truncate=False)
        if options.out:
            frame.write.mode("overwrite").json(f"{options.out.rstrip('/')}/{name}")


if __name__ == "__main__":
    main()
