"""Session settings the plans rely on, and a local session for tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

# ANSI mode stays at its default (on): bad casts must go through the try_ forms.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Without it every column expression records its call site, which slows plan building.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def local_session(cpus: int | str = 8, app: str = "cartloom", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
