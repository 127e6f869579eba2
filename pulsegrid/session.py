"""Spark sessions with the settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "pulsegrid", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; pass further settings with underscores for dots."""
    builder = SparkSession.builder.appName(name)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
