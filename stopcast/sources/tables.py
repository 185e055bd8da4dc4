"""Typed readers for the parquet tables under an ``sf`` directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def pin_utc(spark: SparkSession) -> None:
    """Event times are UTC instants; every time expression (bins, day parts,
    zone conversion) assumes a UTC session zone (SURVEY §1.4.17)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` (timestamp_ntz on disk) as a UTC timestamp."""
    pin_utc(spark)
    df = read_table(spark, sf_dir, "events")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))
