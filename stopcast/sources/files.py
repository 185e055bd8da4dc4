"""File sources and sinks (SRC3, SRC4, SNK1, SNK3).

Outputs go under the shared folder named by ``spark.checkpoint.dir`` (or a
caller-given shared path), never a machine-local temporary directory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from stopcast.session import ensure_checkpoint_dir

# The GTFS files and the columns the reference reads.
GTFS_FILES = {
    "routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type"],
    "trips": ["route_id", "service_id", "trip_id", "trip_headsign", "direction_id"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
    "stop_times": ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"],
    "frequencies": ["trip_id", "start_time", "end_time", "headway_secs"],
}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared output area (under the checkpoint dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/stopcast-out/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """SNK1: write a result table (parquet by default; CSV with header)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """SRC3: CSV with header; a declared schema (no inference) when given."""
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists; any other failure is an error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _all_strings(cols) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in cols])


def read_gtfs(spark: SparkSession, root: str, files: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """SRC4: GTFS text files read with every column as string (keeps leading
    zeros); a missing file gives a typed empty table instead of an error."""
    files = files or GTFS_FILES
    out = {}
    for name, cols in files.items():
        schema = _all_strings(cols)
        path = f"{root.rstrip('/')}/{name}.txt"
        out[name] = (spark.read.option("header", True).schema(schema).csv(path) if exists(spark, path)
                     else spark.createDataFrame([], schema))
    return out


def write_gtfs(tables: dict[str, DataFrame], root: str) -> str:
    """Write GTFS-like tables as ``<name>.txt`` CSV folders (one per table)."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{root.rstrip('/')}/{name}.txt")
    return root
