"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopcast.session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """``<sf_dir>/<table>.parquet`` through Spark's reader (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, which all executors see."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, survives lost executors, and keeps what several readers share."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run wrote under the shared folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs left behind: Spark deletes shuffle files once the
    driver's JVM has collected what referred to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): (node, root) for every
    node of an edge, root = the smallest node of its component.

    Alternates the large-star and small-star steps: every node points to the
    smallest neighbour it knows of, so a chain of n links needs O(log n)
    rounds, and no round holds more rows than there are links.  Each round is
    written to the shared folder (recoverable) and the one before is deleted.
    The driver sees one sum a round.  The minimum over a hub's neighbours is a
    map-side combined aggregate, and the rows go back by a join that Spark may
    split when skewed, so no task holds all neighbours of a hub.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
            out = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        else:
            down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            low = down.groupBy("a").agg(F.min("b").alias("m"))
            out = (down.join(low, "a")
                   .select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                             F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                   .select("e.a", "e.b"))
        return out.where("a <> b").distinct()

    schema = "a bigint, b bigint"

    def put(df: DataFrame) -> tuple[DataFrame, str]:
        path = shared_folder(spark, "links")
        df.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).write.parquet(path)
        return spark.read.schema(schema).parquet(path), path

    cur, path = put(edges.where("a <> b").distinct())
    sign = None
    for _ in range(max_rounds):
        nxt, npath = put(star(star(cur, True), False))
        drop_folder(spark, path)
        cur, path = nxt, npath
        got = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if got == sign:
            break
        sign = got
    else:
        raise RuntimeError(f"components: no fixpoint after {max_rounds} rounds")
    roots = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select("root", "root").distinct())


T = TypeVar("T")
_STATE: dict = {}


def worker_state(key: Hashable, make: Callable[[], T]) -> T:
    """What an operator keeps in a Python worker from task to task (a model,
    a coder, a cache).  A worker keeps that of one operator only: Spark reuses
    workers, and a pipeline's stages would add up in their memory."""
    if key not in _STATE:
        if _STATE:
            _STATE.clear()
            give_back()
        _STATE[key] = make()
    return _STATE[key]


def give_back() -> None:
    """Return freed memory to the system; Python and Arrow keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def no_state() -> None:
    """For operators that keep nothing: what another one kept is dropped."""
    worker_state("none", lambda: None)
