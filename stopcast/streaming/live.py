"""Structured Streaming forms of the label and history operators (ST1, ST2).

The reference is batch-only; these are the streaming re-aims of AG1 and
WN1-WN4 named in SURVEY §2.13.

* ST1 ``users_per_bin_stream``: distinct users per (stop, tumbling bin) with
  an event-time watermark.  Each (stop, bin, user) is a key of its own in the
  de-duplication state, dropped when the watermark has passed its bin, and a
  (stop, bin) holds one number: no list of users anywhere.  Runs in update mode;
  every micro-batch's updated groups are written with the batch id, and
  ``latest`` keeps the last update per group.
* ST2 ``history_stream``: per-key state carried across micro-batches by
  ``transformWithState``.  Events wait in pieces of event time until the
  watermark has passed a piece; a timer then emits the pieces in time order, each
  event with the history of the events before it.  Events may arrive in any order
  within the watermark.  A key's few waiting events are one state value, so that a key
  costs some five state calls a batch, not some of each piece; of a key with more, one
  piece is held at a time.

Rows later than the watermark are left out; ``run_to_table`` writes how many, by
batch, beside the output (``late_rows``).  Sinks, checkpoints and state live under
the shared folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from stopcast.operators.labels import time_floor
from stopcast.semantics import MICROS_PER_DAY
from stopcast.sources.files import exists, shared_path

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """Stream the ``events`` parquet folder/file and shape it like the model
    events (stop from the JSON props, binary target)."""
    from stopcast.sources.tables import pin_utc
    pin_utc(spark)
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    # the file stream source watches a directory; only the events file is read
    ev = r.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return ev.select(
        "event_id", F.col("ts").cast("timestamp").alias("event_timestamp"), F.col("user_id").alias("user_pseudo_id"),
        F.get_json_object("props", "$.k").cast("int").alias("gtfs_stop_id"),
        (F.col("event_type") == "purchase").cast("int").alias("target"))


def users_per_bin_stream(events: DataFrame, *, width: str = "2 minutes", watermark: str = "10 minutes",
                         stop: str = "gtfs_stop_id", user: str = "user_pseudo_id", ts: str = "event_timestamp") -> DataFrame:
    """ST1: streaming AG1 (exact distinct users per (stop, bin); a bin whose rows have no user counts 0)."""
    return (events.withWatermark(ts, watermark)
                  .where(F.col(stop).isNotNull())
                  .select(stop, F.window(ts, width).alias("w"), user)
                  .dropDuplicates([stop, "w", user])
                  .groupBy(stop, "w").agg(F.count(user).alias("user_count"))
                  .select(stop, F.col("w.start").alias("time_bin"), "user_count"))


class _Late(StreamingQueryListener):
    """Rows that stateful operators left out as later than the watermark, by batch."""

    def __init__(self) -> None:
        self.rows: dict[tuple[str, int], int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        # the first operator sees the rows themselves; what it drops, later ones never see
        n = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        self.rows[str(p.id), p.batchId] = max(n, self.rows.get((str(p.id), p.batchId), 0))

    def onQueryTerminated(self, event) -> None:
        pass


@contextlib.contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB: larger than memory, and what ``transformWithState`` asks for."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def run_to_table(stream: DataFrame, spark: SparkSession, name: str, mode: str = "update", end: str | None = None) -> str:
    """Run a streaming query until the available input is consumed, writing
    every micro-batch (with its batch id) to a parquet table; returns its path.
    ``end``: the folder of ``with_end``; the stream is then closed: what waits for
    the watermark is emitted.  The late rows of each batch are in ``<path>-late``."""
    out = shared_path(spark, name)
    ckpt = shared_path(spark, name + "-ckpt")

    def sink(batch: DataFrame, batch_id: int) -> None:
        # a folder per batch, overwritten when Spark repeats the batch
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    late = _Late()
    spark.streams.addListener(late)
    try:
        with _state_on_disk(spark):
            for last in ([False, True] if end else [False]):
                if last:
                    _end_row(spark).write.mode("append").parquet(end)
                q = (stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", ckpt)
                           .trigger(availableNow=True).start())
                q.awaitTermination()
                for p in q.recentProgress:      # the listener may lag behind
                    late.onQueryProgress(type("Event", (), {"progress": p}))
    finally:
        spark.streams.removeListener(late)
    rows = sorted((b, n) for (_, b), n in late.rows.items())
    spark.createDataFrame(rows, "batch_id long, late_rows long").write.parquet(out + "-late")
    return out


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, late_rows) of a table that ``run_to_table`` wrote."""
    return spark.read.parquet(path + "-late")


def latest(spark: SparkSession, path: str, keys: list[str], schema: str | None = None) -> DataFrame:
    """Final state of an update-mode output: last batch's row per key."""
    if not exists(spark, path):        # nothing was emitted
        return spark.createDataFrame([], schema) if schema else spark.createDataFrame([], "batch_id long")
    df = spark.read.parquet(path)
    w = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "batch_id")


HIST_OUT = ("event_id long, key long, hist_count long, hist_conversion_rate double, recency_days long")
EVENT = np.dtype([("ts", "<i8"), ("id", "<i8"), ("target", "<f8")])
END_KEY = -(1 << 63)        # the key of the row that ends a stream
END_SCHEMA = "event_id long, event_timestamp timestamp, __key long, target int"


def _end_row(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT CAST(NULL AS BIGINT) AS event_id, TIMESTAMP '2250-01-01' AS event_timestamp, "
                     f"{END_KEY + 1}L - 1L AS __key, CAST(NULL AS INT) AS target")


FEW = 1 << 16               # bytes of a key's waiting events that are kept together


class OrderedHistory(StatefulProcessor):
    """Waiting events by time, and the history of those already emitted.  What a key
    holds is one value, read and written once a batch; the events of a key of which more
    than ``few`` bytes wait are in pieces of time of their own."""

    def __init__(self, width_ms: int, few: int = FEW):
        self.width, self.few = width_ms, few

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "n long, pos double, lab long, last_us long, due long, events binary, split boolean")
        self.pieces = handle.getMapState("pieces", "piece long", "events binary")

    def _state(self) -> tuple:
        return self.held.get() or (0, 0.0, 0, None, None, b"", False)

    def _wake(self, piece: int) -> int:
        self.handle.registerTimer((piece + 1) * self.width)
        return piece

    def _put(self, new: np.ndarray) -> None:
        piece = new["ts"] // (self.width * 1000)
        for p in np.unique(piece).tolist():
            held = bytes(self.pieces.getValue((p,))[0]) if self.pieces.containsKey((p,)) else b""
            self.pieces.updateValue((p,), (held + new[piece == p].tobytes(),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        *past, due, events, split = self._state()
        events, first = bytes(events), None
        for pdf in rows:
            pdf = pdf[pdf["event_id"].notna()]
            if not len(pdf):
                continue
            new = np.empty(len(pdf), EVENT)
            new["ts"] = pdf["event_timestamp"].astype("datetime64[us]").astype("int64")
            new["id"], new["target"] = pdf["event_id"].astype("int64"), pdf["target"].astype("float64")
            p = int(new["ts"].min()) // (self.width * 1000)
            first = p if first is None else min(first, p)
            if not split and len(events) + new.nbytes <= self.few:
                events += new.tobytes()
                continue
            self._put(np.concatenate([np.frombuffer(events, EVENT), new]))
            events, split = b"", True
        if first is not None:
            if due is None or first < due:
                due = self._wake(first)
            self.held.update((*past, due, events, split))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        *past, due, events, split = self._state()
        due = None
        if split:
            for p in sorted(p for p, in self.pieces.keys()):
                if (p + 1) * self.width > passed:
                    due = self._wake(p)
                    break
                ready = np.frombuffer(bytes(self.pieces.getValue((p,))[0]), EVENT)
                self.pieces.removeKey((p,))
                out, past = self._history(key, ready, past)
                yield out
            split = due is not None
        else:
            waiting = np.frombuffer(bytes(events), EVENT)
            piece = waiting["ts"] // (self.width * 1000)
            ready = (piece + 1) * self.width <= passed
            if ready.any():
                out, past = self._history(key, waiting[ready], past)
                yield out
            if not ready.all():
                due = self._wake(int(piece[~ready].min()))
            events = waiting[~ready].tobytes()
        self.held.update((*past, due, bytes(events), split))

    @staticmethod
    def _history(key, events: np.ndarray, past: list) -> tuple[pd.DataFrame, list]:
        """The rows of ``events`` with the history before each, and the history after them."""
        n, pos, lab, last = past
        events = events[np.lexsort((events["target"], events["id"], events["ts"]))]
        ts, known = events["ts"], ~np.isnan(events["target"])
        y = np.where(known, events["target"], 0.0)
        y_before, known_before = pos + np.cumsum(y) - y, lab + np.cumsum(known) - known
        rate = np.where(known_before > 0, y_before / np.maximum(known_before, 1), 0.0)
        before = np.concatenate([[ts[0] if last is None else last], ts[:-1]])
        recency = np.floor_divide(ts - before, MICROS_PER_DAY)
        if last is None:
            recency[0] = 999
        out = pd.DataFrame({"event_id": events["id"], "key": np.full(len(ts), key[0]), "hist_count": n + np.arange(len(ts)),
                            "hist_conversion_rate": rate, "recency_days": recency})
        return out, [n + len(ts), pos + float(y.sum()), lab + int(known.sum()), int(ts[-1])]

    def close(self) -> None:
        pass


def with_end(events: DataFrame, key: str = "user_pseudo_id") -> tuple[DataFrame, str]:
    """``events`` as (event_id, event_timestamp, ``__key``, target), together with an
    empty folder that is watched: the row that ends the stream goes there."""
    spark = events.sparkSession
    folder = shared_path(spark, "end")
    spark.createDataFrame([], END_SCHEMA).write.parquet(folder)
    ev = (events.where(F.col(key).isNotNull() & F.col("event_id").isNotNull() & F.col("event_timestamp").isNotNull())
          .select("event_id", "event_timestamp", F.col(key).cast("long").alias("__key"), F.col("target").cast("int").alias("target")))
    return ev.unionByName(spark.readStream.schema(END_SCHEMA).parquet(folder)), folder


def history_stream(events: DataFrame, *, watermark: str = "1 day", piece: str = "1 day") -> DataFrame:
    """ST2: streaming WN1/WN4 for one key (count, rate, recency of the events
    before each event) over what ``with_end`` gives; null keys get no history.
    An event is emitted when the watermark has passed its ``piece`` of time."""
    count, unit = piece.split()
    width = int(pd.Timedelta(int(count), unit.rstrip("s")) / pd.Timedelta(1, "ms"))
    return (events.withWatermark("event_timestamp", watermark).groupBy("__key")
            .transformWithStateInPandas(OrderedHistory(width), HIST_OUT, "append", "EventTime"))


__all__ = ["read_events_stream", "users_per_bin_stream", "history_stream", "with_end", "run_to_table", "late_rows", "latest", "time_floor"]
