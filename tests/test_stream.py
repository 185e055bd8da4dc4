"""Streams over several micro-batches, out of order and late, against the batch results."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from stopcast.operators.history import history_features
from stopcast.operators.labels import users_per_bin
from stopcast.streaming import live as L

T0 = dt.datetime(2024, 3, 1)
SCHEMA = "event_id long, event_timestamp timestamp, user_pseudo_id long, gtfs_stop_id int, target int"


def events(n=400, seed=0):
    r = random.Random(seed)
    return [(i, T0 + dt.timedelta(minutes=17 * (i // 2)), r.choice([1, 1, 1, 2, 3, None]), r.choice([0, 1, None]), r.choice([0, 1, None]))
            for i in range(n)]


def batches(spark, tmp_path, parts):
    """A folder with one file a micro-batch, read in this order."""
    folder = f"{tmp_path}/in"
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(parts):
        one = f"{tmp_path}/part{i}"
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"file://{one}")
        file = next(f for f in os.listdir(one) if f.endswith(".parquet"))
        os.link(f"{one}/{file}", f"{folder}/{i:03d}.parquet")
        os.utime(f"{folder}/{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"file://{folder}")


def shuffled(rows, size, reach, seed=1):
    """Rows in batches, each row up to ``reach`` rows away from its place."""
    r = random.Random(seed)
    order = sorted(range(len(rows)), key=lambda i: i + r.uniform(0, reach))
    rows = [rows[i] for i in order]
    return [rows[i:i + size] for i in range(0, len(rows), size)]


@pytest.mark.parametrize("piece", ["1 hour", "1 day"])
def test_history_of_shuffled_batches_equals_the_batch_result(spark, tmp_path, piece):
    rows = events()
    stream, end = L.with_end(batches(spark, tmp_path, shuffled(rows, 90, 30)))
    path = L.run_to_table(L.history_stream(stream, watermark="1 day", piece=piece), spark, "t-hist", mode="append", end=end)
    got = {r["event_id"]: (r["key"], r["hist_count"], r["hist_conversion_rate"], r["recency_days"]) for r in spark.read.parquet(path).collect()}
    df = spark.createDataFrame(rows, SCHEMA)
    want = {r["event_id"]: (r["user_pseudo_id"], r["user_hist_count"], r["user_hist_conversion_rate"], r["user_recency_days"])
            for r in history_features(df, [("user", "user_pseudo_id", True)]).where("user_pseudo_id IS NOT NULL").collect()}
    assert got == want
    assert L.late_rows(spark, path).agg(F.sum("late_rows")).first()[0] == 0


def test_history_is_emitted_up_to_the_watermark_in_order(spark, tmp_path):
    """Without an end only pieces that the watermark has passed come out, each once."""
    rows = events()
    stream, _ = L.with_end(batches(spark, tmp_path, shuffled(rows, 90, 20)))
    path = L.run_to_table(L.history_stream(stream, watermark="6 hours", piece="1 hour"), spark, "t-open", mode="append")
    got = spark.read.parquet(path).collect()
    last = max(r[1] for r in rows) - dt.timedelta(hours=6)
    due = {r[0] for r in rows if r[2] is not None and r[1] < last.replace(minute=0)}
    ids = [r["event_id"] for r in got]
    assert set(ids) >= due and len(ids) == len(set(ids)) and all(rows[i][1] < last for i in ids)
    want = {r["event_id"]: r["user_hist_count"] for r in history_features(spark.createDataFrame(rows, SCHEMA), [("user", "user_pseudo_id", True)]).collect()}
    assert all(want[r["event_id"]] == r["hist_count"] for r in got)


def test_late_rows_are_counted_and_left_out(spark, tmp_path):
    rows = events(200)
    late = [(1000 + i, T0 + dt.timedelta(minutes=i), 50 + i, 0, 1) for i in range(7)]
    parts = [rows[:100], rows[100:], late]
    path = L.run_to_table(L.users_per_bin_stream(batches(spark, tmp_path, parts), width="10 minutes", watermark="1 hour"), spark, "t-late")
    got = {(r["gtfs_stop_id"], r["time_bin"]): r["user_count"] for r in L.latest(spark, path, ["gtfs_stop_id", "time_bin"]).collect()}
    want = {(r["gtfs_stop_id"], r["time_bin"]): r["user_count"]
            for r in users_per_bin(spark.createDataFrame(rows, SCHEMA), width="10 minutes").collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    assert L.late_rows(spark, path).agg(F.sum("late_rows")).first()[0] == 7


def test_users_per_bin_over_shuffled_batches(spark, tmp_path):
    rows = events(300, seed=5)
    path = L.run_to_table(L.users_per_bin_stream(batches(spark, tmp_path, shuffled(rows, 70, 10)), width="30 minutes", watermark="1 day"),
                          spark, "t-bins")
    got = {(r["gtfs_stop_id"], r["time_bin"]): r["user_count"] for r in L.latest(spark, path, ["gtfs_stop_id", "time_bin"]).collect()}
    want = {(r["gtfs_stop_id"], r["time_bin"]): r["user_count"]
            for r in users_per_bin(spark.createDataFrame(rows, SCHEMA), width="30 minutes").collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


class Handle:
    """State in memory that counts its calls."""

    def __init__(self):
        self.calls, self.value, self.map, self.timers = 0, None, {}, set()

    def getValueState(self, *_):
        return self

    def getMapState(self, *_):
        return self

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def getValue(self, key):
        self.calls += 1
        return (self.map[key],)

    def containsKey(self, key):
        self.calls += 1
        return key in self.map

    def updateValue(self, key, value):
        self.calls += 1
        self.map[key] = value[0]

    def removeKey(self, key):
        self.calls += 1
        del self.map[key]

    def keys(self):
        self.calls += 1
        return list(self.map)

    def getCurrentWatermarkInMs(self):
        return self.watermark


@pytest.mark.parametrize("few", [1 << 16, 0, 500])
def test_history_needs_few_state_calls_a_key(few):
    """A key with events on thirty days, in two batches: a handful of calls; pieces of time only for more than ``few`` bytes."""
    import pandas as pd
    r, day = random.Random(3), 86_400_000
    rows = [(i, pd.Timestamp(T0) + pd.Timedelta(minutes=r.randrange(30 * 1440)), r.choice([0.0, 1.0, None])) for i in range(60)]
    handle, history = Handle(), L.OrderedHistory(day, few)
    history.init(handle)
    frame = pd.DataFrame(rows, columns=["event_id", "event_timestamp", "target"])
    frame["target"] = frame["target"].astype("float64")
    got = []
    early = frame["event_timestamp"] < pd.Timestamp(T0) + pd.Timedelta(days=15)
    for part, upto in ((frame[early], 10), (frame[~early], 400)):
        list(history.handleInputRows((7,), iter([part[:9], part[9:]]), handle))
        handle.watermark = int(pd.Timestamp(T0).timestamp() * 1000) + upto * day
        assert min(handle.timers) <= handle.watermark
        got += list(history.handleExpiredTimer((7,), handle, None))
    got = pd.concat(got)
    want = frame.sort_values(["event_timestamp", "event_id"])
    assert got["event_id"].tolist() == want["event_id"].tolist() and got["hist_count"].tolist() == list(range(60))
    known, y = want["target"].notna(), want["target"].fillna(0.0)
    before = (known.cumsum() - known).clip(lower=1)
    assert got["hist_conversion_rate"].tolist() == ((y.cumsum() - y) / before).tolist()
    assert got["recency_days"].tolist()[0] == 999 and got["recency_days"].tolist()[1:] == want["event_timestamp"].diff().dt.days.tolist()[1:]
    assert not handle.map and handle.value[4:] == (None, b"", False)
    assert few < 1 << 16 or handle.calls <= 12
