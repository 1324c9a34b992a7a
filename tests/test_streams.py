"""Keep-last and keep-none of a stream, micro-batch by micro-batch."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from prepframe.plans.learning import _STATE_STORE
from prepframe.streaming import keyed
from prepframe.streaming.keyed import keep_duplicates_stream

SCHEMA = "ts timestamp, k string, b int, x double"


def at(hours):
    return datetime(2024, 1, 1) + timedelta(hours=hours)


def run(spark, folder, batches, keep, keys=("k", "b"), delay="2 hours"):
    """The rows of each batch in a file of its own; what is kept after all of them."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    for k, v in _STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        kept = keep_duplicates_stream(stream, list(keys), "ts", delay, keep)
        assert kept.schema.simpleString() == stream.schema.simpleString()
        kept.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
        return sorted(((r["k"], r["b"], r["x"]) for r in spark.read.schema(kept.schema).parquet(f"{folder}/out").collect()), key=str)
    finally:
        for k in _STATE_STORE:
            spark.conf.unset(k)


BATCHES = [
    [(at(0), "a", 1, 1.0), (at(1), "a", 1, 2.0), (at(0), None, None, 3.0), (at(1), "tie", 1, 5.0), (at(1), "tie", 1, 6.0), (None, "lost", 1, 1.0)],
    [(at(2), "a", 1, None), (at(1.5), "a", 1, 4.0), (at(2), None, None, 7.0), (at(2), "once", 1, 8.0), (at(2), "a", 2, 9.0)],
    [(at(90), "late", 1, 0.0)],
]


def test_keep_last(spark, tmp_path):
    want = [("a", 1, None), ("a", 2, 9.0), ("once", 1, 8.0), ("tie", 1, 6.0), (None, None, 7.0)]
    assert run(spark, str(tmp_path), BATCHES, "last") == sorted(want, key=str)  # "late" is still open


def test_keep_none(spark, tmp_path):
    assert run(spark, str(tmp_path), BATCHES, "none") == sorted([("a", 2, 9.0), ("once", 1, 8.0)], key=str)


def test_a_closed_key_starts_anew(spark, tmp_path):
    batches = [[(at(0), "a", 1, 1.0)], [(at(50), "b", 1, 1.0)], [(at(60), "a", 1, 2.0)], [(at(200), "c", 1, 1.0)]]
    assert run(spark, str(tmp_path), batches, "last") == [("a", 1, 1.0), ("a", 1, 2.0), ("b", 1, 1.0)]


def test_arguments(spark, tmp_path):
    rows = spark.createDataFrame([(at(0), "a", 1, 1.0)], SCHEMA)
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    for df, keys, keep in ((rows, "k", "last"), (stream, "k", "first"), (stream, [], "last"), (stream, "nope", "last")):
        with pytest.raises(ValueError):
            keep_duplicates_stream(df, keys, "ts", "1 hour", keep)


class Store:
    """A bucket's state, timers and calls, without Spark."""

    def __init__(self):
        self.state, self.timers, self.updates = None, set(), 0

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.state is not None

    def get(self):
        return self.state

    def update(self, value):
        self.state, self.updates = value, self.updates + 1

    def clear(self):
        self.state = None

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.watermark

    def getExpiryTimeInMs(self):  # noqa: N802
        return min(self.timers)


@pytest.mark.parametrize("keep", ["last", "none"])
def test_many_keys_are_one_call_to_the_store(keep):
    """Against the rule taken key by key, over batches in which keys are closed, go on and start anew."""
    rng, delay = np.random.default_rng(1), 40
    store = Store()
    verdicts = keyed._Verdicts(keep, delay)
    verdicts.init(store)
    held, got, want, newest = {}, [], [], 0

    def close(key):
        rows = held.pop(key)
        want.extend([max(rows)[1]] if keep == "last" or len(rows) == 1 else [])

    for batch in range(12):
        store.watermark, store.updates = max(0, newest - delay), 0
        rows = [(f"k{rng.integers(600)}", int(t), f"{batch}-{i}") for i, t in enumerate(rng.integers(store.watermark + 1, store.watermark + 90, 300))]
        newest = max(newest, *[t for _, t, _ in rows])
        frame = pd.DataFrame([(0, k, None, t * 1000, row) for k, t, row in rows])
        for out in verdicts.handleInputRows((0,), iter([frame[:100], frame[100:]]), store):
            got += out.iloc[:, 0].tolist()
        assert store.updates == 1 and len(store.timers) == 1
        for key in {k for k, _, _ in rows} & {k for k, r in held.items() if max(r)[0] + delay <= store.watermark}:
            close(key)
        for k, t, row in rows:
            held.setdefault(k, []).append((t, row))
        if min(store.timers) < store.watermark:
            fired = min(store.timers)
            for out in verdicts.handleExpiredTimer((0,), store, store):
                got += out.iloc[:, 0].tolist()
            store.timers.discard(fired)
        for key in [k for k, r in held.items() if max(r)[0] + delay < store.watermark]:
            close(key)
        assert sorted(got) == sorted(want)
    assert len(want) > 300
