"""Keep-last and keep-none duplicates of a stream, by keyed state with timers.

A key's rows are gathered from its first one on until the watermark has passed the newest of them by the delay; then the
key's verdict is given and its state let go. Of a key the state holds one row and a count, however many rows arrive.
Spark stores the state with the stream's checkpoint, so a lost executor changes nothing.

Keys are dealt to buckets by their digest, and a bucket's keys are held as one table: a batch reads, merges and writes
each bucket it touches once, instead of calling the state store for every key. A bucket has one timer, that of its key
which is due first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from prepframe.functions.columns import col
from prepframe.guards import as_list, require

#: Tables the open keys are held in. A stream keeps its number, as its checkpoint does; a table holds its share of the open keys.
BUCKETS = 1_024

_COLUMNS = _BUCKET, _KEY, _AT, _MICROS, _ROW = "_bucket", "_key", "_at", "_micros", "_row"
_STATE = T.StructType([T.StructField("keys", T.BinaryType())])
#: An open key: its last row and that row's time, how many it had, and the time (ms) at which it is due.
_OPEN = pa.schema([("key", pa.large_string()), ("micros", pa.int64()), ("row", pa.large_string()), ("n", pa.int64()), ("until", pa.int64())])


def _one_each(keys: pa.Table) -> pa.Table:
    """Entries of the same key as one: the last row, all counts, the latest end."""
    if not keys.num_rows:
        return keys
    keys = keys.take(pc.sort_indices(keys, [(c, "ascending") for c in ("key", "micros", "row")])).combine_chunks()
    other = pc.not_equal(keys["key"].slice(1), keys["key"].slice(0, keys.num_rows - 1)).to_numpy()
    starts = np.concatenate([[0], np.flatnonzero(other) + 1])
    last = keys.take(pa.array(np.append(starts[1:], keys.num_rows) - 1))
    n = np.add.reduceat(keys["n"].to_numpy(), starts)
    until = np.maximum.reduceat(keys["until"].to_numpy(), starts)
    return pa.table([last["key"], last["micros"], last["row"], pa.array(n), pa.array(until)], schema=_OPEN)


class _Verdicts(StatefulProcessor):
    """The last row of each of a bucket's keys, or its only one, once no more can come."""

    def __init__(self, keep: str, delay_ms: int) -> None:
        self.keep, self.delay_ms = keep, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = _OPEN.empty_table()
        for part in rows:
            fresh = _one_each(pa.concat_tables([fresh, self._arrived(part.set_axis(_COLUMNS, axis=1))]))  # they come by position
        held = self._read()
        # due, but rows come before timers
        due = pc.and_(pc.less_equal(held["until"], timerValues.getCurrentWatermarkInMs()), pc.is_in(held["key"], fresh["key"]))
        yield from self._told(held.filter(due))
        self._write(_one_each(pa.concat_tables([held.filter(pc.invert(due)), fresh])), self._first(held))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, fired = self._read(), expiredTimerInfo.getExpiryTimeInMs()
        due = pc.less_equal(held["until"], max(fired, timerValues.getCurrentWatermarkInMs() - 1))
        yield from self._told(held.filter(due))
        self._write(held.filter(pc.invert(due)), fired, spent=True)

    def _arrived(self, part: pd.DataFrame) -> pa.Table:
        micros = part[_MICROS].to_numpy(np.int64)
        until = np.floor_divide(micros, 1000) + self.delay_ms
        return pa.table([pa.array(part[_KEY], pa.large_string()), micros, pa.array(part[_ROW], pa.large_string()), np.ones(len(part), np.int64), until], schema=_OPEN)

    def _read(self) -> pa.Table:
        held = self.held.get()
        return pa.ipc.open_stream(held[0]).read_all() if held else _OPEN.empty_table()

    def _first(self, keys: pa.Table) -> int | None:
        return pc.min(keys["until"]).as_py()

    def _write(self, keys: pa.Table, timer: int | None, spent: bool = False) -> None:
        """Hold these keys; `timer` is the one that was set before, which Spark lets go itself when it is spent."""
        first = self._first(keys)
        if timer is not None and timer != first and not spent:
            self.handle.deleteTimer(timer)
        if first is None:
            self.held.clear()
            return
        if timer != first:
            self.handle.registerTimer(first)
        if self.keep == "none":  # the row of a key that has several is never asked for
            keys = keys.set_column(2, "row", pc.if_else(pc.greater(keys["n"], 1), pa.scalar(None, pa.large_string()), keys["row"]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _OPEN, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(keys)
        self.held.update((sink.getvalue().to_pybytes(),))

    def _told(self, keys: pa.Table) -> Iterator[pd.DataFrame]:
        rows = keys["row"] if self.keep == "last" else keys.filter(pc.equal(keys["n"], 1))["row"]
        if len(rows):
            yield pd.DataFrame({_ROW: rows.to_pandas()})

    def close(self) -> None:
        pass


def keep_duplicates_stream(stream: DataFrame, keys: str | Sequence[str], ts: str, delay: str, keep: str = "last") -> DataFrame:
    """The last row of each key by `ts`, or (`none`) the rows whose key occurs once; nulls equal each other in a key.

    A key is closed when the watermark (`delay` behind the newest row) has passed its newest row by `delay` again: rows
    of a key that come later than that start anew. Of rows with equal `ts` the one with the greatest JSON text stays. Rows
    without `ts` are left out, as no watermark can ever close them.
    """
    if not stream.isStreaming:
        raise ValueError("not a stream: use dedup.drop_duplicates")
    if keep not in ("last", "none"):
        raise ValueError("keep must be last or none; the first is drop_duplicates_stream")
    names = require(stream, as_list(keys))
    if not names:
        raise ValueError("name the columns of the key")
    require(stream, [ts])
    schema, kept = stream.schema, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
    key, row = F.to_json(F.struct(*[col(k) for k in names]), kept), F.to_json(F.struct(*[col(c) for c in stream.columns]), kept)
    at = col(ts).cast("timestamp")
    wanted = stream.where(col(ts).isNotNull()).select(key.alias(_KEY), at.alias(_AT), F.unix_micros(at).alias(_MICROS), row.alias(_ROW))
    bucket = F.pmod(F.xxhash64(_KEY), F.lit(BUCKETS)).cast("int")
    span = stream.sparkSession.range(1).select(F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL '{delay}'"))).first()[0]
    found = wanted.select(bucket.alias(_BUCKET), "*").withWatermark(_AT, delay).groupBy(_BUCKET).transformWithStateInPandas(
        statefulProcessor=_Verdicts(keep, int(span)),
        outputStructType=T.StructType([T.StructField(_ROW, T.StringType())]),
        outputMode="Append",
        timeMode="EventTime",
    )
    return found.select(F.from_json(_ROW, schema, kept).alias("_")).select("_.*")
