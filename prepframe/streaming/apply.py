"""Fitted operators on streams: parameters are fitted on a stored table and never again inside a micro-batch."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from prepframe.guards import as_list, require


def transform_stream(stream: DataFrame, fitted: Iterable) -> DataFrame:
    """Apply fill, replacement, encoding and scaling parameters to a stream, in turn."""
    if not stream.isStreaming:
        raise ValueError("not a stream: call transform directly")
    for params in fitted:
        stream = params.transform(stream)
    return stream


def drop_duplicates_stream(stream: DataFrame, keys: str | Sequence[str], ts: str, delay: str) -> DataFrame:
    """The first row of each key to arrive within the delay; state older than the watermark is let go."""
    names = require(stream, as_list(keys))
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(names)
