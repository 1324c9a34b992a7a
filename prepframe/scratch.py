"""Written intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_base: str | None = None
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session without that setting gets its own."""
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="prepframe-")
    return _local_base


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table once and go on from the files: the lineage is cut and a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession, keep: int = 0) -> int:
    """Delete what this process wrote under the shared folder, but for the first `keep`; results that read it end here."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while len(_written) > keep:
        path = hadoop(_written.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end: write results before it."""
    before = len(_written)
    try:
        yield
    finally:
        release_scratch(spark, before)
