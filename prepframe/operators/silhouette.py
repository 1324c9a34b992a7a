"""The silhouette of a clustering by plain Euclidean distances, exact or estimated from a stratified sample.

Up to EXACT_ROWS rows, every row is compared with every other one: each task takes blocks of rows and adds up their
distances to each cluster, and only one figure a row leaves it. With more rows the same is done on a sample that takes
each cluster in proportion, by a hash of the rows' keys; the standard error of the estimate follows from the spread
inside the clusters and is 0 where all rows are taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepframe.functions.columns import col
from prepframe.guards import require

#: Rows up to which the result is exact; more are sampled down to about as many, MIN_PER_CLUSTER of a cluster at least.
EXACT_ROWS, MIN_PER_CLUSTER = 20_000, 50
#: Numbers of the compared rows that are broadcast at most (64 MB); wider rows are sampled further.
BROADCAST_NUMBERS = 8_000_000
MAX_CLUSTERS = 1_000
#: Numbers of one step of a task: rows, times rows compared with, times dimensions.
STEP = 1 << 22

_SCHEMA = "silhouette double, std_error double, rows long, compared long, clusters int"


def silhouette(df: DataFrame, features: str, cluster: str, key: str | Sequence[str]) -> DataFrame:
    """One row: silhouette, its standard error, rows, rows compared and clusters.

    `features` is a vector or an array of numbers. Rows without features or cluster are left out; a row alone in its
    cluster has silhouette 0. With fewer than two clusters the silhouette is missing.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require(df, [features, cluster, *keys])
    spark = df.sparkSession
    x = vector_to_array(col(features)) if isinstance(df.schema[features].dataType, VectorUDT) else col(features).cast("array<double>")
    rows = df.select(x.alias("x"), col(cluster).alias("cluster"), F.xxhash64(*[col(k) for k in keys]).alias("draw"))
    rows = rows.where(F.col("x").isNotNull() & F.col("cluster").isNotNull())
    sizes = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width"))
    sizes = sizes.limit(MAX_CLUSTERS + 1).collect()
    if len(sizes) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    total = sum(r["n"] for r in sizes)
    if len(sizes) < 2:
        return spark.createDataFrame([(None, None, total, 0, len(sizes))], _SCHEMA)
    sizes.sort(key=lambda r: r["cluster"])
    most = min(EXACT_ROWS, BROADCAST_NUMBERS // max(1, max(r["width"] for r in sizes)))
    share = min(1.0, most / total)
    quota = {r["cluster"]: min(r["n"], max(MIN_PER_CLUSTER, round(r["n"] * share))) for r in sizes}
    sample = rows
    if share < 1:
        table = spark.createDataFrame([(r["cluster"], quota[r["cluster"]]) for r in sizes], f"cluster {rows.schema['cluster'].dataType.simpleString()}, quota long")
        place = F.row_number().over(Window.partitionBy("cluster").orderBy("draw", "x"))
        # a limit that Spark knows lets every task keep its cluster's first rows only
        cut = rows.withColumn("place", place).where(F.col("place") <= max(quota.values()))
        sample = cut.join(F.broadcast(table), "cluster").where("place <= quota")
    places = {r["cluster"]: i for i, r in enumerate(sizes)}
    held = sample.select("x", "cluster").toArrow()
    owner = np.array([places[c] for c in held.column("cluster").to_pylist()], np.int64)
    points = np.array(held.column("x").to_pylist(), np.float64).reshape(len(owner), -1)
    order = np.lexsort([*points.T[::-1], owner])
    owner, points = owner[order], points[order]
    counts = np.bincount(owner, minlength=len(sizes))
    shared = spark.sparkContext.broadcast((points, owner, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, owner, counts = shared.value
        starts = np.concatenate([[0], np.cumsum(counts)])
        for batch in batches:
            at = batch.column(0).to_numpy()
            step = max(1, STEP // max(1, points.size))
            for first in range(0, len(at), step):
                own = at[first : first + step]
                sums = np.zeros((len(own), len(counts)))
                block = max(1, STEP // max(1, len(own) * points.shape[1]))
                for c in range(len(counts)):
                    for a in range(starts[c], starts[c + 1], block):
                        off = points[own][:, None, :] - points[a : min(a + block, starts[c + 1])]
                        sums[:, c] += np.sqrt((off * off).sum(axis=2)).sum(axis=1)
                mine = owner[own]
                inside = sums[np.arange(len(own)), mine] / np.maximum(1, counts[mine] - 1)
                means = sums / counts
                means[np.arange(len(own)), mine] = np.inf
                beside = means.min(axis=1)
                widest = np.maximum(inside, beside)
                s = np.where((counts[mine] > 1) & (widest > 0), (beside - inside) / np.where(widest > 0, widest, 1), 0.0)
                yield pa.RecordBatch.from_arrays([pa.array(mine), pa.array(s)], names=["cluster", "s"])

    tasks = spark.sparkContext.defaultParallelism * 4
    each = spark.range(0, len(owner), 1, tasks).mapInArrow(run, "cluster long, s double")
    found = {r["cluster"]: r for r in each.groupBy("cluster").agg(F.avg("s").alias("mean"), F.var_samp("s").alias("spread")).collect()}
    value, error = 0.0, 0.0
    for i, r in enumerate(sizes):
        n, m = r["n"], int(counts[i])
        value += n / total * found[i]["mean"]
        error += (n / total) ** 2 * (found[i]["spread"] or 0.0) / m * (1 - m / n)
    return spark.createDataFrame([(float(value), float(error) ** 0.5, total, len(owner), len(sizes))], _SCHEMA)
