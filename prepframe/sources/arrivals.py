"""Column kinds of a folder whose files arrive over time: each file is read once, its detector counts are kept.

The store is a Parquet folder of state rows: for each file the number of its rows (column is null), and for each of its
columns the counts that `infer.detect` gives, with the distinct values where these may still be a category's. Counts of
files add up, so kinds follow from the states alone, the same as from one pass over all files. A file that was replaced
(another size or time) is read again; states of files that are gone count no more.

An arrival's states are written by one job: a run that fails leaves the store as it was, and files that two runs have
read at once count once.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.operators import infer
from prepframe.operators.infer import MAX_CATEGORY_SHARE, MAX_CATEGORY_VALUES, MIN_SHARE, Kind
from prepframe.scratch import stored
from prepframe.sources.csv import ROW_ORDER, read_texts

_VERSION = ["file", "modified", "size"]


def listing(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, modified, size) of the files under `path`; their content is not read."""
    meta = F.col("_metadata")
    return spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path)).select(
        meta["file_path"].alias("file"), meta["file_modification_time"].alias("modified"), meta["file_size"].alias("size")
    )


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop))


def file_states(raw: DataFrame) -> DataFrame:
    """(file, column, counts …, values) of text columns read with their files (`_file`).

    `values` are a column's distinct values in the file, null where they are MAX_CATEGORY_VALUES or more.
    """
    names = [c for c in raw.columns if c not in ROW_ORDER]
    kept = raw.select(F.col("_file").alias("_file"), *[F.col("`" + c.replace("`", "``") + "`") for c in names])
    counts = stored(infer.detect(kept, names, ["_file"]), "counts")
    # Sketches leave out the columns of many values, whose values would all be shuffled. The pairs left are a table
    # read from files, so Spark knows its size when it chooses the join.
    some = counts.where(F.col("distinct_about") < 2 * MAX_CATEGORY_VALUES).select("_file", "column")
    may = [r["column"] for r in some.select("column").distinct().collect()]  # names of columns
    state = counts.drop("distinct_about")
    if not may:
        return state.withColumn("values", F.lit(None).cast("array<string>")).withColumnRenamed("_file", "file")
    found = infer.few_values(kept, may, ["_file"]).groupBy("_file", "column").agg(F.sort_array(F.collect_list("value")).alias("values"))
    listed = some.join(found, ["_file", "column"], "left").select("_file", "column", F.coalesce("values", F.array().cast("array<string>")).alias("values"))
    few = F.when(F.size("values") < MAX_CATEGORY_VALUES, F.col("values")).alias("values")
    return state.join(listed.select("_file", "column", few), ["_file", "column"], "left").withColumnRenamed("_file", "file")


def arrive(spark: SparkSession, path: str, store: str, multiline: bool = False) -> list[str]:
    """Read the files under `path` that the store doesn't know yet and add their states; gives the names of these files."""
    there = listing(spark, path)
    if _exists(spark, store):
        there = there.join(spark.read.parquet(store).select(*_VERSION), _VERSION, "left_anti")
    new = stored(there, "arrived")
    files = sorted(unquote(r["file"]) for r in new.select("file").collect())  # one name for each new file, as a listing holds
    if not files:
        return []
    if new.where("size > 0").limit(1).count():
        raw = stored(read_texts(spark, files, multiline=multiline, row_order=True), "arrival")
        rows = raw.groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
        states = file_states(raw)
        whole = new.join(rows, "file", "left").select(*_VERSION, F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
        out = new.join(states, "file").unionByName(whole, allowMissingColumns=True)
    else:
        nothing = spark.createDataFrame([], T.StructType([T.StructField("_file", T.StringType()), T.StructField("x", T.StringType())]))
        out = new.join(file_states(nothing), "file", "left").withColumn("n_rows", F.lit(0).cast("long"))
    out.write.mode("append").parquet(store)
    return files


def states(spark: SparkSession, path: str, store: str) -> DataFrame:
    """The states of the files that are under `path` now, each once."""
    kept = spark.read.parquet(store).join(listing(spark, path), _VERSION, "left_semi")
    return kept.dropDuplicates([*_VERSION, "column"])


def merge_states(found: DataFrame) -> DataFrame:
    """(column, n_rows, counts …, values): the states of files as one row for each column, as one pass would count.

    Rows of files without the column count in n_rows. `values` is null where they are too many for a category.
    """
    total = found.where("column IS NULL").agg(F.sum("n_rows")).first()[0] or 0
    own = found.where("column IS NOT NULL")
    counts = [c for c in own.columns if c not in (*_VERSION, "column", "n_rows", "values")]
    merged = own.groupBy("column").agg(*[F.sum(c).alias(c) for c in counts], F.bool_and(F.col("values").isNotNull()).alias("_few"))
    distinct = own.select("column", F.explode("values").alias("value")).distinct()
    values = infer.first_values(distinct).groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("values"))
    known = F.coalesce("values", F.array().cast("array<string>"))
    few = F.when(F.col("_few") & (F.size(known) < MAX_CATEGORY_VALUES), known)
    return merged.join(values, "column", "left").select("column", F.lit(total).cast("long").alias("n_rows"), *counts, few.alias("values"))


def kinds_of(merged: DataFrame, date_columns: Sequence[str] = (), date_format: str | None = None, min_share: float = MIN_SHARE) -> dict[str, Kind]:
    """The kind of every column, as `infer.infer_kinds` gives it."""
    kinds = {}
    for r in infer.decisions(merged, min_share).orderBy("column").collect():
        kind = infer.kind_of(r, r["column"] in date_columns, date_format)
        if kind.kind == "text" and r["values"] is not None and len(r["values"]) < MAX_CATEGORY_SHARE * r["n_rows"]:
            kind = Kind("categorical", categories=tuple(sorted(r["values"])))
        kinds[r["column"]] = kind
    return kinds


def folder_kinds(spark: SparkSession, path: str, store: str, **options) -> dict[str, Kind]:
    """Take in what has arrived and give the kinds of all columns of the files now there."""
    arrive(spark, path, store)
    return kinds_of(merge_states(states(spark, path, store)), **options)
