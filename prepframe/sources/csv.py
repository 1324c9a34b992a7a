"""Reading CSV files of unknown dialect into typed tables, and writing tables as CSV."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.functions.columns import col, na_to_null
from prepframe.guards import require
from prepframe.operators.infer import apply_kinds, infer_kinds, kinds_table
from prepframe.scratch import stored
from prepframe.sources import encodings as single_byte

# Candidate separators; when two occur equally often the earlier one wins.
SEPARATORS = [",", ";", "\t", "|"]
SNIFF_LINES = 5
ROW_ORDER = ["_file", "_block", "_line"]
_CORRUPT = "_corrupt_record"


def _best_separator(totals: list[Column]) -> Column:
    """The separator with the highest total, the earlier one on ties, a comma when none occurs."""
    best = F.greatest(*totals)
    return F.coalesce(*[F.when((t == best) & (best > 0), F.lit(s)) for s, t in zip(SEPARATORS, totals)], F.lit(","))


def _occurrences(line: Column, sep: str) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(sep), F.lit("")))


def dialects(spark: SparkSession, path: str | Sequence[str], fallback_encoding: str | None = None) -> DataFrame:
    """(file, separator, encoding, header) for every file under `path`, in one pass over the raw lines.

    The separator is guessed from a file's first five lines. A file is UTF-8 when all of its lines are valid; else it is
    in the fallback encoding, or in the single-byte one that makes its byte pairs likeliest. The header is the first line as it stands; files without any line are left out.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    scores = single_byte.line_scores(F.col("value")) if fallback_encoding is None else []
    encodings = lines.groupBy("file").agg(
        F.bool_and(F.expr("is_valid_utf8(value)")).alias("utf8"), *[F.sum(s).alias(f"e{i}") for i, s in enumerate(scores)]
    )
    fallback = single_byte.best([F.col(f"e{i}") for i in range(len(scores))]) if scores else F.lit(fallback_encoding)
    place = F.row_number().over(Window.partitionBy("file").orderBy("line"))
    head = lines.where("block = 0").withColumn("place", place).where(F.col("place") <= SNIFF_LINES)
    totals = [F.coalesce(F.sum(_occurrences(F.col("value"), s)), F.lit(0)).alias(f"s{i}") for i, s in enumerate(SEPARATORS)]
    counted = head.groupBy("file").agg(F.min_by("value", "place").alias("header"), *totals)
    separator = _best_separator([F.col(f"s{i}") for i in range(len(SEPARATORS))])
    return encodings.join(counted, "file", "left").select(
        "file",
        F.coalesce(separator, F.lit(",")).alias("separator"),
        F.when(F.col("utf8"), "UTF-8").otherwise(fallback).alias("encoding"),
        "header",
    )


def sniff(spark: SparkSession, path: str, fallback_encoding: str | None = None) -> tuple[str, str]:
    """Separator and encoding of the first file, by all of its lines."""
    first = dialects(spark, path, fallback_encoding).orderBy("file").first()
    if first is None:
        raise ValueError(f"no lines in {path}")
    return first["separator"], first["encoding"]


def read_texts(
    spark: SparkSession,
    path: str | Sequence[str],
    separator: str | None = None,
    encoding: str | None = None,
    multiline: bool = False,
    row_order: bool = False,
) -> DataFrame:
    """All columns as text, each file in its own dialect, files matched by the names in their headers.

    Columns stand in the order of the first file that has them; what a file lacks is missing in its rows. `row_order`
    adds the columns ROW_ORDER.
    """
    said = dialects(spark, path).withColumns({"digest": F.md5(F.col("header").cast("binary"))})
    alike = said.groupBy("separator", "encoding", "digest").agg(F.min("file").alias("first"), F.collect_list("file").alias("files"))
    groups = sorted(alike.collect(), key=lambda r: r["first"])
    if not groups:
        raise ValueError(f"no lines in {path}")
    out = None
    for g in groups:
        files = [unquote(f) for f in sorted(g["files"])]
        own = read_raw(spark, files, separator or g["separator"], encoding or g["encoding"], multiline, row_order)
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def field_counts(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(separator, fields): how many columns the header has under each candidate separator."""
    rows = [
        (s, len(spark.read.options(header=True, sep=s, encoding=encoding, escape='"', inferSchema=False).csv(path).columns))
        for s in SEPARATORS
    ]
    return spark.createDataFrame(rows, "separator string, fields long")


def _clean_header(names: Sequence[str]) -> list[str]:
    return [n.strip().replace("\ufeff", "").strip() for n in names]


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    separator: str,
    encoding: str = "UTF-8",
    multiline: bool = False,
    row_order: bool = False,
) -> DataFrame:
    """All columns as text, files with one header. Lines with too many fields are dropped, short ones padded.

    `row_order` adds the columns ROW_ORDER, by which the lines can be put back in file order.
    """
    options = {"header": True, "sep": separator, "encoding": single_byte.read_as(encoding), "escape": '"', "multiLine": multiline}
    # lines must be judged alike whatever columns a query asks for, so the parser sees all of them
    options["columnPruning"] = False
    path = path if isinstance(path, str) else list(path)
    header = spark.read.options(**options, inferSchema=False, enforceSchema=True).csv(path).columns
    if not header:
        raise ValueError(f"no header in {path}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _CORRUPT]])
    raw = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT).schema(schema).csv(path)
    unquoted = F.regexp_replace(F.col(_CORRUPT), r'"[^"]*"', "")
    fields = _occurrences(unquoted, separator) + 1
    # the test for whole lines names a data column, since Spark refuses scans of the raw line alone
    whole = F.length(F.coalesce(col(header[0]), F.lit(""))) >= 0
    kept = raw.where(F.when(F.col(_CORRUPT).isNull(), whole).otherwise(fields <= len(header)))
    names = _clean_header([single_byte.decoded_name(h, encoding) for h in header])
    columns = [na_to_null(single_byte.decoded(col(old), encoding)).alias(new) for old, new in zip(header, names)]
    if row_order:
        columns += [
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
        ]
    return kept.select(*columns)


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows that have all the required columns; an absent column is an error."""
    return df.dropna(subset=require(df, list(cols)))


def read_csv(
    spark: SparkSession,
    path: str,
    separator: str | None = None,
    encoding: str | None = None,
    date_columns: Sequence[str] = (),
    date_format: str | None = None,
    required: Sequence[str] = (),
    min_share: float = 0.7,
    multiline: bool = False,
) -> DataFrame:
    """Read a CSV file, or a folder of them, into a table with guessed column types.

    The text is read twice: for the dialects, and to be parsed into stored text columns, on which kinds are guessed.
    """
    raw = read_texts(spark, path, separator, encoding, multiline)
    if required:
        raw = require_columns(raw, required)
    raw = stored(raw, "csv")
    present_dates = [c for c in date_columns if c in raw.columns]
    return apply_kinds(raw, infer_kinds(raw, present_dates, date_format, min_share))


def csv_profile(spark: SparkSession, path: str) -> DataFrame:
    """(column, kind, date_format, decimal_mark, parse_loss) of a CSV's columns, before any conversion."""
    raw = stored(read_texts(spark, path), "csv")
    return kinds_table(raw, infer_kinds(raw))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> None:
    """Write with a header and without row numbers. One file only on request: it goes through one task."""
    out = df.drop("_row_id")
    (out.coalesce(1) if single_file else out).write.option("header", True).option("escape", '"').mode(mode).csv(path)
