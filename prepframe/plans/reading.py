"""CSV reading and type inference. The files are written from the given tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepframe.functions.columns import DATE_FORMATS, na_to_null, parse_date, parse_number
from prepframe.operators import infer
from prepframe.plans.registry import GAPS, lineitem_gaps, query, table
from prepframe.scratch import scratch_path
from prepframe.sources import arrivals, csv, encodings

# ---- files ----


def _messy_orders(spark, sf):
    """orders as a person might have typed them: comma decimals, day-first dates, codes mixed with numbers."""
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf, "orders").select(
        key.alias("id"),
        F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(",")).alias("price"),
        F.date_format("o_orderdate", "dd.MM.yyyy").alias("day"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("C"), key)).otherwise(key).alias("code"),
        F.col("o_orderstatus").alias("status"),
    )


_MESSY = """messy AS (SELECT o_orderkey::VARCHAR AS id, replace(o_totalprice::VARCHAR, '.', ',') AS price,
  strftime(o_orderdate, '%d.%m.%Y') AS day,
  CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE '' END || o_orderkey::VARCHAR AS code, o_orderstatus AS status FROM orders)"""
_MESSY_COLS = ["id", "price", "day", "code", "status"]


def _written(df, label: str, **options) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.options(**{"header": True, "escape": '"', **options}).csv(path)
    return path


@query(
    "csv_typed_read",
    """SELECT o_orderkey AS id, o_totalprice AS price, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS day,
    CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE '' END || o_orderkey::VARCHAR AS code, o_orderstatus AS status FROM orders""",
)
def csv_typed_read(spark, sf):
    """Separator, number, date and text columns are all found from the files."""
    df = csv.read_csv(spark, _written(_messy_orders(spark, sf), "messy", sep=";"), required=["id"])
    return df.withColumn("day", F.date_format("day", "yyyy-MM-dd HH:mm:ss"))


@query("csv_round_trip", "SELECT * REPLACE (c_nationkey::BIGINT AS c_nationkey) FROM customer")
def csv_round_trip(spark, sf):
    """Whole numbers come back as bigint, which is all that text can say."""
    path = scratch_path(spark, "customer")
    csv.write_csv(table(spark, sf, "customer"), path)
    return csv.read_csv(spark, path)


@query(
    "csv_late_encoding",
    """SELECT c_custkey, CASE WHEN c_custkey = (SELECT max(c_custkey) FROM customer) THEN c_name || ' é' ELSE c_name END AS c_name,
    c_acctbal FROM customer""",
)
def csv_late_encoding(spark, sf):
    """One byte that is not UTF-8, in the last line."""
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    last = df.agg(F.max("c_custkey")).first()[0]
    df = df.withColumn("c_name", F.when(F.col("c_custkey") == last, F.concat("c_name", F.lit(" é"))).otherwise(F.col("c_name")))
    return csv.read_csv(spark, _written(df.orderBy("c_custkey").coalesce(1), "late", encoding="ISO-8859-1"))


# Words that the encodings write with different bytes.
_WORDS = {"UTF-8": "źródło naïve", "windows-1250": "zażółć gęślą jaźń", "ISO-8859-2": "ženíšek příští łąka", "ISO-8859-1": "où être garçon señor"}
_WORD_OF = "CASE c_custkey % 4 " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(_WORDS.values())) + " END"


@query("csv_encodings", f"SELECT c_custkey, c_name || ' ' || {_WORD_OF} AS c_name, c_acctbal FROM customer")
def csv_encodings(spark, sf):
    """Files of four encodings in one folder; each is told by its bytes."""
    df = table(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit(" "), F.expr(_WORD_OF)).alias("c_name"), "c_acctbal")
    path = _written(df.where("c_custkey % 4 = 0"), "encodings")
    for i, encoding in enumerate(_WORDS):
        if i:
            own = df.where(F.col("c_custkey") % 4 == i).withColumn("c_name", encodings.encoded(F.col("c_name"), encoding)).coalesce(1)
            own.write.mode("append").options(header=True, escape='"', encoding="ISO-8859-1").csv(path)
    return csv.read_csv(spark, path)


@query("csv_folder_order", "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS s_acctbal FROM supplier")
def csv_folder_order(spark, sf):
    """Files of one folder with their columns in another order, separated otherwise, and one column short."""
    df = table(spark, sf, "supplier")
    path = _written(df.where("s_suppkey % 2 = 0").select("s_suppkey", "s_name", "s_acctbal"), "folder")
    df.where("s_suppkey % 2 = 1").select("s_name", "s_suppkey").write.mode("append").options(header=True, escape='"', sep=";").csv(path)
    return csv.read_csv(spark, path).select("s_suppkey", "s_name", "s_acctbal")


@query(
    "csv_multiline_text",
    "SELECT doc_id, strlen(text) AS n_bytes, length(text) AS n_text, md5(text) AS digest FROM documents WHERE text IS NOT NULL",
)
def csv_multiline_text(spark, sf):
    """Texts with line breaks, quotes and separators come back whole."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    raw = csv.read_raw(spark, _written(docs, "documents", quoteAll=True, lineSep="\n"), ",", multiline=True)
    return raw.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.length("text").cast("long").alias("n_text"),
        F.md5(F.col("text").cast("binary")).alias("digest"),
    )


_SEPARATED = {"orders": ";", "events": "\t", "part": "|", "supplier": ","}


@query(
    "csv_sniff_separator",
    "SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{s}')" for t, s in _SEPARATED.items()) + ") AS v(tab, separator)",
)
def csv_sniff_separator(spark, sf):
    """Four tables written with four separators; every file of a table must agree."""
    out = None
    for name, sep in _SEPARATED.items():
        df = table(spark, sf, name)
        path = _written(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]), name, sep=sep)
        found = csv.dialects(spark, path).groupBy("separator").agg(F.lit(name).alias("tab")).select("tab", "separator")
        out = found if out is None else out.unionByName(found)
    return out


@query("csv_sniff_encoding", "SELECT * FROM (VALUES ('ISO-8859-1', 'ISO-8859-1'), ('UTF-8', 'UTF-8')) AS v(written, found)")
def csv_sniff_encoding(spark, sf):
    """The documents with an accented letter in the last line alone, written in two encodings."""
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    last = docs.agg(F.max("doc_id")).first()[0]
    docs = docs.select("doc_id", F.when(F.col("doc_id") == last, F.concat(F.lit("é "), "lang")).otherwise(F.col("lang")).alias("text"))
    docs = docs.orderBy("doc_id").coalesce(1)
    out = None
    for encoding in ("UTF-8", "ISO-8859-1"):
        found = csv.dialects(spark, _written(docs, "encoded", encoding=encoding))
        found = found.select(F.lit(encoding).alias("written"), F.col("encoding").alias("found")).distinct()
        out = found if out is None else out.unionByName(found)
    return out


@query(
    "csv_bad_lines",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 <> 1 THEN o_orderstatus END AS o_orderstatus
    FROM orders WHERE o_orderkey % 10 <> 0""",
)
def csv_bad_lines(spark, sf):
    """Every tenth line has a field too many and is dropped; another tenth lacks its last field and is kept."""
    last = F.col("o_orderkey") % 10
    line = F.concat_ws(
        ";",
        "o_orderkey",
        "o_custkey",
        F.when(last != 1, F.col("o_orderstatus")),
        F.when(last == 0, F.lit("one too many")),
    )
    lines = table(spark, sf, "orders").select(line.alias("o_orderkey;o_custkey;o_orderstatus"))
    raw = csv.read_raw(spark, _written(lines, "bad", quote="\0"), ";")
    return raw.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), "o_orderstatus")


@query(
    "csv_profile",
    """SELECT * FROM (VALUES ('id', 'numeric', NULL, '.', 0::BIGINT), ('price', 'numeric', NULL, ',', 0::BIGINT),
    ('day', 'date', 'd.M.yyyy', NULL, 0::BIGINT), ('code', 'text', NULL, NULL, 0::BIGINT), ('status', 'categorical', NULL, NULL, 0::BIGINT))
    AS v("column", kind, date_format, decimal_mark, parse_loss)""",
)
def csv_profile(spark, sf):
    return csv.csv_profile(spark, _written(_messy_orders(spark, sf), "messy", sep=";"))


@query("csv_field_counts", "SELECT * FROM (VALUES (',', 1::BIGINT), (';', 5::BIGINT), ('\t', 1::BIGINT), ('|', 1::BIGINT)) AS v(separator, fields)")
def csv_field_counts(spark, sf):
    return csv.field_counts(spark, _written(_messy_orders(spark, sf), "messy", sep=";"))


@query(
    "csv_row_order",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders",
)
def csv_row_order(spark, sf):
    """Lines numbered in file order: the files are written in key order, so places follow the keys."""
    from prepframe.operators.rowid import with_row_id

    df = table(spark, sf, "orders").select("o_orderkey").orderBy("o_orderkey")
    raw = csv.read_raw(spark, _written(df, "ordered"), ",", row_order=True)
    numbered = with_row_id(raw, csv.ROW_ORDER, "place")
    return numbered.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "place")


@query(
    "require_columns",
    f"WITH {GAPS} SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM gaps WHERE l_quantity IS NOT NULL AND l_returnflag IS NOT NULL",
)
def require_columns(spark, sf):
    kept = csv.require_columns(lineitem_gaps(spark, sf), ["l_quantity", "l_returnflag"])
    return kept.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")


@query("na_tokens_to_null", "SELECT event_id, CASE WHEN event_id % 7 > 4 THEN event_type END AS event_type FROM events")
def na_tokens_to_null(spark, sf):
    kind = F.col("event_id") % 7
    text = F.when(kind == 0, "NA").when(kind == 1, "null").when(kind == 2, "N/A").when(kind == 3, "").when(kind == 4, "nan")
    df = table(spark, sf, "events").select("event_id", text.otherwise(F.col("event_type")).alias("event_type"))
    return df.select("event_id", na_to_null(F.col("event_type")).alias("event_type"))


# ---- detectors ----

_PLAIN = r"'^-?\d+(\.\d+)?$'"
_PYTHON_STYLE = {"yyyy": "%Y", "M": "%m", "d": "%d", "H": "%H", "m": "%M", "s": "%S"}


def _strptime(fmt: str) -> str:
    """A Spark date pattern in strptime notation."""
    out, i = "", 0
    while i < len(fmt):
        letter = next((p for p in ("yyyy", "M", "d", "H", "m", "s") if fmt.startswith(p, i)), None)
        out += _PYTHON_STYLE[letter] if letter else fmt[i]
        i += len(letter) if letter else 1
    return out


def _per_column(expressions: str) -> str:
    return f"WITH {_MESSY} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {expressions.format(c=c)} FROM messy" for c in _MESSY_COLS
    )


def _decided(spark, sf):
    return infer.decisions(infer.detect(_messy_orders(spark, sf)))


@query(
    "detect_numeric",
    _per_column(
        f"count({{c}}) AS n, count(*) FILTER (regexp_matches(replace({{c}}, ',', '.'), {_PLAIN})) AS plain, "
        f"avg(regexp_matches(replace({{c}}, ',', '.'), {_PLAIN})::INT) > 0.7 AS is_numeric"
    ),
)
def detect_numeric(spark, sf):
    return _decided(spark, sf).select("column", "n", "plain", "is_numeric")


@query(
    "detect_decimal_mark",
    _per_column(
        r"count(*) FILTER (regexp_matches({c}, '\d+\.\d+')) AS dots, count(*) FILTER (regexp_matches({c}, '\d+,\d+')) AS commas, "
        r"CASE WHEN count(*) FILTER (regexp_matches({c}, '\d+\.\d+')) >= count(*) FILTER (regexp_matches({c}, '\d+,\d+')) "
        r"THEN '.' ELSE ',' END AS decimal_mark"
    ),
)
def detect_decimal_mark(spark, sf):
    return _decided(spark, sf).select("column", "dots", "commas", "decimal_mark")


_HITS = {f: f"count(try_strptime({{c}}, '{_strptime(f)}'))" for f in DATE_FORMATS}
_BEST = "greatest(" + ", ".join(_HITS.values()) + ")"
_BEST_FORMAT = "CASE " + " ".join(f"WHEN {h} = {_BEST} AND {_BEST} > 0 THEN '{f}'" for f, h in _HITS.items()) + " END"


@query("detect_date_format", _per_column(f"{_BEST_FORMAT} AS date_format, {_BEST} AS date_hits"))
def detect_date_format(spark, sf):
    return _decided(spark, sf).select("column", "date_format", "date_hits")


@query("detect_date", _per_column(f"count({{c}}) >= 3 AND {_BEST} / count({{c}}) > 0.7 AS is_date"))
def detect_date(spark, sf):
    return _decided(spark, sf).select("column", "is_date")


@query(
    "detect_categorical",
    _per_column(
        "count(*) AS n_rows, count(DISTINCT {c}) AS distinct_values, "
        "count(DISTINCT {c}) / count(*) < 0.5 AND count(DISTINCT {c}) < 100 AS is_categorical"
    ),
)
def detect_categorical(spark, sf):
    return infer.detect_categorical(_messy_orders(spark, sf), _MESSY_COLS)


@query(
    "parse_number",
    f"WITH {_MESSY} SELECT id, try_cast(replace(price, ',', '.') AS DOUBLE) AS price, try_cast(code AS DOUBLE) AS code FROM messy",
)
def parse_numbers(spark, sf):
    df = _messy_orders(spark, sf)
    padded = F.concat(F.lit(" \t"), F.col("price"), F.lit("\n"))
    return df.select("id", parse_number(padded, ",").alias("price"), parse_number(F.col("code")).alias("code"))


@query(
    "parse_date",
    f"""WITH {_MESSY} SELECT id, strftime(try_strptime(day, '%d.%m.%Y'), '%Y-%m-%d') AS day_first,
    strftime(try_strptime(day, '%m.%d.%Y'), '%Y-%m-%d') AS month_first FROM messy""",
)
def parse_dates(spark, sf):
    """The wrong format gives missing values, not errors."""
    day = F.col("day")
    return _messy_orders(spark, sf).select(
        "id",
        F.date_format(parse_date(day, "d.M.yyyy"), "yyyy-MM-dd").alias("day_first"),
        F.date_format(parse_date(day, "M.d.yyyy"), "yyyy-MM-dd").alias("month_first"),
    )


@query(
    "infer_schema",
    """SELECT * FROM (VALUES ('id', 'numeric', NULL, '.', 0::BIGINT), ('price', 'numeric', NULL, ',', 0::BIGINT),
    ('day', 'date', 'd.M.yyyy', NULL, 0::BIGINT), ('code', 'text', NULL, NULL, 0::BIGINT), ('status', 'categorical', NULL, NULL, 0::BIGINT))
    AS v("column", kind, date_format, decimal_mark, parse_loss)""",
)
def infer_schema(spark, sf):
    df = _messy_orders(spark, sf)
    return infer.kinds_table(df, infer.infer_kinds(df))


@query(
    "infer_and_apply",
    """SELECT o_orderkey AS id, o_totalprice AS price, strftime(o_orderdate, '%Y-%m-%d') AS day,
    CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE '' END || o_orderkey::VARCHAR AS code, o_orderstatus AS status FROM orders""",
)
def infer_and_apply(spark, sf):
    df = _messy_orders(spark, sf)
    typed = infer.apply_kinds(df, infer.infer_kinds(df, date_columns=["day"]))
    return typed.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "infer_arrivals",
    _per_column(
        f"count(*) AS n_rows, count({{c}}) AS n, count(*) FILTER (regexp_matches(replace({{c}}, ',', '.'), {_PLAIN})) AS plain, "
        f"{_BEST_FORMAT} AS date_format, {_BEST} AS date_hits, "
        "CASE WHEN count(DISTINCT {c}) < 100 THEN array_to_string(list_sort(list(DISTINCT {c})), ',') END AS few_values"
    ),
)
def infer_arrivals(spark, sf):
    """Two arrivals of files; the second reads its own files only, and the merged counts are those of one pass."""
    df, store = _messy_orders(spark, sf), scratch_path(spark, "states")
    early = F.col("id").cast("long") % 3 == 0
    path = _written(df.where(early), "arrivals", sep=";")
    arrivals.arrive(spark, path, store)
    df.where(~early).write.mode("append").options(header=True, escape='"', sep=";").csv(path)
    arrivals.arrive(spark, path, store)
    found = infer.decisions(arrivals.merge_states(arrivals.states(spark, path, store)))
    return found.select("column", "n_rows", "n", "plain", "date_format", "date_hits", F.array_join("values", ",").alias("few_values"))


@query(
    "narrow_integers",
    "SELECT n_nationkey::TINYINT AS n_nationkey, n_name, n_regionkey::TINYINT AS n_regionkey FROM nation",
)
def narrow_integers(spark, sf):
    return infer.narrow_integers(table(spark, sf, "nation"))


@query(
    "narrow_orders",
    """SELECT o_orderkey, o_totalprice, CASE WHEN top < 128 THEN 'tinyint' WHEN top < 32768 THEN 'smallint' WHEN top < 2147483648 THEN 'int' ELSE 'bigint' END AS kind
    FROM orders, (SELECT max(o_orderkey) AS top FROM orders)""",
)
def narrow_orders(spark, sf):
    """The type that the key range allows at this size is told beside the values."""
    narrowed = infer.narrow_integers(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"))
    kind = narrowed.schema["o_orderkey"].dataType.simpleString()
    return narrowed.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_totalprice", F.lit(kind).alias("kind"))
