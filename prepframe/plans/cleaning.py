"""Selecting, filling, de-duplicating and replacing."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepframe.operators import dedup, encode, extract, missing, replace, rowid
from prepframe.plans.registry import GAPS, lineitem_gaps, query, rounded, table

_ID = ["l_orderkey", "l_partkey", "l_linenumber"]
_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus"]
_LINE_ORDER_SQL = ", ".join(_LINE_ORDER)
_LINE_ORDER_DESC_SQL = ", ".join(f"{c} DESC" for c in _LINE_ORDER)
_LINE_COLS = [*_LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_LINE_COLS_SQL = ", ".join(_LINE_COLS)
_ORDER_ROWS = "rows AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)"
_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


# ---- rows and columns ----


@query("row_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders")
def row_id(spark, sf):
    return rowid.with_row_id(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], "row_id")


@query(
    "row_id_ties",
    "SELECT o_orderpriority, o_totalprice, o_orderkey, "
    "row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) - 1 AS row_id FROM orders",
)
def row_id_ties(spark, sf):
    df = table(spark, sf, "orders").select("o_orderpriority", "o_totalprice", "o_orderkey")
    return rowid.with_row_id(df, ["o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey"], "row_id")


_POSITIONS = [42, 7, 7, 0, 1499]


@query(
    "rows_keep",
    f"WITH {_ORDER_ROWS}, wanted(pos) AS (VALUES {', '.join(f'({p})' for p in _POSITIONS)}) "
    f"SELECT {_ORDER_COLS} FROM rows JOIN wanted USING (pos)",
)
def rows_keep(spark, sf):
    return extract.keep_rows(_orders(spark, sf), _POSITIONS, ["o_orderkey"])


@query(
    "rows_remove",
    f"WITH {_ORDER_ROWS} SELECT {_ORDER_COLS} FROM rows WHERE pos NOT IN (42, 7, 0, 1499)",
)
def rows_remove(spark, sf):
    return extract.remove_rows(_orders(spark, sf), _POSITIONS, ["o_orderkey"])


@query(
    "rows_range_ties",
    f"SELECT {_ORDER_COLS} FROM (SELECT *, row_number() OVER (ORDER BY o_orderstatus, o_totalprice, o_orderkey) - 1 AS pos "
    "FROM orders) WHERE pos BETWEEN 200 AND 900",
)
def rows_range_ties(spark, sf):
    """An order over several columns, the first of them with few values."""
    return extract.rows_range(_orders(spark, sf), 200, 900, ["o_orderstatus", "o_totalprice", "o_orderkey"])


@query("rows_range", f"WITH {_ORDER_ROWS} SELECT {_ORDER_COLS} FROM rows WHERE pos BETWEEN 100 AND 1200")
def rows_range(spark, sf):
    return extract.rows_range(_orders(spark, sf), 100, 1200, ["o_orderkey"])


@query("preview", "SELECT * EXCLUDE (o_orderdate) FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def preview(spark, sf):
    df = table(spark, sf, "orders").drop("o_orderdate")
    return extract.preview(df, 10, [F.col("o_totalprice").desc(), "o_orderkey"])


@query("cols_keep", "SELECT o_totalprice, o_orderkey FROM orders")
def cols_keep(spark, sf):
    return extract.keep_columns(table(spark, sf, "orders"), ["o_totalprice", "o_orderkey"])


@query("cols_remove", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def cols_remove(spark, sf):
    return extract.remove_columns(table(spark, sf, "orders"), ["o_orderstatus", "o_orderdate"])


@query(
    "extract_subtable",
    f"WITH {_ORDER_ROWS}, wanted(pos) AS (VALUES {', '.join(f'({p})' for p in _POSITIONS)}) "
    "SELECT o_orderkey, o_totalprice FROM rows JOIN wanted USING (pos)",
)
def extract_subtable(spark, sf):
    return extract.extract_subtable(_orders(spark, sf), _POSITIONS, ["o_orderkey", "o_totalprice"], "keep", ["o_orderkey"])


@query(
    "extract_subtable_remove",
    f"WITH {_ORDER_ROWS} SELECT o_orderkey, o_custkey FROM rows WHERE pos NOT IN (42, 7, 0, 1499)",
)
def extract_subtable_remove(spark, sf):
    return extract.extract_subtable(
        _orders(spark, sf), _POSITIONS, ["o_orderstatus", "o_totalprice"], "remove", ["o_orderkey"]
    )


@query("page", f"WITH {_ORDER_ROWS} SELECT {_ORDER_COLS} FROM rows WHERE pos BETWEEN 600 AND 799")
def page(spark, sf):
    return extract.page(_orders(spark, sf), 3, 200, ["o_orderkey"])[0]


@query(
    "page_place",
    "SELECT pages - 1 AS page, pages, (pages - 1) * 200 + 1 AS first, n AS last, n AS total "
    "FROM (SELECT count(*) AS n, CAST(ceil(count(*) / 200.0) AS BIGINT) AS pages FROM orders)",
)
def page_place(spark, sf):
    """A page number past the end shows the last page."""
    place = extract.page(_orders(spark, sf), 10**9, 200, ["o_orderkey"])[1]
    return spark.createDataFrame([tuple(place.values())], ", ".join(f"{k} long" for k in place))


@query("drop_null_target", f"WITH {GAPS} SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag FROM gaps WHERE l_returnflag IS NOT NULL")
def drop_null_target(spark, sf):
    return extract.drop_null_target(lineitem_gaps(spark, sf), "l_returnflag").select(*_ID, "l_returnflag")


@query(
    "apply_patches",
    """SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 10 = 4 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 10 IN (3, 4) THEN o_custkey + 0.5 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def apply_patches(spark, sf):
    df = _orders(spark, sf)
    last = F.col("o_orderkey") % 10
    price = F.concat(F.col("o_custkey").cast("string"), F.lit(".5"))
    patches = df.where(last.isin(3, 4, 5)).select(
        "o_orderkey",
        F.explode(
            F.array(
                F.struct(F.lit("o_totalprice").alias("column"), F.when(last == 5, "abc").otherwise(price).alias("value")),
                F.struct(
                    F.when(last == 4, "o_orderstatus").otherwise("o_custkey").alias("column"),
                    F.when(last == 4, "X").otherwise("n/a").alias("value"),
                ),
            )
        ).alias("p"),
    )
    return extract.apply_patches(df, patches.select("o_orderkey", "p.*"), "o_orderkey")


# ---- missing data ----


def _filled(df):
    return rounded(df.select(*_ID, "l_quantity", "l_discount", "l_returnflag"))


def _fill_sql(quantity: str, discount: str, flag: str = "l_returnflag", more: str = "") -> str:
    return f"""WITH {GAPS}{more}
      SELECT l_orderkey, l_partkey, l_linenumber, round(CAST({quantity} AS DOUBLE), 6) AS l_quantity,
             round(CAST({discount} AS DOUBLE), 6) AS l_discount, {flag} AS l_returnflag FROM gaps"""


_MODE = "(SELECT {c} FROM gaps WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
_FLAG_MODE = f"coalesce(l_returnflag, {_MODE.format(c='l_returnflag')})"
_QUANTITY_MODE = f"coalesce(l_quantity, {_MODE.format(c='l_quantity')})"
_MEAN = "coalesce({c}, (SELECT avg({c}) FROM gaps))"
_MEDIAN = "coalesce({c}, (SELECT median({c}) FROM gaps))"


@query("fill_mean", _fill_sql(_MEAN.format(c="l_quantity"), _MEAN.format(c="l_discount")))
def fill_mean(spark, sf):
    return _filled(missing.fill(lineitem_gaps(spark, sf), {"l_quantity": "mean", "l_discount": "mean"}))


@query("fill_median", _fill_sql(_MEDIAN.format(c="l_quantity"), _MEDIAN.format(c="l_discount")))
def fill_median(spark, sf):
    return _filled(missing.fill(lineitem_gaps(spark, sf), {"l_quantity": "median", "l_discount": "median"}))


@query(
    "fill_unseen_gaps",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN (SELECT avg(o_custkey) FROM orders) ELSE o_custkey END AS o_custkey FROM orders",
)
def fill_unseen_gaps(spark, sf):
    """Fitted on a table without gaps, applied to one that has them."""
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    gaps = df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")))
    return missing.fit_fill(df, {"o_custkey": "mean"}).transform(gaps)


@query(
    "onehot_after_fill",
    """SELECT o_orderkey, (s = 'F')::TINYINT AS "s_F", (s = 'O')::TINYINT AS "s_O", (s = 'P')::TINYINT AS "s_P", (s = 'none')::TINYINT AS s_none
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'none' ELSE o_orderstatus END AS s FROM orders)""",
)
def onehot_after_fill(spark, sf):
    """The category list of a column goes through a fill, which adds its value."""
    from prepframe.operators.infer import Kind, apply_kinds

    status = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("s")
    df = apply_kinds(table(spark, sf, "orders").select("o_orderkey", status), {"s": Kind("categorical", categories=("F", "O", "P"))})
    return encode.onehot(missing.fill(df, {"s": "constant"}, "none"), "s")


@query("fill_mode", _fill_sql(_QUANTITY_MODE, "l_discount", _FLAG_MODE))
def fill_mode(spark, sf):
    return _filled(missing.fill(lineitem_gaps(spark, sf), {"l_quantity": "mode", "l_returnflag": "mode"}))


@query("fill_constant", _fill_sql("coalesce(l_quantity, -1)", "coalesce(l_discount, -1)"))
def fill_constant(spark, sf):
    return _filled(missing.fill(lineitem_gaps(spark, sf), {"l_quantity": "constant", "l_discount": "constant"}, "-1"))


@query("fill_rules", _fill_sql(_MEDIAN.format(c="l_quantity"), _MEAN.format(c="l_discount"), _FLAG_MODE))
def fill_rules(spark, sf):
    rules = {"l_quantity": "median", "l_discount": "mean", "l_returnflag": "mode"}
    return _filled(missing.fill(lineitem_gaps(spark, sf), rules))


# Whole numbers filled with a mean are double, whether or not a table has gaps in them.
_AS_DOUBLE = "SELECT * REPLACE (l_orderkey::DOUBLE AS l_orderkey, l_partkey::DOUBLE AS l_partkey, l_linenumber::DOUBLE AS l_linenumber) FROM ({})"


@query("fill_table", _AS_DOUBLE.format(_fill_sql(_MEAN.format(c="l_quantity"), _MEAN.format(c="l_discount"))))
def fill_table(spark, sf):
    return _filled(missing.fill_table(lineitem_gaps(spark, sf), "mean"))


@query("fill_table_constant", _fill_sql("l_quantity", "l_discount", "coalesce(l_returnflag, 'none')"))
def fill_table_constant(spark, sf):
    """A text constant fits only the text columns."""
    return _filled(missing.fill_table(lineitem_gaps(spark, sf), "constant", "none"))


_HAVE = "(l_quantity IS NOT NULL)::INT + (l_discount IS NOT NULL)::INT + (l_returnflag IS NOT NULL)::INT"


@query("drop_sparse_rows", f"WITH {GAPS} SELECT l_orderkey, l_partkey, l_linenumber FROM gaps WHERE {_HAVE} >= 2")
def drop_sparse_rows(spark, sf):
    kept = missing.drop_sparse_rows(lineitem_gaps(spark, sf), 2, ["l_quantity", "l_discount", "l_returnflag"])
    return kept.select(*_ID)


@query(
    "drop_sparse_columns",
    f"WITH {GAPS} SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, l_linestatus, l_extendedprice, l_tax FROM gaps",
)
def drop_sparse_columns(spark, sf):
    df = lineitem_gaps(spark, sf)
    return missing.drop_sparse_columns(df, int(df.count() * 0.88))


@query(
    "null_report",
    f"""WITH {GAPS} SELECT 'l_quantity' AS "column", count(*) - count(l_quantity) AS nulls FROM gaps
    UNION ALL SELECT 'l_discount', count(*) - count(l_discount) FROM gaps
    UNION ALL SELECT 'l_returnflag', count(*) - count(l_returnflag) FROM gaps
    UNION ALL SELECT NULL, count(*) FROM gaps WHERE {_HAVE} < 3""",
)
def null_report(spark, sf):
    return missing.null_report(lineitem_gaps(spark, sf), ["l_quantity", "l_discount", "l_returnflag"])


# ---- duplicates ----


def _ranked_sql(order: str) -> str:
    return f"""SELECT {_LINE_COLS_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"""


@query("dedup_first", _ranked_sql(_LINE_ORDER_SQL))
def dedup_first(spark, sf):
    return dedup.drop_duplicates(table(spark, sf, "lineitem"), _LINE_KEY, "first", _LINE_ORDER).select(*_LINE_COLS)


@query("dedup_last", _ranked_sql(_LINE_ORDER_DESC_SQL))
def dedup_last(spark, sf):
    return dedup.drop_duplicates(table(spark, sf, "lineitem"), _LINE_KEY, "last", _LINE_ORDER).select(*_LINE_COLS)


@query(
    "dedup_none",
    f"""SELECT {_LINE_COLS_SQL} FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
    FROM lineitem) WHERE n = 1""",
)
def dedup_none(spark, sf):
    return dedup.drop_duplicates(table(spark, sf, "lineitem"), _LINE_KEY, "none").select(*_LINE_COLS)


@query("dedup_all_columns", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def dedup_all_columns(spark, sf):
    return dedup.drop_duplicates(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity"))


@query("dedup_text", "SELECT min(doc_id) AS doc_id, count(*) * 0 + length(text) AS n_text FROM documents GROUP BY text")
def dedup_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    kept = dedup.drop_duplicates(docs, "text", "first", "doc_id")
    return kept.select("doc_id", F.length("text").cast("long").alias("n_text"))


@query(
    "duplicate_report",
    """SELECT count(*) AS repeated_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS members,
    CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1""",
)
def duplicate_report(spark, sf):
    return dedup.duplicate_report(table(spark, sf, "lineitem"), _LINE_KEY)


# ---- replacement ----


@query(
    "replace_values",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'open' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'top' WHEN '2-HIGH' THEN 'top' ELSE o_orderpriority END AS o_orderpriority
    FROM orders""",
)
def replace_values(spark, sf):
    rules = {"o_orderstatus": {"F": "O", "O": "open"}, "o_orderpriority": {"1-URGENT": "top", "2-HIGH": "top"}}
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return replace.replace_values(df, rules)


@query(
    "replace_null",
    f"""WITH {GAPS} SELECT l_orderkey, l_partkey, l_linenumber, coalesce(l_quantity, 0) AS l_quantity,
    coalesce(l_returnflag, 'none') AS l_returnflag FROM gaps""",
)
def replace_null(spark, sf):
    df = lineitem_gaps(spark, sf).select(*_ID, "l_quantity", "l_returnflag")
    return replace.replace_values(df, {"l_quantity": {"nan": "0"}, "l_returnflag": {None: "none"}})


@query(
    "replace_numeric",
    """SELECT l_orderkey, l_partkey, CAST(CASE l_linenumber WHEN 1 THEN 1.5 WHEN 2 THEN 20 ELSE l_linenumber END AS DOUBLE) AS l_linenumber,
    CASE WHEN l_quantity = 3 THEN 'three' ELSE CAST(l_quantity AS VARCHAR) END AS l_quantity FROM lineitem""",
)
def replace_numeric(spark, sf):
    """A whole-number column is widened to double by 1.5, a double one to text by a word; 'abc' cannot occur."""
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    rules = {"l_linenumber": {"1": "1.5", "2": "20", "abc": "7"}, "l_quantity": {"3": "three"}}
    return replace.replace_values(df, rules)


@query(
    "replace_report",
    f"""WITH {GAPS}, counts AS (SELECT count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n,
      count(*) FILTER (l_returnflag IS NULL) AS missing, count(*) FILTER (l_quantity = 10) AS ten FROM gaps)
    SELECT 0 AS seq, 'l_returnflag' AS "column", 'A' AS old, 'N' AS new, a AS changed FROM counts
    UNION ALL SELECT 1, 'l_returnflag', 'N', 'kept', a + n FROM counts
    UNION ALL SELECT 2, 'l_returnflag', NULL, 'none', missing FROM counts
    UNION ALL SELECT 3, 'l_quantity', '10', '11', ten FROM counts""",
)
def replace_report(spark, sf):
    rules = {"l_returnflag": {"A": "N", "N": "kept", "nan": "none"}, "l_quantity": {"10": "11"}}
    return replace.replace_report(lineitem_gaps(spark, sf), rules)


@query(
    "replace_from_table",
    """SELECT p_partkey, regexp_replace(p_brand, '^Brand#', 'B') AS p_brand, CASE WHEN p_size = 5 THEN 50 ELSE p_size END AS p_size
    FROM part""",
)
def replace_from_table(spark, sf):
    """One rule per brand, read from a table."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    brands = part.select("p_brand").distinct().select(
        F.lit("p_brand").alias("column"),
        F.col("p_brand").alias("old"),
        F.regexp_replace("p_brand", "^Brand#", "B").alias("new"),
        F.lit(1).alias("seq"),
    )
    sizes = part.select(
        F.lit("p_size").alias("column"), F.lit("5").alias("old"), F.lit("50").alias("new"), F.lit(2).alias("seq")
    ).distinct()
    return replace.replace_from_table(part, brands.unionByName(sizes))


@query(
    "replace_many_rules",
    "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'customer ' || c_custkey ELSE c_name END AS c_name FROM customer",
)
def replace_many_rules(spark, sf):
    """A rule for every tenth customer name: too many for one CASE."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    rules = customer.where("c_custkey % 10 = 0").select(
        F.lit("c_name").alias("column"),
        F.col("c_name").alias("old"),
        F.concat(F.lit("customer "), F.col("c_custkey").cast("string")).alias("new"),
        F.col("c_custkey").alias("seq"),
    )
    return replace.replace_from_table(customer, rules)


@query(
    "replace_bigint_many_rules",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN -o_orderkey ELSE o_orderkey + 9007199254740992 END AS big FROM orders""",
)
def replace_bigint_many_rules(spark, sf):
    """A rule for every fiftieth number, all beyond what a double tells apart."""
    big = F.col("o_orderkey") + F.lit(2**53)
    df = table(spark, sf, "orders").select("o_orderkey", big.alias("big"))
    rules = df.where("o_orderkey % 50 = 0").select(
        F.lit("big").alias("column"),
        F.col("big").cast("string").alias("old"),
        (-F.col("o_orderkey")).cast("string").alias("new"),
        F.col("o_orderkey").alias("seq"),
    )
    return replace.replace_from_table(df, rules)


@query(
    "replace_widening_table",
    """SELECT p_partkey, CASE p_size WHEN 5 THEN '20' WHEN 7 THEN 'x' WHEN 9 THEN '2.5' ELSE p_size::VARCHAR END AS p_size FROM part""",
)
def replace_widening_table(spark, sf):
    """Resolved and joined as tables: a text makes the column text, and 1e3 is no number."""
    df = table(spark, sf, "part").select("p_partkey", "p_size")
    rules = [("1e3", "1"), ("5", "20"), ("7", "x"), ("9", "99.0"), ("99", "2.5")]
    rows = [("p_size", old, new, i) for i, (old, new) in enumerate(rules)]
    return replace.replace_from_table(df, spark.createDataFrame(rows, "column string, old string, new string, seq int"), max_rules=0)
