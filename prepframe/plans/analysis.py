"""Encoding, scaling, profiles, correlations and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepframe.functions.columns import short_label
from prepframe.operators import chartdata, corr, encode, profile, scale, sketches
from prepframe.plans.registry import GAPS, every, lineitem_gaps, query, rounded, table

_ID = ["l_orderkey", "l_partkey", "l_linenumber"]
_ID_SQL = ", ".join(_ID)

# ---- encoding ----

_FLAGS = ["A", "N", "R"]


def _dummy_sql(column: str, values: list[str]) -> str:
    return ", ".join(
        f"CAST(CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS TINYINT) AS \"{column}_{v}\"" for v in values
    )


@query("onehot", f"WITH {GAPS} SELECT {_ID_SQL}, {_dummy_sql('l_returnflag', _FLAGS)} FROM gaps")
def onehot(spark, sf):
    return encode.onehot(lineitem_gaps(spark, sf).select(*_ID, "l_returnflag"), "l_returnflag")


@query(
    "onehot_drop_first",
    f"WITH {GAPS} SELECT {_ID_SQL}, {_dummy_sql('l_returnflag', _FLAGS[1:])}, {_dummy_sql('l_linestatus', ['O'])} FROM gaps",
)
def onehot_drop_first(spark, sf):
    df = lineitem_gaps(spark, sf).select(*_ID, "l_returnflag", "l_linestatus")
    return encode.onehot(df, ["l_returnflag", "l_linestatus"], drop_first=True)


@query(
    "onehot_mapping",
    """SELECT 'o_orderpriority' AS "column", v AS value, row_number() OVER (ORDER BY v) - 1 AS code
    FROM (SELECT DISTINCT o_orderpriority AS v FROM orders)
    UNION ALL SELECT 'o_orderstatus', v, row_number() OVER (ORDER BY v) - 1
    FROM (SELECT DISTINCT o_orderstatus AS v FROM orders)""",
)
def onehot_mapping(spark, sf):
    return encode.fit_onehot(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"]).mapping(spark)


def _first_seen_sql(column: str, tab: str, order: str) -> str:
    return f"""SELECT v, row_number() OVER (ORDER BY first) - 1 AS code FROM
      (SELECT trim({column}) AS v, min({order}) AS first FROM {tab} WHERE {column} IS NOT NULL GROUP BY trim({column}))"""


def _bits(width: int, column: str) -> str:
    return ", ".join(f"CAST((code >> {width - 1 - i}) & 1 AS TINYINT) AS {column}_bin_{i}" for i in range(width))


@query(
    "binary_encode",
    f"""WITH codes AS ({_first_seen_sql('p_brand', 'part', 'p_partkey')})
    SELECT p_partkey, p_size, {_bits(5, 'p_brand')} FROM part JOIN codes ON trim(p_brand) = v""",
)
def binary_encode(spark, sf):
    return encode.binary_encode(table(spark, sf, "part").select("p_partkey", "p_size", "p_brand"), "p_brand", "p_partkey")


@query(
    "binary_mapping",
    f"""WITH types AS ({_first_seen_sql('event_type', 'events', 'event_id')})
    SELECT 'event_type' AS "column", v AS value, code, lpad(bin(code), 3, '0') AS bits FROM types""",
)
def binary_mapping(spark, sf):
    return encode.fit_binary(table(spark, sf, "events"), "event_type", "event_id").mapping()


@query(
    "binary_encode_null_order",
    """WITH f AS (SELECT p_brand, min(coalesce(CASE WHEN p_partkey % 3 <> 0 THEN p_size END, -1)::BIGINT * 100000000 + p_partkey) AS met FROM part GROUP BY 1),
    c AS (SELECT p_brand, row_number() OVER (ORDER BY met) - 1 AS code FROM f)
    SELECT p_partkey, code::BIGINT AS code FROM part JOIN c USING (p_brand)""",
)
def binary_encode_null_order(spark, sf):
    """Rows whose first order column is missing come first; the bits are put together again as a number."""
    size = F.when(F.col("p_partkey") % 3 != 0, F.col("p_size")).alias("s")
    df = table(spark, sf, "part").select("p_partkey", size, "p_brand")
    coded = encode.binary_encode(df, "p_brand", ["s", "p_partkey"])
    bits = [c for c in coded.columns if c.startswith("p_brand_bin_")]
    code = F.lit(0)
    for c in bits:
        code = code * 2 + F.col(c)
    return coded.select("p_partkey", code.cast("long").alias("code"))


@query(
    "binary_encode_wide",
    f"""WITH codes AS ({_first_seen_sql('o_custkey::VARCHAR', 'orders', 'o_orderkey')})
    SELECT o_orderkey, code AS customer_code FROM orders JOIN codes ON o_custkey::VARCHAR = v""",
)
def binary_encode_wide(spark, sf):
    """A column with thousands of values: the bits are put together again to show the code."""
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("c"))
    coded = encode.binary_encode(df, "c", "o_orderkey")
    bits = [c for c in coded.columns if c.startswith("c_bin_")]
    code = sum((F.col(b).cast("long") * 2 ** (len(bits) - 1 - i) for i, b in enumerate(bits)), F.lit(0))
    return coded.select("o_orderkey", code.cast("long").alias("customer_code"))


_TARGET = """enc AS (SELECT {c} AS v, (count(l_extendedprice) * avg(l_extendedprice) + {s} * (SELECT avg(l_extendedprice) FROM gaps))
  / (count(l_extendedprice) + {s}) AS m FROM gaps WHERE {c} IS NOT NULL GROUP BY {c})"""


@query(
    "target_encode",
    f"""WITH {GAPS}, {_TARGET.format(c='l_returnflag', s='1.0')}
    SELECT {_ID_SQL}, l_extendedprice, round(coalesce(m, (SELECT avg(l_extendedprice) FROM gaps)), 4) AS l_returnflag_target
    FROM gaps LEFT JOIN enc ON l_returnflag = v""",
)
def target_encode(spark, sf):
    df = lineitem_gaps(spark, sf).select(*_ID, "l_extendedprice", "l_returnflag")
    return rounded(encode.target_encode(df, "l_returnflag", "l_extendedprice"), 4)


@query(
    "target_mapping",
    f"""WITH {GAPS}, {_TARGET.format(c='l_returnflag', s='10.0')},
    status AS (SELECT l_linestatus AS v, (sum(l_extendedprice) + 10.0 * (SELECT avg(l_extendedprice) FROM gaps)) / (count(*) + 10.0) AS m
               FROM gaps GROUP BY l_linestatus)
    SELECT 'l_returnflag' AS "column", v AS value, round(m, 4) AS encoded FROM enc
    UNION ALL SELECT 'l_linestatus', v, round(m, 4) FROM status""",
)
def target_mapping(spark, sf):
    fitted = encode.fit_target(lineitem_gaps(spark, sf), ["l_returnflag", "l_linestatus"], "l_extendedprice", 10.0)
    return rounded(fitted.mapping(), 4)


@query(
    "label_codes",
    f"""WITH {GAPS}, codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM
      (SELECT DISTINCT l_returnflag AS v FROM gaps WHERE l_returnflag IS NOT NULL))
    SELECT {_ID_SQL}, CAST(coalesce(code, -1) AS INT) AS l_returnflag_code FROM gaps LEFT JOIN codes ON l_returnflag = v""",
)
def label_codes(spark, sf):
    return encode.label_codes(lineitem_gaps(spark, sf).select(*_ID, "l_returnflag"), "l_returnflag").drop("l_returnflag")


# ---- scaling ----

_RANGE = "({c} - (SELECT min({c}) FROM gaps)) / ((SELECT max({c}) FROM gaps) - (SELECT min({c}) FROM gaps))"
_STANDARD = "({c} - (SELECT avg({c}) FROM gaps)) / (SELECT stddev_samp({c}) FROM gaps)"


def _scaled_sql(formula: str) -> str:
    cols = ", ".join(f"round({formula.format(c=c)}, 6) AS {c}" for c in ("l_quantity", "l_extendedprice"))
    return f"WITH {GAPS} SELECT {_ID_SQL}, {cols}, 1.0::DOUBLE AS constant FROM gaps"


def _to_scale(spark, sf):
    return lineitem_gaps(spark, sf).select(*_ID, "l_quantity", "l_extendedprice", F.lit(1.0).alias("constant"))


_SCALED = ["l_quantity", "l_extendedprice", "constant", "no such column"]


@query("minmax_scale", _scaled_sql(_RANGE))
def minmax_scale(spark, sf):
    return rounded(scale.minmax_scale(_to_scale(spark, sf), _SCALED))


@query("standard_scale", _scaled_sql(_STANDARD))
def standard_scale(spark, sf):
    return rounded(scale.standard_scale(_to_scale(spark, sf), _SCALED))


@query(
    "scale_params",
    f"""WITH {GAPS} SELECT 'minmax' AS method, 'l_quantity' AS "column", min(l_quantity) AS a, max(l_quantity) AS b FROM gaps
    UNION ALL SELECT 'standard', 'l_quantity', round(avg(l_quantity), 6), round(stddev_samp(l_quantity), 6) FROM gaps
    UNION ALL SELECT 'standard', 'l_tax', round(avg(l_tax), 6), round(stddev_samp(l_tax), 6) FROM gaps""",
)
def scale_params(spark, sf):
    df = lineitem_gaps(spark, sf)
    ranges = scale.fit_minmax(df, ["l_quantity"]).to_table(spark).withColumn("method", F.lit("minmax"))
    standard = scale.fit_standard(df, ["l_quantity", "l_tax"]).to_table(spark).withColumn("method", F.lit("standard"))
    return rounded(ranges.unionByName(standard))


# ---- profiles ----

_PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_sql(tab: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(median({c}), 6) AS median, min({c})::DOUBLE AS min,
        max({c})::DOUBLE AS max, round(stddev_pop({c}), 6) AS std_pop, count({c}) AS count FROM {tab}"""
        for c in cols
    )


@query("numeric_profile", _profile_sql("lineitem", _PROFILED))
def numeric_profile(spark, sf):
    return rounded(profile.numeric_profile(table(spark, sf, "lineitem"), _PROFILED))


@query("numeric_profile_gaps", f"WITH {GAPS} " + _profile_sql("gaps", [*_PROFILED, "l_orderkey", "l_linenumber"]))
def numeric_profile_gaps(spark, sf):
    """With missing values, whole-number columns, and a text column that is left out."""
    cols = [*_PROFILED, "l_orderkey", "l_linenumber", "l_returnflag"]
    return rounded(profile.numeric_profile(lineitem_gaps(spark, sf), cols))


@query(
    "numeric_values_long",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c}::DOUBLE AS value FROM gaps WHERE {c} IS NOT NULL"
        for c in ("l_quantity", "l_discount", "l_linenumber")
    ).join([f"WITH {GAPS} ", ""]),
)
def numeric_values_long(spark, sf):
    return profile.numeric_values_long(lineitem_gaps(spark, sf), ["l_quantity", "l_discount", "l_linenumber", "l_returnflag"])


@query(
    "pooled_mean",
    f"""WITH {GAPS} SELECT round((sum(l_quantity) + sum(l_discount) + sum(l_tax)) / (count(l_quantity) + count(l_discount) + count(l_tax)), 6)
    AS pooled_mean FROM gaps""",
)
def pooled_mean(spark, sf):
    return rounded(profile.pooled_mean(lineitem_gaps(spark, sf), ["l_quantity", "l_discount", "l_tax"]))


@query(
    "value_counts",
    f"""WITH {GAPS} SELECT 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS n FROM gaps WHERE l_returnflag IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM gaps GROUP BY 2
    UNION ALL SELECT 'l_linenumber', l_linenumber::VARCHAR, count(*) FROM gaps GROUP BY 2""",
)
def value_counts(spark, sf):
    return profile.value_counts(lineitem_gaps(spark, sf), ["l_returnflag", "l_linestatus", "l_linenumber"])


def _categorical_sql(tab: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, count(DISTINCT {c}) AS "distinct",
        (SELECT {c} FROM {tab} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode,
        round((SELECT max(n) FROM (SELECT count(*) AS n FROM {tab} WHERE {c} IS NOT NULL GROUP BY {c})) / count({c}), 6) AS top_share,
        round(count({c}) / count(*) * 100, 6) AS fill_pct, min(length({c})) AS length_min, max(length({c})) AS length_max,
        round(avg(length({c})), 6) AS length_mean FROM {tab}"""
        for c in cols
    )


@query("categorical_profile", f"WITH {GAPS} " + _categorical_sql("gaps", ["l_returnflag", "l_linestatus"]))
def categorical_profile(spark, sf):
    return rounded(profile.categorical_profile(lineitem_gaps(spark, sf)))


@query("categorical_profile_text", _categorical_sql("documents", ["lang", "source", "text"]))
def categorical_profile_text(spark, sf):
    return rounded(profile.categorical_profile(table(spark, sf, "documents")))


# ---- correlations ----


def _corr_sql(cols: list[str], source: str, rank: bool = False, digits: int = 6) -> str:
    """Pairwise correlations over rows where both are present; NULL for constant columns."""
    parts = []
    for a in cols:
        for b in cols:
            both = f"SELECT {a}::DOUBLE AS a, {b}::DOUBLE AS b FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
            if rank:
                both = f"""SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS a,
                  rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS b FROM ({both})"""
            parts.append(
                f"""SELECT '{a}' AS column_a, '{b}' AS column_b, round(CASE WHEN min(a) <> max(a) AND min(b) <> max(b)
                THEN covar_pop(a, b) / (stddev_pop(a) * stddev_pop(b)) END, {digits}) AS r FROM ({both})"""
            )
    return " UNION ALL ".join(parts)


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_CONSTANT = "with_constant AS (SELECT *, 1.0::DOUBLE AS constant FROM gaps)"


@query("pearson_matrix", f"WITH {GAPS}, {_CONSTANT} " + _corr_sql([*_CORR, "constant"], "with_constant"))
def pearson_matrix(spark, sf):
    df = lineitem_gaps(spark, sf).withColumn("constant", F.lit(1.0))
    return rounded(corr.pearson_matrix(df, [*_CORR, "constant"]))


@query("pearson_blocks", f"WITH {GAPS}, {_CONSTANT} " + _corr_sql([*_CORR, "constant"], "with_constant"))
def pearson_blocks(spark, sf):
    """The same matrix from a grid of column blocks, here of two columns each."""
    df = lineitem_gaps(spark, sf).withColumn("constant", F.lit(1.0))
    return rounded(corr.pearson_blocks(df, [*_CORR, "constant"], block=2))


@query("spearman_matrix", _corr_sql(_CORR, "lineitem", rank=True))
def spearman_matrix(spark, sf):
    return rounded(corr.spearman_matrix(table(spark, sf, "lineitem"), _CORR))


@query("spearman_gaps", f"WITH {GAPS}, {_CONSTANT} " + _corr_sql([*_CORR, "constant"], "with_constant", rank=True))
def spearman_gaps(spark, sf):
    df = lineitem_gaps(spark, sf).withColumn("constant", F.lit(1.0))
    return rounded(corr.spearman_matrix(df, [*_CORR, "constant"]))


@query(
    "corr_matrix_wide",
    f"""WITH long AS ({_corr_sql(_CORR, 'lineitem', digits=4)}) SELECT column_a AS "Variable", """
    + ", ".join(f"max(r) FILTER (column_b = '{c}') AS {c}" for c in _CORR)
    + " FROM long GROUP BY column_a",
)
def corr_matrix_wide(spark, sf):
    return corr.corr_matrix_wide(corr.pearson_matrix(table(spark, sf, "lineitem"), _CORR))


# ---- chart data ----

_NATIONS = "with_nation AS (SELECT n_name, c_acctbal, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def _with_nation(spark, sf):
    nation = table(spark, sf, "nation")
    customer = table(spark, sf, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("n_name", "c_acctbal", "c_mktsegment")


def _topk_sql(column: str, source: str, k: int, direction: str = "DESC") -> str:
    """Top categories and one row for the others, as a chain of named steps."""
    return f"""counts AS (SELECT {column} AS category, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1),
      placed AS (SELECT *, row_number() OVER (ORDER BY n {direction}, category) AS p, count(*) OVER () AS cats FROM counts),
      top AS (SELECT category, n, false AS is_other, p AS place FROM placed WHERE p < {k} OR cats <= {k}
        UNION ALL SELECT 'Inne', CAST(sum(n) AS BIGINT), true, {k} FROM placed WHERE p >= {k} AND cats > {k} HAVING count(*) > 0)"""


@query(
    "category_counts",
    f"WITH {GAPS} SELECT l_returnflag AS category, count(*) AS n FROM gaps WHERE l_returnflag IS NOT NULL GROUP BY 1",
)
def category_counts(spark, sf):
    return chartdata.category_counts(lineitem_gaps(spark, sf), "l_returnflag")


@query("topk_with_other", f"WITH {_NATIONS}, {_topk_sql('n_name', 'with_nation', 8)} SELECT * FROM top")
def topk_with_other(spark, sf):
    return chartdata.topk_with_other(_with_nation(spark, sf), "n_name")


@query("topk_ascending", f"WITH {_topk_sql('p_brand', 'part', 5, 'ASC')} SELECT * FROM top")
def topk_ascending(spark, sf):
    return chartdata.topk_with_other(table(spark, sf, "part"), "p_brand", 5, descending=False)


@query("topk_all_fit", f"WITH {_topk_sql('event_type', 'events', 8)} SELECT * FROM top")
def topk_all_fit(spark, sf):
    return chartdata.topk_with_other(table(spark, sf, "events"), "event_type")


_SHARES = """shares AS (SELECT *, n / (SELECT sum(n) FROM counts) * 100 AS percent FROM top),
  kept AS (SELECT * FROM shares WHERE percent >= {least})"""


def _share_sql(column: str, source: str, k: int, least: float) -> str:
    return f"{_topk_sql(column, source, k)}, {_SHARES.format(least=least)}"


@query(
    "share_distribution",
    f"WITH {_share_sql('source', 'documents', 8, 3.0)} SELECT category, round(percent, 6) AS percent, is_other FROM kept",
)
def share_distribution(spark, sf):
    shares = chartdata.share_distribution(table(spark, sf, "documents"), "source", 8, 3.0)
    return rounded(shares.drop("n"))


@query(
    "share_counts",
    f"""WITH {_share_sql('source', 'documents', 8, 3.0)} SELECT category, CASE WHEN is_other THEN
      (SELECT CAST(sum(n) AS BIGINT) FROM counts) - (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM kept WHERE NOT is_other) ELSE n END AS n FROM kept""",
)
def share_counts(spark, sf):
    return chartdata.share_distribution(table(spark, sf, "documents"), "source", 8, 3.0).select("category", "n")


@query(
    "share_nothing_left",
    "SELECT 'Inne' AS category, count(*) AS n, 100.0::DOUBLE AS percent, true AS is_other FROM part WHERE p_brand IS NOT NULL",
)
def share_nothing_left(spark, sf):
    return chartdata.share_distribution(table(spark, sf, "part"), "p_brand", 1_000, 90.0)


@query("mean_by_category", "SELECT p_brand, round(avg(p_retailprice), 6) AS mean_y FROM part GROUP BY 1")
def mean_by_category(spark, sf):
    return rounded(chartdata.mean_by_category(table(spark, sf, "part"), "p_brand", "p_retailprice"))


@query(
    "mean_by_category_hue",
    f"""WITH {GAPS} SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS mean_y FROM gaps
    WHERE l_returnflag IS NOT NULL GROUP BY 1, 2""",
)
def mean_by_category_hue(spark, sf):
    df = lineitem_gaps(spark, sf)
    hue = chartdata.choose_hue(df, "brak", "l_linestatus")
    return rounded(chartdata.mean_by_category(df, "l_returnflag", "l_quantity", hue, descending=False))


@query(
    "line_series",
    """WITH points AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, avg(value) AS m, count(value) AS n,
      stddev_samp(value) AS s FROM events GROUP BY 1, 2)
    SELECT day, event_type, round(m, 6) AS mean_y, n, round(m - 1.96 * s / sqrt(n), 6) AS low, round(m + 1.96 * s / sqrt(n), 6) AS high
    FROM points""",
)
def line_series(spark, sf):
    df = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return rounded(chartdata.line_series(df, "day", "value", "event_type"))


@query(
    "numeric_profile_bigint",
    """WITH b AS (SELECT o_orderkey + 9007199254740992 AS k, CASE WHEN o_custkey % 4 <> 0 THEN -o_custkey * 1000000007 END AS c FROM orders),
    k AS (SELECT k AS v, row_number() OVER (ORDER BY k) - 1 AS r, count(*) OVER () AS n FROM b),
    c AS (SELECT c AS v, row_number() OVER (ORDER BY c) - 1 AS r, count(*) OVER () AS n FROM b WHERE c IS NOT NULL)
    SELECT 'k' AS "column", (SELECT sum(v)::VARCHAR FROM k WHERE r IN ((n - 1) // 2, n // 2) AND n % 2 = 0 OR r = n // 2 AND n % 2 = 1) AS middles,
      (SELECT min(v) FROM k) AS min, (SELECT max(v) FROM k) AS max, (SELECT count(*) FROM k) AS count
    UNION ALL SELECT 'c', (SELECT sum(v)::VARCHAR FROM c WHERE r IN ((n - 1) // 2, n // 2) AND n % 2 = 0 OR r = n // 2 AND n % 2 = 1),
      (SELECT min(v) FROM c), (SELECT max(v) FROM c), (SELECT count(*) FROM c)""",
)
def numeric_profile_bigint(spark, sf):
    """Whole numbers beyond 2^53; of an even count the two middles are shown added up, else the one."""
    key, gaps = F.col("o_orderkey") + F.lit(2**53), F.when(F.col("o_custkey") % 4 != 0, -F.col("o_custkey") * 1000000007)
    found = profile.whole_profile(table(spark, sf, "orders").select(key.alias("k"), gaps.alias("c")))
    middles = F.when(F.col("count") % 2 == 0, F.col("median") * 2).otherwise(F.col("median")).cast("decimal(38,0)").cast("string")
    return found.select("column", middles.alias("middles"), "min", "max", "count")


@query(
    "scatter_sample",
    """SELECT o_custkey AS x, o_totalprice AS y, o_orderstatus AS hue FROM orders ORDER BY md5(o_orderkey::VARCHAR) LIMIT 1000""",
)
def scatter_sample(spark, sf):
    return chartdata.scatter_sample(table(spark, sf, "orders"), "o_custkey", "o_totalprice", "o_orderkey", 1000, "o_orderstatus")


_HEAVY, _SHARE = ["l_quantity", "l_suppkey", "l_returnflag", "l_partkey"], 0.0105


@query(
    "heavy_values",
    "WITH heavy_rows AS (SELECT l_suppkey, l_partkey, l_returnflag, CASE WHEN (l_orderkey + l_linenumber) % 7 <> 0 THEN l_quantity END AS l_quantity FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c}::VARCHAR AS value, count(*) AS n FROM heavy_rows GROUP BY {c} "
        f"HAVING {c} IS NOT NULL AND count(*) > {_SHARE} * (SELECT count({c}) FROM heavy_rows)"
        for c in _HEAVY
    ),
)
def heavy_values(spark, sf):
    """From states of each line status, merged."""
    gaps = every("l_quantity", 7, "l_orderkey", "l_linenumber")
    df = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_returnflag", "l_linestatus", gaps)
    states = sketches.frequency_states(df, _HEAVY, ["l_linestatus"])
    return sketches.heavy_values(df, _HEAVY, _SHARE, states)


_SKETCHED, _SHARES = ["l_quantity", "l_extendedprice", "l_tax"], [0.01, 0.25, 0.5, 0.9]


@query(
    "quantile_states",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {s}::DOUBLE AS share, (SELECT count({c}) FROM lineitem) AS n, true AS merged_close, true AS whole_close"
        for c in _SKETCHED
        for s in _SHARES
    ),
)
def quantile_states(spark, sf):
    """Whether the exact ranks of the values told by states, one of each month merged and one of all rows, are as asked for."""
    df = table(spark, sf, "lineitem").select(*_SKETCHED, F.date_trunc("month", "l_shipdate").alias("month"))
    merged = sketches.merge_quantile_states(sketches.quantile_states(df, _SKETCHED, ["month"]))
    whole = sketches.quantile_states(df, _SKETCHED)
    told = sketches.state_quantiles(merged, _SHARES).join(
        sketches.state_quantiles(whole, _SHARES).select("column", "share", F.col("value").alias("other"), F.col("n").alias("same_n")), ["column", "share"]
    )
    told = told.where("n = same_n").select("column", "share", "n", "value", "other")
    long = df.unpivot([], _SKETCHED, "column", "v").where("v IS NOT NULL")
    met = long.join(F.broadcast(told), "column").groupBy("column", "share", "n").agg(
        *[F.count_if(F.col("v") < F.col(c)).alias(f"{c}_below") for c in ("value", "other")],
        *[F.count_if(F.col("v") <= F.col(c)).alias(f"{c}_upto") for c in ("value", "other")],
    )

    def close(c: str):
        wanted = F.col("share") * F.col("n")
        room = F.lit(sketches.RANK_ERROR) * F.col("n") + 1
        return (F.col(f"{c}_below") <= wanted + room) & (F.col(f"{c}_upto") >= wanted - room)

    return met.select("column", "share", "n", close("value").alias("merged_close"), close("other").alias("whole_close"))


@query(
    "distinct_states",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", true AS close FROM (SELECT count(DISTINCT {c}) FROM lineitem)" for c in ("l_orderkey", "l_partkey", "l_quantity")),
)
def distinct_states(spark, sf):
    """Whether merged states tell the number of distinct values within five in a hundred."""
    cols = ["l_orderkey", "l_partkey", "l_quantity"]
    df = table(spark, sf, "lineitem")
    states = sketches.merge_distinct_states(sketches.distinct_states(df, cols, ["l_linestatus"]))
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).unpivot([], cols, "column", "exact")
    told = sketches.distinct_counts(states).join(exact, "column")
    return told.select("column", (F.abs(F.col("distinct") - F.col("exact")) <= 0.05 * F.col("exact")).alias("close"))


@query(
    "scatter_bins",
    """WITH p AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem), e AS (SELECT min(x) AS a, max(x) AS b, min(y) AS c, max(y) AS d FROM p)
    SELECT x_bin, y_bin, round(a + x_bin * (b - a) / 20, 6) AS x_low, round(c + y_bin * (d - c) / 20, 6) AS y_low, n FROM (
      SELECT least(floor((x - a) * 20 / (b - a)), 19)::INT AS x_bin, least(floor((y - c) * 20 / (d - c)), 19)::INT AS y_bin, count(*) AS n
      FROM p, e GROUP BY 1, 2), e""",
)
def scatter_bins(spark, sf):
    return rounded(chartdata.scatter_bins(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 20))


@query(
    "scatter_points",
    f"WITH {GAPS} SELECT l_quantity AS x, l_extendedprice AS y, l_returnflag AS hue, l_tax AS size FROM gaps WHERE l_quantity IS NOT NULL",
)
def scatter_points(spark, sf):
    return chartdata.scatter_points(lineitem_gaps(spark, sf), "l_quantity", "l_extendedprice", "l_returnflag", "l_tax")


@query(
    "trend_line",
    f"""WITH {GAPS} SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
    round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM gaps""",
)
def trend_line(spark, sf):
    return rounded(chartdata.trend_line(lineitem_gaps(spark, sf), "l_quantity", "l_extendedprice"), 4)


@query(
    "short_labels",
    "SELECT c_custkey, CASE WHEN length(c_name) > 15 THEN substr(c_name, 1, 12) || '...' ELSE c_name END AS label FROM customer",
)
def short_labels(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", short_label(F.col("c_name")).alias("label"))


def _band_sql(replicates: int) -> str:
    """The band from the same digests: a row counts as often as its draw reaches limits."""
    draw = "substr(md5(concat_ws(':', event_id, r // 4 + 1)), (8 * (r % 4) + 1)::BIGINT, 8)"
    times = " + ".join(f"(h >= '{t}')::INT" for t in chartdata.POISSON_LIMITS)
    return f"""WITH drawn AS (SELECT event_type, value, r, {draw} AS h FROM events, range({replicates}) AS t(r)),
    weighed AS (SELECT event_type, value, r, {times} AS w FROM drawn),
    means AS (SELECT event_type, r, sum(w * value) / nullif(sum(w), 0) AS m FROM weighed GROUP BY ALL),
    band AS (SELECT event_type, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM means GROUP BY 1)
    SELECT event_type, round(avg(value), 6) AS mean_y, count(*) AS n, round(any_value(low), 6) AS low, round(any_value(high), 6) AS high
    FROM events JOIN band USING (event_type) GROUP BY 1"""


@query("line_band", _band_sql(100))
def line_band(spark, sf):
    """Mean value of each event type with a bootstrap band."""
    return rounded(chartdata.line_band(table(spark, sf, "events"), "event_type", "value", "event_id", replicates=100))
