"""Trees without limits, ID3, silhouettes."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepframe.operators import learn
from prepframe.operators.id3 import fit_id3
from prepframe.operators.silhouette import silhouette as plain_silhouette
from prepframe.plans.registry import query, rounded, table


@query(
    "classify_deep",
    "SELECT o_orderkey, o_orderkey % 64 AS k, CAST(o_orderkey % 64 % 2 AS INT) AS true_label, CAST(o_orderkey % 64 % 2 AS INT) AS deep_pred FROM orders",
)
def classify_deep(spark, sf):
    """A class that changes from each of 64 values to the next, which takes a tree some 60 splits deep."""
    k = F.col("o_orderkey") % 64
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", k.alias("k"), (k % 2).cast("int").alias("odd"))
    return learn.classify(df, ["k", "o_totalprice"], "odd", "o_orderkey", models=("deep",)).predictions.drop("o_totalprice")


_ATTRIBUTES = ["priority", "segment", "nation"]
#: Orders with categories of theirs and of their customers; every thirteenth customer has no segment.
_ORDERS = """orders_of AS (
  SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority,
         CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS segment, CAST(c_nationkey % 5 AS VARCHAR) AS nation
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def _orders_of(spark, sf):
    customer = table(spark, sf, "customer")
    segment = F.when(F.col("c_custkey") % 13 != 0, F.col("c_mktsegment")).alias("segment")
    owners = customer.select(F.col("c_custkey").alias("o_custkey"), segment, (F.col("c_nationkey") % 5).cast("string").alias("nation"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return orders.join(owners, "o_custkey").drop("o_custkey")


def _id3_sql(depth: int) -> str:
    """The levels of the tree one by one: rows_i, counts_i, gains_i and nodes_i."""
    names = "[" + ", ".join(f"'{a}'" for a in _ATTRIBUTES) + "]"
    parts = [f"rows_0 AS (SELECT o_orderkey, '' AS node, [{', '.join(_ATTRIBUTES)}] AS v, status AS class FROM orders_of)"]
    for i in range(depth + 1):
        going_on = "gain > 0" if i < depth else "false"
        parts += [
            f"""counts_{i} AS (
  SELECT node, a, value, class, count(*) AS n FROM (SELECT node, class, unnest(range(1, {len(_ATTRIBUTES) + 1})) AS a, unnest(v) AS value FROM rows_{i})
  GROUP BY ALL)""",
            f"""gains_{i} AS (
  SELECT node, a, n, round(log2(n) - logs / n, 9) AS entropy, round(log2(n) - logs / n - inside / n, 9) AS gain
  FROM (SELECT node, a, sum(nv) AS n, sum(nv * log2(nv) - logs) AS inside
        FROM (SELECT node, a, value, sum(n) AS nv, sum(n * log2(n)) AS logs FROM counts_{i} GROUP BY ALL) GROUP BY ALL)
  JOIN (SELECT node, a, sum(nc * log2(nc)) AS logs FROM (SELECT node, a, class, sum(n) AS nc FROM counts_{i} GROUP BY ALL) GROUP BY ALL) USING (node, a))""",
            f"""labels_{i} AS (
  SELECT node, class AS label FROM (SELECT node, class, sum(n) AS nc FROM counts_{i} WHERE a = 1 GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY nc DESC, class) = 1)""",
            f"""nodes_{i} AS (
  SELECT node, {i} AS depth, n::BIGINT AS n, label, entropy, CASE WHEN {going_on} THEN a END AS split, CASE WHEN {going_on} THEN gain END AS gain
  FROM gains_{i} JOIN labels_{i} USING (node) QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, a) = 1)""",
            f"""rows_{i + 1} AS (
  SELECT o_orderkey, node || '/' || {names}[split] || '=' || coalesce(v[split], '?') AS node, v, class
  FROM rows_{i} JOIN nodes_{i} USING (node) WHERE split IS NOT NULL)""",
        ]
    return f"WITH {_ORDERS}, " + ", ".join(parts)


_ID3_DEPTH = 2
_ALL_NODES = " UNION ALL ".join(f"SELECT * FROM nodes_{i}" for i in range(_ID3_DEPTH + 1))


@query(
    "id3_tree",
    _id3_sql(_ID3_DEPTH)
    + f" SELECT node, depth, n, label, round(entropy, 6) AS entropy, {_ATTRIBUTES!r}[split] AS attribute, round(gain, 6) AS gain FROM ({_ALL_NODES})",
)
def id3_tree(spark, sf):
    return rounded(fit_id3(_orders_of(spark, sf), _ATTRIBUTES, "status", _ID3_DEPTH).nodes)


@query(
    "id3_gains",
    _id3_sql(_ID3_DEPTH)
    + " SELECT node, "
    + f"{_ATTRIBUTES!r}[a] AS attribute, round(gain, 6) AS gain, n::BIGINT AS n FROM ("
    + " UNION ALL ".join(f"SELECT node, a, gain, n FROM gains_{i}" for i in range(_ID3_DEPTH + 1))
    + ")",
)
def id3_gains(spark, sf):
    return rounded(fit_id3(_orders_of(spark, sf), _ATTRIBUTES, "status", _ID3_DEPTH).gains)


@query(
    "id3_predictions",
    _id3_sql(_ID3_DEPTH)
    + " SELECT o_orderkey, coalesce("
    + ", ".join(f"n{i}.label" for i in range(_ID3_DEPTH, -1, -1))
    + ") AS id3_pred FROM rows_0 JOIN nodes_0 n0 USING (node) "
    + " ".join(
        f"LEFT JOIN (SELECT o_orderkey, label FROM rows_{i} JOIN nodes_{i} USING (node)) n{i} USING (o_orderkey)" for i in range(1, _ID3_DEPTH + 1)
    ),
)
def id3_predictions(spark, sf):
    df = _orders_of(spark, sf)
    return fit_id3(df, _ATTRIBUTES, "status", _ID3_DEPTH).transform(df).select("o_orderkey", "id3_pred")


_COMPARED = 400


@query(
    "silhouette",
    f"""WITH drawn AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings ORDER BY md5(vec_id::VARCHAR) LIMIT {_COMPARED}),
means AS (
  SELECT a.vec_id, a.label AS own, b.label, sum(list_distance(a.e, b.e)) AS far, count(*) AS n FROM drawn a JOIN drawn b ON true GROUP BY ALL),
sides AS (
  SELECT vec_id, max(far / greatest(n - 1, 1)) FILTER (WHERE own = label) AS inside, max(n) FILTER (WHERE own = label) AS n,
         min(far / n) FILTER (WHERE own <> label) AS beside FROM means GROUP BY vec_id)
SELECT round(avg(CASE WHEN n > 1 THEN (beside - inside) / greatest(inside, beside) ELSE 0.0 END), 6) AS silhouette, 0.0::DOUBLE AS std_error,
       count(*) AS rows, count(*) AS compared, CAST((SELECT count(DISTINCT label) FROM drawn) AS INT) AS clusters FROM sides""",
)
def silhouette(spark, sf):
    """The labels of embeddings as clusters, over the rows with the smallest hashes of their ids."""
    drawn = table(spark, sf, "embeddings").orderBy(F.md5(F.col("vec_id").cast("string").cast("binary"))).limit(_COMPARED)
    return rounded(plain_silhouette(drawn, "embedding", "label", "vec_id"))
