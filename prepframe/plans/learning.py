"""Feature preparation, classification, clustering, and fitted operators on a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepframe.operators import learn
from prepframe.operators.encode import fit_label_codes, fit_onehot, fit_target
from prepframe.operators.missing import fit_fill
from prepframe.operators.replace import fit_replacement
from prepframe.operators.scale import fit_minmax, fit_standard
from prepframe.plans.registry import lineitem_gaps, query, rounded, table
from prepframe.scratch import scratch_path
from prepframe.streaming.apply import drop_duplicates_stream, transform_stream
from prepframe.streaming.keyed import keep_duplicates_stream

_SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "prepare_features",
    "SELECT round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_samp(c_acctbal) FROM customer), 6) AS c_acctbal, "
    + ", ".join(f"CAST(c_mktsegment = '{s}' AS TINYINT) AS \"c_mktsegment_{s}\"" for s in _SEGMENTS)
    + " FROM customer",
)
def prepare_features(spark, sf):
    return rounded(learn.prepare_features(table(spark, sf, "customer"), ["c_acctbal", "c_mktsegment"]))


@query(
    "stratified_split",
    """SELECT o_orderstatus, b AS is_test, CASE WHEN b THEN test ELSE n - test END AS n
    FROM (SELECT o_orderstatus, count(*) AS n, CAST(round(count(*) * 0.3) AS BIGINT) AS test FROM orders GROUP BY 1)
    CROSS JOIN (VALUES (true), (false)) AS v(b)""",
)
def stratified_split(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    split = learn.stratified_split(df, "o_orderstatus", "o_orderkey")
    return split.groupBy("o_orderstatus", F.col(learn.SPLIT).alias("is_test")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "stratified_split_many_labels",
    """SELECT l_partkey, b AS is_test, CASE WHEN b THEN test ELSE n - test END AS n
    FROM (SELECT l_partkey, count(*) AS n, CAST(floor(count(*) * 0.3 + 0.5) AS BIGINT) AS test FROM lineitem GROUP BY 1)
    CROSS JOIN (VALUES (true), (false)) AS v(b) WHERE CASE WHEN b THEN test ELSE n - test END > 0""",
)
def stratified_split_many_labels(spark, sf):
    """As many labels as there are parts."""
    df = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    split = learn.stratified_split(df, "l_partkey", ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"])
    return split.groupBy("l_partkey", F.col(learn.SPLIT).alias("is_test")).agg(F.count(F.lit(1)).alias("n"))


def _graded(spark, sf):
    """Documents with a quality grade; features are their length, language and source."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    return docs.join(table(spark, sf, "labels"), "doc_id")


_FEATURES = ["n_chars", "lang", "source", "toxic"]


_GRADED = "SELECT doc_id, d.n_chars, d.lang, d.source, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)"
_TESTED = f"SELECT CAST(sum(CAST(round(n * 0.3) AS BIGINT)) AS BIGINT) FROM (SELECT quality, count(*) AS n FROM ({_GRADED}) GROUP BY 1)"


@query("classify", f"SELECT doc_id, n_chars, lang, source, toxic, quality AS true_label, true AS known FROM ({_GRADED})")
def classify(spark, sf):
    """Every labelled row once with its class; predictions are classes of the target."""
    found = learn.classify(_graded(spark, sf), _FEATURES, "quality", "doc_id").predictions
    known = F.col("logreg_pred").isin(0, 1) & F.col("dtree_pred").isin(0, 1)
    return found.withColumn("known", known).drop("logreg_pred", "dtree_pred")


def _measured(spark, sf, models, fit_on):
    """Per model: the test rows, and whether accuracy and F1 recomputed from the predictions are those reported."""
    df = _graded(spark, sf)
    found = learn.classify(df, _FEATURES, "quality", "doc_id", models=models, fit_on=fit_on)
    tested = learn.stratified_split(df, "quality", "doc_id").where(learn.SPLIT).select("doc_id")
    long = found.predictions.join(tested, "doc_id").unpivot(["true_label"], [f"{m}_pred" for m in models], "model", "p")
    by = long.groupBy("model").agg(F.count(F.lit(1)).alias("tested"), F.avg((F.col("true_label") == F.col("p")).cast("int")).alias("right"))
    said = found.metrics_table().withColumn("model", F.concat("model", F.lit("_pred")))
    agrees = (F.abs(F.col("right") - F.col("accuracy")) < 1e-9) & F.col("weighted_f1").between(0, 1)
    return by.join(said, "model").select("model", "tested", agrees.alias("agrees"))


def _measured_sql(models) -> str:
    return " UNION ALL ".join(f"SELECT '{m}_pred' AS model, ({_TESTED}) AS tested, true AS agrees" for m in models)


@query("classify_metrics", _measured_sql(("logreg", "dtree")))
def classify_metrics(spark, sf):
    return _measured(spark, sf, ("logreg", "dtree"), "all")


@query("classify_forest", _measured_sql(("forest", "id3")))
def classify_forest(spark, sf):
    return _measured(spark, sf, ("forest", "id3"), "train")


_RULE = "SELECT p_partkey, p_size, {label} AS true_label, {label} AS dtree_pred, {label} AS id3_pred FROM part"


def _ruled(spark, sf, label):
    """Trees must find a threshold that a label hides, and give the label's own values back."""
    df = table(spark, sf, "part").select("p_partkey", "p_size", label.alias("label"))
    return learn.classify(df, ["p_size"], "label", "p_partkey", models=("dtree", "id3"), max_bins=64).predictions


@query("classify_rule", _RULE.format(label="CAST(p_size > 20 AS INT)"))
def classify_rule(spark, sf):
    return _ruled(spark, sf, (F.col("p_size") > 20).cast("int"))


@query("classify_signed_labels", _RULE.format(label="CASE WHEN p_size > 20 THEN 1 ELSE -1 END"))
def classify_signed_labels(spark, sf):
    return _ruled(spark, sf, F.when(F.col("p_size") > 20, 1).otherwise(-1))


@query("classify_fraction_labels", _RULE.format(label="CASE WHEN p_size > 40 THEN 0.7 WHEN p_size > 20 THEN 0.2 ELSE -0.5 END::DOUBLE"))
def classify_fraction_labels(spark, sf):
    return _ruled(spark, sf, F.when(F.col("p_size") > 40, 0.7).when(F.col("p_size") > 20, 0.2).otherwise(-0.5))


@query("logreg_gradient", "SELECT * FROM (VALUES ('intercept', 0.0::DOUBLE), ('p_retailprice', 0.0::DOUBLE), ('p_size', 0.0::DOUBLE)) AS v(part, gradient)")
def logreg_gradient(spark, sf):
    """The penalised loss has no slope left at the fitted weights: computed from the train rows, to four digits."""
    from pyspark.ml.functions import vector_to_array

    label = ((F.col("p_size") + F.col("p_partkey") % 17) > 25).cast("int").alias("label")
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", label)
    found = learn.classify(df, ["p_size", "p_retailprice"], "label", "p_partkey", models=("logreg",))
    train = learn.stratified_split(df, "label", "p_partkey").where(~F.col(learn.SPLIT))
    model, x = found.models["logreg"], vector_to_array(F.col(learn.FEATURES))
    w, b = [float(v) for v in model.coefficients], float(model.intercept)
    rows = found.features.assemble(train).select("label", x[0].alias("x0"), x[1].alias("x1"))
    off = 1 / (1 + F.exp(-(F.col("x0") * w[0] + F.col("x1") * w[1] + b))) - F.col("label")
    # with one strength on the mean loss, the penalty's slope is the weight over the number of rows
    sums = rows.agg(F.avg(off).alias("g"), *[(F.avg(off * F.col(f"x{i}")) + F.lit(w[i]) / F.count(F.lit(1))).alias(f"g{i}") for i in range(2)])
    parts = [F.struct(F.lit(n).alias("part"), (F.round(c, 4) + 0.0).alias("gradient")) for n, c in (("intercept", "g"), ("p_size", "g0"), ("p_retailprice", "g1"))]
    return sums.select(F.inline(F.array(*parts)))


@query(
    "weighted_f1",
    """WITH said AS (SELECT l_returnflag AS y, CASE WHEN l_linestatus = 'O' THEN 'N' WHEN l_quantity > 25 THEN 'A' ELSE 'R' END AS p FROM lineitem),
    per_label AS (SELECT y, count(*) AS support, count(*) FILTER (y = p) AS tp, (SELECT count(*) FROM said s WHERE s.p = t.y) AS claimed
      FROM said t GROUP BY y)
    SELECT 'rule' AS model, round(sum(support * 2.0 * tp / (support + claimed)) / sum(support), 6) AS weighted_f1 FROM per_label""",
)
def weighted_f1(spark, sf):
    guess = F.when(F.col("l_linestatus") == "O", "N").when(F.col("l_quantity") > 25, "A").otherwise("R")
    said = table(spark, sf, "lineitem").select(F.lit("rule").alias("model"), F.col("l_returnflag").alias("y"), guess.alias("p"))
    return rounded(learn.weighted_f1(said.groupBy("model", "y", "p").agg(F.count(F.lit(1)).alias("n"))))


@query("kmeans", "SELECT c_custkey, c_acctbal, c_mktsegment, true AS known FROM customer")
def kmeans(spark, sf):
    """Every row once; its cluster is one of those asked for."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    found = learn.cluster_kmeans(customer, ["c_acctbal", "c_mktsegment"]).rows
    return found.withColumn("known", F.col("cluster").between(0, 3)).drop("cluster")


@query("kmeans_metrics", "SELECT 4::INT AS k, true AS inertia, true AS silhouette_sq, count(*) AS n FROM embeddings")
def kmeans_metrics(spark, sf):
    """Inertia is the sum of squares about the clusters' means, up to the solver's tolerance."""
    found = learn.cluster_vectors(table(spark, sf, "embeddings"), "embedding")
    at = found.rows.select("cluster", F.posexplode("embedding").alias("place", "x")).groupBy("cluster", "place")
    about = at.agg(F.var_pop("x") * F.count("x")).toDF("cluster", "place", "s").agg(F.sum("s").alias("about"))
    said, counted = found.metrics_table(), found.rows.agg(F.count(F.lit(1)).alias("n"))
    both = said.join(F.broadcast(about)).join(F.broadcast(counted))
    return both.select("k", (F.abs(F.col("inertia") / F.col("about") - 1) < 0.01).alias("inertia"), F.col("silhouette_sq").between(-1, 1).alias("silhouette_sq"), "n")


_APART = """SELECT p_partkey, p_partkey % 4 AS grp, (p_partkey % 4) * 1000.0::DOUBLE + p_size AS x, (p_partkey % 4) * (p_partkey % 4) * 500.0::DOUBLE AS y FROM part"""


def _groups(spark, sf):
    """Four groups far apart."""
    four = F.col("p_partkey") % 4
    x, y = four * 1000.0 + F.col("p_size"), four * four * 500.0
    df = table(spark, sf, "part").select("p_partkey", F.array(x.cast("double"), y.cast("double")).alias("v"))
    return learn.cluster_vectors(df, "v")


@query("kmeans_groups", f"SELECT p_partkey, min(p_partkey) OVER (PARTITION BY grp) AS first_key FROM ({_APART})")
def kmeans_groups(spark, sf):
    found = _groups(spark, sf).rows.select("p_partkey", "cluster")
    return found.join(found.groupBy("cluster").agg(F.min("p_partkey").alias("first_key")), "cluster").select("p_partkey", "first_key")


@query(
    "kmeans_groups_inertia",
    f"""SELECT 4::INT AS k, round(sum(s), 4) AS inertia FROM (
    SELECT var_pop(x) * count(*) + var_pop(y) * count(*) AS s FROM ({_APART}) GROUP BY grp)""",
)
def kmeans_groups_inertia(spark, sf):
    return _groups(spark, sf).metrics_table().select("k", F.round("inertia", 4).alias("inertia"))


@query("score_all", f"SELECT doc_id, n_chars, lang, source, toxic, quality AS true_label, true AS known FROM ({_GRADED})")
def score_all(spark, sf):
    """Every labelled row once, with classes of the target and one of the clusters."""
    found = learn.score_all(_graded(spark, sf), _FEATURES, "quality", "doc_id")[0]
    known = F.col("logreg_pred").isin(0, 1) & F.col("dtree_pred").isin(0, 1) & F.col("cluster").between(0, 3)
    return found.withColumn("known", known).drop("logreg_pred", "dtree_pred", "cluster")


@query(
    "product_clusters",
    """SELECT l_partkey, round(sum(l_quantity)) AS quantity, round(sum(l_extendedprice * (1 - l_discount))) AS revenue,
    count(*) AS lines, true AS known FROM lineitem GROUP BY 1""",
)
def product_clusters(spark, sf):
    """Products clustered by what was sold of them."""
    sales = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("quantity"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        F.count(F.lit(1)).alias("lines"),
    )
    found = learn.cluster_kmeans(sales, ["quantity", "revenue", "lines"]).rows
    return rounded(found.withColumn("known", F.col("cluster").between(0, 3)).drop("cluster"), 0)


@query(
    "seasonality",
    """WITH monthly AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(o_totalprice) AS total FROM orders GROUP BY 1),
    by_month AS (SELECT month(month) AS moy, avg(total) AS m FROM monthly GROUP BY 1)
    SELECT month, round(total, 2) AS total, round(m / (SELECT avg(total) FROM monthly), 6) AS month_index
    FROM monthly JOIN by_month ON month(month) = moy""",
)
def seasonality(spark, sf):
    found = learn.seasonality(table(spark, sf, "orders"), "o_orderdate", "o_totalprice")
    return found.select("month", F.round("total", 2).alias("total"), F.round("month_index", 6).alias("month_index"))


def _fitted(df):
    """Fill, replacement, target means and scaling, each fitted on what the one before gives."""
    fill = fit_fill(df, {"value": "median"})
    filled = fill.transform(df)
    rules = fit_replacement(filled, {"event_type": {"error": "problem"}})
    replaced = rules.transform(filled)
    target = fit_target(replaced, "event_type", "value")
    encoded = target.transform(replaced)
    return [fill, rules, target, fit_standard(encoded, ["value"])]


def _events_gaps(df):
    return df.select("event_id", "event_type", F.when(F.col("event_id") % 6 != 0, F.col("value")).alias("value"))


@query(
    "stream_prepare",
    """WITH gaps AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'problem' ELSE event_type END AS event_type,
      CASE WHEN event_id % 6 <> 0 THEN value END AS value FROM events),
    filled AS (SELECT event_id, event_type, coalesce(value, (SELECT median(value) FROM gaps)) AS value FROM gaps),
    enc AS (SELECT event_type, (sum(value) + (SELECT avg(value) FROM filled)) / (count(*) + 1) AS m FROM filled GROUP BY 1)
    SELECT event_id, round((value - (SELECT avg(value) FROM filled)) / (SELECT stddev_samp(value) FROM filled), 6) AS value,
      round(m, 6) AS event_type_target FROM filled JOIN enc USING (event_type)""",
)
def stream_prepare(spark, sf):
    """Parameters fitted on the stored table, applied to the same rows as they arrive on a stream."""
    stored = table(spark, sf, "events")
    fitted = _fitted(_events_gaps(stored))
    arriving = spark.readStream.schema(stored.schema).parquet(f"{sf}/events*.parquet")
    prepared = transform_stream(_events_gaps(arriving), fitted)
    out, state = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    run = prepared.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    run.awaitTermination()
    return rounded(spark.read.schema(prepared.schema).parquet(out))


def _streamed(spark, sf, name, prepare):
    """A table's rows as they arrive on a stream, prepared and written, then read back."""
    arriving = prepare(spark.readStream.schema(table(spark, sf, name).schema).parquet(f"{sf}/{name}*.parquet"))
    out, state = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    run = arriving.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    run.awaitTermination()
    return spark.read.schema(arriving.schema).parquet(out)


@query("stream_score", "SELECT p_partkey, p_size, CASE WHEN p_size > 20 THEN 1 ELSE -1 END AS dtree_pred FROM part")
def stream_score(spark, sf):
    """A classifier fitted on the stored table scores rows of a stream."""
    df = table(spark, sf, "part").select("p_partkey", "p_size", F.when(F.col("p_size") > 20, 1).otherwise(-1).alias("label"))
    fitted = learn.classify(df, ["p_size"], "label", "p_partkey", models=("dtree",), max_bins=64)
    return _streamed(spark, sf, "part", lambda s: fitted.transform(s.select("p_partkey", "p_size")))


@query(
    "stream_encoders",
    """WITH s AS (SELECT o_orderkey, o_orderstatus AS s, o_totalprice AS p, row_number() OVER () AS r FROM orders)
    SELECT o_orderkey, round((p - (SELECT min(p) FROM s)) / (SELECT max(p) - min(p) FROM s), 6) AS o_totalprice,
      CASE s WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END::BIGINT AS code,
      (s = 'F')::TINYINT AS "o_orderstatus_F", (s = 'O')::TINYINT AS "o_orderstatus_O", (s = 'P')::TINYINT AS "o_orderstatus_P" FROM s""",
)
def stream_encoders(spark, sf):
    """Min-max scaling, label codes and one-hot columns, fitted on the stored table, on a stream."""
    cols = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    df = table(spark, sf, "orders").select(*cols)
    fitted = [fit_minmax(df, ["o_totalprice"]), fit_label_codes(df, "o_orderstatus"), fit_onehot(df, "o_orderstatus")]
    out = rounded(_streamed(spark, sf, "orders", lambda s: transform_stream(s.select(*cols), fitted)))
    return out.withColumn("code", F.col("o_orderstatus_code").cast("long")).drop("o_orderstatus_code")


@query("stream_keep_first", "SELECT event_type, count(*) > 0 AS present FROM events GROUP BY 1")
def stream_keep_first(spark, sf):
    """One row of each event type stays on a stream whose delay covers the whole table."""
    first = lambda s: drop_duplicates_stream(s.select("event_type", F.col("ts").cast("timestamp").alias("ts")), "event_type", "ts", "3650 days")
    kept = _streamed(spark, sf, "events", first)
    return kept.groupBy("event_type").agg((F.count(F.lit(1)) == 1).alias("present"))


_EVENT = ["event_id", "ts", "user_id", "event_type", "value"]


def _events_in_batches(spark, sf, prepare):
    """Events arriving file by file, a micro-batch each, and in the end a row that moves the watermark past them all."""
    out, state, folder = scratch_path(spark, "stream"), scratch_path(spark, "stream-state"), scratch_path(spark, "arriving")
    stored = table(spark, sf, "events").select(*_EVENT).withColumn("ts", F.col("ts").cast("timestamp"))
    stored.repartitionByRange(3, "ts").write.parquet(folder)
    marker = [F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema if f.name != "ts"]
    stored.agg((F.max("ts") + F.expr("INTERVAL '36500 days'")).alias("ts")).select(*marker, "ts").select(*_EVENT).write.mode("append").parquet(folder)
    arriving = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    before = {k: spark.conf.get(k, None) for k in _STATE_STORE}
    for k, v in _STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        kept = prepare(arriving)
        run = kept.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
        run.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(kept.schema).parquet(out).withColumn("ts", F.unix_micros("ts"))


#: State with timers needs the store on disk.
_STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@query(
    "stream_keep_last",
    """SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1""",
)
def stream_keep_last(spark, sf):
    """Each user's last event of a type, from several micro-batches."""
    return _events_in_batches(spark, sf, lambda s: keep_duplicates_stream(s, ["user_id", "event_type"], "ts", "3650 days"))


@query(
    "stream_keep_none",
    """SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value FROM events
    QUALIFY count(*) OVER (PARTITION BY user_id, floor(value)) = 1""",
)
def stream_keep_none(spark, sf):
    """Events whose user and whole part of the value occur once, from several micro-batches."""
    keys = lambda s: s.withColumn("whole", F.floor("value"))
    return _events_in_batches(spark, sf, lambda s: keep_duplicates_stream(keys(s), ["user_id", "whole"], "ts", "3650 days", "none")).drop("whole")


@query(
    "prepared_profile",
    """WITH g AS (SELECT CASE WHEN (l_orderkey + l_linenumber) % 7 <> 0 THEN l_quantity END AS q, l_extendedprice AS p,
      CASE WHEN (l_orderkey + l_suppkey) % 11 <> 0 THEN l_returnflag END AS f FROM lineitem),
    filled AS (SELECT coalesce(q, (SELECT median(q) FROM g)) AS q, p,
      coalesce(f, (SELECT f FROM g WHERE f IS NOT NULL GROUP BY f ORDER BY count(*) DESC, f LIMIT 1)) AS f FROM g),
    enc AS (SELECT f, (sum(p) + (SELECT avg(p) FROM filled)) / (count(*) + 1) AS m FROM filled GROUP BY f),
    rows AS (SELECT (q - (SELECT avg(q) FROM filled)) / (SELECT stddev_samp(q) FROM filled) AS q, m FROM filled JOIN enc USING (f))
    SELECT 'l_quantity' AS "column", round(abs(avg(q)), 4) AS mean, round(median(q), 4) AS median, round(min(q), 4) AS min, round(max(q), 4) AS max,
      round(stddev_pop(q), 4) AS std_pop, count(q) AS count FROM rows
    UNION ALL SELECT 'l_returnflag_target', round(abs(avg(m)), 4), round(median(m), 4), round(min(m), 4), round(max(m), 4), round(stddev_pop(m), 4), count(m) FROM rows""",
)
def prepared_profile(spark, sf):
    """The whole way: fill, replace, encode, scale, then profile."""
    from prepframe.operators import encode, missing, profile, replace, scale

    df = lineitem_gaps(spark, sf).select("l_quantity", "l_extendedprice", "l_returnflag")
    filled = missing.fill(df, {"l_quantity": "median", "l_returnflag": "mode"})
    replaced = replace.replace_values(filled, {"l_returnflag": {"A": "accepted", "R": "returned"}})
    encoded = encode.target_encode(replaced, "l_returnflag", "l_extendedprice")
    scaled = scale.standard_scale(encoded, ["l_quantity"])
    found = profile.numeric_profile(scaled, ["l_quantity", "l_returnflag_target"])
    return rounded(found.withColumn("mean", F.abs("mean")), 4)
