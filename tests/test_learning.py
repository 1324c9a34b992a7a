"""Learners, their measures, and fitted operators on a stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from prepframe.operators import learn
from prepframe.operators.dedup import drop_duplicates
from prepframe.streaming.apply import drop_duplicates_stream, transform_stream


@pytest.fixture(scope="module")
def flowers(spark):
    """Three well separated groups; the label follows the group, one in ten is missing."""
    group = F.col("id") % 3
    noise = (F.xxhash64("id") % 1000) / 2000.0
    return spark.range(300).select(
        "id",
        (group * 4 + noise).alias("a"),
        (group * -3 + noise * noise).alias("b"),
        F.when(group == 0, "x").otherwise("y").alias("c"),
        F.when(F.col("id") % 10 != 9, F.concat(F.lit("g"), group.cast("string"))).alias("label"),
    ).cache()


def test_split_is_exact_per_label_and_stable(spark, flowers):
    rows = flowers.dropna()
    def split(df):
        return {r["id"]: r["_is_test"] for r in learn.stratified_split(df, "label", "id").collect()}

    first = split(rows)
    assert first == split(rows.repartition(5))
    sizes = rows.groupBy("label").count().collect()
    for r in sizes:
        ids = {x["id"] for x in rows.where(F.col("label") == r["label"]).collect()}
        assert sum(first[i] for i in ids) == round(r["count"] * 0.3)


def test_split_of_one_dominant_label(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 990, "common").otherwise("rare").alias("label"))
    split = learn.stratified_split(df, "label", "id").groupBy("label", "_is_test").count()
    assert {(r[0], r[1]): r[2] for r in split.collect()} == {
        ("common", True): 297, ("common", False): 693, ("rare", True): 3, ("rare", False): 7,
    }


def _sizes(split):
    return {(r[0], r[1]): r[2] for r in split.groupBy("label", "_is_test").count().collect()}


def test_split_counts_deeper_and_by_order_when_keys_repeat(spark, monkeypatch):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("label"), F.lit(7).alias("same"))
    want = {(r["id"], r["_is_test"]) for r in learn.stratified_split(df, "label", "id").collect()}
    monkeypatch.setattr(learn, "_BITS_PER_PASS", 4)
    assert {(r["id"], r["_is_test"]) for r in learn.stratified_split(df, "label", "id").collect()} == want
    sizes = _sizes(learn.stratified_split(df, "label", "same"))
    assert sizes == _sizes(learn.stratified_split(df, "label", "id"))
    assert sum(n for (_, test), n in sizes.items() if test) == 500 + 500 + 500


def test_split_moves_no_rows(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("label"))
    split = learn.stratified_split(df, "label", "id")
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    everything = learn.stratified_split(df, "label", "id", test_share=1.0)
    assert everything.where("_is_test").count() == 5000
    assert learn.stratified_split(df, "label", "id", test_share=0.0).where("_is_test").count() == 0


def test_classifiers_find_clear_groups(flowers):
    models = ("logreg", "dtree", "id3", "forest")
    found = learn.classify(flowers, ["a", "b", "c"], "label", "id", models=models)
    assert found.predictions.columns == ["id", "a", "b", "c", "true_label", *[f"{m}_pred" for m in models]]
    assert found.predictions.count() == 270
    assert all(v["accuracy"] > 0.95 and v["weighted_f1"] > 0.95 for v in found.metrics.values())
    with pytest.raises(ValueError):
        learn.classify(flowers, ["a"], "label", "id", fit_on="test")


def test_weighted_f1_by_hand(spark):
    table = spark.createDataFrame(
        [("m", 0, 0, 3), ("m", 0, 1, 1), ("m", 1, 1, 2), ("m", 1, 0, 2), ("m", 2, 0, 2)], "model string, y int, p int, n long"
    )
    f0, f1 = 2 * 3 / (4 + 7), 2 * 2 / (4 + 3)
    assert learn.weighted_f1(table).first()[1] == pytest.approx((4 * f0 + 4 * f1) / 10)


def test_clusters(flowers):
    found = learn.cluster_kmeans(flowers, ["a", "b"], k=3)
    assert found.rows.columns == [*flowers.columns, "cluster"]
    groups = found.rows.groupBy(F.col("id") % 3).agg(F.countDistinct("cluster")).collect()
    assert [g[1] for g in groups] == [1, 1, 1]
    assert found.silhouette_sq > 0.9 and found.inertia > 0


def test_features(flowers):
    prepared = learn.prepare_features(flowers, ["a", "c"])
    assert prepared.columns == ["a", "c_y"]
    stats = prepared.agg(F.avg("a"), F.stddev_samp("a")).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(1)
    with pytest.raises(ValueError):
        learn.prepare_features(flowers.withColumn("z", F.array("a")), ["z"])


def test_score_all(flowers):
    scored, classified, clustered = learn.score_all(flowers, ["a", "b"], "label", "id", k=3)
    assert {"true_label", "logreg_pred", "dtree_pred", "cluster"} <= set(scored.columns)
    assert scored.count() == 270


def _run(stream, tmp_path, name):
    out = str(tmp_path / name)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / f"{name}-state"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(out)


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    from prepframe.plans.learning import _events_gaps, _fitted

    stored = spark.read.parquet(f"{sf_dir}/events.parquet")
    fitted = _fitted(_events_gaps(stored))
    batch = _events_gaps(stored)
    for params in fitted:
        batch = params.transform(batch)
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(f"{sf_dir}/events*.parquet")
    got = _run(transform_stream(_events_gaps(stream), fitted), tmp_path, "prepared")
    assert sorted(got.collect()) == sorted(batch.collect())
    with pytest.raises(ValueError):
        transform_stream(stored, fitted)


def test_stream_duplicates(spark, tmp_path):
    events = spark.range(40).select(
        (F.col("id") % 8).alias("k"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts")
    )
    path = str(tmp_path / "in")
    events.write.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path)
    got = _run(drop_duplicates_stream(stream, "k", "ts", "1 hour"), tmp_path, "unique")
    assert sorted(r["k"] for r in got.collect()) == list(range(8))
    assert drop_duplicates(events, "k", "first", "ts").count() == 8


def test_numeric_classes_come_back(spark):
    for low, high in ((-1, 1), (0.2, 0.7), (3, 9_007_199_254_740_993)):
        df = spark.range(200).select("id", (F.col("id") % 10).alias("x"), F.when(F.col("id") % 10 > 4, F.lit(high)).otherwise(F.lit(low)).alias("label"))
        found = learn.classify(df, ["x"], "label", "id", models=("logreg", "dtree"))
        assert {(r["true_label"], r["dtree_pred"]) for r in found.predictions.collect()} == {(low, low), (high, high)}
        again = found.transform(spark.createDataFrame([(1,), (8,)], "x long")).collect()
        assert [(r["logreg_pred"], r["dtree_pred"]) for r in again] == [(low, low), (high, high)]


def test_text_classes_are_codes(flowers):
    found = learn.classify(flowers, ["a", "b", "c"], "label", "id", models=("dtree",))
    rows = found.transform(flowers.drop("label"))
    both = rows.join(found.predictions.select("id", F.col("dtree_pred").alias("before")), "id")
    assert both.where("dtree_pred <> before").count() == 0 and both.count() == 270


def test_clusters_of_other_rows(flowers):
    found = learn.cluster_kmeans(flowers, ["a", "b"], k=3)
    again = found.transform(flowers).select("id", "cluster").exceptAll(found.rows.select("id", "cluster"))
    assert again.count() == 0


def test_split_of_many_labels(spark):
    df = spark.range(40_000).select("id", (F.col("id") % 900).alias("label"))
    sizes = _sizes(learn.stratified_split(df, "label", "id"))
    assert len(sizes) == 1800
    assert all(sizes[k, True] == int((sizes[k, True] + sizes[k, False]) * 0.3 + 0.5) for k in range(900))
    gaps = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(20)], "id long, label string")
    assert _sizes(learn.stratified_split(gaps, "label", "id")) == {("a", True): 3, ("a", False): 7, (None, True): 3, (None, False): 7}
