"""Feature preparation, classifiers, k-means and their measures, on pyspark.ml."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.functions.columns import col, present
from prepframe.guards import categories_of, numeric_columns, require, text_columns
from prepframe.operators.deeptree import DeepTree, fit_deep_tree
from prepframe.operators.encode import OneHot, fit_onehot
from prepframe.operators.rowid import number_rows
from prepframe.operators.scale import Scaling, fit_standard
from prepframe.scratch import stored

FEATURES, LABEL, SPLIT = "_features", "_label", "_is_test"


@dataclass
class Features:
    """Numbers standardised, text turned into 0/1 columns with the first category left out."""

    cols: list[str]
    scaling: Scaling | None
    dummies: OneHot | None

    def columns(self) -> list[str]:
        """Names of the prepared columns, in vector order."""
        texts = self.dummies.categories if self.dummies else {}
        plain = [c for c in self.cols if c not in texts]
        return plain + [n for c in texts for n in self.dummies.names(c)]

    def transform(self, df: DataFrame) -> DataFrame:
        """The prepared feature columns, beside whatever else `df` holds."""
        out = self.scaling.transform(df) if self.scaling else df
        return self.dummies.transform(out) if self.dummies else out

    def assemble(self, df: DataFrame) -> DataFrame:
        """`df` unchanged, plus a vector column; rows with a missing number get an error, as in training."""
        struct = F.struct(*[col(c) for c in df.columns]).alias("_raw")
        raw = df.select(struct, *[col(c) for c in self.cols])
        prepared = self.transform(raw)
        vectors = VectorAssembler(inputCols=self.columns(), outputCol=FEATURES, handleInvalid="error").transform(prepared)
        return vectors.select("_raw.*", FEATURES)


def fit_features(df: DataFrame, cols: Sequence[str]) -> Features:
    names = require(df, list(cols))
    chosen = df.select(*[col(c) for c in names])
    numbers, texts = numeric_columns(chosen), text_columns(chosen)
    booleans = [f.name for f in chosen.schema if isinstance(f.dataType, T.BooleanType)]
    odd = set(names) - set(numbers) - set(texts) - set(booleans)
    if odd:
        raise ValueError(f"features must be numbers, booleans or text: {sorted(odd)}")
    return Features(
        names,
        fit_standard(chosen, numbers) if numbers else None,
        fit_onehot(chosen, texts, drop_first=True) if texts else None,
    )


def prepare_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The prepared feature columns alone."""
    chosen = df.select(*[col(c) for c in require(df, list(cols))])
    return fit_features(df, cols).transform(chosen)


_BITS_PER_PASS = 10
#: Labels up to which the table of their limits is broadcast; a join by shuffle beyond.
BROADCAST_LABELS = 100_000


def stratified_split(
    df: DataFrame, label: str, key: str | Sequence[str], test_share: float = 0.3, seed: int = 42
) -> DataFrame:
    """Add `_is_test`: round(share · n) rows of every label, the same ones for the same seed and keys.

    A row is drawn by the hash of its key, and every label gets the limit below which exactly the wanted number
    of its hashes lie. The limits are found by counting, so no row is moved. Only where equal hashes straddle a
    limit (keys that repeat) are the rows put in order instead.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require(df, [label, *keys])
    draw = F.xxhash64(*[col(k) for k in keys], F.lit(seed))
    limits = _draw_limits(df.select(col(label).alias("label"), draw.alias("draw")), test_share)
    if limits is None:
        return _ranked_split(df, label, keys, draw, test_share)
    table = limits.select(F.col("label").alias("_label_value"), F.col("limit").alias("_limit"))
    if limits.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        table = F.broadcast(table)
    joined = df.join(table, col(label).eqNullSafe(F.col("_label_value")))
    below = F.coalesce(draw < F.col("_limit"), F.lit(True))
    return joined.withColumn(SPLIT, below).drop("_label_value", "_limit")


def _draw_limits(draws: DataFrame, share: float) -> DataFrame | None:
    """(label, limit): the hash with exactly round(share · n) smaller ones (null: all are); None if ties forbid it.

    Hashes are counted by their leading bits; of the part that holds a label's limit the next bits are counted, and
    so on. Labels and their counts stay in tables: at most 1 024 parts a label at a time, fewer than its rows.
    """
    shift, here = 64 - _BITS_PER_PASS, draws
    done, wanted = [], None
    by_part = Window.partitionBy("label").orderBy("part")
    while True:
        counts = here.groupBy("label", F.shiftright("draw", shift).alias("part")).agg(F.count(F.lit(1)).alias("n"))
        if wanted is None:
            totals = counts.groupBy("label").agg(F.sum("n").alias("total"))
            wanted = totals.select("label", F.floor(F.col("total") * share + 0.5).alias("wanted"), "total")
        # the first part of each label whose rows, with those before it, are more than wanted
        counted = counts.withColumn("upto", F.sum("n").over(by_part))
        met = counted.withColumnRenamed("label", "_label").join(wanted, F.col("_label").eqNullSafe(F.col("label")))
        first = met.where(F.col("upto") > F.col("wanted")).groupBy("label").agg(
            F.min(F.struct("part", "n", "upto", "wanted")).alias("at")
        )
        first = stored(first.select("label", "at.part", (F.col("at.wanted") - F.col("at.upto") + F.col("at.n")).alias("still")), "limits")
        if shift == 64 - _BITS_PER_PASS:
            done.append(wanted.where("wanted >= total").select("label", F.lit(None).cast("long").alias("limit")))
        # none of the part's hashes is wanted: the limit is where the part begins
        done.append(first.where("still = 0").select("label", F.shiftleft("part", shift).alias("limit")))
        inside = first.where("still > 0")
        if inside.isEmpty():
            out = done[0]
            for d in done[1:]:
                out = out.union(d)
            return stored(out, "limits")
        if shift == 0:
            return None
        parts = inside.select(F.col("label").alias("_label"), F.col("part").alias("_part"))
        same = F.col("label").eqNullSafe(F.col("_label")) & (F.shiftright("draw", shift) == F.col("_part"))
        here = draws.join(parts, same).select("label", "draw")
        wanted = inside.select("label", F.col("still").alias("wanted"))
        shift = max(0, shift - _BITS_PER_PASS)


def _ranked_split(df: DataFrame, label: str, keys: list[str], draw, share: float) -> DataFrame:
    """The same split by places within (label, hash), equal hashes in order of arrival."""
    numbered = number_rows(df, [col(label), draw, *keys]).rows(name="_at")
    sizes = numbered.groupBy(col(label).alias("_label_value")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"))
    in_label = F.col("_at") - F.col("_from")
    if sizes.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        sizes = F.broadcast(sizes)
    return (
        numbered.join(sizes, col(label).eqNullSafe(F.col("_label_value")))
        .withColumn(SPLIT, in_label < F.floor(F.col("_n") * share + 0.5))
        .drop("_at", "_label_value", "_n", "_from")
    )


@dataclass
class Labels:
    """The classes of a target. Models learn their places; text classes are given out as codes, others as they are."""

    target: str
    dtype: T.DataType
    values: list

    @property
    def coded(self) -> bool:
        return isinstance(self.dtype, T.StringType)

    def index(self) -> Column:
        """The place of a row's class."""
        return (F.array_position(self._array(), col(self.target)) - 1).cast("int")

    def value(self, place: Column) -> Column:
        """What a place stands for."""
        return place.cast("int") if self.coded else F.element_at(self._array(), place.cast("int") + 1)

    def _array(self) -> Column:
        return F.array(*[F.lit(v).cast(self.dtype) for v in self.values])


#: Classes that a target may have; a target with more is a number to be predicted, not a class.
MAX_CLASSES = 1_000


def fit_labels(df: DataFrame, target: str) -> Labels:
    """The distinct values of a target in order, or those its category list has; more than MAX_CLASSES are an error."""
    known = categories_of(df, target)
    if known is None:
        known = sorted(r[0] for r in df.select(present(df, target)).distinct().dropna().limit(MAX_CLASSES + 1).collect())
    if len(known) > MAX_CLASSES:
        raise ValueError(f"target {target} has more than {MAX_CLASSES} classes")
    return Labels(target, df.schema[target].dataType, list(known))


@dataclass
class Classified:
    """Predictions for every row, test measures per model {model: {accuracy, weighted_f1}}, and how to score more rows."""

    predictions: DataFrame
    metrics: dict[str, dict[str, float]]
    models: dict[str, object]
    features: Features
    labels: Labels

    def transform(self, df: DataFrame) -> DataFrame:
        """Other rows, on a stream as well, with `{model}_pred`; their target need not be known."""
        return _predicted(self.features.assemble(df), self.models, self.labels).drop(FEATURES)

    def metrics_table(self) -> DataFrame:
        rows = [(m, v["accuracy"], v["weighted_f1"]) for m, v in self.metrics.items()]
        return self.predictions.sparkSession.createDataFrame(rows, "model string, accuracy double, weighted_f1 double")


def _models(n_train: int, seed: int, max_bins: int) -> Mapping[str, object]:
    shared = {"featuresCol": FEATURES, "labelCol": LABEL}
    trees = {**shared, "seed": seed, "maxBins": max_bins}
    return {
        # a penalty of 1/(2C) on the summed loss, C = 1, is 1/n on Spark's mean loss
        "logreg": LogisticRegression(
            **shared, maxIter=1000, regParam=1.0 / max(n_train, 1), elasticNetParam=0.0, standardization=False
        ),
        "dtree": DecisionTreeClassifier(**trees, impurity="gini", maxDepth=30),
        # information gain is the criterion of ID3
        "id3": DecisionTreeClassifier(**trees, impurity="entropy", maxDepth=30),
        "forest": RandomForestClassifier(**trees, impurity="gini", numTrees=20, maxDepth=10),
    }


def classify(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    key: str | Sequence[str],
    test_share: float = 0.3,
    seed: int = 42,
    models: Sequence[str] = ("logreg", "dtree"),
    fit_on: str = "train",
    max_bins: int = 32,
) -> Classified:
    """Train on a stratified part and predict every row whose target is present.

    The result has the raw columns, `true_label` and `{model}_pred`: codes for text classes, else the classes
    themselves, whatever numbers they are. Models are logreg, dtree, id3, forest, and deep, an exact tree without a limit of
    depth or bins. With `fit_on="all"` the features are prepared from all rows, test rows included.
    """
    if fit_on not in ("train", "all"):
        raise ValueError("fit_on must be train or all")
    rows = df.dropna(subset=require(df, [target]))
    labels = fit_labels(rows, target)
    split = stratified_split(rows.withColumn(LABEL, labels.index()), target, key, test_share, seed)
    train_rows = split.where(~F.col(SPLIT))
    prepared = fit_features(train_rows if fit_on == "train" else split, features)
    # stored, so that each pass of the solvers reads vectors instead of preparing them again
    vectors = stored(prepared.assemble(split), "vectors")
    train = vectors.where(~F.col(SPLIT))
    chosen = _models(train.count(), seed, max_bins)
    fitted = {m: fit_deep_tree(train, FEATURES, LABEL, len(labels.values)) if m == "deep" else chosen[m].fit(train) for m in models}
    out = _predicted(vectors.withColumn("true_label", labels.value(F.col(LABEL))), fitted, labels)
    metrics = class_metrics(out.where(SPLIT), "true_label", {m: f"{m}_pred" for m in models})
    return Classified(out.drop(FEATURES, SPLIT, LABEL, target), metrics, fitted, prepared, labels)


def _predicted(vectors: DataFrame, models: Mapping[str, object], labels: Labels) -> DataFrame:
    out = vectors
    for name, model in models.items():
        if isinstance(model, DeepTree):
            out = model.transform(out, FEATURES, "_p").withColumn(f"{name}_pred", labels.value(F.col("_p"))).drop("_p")
            continue
        scored = model.copy().setPredictionCol("_p").setRawPredictionCol("").setProbabilityCol("").transform(out)
        out = scored.withColumn(f"{name}_pred", labels.value(F.col("_p"))).drop("_p")
    return out


def class_metrics(df: DataFrame, label: str, predictions: Mapping[str, str]) -> dict[str, dict[str, float]]:
    """Accuracy and weighted F1 of several predictions, from one small confusion table."""
    pairs = df.select(col(label).alias("y"), *[col(p).alias(m) for m, p in predictions.items()])
    confusion = (
        pairs.unpivot(["y"], list(predictions), "model", "p").groupBy("model", "y", "p").agg(F.count(F.lit(1)).alias("n"))
    )
    # one row for each model and pair of classes; measured on the driver, without files
    table = df.sparkSession.createDataFrame(confusion.collect(), confusion.schema)
    hit = F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)) / F.sum("n")
    rows = table.groupBy("model").agg(hit.alias("accuracy")).join(weighted_f1(table), "model").collect()
    return {r["model"]: {"accuracy": r["accuracy"], "weighted_f1": r["weighted_f1"]} for r in rows}


def weighted_f1(confusion: DataFrame) -> DataFrame:
    """(model, weighted_f1) from (model, y, p, n): each label's F1 weighted by its number of true rows."""
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    true = confusion.groupBy("model", F.col("y").alias("label")).agg(F.sum("n").alias("support"), F.sum(hit).alias("tp"))
    said = confusion.groupBy("model", F.col("p").alias("label")).agg(F.sum("n").alias("said"))
    per_label = true.join(said, ["model", "label"], "left").select(
        "model",
        "support",
        (2.0 * F.col("tp") / (F.col("support") + F.coalesce("said", F.lit(0)))).alias("f1"),
    )
    return per_label.groupBy("model").agg(
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1")
    )


@dataclass
class Clustered:
    """Every row with its `cluster`, and the measures of the clustering."""

    rows: DataFrame
    model: KMeansModel
    inertia: float
    silhouette_sq: float | None
    features: Features | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        """Other rows, on a stream as well, with their cluster."""
        if self.features is None:
            raise ValueError("fitted on an array column: score vectors with the model itself")
        return self.model.transform(self.features.assemble(df)).drop(FEATURES)

    def metrics_table(self) -> DataFrame:
        sizes = self.model.summary.clusterSizes
        rows = [(len(sizes), float(self.inertia), self.silhouette_sq)]
        return self.rows.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette_sq double")


def cluster_kmeans(df: DataFrame, features: Sequence[str], k: int = 4, seed: int = 42) -> Clustered:
    """k-means on prepared features.

    `silhouette_sq` uses squared Euclidean distances, which need one pass; the plain one needs all pairs of rows.
    """
    prepared = fit_features(df, features)
    return _cluster(stored(prepared.assemble(df), "vectors"), k, seed, prepared)


def _cluster(vectors: DataFrame, k: int, seed: int, features: Features | None = None) -> Clustered:
    model = KMeans(featuresCol=FEATURES, predictionCol="cluster", k=k, seed=seed, maxIter=300, tol=1e-4).fit(vectors)
    rows = model.transform(vectors)
    silhouette = None
    if k > 1 and len([s for s in model.summary.clusterSizes if s]) > 1:
        silhouette = ClusteringEvaluator(featuresCol=FEATURES, predictionCol="cluster").evaluate(rows)
    return Clustered(rows.drop(FEATURES), model, model.summary.trainingCost, silhouette, features)


def cluster_vectors(df: DataFrame, array_col: str, k: int = 4, seed: int = 42) -> Clustered:
    """k-means on an array column taken as it is."""
    from pyspark.ml.functions import array_to_vector

    require(df, array_col)
    return _cluster(stored(df.withColumn(FEATURES, array_to_vector(col(array_col))), "vectors"), k, seed)


def score_all(
    df: DataFrame, features: Sequence[str], target: str, key: str | Sequence[str], k: int = 4, seed: int = 42
) -> tuple[DataFrame, Classified, Clustered]:
    """Class predictions and the cluster of every row in one table: the cluster model scores the predicted rows."""
    classified = classify(df, features, target, key, seed=seed)
    rows = classified.predictions
    prepared = fit_features(rows, features)
    clustered = _cluster(stored(prepared.assemble(rows), "vectors"), k, seed, prepared)
    return clustered.rows, classified, clustered


def seasonality(df: DataFrame, ts: str, value: str) -> DataFrame:
    """(month, total, month_index): monthly sums and their month of the year's mean relative to the overall mean."""
    require(df, [ts, value])
    monthly = (
        df.where(col(ts).isNotNull())
        .groupBy(F.date_trunc("month", col(ts)).cast("date").alias("month"))
        .agg(F.sum(present(df, value)).alias("total"))
    )
    # a table of months is short whatever the data holds, so its overall mean may be taken in one task
    by_month = F.avg("total").over(Window.partitionBy(F.month("month")))
    overall = F.avg("total").over(Window.partitionBy(F.lit(0)))
    return monthly.select("month", "total", (by_month / overall).alias("month_index")).orderBy("month")
