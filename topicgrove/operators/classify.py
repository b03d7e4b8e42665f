"""Training and applying the classifier that assigns leaf topics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicgrove.schema import cluster_column, require_levels

HASH_DIGITS = 3
LEAST_PER_CLASS = 2


def _hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))


def split_stratified(
    posts: DataFrame, label: str, key: str = "url", test_size: float = 0.2, seed: int = 0
) -> DataFrame:
    """Posts with ``is_test``: per class, the ``round(test_size * size)`` posts with the smallest hashes.

    The hash of a post's ``key`` decides, so a split is repeatable. A class is
    ranked in slices by the first hash digits, and slices are put in order by
    their counts, so even a class with a third of all posts is ranked by many
    tasks.
    """
    hashed = posts.withColumn("_hash", _hash(key, seed)).withColumn("_slice", F.substring("_hash", 1, HASH_DIGITS))
    counts = hashed.groupBy(label, "_slice").agg(F.count("*").alias("_n"))
    of_class = Window.partitionBy(label)
    before = of_class.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.round(F.sum("_n").over(of_class) * F.lit(test_size)).cast("long")
    slices = counts.select(
        label, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), quota.alias("_quota")
    )
    place = F.row_number().over(Window.partitionBy(label, "_slice").orderBy("_hash", key))
    ranked = hashed.withColumn("_place", place).join(slices, [label, "_slice"])
    is_test = F.col("_before") + F.col("_place") <= F.col("_quota")
    return ranked.select(*posts.columns, is_test.alias("is_test"))


def require_class_sizes(train: DataFrame, label: str) -> DataFrame:
    """Raise ValueError with some of the classes that have fewer than two training posts."""
    small = train.groupBy(label).count().filter(F.col("count") < LEAST_PER_CLASS).orderBy(label).limit(5).collect()
    if small:
        raise ValueError(f"Classes with a single training post cannot be learned: {', '.join(str(r[0]) for r in small)}.")
    return train


@dataclass(frozen=True)
class TopicModel:
    """A fitted classifier of embedded posts into leaf clusters."""

    model: PipelineModel
    label: str
    vector: str

    def predict(self, posts: DataFrame) -> DataFrame:
        """Posts with the predicted leaf id in the label column."""
        scored = self.model.transform(_features(posts, self.vector))
        kept = [c for c in posts.columns if c != self.label]
        return scored.select(*kept, F.col("_predicted").cast("int").alias(self.label))

    def score(self, posts: DataFrame) -> float:
        """Share of labelled posts whose label is predicted; a label that was never learned counts as missed."""
        truth = posts.filter(F.col(self.label).isNotNull()).withColumn("_truth", F.col(self.label).cast("int"))
        right = F.col("_truth") == F.col(self.label)
        return self.predict(truth).agg(F.avg(right.cast("double"))).first()[0]


def _features(posts: DataFrame, vector: str) -> DataFrame:
    return posts.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))


def _labelled(posts: DataFrame, label: str, vector: str) -> DataFrame:
    return _features(posts, vector).withColumn("_class", F.col(label).cast("string"))


def fit_model(train: DataFrame, label: str, vector: str = "text_embedding", model: Estimator | None = None) -> TopicModel:
    """Fit any Spark ML classifier on embedded posts; multinomial logistic regression by default."""
    require_class_sizes(train.filter(F.col(label).isNotNull()), label)
    rows = _labelled(train.select(label, vector).filter(F.col(label).isNotNull()), label, vector)
    indexer = StringIndexer(inputCol="_class", outputCol="_label", handleInvalid="error").fit(rows)
    classifier = model or LogisticRegression(maxIter=50, regParam=0.001)
    classifier = classifier.copy().setFeaturesCol("_features").setLabelCol("_label")
    names = IndexToString(inputCol="prediction", outputCol="_predicted", labels=indexer.labels)
    fitted = Pipeline(stages=[indexer, classifier]).fit(rows)
    return TopicModel(PipelineModel(stages=[fitted.stages[-1], names]), label, vector)


def classify(
    posts: DataFrame,
    num_levels: int,
    vector: str = "text_embedding",
    model: Estimator | None = None,
    test_size: float = 0.2,
    seed: int = 0,
) -> tuple[TopicModel, float]:
    """A model fitted on the training split and its accuracy on the test split."""
    require_levels(posts, num_levels)
    label = cluster_column(num_levels)
    rows = posts.select("url", label, vector).filter(F.col(label).isNotNull())
    split = split_stratified(rows, label, "url", test_size, seed)
    fitted = fit_model(split.filter(~F.col("is_test")), label, vector, model)
    return fitted, fitted.score(split.filter("is_test"))
