"""Regression and classification jobs on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.values import ratio
from tallyfold.operators.rows import union_all
from tallyfold.session import materialize


def assemble_features(df: DataFrame, columns: Sequence[str], invalid: str = "skip") -> DataFrame:
    """Columns as one ``features`` vector; rows with nulls are skipped or an error."""
    return VectorAssembler(
        inputCols=list(columns), outputCol="features", handleInvalid=invalid
    ).transform(df)


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """value, n, idx of the values of a text column: 0 is the most frequent one, ties by name. Nulls have no index.

    Counts are combined in each task. The distinct values are then cut along their order into ranges; each is
    numbered by itself and begins where the ranges before it end. No list of values comes to the driver.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    # Written: the cuts are drawn from a sample, so both uses below must see the same ones.
    ranges = materialize(
        counts.repartitionByRange(F.desc("n"), F.asc("value")).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(F.desc("n"), "value")) - 1
    # As many rows as there are ranges.
    numbered = ranges.withColumn("_place", place).join(F.broadcast(starts), "_range")
    return numbered.select("value", "n", (F.col("start") + F.col("_place")).cast("double").alias("idx"))


def index_categories(
    df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None, invalid: str = "skip"
) -> DataFrame:
    """``<column>_index`` per text column, learnt on ``fitted_on`` (default: ``df`` itself).

    ``invalid`` says what becomes of a row that holds a null or a value not seen there:
    skip drops the row, keep gives the value one index more, error stops.
    """
    if invalid not in ("skip", "keep", "error"):
        raise ValueError(f"invalid is skip, keep or error, not {invalid}")
    learnt = df if fitted_on is None else fitted_on
    for column in columns:
        known = materialize(dictionary(learnt, column).select("value", "idx"), "dictionary")
        found = df.join(known.withColumnsRenamed({"value": column, "idx": f"{column}_index"}), column,
                        "inner" if invalid == "skip" else "left")
        if invalid == "keep":
            more = known.agg(F.count("*").cast("double").alias("more")).scalar()
            found = found.withColumn(f"{column}_index", F.coalesce(f"{column}_index", more))
        elif invalid == "error":
            message = F.concat(F.lit(f"{column} has no index for "), F.coalesce(column, F.lit("null")))
            found = found.withColumn(f"{column}_index", F.coalesce(
                f"{column}_index", F.raise_error(message).cast("double")))
        df = found.select(*df.columns, f"{column}_index")
    return df


def index_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values of each indexed column with their index."""
    return union_all(*[
        dictionary(df, column).select(F.lit(column).alias("column"), "value", "idx") for column in columns])


def leaf_means(train: DataFrame, test: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``test`` with the tree's ``prediction`` and ``is_leaf_mean``.

    A tree predicts the mean label of the training rows in the same leaf, which are those
    with the same prediction. Both are compared to nine digits.
    """
    model = fit_tree(train, features, label)
    means = model.transform(train).groupBy("prediction").agg(F.avg(label).alias("_mean"))
    near = F.abs(F.col("prediction") - F.col("_mean")) <= F.abs(F.col("_mean")) * 1e-9
    return model.transform(test).join(F.broadcast(means), "prediction", "left").withColumn(
        "is_leaf_mean", F.coalesce(near, F.lit(False))).drop("features", "_mean")


def fit_tree(train: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """A decision tree of at most 2**5 leaves."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        DecisionTreeRegressor(featuresCol="features", labelCol=label, seed=42),
    ]).fit(train)


def regress_tree(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str
) -> DataFrame:
    """``test`` with the ``prediction`` of a decision tree fitted on ``train``."""
    return fit_tree(train, features, label).transform(test).drop("features")


def eval_rmse(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Root of the mean squared error."""
    error = F.col(prediction) - F.col(label)
    return predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def eval_accuracy(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction equals the label."""
    right = F.count_if(F.col(prediction) == F.col(label))
    return predictions.agg(ratio(right, F.count("*")).alias("accuracy"))


def repartition_for_training(df: DataFrame, partitions: int | None, label: str = "label") -> DataFrame:
    """Features and label over at least ``partitions`` tasks, written once.

    A fit reads its rows several times, and each reading would run a shuffle anew. The written rows are read in
    splits of even size; only a table too small for so many splits is dealt out again.
    """
    if not partitions:
        return df
    written = materialize(df.select("features", label), "training")
    return written if written.rdd.getNumPartitions() >= partitions else written.repartition(partitions)


def classify_logistic(
    train: DataFrame, test: DataFrame, label: str = "label", partitions: int | None = None
) -> DataFrame:
    """``test`` with logistic predictions; both frames carry ``features``."""
    model = LogisticRegression(featuresCol="features", labelCol=label)
    return model.fit(repartition_for_training(train, partitions, label)).transform(test)


def classify_mlp(
    train: DataFrame, test: DataFrame, hidden: Sequence[int] = (5, 4), classes: int = 2,
    label: str = "label", max_iter: int = 50, seed: int = 42, partitions: int | None = None,
) -> DataFrame:
    """``test`` with perceptron predictions; the input width is that of ``features``."""
    width = train.schema["features"].metadata.get("ml_attr", {}).get(
        "num_attrs"
    ) or len(train.select("features").first()["features"])
    model = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol=label, maxIter=max_iter, seed=seed,
        layers=[width, *hidden, classes],
    )
    return model.fit(repartition_for_training(train, partitions, label)).transform(test)


def fallback_model(
    train: DataFrame, test: DataFrame, floor: float = 0.55, label: str = "label",
    partitions: int | None = None,
) -> DataFrame:
    """Accuracy report; the perceptron is trained only if the first model is below ``floor``."""
    spark = train.sparkSession
    train = repartition_for_training(train, partitions, label)
    predicted = classify_logistic(train, test, label)
    reached = eval_accuracy(predicted, label).first()["accuracy"]
    rows = [("logistic", reached, reached >= floor)]
    if reached < floor:
        predicted = classify_mlp(train, test, label=label)
        rows.append(("mlp", eval_accuracy(predicted, label).first()["accuracy"], True))
    return spark.createDataFrame(rows, "model string, accuracy double, chosen boolean")
