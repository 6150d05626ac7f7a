"""Scores of predictions, each from one aggregate over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.core import half_even, ratio


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (classes x rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("records"))
    totals = counts.agg(
        F.struct(F.sum("records").alias("n"), F.count("*").alias("k"))
    ).scalar()
    return counts.withColumn("weight", totals["n"] / (totals["k"] * F.col("records")))


def with_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Adds `weight`; the handful of classes travels as one map, so nothing is shuffled."""
    weights = class_weights(df, label).agg(
        F.map_from_entries(F.collect_list(F.struct(label, "weight")))
    )
    return df.withColumn("weight", F.element_at(weights.scalar(), F.col(label)))


def regression_metrics(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """MAE, RMSE and R2."""
    y, error = F.col(label), F.col(label) - F.col(prediction)
    n = F.count("*")
    residual, total = F.sum(error * error), F.var_pop(y) * n
    return df.agg(
        half_even(F.avg(F.abs(error)), digits).alias("mae"),
        half_even(F.sqrt(ratio(residual, n)), digits).alias("rmse"),
        half_even(F.when(total > 0, 1 - ratio(residual, total)), digits).alias("r2"),
    )


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def class_scores(counts: DataFrame) -> DataFrame:
    """Unrounded precision, recall, F1 and support per class; a ratio over nothing is 0."""
    actual = counts.select(F.col("label").alias("class"), "n", F.lit(1).alias("is_label"), (F.col("label") == F.col("prediction")).cast("int").alias("hit"))
    named = counts.select(F.col("prediction").alias("class"), "n", F.lit(0), F.lit(0))
    sums = actual.union(named).groupBy("class").agg(
        F.sum(F.col("n") * F.col("hit")).alias("hits"),
        F.sum(F.col("n") * F.col("is_label")).alias("support"),
        F.sum(F.col("n") * (1 - F.col("is_label"))).alias("predicted"),
    )
    return sums.select(
        "class",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "hits",
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def classification_report(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    scores = class_scores(confusion(df, label, prediction))
    rounded = [half_even(F.col(c), digits).alias(c) for c in ("precision", "recall", "f1")]
    return scores.select("class", *rounded, "support")


def classification_metrics(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    scores = class_scores(confusion(df, label, prediction))
    total = F.sum("support")
    weighted = {c: ratio(F.sum(F.col(c) * F.col("support")), total) for c in ("precision", "recall", "f1")}
    return scores.agg(
        half_even(ratio(F.sum("hits"), total), digits).alias("accuracy"),
        *[half_even(value, digits).alias(name) for name, value in weighted.items()],
    )
