"""Model training, comparison and attribution queries.

All of them train full-size models, `models.Size()`, on the whole table and every feature. A fit takes
minutes even at the smaller scales (README has the times).
"""

from __future__ import annotations

from functools import cache

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.catalog.registry import register
from headway.catalog.sql import hashed, rounded, with_ctes
from headway.functions.core import half_even
from headway.operators import encode, explain, metrics, models, sampling
from headway.plans.staging import new_path, small_methods, stage
from headway.plans.warehouse import Warehouse

KEY = "incident_id"


def _regression_split(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    rows = sampling.split_random(w.regression_matrix, KEY)
    return rows.where("is_test = 0").drop("is_test"), rows.where("is_test = 1").drop("is_test")


@cache
def _classification_split(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    rows = sampling.split_stratified(w.classification_matrix, "label", KEY)
    with small_methods(rows.sparkSession):
        rows = stage(rows, "classification_split")
    return rows.where("is_test = 0").drop("is_test"), rows.where("is_test = 1").drop("is_test")


@cache
def _regression(w: Warehouse) -> models.Comparison:
    train, test = _regression_split(w)
    features = encode.feature_names(train)
    return models.compare(
        train, test, features, KEY, "regression", models.regressors(), folds=None
    )


@cache
def _balanced(w: Warehouse) -> DataFrame:
    train, _ = _classification_split(w)
    return metrics.with_class_weights(models.oversample(train, encode.feature_names(train), KEY), "label")


@cache
def _classification(w: Warehouse) -> models.Comparison:
    train, test = _classification_split(w)
    return models.compare(
        _balanced(w), test, encode.feature_names(train), KEY, "classification", models.classifiers(), folds=None
    )


@register("train_regression")
def train_regression(w: Warehouse):
    return _regression(w).results


@register("train_classification")
def train_classification(w: Warehouse):
    """Trained on oversampled rows, scored on untouched ones."""
    return _classification(w).results


@cache
def _cross_validated(w: Warehouse, task: str) -> list[tuple[str, str, float, float]]:
    """Five-fold scores of every model of a task: (task, model, mean, deviation).

    Classifiers see the oversampled rows, whose copies share the fold of the row they come from.
    """
    if task == "regression":
        train, _ = _regression_split(w)
        vectors, chosen = models.training_vectors(train, encode.feature_names(train)), models.regressors()
    else:
        features = encode.feature_names(_classification_split(w)[0])
        vectors, chosen = models.training_vectors(_balanced(w), features), models.classifiers()
    return [(task, name, *models.cross_validate(model, vectors, KEY, task)) for name, model in chosen.items()]


@register("cv_scores")
def cv_scores(w: Warehouse):
    schema = "task STRING, model STRING, cv_mean DOUBLE, cv_std DOUBLE"
    rows = [*_cross_validated(w, "regression"), *_cross_validated(w, "classification")]
    return w.trips.sparkSession.createDataFrame(rows, schema)


@register("cv_by_fold")
def cv_by_fold(w: Warehouse):
    """Five-fold scores of the classifiers, oversampled once beforehand (`cv_mean`, whose synthetic
    rows may lie near held-out ones) and inside each training part (`fold_mean`)."""
    train, _ = _classification_split(w)
    real, made = models.resampled_folds(train, encode.feature_names(train), KEY)
    once = {name: scores for _, name, *scores in _cross_validated(w, "classification")}
    rows = []
    for name, model in models.classifiers().items():
        rows.append((name, *once[name], *models.cross_validate_resampled(model, real, made)))
    schema = "model STRING, cv_mean DOUBLE, cv_std DOUBLE, fold_mean DOUBLE, fold_std DOUBLE"
    return w.trips.sparkSession.createDataFrame(rows, schema)


def _board(w: Warehouse, found: models.Comparison, score: str) -> DataFrame:
    cv = [(name, mean, std) for _, name, mean, std in _cross_validated(w, found.task)]
    schema = f"model STRING, cv_{score}_mean DOUBLE, cv_{score}_std DOUBLE"
    scores = w.trips.sparkSession.createDataFrame(cv, schema)
    return models.leaderboard(found.results.join(scores, "model"), found.task)


@register("leaderboard")
def leaderboard(w: Warehouse):
    return _board(w, _regression(w), "r2")


@register("classification_leaderboard")
def classification_leaderboard(w: Warehouse):
    return _board(w, _classification(w), "f1")


@register("best_model_report")
def best_model_report(w: Warehouse):
    """Scores per class of the best trained classifier on untouched rows."""
    _, test = _classification_split(w)
    scored = _classification(w).best.transform(test)
    return metrics.classification_report(scored, "label", "prediction")


@register("feature_importance")
def feature_importance(w: Warehouse):
    """The fifteen features that count most in the best model of each task."""
    parts = []
    for found in (_regression(w), _classification(w)):
        table = models.importances(w.trips.sparkSession, found.best, found.features)
        top = models.top_importances(table)
        parts.append(top.select(F.lit(found.task).alias("task"), F.lit(found.best_name).alias("model"), "feature", "importance"))
    return parts[0].unionByName(parts[1])


@register("model_roundtrip", with_ctes("SELECT count(*) AS records, CAST(0 AS BIGINT) AS changed FROM trips"))
def model_roundtrip(w: Warehouse):
    """Predictions of the best model before and after saving and loading it."""
    found = _regression(w)
    path = new_path(w.trips.sparkSession, "model")
    models.save(found.best, path)
    before = found.best.transform(w.regression_matrix).select(KEY, F.col("prediction").alias("before"))
    # Hinted because the many flat columns make Spark underrate the size of the two selected ones.
    both = models.load(path).transform(w.regression_matrix).join(before.hint("merge"), KEY)
    return both.agg(
        F.count("*").alias("records"),
        F.sum((F.col("prediction") != F.col("before")).cast("int")).alias("changed"),
    )


_LINE = ["hour", "passenger_count"]


@register(
    "shapley_linear",
    with_ctes(
        f"SELECT incident_id, 'hour' AS feature, {rounded('b1 * (hour - m1)', 6)} AS value FROM trips CROSS JOIN fitted "
        f"UNION ALL SELECT incident_id, 'passenger_count', {rounded('b2 * (passenger_count - m2)', 6)} FROM trips CROSS JOIN fitted",
        {
            "fitted": "SELECT m1, m2, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM "
            "(SELECT avg(hour) AS m1, avg(passenger_count) AS m2, var_pop(hour) AS s11, var_pop(passenger_count) AS s22, covar_pop(hour, passenger_count) AS s12, "
            "covar_pop(delay_minutes, hour) AS s1y, covar_pop(delay_minutes, passenger_count) AS s2y FROM trips) AS moments"
        },
    ),
)
def shapley_linear(w: Warehouse):
    """Every trip's exact attribution under a two-feature linear model."""
    rows = w.trips.select(KEY, *_LINE, F.col("delay_minutes").alias("label"))
    fitted = models.assembled(LinearRegression(solver="auto"), _LINE).fit(rows)
    weights = list(fitted.stages[-1].coefficients)
    values = explain.linear_attribution(rows, KEY, _LINE, weights, rows)
    return values.withColumn("value", half_even(F.col("value"), 6))


#: Rows of the sampled report, as usual; exact values explain every test row.
EXPLAINED = 500


def _groups(features: list[str]) -> dict[str, list[str]]:
    """One-hot columns of one category belong together."""
    groups: dict[str, list[str]] = {}
    for c in features:
        logical = next((k for k in encode.CATEGORIES if c.startswith(f"{k}_")), c)
        groups.setdefault(logical, []).append(c)
    return groups


@register("shapley_sampled")
def shapley_sampled(w: Warehouse):
    """Attributions of a sample by random walks, which work for any model."""
    found, (train, test) = _regression(w), _regression_split(w)
    rows = sampling.sample_rows(test, KEY, EXPLAINED)
    return explain.sampled_attribution(found.best, rows, KEY, _groups(found.features), train, permutations=4)


@cache
def _exact(w: Warehouse, task: str) -> DataFrame:
    """Exact attributions of every test row under the best model of a task."""
    found = _regression(w) if task == "regression" else _classification(w)
    train, test = _regression_split(w) if task == "regression" else _classification_split(w)
    groups = _groups(found.features)
    return stage(explain.exact_attribution(found.best, test, KEY, groups, found.features, train), "attributions")


@register("shapley_summary")
def shapley_summary(w: Warehouse):
    return explain.attribution_summary(_exact(w, "regression"))


@register("shapley_classifier")
def shapley_classifier(w: Warehouse):
    """Attributions of what the best classifier adds up to a delay."""
    return explain.attribution_summary(_exact(w, "classification"))


@register(
    "shapley_trees",
    with_ctes(
        f"SELECT count(*) AS explained, CAST(0 AS BIGINT) AS off FROM trips WHERE {hashed('incident_id', 42)} < 858993459.2"
    ),
)
def shapley_trees(w: Warehouse):
    """Test rows explained under the random forest, and those whose values don't add up to its
    prediction minus the base value."""
    found, (_, test) = _regression(w), _regression_split(w)
    forest = found.fitted["Random Forest"]
    values = explain.tree_attribution(forest, test, KEY, _groups(found.features), found.features)
    sums = values.groupBy(KEY).agg((F.sum("value") + F.first("base")).alias("total"))
    scores = forest.transform(test).select(KEY, explain.tree_score(forest).alias("score"))
    both = sums.join(scores.hint("merge"), KEY)
    off = F.sum((F.abs(F.col("total") - F.col("score")) > 1e-6).cast("bigint"))
    return both.agg(F.count("*").alias("explained"), off.alias("off"))
