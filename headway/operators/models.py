"""Training, cross-validation, comparison and storage of delay models."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.functions.core import HASH_RANGE, flag, portable_hash
from headway.operators import metrics
from headway.operators.balance import smote, smote_by_fold
from headway.plans.staging import new_path, small_methods, small_splits, stage

# Score columns, and whether more is better.
REGRESSION_SCORES = {"mae": False, "rmse": False, "r2": True, "cv_r2_mean": True}
CLASSIFICATION_SCORES = {"accuracy": True, "f1": True, "cv_f1_mean": True}

#: Bytes of staged vectors that one task of a fit takes. A fit keeps its rows unpacked, in 30 to 40
#: times the bytes, and reads them again for every level of every tree.
FIT_BYTES = 8 << 20
#: Folds fitted at the same time: most jobs of a fit are short and leave cores idle.
FOLDS_AT_ONCE = 3


@dataclass(frozen=True)
class Size:
    """Model sizes; the defaults are the full ones."""

    trees: int = 100
    tree_depth: int = 15
    boosting_rounds: int = 100
    boosting_depth: int = 6
    iterations: int = 1000
    seed: int = 42


def regressors(size: Size = Size()) -> dict[str, Estimator]:
    tree = {"maxDepth": size.tree_depth, "seed": size.seed}
    return {
        "Linear Regression": LinearRegression(solver="auto"),
        "Decision Tree": DecisionTreeRegressor(**tree),
        "Random Forest": RandomForestRegressor(numTrees=size.trees, **tree),
        "Gradient Boosting": GBTRegressor(
            maxIter=size.boosting_rounds, maxDepth=size.boosting_depth, seed=size.seed
        ),
    }


def classifiers(size: Size = Size()) -> dict[str, Estimator]:
    """Balanced class weights (column `weight`) for all but boosting, as in the usual set-up."""
    tree = {"maxDepth": size.tree_depth, "seed": size.seed, "weightCol": "weight"}
    return {
        "Logistic Regression": LogisticRegression(maxIter=size.iterations, weightCol="weight"),
        "Decision Tree": DecisionTreeClassifier(**tree),
        "Random Forest": RandomForestClassifier(numTrees=size.trees, **tree),
        "Gradient Boosting": GBTClassifier(
            maxIter=size.boosting_rounds, maxDepth=size.boosting_depth, seed=size.seed
        ),
    }


def with_fold(df: DataFrame, key: str, folds: int = 5, seed: int = 7) -> DataFrame:
    """Adds `fold`, decided by the key's hash, so folds survive repartitioning."""
    width = HASH_RANGE / folds
    return df.withColumn("fold", F.floor(portable_hash(F.col(key), seed) / width).cast("int"))


def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features")


def assembled(model: Estimator, features: list[str]) -> Pipeline:
    return Pipeline(stages=[assembler(features), model])


def training_vectors(train: DataFrame, features: list[str]) -> DataFrame:
    """Rows as vectors, staged: every fit of every model and fold reads them again."""
    rest = [c for c in train.columns if c not in features]
    vectors = assembler(features).transform(train).select(*rest, "features")
    with small_methods(train.sparkSession):
        return stage(vectors, "training_vectors", group=FIT_BYTES // 2)


def without_summary(model: Model) -> Model:
    """The model as it is after saving and loading, if it holds a summary of its training.

    A summary refers to the session, which tasks can't be sent once it has watched a query.
    """
    if isinstance(model, PipelineModel):
        return PipelineModel(stages=[without_summary(part) for part in model.stages])
    if not getattr(model, "hasSummary", False):
        return model
    path = new_path(SparkSession.active(), "fitted")
    model.write().save(path)
    return type(model).load(path)


def fit(model: Estimator, vectors: DataFrame) -> Model:
    with small_splits(vectors.sparkSession, FIT_BYTES):
        return without_summary(model.fit(vectors))


def _for_each_fold(spark: SparkSession, score: Callable[[int], float | None], folds: int) -> list[float]:
    """The scores of all folds in order, without those that have none."""
    # The setting is held here, as folds share the session.
    with small_splits(spark, FIT_BYTES), ThreadPoolExecutor(FOLDS_AT_ONCE) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(score), range(folds)))
    return [value for value in found if value is not None]


def cross_validate(
    model: Estimator, vectors: DataFrame, key: str, task: str, folds: int = 5
) -> tuple[float, float]:
    """Mean and population deviation of R2 (regression) or weighted F1 over the folds.

    `vectors` come from `training_vectors`.
    """
    evaluator = (
        RegressionEvaluator(metricName="r2")
        if task == "regression"
        else MulticlassClassificationEvaluator(metricName="f1")
    )
    folded = with_fold(vectors, key, folds)
    sizes = dict(folded.where("fold IS NOT NULL").groupBy("fold").count().collect())
    for fold in range(folds):
        if sizes.get(fold, 0) in (0, sum(sizes.values())):
            raise ValueError(f"fold {fold} holds no rows, or all of them")

    def score(fold: int) -> float:
        part, held = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        return evaluator.evaluate(fit(model, part).transform(held))

    return _mean_and_deviation(_for_each_fold(vectors.sparkSession, score, folds))


def _mean_and_deviation(scores: list[float]) -> tuple[float, float]:
    mean = sum(scores) / len(scores)
    return mean, (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5


def resampled_folds(
    train: DataFrame, features: list[str], key: str, folds: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Vectors for cross-validation that oversamples inside each training part.

    The first table holds the real rows with their `fold`; the second, for every `held_out` fold,
    synthetic rows made of the other folds' rows alone.
    """
    named = train.select(key, "label", *[F.col(f"`{c}`").cast("double").alias(c) for c in features])
    real = stage(with_fold(named, key, folds), "folded")
    made = smote_by_fold(real, "label", key, features)
    weight = F.lit(1.0).alias("weight")  # both classes of a training part have the same size
    vectors = assembler(features).transform(real).select(key, "fold", "label", "features", weight)
    extra = assembler(features).transform(made).select(key, "held_out", "label", "features", weight)
    group = FIT_BYTES // 2
    return stage(vectors, "fold_vectors", group=group), stage(extra, "made_vectors", group=group)


def cross_validate_resampled(
    model: Estimator, real: DataFrame, made: DataFrame, folds: int = 5
) -> tuple[float, float]:
    """Mean and population deviation of weighted F1 over folds of untouched rows.

    `real` and `made` come from `resampled_folds`: no row that a fold is scored on, nor one made of
    it, takes part in the fit.
    """
    evaluator = MulticlassClassificationEvaluator(metricName="f1")

    def score(fold: int) -> float | None:
        columns = ["label", "features", "weight"]
        part = real.where(F.col("fold") != fold).select(columns)
        part = part.unionByName(made.where(F.col("held_out") == fold).select(columns))
        held = real.where(F.col("fold") == fold)
        return None if held.isEmpty() else evaluator.evaluate(fit(model, part).transform(held))

    return _mean_and_deviation(_for_each_fold(real.sparkSession, score, folds))


def predictions(fitted: dict[str, Model], rows: DataFrame, features: list[str]) -> DataFrame:
    """The label and, in a column named after it, the prediction of every model, staged.

    One pass: the rows are read and made into vectors once for all models, not once for each.
    """
    scored = assembler(features).transform(rows).select("label", "features")
    for name, model in fitted.items():
        columns = {model.predictionCol: name}
        if model.hasParam("rawPredictionCol"):
            columns |= {model.rawPredictionCol: f"{name} raw", model.probabilityCol: ""}
        scored = model.copy(columns).transform(scored)
    with small_methods(rows.sparkSession):
        return stage(scored.select("label", *fitted), "predictions")


@dataclass
class Comparison:
    """Scores of every model, the fitted models and the name of the best one."""

    task: str
    results: DataFrame
    best_name: str
    fitted: dict[str, PipelineModel]
    features: list[str]

    @property
    def best(self) -> PipelineModel:
        return self.fitted[self.best_name]


def compare(
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    key: str,
    task: str,
    models: dict[str, Estimator],
    folds: int | None = 5,
) -> Comparison:
    """Fit every model, score it on the test rows and pick the best R2 or weighted F1.

    Scores are a handful of numbers per model; only they reach the driver.
    """
    score, by = (
        (metrics.regression_metrics, "r2")
        if task == "regression"
        else (metrics.classification_metrics, "f1")
    )
    vectors = training_vectors(train, features)
    fits = {name: fit(model, vectors) for name, model in models.items()}
    fitted = {name: PipelineModel(stages=[assembler(features), one]) for name, one in fits.items()}
    rows, predicted = [], predictions(fits, test, features)
    for name, model in models.items():
        scored = score(predicted, "label", name).first().asDict()
        if folds:
            mean, deviation = cross_validate(model, vectors, key, task, folds)
            scored |= {f"cv_{by}_mean": round(mean, 4), f"cv_{by}_std": round(deviation, 4)}
        rows.append({"model": name, **scored})
    best = max(rows, key=lambda row: row[by] if row[by] is not None else float("-inf"))["model"]
    columns = ", ".join(f"{c} {'string' if c == 'model' else 'double'}" for c in rows[0])
    results = train.sparkSession.createDataFrame([tuple(r.values()) for r in rows], columns)
    return Comparison(task, results, best, fitted, features)


def leaderboard(results: DataFrame, task: str) -> DataFrame:
    """The results with `best_{score}` flags for the models that lead in each score."""
    everyone = W.partitionBy()
    scores = REGRESSION_SCORES if task == "regression" else CLASSIFICATION_SCORES
    flags = {}
    for c, more in scores.items():
        if c in results.columns:
            top = (F.max(c) if more else F.min(c)).over(everyone)
            flags[f"best_{c}"] = flag(F.col(c) == top)
    return results.withColumns(flags)


def importances(spark: SparkSession, model: PipelineModel, features: list[str]) -> DataFrame:
    """What each feature counts in a model, largest first: impurity importances of trees, absolute
    coefficients of linear models."""
    last = model.stages[-1]
    found = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = [(name, abs(float(value))) for name, value in zip(features, found.toArray())]
    table = spark.createDataFrame(rows, "feature STRING, importance DOUBLE")
    return table.orderBy(F.desc("importance"), "feature")


def top_importances(table: DataFrame, n: int = 15) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature").limit(n)


def save(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def oversample(train: DataFrame, features: list[str], key: str) -> DataFrame:
    """Training rows with synthetic rows added until both classes have the same size.

    A synthetic row keeps the key of the row it was made from, so both fall into one fold; `copy`
    numbers them from 1 and is 0 for real rows, so (key, copy) identifies a row.
    """
    made = smote(train, "label", key, features)
    columns = [F.col(f"`{c}`").cast("double").alias(c) for c in features]
    real = train.select(key, F.lit(0).cast("bigint").alias("copy"), "label", *columns)
    synthetic = made.select(key, F.col("copy").cast("bigint"), "label", *columns)
    return stage(real.unionByName(synthetic), "oversampled")
