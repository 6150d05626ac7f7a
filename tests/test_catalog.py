"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

from headway.catalog import QUERIES, SQL, modelling, registry
from headway.catalog.check import compare, connect

SF_DIR = os.environ.get("HEADWAY_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_sql(spark, duck, key):
    ours = QUERIES[key](spark, SF_DIR).toArrow()
    assert compare(ours, duck.sql(SQL[key]).to_arrow_table()) == ""
    assert ours.num_rows > 0


# Full-size training is covered by planted data in test_models.
@pytest.mark.parametrize("key", ["welch_decision", "hw_grid_fit", "forecast"])
def test_runs_twice_alike(spark, key):
    first, second = (sorted(map(str, QUERIES[key](spark, SF_DIR).collect())) for _ in range(2))
    assert first == second and first


SIZES = {
    "DecisionTree": {"maxDepth": 15},
    "RandomForest": {"maxDepth": 15, "numTrees": 100},
    "GBT": {"maxDepth": 6, "maxIter": 100},
    "LogisticRegression": {"maxIter": 1000},
}


def test_training_queries_use_models_of_full_size(spark, monkeypatch):
    """What the queries hand over to be fitted and cross-validated, without fitting any of it."""

    class Rows:
        trips = type("Trips", (), {"sparkSession": spark})

    handed = {"compare": [], "cross_validate": [], "cross_validate_resampled": []}

    def noted(name, *models):
        handed[name] += models
        return 0.0, 0.0

    stubs = {
        "compare": lambda train, test, features, key, task, chosen, folds: noted("compare", *chosen.values()),
        "cross_validate": lambda model, *rest: noted("cross_validate", model),
        "cross_validate_resampled": lambda model, *rest: noted("cross_validate_resampled", model),
        "resampled_folds": lambda *rest: (None, None),
        "training_vectors": lambda *rest: None,
    }
    for name, stub in stubs.items():
        monkeypatch.setattr(modelling.models, name, stub)
    for name in ("_regression_split", "_classification_split", "_balanced"):
        monkeypatch.setattr(modelling, name, lambda w: (None, None))
    monkeypatch.setattr(modelling.encode, "feature_names", lambda rows: [])
    rows = Rows()
    monkeypatch.setattr(registry, "warehouse", lambda spark, sf_dir: rows)
    modelling._regression(rows), modelling._classification(rows)
    QUERIES["cv_scores"](spark, SF_DIR), QUERIES["cv_by_fold"](spark, SF_DIR)
    assert [len(models) for models in handed.values()] == [8, 8, 4]
    for model in (m for models in handed.values() for m in models):
        for kind, sizes in SIZES.items():
            if type(model).__name__.startswith(kind):
                assert {name: model.getOrDefault(name) for name in sizes} == sizes


def test_invariants_hold(spark):
    row = QUERIES["dataset_invariants"](spark, SF_DIR).first().asDict()
    assert set(row.values()) == {0}


def test_entry_and_registry_agree(spark):
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) <= set(driver.queries())
    result = driver.entry(spark)
    assert result.columns == ["weather_condition", "trips", "avg_delay", "delayed_share"]


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_filters_reach_the_scan_and_prune_months(spark):
    text = plan(QUERIES["filter_dashboard"](spark, SF_DIR))
    assert "PartitionFilters: [isnotnull(date_month" in text
    assert "GreaterThanOrEqual(date,1996-03-15)" in text and "In(borough" in text
    assert "Exchange hash" not in text and "BroadcastHashJoin" in text


def test_features_need_no_shuffle_of_the_facts(spark):
    text = plan(QUERIES["featured"](spark, SF_DIR))
    assert "Exchange hash" not in text and "SortMergeJoin" not in text


def test_large_day_tables_are_not_broadcast(spark):
    """Beyond the broadcast threshold the same query plans a sort-merge join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 1000)
    try:
        assert "SortMergeJoin" in plan(QUERIES["merged"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
