"""Balancing, series, models and attribution on planted data."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from headway.functions import smoothing
from headway.operators import balance, explain, models, sampling, scenario, series
from headway.plans import staging
from tests.conftest import values


def brute_force(points: dict[int, tuple], k: int) -> dict[int, list[int]]:
    found = {}
    for i, p in points.items():
        order = sorted(
            (round(sum((a - b) ** 2 for a, b in zip(p, q)), 6), j) for j, q in points.items() if j != i
        )
        found[i] = [j for _, j in order[:k]]
    return found


@pytest.mark.parametrize("copies", [0, 300])
def test_neighbours_equal_brute_force(spark, copies):
    """Clusters, ties, outliers and one vector that holds a third of all rows."""
    rng = np.random.default_rng(3)
    points = {i: tuple(map(float, p)) for i, p in enumerate(rng.integers(0, 12, (600, 3)))}
    points |= {600 + i: tuple(map(float, rng.normal(0, 200, 3).round(3))) for i in range(20)}
    points |= {1000 + i: (5.0, 5.0, 5.0) for i in range(copies)}
    df = spark.createDataFrame([(i, *p) for i, p in points.items()], "id long, a double, b double, c double")
    got = balance.neighbours(df.repartition(4), "id", ["a", "b", "c"])
    near = {r["id"]: [n["id"] for n in r["near"]] for r in got.collect()}
    assert near == brute_force(points, 5)


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(3)], "id long, a double")
    near = {r["id"]: [n["id"] for n in r["near"]] for r in balance.neighbours(df, "id", ["a"]).collect()}
    assert near == {0: [1, 2], 1: [0, 2], 2: [1, 0]}


def test_smote_balances_and_interpolates(spark):
    df = spark.range(0, 500).selectExpr("id", "CAST(id % 9 = 0 AS INT) AS y", "CAST(id AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b")
    made = balance.smote(df, "y", "id", ["a", "b"])
    rare = df.where("y = 1").count()
    assert made.count() == 500 - 2 * rare
    per_row = made.groupBy("id").count().agg(F.min("count"), F.max("count"), F.count("*")).first()
    assert per_row[1] - per_row[0] <= 1 and per_row[2] == rare
    ends = made.join(df.selectExpr("id AS neighbour", "a AS na"), "neighbour")
    outside = ends.where("a < least(id, na) - 1e-9 OR a > greatest(id, na) + 1e-9 OR neighbour = id")
    assert outside.count() == 0
    assert values(made) == values(balance.smote(df.repartition(3), "y", "id", ["a", "b"]))


def test_boxes_stay_bounded_whatever_the_data(spark, monkeypatch):
    """Small bounds force several rounds of cuts; equal values, a hot vector and one-hot rows included."""
    for name, value in {"BOX_POINTS": 40, "TASK_ROWS": 64, "SAMPLE": 64, "ROUND_DEPTH": 2}.items():
        monkeypatch.setattr(balance, name, value)
    rng = np.random.default_rng(9)
    points = {i: tuple(map(float, p)) for i, p in enumerate(rng.integers(0, 9, (400, 3)))}
    points |= {1000 + i: (0.0, 1.0, float(i)) for i in range(150)}  # a single dimension varies
    points |= {2000 + i: (5.0, 5.0, 5.0) for i in range(250)}
    columns = ["a", "b", "c"]
    df = spark.createDataFrame([(i, *p) for i, p in points.items()], "id long, a double, b double, c double").repartition(3)
    boxed = balance.boxed(balance.distinct_points(df, "id", columns, 6))
    sizes = [r["count"] for r in boxed.groupBy("box").count().collect()]
    assert max(sizes) <= 40 and sum(sizes) == len(set(points.values()))
    assert boxed.agg(F.max("box")).first()[0] > 4, "no box was split a second time"
    near = {r["id"]: [n["id"] for n in r["near"]] for r in balance.neighbours(df, "id", columns).collect()}
    assert near == brute_force(points, 5)


def test_neighbours_by_fold_leave_the_held_out_rows_aside(spark):
    rng = np.random.default_rng(2)
    points = {i: tuple(map(float, p)) for i, p in enumerate(rng.integers(0, 6, (180, 2)))}
    df = spark.createDataFrame([(i, *p, i % 3) for i, p in points.items()], "id long, a double, b double, fold int")
    found = balance.neighbours(df, "id", ["a", "b"], 5, "fold", [0, 1, 2]).collect()
    near = {(r["id"], r["view"]): [n["id"] for n in r["near"]] for r in found}
    assert len(near) == len(found) == 2 * 180
    for view in range(3):
        want = brute_force({i: p for i, p in points.items() if i % 3 != view}, 5)
        assert {i: near[i, view] for i in want} == want


def test_oversampling_by_fold_never_uses_held_out_rows(spark):
    df = spark.range(0, 400).selectExpr(
        "id", "CAST(id % 7 = 0 AS INT) AS label", "CAST(id % 23 AS DOUBLE) AS `a b`", "CAST(id % 11 AS DOUBLE) AS c"
    )
    folded = models.with_fold(df, "id").cache()
    made = balance.smote_by_fold(folded, "label", "id", ["a b", "c"]).cache()
    of = {r["id"]: r["fold"] for r in folded.collect()}
    rows = made.collect()
    assert {r["held_out"] for r in rows} == set(of.values())
    assert all(of[r["id"]] != r["held_out"] != of[r["neighbour"]] and r["id"] != r["neighbour"] for r in rows)
    assert len({(r["held_out"], r["id"], r["copy"]) for r in rows}) == len(rows)
    for held in set(of.values()):
        sizes = {v: folded.where(f"fold <> {held} AND label = {v}").count() for v in (0, 1)}
        assert made.where(f"held_out = {held}").count() == sizes[0] - sizes[1]
    alone = folded.where("fold <> 0").drop("fold")
    one = balance.smote(alone, "label", "id", ["a b", "c"])
    columns = ["id", "copy", "neighbour", "a b", "c"]
    key = [F.col(f"`{c}`") for c in columns]
    assert sorted(map(tuple, one.select(key).collect())) == sorted(map(tuple, made.where("held_out = 0").select(key).collect()))


def test_scores_by_fold_are_those_of_untouched_rows(spark):
    df = spark.range(0, 500).selectExpr(
        "id", "CAST(pmod(hash(id), 5) = 0 AS INT) AS label", "CAST(pmod(hash(id), 5) + id % 2 AS DOUBLE) AS a"
    )
    real, made = models.resampled_folds(df, ["a"], "id")
    model = models.classifiers(models.Size(iterations=20))["Logistic Regression"]
    mean, deviation = models.cross_validate_resampled(model, real, made)
    assert 0.8 < mean <= 1.0 and 0.0 <= deviation < 0.2
    assert real.count() == 500 and made.where("label = 0").count() == 0


def test_vectors_are_never_broadcast(spark):
    """Spark takes an array for one value, so it would send vectors of any number of rows to the driver."""
    df = spark.range(0, 300).selectExpr("id", "CAST(id % 9 = 0 AS INT) AS y", "CAST(id AS DOUBLE) AS a", "id % 3 AS f")
    made = [balance.smote(df.drop("f"), "y", "id", ["a"]), balance.smote_by_fold(df, "y", "id", ["a"], "f")]
    for plan in (d._jdf.queryExecution().sparkPlan().toString() for d in made):
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_background_rows_of_one_key_are_numbered_apart(spark):
    df = spark.createDataFrame([(i % 4, float(i)) for i in range(20)], "id long, a double").repartition(3)
    rows, places = explain.numbered(df, "id", 42)
    found = rows.join(places, "row").collect()
    assert sorted(r["partner"] for r in found) == list(range(1, 21))
    assert sorted(r["a"] for r in found) == [float(i) for i in range(20)]


def test_models_are_sent_to_tasks_of_a_session_that_watched_a_query(spark):
    """A training summary holds the session, which tasks can't be sent once it has observed."""
    seen = Observation("rows")
    assert spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).count() == 5 and seen.get["n"] == 5
    rows = spark.range(0, 200).selectExpr(
        "id", "CAST(id % 2 AS DOUBLE) AS label", "CAST(id % 2 + id % 5 AS DOUBLE) AS a", "1.0D AS weight"
    )
    logistic = {"Logistic Regression": models.classifiers(models.Size(iterations=20))["Logistic Regression"]}
    found = models.compare(rows, rows, ["a"], "id", "classification", logistic, folds=2)
    assert 0.5 < found.results.first()["cv_f1_mean"] <= 1.0
    assert found.best.transform(rows).where("prediction = label").count() > 100


def old_grid(values):
    """Squared error of the best triple of a grid from the usual start, as a plain loop."""
    best = np.inf
    for a in np.arange(0.1, 0.95, 0.1):
        for b in np.arange(0.1, 0.95, 0.1):
            for g in np.arange(0.1, 0.95, 0.1):
                first, second = values[:7], values[7:14]
                level, trend, season, error = first.mean(), (second.mean() - first.mean()) / 7, list(first - first.mean()), 0.0
                for i, v in enumerate(values):
                    seen = v - level - trend - season[i % 7]
                    error += seen**2
                    new = a * (v - season[i % 7]) + (1 - a) * (level + trend)
                    new_trend = b * (new - level) + (1 - b) * trend
                    season[i % 7] = g * (v - level - trend) + (1 - g) * season[i % 7]
                    level, trend = new, new_trend
                best = min(best, error)
    return best


@pytest.mark.parametrize("days, noise", [(14, 1.0), (30, 3.0), (90, 5.0)])
def test_estimated_starts_beat_the_grid_from_the_usual_start(days, noise):
    values = np.array(planted(days)) + np.random.default_rng(days).normal(0, noise, days)
    fit = smoothing.best_fit(values, 7)
    assert fit["sse"] <= old_grid(values)
    weights, start = np.array([fit[w] for w in ("alpha", "beta", "gamma")]), np.array(fit["start"])
    rng = np.random.default_rng(1)
    for _ in range(20):  # no other start does better with these weights
        assert smoothing.run(values, weights, start + rng.normal(0, 0.5, 9))[0] >= fit["sse"] - 1e-9
    assert smoothing.run(values, weights, start)[0] == pytest.approx(fit["sse"])


def test_gap_fill_uses_each_series_own_calendar(frame):
    d = lambda n: dt.date(2023, 1, n)
    df = frame([("a", d(1), 4.0), ("a", d(1), 6.0), ("a", d(4), 9.0), ("b", d(2), 1.0)], "s string, date date, delay_minutes double")
    assert values(series.daily_series(df, ["s"]), "s", "date", "value") == [
        ("a", d(1), 5.0), ("a", d(2), 5.0), ("a", d(3), 5.0), ("a", d(4), 9.0), ("b", d(2), 1.0),
    ]


def planted(days, level=30.0, slope=0.05):
    season = [0, 2, 4, 6, 4, -6, -10]
    return [level + slope * i + season[i % 7] for i in range(days)]


def test_holt_winters_continues_a_planted_series():
    fit = smoothing.best_fit(planted(140), 7)
    assert fit["steps"] == pytest.approx(planted(147)[140:], abs=0.3)
    noise = np.random.default_rng(0).normal(0, 1, 140)
    noisy = smoothing.best_fit(np.array(planted(140)) + noise, 7)
    assert noisy["steps"] == pytest.approx(planted(147)[140:], abs=2.5) and noisy["sse"] > fit["sse"]


def test_short_series_repeat_their_last_week():
    fit = smoothing.best_fit([1.0, 2.0, 3.0], 7)
    assert fit["steps"] == [1.0, 2.0, 3.0, 1.0, 2.0, 3.0, 1.0] and fit["alpha"] is None


def test_forecast_reanchors_and_applies_scenarios(frame):
    start = dt.date(2023, 1, 1)
    rows = [("s", start + dt.timedelta(i), v) for i, v in enumerate(planted(120))]
    daily = frame(rows, "borough string, date date, value double")
    fits = series.fit_holt_winters(daily, ["borough"])
    whole = series.with_history(daily, series.forecast_steps(fits, ["borough"]))
    moved = series.reanchor(whole, "2026-01-31", ["borough"])
    assert moved.where("type = 'Historical'").agg(F.max("date")).first()[0] == dt.date(2026, 1, 31)
    ahead = moved.where("type = 'Forecast'")
    assert values(ahead.agg(F.min("date"), F.max("date"))) == [(dt.date(2026, 2, 1), dt.date(2026, 2, 7))]
    what_if = scenario.scenarios(moved, ["borough"])
    assert what_if.count() == 12 * (90 + 7)
    storm = what_if.where("weather_scenario = 'Snowstorm' AND event_scenario = 'Parade / Marathon' AND type = 'Forecast'")
    plain = what_if.where("weather_scenario = 'Typical (No Change)' AND event_scenario = 'None' AND type = 'Forecast'")
    added = storm.alias("x").join(plain.alias("y"), "date").agg(F.min(F.col("x.delay") - F.col("y.delay"))).first()[0]
    assert added == pytest.approx(40.0)
    bands = scenario.forecast_summary(storm)
    assert {r["band"] for r in bands.collect()} <= {"severe", "elevated"} and bands.count() == 7


def test_rain_counts_only_in_wind(frame):
    schema = """precipitation_mm double, wind_speed_max_kmh double, weather_condition string, is_rush_hour int,
        is_weekend int, has_event int, total_attendance long"""
    rows = [(50.0, 20.0, "Clear", 0, 1, 0, 0), (10.0, 30.0, "Snow", 1, 0, 1, 99), (None, None, None, 0, 0, 0, 0)]
    got = scenario.predict(frame(rows, schema)).collect()
    assert got[0]["predicted_delay"] == 12.0 and got[0]["predicted_delayed"] == 0
    assert got[1]["predicted_delay"] == pytest.approx(20 + 8 + 3 + 15 + 10 + 1.5 * np.log1p(99))
    assert (got[2]["predicted_delay"], got[2]["predicted_category"]) == (20.0, "Moderate")


@pytest.fixture(scope="module")
def signal(spark):
    """y depends on a and b; c is noise."""
    df = spark.range(0, 3000).selectExpr(
        "id", "CAST(id % 10 AS DOUBLE) AS a", "CAST(id % 3 AS DOUBLE) AS b", "CAST(hash(id) % 100 AS DOUBLE) AS c"
    )
    return df.withColumn("label", F.col("a") * 2 + F.when(F.col("b") == 2, 10.0).otherwise(0.0))


SMALL = models.Size(trees=3, tree_depth=6, boosting_rounds=3, boosting_depth=4, iterations=20)


def test_regressors_beat_the_mean_and_survive_saving(signal, spark, tmp_path):
    train, test = (sampling.split_random(signal, "id").where(f"is_test = {i}") for i in (0, 1))
    found = models.compare(train, test, ["a", "b", "c"], "id", "regression", models.regressors(SMALL), folds=2)
    scores = {r["model"]: r for r in found.results.collect()}
    assert scores["Decision Tree"]["r2"] > 0.95 and scores["Gradient Boosting"]["r2"] > 0.8
    assert all(r["r2"] > 0.3 and r["cv_r2_std"] >= 0 for r in scores.values())
    board = models.leaderboard(found.results, "regression").where("best_r2 = 1").first()
    assert board["model"] == found.best_name
    table = models.importances(spark, found.fitted["Random Forest"], found.features)
    assert table.first()["importance"] > 0.3 and models.top_importances(table, 2).count() == 2
    models.save(found.best, str(tmp_path / "m"))
    again = models.load(str(tmp_path / "m")).transform(test)
    assert values(again, "id", "prediction") == values(found.best.transform(test), "id", "prediction")


def test_classifiers_on_oversampled_rows(signal):
    rows = signal.withColumn("label", (F.col("label") > 22).cast("double"))
    balanced = models.oversample(rows, ["a", "b", "c"], "id")
    assert balanced.groupBy("label").count().select("count").distinct().count() == 1
    assert balanced.select("id", "copy").distinct().count() == balanced.count()
    weighted = balanced.withColumn("weight", F.lit(1.0))
    found = models.compare(weighted, rows, ["a", "b", "c"], "id", "classification", models.classifiers(SMALL), folds=None)
    assert all(r["f1"] > 0.7 for r in found.results.collect())


def test_attributions_add_up_to_the_prediction(signal):
    model = models.assembled(models.regressors(SMALL)["Decision Tree"], ["a", "b", "c"]).fit(signal)
    rows = signal.where("id < 40")
    values_ = explain.sampled_attribution(model, rows, "id", {"ab": ["a", "b"], "c": ["c"]}, rows, permutations=3)
    total = values_.groupBy("id").agg(F.sum("value").alias("s"), F.count("*").alias("n"))
    assert total.where("n != 2").count() == 0 and total.count() == 40
    low, high = model.transform(rows).agg(F.min("prediction"), F.max("prediction")).first()
    off = model.transform(rows).join(total, "id").where(f"prediction - s < {low} - 1e-6 OR prediction - s > {high} + 1e-6")
    assert off.count() == 0
    top = explain.attribution_summary(values_).first()
    assert top["feature"] == "ab"


def test_rare_rows_get_distinct_copies(spark):
    """Two rare rows in 4,000: thousands of copies of each, under keys beyond 32 bits."""
    big = 9_200_000_000_000_000
    df = spark.range(0, 4000).selectExpr(f"id + {big} AS id", "CAST(id < 2 AS DOUBLE) AS label", "CAST(id AS DOUBLE) AS a")
    balanced = models.oversample(df, ["a"], "id")
    assert balanced.count() == balanced.select("id", "copy").distinct().count() == 7996
    folds = models.with_fold(balanced, "id").groupBy("id").agg(F.countDistinct("fold").alias("n"))
    assert folds.where("n > 1").count() == 0


def test_every_row_is_explained_against_the_whole_background(signal):
    model = models.assembled(models.regressors(SMALL)["Linear Regression"], ["a", "b", "c"]).fit(signal)
    credits = explain.sampled_attribution(model, signal, "id", {"a": ["a"], "b": ["b"], "c": ["c"]}, signal, permutations=2)
    weights = dict(zip("abc", model.stages[-1].coefficients))
    assert credits.select("id").distinct().count() == 3000
    means = signal.agg(*[F.avg(c).alias(c) for c in "abc"]).first()
    for name in "ab":  # each credit is unbiased, so their mean over all rows is near the exact one
        exact = signal.agg(F.avg(F.abs((F.col(name) - means[name]) * float(weights[name])))).first()[0]
        found = credits.where(F.col("feature") == name).agg(F.avg("value"), F.avg(F.abs("value"))).first()
        assert abs(found[0]) < 0.35 and found[1] >= exact * 0.9


def test_classifiers_are_explained_by_their_probability(signal):
    rows = signal.withColumn("label", (F.col("label") > 22).cast("double")).withColumn("weight", F.lit(1.0))
    model = models.assembled(models.classifiers(SMALL)["Logistic Regression"], ["a", "b"]).fit(rows)
    some = rows.where("id < 60")
    total = explain.sampled_attribution(model, some, "id", {"a": ["a"], "b": ["b"]}, rows, permutations=2)
    sums = total.groupBy("id").agg(F.sum("value").alias("s")).agg(F.min("s"), F.max("s"), F.countDistinct("s")).first()
    assert -1 <= sums[0] < 0 < sums[1] <= 1 and sums[2] > 3


def test_linear_attribution_is_exact(frame):
    rows = frame([(1, 1.0, 5.0), (2, 3.0, 9.0)], "id int, a double, b double")
    got = explain.linear_attribution(rows, "id", ["a", "b"], [2.0, -1.0], rows)
    assert values(got) == [(1, "a", -2.0), (1, "b", 2.0), (2, "a", 2.0), (2, "b", -2.0)]


def test_all_models_are_scored_in_one_pass(spark):
    """Test rows are read once, and every model predicts what it predicts on its own."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(value):
        seen.add(1)
        return value

    rows = spark.range(0, 400).selectExpr("id", "CAST(id % 20 AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b", "1.0D AS weight")
    for task, chosen in (("regression", models.regressors(SMALL)), ("classification", models.classifiers(SMALL))):
        label = "a * 3 + b" if task == "regression" else "CAST(a + b > 13 AS DOUBLE)"
        train = rows.withColumn("label", F.expr(label))
        test = train.withColumn("a", counted.asNondeterministic()("a"))
        seen.value = 0
        found = models.compare(train, test, ["a", "b"], "id", task, chosen, folds=None)
        assert seen.value == 400
        together = models.predictions({name: one.stages[-1] for name, one in found.fitted.items()}, train, ["a", "b"])
        for name, one in found.fitted.items():
            assert values(one.transform(train).select("label", "prediction")) == values(together.select("label", name))


def test_wide_vectors_are_written_by_small_methods(spark, monkeypatch):
    """The JVM compiles no method as large as the one that 95 columns make."""
    seen = []
    monkeypatch.setattr(models, "stage", lambda df, name, **more: seen.append((name, spark.conf.get(staging._METHOD))) or df)
    usual = spark.conf.get(staging._METHOD)
    train = spark.range(0, 9).selectExpr("id", "CAST(id % 3 = 0 AS DOUBLE) AS label", "CAST(id AS DOUBLE) AS a")
    models.training_vectors(train, ["a"])
    small = str(staging.METHOD_BYTES)
    assert seen == [("training_vectors", small)] and spark.conf.get(staging._METHOD) == usual != small
