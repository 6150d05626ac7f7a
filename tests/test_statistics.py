"""Statistics, ranking, encoding and scores against independent computations."""

import math
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from headway.functions import student
from headway.functions.core import nan_to_null, portable_hash
from headway.operators import encode, metrics, sampling, stats
from tests.conftest import values


def test_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(1)
    data = pd.DataFrame(rng.normal(1e6, 3, (400, 3)), columns=list("abc"))
    data["c"] += data["a"]
    data.loc[::3, "b"] = None
    data.loc[::5, "c"] = None
    data["k"] = 4.0
    df = spark.createDataFrame(data).withColumn("b", nan_to_null(F.col("b"))).repartition(4)
    got = {(r[0], r[1]): r[2] for r in stats.correlations(df, list("abck")).collect()}
    want = data.corr()
    for x in "abc":
        for y in "abc":
            assert got[x, y] == pytest.approx(want.loc[x, y], abs=1e-9)
    assert got["a", "k"] is None and got["k", "k"] is None and len(got) == 16


def test_box_stats_leave_outliers_out(frame):
    rows = [("a", float(v)) for v in (1, 2, 3, 4, 5, 100)] + [("b", 7.0), (None, 1.0), ("a", None)]
    got = {r["g"]: r for r in stats.box_stats(frame(rows, "g string, delay_minutes double"), "g").collect()}
    a = got["a"]
    assert (a["q1"], a["median"], a["q3"]) == (2.25, 3.5, 4.75)
    assert (a["whisker_low"], a["whisker_high"], a["outliers"], a["records"]) == (1.0, 5.0, 1, 6)
    assert got["b"]["median"] == 7.0 and got[None]["records"] == 1


def test_histogram_keeps_empty_bins_and_the_maximum(frame):
    df = frame([(0.0,), (10.0,), (10.0,), (4.9,)], "delay_minutes double")
    got = [r["records"] for r in stats.histogram(df, bins=5).orderBy("bin").collect()]
    assert got == [1, 0, 1, 0, 2]
    flat = frame([(3.0,), (3.0,)], "delay_minutes double")
    assert sum(r["records"] for r in stats.histogram(flat, bins=5).collect()) == 2


def test_density_integrates_to_less_than_one_and_peaks_at_the_mode(frame):
    df = frame([(v,) for v in [1.0] * 50 + [9.0] * 10], "delay_minutes double")
    curve = stats.density(df).orderBy("point").collect()
    assert len(curve) == 200 and curve[0]["x"] == 1.0 and curve[-1]["x"] == 9.0
    assert max(curve, key=lambda r: r["density"])["x"] < 2.0


def test_trend_line_without_spread_is_null(frame):
    rows = [("a", 1.0, 3.0), ("a", 2.0, 5.0), ("b", 1.0, 3.0), ("b", 1.0, 4.0), ("c", 1.0, None)]
    got = {r["weather_condition"]: r for r in stats.trend_lines(frame(rows, "weather_condition string, x double, delay_minutes double"), ["x"]).collect()}
    assert (got["a"]["slope"], got["a"]["intercept"], got["a"]["r2"]) == (2.0, 1.0, 1.0)
    assert got["b"]["slope"] is None and got["c"]["points"] == 0


def test_empty_selection_gives_nulls_not_errors(frame):
    df = frame([("2023-01-01", 1.0, 1, 1, 1)], "date string, delay_minutes double, is_delayed int, weather_severity int, has_event int").where("false")
    assert stats.overview(df).first()["avg_delay"] is None
    assert stats.summary(df).first()["mean"] is None
    assert stats.welch(df, F.col("weather_severity") >= 3).first()["t"] is None


def test_welch_matches_the_textbook_and_decides(frame):
    a, b = [30.0, 41.0, 28.5, 36.0, 39.5], [20.0, 22.5, 19.0, 25.0, 21.0, 30.0]
    df = frame([(1, v) for v in a] + [(0, v) for v in b] + [(None, 5.0)], "s int, delay_minutes double")
    row = stats.decide(stats.welch(df, F.col("s") == 1)).first()
    va, vb = statistics.variance(a) / 5, statistics.variance(b) / 6
    assert row["t"] == pytest.approx((statistics.mean(a) - statistics.mean(b)) / math.sqrt(va + vb))
    assert row["degrees"] == pytest.approx((va + vb) ** 2 / (va**2 / 4 + vb**2 / 5))
    assert row["reject"] and 0.001 < row["p_value"] < 0.01


@pytest.mark.parametrize(
    "t, degrees, p",
    [(0.0, 5, 1.0), (2.570582, 5, 0.05), (12.7062, 1, 0.05), (1.959964, 1e7, 0.05), (3.0, 2, 0.0954659)],
)
def test_t_tail(t, degrees, p):
    assert student.two_sided(t, degrees) == pytest.approx(p, rel=1e-4)


def test_missing_weekday_is_null(frame):
    df = frame([("Monday", 2.0), ("Monday", 4.0)], "day_of_week string, delay_minutes double")
    got = stats.weekday_means(df).orderBy("day_of_week_num").collect()
    assert [r["avg_delay_minutes"] for r in got] == [3.0] + [None] * 6


def test_filters(frame):
    df = frame(
        [("2023-01-01", "x", "Rain", 1), ("2023-01-02", "y", None, 0), ("2023-01-03", "x", "Snow", 0)],
        "d string, borough string, weather_condition string, is_weekend int",
    ).withColumn("date", F.col("d").cast("date"))
    count = lambda **f: stats.select_rows(df, **f).count()
    assert count() == 3 and count(boroughs=[], weather=[]) == 3
    assert count(first="2023-01-02", last="2023-01-03") == 2
    assert count(boroughs=["x"], weather=["Rain", "Snow"]) == 2
    assert count(day_type="weekday") == 2 and count(day_type="weekend") == 1


def test_overview_counts_records_and_days(frame):
    df = frame(
        [("2023-01-01", 10.0, 0, 3, 1), ("2023-01-01", 20.0, 1, 3, 1), ("2023-01-02", 30.0, 1, None, 0)],
        "date string, delay_minutes double, is_delayed int, weather_severity int, has_event int",
    )
    row = stats.overview(df).first()
    assert (row["bad_weather_records"], row["bad_weather_days"]) == (2, 1)
    assert (row["event_records"], row["event_days"], row["avg_delay"]) == (2, 1, 20.0)


def test_capping_breaks_ties_by_value_and_sends_null_to_other(frame):
    rows = [(v,) for v in "aabbcdefghij"] + [(None,)]
    got = encode.cap_levels(frame(rows, "run_type string"), ["run_type"], 3)
    assert values(stats.value_counts(got, "run_type")) == [("Other", 8), ("a", 2), ("b", 2), ("c", 1)]


def test_one_hot_keeps_declared_levels_and_zeroes_null(frame):
    df = frame([(1, "Drizzle", "x"), (2, None, "y")], "id int, rain_category string, season string")
    got = encode.one_hot(df, ["rain_category", "season", "absent"])
    assert [c for c in got.columns if c.startswith("rain")] == [
        f"rain_category_{n}" for n in ("No_Rain", "Drizzle", "Light_Rain", "Moderate_Rain", "Heavy_Rain")
    ]
    null_row = got.where("id = 2").first().asDict()
    assert sum(v for k, v in null_row.items() if k.startswith("rain")) == 0
    assert null_row["season_y"] == 1 and null_row["season_x"] == 0


def test_label_codes_sort_null_as_text(spark):
    df = spark.range(0, 5000).selectExpr("CASE WHEN id % 100 = 7 THEN NULL ELSE concat('r', id % 977) END AS route_id")
    codes = {r["value"]: r["code"] for r in encode.label_codes(df, "route_id").collect()}
    want = sorted({"nan"} | {f"r{i % 977}" for i in range(5000) if i % 100 != 7})
    assert codes == {v: i for i, v in enumerate(want)}


def test_model_matrix_drops_targets_and_ids(frame):
    df = frame(
        [(1, 5.0, 1, float("nan"), None, "t", 1)],
        "incident_id long, delay_minutes double, is_delayed int, rain double, n int, date string, delay_category_Major int",
    )
    got = encode.model_matrix(df, "regression")
    assert got.columns == ["incident_id", "rain", "n", "label"] and values(got) == [(1, 0.0, 0, 5.0)]
    assert encode.model_matrix(df, "classification").first()["label"] == 1.0


def test_stratified_split_is_exact_and_stable(spark):
    df = spark.range(0, 4001).selectExpr("id", "CAST(id % 10 = 3 AS INT) AS y")
    tests = [
        values(sampling.split_stratified(df.repartition(n), "y", "id").where("is_test = 1"), "id")
        for n in (1, 5)
    ]
    assert tests[0] == tests[1]
    ids = [i for (i,) in tests[0]]
    assert sum(i % 10 == 3 for i in ids) == 80 and sum(i % 10 != 3 for i in ids) == math.ceil(0.2 * 3601)


def test_stratified_split_does_not_shuffle_rows_by_class(spark):
    df = spark.range(0, 1000).selectExpr("id", "CAST(id % 2 AS INT) AS y", "uuid() AS payload")
    text = sampling.split_stratified(df, "y", "id")._jdf.queryExecution().executedPlan().toString()
    outer = text.split("Subquery")[0]
    assert "Join" not in text and "Exchange" not in outer


def test_seeds_order_keys_independently(spark):
    df = spark.range(0, 20000).select(*[portable_hash(F.col("id"), s).alias(f"h{s}") for s in (7, 42, 43)])
    for a, b in (("h7", "h42"), ("h42", "h43")):
        assert abs(df.select(F.corr(a, b)).first()[0]) < 0.02


def test_class_weights(frame):
    df = frame([(0,), (0,), (0,), (1,)], "y int")
    assert values(metrics.class_weights(df, "y"), "y", "weight") == [(0, 4 / 6), (1, 2.0)]
    assert values(metrics.with_class_weights(df, "y").distinct()) == [(0, 4 / 6), (1, 2.0)]


def test_scores_of_an_absent_class_are_zero(frame):
    df = frame([(0, 0), (0, 0), (1, 0), (2, 3)], "y int, p int")
    report = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert (report[1]["precision"], report[1]["recall"], report[3]["support"]) == (0.0, 0.0, 0)
    assert (report[0]["precision"], report[0]["recall"]) == (0.6667, 1.0)
    row = metrics.classification_metrics(df, "y", "p").first()
    assert row["accuracy"] == 0.5 and row["recall"] == 0.5


def test_regression_scores(frame):
    row = metrics.regression_metrics(frame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double"), "y", "p").first()
    assert (row["mae"], row["rmse"], row["r2"]) == (0.6667, 0.8165, 0.75)


def test_levels_with_dots_and_back_ticks_reach_a_model(frame):
    from headway.operators import models

    rows = [(i, "Won`t Start" if i % 3 else "St. John", "St_ John" if i % 2 else "St. John", float(i % 3)) for i in range(30)]
    df = frame(rows, "incident_id long, delay_reason string, borough string, delay_minutes double").withColumn("is_delayed", F.lit(0))
    matrix = encode.model_matrix(encode.encode(df), "regression")
    names = encode.feature_names(matrix)
    assert {"borough_St_ John", "borough_St_ John_2", "delay_reason_Won_t Start"} <= set(names)
    fitted = models.assembled(models.regressors(models.Size(trees=2))["Linear Regression"], names).fit(matrix)
    assert fitted.transform(matrix).count() == 30


def test_encoding_levels_equal_capping_then_listing(frame):
    rows = [("abcde"[i % 5] if i % 7 else None, "x" if i % 2 else "y") for i in range(60)]
    df = frame(rows, "borough string, season string")
    kept, levels = encode.encoding_levels(df, n=3)
    capped = encode.cap_levels(df, n=3)
    assert kept == encode.top_levels(df, ["borough"], 3)
    assert levels == encode.levels_of(capped, ["season", "borough"])


def test_hash_uses_the_high_bits_of_a_key(spark):
    df = spark.range(0, 4096).selectExpr("7 + shiftleft(id, 32) AS id")
    assert df.select(portable_hash(F.col("id"), 42).alias("h")).distinct().count() == 4096


def test_correlations_leave_out_nulls_by_pair(frame):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 1.0, 5.0), (float("nan"), 9.0, 5.0)]
    got = {(r[0], r[1]): r[2] for r in stats.correlations(frame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "c"] is None and got["c", "c"] is None
    assert abs(got["a", "b"] - np.corrcoef([1, 2, 4], [2, 4, 1])[0, 1]) < 1e-12 and abs(got["a", "a"] - 1) < 1e-12


def test_any_measure_has_exact_medians_and_a_close_density(spark):
    df = spark.range(0, 5000).selectExpr("id % 3 AS g", "CAST(pmod(hash(id), 100000) AS DOUBLE) / 7 AS y")
    frame = df.toPandas()
    got = {r["g"]: r["median"] for r in stats.labelled_summary(df, "g", {0: "0", 1: "1", 2: "2"}, "y").collect()}
    assert got == {str(k): v for k, v in frame.groupby("g")["y"].median().items()}
    assert stats.summary(df, "y").first()["median"] == frame["y"].median()
    curve = stats.density(df, "y", points=50).orderBy("point").toPandas()
    width = frame["y"].std() * len(frame) ** -0.2
    exact = np.exp(-0.5 * ((curve["x"].to_numpy()[:, None] - frame["y"].to_numpy()) / width) ** 2).mean(axis=1) / (width * np.sqrt(2 * np.pi))
    assert np.abs(curve["density"] - exact).max() < exact.max() * 1e-3


def test_correlations_of_the_star_equal_those_of_the_joined_rows(spark):
    rng = np.random.default_rng(8)
    days = pd.DataFrame({"date": range(40), "rain": rng.normal(1e9, 0.5, 40), "flag": 1, "wind": rng.normal(0, 3, 40)})
    days.loc[::7, "rain"], days.loc[::5, "flag"] = None, None
    rows = pd.DataFrame({"date": rng.integers(0, 44, 3000), "delay": rng.normal(50, 9, 3000), "hour": rng.integers(0, 24, 3000)})
    rows.loc[::6, "delay"] = None
    joined = rows.merge(days, on="date", how="left")
    double = lambda df, *cs: df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in cs})
    facts = double(spark.createDataFrame(rows), "delay").repartition(7)
    far = double(spark.createDataFrame(days), "rain", "flag", "wind")
    columns = ["rain", "delay", "flag", "hour", "wind"]
    star = {(r[0], r[1]): r[2] for r in stats.correlations(facts, columns, far).collect()}
    flat = double(spark.createDataFrame(joined), *columns).repartition(5)
    flat = {(r[0], r[1]): r[2] for r in stats.correlations(flat, columns).collect()}
    want = joined.assign(rain=joined["rain"] - 1e9)[columns].corr()  # exact, and easier on pandas
    assert star.keys() == flat.keys() and len(star) == 25
    for (a, b), value in star.items():
        if "flag" in (a, b):
            assert value is None and flat[a, b] is None  # constant wherever it is known
        else:
            assert value == pytest.approx(want.loc[a, b], abs=1e-8) and flat[a, b] == pytest.approx(value, abs=1e-8)


def test_constants_stay_constant_over_many_partitions(spark):
    df = spark.range(0, 3000).selectExpr("0.1D + 0.2D AS x", "CAST(id % 7 AS DOUBLE) AS y", "'g' AS g", "id % 2 AS s").repartition(16)
    line = stats.trend_lines(df, ["x"], "g", "y").first()
    assert line["slope"] is None and line["r2"] is None and line["points"] == 3000
    flat = stats.trend_lines(df, ["y"], "g", "x").first()
    assert flat["slope"] == 0.0 and flat["r2"] == 1.0 and flat["intercept"] == pytest.approx(0.3)
    found = {(r[0], r[1]): r[2] for r in stats.correlations(df, ["x", "y"]).collect()}
    assert found["x", "y"] is None and found["x", "x"] is None and found["y", "y"] == pytest.approx(1.0)
    assert stats.welch(df, F.col("s") == 1, "x").first()["t"] is None
    assert stats.density(df, "x").where("density IS NOT NULL").count() == 0


@pytest.mark.parametrize("accuracy", [20, 300, 10_000])
def test_two_scans_give_exact_quantiles_and_boxes(spark, accuracy):
    rng = np.random.default_rng(5)
    data = {"a": rng.normal(0, 1, 4000), "b": rng.lognormal(0, 2, 999), "c": np.array([3.5]), None: np.arange(50.0)}
    data["a"][::3] = 7.25  # one value holds a third of a group
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("empty", None)]
    df = spark.createDataFrame(rows, "g string, y double").repartition(5)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["g"]: r for r in stats.group_quantiles(df, "g", "y", shares, accuracy).collect()}
    boxes = {r["g"]: r for r in stats.box_stats(df, "g", "y", accuracy=accuracy).collect()}
    assert set(got) == set(boxes) == set(data)
    for g, vs in data.items():
        assert got[g]["q"] == pytest.approx(list(np.quantile(vs, shares)), rel=1e-12, abs=1e-12)
        assert got[g]["mean"] == pytest.approx(vs.mean()) and got[g]["records"] == len(vs)
        q1, median, q3 = np.quantile(vs, [0.25, 0.5, 0.75])
        inner = vs[(vs >= q1 - 1.5 * (q3 - q1)) & (vs <= q3 + 1.5 * (q3 - q1))]
        box = [boxes[g][c] for c in ("q1", "median", "q3", "whisker_low", "whisker_high", "outliers")]
        assert box == pytest.approx([q1, median, q3, inner.min(), inner.max(), len(vs) - len(inner)])


def test_brackets_keep_a_small_share_of_a_large_group(spark):
    df = spark.range(0, 200_000).selectExpr("1 AS g", "CAST(pmod(hash(id), 1000000007) AS DOUBLE) AS y")
    brackets = stats._brackets(df, "g", "y", [0.5], 500)
    kept = stats._cells(df, "g", "y", brackets).where("value IS NOT NULL")
    assert 0 < kept.count() < 200_000 * 8 / 500


def test_density_keeps_the_digits_of_large_values(spark):
    v = np.array([1e9 + 0.01 * i for i in range(5)])
    df = spark.createDataFrame([(float(x),) for x in v], "y double").repartition(3)
    curve = stats.density(df, "y", points=5).orderBy("point").toPandas()
    width = v.std(ddof=1) * 5**-0.2
    exact = [np.exp(-0.5 * ((x - v) / width) ** 2).mean() / (width * math.sqrt(2 * math.pi)) for x in np.linspace(v[0], v[-1], 5)]
    assert list(curve["density"]) == pytest.approx(exact, rel=1e-6)


def test_density_of_far_apart_values_reaches_only_near_points(spark):
    rows = [(float(i % 10) / 10,) for i in range(20_000)] + [(1e6,)]
    df = spark.createDataFrame(rows, "y double").repartition(4)
    curve = stats.density(df, "y", points=50).orderBy("point").collect()
    frame = np.array([r[0] for r in rows])
    width = frame.std(ddof=1) * len(frame) ** -0.2
    for r in curve:
        exact = np.exp(-0.5 * ((r["x"] - frame) / width) ** 2).mean() / (width * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(exact, rel=1e-3, abs=1e-12)
