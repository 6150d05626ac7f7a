"""Encoding, splitting, weighting and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.catalog.registry import register
from headway.catalog.sql import hashed, rounded, with_ctes
from headway.functions.core import half_even, of_type
from headway.operators import encode, metrics, sampling, scenario
from headway.plans.warehouse import Warehouse

_TOP = {
    f"top_{c}": f"SELECT {c} FROM trips GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 8"
    for c in encode.CAPPED
}
_CAPPED = {
    **_TOP,
    "capped": "SELECT featured.* EXCLUDE (borough, delay_reason, run_type), "
    + ", ".join(
        f"CASE WHEN {c} IN (SELECT {c} FROM top_{c}) THEN {c} ELSE 'Other' END AS {c}"
        for c in encode.CAPPED
    )
    + " FROM featured",
}


@register("topk_other", with_ctes("SELECT incident_id, borough, delay_reason, run_type FROM capped", _CAPPED))
def topk_other(w: Warehouse):
    return encode.cap_levels(w.trips).select("incident_id", *encode.CAPPED)


@register(
    "one_hot",
    with_ctes(
        " UNION ALL ".join(
            f"SELECT incident_id, concat('{c}_', {c}) AS feature FROM capped WHERE {c} IS NOT NULL"
            for c in encode.CATEGORIES
        ),
        _CAPPED,
    ),
)
def one_hot(w: Warehouse):
    """The 0/1 columns depend on the data, so the query lists the ones of every row."""
    rows = w.featured.select("incident_id", *encode.CATEGORIES)
    kept, levels = encode.encoding_levels(rows)
    encoded = encode.one_hot(encode.cap_levels(rows, kept=kept), levels=levels)
    names = [c for c in encoded.columns if c != "incident_id"]
    ones = F.array_compact(F.array(*[F.when(F.col(f"`{c}`") == 1, F.lit(c)) for c in names]))
    return encoded.select("incident_id", F.explode(ones).alias("feature"))


@register(
    "label_encode",
    with_ctes(
        "SELECT incident_id, route_id, code AS route_id_encoded FROM trips JOIN codes ON coalesce(route_id, 'nan') = value",
        {
            "codes": "SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code FROM "
            "(SELECT DISTINCT coalesce(route_id, 'nan') AS value FROM trips) AS v"
        },
    ),
)
def label_encode(w: Warehouse):
    codes = encode.label_codes(w.trips, "route_id")
    rows = encode.label_encode(w.trips, "route_id", codes)
    return rows.select("incident_id", "route_id", "route_id_encoded")


_INTEGERS = [
    "hour", "passenger_count", "is_weekend", "is_rush_hour", "weather_severity", "event_count",
    "total_attendance", "max_attendance", "max_impact_score", "has_high_impact", "has_event",
    "month", "day_of_year", "week_of_year", "day_of_week_num", "is_extreme_weather",
    "is_rainy_day", "is_snowy_day", "has_large_event", "has_multiple_events",
]
_DOUBLES = [
    "temperature_max_c", "temperature_min_c", "temperature_mean_c", "apparent_temp_max_c",
    "apparent_temp_min_c", "precipitation_mm", "rain_mm", "snowfall_cm", "precipitation_hours",
    "wind_speed_max_kmh", "wind_gusts_max_kmh", "wind_direction_dominant", "solar_radiation_mj",
    "evapotranspiration_mm", "prev_day_avg_delay", "rolling_3d_avg_delay", "rolling_7d_avg_delay",
    "delay_trend_3d", "hour_sin", "hour_cos", "month_sin", "month_cos", "weather_severity_index",
    "temp_range_c", "wind_chill_effect", "event_impact_score",
]


@register(
    "model_matrix",
    with_ctes(
        "SELECT incident_id, CAST(is_delayed AS DOUBLE) AS label, "
        + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _INTEGERS)
        + ", "
        + ", ".join(f"{rounded(f'coalesce({c}, 0)', 6)} AS {c}" for c in _DOUBLES)
        + " FROM featured"
    ),
)
def model_matrix(w: Warehouse):
    matrix = encode.model_matrix(w.featured, "classification")
    doubles = of_type(matrix.schema, T.DoubleType)
    return matrix.withColumns({c: half_even(F.col(c), 6) for c in doubles})


@register(
    "split_random",
    with_ctes(
        f"SELECT incident_id, CAST({hashed('incident_id', 42)} < 0.2e0 * 4294967296 AS INTEGER) AS is_test FROM trips"
    ),
)
def split_random(w: Warehouse):
    return sampling.split_random(w.trips, "incident_id").select("incident_id", "is_test")


@register(
    "split_stratified",
    with_ctes(
        "SELECT incident_id, is_delayed, CAST(row_number() OVER (PARTITION BY is_delayed ORDER BY "
        f"{hashed('incident_id', 42)}, incident_id) <= ceil(0.2e0 * count(*) OVER (PARTITION BY is_delayed)) AS INTEGER) AS is_test FROM trips"
    ),
)
def split_stratified(w: Warehouse):
    rows = w.trips.select("incident_id", "is_delayed")
    return sampling.split_stratified(rows, "is_delayed", "incident_id")


@register(
    "class_weights",
    with_ctes(
        "SELECT is_delayed, count(*) AS records, (SELECT count(*) FROM trips) / (count(*) OVER () * count(*)) AS weight FROM trips GROUP BY is_delayed"
    ),
)
def class_weights(w: Warehouse):
    return metrics.class_weights(w.trips, "is_delayed")


PREDICTED = {
    "predicted": """SELECT *, greatest(20e0
        + CASE WHEN wind_speed_max_kmh > 20 THEN coalesce(precipitation_mm, 0) * 0.8e0 + (wind_speed_max_kmh - 20) * 0.3e0 ELSE 0 END
        + CASE WHEN weather_condition IN ('Heavy Rain', 'Snow') THEN 15 WHEN weather_condition = 'Rain' THEN 8 ELSE 0 END
        + CASE WHEN is_rush_hour = 1 THEN 10 ELSE 0 END - CASE WHEN is_weekend = 1 THEN 8 ELSE 0 END
        + CASE WHEN has_event = 1 THEN ln(1 + total_attendance) * 1.5e0 ELSE 0 END, 0) AS predicted_delay FROM merged""",
    "judged": """SELECT *, CAST(predicted_delay > 15 AS INTEGER) AS predicted_delayed,
        CASE WHEN predicted_delay <= 15 THEN 'Minor' WHEN predicted_delay <= 30 THEN 'Moderate'
          WHEN predicted_delay <= 60 THEN 'Major' ELSE 'Severe' END AS predicted_category FROM predicted""",
}


@register(
    "scenario_predict",
    with_ctes(
        f"SELECT incident_id, {rounded('predicted_delay', 6)} AS predicted_delay, predicted_delayed, predicted_category FROM judged",
        PREDICTED,
    ),
)
def scenario_predict(w: Warehouse):
    rows = scenario.predict(w.featured)
    return rows.select(
        "incident_id",
        half_even(F.col("predicted_delay"), 6).alias("predicted_delay"),
        "predicted_delayed",
        "predicted_category",
    )


@register(
    "regression_metrics",
    with_ctes(
        f"SELECT {rounded('avg(abs(delay_minutes - predicted_delay))', 4)} AS mae, "
        f"{rounded('sqrt(avg((delay_minutes - predicted_delay) * (delay_minutes - predicted_delay)))', 4)} AS rmse, "
        f"{rounded('1 - sum((delay_minutes - predicted_delay) * (delay_minutes - predicted_delay)) / (var_pop(delay_minutes) * count(*))', 4)} AS r2 FROM judged",
        PREDICTED,
    ),
)
def regression_metrics(w: Warehouse):
    """The rule-based predictions scored against the recorded delays."""
    return metrics.regression_metrics(scenario.predict(w.featured), "delay_minutes", "predicted_delay")


_SCORES = {
    **PREDICTED,
    "pairs": "SELECT is_delayed AS y, predicted_delayed AS p, count(*) AS n FROM judged GROUP BY ALL",
    "classes": "SELECT y AS class FROM pairs UNION SELECT p FROM pairs",
    "scores": """SELECT class, hits, support, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
        CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall,
        CASE WHEN predicted + support > 0 THEN 2 * hits / (predicted + support) ELSE 0 END AS f1 FROM
        (SELECT class, coalesce(sum(n) FILTER (y = class AND p = class), 0) AS hits, coalesce(sum(n) FILTER (y = class), 0) AS support,
           coalesce(sum(n) FILTER (p = class), 0) AS predicted FROM classes CROSS JOIN pairs GROUP BY class) AS c""",
}


@register(
    "classification_metrics",
    with_ctes(
        f"SELECT {rounded('sum(hits) / sum(support)', 4)} AS accuracy, "
        + ", ".join(
            f"{rounded(f'sum({c} * support) / sum(support)', 4)} AS {c}"
            for c in ("precision", "recall", "f1")
        )
        + " FROM scores",
        _SCORES,
    ),
)
def classification_metrics(w: Warehouse):
    return metrics.classification_metrics(scenario.predict(w.featured), "is_delayed", "predicted_delayed")


@register(
    "classification_report",
    with_ctes(
        "SELECT class, "
        + ", ".join(f"{rounded(c, 4)} AS {c}" for c in ("precision", "recall", "f1"))
        + ", CAST(support AS BIGINT) AS support FROM scores",
        _SCORES,
    ),
)
def classification_report(w: Warehouse):
    return metrics.classification_report(scenario.predict(w.featured), "is_delayed", "predicted_delayed")
