"""Filter, aggregate, statistics and top-k queries over featured rows."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from headway.catalog.registry import register
from headway.catalog.sql import case, finite, hashed, rounded, text, with_ctes
from headway.functions.calendar import WEEKDAYS
from headway.functions.core import half_even
from headway.operators import sampling, stats
from headway.plans.warehouse import Warehouse

_FILTER = {
    "first": "1996-03-15",
    "last": "1998-02-10",
    "boroughs": ["NATION_1", "NATION_3", "NATION_7", "NATION_12"],
    "weather": ["Snow", "Rain", "Clear"],
    "day_type": "weekday",
}


@register(
    "filter_dashboard",
    with_ctes(
        "SELECT incident_id, date, borough, weather_condition, is_weekend, delay_minutes FROM featured "
        "WHERE date BETWEEN DATE '1996-03-15' AND DATE '1998-02-10' AND is_weekend = 0 "
        "AND borough IN ('NATION_1', 'NATION_3', 'NATION_7', 'NATION_12') AND weather_condition IN ('Snow', 'Rain', 'Clear')"
    ),
)
def filter_dashboard(w: Warehouse):
    rows = stats.select_rows(w.featured_by_month, **_FILTER)
    return rows.select(
        "incident_id", "date", "borough", "weather_condition", "is_weekend", "delay_minutes"
    )


@register(
    "kpi_overview",
    with_ctes(
        "SELECT count(*) AS total_records, avg(delay_minutes) AS avg_delay, sum(is_delayed) * 100 / count(*) AS delayed_percent, "
        "CAST(count(*) FILTER (weather_severity >= 3) AS BIGINT) AS bad_weather_records, CAST(sum(has_event) AS BIGINT) AS event_records, "
        "count(DISTINCT CASE WHEN weather_severity >= 3 THEN date END) AS bad_weather_days, "
        "count(DISTINCT CASE WHEN has_event = 1 THEN date END) AS event_days FROM featured"
    ),
)
def kpi_overview(w: Warehouse):
    return stats.overview(w.featured)


@register("delay_by_day", with_ctes("SELECT date, avg(delay_minutes) AS avg_delay_minutes FROM trips GROUP BY date"))
def delay_by_day(w: Warehouse):
    return stats.average_by(w.trips, "date", "delay_minutes")


@register("delay_by_borough", with_ctes("SELECT borough, avg(delay_minutes) AS avg_delay_minutes FROM trips GROUP BY borough ORDER BY 2"))
def delay_by_borough(w: Warehouse):
    return stats.average_by(w.trips, "borough", "delay_minutes").orderBy("avg_delay_minutes", "borough")


@register("delay_by_hour", with_ctes("SELECT hour, avg(delay_minutes) AS avg_delay_minutes FROM trips GROUP BY hour"))
def delay_by_hour(w: Warehouse):
    return stats.average_by(w.trips, "hour", "delay_minutes")


@register("custom_avg", with_ctes("SELECT time_period, avg(passenger_count) AS avg_passenger_count FROM featured GROUP BY time_period"))
def custom_avg(w: Warehouse):
    return stats.average_by(w.featured, "time_period", "passenger_count")


_DAY_NUMBER = case([(f"day_of_week = {text(n)}", str(i)) for i, n in enumerate(WEEKDAYS)])


@register(
    "delay_by_dow",
    with_ctes(
        f"SELECT day_of_week, avg_delay_minutes, CAST({_DAY_NUMBER} AS INTEGER) AS day_of_week_num FROM "
        f"(SELECT unnest([{', '.join(map(text, WEEKDAYS))}]) AS day_of_week) AS week "
        "LEFT JOIN (SELECT day_of_week, avg(delay_minutes) AS avg_delay_minutes FROM trips GROUP BY day_of_week) AS means USING (day_of_week)"
    ),
)
def delay_by_dow(w: Warehouse):
    return stats.weekday_means(w.trips)


@register("category_counts", with_ctes("SELECT delay_category, count(*) AS records FROM trips GROUP BY delay_category"))
def category_counts(w: Warehouse):
    return stats.value_counts(w.trips, "delay_category")


@register(
    "top_reasons",
    with_ctes(
        "SELECT * FROM (SELECT 'delay_reason' AS field, delay_reason AS value, count(*) AS records FROM trips GROUP BY delay_reason ORDER BY records DESC, value LIMIT 8) AS a "
        "UNION ALL SELECT * FROM (SELECT 'run_type', run_type, count(*) AS records FROM trips GROUP BY run_type ORDER BY records DESC, run_type LIMIT 8) AS b"
    ),
)
def top_reasons(w: Warehouse):
    """The given reasons have fewer than eight values, so run types are reported too."""
    return stats.top_values(w.trips, ["delay_reason", "run_type"])


@register(
    "filter_options",
    with_ctes(
        "SELECT DISTINCT 'borough' AS field, borough AS value FROM trips WHERE borough IS NOT NULL "
        "UNION ALL SELECT DISTINCT 'weather_condition', weather_condition FROM merged WHERE weather_condition IS NOT NULL"
    ),
)
def filter_options(w: Warehouse):
    return stats.distinct_values(w.featured, ["borough", "weather_condition"]).orderBy("field", "value")


_FILTERED = {
    "chosen": "SELECT * FROM featured WHERE date BETWEEN DATE '1996-03-15' AND DATE '1998-02-10' AND is_weekend = 0 "
    "AND borough IN ('NATION_1', 'NATION_3', 'NATION_7', 'NATION_12') AND weather_condition IN ('Snow', 'Rain', 'Clear')"
}


@register(
    "filter_kpi",
    with_ctes(
        "SELECT count(*) AS total_records, avg(delay_minutes) AS avg_delay, sum(is_delayed) * 100 / count(*) AS delayed_percent, "
        "CAST(count(*) FILTER (weather_severity >= 3) AS BIGINT) AS bad_weather_records, CAST(sum(has_event) AS BIGINT) AS event_records, "
        "count(DISTINCT CASE WHEN weather_severity >= 3 THEN date END) AS bad_weather_days, "
        "count(DISTINCT CASE WHEN has_event = 1 THEN date END) AS event_days FROM chosen",
        _FILTERED,
    ),
)
def filter_kpi(w: Warehouse):
    """The headline row of the filtered incidents."""
    return stats.overview(stats.select_rows(w.featured_by_month, **_FILTER))


@register(
    "filter_trend",
    with_ctes("SELECT date, avg(delay_minutes) AS avg_delay_minutes FROM chosen GROUP BY date", _FILTERED),
)
def filter_trend(w: Warehouse):
    return stats.average_by(stats.select_rows(w.featured_by_month, **_FILTER), "date", "delay_minutes")


@register(
    "filter_top_reasons",
    with_ctes(
        "SELECT * FROM (SELECT 'delay_reason' AS field, delay_reason AS value, count(*) AS records FROM chosen GROUP BY delay_reason ORDER BY records DESC, value LIMIT 8) AS a "
        "UNION ALL SELECT * FROM (SELECT 'run_type', run_type, count(*) AS records FROM chosen GROUP BY run_type ORDER BY records DESC, run_type LIMIT 8) AS b",
        _FILTERED,
    ),
)
def filter_top_reasons(w: Warehouse):
    chosen = stats.select_rows(w.featured_by_month, **_FILTER)
    return stats.top_values(chosen, ["delay_reason", "run_type"])


@register(
    "rush_compare",
    with_ctes(
        "SELECT CASE is_rush_hour WHEN 0 THEN 'Non-Rush Hour' ELSE 'Rush Hour' END AS is_rush_hour, avg(delay_minutes) AS mean, "
        "median(delay_minutes) AS median, count(*) AS records FROM trips GROUP BY ALL"
    ),
)
def rush_compare(w: Warehouse):
    return stats.labelled_summary(w.trips, "is_rush_hour", {0: "Non-Rush Hour", 1: "Rush Hour"})


@register(
    "event_compare",
    with_ctes(
        "SELECT CASE has_event WHEN 0 THEN 'No Event' ELSE 'Event Day' END AS has_event, avg(delay_minutes) AS mean, "
        "median(delay_minutes) AS median, count(*) AS records FROM merged GROUP BY ALL"
    ),
)
def event_compare(w: Warehouse):
    return stats.labelled_summary(w.featured, "has_event", {0: "No Event", 1: "Event Day"})


def _compare_sql(table: str, by: str, zero: str, one: str, y: str) -> str:
    return with_ctes(
        f"SELECT CASE {by} WHEN 0 THEN {text(zero)} ELSE {text(one)} END AS {by}, avg({y}) AS mean, "
        f"median({y}) AS median, count(*) AS records FROM {table} GROUP BY ALL"
    )


@register("rush_passengers", _compare_sql("trips", "is_rush_hour", "Non-Rush Hour", "Rush Hour", "passenger_count"))
def rush_passengers(w: Warehouse):
    labels = {0: "Non-Rush Hour", 1: "Rush Hour"}
    return stats.labelled_summary(w.trips, "is_rush_hour", labels, "passenger_count")


@register("event_passengers", _compare_sql("merged", "has_event", "No Event", "Event Day", "passenger_count"))
def event_passengers(w: Warehouse):
    labels = {0: "No Event", 1: "Event Day"}
    return stats.labelled_summary(w.featured, "has_event", labels, "passenger_count")


@register("delay_summary", with_ctes("SELECT avg(delay_minutes) AS mean, median(delay_minutes) AS median, count(*) AS records FROM trips"))
def delay_summary(w: Warehouse):
    return stats.summary(w.trips)


def _box_sql(by: str, outliers: bool, y: str = "delay_minutes", table: str = "merged") -> str:
    fenced = f"CASE WHEN {y} BETWEEN q1 - reach AND q3 + reach THEN {y} END"
    extra = f", CAST(sum(CASE WHEN {y} BETWEEN q1 - reach AND q3 + reach THEN 0 ELSE 1 END) AS BIGINT) AS outliers"
    quarter = {p: f"quantile_cont({y}, {p})" for p in (0.25, 0.5, 0.75)}
    return with_ctes(
        f"SELECT b.{by}, count(*) AS records, any_value(q1) AS q1, any_value(med) AS median, any_value(q3) AS q3, "
        f"min({fenced}) AS whisker_low, max({fenced}) AS whisker_high"
        f"{extra if outliers else ''} FROM boxes AS b JOIN {table} AS m ON m.{by} IS NOT DISTINCT FROM b.{by} "
        f"WHERE {y} IS NOT NULL GROUP BY b.{by}",
        {
            "boxes": f"SELECT {by}, {quarter[0.25]} AS q1, {quarter[0.5]} AS med, {quarter[0.75]} AS q3, "
            f"1.5e0 * ({quarter[0.75]} - {quarter[0.25]}) AS reach FROM {table} GROUP BY {by}"
        },
    )


@register("box_by_condition", _box_sql("weather_condition", True))
def box_by_condition(w: Warehouse):
    return stats.box_stats(w.featured, "weather_condition")


@register("box_by_severity", _box_sql("weather_severity", False))
def box_by_severity(w: Warehouse):
    return stats.box_stats(w.featured, "weather_severity", outliers=False)


@register("box_custom", _box_sql("season", True, "weather_severity_index", "featured"))
def box_custom(w: Warehouse):
    """A box plot of a freely chosen measure, whose number of values is not known."""
    return stats.box_stats(w.featured, "season", "weather_severity_index")


@register("box_passengers", _box_sql("weather_condition", True, "passenger_count"))
def box_passengers(w: Warehouse):
    return stats.box_stats(w.featured, "weather_condition", "passenger_count")


_CORR = stats.CORRELATION_COLUMNS
# The exploration report's shorter list; its event column lives on in `max_attendance`.
_CORR_SHORT = [
    "delay_minutes", "temperature_max_c", "precipitation_mm", "snowfall_cm",
    "wind_speed_max_kmh", "weather_severity", "max_attendance",
]


def _corr_sql(columns: list[str]) -> str:
    pairs = " UNION ALL ".join(
        f"SELECT {text(a)} AS column_a, {text(b)} AS column_b, {finite(rounded(f'corr({a}, {b})', 6))} AS correlation FROM facts"
        for a, b in product(columns, columns)
    )
    return with_ctes(pairs, {"facts": f"SELECT {', '.join(columns)} FROM featured"}).replace(
        "facts AS (", "facts AS MATERIALIZED (", 1
    )


@register("correlation_matrix", _corr_sql(_CORR))
def correlation_matrix(w: Warehouse):
    """Facts hold the row-level columns, the day dimension the others."""
    matrix = stats.correlations(w.trips, _CORR, w.days)
    return matrix.withColumn("correlation", half_even(F.col("correlation"), 6))


@register("correlation_short", _corr_sql(_CORR_SHORT))
def correlation_short(w: Warehouse):
    matrix = stats.correlations(w.trips, _CORR_SHORT, w.days)
    return matrix.withColumn("correlation", half_even(F.col("correlation"), 6))


def _line_sql(x: str) -> str:
    parts = ", ".join(
        f"{rounded(f'regr_{f}(delay_minutes, {x})', 6)} AS {f}" for f in ("slope", "intercept", "r2")
    )
    return (
        f"SELECT weather_condition, {text(x)} AS x, CAST(regr_count(delay_minutes, {x}) AS BIGINT) AS points, {parts} "
        "FROM merged WHERE weather_condition IS NOT NULL GROUP BY weather_condition"
    )


@register(
    "ols_trend",
    with_ctes(f"{_line_sql('precipitation_mm')} UNION ALL {_line_sql('temperature_mean_c')}"),
)
def ols_trend(w: Warehouse):
    """One line per weather condition, over rain and over temperature."""
    known = w.featured.where(F.col("weather_condition").isNotNull())
    lines = stats.trend_lines(known, ["precipitation_mm", "temperature_mean_c"])
    return lines.withColumns({c: half_even(F.col(c), 6) for c in ("slope", "intercept", "r2")})


def _histogram_sql(y: str) -> str:
    return with_ctes(
        "SELECT CAST(bin AS INTEGER) AS bin, low + bin * width AS bin_start, low + (bin + 1) * width AS bin_end, "
        f"(SELECT count(*) FROM trips WHERE least(CAST(floor(({y} - low) / width) AS INTEGER), 49) = bin) AS records "
        "FROM span, range(50) AS r(bin)",
        {"span": f"SELECT min({y}) AS low, (max({y}) - min({y})) / 50 AS width FROM trips"},
    )


@register("delay_histogram", _histogram_sql("delay_minutes"))
def delay_histogram(w: Warehouse):
    return stats.histogram(w.trips)


@register("passenger_histogram", _histogram_sql("passenger_count"))
def passenger_histogram(w: Warehouse):
    return stats.histogram(w.trips, "passenger_count")


def _density_sql(y: str) -> str:
    return with_ctes(
        f"SELECT CAST(point AS INTEGER) AS point, {rounded('x', 6)} AS x, "
        f"{rounded(f'sum(exp(-0.5e0 * ((x - {y}) / width) * ((x - {y}) / width)) * n) / any_value(total * width * sqrt(2 * pi()))', 6)} AS density "
        "FROM (SELECT *, low + point * (high - low) / 199 AS x FROM facts CROSS JOIN counted CROSS JOIN range(200) AS r(point)) AS g GROUP BY point, x",
        {
            "counted": f"SELECT {y}, count(*) AS n FROM trips GROUP BY {y}",
            "facts": f"SELECT min({y}) AS low, max({y}) AS high, count(*) AS total, "
            f"stddev_samp({y}) * pow(count(*), -0.2e0) AS width FROM trips",
        },
    )


@register("delay_kde", _density_sql("delay_minutes"))
def delay_kde(w: Warehouse):
    curve = stats.density(w.trips)
    return curve.withColumns({c: half_even(F.col(c), 6) for c in ("x", "density")})


@register("passenger_kde", _density_sql("passenger_count"))
def passenger_kde(w: Warehouse):
    curve = stats.density(w.trips, "passenger_count")
    return curve.withColumns({c: half_even(F.col(c), 6) for c in ("x", "density")})


@register(
    "welch_ttest",
    with_ctes(
        "SELECT n_high, n_low, mean_high, mean_low, "
        f"{rounded('(mean_high - mean_low) / sqrt(a + b)', 6)} AS t, "
        f"{rounded('(a + b) * (a + b) / (a * a / (n_high - 1) + b * b / (n_low - 1))', 3)} AS degrees "
        "FROM (SELECT count(*) FILTER (weather_severity >= 3) AS n_high, count(*) FILTER (weather_severity < 3) AS n_low, "
        "avg(delay_minutes) FILTER (weather_severity >= 3) AS mean_high, avg(delay_minutes) FILTER (weather_severity < 3) AS mean_low, "
        "var_samp(delay_minutes) FILTER (weather_severity >= 3) / count(*) FILTER (weather_severity >= 3) AS a, "
        "var_samp(delay_minutes) FILTER (weather_severity < 3) / count(*) FILTER (weather_severity < 3) AS b FROM merged) AS m"
    ),
)
def welch_ttest(w: Warehouse):
    test = stats.welch(w.featured, F.col("weather_severity") >= 3)
    return test.withColumns({"t": half_even(F.col("t"), 6), "degrees": half_even(F.col("degrees"), 3)})


@register("welch_decision")
def welch_decision(w: Warehouse):
    """The test with its p-value; SQL has no t distribution."""
    return stats.decide(stats.welch(w.featured, F.col("weather_severity") >= 3))


@register(
    "dataset_profile",
    with_ctes(
        "SELECT count(*) AS row_count, CAST(40 AS INTEGER) AS column_count, min(date) AS first_date, max(date) AS last_date, "
        "avg(delay_minutes) AS avg_delay, avg(is_delayed) AS delayed_share, CAST(sum(has_event) AS BIGINT) AS event_records FROM merged"
    ),
)
def dataset_profile(w: Warehouse):
    return stats.profile(w.merged)


@register(
    "dataset_invariants",
    with_ctes(
        "SELECT CAST(count(*) FILTER (delay_minutes IS NULL) AS BIGINT) AS null_delays, CAST(count(*) FILTER (delay_minutes < 0) AS BIGINT) AS negative_delays, "
        "CAST(count(*) FILTER (hour IS NULL OR day_of_week IS NULL OR month IS NULL OR is_weekend IS NULL OR is_rush_hour IS NULL) AS BIGINT) AS null_time_parts, "
        "CAST(0 AS INTEGER) AS missing_columns FROM featured"
    ),
)
def dataset_invariants(w: Warehouse):
    return stats.invariants(w.featured)


@register(
    "borough_geo",
    with_ctes(
        "SELECT borough, avg(delay_minutes) AS avg_delay, count(*) AS records, any_value(lat) AS lat, any_value(lon) AS lon FROM trips "
        "JOIN (SELECT concat('NATION_', i) AS name, 40 + i / 16 AS lat, -74 + i / 8 AS lon FROM range(20) AS r(i)) AS areas ON borough = name GROUP BY borough"
    ),
)
def borough_geo(w: Warehouse):
    """The given boroughs are nation names, so the areas are made for twenty of them."""
    areas = w.trips.sparkSession.range(20).selectExpr(
        "concat('NATION_', id) AS borough", "40 + id / 16 AS lat", "-74 + id / 8 AS lon"
    )
    return stats.area_means(w.trips, areas)


@register(
    "event_day_points",
    with_ctes("SELECT incident_id, event_impact_score, delay_minutes, total_attendance, weather_condition FROM featured WHERE has_event = 1"),
)
def event_day_points(w: Warehouse):
    return stats.event_points(w.featured)


@register(
    "sample_points",
    with_ctes(
        "SELECT incident_id, precipitation_mm, delay_minutes, weather_condition FROM merged "
        f"ORDER BY {hashed('incident_id', 42)}, incident_id LIMIT 5000"
    ),
)
def sample_points(w: Warehouse):
    rows = w.featured.select("incident_id", "precipitation_mm", "delay_minutes", "weather_condition")
    return sampling.sample_rows(rows, "incident_id", 5000)


