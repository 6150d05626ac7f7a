"""Minority oversampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.catalog.registry import register
from headway.catalog.sql import drawn, hashed, rounded, with_ctes
from headway.functions.core import half_even
from headway.operators import balance
from headway.plans.warehouse import Warehouse

FEATURES = [
    "hour", "passenger_count", "is_weekend", "precipitation_mm", "wind_speed_max_kmh",
    "temperature_mean_c", "weather_severity_index", "event_impact_score",
]

_APART = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATURES)
_SQL = {
    "sized": "SELECT is_delayed, count(*) AS n FROM trips GROUP BY is_delayed",
    "rare": "SELECT is_delayed AS label, n, (SELECT max(n) FROM sized) - n AS missing FROM sized ORDER BY n LIMIT 1",
    "minority": "SELECT incident_id, is_delayed, "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in FEATURES)
    + " FROM featured JOIN rare ON is_delayed = label",
    "reps": f"SELECT * FROM minority QUALIFY row_number() OVER (PARTITION BY {', '.join(FEATURES)} ORDER BY incident_id) <= 6",
    "points": f"SELECT min(incident_id) AS point, {', '.join(FEATURES)} FROM minority GROUP BY {', '.join(FEATURES)}",
    "near": f"SELECT a.point, min({{'d2': {rounded(_APART, 6)}, 'id': b.incident_id}}, 6) AS near FROM points AS a CROSS JOIN reps AS b GROUP BY a.point",
    "matched": "SELECT minority.*, list_filter(near, lambda x: x.id <> incident_id)[1:5] AS near FROM minority "
    f"JOIN points USING ({', '.join(FEATURES)}) JOIN near ON near.point = points.point",
    "counted": f"SELECT *, n, missing, missing // n + CASE WHEN row_number() OVER (ORDER BY {hashed('incident_id', 42)}, incident_id) <= missing % n THEN 1 ELSE 0 END AS copies "
    "FROM matched CROSS JOIN rare",
    "drawn": "SELECT *, unnest(generate_series(1, CAST(copies AS BIGINT))) AS copy FROM counted",
    "chosen": f"SELECT * EXCLUDE (near), near[1 + ({drawn('incident_id', 'copy', 43)}) % len(near)].id AS neighbour, ({drawn('incident_id', 'copy', 44)}) / 4294967296e0 AS gap FROM drawn",
}


@register(
    "smote",
    with_ctes(
        "SELECT c.incident_id, CAST(copy AS INTEGER) AS copy, neighbour, c.is_delayed, "
        + ", ".join(f"{rounded(f'c.{c} + gap * (m.{c} - c.{c})', 6)} AS {c}" for c in FEATURES)
        + " FROM chosen AS c JOIN minority AS m ON m.incident_id = c.neighbour",
        _SQL,
    ),
)
def smote(w: Warehouse):
    """Synthetic rows for the rarer delay class, from exact neighbours over the whole class."""
    rows = w.featured.select("incident_id", "is_delayed", *FEATURES)
    made = balance.smote(rows, "is_delayed", "incident_id", FEATURES)
    return made.withColumns({c: half_even(F.col(c), 6) for c in FEATURES})
