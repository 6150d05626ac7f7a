"""City-event scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.core import first_match, half_even

# Score of each impact level; anything else scores 0.
IMPACT_SCORE = {"Low": 1, "Medium": 2, "High": 3}
LARGE_EVENT_ABOVE = 10000


def impact_score(level: Column) -> Column:
    return first_match([(level == name, score) for name, score in IMPACT_SCORE.items()], 0)


def day_impact_score(has_event: Column, max_score: Column, attendance: Column, count: Column) -> Column:
    score = half_even(max_score * 2 + F.log1p(attendance.cast("double")) + count * 0.5, 2)
    return F.when(has_event == 0, F.lit(0.0)).otherwise(score)
