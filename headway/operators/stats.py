"""Aggregates and statistics over featured rows.

Exact quantiles and box plots take two scans: a bounded summary brackets the values wanted, and only
values inside the brackets are kept. Histograms and densities count by bin.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions.calendar import WEEKDAYS
from headway.functions.core import first_match, flag, nan_to_null, ratio
from headway.plans.staging import stage

# The correlated columns, in order.
CORRELATION_COLUMNS = [
    "delay_minutes", "precipitation_mm", "wind_speed_max_kmh", "temperature_mean_c",
    "weather_severity", "has_event", "event_impact_score", "is_rush_hour", "is_weekend", "hour",
    "passenger_count", "weather_severity_index",
]

# Coordinates of the known service areas.
AREA_COORDINATES = {
    "Manhattan": (40.7831, -73.9712),
    "Brooklyn": (40.6782, -73.9442),
    "Queens": (40.7282, -73.7949),
    "Bronx": (40.8448, -73.8648),
    "Staten Island": (40.5795, -74.1502),
    "Nassau County": (40.7282, -73.5828),
    "Westchester": (41.1220, -73.7949),
    "New Jersey": (40.7178, -74.0431),
    "Rockland County": (41.1489, -74.0401),
    "Suffolk": (40.8522, -73.1189),
}


def select_rows(
    df: DataFrame,
    first: str | None = None,
    last: str | None = None,
    boroughs: list[str] | None = None,
    weather: list[str] | None = None,
    day_type: str = "all",
) -> DataFrame:
    """The interactive filters. An empty list keeps everything, as does `day_type="all"`.

    On a table partitioned by `date_month` the date range also prunes whole partitions.
    """
    by_month = "date_month" in df.columns
    if first is not None:
        df = df.where(F.col("date") >= F.lit(first).cast("date"))
        df = df.where(F.col("date_month") >= first[:7]) if by_month else df
    if last is not None:
        df = df.where(F.col("date") <= F.lit(last).cast("date"))
        df = df.where(F.col("date_month") <= last[:7]) if by_month else df
    if boroughs:
        df = df.where(F.col("borough").isin(boroughs))
    if weather:
        df = df.where(F.col("weather_condition").isin(weather))
    if day_type != "all":
        df = df.where(F.col("is_weekend") == {"weekday": 0, "weekend": 1}[day_type])
    return df


def average_by(df: DataFrame, x: str, y: str) -> DataFrame:
    """Mean of any numeric column by any other column."""
    return df.groupBy(x).agg(F.avg(y).alias(f"avg_{y}"))


def overview(df: DataFrame) -> DataFrame:
    """The headline row. Bad-weather and event figures count records; the day counts are extra."""
    bad = F.col("weather_severity") >= 3
    eventful = F.col("has_event") == 1
    per_day = df.groupBy("date").agg(
        F.count("*").alias("n"),
        F.sum("delay_minutes").alias("minutes"),
        F.sum("is_delayed").alias("delayed"),
        F.sum(flag(bad)).alias("bad"),
        F.sum("has_event").alias("eventful"),
        F.max(flag(bad)).alias("bad_day"),
        F.max(flag(eventful)).alias("event_day"),
    )
    n = F.sum("n")
    return per_day.agg(
        n.alias("total_records"),
        ratio(F.sum("minutes"), n).alias("avg_delay"),
        ratio(F.sum("delayed") * 100, n).alias("delayed_percent"),
        F.sum("bad").alias("bad_weather_records"),
        F.sum("eventful").alias("event_records"),
        F.sum("bad_day").cast("bigint").alias("bad_weather_days"),
        F.sum("event_day").cast("bigint").alias("event_days"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("records"))


def _fields(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value) of every cell that is not null: one scan for all columns."""
    cells = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells))).where("value IS NOT NULL")


def top_values(df: DataFrame, columns: list[str], n: int = 8) -> DataFrame:
    """The most frequent values of each column as (field, value, records); ties by value."""
    counts = _fields(df, columns).groupBy("field", "value").agg(F.count("*").alias("records"))
    rank = F.row_number().over(W.partitionBy("field").orderBy(F.desc("records"), F.asc("value")))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank")


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """The values of each column as (field, value)."""
    return _fields(df, columns).distinct()


def weekday_means(df: DataFrame, y: str = "delay_minutes") -> DataFrame:
    """One row per weekday name, Monday first; a weekday without data has a null mean."""
    names = F.explode(F.array(*[F.lit(n) for n in WEEKDAYS])).alias("day_of_week")
    week = df.sparkSession.range(1).select(names)
    means = df.groupBy("day_of_week").agg(F.avg(y).alias(f"avg_{y}"))
    position = first_match([(F.col("day_of_week") == n, i) for i, n in enumerate(WEEKDAYS)])
    return week.join(means, "day_of_week", "left").withColumn("day_of_week_num", position)


def labelled_summary(
    df: DataFrame, by: str, labels: dict[int, str], y: str = "delay_minutes"
) -> DataFrame:
    """Mean, exact median and count of `y` for each labelled value of `by`."""
    found = _mean_median(df, by, y)
    return found.withColumn(by, first_match([(F.col(by) == k, v) for k, v in labels.items()]))


def _mean_median(df: DataFrame, by: str, y: str) -> DataFrame:
    found = group_quantiles(df, by, y, [0.5])
    return found.select(by, "mean", F.col("q")[0].alias("median"), "records")


def summary(df: DataFrame, y: str = "delay_minutes") -> DataFrame:
    """Mean, exact median and count of all rows: one row, null where there are none."""
    found = _mean_median(df.select(F.lit(0).alias("all"), y), "all", y)
    one = F.max_by(F.struct("mean", "median", "records"), "all")
    return found.agg(one.alias("one")).select("one.*")


#: Rank error of the summaries that find brackets, as a share of a group's rows; smaller groups
#: than one over it are kept whole.
BRACKET_ACCURACY = 10_000


def _brackets(df: DataFrame, by: str, y: str, shares: list[float], accuracy: int) -> DataFrame:
    """Per group its `mean`, and `b_`, for each share the bounds of the values that decide it.

    The summary's values are off by at most a share of 1 / accuracy; the bracket leaves room for it
    on both sides, and for the two ranks next to a share.
    """
    room = 3 / accuracy
    ends = [p for s in shares for p in (max(0.0, s - room), min(1.0, s + room))]
    found = df.groupBy(by).agg(
        F.count("*").alias("records"),
        F.avg(y).alias("mean"),
        F.min(y).cast("double").alias("least"),
        F.max(y).cast("double").alias("most"),
        F.percentile_approx(F.col(y).cast("double"), ends, accuracy).alias("ends"),
    )
    whole = F.struct(F.col("least").alias("lo"), F.col("most").alias("hi"))
    bounds = []
    for i, s in enumerate(shares):
        lo = F.col("least") if s <= room else F.col("ends")[2 * i]
        hi = F.col("most") if s >= 1 - room else F.col("ends")[2 * i + 1]
        bounds.append(F.struct(lo.alias("lo"), hi.alias("hi")))
    brackets = F.when(F.col("records") <= accuracy, F.transform(F.array(*bounds), lambda _: whole))
    return found.select(F.col(by).alias("g_"), "mean", brackets.otherwise(F.array(*bounds)).alias("b_"))


def _fences(q1: Column, q3: Column) -> tuple[Column, Column]:
    """The furthest that whiskers reach: 1.5 times the box beyond its ends."""
    reach = (q3 - q1) * 1.5
    return q1 - reach, q3 + reach


def _fence_brackets() -> Column:
    """Bounds of both fences, given those of the first and the last quantile in `b_`."""
    first, last = F.element_at("b_", 1), F.element_at("b_", -1)
    low = [first["lo"] - (last["hi"] - first["lo"]) * 1.5, first["hi"] - (last["lo"] - first["hi"]) * 1.5]
    high = [last["lo"] + (last["lo"] - first["hi"]) * 1.5, last["hi"] + (last["hi"] - first["lo"]) * 1.5]
    slack = (F.abs(first["lo"]) + F.abs(last["hi"])) * 1e-12
    pairs = [(F.least(*side) - slack, F.greatest(*side) + slack) for side in (low, high)]
    return F.array(*[F.struct(lo.alias("lo"), hi.alias("hi")) for lo, hi in pairs])


def _cells(df: DataFrame, by: str, y: str, brackets: DataFrame) -> DataFrame:
    """Counts and extremes of the values of each group, by cell; values in brackets one by one.

    The ends of brackets part a group's values into cells: each end is one, and what lies between
    two ends. Rows of a cell outside all brackets are one row with a null `value`.
    """
    same = F.col(by).eqNullSafe(F.col("g_"))
    inside = F.exists("b_", lambda b: (b["lo"] <= F.col(y)) & (F.col(y) <= b["hi"]))
    ends = F.array_distinct(F.concat(F.transform("b_", lambda b: b["lo"]), F.transform("b_", lambda b: b["hi"])))
    place = 2 * F.size(F.filter("ends", lambda e: e < F.col(y)))
    cell = place + F.exists("ends", lambda e: e == F.col(y)).cast("int")
    placed = df.join(brackets.withColumn("ends", ends), same).select(
        F.col(by).alias("g_"), cell.alias("cell"), F.col(y).alias("y_"), F.when(inside, F.col(y)).alias("value")
    )
    return placed.groupBy("g_", "cell", "value").agg(
        F.count("*").alias("n"), F.min("y_").alias("low"), F.max("y_").alias("high")
    )


def _pick_ranks(cells: DataFrame, shares: list[float]) -> DataFrame:
    """Interpolated quantiles `q` per group of `_cells`, and its `records`.

    Running counts of the few cells tell which one holds each wanted rank; only values there are
    sorted.
    """
    group, upto = W.partitionBy("g_"), W.partitionBy("g_").orderBy("cell")
    sizes = cells.groupBy("g_", "cell").agg(F.sum("n").alias("size"))
    running = sizes.withColumn("below", F.sum("size").over(upto) - F.col("size")).withColumn(
        "total", F.sum("size").over(group)
    )
    position = F.col("share") * (F.col("total") - 1)
    asked = (
        running.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
        .withColumn("position", position)
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))))
        .where("below <= rank AND rank < below + size")
        .groupBy("g_", "cell", "below", "total")
        .agg(F.collect_list(F.struct("share", "position", "rank")).alias("ranks"))
        .select(F.col("g_").alias("h_"), F.col("cell").alias("c_"), "below", "total", "ranks")
    )
    here = F.col("g_").eqNullSafe(F.col("h_")) & (F.col("cell") == F.col("c_"))
    end = F.col("below") + F.sum("n").over(W.partitionBy("h_", "c_").orderBy("value"))
    ordered = cells.join(asked, here).withColumn("end", end)
    covered = F.filter("ranks", lambda r: (r["rank"] < F.col("end")) & (r["rank"] >= F.col("end") - F.col("n")))
    found = ordered.select("h_", "total", F.col("value").cast("double").alias("v"), F.inline(covered))
    low, high = F.min_by("v", "rank"), F.max_by("v", "rank")
    part = F.max("position") - F.floor(F.max("position"))
    per_share = found.groupBy("h_", "total", "share").agg((low + (high - low) * part).alias("v"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("share", "v"))), lambda s: s["v"])
    return per_share.groupBy("h_").agg(listed.alias("q"), F.max("total").alias("records"))


def group_quantiles(
    df: DataFrame, by: str, y: str, shares: list[float], accuracy: int = BRACKET_ACCURACY
) -> DataFrame:
    """Exact interpolated quantiles of `y` per group as array `q`, with its `mean` and `records`.

    Two scans for any measure: a mergeable summary of bounded size brackets the values wanted, and a
    second scan counts what lies below the brackets and keeps only values inside them. Rows without
    `y` are left out; shares come in ascending order.
    """
    rows = df.select(by, y).where(F.col(y).isNotNull())
    brackets = stage(_brackets(rows, by, y, shares, accuracy), "brackets")
    cells = stage(_cells(rows, by, y, brackets), "bracketed")
    found = _pick_ranks(cells, shares).join(brackets, F.col("h_").eqNullSafe(F.col("g_")))
    return found.select(F.col("h_").alias(by), "records", "mean", "q")


def box_stats(
    df: DataFrame, by: str, y: str = "delay_minutes", outliers: bool = True, accuracy: int = BRACKET_ACCURACY
) -> DataFrame:
    """Quartiles, whiskers (the furthest values within 1.5 IQR of the box) and outlier counts.

    Two scans, as `group_quantiles`: the brackets of the quartiles bound the fences too, so the
    second scan also keeps the values near the fences.
    """
    shares = [0.25, 0.5, 0.75]
    rows = df.select(by, y).where(F.col(y).isNotNull())
    brackets = _brackets(rows, by, y, shares, accuracy)
    brackets = stage(brackets.withColumn("b_", F.concat("b_", _fence_brackets())), "brackets")
    cells = stage(_cells(rows, by, y, brackets), "bracketed")
    boxes = _pick_ranks(cells, shares)
    q1, q3 = F.col("q")[0], F.col("q")[2]
    low, high = _fences(q1, q3)
    within = (F.col("low") >= low) & (F.col("high") <= high)
    aggregates = [
        F.first("records").alias("records"),
        F.first(q1).alias("q1"),
        F.first(F.col("q")[1]).alias("median"),
        F.first(q3).alias("q3"),
        F.min(F.when(within, F.col("low"))).alias("whisker_low"),
        F.max(F.when(within, F.col("high"))).alias("whisker_high"),
    ]
    if outliers:
        aggregates.append(F.sum(F.when(~within, F.col("n")).otherwise(0)).alias("outliers"))
    matched = cells.join(boxes, F.col("g_").eqNullSafe(F.col("h_")))
    return matched.groupBy(F.col("g_").alias(by)).agg(*aggregates)


def _near(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Some known value of each column: sums of distances from it keep their digits."""
    some = df.select(columns).limit(256)
    row = some.agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns]).first()
    return {c: row[c] if row[c] is not None else 0.0 for c in columns}


def _as_doubles(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """The columns as distances from `_near`, NaN as null."""
    clean = df.select(*keys, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    at = _near(clean, columns) if columns else {}
    return clean.select(*keys, *[(F.col(c) - at[c]).alias(c) for c in columns])


def co_moments(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Sums that co-moments of rows are merged from, per key and set of known columns.

    Per group: `n`, and for each column its sum `s_`, extremes `l_` and `h_` and the sums of its
    products `p_` with itself and the later ones; null where the group doesn't know the column.
    """
    known = reduce(add, [F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(columns)], F.lit(0))
    sums = [F.count("*").alias("n")]
    for i, c in enumerate(columns):
        sums += [F.sum(c).alias(f"s_{c}"), F.min(c).alias(f"l_{c}"), F.max(c).alias(f"h_{c}")]
        sums += [F.sum(F.col(c) * F.col(d)).alias(f"p_{c}_{d}") for d in columns[i:]]
    return df.groupBy(*keys, known.alias("known")).agg(*sums)


def correlations(
    df: DataFrame,
    columns: list[str] = CORRELATION_COLUMNS,
    days: DataFrame | None = None,
    day: str = "date",
) -> DataFrame:
    """Pearson correlation of every pair, each pair over the rows where both are present.

    One scan of the rows, which leaves sums per day; columns of `days` (one row per `day`) are
    combined with them at day grain, so the two never meet row by row. Without `days` all columns
    are taken from the rows. The result lists both orders of a pair, like a matrix; a column that
    has one value within a pair's rows correlates with nothing.
    """
    own = [c for c in columns if c in df.columns]
    far = [c for c in columns if c not in own and days is not None and c in days.columns]
    keys = [day] if far else []
    sums = co_moments(_as_doubles(df, own, keys), own, keys)
    if far:
        sums = stage(sums, "co_moments").join(_as_doubles(days, far, keys), keys, "left")

    n, found = F.col("n"), own + far
    at = {c: i for i, c in enumerate(found)}
    products = {pair: i for i, pair in enumerate((a, b) for i, a in enumerate(own) for b in own[i:])}
    groups = sums.select(
        "n",
        F.array(*[F.col(f"s_{c}") for c in own], *[n * F.col(c) for c in far]).alias("s"),
        F.array(*[F.col(f"p_{c}_{c}") for c in own], *[n * F.col(c) * F.col(c) for c in far]).alias("q"),
        F.array(*[F.col(f"l_{c}") for c in own], *far).alias("l"),
        F.array(*[F.col(f"h_{c}") for c in own], *far).alias("h"),
        F.array(*[F.col(f"p_{a}_{b}") for a, b in products]).alias("p"),
    )
    every = [(a, b) for i, a in enumerate(found) for b in found[i:]]
    rows = [(a, b, at[a], at[b], products.get((a, b), -1), b in far) for a, b in every]
    schema = "column_a STRING, column_b STRING, i INT, j INT, k INT, far BOOLEAN"
    pairs = df.sparkSession.createDataFrame(rows, schema)
    pair = F.struct(*pairs.columns)
    listed = pairs.agg(F.collect_list(pair)).scalar()
    both = F.get("s", F.col("i")).isNotNull() & F.get("s", F.col("j")).isNotNull()

    def one(name: str) -> Column:
        return F.when(both, F.get(name, F.col("i")))

    def other(name: str) -> Column:
        return F.when(both, F.get(name, F.col("j")))

    product = F.when(F.col("far"), one("s") * other("l")).otherwise(F.get("p", F.col("k")))
    cells = groups.select("*", F.inline(listed))
    pairs = cells.groupBy("column_a", "column_b").agg(
        F.sum(F.when(both, n)).cast("double").alias("n"), F.sum(product).alias("ab"),
        F.sum(one("s")).alias("sa"), F.sum(other("s")).alias("sb"),
        F.sum(one("q")).alias("qa"), F.sum(other("q")).alias("qb"),
        F.min(one("l")).alias("la"), F.min(other("l")).alias("lb"),
        F.max(one("h")).alias("ha"), F.max(other("h")).alias("hb"),
    )
    covered = F.col("ab") - ratio(F.col("sa") * F.col("sb"), F.col("n"))
    spread = [F.col(f"q{x}") - ratio(F.col(f"s{x}") * F.col(f"s{x}"), F.col("n")) for x in "ab"]
    value = ratio(covered, F.sqrt(spread[0]) * F.sqrt(spread[1]))
    varies = (F.col("la") < F.col("ha")) & (F.col("lb") < F.col("hb")) & (spread[0] > 0) & (spread[1] > 0)
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))
    found = pairs.select("column_a", "column_b", F.when(varies, bounded).alias("correlation"))
    names = [F.col("column_a").alias("x"), F.col("column_b").alias("y")], [F.col("column_b").alias("x"), F.col("column_a").alias("y")]
    orders = F.array_distinct(F.array(*[F.struct(*pair) for pair in names]))
    both = found.select(F.explode(orders).alias("pair"), "correlation")
    return both.select(F.col("pair.x").alias("column_a"), F.col("pair.y").alias("column_b"), "correlation")


def trend_lines(
    df: DataFrame, xs: list[str], by: str = "weather_condition", y: str = "delay_minutes"
) -> DataFrame:
    """Least-squares line of `y` over each of `xs` in each group; none where it does not vary.

    Whether a column varies is told by its extremes: merged variances of a constant needn't be 0.
    """
    lines = []
    for x in xs:
        sums = [getattr(F, f"regr_{s}")(y, x).alias(s) for s in ("sxx", "syy", "sxy", "avgx", "avgy")]
        own, far = F.when(F.col(y).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull(), F.col(y))
        varies = [(F.min(c) < F.max(c)).alias(name) for c, name in ((own, "x_varies"), (far, "y_varies"))]
        lines.append(F.struct(F.lit(x).alias("x"), F.regr_count(y, x).alias("points"), *sums, *varies))
    sums = df.groupBy(by).agg(F.array(*lines).alias("lines")).select(by, F.inline("lines"))
    sxx, syy, sxy = F.col("sxx"), F.col("syy"), F.col("sxy")
    slope = F.when(F.col("x_varies"), F.when(F.col("y_varies"), ratio(sxy, sxx)).otherwise(0.0))
    r2 = F.when(F.col("x_varies"), F.when(F.col("y_varies"), ratio(sxy * sxy, sxx * syy)).otherwise(1.0))
    return sums.select(
        by, "x", "points", slope.alias("slope"), (F.col("avgy") - slope * F.col("avgx")).alias("intercept"), r2.alias("r2")
    )


def _span(df: DataFrame, y: str) -> tuple[Column, Column]:
    """The smallest value of `y` and the distance to the largest, as a scalar of its own scan."""
    span = df.agg(F.struct(F.min(y).alias("low"), (F.max(y) - F.min(y)).alias("wide"))).scalar()
    return span["low"], span["wide"]


def histogram(df: DataFrame, y: str = "delay_minutes", bins: int = 50) -> DataFrame:
    """Equal-width bins over the data range; the maximum belongs to the last bin.

    The range is found first, so that rows are counted by bin and never by value.
    """
    known = df.select(y).where(F.col(y).isNotNull())
    low, wide = _span(known, y)
    width = wide / bins
    place = F.least(F.floor(ratio(F.col(y) - low, width)), F.lit(bins - 1)).cast("int")
    filled = known.groupBy(F.coalesce(place, F.lit(0)).alias("bin")).agg(F.count("*").alias("records"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("records", F.lit(0).cast("bigint")).alias("records"),
    )


#: Widths of the kernel beyond which it adds less than 1e-14 of its height.
KERNEL_REACH = 8.0


def density(df: DataFrame, y: str = "delay_minutes", points: int = 200, bins: int = 4096) -> DataFrame:
    """Gaussian kernel density on an even grid over the data range, Scott's bandwidth.

    Rows are summed in fine bins, each standing at the mean of its values: exact where a bin holds
    one value, as with delays, and otherwise off by less than a bin's width. Values count as their
    distance from the smallest, and the spread comes from centred moments, so large magnitudes keep
    their digits. A bin adds only to the grid points that its kernel reaches.
    """
    known = df.select(F.col(y).cast("double").alias("v")).where("v IS NOT NULL")
    n, wide = F.count("*").cast("double"), F.max("v") - F.min("v")
    spread = F.when(wide > 0, F.stddev_samp("v")).otherwise(0.0)
    facts = stage(
        known.agg(
            n.alias("n"), F.min("v").alias("low"), wide.alias("wide"),
            (spread * F.pow(n, F.lit(-0.2))).alias("width"),
        ),
        "density_facts",
    )
    f = {c: facts.select(c).scalar() for c in facts.columns}
    place = F.coalesce(F.floor(ratio((F.col("v") - f["low"]) * bins, f["wide"])), F.lit(0).cast("bigint"))
    counts = known.select(place.alias("bin"), (F.col("v") - f["low"]).alias("v")).groupBy("bin")
    counts = counts.agg(F.count("*").alias("n"), F.avg("v").alias("v")).withColumns({"width": f["width"], "step": f["wide"] / (points - 1)})
    reach = F.col("width") * KERNEL_REACH
    first = F.greatest(F.lit(0), F.ceil(ratio(F.col("v") - reach, F.col("step"))).cast("int"))
    last = F.least(F.lit(points - 1), F.floor(ratio(F.col("v") + reach, F.col("step"))).cast("int"))
    touched = counts.withColumns({"first": first, "last": last}).where("first <= last")
    touched = touched.select("*", F.explode(F.sequence("first", "last")).alias("point"))
    gap = ratio(F.col("point") * F.col("step") - F.col("v"), F.col("width"))
    sums = touched.groupBy("point").agg(F.sum(F.exp(-0.5 * gap * gap) * F.col("n")).alias("total"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    scale = f["n"] * f["width"] * F.sqrt(2 * F.pi())
    return grid.join(sums, "point", "left").select(
        "point",
        (f["low"] + F.col("point") * f["wide"] / (points - 1)).alias("x"),
        ratio(F.coalesce("total", F.lit(0.0)), scale).alias("density"),
    )


def welch(df: DataFrame, split: Column, y: str = "delay_minutes") -> DataFrame:
    """Welch's unequal-variance t statistic between rows where `split` holds and where it fails."""
    high, low = F.when(split, F.col(y)), F.when(~split, F.col(y))

    def variance(part: Column) -> Column:
        """0 for equal values, whose merged variance needn't be."""
        return F.when(F.min(part) < F.max(part), F.var_samp(part)).otherwise(F.var_samp(part) * 0)

    moments = df.agg(
        F.count(high).alias("n_high"),
        F.count(low).alias("n_low"),
        F.avg(high).alias("mean_high"),
        F.avg(low).alias("mean_low"),
        variance(high).alias("var_high"),
        variance(low).alias("var_low"),
    )
    a, b = ratio(F.col("var_high"), F.col("n_high")), ratio(F.col("var_low"), F.col("n_low"))
    spread = ratio(a * a, F.col("n_high") - 1) + ratio(b * b, F.col("n_low") - 1)
    return moments.select(
        "n_high",
        "n_low",
        "mean_high",
        "mean_low",
        ratio(F.col("mean_high") - F.col("mean_low"), F.sqrt(a + b)).alias("t"),
        ratio((a + b) * (a + b), spread).alias("degrees"),
    )


def decide(test: DataFrame, level: float = 0.05) -> DataFrame:
    """Two-sided p-value of a `welch` row and whether it rejects equality at `level`."""
    schema = T.StructType(
        [
            *test.schema.fields,
            T.StructField("p_value", T.DoubleType()),
            T.StructField("reject", T.BooleanType()),
        ]
    )

    def add(frames):
        from headway.functions.student import two_sided

        for frame in frames:
            p = [two_sided(t, v) for t, v in zip(frame["t"], frame["degrees"])]
            yield frame.assign(p_value=p, reject=pd.Series(p, index=frame.index) < level)

    return test.mapInPandas(add, schema)


def profile(df: DataFrame) -> DataFrame:
    """Row and column counts, date range, mean delay, share delayed and share with events."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.avg("delay_minutes").alias("avg_delay"),
        F.avg("is_delayed").alias("delayed_share"),
        F.sum("has_event").alias("event_records"),
    )


def area_table(spark: SparkSession) -> DataFrame:
    rows = [(name, lat, lon) for name, (lat, lon) in AREA_COORDINATES.items()]
    return spark.createDataFrame(rows, "borough STRING, lat DOUBLE, lon DOUBLE")


def area_means(df: DataFrame, areas: DataFrame) -> DataFrame:
    """Mean delay and count per borough that has coordinates in `areas` (borough, lat, lon)."""
    means = df.groupBy("borough").agg(
        F.avg("delay_minutes").alias("avg_delay"), F.count("*").alias("records")
    )
    return means.join(areas, "borough")


def event_points(df: DataFrame) -> DataFrame:
    return df.where("has_event = 1").select(
        "incident_id", "event_impact_score", "delay_minutes", "total_attendance", "weather_condition"
    )


def invariants(df: DataFrame) -> DataFrame:
    """Rows breaking each promise about the target and the time columns; all must be 0."""
    needed = ["hour", "day_of_week", "month", "is_weekend", "is_rush_hour"]
    missing = [c for c in needed if c not in df.columns]
    return df.agg(
        F.sum(flag(F.col("delay_minutes").isNull())).alias("null_delays"),
        F.sum(flag(F.col("delay_minutes") < 0)).alias("negative_delays"),
        F.sum(flag(F.greatest(*[F.col(c).isNull() for c in needed if c in df.columns]))).alias("null_time_parts"),
        F.lit(len(missing)).alias("missing_columns"),
    )
