"""Level capping, one-hot and label encoding, and the model matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions.core import flag, nan_to_null, of_type
from headway.functions.weather import RAIN_LABELS
from headway.plans.staging import stage

# The encoded columns, and those among them that are capped at their top levels.
CATEGORIES = [
    "incident_type", "weather_condition", "season", "time_period", "delay_category",
    "rain_category", "borough", "delay_reason", "run_type",
]
CAPPED = ["borough", "delay_reason", "run_type"]
TOP_LEVELS = 8
OTHER = "Other"

# Columns that never become features, and the two targets.
NOT_FEATURES = [
    "date", "route_id", "route_name", "scheduled_departure", "actual_departure", "day_of_week",
    "event_types", "temp_category", "visibility_category",
]
REGRESSION_TARGET = "delay_minutes"
CLASSIFICATION_TARGET = "is_delayed"

# Levels declared in advance are encoded even where the data lacks them.
DECLARED_LEVELS = {"rain_category": RAIN_LABELS}


def top_levels(df: DataFrame, columns: list[str], n: int = TOP_LEVELS) -> dict[str, list[str]]:
    """The `n` most frequent levels of each column, ties by value: one scan counts all columns."""
    if not columns:
        return {}
    cells = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("level")) for c in columns]
    counts = df.select(F.inline(F.array(*cells))).where("level IS NOT NULL")
    counts = counts.groupBy("name", "level").agg(F.count("*").alias("records"))
    rank = F.row_number().over(W.partitionBy("name").orderBy(F.desc("records"), "level"))
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in counts.withColumn("rank", rank).where(F.col("rank") <= n).orderBy("name", "rank").collect():
        found[row["name"]].append(row["level"])
    return found


def cap_levels(
    df: DataFrame,
    columns: list[str] = CAPPED,
    n: int = TOP_LEVELS,
    kept: dict[str, list[str]] | None = None,
) -> DataFrame:
    """All but the `kept` levels (else the `n` most frequent) become "Other", and so does null."""
    columns = [c for c in columns if c in df.columns]
    kept = kept if kept is not None else top_levels(df, columns, n)
    capped = {
        c: F.when(F.col(f"`{c}`").isin(kept[c]), F.col(f"`{c}`")).otherwise(F.lit(OTHER)) if kept[c] else F.lit(OTHER)
        for c in columns
    }
    return df.withColumns(capped)


def levels_of(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted levels per column; the columns of the encoded schema have to be known when planning.

    One scan finds the levels of all columns, except of those declared in advance. Every level
    becomes a column, so an uncapped column with very many levels gives as many columns.
    """
    found = {c: list(DECLARED_LEVELS.get(c, [])) for c in columns}
    open_ended = [c for c in columns if c not in DECLARED_LEVELS]
    if open_ended:
        cells = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("level")) for c in open_ended]
        pairs = df.select(F.inline(F.array(*cells))).where("level IS NOT NULL").distinct()
        for name, level in pairs.collect():
            found[name].append(level)
        found |= {c: sorted(found[c]) for c in open_ended}
    return found


def encoding_levels(
    df: DataFrame, columns: list[str] = CATEGORIES, capped: list[str] = CAPPED, n: int = TOP_LEVELS
) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """What `cap_levels` keeps and `one_hot` encodes, from one scan that counts every level.

    A capped column has its kept levels and, if rows are left for it, "Other".
    """
    columns = [c for c in columns if c in df.columns]
    open_ended = [c for c in columns if c not in DECLARED_LEVELS]
    cells = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("level")) for c in open_ended]
    counts = df.select(F.inline(F.array(*cells))).groupBy("name", "level").agg(F.count("*").alias("records"))
    order = W.partitionBy("name").orderBy(F.col("level").isNull(), F.desc("records"), "level")
    ranked = counts.withColumn("rank", F.row_number().over(order))
    # Of a capped column only one row beyond the kept ones matters: it says that there are others.
    few = ranked.where((~F.col("name").isin(capped)) | (F.col("rank") <= n + 1) | F.col("level").isNull())
    kept: dict[str, list[str]] = {c: [] for c in columns if c in capped}
    levels = {c: list(DECLARED_LEVELS.get(c, [])) for c in columns}
    more = set()
    for row in few.orderBy("name", "rank").collect():
        name, level = row["name"], row["level"]
        if name in kept and (level is None or len(kept[name]) == n):
            more.add(name)
        elif level is not None:
            (kept if name in kept else levels)[name].append(level)
    for c in open_ended:
        found = {*kept[c], OTHER} if c in more else kept.get(c, levels[c])
        levels[c] = sorted(found)
    return kept, levels


def dummy_names(columns: list[str], levels: dict[str, list[str]]) -> list[tuple[str, str, str]]:
    """(name, column, level) of every 0/1 column.

    Names are `{column}_{level}`; signs that column references can't hold (dots, back-ticks) become
    underscores, and a name that is taken gets a number.
    """
    named, taken = [], set()
    for c in columns:
        for level in levels[c]:
            base = f"{c}_{level}".replace(".", "_").replace("`", "_")
            name, number = base, 2
            while name in taken:
                name, number = f"{base}_{number}", number + 1
            taken.add(name)
            named.append((name, c, level))
    return named


def one_hot(df: DataFrame, columns: list[str] = CATEGORIES, levels: dict | None = None) -> DataFrame:
    """Replace each column by one 0/1 column per level (see `dummy_names`); null is all 0."""
    columns = [c for c in columns if c in df.columns]
    levels = levels if levels is not None else levels_of(df, columns)
    dummies = [flag(F.col(f"`{c}`") == level).alias(name) for name, c, level in dummy_names(columns, levels)]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], *dummies)


def label_codes(df: DataFrame, column: str, missing: str = "nan") -> DataFrame:
    """Distinct values with codes 0, 1, ... in sorted order; null counts as the text `missing`.

    The number of values is not bounded, so they are range-partitioned: each range ranks its own
    values and is shifted by the sizes of the ranges before it. The ranges are staged first, since
    sizes and ranks must see the same ones.
    """
    values = df.select(F.coalesce(F.col(column).cast("string"), F.lit(missing)).alias("value"))
    ranges = values.distinct().repartitionByRange("value")
    staged = stage(ranges.withColumn("range", F.spark_partition_id()), f"{column}_ranges")
    sizes = staged.groupBy("range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.orderBy("range")) - F.col("n")
    offsets = sizes.select("range", before.alias("before"))
    position = F.row_number().over(W.partitionBy("range").orderBy("value"))
    return (
        staged.join(offsets, "range")
        .select("value", (F.col("before") + position - 1).cast("int").alias("code"))
    )


def label_encode(df: DataFrame, column: str, codes: DataFrame, missing: str = "nan") -> DataFrame:
    """Adds `{column}_encoded`. The join is left to the optimizer: the codes may be many."""
    keyed = codes.withColumnsRenamed({"value": "_value", "code": f"{column}_encoded"})
    match = F.coalesce(F.col(column).cast("string"), F.lit(missing)) == F.col("_value")
    return df.join(keyed, match, "left").drop("_value")


def encode(df: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Cap, one-hot and, where a route column exists, label-encode it."""
    if "route_id" in df.columns:
        codes = codes if codes is not None else label_codes(df, "route_id")
        df = label_encode(df, "route_id", codes)
    kept, levels = encoding_levels(df)
    return one_hot(cap_levels(df, kept=kept), levels=levels)


def model_matrix(df: DataFrame, task: str, keys: list[str] = ["incident_id"]) -> DataFrame:
    """Keys, numeric features with nulls as 0, and the target as `label`.

    Unlike the usual dump of all numeric columns, keys identify rows and are no features.
    """
    target, other = REGRESSION_TARGET, CLASSIFICATION_TARGET
    if task == "classification":
        target, other = other, target
    dropped = {*NOT_FEATURES, *keys, target, other, "delay_category"}
    features = [
        c
        for c in of_type(df.schema, T.NumericType)
        if c not in dropped and not c.startswith("delay_category_")
    ]
    filled = []
    for c in features:
        column, kind = F.col(f"`{c}`"), df.schema[c].dataType
        column = nan_to_null(column) if isinstance(kind, T.DoubleType) else column
        filled.append(F.coalesce(column, F.lit(0).cast(kind)).alias(c))
    return df.select(*keys, *filled, F.col(target).cast("double").alias("label"))


def feature_names(matrix: DataFrame, keys: list[str] = ["incident_id"]) -> list[str]:
    return [c for c in matrix.columns if c not in (*keys, "label")]
