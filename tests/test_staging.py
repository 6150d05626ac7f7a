"""How stage tables are written and read."""

from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from headway.operators import models
from headway.plans import warehouse
from headway.plans.staging import GROUP_BYTES, small_splits, stage
from headway.plans.warehouse import Warehouse
from headway.sources.schemas import TRIPS_SCHEMA

_SPLIT = "spark.sql.files.maxPartitionBytes"


def test_small_splits_hold_inside_alone(spark):
    before = spark.conf.get(_SPLIT)
    with pytest.raises(ZeroDivisionError):
        with small_splits(spark):
            assert spark.conf.get(_SPLIT) == str(GROUP_BYTES)
            raise ZeroDivisionError
    assert spark.conf.get(_SPLIT) == before


def test_a_stage_can_be_read_in_small_splits(spark):
    """A row group can't be read by two tasks, so a file needs several."""
    rows = spark.range(0, 6_000_000, 1, 1).select(F.xxhash64("id").alias("x"))
    (file,) = stage(rows, "groups").inputFiles()
    groups = pq.ParquetFile(file.removeprefix("file://")).metadata
    assert groups.num_row_groups > 1
    assert max(groups.row_group(i).total_byte_size for i in range(groups.num_row_groups)) <= 1.5 * GROUP_BYTES


def test_facts_are_sorted_in_small_splits(spark, monkeypatch):
    seen = {}

    def watched(df, name, **more):
        seen[name] = spark.conf.get(_SPLIT)
        return stage(df, name, **more)

    monkeypatch.setattr(warehouse, "stage", watched)
    day = datetime(2024, 1, 1)
    row = {"incident_id": 1, "created_on": day}
    names = [part.split()[0] for part in TRIPS_SCHEMA.split(",")]
    raw = spark.createDataFrame([tuple(row.get(n) for n in names)], TRIPS_SCHEMA)
    events = "date DATE, event_name STRING, event_type STRING, expected_attendance BIGINT, impact_level STRING"
    star = Warehouse(lambda: raw, lambda: None, lambda: spark.createDataFrame([], events))
    assert star.facts.count() == 1 and star.event_days.count() == 0
    assert seen["trips"] == seen["event_days"] == str(GROUP_BYTES) != spark.conf.get(_SPLIT)


def test_fits_read_bounded_parts_of_vectors(spark, monkeypatch):
    """Vectors of many rows in one file come in parts, whichever model is fitted."""
    columns = [F.rand(i).alias(f"x{i}") for i in range(8)]
    rows = spark.range(0, 400_000, 1, 1).select(F.col("id").alias("key"), F.rand(9).alias("label"), *columns)
    vectors = models.training_vectors(rows, [f"x{i}" for i in range(8)])
    (file,) = vectors.inputFiles()
    assert pq.ParquetFile(file.removeprefix("file://")).metadata.num_row_groups > 2
    seen = []
    monkeypatch.setattr(models, "without_summary", lambda model: seen.append(spark.conf.get(_SPLIT)) or model)
    models.cross_validate(models.regressors()["Linear Regression"], vectors.limit(1000), "key", "regression")
    assert seen == [str(models.FIT_BYTES)] * 5 and spark.conf.get(_SPLIT) != seen[0]


def test_folds_fitted_together_score_as_one_by_one(spark, monkeypatch):
    rows = spark.range(0, 600).select(F.col("id").alias("key"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    vectors = models.training_vectors(rows.withColumn("label", F.col("a") + F.rand(3)), ["a", "b"])
    model = models.regressors()["Linear Regression"]
    together = models.cross_validate(model, vectors, "key", "regression")
    monkeypatch.setattr(models, "FOLDS_AT_ONCE", 1)
    assert together == pytest.approx(models.cross_validate(model, vectors, "key", "regression"))
    with pytest.raises(ValueError):
        models.cross_validate(model, vectors.where("key = 1"), "key", "regression")
