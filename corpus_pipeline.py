"""From raw documents to packed sequences: rules, classifier, near duplicates, secrets, packing.

Each stage takes the documents its predecessor kept. All but the last return the columns of
documents, whatever further columns there are and however they are named; the last returns the
pieces of the packed sequences. An empty table passes through every stage as one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm import jaccard, packing, quality_classifier, quality_rules, secrets
from headway.llm.common import table
from headway.plans.staging import new_path, stage

#: Lists of ids are broadcast up to this length, and joined by sorting beyond it.
BROADCAST_IDS = 4_000_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def small(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules.

    Null and empty texts go, as all of under 50 words. Rows are judged one by one, so repeated rows
    stay or go together; a null language is judged by all references.
    """
    return quality_rules.kept_by_rules(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled raw documents, holds to be good.

    Null and empty texts are no evidence and stay or go by the share of good labels. Rows are judged
    one by one, whatever their ids.
    """
    model = quality_classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.kept_by_classifier(docs, model)


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of the documents has them."""
    taken = {c.lower() for c in docs.columns}
    return [next(n + "_" * k for k in range(len(taken) + 1) if n + "_" * k not in taken) for n in names]


def _first(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, nulls being one: the least by a hash of all columns, so no chance decides."""
    (rank,) = _unused(rows, "rank")
    order = [F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))), F.col("`text`")]
    place = F.row_number().over(Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order))
    return rows.withColumn(rank, place).where(F.col(rank) == 1).drop(rank)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows that share an id are told apart by their class: of a group's rows with its smallest id, one
    of the smallest class stays. Rows without an id, and texts without words, null ones included,
    stay once per id and text. Of rows alike in all that, the least by a hash of all columns stays.
    """
    copy, repeat, first_id, first_class, class_ = _unused(docs, "copy_id", "repeated_id", "first_id", "first_class", "class")
    found = stage(jaccard.jaccard_classes(docs, words=5, percent=80), "near_duplicates")
    repeated = stage(found.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL"), "repeated_ids")
    repeated = repeated.select(F.col("doc_id").alias(repeat))
    copies = found.where("doc_id <> component_id").select(F.col("doc_id").alias(copy))
    copies = copies.join(repeated, F.col(copy) == F.col(repeat), "left_anti")
    kept = docs.join(small(copies), F.col("doc_id") == F.col(copy), "left_anti")
    if repeated.isEmpty():
        return kept
    same = F.col("doc_id").eqNullSafe(F.col(repeat))
    first = found.where("doc_id IS NOT NULL AND class IS NOT NULL").groupBy("component")
    first = first.agg(F.min(F.struct("doc_id", "class")).alias("first"))
    first = first.select(F.col("first.doc_id").alias(first_id), F.col("first.class").alias(first_class))
    first = stage(first.join(repeated, F.col(first_id) == F.col(repeat), "left_semi"), "first_rows")
    rows = kept.join(small(repeated), same, "left_semi").withColumn(class_, jaccard.class_of(5)(F.col("text")))
    by_text = F.col("doc_id").isNull() | F.col(class_).isNull()
    chosen = (F.col("doc_id") == F.col(first_id)) & (F.col(class_) == F.col(first_class))
    once = _first(rows.where(~by_text).join(small(first), chosen, "left_semi"), ["doc_id", class_])
    once = once.unionByName(_first(rows.where(by_text), ["doc_id", "text"])).drop(class_)
    return kept.join(small(repeated), same, "left_anti").unionByName(once)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and their lengths counted anew.

    Null texts stay null, and so do their lengths; rows keep their order of columns and their number.
    """
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that the documents are packed into.

    Null and empty texts are packed as their end mark alone; repeated rows are packed each.
    """
    return packing.with_checksums(packing.pack(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_duplicates", near_duplicates_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Compression, trained models and packing can't be said in SQL; tests hold stages to brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        path = new_path(spark, f"pipeline_{name}")
        apply(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
