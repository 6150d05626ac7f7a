"""File scans and sinks: CSV, Parquet, JSON documents and JSON record pages."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions.core import ratio
from headway.sources.schemas import HOLIDAY_SCHEMA, WEATHER_DOCUMENT_SCHEMA, WEATHER_RENAMES


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    multi_line: bool = False,
    bad_rows: str | None = None,
) -> DataFrame:
    """Header CSV, columns matched by name: the declared ones, null where the header lacks them.

    Without a schema Spark infers one, which costs a second pass over the files. Fields with line
    breaks need `multi_line`, which reads each file in one task. A file whose header differs from
    the first one's ends the read instead of shifting its values. With `bad_rows` a column of that
    name holds the text of every line that does not fit the schema, so that they can be counted.
    """
    options = {"header": True, "mode": "PERMISSIVE", "escape": '"', "multiLine": multi_line}
    reader = spark.read.options(**options, enforceSchema=False)
    if schema is None:
        return reader.csv(path, inferSchema=True)
    wanted = T.StructType.fromDDL(schema)
    kinds = {field.name: field.dataType for field in wanted}
    header = spark.read.options(**options).csv(path).columns
    fields = [T.StructField(name, kinds.get(name, T.StringType())) for name in header]
    if bad_rows:
        reader = reader.options(enforceSchema=True, columnNameOfCorruptRecord=bad_rows)
        fields.append(T.StructField(bad_rows, T.StringType()))
    rows = reader.schema(T.StructType(fields)).csv(path)
    columns = [
        F.col(f"`{f.name}`") if f.name in header else F.lit(None).cast(f.dataType).alias(f.name)
        for f in wanted
    ]
    return rows.select(*columns, *([bad_rows] if bad_rows else []))


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; quotes are doubled inside quoted fields, and text keeps its outer blanks."""
    df.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def read_table(
    spark: SparkSession, base: str, schema: str | None = None, dates: tuple[str, ...] = ("date",)
) -> DataFrame:
    """`base.parquet` if it exists, else `base.csv`; listed date columns are coerced."""
    try:
        df = spark.read.parquet(f"{base}.parquet")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        df = read_csv(spark, f"{base}.csv", schema)
    text = {name for name, kind in df.dtypes if kind == "string"}
    return df.withColumns({c: F.col(c).try_cast("date") for c in dates if c in text})


def _bytes_of(spark: SparkSession, path: str, kind: str, files: str = "part-*") -> DataFrame:
    """Sizes from the file listing that the binary-file source does without opening the files."""
    found = spark.read.format("binaryFile").options(pathGlobFilter=files, recursiveFileLookup=True)
    return found.load(path).select(F.lit(kind).alias("kind"), "length")


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header) of every CSV file under a path: the first line of each, found in two scans.

    Headers hold no line breaks. Sums of numbers are kept per file in place, while texts would have
    every line sorted by file, so the place of the first line is found first, and its text by it.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    lines = lines.where("block = 0")
    first = lines.groupBy("file").agg(F.min("line").alias("line"))
    return lines.join(first.hint("broadcast"), ["file", "line"]).select("file", F.col("value").alias("header"))


def read_csv_folder(
    spark: SparkSession, path: str, schema: str | None = None, bad_rows: str | None = None, file: str | None = None
) -> DataFrame:
    """All CSV files under a path as one table, whatever columns each file has, in whatever order.

    Files are grouped by header: one scan per distinct header, columns matched by name, null where a
    file lacks one. With a schema its columns are returned; without one, the union of all columns,
    as text where files disagree about a type. `bad_rows` names a column for the text of lines that
    don't fit, `file` one for the file that a row is from. The list of files reaches the driver, as
    for any scan.
    """
    found = csv_headers(spark, path).groupBy("header").agg(F.sort_array(F.collect_set("file")).alias("files"))
    groups = [row["files"] for row in found.orderBy("header").collect()]
    if not groups:
        return spark.createDataFrame([], schema or "none STRING")
    parts = []
    for files in groups:
        part = read_csv(spark, files, schema, bad_rows=bad_rows if schema else None)
        if file:
            part = part.withColumn(file, F.input_file_name())
        parts.append(part)
    kinds: dict[str, set[str]] = {}
    for part in parts:
        for name, kind in part.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = {name for name, own in kinds.items() if len(own) > 1}
    parts = [p.withColumns({c: F.col(f"`{c}`").cast("string") for c in p.columns if c in mixed}) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def bad_rows_by_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, records, bad_records) of every file under a path that holds rows: one scan."""
    rows = read_csv_folder(spark, path, schema, bad_rows="_bad", file="_file")
    columns = [F.col(f"`{c}`") for c in rows.columns if c not in ("_bad", "_file")]
    one = F.pmod(F.xxhash64(*columns), F.lit(1)) + 1  # a column that nothing reads is not parsed
    return rows.groupBy(F.col("_file").alias("file")).agg(
        F.sum(one).alias("records"), F.count("_bad").alias("bad_records")
    )


def csv_to_parquet(spark: SparkSession, tables: dict[str, tuple[str, str, str | None]]) -> DataFrame:
    """Convert each `name: (csv path, parquet path, schema)`, a file or a folder of files.

    Reports per table the rows written and those that did not fit the schema (kept, with nulls),
    counted while writing, and the bytes of both sides with their ratio.
    """
    reports = []
    for name, (source, target, schema) in tables.items():
        rows = read_csv_folder(spark, source, schema, bad_rows="_bad")
        bad = F.count("_bad") if schema else F.sum(F.lit(0))
        seen = Observation(f"rows of {name}")
        rows = rows.observe(seen, F.count(F.lit(1)).alias("records"), bad.alias("bad"))
        rows.drop("_bad").write.option("compression", "snappy").parquet(target)
        counts = seen.get
        both = _bytes_of(spark, source, "csv", "*").union(_bytes_of(spark, target, "parquet"))
        sums = [
            F.sum(F.when(F.col("kind") == kind, F.col("length"))).alias(f"{kind}_bytes")
            for kind in ("csv", "parquet")
        ]
        reports.append(
            both.agg(*sums).select(
                F.lit(name).alias("table_name"),
                F.lit(counts["records"]).cast("bigint").alias("records"),
                F.lit(counts["bad"] or 0).cast("bigint").alias("bad_records"),
                "csv_bytes",
                "parquet_bytes",
            )
        )
    report = reduce(DataFrame.union, reports)
    return report.withColumn("size_ratio", ratio(F.col("parquet_bytes"), F.col("csv_bytes")))


def csv_folder_to_parquet(
    spark: SparkSession, folder: str, schemas: dict[str, str] | None = None
) -> DataFrame:
    """Convert every `name.csv` in a folder to `name.parquet` beside it; report as above.

    The list of files is as long as the folder has tables.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    sources = sorted(row["path"] for row in found.select("path").distinct().collect())
    tables = {}
    for source in sources:
        base = source.removesuffix(".csv")
        name = base.rpartition("/")[2]
        tables[name] = (source, f"{base}.parquet", (schemas or {}).get(name))
    return csv_to_parquet(spark, tables)


def read_weather_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Documents of parallel arrays, one array per measure, to one row per day.

    A measure that a document lacks is null on all of its days. `multi_line` is for documents that
    span lines, one per file; otherwise one document per line.
    """
    fields = ["time", *WEATHER_RENAMES]
    arrays = [F.coalesce(F.col(f"daily.{name}"), F.array()).alias(name) for name in fields]
    zipped = F.arrays_zip(*arrays)
    names = {"time": "date", **WEATHER_RENAMES}
    return (
        spark.read.schema(WEATHER_DOCUMENT_SCHEMA)
        .option("multiLine", multi_line)
        .json(path)
        .select(F.inline(zipped).alias(*fields))
        .withColumn("time", F.col("time").try_cast("date"))
        .select([F.col(old).alias(new) for old, new in names.items()])
    )


def read_record_pages(
    spark: SparkSession, path: str, schema: str | None = None, array_pages: bool = False
) -> DataFrame:
    """Ragged record pages as one table: a key missing from a page or record is null.

    Without a schema the columns are the union of the keys of all pages, found by a pass over
    every record. A schema saves that pass and keeps its keys alone. `array_pages` is for pages
    that hold one JSON array each; otherwise one record per line.
    """
    reader = spark.read.option("multiLine", array_pages).option("samplingRatio", 1.0)
    return (reader.schema(schema) if schema else reader).json(path)


def read_holidays(spark: SparkSession, path: str, array_pages: bool = False) -> DataFrame:
    """Holiday objects to event rows; a missing `global` counts as nationwide."""
    days = read_record_pages(spark, path, HOLIDAY_SCHEMA, array_pages)
    return days.select(
        "date",
        F.col("localName").alias("event_name"),
        F.lit("Public Holiday").alias("event_type"),
        F.lit(0).cast("bigint").alias("expected_attendance"),
        F.lit("High").alias("impact_level"),
        F.coalesce("global", F.lit(True)).alias("nationwide"),
    )


def export_head(df: DataFrame, order: list[str], path: str | None = None, rows: int = 1000) -> DataFrame:
    """The first `rows` rows in a total order, optionally written as CSV."""
    head = df.orderBy([F.col(c).asc_nulls_last() for c in order]).limit(rows)
    if path is not None:
        write_csv(head, path)
    return head
