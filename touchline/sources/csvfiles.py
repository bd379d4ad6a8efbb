"""CSV loaders of the historical facts and the dimensions."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from touchline.operators.normalise import dedupe, normalise
from touchline.schemas import FACTS, WarehouseTable
from touchline.sources import files

SOURCE_FILE = "source_file"

#: Headers read at the same time; on an object store each one is a round trip.
HEADER_THREADS = 32


def empty_table(spark: SparkSession, table: WarehouseTable) -> DataFrame:
    return spark.createDataFrame([], table.schema)


def read_text_columns(
    spark: SparkSession, paths: list[str], header: list[str], multi_line: bool = False
) -> DataFrame:
    """Read CSV files of one header with every column as text.

    Nothing is inferred, so an id keeps its digits whatever stands beside it.
    ``multi_line`` allows line breaks in quoted fields, but then a file can't be
    split over tasks.
    """
    schema = StructType([StructField(name, StringType()) for name in header])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(paths)
    )


def load_csv(
    spark: SparkSession,
    pattern: str,
    table: WarehouseTable,
    multi_line: bool = False,
    with_source: bool = False,
) -> DataFrame:
    """Normalised rows of all files that match; an empty table if none does.

    Files are grouped by header, since files of one table may differ in columns
    or their order; each group is one scan.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    paths = files.glob(spark, pattern)
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        headers = pool.map(lambda path: files.csv_header(spark, path), paths)
    for path, header in zip(paths, headers):
        groups.setdefault(tuple(header), []).append(path)
    groups.pop((), None)
    parts = []
    for header, paths in groups.items():
        raw = read_text_columns(spark, paths, list(header), multi_line)
        if with_source:
            raw = raw.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
        parts.append(normalise(raw, table, keep=(SOURCE_FILE,) if with_source else ()))
    if not parts:
        empty = empty_table(spark, table)
        return empty.withColumn(SOURCE_FILE, F.lit("")) if with_source else empty
    return reduce(DataFrame.unionByName, parts)


def load_facts(spark: SparkSession, pattern: str, multi_line: bool = False) -> DataFrame:
    """Historical events of all fact files.

    They hold ids, numbers and event names, so by default a file is split over tasks.
    """
    return load_csv(spark, pattern, FACTS, multi_line)


def load_dimension(
    spark: SparkSession,
    pattern: str,
    table: WarehouseTable,
    multi_line: bool = True,
    unique: bool = True,
) -> DataFrame:
    """A dimension with one row per key, the one of the last file by path.

    Names are free text, so quoted line breaks are read as such; a file is then one
    task's work. ``unique=False`` keeps every row, as appending loads would.
    """
    if not unique:
        return load_csv(spark, pattern, table, multi_line)
    rows = load_csv(spark, pattern, table, multi_line, with_source=True)
    return dedupe(rows, table.key, SOURCE_FILE).select(*table.columns)


def count_by_file(rows: DataFrame) -> DataFrame:
    """Loaded rows per source file of a load made ``with_source``."""
    return rows.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows"))
