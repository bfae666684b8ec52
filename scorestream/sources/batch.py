"""Batch readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def table_scan(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, Any] | None = None,
    view: str | None = None,
) -> DataFrame:
    """Scan a table through any installed connector.

    A warehouse connector takes its table name as an option, for instance
    ``fmt="bigquery", options={"table": "dataset.table"}``.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    df = reader.load(path) if path else reader.load()
    if view:
        df.createOrReplaceTempView(view)
    return df


def csv_scan(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    header: bool = True,
    mode: str = "DROPMALFORMED",
    **options: Any,
) -> DataFrame:
    """CSV with a given schema, or with every column a string.

    Whether a record is malformed is judged on all its columns, whatever the
    query selects: otherwise a count would keep rows that a full read drops.
    """
    reader = spark.read.options(header=header, mode=mode, columnPruning=False, **options)
    if schema is None:
        return reader.csv(path)
    df = reader.schema(schema).csv(path)
    if mode.upper() != "DROPMALFORMED":
        return df
    # Always true, but it makes every column a required one.
    return df.where(F.hash(*df.columns) <= F.lit(2**31 - 1))


def json_scan(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    **options: Any,
) -> DataFrame:
    """JSON lines from a file, a directory or several of them, as one scan.

    Without a schema the input is read once more to infer it.
    """
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def binary_scan(
    spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """Whole files: path, modificationTime, length, content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def whole_text_scan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per text file, with its path."""
    return spark.read.text(path, wholetext=True).select("_metadata.file_path", "value")


def driver_rows(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    """A small table written down in the program, such as a label list."""
    return spark.createDataFrame(list(rows), schema)
