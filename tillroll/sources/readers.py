"""Readers for raw files, the star tables, the line extract and exported marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.functions.fixed_values import MISSING_MARKERS, READABLE_NAMES
from tillroll.operators.cleaning import union_partitions
from tillroll.plans.metrics import clean_dashboard_fact
from tillroll.sources.schemas import (
    ENRICHED_COLUMNS,
    MART_SCHEMAS,
    STAR_SCHEMAS,
    STAR_TABLES,
    string_schema,
)
from tillroll.sources.versions import published_version
from tillroll.sources.writers import CSV_OPTIONS


def _blank_to_null(df: DataFrame) -> DataFrame:
    return df.select(
        [F.when(~F.col(c).isin(MISSING_MARKERS), F.col(c)).alias(c) for c in df.columns]
    )


def read_raw_csv(
    spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1", multi_line: bool = False
) -> DataFrame:
    """Raw lines as text under the names in the file's header.

    All files of one call must have the same header, which Spark checks; read
    files of another layout apart and stack them with ``union_partitions``.
    ``multi_line`` allows line breaks inside quotes, at the price of one task per file.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("enforceSchema", False)
    return _blank_to_null(reader.option("encoding", encoding).option("multiLine", multi_line).csv(path))


def read_raw_periods(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One file per period, stacked by column name."""
    return union_partitions([read_raw_csv(spark, p) for p in paths])


def read_processed_fact(spark: SparkSession, path: str) -> DataFrame:
    """The line extract, typed leniently and with the dashboard columns."""
    text = spark.read.options(**CSV_OPTIONS).schema(string_schema(ENRICHED_COLUMNS)).csv(path)
    return clean_dashboard_fact(_blank_to_null(text))


def load_star(spark: SparkSession, folder: str, views: bool = True) -> dict[str, DataFrame]:
    """The four star tables of the newest published version with their declared schemas, also as views."""
    version = published_version(spark, folder)
    star = {
        name: spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{version}/{name}") for name in STAR_TABLES
    }
    if views:
        for name, table in star.items():
            table.createOrReplaceTempView(name)
    return star


def type_mart_exports(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The exported mart files with their declared column types."""
    return {
        name: spark.read.options(**CSV_OPTIONS).schema(schema).csv(f"{folder.rstrip('/')}/{name}")
        for name, schema in MART_SCHEMAS.items()
    }


def read_extracts(spark: SparkSession, folder: str, schemas: dict[str, StructType]) -> dict[str, DataFrame]:
    """The exported extracts with the given column types."""
    return {
        name: spark.read.options(**CSV_OPTIONS).schema(schema).csv(f"{folder.rstrip('/')}/{name}")
        for name, schema in schemas.items()
    }


def readable_names(df: DataFrame) -> DataFrame:
    """Captions instead of column names, where there is one."""
    return df.withColumnsRenamed({k: v for k, v in READABLE_NAMES.items() if k in df.columns})


def dedupe_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key. Null keys count as one key."""
    return df.dropDuplicates([key])
