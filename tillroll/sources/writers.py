"""Writers for the star tables and the CSV exports."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.schemas import MART_SCHEMAS, STAR_SCHEMAS, STAR_TABLES, conform_to_schema
from tillroll.sources.versions import publish_version, refuse_own_input
from tillroll.sources.workspace import CODEC, freed_shuffles

# Quotes inside quotes are doubled, blanks are kept; the same for reading and writing.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# Marts of one row per month or country at most; the customer mart stays in many files.
_ONE_FILE_MARTS = {
    "mart_executive_kpis",
    "mart_repeat_purchase_metrics",
    "mart_country_revenue",
    "mart_sales_monthly",
}


@dataclass
class ExportResult:
    exported: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)

    @property
    def complete(self) -> bool:
        return not self.missing


def write_star(tables: dict[str, DataFrame], folder: str) -> str:
    """Replace all star tables together; returns the folder of the new version.

    They are written to a folder of their own, dimensions first and then the fact,
    and are published in one step at the end. If a write fails, the tables that were
    published before stay. Tables that are read from ``folder`` are refused.
    """
    spark = next(iter(tables.values())).sparkSession
    refuse_own_input(tables, folder)

    def write(version: str) -> None:
        for name in STAR_TABLES:
            table = conform_to_schema(tables[name], STAR_SCHEMAS[name])
            table.write.option("compression", CODEC).parquet(f"{version}/{name}")

    with freed_shuffles(spark):
        return publish_version(spark, folder, write)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    out = df.coalesce(1) if one_file else df
    with freed_shuffles(df.sparkSession):
        out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def export_marts(
    spark: SparkSession, folder: str, mart_schema: str | None = "analytics_marts"
) -> ExportResult:
    """Write each mart that exists to CSV and report those that do not.

    ``mart_schema=None`` exports the temporary views of ``register_layers``.
    """
    result = ExportResult()
    for name in MART_SCHEMAS:
        table = f"{mart_schema}.{name}" if mart_schema else name
        if not spark.catalog.tableExists(table):
            result.missing.append(name)
            continue
        target = f"{folder.rstrip('/')}/{name}"
        write_csv(spark.table(table), target, one_file=name in _ONE_FILE_MARTS)
        result.exported.append(name)
    return result


def export_bi_extracts(extracts: dict[str, DataFrame], folder: str) -> None:
    """Write each extract to CSV; the line extract stays in many files."""
    for name, df in extracts.items():
        small = name != "fact_sales_enriched"
        write_csv(df, f"{folder.rstrip('/')}/{name}", one_file=small)
