"""Writers for the panel, the forecast fact and the reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import NumericType, StructType

from orderloom.constants import CELL_KEYS


def write_frame(df: DataFrame, path: str, file_format: str = "parquet", partition_by: str | None = None) -> None:
    """Write Parquet, or CSV with a header and ISO dates."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if file_format == "csv":
        writer.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    else:
        writer.parquet(path)


def write_panel(panel: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Panel or features; Parquet is partitioned by year so later reads can prune."""
    write_frame(panel, path, file_format, "Year" if file_format == "parquet" else None)


def _read_back(schema: StructType, spark: SparkSession, path: str, file_format: str) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True) if file_format == "csv" else reader.parquet(path)


def write_forecast(results: DataFrame, path: str, file_format: str = "csv") -> None:
    """Forecast fact in cell order, with ISO dates and full double precision, read back and compared.

    What was saved has the rows, cells and sums of what was to be saved.
    """
    write_frame(results.orderBy(*CELL_KEYS), path, file_format)
    saved = _read_back(results.schema, results.sparkSession, path, file_format)
    numbers = [f.name for f in results.schema if isinstance(f.dataType, NumericType) and f.name not in CELL_KEYS]
    facts = [F.count(F.lit(1)), *[F.count(c) for c in (*CELL_KEYS, *numbers)],
             *[F.sum(F.col(c).cast("decimal(38,10)")) for c in numbers],
             F.sum(F.xxhash64(*[F.col(c).cast("string") for c in CELL_KEYS]).cast("decimal(38,0)"))]
    wrote, read = (tuple(df.agg(*facts).first()) for df in (results, saved))
    if wrote != read:
        raise ValueError(f"Saved forecast differs: {wrote} written, {read} read")


def report_names(reports: Mapping[str, Callable]) -> list[str]:
    """Names of a report registry, which must be non-empty and well formed."""
    names = list(reports)
    if not names or any(not n or n != n.strip().lower() for n in names):
        raise ValueError("Report names must be non-empty lower-case identifiers.")
    return names


def export_reports(
    reports: Mapping[str, DataFrame], folder: str, file_format: str = "csv"
) -> dict[str, int]:
    """Write every report to its own dataset and verify the row counts read back."""
    written = {}
    for name in report_names(reports):
        path, seen = f"{folder.rstrip('/')}/{name}", Observation()
        frame = reports[name]
        write_frame(frame.observe(seen, F.count(F.lit(1)).alias("rows")), path, file_format)
        rows = _read_back(frame.schema, frame.sparkSession, path, file_format).count()
        if rows != seen.get["rows"]:
            raise ValueError(f"Export row mismatch in {name}: wrote {seen.get['rows']}, read {rows}")
        written[name] = rows
    return written
