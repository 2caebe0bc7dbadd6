"""Typed scans of the input tables and column parsing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderloom.sources.schemas import TABLES


def read_table(spark: SparkSession, name: str, path: str, file_format: str | None = None) -> DataFrame:
    """Scan one input table with its declared schema from CSV or Parquet.

    CSV text is read strictly: a malformed date or number fails the job instead of
    turning into NULL. CSV columns are matched to the schema through the header.
    """
    schema = TABLES[name]
    kind = file_format or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if kind == "parquet":
        return spark.read.schema(schema).parquet(path)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("dateFormat", "yyyy-MM-dd")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_forecast(spark: SparkSession, path: str, file_format: str | None = None) -> DataFrame:
    """Scan the frozen forecast fact (a leading byte-order mark is accepted)."""
    return read_table(spark, "model_forecast_results", path, file_format)


def read_text_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The same CSV with every column as text, for cleaning with the parsers below."""
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in TABLES[name].fields])
    return spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)


def parse_dates(df: DataFrame, column: str, strict: bool = True) -> DataFrame:
    """Parse a text date: strict fails on bad input, lenient yields NULL."""
    text = F.col(column)
    parsed = F.to_date(text) if strict else F.try_to_timestamp(text).cast("date")
    return df.withColumn(column, parsed)


def parse_numbers(df: DataFrame, columns: Iterable[str], kind: str = "bigint") -> DataFrame:
    """Parse text numbers leniently; what does not parse becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name in columns})


def register_sources(frames: Mapping[str, DataFrame]) -> None:
    """Expose frames under their table names for `spark.sql`."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
