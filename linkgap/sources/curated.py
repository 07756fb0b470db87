"""Curated CSV files: category overrides, actions, duplicates.

Header line, standard quoting (fields may hold quoted commas, doubled
quotes escape a quote), declared schema, FAILFAST. A header-only file is
0 rows; a missing file is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas
from ..operators.load import path_exists


def read_curated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"missing curated file {path}")
    return (spark.read.schema(schema).option("header", "true").option("quote", '"')
            .option("escape", '"').option("multiLine", "true").option("mode", "FAILFAST").csv(path))


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    return read_curated(spark, path, schemas.OVERRIDES)


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    return read_curated(spark, path, schemas.ACTIONS)


def read_duplicates(spark: SparkSession, path: str) -> DataFrame:
    return read_curated(spark, path, schemas.DUPLICATES)


def write_curated(df: DataFrame, path: str) -> None:
    """CSV with a header line per part file, written by every task in
    parallel (a list derived from data can be large); readers take the
    folder."""
    (df.write.mode("overwrite").option("header", "true").option("quote", '"')
     .option("escape", '"').csv(path))
