"""Report sinks: JSON lines, and CSV with lists written out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def list_cell(c: Column) -> Column:
    """['a', 'b'], or [] for an empty list."""
    return F.when(F.size(c) <= 0, "[]").otherwise(F.concat(F.lit("['"), F.array_join(c, "', '"), F.lit("']")))


def csv_ready(df: DataFrame) -> DataFrame:
    return df.select(*(list_cell(F.col(f.name)).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name) for f in df.schema))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; a table without rows has none."""
    csv_ready(df).write.mode("overwrite").option("header", not df.isEmpty()).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
