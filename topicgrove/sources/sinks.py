"""Table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str) -> None:
    """Replace ``path`` with a Parquet table; arrays keep their type."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace ``path`` with CSV files with a header; arrays are written as JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema
    ]
    df.select(flat).write.mode("overwrite").csv(path, header=True, escape='"')
