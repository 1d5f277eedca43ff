"""Parquet table scans over a scale-factor directory.

Scans are lazy; Catalyst prunes columns and pushes filters into the Parquet
reader, so callers should ``select`` only what they need right after reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read one supplied table; ``cols`` narrows the projection at the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df
