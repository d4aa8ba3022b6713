"""Result tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sink_table(df: DataFrame, folder: str, name: str, fmt: str = "parquet") -> str:
    """Write the data table of a figure or report as ``folder/name``; returns the path."""
    path = f"{folder.rstrip('/')}/{name}"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path
