"""Where results go: markdown and JSON files by book, and a manifest whose row is written last."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_markdown(chapters: DataFrame, folder: str, file_name: str = "file_name", md: str = "md") -> None:
    """One folder per file name, its text lines as they are; tasks write their own files, and a rewrite replaces only the folders it has."""
    rows = chapters.select(F.col(md).alias("value"), F.col(file_name).alias("file_name"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_name").text(folder)


def write_reports(report: DataFrame, folder: str, by: list[str]) -> None:
    report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(folder)


def record(files: DataFrame, manifest: str, version: str) -> None:
    """Appends what was processed, after its results are written: a run that fails before is repeated."""
    files.select("path", F.lit(version).alias("version"), "sha1").write.mode("append").parquet(manifest)
