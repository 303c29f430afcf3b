"""Writers: result rows, reports, snapshots with evolving columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, one folder per source; dates as ISO text. A source's old rows are replaced."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("ignoreNullFields", "false").partitionBy("site").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quoted fields and backslash escapes."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", "\\").csv(path)


def append_report(report: DataFrame, path: str) -> None:
    report.write.mode("append").parquet(path)


def evolve(current: DataFrame, new: DataFrame) -> DataFrame:
    """Both sets of columns; those one side lacks are null there."""
    return current.unionByName(new, allowMissingColumns=True)


def write_snapshot(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """A new snapshot under its own path; the caller switches readers to it."""
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def read_evolved(spark: SparkSession, *paths: str) -> DataFrame:
    """Snapshots of different age as one table."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)
