"""Parquet table access for the driver-provided data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """``spark.read.parquet`` of one table; pruning and pushdown stay with Catalyst.

    ``partitions`` deals the rows out anew, for CPU-bound work on a table of few row groups.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(partitions) if partitions else df


def read_daily(spark: SparkSession, folder: str, first_day: str | None = None, last_day: str | None = None,
               pattern: str = r"(\d{4}-\d{2}-\d{2})[^/]*$") -> DataFrame:
    """A folder of one Parquet file per day, named by its date; ``day`` comes from the file name.

    Files outside [first_day, last_day] are filtered by name before their rows are decoded further.
    """
    df = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    df = df.withColumn("day", F.to_date(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)))
    if first_day is not None:
        df = df.where(F.col("day") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        df = df.where(F.col("day") <= F.lit(last_day).cast("date"))
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Columnar write; partition columns prune later scans."""
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
