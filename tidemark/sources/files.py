"""File listings, footer schemas and the tenant manifest."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import TENANT_MANIFEST
from tidemark.sinks import storage

_LEVELS = ("year", "month", "day", "hour")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Tenant manifest: one JSON array; `position` keeps the order of its entries."""
    text = spark.read.option("wholetext", True).text(path)
    entries = F.from_json("value", F.lit(f"array<{TENANT_MANIFEST.simpleString()}>"))
    return text.select(F.posexplode(entries).alias("position", "entry")).select(
        "entry.*", "position"
    )


def list_files(
    spark: SparkSession, path: str | list[str], glob: str = "*.parquet"
) -> DataFrame:
    """Recursive listing (path, size, modified_at); file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"))
    )


def has_data(files: DataFrame) -> bool:
    """Guard of jobs that skip an empty directory."""
    return not files.isEmpty()


def newest_file(files: DataFrame) -> str | None:
    """Path of the most recently modified file; ties go to the greatest path."""
    row = files.agg(F.max(F.struct("modified_at", "path")).alias("newest")).first()
    return row.newest.path if row.newest else None


def read_footer_schema(spark: SparkSession, path: str) -> DataFrame:
    """An unread DataFrame with the columns and types in one file's footer."""
    return spark.read.parquet(path).limit(0)


def schema_rows(df: DataFrame) -> DataFrame:
    """(col_name, data_type) of a DataFrame, types in Spark's short notation."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "col_name STRING, data_type STRING")


def partition_dates(files: DataFrame) -> DataFrame:
    """Distinct dates that own at least one file, from `dt=` or year/month/day directories."""
    named = F.regexp_extract("path", r"/dt=(\d{4}-\d{2}-\d{2})/", 1)
    parts = [
        F.regexp_extract("path", r"/(?:year=)?(\d{4})/(?:month=)?(\d{1,2})/(?:day=)?(\d{1,2})/", i)
        for i in (1, 2, 3)
    ]
    date = F.coalesce(
        named.try_cast("date"), F.concat_ws("-", *parts).try_cast("date")
    )
    return files.select(date.alias("dt")).filter(F.col("dt").isNotNull()).distinct()


def newest_directory(spark: SparkSession, root: str) -> str | None:
    """The latest `year=/month=/day=/hour=` directory that has files: a listing per level."""

    def latest(path: str, depth: int) -> str | None:
        names = storage.children(spark, path)
        if depth == len(_LEVELS):
            return path if any(n.endswith(".parquet") for n in names) else None
        own = [n for n in names if n.startswith(f"{_LEVELS[depth]}=")]
        for name in sorted(own, key=lambda n: int(n.partition("=")[2]), reverse=True):
            if found := latest(f"{path}/{name}", depth + 1):
                return found
        return None

    return latest(root.rstrip("/"), 0)


def hour_of(directory: str) -> datetime:
    """Time of an hour directory."""
    values = dict(part.split("=") for part in directory.split("/") if "=" in part)
    return datetime(*(int(values[level]) for level in _LEVELS))
