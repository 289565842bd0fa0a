"""Files that hold a small range of time and of users, and the choice of those a read needs.

Rows are ordered along a curve that interleaves the bits of two ranks: the rank of the time
among its quantiles, and the leading bits of a hash of the user. A file is then a near-square
piece of both, whereas files ordered by time alone hold every user. A table of the least and
greatest rank and time per file picks the files of a read before any of them is opened. The
cuts between files come from a sample, so a file can hold the end of one square and the start
of a far one; the ranges are therefore kept per box, a small square of the curve, as well.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.intervals import Interval, in_interval, ts
from tidemark.sinks import tables

#: Bits of each rank. Quantiles are approximate; they only decide where rows lie.
RANK_BITS = 8
#: The least number of boxes the curve has per file. It has at most 4 times as many, and no more
#: than 2^(2 * RANK_BITS) in all; a cut between two files divides at most one of them.
BOXES_PER_FILE = 16
#: What the table of files tells of a file and of a box.
RANGES = ("first", "last", "least_rank", "greatest_rank")


def user_rank(user: str | Column, bits: int = RANK_BITS) -> Column:
    """The leading bits of a hash of the user; NULL users share one rank."""
    return F.shiftrightunsigned(F.xxhash64(user), 64 - bits)


def time_bounds(df: DataFrame, time_col: str = "created_at", bits: int = RANK_BITS) -> list[int]:
    """Times in microseconds that divide the rows into 2^bits parts of about equal size."""
    parts = 1 << bits
    at = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(F.unix_micros(time_col), at, 10 * parts)).first()[0]
    return sorted(set(found or []))


def time_rank(time_col: str, bounds: list[int]) -> Column:
    """How many bounds are at or below a time, by halving; a NULL time ranks first."""
    value = F.coalesce(F.unix_micros(time_col), F.lit(-(1 << 63)))

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < bounds[middle], between(low, middle)).otherwise(
            between(middle + 1, high)
        )

    return between(0, len(bounds))


def interleave(a: Column, b: Column, bits: int = RANK_BITS) -> Column:
    """The bits of two numbers in turn, the highest first."""
    out = F.lit(0).cast("long")
    for i in range(bits):
        for number, place in ((a, 2 * i + 1), (b, 2 * i)):
            bit = F.shiftright(number.cast("long"), i).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, place))
    return out


def write_clustered(
    df: DataFrame, path: str, files: int, time_col: str = "created_at", user_col: str = "user_id"
) -> None:
    """Write `df` as about `files` files along the curve, and the table of their ranges beside."""
    bounds = time_bounds(df, time_col)
    # Columns of their own, so that each rank is worked out once per row.
    ranked = df.withColumns({"_time": time_rank(time_col, bounds), "_user": user_rank(user_col)})
    curve = interleave(F.col("_time"), F.col("_user"))
    placed = ranked.withColumn("_curve", curve).drop("_time", "_user")
    # The time breaks ties, so one full cell of the curve can be cut too.
    placed.repartitionByRange(files, "_curve", time_col).sortWithinPartitions(
        "_curve", time_col
    ).drop("_curve").write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    rows = spark.read.schema(df.schema).parquet(path)
    tables.replace_table(file_ranges(rows, bounds, files, time_col, user_col), index_path(path))


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}_files"


def box_bits(files: int) -> int:
    """How many leading bits of both ranks name a box."""
    return min(RANK_BITS, math.ceil(math.log2(max(files, 1) * BOXES_PER_FILE) / 2))


def file_ranges(
    rows: DataFrame,
    bounds: list[int],
    files: int,
    time_col: str = "created_at",
    user_col: str = "user_id",
) -> DataFrame:
    """(file, rows, first, last, least_rank, greatest_rank, boxes) of the files of a scan.

    `boxes` holds the same ranges of the rows of each box within the file.
    """
    bits = box_bits(files)
    step = 1 << (RANK_BITS - bits)
    rank = user_rank(user_col)
    boxes = rows.groupBy(
        F.col("_metadata.file_path").alias("file"),
        # Every step-th bound: the leading bits of the time's rank.
        time_rank(time_col, bounds[step - 1 :: step]).alias("_time"),
        user_rank(user_col, bits).alias("_user"),
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(time_col).alias("first"),
        F.max(time_col).alias("last"),
        F.min(rank).alias("least_rank"),
        F.max(rank).alias("greatest_rank"),
    )
    return boxes.groupBy("file").agg(
        F.sum("rows").alias("rows"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.min("least_rank").alias("least_rank"),
        F.max("greatest_rank").alias("greatest_rank"),
        F.collect_list(F.struct(*RANGES)).alias("boxes"),
    )


def files_of(index: DataFrame, iv: Interval, users: list[str]) -> list[str]:
    """The files that can hold rows of some of the users in an interval."""
    spark = index.sparkSession
    ranks = spark.createDataFrame([(u,) for u in users], "u STRING").select(user_rank("u").alias("r"))
    wanted = sorted({r.r for r in ranks.collect()})

    def reached(box: Column) -> Column:
        timely = (box["last"] >= ts(iv[0])) & (box["first"] < ts(iv[1]))
        return timely & F.exists(
            F.array(*map(F.lit, wanted)), lambda r: r.between(box["least_rank"], box["greatest_rank"])
        )

    # Tables written before there were boxes have the ranges of whole files only.
    boxes = F.col("boxes") if "boxes" in index.columns else F.array(F.struct(*RANGES))
    found = index.filter(F.exists(boxes, reached)).select("file").orderBy("file")
    return [r.file for r in found.collect()]


def read_users(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    iv: Interval,
    users: list[str],
    time_col: str = "created_at",
    user_col: str = "user_id",
) -> DataFrame:
    """Rows of the listed users in an interval, from the files that can hold them."""
    files = files_of(spark.read.parquet(index_path(path)), iv, users) if users else []
    if not files:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(*files)
    return df.filter(in_interval(time_col, iv) & F.col(user_col).isin(users))
