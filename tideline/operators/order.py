"""A stored order of the files of a date, of which archive runs are slices.

The files are range-partitioned by address and sorted once, and stored with their range and their
place in it, beside the count of each range summed over the ranges before it. So the position of
every file is known, and a run takes the files of an interval of positions without a sort: it opens
the ranges that the interval meets. Files that come later are a further part, with positions after
the end. No task holds more than a range, and the driver sees one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.schemas import FILES, PROCESSED_DATE, RUN, SOURCE_FILE
from tideline.sources.tables import read_slice, table_exists, write_slice

PART = "part"
POSITIONS = (1 << 33) - 1  # Spark puts the row's position in the low 33 bits of its id

# Fixed by this module: what the three stored tables hold.
ROWS = T.StructType(
    [
        *FILES.fields,
        T.StructField(PART, T.LongType()),
        T.StructField("range", T.IntegerType()),
        T.StructField("place", T.LongType()),
    ]
)
RANGES = T.StructType(
    [
        T.StructField(PROCESSED_DATE, T.StringType()),
        T.StructField(PART, T.LongType()),
        T.StructField("range", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("files", T.LongType()),
    ]
)
RUNS = T.StructType(
    [
        T.StructField(PROCESSED_DATE, T.StringType()),
        T.StructField(RUN, T.LongType()),
        T.StructField("first", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


def order_path(report_path: str) -> str:
    return f"{report_path.rstrip('/')}-order"


def _stored(spark: SparkSession, path: str, table: str, schema: T.StructType, date: str, fmt: str):
    if not table_exists(spark, f"{path}/{table}"):
        return spark.createDataFrame([], schema)
    return read_slice(spark, f"{path}/{table}", schema, fmt, **{PROCESSED_DATE: date})


def has_order(spark: SparkSession, path: str, date: str) -> bool:
    return table_exists(spark, f"{path}/ranges/{PROCESSED_DATE}={date}")


def ordered_files(spark: SparkSession, path: str, date: str, fmt: str = "parquet") -> DataFrame:
    """The files of a date that have a position."""
    return _stored(spark, path, "rows", ROWS, date, fmt).select(SOURCE_FILE)


def _ranges(spark: SparkSession, path: str, date: str, fmt: str) -> list:
    """The ranges in order of position, one row for each."""
    rows = _stored(spark, path, "ranges", RANGES, date, fmt).collect()
    return sorted(rows, key=lambda row: (row["start"], row[PART], row["range"]))


def extend_order(files: DataFrame, path: str, date: str, fmt: str = "parquet") -> None:
    """Give further files of a date positions after the end, in the order of their addresses.

    An extension that was broken off has no ranges yet, and the next one takes its place.
    """
    spark = files.sparkSession
    if files.isEmpty():
        return
    ranges = _ranges(spark, path, date, fmt)
    end = ranges[-1]["start"] + ranges[-1]["files"] if ranges else 0
    own = {PROCESSED_DATE: date, PART: max((row[PART] for row in ranges), default=-1) + 1}
    placed = (
        files.select(SOURCE_FILE)
        .repartitionByRange(SOURCE_FILE)
        .sortWithinPartitions(SOURCE_FILE)
        .withColumn("range", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit(POSITIONS)))
    )
    write_slice(placed, f"{path}/rows", fmt, **own)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        read_slice(spark, f"{path}/rows", ROWS, fmt, **own)
        .groupBy("range")
        .agg(F.count(F.lit(1)).alias("files"))
    )
    # One row per range, so the window stays small.
    starts = counts.select(
        "range", (F.coalesce(F.sum("files").over(before), F.lit(0)) + end).alias("start"), "files"
    )
    write_slice(starts, f"{path}/ranges", fmt, **own)


def slice_of_run(
    spark: SparkSession, path: str, date: str, run: int, limit: int, fmt: str = "parquet"
) -> DataFrame:
    """The files of one run: the next `limit` that no other run has, all with a negative limit.

    A run's interval is stored before it is used. Repeated, it begins where it began, and ends at
    its limit or where another run began.
    """
    ranges = _ranges(spark, path, date, fmt)
    total = ranges[-1]["start"] + ranges[-1]["files"] if ranges else 0
    runs = {row[RUN]: row for row in _stored(spark, path, "runs", RUNS, date, fmt).collect()}
    others = [row for number, row in runs.items() if number != run]
    if run in runs:
        first = runs[run]["first"]
    else:
        first = max((row["end"] for row in others), default=0)
    taken = (row["first"] for row in others if row["first"] >= first and row["end"] > row["first"])
    end = min([total, *taken, *([first + limit] if limit >= 0 else [])])
    end = max(first, end)
    interval = spark.range(1).select(
        F.lit(first).cast("long").alias("first"), F.lit(end).cast("long").alias("end")
    )
    write_slice(interval, f"{path}/runs", fmt, **{PROCESSED_DATE: date, RUN: run})
    met = [row for row in ranges if row["start"] < end and row["start"] + row["files"] > first]
    files = spark.createDataFrame([], FILES).select(SOURCE_FILE)
    for part in sorted({row[PART] for row in met}):
        own = [row for row in met if row[PART] == part]
        rows = read_slice(spark, f"{path}/rows", ROWS, fmt, **{PROCESSED_DATE: date, PART: part})
        inside = _between(own[0], first - own[0]["start"], own[-1], end - own[-1]["start"])
        files = files.unionByName(rows.filter(inside).select(SOURCE_FILE))
    return files


def _between(first: Row, place: int, last: Row, end: int) -> Column:
    """Rows from a place of one range up to, but without, a place of another.

    Ranges lie in files of their own, whose statistics let a scan pass over the others.
    """
    number = F.col("range")
    return (
        number.between(first["range"], last["range"])
        & ((number > first["range"]) | (F.col("place") >= place))
        & ((number < last["range"]) | (F.col("place") < end))
    )
