"""Which files are done on a date, and the lists made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.uri import strip_prefix
from tideline.schemas import FILE_PATH, PROCESSED_DATE, REPORT, SOURCE_FILE
from tideline.scratch import delete_at_exit, new_folder
from tideline.sources.tables import iso_date

POSITIONS = (1 << 33) - 1  # Spark puts the row's position in the low 33 bits of its id


def files_of(table: DataFrame, date: str) -> DataFrame:
    """The distinct source files a table read on one date."""
    return table.filter(F.col(PROCESSED_DATE) == iso_date(date)).select(SOURCE_FILE).distinct()


def candidates(data: DataFrame, metadata: DataFrame, date: str) -> DataFrame:
    """Files of `date` that are in both tables: loaded and audited, so ready for the archive.

    Each side is reduced to one row per file and task before it is shuffled, and the semi-join
    then runs on the partitioning the distincts left behind.
    """
    return files_of(metadata, date).join(files_of(data, date), SOURCE_FILE, "left_semi")


def report_rows(files: DataFrame, date: str) -> DataFrame:
    """REPORT rows: the files and the date, as a date, on which they were read."""
    day = F.lit(iso_date(date)).cast(REPORT[PROCESSED_DATE].dataType)
    return files.select(SOURCE_FILE, day.alias(PROCESSED_DATE))


def move_list(files: DataFrame, prefix: str) -> DataFrame:
    """Paths relative to the container, one per file."""
    return files.select(strip_prefix(SOURCE_FILE, prefix).alias(FILE_PATH))


def not_in(files: DataFrame, others: DataFrame) -> DataFrame:
    """The files that are not among `others`."""
    return files.join(others.select(SOURCE_FILE), SOURCE_FILE, "left_anti")


def first_files(files: DataFrame, limit: int, staging: str | None = None) -> DataFrame:
    """The `limit` files that come first by address; a negative limit keeps them all.

    The files are range-partitioned by address and stored under `staging`, a fresh scratch folder
    unless given, with their position; the count of each range then tells which ranges, and how
    much of one of them, the limit covers. No task holds more than its range, whatever the limit.
    """
    if limit < 0:
        return files
    spark = files.sparkSession
    own = staging is None
    staging = staging or new_folder(spark, "first-files")
    (
        files.repartitionByRange(SOURCE_FILE)
        .sortWithinPartitions(SOURCE_FILE)
        .withColumn("range", F.spark_partition_id())
        .withColumn("position", F.monotonically_increasing_id().bitwiseAND(F.lit(POSITIONS)))
        .write.mode("overwrite")
        .parquet(staging)
    )
    if own:
        delete_at_exit(spark, staging)
    ranked = spark.read.parquet(staging)
    # One row per shuffle partition, so this window stays small.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        ranked.groupBy("range")
        .agg(F.count(F.lit(1)).alias("files"))
        .select("range", F.coalesce(F.sum("files").over(before), F.lit(0)).alias("skipped"))
    )
    return (
        ranked.join(ranges, "range")
        .filter(F.col("skipped") + F.col("position") < limit)
        .select(*files.columns)
    )


def write_move_list(paths: DataFrame, path: str) -> None:
    """Write the move list as text, one path per line, replacing the former list.

    The list is a folder of part files: a short list is one part, a long one is written by as many
    tasks as hold it and never meets in a single task or on the driver.
    """
    paths.select(FILE_PATH).write.mode("overwrite").text(path)
