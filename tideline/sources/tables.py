"""Partitioned tables: whole-table scans, and reads and writes of one partition."""

from __future__ import annotations

import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from tideline.schemas import BATCH_ID, PROCESSED_DATE, RUN

# Formats whose table is a plain tree of partition folders.
FOLDER_FORMATS = frozenset({"parquet", "orc", "json", "csv"})
# Partition keys that are numbers; others are text unless the written rows have the column.
LONG_KEYS = frozenset({BATCH_ID, RUN, "part"})


def iso_date(value: str | date) -> str:
    """`value` as `yyyy-MM-dd`; raises ValueError for anything that is not a date."""
    text = value.isoformat() if isinstance(value, date) else value
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"not a date of the form yyyy-MM-dd: {text!r}")
    return date.fromisoformat(text).isoformat()


def read_table(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet"
) -> DataFrame:
    """Scan a stored table under its declared schema.

    The schema keeps a date partition the string it was written as; Spark would infer a date.
    Table formats that store their own schema are read by it and cut to these columns.
    """
    reader = spark.read.format(fmt)
    if fmt in FOLDER_FORMATS:
        reader = reader.schema(schema)
    return reader.load(path).select(*schema.names)


def _folder(path: str, keys: dict[str, object]) -> str:
    return "/".join([path.rstrip("/"), *(f"{name}={value}" for name, value in keys.items())])


def read_slice(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **keys: object
) -> DataFrame:
    """The rows of one partition, named by its leading partition columns in order.

    Only that partition's folder is listed, so the cost does not grow with the age of the table as
    it would when the whole tree is listed and pruned afterwards. A partition that was never
    written is empty; a table that is not there is an error. For tables written by `write_slice`;
    `read_date` reads either kind of table.
    """
    if fmt not in FOLDER_FORMATS:
        table = read_table(spark, path, schema, fmt)
        for name, value in keys.items():
            table = table.filter(F.col(name) == F.lit(value))
        return table
    reader = spark.read.format(fmt).schema(schema).option("basePath", path)
    try:
        return reader.load(_folder(path, keys)).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or not table_exists(spark, path):
            raise
        return spark.createDataFrame([], schema)


def _store_of(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the root of a table is there. Nothing below it is listed."""
    store, root = _store_of(spark, path)
    return store.exists(root)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder matches `path`, which may be a pattern."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def has_sink_log(spark: SparkSession, path: str) -> bool:
    """Whether a streaming file sink keeps the table, and with it a log of what is committed."""
    return path_exists(spark, f"{path}/_spark_metadata")


def prepare_table(spark: SparkSession, path: str, fmt: str = "parquet") -> None:
    """Make the root of a table that a job will write, so that it is there and empty from the start.

    A table kept by a streaming sink is refused: Spark would not see what is added beside its log.
    """
    if fmt not in FOLDER_FORMATS:
        return
    if has_sink_log(spark, path):
        raise ValueError(f"{path} is kept by the log of a streaming sink; write to another folder")
    store, root = _store_of(spark, path)
    store.mkdirs(root)


def slice_is_whole(
    spark: SparkSession, path: str, fmt: str = "parquet", **keys: object
) -> bool:
    """Whether `write_slice` finished a partition; a key may be `*`.

    Output committers leave a success marker unless told not to. Without one the answer is no.
    """
    return fmt in FOLDER_FORMATS and path_exists(spark, f"{_folder(path, keys)}/_SUCCESS")


def read_date(
    spark: SparkSession, path: str, schema: StructType, day: str, fmt: str = "parquet"
) -> DataFrame:
    """The rows a table read on one date, whichever way the table is written.

    Where a streaming sink keeps a log, the whole table is named so that Spark goes by the log and
    leaves out files of batches that never finished; the date then prunes the log's entries.
    """
    if fmt in FOLDER_FORMATS and not has_sink_log(spark, path):
        return read_slice(spark, path, schema, fmt, **{PROCESSED_DATE: day})
    return read_table(spark, path, schema, fmt).filter(F.col(PROCESSED_DATE) == day)


def _key_types(schema: StructType, keys: dict[str, object]) -> dict[str, T.DataType]:
    """The type each key is stored with: that of the written column, else the declared one."""
    own = {field.name: field.dataType for field in schema.fields}
    return {
        name: own.get(name, T.LongType() if name in LONG_KEYS else T.StringType()) for name in keys
    }


def replace_predicate(schema: StructType, keys: dict[str, object]) -> str:
    """The condition that names one partition, with literals of the stored types."""

    def literal(value: object, kind: T.DataType) -> str:
        if isinstance(kind, T.IntegralType):
            return str(value)
        quoted = "'" + str(value).replace("'", "''") + "'"
        return f"DATE {quoted}" if isinstance(kind, T.DateType) else quoted

    types = _key_types(schema, keys)
    return " AND ".join(f"{name} = {literal(value, types[name])}" for name, value in keys.items())


def with_keys(df: DataFrame, keys: dict[str, object]) -> DataFrame:
    """`df` with the keys as columns, in the types they are stored with."""
    types = _key_types(df.schema, keys)
    return df.withColumns({name: F.lit(value).cast(types[name]) for name, value in keys.items()})


def write_slice(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    **keys: object,
) -> None:
    """Write `df` as the whole content of one partition, replacing what a former attempt left.

    For folder formats the partition's own folder is overwritten in place, which any output
    committer supports and which moves no file twice; other formats replace by predicate.
    `partition_by` parts the rows further, below that folder. They are brought together by its
    values first, so the number of files follows the values and not tasks times values, and a
    value with many rows is split.
    """
    inner = [] if partition_by is None or partition_by in keys else [partition_by]
    if inner:
        df = df.hint("rebalance", *inner)
    if fmt in FOLDER_FORMATS:
        rows = df.drop(*keys).write.format(fmt).mode("overwrite")
        (rows.partitionBy(*inner) if inner else rows).save(_folder(path, keys))
        return
    (
        with_keys(df, keys)
        .write.format(fmt)
        .mode("overwrite")
        .option("replaceWhere", replace_predicate(df.schema, keys))
        .partitionBy(*keys, *inner)
        .save(path)
    )
