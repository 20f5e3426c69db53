"""Size and modification time of files, from listings in place of a lookup per row."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.stamps import source_file
from tideline.schemas import MODIFICATION_TIME, SIZE, SOURCE_FILE
from tideline.scratch import delete_at_exit, new_folder
from tideline.sources.stores import store_finder

# What is listed: files, and folders that are yet to be listed.
ENTRIES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("is_folder", T.BooleanType()),
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(SIZE, T.LongType()),
        T.StructField(MODIFICATION_TIME, T.TimestampType()),
    ]
)
# Folders that a task lists below one folder, so that a small tree takes one job.
FOLDERS_PER_TASK = 32
# Characters that Spark's addresses show as they are.
PLAIN = "/@_-!.~'()*,;:$&+="


def list_files(spark: SparkSession, path: str, in_tasks: bool | None = None) -> DataFrame:
    """One row per file under `path`: source file, size and modification time.

    The source file has the form it has in the stored tables; hidden files and those without a byte
    are left out, as in Spark's scans. With `in_tasks`, which is the rule where all tasks share the
    driver's file system, sub-folders are listed side by side in tasks and the driver holds no file
    name. Else, and in stores that only Spark can open, Spark's own listing is used, whose index of
    all files is on the driver. A file that goes while the listing is made may or may not be in it.
    """
    if in_tasks is None:
        in_tasks = urlsplit(path).scheme in ("", "file")
    return _listed_in_tasks(spark, path) if in_tasks else _listed_by_scan(spark, path)


def _listed_by_scan(spark: SparkSession, path: str) -> DataFrame:
    """The binary-file source reads no content when the content column is not asked for."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("ignoreMissingFiles", True)
        .load(path)
        .select(
            source_file(),
            F.col("length").alias(SIZE),
            F.col("modificationTime").alias(MODIFICATION_TIME),
        )
    )


def _lister(folders: int):
    """The function run in the tasks; self-contained, so workers need no copy of this package."""
    store_for, plain, most = store_finder(), PLAIN, folders

    def entries_of(batches):
        import posixpath
        import re
        from collections import deque
        from itertools import islice
        from urllib.parse import quote

        import pandas as pd
        from pyarrow import fs

        def is_hidden(name):
            # Fixed rule: what Spark's scans pass over.
            return (
                name.startswith(".")
                or (name.startswith("_") and "=" not in name)
                or name.endswith("._COPYING_")
            )

        def encoded(path):
            """Only ASCII signs are encoded, as in Spark's addresses."""
            return re.sub(r"[\x00-\x7f]+", lambda some: quote(some[0], safe=plain), path)

        def entries():
            for batch in batches:
                for folder in batch["path"]:
                    yield from entries_below(folder)

        def entries_below(top):
            """Entries of the folder and of those below it; folders beyond `most` are handed back."""
            folders, listed = deque([top]), 0
            while folders and listed < most:
                folder = folders.popleft()
                listed += 1
                store, inside = store_for(folder)
                for found in store.get_file_info(fs.FileSelector(inside, allow_not_found=True)):
                    name = posixpath.basename(found.path)
                    if is_hidden(name):
                        continue
                    path = f"{folder.rstrip('/')}/{name}"
                    if found.type == fs.FileType.Directory:
                        folders.append(path)
                    elif found.type == fs.FileType.File and found.size:
                        # Spark knows times to the millisecond.
                        time = pd.Timestamp(found.mtime_ns // 1_000_000, unit="ms", tz="UTC")
                        yield path, False, encoded(path), found.size, time
            for folder in folders:
                yield folder, True, None, None, None

        rows = entries()
        names = ["path", "is_folder", "source_file", "size", "modification_time"]
        while some := list(islice(rows, 10_000)):
            frame = pd.DataFrame(some, columns=names)
            yield frame.astype({"size": "Int64", "modification_time": "datetime64[ms, UTC]"})

    return entries_of


def _listed_in_tasks(
    spark: SparkSession, path: str, per_task: int = FOLDERS_PER_TASK
) -> DataFrame:
    """Jobs whose tasks list `per_task` folders from each they are given, and hand back the others."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # As Spark writes it: absolute, and with the scheme and store of the path.
    address = store.makeQualified(root).toString()
    todo = spark.range(1).select(F.lit(address).alias("path"))
    levels = []
    while True:
        level_path = new_folder(spark, "listing")
        todo.mapInPandas(_lister(per_task), ENTRIES).write.parquet(level_path)
        delete_at_exit(spark, level_path)
        level = spark.read.schema(ENTRIES).parquet(level_path)
        levels.append(level_path)
        inner = level.filter("is_folder").select("path")
        if inner.isEmpty():
            break
        todo = inner.repartition(spark.sparkContext.defaultParallelism)
    entries = spark.read.schema(ENTRIES).parquet(*levels)
    return entries.filter("NOT is_folder").select(SOURCE_FILE, SIZE, MODIFICATION_TIME)


def with_properties(files: DataFrame, listing: DataFrame) -> DataFrame:
    """Add size and modification time to a table of source files; a file that is gone gets NULL."""
    return files.join(listing, SOURCE_FILE, "left")
