"""Moving files to an archive folder from Spark tasks, with a status row for each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.uri import plain_path
from tideline.schemas import FILE_PATH, MOVE_STATUS, MOVED, NOT_MOVED, SOURCE_FILE
from tideline.sources.stores import store_finder
from tideline.sources.tables import read_slice, slice_is_whole, write_slice

LISTED = T.StructType([T.StructField(SOURCE_FILE, T.StringType())])


# The stores in which a rename is one step.
RENAMING = ("local", "hdfs")


def _mover(archive_dir: str, moved: str, not_moved: str, in_one_step: bool | None):
    """The function run in the tasks; self-contained, so workers need no copy of this package."""
    renaming = RENAMING
    store_for = store_finder()

    def move_files_of(batches):
        import posixpath
        import traceback
        from datetime import datetime, timezone
        from urllib.parse import urlsplit

        import pandas as pd
        from pyarrow import fs

        made = set()

        def archive_address(address):
            """The archive folder; a plain path is meant in the file's own store."""
            if urlsplit(archive_dir).scheme:
                return archive_dir
            parts = urlsplit(address)
            if not parts.netloc:
                return archive_dir
            return f"{parts.scheme}://{parts.netloc}/{archive_dir.lstrip('/')}"

        def size_of(store, path):
            """The length of a file, None if there is none."""
            found = store.get_file_info(path)
            return None if found.type == fs.FileType.NotFound else found.size

        def alike(store, one, other):
            if size_of(store, one) != size_of(store, other):
                return False
            with store.open_input_stream(one) as a, store.open_input_stream(other) as b:
                while chunk := a.read(1 << 20):
                    if b.read(len(chunk)) != chunk:
                        return False
            return True

        def publish_copy(store, source, target, hidden):
            """The target is there whole or not at all, whatever step is the last one done."""
            store.copy_file(source, hidden)
            if size_of(store, hidden) != size_of(store, source):
                raise OSError(f"the copy of {source} is not whole")
            store.move(hidden, target)
            store.delete_file(source)

        def rename(store, source, target):
            try:
                store.move(source, target)
            except OSError:
                # Another attempt of the task was quicker.
                if size_of(store, source) is not None or size_of(store, target) is None:
                    raise

        def move(address):
            store, source = store_for(address)
            archive_store, archive = store_for(archive_address(address))
            if archive_store != store:
                raise ValueError(f"{address} is not in the store of {archive_dir}")
            target = posixpath.join(archive, source.lstrip("/"))
            folder, name = posixpath.split(target)
            hidden = posixpath.join(folder, f".{name}.moving")
            if size_of(store, source) is None:
                # A retried or speculative task finds its move done.
                if size_of(store, target) is not None:
                    return
                raise FileNotFoundError(source)
            if size_of(store, target) is not None:
                # An attempt that published its copy and went no further is finished.
                if not alike(store, source, target):
                    raise FileExistsError(target)
                store.delete_file(source)
                if size_of(store, hidden) is not None:
                    store.delete_file(hidden)
                return
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            one_step = store.type_name in renaming if in_one_step is None else in_one_step
            if one_step:
                rename(store, source, target)
            else:
                publish_copy(store, source, target, hidden)

        for batch in batches:
            rows = []
            for named, raw in zip(batch["file_path"], batch["raw_path"], strict=True):
                status, failure = moved, None
                try:
                    move(raw)
                except Exception:
                    status, failure = not_moved, traceback.format_exc()
                rows.append((named, status, datetime.now(timezone.utc), failure))
            yield pd.DataFrame(rows, columns=["file_path", "status", "moved_datetime", "exception"])

    return move_files_of


def move_files(
    files: DataFrame, archive_dir: str, tasks: int | None = None, in_one_step: bool | None = None
) -> DataFrame:
    """Move each source file below `archive_dir`, under its own full path, and report the outcome.

    The archive is in the store the files are in; an `archive_dir` with no scheme says just that.
    Files are dealt evenly to `tasks` tasks. A move has a side effect: `files` must be stored rows,
    not a listing of the folder being emptied that a lost task would compute anew, and the result
    is meant to be written once. `run_moves` sees to both. A repeated attempt of a move that was
    done counts as success, and an archived file is never overwritten.

    In a store that renames in one step a move is a rename. In others, such as object stores, the
    file is copied under a hidden name, its length checked, the copy published and then the source
    deleted; an attempt that stopped anywhere in between is taken up by the next, which finds
    either no target or one equal to the source. `in_one_step` overrules what the store's type says.
    """
    tasks = tasks or files.sparkSession.sparkContext.defaultParallelism
    paths = files.select(
        F.col(SOURCE_FILE).alias(FILE_PATH), plain_path(SOURCE_FILE).alias("raw_path")
    )
    return paths.repartition(tasks).mapInPandas(
        _mover(archive_dir, MOVED, NOT_MOVED, in_one_step), MOVE_STATUS
    )


def run_moves(
    files: DataFrame,
    archive_dir: str,
    list_path: str,
    status_path: str,
    tasks: int | None = None,
    run: int = 0,
    in_one_step: bool | None = None,
) -> DataFrame:
    """Move the files and return the stored status of this run, one row for each file.

    The distinct files are stored as the list of the run before anything moves. Running it again,
    after a failure or for no reason, goes by that list, even if `files` was a listing of a folder
    that has emptied since, and replaces the run's status. Other files need another `run`.
    """
    spark = files.sparkSession
    if not slice_is_whole(spark, list_path, run=run):
        write_slice(files.select(SOURCE_FILE).distinct(), list_path, run=run)
    stored = read_slice(spark, list_path, LISTED, run=run)
    write_slice(move_files(stored, archive_dir, tasks, in_one_step), status_path, run=run)
    return read_slice(spark, status_path, MOVE_STATUS, run=run)
