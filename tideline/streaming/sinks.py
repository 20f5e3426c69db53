"""Starting the streams: a partitioned table sink, or a function run on every micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tideline.schemas import PROCESSED_DATE

EVERY_TEN_SECONDS = {"processingTime": "10 seconds"}
UNTIL_DONE = {"availableNow": True}


def checkpoint_for(root: str, job: str, input_path: str) -> str:
    """A checkpoint folder of its own for each job and landing folder: `{root}/{job}/{input}`.

    The container and account of the input are part of it, as two may hold folders of one name.
    """
    parts = urlsplit(input_path)
    names = [root.rstrip("/"), job, parts.netloc.replace(":", "_"), parts.path.strip("/")]
    return "/".join(name for name in names if name)


def start_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    partition_by: str = PROCESSED_DATE,
    fmt: str = "parquet",
    trigger: dict[str, object] = EVERY_TEN_SECONDS,
) -> StreamingQuery:
    """Append a stream to a partitioned table; progress survives restarts through `checkpoint`."""
    return (
        df.writeStream.format(fmt)
        .outputMode("append")
        .partitionBy(partition_by)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(**trigger)
        .start(path)
    )


def start_batches(
    df: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str,
    trigger: dict[str, object] = EVERY_TEN_SECONDS,
) -> StreamingQuery:
    """Run `on_batch(batch, batch_id)` on every micro-batch.

    A batch that fails is run again with the same rows, id and processing time, so `on_batch` must
    write the same place twice without doubling it, as the writers of this package do.
    """
    return (
        df.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(**trigger)
        .start()
    )
