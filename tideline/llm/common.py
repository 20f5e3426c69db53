"""What the operators share: staged tables, word splitting and stable numbers for rows."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tideline
from tideline.scratch import delete_at_exit, new_folder

# Fixed value: what separates words, in every operator that says no more about it.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Have Spark hand this package to its Python workers, once per application.

    The archive is made on the driver alone; Spark's file server passes it on.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="tideline-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    home = Path(tideline.__file__).resolve().parent
    context.addPyFile(shutil.make_archive(f"{folder}/tideline", "zip", home.parent, home.name))
    _shipped.add(context.applicationId)


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, purpose: str, release: bool = False) -> DataFrame:
    """`df` as a table in the shared scratch folder, so that lost executors cannot undo it.

    The table is deleted when the program ends. `release` has Spark delete the shuffled data of this
    write as soon as the table is there, not when the driver happens to collect garbage.
    """
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    before = spark.conf.get(RELEASE, None)
    if release:
        spark.conf.set(RELEASE, True)
    try:
        df.write.parquet(folder)
    finally:
        if release and before is None:
            spark.conf.unset(RELEASE)
        elif release:
            spark.conf.set(RELEASE, before)
    delete_at_exit(spark, folder)
    return spark.read.schema(df.schema).parquet(folder)


def whole_text(column: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The distinct-or-not words of a text as an array, without empty ends."""
    return F.filter(F.split(text, SPACES), lambda word: word != "")


def bucket_of_id(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo `modulus`; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def lower_words(text: str) -> list[bytes]:
    """The words of a text with A-Z lower-cased. `bytes.split` parts at the same six characters."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def text_chunks(batches: Iterator, max_bytes: int) -> Iterator:
    """Arrow batches cut into runs of rows whose first text column holds about `max_bytes`.

    A run has one row at least, so a text longer than that is a run of its own.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        at = batch.schema.get_field_index("text")
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        first, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield pa.RecordBatch.slice(batch, first, row - first)
                first, held = row, 0
            held += size
        if first < len(sizes):
            yield pa.RecordBatch.slice(batch, first, len(sizes) - first)
