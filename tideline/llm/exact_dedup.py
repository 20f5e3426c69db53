"""Exact deduplication by skew-safe combining.

Copies are combined three times, and each time the grouping key holds the whole text beside its
digest, so texts are never taken for equal by their digest alone:

1. locally: every task combines the copies it reads before it sends anything on;
2. by digest and salt: a text that very many tasks hold is merged in `salts` places at once;
3. the winners of the salts, at most `salts` rows for a text, are combined globally.

A text held by a third of all rows thus reaches any task as a few rows. Documents find their group
again by SHA-256 and length of the text; there the group's row is narrow, and adaptive execution
splits the rows of a hot digest.

Nulls: a null text is the empty text. A null id never stays if its group has another one; if not,
`keep_id` is null and, as no id tells the rows apart, all of them are marked kept (`deduplicate`
keeps one). Rows that repeat an id and a text count each. An empty table gives an empty result.
Columns of the input other than `doc_id` and `text` are not looked at by `copy_groups`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import whole_text

SALTS = 32


def _combined(
    rows: DataFrame, first: Mapping[str, Column], again: Mapping[str, Column], salts: int
) -> DataFrame:
    """Aggregate rows of (digest, content, ...) per content, in the three steps above."""
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "content")
        .agg(*(value.alias(name) for name, value in first.items()))
    )
    return salted.groupBy("digest", "content").agg(
        *(value.alias(name) for name, value in again.items())
    )


def copy_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per document: `doc_id, text_sha256, keep_id, group_size, kept`.

    Of equal texts the largest `doc_id` stays.
    """
    rows = docs.select("doc_id", whole_text().alias("content")).withColumn(
        "digest", F.sha2(F.col("content"), 256)
    )
    groups = _combined(
        rows,
        {"keep_id": F.max("doc_id"), "group_size": F.count(F.lit(1))},
        {"keep_id": F.max("keep_id"), "group_size": F.sum("group_size")},
        salts,
    ).select("digest", F.length("content").alias("n"), "keep_id", "group_size")
    members = rows.select("doc_id", "digest", F.length("content").alias("n"))
    return members.join(groups, ["digest", "n"]).select(
        "doc_id",
        F.col("digest").alias("text_sha256"),
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )


def deduplicate(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The documents that stay, one whole row per distinct text, with the columns of `docs`.

    Of rows alike in text and id the one that is largest by its other columns stays.
    """
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    rows = docs.select(
        whole_text().alias("content"),
        F.sha2(whole_text(), 256).alias("digest"),
        F.struct(
            "doc_id", F.col("text").isNotNull().alias("text"), *(F.col(f"`{c}`") for c in others)
        ).alias("row"),
    )
    kept = _combined(rows, {"row": F.max("row")}, {"row": F.max("row")}, salts)
    text = F.when(F.col("row.text"), F.col("content")).alias("text")
    return kept.select(
        *(text if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns)
    )
