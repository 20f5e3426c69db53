"""Sharding by a Feistel permutation of global row numbers, with cycle walking.

Rows are numbered 0 to n - 1 by id and digest of the text. A keyed permutation of these numbers
gives each row its position; position `p` is slot `p div shards` of shard `p mod shards`. So the
order is shuffled, shards differ by one row at most, slots have no gap, and shard and slot of any
row number, or the row number of any slot, come from a formula without touching the data.

The permutation works on pairs `(l, r)` of a grid of `a` rows and `b` columns, the smallest with
`a = ceil(sqrt(n))` that holds n numbers: in turn, `l` is moved by a hash of `r` modulo `a` and `r`
by a hash of `l` modulo `b`. Every round can be undone, so the whole is one to one on the grid.
Fewer than `a` numbers of the grid are n or above. A row that lands there is permuted again until
it is below n (cycle walking), which keeps the result one to one on the rows. `WALK` steps always
do up to n = 576, where the grid has fewer spare numbers than that; beyond, a row needs more with
a probability below (1 / 24)^24, and the query then fails with a message, never with a wrong place.

The law is `rows`. Groups of equal texts are not kept together, as no law of rows could.

Nulls: a null text has no bytes (size 1, crc32 0); null ids come first and are told apart by their
texts. Rows alike in id and text are interchangeable: they share their places in any way. Empty
texts are ordinary rows, long ones are only hashed. An empty table gives an empty result. The input
columns besides `doc_id` and `text` are not looked at by `shards`; `write_shards` keeps all of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import whole_text
from tideline.llm.numbering import numbered

SHARDS = 16
SEED = "shards"
ROUNDS = 6
WALK = 24
# Hexadecimal digits of a round's hash: 48 bits.
HEX = 12


def grid(n: int) -> tuple[int, int]:
    """Rows and columns of the grid the permutation of n numbers works on."""
    rows = max(1, math.isqrt(max(n, 1) - 1) + 1) if n > 1 else 1
    return rows, max(1, -(-n // rows))


def _hash(seed: str, turn: Column, half: Column) -> Column:
    named = F.concat_ws(":", F.lit(seed), turn.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.md5(named), 1, HEX), 16, 10).cast("long")


def _turns(number: Column, n: int, seed: str, turns: list[int], sign: int) -> Column:
    """The rounds of the permutation, or of its inverse, on one number of the grid."""
    a, b = (F.lit(side).cast("long") for side in grid(n))

    def turn(state: Column, k: Column) -> Column:
        left, right = state["l"], state["r"]
        moved_left = F.pmod(left + sign * (_hash(seed, k, right) % a), a)
        moved_right = F.pmod(right + sign * (_hash(seed, k, left) % b), b)
        return F.when(
            k % 2 == 1, F.struct(moved_left.alias("l"), right.alias("r"))
        ).otherwise(F.struct(left.alias("l"), moved_right.alias("r")))

    start = F.struct(F.floor(number / b).cast("long").alias("l"), F.pmod(number, b).alias("r"))
    return F.aggregate(
        F.array(*map(F.lit, turns)), start, turn, lambda state: state["l"] * b + state["r"]
    )


def _walk(number: Column, n: int, seed: str, turns: list[int], sign: int) -> Column:
    """Permute until the number is below n again."""
    size = F.lit(n).cast("long")
    first = _turns(number.cast("long"), n, seed, turns, sign)
    # Without steps left, a number that is still outside must not pass for a place.
    landed = F.aggregate(
        F.sequence(F.lit(2), F.lit(WALK)),
        first,
        lambda at, _: F.when(at < size, at).otherwise(_turns(at, n, seed, turns, sign)),
    )
    stray = F.raise_error(F.lit("a row needs more steps of cycle walking; use another seed"))
    return F.when(landed < size, landed).otherwise(stray.cast("long"))


def permuted(number: Column, n: int, seed: str = SEED) -> Column:
    """The position, 0 to n - 1, of row `number` of n."""
    return _walk(number, n, seed, list(range(1, ROUNDS + 1)), 1)


def unpermuted(position: Column, n: int, seed: str = SEED) -> Column:
    """The row number that has this position."""
    return _walk(position, n, seed, list(range(ROUNDS, 0, -1)), -1)


def shard_and_slot(
    number: Column, n: int, n_shards: int = SHARDS, seed: str = SEED
) -> tuple[Column, Column]:
    """Shard and slot of row `number` of n."""
    position = permuted(number, n, seed)
    return F.pmod(position, F.lit(n_shards)).cast("int"), F.floor(position / n_shards).cast("long")


def row_in(shard: Column, slot: Column, n: int, n_shards: int = SHARDS, seed: str = SEED) -> Column:
    """The row number in a slot of a shard; the slot must be one that is filled."""
    return unpermuted(slot.cast("long") * n_shards + shard, n, seed)


def _placed(rows: DataFrame, n_shards: int, seed: str, purpose: str) -> DataFrame:
    """Rows of (doc_id, digest, ...) with `number`, `shard` and `slot`."""
    ranked = numbered(rows, ["doc_id", "digest"], purpose)
    n = ranked.agg(F.count(F.lit(1))).first()[0]
    # The position is a column of its own first, so that it is worked out once.
    placed = ranked.withColumn("position", permuted(F.col("number"), n, seed))
    return placed.withColumns(
        {
            "shard": F.pmod("position", F.lit(n_shards)).cast("int"),
            "slot": F.floor(F.col("position") / n_shards).cast("long"),
        }
    )


def shards(docs: DataFrame, n_shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """One row per document: `doc_id, size, text_crc32, number, shard, slot`.

    `size` is the bytes of the text in UTF-8 plus one. Texts stay where they are: only these narrow
    rows are shuffled, once.
    """
    text = whole_text()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(1).cast("long")).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("digest"),
    )
    return _placed(rows, n_shards, seed, "sharding-rows").select(
        "doc_id", "size", "text_crc32", "number", "shard", "slot"
    )


def write_shards(
    docs: DataFrame, folder: str, n_shards: int = SHARDS, seed: str = SEED
) -> DataFrame:
    """Write the documents to `folder/shard=…`, in the order of their slots, and return that table.

    Columns: `row` (the columns of `docs`), `slot` and the partition `shard`. A shard is written by
    as many tasks as hold it; rows are read in order by sorting on `slot`, which each file's
    statistics cover.
    """
    rows = docs.select(
        "doc_id",
        F.md5(whole_text()).alias("digest"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
    )
    placed = _placed(rows, n_shards, seed, "sharding-texts").select("row", "shard", "slot")
    (
        placed.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .mode("overwrite")
        .parquet(folder)
    )
    schema = placed.select("row", "slot", "shard").schema
    return docs.sparkSession.read.schema(schema).parquet(folder)
