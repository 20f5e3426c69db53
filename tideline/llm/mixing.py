"""Mixing sources to target weights by Pareto order sampling.

A source of `Z` words with a target of `T` words is to be taken `T / Z` times. A document of it is
expected in `e = T / Z` copies, times its preference over the mean preference of the source's
words, and in `max_repeats` at most. The whole part of `e` is certain. What is left, the inclusion
probability `p = e - floor(e)`, goes to the order sample: documents are ranked by random odds over
inclusion odds, `(u / (1 - u)) / (p / (1 - p))`, and the lowest ranks are taken until the words the
target still lacks are filled; the sample's size is fixed in words. A document that would overshoot
ends a round, and further rounds fill the gap with the documents next in rank that are not longer
than the gap, so a source misses its target by few words even where single documents are long.

The cut never sorts a source. A round sums words per source and leading digit of the rank (4096
values), which tasks do ahead of the shuffle. Only the documents of the digit in which the sum
passes the limit are told apart further, digit by digit, until few of a source are left.

`u` is a hash of seed, id and text, so reruns agree on any cluster. Nulls: a null source is a source
of its own, last in order; a null text has no words; a preference that is null or not above zero
takes the document out. Rows that repeat an id and a text have one rank and are taken together.
Documents without words count as fitting. An empty table gives an empty result. Columns of the
input are kept in a struct, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import WORD, stage, whole_text

MAX_REPEATS = 3
ROUNDS = 5
DIGITS = 4096
# So many documents of one source may be ranked side by side in one task.
FEW = 2000
# Hexadecimal digits of the hash behind `u`: 48 bits, four digits of the rank.
HEX = 12
LEVELS = 4


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """`source, source_size, target` from rows of (source, source_size).

    Sources in code-point order, null last, weigh 1, 2, 3, 1, ... and share the sum of all sizes; a
    target stops at `max_repeats` times its source and the others share what is over by weight,
    until none is above. In the end all uncapped sources get the same words per weight. With the
    sources sorted by cap over weight, that level is the largest of (words left when those before
    are capped) / (weights from here on). The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    capped = sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1).withColumn(
        "cap", F.col("source_size") * max_repeats
    )
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    return (
        capped.withColumn("share", left.cast("double") / F.sum("weight").over(onward))
        .withColumn("level", F.max("share").over(everything))
        .withColumn(
            "target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level"))
        )
        .select("source", "source_size", "target")
    )


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def random_unit(seed: str, doc_id: Column, text: Column) -> Column:
    """A number inside (0, 1) that is a hash of the three."""
    named = F.concat_ws(
        ":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("-")), F.md5(text)
    )
    leading = F.conv(F.substring(F.md5(named), 1, HEX), 16, 10).cast("double")
    return (leading + 0.5) / float(16**HEX)


def _rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds, brought from (0, inf) to (0, 1) in the same order."""
    return u * (1 - p) / (u * (1 - p) + (1 - u) * p)


def _digit(rank: Column, level: int) -> Column:
    scaled = F.floor(rank * float(DIGITS**level))
    return F.least(scaled, F.lit(DIGITS**level - 1))


def _same_source(left: DataFrame, right: DataFrame) -> Column:
    return left["source"].eqNullSafe(right["source"])


def _first_beyond(rows: DataFrame) -> DataFrame:
    """`source, block`: the rank at which the words of a source, summed by rank, pass its `gap`.

    `rows` has source, gap, size and rank. Sources that never pass it have no row.
    """
    order = Window.partitionBy("source").orderBy("rank")
    inside = rows.withColumn("carried", F.lit(0).cast("long"))
    for level in range(1, LEVELS + 1):
        digit = _digit(F.col("rank"), level)
        sums = inside.groupBy("source", "gap", "carried", digit.alias("digit")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("documents")
        )
        upto = Window.partitionBy("source").orderBy("digit")
        passing = (
            sums.withColumn("through", F.col("carried") + F.sum("words").over(upto))
            .filter(F.col("through") > F.col("gap"))
            .groupBy("source")
            .agg(F.min(F.struct("digit", "through", "words", "documents")).alias("at"))
            .select(
                F.col("source").alias("found"),
                F.col("at.digit").alias("digit"),
                (F.col("at.through") - F.col("at.words")).alias("carried_on"),
                F.col("at.documents").alias("documents"),
            )
        )
        passing = stage(passing, "mixing-digits")
        inside = (
            inside.join(
                passing, F.col("source").eqNullSafe(F.col("found")) & (digit == F.col("digit"))
            )
            .withColumn("carried", F.col("carried_on"))
            .select("source", "gap", "size", "rank", "carried")
        )
        most = passing.agg(F.max("documents")).first()[0]
        if most is None or most <= FEW:
            break
    summed = inside.withColumn("through", F.col("carried") + F.sum("size").over(order))
    return (
        summed.filter(F.col("through") > F.col("gap"))
        .groupBy("source")
        .agg(F.min("rank").alias("block"))
    )


def _copies(max_repeats: int) -> tuple[Column, Column]:
    """Certain copies and the inclusion probability of one more, from `u`-less columns."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = F.least(F.lit(float(max_repeats)), ratio * F.col("preference") / F.col("mean"))
    wanted = F.when(F.col("preference") > 0, wanted).otherwise(0.0)
    certain = F.floor(wanted)
    return certain.cast("long"), wanted - certain


def mix(
    docs: DataFrame,
    preference: Column | None = None,
    max_repeats: int = MAX_REPEATS,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: `row` (its columns), `size, source_size, target, copies`.

    `copies` is how often the mix takes the document. `preference` is a positive number by which
    documents of a source are preferred to each other; without one they are equal, and inclusion
    differs by source alone.
    """
    preferred = F.lit(1.0) if preference is None else preference.cast("double")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("source").cast("string").alias("source"),
        word_count(whole_text()).alias("size"),
        preferred.alias("preference"),
        random_unit(seed, F.col("doc_id"), whole_text()).alias("u"),
    )
    narrow = stage(rows.drop("row"), "mixing-sizes")
    usable = F.when(F.col("preference") > 0, F.col("preference"))
    by_source = narrow.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        (F.sum(usable * F.col("size")) / F.sum("size")).alias("mean"),
    )
    by_source = stage(by_source, "mixing-sources")
    targets = source_targets(by_source)
    means = by_source.select(F.col("source").alias("of"), F.coalesce("mean", F.lit(1.0)).alias("mean"))
    sources = stage(
        targets.join(means, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "mixing-targets"
    )
    certain, p = _copies(max_repeats)

    def placed(some: DataFrame, per_source: DataFrame) -> DataFrame:
        """Documents with their source's columns, certain copies, probability and rank."""
        per_source = per_source.withColumnRenamed("source", "of")
        return (
            some.join(per_source, F.col("source").eqNullSafe(F.col("of")), "left")
            .drop("of")
            .withColumn("certain", certain)
            .withColumn("p", p)
            .withColumn("rank", F.when(F.col("p") > 0, _rank(F.col("u"), F.col("p"))))
        )

    whole = placed(narrow, sources)
    ranked = stage(whole.filter("p > 0").select("source", "size", "rank"), "mixing-ranks")
    taken = whole.groupBy("source").agg(F.sum(F.col("certain") * F.col("size")).alias("words"))
    # One row per source: the words still lacking, the rank reached, and the rounds so far.
    state = taken.join(
        sources.select(F.col("source").alias("of"), "target"), F.col("source").eqNullSafe(F.col("of"))
    ).select(
        "source",
        F.floor(F.col("target") - F.col("words")).alias("gap"),
        F.lit(-1.0).alias("after"),
        F.array().cast("array<struct<after:double,block:double,gap:bigint>>").alias("rounds"),
    )
    state = stage(state, "mixing-state")
    for _ in range(ROUNDS):
        limits = state.select(F.col("source").alias("of"), "gap", "after")
        open_rows = ranked.join(
            limits,
            F.col("source").eqNullSafe(F.col("of"))
            & (F.col("rank") > F.col("after"))
            & (F.col("size") <= F.col("gap")),
        ).select("source", "gap", "size", "rank")
        open_rows = stage(open_rows, "mixing-open")
        blocks = stage(
            _first_beyond(open_rows).withColumnRenamed("source", "of"), "mixing-blocks"
        )
        filled = (
            open_rows.join(blocks, F.col("source").eqNullSafe(F.col("of")), "left")
            .filter(F.col("block").isNull() | (F.col("rank") < F.col("block")))
            .groupBy(F.col("source").alias("filled_of"))
            .agg(F.sum("size").alias("words"))
        )
        block = F.coalesce("block", F.lit(2.0))
        state = stage(
            state.join(blocks, F.col("source").eqNullSafe(F.col("of")), "left")
            .join(filled, F.col("source").eqNullSafe(F.col("filled_of")), "left")
            .select(
                "source",
                (F.col("gap") - F.coalesce("words", F.lit(0))).alias("gap"),
                block.alias("after"),
                F.array_append(
                    "rounds", F.struct(F.col("after"), block.alias("block"), F.col("gap"))
                ).alias("rounds"),
            ),
            "mixing-state",
        )
    rounds = state.select(F.col("source").alias("rounds_of"), "rounds")
    per_source = stage(
        sources.join(rounds, F.col("source").eqNullSafe(F.col("rounds_of"))).drop("rounds_of"),
        "mixing-rounds",
    )
    once_more = F.exists(
        "rounds",
        lambda r: (F.col("rank") > r["after"])
        & (F.col("rank") < r["block"])
        & (F.col("size") <= r["gap"]),
    )
    return placed(rows, per_source).select(
        "row",
        "size",
        "source_size",
        "target",
        (F.col("certain") + F.when(once_more, 1).otherwise(0)).alias("copies"),
    )


def mixed(docs: DataFrame, **options: object) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with the columns of `docs`."""
    taken = mix(docs, **options).filter(F.col("copies") > 0)
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
