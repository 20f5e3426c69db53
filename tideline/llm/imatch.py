"""I-Match fingerprints with randomised lexicons, and how they hold under edits.

The lexicon is the terms (lower-cased words) whose inverse document frequency lies in a band: in
`MIN_DOCUMENTS` documents at least and in a share `MAX_SHARE` of them at most. Each of
`SEEDS * RATES` random subsets of the lexicon keeps a quarter, a sixteenth, ... of its terms, and the
distinct terms kept of a document are hashed as a set: their 64-bit hashes under the subset's seed are
combined by exclusive or, which no order changes. Subsets that differ in rate fit short and long
documents. The fingerprint is the list of these hashes, 32 bits of each, "-" where a subset keeps
nothing; a text without terms of the lexicon has its own digest instead.

Document frequencies are counted for every term, told apart by its 64-bit hash, and tasks add them up
before anything is shuffled. The lexicon is a table that grows with the input, so terms do not go to
it; what is outside of it comes to them. A term below the band is in one document, which is told of
it, and so is the one whose edited text may hold it. Terms above the band are few whatever the input:
each takes `MAX_SHARE` of the documents, so there are at most as many as a mean document has terms,
divided by that share. They are sent to the tasks, up to `SENT` of them. Every other word of the two
documents is in the lexicon. An edited text has two words besides that may be in neither: the one
where both parts meet and the last one. These are looked up in the lexicon by a join, and what they
add to the fingerprint is put in afterwards, which exclusive or allows.

Texts are shuffled once, to meet the text that theirs is edited with; the terms of both add up to
fingerprints right there, without being gathered or shuffled. Shuffled texts and terms are deleted as
soon as what was made of them is stored.

The likeness of two fingerprints is the share of equal hashes among subsets not empty in both.

Nulls: a null text is empty, null ids come last. Rows that repeat an id and a text are one document
in the order and each get a row. One document is its own next one. An empty table gives an empty
result. Columns other than `doc_id` and `text` are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import SPACES, stage, whole_text

MIN_DOCUMENTS = 2
MAX_SHARE = 0.2
SEEDS = 8
RATES = 5
HASH_DIGITS = 8
SENT = 4_000_000
# Stands for no term and is never left out, so that a text without terms keeps a row.
NO_TERM = 0


def _hashes(text: Column) -> Column:
    """Hashes of the terms of a text, in their order and repeated."""
    hashes = F.transform(F.split(F.lower(text), SPACES), lambda w: F.xxhash64(w))
    # Only the ends of a split text can be empty.
    return F.array_remove(hashes, F.xxhash64(F.lit("")))


def places(docs: DataFrame, holder: Column) -> DataFrame:
    """`term, place, holder` for the hash of each term; place is 0 inside the band, -1 below, 1 above.

    `holder` is a number for a row. A term below the band has that of the one row it is in; rows that
    share a number by chance are no harm, as only one of them has the term.
    """
    total = docs.count()
    # The holder is worked out in a projection of its own, once a row and not once a term.
    held = docs.select(whole_text().alias("text"), holder.alias("holder"))
    counted = (
        held.select(F.explode(F.array_distinct(_hashes(F.col("text")))).alias("term"), "holder")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("documents"), F.min("holder").alias("holder"))
    )
    above = F.col("documents") > F.greatest(F.lit(MIN_DOCUMENTS), F.lit(MAX_SHARE * total))
    below = F.col("documents") < MIN_DOCUMENTS
    found = counted.filter(F.col("term") != NO_TERM).select(
        "term",
        F.when(below, -1).when(above, 1).otherwise(0).cast("byte").alias("place"),
        F.when(below, F.col("holder")).alias("holder"),
    )
    return stage(found, "imatch-terms", release=True)


def lexicon(docs: DataFrame, placed: DataFrame | None = None) -> DataFrame:
    """`term` for the hash of each term inside the band; `placed` are the `places` of `docs`, if known."""
    if placed is None:
        placed = places(docs, F.lit(0))
    return placed.filter("place = 0").select("term")


def _without_common(terms: DataFrame, placed: DataFrame) -> DataFrame:
    """`terms` but for those above the band."""
    common = placed.filter("place > 0").select("term")
    if common.count() <= SENT:
        common = F.broadcast(common)
    return terms.join(common, "term", "left_anti")


def known_terms(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """`rows` with a row per term of the lexicon, `term, of`, instead of `own, edited`.

    `own` and `edited` are the hashes of two texts, without terms below the band; `of` is 1 for a term
    of the first, 2 of the second and 3 of both. Every row has `NO_TERM` besides, with 0.
    """

    def flagged(hashes: Column, of: int) -> Column:
        return F.transform(hashes, lambda h: F.struct(h.alias("term"), F.lit(of).alias("of")))

    every = F.concat(
        flagged(F.array_intersect("own", "edited"), 3),
        flagged(F.array_except("own", "edited"), 1),
        flagged(F.array_except("edited", "own"), 2),
        flagged(F.array(F.lit(NO_TERM).cast("long")), 0),
    )
    others = [c for c in rows.columns if c not in ("own", "edited")]
    exploded = rows.select(*others, F.explode(every).alias("t")).select(*others, "t.term", "t.of")
    return _without_common(exploded, placed)


def known_cut_words(rows: DataFrame, placed: DataFrame, terms: DataFrame) -> DataFrame:
    """`key, term, of` for those of `seam` and `tail` that are in the lexicon `terms`; `of` is 2."""
    cut = rows.select(
        "key", F.explode(F.array_distinct(F.array("seam", "tail"))).alias("term"), F.lit(2).alias("of")
    ).filter(F.col("term") != F.xxhash64(F.lit("")))
    # Where many texts end in the same word, it is mostly one above the band.
    return _without_common(cut, placed).join(terms, "term", "left_semi")


def _hash_of(bit: int, kept: Column, value: Column) -> Column:
    """Hash of the set of those terms of a text that are kept, null for none."""
    inside = (F.col("of").bitwiseAND(F.lit(bit)) != 0) & kept
    return F.shiftright(F.bit_xor(F.when(inside, value)), 64 - 4 * HASH_DIGITS).cast("int")


def fingerprints(terms: DataFrame) -> DataFrame:
    """`own_prints, edited_prints` per row of what `known_terms` was given.

    Arrays of integers, null where a subset keeps nothing; a text without terms has none at all.
    """
    rows = [c for c in terms.columns if c not in ("term", "of")]
    seeded = terms.select("*", *(F.xxhash64("term", F.lit(s)).alias(f"h_{s}") for s in range(SEEDS)))
    parts = {}
    for name, bit in (("own", 1), ("edited", 2)):
        parts[name, "all"] = _hash_of(bit, F.lit(True), F.col("term"))
        for seed in range(SEEDS):
            value = F.col(f"h_{seed}")
            for rate in range(1, RATES + 1):
                kept = value.bitwiseAND(F.lit(4**rate - 1)) == 0
                parts[name, seed, rate] = _hash_of(bit, kept, value)
    columns = {part: "_".join(map(str, part)) for part in parts}
    summed = seeded.groupBy(*rows).agg(*(parts[p].alias(c) for p, c in columns.items()))

    def listed(name: str) -> Column:
        own = [c for p, c in columns.items() if p[0] == name]
        return F.when(F.col(own[0]).isNotNull(), F.array(*own)).alias(f"{name}_prints")

    return summed.select(*rows, listed("own"), listed("edited"))


def added(a: str, b: str) -> Column:
    """Fingerprint of the terms of two that have none in common; null is that of no terms."""
    both = F.zip_with(a, b, lambda x, y: F.coalesce(x.bitwiseXOR(y), x, y))
    return F.coalesce(both, F.col(a), F.col(b))


def _text_of(prints: str, alone: str) -> Column:
    """A fingerprint as text; `alone` is that of a text without terms."""

    def digits(value: Column) -> Column:
        unsigned = value.cast("long").bitwiseAND(F.lit((1 << 4 * HASH_DIGITS) - 1))
        return F.coalesce(F.lpad(F.hex(unsigned), HASH_DIGITS, "0"), F.lit("-"))

    return F.coalesce(F.array_join(F.transform(prints, digits), " "), F.col(alone))


def likeness(a: str, b: str, a_alone: str, b_alone: str) -> Column:
    """Share of equal hashes among the subsets that are not empty in both; 0 for unlike kinds."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda v: v))
    used = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.isNotNull() | y.isNotNull()), lambda v: v))
    alone = F.coalesce((F.col(a_alone) == F.col(b_alone)).cast("double"), F.lit(0.0))
    return F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), same / used).otherwise(alone)


def neighbours(rows: DataFrame) -> DataFrame:
    """`key, n_chars, holder, prev_key, prev_n` for distinct (key, doc_id, holder, n_chars).

    Rows are range partitioned by descending id; windows run inside the partitions, and the borders
    of the partitions are put together. The last row is before the first one.
    """
    by_id = [F.col("doc_id").desc_nulls_last(), F.col("key").desc()]
    ranged = stage(
        rows.distinct().repartitionByRange(*by_id).withColumn("part", F.spark_partition_id()),
        "imatch-order",
        release=True,
    )
    inside = Window.partitionBy("part").orderBy(*by_id)
    near = ranged.select(
        "*", F.lag("key").over(inside).alias("lag_key"), F.lag("n_chars").over(inside).alias("lag_n")
    )
    ends = ranged.groupBy("part").agg(F.min(F.struct("doc_id", "key", "n_chars")).alias("tail"))
    parts = Window.orderBy("part")
    ends = ends.select(
        "part",
        F.coalesce(
            F.lag("tail").over(parts),
            F.last("tail").over(parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("before"),
    )
    return near.join(ends, "part").select(
        "key",
        "n_chars",
        "holder",
        F.coalesce("lag_key", F.col("before.key")).alias("prev_key"),
        F.coalesce("lag_n", F.col("before.n_chars")).alias("prev_n"),
    )


def _first_word(text: Column) -> Column:
    """What stands before the first separator."""
    return F.split(text, SPACES, 2)[0]


def _last_word(text: Column) -> Column:
    """What stands behind the last separator."""
    return F.reverse(_first_word(F.reverse(text)))


def next_document_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    The edited text has its last third replaced by the start of the next document, by descending id.
    Columns: `doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`.
    """
    base = docs.select("doc_id", whole_text().alias("text"))
    holder = F.hash("doc_id", "text")
    placed_terms = places(base, holder)
    terms = lexicon(base, placed_terms)
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text"))
    keyed = base.withColumn("key", F.unhex(F.sha2(named, 256)))
    rare = placed_terms.filter("place < 0").groupBy("holder").agg(F.collect_list("term").alias("rare"))
    order = stage(
        neighbours(
            keyed.select(
                "key", "doc_id", holder.alias("holder"), F.length("text").cast("long").alias("n_chars")
            )
        )
        .join(rare, "holder", "left")
        .withColumn("rare", F.coalesce("rare", F.array().cast("array<long>")))
        .drop("holder"),
        "imatch-neighbours",
        release=True,
    )
    # Rows that repeat an id and a text are one here, combined before they are shuffled. What a
    # document lends to the one before it is a third of that one.
    texts = keyed.groupBy("key").agg(F.first("text").alias("text"))
    placed = texts.join(order, "key")
    lent = placed.select(
        F.col("prev_key").alias("key"),
        F.expr("substring(text, 1, int(prev_n div 3))").alias("start"),
        F.col("rare").alias("next_rare"),
    )
    edited = (
        placed.join(lent, "key")
        .withColumn("kept", F.expr("substring(text, 1, int(n_chars - n_chars div 3))"))
        .withColumn("edited", F.concat("kept", "start"))
    )
    seam = F.xxhash64(F.lower(F.concat(_last_word(F.col("kept")), _first_word(F.col("start")))))
    tail = F.xxhash64(F.lower(_last_word(F.col("edited"))))
    hashed = edited.select(
        "*", _hashes(F.col("text")).alias("own_terms"), _hashes(F.col("edited")).alias("edited_terms"),
        seam.alias("seam"), tail.alias("tail"),
    ).select(
        "key", "prev_key", "n_chars", "seam", "tail",
        F.unhex(F.sha2("text", 256)).alias("sha256"), F.unhex(F.sha2("edited", 256)).alias("edited_sha256"),
        F.array_except("own_terms", "rare").alias("own"),
        F.array_except("edited_terms", F.concat("rare", "next_rare", F.array("seam", "tail"))).alias("edited"),
    )

    def alone(sha256: str) -> Column:
        return F.substring(F.lower(F.hex(sha256)), 1, 2 * HASH_DIGITS)

    printed = fingerprints(known_terms(hashed, placed_terms))
    parts = stage(
        printed.select(
            "key", "prev_key", "n_chars", "edited_sha256", "seam", "tail", "own_prints", "edited_prints",
            F.when(F.col("own_prints").isNull(), alone("sha256")).alias("own_alone"),
        ),
        "imatch-parts",
        release=True,
    )
    cut = fingerprints(known_cut_words(parts, placed_terms, terms))
    whole = (
        parts.join(cut.select("key", F.col("edited_prints").alias("cut_prints")), "key", "left")
        .withColumn("edited_prints", added("edited_prints", "cut_prints"))
        .withColumn("edited_alone", F.when(F.col("edited_prints").isNull(), alone("edited_sha256")))
    )
    found = stage(whole.drop("seam", "tail", "cut_prints"), "imatch-prints", release=True)
    # Each document is the next one of one other, which its fingerprint is sent to.
    following = found.select(
        F.col("prev_key").alias("key"),
        F.col("own_prints").alias("next_prints"), F.col("own_alone").alias("next_alone"),
    )
    both = found.drop("prev_key").join(following, "key")
    return keyed.select("key", "doc_id").join(both, "key").select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        _text_of("own_prints", "own_alone").alias("fingerprint"),
        _text_of("edited_prints", "edited_alone").alias("edited_fingerprint"),
        likeness("own_prints", "edited_prints", "own_alone", "edited_alone").alias("near_edited"),
        likeness("own_prints", "next_prints", "own_alone", "next_alone").alias("near_next"),
    )
