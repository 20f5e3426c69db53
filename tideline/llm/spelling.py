"""Spelling variants: words one edit apart, each with its most frequent neighbour and its root.

Words one inserted, deleted or replaced code point apart are found by asymmetric q-chunks. A word
of `L` code points contributes two disjoint chunks, its halves. The other word, of L or L - 1 code
points, contributes its positional grams of the chunks' lengths; of those within shift one it needs
just these: one at the same place, and, being the shorter, one a place earlier for a chunk behind
the edit. One edit leaves one of the chunks whole, so every pair meets at a chunk, and a distance
with a bound of one verifies it inside the join; what the join emits are pairs that are near.

A chunk that more than `GROUP` words share is not joined. Its words go on to the next level: the
part that the chunk leaves open is halved again, one of these chunks is whole again, and the key is
both chunks. That ends where the open part is a single code point, at the latest after
log2(longest word) levels: words that agree on all the rest are near each other by that alone, and
there are at most as many as the alphabet has letters (90). So no group grows with the vocabulary
and no pair is lost.

Forms point to words of at least twice the count, so their chains end after log2 of the largest
count; roots are found by doubling the pointers that often.

Nulls: a null text has no words; a null id stands as empty text before the colon of the damage.
Empty texts have none either; words of long texts are counted like others. Repeated rows count
each. Ties of the largest count go to the smallest word in code-point order. An empty table gives
an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import ship_package, stage

# Fixed values of the damage and of what counts as a word.
RUN = "[A-Za-zÀ-ÿ]+"
DAMAGE = 97
LETTERS = 5
OCCURRENCES = 3
# A form is at least so many times as frequent.
DOMINANCE = 2
# A chunk shared by more words is divided further.
GROUP = 100
# Distinct words a task holds before it passes their counts on.
HELD = 300_000
# Code points of a text that are looked at in one go.
STRETCH = 1 << 20


def _stretches(text: str) -> Iterator[str]:
    """The text in parts that end where no run goes on."""
    first = 0
    while len(text) - first > STRETCH:
        end = first + STRETCH
        rest = re.compile(RUN).match(text, end)
        if rest:
            end = rest.end()
        yield text[first:end]
        first = end
    yield text[first:]


def runs_of(text: str, least: int) -> Counter:
    """Runs of at least `least` code points with A-Z lower-cased, and how often each is there."""
    # A run that is too short is passed over as a whole, as no match can begin inside a longer one.
    wanted = re.compile(f"{RUN[:-1]}{{{least},}}")
    found: Counter = Counter()
    for part in _stretches(text):
        # On UTF-8 bytes `lower` is A-Z alone.
        lower = part.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        found.update(wanted.findall(lower))
    return found


def _count_task(letters: int):
    def count(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        held: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                names=["word", "n"],
            )
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in runs_of(text, letters).items():
                    h = zlib.crc32(word.encode(), before)
                    if h % DAMAGE == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < letters:
                            continue
                    held[word] += n
                if len(held) > HELD:
                    yield passed_on()
        if held:
            yield passed_on()

    return count


def count_words(
    docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES
) -> DataFrame:
    """`word, n`: the words, after the damage, with `letters` code points and `occurrences` at least.

    Tasks count before anything is shuffled, so a word that is everywhere is a row per task.
    """
    ship_package(docs.sparkSession)
    counted = docs.select("doc_id", "text").mapInArrow(_count_task(letters), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def _key(rest_before: Column, rest_behind: Column) -> Column:
    """A number for what two words must share: length, open part and all the rest of the word.

    Words that meet by a collision of it are told apart by the distance.
    """
    return F.xxhash64("length", "first", "last", rest_before, rest_behind)


def _halves(members: DataFrame) -> DataFrame:
    """Each member twice, with one half of its open part left open; empty open parts are left out.

    `length` is that of the longer word; `first` and `last` bound its open part. In a shorter word
    what lies behind the open part begins one place earlier.
    """
    middle = F.col("first") + F.floor((F.col("last") - F.col("first")) / 2).cast("int")
    parts = F.array(
        F.struct(F.col("first").alias("first"), middle.alias("last")),
        F.struct(middle.alias("first"), F.col("last").alias("last")),
    )
    halved = (
        members.select("word", "n", "length", "own", F.explode(parts).alias("open"))
        .select("word", "n", "length", "own", "open.first", "open.last")
        .filter(F.col("first") < F.col("last"))
    )
    behind = F.col("last") - F.col("length") + F.col("own")
    return halved.withColumn(
        "key",
        _key(
            F.substr("word", F.lit(1), F.col("first")),
            F.substr("word", behind + 1, F.col("own") - behind),
        ),
    )


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """`a, a_n, b, b_n`: every two words of (word, n) that are one edit apart, once.

    `word` must be distinct. `a` is the longer, or of two alike in length the smaller.
    """
    own = F.length("word")
    members = words.select(
        "word",
        "n",
        own.alias("own"),
        F.explode(F.array(own, own + 1)).alias("length"),
    ).select("*", F.lit(0).alias("first"), F.col("length").alias("last"))
    found = None
    while True:
        members = stage(_halves(members), "spelling-members")
        shared = members.filter(F.col("last") - F.col("first") > 1).groupBy("key").count()
        hot = stage(shared.filter(F.col("count") > group).select("key"), "spelling-hot")
        few = members.join(hot, "key", "left_anti")
        # Open parts of one code point are never divided, whatever shares their key.
        longer = few.filter(F.col("own") == F.col("length")).select(
            "key", F.col("word").alias("a"), F.col("n").alias("a_n")
        )
        other = few.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), "own", "length")
        same_length = F.col("own") == F.col("length")
        met = longer.join(other, "key").filter(
            (~same_length | (F.col("a") < F.col("b")))
            & (F.levenshtein(F.col("a"), F.col("b"), 1) == 1)
        ).select("a", "a_n", "b", "b_n")
        met = stage(met, "spelling-pairs")
        found = met if found is None else found.unionByName(met)
        if hot.isEmpty():
            return found.dropDuplicates(["a", "b"])
        members = members.join(hot, "key", "left_semi").drop("key")


def _roots(forms: DataFrame, hops: int) -> DataFrame:
    """`word, root` of (word, form): where the forms end, for chains of at most `hops`."""
    pointers = stage(forms.select("word", F.col("form").alias("root")), "spelling-pointers")
    for _ in range(math.ceil(math.log2(hops + 1)) if hops else 0):
        further = pointers.select(F.col("word").alias("at"), F.col("root").alias("beyond"))
        pointers = stage(
            pointers.join(further, F.col("root") == F.col("at"), "left").select(
                "word", F.coalesce("beyond", "root").alias("root")
            ),
            "spelling-pointers",
        )
    return pointers


def variant_groups(words: DataFrame, group: int = GROUP, dominance: int = DOMINANCE) -> DataFrame:
    """`word, n, n_near, form, form_n, root` of every word of (word, n).

    `form` is the near word of largest n, ties the smallest word, if that n is at least `dominance`
    times the word's own; `root` is where the forms lead to, the word itself without a form.
    """
    if dominance < 2:
        raise ValueError("forms must be more frequent, or their chains may not end")
    words = stage(words.select("word", "n"), "spelling-words")
    pairs = near_words(words, group)
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word")).alias("other")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("word")).alias("other")),
    )
    best = (
        pairs.select(F.explode(both).alias("link"))
        .select("link.*")
        .groupBy("word", "n")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min("other").alias("best"))
    )
    is_form = -F.col("best.n") >= dominance * F.col("n")
    best = stage(
        best.select(
            "word",
            "n_near",
            F.when(is_form, F.col("best.word")).alias("form"),
            F.when(is_form, -F.col("best.n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    least, most = words.agg(F.min("n"), F.max("n")).first()
    hops = 0 if most is None or least < 1 else int(math.log(most / least, dominance) + 1e-9)
    roots = _roots(best.filter(F.col("form").isNotNull()), hops)
    return (
        words.join(best, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )
