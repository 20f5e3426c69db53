"""Language identification by compression.

For each language a zstandard raw-content dictionary is made of its most frequent words, the most
frequent last, where matches are nearest. A text's words are cut into windows, all of them, and
each window is compressed with every dictionary; the language with the fewest bytes in all wins.
The margin is how much more the runner-up needs, as a share of the winner's bytes; below `MARGIN`
the decision is rejected (`accepted` false, `lang_pred` still the nearest language).

Training reads at most `SAMPLE` documents of each language: those of at most `SAMPLE_CHARS`
characters first, by the hashes of their ids, then longer ones, of which it reads `PIECES` pieces
spread from start to end, `SAMPLE_CHARS` in all. That is the only place where text is left out. A
word counts once per document.

Nulls: a text that is null or has no letters is `und` with score 0. Rows without a language or an
id are not learned from; without any language everything is `und`. Ties go to the first language by
name. Repeated rows are predicted one by one; an empty table gives an empty result. Other columns of
the input are kept, `lang_pred`, `score` and `accepted` replace columns of those names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import ship_package
from tideline.llm.compression import compressor, content, windows, words_in

SAMPLE = 1500
SAMPLE_CHARS = 20_000
PIECES = 10
WINDOW = 64
DICTIONARY_BYTES = 16_384
# Matches this short let syllables tell languages apart where words are new.
MIN_MATCH = 4
MARGIN = 0.02
# How fast the score nears 1 with the margin.
STEEPNESS = 20.0
UNKNOWN = "und"


def fit(texts: Sequence[str | None], langs: Sequence[str]) -> dict[str, bytes]:
    """A dictionary per language. The order of the rows has no effect."""
    counts: dict[str, Counter] = {}
    for text, lang in zip(texts, langs, strict=True):
        counts.setdefault(lang, Counter()).update(set(words_in(text)))
    dictionaries = {}
    for lang in sorted(counts):
        common = sorted(counts[lang], key=lambda w: (-counts[lang][w], w))
        dictionaries[lang] = content(reversed(common), DICTIONARY_BYTES)
    return dictionaries


def predict(text: str | None, tools: Mapping[str, object]) -> tuple[str, float, bool]:
    """Language, score and whether the margin is wide enough."""
    words = words_in(text)
    if not words or not tools:
        return UNKNOWN, 0.0, False
    cut = windows(words, WINDOW)
    sizes = sorted((sum(len(t.compress(w)) for w in cut), lang) for lang, t in tools.items())
    best, lang = sizes[0]
    margin = (sizes[1][0] - best) / best if len(sizes) > 1 else 1.0
    return lang, 1 - math.exp(-STEEPNESS * margin), margin >= MARGIN


def train(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> dict[str, bytes]:
    """Dictionaries from the rows of `docs` (doc_id, text, lang) that satisfy `learn`.

    Languages are told apart by name; their number is that of the distinct names.
    """
    usable = docs.filter(learn & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    usable = usable.filter(F.col("text").isNotNull())
    length = F.length("text")
    long = length > SAMPLE_CHARS
    ids = usable.select("doc_id", "lang", long.alias("long"))
    langs = [row[0] for row in ids.select("lang").distinct().collect()]
    drawn = None
    for lang in langs:
        some = ids.filter(F.col("lang") == lang).orderBy("long", F.xxhash64("doc_id"), "doc_id").limit(sample)
        drawn = some if drawn is None else drawn.unionByName(some)
    if drawn is None:
        return {}
    piece = SAMPLE_CHARS // PIECES
    starts = (F.lit(1) + F.floor((length - piece) * k / (PIECES - 1)).cast("int") for k in range(PIECES))
    pieces = F.concat_ws(" ", *(F.substr("text", start, F.lit(piece)) for start in starts))
    read = F.when(long, pieces).otherwise(F.col("text")).alias("text")
    rows = (
        usable.withColumn("long", long)
        .join(drawn.distinct(), ["doc_id", "lang", "long"])
        .select(read, "lang")
        .collect()
    )
    return fit([row[0] for row in rows], [row[1] for row in rows])


def with_language(docs: DataFrame, dictionaries: Mapping[str, bytes]) -> DataFrame:
    """`docs` with `lang_pred, score, accepted`. The dictionaries travel with the function."""
    ship_package(docs.sparkSession)
    known = dict(dictionaries)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tools = {lang: compressor(data, MIN_MATCH) for lang, data in known.items()}
        for batch in batches:
            yield pd.DataFrame(
                [predict(text, tools) for text in batch], columns=["lang_pred", "score", "accepted"]
            )

    found = docs.withColumn("language of text", classify(F.col("text")))
    others = [c for c in docs.columns if c not in ("lang_pred", "score", "accepted")]
    return found.select(*(f"`{c}`" for c in others), F.col("`language of text`.*"))
