"""Toxicity by compression distance.

Two zstandard raw-content dictionaries are trained, one on toxic and one on ordinary text. Both end
in the same words, the most frequent ones of all training text, so that ordinary prose costs the
same under either. In front of those stand the words that tell the classes apart: in the toxic one
the words whose share of toxic documents is above their share of ordinary ones by `SIGNIFICANCE`
standard errors, in the other as many bytes of further words of ordinary text. Near copies of a
training document count once, so a copied text makes none of its words significant.

A text is cut into windows of `WINDOW` words, all of them. A window's margin is the bytes that the
toxic dictionary saves over the ordinary one. From a document's margins (mean, maximum, share and
number of windows at `NOTABLE` or above, number of windows) a logistic fit on the training
documents gives a score in [0, 1]; 0.5 is the calibrated threshold.

Training reads at most `SAMPLE` labelled documents of each class, those with the smallest hashes of
their ids. Those longer than `SAMPLE_CHARS` are learnt from only where a class has no others, by
pieces spread over them; that is the only place where text is left out.
Nulls: a null or empty text, and one without letters, is one empty window. Labels that are null, or
whose id is null, are not learned from; with one class alone nothing can be learned and every score
is that class (0 without labels). Repeated rows are scored one by one; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import ship_package
from tideline.llm.compression import compressor, content, windows, words_in

SAMPLE = 3000
SAMPLE_CHARS = 20_000
PIECES = 10
WINDOW = 16
NOTABLE = 3
SIGNIFICANCE = 6.0
SUPPORT = 5
SPECIAL_BYTES = 8192
SHARED_BYTES = 16_384
SHARED_WORDS = 2500
SHINGLE = 5


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    center: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


def _margins(text: str | None, toxic, ordinary) -> np.ndarray:
    cut = windows(words_in(text), WINDOW) or [b""]
    return np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in cut])


def _features(margins: np.ndarray) -> tuple[float, ...]:
    notable = margins >= NOTABLE
    return (
        float(margins.mean()),
        float(margins.max()),
        float(notable.mean()),
        math.log1p(int(notable.sum())),
        math.log(len(margins)),
    )


def _word_counts(texts: Sequence[list[str]]) -> tuple[Counter, int]:
    """In how many groups of near copies a word is, and the number of groups.

    A group shares its lowest hash of five consecutive words.
    """
    import xxhash

    groups: dict[int, set[str]] = {}
    for words in texts:
        shingles = [" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))]
        lowest = min(
            xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) for s in shingles
        )
        groups.setdefault(lowest, set()).update(words)
    counts: Counter = Counter()
    for words in groups.values():
        counts.update(words)
    return counts, len(groups)


def _dictionaries(toxic: Sequence[list[str]], ordinary: Sequence[list[str]]) -> tuple[bytes, bytes]:
    in_toxic, n_toxic = _word_counts(toxic)
    in_ordinary, n_ordinary = _word_counts(ordinary)

    def errors(word: str) -> float:
        """By how many standard errors the word is more frequent in toxic documents."""
        a, b = in_toxic[word], in_ordinary[word]
        share = (a + b) / (n_toxic + n_ordinary)
        spread = share * (1 - share) * (1 / n_toxic + 1 / n_ordinary)
        return (a / n_toxic - b / n_ordinary) / math.sqrt(spread) if spread else 0.0

    telling = {w: errors(w) for w in in_toxic if in_toxic[w] >= SUPPORT}
    # The strongest last, where matches are nearest.
    special = sorted((w for w in telling if telling[w] >= SIGNIFICANCE), key=lambda w: (telling[w], w))
    frequent = sorted(in_ordinary, key=lambda w: (-in_ordinary[w], w))
    frequent = [w for w in frequent if telling.get(w, 0.0) < SIGNIFICANCE]
    shared = content(reversed(frequent[:SHARED_WORDS]), SHARED_BYTES)
    front = content(special, SPECIAL_BYTES)
    other = content(reversed(frequent[SHARED_WORDS:]), len(front))
    return front + shared, other.rjust(len(front), b"\0") + shared


def _fit(features: np.ndarray, labels: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Weights of a logistic fit by Newton steps; the first one is the intercept."""
    x = np.c_[np.ones(len(features)), features]
    ridge = penalty * len(x) * np.diag([1e-6] + [1.0] * features.shape[1])
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (labels - p) - ridge @ weights
        weights = weights + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, slope)
    return weights


def fit(texts: Sequence[str | None], labels: Sequence[int]) -> ToxicityModel:
    """A model from texts and their labels (1: toxic). The order of the rows has no effect."""
    ordered = sorted(zip((t or "" for t in texts), labels, strict=True))
    split = [words_in(text) for text, _ in ordered]
    y = np.array([label for _, label in ordered], dtype=float)
    n_features = len(_features(np.zeros(1)))
    if not len(y) or y.min() == y.max():
        certain = 30.0 if len(y) and y[0] == 1 else -30.0
        flat = (0.0,) * n_features
        return ToxicityModel(b"", b"", flat, (1.0,) * n_features, (certain, *flat))
    toxic, ordinary = _dictionaries(
        [w for w, label in zip(split, y, strict=True) if label == 1],
        [w for w, label in zip(split, y, strict=True) if label == 0],
    )
    tools = compressor(toxic), compressor(ordinary)
    features = np.array([_features(_margins(text, *tools)) for text, _ in ordered])
    center, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    weights = _fit((features - center) / scale, y)
    return ToxicityModel(
        toxic, ordinary, tuple(center.tolist()), tuple(scale.tolist()), tuple(weights.tolist())
    )


def training_sample(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample: int = SAMPLE
) -> DataFrame:
    """`text, toxic, long` of at most `sample` labelled documents of each class.

    Of a text longer than `SAMPLE_CHARS` as many characters are read, in pieces spread over it.
    `learn` is a condition on `doc_id`. The ids are drawn from the labels, by hash, so what is
    sorted and joined is narrow, and the few ids drawn are small enough for any join.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    if learn is not None:
        usable = usable.filter(learn)
    usable = usable.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    order = F.xxhash64("doc_id"), F.col("doc_id")
    drawn = [usable.filter(F.col("toxic") == k).orderBy(*order).limit(sample) for k in (0, 1)]
    length = F.length("text")
    piece = SAMPLE_CHARS // PIECES
    starts = (F.lit(1) + F.floor((length - piece) * k / (PIECES - 1)).cast("int") for k in range(PIECES))
    pieces = F.concat_ws(" ", *(F.substr("text", start, F.lit(piece)) for start in starts))
    long = F.coalesce(length > SAMPLE_CHARS, F.lit(False))
    read = docs.select(
        "doc_id", F.when(long, pieces).otherwise(F.col("text")).alias("text"), long.alias("long")
    )
    return read.join(drawn[0].unionByName(drawn[1]), "doc_id").select("text", "toxic", "long")


def train(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample: int = SAMPLE
) -> ToxicityModel:
    rows = training_sample(docs, labels, learn, sample).collect()
    # Long texts stand in only for a class that has no others.
    short = {row[1] for row in rows if not row[2]}
    rows = [row for row in rows if not row[2] or row[1] not in short]
    return fit([row[0] for row in rows], [row[1] for row in rows])


def with_toxicity(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """`docs` with the score of `text` in a further column `name`.

    The model is some tens of kilobytes and travels with the function.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tools = compressor(model.toxic), compressor(model.ordinary)
        for batch in batches:
            features = np.array(
                [_features(_margins(one, *tools)) for one in batch], dtype=float
            ).reshape(len(batch), len(model.center))
            z = (features - model.center) / model.scale @ model.weights[1:] + model.weights[0]
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.withColumn(name, score(F.col("text")))
