"""Cross-entropy difference of two n-gram models with one vocabulary.

The target is the documents marked as such; the background is a sample of all documents as large as
the target, drawn by a hash of id and text. The shared vocabulary is the words of at least
`DOCUMENTS` target documents, the border of a text and one unknown word for all others. Two matched
bigram models are interpolated with their unigrams by the same `WEIGHT`, and these with the uniform
distribution:

    p(w) = (c(w) + 1) / (tokens + words)    p(w | u) = (c(u, w) + WEIGHT * p(w)) / (c(u) + WEIGHT)

Bigrams with an unknown word, and those that target and background together have fewer than
`OCCURRENCES` times, are not counted; p(w | u) then follows from the words alone. A text is
scored by what the models know *without it*: where it belongs to the target or the background, its
own counts are taken out first, so texts that were learnt score like others. The score is the mean
loss per token under the target model less that under the background model, in nats: the lower, the
more a text is like the target.

A text's loss is a sum over its distinct words, with a correction for each distinct bigram that a
model has. Words and bigrams are entries of one table that grows with the input, dealt to buckets by
a hash. For each bucket a text sends its entries as one packed row; there the bucket's part of the
table, sorted, is searched for them, and the sums go back to the text. If the vocabulary has at most
`SENT` words it is sent to all tasks, which drop what is unknown before anything is shuffled; if
not, more is shuffled, with the same result. Shuffled counts are deleted once the table is stored.
Words are told apart by 64-bit hashes, entries by a bucket and 48 bits more.

Nulls: a null or empty text is the border after the border, one token. Rows that repeat an id and a
text are scored alike; ids may be null, a null mark is no mark. Without a target all words are
unknown. An empty table gives an empty result. Other columns of the input are kept; those named like
a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import ship_package, stage, text_chunks, whole_text

BORDER = 0
WEIGHT = 20.0
DOCUMENTS = 30
OCCURRENCES = 2
SENT = 2_000_000
ENTRIES_PER_BUCKET = 4_000_000
LEAST_BUCKETS = 16
CHUNK_BYTES = 4 << 20
DRAWS = 1 << 30
RESULTS = ("n_tokens", "target_loss", "background_loss", "score")
KEY = "lm text key"
MOST = 255  # an entry of a packed row holds a count of so many
KEY_BYTES = 6
# Marks of a text that belongs to the target, or to the background.
IN_TARGET, IN_BACKGROUND = 1, 2

ENTRIES = "bucket int, part int, k long, a long, b long, c long, d long"
PACKED = "bucket int, part int, k long, a long, b long, c long, d long, keys binary, n binary, own binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _coded(chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a chunk's texts by number: `ids, first, second, text, marks`.

    `ids` has the 64-bit number of each distinct word, the border at 0. `second` are the places there
    of the words of all texts in a row, the border after those of each text; `first` are the ones
    before them and `text` tells the texts apart. `marks` has one for each text. Words are split and
    told apart by Arrow, at the same six characters as elsewhere, and each is hashed once a chunk.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash

    lines = pc.fill_null(chunk.column(chunk.schema.get_field_index("text")), "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(lines))
    words = split.flatten()
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    # The ends of a split text may be empty.
    some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    of_text = np.repeat(np.arange(len(lengths)), lengths)[some]
    coded = words.dictionary_encode()
    wide = pa.types.is_large_string(words.type)
    distinct = coded.dictionary.cast(pa.large_binary() if wide else pa.binary())
    hashes = map(xxhash.xxh3_64_intdigest, distinct.to_numpy(zero_copy_only=False))
    ids = np.zeros(len(distinct) + 1, np.uint64)
    # No word has the number of the border.
    ids[1:] = np.maximum(np.fromiter(hashes, np.uint64, len(distinct)), 1)
    second = np.zeros(len(of_text) + len(lengths), np.int64)
    second[np.arange(len(of_text)) + of_text] = coded.indices.to_numpy(zero_copy_only=False)[some] + 1
    first = np.concatenate([[BORDER], second[:-1]])
    text = np.repeat(np.arange(len(lengths)), np.bincount(of_text, minlength=len(lengths)) + 1)
    marks = chunk.column(chunk.schema.get_field_index("marks")).to_numpy(zero_copy_only=False)
    return ids, first, second, text, marks


def bigram_keys(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(u + np.uint64(1)) + w)


def word_keys(w: np.ndarray) -> np.ndarray:
    return _mixed(w ^ np.uint64(0x5851F42D4C957F2D))


def _among(ids: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Which ids are in the sorted vocabulary."""
    at = np.minimum(np.searchsorted(vocabulary, ids), len(vocabulary) - 1)
    return vocabulary[at] == ids if len(vocabulary) else np.zeros(len(ids), dtype=bool)


def _word_counts_task():
    """`w, t, b, d` of each chunk: counts in target and background, and target documents."""

    def counts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for chunk in text_chunks(batches, CHUNK_BYTES):
            # The border counts once: as the word after the last one, and as that before the first.
            ids, _, second, text, marks = _coded(chunk)
            target, background = (marks & IN_TARGET > 0)[text], (marks & IN_BACKGROUND > 0)[text]
            once = np.unique((text * len(ids) + second)[target]) % len(ids)
            sums = [np.bincount(second, target, len(ids)), np.bincount(second, background, len(ids))]
            sums.append(np.bincount(once, minlength=len(ids)))
            there = np.flatnonzero(np.bincount(second, minlength=len(ids)))
            arrays = [pa.array(ids[there].view(np.int64))]
            arrays += [pa.array(c[there].astype(np.int64)) for c in sums]
            yield pa.RecordBatch.from_arrays(arrays, names=["w", "t", "b", "d"])

    return counts


def _bigram_counts_task(sent):
    """`u, w, t, b` of each chunk, of words in the vocabulary where it is sent."""

    def counts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for chunk in text_chunks(batches, CHUNK_BYTES):
            ids, first, second, text, marks = _coded(chunk)
            # Marks are two bits; what has the same pair of words lies side by side.
            pairs = (first * len(ids) + second) * 4 + marks[text]
            if sent is not None:
                inside = _among(ids, sent.value)
                pairs = pairs[inside[first] & inside[second]]
            pairs, n = np.unique(pairs, return_counts=True)
            pairs, mark = pairs >> 2, pairs & 3
            starts = np.flatnonzero(np.diff(pairs, prepend=-1))
            sums = [
                np.add.reduceat(n * (mark & one > 0), starts) if len(starts) else n
                for one in (IN_TARGET, IN_BACKGROUND)
            ]
            u, w = np.divmod(pairs[starts], len(ids))
            arrays = [pa.array(ids[u].view(np.int64)), pa.array(ids[w].view(np.int64)), *map(pa.array, sums)]
            yield pa.RecordBatch.from_arrays(arrays, names=["u", "w", "t", "b"])

    return counts


def _place(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each key, and what tells it apart inside."""
    n = np.uint64(buckets)
    return (keys % n).astype(np.int32), (keys // n) & np.uint64((1 << 8 * KEY_BYTES) - 1)


def _entries_task(buckets: int):
    """Rows of (u, w, t, b, w_t, w_b) as entries; a null `u` stands for the word alone."""

    def entries(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            u, w, t, b, w_t, w_b = (batch.column(k) for k in range(6))
            alone = u.is_null().to_numpy(zero_copy_only=False)
            first = u.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
            second = w.to_numpy(zero_copy_only=False).view(np.uint64)
            keys = np.where(alone, word_keys(second), bigram_keys(first, second))
            bucket, inside = _place(keys, buckets)
            zero = pa.array(np.zeros(len(keys), np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), zero, pa.array(inside.view(np.int64)), t, b, w_t, w_b],
                names=["bucket", "part", "k", "a", "b", "c", "d"],
            )

    return entries


def _split_counts(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of entries; those with counts above `MOST` are there more than once."""
    at = np.arange(len(n))
    if len(n) and n.max() > MOST:
        times = -(-n // MOST)
        at = np.repeat(at, times)
        rest = n - (times - 1) * MOST
        last = np.r_[at[1:] != at[:-1], True]
        return at, np.where(last, rest[at], MOST)
    return at, n


def _binary(data: np.ndarray, ends: np.ndarray):
    """An array of binary values that lie in a row in `data` and end at `ends`."""
    import pyarrow as pa

    offsets = np.concatenate([[0], ends])
    wide = offsets[-1] > np.iinfo(np.int32).max
    buffers = [None, pa.py_buffer(offsets.astype(np.int64 if wide else np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary() if wide else pa.binary(), len(ends), buffers)


def _data(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of binary values in a row, and their lengths."""
    import pyarrow as pa

    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], np.diff(offsets)


def _pieces_task(buckets: int, sent):
    """For each text and bucket the entries of the text, packed."""

    def entries_of(ids, first, second, text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, key, count there, and the text's own counts of (entry, its last word)."""
        size = len(ids)
        words, n = np.unique(text * size + second, return_counts=True)
        pairs = (text * size + second) * size + first
        keep = slice(None)
        if sent is not None:
            # The border is in every vocabulary and before the first word.
            inside = _among(ids, sent.value)
            keep = inside[words % size]
            pairs = pairs[inside[first] & inside[second]]
        pairs, n_pairs = np.unique(pairs, return_counts=True)
        last, u = np.divmod(pairs, size)
        # In the order of their last words, which are among the words.
        of_last = n[np.searchsorted(words, last)]
        words, n = words[keep], n[keep]
        keys = [word_keys(ids)[words % size], bigram_keys(ids[u], ids[last % size])]
        own = np.stack([np.concatenate([n, n_pairs]), np.concatenate([n, of_last])], axis=1)
        at, counts = _split_counts(own[:, 0])
        of_text = np.concatenate([words, last]) // size
        return of_text[at], np.concatenate(keys)[at], counts, own.astype("<u4")[at]

    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for chunk in text_chunks(batches, CHUNK_BYTES):
            text_keys = chunk.column(chunk.schema.get_field_index("key")).to_numpy(zero_copy_only=False)
            *coded, text, marks = _coded(chunk)
            of_text, keys, n, own = entries_of(*coded, text)
            bucket, inside = _place(keys, buckets)
            group = of_text * buckets + bucket
            # Sorted by group and place, in one number.
            bits = len(group).bit_length()
            order = np.sort(group << bits | np.arange(len(group))) & ((1 << bits) - 1)
            group, inside, n, own = group[order], inside[order], n[order], own[order]
            ends = np.flatnonzero(np.diff(group, append=-1)) + 1
            of_piece, number = np.divmod(group[ends - 1], buckets)
            packed = inside.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
            mine = marks[group // buckets] > 0
            zero = pa.array(np.zeros(len(ends), np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number.astype(np.int32)), pa.array(np.ones(len(ends), np.int32)), zero,
                    pa.array(text_keys[of_piece]), pa.array(np.bincount(text)[of_piece]),
                    pa.array(marks[of_piece].astype(np.int64)), zero,
                    _binary(np.ascontiguousarray(packed), ends * KEY_BYTES),
                    _binary(n.astype(np.uint8), ends),
                    _binary(own[mine], np.cumsum(mine)[ends - 1] * 8),
                ],
                names=["bucket", "part", "k", "a", "b", "c", "d", "keys", "n", "own"],
            )

    return pieces


def _search_task(totals: tuple[int, int], size: int):
    """Buckets as a stream, the table's entries before the texts': sums for each text."""

    def sums_of(table: list[np.ndarray], rows) -> tuple:
        (raw, _), (n, lengths), (counts, _) = (_data(rows.column(k)) for k in (7, 8, 9))
        keys = np.zeros((len(n), 8), np.uint8)
        keys[:, :KEY_BYTES] = raw.reshape(-1, KEY_BYTES)
        keys = keys.reshape(-1).view("<u8").astype(np.int64)
        n = n.astype(np.float64)
        text = np.repeat(np.arange(len(lengths)), lengths)
        tokens = rows.column(4).to_numpy(zero_copy_only=False)
        marks = rows.column(5).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(table[0], keys), max(len(table[0]) - 1, 0))
        found = np.flatnonzero(table[0][at] == keys) if len(table[0]) else np.empty(0, np.int64)
        at, n, text = at[found], n[found], text[found]
        own = np.zeros((len(keys), 2))
        marked = np.repeat(marks > 0, lengths)
        own[marked] = np.frombuffer(counts.tobytes(), "<u4").reshape(-1, 2)
        own = own[found]
        alone = table[3][at] < 0
        known = np.bincount(text, n * alone, len(lengths))
        sums = []
        for mark, entry, last, total in ((IN_TARGET, 1, 3, totals[0]), (IN_BACKGROUND, 2, 4, totals[1])):
            mine = (marks[text] & mark) > 0
            of_entry = table[entry][at] - own[:, 0] * mine
            of_word = np.where(alone, of_entry, table[last][at] - own[:, 1] * mine)
            smooth = WEIGHT * (of_word + 1) / (total - tokens[text] * mine + size)
            value = np.log(of_entry + np.where(alone, WEIGHT, smooth)) - np.log(smooth)
            sums.append(np.bincount(text, n * np.where(alone, value, -value), len(lengths)).astype(np.float64))
        return rows.column(3), known.astype(np.int64), *sums

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bucket, parts, table = None, [], None
        for batch in batches:
            number = batch.column(0).to_numpy(zero_copy_only=False)
            part = batch.column(1).to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(number) != 0) | (np.diff(part) != 0)) + 1
            cuts = [0, *change.tolist(), len(number)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if low == high:
                    continue
                rows = batch.slice(low, high - low)
                if number[low] != bucket:
                    bucket, parts, table = number[low], [], None
                if part[low] == 0:
                    parts.append([rows.column(k).to_numpy(zero_copy_only=False) for k in range(2, 7)])
                    continue
                if table is None:
                    none = [np.empty(0, np.int64)] * 5
                    table = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else none
                    parts = []
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x) for x in sums_of(table, rows)],
                    names=["key", "known", "target", "background"],
                )

    return search


def marked(docs: DataFrame, in_target: Column) -> DataFrame:
    """`key, text, marks` per row of `docs`: the target, and a background of the same size."""
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), whole_text())
    rows = docs.select(
        key.alias("key"), whole_text().alias("text"), F.coalesce(in_target, F.lit(False)).alias("target")
    )
    size = F.octet_length("text") + 1
    target, whole = rows.agg(F.sum(F.when(F.col("target"), size)), F.sum(size)).first()
    share = (target or 0) / whole if whole else 0.0
    drawn = F.pmod(F.xxhash64("key"), F.lit(DRAWS)) < int(share * DRAWS)
    marks = F.when(F.col("target"), IN_TARGET).otherwise(0) + F.when(drawn, IN_BACKGROUND).otherwise(0)
    return rows.select("key", "text", marks.alias("marks"))


def score(
    docs: DataFrame,
    in_target: Column,
    documents: int = DOCUMENTS,
    occurrences: int = OCCURRENCES,
    sent_words: int = SENT,
) -> DataFrame:
    """`docs` with `n_tokens, target_loss, background_loss, score`.

    `in_target` tells the documents that the target model learns from.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = marked(docs, in_target)
    learnt = rows.filter("marks > 0")
    words = learnt.mapInArrow(_word_counts_task(), "w long, t long, b long, d long")
    words = stage(
        words.groupBy("w").agg(*(F.sum(c).alias(c) for c in "tbd")), "lm-words", release=True
    )
    known = F.col("w") == BORDER
    vocabulary = stage(
        words.filter(known | (F.col("d") >= documents)).select("w", "t", "b"), "lm-vocabulary"
    )
    totals = [n or 0 for n in words.agg(F.sum("t"), F.sum("b")).first()]
    n_words, *inside = vocabulary.agg(F.count(F.lit(1)), F.sum("t"), F.sum("b")).first()
    # Of all words and the unknown one; the unknown has what the others leave.
    size, unknown = n_words + 1, [t - (i or 0) for t, i in zip(totals, inside, strict=True)]
    sent = None
    if n_words <= sent_words:
        ids = [row[0] for row in vocabulary.select("w").collect()]
        # The border comes without any text that was learnt as well.
        ids = np.unique(np.array([BORDER, *ids], np.int64).view(np.uint64))
        sent = spark.sparkContext.broadcast(ids)
    bigrams = learnt.mapInArrow(_bigram_counts_task(sent), "u long, w long, t long, b long")
    bigrams = bigrams.groupBy("u", "w").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
    bigrams = bigrams.filter(F.col("t") + F.col("b") >= occurrences)
    of_word = vocabulary.select("w", F.col("t").alias("w_t"), F.col("b").alias("w_b"))
    pairs = bigrams.join(of_word, "w")
    if sent is None:
        pairs = pairs.join(vocabulary.select(F.col("w").alias("u")), "u", "left_semi")
    alone = vocabulary.select(
        F.lit(None).cast("long").alias("u"), "w", "t", "b",
        F.lit(-1).cast("long").alias("w_t"), F.lit(-1).cast("long").alias("w_b"),
    )
    model = stage(
        pairs.select("u", "w", "t", "b", "w_t", "w_b").unionByName(alone), "lm-entries", release=True
    )
    buckets = max(LEAST_BUCKETS, -(-model.count() // ENTRIES_PER_BUCKET))
    entries = model.mapInArrow(_entries_task(buckets), ENTRIES).select(
        "*", *(F.lit(None).cast("binary").alias(c) for c in ("keys", "n", "own"))
    )
    pieces = rows.mapInArrow(_pieces_task(buckets, sent), PACKED)
    dealt = entries.unionByName(pieces).repartitionById(buckets, F.col("bucket"))
    found = dealt.sortWithinPartitions("bucket", "part", "k").mapInArrow(
        _search_task(tuple(totals), size), "key long, known long, target double, background double"
    )
    # Rows that repeat an id and a text add up under one key, and are taken apart by their number.
    sums = found.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("known", "target", "background")))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in RESULTS]
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), whole_text())
    tokens = F.regexp_count(whole_text(), F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 1
    scored = docs.select(*others, key.alias(KEY), tokens.alias("n_tokens"))
    copies = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.first("marks").alias("marks"))
    sums = copies.join(sums, "key").select(F.col("key").alias(KEY), "copies", "marks", "known", "target", "background")

    def loss(model: str, mark: int, total: int, of_unknown: int) -> Column:
        n = F.col("n_tokens") - F.col("known") / F.col("copies")
        mine = F.when(F.col("marks").bitwiseAND(F.lit(mark)) > 0, 1).otherwise(0)
        count = F.lit(of_unknown) - n * mine
        smooth = WEIGHT * (count + 1) / (F.lit(total) - F.col("n_tokens") * mine + size)
        unknown_loss = F.when(n > 0, n * (F.log(count + WEIGHT) - F.log(smooth))).otherwise(0.0)
        return (F.col(model) / F.col("copies") + unknown_loss) / F.col("n_tokens")

    return (
        scored.join(sums, KEY)
        .withColumn("target_loss", loss("target", IN_TARGET, totals[0], unknown[0]))
        .withColumn("background_loss", loss("background", IN_BACKGROUND, totals[1], unknown[1]))
        .drop(KEY, "copies", "marks", "known", "target", "background")
        .withColumn("score", F.col("target_loss") - F.col("background_loss"))
    )
