"""Removal of repeated word windows by super-k-mer partitioning.

A window is `WINDOW` consecutive words of one text. Its minimiser is the smallest hash of the
`GRAM`-word grams inside it, the leftmost one on ties. Consecutive windows whose minimiser is at the
same place form a super-k-mer: at most `WINDOW - GRAM + 1` windows in one packed string. Equal
windows have equal minimisers, at the same place in the window, so they meet in the bucket of that
minimiser, and windows of one string always differ.

1. Minimisers are counted, as numbers. A bucket with one super-k-mer has no repeated window.
2. The super-k-mers of all other buckets are packed. Up to `SENT` of these minimisers are sent to
   all tasks, which then drop the other strings on the spot; more are joined with the places.
3. Each task combines equal strings: the one that starts first travels to its bucket, all windows of
   the others start earlier somewhere. So a passage that very many documents hold comes to its
   bucket once from each task (and each `HELD` bytes of strings).
4. Buckets are sorted and go through their tasks as a stream. Of equal strings again the first stays.
   The windows of a bucket's distinct strings are counted in memory, where each learns the first
   place it starts at. A bucket of more than `BUCKET` distinct strings is passed on instead, and its
   windows are grouped by bucket and window, which spreads them.
5. The words that repeated windows cover are removed from the texts.

Places are in order of id and start; windows are judged on the input. Nulls: a null text has no
words; rows without an id come last. Rows that repeat an id and a text are one document and get
equal results, rows that repeat an id only are ordered by a hash of the text. Texts shorter than a
window lose nothing. An empty table gives an empty result. Columns other than `doc_id` and `text`
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import ship_package, stage, text_chunks, whole_text

WINDOW = 20
GRAM = 4
CHUNK_BYTES = 4 << 20
REMEMBERED = 300_000
SENT = 1_500_000
HELD = 32 << 20
BUCKET = 20_000
NO_ID = (1 << 63) - 1

# A row is known by its id and a number for its text.
ROW = ["doc", "copy"]
PLACE = "doc long, copy long, start int, windows int"
# Odd numbers that set the words of a gram apart by their place.
FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64
)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_known = _WordHashes()


def words_of(text: str) -> list[bytes]:
    """The words in UTF-8. `bytes.split` parts at the same six characters."""
    return text.encode("utf-8", "surrogatepass").split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def super_kmers(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of each super-k-mer."""
    n = len(words) - WINDOW + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    if len(_known) > REMEMBERED:
        _known.clear()
    hashes = np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    size = len(words) - GRAM + 1
    grams = hashes[:size] * FACTORS[0]
    for k in range(1, GRAM):
        grams += hashes[k : k + size] * FACTORS[k]
    grams = _mixed(grams)
    # The upper half of a hash, and its place to tell ties apart: the least of these is leftmost.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(size, dtype=np.uint64)
    reach = WINDOW - GRAM + 1
    width = 1
    while width < reach:
        step = min(width, reach - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    place = (least & np.uint64(0xFFFFFFFF)).view(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return grams[place[first]].view(np.int64), first, np.diff(np.r_[first, n])


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(whole_text()).alias("copy"),
        "doc_id",
        whole_text().alias("text"),
    )


def _counts_task():
    def counts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for chunk in text_chunks(batches, CHUNK_BYTES):
            texts = chunk.column(chunk.schema.get_field_index("text")).to_pylist()
            found = np.concatenate([super_kmers(words_of(text))[0] for text in texts])
            minimisers, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(minimisers), pa.array(n)], names=["minimiser", "n"])

    return counts


def _places_task(with_strings: bool):
    """The super-k-mers of each row, with their packed strings or without."""

    def places(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for chunk in text_chunks(batches, CHUNK_BYTES):
            doc, copy, text = (chunk.column(chunk.schema.get_field_index(c)) for c in (*ROW, "text"))
            found, strings = [], []
            for own in text.to_pylist():
                words = words_of(own)
                found.append(super_kmers(words))
                if with_strings:
                    _, first, n = found[-1]
                    ends = first + n + WINDOW - 1
                    strings += [
                        b" ".join(words[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)
                    ]
            sizes = [len(f[0]) for f in found]
            minimisers, starts, windows = (np.concatenate([f[k] for f in found]) for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(doc.to_numpy(zero_copy_only=False), sizes), pa.int64()),
                    pa.array(np.repeat(copy.to_numpy(zero_copy_only=False), sizes), pa.int64()),
                    pa.array(starts.astype(np.int32), pa.int32()),
                    pa.array(windows.astype(np.int32), pa.int32()),
                    pa.array(minimisers, pa.int64()),
                    *([pa.array(strings, pa.binary())] if with_strings else []),
                ],
                names=[*ROW, "start", "windows", "minimiser", *(["packed"] if with_strings else [])],
            )

    return places


def _packed_task():
    """The packed strings at given places of each row."""

    def packed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for chunk in text_chunks(batches, CHUNK_BYTES):
            columns = [
                chunk.column(chunk.schema.get_field_index(c)).to_pylist() for c in (*ROW, "text", "at")
            ]
            out: list[list] = [[], [], [], [], [], []]
            for doc, copy, text, at in zip(*columns, strict=True):
                words = words_of(text)
                for place in at:
                    first, n = place["start"], place["windows"]
                    string = b" ".join(words[first : first + n + WINDOW - 1])
                    row = (doc, copy, first, n, place["minimiser"], string)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=[*ROW, "start", "windows", "minimiser", "packed"],
            )

    return packed


def _record_batch(rows: list[tuple]):
    """Rows of (doc, copy, start, windows, minimiser, packed); later ones have no string."""
    import pyarrow as pa

    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=[*ROW, "start", "windows", "minimiser", "packed"],
    )


def _combine_task():
    """Of equal strings in a task the first place, with the string; the others without."""

    def combine(batches: Iterator) -> Iterator:
        held: dict[tuple[int, bytes], tuple] = {}
        size = 0
        for batch in batches:
            later = []
            for doc, copy, start, windows, minimiser, packed in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                place = doc, copy, start, windows
                key = minimiser, packed
                first = held.setdefault(key, place)
                if first is place:
                    size += len(packed)
                    continue
                if place[:3] < first[:3]:
                    held[key], place = place, first
                if place[:3] != held[key][:3]:
                    later.append((*place, minimiser, None))
            yield _record_batch(later)
            if size > HELD:
                yield _record_batch([(*place, *key) for key, place in held.items()])
                held, size = {}, 0
        yield _record_batch([(*place, *key) for key, place in held.items()])

    return combine


def _bucket_task():
    """Buckets in a row, sorted by string and place: repeated places, or strings of too large ones."""

    def first_windows(strings: list[tuple]) -> list[tuple]:
        """Places, as one window each, of the distinct strings of a bucket that are not the first."""
        began: dict[bytes, tuple] = {}
        own = []
        for doc, copy, start, windows, _, packed in strings:
            words = packed.split(b" ")
            for at in range(windows):
                window = b" ".join(words[at : at + WINDOW])
                place = doc, copy, start + at
                own.append((window, place))
                if place < began.setdefault(window, place):
                    began[window] = place
        return [(*place, 1, None, None) for window, place in own if began[window] < place]

    def buckets(batches: Iterator) -> Iterator:
        bucket, strings, passed_on, out, last = None, [], False, [], None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row[4] != bucket:
                    out += strings if passed_on else first_windows(strings) if len(strings) > 1 else []
                    bucket, strings, passed_on, last = row[4], [], False, None
                if row[5] == last:
                    # Sorted by place, the first one has been here; the same row may be there twice.
                    if row[:3] != first:
                        out.append((*row[:4], None, None))
                    continue
                last, first = row[5], row[:3]
                strings.append(row)
                if len(strings) > BUCKET:
                    out += strings
                    strings, passed_on = [], True
            if out:
                yield _record_batch(out)
                out = []
        out += strings if passed_on else first_windows(strings) if len(strings) > 1 else []
        yield _record_batch(out)

    return buckets


def _kept_task():
    def kept(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        for chunk in text_chunks(batches, CHUNK_BYTES):
            ids = chunk.column(chunk.schema.get_field_index("doc_id"))
            texts = chunk.column(chunk.schema.get_field_index("text")).to_pylist()
            all_starts = chunk.column(chunk.schema.get_field_index("starts")).to_pylist()
            totals, gone, digests, left = [], [], [], []
            for text, starts in zip(texts, all_starts, strict=True):
                words = words_of(text)
                totals.append(len(words))
                if starts:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    at = np.array([s["start"] for s in starts])
                    np.add.at(change, at, 1)
                    np.add.at(change, at + [s["windows"] + WINDOW - 1 for s in starts], -1)
                    stays = np.cumsum(change[:-1]) == 0
                    words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                rest = b" ".join(words)
                gone.append(totals[-1] - len(words))
                digests.append(hashlib.sha256(rest).hexdigest())
                left.append(rest.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests), pa.array(left)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return kept


def _strings(rows: DataFrame, several: DataFrame) -> DataFrame:
    """The packed super-k-mers in the stored buckets `several`."""
    n = several.count()
    if n <= SENT:
        every = rows.select(*ROW, "text").mapInArrow(
            _places_task(True), f"{PLACE}, minimiser long, packed binary"
        )
        return every.join(F.broadcast(several), "minimiser", "left_semi").select(
            *ROW, "start", "windows", "minimiser", "packed"
        )
    places = rows.select(*ROW, "text").mapInArrow(_places_task(False), f"{PLACE}, minimiser long")
    wanted = (
        places.join(several, "minimiser", "left_semi")
        .distinct()
        .groupBy(*ROW)
        .agg(F.collect_list(F.struct("minimiser", "start", "windows")).alias("at"))
    )
    return (
        rows.join(wanted, ROW)
        .select(*ROW, "text", "at")
        .mapInArrow(_packed_task(), f"{PLACE}, minimiser long, packed binary")
    )


def _grouped_windows(strings: DataFrame) -> DataFrame:
    """Repeated places among distinct strings of large buckets, each window grouped by its words."""
    words = F.split(F.col("packed").cast("string"), " ")
    windows = strings.select(
        *ROW, "minimiser", "start", words.alias("words"),
        F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("at"),
    ).select(
        "minimiser",
        F.array_join(F.slice("words", F.col("at") + 1, F.lit(WINDOW)), " ").alias("window"),
        F.struct(*ROW, (F.col("start") + F.col("at")).alias("start")).alias("place"),
    )
    firsts = windows.groupBy("minimiser", "window").agg(F.min("place").alias("began"))
    later = windows.join(firsts, ["minimiser", "window"]).filter(F.col("began") < F.col("place"))
    return later.select("place.*", F.lit(1).alias("windows"))


def repeated_windows(rows: DataFrame) -> DataFrame:
    """`doc, copy, starts`: runs of windows (start, windows) of a row that also start earlier."""
    counted = rows.select("text").mapInArrow(_counts_task(), "minimiser long, n long")
    several = counted.groupBy("minimiser").agg(F.sum("n").alias("n")).filter("n > 1")
    several = stage(several.select("minimiser"), "superkmer-buckets")
    schema = f"{PLACE}, minimiser long, packed binary"
    combined = stage(_strings(rows, several).mapInArrow(_combine_task(), schema), "superkmer-strings")
    firsts = (
        combined.filter("packed is not null")
        .repartition("minimiser")
        .sortWithinPartitions("minimiser", "packed", *ROW, "start")
    )
    judged = stage(firsts.mapInArrow(_bucket_task(), schema), "superkmer-judged")
    columns = [*ROW, "start", "windows"]
    later = combined.filter("packed is null").select(*columns).unionByName(
        judged.filter("packed is null").select(*columns)
    )
    large = judged.filter("packed is not null")
    if not large.isEmpty():
        later = later.unionByName(_grouped_windows(large))
    return later.groupBy(*ROW).agg(F.collect_list(F.struct("start", "windows")).alias("starts"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """`doc_id, n_words, n_removed, kept_sha256, kept_text` for each row of `docs`."""
    ship_package(docs.sparkSession)
    rows = _rows(docs)
    starts = stage(repeated_windows(rows), "superkmer-starts")
    joined = rows.join(starts, ROW, "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "starts"
    )
    return joined.mapInArrow(
        _kept_task(),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string",
    )
