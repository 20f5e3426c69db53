"""MinHash near-duplicates by a multi-index Hamming join.

A document's set is its distinct shingles of five words. Its signature has `SLOTS` slots of `b` bits,
each the low bits of the least of one hash over the set; two documents differ in a slot with
probability `(1 - J) * (1 - 2**-b)`. The signature distance is the number of slots that differ.

Signatures are split into `CHUNKS` chunks. By the pigeonhole, two signatures at a distance of at
most `CHUNKS * (ERRORS + 1) - 1` agree in some chunk up to `ERRORS` slots. Each way to leave out
`ERRORS` slots of a chunk is one key, so documents that share no key are further apart than that, and
every pair within it shares a key: none is lost. With the defaults (16 chunks of 6 slots, one
error, distance 31 of 96) a pair of similarity 0.75 shares no key with a probability of 5e-6.

1. Documents of equal word sequences are one class, which goes by a hash of their digest.
2. Classes that share a key are linked to the least class of that key as candidates, a star and
   not all pairs; of its stars a class tries the one with the smallest centre. Candidates are
   compared on their full sets and linked components are found.
3. Where a key still holds several components, its members are compared across components inside
   tasks, in blocks of `BLOCK` members, by a wide signature of `WIDE` slots of 8 bits and by the
   sizes of their sets. First each block by itself emits a spanning forest of the near ones, the
   nearest first: fewer pairs than it has members. These are compared on their full sets, and once
   more with other blocks.
4. What then still is near across components, in any two blocks of a key, is compared inside tasks.
   Members with a near pair are found first; they meet again with their full sets, each pair under
   the first key that it shares, and a forest of the links is emitted. No pair that is not linked
   leaves a task, so the rows grow with the members and not with their pairs.
5. The components of all links are the result, each named by its smallest id.

Near is a wide distance of at most `FAR`, and of at most `BITS_FAR` in the low bits of the slots: a
pair of similarity 0.75 is beyond either with a probability of some 1e-6, one of similarity 0.5 within it with one below 1e-5, so what merely shares a passage
costs no comparison of texts. A group of near copies costs one candidate per member and key. No key,
bucket or list of partners is capped.

Nulls: a null or empty text has an empty set and is linked with nothing. A row without an id is
linked with nothing either and has a null component; it is kept. Rows that repeat an id are looked
at one by one, each by its own words, and `deduplicate` takes out rows by id and words. An empty table gives an empty result. Columns other than `doc_id` and `text`
are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import (
    ship_package,
    stage,
    text_chunks,
    whole_text,
    words_of,
)
from tideline.llm.components import connected_components, joined_components

SHINGLE = 5
PERCENT = 75
CHUNKS = 16
CHUNK_SLOTS = 6
ERRORS = 1
SLOTS = CHUNKS * CHUNK_SLOTS
WIDE = 384
FAR = 138
# A bit of each slot differs half as often. What is beyond this in bits is not looked at in full.
BITS_FAR = 81
BLOCK = 4096
CHUNK_BYTES = 4 << 20
# Shingles in a block of full sets.
SETS = 1 << 20
# Classes to be compared are sent to all tasks up to so many, 16 bytes each.
SENT = 500_000
# Rounds of forests, by the number that deals the members of a key to blocks.
FORESTS = (0, 1)
# Near pairs a task holds before it reduces them to a forest.
HELD = 1 << 20
# Shingles whose hashes are worked out side by side, so that they stay in the processor's cache.
AT_ONCE = 64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Odd numbers that set the words of a shingle apart by their place.
FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD],
    np.uint64,
)
# A number for each byte, and which bytes part words.
BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)
IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
BASE = 0xD1342543DE82EF95  # odd, so its powers can be undone


class _Powers:
    """Powers of `BASE` and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = np.uint64(len(self.up))
            up, down = (
                np.uint64(pow(base, int(size), 1 << 64)) for base in (BASE, pow(BASE, -1, 1 << 64))
            )
            self.up = np.concatenate([self.up, self.up * up])
            self.down = np.concatenate([self.down, self.down * down])
        return self.up[:n], self.down[:n]


_powers = _Powers()


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word: the difference of two sums over the text, brought to its start."""
    data = np.frombuffer(text, np.uint8)
    space = IS_SPACE[data]
    edges = np.flatnonzero(np.diff(np.r_[True, space, True]))
    first, end = edges[::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTES[data] * up[:-1], out=sums[1:])
    return _mixed((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64))


def lowered(text: str | None) -> bytes:
    """A text with A-Z in lower case, in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def shingle_hashes(text: bytes) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles; fewer words than a shingle are one shingle."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    width = min(SHINGLE, len(hashes))
    n = len(hashes) - width + 1
    total = hashes[:n] * FACTORS[0] + np.uint64(width)
    for k in range(1, width):
        total += hashes[k : k + n] * FACTORS[k]
    return np.unique(_mixed(total))


def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Factors and offsets of the hash functions on 32 bits."""
    numbers = np.random.default_rng(20240501).integers(0, 1 << 32, (2, WIDE), dtype=np.uint32)
    return numbers[0] | np.uint32(1), numbers[1]


def signature(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, bytes]:
    """The slots of a set: `SLOTS` of 16 bits for the keys, `WIDE` of 8 bits for the distance."""
    factors, offsets = functions
    low = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), AT_ONCE):
        some = low[k : k + AT_ONCE] * factors
        some += offsets
        np.minimum(least, some.min(axis=0), out=least)
    # A function is one to one, so its least value tells the shingle; its bits are scrambled.
    bits = _mixed(least.astype(np.uint64))
    return (
        (bits[:SLOTS] & np.uint64(0xFFFF)).astype("<u2").tobytes(),
        (bits >> np.uint64(32)).astype(np.uint8).tobytes(),
    )


def _sketch_task():
    def sketch(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        functions = _functions()
        for chunk in text_chunks(batches, CHUNK_BYTES):
            texts = chunk.column(chunk.schema.get_field_index("text")).to_pylist()
            sizes, digests, signatures, wides = [], [], [], []
            for text in texts:
                lower = lowered(text)
                shingles = shingle_hashes(lower)
                sizes.append(len(shingles))
                digests.append(hashlib.sha256(b" ".join(lower.split())).digest())
                narrow, wide = signature(shingles, functions) if len(shingles) else (None, None)
                signatures.append(narrow)
                wides.append(wide)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column(chunk.schema.get_field_index("doc_id")),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    pa.array(wides, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest", "signature", "wide"],
            )

    return sketch


def sketches(docs: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, digest, signature, wide` per row; the digest is of the word sequence."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        _sketch_task(), "doc_id long, n_shingles long, digest binary, signature binary, wide binary"
    )


def _key_columns() -> list[tuple[int, list[int]]]:
    """For each key, its number and the slots it holds."""
    chosen = []
    for chunk in range(CHUNKS):
        slots = range(chunk * CHUNK_SLOTS, (chunk + 1) * CHUNK_SLOTS)
        for kept in combinations(slots, CHUNK_SLOTS - ERRORS):
            chosen.append((len(chosen), list(kept)))
    return chosen


def _keys_of(signatures: list[bytes], columns: list[tuple[int, list[int]]]) -> np.ndarray:
    """The keys of each signature, in the order of `columns`."""
    slots = np.frombuffer(b"".join(signatures), dtype="<u2")
    slots = slots.reshape(len(signatures), SLOTS).astype(np.uint64)
    out = np.empty((len(slots), len(columns)), dtype=np.uint64)
    for number, kept in columns:
        total = np.full(len(slots), number + 1, dtype=np.uint64)
        for slot in kept:
            total = _mixed(total + slots[:, slot])
        out[:, number] = total
    return out


def _keys_task():
    def keys(batches: Iterator) -> Iterator:
        import pyarrow as pa

        columns = _key_columns()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            out = _keys_of(batch.column(1).to_pylist(), columns)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(ids, len(columns)), pa.int64()),
                    pa.array(out.reshape(-1).view(np.int64)),
                ],
                names=["id", "key"],
            )

    return keys


def _size_fits(n: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can be similar enough at all."""
    return 100 * np.minimum(n, other) >= PERCENT * np.maximum(n, other)


def _distances(some: np.ndarray, one: np.ndarray) -> np.ndarray:
    """In how many bytes rows of 64-bit words differ from one row."""
    differs = (some.view(np.uint8) != one.view(np.uint8)).view(np.uint64)
    return np.bitwise_count(differs).sum(axis=1, dtype=np.int64)


def _bits(wide: np.ndarray) -> np.ndarray:
    """One bit of each slot, in 64-bit words."""
    low = wide.view(np.uint8).reshape(len(wide), WIDE) & 1
    return np.packbits(low, axis=1).view(np.uint64).reshape(len(wide), WIDE // 64)


def _near_rows(of: np.ndarray, n: np.ndarray, wide: np.ndarray, half: np.ndarray) -> Iterator:
    """For members of a block, or of two, the places of those near them in other components.

    Each pair comes once: a place, an array of places, and an array of distances. Members come by
    size, so that the sets that one can be similar to are a stretch of the others. `half` is 0 and 1
    for members of two blocks, which are compared with each other, 2 for one block.
    """
    same_block = half[0] == 2
    low, high = (np.flatnonzero((half == k) | same_block) for k in (0, 1))
    b, of_b = wide[high], of[high]
    bits = _bits(wide)
    bits_b = np.ascontiguousarray(bits[high].T)
    firsts = np.searchsorted(100 * n[high], PERCENT * n[low])
    ends = np.searchsorted(PERCENT * n[high], 100 * n[low], side="right").tolist()
    for place, row in enumerate(low.tolist()):
        # A block by itself has each pair once if only what comes later is looked at.
        first, end = (place + 1 if same_block else int(firsts[place])), ends[place]
        if first >= end:
            continue
        differ = np.bitwise_count(bits_b[:, first:end] ^ bits[row][:, None])
        likely = (differ.sum(axis=0, dtype=np.uint16) <= BITS_FAR) & (of_b[first:end] != of[row])
        other = first + np.flatnonzero(likely)
        if not len(other):
            continue
        distance = _distances(b[other], wide[row])
        inside = distance <= FAR
        if inside.any():
            yield row, high[other[inside]], distance[inside]


def _pairs_across(
    ids: np.ndarray, of: np.ndarray, n: np.ndarray, wide: np.ndarray, half: np.ndarray, forest: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of different components among the members of a block, or of two, or a forest."""
    none = np.empty(0, np.int64)
    found_a, found_b, far, held = [none], [none], [none], 0
    for row, other, distance in _near_rows(of, n, wide, half):
        found_a.append(np.full(len(other), row))
        found_b.append(other)
        far.append(distance)
        held += len(other)
        if forest and held > HELD:
            # A forest of these and what follows is one of this forest and what follows.
            at_a, at_b, apart = _forest_of(found_a, found_b, far, of, ids)
            found_a, found_b, far, held = [at_a], [at_b], [apart], len(at_a)
    if forest and held:
        at_a, at_b, _ = _forest_of(found_a, found_b, far, of, ids)
    else:
        at_a, at_b = np.concatenate(found_a), np.concatenate(found_b)
    x, y = ids[at_a], ids[at_b]
    return np.minimum(x, y), np.maximum(x, y)


def _forest_of(found_a, found_b, far, of, ids) -> tuple[np.ndarray, ...]:
    at_a, at_b, apart = (np.concatenate(x) for x in (found_a, found_b, far))
    order = np.lexsort((ids[at_b], ids[at_a], apart))
    chosen = _forest(of[at_a], of[at_b], order)
    return at_a[chosen], at_b[chosen], apart[chosen]


def _of_this_key(key: int, keys: np.ndarray, row: int, other: np.ndarray) -> np.ndarray:
    """Of members that share `key` with one, those with which it shares no earlier key."""
    first = (keys[other] == keys[row]).argmax(axis=1)
    return other[keys[row, first].view(np.int64) == key]


def _ends_across(rows, keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """`key, id` of the members of a block, or of two, that have a near pair of this key."""
    key, half, ids, of, n = (rows.column(k).to_numpy(zero_copy_only=False) for k in (0, 3, 4, 5, 6))
    ends = np.zeros(len(ids), dtype=bool)
    for row, other, _ in _near_rows(of, n, _wides(rows), half):
        other = _of_this_key(key[0], keys, row, other)
        ends[other] = True
        ends[row] |= len(other) > 0
    return key[ends], ids[ends]


def _links_across(rows, keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links of this key across components, found on the full sets: a forest of them."""
    key, half, ids, of, n = (rows.column(k).to_numpy(zero_copy_only=False) for k in (0, 3, 4, 5, 6))
    sets = [np.frombuffer(one, np.uint64) for one in rows.column(9).to_pylist()]
    component, found = np.unique(of, return_inverse=True)[1], []
    for row, other, _ in _near_rows(of, n, _wides(rows), half):
        other = _of_this_key(key[0], keys, row, other[component[other] != component[row]])
        if not len(other):
            continue
        hashes, own = np.concatenate([sets[k] for k in other]), sets[row]
        same = own[np.minimum(np.searchsorted(own, hashes), len(own) - 1)] == hashes
        starts = np.cumsum(n[other]) - n[other]
        common = np.add.reduceat(same.astype(np.int64), starts)
        linked = 100 * common >= PERCENT * (n[row] + n[other] - common)
        for k in other[linked].tolist():
            if component[k] != component[row]:
                found.append((row, k))
                component[component == component[k]] = component[row]
    at_a, at_b = np.array(found, np.int64).reshape(-1, 2).T
    return np.minimum(ids[at_a], ids[at_b]), np.maximum(ids[at_a], ids[at_b])


def _wides(rows) -> np.ndarray:
    wide = np.frombuffer(b"".join(rows.column(7).to_pylist()), np.uint64)
    return wide.reshape(rows.num_rows, WIDE // 8)


def _near_across(forest: bool):
    def pairs(rows, keys: None) -> tuple[np.ndarray, ...]:
        half, ids, of, n = (rows.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5, 6))
        return _pairs_across(ids, of, n, _wides(rows), half, forest)

    return pairs


def _across_task(of_group: Callable, names: list[str]):
    """Blocks of keys as a stream, each with its members by size: what `of_group` finds in each."""

    def across(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def found_in(rows):
            """What is found in these rows, which hold whole groups."""
            key, low, high = (rows.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            change = (np.diff(key) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(key)]
            # Worked out for all rows at once: groups are many and small.
            signed = "signature" in rows.schema.names
            keys = _keys_of(rows.column(8).to_pylist(), _key_columns()) if signed else None
            found = [
                of_group(rows.slice(i, j - i), keys[i:j] if signed else None)
                for i, j in zip(cuts[:-1], cuts[1:], strict=True)
                if j - i > 1
            ]
            none = [np.empty(0, np.int64)]
            a, b = (np.concatenate(none + [pair[k] for pair in found]) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=names)

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch
            if held is not None:
                rows = pa.concat_batches([held, batch])
            # The last group may go on in the next batch.
            same = np.ones(rows.num_rows, dtype=bool)
            for k in range(3):
                column = rows.column(k).to_numpy(zero_copy_only=False)
                same &= column == column[-1]
            last = rows.num_rows - int(same.sum())
            if last:
                yield found_in(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None:
            yield found_in(held)

    return across


def _forest(of_a: np.ndarray, of_b: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of edges between components, taken in an order, those that join what was apart."""
    nodes, ends = np.unique(np.concatenate([of_a, of_b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    starts, stops = ends[: len(of_a)].tolist(), ends[len(of_a) :].tolist()
    chosen, apart = [], len(nodes) - 1
    for edge in order.tolist():
        x, y = root(starts[edge]), root(stops[edge])
        if x != y:
            parent[x] = y
            chosen.append(edge)
            apart -= 1
            if not apart:
                break
    return np.array(chosen, dtype=np.int64)


def words_digest(text: Column) -> Column:
    """The digest of `sketches`, of a text's lower-cased words."""
    words = words_of(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.unhex(F.sha2(F.array_join(words, " "), 256))


def class_number(digest: Column) -> Column:
    """The number by which a class of equal words goes; its digest has 256 bits, this 64."""
    return F.xxhash64(digest)


def _confirm_task():
    """Of candidates with both texts, those whose full sets are similar enough."""

    def confirm(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last: tuple[object, np.ndarray] = (None, np.empty(0, np.uint64))
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for k in range(len(a)):
                if last[0] != b[k]:
                    last = b[k], shingle_hashes(lowered(batch.column(3)[k].as_py()))
                own = shingle_hashes(lowered(batch.column(2)[k].as_py()))
                common = len(np.intersect1d(own, last[1], assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(own) + len(last[1]) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]
            ).filter(pa.array(keep, pa.bool_()))

    return confirm


def _texts(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """`id, text` of classes, each read from a document with its smallest id and its words."""
    needed = stage(classes.select("id", "least").join(ids.distinct(), "id"), "minhash-needed")
    if needed.count() <= SENT:
        needed = F.broadcast(needed)
    rows = docs.select(F.col("doc_id").cast("long").alias("least"), whole_text().alias("text"))
    return (
        rows.join(needed, "least")
        # Written so that it is worked out for the few rows that the join finds, not as a key of it.
        .filter(class_number(words_digest(F.col("text"))).bitwiseXOR(F.col("id")) == 0)
        .groupBy("id")
        .agg(F.first("text").alias("text"))
    )


def _sets_task():
    """Shingle hashes of texts, in order."""

    def sets(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for chunk in text_chunks(batches, CHUNK_BYTES):
            found = [shingle_hashes(lowered(text)).tobytes() for text in chunk.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array(found, pa.binary())], names=["id", "shingles"]
            )

    return sets


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links among candidate `pairs` of (a, b), which are numbers of classes."""
    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    texts = stage(_texts(needed, classes, docs), "minhash-texts")
    with_a = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    links = both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm_task(), "a long, b long")
    return stage(links, "minhash-links")


def _near_by_signature(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The `pairs` of (a, b) whose wide signatures and sizes allow a link."""

    def of(end: str) -> DataFrame:
        return signatures.select(
            F.col("id").alias(end), F.col("wide").alias(f"wide_{end}"), F.col("n_shingles").alias(f"n_{end}")
        )

    def near(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(-1, WIDE // 8)
                for k in (2, 4)
            )
            n_a, n_b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            keep = (_distances(a, b) <= FAR) & _size_fits(n_a, n_b)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return both.select("a", "b", "wide_a", "n_a", "wide_b", "n_b").mapInArrow(near, "a long, b long")


def _dealt(
    members: DataFrame, signatures: DataFrame, components: DataFrame, block: int, forest: int | None
) -> DataFrame:
    """Members of keys that hold several components, in blocks of `block` each or so.

    A key of `n` members is cut into `n / block` blocks by a hash of the id, and every two of them
    meet in a task of their own, so no task holds more than two blocks' worth. With `forest`, a
    number that changes the hash, blocks are by themselves.
    """
    placed = stage(
        members.join(components, "id", "left").select(
            "key", "id", "n", F.coalesce("component", "id").alias("component")
        ),
        "minhash-placed",
    )
    mixed = placed.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    ).filter("least <> most").select("key")
    blocks = F.ceil(F.col("n") / block)
    own = F.pmod(F.xxhash64("id", F.lit(forest or 0)), F.col("blocks"))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    if forest is not None:
        others = F.array("own")
    parts = (
        placed.join(mixed, "key", "left_semi")
        .join(signatures, "id")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(others))
        .select(
            "key",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0)
            .otherwise(1).alias("half"),
            "id",
            "component",
            "n_shingles",
            *(c for c in ("wide", "signature", "shingles") if c in signatures.columns),
        )
    )
    group = ["key", "low", "high"]
    return parts.repartition(*group).sortWithinPartitions(*group, "n_shingles", "id")


def _across(
    members: DataFrame,
    signatures: DataFrame,
    components: DataFrame,
    block: int = BLOCK,
    forest: int | None = None,
) -> DataFrame:
    """Near pairs (a, b) across components; with `forest`, a forest of them inside each block."""
    together = _dealt(members, signatures, components, block, forest)
    return together.mapInArrow(
        _across_task(_near_across(forest is not None), ["a", "b"]), "a long, b long"
    )


def _linked_across(
    members: DataFrame,
    classes: DataFrame,
    components: DataFrame,
    docs: DataFrame,
    block: int = BLOCK,
    sets: int = SETS,
) -> DataFrame:
    """All that links components: of each key a forest of the links across them, (a, b).

    What has a near pair is found first, row by row and not pair by pair; it meets again with its
    full sets, in blocks of `sets` shingles. A pair is looked at under the first key that it shares.
    """
    signatures = classes.select("id", "n_shingles", "wide", "signature")
    ends = _dealt(members, signatures, components, block, None).mapInArrow(
        _across_task(_ends_across, ["key", "id"]), "key long, id long"
    )
    ends = stage(ends.distinct(), "minhash-ends")
    texts = _texts(ends.select("id"), classes, docs).select("id", "text")
    shingles = stage(texts.mapInArrow(_sets_task(), "id long, shingles binary"), "minhash-sets")
    sizes = ends.join(classes.select("id", "n_shingles"), "id").groupBy("key")
    weighed = ends.join(sizes.agg(F.sum("n_shingles").alias("n")), "key")
    links = _dealt(weighed, signatures.join(shingles, "id"), components, sets, None).mapInArrow(
        _across_task(_links_across, ["a", "b"]), "a long, b long"
    )
    return stage(links, "minhash-links")


def near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept, digest` per row of `docs`.

    `digest` is that of the document's words.
    """
    sketched = stage(sketches(docs), "minhash-sketches")
    classes = stage(
        sketched.filter("doc_id is not null and signature is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("least"),
            *(F.first(c).alias(c) for c in ("signature", "wide", "n_shingles")),
        )
        .withColumn("id", class_number(F.col("digest"))),
        "minhash-classes",
    )
    signatures = classes.select("id", "wide", "n_shingles")
    keys = classes.select("id", "signature").mapInArrow(_keys_task(), "id long, key long")
    shared = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("hub")
    ).filter("n > 1")
    members = stage(keys.join(shared, "key").select("key", "id", "hub", "n"), "minhash-members")
    first = members.filter("id <> hub").groupBy(F.col("id").alias("b")).agg(F.min("hub").alias("a"))
    first = stage(_near_by_signature(first.select("a", "b"), signatures), "minhash-pairs")
    components = connected_components(_confirmed(first, classes, docs))
    for forest in FORESTS:
        near = _across(members, signatures, components, block, forest).distinct()
        near = stage(near, "minhash-pairs")
        components = joined_components(components, _confirmed(near, classes, docs))
    links = _linked_across(members, classes, components, docs, block)
    components = joined_components(components, links)
    placed = stage(
        classes.join(components, "id", "left").select(
            "digest", "least", F.coalesce("component", "id").alias("component")
        ),
        "minhash-named",
    )
    least = placed.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("smallest"))
    named = placed.join(least, F.col("component") == F.col("of")).select(
        "digest", F.col("smallest").alias("component")
    )
    own = F.col("doc_id").isNotNull() & F.col("signature").isNotNull()
    component = F.when(own, F.col("component")).otherwise(F.col("doc_id"))
    return (
        sketched.join(named, "digest", "left")
        .withColumn("component_id", component)
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            (F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
            "digest",
        )
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay: one document of each group, and rows without an id.

    A row goes if its id and words are those of a document that is not kept. Of rows alike in both,
    and of different texts under the id of a group's smallest document, all stay.
    """
    # Names that no column of documents has.
    gone = near_duplicates(docs).filter("not kept").select(
        F.col("doc_id").alias("id of a copy"), F.col("digest").alias("words of a copy")
    )
    same = (F.col("doc_id").cast("long") == F.col("id of a copy")) & (
        words_digest(whole_text()) == F.col("words of a copy")
    )
    return docs.join(gone.distinct(), same, "left_anti")
