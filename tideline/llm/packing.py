"""Packing documents into windows by the sum-of-squares rule.

A document is its token ids and a closing id. Whole windows of a long document are cut off first.
What is left goes, as it arrives, to the fill level that makes the sum of squares of the counts of
partially filled windows smallest: `counts[h]` is how many open windows are filled to `h`, and
putting `s` tokens on level `h` changes the sum by `2 * (counts[h + s] - counts[h]) + 2`, on an
empty window by `2 * counts[s] + 1`, and by `1 - 2 * counts[h]` if it fills the window.

Every task packs the documents it reads, so nothing is shuffled and windows are numbered by task.
The open windows of a task are closed at its end, or when there are `max_open` of them: the emptiest
are cut up to fill the fullest, and the last one is parted into powers of two, which need no padding.

Nulls: a null text is the closing id alone, so is an empty one; ids of documents may be null or
repeat, rows are packed one by one. A text longer than a window is cut. An empty table gives an
empty result. The same files read in the same splits give the same windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tideline.llm.common import ship_package, text_chunks
from tideline.llm.tokens import word_encoder

WINDOW = 4096
CLOSING_ID = 2
MAX_OPEN = 2048
CHUNK_BYTES = 4 << 20
ID_BYTES = 4

Piece = tuple[object, int, bytes, int]  # doc_id, start, ids, tokens of its document


class Packer:
    """Open windows by fill level; `full` collects the windows that are done."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        # counts[window] stays 0: full windows are not counted.
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list[Piece]]] = {}
        self.n_open = 0
        self.full: list[list[Piece]] = []

    def level_for(self, size: int) -> int:
        """The fill level to put `size` tokens on; 0 is a new window, ties go to the fullest."""
        levels = np.flatnonzero(self.counts[1 : self.window + 1 - size]) + 1
        best, best_level = 2 * int(self.counts[size]) + 1, 0
        if len(levels):
            change = 2 * (self.counts[levels + size] - self.counts[levels]) + 2
            if levels[-1] + size == self.window:
                change[-1] -= 1
            at = len(levels) - 1 - int(np.argmin(change[::-1]))
            if change[at] <= best:
                best_level = int(levels[at])
        return best_level

    def add(self, doc_id: object, ids: bytes) -> None:
        tokens, step = len(ids) // ID_BYTES, self.window * ID_BYTES
        whole = tokens // self.window * step
        for first in range(0, whole, step):
            self.full.append([(doc_id, first // ID_BYTES, ids[first : first + step], tokens)])
        if whole < len(ids):
            self._place((doc_id, whole // ID_BYTES, ids[whole:], tokens))

    def _place(self, piece: Piece) -> None:
        size = len(piece[2]) // ID_BYTES
        level = self.level_for(size)
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
            pieces.append(piece)
        else:
            pieces = [piece]
        level += size
        if level == self.window:
            self.full.append(pieces)
            return
        self.open.setdefault(level, []).append(pieces)
        self.counts[level] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            self.close()

    def close(self) -> None:
        """Close all open windows without padding, cutting documents where it takes that."""
        stacks = [
            (level, pieces) for level in sorted(self.open) for pieces in self.open[level]
        ]
        self.open.clear()
        self.counts[:] = 0
        self.n_open = 0
        while len(stacks) > 1:
            level, pieces = stacks.pop()
            while level < self.window and stacks:
                less, donor = stacks[0]
                doc_id, start, ids, tokens = donor.pop()
                moved = min(len(ids) // ID_BYTES, self.window - level)
                cut = len(ids) - moved * ID_BYTES
                if cut:
                    donor.append((doc_id, start, ids[:cut], tokens))
                pieces.append((doc_id, start + cut // ID_BYTES, ids[cut:], tokens))
                level += moved
                stacks[0] = less - moved, donor
                if not donor:
                    stacks.pop(0)
            if level == self.window:
                self.full.append(pieces)
            else:
                stacks.append((level, pieces))
        for level, pieces in stacks:
            self._part(level, pieces)

    def _part(self, level: int, pieces: list[Piece]) -> None:
        """Part a window into powers of two, the largest first."""
        pieces = pieces[::-1]
        while level:
            room = 1 << (level.bit_length() - 1)
            level -= room
            taken = []
            while room:
                doc_id, start, ids, tokens = pieces.pop()
                moved = min(len(ids) // ID_BYTES, room)
                cut = moved * ID_BYTES
                taken.append((doc_id, start, ids[:cut], tokens))
                if cut < len(ids):
                    pieces.append((doc_id, start + moved, ids[cut:], tokens))
                room -= moved
            self.full.append(taken)


def _pack_task(tokenizer: str, window: int, closing_id: int, max_open: int):
    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = word_encoder(tokenizer)
        packer = Packer(window, max_open)
        end = np.array([closing_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 33

        def done(schema_id: pa.DataType) -> pa.RecordBatch:
            nonlocal number
            columns: list[list] = [[], [], [], [], [], [], []]
            for pieces in packer.full:
                offset = 0
                for doc_id, start, ids, tokens in pieces:
                    length = len(ids) // ID_BYTES
                    row = (doc_id, start, length, ids, tokens, number, offset)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += length
                number += 1
            packer.full.clear()
            long = pa.int64()
            kinds = [schema_id, long, long, pa.binary(), long, long, long]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        kind = None
        for chunk in text_chunks(batches, CHUNK_BYTES):
            kind = chunk.schema.field("doc_id").type
            texts = chunk.column(chunk.schema.get_field_index("text")).to_pylist()
            ids = chunk.column(chunk.schema.get_field_index("doc_id")).to_pylist()
            for doc_id, tokens in zip(ids, encoder.encode(texts), strict=True):
                packer.add(doc_id, tokens + end)
            yield done(kind)
        if kind is not None:
            packer.close()
            yield done(kind)

    return pack


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    closing_id: int = CLOSING_ID,
    max_open: int = MAX_OPEN,
) -> DataFrame:
    """Pieces of documents in windows.

    Columns: `doc_id`; `start` and `length` of the piece in its document's ids; `ids`, the piece's
    ids as little-endian unsigned 32-bit; `doc_tokens`, the document's ids with the closing one;
    `sequence_id`, the window; `offset`, the piece's place in it.
    """
    ship_package(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    long = T.LongType()
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("start", long),
            T.StructField("length", long),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", long),
            T.StructField("sequence_id", long),
            T.StructField("offset", long),
        ]
    )
    return rows.mapInArrow(_pack_task(tokenizer, window, closing_id, max_open), schema)
