"""Token ids of whole texts, as little-endian unsigned 32-bit bytes."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import chain

import numpy as np

# Parts, and as many pieces, remembered in a worker before it starts anew: about 60 MB of each.
REMEMBERED = 400_000
# What the vocabulary appends to the last id of a piece, and how it cuts a text, which
# it puts in lower case first: English endings, runs of letters, single digits, runs of other signs.
WORD_END = "</w>"
LETTERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u024f"
DIGITS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
PIECES = re.compile(
    f"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{DIGITS}]|[^ \n{LETTERS}{DIGITS}]+"
)
# The classes above hold for texts of these characters: ASCII, Latin letters but for the dotted
# capital I, general punctuation, blanks. They are alike before and after composition. Special
# tokens, whose names begin with `<|`, are found before a text is cut.
NOT_SIMPLE = re.compile(
    "[^ \n!-~\u00a1-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e]|<\\|"
)

_encoders: dict[str, WordEncoder] = {}


class _Numbers(dict):
    """Numbers parts in the order in which they come; `new` are those not yet learnt."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        self.new.append(part)
        return number


def _parts(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The parts of texts between blanks and line ends.

    How many each text has, the place of each among the distinct ones, and these.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    lines = pc.replace_substring(pa.array([text or "" for text in texts], pa.large_string()), "\n", " ")
    split = pc.split_pattern(lines, " ")
    coded = split.flatten().dictionary_encode()
    return (
        pc.list_value_length(split).to_numpy(zero_copy_only=False),
        coded.indices.to_numpy(zero_copy_only=False),
        coded.dictionary.to_pylist(),
    )


class WordEncoder:
    """Ids of texts by a vocabulary that drops white space and never joins across its pieces.

    The ids of a text are those of its space-separated parts in a row. Each distinct part is worked
    out once and remembered: a simple one is cut into its pieces, of which each distinct one is
    encoded once, many in a line; others are encoded whole. The encoder lives as long as the worker.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._remembered = remembered
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[n for piece, n in vocabulary.items() if piece.endswith(WORD_END)]] = True
        self._pieces: dict[str, bytes] = {}
        self._forget_parts()

    def _forget_parts(self) -> None:
        self._numbers = _Numbers()
        # The ids of all parts in a row, and where those of each part begin and end.
        self._ids = np.empty(0, "<u4")
        self._bounds = np.zeros(1, np.int64)

    def _encoded(self, parts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in found]

    def _learn_pieces(self, pieces: list[str]) -> None:
        """Encode new pieces as one line and tell them apart by word ends."""
        line = self._tokenizer.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)
        ids = np.array(line[0].ids, "<u4")
        ends = (np.flatnonzero(self._ends[ids]) + 1) * 4
        if len(ends) != len(pieces):
            # Some piece does not end in a word end: one by one there is nothing to tell apart.
            self._pieces.update(zip(pieces, self._encoded(pieces), strict=True))
            return
        data, first = ids.tobytes(), 0
        for piece, end in zip(pieces, ends.tolist(), strict=True):
            self._pieces[piece] = data[first:end]
            first = end

    def _learn(self, parts: list[str]) -> None:
        """Append the ids of new parts, in their order."""
        # Most parts are one piece as they stand.
        cut = [
            [part] if part.isascii() and part.isalpha() and part.islower()
            else None if NOT_SIMPLE.search(part) else PIECES.findall(part.lower())
            for part in parts
        ]
        pieces = set(chain.from_iterable(filter(None, cut))).difference(self._pieces)
        if pieces:
            self._learn_pieces(list(pieces))
        odd = iter(self._encoded([part for part, own in zip(parts, cut, strict=True) if own is None]))
        ids = self._pieces
        found = [
            next(odd) if own is None
            else ids[own[0]] if len(own) == 1 else b"".join([ids[piece] for piece in own])
            for own in cut
        ]
        ends = np.cumsum([len(own) // 4 for own in found]) + self._bounds[-1]
        self._bounds = np.concatenate([self._bounds, ends])
        self._ids = np.concatenate([self._ids, np.frombuffer(b"".join(found), "<u4")])

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        if len(self._numbers) > self._remembered:
            self._forget_parts()
        if len(self._pieces) > self._remembered:
            self._pieces = {}
        sizes, places, distinct = _parts(texts)
        numbers = np.fromiter(map(self._numbers.__getitem__, distinct), np.int64, len(distinct))[places]
        if self._numbers.new:
            self._learn(self._numbers.new)
            self._numbers.new = []
        first = self._bounds[numbers]
        n = self._bounds[numbers + 1] - first
        ends = np.cumsum(n)
        # Every id's place among those remembered: its part's first, and on from there.
        ids = self._ids[np.arange(n.sum()) + np.repeat(first - (ends - n), n)]
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *sizes])]
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def word_encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
