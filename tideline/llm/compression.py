"""Lengths of text windows under zstandard raw-content dictionaries, for the two classifiers."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

# Letters of any script, in runs: what the classifiers see of a text. Python counts fractions, raised
# digits and Roman numerals as signs of words too, but they are no letters.
NUMBERS = "".join(
    c for c in map(chr, range(0x110000)) if c.isnumeric() and not c.isdecimal() and not c.isalpha()
)
LETTERS = re.compile(rf"[^\W\d_{NUMBERS}]+")
# The same but for those signs, and many times as fast: their class is searched sign by sign.
NEARLY_LETTERS = re.compile(r"[^\W\d_]+")


def words_in(text: str | None) -> list[str]:
    found = NEARLY_LETTERS.findall((text or "").lower())
    if not found or "".join(found).isalpha():
        return found
    return [part for run in found for part in ([run] if run.isalpha() else LETTERS.findall(run))]


def windows(words: Sequence[str], size: int) -> list[bytes]:
    """All words in windows of `size`, the last one shorter, with blanks around every word."""
    return [
        f" {' '.join(words[i : i + size])} ".encode("utf-8", "surrogatepass")
        for i in range(0, len(words), size)
    ]


def content(words: Iterable[str], size: int) -> bytes:
    """Words as dictionary content of at most `size` bytes, cut at its start."""
    return f" {' '.join(words)} ".encode("utf-8", "surrogatepass")[-size:]


def compressor(dictionary: bytes, min_match: int = 5):
    """A compressor that knows `dictionary`; greedy, no frame extras."""
    import zstandard

    parameters = zstandard.ZstdCompressionParameters(
        window_log=17,
        chain_log=15,
        hash_log=16,
        search_log=4,
        min_match=min_match,
        strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False,
        write_dict_id=False,
    )
    known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=known)
