"""Words without case and ASCII punctuation, and sets of known ones."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from smeltery.llm import texts

# Letters in lower case; ASCII punctuation and blanks as blanks.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
for _low, _high in ((0, 47), (58, 64), (91, 96), (123, 127)):
    _PLAIN[_low : _high + 1] = 32


def plain_words(text: str) -> list[bytes]:
    return _PLAIN[np.frombuffer(text.encode(), np.uint8)].tobytes().split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    return texts.word_hashes(data, ends - [len(w) for w in words], ends) if words else np.zeros(0, np.uint64)


@dataclass(frozen=True)
class Terms:
    hashes: np.ndarray  # sorted
    filter: np.ndarray

    @staticmethod
    def of(hashes: np.ndarray) -> "Terms":
        hashes = np.unique(hashes)
        some = np.zeros(1 << 22, bool)
        some[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        return Terms(hashes, np.packbits(some))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that hold a term, and which."""
        low = (hashes & np.uint64((1 << 22) - 1)).astype(np.int64)
        likely = np.flatnonzero(self.filter[low >> 3] >> (7 - (low & 7)).astype(np.uint8) & 1)
        at = np.minimum(np.searchsorted(self.hashes, hashes[likely]), len(self.hashes) - 1)
        real = self.hashes[at] == hashes[likely]
        return likely[real], at[real]


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the index of each text's first (one more at the end)."""
    data, bounds = texts.flat(column)
    data = _PLAIN[data]
    starts, ends, first = texts.word_spans(data, bounds)
    return texts.word_hashes(data, starts, ends), first
