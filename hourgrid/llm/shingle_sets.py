"""Word shingles of a text as a set of 64-bit hashes.

A-Z are lower-cased and words are what lies between ASCII white space. A word's hash is eight bytes of BLAKE2b, remembered for
a bounded number of words; a shingle's hash is a polynomial over its few words' hashes, mixed at last. With fewer words than a shingle
has, the whole sequence is the only shingle.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Words whose hashes a task remembers, and the longest of them.
MEMO_ENTRIES, MEMO_LENGTH = 200_000, 64
_WORD = np.uint64(0x9FB21C651E98DF25)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Memo(dict):
    """Hashes of words; emptied when it holds ``MEMO_ENTRIES``."""

    def __missing__(self, word: bytes) -> int:
        found = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= MEMO_LENGTH:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = found
        return found


_memo = _Memo()


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word, in order."""
    words = WORD.findall(text.encode().lower())  # bytes: A-Z alone are lower-cased
    return np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Distinct shingle hashes, ascending, as signed 64-bit numbers."""
    w = word_hashes(text or "")
    if not len(w):
        return np.empty(0, np.int64)
    k = min(words, len(w))
    runs = len(w) - k + 1
    h = np.full(runs, k, np.uint64)
    for i in range(k):
        h = h * _WORD + w[i : i + runs]
    return np.unique(_mix(h).view(np.int64))
