"""Pre-tokens of a text, equal to those of the ``tokenizers`` library, and counts or ids of each.

A text is cut at the special strings first, then by the vocabulary's own pattern. Texts
of Latin letters and common punctuation, whose classes do not change between versions of Unicode, are cut by
Python's own expressions; any other text is cut by the library itself.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable

import numpy as np
from tokenizers import Tokenizer, normalizers, pre_tokenizers

# Characters below the combining marks, and general punctuation: classes, lower case and NFC form of
# these are the same in both libraries (a test compares all of them).
SAFE = [chr(c) for c in (*range(0x300), *range(0x2010, 0x2028))]
UNSAFE = re.compile("[^\x00-˿‐-‧]")


def _class(of: Callable[[str], bool]) -> str:
    """The safe characters that ``of`` holds for, as the inside of a character class."""
    return "".join(f"\\u{ord(c):04x}" for c in SAFE if of(c))


_LETTER, _NUMBER = (_class(lambda c, k=k: unicodedata.category(c)[0] == k) for k in "LN")
_SPACE = _class(lambda c: c in "\t\n\x0b\x0c\r \x85\xa0")
# The patterns of the two vocabularies, as their files state them, over the safe characters.
SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
WORD_PATTERN = f"{SHORT}|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+"
BYTE_PATTERN = f"{SHORT}| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"

# What ends the last token of a pre-token, in the vocabulary that marks it.
LAST = "</w>"


class Cutter:
    """Cuts texts into (special strings, pre-tokens) for one vocabulary file."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.at_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        self.normalizer = self.tokenizer.normalizer
        self.pattern = re.compile(WORD_PATTERN if self.normalizer else BYTE_PATTERN)
        self.pre_tokenizer = self.tokenizer.pre_tokenizer
        if self.normalizer:  # pre-tokens are normalised already, and would not always stay the same; nor are they cut again
            self.tokenizer.normalizer = normalizers.Sequence([])
            as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), as_bytes])
        vocabulary = self.tokenizer.get_vocab()
        self.is_last = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.is_last[[i for t, i in vocabulary.items() if t.endswith(LAST)]] = True

    def pieces(self, segment: str) -> list[str]:
        """Pre-tokens of a text that holds no special string."""
        plain = segment.lower() if self.normalizer else segment
        if segment.isascii() or not (UNSAFE.search(segment) or UNSAFE.search(plain)):
            return self.pattern.findall(plain)
        if self.normalizer:
            segment = self.normalizer.normalize_str(segment)
        return [segment[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(segment)]

    def cut(self, text: str) -> tuple[list[str], list[str]]:
        """Special strings and pre-tokens, each in order."""
        if not any(map(text.__contains__, self.special)):
            return [], self.pieces(text)
        found, out, at = [], [], 0
        for m in self.at_special.finditer(text):
            out += self.pieces(text[at : m.start()])
            found.append(m.group())
            at = m.end()
        return found, out + self.pieces(text[at:])

    def in_order(self, text: str) -> list[str]:
        """Pre-tokens and special strings together, in the order of the text."""
        if not any(map(text.__contains__, self.special)):
            return self.pieces(text)
        out, at = [], 0
        for m in self.at_special.finditer(text):
            out += self.pieces(text[at : m.start()])
            out.append(m.group())
            at = m.end()
        return out + self.pieces(text[at:])

    def encode(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each pre-token or special string."""
        return [e.ids for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]

    def encode_words(self, pieces: list[str]) -> list[bytes]:
        """Ids of each pre-token as little-endian unsigned 32-bit numbers, for a vocabulary whose pre-tokens hold no
        white space: they are encoded as one text.

        Where no text holds ``LAST`` itself, an id that ends in it is the last of its pre-token; if each has one, that
        tells them apart. Otherwise the library does, which takes longer.
        """
        text = " ".join(pieces)
        if LAST not in text:
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.is_last[ids]) + 1
        if LAST in text or len(ends) != len(pieces):
            encoded = self.tokenizer.encode(text, add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            ends = np.searchsorted(np.array(encoded.word_ids, np.int64), np.arange(1, len(pieces) + 1))
        packed, ends = ids.tobytes(), (4 * ends).tolist()
        return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if pieces else []


@functools.cache
def cutter(path: str) -> Cutter:
    """One cutter for each worker process and vocabulary."""
    return Cutter(path)
