"""Pre-tokens of byte-level BPE vocabularies, found for a whole chunk of texts with array operations.

The character classes come from the tokenizer's own pre-tokenizer: it is probed once for each character
met, so the split agrees with the library whatever its Unicode version is.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from dataclasses import dataclass

import numpy as np

from panelmill.llm.common import Rolling, grouped

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SPACE, LETTER, DIGIT, OTHER, UNKNOWN = 0, 1, 2, 3, 255
_TOP = 0x110000


@functools.lru_cache(1)
def _rolling() -> Rolling:
    return Rolling(_TOP, 20)


@dataclass
class Split:
    """words: the distinct pre-tokens; codes: each pre-token's word; offsets: the texts' bounds in codes."""

    words: list[str]
    codes: np.ndarray
    offsets: np.ndarray


class Splitter:
    """Splits as the tokenizer file says. spaced: a space belongs to the word after it and digits stay
    together (the byte-level form); else white space is dropped and each digit stands alone."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spaced = len(self.tokenizer.pre_tokenizer.pre_tokenize_str("a b")[1][0]) == 2
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.classes = np.full(_TOP, UNKNOWN, np.uint8)
        self._probe(np.array([c for c in range(0x250)], np.uint32))

    def _probe(self, points: np.ndarray) -> None:
        pre = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for p in points.tolist():
            c = chr(p)
            spans = [[y - x for _, (x, y) in pre(f"{a}{c}")] for a in "a1!"]
            if spans[0] == [2]:
                kind = LETTER
            elif spans[2] == [2]:
                kind = OTHER
            elif spans[1] == [2] or not self.spaced and spans[1] == [1, 1]:
                kind = DIGIT
            else:
                kind = SPACE
            self.classes[p] = kind

    def normal(self, text: str) -> str:
        """As the file's normalizer; for characters below U+0250 Python's lower() is the same."""
        if self.tokenizer.normalizer is None:
            return text
        if text.isascii():
            return text.lower()
        if max(text) < "ɐ":
            return unicodedata.normalize("NFC", text).lower()
        return self.tokenizer.normalizer.normalize_str(text)

    def split(self, data: np.ndarray, offsets: np.ndarray) -> Split:
        """data, offsets: UTF-8 bytes of texts and the bounds of each."""
        raw = data.tobytes()
        special = any(s.encode() in raw for s in self.special)
        if special or self.tokenizer.normalizer is not None:
            parts, marks, bounds, at = [], [], [0], 0
            for i in range(len(offsets) - 1):
                for j, piece in enumerate(self._pieces(raw[offsets[i] : offsets[i + 1]].decode(), special)):
                    piece = piece if j % 2 else self.normal(piece)
                    marks += [at, at + len(piece)] if j % 2 else []
                    parts.append(piece)
                    at += len(piece)
                bounds.append(at)
            text, starts, marks = "".join(parts), np.array(bounds, np.int64), np.array(marks, np.int64)
        else:
            text, marks = raw.decode(), np.zeros(0, np.int64)
            starts = offsets.astype(np.int64)
            if len(text) != len(raw):
                seen = np.zeros(len(data) + 1, np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=seen[1:])
                starts = seen[starts]
        return self._split(text, starts, marks)

    def _pieces(self, text: str, special: bool) -> list[str]:
        """Ordinary text and special strings in turn."""
        if not special:
            return [text]
        import re

        return re.split("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")", text)

    def _split(self, text: str, starts: np.ndarray, marks: np.ndarray) -> Split:
        n = len(text)
        if not n:
            return Split([], np.zeros(0, np.int64), np.zeros(len(starts), np.int64))
        points = np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self.classes[points]
        if (kind == UNKNOWN).any():
            self._probe(np.unique(points[kind == UNKNOWN]))
            kind = self.classes[points]
        edge = np.zeros(n + 4, bool)
        edge[starts] = edge[marks] = True
        edge[n:] = True
        begin = np.empty(n + 4, bool)
        begin[n:] = True
        begin[0] = True
        begin[1:n] = kind[1:] != kind[:-1]
        begin |= edge
        padded = np.concatenate([points, np.zeros(4, points.dtype)])
        if self.spaced:
            at = np.flatnonzero(begin[:n] & (kind != SPACE) & ~edge[:n])
            at = at[kind[at - 1] == SPACE]
            begin[at - 1] = True
            begin[at[points[at - 1] == 0x20]] = False
        else:
            begin[:n] |= kind == DIGIT
        # an apostrophe with the letters of a contraction, if the match can begin at the apostrophe
        at = np.flatnonzero((points == 0x27) & begin[:n])
        if len(at):
            at = at[~edge[at + 1]]
            a, b = padded[at + 1], padded[at + 2]
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ~edge[at + 2] & ((np.isin(a, [ord("r"), ord("v")]) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
            begin[at[one | two] + 1] = False
            begin[at[one] + 2] = True
            begin[at[two] + 3] = True
        for x, y in zip(marks[::2], marks[1::2], strict=True):
            begin[x + 1 : y] = False
        first = np.flatnonzero(begin[:n])
        last = np.append(first[1:], n)
        if not self.spaced:
            keep = kind[first] != SPACE
            first, last = first[keep], last[keep]
        rolling = _rolling()
        codes, where = grouped(points, first, last, rolling.slices(rolling.sums(points), first, last))
        words = [text[x:y] for x, y in zip(first[where].tolist(), last[where].tolist(), strict=True)]
        return Split(words, codes, np.searchsorted(first, starts))


@functools.lru_cache(4)
def splitter(path: str) -> Splitter:
    """One for each file and worker."""
    return Splitter(path)
