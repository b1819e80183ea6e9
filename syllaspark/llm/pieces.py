"""Splitting texts into repeating units, and encoding each distinct unit once.

Where each white space character stands alone between others, the public pattern
gives a space to the piece after it and makes a line feed a piece, so such a text may
be cut there and each distinct part be encoded once; other texts are cut into the
pattern's own pieces.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import islice

import numpy as np

#: White space of any length but one, other than a space or line feed, or at either end: such texts are cut piece by piece.
_PLAIN = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x1f")
_ODD = re.compile(r"[^\S \n]")


class _Index(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Units:
    """Ids of whole texts through a table of the distinct units met so far.

    ``encode(pieces)`` gives the ids of the pieces as (flat ids, lengths).  When the
    table exceeds ``limit`` units, those met most often stay: a matter of memory and
    speed, not of results.
    """

    def __init__(self, pattern: str, encode: Callable, limit: int = 600_000):
        import regex

        self.findall, self.encode, self.limit = regex.compile(pattern).findall, encode, limit
        self.index = _Index()
        self.flat, self.starts, self.lengths, self.often = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _shrink(self) -> None:
        stay = np.sort(np.argpartition(-self.often, self.limit // 2)[: self.limit // 2])
        keys = list(self.index)
        self.index = _Index((keys[k], i) for i, k in enumerate(stay.tolist()))
        size = self.lengths[stay]
        ends = np.cumsum(size)
        self.flat = self.flat[np.repeat(self.starts[stay] - ends + size, size) + np.arange(ends[-1])]
        self.starts, self.lengths, self.often = ends - size, size, self.often[stay] // 2

    def _keys(self, text: str) -> list[str]:
        """Keys of a text's units: a unit's own text, less its leading space or else with one more."""
        if not text:
            return []
        if any(x in text for x in _PLAIN) or text[0] in " \n" or text[-1] in " \n" or not text.isascii() and _ODD.search(text):
            return [p[1:] if p[0] == " " and len(p) > 1 and " " not in p[1:] else " " + p for p in self.findall(text)]
        if "\n" not in text:
            keys = text.split(" ")
            keys[0] = " " + keys[0]
            return keys
        out = []
        for line in text.split("\n"):
            keys = line.split(" ")
            keys[0] = " " + keys[0]
            out += keys
            out.append(" \n")
        return out[:-1]

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, how many each text has)."""
        if len(self.index) > self.limit:
            self._shrink()
        look, at, counts = self.index.__getitem__, [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            keys = self._keys(text)
            counts[k] = len(keys)
            at.append(np.fromiter(map(look, keys), np.int32, len(keys)))
        self._grow()
        at = np.concatenate(at) if at else np.zeros(0, np.int32)
        self.often += np.bincount(at, minlength=len(self.often))
        size = self.lengths[at]
        ends = np.cumsum(size)
        flat = self.flat[np.repeat(self.starts[at] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        per = np.diff(np.append(0, ends)[np.append(0, np.cumsum(counts))])
        return flat, per

    def _grow(self) -> None:
        known = len(self.starts)
        if len(self.index) == known:
            return
        new = list(islice(self.index, known, None))
        lone = np.fromiter(map(str.isalpha, new), bool, len(new))  # a word after a space is one piece
        words, rest = np.flatnonzero(lone), np.flatnonzero(~lone)
        pieces, of = _Index(), []
        for key in map(new.__getitem__, rest.tolist()):
            of.append([pieces[p] for p in self.findall(key[1:] if key[0] == " " else " " + key)])
        flat, lengths = self.encode([" " + new[k] for k in words.tolist()] + list(pieces))
        starts = np.cumsum(lengths) - lengths
        many = np.fromiter(map(len, of), np.int64, len(of))
        at = len(words) + np.fromiter((i for row in of for i in row), np.int64, int(many.sum()))
        size = lengths[at]
        ends = np.cumsum(size)
        joined = flat[np.repeat(starts[at] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        stops = np.append(0, ends)[np.cumsum(many)]
        own, begin, base = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64), len(self.flat)
        own[words], begin[words] = lengths[: len(words)], base + starts[: len(words)]
        used = int(lengths[: len(words)].sum())
        own[rest] = np.diff(np.append(0, stops))
        begin[rest] = base + used + stops - own[rest]
        self.starts, self.lengths = np.append(self.starts, begin), np.append(self.lengths, own)
        self.flat = np.concatenate([self.flat, flat[:used].astype(np.int32), joined.astype(np.int32)])
        self.often = np.append(self.often, np.zeros(len(new), np.int64))


_KEPT: dict = {}


def kept(name: tuple, make: Callable):
    """What ``make`` gives, made once in each Python worker, which serves many tasks; the last few stay."""
    if name not in _KEPT:
        while len(_KEPT) >= 2:
            _KEPT.pop(next(iter(_KEPT)))
        _KEPT[name] = make()
    return _KEPT[name]
