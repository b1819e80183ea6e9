"""Differences between two versions of a text, sentence by sentence and word by word."""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import sentences

OPS = "array<struct<op:string,old:string,new:string,words:array<struct<op:string,text:string>>>>"
#: Characters whose differences a worker holds at once, unless one pair of texts has more: objects of words and lines take far more room than text.
HELD_CHARS = 1 << 18


def _words(a: str, b: str) -> list[dict]:
    x, y = re.findall(r"\S+|\s+", a), re.findall(r"\S+|\s+", b)
    out = []
    for op, i, j, k, l in difflib.SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
        if op in ("equal", "delete", "replace"):
            out.append({"op": "same" if op == "equal" else "old", "text": "".join(x[i:j])})
        if op in ("insert", "replace"):
            out.append({"op": "new", "text": "".join(y[k:l])})
    return out


def compare(old: list[str], new: list[str], context: int = 3, words: bool = True) -> list[dict]:
    """Changed lines with some unchanged ones around them; with ``words``, replaced lines also by words."""
    out = []
    for group in difflib.SequenceMatcher(None, old, new, autojunk=False).get_grouped_opcodes(context):
        for op, i, j, k, l in group:
            if op == "equal":
                out += [{"op": "same", "old": x, "new": x, "words": None} for x in old[i:j]]
                continue
            paired = min(j - i, l - k) if op == "replace" else 0
            out += [{"op": "changed", "old": old[i + n], "new": new[k + n], "words": _words(old[i + n], new[k + n]) if words else None} for n in range(paired)]
            out += [{"op": "removed", "old": x, "new": None, "words": None} for x in old[i + paired : j]]
            out += [{"op": "added", "old": None, "new": x, "words": None} for x in new[k + paired : l]]
    return out


def in_parts(batches: Iterator[tuple[pd.Series, pd.Series]], context: int, words: bool) -> Iterator[pd.Series]:
    """The differences of all pairs in order, some of a batch at a time."""
    for batch in batches:
        held, chars = [], 0
        for x, y in zip(*batch):
            if x is None or y is None:
                held.append(None)
                continue
            held.append(compare(list(x), list(y), context, words))
            chars += sum(map(len, x)) + sum(map(len, y))
            if chars >= HELD_CHARS:
                yield pd.Series(held, dtype=object)
                held, chars = [], 0
        if held:
            yield pd.Series(held, dtype=object)


def diff(old: Column, new: Column, context: int = 3, words: bool = True) -> Column:
    """What changed, as an array of (op, old, new, words); null if either text is.  Without ``words`` these are null."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        return in_parts(batches, context, words)

    return F.pandas_udf(run, OPS)(sentences(old), sentences(new))


def unified(ops: Column) -> Column:
    """The differences as lines that begin with a blank, ``-`` or ``+``."""
    line = lambda o: F.when(o["op"] == "same", F.concat(F.lit("  "), o["old"])).otherwise(F.concat_ws("\n", F.concat(F.lit("- "), o["old"]), F.concat(F.lit("+ "), o["new"])))
    return F.array_join(F.transform(ops, line), "\n")
