"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of one fixed public vocabulary.  A
word's probability is the sum over all its segmentations into pieces, which a
forward pass computes; a text's is the product over its words.  The probabilities
are fitted by expectation maximisation on a bounded sample of labelled rows.

Rows: one output row per input row.  A null text, or one without a letter (Unicode
category L; number signs are none), is ``und`` with score 0, and so is every text when
no row is labelled.  Ties go to the language that sorts first.  Repeated rows are
predicted alike; columns other than those named are not read.  More than ``LANGUAGES``
labels are an error, as a model holds the vocabulary once for each.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import read_ranks
from .mapping import map_text

#: Longest piece, in bytes, that a segmentation may use.
LONGEST = 16
#: Labelled rows of each language that a fit takes at most, and languages.
SAMPLE, LANGUAGES = 250, 1000
#: Words of more bytes are scored block by block, in blocks of so many.
LONG = 4096
UND = "und"
_LETTERS = regex.compile(r"\p{L}+")
_B = np.uint64(0x100000001B3)
_EMPTY = np.uint64(2**64 - 1)


class Vocabulary:
    """Ids of byte strings through a hash that grows byte by byte."""

    def __init__(self, tokens: list[bytes]):
        tokens = sorted({t for t in tokens if len(t) <= LONGEST} | {bytes([b]) for b in range(256)})
        self.size = len(tokens)
        hashes = np.zeros(self.size, np.uint64)
        for k, t in enumerate(tokens):
            h = 0
            for b in t:
                h = (h * int(_B) + b + 1) & (2**64 - 1)
            hashes[k] = h
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        if (np.diff(self.sorted.astype(object)) == 0).any():
            raise ValueError("two pieces share a hash")
        self.bits = 18
        slot = self._slot(self.sorted)
        self.keys, self.ids = np.full(1 << self.bits, _EMPTY), np.full(1 << self.bits, self.size, np.int32)
        left = np.arange(self.size)
        while len(left):
            free = self.keys[slot[left]] == _EMPTY
            self.keys[slot[left[free]]] = self.sorted[left[free]]
            won = self.keys[slot[left]] == self.sorted[left]
            self.ids[slot[left[won]]] = self.order[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids; ``size`` where there is no such piece."""
        slot = self._slot(hashes)
        got = self.keys[slot]
        out = np.where(got == hashes, self.ids[slot], self.size)
        todo = np.flatnonzero((got != hashes) & (got != _EMPTY))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            got = self.keys[slot[todo]]
            hit = got == hashes[todo]
            out[todo[hit]] = self.ids[slot[todo[hit]]]
            todo = todo[~hit & (got != _EMPTY)]
        return out

    def spans(self, grid: np.ndarray) -> np.ndarray:
        """[l, row, i]: the id of the piece of ``l + 1`` bytes that begins at ``i``; rows have one width."""
        n, width = grid.shape
        longest = min(width, LONGEST)
        out = np.full((longest, n, width), self.size, np.int32)
        h = np.zeros((n, width), np.uint64)
        for l in range(longest):
            stop = width - l
            h = h[:, :stop] * _B + grid[:, l:].astype(np.uint64) + np.uint64(1)
            out[l, :, :stop] = self.find(h.ravel()).reshape(n, stop)
        return out


def _grids(words: list[str], limit: int = 1 << 16):
    """Matrices of the bytes of words (a space before each) of equal length, with the words' places."""
    raw = [b" " + w.encode() for w in words]
    by: dict[int, list[int]] = {}
    for k, w in enumerate(raw):
        by.setdefault(len(w), []).append(k)
    for width, rows in sorted(by.items()):
        step = max(1, limit // width)
        for first in range(0, len(rows), step):
            part = rows[first : first + step]
            yield np.array(part), np.frombuffer(b"".join(raw[k] for k in part), np.uint8).reshape(len(part), width)


def _forward(ids: np.ndarray, prob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(alpha [i, row, language] scaled, log of the scale [i, row]) over all segmentations of the first i bytes."""
    longest, n, width = ids.shape
    alpha = np.zeros((width + 1, n, prob.shape[1]))
    scale = np.zeros((width + 1, n))
    alpha[0] = 1
    for j in range(1, width + 1):
        total = np.zeros((n, prob.shape[1]))
        for l in range(min(j, longest)):
            i = j - l - 1
            total += alpha[i] * prob[ids[l, :, i]] * np.exp(np.minimum(scale[i] - scale[j - 1], 700))[:, None]
        top = np.maximum(total.max(axis=1), 1e-300)
        alpha[j] = np.maximum(total / top[:, None], 1e-290)
        scale[j] = scale[j - 1] + np.log(top)
    return alpha, scale


@dataclass
class Model:
    languages: list[str]
    vocabulary: Vocabulary
    prob: np.ndarray  # [piece, language], a last row of zeros for no piece

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word in each language."""
        out = np.zeros((len(words), len(self.languages)))
        for rows, grid in _grids(words):
            if grid.shape[1] > LONG:
                out[rows] = [self._long_score(line) for line in grid]
                continue
            alpha, scale = _forward(self.vocabulary.spans(grid), self.prob)
            out[rows] = np.log(alpha[-1]) + scale[-1][:, None]
        return out

    def _long_score(self, line: np.ndarray) -> np.ndarray:
        """The same for one word of any length, with memory for one block."""
        none, k = self.vocabulary.size, len(self.languages)
        alpha, scale = np.zeros((LONGEST, k)), 0.0  # of the last places, the nearest one last
        alpha[-1] = 1
        for first in range(0, len(line), LONG):
            base, stop = max(0, first - LONGEST + 1), min(len(line), first + LONG)
            ids = self.vocabulary.spans(line[None, base:stop])[:, 0]
            ending = np.full((stop - first, LONGEST), none)
            for l in range(len(ids)):  # pieces of l + 1 bytes by the place where they end
                begin = np.arange(first, stop) - l
                ok = begin >= base
                ending[ok, LONGEST - 1 - l] = ids[l, begin[ok] - base]
            prob = self.prob[ending]
            run = np.vstack([alpha, np.zeros((stop - first, k))])
            for j in range(stop - first):
                run[j + LONGEST] = (run[j : j + LONGEST] * prob[j]).sum(axis=0)
                if j % 8 == 7:
                    top = run[j + LONGEST].max()
                    run[j + 1 : j + LONGEST + 1] /= top
                    np.maximum(run[j + LONGEST], 1e-290, out=run[j + LONGEST])
                    scale += np.log(top)
            alpha = run[-LONGEST:]
        return np.log(np.maximum(alpha[-1], 1e-300)) + scale


def fit(vocabulary: Vocabulary, counts: dict[str, Counter], rounds: int = 3, smooth: float = 0.5) -> Model:
    """Expectation maximisation for each language on its words' counts.

    Posterior counts of a piece come from the forward pass and the same pass over
    the reversed words.
    """
    languages = sorted(counts)
    prob = np.zeros((vocabulary.size + 1, len(languages)))
    for k, language in enumerate(languages):
        words = sorted(counts[language])
        often = np.array([counts[language][w] for w in words], float)
        p = np.full(vocabulary.size + 1, 1 / vocabulary.size)
        p[-1] = 0
        for _ in range(rounds):
            seen = np.zeros(vocabulary.size + 1)
            for rows, grid in _grids(words):
                ids = vocabulary.spans(grid)
                longest, n, width = ids.shape
                alpha, a_scale = _forward(ids, p[:, None])
                back = np.full_like(ids, vocabulary.size)
                for l in range(longest):  # a piece at i of a word is at width - i - l - 1 of the word reversed
                    back[l, :, : width - l] = ids[l, :, : width - l][:, ::-1]
                beta, b_scale = _forward(back, p[:, None])
                total = np.log(alpha[-1, :, 0]) + a_scale[-1]
                for l in range(longest):
                    for i in range(width - l):
                        j = width - i - l - 1
                        share = np.exp(np.minimum(np.log(alpha[i, :, 0] * beta[j, :, 0]) + a_scale[i] + b_scale[j] - total, 700)) * p[ids[l, :, i]]
                        np.add.at(seen, ids[l, :, i], share * often[rows])
            seen[-1] = 0
            p = seen + smooth / vocabulary.size * max(1.0, seen.sum() / 1000)
            p[-1] = 0
            p /= p.sum()
        prob[:, k] = p
    return Model(languages, vocabulary, prob)


def learn(labelled: DataFrame, vocabulary_file: str, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """A model from labelled rows; None when there are none.

    ``sample`` bounds the rows of each language whose words are counted: those that come
    first by a hash of id and text.  Only words and their counts come to the driver.
    """
    rows = labelled.where(labelled[lang_col].isNotNull() & labelled[text_col].isNotNull()).select(labelled[id_col].cast("string").alias("id"), labelled[lang_col].cast("string").alias("lang"), labelled[text_col].alias("text"))
    hashed = F.xxhash64("id", "text", F.lit("language sample"))
    ranked = lambda frame: frame.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).where(F.col("at") <= sample)
    edges = ranked(rows.select("lang", hashed.alias("hash"))).groupBy("lang").agg(F.max("hash").alias("edge")).limit(LANGUAGES + 1).collect()
    if len(edges) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not edges:
        return None
    upto = F.broadcast(labelled.sparkSession.createDataFrame([tuple(r) for r in edges], "lang string, edge long"))
    taken = ranked(rows.join(upto, "lang").where(hashed <= F.col("edge")).select("lang", "text", hashed.alias("hash")))  # of equal rows no more than asked
    words = taken.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    counts: dict[str, Counter] = {}
    for r in words.groupBy("lang", "word").agg(F.count("*").alias("n")).toLocalIterator():
        counts.setdefault(r["lang"], Counter())[r["word"]] = r["n"]
    if not counts:
        return None
    return fit(Vocabulary(list(read_ranks(vocabulary_file))), counts)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", limit: int = 150_000) -> DataFrame:
    """(id, lang_pred, score): the most probable language and its posterior under equal priors."""
    if model is None:
        return docs.select(docs[id_col], F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages times a fixed vocabulary

    def make():
        model = shared.value
        k = len(model.languages)
        table: dict[str, int] = {}
        scores, letters = np.zeros((0, k)), np.zeros(0, bool)

        def grow(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
            words: dict[str, int] = {}
            of = [[words.setdefault(w, len(words)) for w in ([u] if u.isalpha() else _LETTERS.findall(u))] for u in new]
            each = np.vstack([model.word_scores(list(words)), np.zeros((1, k))])
            many = np.fromiter(map(len, of), np.int64, len(of))
            at = np.fromiter((i for row in of for i in row), np.int64, int(many.sum()))
            sums = np.vstack([np.zeros((1, k)), np.cumsum(each[at], axis=0)]) if len(at) else np.zeros((1, k))
            ends = np.append(0, np.cumsum(many))
            return sums[ends[1:]] - sums[ends[:-1]], many > 0

        def f(column, _buf, _offs):
            nonlocal scores, letters
            if len(table) > limit:
                table.clear()
                scores, letters = np.zeros((0, k)), np.zeros(0, bool)
            names, score = [], []
            units = [("" if t is None else t).lower().split() for t in column.to_pylist()]
            at = [np.fromiter((table.setdefault(u, len(table)) for u in row), np.int32, len(row)) for row in units]
            if len(table) > len(scores):
                new = list(table)[len(scores) :]
                more, has = grow(new)
                scores, letters = np.vstack([scores, more]), np.append(letters, has)
            for row in at:
                if not len(row) or not letters[row].any():
                    names.append(UND)
                    score.append(0.0)
                    continue
                total = scores[row].sum(axis=0)
                best = int(total.argmax())
                names.append(model.languages[best])
                score.append(float(1 / np.exp(total - total[best]).sum()))
            return [names, score]

        return f

    return map_text(docs, id_col, text_col, make, "lang_pred string, score double", 1 << 20).withColumnRenamed("id", id_col)


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 1 modulo 3; a null id is kept out too."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def language_report(docs: DataFrame, vocabulary_file: str, sample: int = SAMPLE) -> DataFrame:
    """Per document: whether it was held out, the predicted language and its score."""
    model = learn(docs.where(~held_out(docs["doc_id"])), vocabulary_file, sample=sample)
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
