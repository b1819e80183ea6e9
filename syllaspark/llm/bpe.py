"""Byte-level BPE encoding and decoding over padded numpy matrices.

Pieces of like length form one matrix.  In each round every row merges its leftmost
pair of the least rank, found by a hashed pair lookup, and the matrix is compacted
by the column that each merging row loses; rows with nothing to merge leave it.

Rows: one output row per input row; a null or empty text has no ids.  Ids of
repeated rows are made alike.  Columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .mapping import map_text
from .pieces import Units, kept

NONE = np.int32(2**31 - 1)
#: Distinct units that a worker keeps between tasks.
UNITS = 150_000
#: Pieces of more bytes are merged one by one with a heap; the result is the same.
LONG = 512


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class PairTable:
    """(left id, right id) to the id of their merge, by open addressing in one array."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        keys, values = np.array(keys, np.uint64), np.array(values, np.int32)
        self.bits = max(4, int(2 * max(1, len(keys))).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1), np.uint64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] == np.uint64(2**64 - 1)
            self.keys[slot[left[free]]] = keys[left[free]]  # of several, the last one stays
            won = self.keys[slot[left]] == keys[left]
            self.values[slot[left[won]]] = values[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(keys)
        got = self.keys[slot]
        out = np.where(got == keys, self.values[slot], NONE)
        todo = np.flatnonzero((got != keys) & (got != np.uint64(2**64 - 1)))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
            got = self.keys[slot[todo]]
            hit = got == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (got != np.uint64(2**64 - 1))]
        return out


class MatrixBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, PairTable(ranks)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_lengths = np.fromiter(map(len, tokens), np.int64, size)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, lengths) of separate pieces."""
        raw = [p.encode() for p in pieces]
        out: list = [None] * len(raw)
        buckets: dict[int, list[int]] = {}
        for k, piece in enumerate(raw):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[k] = np.array([rank], np.int32)
            elif len(piece) > LONG:
                out[k] = self._long(piece)
            else:
                buckets.setdefault(len(piece) if len(piece) <= 16 else -(-len(piece) // 8) * 8, []).append(k)
        for width, rows in sorted(buckets.items()):
            for first in range(0, len(rows), max(1, (1 << 20) // width)):
                self._matrix(raw, rows[first : first + max(1, (1 << 20) // width)], width, out)
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), lengths

    def _matrix(self, raw: list[bytes], rows: list[int], width: int, out: list) -> None:
        grid = np.full((len(rows), width), -1, np.int32)
        sizes = np.fromiter((len(raw[k]) for k in rows), np.int64, len(rows))
        grid[np.arange(width) < sizes[:, None]] = self.single[np.frombuffer(b"".join(raw[k] for k in rows), np.uint8)]
        rows = np.array(rows)
        rank = np.full((len(rows), width - 1), NONE, np.int32)
        real = grid[:, 1:] >= 0
        rank[real] = self.pairs.look(grid[:, :-1][real], grid[:, 1:][real])
        while len(rows):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), np.int64)
            line = np.arange(len(rows))
            least = rank[line, at] if rank.shape[1] else np.full(len(rows), NONE)
            done = least == NONE
            if done.any():
                for k, row in zip(rows[done].tolist(), grid[done]):
                    out[k] = row[row >= 0]
                rows, grid, rank, at, least = rows[~done], grid[~done], rank[~done], at[~done], least[~done]
                if not len(rows):
                    break
                line = np.arange(len(rows))
            grid[line, at] = least
            n = grid.shape[1]
            keep = np.ones((len(rows), n), bool)
            keep[line, at + 1] = False
            grid = grid[keep].reshape(len(rows), n - 1)
            keep = np.ones((len(rows), n - 1), bool)
            keep[line, at] = False
            rank = rank[keep].reshape(len(rows), n - 2)
            for side in (-1, 0):  # the pairs that the merged id now forms
                pos = at + side
                ok = (pos >= 0) & (pos < n - 2)
                r, p = line[ok], pos[ok]
                left, right = grid[r, p], grid[r, p + 1]
                whole = right >= 0
                rank[r[whole], p[whole]] = self.pairs.look(left[whole], right[whole])
                rank[r[~whole], p[~whole]] = NONE

    def _long(self, piece: bytes) -> np.ndarray:
        """One long piece: a heap of (rank, place) over a linked list."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n)) + [-1], [-1] + list(range(n - 1))
        first = self.pairs.look(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    s = self.ranks.get(self._token(ids[x]) + self._token(ids[y]))
                    if s is not None:
                        heapq.heappush(heap, (s, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def _token(self, i: int) -> bytes:
        s = int(self.token_starts[i])
        return self.token_bytes[s : s + int(self.token_lengths[i])].tobytes()

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, the end of each id's bytes)."""
        size = self.token_lengths[ids]
        ends = np.cumsum(size)
        return self.token_bytes[np.repeat(self.token_starts[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)], ends


def bpe_encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """(id, ids), or with ``digests`` (id, n_tokens, ids_sha256, decoded_sha256).

    ``rank_file`` is read where the tokenizer package is installed, on each executor.
    The digests are of the ids as little-endian unsigned 32-bit integers and of the
    bytes that they decode to.
    """

    def make():
        def tools():
            bpe = MatrixBpe(read_ranks(rank_file))
            return bpe, Units(pattern, bpe.encode_pieces, UNITS)

        bpe, units = kept(("bpe", rank_file, pattern), tools)

        def f(column, _buf, _offs):
            flat, per = units.ids(["" if t is None else t for t in column.to_pylist()])
            ends = np.cumsum(per)
            if not digests:
                return [pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat, pa.int32()))]
            raw, byte_ends = bpe.decode(flat)
            ids, raw = memoryview(flat.astype("<u4").tobytes()), memoryview(raw.tobytes())
            byte_ends = np.append(0, byte_ends)[np.append(0, ends)]
            ids_sha, raw_sha, last = [], [], 0
            for k, e in enumerate(ends.tolist()):
                ids_sha.append(hashlib.sha256(ids[4 * last : 4 * e]).hexdigest())
                raw_sha.append(hashlib.sha256(raw[byte_ends[k] : byte_ends[k + 1]]).hexdigest())
                last = e
            return [pa.array(per), ids_sha, raw_sha]

        return f

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    return map_text(docs, id_col, text_col, make, fields, 1 << 20).withColumnRenamed("id", id_col)


def bpe_decode(rows: DataFrame, rank_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded): the bytes of each row's ids; null or no ids give empty bytes, an unknown id is an error."""
    from ..session import ship

    ship(rows.sparkSession)
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = MatrixBpe(read_ranks(rank_file))
        for batch in batches:
            column = batch.column(1)
            lists = [np.zeros(0, np.int64) if x is None else np.array(x, np.int64) for x in column.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bpe.decode(x)[0].tobytes() for x in lists], pa.binary())], names=["id", "decoded"])

    return rows.select(rows[id_col], rows[ids_col]).toDF("id", "ids").mapInArrow(run, f"id {kind}, decoded binary").withColumnRenamed("id", id_col)
