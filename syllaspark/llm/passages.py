"""Substring dedup: passages that an earlier document holds are cut from later ones.

A window is a run of words of one document.  Its anchor is the least hash among its
shorter word grams, so equal windows have equal anchors wherever they stand, and a
document falls into segments of windows with one anchor.

1. Routing.  Segments travel as (anchor, content key, id).  An anchor of one document
   is done with, as no other document can hold one of its windows.  Of the others each
   distinct segment is kept once, under the least id that holds it, with a list of its
   other holders; anchor and key name it by 128 bits.
2. Index.  These segments are dealt over shards by their anchor.  Each shard builds a
   compressed FM-index over them.
3. Streaming.  The segments of every document stream past the index of their shard;
   equal segments have equal statistics and are searched once.  Backward search over
   the wavelet matrix gives the matching statistics: for every place the length of the
   longest run of words that ends there and also stands elsewhere, up to a window, with
   the interval of its occurrences.  Places that reach a window whose interval holds a
   smaller id are reported; a later holder of a segment reports all its windows, as the
   index holds it under a smaller id.
4. Documents with a repeated window are read again and lose the words it covers.

Anchors that a map task meets very often are not gathered: their segments are
aggregated by content before they move, and their windows are dealt over the shards
one by one, so that no task holds all of a common passage or phrase.

Rows: one output row per input row.  A row with a null id comes before or after no
other: it loses nothing, and nothing is lost to it.  A null or empty text has no words.  Rows of equal id count as one document: neither
repeats the other, and both lose what a smaller id has.  Words are told apart by
64-bit hashes, windows by the hashes of all their words.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship, spread, tasks_for
from .arrays import SLICE_BYTES, U, _power, chained, mix, slices, span_hashes, tidy, words
from .fmindex import FmIndex

#: Words of the grams that anchors are chosen among.
GRAM = 6
#: Segments that a map task gathers before it sends them on, and occurrences of an anchor there that make it common.
BUFFER, COMMON = 400_000, 64
#: Segments of one FM-index, about.
SHARD = 4000
#: Up to this many ids are broadcast to pick documents; more are joined by a shuffle.
BROADCAST_IDS = 300_000


class Segments:
    """The words of a slice of documents, and their segments in order."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, window: int):
        self.starts, self.ends, self.counts = words(buf, offs)
        each = span_hashes(buf, self.starts, self.ends) if len(self.starts) else np.zeros(0, U)
        self.each, n = each, len(each)
        last = np.cumsum(self.counts)
        self.first = last - self.counts
        fits = np.zeros(n + 1, np.int64)
        some = self.counts >= window
        np.add.at(fits, self.first[some], 1)
        np.add.at(fits, last[some] - window + 1, -1)
        win = np.flatnonzero(np.cumsum(fits[:n]) > 0)
        gram = min(GRAM, window)
        best, at = _least(chained(each, gram), window - gram + 1)
        best, at = best[win], at[win]
        cut = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(win) else np.zeros(0, np.int64)
        self.win = win[cut]
        self.many = np.diff(np.append(cut, len(win)))
        self.anchor = best[cut]
        self.doc = np.searchsorted(last, self.win, "right")
        pw, inv = _power(n + 1)
        sums = np.append(U(0), np.cumsum(each * pw[:n]))
        stop = self.win + self.many + window - 1
        shape = (self.many * 64 + at[cut] - self.win).astype(U)
        self.key = mix((sums[stop] - sums[self.win]) * inv[self.win] + mix(shape, 5), 6)


def _least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of every ``width`` consecutive values and the place of the first such one, by doubling."""
    at, size = np.arange(len(values)), 1
    while size < width and len(values):
        step = min(size, width - size)
        left, right = values[:-step], values[step:]
        less = right < left
        values, at = np.where(less, right, left), np.where(less, at[step:], at[:-step])
        size += step
    return values, at


def _joined(buf: np.ndarray, offs: np.ndarray, s: Segments, keep: np.ndarray) -> list[str]:
    """A digest of each document's kept words, joined by one space."""
    mark = np.zeros(len(buf) + 1, np.int8)
    starts, ends = s.starts[keep], s.ends[keep]
    mark[starts] += 1
    per = _per(keep, s)
    inner = ends < np.repeat(offs[1:], per)
    mark[ends + inner] -= 1  # each place once
    take = np.cumsum(mark[:-1], dtype=np.int8).view(bool)
    chars = buf.copy()
    chars[ends[inner]] = 32
    out, at = chars[take], np.append(0, np.cumsum(ends - starts + inner))[np.append(0, np.cumsum(per))]
    view, digests = memoryview(out), []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b > a and view[b - 1] == 32:
            b -= 1
        digests.append(hashlib.sha256(view[a:b]).hexdigest())
    return digests


def _per(keep: np.ndarray, s: Segments) -> np.ndarray:
    """Kept words of each document."""
    total = np.append(0, np.cumsum(keep))
    return total[s.first + s.counts] - total[s.first]


SCHEMA = "kind int, a long, b long, c long, digest string"


def _table(kind: int, a, b, c, digest=None) -> pa.RecordBatch:
    n = len(a)
    longs = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (a, b, c)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *longs, pa.array(digest, pa.string()) if digest is not None else pa.nulls(n, pa.string())], names=["kind", "a", "b", "c", "digest"])


def _send(window: int, buckets: int):
    """Map side: (bucket, kind, payload) with segments (0), common segments (8) and documents (2)."""

    def packed(kind, bucket, columns):
        by = np.argsort(bucket, kind="stable")
        bucket, table = bucket[by], np.column_stack([np.ascontiguousarray(c)[by].view(np.int64) for c in columns])
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
        payload = [table[i:j].tobytes() for i, j in zip(cut, np.append(cut[1:], len(bucket)))]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut].astype(np.int64)), pa.array(np.full(len(cut), kind, np.int32)), pa.array(payload, pa.binary()), pa.nulls(len(cut), pa.list_(pa.string()))], names=["bucket", "kind", "payload", "digests"])

    def run(batches):
        held, size = [], 0

        def flush():
            anchor, key, doc = (np.concatenate(x) for x in zip(*held))
            held.clear()
            names, back, often = np.unique(anchor, return_inverse=True, return_counts=True)
            hot = often[back] >= COMMON
            flags = names[often >= COMMON]
            rare = ~hot
            none = np.zeros(len(flags), U)
            yield packed(0, np.concatenate([anchor[rare], flags]) % U(buckets), [np.concatenate([anchor[rare], flags]), np.concatenate([key[rare], none]), np.concatenate([doc[rare], none.view(np.int64)])])
            yield packed(8, mix(key[hot] ^ mix(doc[hot].view(U))) % U(buckets), [anchor[hot], key[hot], doc[hot]])

        for batch in batches:
            ids = np.array(batch.column(0), np.int64)
            for first, last, buf, offs in slices(batch.column(1), SLICE_BYTES):
                s = Segments(buf, offs, window)
                own = ids[first:last]
                digests = _joined(buf, offs, s, np.ones(len(s.starts), bool))
                table = np.column_stack([own, s.counts])
                yield pa.RecordBatch.from_arrays([pa.array([int(mix(own[:1].view(U))[0] % U(buckets))]), pa.array([2], pa.int32()), pa.array([table.tobytes()], pa.binary()), pa.array([digests], pa.list_(pa.string()))], names=["bucket", "kind", "payload", "digests"])
                if len(s.key):
                    held.append((s.anchor, s.key, own[s.doc]))
                    size += len(s.key)
                if size >= BUFFER:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return run


def _receive(batches):
    """Reduce side, in rows of SCHEMA.

    2: (id, words, -, digest).  6: (id, key) of the first holder of a segment whose
    anchor several documents share.  5: (id, key) of a later holder.  8: (id, key) of a
    segment with a common anchor.
    """

    def finish(payloads):
        table = np.concatenate([np.frombuffer(p, np.int64).reshape(-1, 3) for p in payloads])
        anchor, key, doc = table[:, 0], table[:, 1], table[:, 2]
        by = np.lexsort((doc, key, anchor))
        anchor, key, doc = anchor[by], key[by], doc[by]
        n = len(anchor)
        new_anchor = np.append(True, anchor[1:] != anchor[:-1])
        new_key = new_anchor | np.append(True, key[1:] != key[:-1])
        at, run = np.flatnonzero(new_anchor), np.cumsum(new_anchor) - 1
        flagged = np.zeros(len(at), bool)
        flagged[run[key == 0]] = True
        shared = np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)
        least = doc[np.flatnonzero(new_key)][np.cumsum(new_key) - 1]
        hot = flagged[run] & (key != 0)
        cold = ~flagged[run]
        whole = cold & (doc > least)
        part = cold & new_key & shared[run]
        for kind, rows in ((8, hot), (5, whole), (6, part)):
            if rows.any():
                yield _table(kind, doc[rows], key[rows], anchor[rows])

    at, held = None, []
    for batch in batches:
        for bucket, kind, payload, digests in zip(*[c.to_pylist() for c in batch.columns]):
            if bucket != at:
                if held:
                    yield from finish(held)
                at, held = bucket, []
            if kind == 0:
                held.append(payload)
            elif kind == 8:
                t = np.frombuffer(payload, np.int64).reshape(-1, 3)
                yield _table(8, t[:, 2], t[:, 1], t[:, 0])
            else:
                t = np.frombuffer(payload, np.int64).reshape(-1, 2)
                yield _table(2, t[:, 0], t[:, 1], t[:, 1], digests)
    if held:
        yield from finish(held)


def _listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, entry) of all entries of a column of lists of whole numbers."""
    ends = np.append(0, np.cumsum(np.array(column.value_lengths().fill_null(0), np.int64)))
    return np.repeat(np.arange(len(column)), np.diff(ends)), np.array(column.flatten(), np.int64)


def _held(s: Segments, rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The first segment of each document with each of its listed keys."""
    if not len(keys):
        return np.zeros(0, np.int64)
    name = lambda row, key: mix(key.view(U) ^ mix(row.astype(U)), 9)
    own = name(s.doc, s.key)
    hit = np.flatnonzero(np.isin(own, name(rows, keys)))
    return np.sort(hit[np.unique(own[hit], return_index=True)[1]])


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of runs of given sizes, one run after the other."""
    ends = np.cumsum(size)
    return np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _contents(window: int, shards: int):
    """(shard, id, key, at, many, content) of the segments, or single windows of common ones, that shards index."""

    def run(batches):
        for batch in batches:
            ids = np.array(batch.column(0), np.int64)
            lists = [_listed(batch.column(k)) for k in (3, 4)]
            for first, last, buf, offs in slices(batch.column(1), SLICE_BYTES):
                s = Segments(buf, offs, window)
                part, single = (_held(s, rows[on] - first, keys[on]) for rows, keys in lists for on in [slice(*np.searchsorted(rows, [first, last]))])
                split = np.repeat(single, s.many[single])
                at = _runs(np.zeros(len(single), np.int64), s.many[single])
                lone = s.win[split] + at
                whole = s.each[lone] * U(3)  # as chained() does, of these windows alone
                for j in range(1, window):
                    whole = mix(whole + s.each[lone + j], j)
                begin = np.append(s.win[part], lone)
                many = np.append(s.many[part], np.ones(len(split), np.int64))
                shard = np.append(s.anchor[part], whole) % U(shards)
                rows = np.append(part, split)
                size = many + window - 1
                flat = s.each[_runs(begin, size)]
                offsets = np.append(0, np.cumsum(8 * size)).astype(np.int32)
                content = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])
                yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int64)), pa.array(ids[first + s.doc[rows]]), pa.array(s.key[rows].view(np.int64)), pa.array(np.append(np.zeros(len(part), np.int64), at)), pa.array(many), content], names=["shard", "id", "key", "at", "many", "content"])

    return run


def _shards(batches):
    """The rows of each shard, from batches sorted by it, as one list of record batches."""
    held, at = [], None
    for batch in batches:
        shard = np.array(batch.column(0), np.int64)
        cut = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]).astype(np.int64) if len(shard) else np.zeros(0, np.int64)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if held and shard[a] != at:
                yield held
                held = []
            at = shard[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield held


def _match(window: int):
    """(id, key, at) of each repeated window: one FM-index for each shard, and the shard's segments streamed past it."""

    def words_of(column: pa.Array) -> np.ndarray:
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(U) if ends[-1] > ends[0] else np.zeros(0, U)

    def run(batches):
        for rows in _shards(batches):
            ids, key, at, many = (np.concatenate([np.array(r.column(k), np.int64) for r in rows]) for k in (1, 2, 3, 4))
            sizes = many + window - 1
            index = FmIndex(np.concatenate([words_of(r.column(5)) for r in rows]), sizes, window)
            row = np.repeat(np.arange(len(ids)), many)
            k = _runs(np.zeros(len(ids), np.int64), many)
            length, low, high = index.statistics((np.cumsum(sizes) - sizes)[row] + k + window - 1, window)
            hit = np.flatnonzero(length >= window)
            hit = hit[index.least(ids, low[hit], high[hit]) < ids[row[hit]]]
            yield pa.RecordBatch.from_arrays([pa.array(ids[row[hit]]), pa.array(key[row[hit]]), pa.array(at[row[hit]] + k[hit])], names=["id", "key", "at"])

    return run


def _cut(window: int):
    """(id, n_words, n_removed, kept_sha256) of documents with repeated windows."""

    def run(batches):
        for batch in batches:
            whole, some = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for first, last, buf, offs in slices(batch.column(1), SLICE_BYTES):
                s = Segments(buf, offs, window)
                key, edge = s.key.view(np.int64), np.searchsorted(s.doc, np.arange(last - first + 1))
                cover = np.zeros(len(s.starts) + 1, np.int64)
                for d in range(last - first):
                    own = np.arange(edge[d], edge[d + 1])
                    hit = own[np.isin(key[own], whole[first + d] or [])]
                    np.add.at(cover, s.win[hit], 1)
                    np.add.at(cover, s.win[hit] + s.many[hit] + window - 1, -1)
                    if some[first + d]:
                        at: dict[int, list[int]] = {}
                        for x in some[first + d]:
                            at.setdefault(x["key"], []).append(x["at"])
                        for j in own[np.isin(key[own], list(at))].tolist():
                            for k in at[int(key[j])]:
                                cover[s.win[j] + k] += 1
                                cover[s.win[j] + k + window] -= 1
                keep = np.cumsum(cover[:-1]) == 0
                kept = _per(keep, s)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(s.counts), pa.array(s.counts - kept), pa.array(_joined(buf, offs, s, keep))], names=["id", "n_words", "n_removed", "kept_sha256"])

    return run


def repeated_passages(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) after every word is removed that a repeated window covers.

    A window is repeated where its words also stand in a document with a smaller id.
    Windows are judged on the input.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "passages")
    plain = docs.where(docs[id_col].isNotNull()).select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    tasks = tasks_for(docs, 6 << 20)
    buckets = 1 << max(8, (4 * tasks - 1).bit_length())
    sent = spread(plain).mapInArrow(tidy(_send(window, buckets)), "bucket long, kind int, payload binary, digests array<string>")
    got = scratch.save(sent.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_receive), SCHEMA), "shards")
    of = lambda kind: got.where(F.col("kind") == kind)
    nameless = docs.where(docs[id_col].isNull()).select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"), F.lit(None).cast("array<long>").alias("whole"), F.lit(None).cast("array<struct<key:long,at:long>>").alias("some"))
    cut = lambda rows: rows.mapInArrow(tidy(_cut(window)), "id long, n_words long, n_removed long, kept_sha256 string")
    untouched = of(2).select(F.col("a").alias("id"), F.col("b").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.col("digest").alias("kept_sha256")).unionByName(cut(nameless))

    common = of(8).select(F.col("a").alias("id"), F.col("b").alias("key"))
    firsts = scratch.save(common.groupBy("key").agg(F.min("id").alias("least")), "firsts")
    told = of(5).select(F.col("a").alias("id"), F.col("b").alias("key"), F.lit(0).alias("what"))
    told = told.unionByName(common.join(firsts, "key").where("id > least").select("id", "key", F.lit(0).alias("what")))
    told = told.unionByName(of(6).select(F.col("a").alias("id"), F.col("b").alias("key"), F.lit(1).alias("what")))
    told = told.unionByName(firsts.select(F.col("least").alias("id"), "key", F.lit(2).alias("what")))
    keys = lambda k: F.collect_set(F.when(F.col("what") == k, F.col("key")))
    marks = scratch.save(told.groupBy("id").agg(keys(0).alias("whole"), keys(1).alias("part"), keys(2).alias("single")), "marks")
    head = marks.agg(F.count("*").alias("n"), F.sum(F.size("part") + 8 * F.size("single")).alias("segments")).first()
    if not head["n"]:
        return untouched.withColumnRenamed("id", id_col)
    some = plain
    if head["n"] <= BROADCAST_IDS:  # the texts of other documents need not move
        some = plain.join(F.broadcast(marks.select("id")), "id", "left_semi")
    work = scratch.save(some.join(marks, "id"), "work")

    shards = max(1, -(-(head["segments"] or 0) // SHARD))
    asked = work.where(F.size("part") + F.size("single") > 0)
    parts = asked.mapInArrow(tidy(_contents(window, shards)), "shard long, id long, key long, at long, many long, content binary")
    found = parts.repartition(max(8, min(shards, 4 * tasks)), "shard").sortWithinPartitions("shard").mapInArrow(tidy(_match(window)), "id long, key long, at long")
    found = scratch.save(found.distinct().groupBy("id").agg(F.collect_list(F.struct("key", "at")).alias("some")), "found")
    scratch.keep(got, marks, work, found)
    touched = cut(work.join(found, "id", "left").select("id", "text", "whole", "some"))
    return untouched.join(marks.select("id"), "id", "left_anti").unionByName(touched).withColumnRenamed("id", id_col)
