"""Token-id files: frequency-ranked ids, byte-aligned lengths and separate control bytes.

A file holds a run of documents in ascending id order.  Each id is replaced by its
rank among the file's ids by falling frequency, so that common ids take one byte;
two-bit length codes stand apart from the data bytes, four to a control byte, and a
table lookup gives the lengths of four ids at once when a file is read.

Layout, little-endian: magic, documents, ids, distinct ids (8 bytes each); document
ids; document lengths; ids by rank (4 bytes each); control bytes; data bytes.

Rows: every row is written, also repeated ones and null or empty texts (the end id
alone).  Rows of equal id are ordered by text; a null id comes first and is read
back as null.  Columns other than id and text are not read.  With ``added_tokens`` ids
are what the library gives by default, so that an added token of the tokenizer that
stands in a text is one id; without, it is encoded like any other characters.

Where pyarrow opens the folder, files stand in it under their names.  For folders that
only Spark opens, the same bytes stand in the list of files, which Spark writes.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship, tasks_for
from .arrays import slices
from .pieces import Units, kept

MAGIC = b"SYLTOK01"
#: Ids in one file, at least, before the next is begun.
FILE_IDS = 2_000_000
#: Up to so many rows of the file list are broadcast; a longer list is joined by a shuffle.
BROADCAST_FILES = 200_000
NULL_ID = -(2**63)
_LENGTHS = np.array([[1 + (b >> 2 * k & 3) for k in range(4)] for b in range(256)], np.uint8)


def pack(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one file."""
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    by_rank = np.argsort(-counts, kind="stable")[: int((counts > 0).sum())]
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    ranks = rank_of[ids]
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    for bound in (0xFF, 0xFFFF, 0xFFFFFF):
        codes[: len(ranks)] += ranks > bound
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    begin = np.cumsum(codes[: len(ranks)], dtype=np.int64) + np.arange(len(ranks)) - codes[: len(ranks)]
    data = np.zeros(int(begin[-1]) + 1 + int(codes[len(ranks) - 1]) if len(ranks) else 0, np.uint8)
    data[begin] = ranks.astype(np.uint8)
    for k in range(1, 4):
        has = np.flatnonzero(codes[: len(ranks)] >= k)
        if not len(has):
            break
        data[begin[has] + k] = (ranks[has] >> np.uint32(8 * k)).astype(np.uint8)
    head = np.array([len(doc_ids), len(ids), len(by_rank)], "<i8").tobytes()
    return b"".join([MAGIC, head, doc_ids.astype("<i8").tobytes(), sizes.astype("<i8").tobytes(), by_rank.astype("<u4").tobytes(), control.tobytes(), data.tobytes()])


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, their numbers of ids, all ids) of one file."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token-id file")
    docs, n, distinct = np.frombuffer(raw, "<i8", 3, 8).tolist()
    at = 32
    doc_ids = np.frombuffer(raw, "<i8", docs, at)
    sizes = np.frombuffer(raw, "<i8", docs, at := at + 8 * docs)
    by_rank = np.frombuffer(raw, "<u4", distinct, at := at + 8 * docs)
    control = np.frombuffer(raw, np.uint8, -(-n // 4), at := at + 4 * distinct)
    data = np.frombuffer(raw, np.uint8, -1, at + len(control))
    length = _LENGTHS[control].ravel()[:n]
    begin = np.cumsum(length, dtype=np.int64) - length
    ranks = data[begin].astype(np.uint32)
    for k in range(1, 4):
        has = np.flatnonzero(length > k)
        if not len(has):
            break
        ranks[has] |= data[begin[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return doc_ids, sizes, by_rank[ranks].astype("<u4")


def opened(folder: str):
    """(pyarrow's file system, path) of a folder; None where pyarrow can't open it."""
    from pyarrow import fs

    for scheme in ("s3a://", "s3n://"):
        folder = folder.replace(scheme, "s3://", 1) if folder.startswith(scheme) else folder
    try:
        return fs.FileSystem.from_uri(folder)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None


def publish(store, base: str, name: str, attempt: int, data: bytes) -> None:
    """Let a whole file appear under its name; where an earlier attempt at the task wrote it, that one stays."""
    from pyarrow import fs

    there = lambda: store.get_file_info(f"{base}/{name}").type == fs.FileType.File
    if there():
        return
    own = f"{base}/_{name}.{attempt}"
    with store.open_output_stream(own) as out:
        out.write(data)
    try:
        store.move(own, f"{base}/{name}")
    except OSError:
        if not there():
            raise
        store.delete_file(own)


def write_token_files(docs: DataFrame, folder: str, tokenizer_file: str, pattern: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS, added_tokens: bool = False) -> DataFrame:
    """Write the files below ``folder``; the list of files (name, n_docs, n_ids), by name in document order.

    The list has the bytes too (content), but they are null where the files stand in the folder.

    Rows are dealt out by ranges of the id, so one shuffle orders the whole corpus.
    A file appears under its name only when it is whole, and a repeated task writes
    the same bytes again, so that lost executors leave no trace.
    """
    spark = docs.sparkSession
    ship(spark)

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext
        from tokenizers import Tokenizer

        def tools():
            tokenizer = Tokenizer.from_file(tokenizer_file)
            tokenizer.encode_special_tokens = not added_tokens
            added = [t.content for t in tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
            holds = re.compile("|".join(map(re.escape, added)) or r"(?!)").search

            def plain(texts):
                rows = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                size = np.fromiter(map(len, rows), np.int64, len(rows))
                return np.fromiter(chain.from_iterable(rows), np.int32, int(size.sum())), size

            lead = np.array([t.startswith("Ġ") for _, t in sorted((i, t) for t, i in tokenizer.get_vocab().items())])

            def encode(pieces):
                """Words after a space go to the library many at a time: the ids that begin with a space part them again."""
                word = np.fromiter((p[0] == " " and p[1:].isalpha() for p in pieces), bool, len(pieces))
                words, rest = np.flatnonzero(word), np.flatnonzero(~word)
                many = [pieces[k] for k in words.tolist()]
                a, _ = plain(["".join(many[k : k + 64]) for k in range(0, len(many), 64)])
                b, b_size = plain([pieces[k] for k in rest.tolist()])
                begin = np.flatnonzero(lead[a])
                assert len(begin) == len(many)
                size = np.zeros(len(pieces), np.int64)
                size[words], size[rest] = np.diff(np.append(begin, len(a))), b_size
                start = np.zeros(len(pieces), np.int64)
                start[words], start[rest] = begin, len(a) + np.cumsum(b_size) - b_size
                ends = np.cumsum(size)
                return np.append(a, b)[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)], size

            units = Units(pattern, encode)

            def whole(texts):
                """Texts that hold an added token go to the library as they are, since it finds those before it cuts."""
                odd = [k for k, t in enumerate(texts) if holds(t)]
                if not odd:
                    return units.ids(texts)
                flat, per = units.ids(["" if holds(t) else t for t in texts])
                ids, size = plain([texts[k] for k in odd])
                flat = np.insert(flat, np.repeat(np.cumsum(per)[odd], size), ids)
                per[odd] = size
                return flat, per

            return whole

        ids_of = kept(("library", tokenizer_file, pattern, added_tokens), tools)
        store, base = opened(folder) if direct else (None, "")
        part, done = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush():
            nonlocal done
            doc_ids, sizes, ids = (np.concatenate(x) for x in zip(*held))
            held.clear()
            name = f"{part:07d}-{done:06d}.tok"
            done += 1
            data = pack(doc_ids, sizes, ids)
            if store is not None:
                publish(store, base, name, TaskContext.get().taskAttemptId(), data)
            content = pa.array([data if store is None else None], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(doc_ids)]), pa.array([len(ids)]), content], names=["name", "n_docs", "n_ids", "content"])

        for batch in batches:
            column = batch.column(1)
            doc_ids = np.array(batch.column(0).fill_null(NULL_ID))
            for first, last, _, _ in slices(column, 4 << 20):
                flat, per = ids_of(["" if t is None else t for t in column.slice(first, last - first).to_pylist()])
                ids = np.insert(flat, np.cumsum(per), end_id)
                held.append((doc_ids[first:last], per + 1, ids))
                if sum(len(x[2]) for x in held) >= file_ids:
                    yield flush()
        if held:
            yield flush()

    direct = opened(folder) is not None
    if direct:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    rows = rows.repartitionByRange(tasks_for(docs, 16 << 20), "id").sortWithinPartitions("id", "text")
    return rows.mapInArrow(run, "name string, n_docs long, n_ids long, content binary")


def read_token_files(files: DataFrame, folder: str, digests: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids), or a crc32 of the ids instead of them, from the files that a list names.

    ``start`` counts the ids of all files and documents before.
    """
    spark = files.sparkSession
    ship(spark)
    from pyspark.sql import Window

    listed = files.select("name", (F.sum("n_ids").over(Window.orderBy("name")) - F.col("n_ids")).alias("base"))
    if files.count() <= BROADCAST_FILES:
        listed = F.broadcast(listed)
    if files.where("content is not null").limit(1).count():
        raw = files.select("name", "content")
    else:
        raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)
        raw = raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    raw = raw.join(listed, "name")
    what = "ids_crc32 long" if digests else "ids array<int>"

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                doc_ids, sizes, ids = unpack(batch.column(0)[k].as_py())
                ends = np.cumsum(sizes)
                begin = ends - sizes
                if digests:
                    view = memoryview(ids.tobytes())
                    last = pa.array([zlib.crc32(view[4 * b : 4 * e]) for b, e in zip(begin.tolist(), ends.tolist())], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int32)))
                names = pa.array(doc_ids, mask=doc_ids == NULL_ID)
                yield pa.RecordBatch.from_arrays([names, pa.array(begin + batch.column(1)[k].as_py()), pa.array(sizes), last], names=["doc_id", "start", "n_tokens", what.split()[0]])

    return raw.select("content", "base").mapInArrow(run, f"doc_id long, start long, n_tokens long, {what}")


def token_file_report(docs: DataFrame, tokenizer_file: str, pattern: str, added_tokens: bool = False) -> DataFrame:
    """Write all documents, read the files back, and report start, length and crc32 of each document's ids."""
    scratch = Scratch(docs.sparkSession, "tokens")
    folder = f"{scratch.base}/files"
    files = scratch.save(write_token_files(docs, folder, tokenizer_file, pattern, added_tokens=added_tokens), "list")
    if not files.limit(1).collect():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(files, folder, digests=True)
