"""N-gram Jaccard join through R-trees over count vectors.

A document is the set of its distinct word shingles.  The join finds, for documents
whose sets overlap by a given Jaccard share, the components that the links form.

1. Shards.  Two sets that link differ in at most D elements, where D follows from
   the smaller size.  Hash space is cut into somewhat more than D + 1 ranges, so
   some range that isn't empty holds the same elements of both.  Sets that agree on
   a range are candidates; stars over them, not pairs, give candidate components.
   This loses no link, and unrelated texts hardly ever agree on a whole range.
   Sets leave out some ranges, first those of shingles that very many texts share, such as
   lines of licenses: a list of them, counted over the whole table, only ranks ranges.
2. Trees.  In each candidate component, elements are hashed into groups and the
   group counts of every set are a point.  An R-tree over the points bounds the
   overlap of a query with all of a node's sets by the summed minima of the query
   and the node's upper corner; only sets under nodes that could reach the needed
   overlap are verified, element by element.  Sets already connected are passed by.
3. Large components.  One too large for a task is first thinned by verifying
   its stars, whose centres several priorities choose.  Sets that share a range and
   are still unconnected are joined with the same trees, page against page where
   many share it, so that no task holds a component.

Rows: one output row per input row with an id.  A null or empty text, or one of
white space, has no shingle and links with nothing.  A text with fewer words than a
shingle is one shingle.  Rows of equal sets are one node.  Repeated ids each have
their row.  Rows with a null id link with nothing, as no component could be named by
one: their row has a null component.  Elements and sets are told apart by 64-bit hashes.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship, spread, tasks_for
from .arrays import SLICE_BYTES, U, chained, mix, slices, span_hashes, tidy, words
from .components import connected_components

GROUPS = 256
#: Groups of the second, finer bound that pairs pass before their elements move.
FINE = 4096
#: Sets of one key that a task joins at most on either side, where a component is too large for one task.
PAGE = 1024
#: Further rounds of stars for keys of more sets than a page, before what is apart is compared in full.
THINNING = 1
#: Up to this many candidate ids are broadcast to pick their texts; more are joined by a shuffle.
BROADCAST_IDS = 300_000
#: Sets, and elements of all of them, of a candidate component that one task takes whole.
SMALL, ELEMENTS = 4096, 4_000_000
#: Shingles that rank ranges as common ones: those that a task meets ``LOCAL`` times among ``COUNTED`` shingles, and all
#: tasks ``SHARED`` times, up to so many, the most frequent first.  Which these are is a matter of volume, not of results.
COMMON, LOCAL, SHARED, COUNTED = 65_536, 3, 12, 2_000_000
#: Pairs that a task remembers, so as to name them once: a matter of volume, not of results.
TOLD = 500_000
#: (key, set) entries that a map task combines before it sends them on.
BUFFER = 250_000


def shingle_sets(buf: np.ndarray, offs: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; A-Z count as a-z."""
    starts, ends, counts = words(buf, offs)
    each = span_hashes(buf, starts, ends, lower=True) if len(starts) else np.zeros(0, U)
    rows = chained(each, width)
    first = np.cumsum(counts) - counts
    out = []
    for a, n in zip(first.tolist(), counts.tolist()):
        if n >= width:
            out.append(np.unique(rows[a : a + n - width + 1]))
        elif n:
            out.append(chained(each[a : a + n], n) ^ U(n))
        else:
            out.append(np.zeros(0, U))
    return out


class Ranges:
    """Size classes, and the ranges of hash space whose contents are a set's keys."""

    def __init__(self, num: int, den: int, common: np.ndarray | None = None):
        """``common``: sorted elements that count for little where ranges are chosen."""
        self.num, self.den, self.common = num, den, common
        self.upper: list[int] = []
        self.cache: dict[int, np.ndarray] = {}

    def differ(self, n: int) -> int:
        """The most elements by which a set of n and one no smaller can differ and link."""
        return n * (self.den - self.num) // self.num

    def class_of(self, n: int) -> int:
        while not self.upper or self.upper[-1] < n:
            low = self.upper[-1] + 1 if self.upper else 1
            self.upper.append(max(low, low * 3 // 2))
        return int(np.searchsorted(self.upper, n))

    def spare(self, c: int) -> int:
        """Ranges beyond those needed, so that a set may do without its poorest ones."""
        d = self.differ(self.upper[c])
        return 3 + d // 4 if d else 0

    def parts(self, c: int) -> int:
        return self.differ(self.upper[c]) + 1 + self.spare(c)

    def _cuts(self, k: int) -> np.ndarray:
        if k not in self.cache:
            self.cache[k] = np.array([(i << 64) // k for i in range(1, k)], U)
        return self.cache[k]

    def keys(self, own: np.ndarray) -> np.ndarray:
        """Keys of a sorted set: in its class, and in lower classes whose sets it can link with.

        A class's smaller sets differ in less, so a set takes only as many of the
        ranges as its own size asks.  Two sets that link agree on more ranges than are
        to spare.  Each leaves out its poorest ranges, of few elements that aren't common and
        then of few elements, no more than are to spare; as what a range holds tells how poor
        it is, the set that leaves out the richer ones still has a range that agrees, and the
        other, which leaves out poorer ones only, has it too.
        """
        n, out = len(own), []
        c = home = self.class_of(n)
        sums = np.append(U(0), np.cumsum(mix(own, 1)))
        rare = np.arange(n + 1)
        if self.common is not None and len(self.common):
            place = np.searchsorted(self.common, own)
            place[place == len(self.common)] = 0
            rare = np.append(0, np.cumsum(self.common[place] != own))
        while c >= 0 and (c == home or self.upper[c] * self.den >= self.num * n):
            k, spare = self.parts(c), self.spare(c)
            m = min(k, self.differ(n) + 1 + spare) if c == home else k
            at = np.concatenate([[0], np.searchsorted(own, self._cuts(k)[: m if m < k else k - 1]), [n] if m == k else []]).astype(np.int64)[: m + 1]
            total, held = sums[at[1:]] - sums[at[:-1]], np.diff(at)
            key = mix(total + np.arange(m, dtype=U) * U(0xD6E8FEB86659FD93), c + 2)
            rich = (rare[at[1:]] - rare[at[:-1]] << 31) + held
            out.append(key[rich >= np.partition(rich, spare)[spare]])
            c -= 1
        return np.concatenate(out)


def _centred(keys: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, their centres, edges): a star over the sets of each key, as rows of set, centre and key.

    One of four priorities, which the key picks, chooses the centre: the sets of a
    component meet the same few centres again and again, yet more than one.
    """
    order = mix(sets ^ mix(keys & U(3)), 7)
    by = np.lexsort((order, keys))
    keys, sets = keys[by], sets[by]
    new = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    centre = sets[np.flatnonzero(new)][np.cumsum(new) - 1] if len(keys) else sets
    edge = sets != centre
    edge &= new | np.append(True, sets[1:] != sets[:-1]) if len(keys) else edge  # equal sets of a key lie together
    return keys[new], centre[new], np.column_stack([sets[edge], centre[edge], keys[edge]])


def _frequent(width: int):
    """(element, n) of the shingles that many of a task's texts hold."""

    def run(batches):
        held, size = [], 0

        def flush():
            element, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(element[n >= LOCAL].view(np.int64)), pa.array(n[n >= LOCAL].astype(np.int64))], names=["element", "n"])

        for batch in batches:
            for _, _, buf, offs in slices(batch.column(0), SLICE_BYTES):
                for s in shingle_sets(buf, offs, width):
                    held.append(s)
                    size += len(s)
                if size >= COUNTED:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def common_shingles(texts: DataFrame, width: int) -> np.ndarray:
    """The sorted hashes of shingles that very many of all the texts share."""
    found = texts.mapInArrow(tidy(_frequent(width)), "element long, n long").groupBy("element").agg(F.sum("n").alias("n")).where(F.col("n") >= SHARED)
    top = found.orderBy(F.desc("n"), "element").limit(COMMON).select("element").collect()
    return np.sort(np.array([r[0] for r in top], np.int64).view(U))


def _send(width: int, num: int, den: int, buckets: int, common: np.ndarray | None = None):
    """Map side: (bucket, kind, payload) with keys (0), edges (1) and documents (2)."""

    def rows(kind: int, bucket: np.ndarray, columns: list[np.ndarray]):
        by = np.argsort(bucket, kind="stable")
        bucket, table = bucket[by], np.column_stack([c[by].view(np.int64) for c in columns])
        cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)) if len(bucket) else np.zeros(1, np.int64)
        payload = [table[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]].astype(np.int64)), pa.array(np.full(len(payload), kind, np.int32)), pa.array(payload, pa.binary())], names=["bucket", "kind", "payload"])

    def run(batches):
        ranges, held, docs, size = Ranges(num, den, common), [], [], 0

        def flush():
            keys, sets = np.concatenate([k for k, _ in held]), np.concatenate([np.full(len(k), s, U) for k, s in held])
            held.clear()
            keys, centres, edges = _centred(keys, sets)
            yield rows(0, keys % U(buckets), [keys, centres])
            yield rows(1, edges[:, 2] % U(buckets), list(edges.T))

        for batch in batches:
            ids = np.array(batch.column(0), np.int64)
            for first, last, buf, offs in slices(batch.column(1), SLICE_BYTES):
                found = shingle_sets(buf, offs, width)
                n = np.fromiter(map(len, found), np.int64, len(found))
                name = mix(np.array([mix(s, 1).sum(dtype=U) for s in found], U) + n.astype(U), 3)
                yield rows(2, name % U(buckets), [ids[first:last], n, name])
                for s, x in zip(found, name):
                    if len(s):
                        held.append((ranges.keys(s), x))
                        size += len(held[-1][0])
                    if size >= BUFFER:
                        yield from flush()
                        size = 0
        if held:
            yield from flush()

    return run


def _receive(batches):
    """Reduce side: (kind, a, b, c) with edges (1: set, centre, key) and documents (2: id, size, set)."""

    def finish(keys, edges):
        found = [np.frombuffer(p, U).reshape(-1, 3) for p in edges]
        if keys:
            table = np.concatenate([np.frombuffer(p, U).reshape(-1, 2) for p in keys])
            found.append(_centred(table[:, 0], table[:, 1])[2])
        return out(1, list(np.unique(np.concatenate(found), axis=0).view(np.int64).T))

    def out(kind, columns):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int32)), *[pa.array(np.ascontiguousarray(c)) for c in columns]], names=["kind", "a", "b", "c"])

    at, keys, edges = None, [], []
    for batch in batches:
        for bucket, kind, payload in zip(*[c.to_pylist() for c in batch.columns]):
            if bucket != at:
                if keys or edges:
                    yield finish(keys, edges)
                at, keys, edges = bucket, [], []
            if kind == 2:
                yield out(2, list(np.frombuffer(payload, np.int64).reshape(-1, 3).T))
            else:
                (keys if kind == 0 else edges).append(payload)
    if keys or edges:
        yield finish(keys, edges)


class CountTree:
    """An R-tree over group counts, packed by size and then by leading counts."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, fan: int = 8):
        self.order = np.lexsort((counts[:, 0], sizes))
        run = max(1, int(np.ceil(np.sqrt(len(sizes) / fan))) * fan)
        for first in range(0, len(self.order), run):  # within a run of like sizes, by counts
            part = self.order[first : first + run]
            self.order[first : first + run] = part[np.lexsort((counts[part, 2 % GROUPS], counts[part, 1 % GROUPS]))]
        self.kind = np.float32 if sizes.max(initial=0) < 1 << 22 else np.float64  # sums of whole numbers, exact in either
        upper, low, high = counts[self.order].astype(self.kind), sizes[self.order], sizes[self.order]
        self.levels = [(upper, low, high)]
        while len(upper) > 1:
            cut = np.arange(0, len(upper), fan)
            upper, low, high = np.maximum.reduceat(upper, cut, axis=0), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.levels.append((upper, low, high))
        self.fan = fan
        self.ones = np.ones(GROUPS, self.kind)

    def search(self, counts: np.ndarray, size: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, bounds on the overlap) of the sets that may link with a query, best bound first."""
        at, counts = np.zeros(1, np.int64), counts.astype(self.kind)
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, low, high = self.levels[depth]
            fits = (high[at] * den >= num * size) & (num * low[at] <= den * size)
            at = at[fits]
            bound = np.minimum(counts, upper[at]) @ self.ones
            ok = (num + den) * bound.astype(np.float64) >= num * (size + low[at])
            at, bound = at[ok], bound[ok]
            if depth:
                at = (at[:, None] * self.fan + np.arange(self.fan)).ravel()
                at = at[at < len(self.levels[depth - 1][1])]
        by = np.argsort(-bound, kind="stable")
        return self.order[at[by]], bound[by]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def links(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    same = overlap(a, b)
    return den * same >= num * (len(a) + len(b) - same)


#: A group's count from here on is kept as this, and reads as more than any set has.
MOST = 255


def to_point(counts: np.ndarray) -> bytes:
    return np.minimum(counts, MOST).astype(np.uint8).tobytes()


def from_points(raw: list[bytes], groups: int = GROUPS) -> np.ndarray:
    points = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, groups).astype(np.float32)
    points[points == MOST] = np.inf
    return points


def counted(sets: list[np.ndarray], groups: int = GROUPS) -> np.ndarray:
    """Group counts of each set; ``groups`` is a power of two."""
    shift = U(65 - groups.bit_length())
    return np.array([np.bincount((s >> shift).astype(np.int64), minlength=groups) for s in sets], np.int64).reshape(-1, groups)


def near_points(left, right, sizes_left, sizes_right, labels_left, labels_right, num: int, den: int):
    """(place in left, places in right, best bound first) of what may link across labels; right None: within left, once."""
    own = right is None
    if own:
        right, sizes_right, labels_right = left, sizes_left, labels_left
    tree = CountTree(right, sizes_right)
    for i in range(len(left)):
        at = tree.search(left[i], int(sizes_left[i]), num, den)[0]
        at = at[labels_right[at] != labels_left[i]]
        yield i, at[at < i] if own else at


def tree_join(sets: list[np.ndarray], num: int, den: int) -> list[int]:
    """For each set the least place that links connect it with."""
    sizes, root = np.array([len(s) for s in sets]), np.arange(len(sets))
    for i, near in near_points(counted(sets), None, sizes, None, np.arange(len(sets)), None, num, den):
        for j in near.tolist():
            a, b = root[i], root[j]
            if a != b and links(sets[i], sets[j], num, den):
                root[root == max(a, b)] = min(a, b)
    return root.tolist()


def _sets_of(width: int):
    def run(batches):
        told: set[int] = set()  # rows of a repeated id and text count once in a task
        for batch in batches:
            node = np.array(batch.column(1), np.int64)
            for first, last, buf, offs in slices(batch.column(0), SLICE_BYTES):
                found = shingle_sets(buf, offs, width)
                name = mix(np.array([mix(s, 1).sum(dtype=U) for s in found], U) + np.array([len(s) for s in found], U), 3).view(np.int64)
                ok = name == node[first:last]  # a repeated id may name another text
                for i in np.flatnonzero(ok).tolist():
                    ok[i] = int(name[i]) not in told
                    told.add(int(name[i]))
                rows = batch.slice(first, last - first).filter(pa.array(ok))
                yield pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), rows.column(3), pa.array([s.tobytes() for s, k in zip(found, ok) if k], pa.binary())], names=["node", "comp", "small", "elements"])

    return run


def _sizes(width: int):
    """(null, size, null) of the set of each text."""

    def run(batches):
        for batch in batches:
            for _, _, buf, offs in slices(batch.column(0), SLICE_BYTES):
                n = pa.array([len(s) for s in shingle_sets(buf, offs, width)], pa.int64())
                none = pa.nulls(len(n), pa.int64())
                yield pa.RecordBatch.from_arrays([none, n, none], names=["id", "n", "component_id"])

    return run


def _by_key(batches, key: str):
    """Runs of rows of equal key, from rows sorted by it."""
    held, at = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[key] != at:
                yield at, held
                held = []
            at = row[key]
            held.append(row)
    if held:
        yield at, held


def _pairs(rows: list[tuple[int, int]], names: tuple[str, str]):
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], names=list(names))


def near_groups(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): sets link when ``den * intersection >= num * union``.

    ``component_id`` is the least id that links reach.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "jaccard")
    plain = docs.where(docs[id_col].isNotNull()).select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    tasks = tasks_for(docs, 6 << 20)
    buckets = 1 << max(8, (4 * tasks - 1).bit_length())
    common = common_shingles(spread(plain).select("text"), width)
    sent = spread(plain).mapInArrow(tidy(_send(width, num, den, buckets, common)), "bucket long, kind int, payload binary")
    got = scratch.save(sent.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_receive), "kind int, a long, b long, c long"), "shards")
    members = got.where("kind = 2").select(F.col("a").alias("id"), F.col("b").alias("n"), F.col("c").alias("node"))
    edges = got.where("kind = 1").select("a", "b", F.col("c").alias("key"))

    if edges.limit(1).collect():
        classes = _classes(plain, members, edges, scratch, width, num, den, tasks)
        members = scratch.save(members.join(classes, "node", "left").select("id", "n", F.coalesce("class", "node").alias("class")), "members")
        scratch.keep(members)
    else:
        members = members.withColumnRenamed("node", "class")
    names = scratch.save(members.where("n > 0").groupBy("class").agg(F.min("id").alias("component_id")), "names")
    some = members.where("n > 0").join(names, "class").select("id", "n", "component_id")
    alone = members.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    nameless = docs.where(docs[id_col].isNull()).select(docs[text_col].alias("text")).mapInArrow(tidy(_sizes(width)), "id long, n long, component_id long")
    return some.unionByName(alone).unionByName(nameless).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _classes(plain, members, edges, scratch, width, num, den, tasks) -> DataFrame:
    """(node, class) of every set that is a candidate for a link."""
    spark = plain.sparkSession
    labels = connected_components(edges, scratch)
    firsts = scratch.save(members.join(labels, "node").groupBy("node", F.col("label").alias("comp")).agg(F.min("id").alias("id"), F.max("n").alias("n")), "firsts")
    sizes = firsts.groupBy("comp").agg(F.count("*").alias("sets"), F.sum("n").alias("elements"))
    sizes = scratch.save(sizes.select("comp", ((F.col("sets") <= SMALL) & (F.col("elements") <= ELEMENTS)).alias("small")), "sizes")
    firsts = scratch.save(firsts.join(sizes, "comp").select("id", "node", "comp", "small"), "firsts")
    picked = F.broadcast(firsts) if firsts.count() <= BROADCAST_IDS else firsts
    texts = plain.join(picked, "id").select("text", "node", "comp", "small")
    sets = scratch.save(texts.mapInArrow(tidy(_sets_of(width)), "node long, comp long, small boolean, elements binary"), "sets")

    def small(batches):
        for _, rows in _by_key(batches, "comp"):
            found = [np.frombuffer(r["elements"], U) for r in rows]
            root = tree_join(found, num, den)
            yield _pairs([(r["node"], rows[k]["node"]) for r, k in zip(rows, root)], ("node", "class"))

    little = sets.where("small").select("comp", "node", "elements").repartition(tasks, "comp").sortWithinPartitions("comp").mapInArrow(tidy(small), "node long, class long").distinct()
    if not sizes.where("not small").limit(1).collect():
        return little
    return little.unionByName(_large(firsts.where("not small").select("node"), sets.where("not small"), edges, scratch, num, den, tasks))


def _large(nodes, sets, edges, scratch, num, den, tasks) -> DataFrame:
    """(node, class) in components of more sets than a page."""
    sets = sets.select("node", "elements")

    def to_points(groups):
        def run(batches):
            for batch in batches:
                for first in range(0, batch.num_rows, 256):
                    part = batch.slice(first, 256)
                    found = [np.frombuffer(x.as_py(), U) for x in part.column(1)]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array([to_point(row) for row in counted(found, groups)], pa.binary())], names=["node", "n", "point"])

        return tidy(run)

    made = lambda groups: scratch.save(sets.mapInArrow(to_points(groups), "node long, n long, point binary"), "points")
    points, fine = made(GROUPS), made(FINE)

    def bounded(groups):
        def run(batches):
            for batch in batches:
                for first in range(0, batch.num_rows, 256):
                    part = batch.slice(first, 256)
                    a, b = (np.array(part.column(k), np.int64) for k in (2, 4))
                    x, y = (from_points(part.column(k).to_pylist(), groups) for k in (3, 5))
                    ok = (np.minimum(a, b) * den >= np.maximum(a, b) * num) & ((num + den) * np.minimum(x, y).sum(axis=1, dtype=np.float64) >= num * (a + b))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(ok))

        return tidy(run)

    def verify(batches):
        centre = None
        for batch in batches:
            kind, node, at = (batch.column(k).to_pylist() for k in (1, 2, 0))
            found = []
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column(3)[i].as_buffer(), U)
                if not kind[i]:
                    centre = own.copy()
                elif links(own, centre, num, den):
                    found.append((node[i], at[i]))
            yield _pairs(found, ("a", "b"))

    def both(pairs, table, columns):
        """Pairs with what the table has of either end: it is read once, and only what pairs name moves, once."""
        ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node"))
        ends = F.broadcast(ends) if pairs.count() <= BROADCAST_IDS else ends
        side = lambda s, c: F.first(F.when(F.col("node") == F.col(s), F.col(c)), ignorenulls=True).alias(f"{c}_{s}")
        return table.join(ends, "node").groupBy("a", "b").agg(*[side(s, c) for s in "ab" for c in columns])

    def connect(marked, pairs):
        """``marked`` after the links among the pairs.  Sets meet only if their sizes and points allow it."""
        near = scratch.save(both(pairs, points, ["n", "point"]).mapInArrow(bounded(GROUPS), "a long, b long"), "bounded")
        near = scratch.save(both(near, fine, ["n", "point"]).mapInArrow(bounded(FINE), "a long, b long"), "bounded")
        # a set moves once to the set that it is compared with, and that one once for each thousand
        shares = near.groupBy("b").agg(F.ceil(F.count("*") / 1000).alias("shares"))
        centres = shares.select(F.col("b").alias("at"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), F.lit(0).alias("kind"), F.col("b").alias("node"))
        others = near.join(shares, "b").select(F.col("b").alias("at"), F.pmod(F.xxhash64("a"), "shares").alias("share"), F.lit(1).alias("kind"), F.col("a").alias("node"))
        asked = scratch.save(centres.unionByName(others), "asked")
        asked = F.broadcast(asked) if asked.count() <= 2 * BROADCAST_IDS else asked
        rows = sets.join(asked, "node").repartition(tasks, "at", "share").sortWithinPartitions("at", "share", "kind")
        found = scratch.save(rows.select("at", "kind", "node", "elements").mapInArrow(tidy(verify), "a long, b long").distinct(), "links")
        return _relabelled(marked, found, scratch)

    stars = scratch.save(edges.join(nodes.select(F.col("node").alias("a")), "a", "left_semi").select("a", "b", "key"), "stars")
    pairs = scratch.save(stars.select("a", "b").distinct(), "pairs")
    marked = connect(nodes.select("node", F.col("node").alias("label")), pairs)

    # What a star leaves apart is compared key by key, for sets that link share a key.  The
    # star of a key of two sets has compared them already.
    label = lambda n: marked.select(F.col("node").alias(n), F.col("label").alias(f"label_{n}"))
    apart = scratch.save(pairs.join(label("a"), "a").join(label("b"), "b").where("label_a <> label_b").select("a", "b"), "apart")
    wanted = stars.join(apart, ["a", "b"], "left_semi").select("key").distinct()
    wanted = wanted.join(stars.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key", "left_semi")
    stars = scratch.save(stars.join(scratch.save(wanted, "wanted"), "key", "left_semi"), "open-stars")
    held_by = scratch.save(stars.select("key", F.col("a").alias("node")).unionByName(stars.select("key", F.col("b").alias("node"))).distinct(), "held-by")
    # keys that the same sets hold count once
    same = held_by.groupBy("key").agg(F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"), F.count("*").alias("n"))
    once = scratch.save(same.groupBy("x", "y", "n").agg(F.min("key").alias("key")).select("key"), "once")
    for turn in range(THINNING + 1):
        labelled = scratch.save(held_by.join(marked, "node"), "labelled")
        some = F.min(F.struct(F.xxhash64("node", F.lit(turn), F.pmod("key", F.lit(4))).alias("h"), "node"))
        counts = labelled.groupBy("key", "label").agg(F.count("*").alias("n"), some.alias("some"))
        top = F.max(F.struct("n", "label", "some"))
        groups = scratch.save(counts.groupBy("key").agg(top.alias("top"), F.sum("n").alias("n"), F.count("*").alias("labels")).where("labels > 1").select("key", "n", F.col("top.label").alias("major"), F.col("top.n").alias("most"), F.col("top.some.node").alias("b")).join(once, "key", "left_semi"), "groups")
        large = groups.where(F.col("n") > PAGE)
        if turn == THINNING or not large.limit(1).collect():
            break
        # sets outside a large key's most common label meet one set of it
        minor = labelled.join(large.select("key", "major", "b"), "key").where("label <> major").select(F.col("node").alias("a"), "b")
        marked = connect(marked, scratch.save(minor.distinct(), "minor"))
    if not groups.limit(1).collect():
        return marked.select("node", F.col("label").alias("class"))

    # In one page where few share a key, else pages of the labels other than the key's most
    # common one against all its pages.
    groups = groups.select("key", F.when(F.col("n") > PAGE, F.col("major")).alias("major"), F.ceil((F.col("n") - F.col("most")) / PAGE).cast("int").alias("minor_pages"), F.ceil(F.col("most") / PAGE).cast("int").alias("major_pages"))
    paged = labelled.join(groups, "key").withColumn("is_major", F.col("label").eqNullSafe(F.col("major")))
    pages = F.when(F.col("is_major"), F.col("major_pages")).when(F.col("major").isNotNull(), F.col("minor_pages")).otherwise(1)
    paged = paged.withColumn("page", F.pmod(F.xxhash64("node"), pages).cast("int")).join(points, "node")
    upto = lambda last: F.sequence(F.lit(0), last)
    spot = lambda i, m, j, side: F.struct(i.alias("i"), F.lit(m).alias("m"), j.alias("j"), F.lit(side).alias("side"))
    page = F.col("page")
    as_left = F.concat(F.transform(F.sequence(page, F.col("minor_pages") - 1), lambda j: spot(page, False, j, 0)), F.transform(upto(F.col("major_pages") - 1), lambda j: spot(page, True, j, 0)))
    as_right = F.transform(F.filter(upto(page), lambda i: i < page), lambda i: spot(i, False, page, 1))
    to = F.when(F.col("major").isNull(), F.array(spot(page, False, page, 0))).when(F.col("is_major"), F.transform(upto(F.col("minor_pages") - 1), lambda i: spot(i, True, page, 1))).otherwise(F.concat(as_left, as_right))
    dealt = paged.select("key", "node", "label", "n", "point", F.explode(to).alias("t")).select(F.concat_ws(":", "key", "t.i", F.col("t.m").cast("string"), "t.j").alias("pair"), "t.side", (~F.col("t.m") & (F.col("t.i") == F.col("t.j"))).alias("own"), "node", "label", "n", "point")

    def join(batches):
        told: set[tuple[int, int]] = set()  # pairs of this task, which other keys may name again
        for _, rows in _by_key(batches, "pair"):
            sides = [[r for r in rows if r["side"] == k] for k in (0, 1)]
            grids = [from_points([r["point"] for r in side]) for side in sides]
            sizes, label = ([np.array([r[c] for r in side], np.int64) for side in sides] for c in ("n", "label"))
            if rows[0]["own"]:
                sides[1], near = sides[0], near_points(grids[0], None, sizes[0], None, label[0], None, num, den)
            elif not sides[0] or not sides[1]:
                continue
            else:
                near = near_points(grids[0], grids[1], sizes[0], sizes[1], label[0], label[1], num, den)
            own = {(min(x, y), max(x, y)) for i, at in near for x, y in ((sides[0][i]["node"], sides[1][j]["node"]) for j in at.tolist())} - told
            if len(told) < TOLD:
                told |= own
            yield _pairs(list(own), ("a", "b"))

    near = dealt.repartition(tasks, "pair").sortWithinPartitions("pair").mapInArrow(tidy(join), "a long, b long").distinct()
    return connect(marked, scratch.save(near, "near")).select("node", F.col("label").alias("class"))


def _relabelled(marked: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) after links between nodes join their labels."""
    label = lambda n: marked.select(F.col("node").alias(n), F.col("label").alias(f"label_{n}"))
    edges = links.join(label("a"), "a").join(label("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    edges = scratch.save(edges.where("a <> b").distinct(), "label-links")
    if edges.limit(1).collect():
        merged = connected_components(edges, scratch).select(F.col("node").alias("label"), F.col("label").alias("least"))
        marked = marked.join(merged, "label", "left").select("node", F.coalesce("least", "label").alias("label"))
    return scratch.save(marked, "marked")
