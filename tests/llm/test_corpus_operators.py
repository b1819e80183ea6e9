"""Joins, dedup, search, mixing and formatting against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from syllaspark.llm import arrays, components, fmindex, jaccard, mixing, passages, preference, queries, recipes, topk
from syllaspark.llm.components import connected_components
from syllaspark.session import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _edited(r, n, group, words, edits):
    out = []
    for _ in range(group):
        base = [r.choice("abcdefghijklmnop") + str(r.randint(0, 9)) for _ in range(words)]
        for _ in range(n):
            own = list(base)
            for _ in range(r.choice(edits)):
                own[r.randrange(len(own))] = f"z{r.randint(0, 999)}"
            out.append(" ".join(own))
    return out


def _shingles(text, k):
    w = WORD.findall((text or "").translate(LOW))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def _groups(rows, k, num, den):
    sets = [(i, _shingles(t, k)) for i, t in rows]
    holders = defaultdict(list)
    for n, (_, s) in enumerate(sets):
        for e in s:
            holders[e].append(n)
    common, root = Counter(), list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for own in holders.values():
        common.update((a, b) for i, a in enumerate(own) for b in own[:i])
    for (a, b), n in common.items():
        if den * n >= num * (len(sets[a][1]) + len(sets[b][1]) - n):
            root[find(a)] = find(b)
    least = defaultdict(lambda: 10**18)
    for n, (i, _) in enumerate(sets):
        least[find(n)] = min(least[find(n)], i)
    return sorted((i, len(s), least[find(n)] if s else i) for n, (i, s) in enumerate(sets))


@pytest.mark.parametrize(("k", "num", "den", "page"), [(4, 85, 100, 64), (5, 80, 100, 8)])
def test_jaccard_components(spark, monkeypatch, k, num, den, page):
    monkeypatch.setattr(jaccard, "PAGE", page)
    monkeypatch.setattr(jaccard, "SMALL", page)
    r = random.Random(7)
    texts = _edited(r, 60, 2, 80, [0, 1, 2, 3, 5, 6]) + [" ".join(f"q{r.randint(0, 2)}" for _ in range(r.randint(0, 8))) for _ in range(150)]
    texts += [None, "", " \n", "A B C", "a b c", "a b", "x " * 5000]
    rows = list(enumerate(texts)) + [(3, texts[70]), (3, texts[3])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash")).repartition(3)
    nameless = [(None, "x y z"), (None, texts[0]), (None, None)]
    frame = frame.unionByName(spark.createDataFrame([(*x, "c") for x in nameless], frame.schema))
    whole = [tuple(x) for x in jaccard.near_groups(frame, k, num, den).collect()]
    got = sorted(x for x in whole if x[0] is not None)
    assert got == _groups(rows, k, num, den)
    assert sorted(x for x in whole if x[0] is None) == sorted((None, len(_shingles(t, k)), None) for _, t in nameless)
    assert jaccard.near_groups(frame.where("false"), k, num, den).count() == 0
    if k == 4:
        assert _duck(queries.ORACLES["op1_jaccard"], documents=pd.DataFrame(rows + nameless, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})) == sorted(whole, key=str)


def test_keys_of_linked_sets_meet():
    r = np.random.default_rng(5)
    ranges = jaccard.Ranges(85, 100)
    for _ in range(300):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        change = int(r.integers(0, max(1, len(a) // 6) + 1))
        b = np.unique(np.concatenate([a[change // 2 :], r.integers(0, 2**63, change - change // 2).astype(np.uint64)]))
        if len(b) and jaccard.links(a, b, 85, 100):
            assert np.intersect1d(ranges.keys(a), ranges.keys(b)).size


def test_shared_lines_make_few_candidates(spark, monkeypatch):
    r = np.random.default_rng(8)
    new = lambda n: np.unique(r.integers(0, 2**64 - 1, n, dtype=np.uint64))
    line = new(40)
    plain, ranked = jaccard.Ranges(80, 100), jaccard.Ranges(80, 100, line)
    sets = [np.unique(np.concatenate([new(int(r.integers(60, 200))), line])) for _ in range(60)]
    meet = lambda ranges: sum(np.intersect1d(ranges.keys(a), ranges.keys(b)).size > 0 for i, a in enumerate(sets) for b in sets[:i])
    assert meet(ranked) < meet(plain) / 4
    met = 0
    for s in [*sets, *[x[: int(r.integers(1, 30))] for x in sets], line]:  # no link is lost, whatever is common
        for ranges in (ranked, jaccard.Ranges(80, 100, np.sort(s[::2]))):
            change = int(r.integers(0, len(s) // 5 + 1))
            other = np.unique(np.concatenate([s[change // 2 :], new(change - change // 2)]))
            if jaccard.links(s, other, 80, 100):
                met += 1
                assert np.intersect1d(ranges.keys(s), ranges.keys(other)).size
    assert met > 100
    texts = spark.createDataFrame([(f"a{k} b c d e f{k}",) for k in range(20)] + [(None,), ("",), ("b c d e",)] * 7, "text string").coalesce(1)
    held = lambda t: jaccard.shingle_sets(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]), 3)[0].tolist()
    assert jaccard.common_shingles(texts, 3).tolist() == held("b c d e")
    monkeypatch.setattr(jaccard, "COMMON", 1)
    assert len(jaccard.common_shingles(texts, 3)) == 1 and len(jaccard.common_shingles(texts.where("false"), 3)) == 0


def test_tree_bounds_never_lose_a_link():
    r = np.random.default_rng(6)
    sets = [np.unique(r.integers(0, 2**63, int(n)).astype(np.uint64)) for n in r.integers(1, 200, 60)]
    sets += [np.unique(np.append(s[1:], s[:1] + np.uint64(1))) for s in sets]
    sizes, points = np.array([len(s) for s in sets]), jaccard.counted(sets)
    tree = jaccard.CountTree(points, sizes)
    for i, s in enumerate(sets):
        near = set(tree.search(points[i], len(s), 80, 100)[0].tolist())
        assert {j for j, t in enumerate(sets) if jaccard.links(s, t, 80, 100)} <= near


@pytest.mark.parametrize("one_task", [0, 1_000_000])
def test_components(spark, monkeypatch, one_task):
    monkeypatch.setattr(components, "ONE_TASK", one_task)
    r = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(r.randint(200, 260), r.randint(200, 260)) for _ in range(40)] + [(7, 7)]
    got = {x["node"]: x["label"] for x in connected_components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "t")).collect()}
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    for n in got:
        seen, todo = {n}, [n]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        assert got[n] == min(seen)


def _passages(rows, k):
    first, all_words = {}, [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in all_words:
        for j in range(len(w) - k + 1):
            key = tuple(w[j : j + k])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in all_words:
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            if first[tuple(w[j : j + k])] < i:
                gone[j : j + k] = [True] * k
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("common", "shard"), [(64, 4000), (3, 20)])
def test_passages(spark, monkeypatch, common, shard):
    monkeypatch.setattr(passages, "COMMON", common)
    monkeypatch.setattr(passages, "SHARD", shard)
    r = random.Random(4)
    shared = [" ".join(r.choice("abcdefgh") + str(r.randint(0, 3)) for _ in range(r.randint(5, 60))) for _ in range(8)]
    texts = []
    for _ in range(150):
        t = []
        for _ in range(r.randint(1, 4)):
            t.append(" ".join(r.choice("abc") + str(r.randint(0, 9)) for _ in range(r.randint(0, 20))))
            p = r.choice(shared).split()
            a = r.randint(0, len(p))
            t.append(r.choice([" ", "\n", "  "]).join(p[a : a + r.randint(0, 50)]))
        texts.append(r.choice(["", " ", "\n"]) + " ".join(t) + r.choice(["", " "]))
    texts += [" ".join(r.choice("xy") for _ in range(r.randint(0, 40))) for _ in range(40)] + [None, "", "  ", "é " * 30, "y " * 4000]
    rows = list(enumerate(texts)) + [(5, texts[20]), (900, texts[20]), (900, texts[20])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).repartition(3)
    nameless = [(None, "a"), (None, texts[0]), (None, None)]
    frame = frame.unionByName(spark.createDataFrame([(*x, 1) for x in nameless], frame.schema))
    got = [tuple(x) for x in passages.repeated_passages(frame).collect()]
    assert sorted(x for x in got if x[0] is not None) == _passages(rows, 13)
    assert sorted(x[1:3] for x in got if x[0] is None) == sorted((len(WORD.findall(t or "")), 0) for _, t in nameless)
    assert passages.repeated_passages(frame.where("false")).count() == 0
    assert _duck(queries.ORACLES["op9_passages"], documents=pd.DataFrame(rows + nameless, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})) == sorted(got, key=str)


def test_matching_statistics():
    r = np.random.default_rng(8)
    sizes = r.integers(5, 30, 40)
    flat = r.integers(0, 3, sizes.sum()).astype(np.uint64)
    ends = np.cumsum(sizes)
    begin = ends - sizes
    for limit in (1, 3, 5, 13):
        index = fmindex.FmIndex(flat, sizes, limit)
        last = np.concatenate([np.arange(b + min(limit, e - b) - 1, e) for b, e in zip(begin, ends)])
        length, low, high = index.statistics(last, limit)
        values = r.permutation(40)
        where = defaultdict(list)
        for d, (b, e) in enumerate(zip(begin, ends)):
            for n in range(1, limit + 1):
                for j in range(b, e - n + 1):
                    where[tuple(flat[j : j + n])].append(d)
        room = np.minimum(limit, last - begin[np.searchsorted(ends, last, "right")] + 1)
        want = [max([n for n in range(1, m + 1) if len(where[tuple(flat[e - n + 1 : e + 1])]) > 1], default=0) for e, m in zip(last, room)]
        whole = room == limit
        assert (length[whole] == np.array(want)[whole]).all()
        full = np.flatnonzero(whole & (length == limit))
        for n, least in zip(full, index.least(values, low[full], high[full])):
            own = where[tuple(flat[last[n] - limit + 1 : last[n] + 1])]
            assert least == min(values[own]) and high[n] - low[n] == len(own)


def test_words_that_one_prefix_sum_confuses(spark):
    word = lambda n, flip: "".join("ab"[bin(i).count("1") % 2 ^ flip] for i in range(n))
    texts = []
    for n in (8, 32, 33, 1024, 2048, 4096):
        for flip in (0, 1):
            texts += [" ".join([word(n, flip)] * 2 + ["w" + str(k) for k in range(30)]), word(n, flip)]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(x) for x in jaccard.near_groups(frame, 4, 85, 100).collect()) == _groups(rows, 4, 85, 100)
    assert sorted(tuple(x) for x in passages.repeated_passages(frame).collect()) == _passages(rows, 13)
    buf = "".join(word(2048, f) for f in (0, 1)).encode()
    a, b = arrays.span_hashes(np.frombuffer(buf, np.uint8), np.array([0, 2048]), np.array([2048, 4096]))
    assert a != b


def _vectors(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=6)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(40)] + [(300, None), (350, [1.0, None] + [0.0] * 4), (400, [float("nan")] * 6), (450, [float("inf")] * 6), (500, [1.0, 2.0]), (None, [0.0] * 6), (50, rows[7][1])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0))


def _scores(rows, k=5):
    """(query, rank, id, score) with Python's whole numbers, every row a candidate of its own."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = defaultdict(list)
    for q, v in good:
        if q % 50 == 0:
            found[q] += [(-sum(a * b for a, b in zip(v, w)), c) for c, w in good if c != q and len(w) == len(v)]
    return sorted((q, n, c, -s) for q, own in found.items() for n, (s, c) in enumerate(sorted(own)[:k], 1))


def test_top_k(spark):
    rows, frame = _vectors(spark)
    assert sorted(tuple(x) for x in topk.top_k(frame, F.col("vec_id") % 50 == 0, k=5, shard_rows=40).collect()) == _scores(rows)
    assert topk.top_k(frame.where("false"), F.lit(True)).count() == 0


def test_top_k_equals_its_sql(spark):
    big = [(i, [1.0, float(1e7 + i)]) for i in range(60)] + [(50, [-1.0, 2.0]), (100, [])]
    few = [(0, [1.0, 2.0, 3.0]), *[(1, [3.0, 3.0, 3.0])] * 3, *[(k, [0.1 * k, 1.0, 0.5]) for k in range(2, 10)], (100, []), (7, [])]
    for rows in (few, big, _vectors(spark)[0]):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = sorted(tuple(x) for x in topk.top_k(frame, F.col("vec_id") % 50 == 0, k=5, shard_rows=8).collect())
        table = pd.DataFrame(rows, columns=["vec_id", "embedding"]).astype({"vec_id": "Int64"})
        assert got == sorted(_duck(queries.ORACLES["op3_top_k"], embeddings=table)) == _scores(rows)
    assert [x[2] for x in sorted(_scores(few))[:5]] == [1, 1, 1, 9, 8]


def test_top_k_sums_whole_numbers(spark):
    rows = [(i, [float(2**20 + i), float(-(2**19)), 1 / 256, float(i % 3)] * 4) for i in range(120)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = _scores(rows)
    assert max(abs(x[3]) for x in want) > 2**53
    assert sorted(tuple(x) for x in topk.top_k(frame, F.col("vec_id") % 50 == 0, k=5, shard_rows=50).collect()) == want
    huge = spark.createDataFrame([(0, [1e18]), (1, [1e18]), (2, [-1e18])], "vec_id long, embedding array<double>")
    assert [x["score"] for x in topk.top_k(huge, F.col("vec_id") == 0).orderBy("rank").collect()] == [2**63 - 1, -(2**63)]


def _duck(sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return sorted(con.execute(sql).fetchall(), key=str)


def test_exact_dedup(spark):
    texts = ["a b", "ab", "a\tb\n", "a  b ", None, "", " ", "x" * 9000, "x" * 9000 + " ", "a b", "lang " * 3000, "lang\n" * 3000, "lang " * 2999]
    rows = list(enumerate(texts)) + [(0, "a b"), (1, "other")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    got = sorted(((x["doc_id"], x["keep_id"], x["group_size"], x["kept"], x["text_sha256"]) for x in recipes.exact_groups(frame).collect()), key=str)
    assert got == _duck(queries.ORACLES["op5_exact_dedup"], documents=pd.DataFrame(rows, columns=["doc_id", "text"]))
    assert recipes.exact_groups(frame.where("false")).count() == 0


def test_chunks_join_to_the_text(spark):
    r = random.Random(1)
    texts = ["".join(r.choice("aeiounrst xyz") for _ in range(n)) for n in (0, 1, 899, 900, 5000, 20000)] + ["q" * 9999]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", recipes.chunks(F.col("t")).alias("c")).collect()
    for x in rows:
        assert "".join(x["c"]) == x["t"] and all(len(c) <= recipes.MOST + 2 for c in x["c"])
    tail = [c for x in rows[4:5] for c in x["c"]]
    shifted = spark.createDataFrame([("unlike" + texts[4],)], "t string").select(recipes.chunks(F.col("t"))).first()[0]
    assert len(tail) > 2 and shifted[-1] == tail[-1]  # cuts follow the content


def test_clashing_identifiers_are_told_apart(spark, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(recipes.F, "xxhash64", lambda c: F.length(c).cast("long"))
    rows = [(1, "abc"), (2, "abd"), (3, "a bc"), (4, "xyzw")]
    try:
        got = {x["doc_id"]: x["keep_id"] for x in recipes.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        monkeypatch.setattr(recipes.F, "xxhash64", real)
    assert got == {1: 3, 2: 2, 3: 3, 4: 4}


def _sources(spark, seed=1):
    r = random.Random(seed)
    rows = [(k, "w " * r.randint(0, 30), r.choice(["a"] * 8 + ["b", "b", "c", None])) for k in range(400)] + [(1000, None, "a"), (1001, "", "empty"), (5, "x y", "b")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("of", F.lit("clash"))


def test_mixing(spark):
    rows, frame = _sources(spark)
    got = sorted(((x["doc_id"], x["source"], x["n_tokens"], x["source_budget"], x["copies"]) for x in mixing.mixture(frame).collect()), key=str)
    assert got == _duck(mixing.ORACLE, documents=pd.DataFrame(rows, columns=["doc_id", "text", "source"]))
    taken = Counter()
    for _, s, n, _, c in got:
        taken[s] += n * c
    for _, s, _, budget, _ in got:
        assert taken[s] >= budget and taken[s] - budget <= 60  # over by less than the last documents
    assert mixing.mixture(frame.where("false")).count() == 0
    assert {x["copies"] for x in mixing.mixture(frame.where("text is null")).collect()} == {0}


def test_mixing_of_rows_without_an_id(spark):
    rows = [(None, "a b c", "x"), (None, "d", "x"), (1, "e f", "x"), (None, "g", None), (2, "h " * 40, "y"), (2, "h " * 40, "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(frame).collect()
    copies = defaultdict(set)
    for x in got:
        copies[x["doc_id"], x["source"]].add(x["copies"])
    assert len(got) == len(rows) and all(len(c) == 1 for c in copies.values())
    covering = Counter((x["doc_id"], x["source"]) for x in mixing.mixed(frame).collect())
    assert set(covering) == {(k, s) for k, _, s in rows}


def test_mixture_that_covers_drops_nothing(spark):
    rows, frame = _sources(spark, 2)
    out = mixing.mixed(frame)
    assert out.columns == frame.columns
    copies = Counter(x["doc_id"] for x in out.where("source is not null and length(text) > 0").collect())
    own = Counter(k for k, t, s in rows if s is not None and t)
    assert set(copies) == set(own) and max(copies[k] / own[k] for k in own) <= 5 and max(copies.values()) > 1


def test_preference_pairs(spark):
    talks = {0: ["u:hi", "a:hello", "u:more", "a:good"], 1: ["u:hi", "a:hello", "u:more", "a:bad", "u:why"], 2: ["s:x", "u:q"], 3: [], 4: ["a:é"], 5: ["a:é"], 7: ["u:only"], 8: ["a:x"], 9: ["u:x"]}
    role = {"u": "user", "a": "assistant", "s": "system"}
    rows = [(c, k, role[t[0]], t[2:]) for c, ts in talks.items() for k, t in enumerate(ts)] + [(10, 0, None, None), (10, None, "user", "first"), (11, 0, "user", "x"), (11, 0, "user", "x"), (None, 0, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("t", F.lit(0))
    out = preference.adjacent_pairs(frame)
    got = sorted(((x["pair_id"], x["n_shared"], x["prompt"], x["chosen"], x["rejected"], x["chosen_mask"], x["rejected_mask"]) for x in out.collect()), key=str)
    assert got == _duck(preference.ORACLE, conversations=pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    first = out.where("pair_id = 0").first()
    a, b = map(int, first["chosen_mask"].split(":"))
    assert first["n_shared"] == 3 and first["chosen"][a:b] == "good<|end|>\n" and first["prompt"].count("<|end|>") == 3
    assert preference.adjacent_pairs(frame.where("false")).count() == 0


def test_mixing_keeps_sources_without_tokens(spark):
    rows = [(1, "a b c", "x"), (2, "d", "y"), (3, " ", "z"), (4, None, "z"), (5, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [x["doc_id"] for x in mixing.mixed(frame).collect()]
    assert set(got) == {1, 2, 3, 4, 5} and [got.count(k) for k in (3, 4, 5)] == [1, 1, 1]
    assert sorted(x["doc_id"] for x in mixing.mixed(frame.where("doc_id > 2")).collect()) == [3, 4, 5]
    assert {x["copies"] for x in mixing.mixture(frame.where("doc_id > 2")).collect()} == {0}
