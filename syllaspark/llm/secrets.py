"""Secret scans by one combined deterministic automaton.

Every rule is a prefix expression followed by a run of characters of one class,
of which a least number is asked.  All rules are compiled together by subset
construction into one transition array, which is then minimised; one pass over
the bytes runs it for all rules at once, many pieces of text in lockstep.

Rows: each input row gives one output row, whatever its length.  A null or empty text has no finding.
Repeated rows and ids are scanned each by itself.  Columns other than id and text
are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mapping import map_text


@dataclass(frozen=True)
class Rule:
    """``prefix`` then one or more bytes of ``tail``; matches with under ``least`` tail bytes are consumed, not reported."""

    kind: str
    prefix: str
    tail: str
    least: int
    any_case: bool = False


#: The kinds that every report counts.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "A-Za-z0-9+/_.=-", 6, True),
    Rule("access", "AKIA", "A-Z0-9", 16),
    Rule("hex", "", "0-9a-f", 24),
)
#: Kinds that this scanner adds.
MORE = (
    Rule("bearer", r"[Bb]earer\x20+", "A-Za-z0-9._~+/=-", 12),
    Rule("userinfo", r"://[A-Za-z0-9._-]+:[A-Za-z0-9._%+-]+", "@", 1),
    Rule("pem", r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY", "-", 5),
)
DEFAULT = BASE + MORE


def byte_class(body: str) -> frozenset[int]:
    """The bytes of a class such as ``A-Za-z0-9_.-``; a hyphen at either end is itself."""
    out, i = set(), 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            out |= set(range(ord(body[i]), ord(body[i + 2]) + 1))
            i += 3
        else:
            out.add(ord(body[i]))
            i += 1
    return frozenset(out)


class _Nfa:
    """Thompson construction for literals, classes, groups, ``|``, ``?``, ``*`` and ``+``."""

    def __init__(self, text: str, any_case: bool):
        self.free: list[list[int]] = []
        self.on: list[list[tuple[frozenset[int], int]]] = []
        self.text, self.at, self.any_case = text, 0, any_case
        self.start, self.end = self._either()
        if self.at != len(text):
            raise ValueError(f"expression not understood at {self.at}: {text}")

    def _new(self) -> int:
        self.free.append([])
        self.on.append([])
        return len(self.free) - 1

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _either(self) -> tuple[int, int]:
        a, b = self._new(), self._new()
        while True:
            x, y = self._row()
            self.free[a].append(x)
            self.free[y].append(b)
            if self._peek() != "|":
                return a, b
            self.at += 1

    def _row(self) -> tuple[int, int]:
        a = b = self._new()
        while self._peek() not in ("", "|", ")"):
            x, y = self._one()
            self.free[b].append(x)
            b = y
        return a, b

    def _one(self) -> tuple[int, int]:
        c = self._peek()
        if c == "(":
            self.at += 1
            x, y = self._either()
            if self._peek() != ")":
                raise ValueError("unclosed group")
            self.at += 1
        else:
            if c == "[":
                close = self.text.index("]", self.at)
                which = byte_class(self.text[self.at + 1 : close])
                self.at = close + 1
            elif c == "\\":
                m = re.compile(r"\\x([0-9A-Fa-f]{2})|\\(\W)").match(self.text, self.at)
                if not m:
                    raise ValueError("escape not understood")
                which, self.at = frozenset([int(m[1], 16) if m[1] else ord(m[2])]), m.end()
            else:
                which, self.at = frozenset([ord(c)]), self.at + 1
            if self.any_case:
                which = frozenset(ord(f(chr(b))) for b in which for f in (str.lower, str.upper))
            x, y = self._new(), self._new()
            self.on[x].append((which, y))
        if self._peek() in ("?", "*", "+") and self._peek():
            sign = self._peek()
            self.at += 1
            a, b = self._new(), self._new()
            self.free[a].append(x)
            self.free[y].append(b)
            if sign in "?*":
                self.free[a].append(b)
            if sign in "*+":
                self.free[y].append(x)
            x, y = a, b
        return x, y

    def closure(self, states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def step(self, states, byte: int) -> frozenset[int]:
        return self.closure({t for s in states for which, t in self.on[s] if byte in which})


class _Machine:
    """One rule's part of a combined state: a set of prefix states, or the length of the tail so far.

    Until a match has its first tail byte, every position may begin one; from then
    on the match that began first owns the text up to the end of its tail.
    """

    def __init__(self, rule: Rule):
        self.rule, self.nfa, self.tail = rule, _Nfa(rule.prefix, rule.any_case), byte_class(rule.tail)
        self.first = self.nfa.closure([self.nfa.start])

    def step(self, state, byte: int):
        if isinstance(state, int):
            if byte in self.tail:
                return min(state + 1, self.rule.least)
            state = self.first
        if self.nfa.end in state and byte in self.tail:
            return 1
        return self.nfa.step(state, byte) | self.first


@dataclass
class Automaton:
    rules: tuple[Rule, ...]
    next: np.ndarray  # premultiplied: next[state + byte] is 256 times the next state
    says: np.ndarray  # by state: a bit for each rule that reports
    low: int  # states from here on (premultiplied) report
    resets: np.ndarray  # bytes after which every state is the first one
    back: list  # for each rule: transition array and accepting flags of its prefix read backwards


def _minimised(table: np.ndarray, says: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Partition refinement: states stay together while they report alike and go to like states."""
    part = np.unique(says, return_inverse=True)[1]
    while True:
        rows = np.column_stack([part, part[table]])
        new = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
        if new.max() == part.max():
            break
        part = new
    keep = np.unique(part, return_index=True)[1]
    return part[table[keep]], np.append(says[keep], part[0])


def _backwards(rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """The prefix read from its end: subset construction over reversed edges; state 0 is dead, 1 the first."""
    nfa = _Nfa(rule.prefix, rule.any_case)
    free, on = [[] for _ in nfa.free], [[] for _ in nfa.on]
    for s, ts in enumerate(nfa.free):
        for t in ts:
            free[t].append(s)
    for s, ts in enumerate(nfa.on):
        for which, t in ts:
            on[t].append((which, s))
    nfa.free, nfa.on = free, on
    first = nfa.closure([nfa.end])
    names, rows, k = {frozenset(): 0, first: 1}, [[0] * 256], 1
    order = [frozenset(), first]
    while k < len(order):
        row = []
        for b in range(256):
            t = nfa.step(order[k], b)
            if t not in names:
                names[t] = len(order)
                order.append(t)
            row.append(names[t])
        rows.append(row)
        k += 1
    return np.array(rows, np.int32), np.array([nfa.start in s for s in order])


@lru_cache(maxsize=8)
def compiled(rules: tuple[Rule, ...]) -> Automaton:
    """Subset construction over all rules at once, then minimisation."""
    machines = [_Machine(r) for r in rules]
    signs = [tuple(b in s for m in machines for s in [m.tail, *[w for row in m.nfa.on for w, _ in row]]) for b in range(256)]
    alike = {s: b for b, s in reversed(list(enumerate(signs)))}
    of = [alike[s] for s in signs]  # bytes that no rule tells apart share a column
    start = tuple(m.first for m in machines)
    names, order, rows = {start: 0}, [start], []
    while len(rows) < len(order):
        state, went = order[len(rows)], {}
        for b in alike.values():
            t = tuple(m.step(s, b) for m, s in zip(machines, state))
            if t not in names:
                names[t] = len(order)
                order.append(t)
            went[b] = names[t]
        rows.append([went[of[b]] for b in range(256)])
    says = np.array([sum(1 << k for k, (m, s) in enumerate(zip(machines, state)) if isinstance(s, int) and s >= m.rule.least) for state in order])
    table, says = _minimised(np.array(rows), says)
    first, says = says[-1], says[:-1]
    rank = np.lexsort((np.arange(len(says)) != first, says != 0))  # the first state, the silent ones, those that report
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    table, says = place[table[rank]], says[rank]
    resets = (table == 0).all(axis=0)
    return Automaton(rules, (table * 256).astype(np.int32).ravel(), says.astype(np.int32), int((says == 0).sum()) * 256, resets, [_backwards(r) for r in rules])


#: Bytes of a lane, about; of a part of a stretch without a reset; and bytes before a part from which its first state is guessed.
LANE, PART, LEAD = 256, 4096, 256


def _lockstep(auto: Automaton, buf: np.ndarray, begin: np.ndarray, length: np.ndarray, state: np.ndarray):
    """(last state of each lane, and of each report the lane, position and state)."""
    by = np.argsort(-length, kind="stable")
    begin, length, state = begin[by], length[by], state[by].astype(np.int32)
    active = np.searchsorted(-length, -np.arange(length[0]), "left") if len(by) else []
    lane, where, what = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for t in range(len(active)):
        a = int(active[t])
        s = auto.next.take(state[:a] + buf.take(begin[:a] + t))
        state[:a] = s
        told = np.flatnonzero(s >= auto.low)
        if len(told):
            lane.append(by[told])
            where.append(begin[told] + t)
            what.append(s[told])
    last = np.empty(len(by), np.int32)
    last[by] = state
    return last, np.concatenate(lane), np.concatenate(where), np.concatenate(what)


def hits(auto: Automaton, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which some rule reports, and the rules' bits, from one pass over the bytes.

    The bytes are cut into lanes after bytes that reset the automaton, and at the ends
    of texts; the lanes run in lockstep, the longest first.  A stretch that no byte
    resets is cut into parts, whose first states are guessed from the bytes before them;
    a part whose guess the part before it belies runs again.
    """
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    cut = np.flatnonzero(auto.resets[buf]) + 1
    if len(cut):
        at = np.searchsorted(cut, np.arange(LANE, n, LANE))
        cut = cut[at[at < len(cut)]]
    begin = np.unique(np.concatenate([offs[:-1], cut]))
    begin = begin[begin < n]
    length = np.diff(np.append(begin, n))
    many = np.where(length > 2 * PART, -(-length // PART), 1)
    guessed = np.ones(int(many.sum()), bool)  # parts other than the first of their lane
    guessed[np.cumsum(many) - many] = False
    begin = np.repeat(begin, many) + PART * (np.arange(len(guessed)) - np.repeat(np.cumsum(many) - many, many))
    length = np.diff(np.append(begin, n))
    state = np.zeros(len(begin), np.int32)
    follow = np.flatnonzero(guessed)
    state[follow] = _lockstep(auto, buf, begin[follow] - LEAD, np.full(len(follow), LEAD), state[follow])[0]
    last, lane, where, what = _lockstep(auto, buf, begin, length, state)
    while True:
        wrong = follow[state[follow] != last[follow - 1]]
        if not len(wrong):
            break
        whole = np.cumsum(~guessed)[wrong]  # of each wrong part its stretch; the first one follows a part that is right
        first = np.unique(whole, return_index=True)[1]
        state[wrong] = last[wrong[first] - 1][np.searchsorted(whole[first], whole)]  # what held there often holds on
        last[wrong], new, at, says = _lockstep(auto, buf, begin[wrong], length[wrong], state[wrong])
        stay = ~np.isin(lane, wrong)
        lane, where, what = (np.append(x[stay], y) for x, y in ((lane, wrong[new]), (where, at), (what, says)))
    by = np.argsort(where, kind="stable")
    return where[by], auto.says[what[by] >> 8]


def found(auto: Automaton, buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, rule, end) in bytes of each text, in that order."""
    where, what = hits(auto, buf, offs)
    out = []
    for k, rule in enumerate(auto.rules):
        at = where[(what >> k) & 1 == 1]
        if not len(at):
            continue
        doc = np.searchsorted(offs, at, "right") - 1
        new = np.append(True, (np.diff(at) > 1) | (np.diff(doc) > 0))
        last = np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)
        table, accepts = auto.back[k]
        for d, p, e in zip(doc[new].tolist(), at[new].tolist(), at[last].tolist()):
            low = int(offs[d])
            begin = i = p - rule.least + 1
            state = 1
            while i > low:
                i -= 1
                state = table[state, buf[i]]
                if not state:
                    break
                if accepts[state]:
                    begin = i
            out.append((d, begin - low, k, e + 1 - low))
    out.sort()
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = DEFAULT) -> DataFrame:
    """(id, findings): for each row the kind, start and end (code points, end exclusive) of what was found.

    Findings are ordered by start, then by the rules' order.  Matches of one kind
    are leftmost and do not overlap; kinds may overlap each other.
    """
    shared = docs.sparkSession.sparkContext.broadcast(compiled(rules))  # a few megabytes, set by the rules alone

    def make():
        auto = shared.value
        kinds = pa.array([r.kind for r in rules])

        def f(_, buf, offs):
            rows = found(auto, buf, offs)
            doc = np.array([r[0] for r in rows], np.int64)
            ends = np.array([[r[1], r[3]] for r in rows], np.int64).reshape(-1, 2)
            inner = np.flatnonzero((buf & 0xC0) == 0x80)  # bytes to code points
            ends -= np.searchsorted(inner, offs[doc][:, None] + ends) - np.searchsorted(inner, offs[doc])[:, None]
            spans = pa.StructArray.from_arrays([kinds.take(pa.array([r[2] for r in rows], pa.int32())), pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["kind", "start", "end"])
            return [pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(offs))), pa.int32()), spans)]

        return f

    return map_text(docs, id_col, text_col, make, "findings array<struct<kind:string,start:long,end:long>>", 8 << 20).withColumnRenamed("id", id_col)


def _joined(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans, and all spans as text."""
    found_ = find_secrets(docs)
    base = F.filter("findings", lambda x: x["kind"].isin(*[r.kind for r in BASE]))
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    return found_.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("findings")).alias("spans"))
