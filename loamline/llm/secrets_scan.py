"""Secret scans by one deterministic automaton.

All rules' regular expressions are parsed here, joined into one nondeterministic automaton, made deterministic by subset construction and
minimised; its transition array is walked once over the bytes of a text and tells where any rule's match first ends. At such an end the
rule's own reversed automaton runs back to the leftmost start and its forward automaton on to the longest end, as far as the match
reaches. Matches of one rule don't overlap; those of different rules may.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batched, mixed


@dataclass(frozen=True)
class Rule:
    """kind: its name in spans. pattern: what matches, greedily. prefix: the part before the value, whose length must be least at least (without prefix the value is the whole match)."""

    kind: str
    pattern: str
    least: int = 1
    prefix: str = ""
    fold: bool = False


KEYWORD = "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
#: The first three are the base; the others add spans.
RULES = (
    Rule("assign", KEYWORD + "[A-Za-z0-9+/_.=-]+", 6, KEYWORD, True),
    Rule("access", "AKIA[A-Z0-9]{16,}"),  # of AKIA[A-Z0-9]+ what has 20 characters: a run too short has no longer one inside
    Rule("hex", "[0-9a-f]{24,}"),  # likewise of [0-9a-f]+
    Rule("private_key", "-----BEGIN\\x20[A-Z\\x20]*PRIVATE\\x20KEY-----"),
    Rule("jwt", "eyJ[0-9A-Za-z_-]+\\.eyJ[0-9A-Za-z_-]+"),
)


# ---------------------------------------------------------------- from patterns to automata


@dataclass
class Nfa:
    """States by number; edges carry a set of bytes, skips none. One start and one end."""

    edges: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    skips: list[list[int]] = field(default_factory=list)
    start: int = 0
    end: int = 0

    def state(self) -> int:
        self.edges.append([])
        self.skips.append([])
        return len(self.edges) - 1

    def reversed(self) -> Nfa:
        out = Nfa([[] for _ in self.edges], [[] for _ in self.edges], self.end, self.start)
        for s, edges in enumerate(self.edges):
            for chars, t in edges:
                out.edges[t].append((chars, s))
            for t in self.skips[s]:
                out.skips[t].append(s)
        return out


class Parser:
    """Regular expressions of literals, escapes (\\xHH or a sign), classes, groups, |, ?, *, + and {m}, {m,}, {m,n}, over bytes."""

    def __init__(self, pattern: str, fold: bool):
        self.p, self.at, self.fold, self.nfa = pattern, 0, fold, Nfa()

    def parse(self) -> Nfa:
        self.nfa.start, self.nfa.end = self.either()
        if self.at != len(self.p):
            raise ValueError(f"{self.p!r}: can't read {self.p[self.at :]!r}")
        return self.nfa

    def either(self) -> tuple[int, int]:
        parts = [self.sequence()]
        while self.p[self.at : self.at + 1] == "|":
            self.at += 1
            parts.append(self.sequence())
        if len(parts) == 1:
            return parts[0]
        a, b = self.nfa.state(), self.nfa.state()
        for x, y in parts:
            self.nfa.skips[a].append(x)
            self.nfa.skips[y].append(b)
        return a, b

    def sequence(self) -> tuple[int, int]:
        a = b = self.nfa.state()
        while self.at < len(self.p) and self.p[self.at] not in "|)":
            begin = self.at
            x, y = self.atom()
            end = self.at
            low, high = self.times()
            resume = self.at

            def again(begin: int = begin, end: int = end) -> tuple[int, int]:
                self.at = begin
                out = self.atom()
                assert self.at == end
                return out

            copies = [(x, y)] + [again() for _ in range(max(low, high or 0, 1) - 1)] + ([again()] if high is None and low else [])
            self.at = resume
            for i, (x, y) in enumerate(copies if high != 0 else []):
                self.nfa.skips[b].append(x)
                if i >= low:  # may be left out
                    self.nfa.skips[x].append(y)
                if high is None and i == len(copies) - 1:  # may come again
                    self.nfa.skips[y].append(x)
                b = y
        return a, b

    def times(self) -> tuple[int, int | None]:
        sign = self.p[self.at : self.at + 1]
        if sign and sign in "?*+":
            self.at += 1
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
        if sign == "{":
            end = self.p.index("}", self.at)
            low, comma, high = self.p[self.at + 1 : end].partition(",")
            self.at = end + 1
            return int(low), (int(high) if high else None) if comma else int(low)
        return 1, 1

    def atom(self) -> tuple[int, int]:
        sign = self.p[self.at]
        if sign == "(":
            self.at += 3 if self.p.startswith("(?:", self.at) else 1
            a, b = self.either()
            self.at += 1
            # A state of its own on either side keeps loops of the group and its neighbours apart.
            x, y = self.nfa.state(), self.nfa.state()
            self.nfa.skips[x].append(a)
            self.nfa.skips[b].append(y)
            return x, y
        chars = self.set_of() if sign == "[" else frozenset(self.one())
        if self.fold:
            chars = frozenset(c for x in chars for c in (x, *bytes([x]).lower(), *bytes([x]).upper()))
        a, b = self.nfa.state(), self.nfa.state()
        self.nfa.edges[a].append((chars, b))
        return a, b

    def one(self) -> bytes:
        sign = self.p[self.at]
        self.at += 1
        if sign == "\\":
            sign = self.p[self.at]
            self.at += 1
            if sign == "x":
                self.at += 2
                return bytes([int(self.p[self.at - 2 : self.at], 16)])
        return sign.encode("latin-1")

    def set_of(self) -> frozenset[int]:
        self.at += 1
        other = self.p[self.at] == "^"
        self.at += other
        found: set[int] = set()
        while self.p[self.at] != "]":
            (low,) = self.one()
            if self.p[self.at] == "-" and self.p[self.at + 1] != "]":
                self.at += 1
                (high,) = self.one()
                found.update(range(low, high + 1))
            else:
                found.add(low)
        self.at += 1
        return frozenset(range(256)) - found if other else frozenset(found)


@dataclass
class Dfa:
    """table[state, class of a byte] is the next state; state 0 is dead, 1 the start. accepts: for each state a bit for each rule."""

    classes: bytes
    table: np.ndarray
    accepts: np.ndarray


def deterministic(rules: list[Nfa], anywhere: bool) -> Dfa:
    """Subset construction over all rules at once, then minimisation. anywhere: matches may start at any byte."""
    edges: list[list[tuple[frozenset[int], int]]] = []
    skips: list[list[int]] = []
    starts, ends = [], {}
    for r, nfa in enumerate(rules):
        base = len(edges)
        edges += [[(chars, t + base) for chars, t in e] for e in nfa.edges]
        skips += [[t + base for t in s] for s in nfa.skips]
        starts.append(nfa.start + base)
        ends[nfa.end + base] = 1 << r
    # Bytes that no edge tells apart share a class.
    kinds = sorted({chars for e in edges for chars, _ in e}, key=sorted)
    names: dict[tuple[bool, ...], int] = {}
    classes = bytes(names.setdefault(tuple(b in chars for chars in kinds), len(names)) for b in range(256))
    some = {c: b for b, c in reversed(list(enumerate(classes)))}
    moves = [[[t for chars, t in e if some[c] in chars] for c in range(len(names))] for e in edges]

    # Sets of states are bits of an integer.
    useful = sum(1 << s for s in range(len(edges)) if edges[s] or s in ends)

    def closed(states: list[int]) -> int:
        out, todo = 0, list(states)
        for s in states:
            out |= 1 << s
        while todo:
            for t in skips[todo.pop()]:
                if not out >> t & 1:
                    out |= 1 << t
                    todo.append(t)
        return out & useful

    def members(bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(low.bit_length() - 1)
            bits ^= low
        return out

    first = closed(starts)
    alone = [[closed(t) for t in m] for m in moves]
    at, sets, rows = {0: 0, first: 1}, [0, first], []
    while len(rows) < len(sets):
        inside, row = [alone[x] for x in members(sets[len(rows)])], []
        for c in range(len(names)):
            t = first if anywhere else 0
            for x in inside:
                t |= x[c]
            if t not in at:
                at[t] = len(sets)
                sets.append(t)
            row.append(at[t])
        rows.append(row)
    accepts = np.array([sum(ends.get(x, 0) for x in members(s)) for s in sets], np.int64)
    return minimised(classes, np.array(rows, np.int32), accepts)


def minimised(classes: bytes, table: np.ndarray, accepts: np.ndarray) -> Dfa:
    """Merges states that no text tells apart: parts split by where their states go until none splits."""
    part = np.unique(accepts, return_inverse=True)[1]
    odd = mixed(np.arange(1, table.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    while True:
        # Equal sums of mixed 64-bit values stand for equal rows.
        key = mixed(part.astype(np.uint64) + np.uint64(1)) + (mixed(part[table].astype(np.uint64) + np.uint64(7)) * odd).sum(axis=1, dtype=np.uint64)
        new = np.unique(key, return_inverse=True)[1]
        if new.max() == part.max():
            break
        part = new
    # Dead and start keep their numbers.
    order = list(dict.fromkeys([part[0], part[1], *part.tolist()]))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    firsts = np.array([int(np.flatnonzero(part == p)[0]) for p in order])
    if part[0] == part[1]:
        raise ValueError("no rule can match")
    return Dfa(classes, rank[part[table[firsts]]].astype(np.int32), accepts[firsts])


@dataclass
class Compiled:
    rules: tuple[Rule, ...]
    search: Dfa
    forward: list[Dfa]
    backward: list[Dfa]
    prefixes: list[Dfa | None]


@lru_cache(maxsize=8)
def compiled(rules: tuple[Rule, ...] = RULES) -> Compiled:
    nfas = [Parser(r.pattern, r.fold).parse() for r in rules]
    return Compiled(
        rules, deterministic(nfas, True), [deterministic([n], False) for n in nfas], [deterministic([n.reversed()], False) for n in nfas],
        [deterministic([Parser(r.prefix, r.fold).parse()], False) if r.prefix else None for r in rules],
    )


# ---------------------------------------------------------------- scanning


def run_on(dfa: Dfa, data: bytes, at: int, stop: int, step: int) -> int | None:
    """How far the longest match from `at` reaches, going by step until stop; None without a match."""
    state, best = 1, None
    table, classes, accepts = dfa.table, dfa.classes, dfa.accepts
    while at != stop:
        state = table[state, classes[data[at if step > 0 else at - 1]]]
        if not state:
            break
        at += step
        if accepts[state]:
            best = at
    return best


class Scanner:
    """Finds spans in texts. The search automaton becomes nested lists: a row's entry is the next row, or the number of an accepting state."""

    def __init__(self, of: Compiled):
        self.of = of
        table, accepts = of.search.table.tolist(), of.search.accepts.tolist()
        self.rows: list[list] = [[] for _ in table]
        for s, row in enumerate(table):
            self.rows[s].extend(t if accepts[t] else self.rows[t] for t in row)
        self.hits = [[r for r in range(len(of.rules)) if a >> r & 1] for a in accepts]
        self.classes = of.search.classes

    def ends(self, data: bytes) -> Iterator[tuple[int, int]]:
        """(end, accepting state) wherever some rule has a match that ends: one pass over the bytes."""
        codes = data.translate(self.classes)
        it, row, rows, n = iter(codes), self.rows[1], self.rows, len(codes)
        while True:
            try:
                for c in it:
                    row = row[c]
            except TypeError:  # row is the number of an accepting state, and c the byte after it
                yield n - it.__length_hint__() - 1, row
                row = rows[row][c]
                continue
            break
        if isinstance(row, int):
            yield n, row

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start, then rule."""
        of, found, done = self.of, [], [0] * len(self.of.rules)
        for end, state in self.ends(data):
            for r in self.hits[state]:
                if end <= done[r]:
                    continue
                start = run_on(of.backward[r], data, end, done[r], -1)
                if start is None:
                    continue
                stop = run_on(of.forward[r], data, start, len(data), 1)
                done[r] = stop
                value = start
                if of.prefixes[r] is not None:
                    value = run_on(of.prefixes[r], data, start, stop, 1) or start
                if stop - value >= of.rules[r].least:
                    found.append((start, r, stop))
        return sorted(found)


FOUND = pa.schema([("doc_id", pa.int64()), ("counts", pa.list_(pa.int64())), ("base_sha256", pa.string()), ("spans", pa.string())])


def scanner(of: Compiled, base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(of)

        def made():
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    text = text.as_py() or ""
                    data = text.encode("utf-8", "surrogatepass")
                    spans = scan.spans(data)
                    if len(data) != len(text):  # from bytes to code points
                        spans = [(len(data[:a].decode("utf-8", "surrogatepass")), r, len(data[:b].decode("utf-8", "surrogatepass"))) for a, r, b in spans]
                    said = [(r, f"{of.rules[r].kind}:{a}:{b}") for a, r, b in spans]
                    counts = [sum(x == r for x, _ in said) for r in range(len(of.rules))]
                    yield doc, counts, hashlib.sha256(",".join(x for r, x in said if r < base).encode()).hexdigest(), ",".join(x for _, x in said)

        yield from batched(made(), FOUND)

    return run


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = 3) -> DataFrame:
    """(doc_id, counts, base_sha256, spans) of every text (null: empty): spans are kind:start:end in code points, by start, then rule.

    counts has a number for each rule; base_sha256 is the digest of the spans of the first `base` rules. Repeated rows stay, a null
    doc_id stays null, extra columns are ignored, an empty table gives no rows. Text is read once, whatever the rules; nothing is shuffled.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(scanner(compiled(rules), base), "doc_id long, counts array<long>, base_sha256 string, spans string")
