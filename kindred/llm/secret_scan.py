"""Secret scans: every rule in one minimised automaton over the bytes of the texts.

The rules are regular expressions. Read backwards and joined, they make one nondeterministic
automaton; subset construction and partition refinement turn it into a transition array. One pass
from the end of a text to its start then marks every byte where a match of some rule begins. From a
mark, the rule's own automaton, compiled the same way but read forwards, runs to the longest end.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, LongType, StringType, StructField, StructType,
)

from kindred.llm.buffers import CHAR_START, add_columns, blocks

BREAK = 0xFF  # stands between texts; no UTF-8 text holds it and no rule may match it
SEGMENT = 512
ROUNDS = 3  # in which all misled segments are run again together


@dataclass(frozen=True)
class Rule:
    """``head`` followed by one or more of ``body`` (both regular expressions, ``body`` a class or a
    group); matches with fewer than ``least`` bytes in the body are dropped after matching."""

    kind: str
    head: str
    body: str
    least: int = 1


def either_case(words: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in words)


BASE_RULES = (
    Rule(
        "assign",
        f"({either_case('password|passwd|secret|token|api_?key')})[\"']?\\x20*[:=]\\x20*[\"']?",
        "[A-Za-z0-9+/_.=-]", 6,
    ),
    Rule("access", "AKIA", "[A-Z0-9]", 16),
    # Runs of hex digits cannot overlap, so the least length may be part of the pattern.
    Rule("hex", "[0-9a-f]{23}", "[0-9a-f]"),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY", "-", 5),
    Rule("code_host", "gh[opsu]_", "[A-Za-z0-9]", 36),
    Rule("chat", "xox[abprs]-", "[A-Za-z0-9-]", 20),
    Rule("web_token", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.", "[A-Za-z0-9_-]", 10),
)


# --- from a pattern to a transition array -------------------------------------------------------


class _Reader:
    """Reads literals, ``\\xNN``, classes, groups, ``|`` and the repeats ``? * + {m} {m,} {m,n}``."""

    def __init__(self, pattern: str):
        self.p, self.i = pattern, 0

    def peek(self) -> str:
        return self.p[self.i : self.i + 1]

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def byte(self) -> int:
        c = self.take()
        if c == "\\":
            c = self.take()
            if c == "x":
                self.i += 2
                return int(self.p[self.i - 2 : self.i], 16)
        return ord(c)

    def either(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("or", options)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated())
        return ("then", parts)

    def repeated(self):
        node = self.single()
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                stop = self.p.index("}", self.i)
                low, _, high = self.p[self.i : stop].partition(",")
                bounds = (int(low), int(high or low) if high or "," not in self.p[self.i : stop] else None)
                self.i = stop + 1
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            node = ("times", node, *bounds)
        return node

    def single(self):
        if self.peek() == "(":
            self.take()
            node = self.either()
            self.take()
            return node
        if self.peek() != "[":
            return ("one", frozenset([self.byte()]))
        self.take()
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        while self.peek() != "]":
            low = self.byte()
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.take()
                found.update(range(low, self.byte() + 1))
            else:
                found.add(low)
        self.take()
        return ("one", frozenset(range(BREAK)) - found if negated else frozenset(found))


def _backwards(node):
    if node[0] == "one":
        return node
    if node[0] == "times":
        return ("times", _backwards(node[1]), *node[2:])
    inner = [_backwards(x) for x in node[1]]
    return (node[0], inner[::-1] if node[0] == "then" else inner)


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []
        self.steps: list[tuple[frozenset, int] | None] = []
        self.accepts: dict[int, int] = {}

    def state(self) -> int:
        self.free.append([])
        self.steps.append(None)
        return len(self.free) - 1

    def add(self, node, start: int) -> int:
        """Lays the node's states from ``start`` on; the state where it ends."""
        if node[0] == "one":
            end = self.state()
            self.steps[start] = (node[1], end)
            return end
        if node[0] == "then":
            for part in node[1]:
                start = self.add(part, self.linked(start))
            return start
        if node[0] == "or":
            end = self.state()
            for option in node[1]:
                self.free[self.add(option, self.linked(start))].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            start = self.add(inner, self.linked(start))
        if high is None:
            loop = self.linked(start)
            self.free[self.add(inner, self.linked(loop))].append(loop)
            return self.linked(loop)
        end = self.state()
        for _ in range(high - low):
            self.free[start].append(end)
            start = self.add(inner, self.linked(start))
        self.free[start].append(end)
        return end

    def linked(self, start: int) -> int:
        new = self.state()
        self.free[start].append(new)
        return new

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for other in self.free[todo.pop()]:
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``table[state * width + classes[byte]]`` is the next state; state 0 begins; ``accepts`` holds
    a bit per pattern; ``dead`` is the state without a way on, or -1."""

    classes: np.ndarray
    width: int
    table: np.ndarray
    accepts: np.ndarray
    dead: int


def compile_patterns(patterns, search: bool, backwards: bool) -> Automaton:
    """One automaton for all patterns. With ``search`` a match may begin at any byte."""
    nfa = _Nfa()
    start = nfa.state()
    for bit, pattern in enumerate(patterns):
        tree = _Reader(pattern).either()
        nfa.accepts[nfa.add(_backwards(tree) if backwards else tree, nfa.linked(start))] = 1 << bit
    classes, width = _byte_classes([s[0] for s in nfa.steps if s])
    sample = [int(np.flatnonzero(classes == c)[0]) for c in range(width)]
    first = nfa.closure([start])
    known, todo, rows = {first: 0}, [first], []
    for states in todo:
        row = []
        for byte in sample:
            after = {nfa.steps[s][1] for s in states if nfa.steps[s] and byte in nfa.steps[s][0]}
            target = nfa.closure(after | ({start} if search else set()))
            if target not in known:
                known[target] = len(known)
                todo.append(target)
            row.append(known[target])
        rows.append(row)
    accepts = [sum({nfa.accepts[s] for s in states if s in nfa.accepts}) for states in todo]
    return _minimised(classes, width, np.array(rows), np.array(accepts))


def _byte_classes(sets) -> tuple[np.ndarray, int]:
    signature = np.zeros((256, len(sets)), bool)
    for k, members in enumerate(sets):
        signature[list(members), k] = True
    _, classes = np.unique(signature, axis=0, return_inverse=True)
    return classes.ravel().astype(np.int64), int(classes.max()) + 1


def _minimised(classes, width, rows, accepts) -> Automaton:
    """Merges states that no continuation tells apart, by refining the partition until it holds."""
    _, block = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[rows]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    order = np.argsort([np.flatnonzero(block == b)[0] for b in range(block.max() + 1)])
    renamed = np.empty(len(order), np.int64)
    renamed[order] = np.arange(len(order))
    block = renamed[block]
    chosen = np.array([np.flatnonzero(block == b)[0] for b in range(block.max() + 1)])
    table, marks = block[rows[chosen]], accepts[chosen]
    lost = [s for s in range(len(table)) if not marks[s] and (table[s] == s).all()]
    return Automaton(classes, width, table.ravel().astype(np.int32), marks.astype(np.int64), lost[0] if lost else -1)


# --- scanning -----------------------------------------------------------------------------------


def run_states(automaton: Automaton, data: np.ndarray) -> np.ndarray:
    """The state after every byte of ``data``, as one run from the start would give it.

    All segments of the buffer advance together, each from the start state; then segments whose
    neighbour ended elsewhere are run again from there, until both runs meet. Most meet within a segment.
    Where whole segments never do (long runs of token characters), the few are walked through in
    sequence, each byte once.
    """
    n = len(data)
    segments = -(-n // SEGMENT)
    padded = np.full(segments * SEGMENT, BREAK, np.uint8)
    padded[:n] = data
    steps = np.ascontiguousarray(automaton.classes[padded].reshape(segments, SEGMENT).T)
    states = np.empty((SEGMENT, segments), np.int32)
    table, width = automaton.table, automaton.width
    now = np.zeros(segments, np.int64)
    for j in range(SEGMENT):
        now = table[now * width + steps[j]]
        states[j] = now
    begun = np.zeros(segments, np.int64)
    for _ in range(ROUNDS):
        wrong = _misled(states, begun)
        if not len(wrong):
            break
        begun[wrong] = states[-1, wrong - 1]
        now = begun[wrong]
        for j in range(SEGMENT):
            now = table[now * width + steps[j, wrong]]
            differ = now != states[j, wrong]
            if not differ.any():
                break
            wrong, now = wrong[differ], now[differ]
            states[j, wrong] = now
    listed = None
    for first in _misled(states, begun).tolist():
        segment = first
        while segment < segments and states[-1, segment - 1] != begun[segment]:
            listed = listed or table.tolist()
            begun[segment] = state = int(states[-1, segment - 1])
            was, mine, row = states[:, segment].tolist(), steps[:, segment].tolist(), []
            for byte, old in zip(mine, was):
                state = listed[state * width + byte]
                if state == old:
                    break
                row.append(state)
            states[: len(row), segment] = row
            segment += 1
    return states.T.ravel()[:n]


def _misled(states: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """Segments that began in another state than that in which the one before them ended."""
    return 1 + np.flatnonzero(states[-1, :-1] != begun[1:])


def longest_end(automaton: Automaton, data: bytes, start: int) -> int:
    """End of the longest match that begins at ``start``; -1 without one."""
    table, accepts, classes = _lists(automaton)
    state, end = 0, start if accepts[0] else -1
    for i in range(start, len(data)):
        state = table[state * automaton.width + classes[data[i]]]
        if state == automaton.dead:
            break
        if accepts[state]:
            end = i + 1
    return end


_as_lists: dict[int, tuple] = {}


def _lists(automaton: Automaton):
    if id(automaton) not in _as_lists:
        _as_lists[id(automaton)] = (
            automaton, (automaton.table.tolist(), automaton.accepts.tolist(), automaton.classes.tolist())
        )
    return _as_lists[id(automaton)][1]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        whole = [f"{r.head}({r.body})+" for r in rules]
        self.starts = compile_patterns(whole, search=True, backwards=True)
        self.ends = [compile_patterns([p], search=False, backwards=False) for p in whole]
        self.heads = [compile_patterns([r.head], search=False, backwards=False) for r in rules]

    def scan(self, column: pa.Array) -> list[list[tuple[int, int, int]]]:
        """Per row its matches (start, rule number, end) in code points, by start and rule."""
        found: list[list] = [[] for _ in range(len(column))]
        for low, high, data, offsets in blocks(column):
            joined = np.insert(data, offsets[1:], BREAK)
            at = offsets + np.arange(len(offsets))
            marks = self.starts.accepts[run_states(self.starts, joined[::-1])][::-1]
            hits = np.flatnonzero(marks)
            rows = np.searchsorted(at, hits, "right") - 1
            for row in np.unique(rows):
                mine = hits[rows == row]
                text = joined[at[row] : at[row + 1] - 1]
                found[low + row] = self._matches(text, mine - at[row], marks[mine])
        return found

    def _matches(self, text: np.ndarray, begins: np.ndarray, marks: np.ndarray) -> list[tuple[int, int, int]]:
        """Leftmost matches that do not overlap, per rule."""
        raw, found = text.tobytes(), []
        for k, rule in enumerate(self.rules):
            mine = begins[(marks >> k) & 1 == 1]
            i = 0
            while i < len(mine):
                start = int(mine[i])
                end = longest_end(self.ends[k], raw, start)
                if end - longest_end(self.heads[k], raw, start) >= rule.least:
                    found.append((start, k, end))
                i = int(np.searchsorted(mine, end))
        if not found:
            return []
        chars = np.concatenate([[0], np.cumsum(CHAR_START[text])])
        return sorted((int(chars[s]), k, int(chars[e])) for s, k, e in found)


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """Compiled once per worker process."""
    return Scanner(rules)


SPAN = StructType([
    StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
])
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``secrets``: array of (kind, start, end) in code points, end exclusive, by start
    and then by the order of the rules.

    Matches of one rule are leftmost, longest and never overlap; a match that is too short is dropped
    but still uses up its characters. Matches of different rules may overlap. A null or empty text has
    an empty array; every row is scanned by itself, so repeated rows give repeated results and an
    empty table an empty one. A column named ``secrets`` is replaced. A very long text, or a long run
    of the characters of a rule, is scanned whole in time that grows with its length.
    """
    def compute(column):
        ready = scanner(rules)
        found = ready.scan(column)
        return [pa.array(
            [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in spans] for spans in found], _SPANS
        )]

    return add_columns(docs, text, [StructField("secrets", ArrayType(SPAN))], compute, keep)


def redact_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, text: str = "text", mark: str = "[secret]"
) -> DataFrame:
    """``docs`` in which every secret in the text is replaced by ``mark``; overlapping secrets are
    replaced as one. Texts without a secret, null ones among them, stay as they are."""
    def compute(column):
        out = []
        for value, spans in zip(column.to_pylist(), scanner(rules).scan(column), strict=True):
            parts, done = [], 0
            for start, _, end in spans:
                if start >= done:
                    parts += [value[done:start], mark]
                done = max(done, end)
            out.append("".join([*parts, value[done:]]) if spans else value)
        return [pa.array(out, pa.string())]

    order = docs.columns
    return add_columns(docs, text, [StructField(text, StringType())], compute).select(*[F.col(f"`{c}`") for c in order])
