"""URL filters: every wildcard rule at once, as the bits of a few machine words.

Rules become globs over the canonical URL, which is a dot, the host, a separator and the path. ``*``
stands for any symbols, ``?`` for one. The places of all globs lie one after the other in a row of
64-bit words; a set bit says that the glob matches up to there. Reading a symbol shifts all bits by
one place, keeps those whose place allows the symbol, and keeps those that stand before a ``*``.
The URLs of a batch advance together.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField

from kindred.llm.buffers import add_columns, fresh_name

SEPARATOR = "\0"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS = 4096
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(found, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def _literal(text: str) -> list[str]:
    return list(text)


def _host_rule(rule: Rule) -> list[str | None]:
    """Any subdomain, the host, the separator, the start of the path; None is ``*``."""
    return [None, *_literal("." + rule.host + SEPARATOR + rule.path), None]


def _glob(text: str) -> list[str | None]:
    """A glob over ``host/path``; ``?`` is kept as the empty string."""
    host, slash, path = text.partition("/")
    whole = "." + host + SEPARATOR + slash + path
    return [None if c == "*" else "" if c == "?" else c for c in whole]


FEW_TEXTS = 16  # from so many on, texts are run together


class ShiftAnd:
    def __init__(self, globs: list[list[str | None]]):
        symbols = sorted({s for g in globs for s in g if s})
        self.alphabet = np.array([ord(s) for s in symbols], np.uint32)
        places = sum(1 + sum(s is not None for s in g) for g in globs)
        self.words = -(-places // 64)
        self.allowed = np.zeros((len(symbols) + 1, self.words), np.uint64)  # the last: any other symbol
        self.stay = np.zeros(self.words, np.uint64)
        self.begin = np.zeros(self.words, np.uint64)
        self.ends: list[tuple[int, np.uint64]] = []
        place = 0
        # Each glob begins with a place that no symbol enters: it is set at the start only.
        for glob in globs:
            self._set(self.begin, place)
            for symbol in glob:
                if symbol is None:
                    self._set(self.stay, place)
                    continue
                place += 1
                for k in range(len(symbols) + 1):
                    if symbol == "" or (k < len(symbols) and symbols[k] == symbol):
                        self._set(self.allowed[k], place)
            self.ends.append((place // 64, np.uint64(1 << (place % 64))))
            place += 1

    @staticmethod
    def _set(words: np.ndarray, place: int) -> None:
        words[place // 64] |= np.uint64(1 << (place % 64))

    def matches(self, texts: list[str]) -> np.ndarray:
        """For each text and glob, whether the glob matches the whole text."""
        sizes = np.array([len(t) for t in texts])
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, codes), max(len(self.alphabet) - 1, 0))
        known = self.alphabet[at] == codes if len(self.alphabet) else np.zeros(len(codes), bool)
        symbols = np.where(known, at, len(self.alphabet))
        begins = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        begins, sizes = begins[order], sizes[order]
        state = np.tile(self.begin, (len(texts), 1))
        for j in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -j, "left"))
            if n <= FEW_TEXTS:
                for k in range(n):
                    state[k] = self._go_on(state[k], symbols[begins[k] + j : begins[k] + sizes[k]])
                break
            old = state[:n]
            moved = old << np.uint64(1)
            moved[:, 1:] |= old[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.allowed[symbols[begins[:n] + j]]) | (old & self.stay)
        found = np.empty((len(texts), len(self.ends)), bool)
        for k, (word, bit) in enumerate(self.ends):
            found[order, k] = (state[:, word] & bit) != 0
        return found


    def _go_on(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The state after the symbols, with all words in one integer: for the few longest texts."""
        whole = lambda words: int.from_bytes(words.astype("<u8").tobytes(), "little")
        allowed, stay, now = [whole(a) for a in self.allowed], whole(self.stay), whole(state)
        for symbol in symbols.tolist():
            now = now << 1 & allowed[symbol] | now & stay
            if not now:
                break
        return np.frombuffer(now.to_bytes(8 * len(state), "little"), "<u8").astype(np.uint64)


@lru_cache(maxsize=4)
def _compiled(rules: tuple[Rule, ...], globs: tuple[str, ...]) -> ShiftAnd:
    return ShiftAnd([_host_rule(r) for r in rules] + [_glob(g) for g in globs])


def judge_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...],
    blocked: tuple[str, ...] = (),
    url: str = "url",
    default: str = "allow",
    keep: list[str] | None = None,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``glob`` and ``verdict``.

    The longest rule that fits (the first of equals) decides. Without one, a URL that fits a glob of
    ``blocked`` (over ``host/path``, case as in the canonical URL) is blocked, and ``glob`` names the
    first such glob; all others get ``default``. A null URL, or one without ``://``, has an empty host
    and path. Rows are judged one by one, so repeated ones repeat and an empty table stays empty; the time
    for a long URL grows with its length. Columns with the new names are replaced.
    """
    names = tuple(r.name for r in rules)
    order = sorted(range(len(rules)), key=lambda k: (-len(names[k]), k))

    def compute(column):
        rule, glob, verdict = [], [], []
        ready = _compiled(rules, blocked)
        for low in range(0, len(column), ROWS):
            found = ready.matches(column.slice(low, ROWS).to_pylist())
            for hit in found:
                best = next((k for k in order if hit[k]), None)
                other = next((k for k in range(len(blocked)) if hit[len(rules) + k]), None)
                rule.append(None if best is None else names[best])
                glob.append(None if other is None else blocked[other])
                verdict.append(
                    rules[best].verdict if best is not None else default if other is None else "block"
                )
        return [pa.array(x, pa.string()) for x in (rule, glob, verdict)]

    fields = [StructField(n, StringType()) for n in ("rule", "glob", "verdict")]
    kept = [c for c in (pages.columns if keep is None else keep) if c.lower() not in ("host", "path")]
    canonical = fresh_name([*kept, "host", "path"], "canonical")
    source = pages[f"`{url}`"].cast("string")
    safe = lambda part: F.translate(part, SEPARATOR, "�")
    parts = pages.select(
        *[pages[f"`{c}`"] for c in kept], url_host(source).alias("host"), url_path(source).alias("path"),
        F.concat(F.lit("."), safe(url_host(source)), F.lit(SEPARATOR), safe(url_path(source))).alias(canonical),
    )
    return add_columns(parts, canonical, fields, compute, [*kept, "host", "path"])
