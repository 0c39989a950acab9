"""Periodic runs of words: a suffix automaton whose end positions are merged small to large.

A run is a stretch whose words stand again ``period`` words later, that no neighbouring
word extends, of at least ``least`` words and ``power`` periods. States of the automaton
are taken from the longest down; each hands its ordered end positions to its suffix link,
the smaller set into the larger. Two positions that become neighbours in a state of length
n end two copies of the same n words, and no more than n before them agree: where they are
at most n apart the copies touch, a square, and the run goes on to the right as far as
words agree. In a run of smallest period q the last words of two copies become neighbours
(anything between them would give a smaller period), so no run is missed.

Before that a text is cut, exactly: all ``k``-grams of a run stand again at the distance of
its period, so words that no k-gram with a near copy holds are in no run.

Defined results: null and blank texts have no words and no runs; their text without
repeats is empty. Rows are taken one by one, so repeated rows have equal results, and
columns of any name are kept.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, schema_of, set_apart, slices

LEAST, POWER = 24, 3
#: Positions of a block of an ordered set.
BLOCK = 1024
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Ends:
    """An ordered set of positions in blocks, so that a large set takes a position at small cost."""

    def __init__(self, first: int):
        self.blocks, self.tops, self.size = [[first]], [first], 1

    def add(self, x: int) -> tuple[int, int]:
        """Take ``x``; its neighbours, -1 where there is none."""
        blocks = self.blocks
        k = 0 if len(blocks) == 1 else min(bisect_left(self.tops, x), len(blocks) - 1)
        block = blocks[k]
        j = bisect_left(block, x)
        before = block[j - 1] if j else blocks[k - 1][-1] if k else -1
        after = block[j] if j < len(block) else blocks[k + 1][0] if k + 1 < len(blocks) else -1
        block.insert(j, x)
        if len(block) > 2 * BLOCK:
            blocks[k : k + 1] = [block[:BLOCK], block[BLOCK:]]
            self.tops[k : k + 1] = [block[BLOCK - 1], block[-1]]
        else:
            self.tops[k] = block[-1]
        self.size += 1
        return before, after

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


class Automaton:
    """The suffix automaton of ``words`` (numbers of 31 bits). The first transition of a state is kept in arrays, few states have more."""

    def __init__(self, words: list[int]):
        self.length, self.link, self.end = array("i", [0]), array("i", [-1]), array("i", [-1])
        self._word, self._to, self._more = array("i", [-1]), array("i", [-1]), {}
        last = 0
        for i, word in enumerate(words):
            last = self._append(last, word, i)

    def _state(self, length: int, link: int, end: int, word: int = -1, to: int = -1) -> int:
        self.length.append(length)
        self.link.append(link)
        self.end.append(end)
        self._word.append(word)
        self._to.append(to)
        return len(self.length) - 1

    def go(self, state: int, word: int) -> int:
        if self._word[state] == word:
            return self._to[state]
        more = self._more.get(state)
        return more.get(word, -1) if more else -1

    def _lead(self, state: int, word: int, to: int) -> None:
        if self._word[state] in (-1, word):
            self._word[state], self._to[state] = word, to
        else:
            self._more.setdefault(state, {})[word] = to

    def _append(self, last: int, word: int, i: int) -> int:
        new, state = self._state(self.length[last] + 1, 0, i), last
        while state != -1 and self.go(state, word) == -1:
            self._lead(state, word, new)
            state = self.link[state]
        if state == -1:
            return new
        found = self.go(state, word)
        if self.length[found] != self.length[state] + 1:
            copy = self._state(self.length[state] + 1, self.link[found], -1, self._word[found], self._to[found])
            if found in self._more:
                self._more[copy] = dict(self._more[found])
            while state != -1 and self.go(state, word) == found:
                self._lead(state, word, copy)
                state = self.link[state]
            self.link[found] = copy
            found = copy
        self.link[new] = found
        return new

    def neighbours(self, shortest: int) -> Iterator[tuple[int, int, int]]:
        """(state length, end, end) of positions that become neighbours in a state of at least ``shortest`` words."""
        length = np.frombuffer(self.length, np.int32)
        states = np.flatnonzero(length >= max(shortest, 1))
        held: dict[int, Ends] = {}
        for state in states[np.argsort(-length[states], kind="stable")].tolist():
            if self.end[state] >= 0:
                yield from self._merge(held, state, Ends(self.end[state]))
            own, link = held.pop(state), self.link[state]
            if self.length[link] >= max(shortest, 1):
                yield from self._merge(held, link, own)

    def _merge(self, held: dict[int, Ends], state: int, given: Ends) -> Iterator[tuple[int, int, int]]:
        into = held.get(state)
        if into is None:
            held[state] = given
            return
        if into.size < given.size:
            into, given = given, into
        held[state] = into
        n, came, pending = self.length[state], -1, None
        for x in given:
            # what stood after the last one is its neighbour unless this one comes between
            if pending and pending[1] < x:
                yield n, *pending
            before, after = into.add(x)
            if before not in (-1, came):
                yield n, before, x
            came, pending = x, (x, after) if after != -1 else None
        if pending:
            yield n, *pending


def near_stretches(words: np.ndarray, least: int, power: int) -> list[tuple[int, int]]:
    """(begin, end) of the stretches that can hold a run: their k-grams all have a copy within ``1/power`` of their length."""
    k = max(1, least * (power - 2) // power)
    if len(words) < least:
        return []
    key = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        key = key * np.uint64(0x9E3779B97F4A7C15) + mix(words[i : i + len(key)].astype(np.uint64) + np.uint64(1))
    out, todo = [], [(0, len(words))]
    while todo:
        begin, end = todo.pop()
        own = key[begin : end - k + 1]
        order = np.argsort(own, kind="stable")
        gap = np.where(own[order[1:]] == own[order[:-1]], np.diff(order), len(words))
        near = np.zeros(len(own) + 2, bool)
        close = gap * power <= end - begin
        near[order[1:][close] + 1] = near[order[:-1][close] + 1] = True
        edges = np.flatnonzero(near[1:] != near[:-1])
        parts = [(begin + a, begin + b + k - 1) for a, b in edges.reshape(-1, 2).tolist() if b - a + k - 1 >= least]
        if parts == [(begin, end)]:
            out.append((begin, end))
        else:
            todo += parts
    return sorted(out)


def runs(words: list, least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if power < 2:
        raise ValueError("a run has two periods at least")
    number: dict = {}
    codes = [number.setdefault(w, len(number)) for w in words]
    out = []
    for begin, end in near_stretches(np.array(codes, np.int64), least, power):
        own = codes[begin:end]
        seen = set()
        # the last two copies within a run share all but one period of it
        for n, one, two in Automaton(own).neighbours(least - least // power):
            period, start = two - one, one - n + 1
            if period > n or (start, period) in seen:
                continue
            seen.add((start, period))
            stop = two + 1
            while stop < len(own) and own[stop] == own[stop - period]:
                stop += 1
            if stop - start >= max(least, power * period):
                out.append((begin + start, stop - start, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not found:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]


def looped(words: list, doc_id: int | None) -> list:
    """Every tenth document by hash goes in circles from some word on (planted runs); a null id hashes as the empty text."""
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    ring = words[a : a + p]
    return words[:a] + (ring * (-(-(n - a) // p)))[: n - a]


def find_runs(docs: DataFrame, least: int = LEAST, power: int = POWER, prepare: Callable[[list, int | None], list] | None = None) -> DataFrame:
    """``docs`` with ``_runs`` (start, length, period of each run, in words) and ``_collapsed`` (the words without repeats, joined by a space).

    Words are ``[^\\x20\\x09-\\x0D]+``; ``prepare(words, doc_id)`` may change them first.
    """
    own = set_apart(docs, "doc_id", "text")
    names = own.columns

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, rest = [], []
            for text, doc_id in zip(batch.column("text"), batch.column("doc_id").to_pylist(), strict=True):
                words = (text.as_py() or "").encode().split()
                if prepare:
                    words = prepare(words, doc_id)
                own_runs = runs(words, least, power) if len(words) >= least else []
                found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in own_runs])
                rest.append(b" ".join(collapsed(words, own_runs)).decode())
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind), pa.array(rest, pa.string())], [*names, "_runs", "_collapsed"])

    return own.mapInArrow(find, f"{schema_of(own)}, _runs {_RUNS}, _collapsed string").toDF(*docs.columns, "_runs", "_collapsed")


def _greatest(found: Column) -> Column:
    """The run of the greatest length/period; of equal ones the first."""
    start = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(found, start, lambda best, r: F.when(best.isNull() | (r.length * best.period > best.length * r.period), r).otherwise(best))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli of the run of the greatest exponent, and hashes of all runs and of the text without repeats, with planted runs (``looped``)."""
    found = find_runs(docs.select("doc_id", "text"), prepare=looped).select("doc_id", "_runs", "_collapsed", _greatest(F.col("_runs")).alias("best"))
    lines = F.transform("_runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    text = F.when(F.size("_runs") == 0, "").otherwise(F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("_runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("_collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
