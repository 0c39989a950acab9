"""Benchmark decontamination with suffix arrays over the training words.

The suffixes of all benchmark items are sorted once. Those that begin with the same window
of ``WINDOW`` words (a shorter item is one window) stand side by side as a group, however
many items share it. Each task builds suffix arrays over shards of its documents (word
ids, prefix doubling to 16 words) and binary-searches every group in them, which gives
the places of each window; each place then searches its group for the suffix that it
follows longest, the longest verbatim match. So work grows with places and groups, not
with pairs of places and items. Documents stay where they are read: there is no shuffle.
The benchmark goes to the tasks as a broadcast of at most ``BENCHMARK_BYTES``; a larger one
is cut into blocks by a hash of the item id and each block makes one more pass over the
hits so far.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Words are
compared by a 64-bit hash whose representatives are compared byte by byte in each
shard.

Defined results: null or wordless text has no words and is clean; items without
words are skipped; items that share an id count once; an item with a null id
counts under the empty name; an empty benchmark leaves all clean; other columns
pass through ``decontaminate`` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, schema_of, set_apart, slices

WINDOW, DEPTH = 10, 16
BENCHMARK_BYTES = 32 << 20


class Tests:
    """The words of a block of items one after another, with the suffixes and windows."""

    def __init__(self, items: list[tuple[str, str]]):
        words = Words(pa.array([t for _, t in items], pa.string()))
        self.keys, self.names, self.vocabulary = words.key, [n for n, _ in items], {}
        for k, key in enumerate(words.key.tolist()):
            self.vocabulary.setdefault(key, words.word(k))
        first = words.first
        n = np.diff(first)
        self.item = np.repeat(np.arange(len(items)), n)
        left = np.repeat(first[1:], n) - np.arange(len(words.key))  # words from here to the item's end
        size = np.minimum(n, WINDOW)[self.item] if len(self.item) else np.zeros(0, np.int64)
        size = np.where(left >= size, size, 0)  # words of the window that begins here, or 0
        # ranks of words; a 0 behind each item keeps its suffixes inside it
        self.words, rank = np.unique(words.key, return_inverse=True)
        self.place = np.arange(len(words.key)) + self.item
        self.ids = np.zeros(len(words.key) + len(items), np.int64)
        self.ids[self.place] = rank + 1
        depth = 1 << int(max(n.max(initial=1), 1) - 1).bit_length()
        order = suffix_array(self.ids, max(depth, 1))
        suffix = np.full(len(self.ids), -1, np.int64)
        suffix[self.place] = np.arange(len(words.key))
        order = suffix[order]
        sorted_, start, width = [], [], []
        for k in np.unique(size[size > 0]).tolist():
            own = order[(order >= 0) & (np.where(order >= 0, size[order], 0) == k)]
            fresh = np.zeros(len(own), bool)
            fresh[:1] = True
            for j in range(k):
                at = self.ids[self.place[own] + j]
                fresh[1:] |= at[1:] != at[:-1]
            start.append(np.flatnonzero(fresh) + sum(map(len, sorted_)))
            width.append(np.full(int(fresh.sum()), k))
            sorted_.append(own)
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        #: Suffixes by group and within it in order; where each group begins (one more than groups); words of its window.
        self.sorted, self.size = join(sorted_), join(width)
        self.start = np.append(join(start), len(self.sorted)).astype(np.int64)
        #: Items of each group, in the order of their names.
        by_name = np.argsort(np.argsort(np.array(self.names, object), kind="stable"), kind="stable") if self.names else np.zeros(0, np.int64)
        self.items = [np.unique(by_name[self.item[self.sorted[a:b]]]) for a, b in zip(self.start[:-1], self.start[1:], strict=True)]
        self.ordered = sorted(self.names)

    def names_of(self, groups: tuple[int, ...], known: dict) -> list[str]:
        """Sorted names of the items of some groups; ``known`` remembers them."""
        if groups not in known:
            own = self.items[groups[0]] if len(groups) == 1 else np.unique(np.concatenate([self.items[g] for g in groups]))
            known[groups] = list(dict.fromkeys(self.ordered[k] for k in own))
        return known[groups]


def suffix_array(ids: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Positions in the order of their next ``depth`` ids (a power of two); ids beyond the end are 0."""
    rank, h = ids.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while h < depth and len(rank):
        beyond = np.zeros(len(rank), np.int64)
        beyond[:-h] = rank[h:] if h < len(rank) else 0
        key = rank * (int(rank.max()) + 2) + beyond
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty_like(rank)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) + 1
        h *= 2
    return order


def _bound(order: np.ndarray, ids: np.ndarray, tests: np.ndarray, at: np.ndarray, size: np.ndarray, upper: bool) -> np.ndarray:
    """For each suffix of ``tests`` at ``at``: the first place in ``order`` not before its first ``size`` ids (or behind all equal ones)."""
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(order), np.int64)
    most = int(size.max(initial=0))
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        place, less, same = order[mid], np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for k in range(most):
            live = np.flatnonzero(same & (k < size[open_]))
            if not len(live):
                break
            there = ids[np.minimum(place[live] + k, len(ids) - 1)]
            there = np.where(place[live] + k < len(ids), there, 0)
            here = tests[at[open_[live]] + k]
            less[live] |= there < here
            same[live] = there == here
        right = less | (same & upper)
        lo[open_[right]] = mid[right] + 1
        hi[open_[~right]] = mid[~right]


def search(words: Words, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, run, group) of every place of a window in the shard's words; ``run``: words of the longest match there."""
    n_docs = len(words.first) - 1
    # a 0 behind each document keeps matches inside it
    where = np.arange(len(words.key)) + np.repeat(np.arange(n_docs), np.diff(words.first))
    vocabulary, sample, inverse = np.unique(words.key, return_index=True, return_inverse=True)
    ids = np.zeros(len(words.key) + n_docs, np.int64)
    ids[where] = inverse + 1
    order = suffix_array(ids)
    # words of the benchmark by their number here (hashes that are equal are compared byte by byte), and the other way round
    own = np.array([x in tests.vocabulary and tests.vocabulary[x] == words.word(k) for x, k in zip(vocabulary.tolist(), sample.tolist(), strict=True)], bool)
    found = np.minimum(np.searchsorted(vocabulary, tests.words), len(vocabulary) - 1)
    known = (vocabulary[found] == tests.words) & own[found]
    number = np.concatenate([[0], np.where(known, found + 1, len(vocabulary) + 1 + np.arange(len(tests.words)))])  # unknown words match nothing
    test_ids = number[tests.ids]
    rank = np.full(len(vocabulary) + 1, -1, np.int64)
    rank[found[known] + 1] = np.flatnonzero(known) + 1
    ranks = rank[ids]
    # groups all of whose words stand in the shard
    at = tests.place[tests.sorted[tests.start[:-1]]]
    possible = np.ones(len(at), bool)
    for k in range(WINDOW):
        possible &= (k >= tests.size) | (test_ids[np.minimum(at + k, len(test_ids) - 1)] <= len(vocabulary))
    groups = np.flatnonzero(possible)
    lo, hi = (_bound(order, ids, test_ids, at[groups], tests.size[groups], u) for u in (False, True))
    n = hi - lo
    group = np.repeat(groups, n)
    begin = order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    return np.searchsorted(where, begin), _longest(ranks, begin, group, tests), group  # places without the zeros


def _common(ranks: np.ndarray, begin: np.ndarray, suffix: np.ndarray, size: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """Words that the shard from ``begin`` and a benchmark suffix share beyond their window, with it, and whether the suffix stands before the place."""
    run, less, live = size.copy(), np.zeros(len(begin), bool), np.arange(len(begin))
    at = tests.place[suffix]
    while len(live):
        k = run[live]
        here = np.where(begin[live] + k < len(ranks), ranks[np.minimum(begin[live] + k, len(ranks) - 1)], -1)
        there = tests.ids[at[live] + k]
        same = (here == there) & (there > 0)
        less[live[~same]] = there[~same] < here[~same]
        live = live[same]
        run[live] += 1
    return run, less


def _longest(ranks: np.ndarray, begin: np.ndarray, group: np.ndarray, tests: Tests) -> np.ndarray:
    """The longest match of each place among its group's sorted suffixes: it is beside where the place itself would stand."""
    size = tests.size[group]
    first, last = tests.start[group], tests.start[group + 1]
    lo, hi = first.copy(), last.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            break
        mid = (lo[open_] + hi[open_]) // 2
        _, less = _common(ranks, begin[open_], tests.sorted[mid], size[open_], tests)
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]
    out = size.copy()
    for near in (lo - 1, lo):
        k = np.flatnonzero((near >= first) & (near < last))
        run, _ = _common(ranks, begin[k], tests.sorted[near[k]], size[k], tests)
        out[k] = np.maximum(out[k], run)
    return out


def _hits(column: pa.Array, tests: Tests) -> list[tuple]:
    """Of each row: words, hit spans, item names and the longest match."""
    words = Words(column)
    n_docs = len(column)
    if not len(words.key) or not len(tests.sorted):
        return [(int(n), [], [], 0) for n in np.diff(words.first)]
    begin, run, group = search(words, tests)
    size = tests.size[group]
    step = np.zeros(len(words.key) + 1, np.int64)
    np.add.at(step, begin, 1)
    np.add.at(step, begin + size, -1)
    hit = np.concatenate([[False], np.cumsum(step)[:-1] > 0, [False]])
    # a span also ends with its document
    doc_of = np.searchsorted(words.first, begin, "right") - 1
    pairs = np.unique(doc_of * len(tests.size) + group)
    longest = np.zeros(n_docs, np.int64)
    np.maximum.at(longest, doc_of, run)
    groups: dict[int, list[int]] = {}
    for d, g in zip((pairs // len(tests.size)).tolist(), (pairs % len(tests.size)).tolist(), strict=True):
        groups.setdefault(d, []).append(g)
    out, known = [], {}
    for d in range(n_docs):
        a, b = int(words.first[d]), int(words.first[d + 1])
        if d not in groups:
            out.append((b - a, [], [], 0))
            continue
        own = np.concatenate([[False], hit[a + 1 : b + 1], [False]])
        edges = np.flatnonzero(own[1:] != own[:-1])
        spans = [{"begin": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2], strict=True)]
        out.append((b - a, spans, tests.names_of(tuple(groups[d]), known), int(longest[d])))
    return out


_SPAN = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_FOUND = "_n_words long, _spans array<struct<begin: long, end: long>>, _items array<string>, _longest long"


def _union(old: list[dict], new: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(old + new, key=lambda s: (s["begin"], s["end"])):
        if out and s["begin"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return out


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", limit: int = BENCHMARK_BYTES) -> DataFrame:
    """``docs`` with _n_words, _spans (hit word ranges), _items (names of items with occurring windows) and _longest."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.coalesce("text", F.lit("")).alias("body"))
    blocks = 1 + int(items.agg(F.coalesce(F.sum(F.octet_length("body") + F.octet_length("name")), F.lit(0))).first()[0]) // limit
    out = docs
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("name", "body"), F.lit(blocks)) == b) if blocks > 1 else items
        # at most `limit` bytes of text, sorted here once
        shared = spark.sparkContext.broadcast(Tests([(r["name"], r["body"]) for r in block.distinct().collect()]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, again=b > 0) -> Iterator[pa.RecordBatch]:
            tests = shared.value
            for batch in slices(batches, text):
                found = _hits(batch.column(text), tests)
                if again:
                    old = batch.select(["_spans", "_items", "_longest"]).to_pylist()
                    found = [(n, _union(o["_spans"], s), sorted({*o["_items"], *i}), max(o["_longest"], x)) for o, (n, s, i, x) in zip(old, found, strict=True)]
                    batch = batch.drop_columns(["_n_words", "_spans", "_items", "_longest"])
                n, spans, names, longest = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(spans, _SPAN), pa.array(names, pa.list_(pa.string())), pa.array(longest, pa.int64())], [*batch.schema.names, "_n_words", "_spans", "_items", "_longest"])

        out = out.mapInArrow(run, schema_of(docs) + ", " + _FOUND)
    return out


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest of each row of ``docs``."""
    found = matches(docs.select("doc_id", "text"), benchmark)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    return found.select("doc_id", F.col("_n_words").alias("n_words"), hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"), (F.size("_spans") > 0).alias("contaminated"), F.col("_longest").alias("longest"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, with their columns as they are."""
    kept = matches(set_apart(docs, text), benchmark, text).where(F.size("_spans") == 0).drop("_n_words", "_spans", "_items", "_longest")
    return kept.toDF(*docs.columns)
