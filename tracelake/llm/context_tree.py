"""Language-model scoring by context-tree weighting over bytes.

A text is its bytes, A-Z lower-cased, and one end (a byte that UTF-8 lacks, which also
stands before each text as its context). The eight bits of a byte are decided one after
another; for every prefix of bits a context tree over the ``DEPTH`` bytes before counts
zeros and ones of all training texts. A node's probability of its bits is half the
Krichevsky-Trofimov estimate and half the product of its children, from the leaves to the
root; from these come the weights with which the estimates of all depths are mixed to
predict a bit. A context that training never held takes the estimate of its parent. The
score of a text is the sum over its bytes, so its code length; counts are never cut or
hashed away.

On Spark: texts are dealt into slices of ``SLICE`` bytes, each of which asks for its
different (context, byte) codes and words, packed by shard. A shard holds all contexts
that end in some pairs of bytes, so trees below depth 2 live whole in one shard; the
at most 65,280 nodes of depth 1 are summed by Spark and mixed on the driver. Shards answer
the slices that asked, and a slice scores its texts with the answers: no part of the model
is broadcast but depths 0 and 1, and work, disk and memory follow different codes, not
rows. A hot word or passage is one code of each slice.

Beside it stands the base of single words: counts with 0.1 added.

Defined results: null and empty texts are the end alone; repeated rows have equal scores;
without training texts each byte has 1/256 and words none is known; columns of any name
are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _LOWER, mix, schema_of, set_apart, slices, utf8, written

DEPTH = 5
#: Text bytes of a slice, bytes handled at once, and shards of codes (and of words).
SLICE, PIECE, SHARDS = 32 << 20, 2 << 20, 1024
END = 0xFF
_DOC, _CODES, _WORDS = 0, 1, 2
_ASKED = "_kind int, _slice bigint, _shard int, _keys binary, _n binary"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_U = np.uint64


def pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, rows) of the bytes and ends of a column: a code holds the contexts' bytes, the last one first, and then the byte."""
    raw, at = utf8(column)
    rows = len(at) - 1
    stream = np.full(len(raw) + rows * (DEPTH + 1), END, np.uint8)
    row = np.repeat(np.arange(rows), np.diff(at))
    place = np.arange(len(raw)) + (row + 1) * DEPTH + row
    stream[place] = _LOWER[raw]
    ends = at[1:] + np.arange(1, rows + 1) * DEPTH + np.arange(rows)
    place, row = np.insert(place, at[1:], ends), np.insert(row, at[1:], np.arange(rows))
    for k in range(0, len(place), PIECE):
        here = place[k : k + PIECE]
        code = np.zeros(len(here), _U)
        for back in range(1, DEPTH + 1):
            code = code << _U(8) | stream[here - back]
        yield code << _U(8) | stream[here], row[k : k + PIECE]


def narrow(n: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold the greatest of them."""
    return n.astype(np.min_scalar_type(int(n.max()))).tobytes()


def wide(raw: bytes, many: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{len(raw) // many}").astype(np.int64)


def short(codes: np.ndarray) -> bytes:
    """Codes without the bytes that none of them uses."""
    return codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : DEPTH + 1].tobytes()


def whole(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // (DEPTH + 1), 8), np.uint8)
    out[:, : DEPTH + 1] = np.frombuffer(raw, np.uint8).reshape(-1, DEPTH + 1)
    return out.view("<u8").ravel()


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about ``PIECE`` bytes at a time."""
    begin = 0
    while len(text) - begin > PIECE:
        cut = _SPACE.search(text, begin + PIECE)
        if not cut:
            break
        yield text[begin : cut.start()].split()
        begin = cut.end()
    yield text[begin:].split()


def summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order and their summed counts."""
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def counted(codes: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes and how often a learnt row holds each (codes of other rows: 0 times)."""
    both, n = np.unique(codes << _U(1) | learn.astype(_U), return_counts=True)
    return summed(both >> _U(1), np.where(both & _U(1), n, 0))


class _Slice:
    """What the rows of a slice ask for."""

    def __init__(self):
        self.size, self.parts, self.words = 0, [], {b"": 0}

    def add(self, batch: pa.RecordBatch) -> None:
        text, learn = batch.column("text"), np.array(batch.column("_learn").to_pylist(), bool)
        for codes, row in pieces(text):
            self.parts.append(counted(codes, learn[row]))
        raw, at = utf8(text)
        low, own = _LOWER[raw].tobytes(), self.words
        for k in range(len(learn)):
            for some in words(low[at[k] : at[k + 1]]):
                if learn[k]:
                    for w in some:
                        own[w] = own.get(w, 0) + 1
                else:
                    for w in some:
                        own.setdefault(w, 0)
        own[b""] += int(learn.sum())
        self.size += len(raw)
        if len(self.parts) > 16:
            self.parts = [summed(*map(np.concatenate, zip(*self.parts, strict=True)))]

    def asked(self) -> Iterator[tuple[int, int, bytes, bytes]]:
        """(kind, shard, keys, counts)."""
        codes, n = summed(*map(np.concatenate, zip(*self.parts, strict=True)))
        shard = (mix(codes >> _U(8 * (DEPTH - 1))) % _U(SHARDS)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        codes, n, shard = codes[order], n[order].astype(np.int64), shard[order]
        edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield _CODES, int(shard[a]), short(codes[a:b]), narrow(n[a:b])
        dealt: dict[int, list[bytes]] = {}
        for w in self.words:
            dealt.setdefault(SHARDS + crc32(w) % SHARDS, []).append(w)
        for s, own in dealt.items():
            yield _WORDS, s, b" ".join(own), narrow(np.array([self.words[w] for w in own], np.int64))


def _dealt(docs: DataFrame) -> DataFrame:
    """Rows of documents with the slice they belong to, and what each slice asks of each shard; written, so that slices stay what they are."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held, schema = TaskContext.get().partitionId() << 32, 0, _Slice(), None

        def marked(columns: list, kind: list, shard: list, keys: list, n: list) -> pa.RecordBatch:
            made = [pa.array(kind, pa.int32()), pa.array([part + k] * len(kind), pa.int64()), pa.array(shard, pa.int32()), pa.array(keys, pa.binary()), pa.array(n, pa.binary())]
            return pa.RecordBatch.from_arrays([*columns, *made], [*schema.names, "_kind", "_slice", "_shard", "_keys", "_n"])

        def asked() -> Iterator[pa.RecordBatch]:
            found = list(held.asked())
            for a in range(0, len(found), 256):
                kind, shard, keys, n = map(list, zip(*found[a : a + 256], strict=True))
                yield marked([pa.nulls(len(kind), t) for t in schema.types], kind, shard, keys, n)

        for batch in slices(batches, most=PIECE):
            schema, some = batch.schema, batch.num_rows
            held.add(batch)
            yield marked(batch.columns, [_DOC] * some, [-1] * some, [None] * some, [None] * some)
            if held.size >= SLICE:
                yield from asked()
                k, held = k + 1, _Slice()
        if held.parts:
            yield from asked()

    return written(docs.mapInArrow(deal, f"{schema_of(docs)}, {_ASKED}"), "slices", "zstd")


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
    """(shard, row) of batches sorted by shard."""
    for batch in batches:
        for row in batch.to_pylist():
            yield row["_shard"], row


def _merged(asked: DataFrame) -> DataFrame:
    """(_shard, _keys, _n, tokens, different): the counts of all slices, codes in order."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(shard: int, parts: list, own: dict) -> pa.RecordBatch:
            if shard < SHARDS:
                codes, n = summed(*map(np.concatenate, zip(*parts, strict=True)))
                row = (short(codes), narrow(n), 0, 0)
            else:
                row = (b" ".join(own), narrow(np.array(list(own.values()), np.int64)), sum(own.values()), sum(n > 0 for n in own.values()))
            return pa.RecordBatch.from_pydict({"_shard": pa.array([shard], pa.int32()), "_keys": pa.array([row[0]], pa.binary()), "_n": pa.array([row[1]], pa.binary()), "tokens": [row[2]], "different": [row[3]]})

        shard, parts, own, size = None, [], {}, 0
        for here, row in _by_shard(batches):
            if here != shard:
                if shard is not None:
                    yield out(shard, parts, own)
                shard, parts, own, size = here, [], {}, 0
            if here < SHARDS:
                codes = whole(row["_keys"])
                parts.append((codes, wide(row["_n"], len(codes))))
                size += len(codes)
                if len(parts) > 1 and size > 2 * len(parts[0][0]) + PIECE:
                    parts = [summed(*map(np.concatenate, zip(*parts, strict=True)))]
                    size = len(parts[0][0])
            else:
                some = row["_keys"].split(b" ")
                for w, c in zip(some, wide(row["_n"], len(some)).tolist(), strict=True):
                    own[w] = own.get(w, 0) + c
        if shard is not None:
            yield out(shard, parts, own)

    dealt = asked.select("_shard", "_keys", "_n").repartition("_shard").sortWithinPartitions("_shard")
    return written(dealt.mapInArrow(merge, "_shard int, _keys binary, _n binary, tokens bigint, different bigint"), "counts")


_HALF = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1 << 12) + 0.5))])  # log of gamma(k + 1/2) / gamma(1/2)
_WHOLE = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 1 << 12)))])  # log of k!


def _stirling(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x)


def kt(total: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of ``total`` bits of which ``ones`` are one."""

    def gamma(n: np.ndarray, table: np.ndarray, add: float, less: float) -> np.ndarray:
        small = n < len(table)
        return np.where(small, table[np.where(small, n, 0)], _stirling(np.where(small, 1, n) + add) - less)

    root = 0.5 * math.log(math.pi)
    return gamma(ones, _HALF, 0.5, root) + gamma(total - ones, _HALF, 0.5, root) - gamma(total, _WHOLE, 1.0, 0.0)


class Level:
    """The nodes of one depth: for each number of bits the node of every code, and the nodes' counts."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        self.node, self.total, self.ones, self.first = [], [], [], []
        for b in range(8):
            prefix = codes >> _U(8 - b)
            new = np.concatenate([[True], prefix[1:] != prefix[:-1]])
            first = np.flatnonzero(new)
            self.node.append(np.cumsum(new) - 1)
            self.first.append(first)
            self.total.append(np.add.reduceat(n, first))
            self.ones.append(np.add.reduceat(n * (codes >> _U(7 - b) & _U(1)).astype(np.int64), first))


def bits(codes: np.ndarray) -> list[np.ndarray]:
    return [(codes >> _U(7 - b) & _U(1)).astype(bool) for b in range(8)]


def _estimate(total: np.ndarray, ones: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (np.where(bit, ones, total - ones) + 0.5) / (total + 1.0)


def _weight(log_odds: np.ndarray) -> np.ndarray:
    """Share of a node's own estimate, from the logarithm of its odds against the children."""
    return 0.5 * (1 + np.tanh(0.5 * log_odds))


class Tree:
    """The trees of a shard's codes (sorted, one of a kind), from depth ``DEPTH`` up to ``top``."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, top: int = 2):
        self.top, self.codes = top, codes
        self.levels, self.up, self.odds = {}, {}, {}
        below = None
        for d in range(DEPTH, top - 1, -1):
            level = self.levels[d] = Level(codes, n)
            own = [kt(t, o) for t, o in zip(level.total, level.ones, strict=True)]
            if below is None:
                log = own
            else:
                children = [self._children(d, b, below) for b in range(8)]
                self.odds[d] = [a - c for a, c in zip(own, children, strict=True)]
                log = [np.logaddexp(a, c) - math.log(2) for a, c in zip(own, children, strict=True)]
            if d > top:
                shorter, parent = np.unique(codes >> _U(16) << _U(8) | codes & _U(255), return_inverse=True)
                n = np.bincount(parent, weights=n, minlength=len(shorter)).astype(np.int64)
                codes, self.up[d] = shorter, parent
            below = log
        self.log, self.at_top = below, codes

    def _children(self, d: int, b: int, log: list[np.ndarray]) -> np.ndarray:
        """Summed logarithms of the nodes one deeper."""
        level, deeper = self.levels[d], self.levels[d + 1]
        return np.bincount(level.node[b][self.up[d + 1][deeper.first[b]]], weights=log[b], minlength=len(level.first[b]))

    def summary(self) -> Iterator[tuple[int, int, int, int, float]]:
        """(last byte, bit prefix, total, ones, log of the children) for the nodes above ``top`` = 2."""
        level = self.levels[self.top]
        for b in range(8):
            code = self.at_top[level.first[b]]
            key = (code >> _U(16)).astype(np.int64) << 8 | 1 << b | ((code & _U(255)) >> _U(8 - b)).astype(np.int64)
            keys, node = np.unique(key, return_inverse=True)
            sums = [np.bincount(node, weights=w) for w in (level.total[b], level.ones[b], self.log[b])]
            yield from zip((keys >> 8).tolist(), (keys & 255).tolist(), sums[0].astype(np.int64).tolist(), sums[1].astype(np.int64).tolist(), sums[2].tolist(), strict=True)

    def log10(self, above: Top) -> np.ndarray:
        """log10 of the probability of each code's byte after its context."""
        out = np.zeros(len(self.codes))
        for b, bit in enumerate(bits(self.codes)):
            at, deep, seen = np.arange(len(self.codes)), None, None
            for d in range(DEPTH, self.top - 1, -1):
                level = self.levels[d]
                node = level.node[b][at]
                total = level.total[b][node]
                own = _estimate(total, level.ones[b][node], bit)
                if deep is None:
                    deep = own
                else:
                    share = _weight(self.odds[d][b][node])
                    deep = share * own + (1 - share) * np.where(seen, deep, own)
                seen = total > 0
                at = self.up[d][at] if d > self.top else at
            out += np.log10(above.mixed(self.codes, b, bit, deep, seen))
        return out


class Top:
    """Depths 0 and 1: 255 nodes for each of 256 last bytes at most."""

    def __init__(self, rows: list[tuple[int, int, int, int, float]]):
        total, ones, log = np.zeros((256, 256), np.int64), np.zeros((256, 256), np.int64), np.zeros((256, 256))
        for byte, prefix, t, o, x in rows:
            total[byte, prefix], ones[byte, prefix], log[byte, prefix] = t, o, x
        own = kt(total, ones)
        self.total, self.ones, self.share = total, ones, _weight(own - log)
        self.total0, self.ones0 = total.sum(0), ones.sum(0)
        self.share0 = _weight(kt(self.total0, self.ones0) - (np.logaddexp(own, log) - math.log(2)).sum(0))

    def mixed(self, codes: np.ndarray, b: int, bit: np.ndarray, deep: np.ndarray, seen: np.ndarray) -> np.ndarray:
        prefix = 1 << b | ((codes & _U(255)) >> _U(8 - b)).astype(np.int64)
        last = (codes >> _U(8 * DEPTH)).astype(np.int64)
        total = self.total[last, prefix]
        own, share = _estimate(total, self.ones[last, prefix], bit), self.share[last, prefix]
        one = share * own + (1 - share) * np.where(seen, deep, own)
        root, share0 = _estimate(self.total0[prefix], self.ones0[prefix], bit), self.share0[prefix]
        return share0 * root + (1 - share0) * np.where(total > 0, one, root)


def _top(counts: DataFrame) -> Top:
    """Depths 0 and 1 from the sums over shards: 65,280 rows at most reach the driver."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, row in _by_shard(batches):
            codes = whole(row["_keys"])
            found = list(Tree(codes, wide(row["_n"], len(codes))).summary())
            yield pa.RecordBatch.from_pydict(dict(zip(("byte", "prefix", "total", "ones", "log"), zip(*found, strict=True), strict=True)))

    nodes = counts.where(F.col("_shard") < SHARDS).select("_shard", "_keys", "_n").mapInArrow(summarise, "byte bigint, prefix bigint, total bigint, ones bigint, log double")
    return Top([tuple(r) for r in nodes.groupBy("byte", "prefix").agg(F.sum("total"), F.sum("ones"), F.sum("log")).collect()])


def _answers(asked: DataFrame, counts: DataFrame, top: Top) -> DataFrame:
    """(_kind, _slice, _keys, _n): for the keys that slices asked for log10 of a code's probability, or the count of a word."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, codes, log, own = None, None, None, {}
        for here, row in _by_shard(batches):
            if row["_slice"] < 0:  # the counts of a shard come before what is asked of it
                shard = here
                if here < SHARDS:
                    codes = whole(row["_keys"])
                    log = Tree(codes, wide(row["_n"], len(codes))).log10(top)
                else:
                    some = row["_keys"].split(b" ")
                    own = dict(zip(some, wide(row["_n"], len(some)).tolist(), strict=True))
                continue
            assert here == shard, "a shard without counts"
            if here < SHARDS:
                got = log[np.searchsorted(codes, whole(row["_keys"]))].tobytes()
            else:
                got = narrow(np.array([own[w] for w in row["_keys"].split(b" ")], np.int64))
            yield pa.RecordBatch.from_pydict({"_kind": pa.array([row["_kind"]], pa.int32()), "_slice": pa.array([row["_slice"]], pa.int64()), "_keys": pa.array([row["_keys"]], pa.binary()), "_n": pa.array([got], pa.binary())})

    every = counts.select("_shard", F.lit(-1).alias("_kind"), F.lit(-1).cast("long").alias("_slice"), "_keys", "_n").unionByName(asked.select("_shard", "_kind", "_slice", "_keys", F.lit(None).cast("binary").alias("_n")))
    return every.repartition("_shard").sortWithinPartitions("_shard", "_slice").mapInArrow(answer, "_kind int, _slice bigint, _keys binary, _n binary")


class _Answers:
    """What the shards answered a slice."""

    def __init__(self, different: int, tokens: int):
        self.codes, self.log, self.words, self.whole = [], [], {}, tokens + 0.1 * (different + 1)

    def take(self, kind: int, keys: bytes, n: bytes) -> None:
        if kind == _CODES:
            self.codes.append(whole(keys))
            self.log.append(np.frombuffer(n, np.float64))
        else:
            some = keys.split(b" ")
            self.words.update(zip(some, wide(n, len(some)).tolist(), strict=True))

    def of(self, text: pa.Array) -> list[np.ndarray]:
        """Tokens, known tokens, log10 by words and by contexts, bits a byte, of each row."""
        if len(self.codes) > 1:
            codes, log = np.concatenate(self.codes), np.concatenate(self.log)
            order = np.argsort(codes, kind="stable")
            self.codes, self.log = [codes[order]], [log[order]]
        total, size = np.zeros(len(text)), np.zeros(len(text), np.int64)
        for codes, row in pieces(text):
            both, n = np.unique(codes << _U(16) | row.astype(_U), return_counts=True)
            row = (both & _U(0xFFFF)).astype(np.int64)
            total += np.bincount(row, weights=n * self.log[0][np.searchsorted(self.codes[0], both >> _U(16))], minlength=len(text))
            size += np.bincount(row, weights=n, minlength=len(text)).astype(np.int64)
        raw, at = utf8(text)
        low, every, tokens = _LOWER[raw].tobytes(), [], []
        for k in range(len(text)):
            before = len(every)
            for some in words(low[at[k] : at[k + 1]]):
                every += some
            every.append(b"")
            tokens.append(len(every) - before)
        count = np.fromiter(map(self.words.__getitem__, every), np.int64, len(every))
        first = np.cumsum([0, *tokens[:-1]])
        base = np.add.reduceat(np.log10((count + 0.1) / self.whole), first)
        return [np.array(tokens, np.int64), np.add.reduceat((count > 0).astype(np.int64), first), base, total, -total * math.log2(10) / size]


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """``docs`` with ``_n_tokens``, ``_n_known``, ``_train_tokens``, ``_base`` and ``_log10`` (log10 probabilities by words and by contexts), ``_bits_per_byte``.

    Rows where ``learn`` holds are those that counts come from. Words are
    ``[^\\x20\\x09-\\x0D]+``; a token is a word or the end.
    """
    own = set_apart(docs, "text").columns
    dealt = _dealt(docs.select("*", F.coalesce(learn, F.lit(False)).alias("_learn")).toDF(*own, "_learn"))
    rows, asked = dealt.where(F.col("_kind") == _DOC).select(*own, "_kind", "_slice"), dealt.where(F.col("_kind") != _DOC)
    counts = _merged(asked)
    tokens, different = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("different"), F.lit(0))).first()
    answers = _answers(asked, counts, _top(counts))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = None, None
        for batch in batches:
            name, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_slice", "_kind"))
            doc = kind == _DOC
            edges = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]) | (doc[1:] != doc[:-1]), [True]]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if name[a] != of:
                    held, of = _Answers(different, tokens), name[a]
                part = batch.slice(a, b - a)
                if not doc[a]:
                    for k in range(b - a):
                        held.take(int(kind[a + k]), part.column("_keys")[k].as_py(), part.column("_n")[k].as_py())
                    continue
                for some in slices(part.slice(k, 1 << 16) for k in range(0, b - a, 1 << 16)):
                    yield pa.RecordBatch.from_arrays([*[some.column(c) for c in own], *map(pa.array, held.of(some.column("text")))], [*own, *names])

    names = ["_n_tokens", "_n_known", "_base", "_log10", "_bits_per_byte"]
    kinds = ", ".join(f"{n} {k}" for n, k in zip(names, ["bigint", "bigint", "double", "double", "double"], strict=True))
    met = answers.unionByName(rows, allowMissingColumns=True).repartition("_slice").sortWithinPartitions("_slice", F.desc("_kind"))
    return met.mapInArrow(scored, f"{schema_of(rows.select(*own))}, {kinds}").toDF(*docs.columns, *names).withColumn("_train_tokens", F.lit(tokens).cast("long"))
