"""Lossless WebP (VP8L) encoders in numpy.

``gray_tiles`` writes many grey images at once, for bytes of text as samples:
subtract-green leaves one channel, whose symbols get a prefix code of each image's own
counts, and a line that stood before in its image is a back-reference. ``encode``
writes any pixels with any of the transforms, a colour cache and back-references; it
is plain and slow and serves small images.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .webp import CROSS_COLOR, DISTANCE_CODES, LANE_BITS, LENGTH_CODES, LENGTH_ORDER, LITERALS, NEAR, PALETTE, PREDICTOR, SUBTRACT_GREEN, predictions, reversed_bits

#: Lines shorter than this are not worth a back-reference; a reference has at most so many pixels.
LINE, RUN = 12, 4096
_GREEN = LITERALS + LENGTH_CODES
#: The code for code lengths is the same in every image: 3 bits for the lengths 8 and 9, 4 bits for these others.
_OWN = np.zeros(19, np.int64)
_OWN[[0, 1, 2, 3, 4, 5, 6, 7, 10, 11, 17, 18]] = 4
_OWN[[8, 9]] = 3


def code_lengths(count: np.ndarray, most: int = LANE_BITS) -> np.ndarray:
    """Lengths of a prefix code for the counts, none above ``most`` (counts are flattened until that holds)."""
    out = np.zeros(len(count), np.int64)
    used = np.flatnonzero(count)
    if len(used) < 2:
        out[used] = 1
        return out
    n = count[used]
    order = np.argsort(n, kind="stable")
    n = n[order]
    while True:
        leaf, inner, m = n.tolist(), [], len(used)
        parent, i, j = [0] * (2 * m - 1), 0, 0
        leaf.append(1 << 62)
        for k in range(m, 2 * m - 1):
            low = inner[j] if j < len(inner) else 1 << 62
            if leaf[i] <= low:
                total, parent[i], i = leaf[i], k, i + 1
            else:
                total, parent[m + j], j = low, k, j + 1
                low = inner[j] if j < len(inner) else 1 << 62
            if leaf[i] <= low:
                total, parent[i], i = total + leaf[i], k, i + 1
            else:
                total, parent[m + j], j = total + low, k, j + 1
            inner.append(total)
        depth = [0] * (2 * m - 1)
        for k in range(2 * m - 3, -1, -1):
            depth[k] = depth[parent[k]] + 1
        if max(depth[:m]) <= most:
            out[used[order]] = depth[:m]
            return out
        n = (n + 1) // 2 + 1


def codes_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, number of bits) of every symbol, ready to be written from the lowest bit on; a lone symbol has none."""
    value, width = np.zeros(len(lengths), np.uint64), lengths.copy()
    used = np.flatnonzero(lengths)
    if len(used) < 2:
        width[:] = 0
        return value, width
    order = used[np.argsort(lengths[used], kind="stable")]
    spread = 1 << (15 - lengths[order])
    value[order] = reversed_bits(15)[np.cumsum(spread) - spread]
    return value, width


_OWN_CODES = list(zip(*(x.tolist() for x in codes_of(_OWN)), strict=True))


@lru_cache
def _zeros(run: int) -> tuple[int, int]:
    """Bits for a run of 1 or of 3 to 138 zero lengths."""
    symbol, least, more = (0, 1, 0) if run < 3 else (17, 3, 3) if run < 11 else (18, 11, 7)
    value, bits = _OWN_CODES[symbol]
    return value | run - least << bits, bits + more


@lru_cache
def _own_head() -> tuple[int, int]:
    """Bits that begin a prefix code that isn't simple, up to its code lengths."""
    w = Writer()
    stored = [int(_OWN[k]) for k in LENGTH_ORDER]
    while not stored[-1]:
        stored.pop()
    for value, bits in ((0, 1), (len(stored) - 4, 4), *((n, 3) for n in stored), (0, 1)):
        w.put(value, bits)
    return w.value, w.size


class Writer:
    """Bit fields of a head, lowest bit first."""

    def __init__(self) -> None:
        self.value, self.size = 0, 0

    def put(self, value: int, bits: int) -> None:
        self.value |= value << self.size
        self.size += bits

    def code(self, lengths: np.ndarray) -> None:
        """A prefix code's lengths."""
        used = np.flatnonzero(lengths).tolist()
        if len(used) <= 2 and all(s < 256 for s in used):
            used = used or [0]
            self.put(1 | (len(used) - 1) << 1 | 1 << 2, 3)
            for s in used:
                self.put(s, 8)
            return
        if len(used) == 1:
            # a lone symbol above 255: another one shares the code, and both take a bit
            lengths = lengths.copy()
            lengths[0] = 1
        self.put(*_own_head())
        out, size, k, values = 0, 0, 0, lengths.tolist()
        for stop in [*np.flatnonzero(lengths).tolist(), len(values)]:
            while (zeros := stop - k) > 0:
                run = min(zeros, 138) if zeros >= 3 else 1
                value, bits = _zeros(run)
                out |= value << size
                size += bits
                k += run
            if k < len(values):
                value, bits = _OWN_CODES[values[k]]
                out |= value << size
                size += bits
                k += 1
        self.put(out, size)

    def lone(self, symbol: int) -> None:
        self.put(1 | 1 << 2, 3) if symbol > 1 else self.put(1, 3)
        self.put(symbol, 8 if symbol > 1 else 1)


def prefix_of(value: int) -> tuple[int, int, int]:
    """(prefix, extra bits, number of extra bits) of a length or distance from 1 on."""
    d = value - 1
    if d < 4:
        return d, 0, 0
    top = d.bit_length() - 1
    extra = top - 1
    return 2 * top + (d >> extra & 1), d & (1 << extra) - 1, extra


def packed(value: np.ndarray, width: np.ndarray, at: np.ndarray, n_words: int) -> np.ndarray:
    """64-bit words with each value (below 2**57) from bit ``at`` (ascending) on."""
    out = np.zeros(n_words + 1, np.uint64)
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
    if len(first):
        out[word[first]] = np.bitwise_or.reduceat(value << shift, first)
    over = np.flatnonzero((at & 63) + width > 64)
    out[word[over] + 1] |= value[over] >> (np.uint64(64) - shift[over])
    return out[:n_words]


def _file(body: bytes) -> bytes:
    chunk = b"VP8L" + len(body).to_bytes(4, "little") + body + b"\0" * (len(body) & 1)
    return b"RIFF" + (4 + len(chunk)).to_bytes(4, "little") + b"WEBP" + chunk


def _head(width: int, height: int, alpha: int) -> Writer:
    w = Writer()
    for value, bits in ((0x2F, 8), (width - 1, 14), (height - 1, 14), (alpha, 1), (0, 3)):
        w.put(value, bits)
    return w


def gray_tiles(tiles: list[bytes], width: int) -> list[bytes]:
    """One file for each tile (rows of ``width`` grey samples)."""
    size = np.array([len(t) for t in tiles])
    begin = np.concatenate([[0], np.cumsum(size)])
    symbol = np.frombuffer(b"".join(tiles), np.uint8).astype(np.int32)
    keep = np.ones(len(symbol), bool)
    extras: dict[int, tuple[int, int]] = {}
    refs: dict[int, list[tuple[int, int, int, int]]] = {}
    for k, tile in enumerate(tiles):
        seen: dict[bytes, int] = {}
        at = 0
        for line in tile.split(b"\n"):
            if len(line) >= LINE:
                if line in seen:
                    for part in range(0, len(line), RUN):
                        n = min(RUN, len(line) - part)
                        prefix, extra, bits = prefix_of(n)
                        d_prefix, d_extra, d_bits = prefix_of(at - seen[line] + len(NEAR))
                        place = int(begin[k]) + at + part
                        symbol[place] = LITERALS + prefix
                        keep[place + 1 : place + n] = False
                        extras[place] = extra, bits
                        refs.setdefault(k, []).append((place, d_prefix, d_extra, d_bits))
                else:
                    seen[line] = at
            at += len(line) + 1
    place = np.flatnonzero(keep)
    symbol = symbol[place]
    first = np.searchsorted(place, begin)
    slot = np.repeat(np.arange(0, len(tiles) * _GREEN, _GREEN, dtype=np.int32), np.diff(first)) + symbol
    count = np.bincount(slot, minlength=len(tiles) * _GREEN).reshape(-1, _GREEN)
    codes, widths, heads = np.zeros((len(tiles), _GREEN), np.uint64), np.zeros((len(tiles), _GREEN), np.int64), []
    distances = {}
    for k, t in enumerate(tiles):
        lengths = code_lengths(count[k])
        codes[k], widths[k] = codes_of(lengths)
        w = _head(width, len(t) // width, 0)
        # subtract green; no further transform, no cache, one group
        for value, bits in ((1, 1), (SUBTRACT_GREEN, 2), (0, 1), (0, 1), (0, 1)):
            w.put(value, bits)
        w.code(lengths)
        w.lone(0), w.lone(0), w.lone(255)
        if k in refs:
            own = code_lengths(np.bincount([r[1] for r in refs[k]], minlength=DISTANCE_CODES))
            distances[k] = [x.tolist() for x in codes_of(own)]
            w.code(own)
        else:
            w.lone(0)
        heads.append(w)
    value, bits = codes.ravel()[slot], widths.ravel()[slot]
    for k, own in refs.items():
        code, code_bits = distances[k]
        for p, d_prefix, d_extra, d_bits in own:
            i = int(np.searchsorted(place, p))
            extra, extra_bits = extras[p]
            v, n = int(value[i]), int(bits[i])
            for x, m in ((extra, extra_bits), (code[d_prefix], code_bits[d_prefix]), (d_extra, d_bits)):
                v |= x << n
                n += m
            value[i], bits[i] = v, n
    # every file begins at a word; its symbols follow its head
    upto = np.cumsum(bits)
    before = np.concatenate([[0], upto])[first[:-1]]
    total = np.concatenate([[0], upto])[first[1:]] - before + [w.size for w in heads]
    words = np.concatenate([[0], np.cumsum(-(-total // 64))])
    start = 64 * words[:-1]
    data = packed(value, bits, upto - bits + np.repeat(start + [w.size for w in heads] - before, np.diff(first)), int(words[-1])).view(np.uint8)
    out = []
    for k, w in enumerate(heads):
        a = 8 * int(words[k])
        head = np.frombuffer(w.value.to_bytes(-(-w.size // 8), "little"), np.uint8)
        data[a : a + len(head)] |= head
        out.append(_file(data[a : a + -(-int(total[k]) // 8)].tobytes()))
    return out


def _argb(pixels: np.ndarray) -> np.ndarray:
    p = pixels.reshape(-1, 4).astype(np.uint32)
    return p[:, 3] << 24 | p[:, 0] << 16 | p[:, 1] << 8 | p[:, 2]


def _image(w: Writer, argb: np.ndarray, width: int, top: bool, cache_bits: int, references: bool) -> None:
    """An entropy-coded image: the colour cache, one group of codes, the pixels."""
    w.put(cache_bits << 1 | 1, 5) if cache_bits else w.put(0, 1)
    if top:
        w.put(0, 1)
    cache, values, tokens, i = [0] * (1 << cache_bits), argb.tolist(), [], 0
    seen: dict[tuple, int] = {}
    slot = lambda p: (0x1E35A7BD * p & 0xFFFFFFFF) >> 32 - cache_bits
    while i < len(values):
        n, found = 1, seen.get(tuple(values[i : i + 4])) if references else None
        if found is not None and i + 4 <= len(values):
            n = 4
            while i + n < len(values) and n < RUN and values[i + n] == values[found + n]:
                n += 1
            tokens.append(("copy", n, i - found))
        elif cache_bits and cache[slot(values[i])] == values[i]:
            tokens.append(("cache", slot(values[i])))
        else:
            tokens.append(("pixel", values[i]))
        for k in range(i, i + n):
            if k + 4 <= len(values):
                seen[tuple(values[k : k + 4])] = k
            if cache_bits:
                cache[slot(values[k])] = values[k]
        i += n
    near = {d: k + 1 for d, k in reversed([(max(1, x + y * width), k) for k, (x, y) in enumerate(NEAR)])}
    counts = [np.zeros(n, np.int64) for n in (_GREEN + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCE_CODES)]
    fields: list[list[tuple]] = []
    for kind, *own in tokens:
        if kind == "pixel":
            p = own[0]
            parts = [(0, p >> 8 & 255), (1, p >> 16 & 255), (2, p & 255), (3, p >> 24)]
        elif kind == "cache":
            parts = [(0, _GREEN + own[0])]
        else:
            a, b = prefix_of(own[0]), prefix_of(near.get(own[1], own[1] + len(NEAR)))
            parts = [(0, LITERALS + a[0]), ("bits", *a[1:]), (4, b[0]), ("bits", *b[1:])]
        for x in parts:
            if x[0] != "bits":
                counts[x[0]][x[1]] += 1
        fields.append(parts)
    codes = []
    for c in counts:
        lengths = code_lengths(c)
        if np.count_nonzero(lengths) == 1 and lengths.argmax() > 255:
            lengths[0] = 1
        w.code(lengths)
        codes.append([x.tolist() for x in codes_of(lengths)])
    for parts in fields:
        for x in parts:
            if x[0] == "bits":
                w.put(x[1], x[2])
            else:
                w.put(codes[x[0]][0][x[1]], codes[x[0]][1][x[1]])


def cross_color(pixels: np.ndarray, element: tuple[int, int, int]) -> np.ndarray:
    """Pixels less what (red to blue, green to blue, green to red) predicts."""
    delta = lambda t, c: (np.int16(t) * c.view(np.int8).astype(np.int16) >> 5).astype(np.uint8)
    out = pixels.copy()
    green, red = pixels[..., 1].copy(), pixels[..., 0].copy()
    out[..., 0] -= delta(element[2], green)
    out[..., 2] -= delta(element[1], green) + delta(element[0], red)
    return out


def encode(pixels: np.ndarray, transforms: tuple[str, ...] = (), cache_bits: int = 0, references: bool = True, mode: int | np.ndarray = 11, element: tuple[int, int, int] = (0, 0, 0), shift: int = 3) -> bytes:
    """A file of (height, width, 4) bytes. ``transforms``: of predictor, cross_color, subtract_green, palette, in the order of writing."""
    height, width, _ = pixels.shape
    w, pixels = _head(width, height, int((pixels[..., 3] != 255).any())), pixels.copy()
    for name in transforms:
        w.put(1, 1)
        if name == "subtract_green":
            w.put(SUBTRACT_GREEN, 2)
            pixels[..., 0] -= pixels[..., 1]
            pixels[..., 2] -= pixels[..., 1]
        elif name == "palette":
            colours, index = np.unique(_argb(pixels), return_inverse=True)
            if len(colours) > 256:
                raise ValueError("more than 256 colours")
            w.put(PALETTE, 2)
            w.put(len(colours) - 1, 8)
            each = np.stack([colours >> k & 255 for k in (16, 8, 0, 24)], axis=-1).astype(np.uint8)
            _image(w, _argb(np.diff(each, axis=0, prepend=np.zeros((1, 4), np.uint8))), len(colours), False, 0, False)
            pack = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1 if len(colours) <= 16 else 0
            bits = 8 >> pack
            index = index.reshape(height, width)
            index = np.pad(index, ((0, 0), (0, -width % (1 << pack)))).reshape(height, -1, 1 << pack)
            green = (index << np.arange(1 << pack) * bits).sum(axis=-1).astype(np.uint8)
            pixels = np.zeros((height, green.shape[1], 4), np.uint8)
            pixels[..., 1], pixels[..., 3] = green, 255
        else:
            w.put(PREDICTOR if name == "predictor" else CROSS_COLOR, 2)
            w.put(shift - 2, 3)
            down, across = -(-pixels.shape[0] >> shift), -(-pixels.shape[1] >> shift)
            block = np.zeros((down, across, 4), np.uint8)
            block[..., 3] = 255
            if name == "predictor":
                block[..., 1] = mode
                y, x = (a.ravel() for a in np.mgrid[: pixels.shape[0], : pixels.shape[1]])
                guess = predictions(pixels.astype(np.int16), block[y >> shift, x >> shift, 1], y, x)
                pixels = (pixels.reshape(-1, 4) - guess).astype(np.uint8).reshape(pixels.shape)
            else:
                block[..., :3] = np.array(element, np.int8).view(np.uint8)
                pixels = cross_color(pixels, element)
            _image(w, _argb(block), across, False, 0, references)
    w.put(0, 1)
    _image(w, _argb(pixels), pixels.shape[1], True, cache_bits, references)
    return _file(w.value.to_bytes(-(-w.size // 8), "little"))
