"""Lossless WebP (VP8L) decoder in numpy.

``decode`` reads any lossless image: prefix codes in one or many groups,
back-references, colour cache, and the inverse predictor, cross-colour,
subtract-green and palette transforms. ``decode_many`` reads many images at once:
those with one prefix group, one varying channel and no colour cache (what
``webp_encode.gray_tiles`` writes) advance together, one symbol a step and a lane an
image; the others go through ``decode``. Broken files raise ``ValueError``.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Fixed values of the format: the order in which lengths of the code-length code are stored.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
PREDICTOR, CROSS_COLOR, SUBTRACT_GREEN, PALETTE = range(4)
LITERALS, LENGTH_CODES, DISTANCE_CODES = 256, 24, 40
#: The first distance codes name near pixels (left, up), nearest first.
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))
#: Longest code of an image that decodes in a lane.
LANE_BITS = 11


@lru_cache
def reversed_bits(bits: int) -> np.ndarray:
    """Each number below 2**bits with its bits in reverse order."""
    n = np.arange(1 << bits)
    return sum((n >> k & 1) << (bits - 1 - k) for k in range(bits)) if bits else n


class Bits:
    """Reads little-endian bit fields of up to 32 bits."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at
        self._load()

    def _load(self) -> None:
        self.base = self.at & ~7
        self.head = int.from_bytes(self.data[self.base >> 3 : (self.base >> 3) + 160], "little")

    def peek(self, n: int) -> int:
        d = self.at - self.base
        if d > 1200:
            self._load()
            d = self.at - self.base
        return self.head >> d & (1 << n) - 1

    def take(self, n: int) -> int:
        out = self.peek(n)
        self.at += n
        if self.at > 8 * len(self.data) + 64:
            raise ValueError("the image ends early")
        return out


def table(lengths: np.ndarray, bits: int) -> np.ndarray:
    """symbol << 4 | length for each window of the next ``bits`` bits; a lone symbol takes none."""
    used = np.flatnonzero(lengths)
    if len(used) == 1:
        return np.full(1 << bits, used[0] << 4, np.uint16)
    own = lengths[used]
    order = np.argsort(own, kind="stable")
    own = own[order]
    spread = 1 << (bits - own)
    if not len(used) or spread.sum() != 1 << bits:
        raise ValueError("a prefix code isn't complete")
    return np.repeat((used[order] << 4 | own).astype(np.uint16), spread)[reversed_bits(bits)]


@lru_cache(maxsize=64)
def _length_table(own: tuple[int, ...]) -> list[int]:
    return table(np.array(own), 7).tolist()


def read_lengths(b: Bits, size: int) -> np.ndarray:
    """Code lengths of the next prefix code."""
    out = np.zeros(size, np.int64)
    if b.take(1):
        two = b.take(1)
        out[b.take(8 if b.take(1) else 1)] = 1
        if two:
            out[b.take(8)] = 1
        return out
    own = [0] * 19
    for k in range(4 + b.take(4)):
        own[LENGTH_ORDER[k]] = b.take(3)
    tokens = 2 + b.take(2 + 2 * b.take(3)) if b.take(1) else size
    code, before, found = _length_table(tuple(own)), 8, []
    at, base, head = b.at, b.base, b.head
    while len(found) < size and tokens:
        tokens -= 1
        if at - base > 1200:
            b.at = at
            b._load()
            base, head = b.base, b.head
        window = head >> at - base
        e = code[window & 127]
        at += e & 15
        s = e >> 4
        if s < 16:
            found.append(s)
            before = s or before
        else:
            window >>= e & 15
            more, least = ((2, 3), (3, 3), (7, 11))[s - 16]
            found += [before if s == 16 else 0] * (least + (window & (1 << more) - 1))
            at += more
    b.at = at
    b.take(0)
    if len(found) > size:
        raise ValueError("too many code lengths")
    out[: len(found)] = found
    return out


class Code:
    """A prefix code for reading one symbol at a time."""

    def __init__(self, lengths: np.ndarray):
        self.bits = int(lengths.max(initial=0))
        self.table = table(lengths, self.bits).tolist()

    def read(self, b: Bits) -> int:
        e = self.table[b.peek(self.bits)]
        b.take(e & 15)
        return e >> 4


def read_value(b: Bits, prefix: int) -> int:
    """A length or distance from its prefix and the extra bits that follow."""
    if prefix < 4:
        return prefix + 1
    extra = (prefix - 2) >> 1
    return ((2 + (prefix & 1)) << extra) + b.take(extra) + 1


def distance_of(value: int, width: int) -> int:
    if value > len(NEAR):
        return value - len(NEAR)
    x, y = NEAR[value - 1]
    return max(1, x + y * width)


def _sizes(cache_bits: int) -> tuple[int, ...]:
    return (LITERALS + LENGTH_CODES + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCE_CODES)


class Entropy:
    """The head of an entropy-coded image: colour cache, groups of codes and where which holds."""

    def __init__(self, b: Bits, width: int, height: int, top: bool):
        self.width, self.height = width, height
        self.cache_bits = b.take(4) if b.take(1) else 0
        if self.cache_bits > 11:
            raise ValueError("the colour cache is too large")
        self.shift, self.groups = 0, None
        n = 1
        if top and b.take(1):
            self.shift = b.take(3) + 2
            self.across = -(-width >> self.shift)
            meta = Entropy(b, self.across, -(-height >> self.shift), False).read(b)
            self.groups = (meta >> 8 & 0xFFFF).tolist()
            n = max(self.groups) + 1
        self.lengths = [[read_lengths(b, size) for size in _sizes(self.cache_bits)] for _ in range(n)]

    def read(self, b: Bits) -> np.ndarray:
        """The pixels, as alpha << 24 | red << 16 | green << 8 | blue."""
        codes = [[Code(x) for x in group] for group in self.lengths]
        n, width, cache = self.width * self.height, self.width, [0] * (1 << self.cache_bits)
        out: list[int] = []
        drop = 32 - self.cache_bits

        def emit(p: int) -> None:
            out.append(p)
            if self.cache_bits:
                cache[(0x1E35A7BD * p & 0xFFFFFFFF) >> drop] = p

        green, red, blue, alpha, distance = codes[0]
        while (i := len(out)) < n:
            if self.groups:
                green, red, blue, alpha, distance = codes[self.groups[(i // width >> self.shift) * self.across + (i % width >> self.shift)]]
            s = green.read(b)
            if s < LITERALS:
                r, x = red.read(b), blue.read(b)
                emit(alpha.read(b) << 24 | r << 16 | s << 8 | x)
            elif s < LITERALS + LENGTH_CODES:
                length = read_value(b, s - LITERALS)
                d = distance_of(read_value(b, distance.read(b)), width)
                if d > i or i + length > n:
                    raise ValueError("a back-reference leaves the image")
                for _ in range(length):
                    emit(out[-d])
            else:
                emit(cache[s - LITERALS - LENGTH_CODES])
        return np.array(out, np.uint32)


def channels(argb: np.ndarray, width: int) -> np.ndarray:
    """(height, width, 4) bytes: red, green, blue, alpha."""
    return np.stack([argb >> k & 255 for k in (16, 8, 0, 24)], axis=-1).astype(np.uint8).reshape(-1, width, 4)


class Image:
    """A parsed file: size, transforms (in stored order), the entropy head and the reader at the first pixel."""

    def __init__(self, data: bytes):
        if data[:4] != b"RIFF" or data[8:12] != b"WEBP" or data[12:16] != b"VP8L":
            raise ValueError("no lossless WebP file")
        self.bits = b = Bits(data, 8 * 20)
        if b.take(8) != 0x2F:
            raise ValueError("no lossless WebP signature")
        self.width, self.height = b.take(14) + 1, b.take(14) + 1
        self.alpha = b.take(1)
        if b.take(3):
            raise ValueError("unknown version")
        self.transforms: list[tuple] = []
        width = self.width
        while b.take(1):
            kind = b.take(2)
            if any(kind == t[0] for t in self.transforms):
                raise ValueError("a transform stands twice")
            if kind in (PREDICTOR, CROSS_COLOR):
                shift = b.take(3) + 2
                across, down = -(-width >> shift), -(-self.height >> shift)
                self.transforms.append((kind, shift, channels(Entropy(b, across, down, False).read(b), across)))
            elif kind == PALETTE:
                size = b.take(8) + 1
                colours = np.cumsum(channels(Entropy(b, size, 1, False).read(b), size)[0].astype(np.int64), axis=0).astype(np.uint8)
                pack = 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0
                self.transforms.append((kind, pack, colours, width))
                width = -(-width >> pack)
            else:
                self.transforms.append((kind,))
        self.inner = width
        self.entropy = Entropy(b, width, self.height, True)

    def laned(self) -> bool:
        """Whether only the green channel varies, by one short prefix code without a colour cache."""
        e = self.entropy
        return e.groups is None and not e.cache_bits and e.lengths[0][0].max() <= LANE_BITS and all(np.count_nonzero(x) == 1 for x in e.lengths[0][1:4])

    def finished(self, pixels: np.ndarray) -> np.ndarray:
        """The transforms undone, last first."""
        for kind, *own in reversed(self.transforms):
            if kind == PREDICTOR:
                pixels = undo_predictor(pixels, *own)
            elif kind == CROSS_COLOR:
                pixels = undo_cross_color(pixels, *own)
            elif kind == PALETTE:
                pixels = undo_palette(pixels, *own)
            else:
                pixels[..., 0] += pixels[..., 1]
                pixels[..., 2] += pixels[..., 1]
        return pixels


def undo_cross_color(pixels: np.ndarray, shift: int, elements: np.ndarray) -> np.ndarray:
    h, w, _ = pixels.shape
    own = elements.repeat(1 << shift, 0).repeat(1 << shift, 1)[:h, :w].view(np.int8).astype(np.int16)
    out = pixels.copy()
    green = pixels[..., 1].view(np.int8).astype(np.int16)
    out[..., 0] += (own[..., 2] * green >> 5).astype(np.uint8)
    red = out[..., 0].view(np.int8).astype(np.int16)
    out[..., 2] += (own[..., 1] * green >> 5).astype(np.uint8) + (own[..., 0] * red >> 5).astype(np.uint8)
    return out


def undo_palette(pixels: np.ndarray, pack: int, colours: np.ndarray, width: int) -> np.ndarray:
    index = pixels[..., 1]
    if pack:
        each = 8 >> pack
        index = np.stack([index >> k & (1 << each) - 1 for k in range(0, 8, each)], axis=-1).reshape(len(index), -1)[:, :width]
    # numbers beyond the palette are transparent black
    full = np.zeros((256, 4), np.uint8)
    full[: len(colours)] = colours
    return full[index]


def _half(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a + b) >> 1


def _select(left: np.ndarray, top: np.ndarray, corner: np.ndarray) -> np.ndarray:
    to_left, to_top = np.abs(top - corner).sum(axis=-1), np.abs(left - corner).sum(axis=-1)
    return np.where((to_left < to_top)[..., None], left, top)


def _clamped_half(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.clip(a + (d + (d < 0) >> 1), 0, 255)


#: Prediction by mode from the left, top, top-right and top-left pixels; other modes predict opaque black.
PREDICT = {
    1: lambda left, top, right, corner: left,
    2: lambda left, top, right, corner: top,
    3: lambda left, top, right, corner: right,
    4: lambda left, top, right, corner: corner,
    5: lambda left, top, right, corner: _half(_half(left, right), top),
    6: lambda left, top, right, corner: _half(left, corner),
    7: lambda left, top, right, corner: _half(left, top),
    8: lambda left, top, right, corner: _half(corner, top),
    9: lambda left, top, right, corner: _half(top, right),
    10: lambda left, top, right, corner: _half(_half(left, corner), _half(top, right)),
    11: lambda left, top, right, corner: _select(left, top, corner),
    12: lambda left, top, right, corner: np.clip(left + top - corner, 0, 255),
    13: lambda left, top, right, corner: _clamped_half(_half(left, top), corner),
}


def predictions(done: np.ndarray, modes: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Predicted channels of pixels (y, x) from an image in which all pixels before them are known."""
    h, w, _ = done.shape
    left, top, corner = done[y, x - 1], done[y - 1, x], done[y - 1, x - 1]
    # behind the last pixel of a row comes the first one of the next
    right = np.where((x + 1 < w)[:, None], done[y - 1, np.minimum(x + 1, w - 1)], done[y, 0])
    mode = np.where(y == 0, 1, np.where(x == 0, 2, modes))
    out = np.tile(np.array([0, 0, 0, 255], np.int16), (len(y), 1))
    for m in np.unique(mode).tolist():
        if m in PREDICT:
            own = mode == m
            out[own] = PREDICT[m](left[own], top[own], right[own], corner[own])
    first = (y == 0) & (x == 0)
    out[first] = (0, 0, 0, 255)
    return out


def undo_predictor(pixels: np.ndarray, shift: int, blocks: np.ndarray) -> np.ndarray:
    """Pixels on a line x + 2y depend on earlier lines only and are done at once."""
    h, w, _ = pixels.shape
    out, modes = np.zeros((h, w, 4), np.int16), blocks[..., 1] & 15
    for line in range(w + 2 * h - 2):
        y = np.arange(max(0, -(-(line - w + 1) // 2)), min(h - 1, line // 2) + 1)
        x = line - 2 * y
        out[y, x] = (predictions(out, modes[y >> shift, x >> shift], y, x) + pixels[y, x]) & 255
    return out.astype(np.uint8)


def decode(data: bytes) -> np.ndarray:
    """(height, width, 4) bytes of one file: red, green, blue, alpha."""
    image = Image(data)
    return image.finished(channels(image.entropy.read(image.bits), image.inner))


def _lanes(images: list[Image]) -> list[np.ndarray]:
    """Green channels of images that ``laned`` accepts, decoded together."""
    slack = 16
    n = np.array([i.inner * i.height for i in images])
    begin = np.concatenate([[0], np.cumsum(n + slack)])
    out = np.zeros(begin[-1], np.uint8)
    size = np.array([len(i.bits.data) for i in images])
    raw = np.frombuffer(b"".join([*(i.bits.data for i in images), bytes(64)]), np.uint8).astype(np.uint32)
    word = raw[:-3] | raw[1:-2] << np.uint32(8) | raw[2:-1] << np.uint32(16) | raw[3:] << np.uint32(24)
    codes = np.concatenate([table(i.entropy.lengths[0][0], LANE_BITS) for i in images])
    start = 8 * np.concatenate([[0], np.cumsum(size)[:-1]])
    bit, limit = start + [i.bits.at for i in images], start + 8 * size + 64
    at, end, base, lane = begin[:-1].copy(), begin[:-1] + n, np.arange(len(images)) << LANE_BITS, np.arange(len(images))
    refs: list[tuple[int, int, int, int]] = []
    distances: dict[int, Code] = {}
    mask = np.uint32((1 << LANE_BITS) - 1)
    while len(lane):
        for _ in range(slack):
            e = codes[base + (word[bit >> 3] >> (bit & 7).astype(np.uint32) & mask)]
            bit += e & 15
            symbol = e >> 4
            out[at] = symbol
            at += 1
            if symbol.max() >= LITERALS:
                for k in np.flatnonzero(symbol >= LITERALS).tolist():
                    j, o = int(lane[k]), int(at[k]) - 1
                    if o >= end[k]:
                        continue
                    image = images[j]
                    image.bits.at = int(bit[k] - start[j])
                    image.bits._load()
                    length = read_value(image.bits, int(symbol[k]) - LITERALS)
                    if j not in distances:
                        distances[j] = Code(image.entropy.lengths[0][4])
                    d = distance_of(read_value(image.bits, distances[j].read(image.bits)), image.inner)
                    if d > o - begin[j] or o + length > end[k]:
                        raise ValueError("a back-reference leaves the image")
                    refs.append((j, o, length, d))
                    bit[k], at[k] = image.bits.at + start[j], o + length
        if (bit > limit[lane] + slack * LANE_BITS).any():
            raise ValueError("the image ends early")
        live = at < end
        if not live.all():
            bit, at, end, base, lane = bit[live], at[live], end[live], base[live], lane[live]
    # within an image references come in the order of their places
    for _, o, length, d in refs:
        out[o : o + length] = out[o - d : o - d + length] if d >= length else np.resize(out[o - d : o], length)
    return [out[a : a + k] for a, k in zip(begin[:-1], n, strict=True)]


def decode_many(files: list[bytes]) -> list[np.ndarray]:
    """What ``decode`` gives of each file."""
    images = [Image(f) for f in files]
    laned = [k for k, i in enumerate(images) if i.laned()]
    out: list = [None] * len(files)
    for k, green in zip(laned, _lanes([images[k] for k in laned]) if laned else (), strict=True):
        image = images[k]
        pixels = np.empty((image.height, image.inner, 4), np.uint8)
        pixels[..., 1] = green.reshape(image.height, image.inner)
        for channel, lengths in zip((0, 2, 3), image.entropy.lengths[0][1:4], strict=True):
            pixels[..., channel] = lengths.argmax()
        out[k] = image.finished(pixels)
    for k, image in enumerate(images):
        if out[k] is None:
            out[k] = image.finished(channels(image.entropy.read(image.bits), image.inner))
    return out


def split_files(stored: bytes) -> list[bytes]:
    """The files of a stored row, which stand one after another."""
    out, at = [], 0
    while at < len(stored):
        size = 8 + int.from_bytes(stored[at + 4 : at + 8], "little")
        out.append(stored[at : at + size + (size & 1)])
        at += size + (size & 1)
    return out
