"""Small decoders for one export: print alphabet, raw deflate, CBOR with script tables."""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np

#: Fixed value: the alphabet of six-bit characters, lowest bits first.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789()"
_CHARS = np.frombuffer(ALPHABET.encode(), np.uint8)
_SIX = np.full(256, 255, np.uint8)
_SIX[_CHARS] = np.arange(64)
MOST_BYTES, MOST_DEPTH = 512 << 20, 100


def from_print(text: str) -> bytes:
    text = "".join(text.split())
    # what is no single byte becomes a question mark, which the alphabet has not
    six = _SIX[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
    if len(text) == 1 or (six == 255).any():
        raise ValueError("the payload isn't print-encoded")
    bits = np.unpackbits(six[:, None], axis=1, bitorder="little")[:, :6].ravel()
    return np.packbits(bits[: len(bits) // 8 * 8], bitorder="little").tobytes()


def to_print(data: bytes) -> str:
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    bits = np.concatenate([bits, np.zeros(-len(bits) % 6, np.uint8)]).reshape(-1, 6)
    return _CHARS[bits @ (1 << np.arange(6, dtype=np.uint8))].tobytes().decode()


def inflated(data: bytes, most: int = MOST_BYTES) -> bytes:
    z = zlib.decompressobj(-15)
    try:
        out = z.decompress(data, most)
    except zlib.error as e:
        raise ValueError(f"the payload doesn't inflate: {e}") from None
    if z.unconsumed_tail or not z.eof:
        raise ValueError("the payload is too large or cut off")
    return out


_NIL = object()
_FLOATS = {25: struct.Struct(">e"), 26: struct.Struct(">f"), 27: struct.Struct(">d")}
_fullmatch = re.compile("[1-9][0-9]*").fullmatch


def cbor(data: bytes) -> object:
    """One item and nothing behind it; definite lengths, no tags. A missing value is None."""
    value, at = _item(data, 0, 1)
    if at != len(data):
        raise ValueError("something follows the item")
    return None if value is _NIL else value


def _take(data: bytes, at: int, n: int) -> tuple[bytes, int]:
    if at + n > len(data):
        raise ValueError("the item is cut off")
    return data[at : at + n], at + n


def _item(data: bytes, at: int, depth: int) -> tuple[object, int]:
    if depth > MOST_DEPTH:
        raise ValueError("tables are nested too deep")
    if at >= len(data):
        raise ValueError("the item is cut off")
    major, info = data[at] >> 5, data[at] & 31
    at += 1
    if major == 7:
        return _simple(data, at, info)
    if info > 27:
        raise ValueError("indefinite or invalid length")
    n = info
    if info >= 24:
        raw, at = _take(data, at, 1 << info - 24)
        n = int.from_bytes(raw, "big")
    if major < 2:
        return (n if major == 0 else -1 - n), at
    if major < 4:
        raw, at = _take(data, at, n)
        return raw.decode("utf-8", "replace"), at
    if major == 6:
        raise ValueError("tags are not supported")
    pairs: dict = {}
    for k in range(1, n + 1):
        key: object = k
        if major == 5:
            key, at = _item(data, at, depth + 1)
            if key is _NIL or key != key:
                raise ValueError("a table key is missing or no number")
        value, at = _item(data, at, depth + 1)
        if type(key) is str and value is not _NIL:
            pairs[key] = value
            continue
        if isinstance(key, bool) or not isinstance(key, (int, float, str)):
            continue
        key = str(int(key)) if isinstance(key, (int, float)) and key == int(key) else str(key)
        pairs.pop(key, None) if value is _NIL else pairs.__setitem__(key, value)
    return _table(pairs), at


def _whole(key: str) -> bool:
    return _fullmatch(key) is not None


def _keyed(value: object) -> bool:
    """Whether a decoded table had only the keys of a list."""
    return isinstance(value, (list, dict)) and len(value) > 0 and (isinstance(value, list) or all(map(_whole, value)))


def _table(pairs: dict) -> object:
    """A list where the keys are 1 to n, unless the first value is itself keyed by numbers."""
    if not pairs:
        return []
    if not all(map(_whole, pairs)) or _keyed(pairs.get("1")) or {int(k) for k in pairs} != set(range(1, len(pairs) + 1)):
        return pairs
    return [pairs[str(k)] for k in range(1, len(pairs) + 1)]


def _simple(data: bytes, at: int, info: int) -> tuple[object, int]:
    if info in (20, 21):
        return info == 21, at
    if info in (22, 23):
        return _NIL, at
    if info in (25, 26, 27):
        raw, at = _take(data, at, 1 << info - 24)
        return _FLOATS[info].unpack(raw)[0], at
    raise ValueError("an unsupported simple value")


def exports(text: str, marker: str) -> tuple[list[object], list[str]]:
    """Tables of all exports in a text, and why others were dropped; ``marker`` is the word in their markers."""
    found, dropped = [], []
    whole = list(re.finditer(rf"!{marker}:(\d+)!([^!]*)!End:{marker}:\1!", text))
    for m in whole:
        try:
            value = cbor(inflated(from_print(m[2])))
            if not isinstance(value, (list, dict)):
                raise ValueError("the payload is no table")
            found.append(value)
        except ValueError as e:
            dropped.append(str(e))
    begun = len(re.findall(rf"!{marker}:\d+!", text))
    if not begun:
        return [], ["no export in the text"]
    return found, dropped + ["an export is cut off"] * (begun - len(whole))


def to_cbor(value: object) -> bytes:
    """A value of texts, numbers, truth values, lists and tables as one item; lists as tables of 1 to n, None as nil."""
    if value is None:
        return b"\xf6"
    if isinstance(value, bool):
        return b"\xf5" if value else b"\xf4"
    if isinstance(value, int):
        return _head(0, value) if value >= 0 else _head(1, -1 - value)
    if isinstance(value, float):
        return b"\xfb" + struct.pack(">d", value)
    if isinstance(value, str):
        return _head(3, len(raw := value.encode())) + raw
    if isinstance(value, list):
        return _head(4, len(value)) + b"".join(map(to_cbor, value))
    return _head(5, len(value)) + b"".join(to_cbor(int(k) if isinstance(k, str) and _whole(k) else k) + to_cbor(v) for k, v in value.items())


def _head(major: int, n: int) -> bytes:
    for info, size in ((24, 1), (25, 2), (26, 4), (27, 8)):
        if n < 24:
            return bytes([major << 5 | n])
        if n < 1 << 8 * size:
            return bytes([major << 5 | info]) + n.to_bytes(size, "big")
    raise ValueError("a number is too large")


def to_export(value: object, marker: str, number: int = 1) -> str:
    """The export of a table, as ``exports`` reads it."""
    z = zlib.compressobj(9, zlib.DEFLATED, -15)
    body = to_print(z.compress(to_cbor(value)) + z.flush())
    return f"!{marker}:{number}!{body}!End:{marker}:{number}!"
