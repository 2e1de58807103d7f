"""Array helpers shared by the text operators.

A chunk of documents is one UTF-8 byte array plus document bounds, so tokens, hashes and windows are
computed for all documents of the chunk in a few numpy calls. Words are maximal runs of bytes other
than space and \\t\\n\\v\\f\\r; a word never crosses a document because documents are joined by \\n.

Hashes are prefix polynomial hashes modulo 2**64 over random byte codes: the hash of bytes i..j is
(P[j] - P[i]) * BASE**-i, so a hash of any range costs two lookups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C17 | 3
INVERSE = pow(BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _CODES.copy()
_FOLDED[65:91] = _CODES[97:123]
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that all bits of a polynomial hash are usable."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def encode(text: str | None) -> bytes:
    """UTF-8 of a text; null is empty. Lone surrogates become question marks."""
    return b"" if text is None else text.encode("utf-8", "replace")


def chunks(texts, max_bytes: int = 2_000_000) -> Iterator[tuple[list[int], list[bytes]]]:
    """Consecutive documents (row numbers, UTF-8 texts) of about max_bytes; a longer text stands alone."""
    rows: list[int] = []
    held: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        data = encode(text)
        if rows and size + len(data) > max_bytes:
            yield rows, held
            rows, held, size = [], [], 0
        rows.append(i)
        held.append(data)
        size += len(data)
    if rows:
        yield rows, held


def joined(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One byte array with a \\n after each document, and the documents' starts with the final length."""
    buf = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
    starts = np.zeros(len(held) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in held], out=starts[1:])
    return buf, starts


def prefix_hashes(buf: np.ndarray, codes: np.ndarray = _CODES) -> np.ndarray:
    """P with P[j] - P[i] = sum of code(byte t) * BASE**t over i <= t < j."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(codes[buf] * powers(BASE, len(buf)), out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hashes of the byte ranges start..end."""
    n = len(prefix)
    return (prefix[end] - prefix[start]) * powers(INVERSE, n)[start]


def words(buf: np.ndarray, starts: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word, and the number of the first word of each document (with the total).

    fold: A-Z count as a-z.
    """
    space = _SPACE[buf]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(buf) and not space[0]:
        edges = np.concatenate(([0], edges))
    begin, end = edges[0::2], edges[1::2]
    hashes = mix(range_hashes(prefix_hashes(buf, _FOLDED if fold else _CODES), begin, end) + (end - begin).astype(np.uint64))
    return hashes, begin, end, np.searchsorted(begin, starts)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its `size`-word shingles; the whole sequence if it is shorter."""
    n = max(len(hashes) - size + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled = mix(rolled * np.uint64(BASE) + hashes[k : k + n] + np.uint64(k))
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for k in range(a, b):
                whole = mix(whole * np.uint64(BASE) + hashes[k : k + 1] + np.uint64(k - a))
            out.append(mix(whole + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
