"""Cutting texts into the pieces of a byte-level BPE, for whole batches at once.

The rule is the published one of that tokenizer family: contractions, runs of letters, numbers or other characters with
one space before them, and white space of which the last character before something visible stands alone. Here it is
applied to arrays of character classes, so that no text is searched character by character in Python.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
#: Bases of independent rolling hashes.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
#: Powers of the base that are kept, as a power of two; more only for a longer batch.
_LEAST_POWERS = 20
#: Characters whose classes are looked up at once; numpy makes a copy of the places, twice as large as the text.
_LOOKED_UP = 1 << 16


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    # Beyond the third plane no character is a letter or number.
    table[:0x40000] = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x40000)]
    # The characters with the White_Space property.
    white = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    table[white] = SPACE
    return table


@lru_cache(maxsize=2)
def _powers(size: int, kind: int) -> np.ndarray:
    return np.cumprod(np.full(size, np.uint64(_BASES[kind]), dtype=np.uint64))


@lru_cache(maxsize=2)
def _inverse_powers(size: int, kind: int) -> np.ndarray:
    return np.cumprod(np.full(size, np.uint64(pow(_BASES[kind], -1, 1 << 64)), dtype=np.uint64))


@lru_cache(maxsize=2)
def _byte_values(kind: int) -> np.ndarray:
    random = np.random.Generator(np.random.PCG64(7 + kind))
    return random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a bijection)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Rolling:
    """Hashes of any slices of one byte array, from sums of a random value per byte times powers of an odd base.

    For short slices, of some hundred bytes: modulo a power of two, long ones of a certain make (a Thue-Morse string of
    1,024 bytes and its complement) have one hash whatever the base. ``kind`` gives independent hashes.
    """

    def __init__(self, data: np.ndarray, kind: int = 0):
        size = 1 << max(_LEAST_POWERS, int(len(data)).bit_length())
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_byte_values(kind)[data] * _powers(size, kind)[: len(data)], out=self._sums[1:])
        self._inverse = _inverse_powers(size, kind)

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all slices of ``size`` bytes."""
        count = max(0, len(self._sums) - size)
        difference = (self._sums[size:] - self._sums[:count]) * self._inverse[:count]
        return mixed(difference + np.uint64(size * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        difference = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mixed(difference + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def distinct_slices(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """``data`` cut at ``bounds``: the number of each slice's content, in order of appearance, and the distinct contents.

    Contents are compared byte by byte.
    """
    buffers = [None, pa.py_buffer(np.ascontiguousarray(bounds, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    found = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


@dataclass
class Cut:
    """Pieces of a batch: byte starts (with the end appended), which are equal, and where each document begins."""

    data: np.ndarray
    starts: np.ndarray
    codes: np.ndarray
    first: np.ndarray
    pieces: pa.Array
    doc_starts: np.ndarray

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        return self.starts[self.first], self.starts[self.first + 1]


def _piece_flags(codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each character, whether a piece starts there. ``begins``: where documents and special tokens begin."""
    size, table = len(codes), _classes()
    kind = np.empty(size, dtype=np.uint8)
    for k in range(0, size, _LOOKED_UP):
        kind[k : k + _LOOKED_UP] = table[codes[k : k + _LOOKED_UP]]
    fresh = np.zeros(size + 1, dtype=bool)
    fresh[begins] = True
    fresh[size] = True
    before = np.concatenate([np.zeros(1, dtype=np.uint8), kind[:-1]])
    before[fresh[:-1]] = 0
    after = np.concatenate([kind[1:], np.zeros(1, dtype=np.uint8)])
    after[fresh[1:]] = 0
    space = kind == SPACE
    after_blank = np.concatenate([[False], codes[:-1] == 32]) & (before == SPACE)
    starts = (space & ((before != SPACE) | ((after != SPACE) & (after != 0)))) | (~space & (kind != before) & ~after_blank)
    quotes = np.flatnonzero((codes == 39) & starts)
    if len(quotes):
        padded = np.concatenate([codes, [0, 0]])
        one, two = padded[quotes + 1], padded[quotes + 2]
        inside = ~fresh[np.minimum(quotes + 1, size)]
        single = np.isin(one, [ord(c) for c in "stmd"]) & inside
        pair = np.zeros(len(quotes), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        pair &= inside & ~fresh[np.minimum(quotes + 2, size)]
        starts[quotes[single | pair] + 1] = False
        for taken, width in ((single, 2), (pair, 3)):
            ends = quotes[taken] + width
            starts[ends[ends < size]] = True
    return starts


def cut(texts: list[str], special: str | None = None) -> Cut:
    joined = "".join(texts)
    data = np.frombuffer(joined.encode(), dtype=np.uint8)
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    breaks, masked = begins[begins < len(codes)], None
    if special and special in joined:
        spans = np.array([m.span() for m in re.finditer(re.escape(special), joined)], dtype=np.int64)
        spans = spans[np.searchsorted(ends, spans[:, 0], "right") == np.searchsorted(ends, spans[:, 1] - 1, "right")]
        breaks = np.unique(np.concatenate([breaks, spans.reshape(-1)]))
        breaks = breaks[breaks < len(codes)]
        masked = spans
    flags = _piece_flags(codes, breaks) if len(codes) else np.zeros(0, dtype=bool)
    if masked is not None:
        for start, end in masked:
            flags[start + 1 : end] = False
    at = np.flatnonzero(flags)
    if len(data) == len(codes):
        starts = np.append(at, len(data))
    else:
        starts = np.append(np.flatnonzero((data & 0xC0) != 0x80)[at], len(data))
    order, pieces = distinct_slices(data, starts)
    first = np.zeros(len(pieces), dtype=np.int64)
    first[order[::-1]] = np.arange(len(order) - 1, -1, -1)
    doc_starts = np.append(np.searchsorted(at, begins), len(at))
    return Cut(data, starts, order, first, pieces, doc_starts)


def ragged(flat: np.ndarray, offsets: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows ``chosen`` of a ragged array, joined, and the offsets of the result."""
    lengths = (offsets[1:] - offsets[:-1])[chosen]
    out = np.zeros(len(chosen) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    places = np.repeat(offsets[:-1][chosen] - out[:-1], lengths)
    places += np.arange(out[-1])
    return flat[places], out
