"""Words of whole Arrow columns as arrays: places, hashes and shapes, without an object for each word.

Nothing is remembered between batches, so what a worker holds is bounded by the bytes of one part
(``MOST_BYTES``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

MOST_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15

_byte = np.arange(256)
SPACE = np.isin(_byte, [0x20, *range(0x09, 0x0E)])
_letter = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
_latin_signs = np.isin(_byte, [b for b in range(0x80, 0xC0) if b not in (0xAA, 0xB5, 0xBA)])  # after 0xC2
_powers: list[np.ndarray] = []


def _ends(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    where = column.buffers()[1]
    if not len(column) or where is None:
        return np.zeros(1, np.int64)
    return np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def _cuts(data: np.ndarray, most: int, unit: int, back: int) -> Iterator[tuple[int, int, int]]:
    """Begin, stop and the bytes already seen of parts of one long text, of ``most`` bytes at most beside these."""
    begin = seen = 0
    while len(data) - begin - seen > most:
        stop = begin + seen + most
        if unit:
            stop -= (stop - begin - seen) % unit
        else:
            low = begin + seen + 1
            spaces = np.flatnonzero(SPACE[data[low:stop]])
            if len(spaces):
                stop = low + int(spaces[-1]) + 1
            else:
                while stop > low and data[stop] & 0xC0 == 0x80:
                    stop -= 1
        yield begin, stop, seen
        begin = max(begin + 1, stop - back) if back else stop
        if begin < stop and not unit:
            spaces = np.flatnonzero(SPACE[data[begin - 1 : stop - 1]])
            begin += int(spaces[0]) if len(spaces) else 0
            while begin < stop and data[begin] & 0xC0 == 0x80:
                begin += 1
        seen = stop - begin
    yield begin, len(data), seen


def pieces(column: pa.Array, most: int = MOST_BYTES, unit: int = 0, back: int = 0) -> Iterator[tuple[int, pa.Array, int]]:
    """A column without nulls in parts of about ``most`` bytes: the row that a part begins with, the part, and how many of its bytes the part before held.

    A longer text comes in several parts, cut behind white space, a longer word between characters; binary values are cut at multiples
    of ``unit``. Parts of one text overlap by about ``back`` bytes.
    """
    ends = _ends(column)
    begin = 0
    while begin < len(column):
        stop = int(np.searchsorted(ends, ends[begin] + most, side="right")) - 1
        if stop > begin:
            yield begin, column.slice(begin, stop - begin), 0
            begin = stop
            continue
        data = raw(column.slice(begin, 1))[0]
        kind = pa.large_binary() if unit else pa.large_string()
        for a, b, seen in _cuts(data, most, unit, back):
            yield begin, pa.Array.from_buffers(kind, 1, [None, pa.py_buffer(np.array([0, b - a], np.int64)), pa.py_buffer(data[a:b])]), seen
        begin += 1


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and where each row begins, with the end."""
    offsets = _ends(column)
    data = column.buffers()[2]
    every = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return every[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_places(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the words [^\\x20\\x09-\\x0D]+ in each row."""
    inside = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[rows] = True
    open_ = inside[:-1] & ~first[1:-1]  # goes on in the next byte, if that is no space
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~open_
    ends[:-1] &= ~(inside[1:] & open_)
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def hashes_of(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:stop], by the powers of a base."""
    while len(_powers) < 2 or len(_powers[0]) < len(data) + 1:
        size = 1 << (len(data) + 1).bit_length()
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (BASE, pow(BASE, -1, 2**64))]
    up, down = _powers
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    x = (sums[stops] - sums[starts]) * down[starts]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


@dataclass
class Words:
    """Words of a slice: the row of each, its hash without outer signs, and what it is made of."""

    row: np.ndarray
    hash: np.ndarray  # 0 for a word of signs alone
    bare: np.ndarray  # letters and digits from the first to the last, in bytes
    trailing: np.ndarray  # signs behind the last letter or digit
    first: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def words_of(column: pa.Array) -> Words:
    """Spaces of Unicode separate words too. A sign is what is neither letter nor digit in ASCII, Latin-1, general and CJK punctuation; any other character is a letter."""
    data, rows = raw(column)
    letter = _letter[data]
    if (data >= 0x80).any():
        two = np.flatnonzero(data[:-1] == 0xC2)
        two = two[_latin_signs[data[two + 1]]]
        three = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] <= 0x81) | (data[:-2] == 0xE3) & (data[1:-1] == 0x80))
        letter[np.r_[two, two + 1, three, three + 1, three + 2]] = False
        blank2 = two[data[two + 1] == 0xA0]
        last = data[three + 2]
        blank3 = three[np.where(data[three] == 0xE3, last == 0x80, np.where(data[three + 1] == 0x80, (last <= 0x8A) | np.isin(last, (0xA8, 0xA9, 0xAF)), last == 0x9F))]
        data = data.copy()
        data[np.r_[blank2, blank2 + 1, blank3, blank3 + 1, blank3 + 2]] = 0x20
    starts, stops = word_places(data, rows)
    first, last = starts.copy(), stops.copy()
    outer = np.flatnonzero(~(letter[starts] & letter[stops - 1]))  # words with a sign at an end
    trailing = np.zeros(len(starts), np.int64)
    if len(outer):
        at = np.flatnonzero(letter)
        low, high = np.searchsorted(at, starts[outer]), np.searchsorted(at, stops[outer])
        at = np.r_[at, 0]
        some = high > low
        first[outer] = np.where(some, at[np.minimum(low, len(at) - 1)], starts[outer])
        last[outer] = np.where(some, at[high - 1] + 1, starts[outer])
        signs = np.r_[np.int32(0), np.cumsum(~letter & ((data & 0xC0) != 0x80), dtype=np.int32)]
        trailing[outer] = signs[stops[outer]] - signs[last[outer]]
    found = hashes_of(data, first, last)
    found[last == first] = 0
    return Words(np.repeat(np.arange(len(rows) - 1), np.diff(np.searchsorted(starts, rows))), found, last - first, trailing, first, starts, stops)
