"""Simple-8b: word-aligned coding of unsigned 64-bit integers.

Each 64-bit word has a 4-bit selector on top and 60 bits of equally wide values below, the first value lowest. Values
of 2^60 - 1 and above are escaped: a word of 64 ones, then the value as a word of its own. Coding starts anew every
BLOCK values and the file has the word offset of each block, so that blocks decode alone and side by side.

A segment: magic ``S8B1``, block size (u32), number of values (u64), of words (u64), one u64 offset a block, the words;
all little-endian.
"""

from __future__ import annotations

import struct

import numpy as np

# How many values a word holds, and of how many bits, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
BLOCK = 1024
MAGIC, HEADER = b"S8B1", "<4sIQQ"
ESCAPE = np.uint64(2**64 - 1)
LARGE = np.uint64(2**60 - 1)


def _levels(values: np.ndarray) -> np.ndarray:
    """Of each value, which of the widths it needs."""
    if len(values) and int(values.max()) < 1 << 16:
        return _SMALL[values.astype(np.uint16)]
    return np.searchsorted(_LIMITS, values, side="right").astype(np.uint8)


_WIDTHS = np.unique(BITS)
_LIMITS = np.array([(1 << int(b)) for b in _WIDTHS[:-1]], dtype="<u8")  # values from limit k on need more than width k
_SMALL = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype="<u8"), side="right").astype(np.uint8)
_LEVEL_OF = np.searchsorted(_WIDTHS, BITS).astype(np.uint8)


def encode(values: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment of ``values`` (converted to unsigned 64-bit)."""
    values = np.ascontiguousarray(values, dtype="<u8")
    n = len(values)
    blocks = -(-n // block)
    widest = np.full(blocks * block, 255, dtype=np.uint8)
    widest[:n] = _levels(values)
    widest = widest.reshape(blocks, block)  # widest value of the run of ``length`` values from each place; 255 beyond the block
    selector, length = np.full((blocks, block), 15, dtype=np.uint8), 1
    for s in range(14, -1, -1):  # from few wide values to many narrow ones: the last that fits holds the most
        count = int(COUNTS[s])
        while length < count:  # a longer run is two runs that overlap
            step = min(length, count - length)
            longer = np.full_like(widest, 255)
            if step < block:
                np.maximum(widest[:, :-step], widest[:, step:], out=longer[:, :-step])
            widest, length = longer, length + step
        np.copyto(selector, s, where=widest <= _LEVEL_OF[s])
    selector = selector.ravel()[:n]
    starts = np.zeros(n, dtype=bool)
    first = np.arange(0, n, block)
    at, ends = first, np.minimum(first + block, n)
    while len(at):  # all blocks take a word at a time
        starts[at] = True
        at = at + COUNTS[selector[at]]
        more = at < ends
        at, ends = at[more], ends[more]
    begin = np.flatnonzero(starts)
    chosen = selector[begin]
    escaped = values[begin] >= LARGE
    place = np.cumsum(1 + escaped) - 1 - escaped
    words = np.zeros(int(len(begin) + escaped.sum()), dtype="<u8")
    if n:
        counts = np.diff(np.append(begin, n))
        inside = np.arange(n, dtype=np.int32) - np.repeat(begin.astype(np.int32), counts)  # below 240
        shift = inside.astype(np.uint8) * np.repeat(BITS[chosen].astype(np.uint8), counts)
        packed = np.bitwise_or.reduceat(values << shift, begin)
        words[place] = packed | chosen.astype(np.uint64) << np.uint64(60)
    words[place[escaped]] = ESCAPE
    words[place[escaped] + 1] = values[begin[escaped]]
    offsets = place[np.searchsorted(begin, first)].astype("<u8")
    return struct.pack(HEADER, MAGIC, block, n, len(words)) + offsets.tobytes() + words.tobytes()


def _parts(segment: bytes) -> tuple[int, int, np.ndarray, np.ndarray]:
    magic, block, n, n_words = struct.unpack_from(HEADER, segment)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b segment")
    at = struct.calcsize(HEADER)
    blocks = -(-n // block)
    return block, n, np.frombuffer(segment, "<u8", blocks, at), np.frombuffer(segment, "<u8", n_words, at + 8 * blocks)


def _decode_words(words: np.ndarray) -> np.ndarray:
    ones = words == ESCAPE
    marks = np.zeros(len(words), dtype=bool)
    if ones.any():  # in a run of such words every other one, from the first, is the mark
        first = ones & ~np.append(False, ones[:-1])
        run_start = np.maximum.accumulate(np.where(first, np.arange(len(words)), 0))
        marks = ones & ((np.arange(len(words)) - run_start) % 2 == 0)
    raw = np.append(False, marks[:-1])
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.where(raw, 0, COUNTS[selector])
    place = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype="<u8")
    for s in range(2, 16):
        own = np.flatnonzero((selector == s) & ~raw & ~marks)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for j in range(int(COUNTS[s]) if len(own) else 0):
            out[place[own] + j] = (words[own] >> np.uint64(j * BITS[s])) & mask
    out[place[marks]] = words[np.flatnonzero(marks) + 1]
    return out


def decode(segment: bytes) -> np.ndarray:
    """All values of a segment."""
    return _decode_words(_parts(segment)[3])


def decode_block(segment: bytes, k: int) -> np.ndarray:
    """The values of block ``k`` alone."""
    _, _, offsets, words = _parts(segment)
    return _decode_words(words[int(offsets[k]) : int(offsets[k + 1]) if k + 1 < len(offsets) else len(words)])
