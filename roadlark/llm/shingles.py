"""Word shingles of whole texts as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

from roadlark.llm.common import RollingSums, constants, mix, slices

SLICE_BYTES = 4 << 20

# A-Z become lower case, tab to carriage return become blanks, other bytes stay.
_FOLD = bytes(
    32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_ROLLING = RollingSums(seed=11)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of its text).  Words never cross texts."""
    folded = np.frombuffer(data.tobytes().translate(_FOLD), np.uint8)
    inside = folded != 32
    edge = np.zeros(len(folded) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    hashes = _ROLLING.ranges(_ROLLING.sums(folded), start, end)
    return hashes, np.searchsorted(offsets, start, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles.

    A text of fewer than ``width`` words has its whole sequence as one shingle; a text without
    words has none.
    """
    words, owner = word_hashes(data, offsets)
    count = np.bincount(owner, minlength=len(offsets) - 1)
    first = np.concatenate(([0], np.cumsum(count)))
    factors = constants(width * (width + 1), seed=29)
    full = factors[:width]
    grams = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        grams += words[k : k + len(grams)] * full[k]
    grams = mix(grams)
    out = []
    for i, n in enumerate(count.tolist()):
        begin = first[i]
        if n >= width:
            out.append(np.unique(grams[begin : begin + n - width + 1]))
        elif n:
            short = factors[n * width : n * width + n]
            out.append(mix(np.array([np.sum(words[begin : begin + n] * short)])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def batches_of_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """``shingle_sets`` over slices of bounded size: yields (row, set)."""
    for begin, end in slices(np.diff(offsets), SLICE_BYTES):
        part = offsets[begin : end + 1]
        sets = shingle_sets(data[part[0] : part[-1]], part - part[0], width)
        yield from zip(range(begin, end), sets)


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
