"""Runs of equal-length windows over long symbol sequences (bytes or words), for repeat search.

A window is ``width`` consecutive symbols. Every window has a minimizer: the k-mer in it with the smallest hash, the
leftmost of equals. Consecutive windows with the same minimizer form a run. Equal windows have equal minimizers at
equal places, so repeats are searched among runs with one minimizer only, and about two runs per
``width - k`` symbols stand for all windows. Where a stretch repeats, its inner runs are the same, symbol for symbol.

Hashes are polynomials modulo 2**64 over random symbol values, read off prefix sums in whole-array steps.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASES = np.array([0x9E3779B97F4A7C15 | 5, 0xC2B2AE3D27D4EB4F | 5, 0xD6E8FEB86659FD93 | 5], np.uint64)
#: Symbols handled at a time; places inside fit the low bits of a minimizer key.
CHUNK = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@lru_cache(maxsize=8)
def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of a base and of its inverse modulo 2**64."""
    base = int(_BASES[which])
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n + 1, b, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


class Hashes:
    """Hashes of any stretch of ``values`` (uint64 symbol values, at most 2**20 of them)."""

    def __init__(self, values: np.ndarray, which: int = 0):
        n = 1 << max(16, int(len(values)).bit_length())
        up, self._down = powers(which, n)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], out=self._sums[1:])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start])

    def all(self, length: int) -> np.ndarray:
        n = len(self._sums) - length
        return mix((self._sums[length:] - self._sums[:n]) * self._down[:n])


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64, endpoint=False)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_values(text: bytes) -> np.ndarray:
    """A hash per word of ``[^\\x20\\x09-\\x0D]+``, in order."""
    parts = []
    for at, end in _pieces(text):
        raw = np.frombuffer(text, np.uint8, end - at, at)
        gap = _SPACE[raw]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
        start, stop = edge[::2], edge[1::2]
        parts.append(Hashes(byte_values()[raw], 2).at(start, stop) + mix((stop - start).astype(np.uint64)))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _pieces(text: bytes):
    """Cut at separators into pieces of about CHUNK bytes; a longer word is cut off nowhere."""
    at = 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        if end < len(text):
            while end < len(text) and not _SPACE[text[end]]:
                end += 1
        yield at, end
        at = end


def sliding_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours, by running minima from both block ends."""
    n = len(h)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = h
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).reshape(-1)
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def runs(values: np.ndarray, starts: np.ndarray, width: int, k: int) -> dict[str, np.ndarray]:
    """Runs of windows over documents laid end to end in ``values`` (at most CHUNK + width symbols).

    ``starts`` are the documents' first places and the end. Returns per run: doc (index), start (window place in
    ``values``), n (windows), off (from the first window to the minimizer), key (the minimizer's hash), c1 and c2
    (a 128-bit hash of the run's symbols).
    """
    h = Hashes(values)
    kmers = h.all(k) if len(values) >= k else np.zeros(0, np.uint64)
    per = width - k + 1
    if len(kmers) < per:
        empty = np.zeros(0, np.int64)
        return {c: empty for c in ("doc", "start", "n", "off")} | {c: empty.astype(np.uint64) for c in ("key", "c1", "c2")}
    placed = (kmers & ~_PLACE) | np.arange(len(kmers), dtype=np.uint64)
    least = (sliding_minimum(placed, per) & _PLACE).astype(np.int64)
    place = np.arange(len(least))
    doc = np.searchsorted(starts, place, side="right") - 1
    valid = place + width <= starts[doc + 1]
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(fresh)
    # A run ends where the next one starts or where windows stop being whole.
    ends = np.flatnonzero(np.diff(np.concatenate((valid, [False])).astype(np.int8)) == -1) + 1
    stop = np.minimum(np.append(first[1:], len(least)), ends[np.searchsorted(ends, first, side="right")] if len(first) else first)
    n = stop - first
    end = stop + width - 1
    salt = mix(n.astype(np.uint64) << np.uint64(32) | (least[first] - first).astype(np.uint64))
    return {"doc": doc[first], "start": first, "n": n, "off": least[first] - first, "key": kmers[least[first]],
            "c1": h.at(first, end) ^ salt, "c2": Hashes(values, 1).at(first, end) ^ salt}


def grouped(sizes, limit: int = CHUNK):
    """Index ranges of neighbours whose sizes add up to ``limit`` at most; a larger one stands alone."""
    at = total = 0
    for i, size in enumerate(sizes):
        if i > at and total + size > limit:
            yield at, i
            at, total = i, 0
        total += size
    if at < len(sizes):
        yield at, len(sizes)


def all_runs(sequences: list[np.ndarray], width: int, k: int):
    """``runs`` over any number of sequences of any length, in bounded pieces; places are inside each sequence.

    A longer sequence is cut into pieces that overlap by ``width - 1``, so each window is in one piece. A cut may split a run of
    a long stretch in two; windows keep their minimizers, so this changes no result.
    """
    for a, b in grouped([len(s) for s in sequences]):
        if b - a == 1 and len(sequences[a]) > CHUNK:
            s = sequences[a]
            for at in range(0, len(s) - width + 1, CHUNK - width + 1):
                part = s[at:at + CHUNK]
                found = runs(part, np.array([0, len(part)]), width, k)
                found["doc"] = found["doc"] + a
                found["start"] = found["start"] + at
                yield found
        else:
            starts = np.concatenate(([0], np.cumsum([len(s) for s in sequences[a:b]])))
            found = runs(np.concatenate(sequences[a:b]), starts, width, k)
            found["start"] = found["start"] - starts[found["doc"]]
            found["doc"] = found["doc"] + a
            yield found
