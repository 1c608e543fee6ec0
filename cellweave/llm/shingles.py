"""Word and shingle hashes of whole texts in Arrow batches, computed on byte arrays.

Words are maximal runs without the blanks 0x09-0x0D and 0x20, after A-Z are lower-cased. Hashes have 64 bits, so two
different words or shingles of one text or pair of texts meet with a chance below n * n / 2**64.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 19  # bytes hashed at once: a task's arrays stay near 4 MB each
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93),
        np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[0]
    x = (x ^ (x >> np.uint64(27))) * _ODD[1]
    return x ^ (x >> np.uint64(31))


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < size:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size + size // 4, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def _chunk_words(data: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(blank.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD[2])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and per text its bounds in them (one more than texts)."""
    joined = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    blank = (joined == 32) | ((joined >= 9) & (joined <= 13))
    places, hashes, at = [], [], 0
    while at < len(joined):
        end = min(at + CHUNK, len(joined))
        if end < len(joined):  # cut at a blank; a longer word stays whole
            back = np.flatnonzero(blank[at:end])
            if len(back):
                end = at + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(blank[end:])
                end = end + int(ahead[0]) + 1 if len(ahead) else len(joined)
        starts, own = _chunk_words(joined[at:end], blank[at:end])
        places.append(starts + at)
        hashes.append(own)
        at = end
    if not places:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words in order; a shorter sequence is one shingle, none gives none."""
    size = min(size, len(words))
    if not size:
        return words
    last = len(words) - size + 1
    total = np.full(last, size, np.uint64)
    for k in range(size):
        total = mix(total * _ODD[3] + words[k:k + last] * _ODD[4])
    return total


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    words, bounds = word_hashes(texts)
    return [np.unique(shingle_hashes(words[a:b], size)) for a, b in zip(bounds, bounds[1:])]


def fingerprint(hashes: np.ndarray) -> bytes:
    """128 bits that name a set of shingles."""
    with np.errstate(over="ignore"):
        one, two = mix(hashes * _ODD[2]).sum(dtype=np.uint64), mix(hashes ^ _ODD[4]).sum(dtype=np.uint64)
    return int(one).to_bytes(8, "big") + int(two).to_bytes(8, "big")
