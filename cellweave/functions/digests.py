"""MD5 of many short texts that differ in a number at their end (numpy, called inside Arrow tasks)."""

from __future__ import annotations

import hashlib

import numpy as np

SHIFTS = np.repeat([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], 4, axis=0).ravel().tolist()
SINES = [np.uint32(int(abs(np.sin(k + 1.0)) * 2**32)) for k in range(64)]
START = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
AT_ONCE, LONGEST = 1 << 14, 55  # texts hashed together; bytes of a text of one block


def numbered_words(before: int, count: int) -> list[dict[int, np.ndarray]]:
    """Words of the 64-byte blocks of texts with ``before`` bytes and then a number 1 to ``count``: what the numbers, their end and the length add."""
    parts = []
    for low in range(1, count + 1, AT_ONCE):
        numbers = np.arange(low, min(count, low + AT_ONCE - 1) + 1, dtype=np.int64)
        digits = sum((numbers >= 10**k).astype(np.int64) for k in range(len(str(count))))
        words = {14: (8 * (before + digits)).astype(np.uint32)}
        for k in range(int(digits[-1]) + 1):
            digit = numbers // 10 ** np.maximum(digits - 1 - k, 0) % 10 + 48
            byte = np.where(k < digits, digit, np.where(k == digits, 0x80, 0)).astype(np.uint32)
            at = before + k
            words[at // 4] = words.get(at // 4, np.uint32(0)) | (byte << np.uint32(8 * (at % 4)))
        parts.append(words)
    return parts


def md5_of_numbered(start: bytes, count: int, parts: list[dict[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """First and second half, big-endian, of the MD5 of ``start`` followed by 1 to ``count``; ``parts`` are the ``numbered_words`` of its length."""
    if len(start) + len(str(count)) > LONGEST:
        halves = np.frombuffer(b"".join(hashlib.md5(start + b"%d" % k).digest() for k in range(1, count + 1)), ">u8").reshape(count, 2)
        return halves[:, 0].astype(np.uint64), halves[:, 1].astype(np.uint64)
    fixed = np.frombuffer(start.ljust(64, b"\0"), "<u4")
    found = [_block({w: part[w] | fixed[w] if w in part else fixed[w] for w in range(16)}, len(part[14])) for part in parts]
    return tuple(np.concatenate(half) for half in zip(*found))


def _block(words: dict[int, np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, d = (np.full(size, x) for x in START)
    f, t = np.empty_like(a), np.empty_like(a)
    for k in range(64):
        if k < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
            g = k
        elif k < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
            g = (5 * k + 1) % 16
        elif k < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
            g = (3 * k + 5) % 16
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
            g = 7 * k % 16
        f += a
        f += SINES[k]
        f += words[g]
        np.right_shift(f, np.uint32(32 - SHIFTS[k]), out=t)
        f <<= np.uint32(SHIFTS[k])
        f |= t
        f += b
        a, d, c, b, f = d, c, b, f, a
    ends = [(x + y).byteswap().astype(np.uint64) for x, y in zip((a, b, c, d), START)]
    return (ends[0] << np.uint64(32)) | ends[1], (ends[2] << np.uint64(32)) | ends[3]
