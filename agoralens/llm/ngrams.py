"""Hashed character n-grams of whole texts, as arrays."""

import numpy as np

SPACE = 32
#: Which code points of the basic plane are letters.
_LETTER = np.array([chr(c).isalpha() for c in range(1 << 16)])


def letters(text):
    """Lower-case letters as numbers, each run of other characters as one space, also at the ends."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    other = ~_LETTER[np.minimum(points, 0xFFFF)] & (points < 0x10000)
    return np.where(other, np.uint32(SPACE), points)[~(other & np.append(False, other[:-1]))]


def grams(points, n, bits):
    """The bucket of each n-gram, in text order, out of ``2 ** bits``."""
    if len(points) < n:
        return np.zeros(0, np.uint32)
    h = points[: len(points) - n + 1] + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
    for i in range(1, n):
        h = h * np.uint32(0x01000193) ^ (points[i : len(points) - n + 1 + i] * np.uint32(0x85EBCA6B))
    h ^= h >> np.uint32(15)
    return (h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits)


def all_grams(text, orders, bits):
    """The buckets of the n-grams of all orders, one after the other."""
    points = letters(text)
    return np.concatenate([grams(points, n, bits) for n in orders])
