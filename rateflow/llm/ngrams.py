"""Hashed character n-grams of many words at once, as flat numpy arrays."""

import numpy as np

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_OPEN, _CLOSE = 2, 3


def _spread(x):
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def hashed(words, sizes, buckets):
    """(number of the word, bucket) for all n-grams of the given sizes of all words, and the 64-bit hash of each word.

    A word is framed by a begin and an end mark, so n-grams at its ends are its affixes.
    """
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n) + 2
    points = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode("utf-32-le", "surrogatepass"), np.uint32)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), lengths)
    codes = _spread(points.astype(np.uint64) + np.uint64(17))
    out_word, out_bucket = [], []
    rolled = np.zeros(len(codes), np.uint64)
    for size in range(1, max(sizes) + 1):
        rolled = rolled[:len(codes) - size + 1] * _FACTOR + codes[size - 1:]
        if size in sizes:
            inside = np.flatnonzero(owner[:len(rolled)] == owner[size - 1:])
            out_word.append(owner[inside])
            out_bucket.append((_spread(rolled[inside] + np.uint64(size)) % np.uint64(buckets)).astype(np.int64))
    starts = np.cumsum(lengths) - lengths
    nth = (np.arange(len(codes)) - np.repeat(starts, lengths)).astype(np.uint64)
    whole = _spread(np.add.reduceat(_spread(codes + nth * _FACTOR), starts))
    word, bucket = np.concatenate(out_word), np.concatenate(out_bucket)
    order = np.argsort(word, kind="stable")
    return word[order], bucket[order], whole
