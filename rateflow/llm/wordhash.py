"""64-bit hashes of words and of windows of words, over flat arrays of bytes."""

import numpy as np

_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base, n):
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(x):
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def word_table(data, inside):
    """Start, end and hash of every word; `inside` marks the bytes of words."""
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    terms = np.where(inside, data, 0).astype(np.uint64) + inside
    terms *= _powers(_BASE, len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
    return starts, ends, mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts])


def window_hashes(words, width):
    """Hash of the `width` words from each word on, for all but the last words."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for k, factor in enumerate(_powers(_STEP, width)):
        out += words[k:k + n] * factor
    return out


#: A byte that is not ASCII white space, and the lower-case form of ASCII letters.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def spoken(texts):
    """Hashes of the words between white space of all texts, A-Z lower-cased, and the number of words of each text."""
    data = LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    starts, _, hashes = word_table(data, NOT_BLANK[data])
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)
