"""Pairs of Bloom filters over a whole corpus: bits that a document sets, and bits that a second document sets again.

Tasks fill their own pair and send it in segments, as bit numbers where a segment is sparse. Segments are merged one at a
time from a sorted stream: a bit that two tasks have once is twice. A key of two documents has all its bits in the merged
twice filter; a key of one document has them there only by chance. The size is bounded, and so is its broadcast.
"""

import numpy as np
import pyarrow as pa

HASHES = 3
SEGMENT_BITS = 1 << 16
_GAMMA = np.uint64(0x9E3779B97F4A7C15)
PARTIAL = "segment int, once binary, twice binary"


def size_for(keys, bits_per_key, max_bits):
    bits = 1 << 16
    while bits < min(keys * bits_per_key, max_bits):
        bits *= 2
    return bits


def positions(hashes, bits):
    """HASHES bit numbers for each hash; `bits` is a power of two."""
    steps = (hashes * _GAMMA) | np.uint64(1)
    return np.stack([(hashes + np.uint64(i) * steps) & np.uint64(bits - 1) for i in range(HASHES)], 1)


def is_set(bitmap, places):
    return (bitmap[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 != 0


def _set(bitmap, places):
    np.bitwise_or.at(bitmap, places >> np.uint64(3), np.left_shift(np.uint8(1), (places & np.uint64(7)).astype(np.uint8)))


def _pack(segment):
    """A segment's bits as a bitmap, or as 16-bit numbers where that is shorter."""
    if int(np.bitwise_count(segment).sum()) * 2 >= len(segment):
        return segment.tobytes()
    some = np.flatnonzero(segment)
    at, bit = np.nonzero(np.unpackbits(segment[some, None], axis=1, bitorder="little").view(bool))
    return (some[at] * 8 + bit).astype("<u2").tobytes()


def _unpack(data, size):
    if len(data) == size:
        return np.frombuffer(data, np.uint8)
    bits = np.zeros(size * 8, np.uint8)
    bits[np.frombuffer(data, "<u2")] = 1
    return np.packbits(bits, bitorder="little")


class Pair:
    """The two filters of a task."""

    def __init__(self, bits):
        self.bits = bits
        self.once, self.twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, hashes):
        """Keys of whole documents; a key comes once for each document that holds it."""
        places, times = np.unique(positions(hashes, self.bits), return_counts=True)
        _set(self.twice, places[(times > 1) | is_set(self.once, places)])
        _set(self.once, places)

    def batches(self):
        """Record batches of the segments that are not empty."""
        size = min(self.bits, SEGMENT_BITS) // 8
        numbers = [i for i in range(self.bits // 8 // size) if self.once[i * size:(i + 1) * size].any()]
        for start in range(0, len(numbers), 256):
            some = numbers[start:start + 256]
            cut = [slice(i * size, (i + 1) * size) for i in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([_pack(self.once[c]) for c in cut], pa.binary()),
                 pa.array([_pack(self.twice[c]) for c in cut], pa.binary())], names=["segment", "once", "twice"])


def _merged(size):
    """Rows come sorted by segment; one segment is held at a time."""
    def run(batches):
        at, once, twice = None, None, None
        for batch in batches:
            done = []
            for number, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                a, b = _unpack(a, size), _unpack(b, size)
                if number != at:
                    if at is not None:
                        done.append((at, once.tobytes(), twice.tobytes()))
                    at, once, twice = number, a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
            if done:
                yield _segments(done)
        if at is not None:
            yield _segments([(at, once.tobytes(), twice.tobytes())])
    return run


def _segments(rows):
    kinds = (pa.int32(), pa.binary(), pa.binary())
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["segment", "once", "twice"])


def _collected(partial, column, bits):
    size = min(bits, SEGMENT_BITS) // 8
    merged = partial.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merged(size), PARTIAL)
    out = np.zeros(bits // 8, np.uint8)
    for number, segment in merged.select("segment", column).toLocalIterator():
        out[number * size:(number + 1) * size] = np.frombuffer(segment, np.uint8)
    return out


def once_filter(partial, bits):
    """The merged once filter from the segments of all tasks, of bits / 8 bytes."""
    return _collected(partial, "once", bits)


def twice_filter(partial, bits):
    """The merged twice filter from the segments of all tasks, of bits / 8 bytes."""
    return _collected(partial, "twice", bits)


def contains(twice, hashes):
    """Which keys have all their bits in the filter."""
    return is_set(twice, positions(hashes, len(twice) * 8)).all(1)
