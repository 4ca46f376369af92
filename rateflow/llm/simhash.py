"""SimHash near-duplicates, found by Golay-code fuzzy hashing and verified by Hamming distance.

A text has A-Z lower-cased and is cut into words at ASCII white space. Its shingles are `width` consecutive words, repeats
included, joined by a space; a shorter text has its whole word sequence as one shingle, a text without words none. Bit i
of the fingerprint is set if bit i of over half of the shingles' XXH64 values (seed 42) is set; without shingles it is
zero.

Fingerprints that differ in at most `DISTANCE` = 3 bits are linked. Each fingerprint is cut into three segments of at most
23 bits. The binary Golay code is perfect: every 23-bit word lies within 3 bits of one codeword. The keys of a segment are
that codeword and, for a word 3 bits away from it, the five codewords 4 bits away. Two words that differ in one bit share
a key: either they have the same nearest codeword, or each is 3 bits from its own and 4 bits from the other's. Of three
segments that share three errors, two have at most one error each. So a pair of fingerprints shares, for at least one of
the three pairs of segments, a pair of keys; a bucket is such a pair of keys (24 bits).

Only distinct fingerprints are dealt to buckets. In a bucket a breadth-first search compares whole blocks, and only with
fingerprints not reached yet, and sends the links of a spanning forest; so a bucket of n gives fewer than n links, never
all pairs. A bucket of more than `BUCKET` fingerprints is handed on in chunks, and pairs of chunks are searched as tasks
of their own. Links are joined to components in Spark.

Nulls and odd rows: a null or empty text has fingerprint zero, which is linked like any other. A null doc_id is never
chosen as a component's name; a component of null ids only has a null name. Repeated rows are rows of their own. Extra
columns are carried in a struct.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from rateflow.llm.common import by_piece, column, lookup, row_and_text, stored
from rateflow.llm.components import components

WIDTH = 3
DISTANCE = 3
SEED = 42
BUCKET = 4096
#: The generator polynomial of the binary Golay code, and the bits of a fingerprint in each segment.
GENERATOR = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))
_BLOCK = 1 << 15


def _shingle_hashes(text, width=WIDTH, start=0, stop=None):
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(width, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - k + 1].tolist()
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist(), strict=True)]), ">u8")


def fingerprint(text, width=WIDTH):
    """The 64-bit fingerprint of a text given as bytes."""
    hashes = _shingle_hashes(text, width)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[at:at + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs, text_col="text", width=WIDTH):
    """row (all columns of docs), fingerprint as a signed 64-bit number."""
    def run(piece):
        values = np.array([fingerprint(t, width) for t in piece.column("text").to_pylist()], np.uint64)
        return {"row": piece.column("row"), "fingerprint": pa.array(values.view(np.int64))}

    rows = row_and_text(docs, text_col)
    return rows.mapInArrow(by_piece(run), rows.select("row", F.lit(0).cast("bigint").alias("fingerprint")).schema)


def _syndrome(words):
    """Remainder of each 23-bit word by the generator."""
    left = words.astype(np.int64)
    for bit in range(22, 10, -1):
        left = np.where(left >> bit & 1, left ^ (GENERATOR << (bit - 11)), left)
    return left


class Golay:
    """For each syndrome the error patterns that lead to the nearby codewords."""

    def __init__(self):
        patterns = [0] + [sum(1 << i for i in c) for n in (1, 2, 3, 4) for c in combinations(range(23), n)]
        patterns = np.array(patterns, np.int64)
        order = np.argsort(_syndrome(patterns), kind="stable")
        lists = np.split(patterns[order], np.flatnonzero(np.diff(_syndrome(patterns)[order])) + 1)
        self.count = np.array([len(x) for x in lists], np.int64)
        self.errors = np.zeros((2048, max(self.count)), np.int64)
        for i, x in enumerate(lists):
            self.errors[i, :len(x)] = x

    def keys(self, words):
        """(number of the word, codeword index of 12 bits) for all keys of all words."""
        syndrome = _syndrome(words)
        count = self.count[syndrome]
        which = np.repeat(np.arange(len(words)), count)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        return which, (words[which] ^ self.errors[syndrome[which], nth]) >> 11


def bucket_keys(values, golay):
    """(number of the fingerprint, bucket) for all buckets of all fingerprints."""
    values = values.astype(np.uint64)
    numbers, buckets = [], []
    keyed = [golay.keys(((values >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)) for at, n in SEGMENTS]
    for pair, (i, j) in enumerate(combinations(range(3), 2)):
        (a, x), (b, y) = keyed[i], keyed[j]
        times = np.bincount(b, minlength=len(values))
        first = np.cumsum(times) - times
        which = np.repeat(np.arange(len(a)), times[a])
        nth = np.arange(len(which)) - np.repeat(np.cumsum(times[a]) - times[a], times[a])
        numbers.append(a[which])
        buckets.append((pair << 24) | (x[which] << 12) | y[first[a[which]] + nth])
    return np.concatenate(numbers), np.concatenate(buckets)


def _to_buckets(batches):
    golay = Golay()
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(values), 4096):
            some = values[at:at + 4096]
            which, bucket = bucket_keys(some.view(np.uint64), golay)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), pa.array(some[which])], names=["bucket", "fingerprint"])


def forest(values, distance=DISTANCE):
    """Links of a spanning forest of distinct fingerprints within `distance` bits; pairs are never listed."""
    rest = np.sort(values)
    found = []
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            some, front = front[:256], front[256:]
            near = np.bitwise_count(some[:, None] ^ rest[None, :]) <= distance
            reached = near.any(0)
            if reached.any():
                new = rest[reached]
                found.append((some[near[:, reached].argmax(0)], new))
                front, rest = np.concatenate([front, new]), rest[~reached]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


_FOUND = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])


def _search(limit):
    """Rows come sorted by bucket. Links have no bucket; members of a bucket beyond the limit have no b."""
    def result(bucket, chunk, a, b):
        n = len(a)
        return pa.RecordBatch.from_arrays([
            pa.array([bucket] * n, pa.int32()), pa.array([chunk] * n, pa.int32()), pa.array(a.view(np.int64)),
            pa.array(b.view(np.int64)) if b is not None else pa.nulls(n, pa.int64())], schema=_FOUND)

    def run(batches):
        at, held, chunk = None, [], 0

        def close():
            values = np.concatenate(held) if held else np.zeros(0, np.uint64)
            if chunk and len(values):
                yield result(at, chunk, values, None)
            elif len(values) > 1:
                a, b = forest(values)
                if len(a):
                    links.append((a, b))

        links = []
        for batch in batches:
            buckets = batch.column(0).to_numpy()
            values = batch.column(1).to_numpy().view(np.uint64)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)]]).tolist()
            for start, stop in zip(cuts, cuts[1:], strict=False):
                if stop == start:
                    continue
                if buckets[start] != at:
                    yield from close()
                    at, held, chunk = int(buckets[start]), [], 0
                held.append(values[start:stop])
                while sum(map(len, held)) > limit:
                    together = np.concatenate(held)
                    yield result(at, chunk, together[:limit], None)
                    held, chunk = [together[limit:]], chunk + 1
            if links:
                yield result(None, None, *(np.concatenate(x) for x in zip(*links, strict=True)))
                links.clear()
        yield from close()
        if links:
            yield result(None, None, *(np.concatenate(x) for x in zip(*links, strict=True)))
    return run


def links(values, limit=BUCKET):
    """(a, b): links that join the same components as all pairs of distinct fingerprints within 3 bits would."""
    dealt = values.select("fingerprint").mapInArrow(_to_buckets, "bucket int, fingerprint bigint")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
    found = stored(dealt.mapInArrow(_search(limit), "bucket int, chunk int, a bigint, b bigint"), "simhash-links")
    large = found.where("bucket IS NOT NULL")
    chunks = large.groupBy("bucket").agg(F.max("chunk").alias("last"))
    paired = large.join(chunks, "bucket").select(
        "bucket", F.col("a").alias("fingerprint"), F.col("chunk"), F.explode(F.sequence(F.lit(0), "last")).alias("other"))
    paired = paired.select(
        "bucket", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "fingerprint")

    def search(key, group):
        a, b = forest(group.column("fingerprint").to_numpy().view(np.uint64))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    more = paired.groupBy("bucket", "i", "j").applyInArrow(search, "a bigint, b bigint")
    return found.where("bucket IS NULL").select("a", "b").unionByName(more)


def classes(ids, limit=BUCKET):
    """(fingerprint, component, component_id, n) for the distinct fingerprints of the stored table ids(doc_id, fingerprint).

    component is the smallest fingerprint, component_id the smallest doc_id of the class, n the rows of the fingerprint.
    """
    values = stored(
        ids.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "fingerprint-values")
    linked = components(links(values, limit)).withColumnRenamed("node", "fingerprint")
    named = stored(values.join(linked, "fingerprint", "left").select(
        "fingerprint", "first", "n", F.coalesce("component", "fingerprint").alias("component")), "fingerprint-classes")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return stored(
        named.join(least, "component").select("fingerprint", "component", "component_id", "n"), "fingerprint-names")


def near_duplicates(docs, id_col="doc_id", text_col="text", width=WIDTH, limit=BUCKET):
    """doc_id, fingerprint (16 hexadecimal digits), component_id: the smallest id reachable by links, itself included."""
    ids = stored(fingerprints(docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text")), width=width)
                 .select("row.doc_id", "fingerprint"), "fingerprints")
    found = lookup(ids, classes(ids, limit), "fingerprint", "n")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs, id_col="doc_id", text_col="text", width=WIDTH, limit=BUCKET):
    """One document of each class, with all its columns: the smallest doc_id; of several rows with that id, one."""
    rows = stored(fingerprints(docs, text_col, width).withColumn("place", F.monotonically_increasing_id()), "fingerprinted")
    ids = rows.select(F.col("row")[id_col].alias("doc_id"), "fingerprint", "place")
    found = lookup(ids, classes(ids, limit), "fingerprint", "n")
    first = found.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "place")).alias("best"))
    return rows.join(first.select("best.place"), "place", "left_semi").select("row.*")
