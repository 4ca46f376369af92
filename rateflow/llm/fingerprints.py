"""Document fingerprints by MinHash: universal hash permutations over shingles, banded joins, verified Jaccard.

Words are cut at ASCII white space, A-Z lower-cased. Shingles are `WIDTH` = 5 consecutive words, one ending at each word; at
the beginning of a text they reach over its edge, so that short texts have as many shingles as words. A permutation maps
a shingle's 64-bit hash x to a * x + b modulo 2**64 (a odd, both from a seeded generator); a signature holds the smallest
value of each of `PERMUTATIONS` permutations, reduced to its upper 32 bits. All is numpy over whole batches.

The fingerprint of a text is the lowest 8 bits of each entry. Two fingerprints agree by chance in one entry of 256, which
their likeness allows for. For near-duplicates, signatures are cut into bands of `BAND_ROWS` entries, distinct texts with
an equal band meet in Spark, and only pairs with a Jaccard similarity of shingles of at least 0.8 are linked.

Nulls and odd rows: a null text is an empty one; a text without words has no shingles and a fingerprint of ones. In the
order of documents null ids come first, and rows with equal ids are ordered by text. Extra columns are not read by
`fingerprint_edits` and carried in a struct by `signatures`.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rateflow.llm.common import by_piece, column, id_and_text, lookup, pieces, row_and_text, search_buckets, stored
from rateflow.llm.components import components
from rateflow.llm.wordhash import mixed, spoken, window_hashes

WIDTH = 5
PERMUTATIONS = 128
SEED = 11
BAND_ROWS = 5
SIMILARITY = 0.8
#: Texts of a bucket that are compared at once.
BUCKET = 256
#: Ranges of ids at most; a bound on what the driver holds.
RANGES = 1024
_EDGE = np.uint64(0x1F123BB5159A55E5)
#: Small pieces, as the arrays of one permutation should stay in a core's cache.
_PIECE = 1 << 19


def _factors(n=PERMUTATIONS):
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 64, n, np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, n, np.uint64)


def shingles(texts, width=WIDTH):
    """Flat shingle hashes of all texts, and the number of each text's shingles."""
    words, sizes = spoken(texts)
    place = np.repeat(np.cumsum(sizes) - sizes, width - 1)
    framed = np.insert(words, place, _EDGE)
    rolled = mixed(window_hashes(framed, width))
    starts = np.cumsum(sizes + width - 1) - sizes - width + 1
    take = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return rolled[take], sizes


def minhashes(texts, width=WIDTH):
    """One row of PERMUTATIONS 32-bit numbers for each text."""
    values, sizes = shingles(texts, width)
    out = np.full((len(texts), PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        for i, (a, b) in enumerate(zip(*_factors(), strict=True)):
            out[some, i] = np.minimum.reduceat(values * a + b, starts) >> np.uint64(32)
    return out


def _hex(signatures):
    return [row.tobytes().hex() for row in signatures.astype(np.uint8)]


def likeness(a, b):
    """Estimated Jaccard similarity of each row of two fingerprints given as signatures, from 8 bits of each entry."""
    same = (a.astype(np.uint8) == b.astype(np.uint8)).mean(1)
    return np.clip((same - 1 / 256) / (1 - 1 / 256), 0, 1)


def in_order(docs, id_col="doc_id", text_col="text"):
    """Documents dealt to tasks by ranges of ids: own rows in order, then, as guests, the row that follows the range.

    Ids are cut at approximate quantiles. The driver holds one id for each range. Text is shuffled once.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    n = max(1, min(RANGES, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    part = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda c: c <= F.col("doc_id")))
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(part))
    firsts = rows.groupBy("part").agg(
        F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("absent")).orderBy("part").collect()
    before = [(r["part"], None if r["absent"] else r["least"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)]
    edges = F.broadcast(spark.createDataFrame(before, "part int, first bigint, before int"))
    owner = F.struct("part", F.lit(False).alias("guest"))
    host = F.struct(F.col("before").alias("part"), F.lit(True).alias("guest"))
    place = F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.array(owner, host)).otherwise(F.array(owner)))
    dealt = rows.join(edges, "part").select(place.alias("at"), "doc_id", "text").select("at.*", "doc_id", "text")
    return dealt.repartitionById(n, "part").sortWithinPartitions("part", "guest", F.asc_nulls_first("doc_id"), "text")


_EDITS = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _edits(batches):
    """Rows come in the order of in_order; a row is given out once the next is known."""
    held = None  # part, id, text, signature
    for piece in pieces(batches, limit=_PIECE):
        part, guest, ids, texts = (piece.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text"))
        own = list(zip(part, ids, texts, minhashes(texts), strict=True))
        pairs = []
        for row, is_guest in zip(own, guest, strict=True):
            if held is not None and held[0] == row[0]:
                pairs.append((held, row))
            held = None if is_guest else row
        if not pairs:
            continue
        read = [a[2].decode("utf-8", "replace") for a, _ in pairs]
        edited = []
        for text, (_, b) in zip(read, pairs, strict=True):
            half = len(text) // 2
            edited.append((text[:len(text) - half] + b[2][:4 * half].decode("utf-8", "ignore")[:half]).encode())
        first, then, later = np.stack([a[3] for a, _ in pairs]), minhashes(edited), np.stack([b[3] for _, b in pairs])
        yield pa.RecordBatch.from_arrays([
            pa.array([a[1] for a, _ in pairs], pa.int64()), pa.array(list(map(len, read)), pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array(_hex(first)), pa.array(_hex(then)),
            pa.array(likeness(first, then)), pa.array(likeness(first, later))], schema=_EDITS)


def fingerprint_edits(docs, id_col="doc_id", text_col="text"):
    """Fingerprints of each text and of its edit, whose second half is taken from the next document, and their likeness."""
    return in_order(docs, id_col, text_col).mapInArrow(
        _edits, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double")


def signatures(docs, text_col="text", width=WIDTH):
    """row (all columns of docs), signature."""
    def run(piece):
        found = minhashes(piece.column("text").to_pylist(), width)
        return {"row": piece.column("row"), "signature": pa.array(list(found.view(np.int32)), pa.list_(pa.int32()))}

    rows = row_and_text(docs, text_col)
    return rows.mapInArrow(
        by_piece(run, limit=_PIECE), rows.select("row", F.array().cast("array<int>").alias("signature")).schema)


def _similar_links(table):
    """Links of a spanning forest of the texts in a bucket whose shingle sets are similar enough."""
    ids = np.array(table.column("digest").to_pylist(), object)
    sets = [np.unique(np.array(x, np.int64)) for x in table.column("shingles").to_pylist()]
    rest, a, b = list(range(len(ids))), [], []
    while rest:
        front = [rest.pop(0)]
        while front and rest:
            i, left = front.pop(), []
            for j in rest:
                small, large = sorted((len(sets[i]), len(sets[j])))
                common = 0 if small < SIMILARITY * large else len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if common and common >= SIMILARITY * (small + large - common):
                    a.append(ids[i]), b.append(ids[j])
                    front.append(j)
                else:
                    left.append(j)
            rest = left
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def near_duplicates(docs, id_col="doc_id", text_col="text", width=WIDTH):
    """doc_id, component_id: the smallest id of the texts linked by a Jaccard similarity of shingles of 0.8 or more.

    Equal texts are compared once. Texts without words are linked to equal texts only.
    """
    def run(piece):
        texts = piece.column("text").to_pylist()
        values, sizes = shingles(texts, width)
        found = minhashes(texts, width)
        n_bands = PERMUTATIONS // BAND_ROWS
        bands = [[r[i * BAND_ROWS:(i + 1) * BAND_ROWS].tobytes() + bytes([i]) for i in range(n_bands)] if n else []
                 for r, n in zip(found, sizes.tolist(), strict=True)]
        return {"digest": piece.column("digest"), "bands": pa.array(bands, pa.list_(pa.binary())), "shingles": pa.array(
            np.split(values.view(np.int64), np.cumsum(sizes)[:-1]), pa.list_(pa.int64()))}

    rows = id_and_text(docs, id_col, text_col).withColumn("digest", F.unhex(F.sha2("text", 256)))
    ids = rows.select("doc_id", "digest")
    texts = rows.groupBy("digest").agg(F.min("text").alias("text"))
    signed = stored(
        texts.mapInArrow(by_piece(run, limit=_PIECE), "digest binary, bands array<binary>, shingles array<bigint>"), "minhash")
    members = signed.select("digest", F.explode("bands").alias("band"), "shingles")
    found = search_buckets(members, "band", "digest", BUCKET, _similar_links, "a binary, b binary")
    named = components(found).withColumnRenamed("node", "digest")
    counted = ids.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    classes = stored(counted.join(named, "digest", "left").withColumn("component", F.coalesce("component", "digest")), "classes")
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    answers = stored(classes.join(least, "component").select("digest", "component_id", "n"), "class-names")
    return lookup(ids, answers, "digest", "n").select("doc_id", "component_id")
