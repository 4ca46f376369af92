"""Line deduplication: two Bloom filters find suspected repeats; only these are shuffled for an exact decision.

A text is split at line feeds (null or empty: one empty line). A line's key is the line without ASCII white space at
both ends, with A-Z lower-cased. A key of at least `min_chars` code points that is found in at least two documents
loses all its lines but those in the smallest doc_id that holds it.

1. Every task sets the bits of its keys in a "once" filter and the bits that a second document sets again in a "twice"
   filter. Filters are cut into segments, sent as bit numbers where sparse, and merged segment by segment; a bit that two
   tasks have once is twice. A key of two documents has all its bits in the merged twice filter.
2. With that filter broadcast, each document sends the digests of its suspected keys. A grouped minimum, summed up before
   the shuffle, confirms the repeats and chooses the first document.
3. Documents without a suspect pass unshuffled. The others are joined with the digests they lose.

The filter has `bits_per_key` bits a line, at most `max_bits`, which bounds the broadcast; where a corpus has more lines
than fit, more keys are suspected and shuffled as digests, with the same result.

Nulls and odd rows: rows that share a doc_id are one document for this rule, so they keep or lose a key together. A null
doc_id is one document that comes after all others. Extra columns are carried in a struct.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from rateflow.llm import bloom
from rateflow.llm.common import bound_batches, by_piece, column, lookup, pieces, stored, whole_row

MIN_CHARS = 10
BITS_PER_KEY = 8
MAX_BITS = 1 << 28


def line_key(line, min_chars=MIN_CHARS):
    """The key of a line as bytes; None where it is too short to count."""
    key = line.strip().lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key


def _digest(key):
    return hashlib.blake2b(key, digest_size=16).digest()


def _keys(text, min_chars):
    return {k for line in text.split(b"\n") if (k := line_key(line, min_chars)) is not None}


def _hashes(keys):
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, keys)), ">u8").astype(np.uint64)


def _suspects(text, twice, min_chars):
    keys = list(_keys(text, min_chars))
    if not keys:
        return []
    return [_digest(keys[i]) for i in np.flatnonzero(bloom.contains(twice, _hashes(keys)))]


def dedup_lines(docs, id_col="doc_id", text_col="text", min_chars=MIN_CHARS, bits_per_key=BITS_PER_KEY,
                max_bits=MAX_BITS):
    """row (all columns of docs), kept_text, n_lines, n_dropped; one row for each row of docs."""
    spark = docs.sparkSession
    bound_batches(spark)
    text = F.coalesce(column(text_col), F.lit(""))
    texts = docs.select(text.cast("binary").alias("text"))
    lines = docs.select((F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).alias("n")).agg(F.sum("n")).first()[0]
    bits = bloom.size_for(lines or 0, bits_per_key, max_bits)

    def fill(batches):
        filters = bloom.Pair(bits)
        for piece in pieces(batches):
            filters.add(_hashes([k for text in piece.column("text").to_pylist() for k in _keys(text, min_chars)]))
        yield from filters.batches()

    shared = spark.sparkContext.broadcast(bloom.twice_filter(texts.mapInArrow(fill, bloom.PARTIAL), bits))

    rows = docs.select(whole_row(docs), text.cast("binary").alias("text"), column(id_col).alias("doc_id"))

    def mark(piece):
        texts = piece.column("text").to_pylist()
        found = [_suspects(t, shared.value, min_chars) for t in texts]
        return {c: piece.column(c) for c in piece.schema.names if c != "text"} | {
            "n_lines": pa.array([t.count(b"\n") + 1 for t in texts], pa.int64()),
            "suspects": pa.array(found, pa.list_(pa.binary()))}

    def kept(piece):
        out, n_dropped = [], []
        for t, gone in zip(piece.column("text").to_pylist(), piece.column("lost").to_pylist(), strict=True):
            lines, gone = t.split(b"\n"), set(gone or ())
            left = [x for x in lines if not gone or (k := line_key(x, min_chars)) is None or _digest(k) not in gone]
            out.append(b"\n".join(left))
            n_dropped.append(len(lines) - len(left))
        return {"row": piece.column("row"), "kept_text": pa.array(out, pa.binary()).cast(pa.string()),
                "n_lines": piece.column("n_lines"), "n_dropped": pa.array(n_dropped, pa.int64())}

    def marked(frame):
        schema = frame.drop("text").withColumns(
            {"n_lines": F.lit(0).cast("bigint"), "suspects": F.array().cast("array<binary>")}).schema
        return frame.mapInArrow(by_piece(mark), schema)

    suspects = stored(
        marked(rows.select("doc_id", "text")).select("doc_id", F.explode("suspects").alias("key")), "line-suspects")
    absent = F.sum(F.col("doc_id").isNull().cast("bigint"))
    repeats = stored(
        suspects.groupBy("key").agg(
            F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), absent.alias("absent"), F.count("*").alias("n"))
        .where("first <> last OR (absent > 0 AND first IS NOT NULL)").select("key", "first", "n"), "line-repeats")
    lost = lookup(suspects, repeats, "key", "n").where("first IS NOT NULL AND NOT doc_id <=> first")
    lost = lost.groupBy("doc_id").agg(F.collect_set("key").alias("lost"))

    own_text = F.coalesce(column("row").getField(text_col), F.lit(""))
    every = marked(rows)
    clean = every.where(F.size("suspects") == 0).select(
        "row", own_text.alias("kept_text"), "n_lines", F.lit(0).cast("bigint").alias("n_dropped"))
    touched = every.where(F.size("suspects") > 0).select("row", "doc_id", "n_lines").alias("m").join(
        lost.alias("l"), F.col("m.doc_id").eqNullSafe(F.col("l.doc_id")), "left")
    touched = touched.select("row", own_text.cast("binary").alias("text"), "n_lines", "lost")
    return clean.unionByName(touched.mapInArrow(by_piece(kept), clean.schema))


def replaced(kept, text_col="text", count_col="n_chars"):
    """The rows of dedup_lines with the kept text in place of the text; a column `count_col` follows it."""
    fields = kept.schema["row"].dataType.names
    text = {text_col: F.col("kept_text"), count_col: F.length("kept_text").cast("bigint")}
    return kept.select(*[text.get(c, column("row").getField(c)).alias(c) for c in fields])
