"""Benchmark decontamination: windows of benchmark words, broadcast as a hash set, are looked up in every document.

Words are runs of ASCII letters and digits and of all other characters beyond ASCII, with A-Z lower-cased. Each window
of `width` consecutive words of an item is a key; an item of fewer words, but not none, is one key. Workers hash the
words and windows of whole batches of documents with numpy, look the hashes up, and compare the words of every hit with
the words of the window, so a hash never decides alone.

The windows are broadcast in blocks of at most `block_bytes`, which is measured first; a larger benchmark is several
blocks, and the documents pass them one after the other in the same stage, without a shuffle.

Nulls and odd rows: a null text has no words; an item without words, or with a null text, has no window; a null item_id
is named by the empty string. Items that share an id are one item. Repeated documents are separate rows. Extra columns
are carried along in a struct, so their names cannot clash. An empty benchmark hits nothing.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rateflow.llm.common import by_piece, column, row_and_text
from rateflow.llm.wordhash import window_hashes, word_table

WIDTH = 13
BLOCK_BYTES = 32 << 20
HITS = "array<struct<first:bigint,last:bigint,start:bigint,stop:bigint>>"

_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = True
_IS_WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_TO_WORDS = bytes(int(_LOWER[i]) if _IS_WORD[_LOWER[i]] else 0x20 for i in range(256))


def _words(data):
    return data.translate(_TO_WORDS).split()


def item_windows(benchmark, id_col="item_id", text_col="text", width=WIDTH):
    """(item, n_words, words): the distinct windows of all items; `words` are joined by a space, as bytes."""
    def windows(piece):
        item, size, key = [], [], []
        for name, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
            words = _words(text)
            w = min(width, len(words))
            for i in range(len(words) - w + 1 if words else 0):
                item.append(name), size.append(w), key.append(b" ".join(words[i:i + w]))
        return {"item": pa.array(item, pa.string()), "n_words": pa.array(size, pa.int32()), "words": pa.array(key, pa.binary())}

    items = benchmark.select(
        F.coalesce(column(id_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"))
    return items.mapInArrow(by_piece(windows), "item string, n_words int, words binary").distinct()


class _Block:
    """Windows of one block: a filter on hash bits, sorted hashes and, by hash, the words with their items."""

    def __init__(self, rows):
        self.by_width = {}
        grouped = {}
        for item, size, words in rows:
            grouped.setdefault(size, {}).setdefault(bytes(words), []).append(item)
        for size, windows in grouped.items():
            data = np.frombuffer(b"".join(w + b" " for w in windows), np.uint8)
            hashes = window_hashes(word_table(data, _IS_WORD[data])[2], size)[::size]
            by_hash = {}
            for h, w in zip(hashes.tolist(), windows, strict=True):
                by_hash.setdefault(h, []).append(w)
            shift = np.uint64(64 - max(16, math.ceil(math.log2(len(hashes))) + 6))
            seen = np.zeros(1 << int(np.uint64(64) - shift), bool)
            seen[hashes >> shift] = True
            self.by_width[size] = (shift, seen, np.unique(hashes), by_hash, windows)


def _scan(block, texts):
    """Per text: its number of words, its hit runs and the items found."""
    lows = b"\x00".join(texts)
    data = _LOWER[np.frombuffer(lows, np.uint8)]
    starts, ends, hashes = word_table(data, _IS_WORD[data])
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
    first_word = np.searchsorted(starts, np.append(begins, begins[-1] + sizes[-1] + 1))
    doc_of = np.repeat(np.arange(len(texts)), np.diff(first_word))
    marks = np.zeros(len(starts) + 1, np.int64)
    items = {}
    raw = data.tobytes()
    for size, (shift, seen, known, by_hash, names) in block.by_width.items():
        rolled = window_hashes(hashes, size)
        at = np.flatnonzero(seen[rolled >> shift])
        place = np.minimum(np.searchsorted(known, rolled[at]), len(known) - 1)
        at = at[(known[place] == rolled[at]) & (doc_of[at] == doc_of[at + size - 1])]
        for i in at.tolist():
            words = b" ".join(_words(raw[starts[i]:ends[i + size - 1]]))
            if words in by_hash[int(rolled[i])]:
                marks[i] += 1
                marks[i + size] -= 1
                items.setdefault(int(doc_of[i]), set()).update(names[words])
    hit = np.cumsum(marks[:-1]) > 0
    return first_word, starts, ends, begins, hit, items


def _spans(hit, first, starts, ends, begin, text):
    """Runs of hit words of one text: numbers of the first and last word, code points where they start and stop."""
    edges = np.flatnonzero(np.diff(hit, prepend=False, append=False))
    out, at, points = [], 0, 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        place = []
        for byte in (int(starts[first + a] - begin), int(ends[first + b - 1] - begin)):
            points += len(text[at:byte].decode("utf-8", "replace"))
            at = byte
            place.append(points)
        out.append({"first": a, "last": b - 1, "start": place[0], "stop": place[1]})
    return out


def find_hits(docs, benchmark, text_col="text", item_col="item_id", item_text_col="text", width=WIDTH,
              block_bytes=BLOCK_BYTES):
    """row (all columns of docs), n_words, hits (runs of words inside a window of an item), items (their ids, sorted)."""
    spark = docs.sparkSession
    windows = item_windows(benchmark, item_col, item_text_col, width)
    total = windows.agg(F.sum(F.length("words") + F.length("item") + 100)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    out = row_and_text(docs, text_col).withColumns({
        "n_words": F.lit(0).cast("bigint"), "hits": F.array().cast(HITS), "items": F.array().cast("array<string>")})
    schema = out.schema
    for k in range(blocks):
        part = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k)
        shared = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])
        out = out.mapInArrow(_scanner(shared), schema)
    return out.drop("text")


def _scanner(shared):
    def run(batches):
        block = _Block(shared.value)

        def scan(piece):
            texts = piece.column("text").to_pylist()
            first_word, starts, ends, begins, hit, items = _scan(block, texts)
            hits, found = piece.column("hits").to_pylist(), piece.column("items").to_pylist()
            for i in items:
                a, b = first_word[i], first_word[i + 1]
                mask = hit[a:b].copy()
                for old in hits[i]:
                    mask[old["first"]:old["last"] + 1] = True
                hits[i] = _spans(mask, a, starts, ends, begins[i], texts[i])
                found[i] = sorted(items[i].union(found[i]))
            n = np.diff(first_word).astype(np.int64)
            return {"row": piece.column("row"), "text": piece.column("text"), "n_words": pa.array(n),
                    "hits": pa.array(hits, piece.schema.field("hits").type), "items": pa.array(found, pa.list_(pa.string()))}

        yield from by_piece(scan)(batches)
    return run


def n_hit(hits="hits"):
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, h: n + h["last"] - h["first"] + 1)


def is_contaminated(n_words="n_words", hits="hits"):
    """At least one word in twenty is inside a window of a benchmark item."""
    return (F.size(hits) > 0) & (20 * n_hit(hits) >= F.col(n_words))


def without_documents(docs, benchmark, text_col="text", **how):
    """docs without the contaminated ones."""
    found = find_hits(docs, benchmark, text_col, **how)
    return found.where(~is_contaminated()).select("row.*")


def without_spans(docs, benchmark, text_col="text", **how):
    """docs with every hit run cut out of its text; other texts, and all other columns, stay as they are."""
    found = find_hits(docs, benchmark, text_col, **how)
    text = column("row").getField(text_col)
    part = lambda at, *size: F.substring(text, at.cast("int") + 1, *size)
    kept = F.aggregate(
        "hits", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("kept")),
        lambda s, h: F.struct(
            h["stop"].alias("at"), F.concat(s["kept"], part(s["at"], (h["start"] - s["at"]).cast("int"))).alias("kept")),
        lambda s: F.concat(s["kept"], part(s["at"], F.lit(2**31 - 1))))
    cut = found.select("row", F.when(F.size("hits") > 0, kept).otherwise(text).alias("cut"))
    return cut.select(*[(F.col("cut") if c == text_col else column("row").getField(c)).alias(c) for c in docs.columns])
