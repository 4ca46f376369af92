"""Token counts by a two-tier lookup on the map side; no pre-token is shuffled.

A text is cut at white space, which this kind of tokenizer drops and never joins across, so a text has as many tokens as
its pre-tokens together. The first tier is a broadcast table of the lengths of frequent pre-tokens, the second a worker's
own store: what neither holds is encoded by the tokenizers library, once per worker as long as the store has room. Special
strings hold no white space, so they are met inside a pre-token as in the whole text.

The frequent ones are counted over all texts. A task keeps a bounded count (beyond `counted` distinct ones it halves all
counts and lets go of those that reach zero) and sends its `sent` most frequent; the `frequent` most frequent of all are
broadcast. The table only saves work: a count is the same with any table.

Nulls and odd rows: a null text is an empty one, with no bytes and no tokens. Repeated rows are rows of their own. Extra
columns are carried in a struct.
"""

import functools
import json
import os
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rateflow.llm.common import by_piece, pieces, row_and_text, worker_store

FREQUENT = 1 << 16
SENT = 4096
COUNTED = 300_000
#: Lengths that a worker keeps besides the frequent ones; beyond that it starts anew.
CACHED = 500_000
#: White space as the tokenizer's pattern \\s has it; str.split() also cuts at four control characters.
_BLANK = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_CONTROL = re.compile("[\x1c-\x1f]")


def pre_tokens(text):
    if _CONTROL.search(text):
        return [p for p in _BLANK.split(text) if p]
    return text.split()


def checked(tokenizer_json):
    """The tokenizer's JSON; an error if it doesn't drop white space or joins over it."""
    parts = json.loads(tokenizer_json)
    first = (parts["pre_tokenizer"].get("pretokenizers") or [parts["pre_tokenizer"]])[0]
    drops = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]
    if not drops or parts["truncation"] or parts["padding"]:
        raise ValueError("the tokenizer must drop white space and neither cut nor pad")
    return tokenizer_json


@functools.lru_cache(maxsize=2)
def library(tokenizer_json):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_buffer(tokenizer_json)


def lengths(tokenizer_json, words):
    return [len(e) for e in library(tokenizer_json).encode_batch_fast(words, add_special_tokens=False)]


def _count_frequent(sent, counted):
    def run(batches):
        counts = Counter()
        for piece in pieces(batches):
            for text in piece.column("text").cast(pa.string()).to_pylist():
                counts.update(pre_tokens(text))
            while len(counts) > counted:
                counts = Counter({w: n >> 1 for w, n in counts.items() if n > 1})
        best = counts.most_common(sent)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())], names=["word", "n"])
    return run


def frequent_words(texts, frequent=FREQUENT, sent=SENT, counted=COUNTED):
    """At most `frequent` pre-tokens, the most frequent first."""
    found = texts.mapInArrow(_count_frequent(sent, counted), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return [r[0] for r in found.orderBy(F.desc("n"), "word").limit(frequent).collect()]


class Lengths:
    """A worker's two tiers: the broadcast lengths, and those that it has encoded itself."""

    def __init__(self, tokenizer_json, table):
        words, counts = table
        self.json = tokenizer_json
        self.frequent = dict(zip(words.decode().split(" ") if words else [], counts.tolist(), strict=True))
        self.known = dict(self.frequent)

    def count(self, texts):
        """Number of tokens of each text."""
        split = list(map(pre_tokens, texts))
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > len(self.frequent) + CACHED:
            self.known = dict(self.frequent)
            new = set().union(*split).difference(self.known)
        new = list(new)
        for at in range(0, len(new), 10_000):
            some = new[at:at + 10_000]
            self.known.update(zip(some, lengths(self.json, some), strict=True))
        get = self.known.__getitem__
        return [sum(map(get, words)) for words in split]


def count_tokens(docs, tokenizer_path, text_col="text", frequent=FREQUENT):
    """row (all columns of docs), n_bytes, n_tokens."""
    context = docs.sparkSession.sparkContext
    with open(tokenizer_path, "rb") as file:
        tokenizer_json = checked(file.read())
    rows = row_and_text(docs, text_col)
    words = frequent_words(rows.select("text"), frequent)
    table = " ".join(words).encode(), np.array(lengths(tokenizer_json, words), np.uint32)
    shared = context.broadcast((tokenizer_json, table))
    key = uuid.uuid4().hex

    def run(piece):
        own = worker_store(key, lambda: Lengths(*shared.value))
        texts = piece.column("text")
        n_tokens = own.count(texts.cast(pa.string()).to_pylist())
        return {"row": piece.column("row"), "n_bytes": pc.binary_length(texts).cast(pa.int64()),
                "n_tokens": pa.array(n_tokens, pa.int64())}

    schema = rows.select("row", F.lit(0).cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_tokens")).schema
    return rows.mapInArrow(by_piece(run, key=key), schema)
