"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly with numpy.

A word's bag is its hashed character n-grams and the word itself; its vector is their average. A text's vector is the
average of its words' vectors times their number, as a few words decide about a text of any length; two linear outputs
go through a softmax. Misspelt and unseen words share the n-grams of known ones.

Embeddings and outputs are learned together, by full-batch Adam with weight decay and both labels of equal weight, on at
most `max_rows` labelled rows of each label with texts of at most `max_chars` characters. Buckets whose presence differs
between the labels by under `MIN_Z` standard errors stay at zero; without that the many rare n-grams are learned by heart.
All texts are scored whole, however long.

Since the outputs are linear in the average, a word adds one number to the difference of the two outputs. Workers compute
that number for new words in batches and keep a bounded number of them.

Nulls and odd rows: a null or empty text has the score of the bias alone. Rows with a null id, text or label are not
learned from; an id that is labelled with 0 and with 1 counts for both. Without rows of both labels every score is the
share of label 1, or 0. Extra columns are carried in a struct.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rateflow.llm.common import by_piece, column, first_of_labels, row_and_text, worker_store
from rateflow.llm.ngrams import hashed

MAX_ROWS = 1000
MAX_CHARS = 200_000
BUCKETS = 1 << 16
WORDS = 1 << 15
SIZES = (3, 4, 5)
DIMENSION = 8
EPOCHS = 60
MIN_Z = 4
DECAY, RATE = 1e-4, 0.02
CACHED_WORDS = 300_000
_STRIP = "".join(map(chr, range(0x21, 0x30))) + "".join(map(chr, range(0x3A, 0x41))) + "[\\]^_`{|}~"


def words_of(text):
    return [w for p in text.lower().split() if (w := p.strip(_STRIP))]


def bags(words):
    """(number of the word, bucket, weight): the averaged bag of each word; the last WORDS buckets are whole words."""
    word, bucket, whole = hashed(words, SIZES, BUCKETS)
    word = np.concatenate([word, np.arange(len(words))])
    bucket = np.concatenate([bucket, BUCKETS + (whole % np.uint64(WORDS)).astype(np.int64)])
    return word, bucket, (1 / np.bincount(word, minlength=len(words)))[word].astype(np.float32)


def _documents(texts):
    """(text, bucket, weight), the sum of the averaged bags of the words of each text, equal pairs once."""
    split = [words_of(t) for t in texts]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*split)))}
    word, bucket, weight = bags(list(vocabulary))
    ends = np.cumsum(np.bincount(word, minlength=len(vocabulary)))
    order = np.argsort(word, kind="stable")
    bucket, weight = bucket[order], weight[order]
    out = []
    for i, words in enumerate(split):
        numbers, times = np.unique([vocabulary[w] for w in words], return_counts=True)
        if not len(numbers):
            continue
        at = np.concatenate([np.arange(ends[n - 1] if n else 0, ends[n]) for n in numbers.tolist()])
        sizes = np.array([ends[n] - (ends[n - 1] if n else 0) for n in numbers.tolist()])
        total = np.bincount(bucket[at], weight[at] * np.repeat(times, sizes), BUCKETS + WORDS)
        some = np.flatnonzero(total)
        out.append((np.full(len(some), i), some, total[some].astype(np.float32)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def _telling(text, bucket, labels):
    """Buckets whose presence in texts differs between the labels by MIN_Z standard errors."""
    n1, n = labels.sum(), len(labels)
    with_1 = np.bincount(bucket, labels[text], BUCKETS + WORDS)
    with_any = np.bincount(bucket, minlength=BUCKETS + WORDS)
    share = with_any / n
    error = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n1 + 1 / (n - n1)))
    return np.abs(with_1 / n1 - (with_any - with_1) / (n - n1)) >= MIN_Z * error


class Model:
    """Embeddings of buckets and two linear outputs with a bias; `word_scores` is what words add to their difference."""

    def __init__(self, texts, labels, seed=7):
        labels = np.asarray(labels, np.int64)
        self.bucket_scores = np.zeros(BUCKETS + WORDS, np.float32)
        share = float(labels.mean()) if len(labels) else 0.0
        self.bias = float(np.log(share / (1 - share))) if 0 < share < 1 else np.inf if share else -np.inf
        if 0 < share < 1:
            self._fit(texts, labels, seed)

    def _fit(self, texts, labels, seed):
        text, bucket, weight = _documents(texts)
        chosen = _telling(text, bucket, labels)[bucket]
        text, bucket, weight = text[chosen], bucket[chosen], weight[chosen, None]
        used, bucket = np.unique(bucket, return_inverse=True)
        order = np.argsort(bucket, kind="stable")
        bucket_starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        own, text_starts = np.unique(text, return_index=True)
        rng = np.random.default_rng(seed)
        n = len(labels)
        vectors = rng.normal(0, 0.05, (len(used), DIMENSION)).astype(np.float32)
        outputs = rng.normal(0, 0.5, (DIMENSION, 2)).astype(np.float32)
        bias = np.zeros(2, np.float32)
        each = (0.5 / np.bincount(labels, minlength=2)[labels]).astype(np.float32)[:, None]
        target = np.eye(2, dtype=np.float32)[labels]
        parameters = (vectors, outputs, bias)
        state = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
        for step in range(1, EPOCHS + 1):
            mean = np.zeros((n, DIMENSION), np.float32)
            if len(used):
                mean[own] = np.add.reduceat(vectors[bucket] * weight, text_starts)
            z = mean @ outputs + bias
            p = np.exp(z - z.max(1, keepdims=True))
            dz = (p / p.sum(1, keepdims=True) - target) * each
            back = (dz @ outputs.T)[text[order]] * weight[order]
            into = np.add.reduceat(back, bucket_starts) if len(used) else vectors
            for value, slope, (m, v) in zip(
                    parameters, (into + DECAY * vectors, mean.T @ dz, dz.sum(0)), state, strict=True):
                m += 0.1 * (slope - m)
                v += 0.01 * (slope * slope - v)
                value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.bucket_scores[used] = vectors @ (outputs[:, 1] - outputs[:, 0])
        self.bias = float(bias[1] - bias[0])

    def word_scores(self, words):
        word, bucket, weight = bags(words)
        return np.bincount(word, self.bucket_scores[bucket] * weight, len(words))


class Scorer:
    """Scores texts with a bounded store of word scores."""

    def __init__(self, model):
        self.model, self.known = model, {}

    def score(self, texts):
        split = list(map(words_of, texts))
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known.clear()
            new = set().union(*split)
        new = list(new)
        for at in range(0, len(new), 10_000):
            some = new[at:at + 10_000]
            self.known.update(zip(some, self.model.word_scores(some).tolist(), strict=True))
        get = self.known.__getitem__
        z = np.array([sum(map(get, words)) for words in split]) + self.model.bias
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def train(docs, labels, learn, id_col="doc_id", text_col="text", label_col="toxic", max_rows=MAX_ROWS, max_chars=MAX_CHARS):
    """A model from labelled rows. `learn` is a condition on the id column; labels other than 0 and 1 don't count.

    Of each label the max_rows ids of the smallest hash are taken, so the sample depends on the ids only; of a repeated
    id the smallest text.
    """
    known = labels.where(learn).select(column(id_col).alias("id"), column(label_col).alias("label"))
    known = known.where("id IS NOT NULL AND label IN (0, 1)").distinct()
    known = first_of_labels(known, "label", max_rows)
    texts = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    texts = texts.where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    texts = texts.join(F.broadcast(known), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = sorted(map(tuple, texts.select("id", "label", "text").collect()))
    return Model([r[2] for r in rows], [r[1] for r in rows])


def score(docs, model, text_col="text"):
    """row (all columns of docs), score: the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def run(piece):
        own = worker_store(key, lambda: Scorer(shared.value))
        return {"row": piece.column("row"), "score": pa.array(own.score(piece.column("text").cast(pa.string()).to_pylist()))}

    rows = row_and_text(docs, text_col)
    return rows.mapInArrow(by_piece(run, key=key), rows.select("row", F.lit(0.0).alias("score")).schema)
