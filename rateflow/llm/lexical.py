"""Ranked lexical search: impact vectors in buckets of like length, as LEMP searches for large entries of a product.

A document's impact vector has a coordinate for every term of the asked items that it holds:
w * ((10**9 * tf) div (1000 * tf + 20 * m)) by the contract's integers, with the term's weight w over all documents and m
from the document's length. An item is the vector with a one at each of its terms, and its score the inner product.

Documents are read once: words are cut in flat byte arrays and looked up in the items' vocabulary; a document keeps the
numbers and counts of its known terms. Vectors are then ordered by length, longest first (a range shuffle, where the row's
number splits equal lengths), and each task cuts its run into buckets of `BUCKET_ROWS`. With theta, an item's least score that still counts:

* a bucket whose greatest length times the item's length is under theta is skipped (Cauchy-Schwarz), and so is one where
  the greatest coordinates at the item's terms add up to less;
* inside, the terms with the greatest coordinates are the focus, until the others add up to at most `REST` of theta. The
  focus is summed over its postings; a document stays only if the sum, with the others' greatest coordinates or with
  what Cauchy-Schwarz leaves for the others (their number, and the length without the focus), can reach theta;
* whoever stays is scored again over all its terms in 64-bit integers.

theta is the item's k-th best of a sample of `SAMPLE_ROWS` documents, which only saves work, and rises with every bucket.
Each task hands its k best of every item to the merge. Items go in blocks of `BLOCK_BYTES` of distinct terms (an item with
more is a block of its own), one pass over the documents each, whose results are stored; so the vocabulary that goes to tasks is bounded.

A null or empty text has no terms. Rows that share an item id are one item with the terms of all of them. Every row is a
document: repeated rows count and are ranked each; a document without an id counts in N, L and df, but can't be returned.
Equal scores go by ascending id. Without documents or items there are no rows. Other columns are not read.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rateflow.llm.common import bound_batches, column, pieces, stored
from rateflow.llm.terms import LETTERS_DIGITS, runs
from rateflow.session import work_path

TOP = 50
BUCKET_ROWS = 4096
SAMPLE_ROWS = 4096
BLOCK_BYTES = 8 << 20
#: The terms outside the focus may add up to this share of theta.
REST = 0.5
#: Vectors that a partition of the ordered documents holds.
PARTITION_ROWS = 100_000
_SLACK = 1 + 1e-9
_FOUND = "item int, doc_id bigint, score bigint"


def item_terms(items, id_col="item_id", text_col="text"):
    """item_id and term (bytes), each pair once."""
    bound_batches(items.sparkSession)
    rows = items.select(column(id_col).alias("item_id"), F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"))

    def cut(batches):
        for piece in pieces(batches):
            words, counts = runs(piece.column("text"), LETTERS_DIGITS)
            owner = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays([piece.column("item_id").take(owner), words], names=["item_id", "term"])

    schema = T.StructType([rows.schema["item_id"], T.StructField("term", T.BinaryType())])
    return rows.mapInArrow(cut, schema).distinct()


def _counted(vocabulary, batches):
    """Per document: its words, and number and count of each of its terms in the vocabulary."""
    known = pa.array(vocabulary, pa.binary())
    for piece in pieces(batches):
        words, counts = runs(piece.column("text"), LETTERS_DIGITS)
        number = pc.index_in(words, value_set=known)
        number = number.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(counts)), counts)
        keep = number >= 0
        both, tf = np.unique(owner[keep] * len(vocabulary) + number[keep], return_counts=True)
        owner, term = np.divmod(both, max(1, len(vocabulary)))
        ends = np.searchsorted(owner, np.arange(len(counts) + 1)) * 4
        term, tf = term.astype("<i4").tobytes(), tf.astype("<i4").tobytes()
        cut = [(a, b) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([
            piece.column("doc_id"), pa.array(counts, pa.int64()), pa.array([term[a:b] for a, b in cut], pa.binary()),
            pa.array([tf[a:b] for a, b in cut], pa.binary())], names=["doc_id", "n", "terms", "tf"])


def counted_terms(docs, vocabulary, id_col="doc_id", text_col="text"):
    """doc_id, n (all words), terms and tf: numbers of the vocabulary's terms in the text and their counts, packed."""
    bound_batches(docs.sparkSession)
    rows = docs.select(column(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(
        lambda batches: _counted(vocabulary, batches), "doc_id bigint, n bigint, terms binary, tf binary")


def _ints(packed):
    """Packed 32-bit integers of many rows as one array of longs, and the number of each row."""
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
    return np.frombuffer(b"".join(packed), "<i4").astype(np.int64), sizes


def document_counts(counted, n_terms):
    """The number of documents that hold each term, as an array."""
    def add(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_ints(batch.column("terms").to_pylist())[0], minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["term", "df"])

    rows = counted.select("terms").mapInArrow(add, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(n_terms, np.int64)
    for r in rows:
        out[r["term"]] = r["df"]
    return out


def impacts(term, tf, n, weights, n_docs, n_words):
    """The integer impacts of terms with their counts in documents of n words."""
    if len(n) and int(n.max()) * 50 * n_docs > (1 << 63) - 1:  # beyond 64 bits between the steps
        m = 50 + np.array([50 * int(x) * n_docs // n_words for x in n], np.int64)
    else:
        m = 50 + 50 * n * n_docs // max(1, n_words)
    return weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m))


def impact_vectors(counted, weights, n_docs, n_words):
    """doc_id, length, terms and impacts (packed) of the documents with a term of positive impact."""
    def make(batches):
        for batch in batches:
            term, sizes = _ints(batch.column("terms").to_pylist())
            tf, _ = _ints(batch.column("tf").to_pylist())
            n = np.repeat(batch.column("n").to_numpy(), sizes)
            impact = impacts(term, tf, n, weights, n_docs, n_words)
            owner = np.repeat(np.arange(len(sizes)), sizes)[impact > 0]
            term, impact = term[impact > 0].astype("<i4"), impact[impact > 0].astype("<i8")
            length = np.sqrt(np.bincount(owner, impact.astype(np.float64)**2, len(sizes)))
            ends = np.searchsorted(owner, np.arange(len(sizes) + 1))
            rows = np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(rows)), pa.array(length[rows]),
                pa.array([term[ends[i]:ends[i + 1]].tobytes() for i in rows], pa.binary()),
                pa.array([impact[ends[i]:ends[i + 1]].tobytes() for i in rows], pa.binary())],
                names=["doc_id", "length", "terms", "impacts"])

    return counted.where("doc_id IS NOT NULL AND octet_length(terms) > 0").mapInArrow(
        make, "doc_id bigint, length double, terms binary, impacts binary")


class _Bucket:
    """Some vectors of like length, by row and by coordinate."""

    def __init__(self, batch, n_terms):
        self.ids = batch.column("doc_id").to_numpy()
        self.lengths = batch.column("length").to_numpy()
        self.terms, sizes = _ints(batch.column("terms").to_pylist())
        self.values = np.frombuffer(b"".join(batch.column("impacts").to_pylist()), "<i8")
        self.ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        rows = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(self.terms, kind="stable")
        self.posted, self.posted_values = rows[order], self.values[order]
        self.starts = np.searchsorted(self.terms[order], np.arange(n_terms + 1))
        self.greatest = np.zeros(n_terms, np.int64)
        np.maximum.at(self.greatest, self.terms, self.values)

    def search(self, item, theta):
        """(rows, scores) of all documents of the bucket that reach theta, the item being its terms' numbers."""
        item = item[self.greatest[item] > 0]
        item = item[np.argsort(-self.greatest[item], kind="stable")]
        tops = self.greatest[item]
        after = tops.sum() - np.cumsum(tops)  # what the terms behind each can add
        if not len(item) or tops.sum() < theta:
            return None
        focus = item[:1 + int((after > REST * theta).sum())]
        rest = after[len(focus) - 1]
        sums, squares = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids))
        for t in focus:
            rows, values = (x[self.starts[t]:self.starts[t + 1]] for x in (self.posted, self.posted_values))
            sums[rows] += values
            squares[rows] += values.astype(np.float64)**2
        left = np.sqrt((len(item) - len(focus)) * np.maximum(self.lengths**2 * _SLACK - squares, 0))
        rows = np.flatnonzero(sums + np.minimum(rest, left * _SLACK + 1) >= theta)
        return rows, self.scores(rows, item)

    def scores(self, rows, item):
        """Exact scores of some rows."""
        asked = np.zeros(len(self.greatest), bool)
        asked[item] = True
        sizes = self.ends[rows + 1] - self.ends[rows]
        at = np.repeat(self.ends[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.where(asked[self.terms[at]], self.values[at], 0))])
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]


def _search(items, theta, n_terms, k, size, batches):
    """The k best documents of each item (an array of term numbers) among the vectors of a task, longest first."""
    theta = np.array(theta, np.int64)
    length = np.sqrt([len(i) for i in items])
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            bucket = _Bucket(batch.slice(start, size), n_terms)
            longest = bucket.lengths.max() * _SLACK
            for i in np.flatnonzero(length * longest >= theta):
                hit = bucket.search(items[i], theta[i])
                if hit is None:
                    continue
                ids = np.concatenate([found[i][0], bucket.ids[hit[0]]])
                score = np.concatenate([found[i][1], hit[1]])
                order = np.lexsort((ids, -score))[:k]
                order = order[score[order] >= theta[i]]
                found[i] = ids[order], score[order]
                if len(order) == k:
                    theta[i] = score[order[-1]]
    sizes = [len(ids) for ids, _ in found]
    yield pa.RecordBatch.from_arrays([
        pa.array(np.repeat(np.arange(len(items), dtype=np.int32), sizes)),
        *[pa.array(np.concatenate([f[j] for f in found] or [np.zeros(0, np.int64)])) for j in (0, 1)]],
        names=["item", "doc_id", "score"])


def _best(found, k):
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def term_weights(df, n_docs):
    """w of terms by the number of documents that hold them."""
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def _block(docs, items, vocabulary, k, id_col, text_col):
    """item (its place in `items`), doc_id, score, rank."""
    counted = stored(counted_terms(docs, vocabulary, id_col, text_col), "counted-terms")
    n_docs, n_words = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = term_weights(document_counts(counted, len(vocabulary)), n_docs)
    vectors = impact_vectors(counted, weights, n_docs, n_words)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(1_000_000 * SAMPLE_ROWS // max(1, n_docs))
    size = BUCKET_ROWS
    search = lambda theta: lambda batches: _search(items, theta, len(vocabulary), k, size, batches)
    first = _best(vectors.where(share).mapInArrow(search([1] * len(items)), _FOUND), k)
    theta = [1] * len(items)
    for r in first.where(F.col("rank") == k).select("item", "score").collect():
        theta[r["item"]] = max(1, r["score"])
    spread = max(1, math.ceil(n_docs / PARTITION_ROWS), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # The row's number splits equal lengths, also those of rows that repeat an id.
    ordered = vectors.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(
        spread, F.desc("length"), "_row").sortWithinPartitions(F.desc("length"))
    return _best(ordered.drop("_row").mapInArrow(search(theta), _FOUND), k)


def rank_documents(docs, items, k=TOP, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text"):
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0."""
    spark = docs.sparkSession
    asked = stored(item_terms(items, item_col, item_text_col), "item-terms")
    size = asked.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    path = work_path(spark, "block-results")
    kind = asked.schema["item_id"]
    schema = T.StructType([kind, *(T.StructField(n, t) for n, t in (
        ("rank", T.IntegerType()), ("doc_id", T.LongType()), ("score", T.LongType())))])
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        names = sorted({bytes(r["term"]) for r in rows})
        number = {t: i for i, t in enumerate(names)}
        held = {}
        for r in rows:
            held.setdefault(r["item_id"], []).append(number[bytes(r["term"])])
        items_of = list(held)
        ranked = _block(docs, [np.array(sorted(held[i]), np.int64) for i in items_of], names, k, id_col, text_col)
        known = spark.createDataFrame([(i, x) for i, x in enumerate(items_of)], T.StructType([T.StructField("item", T.IntegerType()), kind]))
        ranked.join(F.broadcast(known), "item").select("item_id", "rank", "doc_id", "score").write.parquet(f"{path}/block={b}")
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/block=*").select("item_id", "rank", "doc_id", "score")
