"""Exact top-k search by inner product: MaxScore over the coordinates of integer vectors.

A component x becomes floor(SCALE * x). A coordinate d of a query q is a term: its score bound in a shard of candidates is
q_d times the largest component of the shard with q_d's sign, or 0 where no candidate has that sign, so the other sign only
lowers a score. Let theta be a query's k-th best score so far. Terms are sorted by bound; the longest run of the smallest
whose bounds add up to less than theta is non-essential: a candidate without a positive share in any other term stays
below theta. The postings of the essential terms (a column of the shard each, as vectors are dense) are traversed first,
for many queries at once as a matrix product. What then can still reach theta, with the bounds of the non-essential terms
added, is probed in these, strongest first, and dropped as soon as it can't compete. Whoever is left has its exact score.

Shards are the Arrow batches of the tasks that read the candidates; each task keeps its k best of every query, raises
theta from shard to shard and hands its best to the merge, a rank per query. Theta starts from the k-th best of a bounded
sample of candidates (`SEED_ROWS`), which only saves work: every row is searched. Queries go in blocks of `BLOCK_BYTES`,
one Spark job each, whose results are stored; so nothing that is broadcast grows with the table.

Products are computed in doubles where they are exact (all sums below 2**53), else in Python's integers; a score
outside 64 bits is held at their ends. Vectors that are null, empty or hold a null or non-finite component take no part, nor do rows
without an id. The shorter of two vectors of different lengths is filled with zeros. Rows that repeat an id with the
same vector are one query, with another vector a query each; as candidates all rows count, and a query meets no row of its
own id. Ties go to the smaller id. An empty table gives no rows. Other columns are not read.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow.llm.common import bound_batches, column, stored
from rateflow.session import work_path

SCALE = 1024
TOP = 10
SEED_ROWS = 4096
SEED_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20
#: Candidates of a shard, and queries that are compared with it at once.
SHARD_ROWS, TILE = 4096, 256
#: Non-essential terms that are probed between two comparisons with theta.
PROBES = 8
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1
_FOUND = "query bigint, query_id bigint, vec_id bigint, score bigint"


def _matrix(packed, width=0):
    """Packed vectors of doubles as rows of one matrix, filled with zeros to the longest, or to `width`."""
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 8
    out = np.zeros((len(packed), max(width, int(sizes.max(initial=0)))))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        out[rows, :size] = np.frombuffer(b"".join(packed[i] for i in rows), "<f8").reshape(len(rows), size)
    return out


def _whole(batches, scale):
    for batch in batches:
        vectors = batch.column("v")
        sizes = np.diff(np.asarray(vectors.offsets))
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        whole = np.floor(scale * values.astype(np.float64)).astype("<f8").tobytes()
        ends = 8 * np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        packed = [whole[a:b] for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(packed, pa.binary())], names=["vec_id", "v"])


def whole_vectors(df, id_col="vec_id", vector_col="embedding", scale=SCALE):
    """vec_id and v, the integer components as packed doubles, of the rows that take part."""
    bound_batches(df.sparkSession)
    rows = df.select(column(id_col).cast("bigint").alias("vec_id"), column(vector_col).cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > F.lit(1.7976931348623157e308 / scale)))
    rows = rows.where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").where(~odd)
    return rows.mapInArrow(lambda batches: _whole(batches, scale), "vec_id bigint, v binary")


class Best:
    """The k best candidates so far of a block of queries."""

    def __init__(self, ids, packed, theta=None, k=TOP):
        self.ids, self.k = np.asarray(ids, np.int64), k
        self.queries = _matrix(packed)
        self.theta = np.full(len(packed), _LOWEST, np.int64) if theta is None else np.asarray(theta, np.int64)
        self.found = tuple(np.zeros(0, np.int64) for _ in range(3))  # query, score, id

    def add(self, ids, packed):
        """Search one shard."""
        rows = _matrix(packed, self.queries.shape[1])
        width = rows.shape[1]
        if self.queries.shape[1] < width:
            self.queries = np.pad(self.queries, ((0, 0), (0, width - self.queries.shape[1])))
        safe = math.sqrt(2.0**52 / max(1, width))
        plain, common = np.abs(rows).max(1) <= safe, np.abs(self.queries).max(1) <= safe
        parts = []
        for start in range(0, int(common.sum()), TILE):
            tile = np.flatnonzero(common)[start:start + TILE]
            q, r, score = self._maxscore(tile, rows[plain])
            parts.append((tile[q], score, ids[plain][r]))
        for q, r in ((np.arange(len(self.ids)), np.flatnonzero(~plain)), (np.flatnonzero(~common), np.flatnonzero(plain))):
            parts += [self._long(x, r, rows, ids) for x in q if len(r)]
        self._merge([p for p in parts if len(p[0])])

    def _long(self, q, r, rows, ids):
        whole = [int(x) for x in self.queries[q]]
        scores = [sum(a * int(b) for a, b in zip(whole, rows[x])) for x in r]
        return np.full(len(r), q), np.array([min(max(s, _LOWEST), _HIGHEST) for s in scores], np.int64), ids[r]

    def _maxscore(self, tile, rows):
        """(query, row, score) of all rows that reach theta."""
        queries = self.queries[tile]
        theta = self.theta[tile].astype(np.float64)
        theta = np.where(np.abs(theta) < 2.0**53, theta, np.nextafter(theta, -np.inf))
        if not len(rows):
            return (np.zeros(0, np.int64),) * 3
        up, down = np.maximum(rows.max(0), 0), np.maximum(-rows.min(0), 0)
        bound = np.where(queries > 0, queries * up, -queries * down)
        order = np.argsort(bound, axis=1, kind="stable")
        sums = np.cumsum(np.take_along_axis(bound, order, 1), axis=1)
        weak = (sums < theta[:, None]).sum(1)  # the first so many terms in order are non-essential
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], 1)
        essential = np.where(rank >= weak[:, None], queries, 0.0)
        scores = essential @ rows.T
        rest = np.concatenate([np.zeros((len(queries), 1)), sums], axis=1)
        q, r = np.nonzero(scores + np.take_along_axis(rest, weak[:, None], 1) >= theta[:, None])
        score = scores[q, r]
        left = weak[q]
        while len(left) and left.max():
            for _ in range(PROBES):
                left = left - 1
                more = left >= 0
                term = order[q, np.maximum(left, 0)]
                score = score + np.where(more, queries[q, term] * rows[r, term], 0.0)
            left = np.maximum(left, 0)
            competes = score + rest[q, left] >= theta[q]
            q, r, score, left = q[competes], r[competes], score[competes], left[competes]
        return q, r, score.astype(np.int64)

    def _merge(self, parts):
        if not parts:
            return
        q, score, ids = (np.concatenate([old, *new]) for old, new in zip(self.found, zip(*parts)))
        other = ids != self.ids[q]
        q, score, ids = q[other], score[other], ids[other]
        order = np.lexsort((ids, ~score, q))
        q, score, ids = q[order], score[order], ids[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        self.found = tuple(x[nth < self.k] for x in (q, score, ids))
        last = nth == self.k - 1
        self.theta[q[last]] = np.maximum(self.theta[q[last]], score[last])


def _slices(batches, size):
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            part = batch.slice(start, size)
            yield part, part.column("vec_id").to_numpy(), part.column("v").to_pylist()


def _search(block, k, shard, batches):
    numbers, ids, packed, theta = block
    best = Best(ids, packed, theta, k)
    for _, rows, vectors in _slices(batches, shard):
        best.add(rows, vectors)
    q, score, found = best.found
    reach = score >= np.asarray(theta, np.int64)[q]
    q, score, found = q[reach], score[reach], found[reach]
    yield pa.RecordBatch.from_arrays(
        [pa.array(x, pa.int64()) for x in (np.asarray(numbers, np.int64)[q], best.ids[q], found, score)],
        names=["query", "query_id", "vec_id", "score"])


def _start(seed, k, batches):
    ids, packed = seed
    for part, rows, vectors in _slices(batches, SHARD_ROWS):
        best = Best(rows, vectors, None, k)
        if len(ids):
            best.add(np.asarray(ids, np.int64), packed)
        yield pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(best.theta, pa.int64())], names=["vec_id", "v", "theta"])


def top_k(df, queries, id_col="vec_id", vector_col="embedding", k=TOP, scale=SCALE):
    """query_id, rank, vec_id, score: the k best rows of df for each of `queries`, a frame with the same two columns."""
    spark, shard = df.sparkSession, SHARD_ROWS
    rows = stored(whole_vectors(df, id_col, vector_col, scale), "whole-vectors")
    asked = whole_vectors(queries, id_col, vector_col, scale).distinct()
    longest = rows.agg(F.max(F.octet_length("v"))).first()[0] or 8
    sample = rows.orderBy(F.xxhash64("vec_id", "v")).limit(max(k + 1, min(SEED_ROWS, SEED_BYTES // longest))).collect()
    seed = [r["vec_id"] for r in sample], [bytes(r["v"]) for r in sample]
    asked = stored(asked.mapInArrow(
        lambda batches: _start(seed, k, batches), "vec_id bigint, v binary, theta bigint"), "asked-vectors")
    size = asked.agg(F.sum(F.octet_length("v") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    dealt = asked.withColumn("_block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))
    path = work_path(spark, "block-results")
    for b in range(blocks):
        block = dealt.where(F.col("_block") == b).orderBy("vec_id", "v").collect()
        numbers = [b << 32 | i for i in range(len(block))]
        packed = numbers, [r["vec_id"] for r in block], [bytes(r["v"]) for r in block], [r["theta"] for r in block]
        rows.mapInArrow(lambda batches, packed=packed: _search(packed, k, shard, batches), _FOUND).write.parquet(f"{path}/block={b}")
    found = spark.read.schema(_FOUND).option("basePath", path).parquet(f"{path}/block=*")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
