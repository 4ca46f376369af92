"""Helpers that the operators share: work on Arrow batches in bounded pieces, joins that stand hot keys, bounded broadcasts."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow.session import settle

#: A key with more than one row in this many is joined by broadcast; there are at most so many of these keys.
HOT_SHARE = 1000
#: A hash range that holds so many times the rows that are wanted on average holds them.
SPARE = 4
#: Bytes of text that a Python worker holds at once, apart from a single longer text.
PIECE_BYTES = 2 << 20
#: Bytes of an Arrow batch, apart from a single longer row.
BATCH_BYTES = 8 << 20


def column(name):
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df):
    """All columns of a row in one struct, so that no name in it can clash with a name of ours."""
    return F.struct(*[column(c) for c in df.columns]).alias("row")


def bound_batches(spark):
    """Let the session hand at most BATCH_BYTES at once to a Python worker: a batch is held on both sides of the pipe."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name)
    if not now.rstrip("bB").isdigit() or int(now.rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def id_and_text(df, id_col="doc_id", text_col="text"):
    """The id as it is, and the text as UTF-8 bytes (null: empty)."""
    bound_batches(df.sparkSession)
    return df.select(
        column(id_col).alias("doc_id"), F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"))


def row_and_text(df, text_col="text"):
    """The whole row, and its text as UTF-8 bytes (null: empty)."""
    bound_batches(df.sparkSession)
    return df.select(whole_row(df), F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"))


_STORE = {}


def pieces(batches, text="text", limit=PIECE_BYTES, key=None):
    """Batches cut so that each holds about `limit` bytes of text; a longer text is a piece of its own."""
    if key not in _STORE and _STORE:
        _STORE.clear()
        pa.default_memory_pool().release_unused()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def worker_store(key, make):
    """What a worker process keeps from one task of a query to the next; another query's goes first."""
    if key not in _STORE:
        _STORE[key] = make()
    return _STORE[key]


def by_piece(fn, text="text", limit=PIECE_BYTES, key=None):
    """For mapInArrow: `fn` turns one piece into a dict of arrays; `key` names what it takes from the worker's store."""
    def run(batches):
        for piece in pieces(batches, text, limit, key):
            out = fn(piece)
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
    return run


def lookup(big, small, key, rows, share=HOT_SHARE):
    """Left join of `big` with `small`, which holds each key once and, in `rows`, the number of rows of big with it.

    Keys with over a thousandth of all rows number under a thousand: those are
    broadcast, so that no task gets all rows of such a key. The others are few
    rows each and are joined by a shuffle. `small` should be a stored table.
    """
    total = small.agg(F.sum(rows)).first()[0] or 0
    hot = F.col(rows) * share > total
    others = [c for c in small.columns if c not in (key, rows)]
    answer = F.struct(*others)
    few = F.broadcast(small.where(hot).select(key, answer.alias("_hot")))
    rest = small.where(~hot).select(key, answer.alias("_rest"))
    first = big.join(few, key, "left")
    found = first.where("_hot IS NOT NULL").select(*big.columns, "_hot.*")
    other = first.where("_hot IS NULL").select(*big.columns).join(rest, key, "left").select(*big.columns, "_rest.*")
    return found.unionByName(other)


def stored(df, name):
    """A table in the shared folder; cuts the lineage and survives the loss of executors."""
    return settle(df, name)


def first_of_labels(ids, label, limit):
    """Of each label the `limit` rows of (id, label) whose id has the smallest hash. Rows are distinct.

    Counts come first: of a label with more than a few times `limit` rows only the part of the hash range that
    surely holds those is ranked, so no task gets all rows of a frequent label. A row for each label goes to the driver.
    """
    counts = {r[0]: r[1] for r in ids.groupBy(label).agg(F.count("*").alias("n")).collect()}
    place = F.xxhash64("id") / F.lit(2.0**64) + F.lit(0.5)
    parts = [(F.col(label) == F.lit(v)) & (place >= F.lit(SPARE * limit / n)) for v, n in counts.items() if n > SPARE * limit]
    for far in parts:
        ids = ids.where(~far)
    rank = F.row_number().over(Window.partitionBy(label).orderBy(F.xxhash64("id"), "id"))
    return ids.withColumn("_n", rank).where(F.col("_n") <= limit).drop("_n")


def search_buckets(members, bucket, item, limit, search, schema):
    """Run `search` on the rows of every bucket with at least two rows, never on more than about 2 x limit rows at once.

    A larger bucket is cut into chunks by the hash of `item`, and every two of its chunks are searched together.
    `search` takes an Arrow table and returns one of `schema`; it must give links, not all pairs.
    """
    sizes = members.groupBy(bucket).agg(F.count("*").alias("_n")).where("_n > 1")
    chunks = F.ceil(F.col("_n") / limit).cast("int")
    own = members.join(sizes, bucket).withColumn("_own", F.pmod(F.xxhash64(item), chunks).cast("int"))
    dealt = own.withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    dealt = dealt.withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")})
    return dealt.groupBy(bucket, "_i", "_j").applyInArrow(lambda table: search(table), schema)
