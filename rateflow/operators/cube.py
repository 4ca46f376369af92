"""One stored cube of sums behind the dashboard queries: several grains at once, told apart by grouping_id.

Rows are first summed at the finest grain, so that grouping sets expand those few rows and not the input. Every column is
additive or a smallest label, so increments are merged by summing again. A reader takes the grain with the fewest keys
that has all keys it asks for, and reads nothing but that grain's folder.
"""

from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.functions.scalars import total

SUMMED = S.COUNTS + ["arr_delay"] + S.CAUSE_MINUTES
LABELS = list(S.LABELS.values())
#: Grains of the cube, as sets of S.KEYS.
SETS = (
    ("year",), ("year", "month"), ("year", "carrier"), ("year", "airport"),
    ("year", "month", "carrier"), ("year", "month", "airport"), ("year", "month", "carrier", "airport"))


def grouping_of(keys):
    """The grouping_id of a set of keys: a bit for every key that is summed over."""
    return sum(1 << (len(S.KEYS) - 1 - i) for i, k in enumerate(S.KEYS) if k not in keys)


def build(df, sets=SETS):
    """The keys, labels, sums and `grouping` of all grains. A key that a grain lacks is NULL, and so is its label."""
    measures = [*[F.min(c).alias(c) for c in LABELS], *[total(c).alias(c) for c in SUMMED]]
    finest = df.groupBy(*S.KEYS).agg(*measures)
    rows = finest.groupingSets([[F.col(k) for k in s] for s in sets], *S.KEYS).agg(
        F.grouping_id().cast("int").alias("grouping"), *measures)
    absent = {S.LABELS[c]: F.when(F.col("grouping").bitwiseAND(grouping_of(set(S.KEYS) - {c})) == 0, F.col(S.LABELS[c]))
              for c in S.LABELS}
    return rows.withColumns(absent)


def merge(increments):
    """Add up cubes of increments."""
    return increments.groupBy("grouping", *S.KEYS).agg(
        *[F.min(c).alias(c) for c in LABELS], *[total(c).alias(c) for c in SUMMED])


def write(cube, path):
    """A folder for each grain; the finest may hold most rows, so a grain is split by its size."""
    cube.hint("rebalance", "grouping").write.mode("overwrite").partitionBy("grouping").parquet(path)


def covering(keys, sets=SETS):
    """The set with the fewest keys that has all of `keys`."""
    fit = [s for s in sets if set(keys) <= set(s)]
    if not fit:
        raise ValueError(f"no grain of the cube has the keys {sorted(keys)}")
    return min(fit, key=len)


def read(spark, path, keys, sets=SETS):
    """Rows of the smallest grain that has `keys`, with the columns that KPI functions read."""
    return spark.read.parquet(path).where(F.col("grouping") == grouping_of(covering(keys, sets))).drop("grouping")
