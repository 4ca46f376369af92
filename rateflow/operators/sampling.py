"""Template sampling: one row per airport plus a reproducible random fill."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow import schema as S
from rateflow.functions.draws import row_digest
from rateflow.functions.scalars import number_or_missing
from rateflow.operators.clean import fill_missing_columns

BUCKET_DIGITS = 4
CHUNK = 65_536


def avg_rows_per_year(df):
    """Mean rows per year as a sample size: half to even, at least 1, NULL when no year is known."""
    per_year = F.count(F.lit(1)) / F.nullif(F.count_distinct("year"), F.lit(0))
    rounded = F.rint(per_year).cast("bigint")
    return df.agg(F.when(rounded.isNotNull(), F.greatest(F.lit(1), rounded)).alias("rows"))


def number_rows(df, digest, limit=None, offset=0):
    """Number rows 1, 2, ... in digest order and keep the first `limit`, without a global sort.

    Rows fall into 65,536 buckets by the head of their digest. Counts per bucket
    give every bucket its first number, and rule out all buckets beyond the
    limit before anything is shuffled. Equal rows are counted, not carried, so a
    row repeated very often does not fill one task; they are unfolded at the end
    in chunks.
    """
    columns = df.columns
    marked = df.withColumns({"_digest": digest, "_bucket": F.substring(digest, 1, BUCKET_DIGITS)})
    in_order = Window.partitionBy().orderBy("_bucket")
    # At most 16**BUCKET_DIGITS rows, whatever the input: safe to window and to broadcast.
    starts = marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_bucket", (F.sum("_rows").over(in_order) - F.col("_rows")).alias("_before"))
    if limit is not None:
        starts = starts.filter(F.col("_before") < limit)
    copies = (
        marked.join(F.broadcast(starts), "_bucket")
        .groupBy("_bucket", "_before", "_digest", *columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    running = Window.partitionBy("_bucket").orderBy("_digest").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = copies.withColumn("_start", F.col("_before") + F.sum("_copies").over(running) - F.col("_copies"))
    end = F.col("_start") + F.col("_copies") - 1
    if limit is not None:
        placed = placed.filter(F.col("_start") < limit)
        end = F.least(end, F.lit(limit - 1))
    chunks = (
        placed.withColumn("_end", end)
        .withColumn("_from", F.explode(F.sequence(F.col("_start"), F.col("_end"), F.lit(CHUNK).cast("bigint"))))
        .hint("rebalance")
    )
    last = F.least(F.col("_end"), F.col("_from") + CHUNK - 1)
    numbered = chunks.select(*columns, F.explode(F.sequence(F.col("_from"), last)).alias("template_id"))
    return numbered.withColumn("template_id", F.col("template_id") + offset + 1)


def stratified_templates(df, count, seed=42):
    """Sample `count` template rows: one per airport when the count allows it, the rest from all rows.

    The fill may repeat a row that already stands for its airport. Measures are
    coerced, bad values to 0; rows without carrier or airport are left out.
    """
    return _stratified(df, count, seed, _sizes(df))


def size_counts(df):
    """Rows per year, airport and whether they are usable. Additive."""
    usable = F.col("airport").isNotNull() & F.col("carrier").isNotNull()
    return fill_missing_columns(df).groupBy("year", "airport", usable.alias("usable")).agg(F.count(F.lit(1)).alias("n"))


def _sizes(df):
    """Rows per average year, usable rows and their airports, from one scan."""
    return _measured(size_counts(df))


def _measured(counted):
    rounded = F.rint(F.sum("n") / F.nullif(F.count_distinct("year"), F.lit(0))).cast("bigint")
    return counted.agg(
        F.when(rounded.isNotNull(), F.greatest(F.lit(1), rounded)).alias("per_year"),
        F.coalesce(F.sum(F.when(F.col("usable"), F.col("n"))), F.lit(0)).alias("rows"),
        F.count_distinct(F.when(F.col("usable"), F.col("airport"))).alias("airports")).first()


def _usable(df):
    return fill_missing_columns(df).dropna(subset=["carrier", "airport"])


def _stratified(df, count, seed, size):
    usable = _usable(df)
    return _assembled(usable, usable, count, seed, size)


def _first_of_airports(rows, seed):
    by_stratum = row_digest(rows.columns, f"{seed}-stratum")
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("airport").orderBy(by_stratum)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def _assembled(strata, usable, count, seed, size):
    """The sample from rows that hold the first of every airport, and rows that hold the first of all."""
    columns = usable.columns
    if size["rows"] == 0:
        raise ValueError("No valid rows after filtering (missing carrier/airport)")
    target = min(count, size["rows"])
    by_fill = row_digest(columns, f"{seed}-fill")
    if target >= size["airports"]:
        sample = number_rows(_first_of_airports(strata, seed), row_digest(columns, f"{seed}-stratum"))
        remaining = target - size["airports"]
        if remaining > 0:
            sample = sample.unionByName(number_rows(usable, by_fill, remaining, size["airports"]))
    else:
        sample = number_rows(usable, by_fill, target)
    return sample.withColumns({c: F.coalesce(number_or_missing(F.col(c)), F.lit(0.0)) for c in S.MEASURES})


def average_year_templates(df, default_count=2000, seed=42):
    """Templates as many as an average year has rows; the default count when no year is known."""
    size = _sizes(df)
    return _stratified(df, default_count if size["per_year"] is None else size["per_year"], seed, size)


# The sample as a state: the first rows by digest of an airport and of all, and counts. Merging takes the first again.

def strata_state(df, seed=42):
    """The row of every airport that stands for it, of an increment or of merged states."""
    return _first_of_airports(_usable(df), seed)


def fill_state(df, size, seed=42):
    """The first `size` usable rows in the order of the fill, equal rows as often as they are."""
    rows = _usable(df)
    return number_rows(rows, row_digest(rows.columns, f"{seed}-fill"), size).drop("template_id")


def templates_from_states(sizes, strata, fill, size, default_count=2000, seed=42):
    """average_year_templates of all rows, from the states of their increments, which were kept with this size."""
    measured = _measured(sizes)
    count = default_count if measured["per_year"] is None else measured["per_year"]
    if min(count, measured["rows"]) > size:
        raise ValueError(f"the states hold {size} rows, the sample needs {min(count, measured['rows'])}")
    return _assembled(strata, fill, count, seed, measured)
