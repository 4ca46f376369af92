"""Additive rollups: only sums are stored, ratios are derived on read, so increments can be merged."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow import schema as S
from rateflow.functions.scalars import percent, ratio_null, total, two_decimals

SUMMARY_KEYS = ["year", "month", "carrier", "airport"]
SUMMARY_SUMS = {
    "total_flights": "arr_flights",
    "total_delayed": "arr_del15",
    "total_cancelled": "arr_cancelled",
    "total_diverted": "arr_diverted",
    "total_delay_minutes": "arr_delay",
    **{f"total_{c}": c for c in S.CAUSE_MINUTES},
}
MINUTE_PARTS = ["record_count", "total_flights", "total_delayed", "ratio_sum", "ratio_count"]


def summary(df):
    """Sums per year, month, carrier and airport."""
    return df.groupBy(*SUMMARY_KEYS).agg(*[total(c).alias(n) for n, c in SUMMARY_SUMS.items()])


def merge(increments, keys, sums):
    """Add up increments of a rollup; merging all increments equals a full recompute."""
    return increments.groupBy(*keys).agg(*[total(c).alias(c) for c in sums])


def merge_summary(increments):
    return merge(increments, SUMMARY_KEYS, list(SUMMARY_SUMS))


def performance(df, code):
    """Additive part of the per-code performance rollup, keyed by year, month, code and label."""
    return df.groupBy("year", "month", code, S.LABELS[code]).agg(
        total("arr_flights").alias("total_flights"),
        total("arr_del15").alias("delayed_flights"),
        total("arr_delay").alias("delay_minutes"),
    )


def finish_performance(parts):
    """Delay percentage and mean minutes from the sums; NULL without volume."""
    return parts.withColumns({
        "delay_percentage": percent(F.col("delayed_flights"), F.col("total_flights")),
        "avg_delay_minutes": two_decimals(ratio_null(F.col("delay_minutes"), F.col("total_flights"))),
    }).drop("delay_minutes")


def minute_partials(df, arrival="ingestion_timestamp"):
    """Partial states per arrival minute: counts, sums, and sum and count of minutes per unit of volume."""
    ratio = ratio_null(F.col("arr_delay"), F.col("arr_flights"))
    return df.groupBy(F.date_trunc("minute", F.col(arrival)).alias("ingestion_minute")).agg(
        F.count(F.lit(1)).alias("record_count"),
        total("arr_flights").alias("total_flights"),
        total("arr_del15").alias("total_delayed"),
        total(ratio).alias("ratio_sum"),
        F.count(ratio).alias("ratio_count"),
    )


def minute_stats(partials):
    """Merge partial states into finished statistics, in minute order."""
    merged = merge(partials, ["ingestion_minute"], MINUTE_PARTS)
    return merged.select(
        "ingestion_minute", "record_count", "total_flights", "total_delayed",
        ratio_null(F.col("ratio_sum"), F.col("ratio_count")).alias("avg_delay_per_flight"),
    ).orderBy("ingestion_minute")


def last_minutes(partials, asof, minutes=60):
    """Partials of the trailing minutes before asof (a timestamp Column, for instance a scalar subquery)."""
    return partials.filter(F.col("ingestion_minute") >= asof - F.make_interval(mins=F.lit(minutes)))


def _smallest_first(df, column):
    """A value that grows as the column falls, NULL first, for max_by."""
    kind = df.schema[column].dataType.typeName()
    c = F.col(column)
    if kind in ("timestamp", "timestamp_ntz"):
        c = F.unix_micros(c.cast("timestamp"))
    elif kind == "date":
        c = F.unix_date(c)
    elif kind not in ("byte", "short", "integer", "long", "boolean", "float", "double"):
        raise ValueError(f"{column}: a tie is broken by numbers, dates or times")
    return F.struct(F.col(column).isNull(), -c if kind in ("float", "double") else F.bitwise_not(c.cast("bigint")))


def latest_state(df, keys, version, tie_break=()):
    """The newest version of every key as an aggregate: one row of state a key, additive, and fit for a stream.

    It gives what latest_per_key gives; merging the results of increments equals a full recompute.
    """
    others = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(version), *[_smallest_first(df, c) for c in tie_break])
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_newest"))
    return newest.select(*keys, "_newest.*").select(*df.columns)


def latest_per_key(df, keys, version, tie_break=()):
    """The newest version of every key.

    Ranking with rank 1 only lets Spark drop all but one row per key and task
    before the shuffle, so a key holding most rows stays cheap.
    """
    newest = Window.partitionBy(*keys).orderBy(F.desc(version), *[F.asc(c) for c in tie_break])
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")
