"""Point-in-time queries over recently arrived records."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUFFER_ROWS = 5000
LATEST_ROWS = 25


def latest(df, arrival, tie, rows=LATEST_ROWS):
    """The newest records. A fixed-size top-k: every task keeps at most `rows`."""
    return df.orderBy(F.desc(arrival), F.desc(tie)).limit(rows)


def buffer(df, arrival, tie, rows=BUFFER_ROWS):
    """The bounded live history."""
    return latest(df, arrival, tie, rows)


def status(history, arrival):
    """Size of the history and its last arrival."""
    return history.agg(F.count(F.lit(1)).alias("buffered"), F.max(arrival).alias("last_arrival"))


def message_rate(df, arrival, asof, windows=(1, 5)):
    """Messages per minute over trailing windows ending at asof (a timestamp Column).

    The widest window is filtered first, so the time bound reaches the scan.
    """
    def since(minutes):
        return asof - F.make_interval(mins=F.lit(minutes))

    recent = df.filter(F.col(arrival) >= since(max(windows)))
    return recent.agg(*[
        (F.count_if(F.col(arrival) >= since(w)) / F.lit(float(w))).alias(f"per_minute_{w}") for w in windows])


def second_counts(df, arrival):
    """Messages per arrival second. Additive: increments are merged by adding up seconds."""
    second = F.unix_seconds(F.date_trunc("second", F.col(arrival)))
    return df.groupBy(second.alias("second")).agg(F.count(F.lit(1)).alias("messages"))


def merge_seconds(increments):
    return increments.groupBy("second").agg(F.sum("messages").alias("messages"))


def ring(counts, slots=300):
    """The newest `slots` seconds in a ring: slot, second, messages. At most so many rows, however busy the stream.

    A ring is merged slot by slot: the newer second wins, equal seconds add up.
    """
    slot = F.pmod("second", F.lit(slots)).alias("slot")
    held = merge_seconds(counts).groupBy(slot).agg(F.max_by(F.struct("second", "messages"), F.col("second")).alias("s"))
    newest = held.select("slot", "s.*", F.max("s.second").over(Window.partitionBy()).alias("_newest"))  # at most `slots` rows
    return newest.where(F.col("second") > F.col("_newest") - slots).drop("_newest")


def rate_asof(counts, instants, asof="asof", windows=(1, 5)):
    """Messages per minute in the trailing windows before each instant, from counts per second.

    An instant is a whole second; its window of w minutes holds the 60 * w seconds before it. Instants and seconds meet by
    buckets of the widest window, so an instant reads two buckets, and no bucket has more rows than seconds.
    """
    width = 60 * max(windows)
    at = F.unix_seconds(F.col(asof))
    asked = instants.select(asof).distinct().select(asof, at.alias("_at"))
    asked = asked.withColumn("_bucket", F.explode(F.sequence(F.floor((F.col("_at") - width) / width), F.floor((F.col("_at") - 1) / width))))
    held = merge_seconds(counts).withColumn("_bucket", F.floor(F.col("second") / width))
    ago = F.col("_at") - F.col("second")
    return asked.join(held, "_bucket", "left").groupBy(asof).agg(*[
        (F.coalesce(F.sum(F.when(ago.between(1, 60 * w), F.col("messages"))), F.lit(0)) / F.lit(float(w))).alias(f"per_minute_{w}")
        for w in windows])
