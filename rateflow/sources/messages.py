"""Message streams: reading (value, arrival) and rendering observations as keyed JSON messages."""

from pyspark.sql import functions as F


MAX_OFFSETS = 1_000_000


def read_messages(spark, topic, servers, starting="earliest", strict=True, max_offsets=MAX_OFFSETS, **options):
    """A broker topic as a stream of (payload, arrival, partition, offset).

    max_offsets bounds a micro-batch, and with it the first one of a topic that
    is read from its start.

    strict leaves a payload that is not UTF-8 as NULL, so it is quarantined;
    otherwise undecodable bytes are replaced. Offsets are kept in the query's
    checkpoint and advance only after a batch was written.
    """
    source = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", starting).option("maxOffsetsPerTrigger", max_offsets).options(**options).load()
    )
    return source.select(
        decoded_text(F.col("value"), strict).alias("payload"),
        F.col("timestamp").alias("arrival"), "partition", "offset")


def decoded_text(value, strict=True):
    """Bytes to text: NULL for invalid UTF-8 when strict, otherwise with replacement characters."""
    text = value.cast("string")
    return F.try_validate_utf8(text) if strict else F.make_valid_utf8(text)


def encode_messages(df, key="kafka_key"):
    """Rows as (key, value) messages, value being the JSON of all columns."""
    return df.select(
        F.col(key).alias("key"),
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def message_key(arrival):
    """airport_carrier_millis."""
    return F.concat_ws("_", "airport", "carrier", F.unix_millis(arrival).cast("string"))


def write_messages(encoded, sink, **options):
    """Append (key, value) rows to a sink: "kafka" with topic and kafka.bootstrap.servers, or a file format with path.

    The broker's connector is not part of Spark's own distribution; only file
    formats are tested here.
    """
    encoded.select("key", "value").write.format(sink).mode("append").options(**options).save()
