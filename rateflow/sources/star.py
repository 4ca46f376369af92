"""Adapter: the star-schema tables seen as observations.

Nothing here is part of the library's semantics; it gives the operators realistic
input with integer measures (so sums are exact) and deterministic defects.
"""

from functools import reduce

from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.operators.clean import normalize

GENERATED_YEAR = 2001


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quantity_where(condition):
    return F.coalesce(F.sum(F.when(condition, F.col("l_quantity"))), F.lit(0.0)).cast("bigint")


def observations(spark, sf_dir):
    """Order lines per (year, month of shipping, market segment, nation) as observations."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag",
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_mktsegment").alias("carrier"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("airport"))
    buyers = orders.join(
        customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")),
        F.col("o_custkey") == F.col("c_custkey"))
    joined = lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))

    line = F.col("l_linenumber")
    returned, accepted = F.col("l_returnflag") == "R", F.col("l_returnflag") == "A"
    bucket = {
        "carrier": line == 1, "weather": line == 2, "nas": line == 3, "security": line == 4, "late_aircraft": line >= 5}
    minutes = {
        f"{c}_delay": F.coalesce(F.sum(F.when(returned & b, F.col("l_quantity") * line)), F.lit(0.0)).cast("bigint")
        for c, b in bucket.items()}
    cells = joined.groupBy(*S.KEYS).agg(
        F.sum("l_quantity").cast("bigint").alias("arr_flights"),
        _quantity_where(returned).alias("arr_del15"),
        _quantity_where(accepted & (line == 1)).alias("arr_cancelled"),
        _quantity_where(accepted & (line == 2)).alias("arr_diverted"),
        *[_quantity_where(returned & b).alias(f"{c}_ct") for c, b in bucket.items()],
        *[m.alias(n) for n, m in minutes.items()],
    )
    period = F.col("year") * 12 + F.col("month")
    return cells.withColumns({
        "arr_delay": reduce(lambda a, b: a + b, [F.col(c) for c in S.CAUSE_MINUTES]),
        "carrier_name": F.concat("carrier", F.when(
            F.pmod(period + F.length("airport"), F.lit(5)) == 0, " Lines Inc.").otherwise(" Lines")),
        "airport_name": F.concat("airport", F.when(
            F.pmod(period, F.lit(7)) == 0, ", International").otherwise(", Intl")),
    }).select(*S.REQUIRED)


def dirty_text(spark, sf_dir):
    """Observations as text cells, with deterministic defects chosen by key arithmetic."""
    clean = observations(spark, sf_dir)
    k = F.pmod(F.col("year") * 31 + F.col("month") * 17 + F.col("arr_flights") * 7, F.lit(101))
    generated = F.col("year") == GENERATED_YEAR
    text = {c: F.col(c).cast("string") for c in S.REQUIRED}
    none = F.lit(None).cast("string")

    def where(codes, column, value):
        text[column] = F.when(k.isin(codes), value).otherwise(text[column])

    where([1], "carrier_name", none)
    where([2], "arr_flights", (-F.col("arr_flights")).cast("string"))
    where([3], "arr_del15", (F.col("arr_flights") + 3).cast("string"))
    where([4], "nas_ct", F.concat((F.col("arr_del15") + 1).cast("string"), F.lit(".5")))
    where([5], "arr_delay", (F.col("arr_delay") + 5).cast("string"))
    where([6], "month", F.lit("13"))
    where([7], "arr_delay", F.lit("100500"))
    where([8], "weather_delay", F.lit("-2"))
    where([9], "arr_cancelled", none)
    where([10], "carrier", F.lit("  "))
    where([11], "airport", F.concat(F.lit(" "), F.col("airport"), F.lit("\t")))
    where([12], "arr_diverted", F.lit("NaN"))
    where([13], "airport", none)
    where([14], "arr_flights", F.lit("6e6"))
    where([15], "arr_flights", F.lit("0"))
    where([16], "arr_del15", F.lit("n/a"))
    where([17], "security_ct", F.lit("abc"))
    where([18], "late_aircraft_ct", F.concat((F.col("arr_del15") + 2).cast("string"), F.lit(".0")))
    where([19], "year", F.lit(""))
    text["airport"] = F.when(generated & k.isin(20, 21), F.concat(F.lit("NEW_"), F.col("month").cast("string"))).otherwise(
        text["airport"])
    text["carrier"] = F.when(generated & (k == 22), F.lit("UNHEARD")).otherwise(text["carrier"])
    return clean.select(
        *[text[c].alias(c) for c in S.REQUIRED], generated.alias("is_generated"))


def dirty(spark, sf_dir):
    """The defective observations after normalization."""
    return normalize(dirty_text(spark, sf_dir))


def split(df):
    """Historical part and generated part of clean observations."""
    return df.filter(F.col("year") < GENERATED_YEAR), df.filter(F.col("year") == GENERATED_YEAR)


def split_dirty(df):
    return df.filter(~F.col("is_generated")).drop("is_generated"), df.filter("is_generated").drop("is_generated")


def event_observations(events):
    """Events, batch or stream, as one observation each; row-wise, with the event time as arrival."""
    flights = F.floor(F.col("value")).cast("bigint") + 1
    hit = F.floor(flights / 4).cast("bigint")
    zero = F.lit(0).cast("bigint")
    parity = F.pmod(F.col("event_id"), F.lit(2)).cast("bigint")
    columns = {
        "event_id": F.col("event_id"),
        "arrival": F.col("ts").cast("timestamp"),
        "id": F.concat(F.lit("ev-"), F.col("event_id").cast("string")),
        "year": F.year("ts"),
        "month": F.month("ts"),
        "carrier": F.col("event_type"),
        "carrier_name": F.concat(F.col("event_type"), F.lit(", Line")),
        "airport": F.concat(F.lit("U"), F.col("user_id").cast("string")),
        "airport_name": F.concat(F.lit("User: "), F.col("user_id").cast("string")),
        "arr_flights": flights,
        "arr_del15": hit,
        "carrier_ct": hit * F.lit(0.5), "weather_ct": hit * F.lit(0.125), "nas_ct": hit * F.lit(0.25),
        "security_ct": zero * F.lit(0.5), "late_aircraft_ct": hit * F.lit(0.125),
        "arr_cancelled": F.pmod(F.col("event_id"), F.lit(3)).cast("bigint"),
        "arr_diverted": parity,
        "arr_delay": hit * 25 + parity,
        "carrier_delay": hit * 10, "weather_delay": hit * 2, "nas_delay": hit * 5,
        "security_delay": parity, "late_aircraft_delay": hit * 8,
    }
    return events.select(*[c.alias(n) for n, c in columns.items()])


# Shape of an event's message by event_id modulo this list's length.
SHAPES = [
    "tokens", "array_of_one", "broken", "text_values", "scalar",
    "array_of_two", "mixed_array", "no_id", "infinite", "object", "trailing", "repeated_key",
]


def event_messages(events):
    """One message per event in one of the SHAPES; the expected outcome follows from the source columns."""
    obs = event_observations(events)
    fields = [c for c in obs.columns if c not in ("event_id", "arrival")]
    whole = F.to_json(F.struct(*fields))
    as_text = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in fields]))
    without_id = F.to_json(F.struct(*[
        (F.lit(-1) if c == "arr_cancelled" else F.lit(300) if c == "month" else F.col(c)).alias(c)
        for c in fields if c != "id"]))
    infinite = F.to_json(F.struct(*[(F.lit("inf") if c == "arr_delay" else F.col(c)).alias(c) for c in fields]))
    tokens = F.to_json(F.array(*[
        F.create_map(F.lit("{"), F.concat(F.lit(f'"{c}" : '), F.to_json(F.array(c)).substr(
            F.lit(2), F.length(F.to_json(F.array(c))) - 2)))
        for c in fields]))
    by_shape = {
        "tokens": tokens,
        "array_of_one": F.concat(F.lit("["), whole, F.lit("]")),
        "broken": F.concat(F.lit('{"id":"'), F.col("id"), F.lit('","year":')),
        "text_values": as_text,
        "scalar": F.col("event_id").cast("string"),
        "array_of_two": F.concat(F.lit("["), whole, F.lit(","), whole, F.lit("]")),
        "mixed_array": F.concat(F.lit("["), whole, F.lit(",5]")),
        "no_id": without_id,
        "infinite": infinite,
        "object": whole,
        "trailing": F.concat(whole, F.lit(" tail")),
        "repeated_key": F.concat(F.lit('{"carrier":"earlier",'), whole.substr(F.lit(2), F.length(whole))),
    }
    slot = F.pmod(F.col("event_id"), F.lit(len(SHAPES)))
    payload = F.lit(None).cast("string")
    for i, name in enumerate(SHAPES):
        payload = F.when(slot == i, by_shape[name]).otherwise(payload)
    return obs.select("event_id", "arrival", payload.alias("payload"))


def read_events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def stream_events(spark, sf_dir, files_per_trigger=100):
    """The events table as a file stream, whether it is one file or a folder of files."""
    return (
        spark.readStream.schema(read_events(spark, sf_dir).schema)
        .option("maxFilesPerTrigger", files_per_trigger).parquet(f"{sf_dir}/events.[p]arquet")
    )
