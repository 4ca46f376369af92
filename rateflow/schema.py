"""The observation schema: column groups and Spark types."""

from pyspark.sql import types as T

KEYS = ["year", "month", "carrier", "airport"]
LABELS = {"carrier": "carrier_name", "airport": "airport_name"}
TEXT_COLUMNS = ["carrier", "carrier_name", "airport", "airport_name"]

CAUSES = ["carrier", "weather", "nas", "security", "late_aircraft"]
CAUSE_COUNTS = [f"{c}_ct" for c in CAUSES]
CAUSE_MINUTES = [f"{c}_delay" for c in CAUSES]
COUNTS = ["arr_flights", "arr_del15", "arr_cancelled", "arr_diverted"]
MEASURES = COUNTS + ["arr_delay"] + CAUSE_COUNTS + CAUSE_MINUTES
PERIOD = ["year", "month"]

# The columns a dataset must have to be validated.
REQUIRED = PERIOD + TEXT_COLUMNS + MEASURES

UINT8_MAX = 2**8 - 1
UINT16_MAX = 2**16 - 1
UINT32_MAX = 2**32 - 1

# Upper bound of every unsigned field on the wire.
UNSIGNED = {
    "year": UINT16_MAX,
    "month": UINT8_MAX,
    **{c: UINT32_MAX for c in COUNTS + ["arr_delay"] + CAUSE_MINUTES},
}

# Column order of the stored fact, without the arrival time.
WIRE_COLUMNS = (
    ["id"] + PERIOD + TEXT_COLUMNS + ["arr_flights", "arr_del15"] + CAUSE_COUNTS
    + ["arr_cancelled", "arr_diverted", "arr_delay"] + CAUSE_MINUTES
)


def _fact_type(column):
    if column in PERIOD:
        return T.IntegerType()
    if column in UNSIGNED:
        return T.LongType()
    if column in CAUSE_COUNTS:
        return T.FloatType()
    return T.StringType()


FACT_SCHEMA = T.StructType(
    [T.StructField(c, _fact_type(c)) for c in WIRE_COLUMNS]
    + [T.StructField("ingestion_timestamp", T.TimestampType())]
)
