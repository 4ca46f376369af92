"""From messages to typed fact rows, with a quarantine for rejects."""

from functools import reduce

from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.functions.scalars import computed_once, is_infinite, number_from_text, to_nonneg, to_uint
from rateflow.operators.decode import decode_strict


def field_text(record, name):
    """A field as text; a missing or null field is NULL."""
    path = f"$.{name}" if name.isidentifier() else f"$['{name}']"
    return F.try_variant_get(record, path, "string")


def field_texts(record, names):
    """All named fields as text in one struct, read from the record in one pass."""
    return F.try_variant_get(record, "$", "struct<" + ",".join(f"`{n}`:string" for n in names) + ">")


def field_number(text, record, name):
    """A field, given as text, as a double: numbers and numeric text by Python's rules, JSON true as 1, else NULL.

    Only for the texts true and false the record is asked again: the text "true"
    has no double in the VARIANT, the boolean true has.
    """
    boolean = F.when(text.isin("true", "false"), F.try_variant_get(record, f"$.{name}", "double"))
    return F.coalesce(number_from_text(text), boolean)


def fallback_id(year, month, carrier, airport):
    """A reproducible id for records without one; the parts are separated so they cannot run together."""
    parts = [F.coalesce(c, F.lit("")) for c in (year, month, carrier, airport)]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def typed_columns(number, text):
    """The wire columns. number and text map a field name to its parsed Column."""
    columns = {"id": F.coalesce(text("id"), fallback_id(*[text(k) for k in S.KEYS]))}
    for c in S.WIRE_COLUMNS[1:]:
        if c in S.UNSIGNED:
            columns[c] = to_uint(number(c), S.UNSIGNED[c]).cast(S.FACT_SCHEMA[c].dataType)
        elif c in S.CAUSE_COUNTS:
            columns[c] = to_nonneg(number(c)).cast("float")
        else:
            columns[c] = F.coalesce(text(c), F.lit(""))
    return columns


def ingest(messages, payload="payload", arrival=None, own_id=None):
    """Decode and type messages.

    Every message gives one row: the wire columns, `reason` (NULL for a fact
    row) and the columns it came with. An infinite value in an unsigned field
    rejects its record. arrival names the arrival column; without it the
    current time is taken, in whole seconds. own_id names a further column for
    the id that the message itself has.
    """
    decoded = decode_strict(messages, payload)
    record = F.col("record")
    kept = [*messages.columns, "record", "reason"]
    texts = computed_once(decoded, kept, {"_t": field_texts(record, S.WIRE_COLUMNS)})
    names = list(S.UNSIGNED) + S.CAUSE_COUNTS
    # Few records hold a boolean; only those are asked for numbers field by field.
    boolean = reduce(lambda a, b: a | b, [F.col(f"_t.{c}").isin("true", "false") for c in names])
    plain = F.struct(*[number_from_text(F.col(f"_t.{c}")).alias(c) for c in names])
    asked = F.struct(*[field_number(F.col(f"_t.{c}"), record, c).alias(c) for c in names])
    # A reject has no numbers; its fields are not looked at one by one.
    numbers = computed_once(texts, [*kept, "_t"], {
        "_n": F.when(F.col("_t").isNotNull(), F.when(boolean, asked).otherwise(plain))})
    infinite = reduce(lambda a, b: a | b, [
        F.coalesce(is_infinite(F.col(f"_n.{c}")), F.lit(False)) for c in S.UNSIGNED])
    typed = typed_columns(lambda c: F.col(f"_n.{c}"), lambda c: F.col(f"_t.{c}"))
    stamp = F.date_trunc("second", F.current_timestamp() if arrival is None else F.col(arrival))
    reason = F.coalesce("reason", F.when(infinite, "non_finite"))
    own = {own_id: F.col("_t.id")} if own_id else {}
    return computed_once(numbers, messages.columns, {**typed, "ingestion_timestamp": stamp, "reason": reason, **own})


def facts(ingested):
    """The accepted rows in stored column order."""
    return ingested.filter(F.col("reason").isNull()).select(*S.FACT_SCHEMA.names)


def quarantine(ingested, *context):
    """The rejected messages with their reason and any context columns."""
    return ingested.filter(F.col("reason").isNotNull()).select(*context, "reason")
