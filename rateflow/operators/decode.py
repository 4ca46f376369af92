"""Payload decoding: JSON text to records, strictly (0 or 1) or leniently (0..n), with reject reasons.

A payload is an object, an array of objects, or a pretty-printed object that was
split into tokens: [{"{": "\\"key\\" : value"}, ...]. JSON types matter (true is
a number, "true" is not), hence VARIANT.
"""

from pyspark.sql import functions as F

from rateflow.functions.scalars import BLANKS, computed_once, trimmed

_BARE_NUMBERS = ['"NaN"', '"Infinity"', '"-Infinity"']


def _let(value, body):
    """body(value) with value computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_parsed_json(df, text, into):
    """Add the text's VARIANT, NULL when the text is not exactly one JSON value.

    Spark's parsers stop after the first value. Reading the text as the first
    element of an array that ends in a marker exposes trailing garbage. The
    marker is the text's own digest, which no text can hold.
    Objects with repeated keys or bare NaN, which VARIANT refuses, are read as
    text maps instead; the last value of a repeated key wins.
    """
    text = F.col(text)
    boxed = df.withColumn("_end", F.md5(text))
    boxed = boxed.withColumn("_boxed", F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), F.col("_end"), F.lit('"]'))))
    maps = F.from_json(
        F.concat(F.lit("["), text, F.lit(",null]")), "array<map<string,string>>", {"allowSingleQuotes": "false"})

    def from_map(found):
        alone = (F.size(found) == 2) & F.get(found, F.lit(1)).isNull() & F.get(found, F.lit(0)).isNotNull()
        bare = F.transform_values(
            F.get(found, F.lit(0)), lambda k, v: F.when(v.isin(_BARE_NUMBERS), F.btrim(v, F.lit('"'))).otherwise(v))
        return F.when(alone, _object(F.map_entries(bare)))

    alone = (F.try_variant_get("_boxed", "$[1]", "string") == F.col("_end")) & F.try_variant_get(
        "_boxed", "$[2]", "variant").isNull()
    value = F.when(alone, F.try_variant_get("_boxed", "$[0]", "variant")).when(
        F.col("_boxed").isNull(), _let(maps, from_map))
    return computed_once(boxed, df.columns, {into: value})


def _first_character(text):
    """First significant character; it tells the shape of text that parsed."""
    return F.substring(F.ltrim(text, F.lit(BLANKS)), 1, 1)


def _kind(v):
    return F.schema_of_variant(v)


def _entries(item, texts):
    """Key-value entries of an object, NULL for anything else.

    A VARIANT sorts its keys; texts, the same object as a map of texts, has them
    in the order of the source, in which a later entry wins.
    """
    def build(found):
        ordered = F.transform(F.map_keys(texts), lambda k: F.struct(k.alias("key"), F.element_at(found, k).alias("value")))
        same = F.size(F.map_keys(texts)) == F.size(F.map_keys(found))
        return F.when(same, ordered).otherwise(F.map_entries(found))

    return _let(F.try_variant_get(item, "$", "map<string,variant>"), lambda found: F.when(found.isNotNull(), build(found)))


def _is_brace(key):
    return trimmed(key).isin("{", "}")


def _unsplittable(v):
    """A token value that is not text, yet not empty either: the record cannot be read."""
    number = F.try_variant_get(v, "$", "double")
    return _let(_kind(v), lambda kind: (
        F.when(kind.isin("STRING", "VOID"), F.lit(False))
        .when(kind.startswith("ARRAY"), F.coalesce(
            F.array_contains(F.try_variant_get(v, "$", "array<string>"), ":"), F.lit(False)))
        .when(kind.startswith("OBJECT"), F.try_variant_get(v, "$[':']", "variant").isNotNull())
        .otherwise(number != 0)))


def _unquoted(text):
    return trimmed(F.btrim(trimmed(text), F.lit('"')))


def _split(text):
    """Key and value of a token such as '"key" : value', split at the first colon; NULL without a key."""
    left = F.substring_index(text, ":", 1)
    pair = F.struct(
        _unquoted(left).alias("key"),
        _unquoted(F.substring(text, F.length(left) + 2, F.length(text))).cast("variant").alias("value"))
    return F.when(F.contains(text, F.lit(":")), _let(pair, lambda p: F.when(p["key"] != "", p)))


def _token(entry):
    """The split token of an entry whose value is text, else NULL."""
    value = entry["value"]
    return F.when(_kind(value) == "STRING", _let(F.try_variant_get(value, "$", "string"), _split))


def _object(entries):
    """Key-value entries to an object; the last entry of a key wins."""
    def build(newest_first):
        keys = F.transform(newest_first, lambda e: e["key"])
        unique = F.array_distinct(keys)
        picked = F.transform(unique, lambda k: F.get(newest_first, (F.array_position(keys, k) - 1).cast("int"))["value"])
        whole = F.map_from_arrays(keys, F.transform(newest_first, lambda e: e["value"]))
        return F.when(F.size(unique) == F.size(keys), whole).otherwise(F.map_from_arrays(unique, picked))

    return F.to_variant_object(_let(F.reverse(entries), build))


def _present(items):
    return F.filter(items, lambda e: e.isNotNull())


def _reason(text, has_record, value, shape, items, broken):
    return (
        F.when(has_record, F.lit(None).cast("string"))
        .when(text.isNull(), "empty_message")
        .when(value.isNull(), "invalid_json")
        .when(shape != "[", "not_an_object")
        .when(F.size(items) == 0, "empty_array")
        .when(broken, "bad_token")
        .otherwise("no_tokens")
    )


def _may_have_braces(payload):
    """False only if no key of the JSON text is a brace between blanks: such a key stands so in the text, or is escaped there."""
    return F.contains(payload, F.lit("\\")) | payload.rlike(f'"[{BLANKS}]*[{{}}][{BLANKS}]*"')


def _parsed(df, payload, wanted=None):
    """Add _value, its first character _shape, and for an array its _items and the _objects among them.

    wanted is a condition on messages; _objects is NULL in others.
    """
    value, shape = F.col("_value"), F.col("_shape")
    out = with_parsed_json(df, payload, "_value").withColumn("_shape", _first_character(F.col(payload)))
    out = out.withColumn("_items", F.when(shape == "[", F.try_variant_get(value, "$", "array<variant>")))
    maps = F.from_json(F.col(payload), "array<map<string,string>>", {"allowSingleQuotes": "false"})
    texts = F.when(F.exists("_items", lambda i: _kind(i).startswith("OBJECT")), maps)
    needed = shape == "[" if wanted is None else (shape == "[") & wanted
    # The texts are read once, not once for each item.
    return out.withColumn("_objects", F.when(needed, _let(texts, lambda known: F.transform(
        "_items", lambda item, i: _entries(item, F.get(known, i))))))


def decode_strict(df, payload="payload"):
    """Add `record` (VARIANT) and `reason`: one object per message, or a reject reason.

    Arrays are only read as token lists; other array elements are ignored.
    """
    entries, tokens = F.col("_entries"), F.col("_tokens")
    value, shape = F.col("_value"), F.col("_shape")
    out = _parsed(df, payload, _may_have_braces(F.col(payload)))
    out = out.withColumn("_entries", F.filter(
        F.flatten(_present(F.col("_objects"))), lambda e: _is_brace(e["key"])))
    out = out.withColumn("_broken", F.exists(entries, lambda e: _unsplittable(e["value"])))
    out = out.withColumn("_tokens", F.when(~F.col("_broken"), _present(F.transform(entries, _token))))
    record = F.when(shape == "{", value).when(F.size(tokens) > 0, _object(tokens))
    reason = _reason(
        F.col(payload), F.col("record").isNotNull(), value, shape, F.col("_items"), F.col("_broken"))
    out = out.withColumn("record", record)
    return computed_once(out, df.columns, {"record": F.col("record"), "reason": reason})


def decode_lenient(df, payload="payload"):
    """Add `records` (array of VARIANT, possibly empty) and `reason` for messages without a record.

    An array of plain objects gives all of them. Otherwise tokens and remaining
    keys of its objects are merged into one record.
    """
    value, shape, items = F.col("_value"), F.col("_shape"), F.col("_items")
    objects, entries, merged = F.col("_objects"), F.col("_entries"), F.col("_merged")
    out = _parsed(df, payload).withColumn("_entries", F.flatten(_present(objects)))
    only_objects = F.forall(objects, lambda o: o.isNotNull())
    braced = F.exists(entries, lambda e: F.contains(e["key"], F.lit("{")))
    all_records = F.forall(objects, lambda o: F.exists(o, lambda e: e["key"].isin("year", "month", "carrier")))
    out = out.withColumn("_way", F.when(only_objects & ~braced, "each").when(
        only_objects & all_records, "first").when(objects.isNotNull(), "merge"))
    way = F.col("_way")
    out = out.withColumn("_broken", (way == "merge") & F.exists(
        entries, lambda e: _is_brace(e["key"]) & _unsplittable(e["value"])))
    out = out.withColumn("_merged", F.when((way == "merge") & ~F.col("_broken"), _present(F.transform(
        entries, lambda e: F.when(_is_brace(e["key"]), _token(e)).otherwise(
            F.struct(e["key"].alias("key"), e["value"].alias("value")))))))
    records = (
        F.when((shape == "{") & value.isNotNull(), F.array(value))
        .when(way == "each", items)
        .when(way == "first", F.slice(items, 1, 1))
        .when(F.size(merged) > 0, F.array(_object(merged)))
        .otherwise(F.array().cast("array<variant>"))
    )
    out = out.withColumn("records", records)
    reason = _reason(F.col(payload), F.size("records") > 0, value, shape, items, F.col("_broken"))
    return computed_once(out, df.columns, {"records": F.col("records"), "reason": reason})


def explode_records(decoded):
    """One row per record of a leniently decoded message; messages without records give none."""
    others = [c for c in decoded.columns if c not in ("records", "reason")]
    return decoded.select(*others, F.explode("records").alias("record"))
