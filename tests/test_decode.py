"""Payload shapes, their records and their reject reasons."""

import json

import pytest
from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.operators import decode, ingest
from tests.helpers import lit_rows

STRICT = [
    ('{"id":"a","year":2025,"month":1,"carrier":"AA","arr_flights":10}', None, {"id": "a", "year": 2025}),
    ("{}", None, {}),
    ("[]", "empty_array", None),
    ('[{"{":"\\"year\\" : 2025"},{"{":"\\"carrier\\" : \\"AA\\""}]', None, {"year": "2025", "carrier": "AA"}),
    ('[{"{":"\\"airport_name\\" : \\"Town, PA: Field\\""}]', None, {"airport_name": "Town, PA: Field"}),
    ('[{"{":"\\"year\\" : 2025,"}]', None, {"year": "2025,"}),
    ('[{"{":"novalue"}]', "no_tokens", None),
    ('[{"{":""}]', "no_tokens", None),
    ('[{"{":" : x"}]', "no_tokens", None),
    ('[{"{":5}]', "bad_token", None),
    ('[{"{":true}]', "bad_token", None),
    ('[{"{":0},{"{":null},{"{":false},{"}":"a:b"}]', None, {"a": "b"}),
    ('[{"{":["x"]},{"}":"a:b"}]', None, {"a": "b"}),
    ('[{"{":[":"]},{"}":"a:b"}]', "bad_token", None),
    ('[{"{":{":":1}}]', "bad_token", None),
    ('[{"{":"a:1"},{" { ":"a:2"}]', None, {"a": "2"}),
    ('[{"{":"a:1","other":7},5]', None, {"a": "1"}),
    ('[{"year":2025,"carrier":"AA"}]', "no_tokens", None),
    ('[{"year":1},5]', "no_tokens", None),
    ('{"a":', "invalid_json", None),
    ('{"a":1} tail', "invalid_json", None),
    ('{"a":1}{"b":2}', "invalid_json", None),
    ('{"a":1}]', "invalid_json", None),
    ('[{"{":"a:1"}]]', "invalid_json", None),
    ("{'a':1}", "invalid_json", None),
    ("", "invalid_json", None),
    ("   ", "invalid_json", None),
    ("5", "not_an_object", None),
    ('"text"', "not_an_object", None),
    ("null", "not_an_object", None),
    ('{"a":1,"a":2}', None, {"a": "2"}),
    ('{"a":NaN,"b":3}', None, {"a": "NaN", "b": "3"}),
    (' \n{"a":1}\t', None, {"a": 1}),
    ('{"id":"a"},"<end>"]garbage', "invalid_json", None),
    ('[null,{"carrier":2.5," { ":"\\"carrier\\" : \\"v\\""}]', None, {"carrier": "v"}),
    ('[{"}":"a:1","{":"a:2"}]', None, {"a": "2"}),
    (None, "empty_message", None),
]

LENIENT = [
    ('{"year":1}', [{"year": 1}]),
    ("{}", [{}]),
    ("[]", []),
    ('[{"{":"\\"year\\" : 2025"}]', [{"year": "2025"}]),
    ('[{"{":"novalue"}]', []),
    ('[{"{":5}]', []),
    ('[{"year":2025,"carrier":"AA"}]', [{"year": 2025, "carrier": "AA"}]),
    ('[{"year":2024},{"year":2025}]', [{"year": 2024}, {"year": 2025}]),
    ('[{"x":1},{}]', [{"x": 1}, {}]),
    ('[{"year":1},5]', [{"year": 1}]),
    ('[null,{"carrier":2.5," { ":"\\"carrier\\" : \\"v\\""}]', [{"carrier": "v"}]),
    ('[{"a":1,"b":true},5,{"a":2}]', [{"a": 2, "b": True}]),
    ('[{"{":"k:v"},{"plain":[1]}]', [{"k": "v", "plain": [1]}]),
    ('[{"year":1,"x{":2},{"month":3}]', [{"year": 1, "x{": 2}]),
    ("[5,6]", []),
    ('{"a":', []),
    ("5", []),
    (None, []),
]


def test_strict(spark):
    got = decode.decode_strict(lit_rows(spark, [p for p, _, _ in STRICT])).select(
        "n", F.to_json("record").alias("record"), "reason").orderBy("n").collect()
    for (payload, reason, subset), row in zip(STRICT, got):
        assert row["reason"] == reason, payload
        if subset is None:
            assert row["record"] is None, payload
        else:
            record = json.loads(row["record"])
            assert {k: record.get(k) for k in subset} == subset, payload


def test_lenient(spark):
    got = decode.decode_lenient(lit_rows(spark, [p for p, _ in LENIENT])).select(
        "n", F.transform("records", lambda r: F.to_json(r)).alias("records"), "reason").orderBy("n").collect()
    for (payload, records), row in zip(LENIENT, got):
        assert [json.loads(r) for r in row["records"]] == records, payload
        assert (row["reason"] is None) == bool(records), payload


@pytest.mark.parametrize("text, whole, real", [
    ('"12.9"', 12, 12.9), ('"-3"', 0, 0.0), ('"-0.5"', 0, 0.0), ('""', 0, 0.0), ("null", 0, 0.0), ('"abc"', 0, 0.0),
    ("true", 1, 1.0), ("false", 0, 0.0), ('"true"', 0, 0.0), ('"1e3"', 1000, 1000.0), ("1e12", 4294967295, 1e12),
    ('"nan"', 0, 0.0), ('"1_000"', 1000, 1000.0), ('"1__0"', 0, 0.0), ('"7d"', 0, 0.0), ('"0x10"', 0, 0.0),
    ('" 8 "', 8, 8.0), ("[1]", 0, 0.0), ('{"x":1}', 0, 0.0), ('".5"', 0, 0.5), ('"5."', 5, 5.0), ('"."', 0, 0.0),
])
def test_coercion(spark, text, whole, real):
    row = ingest.ingest(lit_rows(spark, [f'{{"arr_flights":{text},"carrier_ct":{text}}}'])).first()
    assert row["reason"] is None
    assert row["arr_flights"] == whole
    assert row["carrier_ct"] == pytest.approx(real, rel=1e-6)


def test_infinite_values(spark):
    rows = ingest.ingest(lit_rows(spark, ['{"arr_flights":"inf"}', '{"carrier_ct":"inf"}', '{"month":1e400}'])).orderBy(
        "n").collect()
    assert [r["reason"] for r in rows] == ["non_finite", None, "non_finite"]
    assert rows[1]["carrier_ct"] == float("inf")


def test_typed_row(spark):
    payloads = ['{"year":70000,"month":300,"carrier":null,"airport":7}', '{"id":"x"}']
    ingested = ingest.ingest(lit_rows(spark, payloads), arrival="arrival")
    facts = ingest.facts(ingested)
    assert facts.schema == S.FACT_SCHEMA or [f.dataType for f in facts.schema] == [f.dataType for f in S.FACT_SCHEMA]
    first, second = ingested.orderBy("n").collect()
    assert (first["year"], first["month"], first["carrier"], first["airport"]) == (65535, 255, "", "7")
    assert first["ingestion_timestamp"].microsecond == 0
    assert len(first["id"]) == 64 and second["id"] == "x"


def test_id_parts_do_not_run_together(spark):
    rows = ingest.ingest(lit_rows(spark, ['{"year":1,"month":12}', '{"year":11,"month":2}'])).collect()
    assert rows[0]["id"] != rows[1]["id"]


def test_filter_is_not_copied_into_the_decoder(spark):
    accepted = ingest.facts(ingest.ingest(lit_rows(spark, ["{}"])))
    plan = accepted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") <= 4


@pytest.mark.parametrize("payload, record", [
    (r'[{"\u007b":"a:1"}]', '{"a":"1"}'), (r'[{"\t}":"a:1"}]', '{"a":"1"}'), ('[{" {  ":"a:1"}]', '{"a":"1"}'),
    ('[{"x{":"a:1"}]', None), ('[{"x":"{"}]', None), ('[{"x":{"{":"a:1"}}]', None)])
def test_keys_that_are_braces(spark, payload, record):
    """Escaped or with blanks around; texts without such a key are not taken apart."""
    got = decode.decode_strict(lit_rows(spark, [payload])).select(F.to_json("record").alias("r"), "reason").first()
    assert (got.r, got.reason) == (record, None if record else "no_tokens")
