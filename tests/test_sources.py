"""Files and messages: what is written reads back, odd input is handled as specified."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.operators import clean, ingest
from rateflow.session import settle, shared_folder, work_path
from rateflow.sources import files, messages, star
from tests.helpers import observations, one, same_rows


def test_csv_round_trip_with_awkward_labels(spark):
    df = observations(spark, [
        {"airport_name": 'Town, PA: "Main" Field'}, {"airport_name": None, "arr_delay": None}, {"carrier": "NA"}])
    path = work_path(spark, "test")
    files.write_csv(df, path)
    back = clean.normalize(files.read_csv(spark, path))
    expected = df.withColumn("carrier", F.when(F.col("carrier") != "NA", F.col("carrier")))
    assert same_rows(back, expected)


def test_csv_takes_columns_from_the_header(spark, tmp_path):
    (tmp_path / "h.csv").write_text("month,carrier,arr_flights\n3, AA ,7\nx,,n/a\n")
    rows = clean.normalize(files.read_csv(spark, str(tmp_path / "h.csv"))).collect()
    assert [tuple(r) for r in rows] == [(3, "AA", 7.0), (None, None, None)]


def test_csv_goes_by_the_names_of_each_header(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.csv").write_text("b,a\n2,1\n")
    (tmp_path / "three.csv").write_text("a,c\n1,3\n")
    rows = files.read_csv(spark, str(tmp_path), ["b", "a"])
    assert sorted((r["a"], r["b"] or "") for r in rows.collect()) == [("1", ""), ("1", "2"), ("1", "2")]
    assert sorted(files.read_csv(spark, str(tmp_path)).columns) == ["a", "b", "c"]
    swapped = files.read_csv(spark, str(tmp_path / "two.csv"), ["a", "b", "x"])
    assert [tuple(r) for r in swapped.collect()] == [("1", "2", None)]


def test_csv_line_breaks(spark):
    df, path = observations(spark, [{"airport_name": "two\nlines"}, {}]), work_path(spark, "test")
    with pytest.raises(Exception, match="line break"):
        files.write_csv(df, path)
    files.write_csv(df, path, line_breaks=True)
    assert same_rows(clean.normalize(files.read_csv(spark, path, multi_line=True)), df)


def test_csv_heads_are_read_alone(spark, tmp_path):
    """Files with several headers, one compressed, one empty, in a folder whose name has a space."""
    folder = tmp_path / "some files"
    folder.mkdir()
    (folder / "a.csv").write_text("year,carrier\n2001,A\n")
    (folder / "b.csv").write_text("carrier,extra,year\n\"B, b\",x,2002\n")
    (folder / "c.csv.gz").write_bytes(gzip.compress(b"year,carrier\n2003,C\n"))
    (folder / "d.csv").write_text("")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    heads = files._files_by_header(spark, str(folder))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert {h: len(f) for h, f in heads.items()} == {"year,carrier": 2, "carrier,extra,year": 1}
    rows = files.read_csv(spark, str(folder), ["year", "carrier", "extra"])
    assert sorted(tuple(r) for r in rows.na.fill("-").collect()) == [("2001", "A", "-"), ("2002", "B, b", "x"), ("2003", "C", "-")]


def test_json_lines_keep_every_field(spark, tmp_path):
    (tmp_path / "in.ndjson").write_text('{"carrier":"A","my key":1}\n{"id":"x","month":2}\n')
    records, _ = files.load_json_lines(spark, str(tmp_path / "in.ndjson"), None)
    assert records.columns == ["month", "carrier", "id", "my key"]
    assert sorted(tuple(r) for r in records.select("id", "my key").na.fill("").collect()) == [("", "1"), ("x", "")]


def test_json_lines_are_read_once(spark, tmp_path):
    """Odd field names, mixed types, nesting, repeated keys and lines that are no object; the file is not needed afterwards."""
    path = tmp_path / "in.ndjson"
    path.write_text("\n".join([
        '{"carrier":"A","a.b":1,"with `tick`":true,"OBJECT<x":{"y":[1,{"z":2}]}}', '{"carrier":7,"a.b":"t","late":null}', "5", "[1]",
        '{"month":1,"month":2}', "{}", "{bad", '{"empty":{}}']))
    records, bad = files.load_json_lines(spark, str(path))
    path.unlink()
    assert bad == 1 and records.count() == 7
    assert records.columns == ["month", "carrier", "OBJECT<x", "a.b", "empty", "late", "with `tick`"]
    got = {tuple(r) for r in records.na.fill("-").collect()}
    assert ("-", "A", '{"y":[1,{"z":2}]}', "1", "-", "-", "true") in got and ("2", "-", "-", "-", "-", "-", "-") in got
    assert not any(str(path) in f for f in records.inputFiles())


def test_json_lines_without_any_field(spark, tmp_path):
    (tmp_path / "in.ndjson").write_text("{}\n5\n")
    records, bad = files.load_json_lines(spark, str(tmp_path / "in.ndjson"))
    assert records.columns == [] and records.count() == 2 and bad == 0


def test_messages_are_written(spark):
    path = work_path(spark, "test")
    sent = messages.encode_messages(observations(spark, [{}, {"month": 2}]).withColumn("kafka_key", F.lit("k")))
    messages.write_messages(sent, "parquet", path=path)
    assert same_rows(spark.read.parquet(path), sent)


def test_json_lines_skip_blank_and_bad(spark, tmp_path):
    path = tmp_path / "in.ndjson"
    path.write_text('{"carrier":"É","month":2}\n\n   \n{"bad"\n{"carrier":null,"extra":1}\n')
    records, bad = files.load_json_lines(spark, str(path), ["carrier", "month"])
    assert bad == 1 and sorted((r["carrier"] or "", r["month"]) for r in records.collect()) == [("", None), ("É", "2")]
    path.write_text("nothing\n\n")
    with pytest.raises(ValueError):
        files.load_json_lines(spark, str(path))


def test_json_lines_write_missing_as_null(spark):
    path = work_path(spark, "test")
    files.write_json_lines(observations(spark, [{"carrier": None, "airport_name": "Zürich"}]).coalesce(1), path)
    text = one(spark.read.text(path))[0]
    assert json.loads(text)["carrier"] is None and "Zürich" in text


def test_partitioned_layout_prunes_and_sorts(spark, sf_dir):
    path = work_path(spark, "test")
    df = star.observations(spark, sf_dir)
    files.write_partitioned(df, path)
    stored = spark.read.parquet(path)
    assert same_rows(stored.select(*df.columns), df)
    month = stored.filter("year = 2000 AND month = 3")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    for file in month.select("_metadata.file_path").distinct().collect():
        keys = [tuple(r) for r in spark.read.parquet(file[0]).select("carrier", "airport").collect()]
        assert keys == sorted(keys)


def test_encode_then_decode(spark, sf_dir):
    rows = star.event_observations(star.read_events(spark, sf_dir))
    keyed = rows.withColumn("kafka_key", messages.message_key(F.col("arrival"))).drop("event_id", "arrival")
    sent = messages.encode_messages(keyed)
    assert sent.columns == ["key", "value"]
    received = ingest.facts(ingest.ingest(sent, "value")).drop("ingestion_timestamp")
    expected = keyed.select(*[F.col(c).cast(S.FACT_SCHEMA[c].dataType) for c in S.WIRE_COLUMNS])
    assert same_rows(received, expected)


def test_undecodable_bytes(spark):
    raw = spark.createDataFrame([(bytearray(b'{"id":"\xff"}'),), (bytearray(b'{"id":"ok"}'),)], "value binary")
    strict = raw.select(messages.decoded_text(F.col("value")).alias("payload"))
    assert sorted(r["reason"] or "" for r in ingest.ingest(strict).collect()) == ["", "empty_message"]
    lenient = [r[0] for r in raw.select(messages.decoded_text(F.col("value"), strict=False)).collect()]
    assert lenient == ['{"id":"�"}', '{"id":"ok"}']


def test_settle_writes_to_the_shared_folder(spark):
    table = settle(spark.range(5), "test")
    assert table.count() == 5
    assert shared_folder(spark) in one(table.select("_metadata.file_path").limit(1))[0]


class _Session:
    """A session whose settings do not name a folder."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_must_be_named_on_a_cluster():
    assert shared_folder(_Session("local[2]")) == shared_folder(_Session("local[2]"))
    with pytest.raises(ValueError):
        shared_folder(_Session("spark://host:7077"))
    with pytest.raises(ValueError):
        shared_folder(_Session("local-cluster[2,1,1024]"))
