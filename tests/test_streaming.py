"""A stream gives what the batch job gives; a restart neither loses nor repeats rows."""

from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.operators import decode, ingest, live, rollups
from rateflow.session import pieces_for, settle, work_path
from rateflow.sources import star
from rateflow.streaming import jobs
from tests.helpers import same_rows


def _source(spark, sf_dir):
    """Messages as several files, added in two steps."""
    folder = work_path(spark, "messages")
    messages = star.event_messages(star.read_events(spark, sf_dir))
    for step in range(2):
        messages.filter(F.col("event_id") % 2 == step).repartition(3).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 2).parquet(folder)
        yield messages, stream


def test_ingest_in_steps_equals_batch(spark, sf_dir):
    root = work_path(spark, "test")
    for messages, stream in _source(spark, sf_dir):
        jobs.run_to_end(jobs.start_ingest, stream, root, context=["event_id"])
    # Nothing new has arrived: a further run changes nothing.
    jobs.run_to_end(jobs.start_ingest, stream, root, context=["event_id"])
    batch = ingest.ingest(messages, arrival="arrival")
    facts = ingest.facts(batch)
    assert same_rows(jobs.read_output(spark, root, jobs.FACT).select(*facts.columns), facts)
    rejected = ingest.quarantine(batch, "payload", "event_id")
    assert same_rows(jobs.read_output(spark, root, jobs.QUARANTINE), rejected)
    assert same_rows(jobs.current_summary(spark, root), rollups.summary(facts))
    streamed, direct = jobs.current_minute_stats(spark, root), rollups.minute_stats(rollups.minute_partials(facts))
    rounded = F.round("avg_delay_per_flight", 9).alias("r")
    assert same_rows(streamed.select("ingestion_minute", "record_count", rounded),
                     direct.select("ingestion_minute", "record_count", rounded))


def test_replayed_batch_overwrites_itself(spark, sf_dir):
    messages = star.event_messages(star.read_events(spark, sf_dir)).limit(200)
    facts = ingest.facts(ingest.ingest(messages, arrival="arrival"))
    root = work_path(spark, "test")
    for _ in range(2):
        jobs.write_partitioned(facts, jobs._batch_path(root, jobs.FACT, 0), "overwrite")
    assert jobs.read_output(spark, root, jobs.FACT).count() == facts.count()


def test_ingest_of_rejects_only(spark):
    folder, root = work_path(spark, "messages"), work_path(spark, "test")
    rows = spark.createDataFrame([("nonsense", 1)], "payload string, n int").withColumn(
        "arrival", F.lit("2025-01-01").cast("timestamp"))
    rows.write.parquet(folder)
    jobs.run_to_end(jobs.start_ingest, spark.readStream.schema(rows.schema).parquet(folder), root)
    assert jobs.read_output(spark, root, jobs.FACT).count() == 0
    assert jobs.read_output(spark, root, jobs.QUARANTINE).collect()[0]["reason"] == "invalid_json"


def test_live_records_equal_batch(spark, sf_dir):
    root = work_path(spark, "test")
    for messages, stream in _source(spark, sf_dir):
        jobs.run_to_end(jobs.start_live, stream, root)
    batch = decode.explode_records(decode.decode_lenient(messages))
    expected = batch.select(F.col("arrival").alias("received_at"), F.to_json("record").alias("record"))
    assert same_rows(jobs.read_output(spark, root, jobs.LIVE).select("received_at", "record"), expected)
    rejected = decode.decode_lenient(messages).filter(F.size("records") == 0).select("payload", "reason")
    assert same_rows(jobs.read_output(spark, root, jobs.LIVE_QUARANTINE).select("payload", "reason"), rejected)
    newest = live.latest(expected, "received_at", "record")
    assert same_rows(live.latest(jobs.current_history(spark, root), "received_at", "record").select(*newest.columns), newest)


def test_sliding_rate_over_several_batches(spark, sf_dir):
    root = work_path(spark, "test")
    for messages, stream in _source(spark, sf_dir):
        jobs.run_to_end(jobs.start_sliding_rate, stream, root)
    expected = messages.groupBy(F.window("arrival", "5 minutes", "1 minute").alias("w")).agg(
        F.count(F.lit(1)).alias("messages")).select(F.col("w.start").alias("window_start"), "messages")
    assert same_rows(jobs.current_sliding_rate(spark, root).select("window_start", "messages"), expected)


def test_scenario_stream(spark, sf_dir):
    root = work_path(spark, "test")
    templates = star.event_observations(star.stream_events(spark, sf_dir)).withColumn("template_id", F.col("event_id"))
    jobs.run_to_end(jobs.start_scenario, templates, root, replicas=2)
    rows = spark.read.parquet(f"{root}/scenario")
    assert rows.count() == 2 * star.read_events(spark, sf_dir).count()
    assert rows.filter(F.col("arr_delay") != sum(F.col(c) for c in S.CAUSE_MINUTES)).isEmpty()
    assert rows.select("template_id", "replica").distinct().count() == rows.count()


def test_compaction_between_batches_and_after_a_replay(spark, sf_dir):
    root, folder = work_path(spark, "test"), work_path(spark, "messages")
    messages = star.event_messages(star.read_events(spark, sf_dir))
    names = (jobs.FACT, jobs.SUMMARY, jobs.MINUTES)
    for step in range(3):
        messages.filter(F.col("event_id") % 3 == step).repartition(2).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        jobs.run_to_end(jobs.start_ingest, stream, root)
        closed = {jobs.compact(spark, root, name) for name in names}
        assert closed == {2 * step}
        # the batch after the generation is replayed, and the compaction is repeated
        again = jobs.read_output(spark, root, jobs.FACT).count()
        last = jobs._batch_path(root, jobs.FACT, 2 * step + 1)
        copy = settle(spark.read.schema(S.FACT_SCHEMA).parquet(last), "replay")
        jobs.write_partitioned(copy, last, "overwrite")
        assert jobs.compact(spark, root, jobs.FACT) == 2 * step
        assert jobs.read_output(spark, root, jobs.FACT).count() == again
        if step == 1:
            for name in names:
                jobs.drop_compacted(spark, root, name)
    facts = ingest.facts(ingest.ingest(messages, arrival="arrival"))
    assert same_rows(jobs.read_output(spark, root, jobs.FACT).select(*facts.columns), facts)
    assert same_rows(jobs.current_summary(spark, root), rollups.summary(facts))
    counts = ["ingestion_minute", "record_count", "total_flights"]
    assert same_rows(jobs.current_minute_stats(spark, root).select(*counts),
                     rollups.minute_stats(rollups.minute_partials(facts)).select(*counts))


def test_compacted_windows_keep_the_newest_version(spark, sf_dir):
    root = work_path(spark, "test")
    for messages, stream in _source(spark, sf_dir):
        jobs.run_to_end(jobs.start_sliding_rate, stream, root)
        jobs.compact(spark, root, jobs.WINDOWS)
        jobs.drop_compacted(spark, root, jobs.WINDOWS)
    expected = messages.groupBy(F.window("arrival", "5 minutes", "1 minute").alias("w")).agg(
        F.count(F.lit(1)).alias("messages")).select(F.col("w.start").alias("window_start"), "messages")
    assert same_rows(jobs.current_sliding_rate(spark, root).select("window_start", "messages"), expected)


def test_history_is_trimmed(spark, sf_dir):
    root = work_path(spark, "test")
    for messages, stream in _source(spark, sf_dir):
        jobs.run_to_end(jobs.start_live, stream, root, history=40)
    history = jobs.current_history(spark, root)
    whole = jobs.read_output(spark, root, jobs.LIVE)
    assert history.count() == 40 and same_rows(history, live.latest(whole, "received_at", "record", 40))


def test_rows_are_dealt_out_by_their_number(spark, sf_dir):
    """Tasks grow with the table, and results do not depend on their number."""
    events = star.read_events(spark, sf_dir)
    n = events.count()
    assert pieces_for(events, 8) == 8 and pieces_for(events, 8, 1) == n and pieces_for(events.limit(0), 8) == 8
    assert pieces_for(events, 1, n - 1) == 2 and pieces_for(events, 1, n) == 1


def test_pieces_of_a_batch(spark, sf_dir):
    """Both jobs deal a batch out to as many tasks as asked, and keep all rows, the payloads of rejects and the history."""
    one, many = work_path(spark, "test"), work_path(spark, "test")
    folder = work_path(spark, "messages")
    messages = star.event_messages(star.read_events(spark, sf_dir)).where("event_id < 300")
    messages.coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(messages.schema).parquet(folder)
    for root, pieces in ((one, None), (many, 7)):
        jobs.run_to_end(jobs.start_ingest, stream, f"{root}/i", context=["event_id"], pieces=pieces)
        jobs.run_to_end(jobs.start_live, stream, f"{root}/l", context=["event_id"], history=40, pieces=pieces)
    for job, name in (("i", jobs.FACT), ("i", jobs.QUARANTINE), ("l", jobs.LIVE), ("l", jobs.LIVE_QUARANTINE)):
        a, b = (jobs.read_output(spark, f"{root}/{job}", name) for root in (one, many))
        assert a.count() > 0 and same_rows(a, b)
    assert same_rows(jobs.current_history(spark, f"{one}/l"), jobs.current_history(spark, f"{many}/l"))
    assert jobs.read_output(spark, f"{many}/i", jobs.QUARANTINE).where("payload IS NULL").isEmpty()
    assert len(jobs.read_output(spark, f"{many}/l", jobs.LIVE).inputFiles()) == 7
