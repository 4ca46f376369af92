"""Continuous jobs, and the compaction that keeps their outputs readable.

Batch outputs are named by batch id and overwritten when a batch is replayed, so
a restart after a failure neither loses nor repeats rows. Arrival time is the
only clock; nothing is dropped as late.

A job that runs for long leaves many batches. compact() merges all up to a
closed batch into one generation, a folder of its own that is named by that
batch; reads take the newest complete generation and the batches after it.
drop_compacted() then removes what no read needs.
"""

from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.operators import decode, ingest, live, rollups, scenario
from rateflow.session import spread
from rateflow.sources.files import write_partitioned

FACT, QUARANTINE, SUMMARY, MINUTES, WINDOWS = "fact", "quarantine", "summary", "minutes", "windows"
LIVE, LIVE_QUARANTINE, HISTORY = "live", "live_quarantine", "history"
_SHOWN = ["id", "year", "month", "carrier", "airport"]


def _batch_path(root, name, batch_id):
    return f"{root}/{name}/batch_id={batch_id}"


def _generation_path(root, name, upto):
    return f"{root}/{name}_compacted/upto={upto}"


def _start(stream, write_batch, root, trigger, mode="append"):
    return (
        stream.writeStream.outputMode(mode).foreachBatch(write_batch)
        .option("checkpointLocation", f"{root}/checkpoint").trigger(**trigger).start()
    )


def _filesystem(spark, path):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _numbers(spark, folder, prefix, complete=False):
    """The numbers in the names of a folder's sub-folders, in order; complete asks for a finished write."""
    files, where = _filesystem(spark, folder)
    if not files.exists(where):
        return []
    names = [f.getPath().getName() for f in files.listStatus(where)]
    found = sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))
    done = [n for n in found if not complete or files.exists(_filesystem(spark, f"{folder}/{prefix}{n}/_SUCCESS")[1])]
    return done


def _of_rejects(payload):
    """The payload where it is still needed: facts are whole without it, and need not carry it along."""
    return F.when(F.col("reason").isNotNull(), F.col(payload))


def _unrepeated(messages, payload, arrival, within):
    """Typed messages without those whose id came before, by keyed state with a watermark.

    The watermark is on the time of processing, so no message is late, and an id
    is forgotten `within` after its first arrival. A message without an id of
    its own, or a reject, goes by its payload and arrival.
    """
    typed = ingest.ingest(messages, payload, arrival, own_id="_own_id")
    named = F.when(F.col("reason").isNull(), F.concat(F.lit("i"), "_own_id"))
    content = F.concat_ws("\u0001", F.lit("p"), F.coalesce(payload, F.lit("")), F.col(arrival).cast("string"))
    keyed = typed.withColumns({
        "_id": F.coalesce(named, F.sha2(content, 256)), "_seen": F.current_timestamp(), payload: _of_rejects(payload)})
    return keyed.withWatermark("_seen", within).dropDuplicatesWithinWatermark(["_id"]).drop("_id", "_seen", "_own_id")


def start_ingest(messages, root, payload="payload", arrival="arrival", trigger=None, context=(), pieces=None,
                 unique_within=None):
    """Decode, type and append messages; quarantine rejects; add rollup increments.

    A micro-batch is decoded once and kept for its four outputs, with the payloads
    of rejects only. Its size is bounded by the source (maxOffsetsPerTrigger,
    maxFilesPerTrigger). pieces deals a batch that comes in few pieces out to so
    many tasks; it should grow with that bound (session.pieces_for). unique_within,
    for instance "2 days", drops a message whose id was ingested so long ago or
    less, also before a restart; state is one row an id. Default: none is dropped.
    """
    if unique_within:
        messages = _unrepeated(spread(messages, pieces), payload, arrival, unique_within)

    def write_batch(received, batch_id):
        batch = received if unique_within else ingest.ingest(spread(received, pieces), payload, arrival)
        batch = batch.withColumn(payload, _of_rejects(payload)).persist()
        try:
            facts = ingest.facts(batch)
            write_partitioned(facts, _batch_path(root, FACT, batch_id), "overwrite")
            ingest.quarantine(batch, payload, *context).write.mode("overwrite").parquet(
                _batch_path(root, QUARANTINE, batch_id))
            rollups.summary(facts).write.mode("overwrite").parquet(_batch_path(root, SUMMARY, batch_id))
            rollups.minute_partials(facts).write.mode("overwrite").parquet(_batch_path(root, MINUTES, batch_id))
        finally:
            batch.unpersist()

    return _start(messages, write_batch, root, trigger or {"processingTime": "5 seconds"})


def _read(spark, name, paths, base):
    # Batches without facts leave no data file, so the fact's schema is given and not read from files.
    reader = spark.read.schema(S.FACT_SCHEMA) if name == FACT else spark.read
    return reader.option("basePath", base).parquet(*paths) if paths else None


def read_output(spark, root, name, upto=None):
    """Everything a job has appended to one of its outputs: the newest generation and the batches after it."""
    generation = (_numbers(spark, f"{root}/{name}_compacted", "upto=", complete=True) or [None])[-1]
    batches = [b for b in _numbers(spark, f"{root}/{name}", "batch_id=")
               if (generation is None or b > generation) and (upto is None or b <= upto)]
    parts = []
    if generation is not None:
        path = _generation_path(root, name, generation)
        parts.append(_read(spark, name, [path], path))
    if batches:
        parts.append(_read(spark, name, [_batch_path(root, name, b) for b in batches], f"{root}/{name}"))
    if not parts:
        return _read(spark, name, [f"{root}/{name}"], f"{root}/{name}")
    columns = [c for c in parts[0].columns if c not in ("batch_id", "upto")]
    if name == WINDOWS:  # versions of a window are told apart by their batch
        columns = [*dict.fromkeys([*columns, "version"])]
        parts = [p if "version" in p.columns else p.withColumn("version", F.col("batch_id").cast("bigint")) for p in parts]
    out = parts[0].select(*columns)
    return out if len(parts) == 1 else out.unionByName(parts[1].select(*columns))


def closed_batch(spark, root, name):
    """The newest batch that is surely complete: a later one has begun. None without one."""
    batches = _numbers(spark, f"{root}/{name}", "batch_id=")
    return batches[-2] if len(batches) > 1 else None


_MERGES = {
    SUMMARY: rollups.merge_summary,
    MINUTES: lambda df: rollups.merge(df, ["ingestion_minute"], rollups.MINUTE_PARTS),
    WINDOWS: lambda df: rollups.latest_per_key(df, ["window_start"], "version"),
}


def compact(spark, root, name, upto=None, merge=None):
    """Merge one output up to a closed batch (default: the newest) into a generation; gives that batch's number.

    merge is what a state of another module adds up with.

    Rollups are summed, windows reduced to their newest version, facts laid out
    anew by month. Repeating it, also after a failure, writes the same again.
    """
    upto = closed_batch(spark, root, name) if upto is None else upto
    done = _numbers(spark, f"{root}/{name}_compacted", "upto=", complete=True)
    if upto is None or done and done[-1] >= upto:
        return done[-1] if done else None
    rows = read_output(spark, root, name, upto=upto)
    path = _generation_path(root, name, upto)
    if name == FACT:
        write_partitioned(rows, path, "overwrite")
    else:
        (merge or _MERGES.get(name, lambda df: df))(rows).write.mode("overwrite").parquet(path)
    return upto


def drop_compacted(spark, root, name):
    """Remove the batches and older generations that the newest generation holds. Only when no reader has them open."""
    generations = _numbers(spark, f"{root}/{name}_compacted", "upto=", complete=True)
    if not generations:
        return
    old = [_generation_path(root, name, g) for g in generations[:-1]]
    old += [_batch_path(root, name, b) for b in _numbers(spark, f"{root}/{name}", "batch_id=") if b <= generations[-1]]
    for path in old:
        files, where = _filesystem(spark, path)
        files.delete(where, True)


def current_summary(spark, root):
    return rollups.merge_summary(read_output(spark, root, SUMMARY))


def current_minute_stats(spark, root):
    return rollups.minute_stats(read_output(spark, root, MINUTES))


def start_live(messages, root, payload="payload", arrival="arrival", trigger=None, history=live.BUFFER_ROWS, context=(),
               pieces=None):
    """Append every record of every message, stamped with its arrival; quarantine messages without a record.

    Each batch also leaves the `history` newest records so far, made from the
    history before it and its own records, so the live view reads a bounded table.
    pieces deals out a batch as in start_ingest.
    """
    def write_batch(received, batch_id):
        spark = received.sparkSession
        decoded = decode.decode_lenient(spread(received, pieces), payload).persist()
        try:
            shown = decode.explode_records(decoded).withColumn("_t", ingest.field_texts(F.col("record"), _SHOWN)).select(
                F.col(arrival).alias("received_at"),
                *[F.col(f"_t.{c}").alias(c) for c in _SHOWN],
                F.to_json("record").alias("record"),
                F.col(payload).alias("raw"),
            )
            shown.write.mode("overwrite").parquet(_batch_path(root, LIVE, batch_id))
            # The history is picked from what is written, so records become text once.
            shown = spark.read.schema(shown.schema).parquet(_batch_path(root, LIVE, batch_id))
            decoded.filter(F.size("records") == 0).select(
                F.col(arrival).alias("received_at"), *context, payload, "reason").write.mode("overwrite").parquet(
                _batch_path(root, LIVE_QUARANTINE, batch_id))
            before = [b for b in _numbers(spark, f"{root}/{HISTORY}", "batch_id=") if b < batch_id]
            known = spark.read.parquet(_batch_path(root, HISTORY, before[-1])).unionByName(shown) if before else shown
            live.latest(known, "received_at", "record", history).write.mode("overwrite").parquet(
                _batch_path(root, HISTORY, batch_id))
            for old in before[:-1]:  # the one before stays for a replay of this batch
                files, where = _filesystem(spark, _batch_path(root, HISTORY, old))
                files.delete(where, True)
        finally:
            decoded.unpersist()

    return _start(messages, write_batch, root, trigger or {"processingTime": "2 seconds"})


def current_history(spark, root):
    """The newest records of a live job, at most as many as it was told to keep."""
    newest = _numbers(spark, f"{root}/{HISTORY}", "batch_id=")[-1]
    return spark.read.parquet(_batch_path(root, HISTORY, newest))


def start_sliding_rate(messages, root, arrival="arrival", length="5 minutes", every="1 minute", watermark=None,
                       trigger=None):
    """Message counts per sliding window. State is one row per window.

    Every batch writes the windows it changed; current_sliding_rate keeps the
    newest version of each. A watermark bounds the state of an endless stream;
    without one no message is ever late.
    """
    timed = messages.withWatermark(arrival, watermark) if watermark else messages
    counts = timed.groupBy(F.window(arrival, length, every).alias("w")).agg(F.count(F.lit(1)).alias("messages"))
    flat = counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "messages")

    def write_batch(batch, batch_id):
        batch.write.mode("overwrite").parquet(_batch_path(root, WINDOWS, batch_id))

    return _start(flat, write_batch, root, trigger or {"processingTime": "5 seconds"}, "update")


def current_sliding_rate(spark, root):
    """Newest count per window and the rate per minute over the window's length."""
    newest = rollups.latest_per_key(read_output(spark, root, WINDOWS), ["window_start"], "version")
    minutes = (F.unix_seconds("window_end") - F.unix_seconds("window_start")) / F.lit(60.0)
    return newest.select("window_start", "messages", (F.col("messages") / minutes).alias("per_minute"))


def start_scenario(templates, root, replicas=1, seed=42, trigger=None):
    """Project template rows as they arrive."""
    rows = scenario.scenario(templates, replicas, seed, envelope=False)
    return (
        rows.writeStream.outputMode("append").format("parquet").option("path", f"{root}/scenario")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )


def run_to_end(start, *args, **kwargs):
    """Run a job over everything available now and wait for it."""
    query = start(*args, trigger={"availableNow": True}, **kwargs)
    query.awaitTermination()
    return query
