"""The registered queries: each reads whole driver tables through the adapter and runs library operators.

Doubles are rounded for comparison, since engines add them up in different orders.
"""

from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.functions import draws, scalars
from rateflow.operators import (
    clean, compare, cube, decode, dimensions, ingest, kpi, live, quality, rollups, sampling, scenario, seasonality)
from rateflow.plans import validation
from rateflow.session import pieces_for, settle, spread, work_path
from rateflow.sources import files, messages, star
from rateflow.streaming import jobs, states

YEAR = 2000
MONTHS = [1, 2, 3, 6, 11]
SEED = 7
#: The least tasks for the events table, whose rows become messages at a cost far above their size.
PIECES = 8


def tidy(df, digits=6):
    """Whole numbers as bigint, doubles rounded, timestamps without zone."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind in ("byte", "short", "integer", "long"):
            c = c.cast("bigint")
        elif kind in ("float", "double"):
            c = F.round(c.cast("double"), digits)
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def _clean(spark, d):
    return star.observations(spark, d)


def _stored(spark, d):
    """The observations as a stored table, for jobs that read their input several times."""
    return settle(star.observations(spark, d), "observations")


def _parts(spark, d):
    return star.split(_stored(spark, d))


def _dirty(spark, d):
    return star.dirty(spark, d)


def _dirty_parts(spark, d):
    return star.split_dirty(settle(star.dirty(spark, d), "observations"))


def _dirty_original(spark, d):
    return star.split_dirty(star.dirty(spark, d))[0]


def _events(spark, d):
    return star.event_observations(star.read_events(spark, d))


def _pieces(spark, d):
    return pieces_for(star.read_events(spark, d), PIECES)


def _dealt_events(spark, d):
    return spread(star.read_events(spark, d), _pieces(spark, d))


def _messages(spark, d):
    return star.event_messages(_dealt_events(spark, d))


# --- files ---------------------------------------------------------------

def src_csv(spark, d):
    path = work_path(spark, "csv")
    files.write_csv(star.dirty_text(spark, d).select(*S.REQUIRED), path)
    return tidy(clean.normalize(files.read_csv(spark, path)))


def src_ndjson(spark, d):
    path = work_path(spark, "ndjson")
    lines = _messages(spark, d).select(F.when(F.pmod("event_id", F.lit(13)) == 0, "  ").otherwise(F.col("payload")))
    lines.write.text(path)
    parsed = files.read_json_lines(spark, path, ["id", "carrier", "arr_flights"])
    return parsed.groupBy("bad", "carrier").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("arr_flights").try_cast("bigint")).alias("arr_flights"))


def src_ndjson_all(spark, d):
    """Records with fields beyond the required ones, blank and bad lines among them; all fields are found in one pass."""
    path = work_path(spark, "ndjson")
    events, n = star.event_observations(_dealt_events(spark, d)), F.col("event_id")
    extra = F.struct(
        "event_id", *S.REQUIRED, F.when(n % 5 == 0, n).alias("sequence_number"),
        F.when(n % 7 == 0, F.struct(n.alias("inner"))).alias("odd name"), F.when(n % 3 == 0, F.col("id")).alias("message_id"))
    line = F.when(n % 13 == 0, " ").when(n % 11 == 0, "{broken").otherwise(F.to_json(extra))
    events.select(line).write.text(path)
    records, bad = files.load_json_lines(spark, path)
    counted = [F.count(F.col(f"`{c}`")).alias(f"n_{c.replace(' ', '_')}") for c in ("odd name", "message_id", "sequence_number")]
    return tidy(records.groupBy("carrier").agg(
        F.count(F.lit(1)).alias("n"), *counted, F.sum(F.col("sequence_number").cast("bigint")).alias("sequence"),
        F.max("odd name").alias("odd"), F.sum(F.col("arr_flights").cast("bigint")).alias("arr_flights")
    ).withColumns({"bad": F.lit(bad), "columns": F.lit(len(records.columns))}))


def sink_partitioned(spark, d):
    path = work_path(spark, "fact")
    files.write_partitioned(_clean(spark, d), path)
    return tidy(spark.read.parquet(path).select(*S.REQUIRED))


def sink_csv(spark, d):
    path = work_path(spark, "dimension")
    files.write_csv(dimensions.canonical(_clean(spark, d), "airport").orderBy("airport"), path)
    return files.read_csv(spark, path)


def sink_ndjson(spark, d):
    path = work_path(spark, "jsonlines")
    rows = _dirty(spark, d)
    files.write_json_lines(rows.drop("is_generated"), path)
    records, _ = files.load_json_lines(spark, path)
    return tidy(clean.normalize(records))


def encode_messages(spark, d):
    events = star.event_observations(_dealt_events(spark, d))
    keyed = events.withColumn("kafka_key", messages.message_key(F.col("arrival")))
    encoded = messages.encode_messages(keyed.drop("event_id", "arrival"))
    decoded = ingest.ingest(encoded, "value")
    return tidy(decoded.filter(F.col("reason").isNull()).select("key", *S.WIRE_COLUMNS))


def sink_report(spark, d):
    """The written report of a dirty run, read back."""
    path = work_path(spark, "report")
    files.write_report(validation.assess(*_dirty_parts(spark, d)).report(), path)
    report = spark.read.json(path)
    return tidy(report.select("status", F.size("errors").alias("errors"), F.size("generated_warnings").alias("warnings"),
                              F.col("powerbi_outputs.dim_carrier_csv").isNull().alias("stopped"), "original.total_flights"))


def decode_bytes(spark, d):
    """Message bytes, some of them no UTF-8: strict reading leaves those missing, lenient reading replaces what is wrong."""
    n = F.col("event_id")
    text = F.concat(F.lit("é-"), n.cast("string"))
    odd = F.when(n % 3 == 0, F.unhex(F.lit("FF"))).when(n % 3 == 1, F.unhex(F.lit("C328"))).otherwise(F.unhex(F.lit("E282AC")))
    read = star.read_events(spark, d).select("event_id", F.concat(F.encode(text, "UTF-8"), odd).alias("value"))
    return tidy(read.select("event_id", messages.decoded_text(F.col("value")).alias("strict"),
                            messages.decoded_text(F.col("value"), strict=False).alias("lenient")))


def ingest_clock(spark, d):
    """Without an arrival column, facts get the time of ingestion in whole seconds."""
    now = F.date_trunc("second", F.current_timestamp())
    facts = ingest.facts(ingest.ingest(_messages(spark, d)))
    stamp = F.col("ingestion_timestamp")
    return tidy(facts.groupBy((stamp == now).alias("now"), (stamp == F.date_trunc("second", stamp)).alias("whole")).agg(
        F.count(F.lit(1)).alias("n")))


# --- decoding and typing -------------------------------------------------

def ingest_strict(spark, d):
    return tidy(ingest.facts(ingest.ingest(_messages(spark, d), arrival="arrival")))


def ingest_tokens(spark, d):
    decoded = decode.decode_strict(_messages(spark, d))
    fields = ["id", "carrier_name", "airport_name", "arr_flights"]
    return decoded.filter(F.col("record").isNotNull()).select("event_id", *[ingest.field_text(F.col("record"), c).alias(c) for c in fields])


def ingest_lenient(spark, d):
    decoded = decode.decode_lenient(_messages(spark, d))
    records = decode.explode_records(decoded)
    return records.select("event_id", *[
        ingest.field_text(F.col("record"), c).alias(c) for c in ["id", "carrier", "arr_flights"]])


def coerce_numeric(spark, d):
    """Texts in many notations, made from event values, through the three coercions."""
    events = star.read_events(spark, d)
    v, slot = F.col("value"), F.pmod("event_id", F.lit(8))
    whole = F.floor(v).cast("bigint").cast("string")
    text = (
        F.when(slot == 0, F.concat(whole, F.lit(".9"))).when(slot == 1, F.concat(F.lit("-"), whole))
        .when(slot == 2, F.lit("")).when(slot == 3, F.concat(whole, F.lit("e3")))
        .when(slot == 4, F.concat(whole, F.lit("e12"))).when(slot == 5, F.lit("nan"))
        .when(slot == 6, F.concat(F.lit(" "), whole, F.lit("_0 "))).otherwise(F.concat(whole, F.lit("d"))))
    number = scalars.number_from_text(F.col("text"))
    return tidy(events.select("event_id", text.alias("text")).select(
        "event_id",
        scalars.to_uint(number, S.UINT32_MAX).alias("as_uint32"),
        scalars.to_uint(number, S.UINT8_MAX).alias("as_uint8"),
        scalars.to_nonneg(number).alias("as_float")))


def record_id(spark, d):
    c = {k: F.col(k).cast("string") for k in S.KEYS}
    return tidy(_clean(spark, d).select(
        *S.KEYS, ingest.fallback_id(c["year"], c["month"], c["carrier"], c["airport"]).alias("record_id")))


def ingest_quarantine(spark, d):
    rejected = ingest.quarantine(ingest.ingest(_messages(spark, d), arrival="arrival"), "event_id")
    return tidy(rejected)


def partition_key(spark, d):
    key = scalars.month_partition(F.col("year"), F.col("month")).alias("partition_key")
    return tidy(_clean(spark, d).groupBy(key).agg(F.count(F.lit(1)).alias("n")))


# --- cleaning and filters ------------------------------------------------

def normalize(spark, d):
    return tidy(_dirty(spark, d).drop("is_generated"))


def clean_reference(spark, d):
    return tidy(clean.clean_reference(_dirty_original(spark, d)))


def clean_notes(spark, d):
    return tidy(clean.clean_counts(_dirty_original(spark, d)))


def fill_missing_cols(spark, d):
    narrow = _clean(spark, d).select(*[c for c in S.REQUIRED if c not in ("security_ct", "arr_diverted")])
    return tidy(clean.fill_missing_columns(narrow).select(*S.REQUIRED))


def safe_ratio(spark, d):
    c = {n: F.col(n) for n in ("arr_del15", "arr_delay")}
    return tidy(_clean(spark, d).select(
        *S.KEYS, scalars.ratio_zero(c["arr_delay"], c["arr_del15"]).alias("zero_ratio"),
        scalars.ratio_null(c["arr_delay"], c["arr_del15"]).alias("null_ratio")))


def month_labels(spark, d):
    return tidy(_dirty(spark, d).select("month").distinct().filter("month is not null").select(
        "month", scalars.month_name(F.col("month")).alias("month_name"),
        scalars.month_label(F.col("month")).alias("month_label")))


def years_last5(spark, d):
    return tidy(clean.filter_years(_stored(spark, d), "last5"))


def years_range(spark, d):
    return tidy(clean.filter_years(_clean(spark, d), (1999, 1997)))


def valid_records(spark, d):
    return tidy(clean.valid_records(_dirty(spark, d).drop("is_generated")))


def valid_counts(spark, d):
    return tidy(clean.valid_counts(_dirty(spark, d)))


def slicer_values(spark, d):
    return tidy(clean.slicer_values(_clean(spark, d)))


# --- KPIs ----------------------------------------------------------------

def kpi_slice(spark, d):
    return tidy(kpi.overview(_clean(spark, d), YEAR, MONTHS))


def kpi_overall(spark, d):
    return tidy(kpi.overall(clean.valid_records(_dirty(spark, d))))


def kpi_by_month(spark, d):
    return tidy(kpi.by_month(_clean(spark, d)))


def kpi_month_spine(spark, d):
    return tidy(kpi.on_month_spine(kpi.by_month(_clean(spark, d))))


def kpi_compare(spark, d):
    original, generated = _parts(spark, d)
    return tidy(compare.compare(kpi.overall_long(original), kpi.overall_long(generated)))


def delay_rate_by_month(spark, d):
    return tidy(kpi.delay_rate_by_month(_clean(spark, d), YEAR))


def cause_breakdown(spark, d):
    return tidy(kpi.cause_breakdown(_clean(spark, d), YEAR, MONTHS))


def top_carriers(spark, d):
    return tidy(kpi.top_by_delay(_clean(spark, d), "carrier", YEAR, MONTHS))


def top_airports(spark, d):
    return tidy(kpi.top_by_delay(_clean(spark, d), "airport", YEAR, []))


def month_mean_index(spark, d):
    return tidy(kpi.month_mean_index(kpi.by_month(_clean(spark, d))))


# --- rollups -------------------------------------------------------------

def rollup_summary(spark, d):
    return tidy(rollups.summary(_clean(spark, d)))


def rollup_carrier(spark, d):
    return tidy(rollups.finish_performance(rollups.performance(_clean(spark, d), "carrier")))


def rollup_airport(spark, d):
    return tidy(rollups.finish_performance(rollups.performance(_clean(spark, d), "airport")))


def rollup_incremental(spark, d):
    """The summary built from one increment per calendar half, merged on read."""
    rows = _stored(spark, d)
    first, second = rows.filter("month <= 6"), rows.filter("month > 6")
    return tidy(rollups.merge_summary(rollups.summary(first).unionByName(rollups.summary(second))))


def minute_stats_partial(spark, d):
    return tidy(rollups.minute_partials(_events(spark, d), "arrival"))


def minute_stats(spark, d):
    return tidy(rollups.minute_stats(rollups.minute_partials(_events(spark, d), "arrival")))


def _asof(spark, d):
    return _events(spark, d).agg(F.max("arrival")).scalar()


def minute_stats_last_hour(spark, d):
    partials = rollups.minute_partials(_events(spark, d), "arrival")
    return tidy(rollups.minute_stats(rollups.last_minutes(partials, _asof(spark, d))))


def latest_per_key(spark, d):
    return tidy(rollups.latest_per_key(
        star.read_events(spark, d).select("user_id", "event_type", "event_id", "ts", "value"),
        ["user_id"], "ts", ["event_id"]))


# --- dimensions and labels -----------------------------------------------

def canonical_carrier(spark, d):
    return dimensions.canonical(_dirty_original(spark, d), "carrier")


def canonical_airport(spark, d):
    return dimensions.canonical(_dirty_original(spark, d), "airport")


def _with_dimensions(spark, d):
    original, generated = _dirty_parts(spark, d)
    return generated, dimensions.canonical(original, "carrier"), dimensions.canonical(original, "airport"), original


def canonicalize(spark, d):
    generated, carriers, airports, _ = _with_dimensions(spark, d)
    measured = dimensions.measure(carriers, "carrier"), dimensions.measure(airports, "airport")
    return tidy(dimensions.canonicalize(generated, *measured))


def canonicalize_notes(spark, d):
    generated, carriers, airports, _ = _with_dimensions(spark, d)
    return tidy(dimensions.canonicalized_counts(generated, carriers, airports))


def _mismatches(spark, d):
    generated, carriers, airports, _ = _with_dimensions(spark, d)
    return dimensions.mismatches(generated, carriers, "carrier").unionByName(
        dimensions.mismatches(generated, airports, "airport"))


def name_mismatch(spark, d):
    return tidy(_mismatches(spark, d).groupBy("domain").agg(F.sum("n").alias("n")))


def name_mismatch_examples(spark, d):
    return tidy(dimensions.first_per_domain(_mismatches(spark, d), ["code", "label"], 8))


def domain_unknown(spark, d):
    original, generated = _dirty_parts(spark, d)
    codes = dimensions.unknown_codes(generated, original, "airport").unionByName(
        dimensions.unknown_codes(generated, original, "carrier"))
    return tidy(dimensions.summarize_codes(codes).withColumn("examples", F.array_join("examples", ",")))


def noisy_names(spark, d):
    generated = _dirty_parts(spark, d)[1]
    return tidy(dimensions.multi_label_codes(generated, "airport").unionByName(
        dimensions.multi_label_codes(generated, "carrier")))


# --- seasonality ---------------------------------------------------------

def seasonal_index(spark, d):
    return tidy(seasonality.seasonal_index(_clean(spark, d)))


def seasonal_compare(spark, d):
    original, generated = _parts(spark, d)
    return tidy(seasonality.compare(seasonality.seasonal_index(original), seasonality.seasonal_index(generated)))


# --- quality and validation ----------------------------------------------

def dq_null_counts(spark, d):
    return tidy(quality.null_counts(_dirty(spark, d)))


def dq_violations(spark, d):
    return tidy(quality.violation_counts(_dirty(spark, d)))


def dq_findings(spark, d):
    original, generated = _dirty_parts(spark, d)
    found = quality.dataset_findings(clean.clean_reference(original), "ORIGINAL").unionByName(
        quality.dataset_findings(generated, "GENERATED"))
    return tidy(found.drop("ord"))


def validation_status(spark, d):
    original, generated = _parts(spark, d)
    clean_run = validation.assess(original, generated).status().select(F.lit("clean").alias("run"), "*")
    original, generated = _dirty_parts(spark, d)
    dirty_run = validation.assess(original, generated).status().select(F.lit("dirty").alias("run"), "*")
    return tidy(clean_run.unionByName(dirty_run))


def validation_report(spark, d):
    original, generated = _parts(spark, d)
    return validation.assess(original, generated, "last5").report()


def validation_lines(spark, d):
    """All lines of the reports of a clean run over the last five years and of a dirty run, in long form."""
    clean_run = validation.assess(*_parts(spark, d), "last5").lines
    dirty_run = validation.assess(*_dirty_parts(spark, d)).lines
    return tidy(clean_run.select(F.lit("clean").alias("run"), "*").unionByName(dirty_run.select(F.lit("dirty").alias("run"), "*")))


# --- sampling and scenario -----------------------------------------------

def avg_rows_per_year(spark, d):
    return tidy(sampling.avg_rows_per_year(_clean(spark, d)))


def templates_stratified(spark, d):
    return tidy(sampling.average_year_templates(_stored(spark, d), seed=SEED))


def uniform_draws(spark, d):
    events = star.read_events(spark, d)
    key = [F.col("event_id"), F.lit(1)]
    return tidy(events.select("event_id", *[draws.uniform(key, SEED, i).alias(f"u{i}") for i in (1, 2, 4, 5, 15)]), 9)


def _event_templates(events):
    return star.event_observations(events).withColumn("template_id", F.col("event_id"))


def scenario_rows(spark, d):
    return tidy(scenario.scenario(_event_templates(_dealt_events(spark, d)), 2, SEED, envelope=False))


def apportion(spark, d):
    """Rounded parts of an observation against targets near their sum."""
    rows = _events(spark, d)
    parts = [F.col(c) for c in S.CAUSE_MINUTES]
    target = F.greatest(F.lit(0), F.col("arr_delay") + F.pmod("event_id", F.lit(61)) - 30)
    adjusted = scenario.apportion(parts, target)
    return tidy(rows.select("event_id", target.alias("target"), *[p.alias(f"part{i}") for i, p in enumerate(adjusted)]))


# --- live and streaming --------------------------------------------------

def live_latest(spark, d):
    return tidy(live.latest(_events(spark, d), "arrival", "event_id"))


def live_buffer(spark, d):
    return tidy(live.buffer(_events(spark, d), "arrival", "event_id"))


def live_status(spark, d):
    return tidy(live.status(live.buffer(_events(spark, d), "arrival", "event_id"), "arrival"))


def live_rate(spark, d):
    return tidy(live.message_rate(_events(spark, d), "arrival", _asof(spark, d), (1, 5, 600)))


def _stream_messages(spark, d):
    return star.event_messages(star.stream_events(spark, d))


def _run_ingest(spark, d):
    root = work_path(spark, "ingest")
    jobs.run_to_end(jobs.start_ingest, _stream_messages(spark, d), root, context=["event_id"], pieces=_pieces(spark, d))
    return root


def stream_ingest(spark, d):
    return tidy(jobs.read_output(spark, _run_ingest(spark, d), jobs.FACT).select(*S.WIRE_COLUMNS))


def stream_rollup(spark, d):
    root = _run_ingest(spark, d)
    jobs.compact(spark, root, jobs.SUMMARY, upto=0)
    return tidy(jobs.current_summary(spark, root))


def stream_minute_stats(spark, d):
    return tidy(jobs.current_minute_stats(spark, _run_ingest(spark, d)))


def _run_live(spark, d):
    root = work_path(spark, "live")
    jobs.run_to_end(jobs.start_live, _stream_messages(spark, d), root, context=["event_id"], pieces=_pieces(spark, d))
    return root


def stream_live(spark, d):
    rows = jobs.read_output(spark, _run_live(spark, d), jobs.LIVE)
    return tidy(rows.select("received_at", "id", "carrier", "airport"))


def live_quarantine(spark, d):
    return tidy(jobs.read_output(spark, _run_live(spark, d), jobs.LIVE_QUARANTINE).select("event_id", "reason"))


def stream_sliding_rate(spark, d):
    root = work_path(spark, "rate")
    jobs.run_to_end(jobs.start_sliding_rate, star.event_observations(star.stream_events(spark, d)), root)
    return tidy(jobs.current_sliding_rate(spark, root))


def _replayed(spark, rows, start, root, copies=1, files=3, **kwargs):
    """Rows as files of a stream, a few files a batch; each copy of the files comes after a restart of the job."""
    folder = work_path(spark, "arriving")
    for _ in range(copies):
        rows.repartition(files).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(folder)
        jobs.run_to_end(start, stream, root, **kwargs)
    return root


def stream_ingest_unique(spark, d):
    """All messages twice, with a restart between the copies; every id is stored once."""
    root = work_path(spark, "unique")
    messages = settle(_messages(spark, d), "messages")
    pieces = max(PIECES, _pieces(spark, d) * 2 // PIECES)  # a batch is two of the files
    _replayed(spark, messages, jobs.start_ingest, root, copies=2, files=PIECES, unique_within="1 day", pieces=pieces)
    return tidy(jobs.read_output(spark, root, jobs.FACT).select(*S.WIRE_COLUMNS))


def stream_latest(spark, d):
    """The newest event of every user, whose events come in no order; compacted half-way."""
    root, by = work_path(spark, "latest"), (["user_id"], "ts", ["event_id"])
    events = star.read_events(spark, d).select("user_id", "event_type", "event_id", "ts", "value")
    _replayed(spark, events, lambda s, r, **k: states.start_latest(s, r, *by, **k), root)
    states.compact_latest(spark, root, *by, upto=0)
    return tidy(states.current_latest(spark, root, *by))


def stream_rate_asof(spark, d):
    """Rates before every full hour that has messages."""
    root = work_path(spark, "seconds")
    events = star.event_observations(star.read_events(spark, d))
    _replayed(spark, events.select("arrival"), states.start_rate, root)
    states.compact_rate(spark, root, upto=0)
    hours = events.select((F.date_trunc("hour", "arrival") + F.expr("INTERVAL 1 HOUR")).alias("as_of"))
    return tidy(states.rate_asof(spark, root, hours, "as_of", (1, 5, 600)))


def kpi_overall_incremental(spark, d):
    """The KPI vector from one increment per calendar half; the halves share airports and carriers."""
    root, rows = work_path(spark, "kpi"), settle(clean.valid_records(_dirty(spark, d)), "observations")
    states.append_kpi(rows.where("month <= 6"), root, 0)
    states.append_kpi(rows.where("month > 6"), root, 1)
    states.compact_kpi(spark, root, upto=0)
    return tidy(states.current_kpi(spark, root))


def _streamed_labels(spark, d):
    root = work_path(spark, "labels")
    rows = _dirty_original(spark, d).select(*S.TEXT_COLUMNS)
    _replayed(spark, rows, states.start_labels, root, files=5, size=4)
    states.compact_labels(spark, root, upto=0)
    return root


def templates_incremental(spark, d):
    """The template sample from the states of three increments, two of them merged."""
    root, rows, size = work_path(spark, "templates"), _stored(spark, d), 100_000
    for batch, part in enumerate(["month > 8", "month <= 4", "month BETWEEN 5 AND 8"]):
        states.append_templates(rows.where(part), root, batch, size, SEED)
    states.compact_templates(spark, root, size, SEED)
    return tidy(states.current_templates(spark, root, size, SEED))


def stream_validation(spark, d):
    """Clean and dirty generated rows as streams of two batches; the last verdict is that over all rows."""
    out = []
    for run, (original, generated) in (("clean", _parts(spark, d)), ("dirty", _dirty_parts(spark, d))):
        root, reference = work_path(spark, "running"), validation.Reference.of(original)
        _replayed(spark, generated, lambda s, r, reference=reference, **k: states.start_validation(s, reference, r, **k), root)
        out.append(states.current_verdict(spark, root).select(F.lit(run).alias("run"), "status", "errors", "warnings"))
    return tidy(out[0].unionByName(out[1]))


def _cube(spark, d, keys):
    """A grain of the cube, which is stored from two increments."""
    path, rows = work_path(spark, "cube"), _stored(spark, d)
    parts = [cube.build(rows.where(p)) for p in ("month <= 6", "month > 6")]
    cube.write(cube.merge(parts[0].unionByName(parts[1])), path)
    return cube.read(spark, path, keys)


def cube_kpi_slice(spark, d):
    return tidy(kpi.overview(_cube(spark, d, ["year", "month"]), YEAR, MONTHS))


def cube_top_airports(spark, d):
    return tidy(kpi.top_by_delay(_cube(spark, d, ["year", "airport"]), "airport", YEAR, []))


def cube_top_carriers(spark, d):
    return tidy(kpi.top_by_delay(_cube(spark, d, ["year", "month", "carrier"]), "carrier", YEAR, MONTHS))


def cube_causes(spark, d):
    return tidy(kpi.cause_breakdown(_cube(spark, d, ["year", "month"]), YEAR, MONTHS))


def cube_slicer_values(spark, d):
    return tidy(clean.slicer_values(_cube(spark, d, ["year", "month"])))


def stream_canonical(spark, d):
    return states.current_canonical(spark, _streamed_labels(spark, d), "airport")


def stream_mismatch(spark, d):
    root = _streamed_labels(spark, d)
    return tidy(states.current_mismatches(spark, root, "airport").unionByName(states.current_mismatches(spark, root, "carrier")))


def stream_scenario(spark, d):
    root = work_path(spark, "scenario")
    jobs.run_to_end(jobs.start_scenario, _event_templates(star.stream_events(spark, d)), root, seed=SEED)
    rows = spark.read.parquet(f"{root}/scenario")
    return tidy(rows.select("template_id", *S.PERIOD, *S.TEXT_COLUMNS, *S.MEASURES))


ALL = {f.__name__: f for f in [
    src_csv, src_ndjson, stream_ingest, sink_partitioned, sink_csv, sink_ndjson, validation_report, encode_messages,
    ingest_strict, ingest_tokens, ingest_lenient, coerce_numeric, record_id, ingest_quarantine, partition_key,
    normalize, clean_reference, clean_notes, fill_missing_cols, safe_ratio, month_labels, cause_breakdown, kpi_slice,
    years_last5, years_range, valid_records, minute_stats_last_hour, kpi_month_spine, canonicalize, domain_unknown,
    kpi_compare, seasonal_compare, delay_rate_by_month, top_carriers, top_airports, rollup_summary, rollup_carrier,
    rollup_airport, minute_stats_partial, minute_stats, kpi_overall, kpi_by_month, dq_null_counts, dq_violations,
    canonical_carrier, canonical_airport, noisy_names, seasonal_index, month_mean_index, latest_per_key,
    rollup_incremental, avg_rows_per_year, valid_counts, slicer_values, name_mismatch, name_mismatch_examples,
    canonicalize_notes, templates_stratified, live_latest, live_buffer, live_status, stream_minute_stats, live_rate,
    stream_sliding_rate, stream_rollup, stream_live, live_quarantine, stream_scenario, validation_status, dq_findings, uniform_draws,
    apportion, stream_ingest_unique, stream_latest, stream_rate_asof, kpi_overall_incremental, stream_canonical,
    stream_mismatch, src_ndjson_all, templates_incremental, stream_validation, cube_kpi_slice, cube_top_airports,
    cube_top_carriers, cube_causes, cube_slicer_values, validation_lines,
    sink_report, decode_bytes, ingest_clock,
]}
ALL["scenario"] = scenario_rows
