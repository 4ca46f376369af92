"""Jobs whose outputs are mergeable states: newest versions, counts per second, KPI sums and sets, label counts.

Like the outputs of jobs, increments are named by batch id and overwritten on replay. A summary that is
carried on from batch to batch is made from the one before it, which stays until the next is complete.
"""

from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.operators import clean, dimensions, distincts, labels, live, quality, rollups, sampling
from rateflow.plans import validation
from rateflow.streaming import jobs

LATEST, SECONDS, KPI_SUMS, KPI_SETS = "latest", "seconds", "kpi_sums", "kpi_sets"
SIZES, STRATA, FILL, PROFILE, VERDICT = "sizes", "strata", "fill", "profile", "verdict"


def _write(df, root, name, batch_id):
    df.write.mode("overwrite").parquet(jobs._batch_path(root, name, batch_id))


def _before(spark, root, name, batch_id):
    return [b for b in jobs._numbers(spark, f"{root}/{name}", "batch_id=") if b < batch_id]


def _carry(spark, root, name, batch_id, make):
    """Write a summary made from the newest before this batch (None for the first), and drop those that no replay needs."""
    before = _before(spark, root, name, batch_id)
    known = spark.read.parquet(jobs._batch_path(root, name, before[-1])) if before else None
    _write(make(known), root, name, batch_id)
    for old in before[:-1]:
        files, where = jobs._filesystem(spark, jobs._batch_path(root, name, old))
        files.delete(where, True)


def _newest(spark, root, name):
    return spark.read.parquet(jobs._batch_path(root, name, jobs._numbers(spark, f"{root}/{name}", "batch_id=")[-1]))


# --- newest version per key ----------------------------------------------

def start_latest(rows, root, keys, version, tie_break=(), trigger=None):
    """Upsert rows by key: the newest version stays, whenever an older one arrives. State is one row a key.

    Every batch writes the keys it touched; current_latest merges them.
    """
    state = rollups.latest_state(rows, keys, version, tie_break)
    return jobs._start(state, lambda batch, i: _write(batch, root, LATEST, i), root,
                       trigger or {"processingTime": "5 seconds"}, "update")


def current_latest(spark, root, keys, version, tie_break=()):
    return rollups.latest_state(jobs.read_output(spark, root, LATEST), keys, version, tie_break)


def compact_latest(spark, root, keys, version, tie_break=(), upto=None):
    return jobs.compact(spark, root, LATEST, upto, lambda df: rollups.latest_state(df, keys, version, tie_break))


# --- message rate --------------------------------------------------------

def start_rate(messages, root, arrival="arrival", trigger=None):
    """Append messages per second. Any past instant's rate follows from these, without the messages."""
    return jobs._start(messages, lambda batch, i: _write(live.second_counts(batch, arrival), root, SECONDS, i), root,
                       trigger or {"processingTime": "5 seconds"})


def rate_asof(spark, root, instants, asof="asof", windows=(1, 5)):
    """Messages per minute in trailing windows before each whole second of `instants`."""
    return live.rate_asof(jobs.read_output(spark, root, SECONDS), instants, asof, windows)


def compact_rate(spark, root, upto=None, slots=None):
    """Merge counts per second; slots keeps only the newest seconds, as a ring."""
    merge = live.merge_seconds if slots is None else lambda df: live.ring(df, slots).select("second", "messages")
    return jobs.compact(spark, root, SECONDS, upto, merge)


# --- KPI vector ----------------------------------------------------------

def append_kpi(rows, root, batch_id):
    """Add an increment of typed rows: sums and sets per month, and what the dictionaries of codes lack."""
    spark = rows.sparkSession
    rows = rows.persist()
    try:
        dictionaries = {}
        for domain in distincts.DOMAINS:
            name = f"dictionary_{domain}"
            paths = [jobs._batch_path(root, name, b) for b in _before(spark, root, name, batch_id)]
            known = spark.read.parquet(*paths) if paths else None
            _write(distincts.new_codes(known, rows.select(F.col(domain).alias("code"))), root, name, batch_id)
            dictionaries[domain] = spark.read.parquet(*paths, jobs._batch_path(root, name, batch_id))
        _write(distincts.kpi_sums(rows), root, KPI_SUMS, batch_id)
        _write(distincts.kpi_sets(rows, dictionaries), root, KPI_SETS, batch_id)
    finally:
        rows.unpersist()


def start_kpi(rows, root, trigger=None):
    """Keep the overall KPI vector of a stream of typed rows, distinct counts included, in states of a few rows a month."""
    return jobs._start(rows, lambda batch, i: append_kpi(batch, root, i), root, trigger or {"processingTime": "5 seconds"})


def current_kpi(spark, root, months=None):
    """The overall KPI vector; months, a condition on year and month, picks a slice."""
    sums, sets = (jobs.read_output(spark, root, name) for name in (KPI_SUMS, KPI_SETS))
    if months is not None:
        sums, sets = sums.where(months), sets.where(months)
    return distincts.kpi_overall(sums, sets)


def compact_kpi(spark, root, upto=None):
    """Merge the increments; the dictionaries, which the next batch reads, stay as they are."""
    jobs.compact(spark, root, KPI_SETS, upto, lambda df: distincts.merge_sets(df, ["year", "month", "domain"]))
    return jobs.compact(spark, root, KPI_SUMS, upto, lambda df: rollups.merge(df, ["year", "month"], distincts.SUMMED))


# --- labels --------------------------------------------------------------

def add_labels(rows, root, batch_id, size=labels.SIZE):
    """Add the label counts of an increment, and carry on the summaries."""
    spark = rows.sparkSession
    for code in S.LABELS:
        _write(labels.count_labels(rows, code), root, f"labels_{code}", batch_id)
        counts = spark.read.parquet(jobs._batch_path(root, f"labels_{code}", batch_id))
        _carry(spark, root, f"summary_{code}", batch_id, lambda known, counts=counts: labels.summarize(counts, known, size))


def start_labels(rows, root, size=labels.SIZE, trigger=None):
    """Count the labels of every code, and carry on a bounded summary of each code's most frequent ones."""
    return jobs._start(rows, lambda batch, i: add_labels(batch, root, i, size), root, trigger or {"processingTime": "5 seconds"})


def current_labels(spark, root, code):
    """code, label and n, named as in the rows: what multi_label_codes and mismatches(weight="n") read."""
    counts = labels.merge_counts(jobs.read_output(spark, root, f"labels_{code}"))
    return counts.select(F.col("code").alias(code), F.col("label").alias(S.LABELS[code]), "n")


def current_canonical(spark, root, code):
    """The canonical label of every code so far."""
    found = labels.canonical(jobs.read_output(spark, root, f"labels_{code}"), _newest(spark, root, f"summary_{code}"))
    return found.select(F.col("code").alias(code), F.col("label").alias(S.LABELS[code]))


def current_mismatches(spark, root, code):
    """(domain, code, label, expected, n) of labels that are not canonical so far."""
    return dimensions.mismatches(current_labels(spark, root, code), current_canonical(spark, root, code), code, "n")


def compact_labels(spark, root, upto=None):
    return {code: jobs.compact(spark, root, f"labels_{code}", upto, labels.merge_counts) for code in S.LABELS}


# --- template sample -----------------------------------------------------

def append_templates(rows, root, batch_id, size, seed=42):
    """Add an increment to the sample's state: at most `size` rows, one row an airport, and counts."""
    _write(sampling.size_counts(rows), root, SIZES, batch_id)
    _write(sampling.strata_state(rows, seed), root, STRATA, batch_id)
    _write(sampling.fill_state(rows, size, seed), root, FILL, batch_id)


def start_templates(rows, root, size, seed=42, trigger=None):
    """Keep a template sample of a stream; size bounds any sample that will be asked for."""
    return jobs._start(rows, lambda batch, i: append_templates(batch, root, i, size, seed), root,
                       trigger or {"processingTime": "5 seconds"})


def current_templates(spark, root, size, seed=42):
    """average_year_templates of all rows so far."""
    return sampling.templates_from_states(*[jobs.read_output(spark, root, n) for n in (SIZES, STRATA, FILL)], size, seed=seed)


def compact_templates(spark, root, size, seed=42, upto=None):
    jobs.compact(spark, root, STRATA, upto, lambda df: sampling.strata_state(df, seed))
    jobs.compact(spark, root, FILL, upto, lambda df: sampling.fill_state(df, size, seed))
    return jobs.compact(spark, root, SIZES, upto, lambda df: rollups.merge(df, ["year", "airport", "usable"], ["n"]))


# --- validation ----------------------------------------------------------

def add_profile(rows, reference, root, batch_id):
    """Add the profile of an increment, and judge all rows up to it against a validation.Reference."""
    spark = rows.sparkSession
    _write(validation.profile(clean.normalize(rows)), root, PROFILE, batch_id)
    whole = validation.merge_profiles(jobs.read_output(spark, root, PROFILE, upto=batch_id))
    whole = validation.settle(whole, "profile")
    _write(validation.assess_profile(reference, whole).status(), root, VERDICT, batch_id)


def start_validation(rows, reference, root, trigger=None):
    """Validate a stream of generated rows as it grows. Every batch leaves the verdict over all rows so far."""
    missing = quality.missing_columns(rows)
    if missing:
        raise ValueError(f"the stream lacks required columns: {missing}")
    return jobs._start(rows, lambda batch, i: add_profile(batch, reference, root, i), root,
                       trigger or {"processingTime": "30 seconds"})


def verdicts(spark, root):
    """batch, status, errors and warnings after every batch."""
    base = f"{root}/{VERDICT}"
    return spark.read.option("basePath", base).parquet(base).select(
        F.col("batch_id").cast("bigint").alias("batch"), "status", "errors", "warnings")


def current_verdict(spark, root):
    """status, errors and warnings over all rows so far, and first_failed, the first batch whose verdict was FAIL."""
    return verdicts(spark, root).agg(
        F.max_by(F.struct("status", "errors", "warnings"), "batch").alias("v"),
        F.min(F.when(F.col("status") == validation.FAIL, F.col("batch"))).alias("first_failed")).select("v.*", "first_failed")
