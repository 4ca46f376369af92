"""States that streams keep: each equals the batch result, in any order of increments, after restarts and compaction."""

import pytest
from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.operators import cube, dimensions, distincts, ingest, kpi, labels, live, rollups, sampling
from rateflow.plans import validation
from rateflow.session import settle, work_path
from rateflow.sources import star
from rateflow.streaming import jobs, states
from tests.helpers import collected, observations, one, same_rows


def _steps(spark, rows, start, root, parts, between=lambda n: None, **kwargs):
    """Give a job its rows in parts, each after a restart, with something done between them."""
    folder = work_path(spark, "arriving")
    for n, condition in enumerate(parts):
        rows.where(condition).repartition(2).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        jobs.run_to_end(start, stream, root, **kwargs)
        between(n)


# --- unique ingest -------------------------------------------------------

def _messages(spark, rows):
    return spark.createDataFrame(rows, "payload string, seconds int").select(
        "payload", F.timestamp_seconds("seconds").alias("arrival"))


def test_copies_are_dropped_across_a_restart_and_only_copies(spark):
    a, b = '{"id":"a","arr_flights":1}', '{"id":"b","arr_flights":2}'
    nameless = '{"year":2025,"arr_flights":3}'
    rows = _messages(spark, [(a, 10), (b, 10), (nameless, 10), (nameless, 11), ("bad", 10), (None, 10)])
    again = _messages(spark, [(a, 900), (b, 5), (nameless, 10), (nameless, 12), ("bad", 10), ("bad", 13), (None, 10), (None, 14)])
    folder, root = work_path(spark, "messages"), work_path(spark, "test")
    for part in (rows, again):
        part.repartition(3).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        jobs.run_to_end(jobs.start_ingest, stream, root, unique_within="1 day")
    facts = jobs.read_output(spark, root, jobs.FACT)
    assert collected(facts, "arr_flights") == [(1,), (2,), (3,), (3,), (3,)]
    bad = jobs.read_output(spark, root, jobs.QUARANTINE)
    assert bad.where("payload = 'bad'").count() == 2 and bad.where("payload IS NULL").count() == 2
    assert one(jobs.current_summary(spark, root).where("year = 2025"))["total_flights"] == 9


def test_facts_go_into_the_state_without_their_payload(spark):
    rows = _messages(spark, [('{"id":"a","arr_flights":1}', 10), ('{"id":"a","arr_flights":1}', 11), ("bad", 10), ("bad", 12)])
    folder, out = work_path(spark, "messages"), work_path(spark, "test")
    rows.write.parquet(folder)
    unrepeated = jobs._unrepeated(spark.readStream.schema(rows.schema).parquet(folder), "payload", "arrival", "1 day")
    unrepeated.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").trigger(
        availableNow=True).start(f"{out}/rows").awaitTermination()
    kept = spark.read.parquet(f"{out}/rows")
    assert sorted((r.payload or "", r.reason or "") for r in kept.collect()) == [("", "")] + [("bad", "invalid_json")] * 2


def test_without_the_option_copies_stay(spark, sf_dir):
    messages = settle(star.event_messages(star.read_events(spark, sf_dir)).limit(60), "messages")
    root = work_path(spark, "test")
    _steps(spark, messages, jobs.start_ingest, root, ["true", "true"])
    facts = ingest.facts(ingest.ingest(messages, arrival="arrival"))
    assert jobs.read_output(spark, root, jobs.FACT).count() == 2 * facts.count()


# --- latest --------------------------------------------------------------

@pytest.fixture(scope="module")
def versions(spark):
    rows = [(k, v, n, f"{k}-{v}-{n}") for k in ("x", "y", None) for v in (3, 1, 2, 3, None) for n in (5, -5, None)]
    return settle(spark.createDataFrame(rows, "k string, v int, n bigint, payload string"), "versions")


def test_latest_state_equals_ranking(spark, versions, sf_dir):
    assert same_rows(rollups.latest_state(versions, ["k"], "v", ["n"]), rollups.latest_per_key(versions, ["k"], "v", ["n"]))
    events = star.read_events(spark, sf_dir)
    for tie in ("event_id", "value", "ts"):
        assert same_rows(rollups.latest_state(events, ["user_id"], "ts", [tie]), rollups.latest_per_key(events, ["user_id"], "ts", [tie]))
    with pytest.raises(ValueError, match="tie"):
        rollups.latest_state(events, ["user_id"], "ts", ["event_type"])


def test_an_older_version_that_comes_late_does_not_win(spark, versions):
    root, by = work_path(spark, "test"), (["k"], "v", ["n"])
    _steps(spark, versions, lambda s, r, **k: states.start_latest(s, r, *by, **k), root,
           ["v = 3", "v = 1 OR v IS NULL", "v = 2"], lambda n: states.compact_latest(spark, root, *by))
    assert same_rows(states.current_latest(spark, root, *by), rollups.latest_per_key(versions, *by))


# --- rates ---------------------------------------------------------------

def test_rate_of_any_instant_equals_the_messages(spark, sf_dir):
    events = star.event_observations(star.read_events(spark, sf_dir)).select("arrival", "event_id")
    root = work_path(spark, "test")
    _steps(spark, events, states.start_rate, root, ["event_id % 3 = 0", "event_id % 3 = 2", "event_id % 3 = 1"])
    states.compact_rate(spark, root)
    instants = spark.sql("SELECT explode(array(timestamp'2024-01-02 03:04:05', timestamp'2024-01-10 00:00:00', "
                         "timestamp'2023-01-01 00:00:00', timestamp'2024-01-20 12:00:01')) AS asof")
    got = {r[0]: tuple(r)[1:] for r in states.rate_asof(spark, root, instants, windows=(1, 5, 600)).collect()}
    for (at,) in instants.collect():
        direct = one(live.message_rate(events.where(F.col("arrival") < F.lit(at)), "arrival", F.lit(at), (1, 5, 600)))
        assert got[at] == tuple(direct)
    assert len(got) == 4 and any(sum(v) for v in got.values())


def test_a_ring_holds_the_newest_seconds_and_is_merged_by_slot(spark):
    def seconds(rows):
        return spark.createDataFrame(rows, "second bigint, messages bigint")

    first, second = seconds([(100, 1), (101, 2), (399, 3)]), seconds([(101, 5), (401, 7), (350, 1)])
    whole = live.ring(first.unionByName(second))
    assert collected(whole, "slot", "second", "messages") == [(50, 350, 1), (99, 399, 3), (101, 401, 7)]
    merged = live.ring(live.ring(first).select("second", "messages").unionByName(second))
    assert same_rows(whole, merged)
    many = spark.range(5000).select((F.col("id") + 7).alias("second"), F.lit(1).cast("bigint").alias("messages"))
    assert one(live.ring(many).agg(F.count("*").alias("n"), F.min("second").alias("least"))).asDict() == {"n": 300, "least": 4707}


# --- distinct counts -----------------------------------------------------

def test_kpi_vector_from_a_stream_with_shared_codes(spark):
    rows = settle(observations(spark, [
        {"month": 1 + i % 4, "airport": None if i % 11 == 0 else f"A{i % 37}", "carrier": f"C{(i * i) % 13}", "arr_flights": float(i),
         "arr_del15": float(i % 5), "arr_delay": 10.0 * i, "nas_delay": 3.0 * i, "weather_delay": float(i)} for i in range(300)]), "rows")
    root = work_path(spark, "test")
    parts = ["month = 4", "month = 2", "month IN (1, 3)"]
    _steps(spark, rows, states.start_kpi, root, parts, lambda n: states.compact_kpi(spark, root))
    assert same_rows(states.current_kpi(spark, root), kpi.overall(rows))
    assert same_rows(states.current_kpi(spark, root, F.col("month") <= 2), kpi.overall(rows.where("month <= 2")))


def test_a_replayed_increment_changes_nothing(spark):
    rows = observations(spark, [{"airport": f"A{i % 7}", "carrier": f"C{i % 3}"} for i in range(40)])
    root = work_path(spark, "test")
    for batch in (0, 1, 1):
        states.append_kpi(rows.where(F.substring("airport", 2, 1).cast("int") % 2 == batch), root, batch)
    assert same_rows(states.current_kpi(spark, root), kpi.overall(rows))


def test_dictionary_numbers_are_dense_and_stay(spark):
    def frame(codes):
        return spark.createDataFrame([(c,) for c in codes], "code string")

    first = settle(distincts.new_codes(None, frame(["b", "a", "b", None, ""])), "codes")
    assert sorted(r["number"] for r in first.collect()) == [1, 2, 3]
    more = distincts.new_codes(first, frame(["c", "a", "d"]))
    assert sorted(r["number"] for r in more.collect()) == [4, 5] and {r["code"] for r in more.collect()} == {"c", "d"}
    assert distincts.new_codes(None, frame([])).count() == 0


def test_sets_over_several_bitmaps(spark):
    codes = spark.range(80_000).select(F.concat(F.lit("c"), "id").alias("code"))
    dictionary = settle(distincts.new_codes(None, codes), "codes")
    rows = spark.range(100_000).select(F.concat(F.lit("c"), F.col("id") % 70_000).alias("airport"), (F.col("id") % 2).alias("half"))
    sets = settle(distincts.code_sets(rows, dictionary, ["half"], "airport"), "sets")
    assert sets.count() == 6
    assert collected(distincts.set_sizes(sets, ["half"]), "half", "n") == [(0, 35_000), (1, 35_000)]
    assert one(distincts.set_sizes(sets.drop("half"), []))["n"] == 70_000


# --- labels --------------------------------------------------------------

def _named(spark, pairs):
    return observations(spark, [{"airport": c, "airport_name": n} for c, n in pairs])


def test_canonical_labels_of_a_stream_equal_the_batch(spark, sf_dir):
    rows = settle(star.split_dirty(star.dirty(spark, sf_dir))[0].select("month", *S.TEXT_COLUMNS), "rows")
    root = work_path(spark, "test")
    parts = ["month > 8", "month < 4", "month BETWEEN 4 AND 8 OR month IS NULL"]
    _steps(spark, rows, states.start_labels, root, parts, lambda n: states.compact_labels(spark, root), size=2)
    for code in S.LABELS:
        assert same_rows(states.current_canonical(spark, root, code), dimensions.canonical(rows, code))
        counts = states.current_labels(spark, root, code)
        assert same_rows(dimensions.multi_label_codes(counts, code), dimensions.multi_label_codes(rows, code))
        assert same_rows(states.current_mismatches(spark, root, code),
                         dimensions.mismatches(rows, dimensions.canonical(rows, code), code))


def test_a_code_with_many_labels_stays_bounded_and_exact(spark):
    """100,000 labels once each, one of them twice, in the increment where no counter is left for it."""
    def counts(rows):
        return labels.count_labels(rows, "airport")

    base = _named(spark, [("X", "x")]).limit(1)
    many = spark.range(100_000).crossJoin(F.broadcast(base)).withColumn("airport_name", F.format_string("label %06d", "id")).select(base.columns)
    few = _named(spark, [("X", "label 077777"), ("Y", "b"), ("Y", "a"), ("Z", "")])
    first, second = (settle(counts(r), "counts") for r in (many, few))
    summary = settle(labels.summarize(first, None, 8), "summary")
    assert one(summary.select(F.size("kept").alias("n"), "cut")).asDict() == {"n": 0, "cut": 1}
    summary = settle(labels.summarize(second, summary, 8), "summary")
    assert summary.where(F.size("kept") > 8).isEmpty()
    both = first.unionByName(second)
    got = collected(labels.canonical(both, summary), "code", "label", "n")
    assert got == [("X", "label 077777", 2), ("Y", "a", 1)]


def test_summary_never_undercounts_by_more_than_its_cut(spark):
    import random
    rng = random.Random(4)
    true, summary = {}, None
    for _ in range(4):
        pairs = [("X", f"l{min(int(rng.expovariate(0.15)), 40)}") for _ in range(120)]
        for p in pairs:
            true[p] = true.get(p, 0) + 1
        summary = settle(labels.summarize(labels.count_labels(_named(spark, pairs), "airport"), summary, 5), "summary")
        row = one(summary)
        kept = {k["label"]: k["n"] for k in row["kept"]}
        assert len(kept) <= 5
        for (_, label), n in true.items():
            assert n - row["cut"] <= kept.get(label, 0) <= n


# --- template sample -----------------------------------------------------

def _template_rows(spark):
    rows = [{"airport": f"A{i % 9}" if i % 13 else None, "year": 2020 + i % 3, "month": 1 + i % 12, "arr_flights": float(i // 4)}
            for i in range(200)]
    return settle(observations(spark, rows + rows[:60]), "rows")


def test_sample_states_equal_the_sample_of_all_rows(spark):
    rows, root = _template_rows(spark), work_path(spark, "test")
    parts = ["month > 9", "month BETWEEN 3 AND 9", "month < 3"]
    _steps(spark, rows, states.start_templates, root, parts, lambda n: n and states.compact_templates(spark, root, 120), size=120)
    assert same_rows(states.current_templates(spark, root, 120), sampling.average_year_templates(rows))


def test_a_sample_beyond_the_states_is_refused(spark):
    rows, root = _template_rows(spark), work_path(spark, "test")
    states.append_templates(rows, root, 0, 20)
    with pytest.raises(ValueError, match="20 rows"):
        states.current_templates(spark, root, 20)


# --- running validation --------------------------------------------------

def test_running_validation_names_the_first_failing_batch(spark):
    history = observations(spark, [{"year": 2024, "month": m, "arr_del15": 1.0} for m in range(1, 13)])
    reference, root = validation.Reference.of(history), work_path(spark, "test")
    good = observations(spark, [{"month": m, "arr_del15": 1.0} for m in range(1, 7)])
    bad = observations(spark, [{"month": 7, "arr_delay": -1.0}])
    late = observations(spark, [{"month": 8, "arr_del15": 2.0}])
    steps = [good, bad, late]
    for batch, rows in enumerate(steps):
        states.add_profile(rows, reference, root, batch)
        if batch == 1:  # a replay judges the same rows again
            states.add_profile(rows, reference, root, batch)
    assert [r["status"] for r in states.verdicts(spark, root).orderBy("batch").collect()] == ["PASS_WITH_WARNINGS", "FAIL", "FAIL"]
    now = one(states.current_verdict(spark, root))
    whole = one(validation.assess(history, good.unionByName(bad).unionByName(late)).status())
    assert now["first_failed"] == 1 and tuple(now)[:3] == tuple(whole)
    with pytest.raises(ValueError, match="month"):
        states.start_validation(good.drop("month"), reference, root)


def test_merged_profiles_equal_the_profile_of_all_rows(spark, sf_dir):
    rows = settle(star.dirty(spark, sf_dir).drop("is_generated"), "rows")
    parts = [validation.profile(rows.where(c)) for c in ("pmod(hash(airport), 2) = 0", "pmod(hash(airport), 2) = 1")]
    merged, whole = validation.merge_profiles(parts[0].unionByName(parts[1])), validation.profile(rows)
    rounded = [F.round(c, 6).alias(c) if c in S.MEASURES else F.col(c) for c in whole.columns]
    assert same_rows(merged.select(*rounded), whole.select(*rounded))


# --- cube ----------------------------------------------------------------

def test_cube_grains_equal_direct_sums_and_are_read_alone(spark, sf_dir):
    rows = settle(star.dirty(spark, sf_dir).drop("is_generated"), "rows")  # with missing keys
    path = work_path(spark, "cube")
    cube.write(cube.build(rows), path)
    for keys in cube.SETS:
        got = cube.read(spark, path, keys)
        direct = rows.groupBy(*keys).agg(*[F.round(F.coalesce(F.sum(c), F.lit(0)), 6).cast("double").alias(c) for c in cube.SUMMED])
        assert same_rows(got.select(*keys, *[F.round(c, 6).cast("double").alias(c) for c in cube.SUMMED]), direct)
        assert "PartitionFilters: [isnotnull(grouping" in got._jdf.queryExecution().executedPlan().toString()
        assert got.where(" OR ".join([f"{S.LABELS[c]} IS NOT NULL" for c in S.LABELS if c not in keys]) or "false").isEmpty()


def test_cube_of_increments_and_missing_grains(spark):
    rows = observations(spark, [{"month": 1 + i % 3, "airport": f"A{i % 4}", "airport_name": f"n{i % 5}"} for i in range(60)])
    merged = cube.merge(cube.build(rows.where("month = 1")).unionByName(cube.build(rows.where("month > 1"))))
    assert same_rows(merged.select(sorted(merged.columns)), cube.build(rows).select(sorted(merged.columns)))
    assert cube.covering(["airport", "year"]) == ("year", "airport") and cube.covering(["month"]) == ("year", "month")
    with pytest.raises(ValueError, match="day"):
        cube.covering(["day"])
