"""Operators against hand-made vectors, brute force and their own invariants."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.functions import scalars
from rateflow.operators import (
    clean, compare, dimensions, kpi, live, quality, rollups, sampling, scenario, seasonality)
from rateflow.sources import star
from tests.helpers import collected, observations, one, same_rows

# The two published KPI vectors of the reference run.
ORIGINAL = {
    "total_flights": 110695124.0, "total_delayed": 20699417.0, "delay_rate": 0.18699483998951932,
    "cancel_rate": 0.018188723470782688, "divert_rate": 0.0021469238337905473,
    "avg_delay_per_flight": 10.578343405622817, "unique_airports": 418.0, "unique_carriers": 29.0}
GENERATED = {
    "total_flights": 146621.0, "total_delayed": 37878.0, "delay_rate": 0.2583395284440837,
    "cancel_rate": 0.05822494731314068, "divert_rate": 0.000688850846740917,
    "avg_delay_per_flight": 18.032069076053226, "unique_airports": 16.0, "unique_carriers": 9.0}


def test_kpi_comparison_messages(spark):
    o, g = (spark.createDataFrame(list(v.items()), "metric string, value double") for v in (ORIGINAL, GENERATED))
    found = compare.warnings(compare.compare(o, g)).orderBy("ord").collect()
    assert [r["message"] for r in found] == [
        "KPI delay_rate: generated=0.2583 vs original=0.1870 (abs diff=0.0713 > 0.02)",
        "KPI cancel_rate: generated=0.0582 vs original=0.0182 (abs diff=0.0400 > 0.01)",
        "KPI avg_delay_per_flight: generated=18.0321 vs original=10.5783 (abs diff=7.4537 > 2.0)",
        "Low airport coverage in generated: 16",
        "Low carrier coverage in generated: 9",
    ]


def test_metric_missing_on_one_side_is_zero(spark):
    o = spark.createDataFrame([("delay_rate", 0.5)], "metric string, value double")
    g = spark.createDataFrame([("cancel_rate", 0.3)], "metric string, value double")
    assert collected(compare.align(o, g), "metric", "original", "generated") == [
        ("cancel_rate", 0.0, 0.3), ("delay_rate", 0.5, 0.0)]


@pytest.mark.parametrize("target, parts, wanted", [
    (10, [3, 1, 3, 0, 3], [3, 1, 3, 0, 3]), (10, [3, 1, 3, 0, 4], [2, 1, 3, 0, 4]),
    (10, [1, 1, 4, 1, 5], [0, 0, 4, 1, 5]), (10, [3, 1, 3, 0, 2], [4, 1, 3, 0, 2]), (0, [0] * 5, [0] * 5),
])
def test_apportion(spark, target, parts, wanted):
    adjusted = scenario.apportion([F.lit(p).cast("bigint") for p in parts], F.lit(target).cast("bigint"))
    assert list(spark.range(1).select(*[a.alias(f"p{i}") for i, a in enumerate(adjusted)]).first()) == wanted


def test_canonical_labels(spark):
    rows = [("AA", "x"), ("AA", "x"), ("AA", "y"), ("BB", "y"), ("BB", "x"), ("CC", None), (None, "z"), ("DD", ""),
            ("", "q")]
    df = observations(spark, [{"carrier": c, "carrier_name": n} for c, n in rows])
    assert collected(dimensions.canonical(df, "carrier"), "carrier", "carrier_name") == [("AA", "x"), ("BB", "x")]


def test_salted_lookup_equals_broadcast(spark, monkeypatch):
    df = observations(spark, [{"carrier": "AA" if i % 3 else "BB", "arr_flights": float(i)} for i in range(60)]
                      + [{"carrier": None}, {"carrier": "ZZ"}])
    dim = spark.createDataFrame([("AA", "One"), ("BB", "Two")], "carrier string, carrier_name string")
    small = dimensions.measure(dim, "carrier")
    plain = dimensions.attach_expected(df, small)
    monkeypatch.setattr(dimensions, "BROADCAST_ROWS", 0)
    large = dimensions.measure(dim, "carrier")
    assert small.small and not large.small
    salted = dimensions.attach_expected(df, large)
    assert same_rows(plain, salted) and salted.count() == 62
    # columns that cannot be hashed don't take part in the salt
    odd = df.withColumn("m", F.create_map(F.lit("a"), "arr_flights"))
    assert dimensions.attach_expected(odd, large).count() == 62


def test_canonicalize_keeps_codes_and_missing_labels(spark):
    df = observations(spark, [
        {"carrier": "AA", "carrier_name": "old"}, {"carrier": "AA", "carrier_name": None},
        {"carrier": "XX", "carrier_name": "unknown"}])
    dim = spark.createDataFrame([("AA", "new")], "carrier string, carrier_name string")
    airports = spark.createDataFrame([("AB1", "Base")], "airport string, airport_name string")
    out = dimensions.canonicalize(df, dimensions.measure(dim, "carrier"), dimensions.measure(airports, "airport"))
    assert out.columns == df.columns
    assert Counter((r["carrier"], r["carrier_name"]) for r in out.collect()) == Counter(
        [("AA", "new"), ("AA", None), ("XX", "unknown")])
    counts = one(dimensions.canonicalized_counts(df, dim, airports))
    assert (counts["carrier_labels_changed"], counts["airport_labels_changed"]) == (1, 0)


def test_unknown_codes_examples(spark):
    reference = observations(spark, [{"airport": "AB1"}])
    candidate = observations(spark, [{"airport": f"N{i:02d}"} for i in range(14)] * 2 + [{"airport": None}])
    row = one(dimensions.summarize_codes(dimensions.unknown_codes(candidate, reference, "airport")))
    assert row["n"] == 14 and row["examples"] == [f"N{i:02d}" for i in range(10)]


def test_ratios_and_labels(spark):
    row = spark.sql("SELECT 1 AS n, 0 AS d, 3 AS m, 13 AS odd").select(
        scalars.ratio_zero(F.col("n"), F.col("d")).alias("zero"), scalars.ratio_null(F.col("n"), F.col("d")).alias("none"),
        scalars.month_name(F.col("m")).alias("m"), scalars.month_name(F.col("odd")).alias("odd"),
        scalars.month_label(F.col("m")).alias("label"), scalars.percent(F.lit(1), F.lit(8)).alias("p")).first()
    assert tuple(row) == (0.0, None, "March", "13", "03 - March", 12.5)


def test_normalize_and_clean(spark):
    raw = spark.createDataFrame(
        [(" AA ", "", "12", "x", "NaN", "-4")],
        "carrier string, airport string, month string, arr_flights string, arr_delay string, nas_ct string")
    row = one(clean.normalize(raw))
    assert tuple(row) == ("AA", None, 12, None, None, -4.0)
    df = observations(spark, [{"arr_delay": None, "nas_ct": -4.0}])
    assert tuple(one(clean.clean_counts(df))) == (1, 1)
    cleaned = one(clean.clean_reference(df))
    assert (cleaned["arr_delay"], cleaned["nas_ct"]) == (0.0, 0.0)


def test_year_windows(spark):
    df = observations(spark, [{"year": y} for y in [2010, 2013, 2014, 2018, None]])
    def years(w):
        return [r[0] for r in collected(clean.filter_years(df, w).na.fill(-1, ["year"]), "year")]
    assert years("last5") == [2014, 2018]
    assert years((2014, 2011)) == [2013, 2014]
    assert years("all") == years(("a", "b")) == years(None) == [-1, 2010, 2013, 2014, 2018]


def test_empty_month_selection_means_all(spark):
    df = observations(spark, [{"month": 1}, {"month": 2}, {"year": 2024}])
    assert one(kpi.overview(df, 2025, []))["flights"] == 20.0
    assert one(kpi.overview(df, 2025, [2]))["flights"] == 10.0
    assert one(kpi.overview(df, 1900))["delay_rate"] == 0.0


def test_overall_of_nothing(spark):
    row = one(kpi.overall(observations(spark, []))).asDict()
    assert row["total_flights"] == 0.0 and row["delay_rate"] == 0.0 and row["share_nas_delay"] is None
    assert kpi.overall_long(observations(spark, [])).count() == 9


def test_month_groups_leave_out_missing_months(spark):
    df = observations(spark, [{"month": None}, {"month": 3, "arr_flights": None}])
    spine = {r["month"]: r for r in kpi.on_month_spine(kpi.by_month(df)).collect()}
    assert sorted(spine) == list(range(1, 13))
    assert spine[3]["arr_flights"] == 0.0 and spine[3]["delay_rate"] is None and spine[4]["arr_flights"] is None


def test_rules_count_missing_as_unbroken(spark):
    df = observations(spark, [
        {"arr_flights": None, "arr_del15": 5.0}, {"month": 13}, {"month": None}, {"arr_flights": 0.0},
        {"arr_del15": 11.0}, {"arr_delay": 100000.0, "nas_delay": 100000.0}, {"arr_delay": 100001.0, "nas_delay": 100000.0},
        {"arr_delay": 2.0}, {"security_ct": 1.0}])
    counts = {r["rule"]: r["n"] for r in quality.violation_counts(df).collect()}
    fired = {k: v for k, v in counts.items() if v}
    assert fired == {
        "invalid_month": 1, "no_flights": 1, "delayed_over_flights": 1, "delay_too_big": 1, "delay_sum_mismatch": 1,
        "security_ct_over_delayed": 1}
    assert {r["column"]: r["n"] for r in quality.null_counts(df).collect()} == {"month": 1, "arr_flights": 1}


def test_findings_wording_and_severity(spark):
    df = observations(spark, [{"carrier": None, "arr_flights": -1.0, "year": 2024}])
    found = {r["rule"]: r for r in quality.dataset_findings(df, "GENERATED").collect()}
    assert found["missing_values"]["message"] == "GENERATED: Nulls in required columns: {'carrier': 1}"
    assert found["no_flights"]["message"] == "GENERATED: 1 records have arr_flights <= 0"
    assert found["unexpected_years"]["message"] == "GENERATED: unexpected year values [2024] (expected only 2025)"
    assert found["no_flights"]["severity"] == "error" and found["unexpected_years"]["severity"] == "warning"
    original = {r["rule"]: r["severity"] for r in quality.dataset_findings(df, "ORIGINAL").collect()}
    assert original["no_flights"] == "warning" and "unexpected_years" not in original
    short = quality.dataset_findings(df.drop("month"), "GENERATED").collect()
    assert [r["message"] for r in short] == ["GENERATED: Missing required columns: ['month']"]


def test_seasonal_index_by_hand(spark):
    cells = {(2020, 1): (100, 10), (2020, 2): (100, 30), (2021, 1): (300, 60), (2021, 2): (100, 20), (2021, 3): (0, 0)}
    df = observations(spark, [{"year": y, "month": m, "arr_flights": float(f), "arr_del15": float(d)}
                              for (y, m), (f, d) in cells.items()])
    got = {r["month"]: r["seasonal_index"] for r in seasonality.seasonal_index(df).collect()}
    assert got[1] == pytest.approx((0.5 * 100 + 1.0 * 300) / 400)
    assert got[2] == pytest.approx((1.5 * 100 + 1.0 * 100) / 200)
    assert got[3] is None and len(got) == 12


@pytest.mark.parametrize("o, g, outcome", [
    ([1.0] * 8 + [None] * 4, [1.0] * 12, "too_few_months"), ([0.0] * 12, [1.0] * 12, "all_zero"),
    ([1.0] * 12, [float(i) for i in range(12)], "compared"),
])
def test_seasonal_comparison_outcomes(spark, o, g, outcome):
    def frame(v):
        return spark.createDataFrame(list(enumerate(v, 1)), "month int, seasonal_index double")
    row = one(seasonality.compare(frame(o), frame(g)))
    assert row["outcome"] == outcome and row["seasonality_corr"] is None
    messages = [r["message"] for r in seasonality.warnings(seasonality.compare(frame(o), frame(g))).collect()]
    if outcome == "too_few_months":
        assert messages == [
            "Monthly seasonality check: only 8/12 months comparable; correlation may be unreliable"]


def test_increments_equal_recompute(spark, sf_dir):
    df = star.observations(spark, sf_dir)
    parts = [rollups.summary(df.filter(F.pmod(F.xxhash64("airport", "month"), F.lit(3)) == i)) for i in range(3)]
    merged = rollups.merge_summary(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert same_rows(merged, rollups.summary(df))


def test_partial_minute_states_merge_to_direct(spark, sf_dir):
    df = star.event_observations(star.read_events(spark, sf_dir))
    halves = [rollups.minute_partials(df.filter(F.col("event_id") % 2 == i), "arrival") for i in range(2)]
    merged = rollups.minute_stats(halves[0].unionByName(halves[1]))
    direct = df.groupBy(F.date_trunc("minute", "arrival").alias("m")).agg(
        F.avg(F.col("arr_delay") / F.col("arr_flights")).alias("x"), F.count("*").alias("n"))
    got = {r["ingestion_minute"]: r for r in merged.collect()}
    wanted = direct.collect()
    assert len(got) == len(wanted)
    for r in wanted:
        assert got[r["m"]]["avg_delay_per_flight"] == pytest.approx(r["x"]) and got[r["m"]]["record_count"] == r["n"]


def test_latest_per_key_drops_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 3, "c"), (2, 0, "d")], "k int, v int, x string")
    newest = rollups.latest_per_key(df, ["k"], "v", ["x"])
    assert collected(newest, "k", "x") == [(1, "b"), (2, "d")]
    plan = newest._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_live_queries(spark):
    df = spark.sql("SELECT id, timestamp'2025-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id*10) AS at FROM range(100)")
    assert [r["id"] for r in live.latest(df, "at", "id", 3).collect()] == [99, 98, 97]
    status = one(live.status(live.buffer(df, "at", "id", 40), "at"))
    assert status["buffered"] == 40 and status["last_arrival"].strftime("%H:%M:%S") == "00:16:30"
    rate = one(live.message_rate(df, "at", df.agg(F.max("at")).scalar()))
    assert tuple(rate) == (7.0, 31 / 5)
    assert tuple(one(live.message_rate(df.limit(0), "at", F.lit("2025-01-01").cast("timestamp")))) == (0.0, 0.0)


def test_rows_are_numbered_without_gaps_despite_a_hot_row(spark, monkeypatch):
    monkeypatch.setattr(sampling, "CHUNK", 7)
    df = spark.range(300).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS id")
    digest = F.md5(F.col("id").cast("string"))
    for limit in (None, 1, 57, 250, 300):
        rows = sampling.number_rows(df, digest, limit).withColumn("h", digest).orderBy("template_id").collect()
        expected = sorted(r["h"] for r in df.withColumn("h", digest).collect())[:limit]
        assert [r["template_id"] for r in rows] == list(range(1, len(expected) + 1))
        assert [r["h"] for r in rows] == expected


def test_templates_cover_every_airport(spark, sf_dir):
    df = star.observations(spark, sf_dir)
    sample = sampling.stratified_templates(df, 60, 3).collect()
    assert sorted(r["template_id"] for r in sample) == list(range(1, 61))
    assert {r["airport"] for r in sample if r["template_id"] <= 25} == {f"NATION_{i}" for i in range(25)}
    few = sampling.stratified_templates(df, 10, 3).collect()
    assert sorted(r["template_id"] for r in few) == list(range(1, 11))
    everything = sampling.stratified_templates(df, 10**9, 3)
    assert everything.count() == df.count()
    with pytest.raises(ValueError):
        sampling.stratified_templates(df.limit(0), 10)


def test_template_defaults(spark):
    df = observations(spark, [{"carrier": None}, {"airport": "B", "arr_flights": None}]).drop("security_ct")
    row = one(sampling.stratified_templates(df, 5))
    assert (row["security_ct"], row["arr_flights"], row["airport"]) == (0.0, 0.0, "B")
    assert one(sampling.avg_rows_per_year(df.withColumn("year", F.lit(None).cast("int"))))["rows"] is None
    uneven = observations(spark, [{"year": 1}] * 4 + [{"year": 2}])
    assert one(sampling.avg_rows_per_year(uneven))["rows"] == 2


def test_scenario_invariants(spark, sf_dir):
    templates = star.observations(spark, sf_dir).withColumn("template_id", F.monotonically_increasing_id())
    rows = scenario.scenario(templates, 2)
    counts = {r["rule"]: r["n"] for r in quality.violation_counts(rows).collect()}
    assert not {k: v for k, v in counts.items() if v}
    inexact = rows.filter(F.col("arr_delay") != sum(F.col(c) for c in S.CAUSE_MINUTES))
    assert inexact.isEmpty()
    assert rows.filter("year <> 2025 OR arr_flights < 1").isEmpty()
    assert rows.count() == 2 * templates.count()


def test_scenario_defaults(spark):
    templates = observations(spark, [
        {"arr_flights": 100.0, "arr_del15": 50.0, "month": 0}, {"arr_flights": 0.0, "month": 15, "arr_del15": 3.0},
        {"arr_flights": None, "month": None}]).withColumn("template_id", F.monotonically_increasing_id())
    rows = {r["month"]: r for r in scenario.scenario(templates.filter("arr_flights is not null")).collect()}
    assert set(rows) == {1, 12}
    # Without template minutes the mean is 55 per delayed unit, split by the default shares.
    r = rows[1]
    assert 55 * 0.85 * r["arr_del15"] - 1 <= r["arr_delay"] <= 55 * 1.15 * r["arr_del15"] + 1
    assert r["late_aircraft_delay"] > r["nas_delay"] > r["weather_delay"] > r["security_delay"]
    assert rows[12]["arr_flights"] == 1 and rows[12]["arr_del15"] == 0 and rows[12]["arr_delay"] == 0
    assert r["kafka_key"].startswith("AB1_AA_") and r["id"].count("_") == 1


def test_scenario_is_reproducible(spark, sf_dir):
    templates = star.event_observations(star.read_events(spark, sf_dir)).withColumn("template_id", F.col("event_id"))
    a = scenario.scenario(templates, 1, 5, envelope=False)
    b = scenario.scenario(templates.repartition(7, "event_id"), 1, 5, envelope=False)
    assert same_rows(a, b)
    assert not same_rows(a, scenario.scenario(templates, 1, 6, envelope=False))


def test_slicer_and_causes(spark):
    df = observations(spark, [{"month": 2, "nas_delay": 5.0, "arr_delay": 5.0}, {"month": 11}])
    assert [r["month_label"] for r in clean.slicer_values(df).collect()] == ["02 - February", "11 - November"]
    assert {r["cause"]: r["minutes"] for r in kpi.cause_breakdown(df, 2025).collect()} == {
        "Carrier": 0.0, "Weather": 0.0, "NAS": 5.0, "Security": 0.0, "Late Aircraft": 0.0}


def test_top_puts_missing_last_and_breaks_ties_by_code(spark):
    df = observations(spark, [
        {"carrier": "C", "arr_del15": 5.0}, {"carrier": "B", "arr_del15": 5.0}, {"carrier": "A", "arr_flights": 0.0},
        {"carrier": "D", "arr_del15": 1.0}])
    top = kpi.top_by_delay(df, "carrier", 2025)
    assert [(r["carrier"], r["delay_percentage"]) for r in top.collect()] == [
        ("B", 50.0), ("C", 50.0), ("D", 10.0), ("A", None)]
    assert [r["carrier"] for r in kpi.top_by_delay(df, "carrier", 2025, limit=1).collect()] == ["B"]


def brute_canonical(rows):
    counts = defaultdict(Counter)
    for code, label in rows:
        counts[code][label] += 1
    return {c: min(n, key=lambda label: (-n[label], label)) for c, n in counts.items()}


def test_canonical_against_brute_force(spark, sf_dir):
    df = star.observations(spark, sf_dir)
    rows = [(r["airport"], r["airport_name"]) for r in df.select("airport", "airport_name").collect()]
    got = {r[0]: r[1] for r in dimensions.canonical(df, "airport").collect()}
    assert got == brute_canonical(rows)
    assert len(got) == dimensions.canonical(df, "airport").count()
