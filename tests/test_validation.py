"""The whole validation: wording, order, gates and written outputs."""

import json

from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.plans import validation
from rateflow.session import work_path
from rateflow.sources import files
from tests.helpers import observations, one


def _history(spark):
    rows = [{"year": y, "month": m, "carrier": c, "carrier_name": f"{c} Air", "airport": a, "airport_name": f"{a}, Field",
             "arr_flights": 100.0, "arr_del15": 20.0, "arr_delay": 50.0, "nas_delay": 50.0}
            for y in (2018, 2024) for m in range(1, 13) for c in ("AA", "BB") for a in ("X1", "X2")]
    rows.append({"year": 2024, "carrier": "AA", "carrier_name": "Old", "airport": "X1", "airport_name": "X1, Field",
                 "arr_flights": None, "nas_ct": -1.0})
    return observations(spark, rows)


def _generated(spark, **changes):
    return observations(spark, [
        {"month": m, "carrier": "AA", "carrier_name": "Old" if m == 1 else "AA Air", "airport": "X1",
         "airport_name": "X1, Field", "arr_flights": 100.0, "arr_del15": 30.0, "arr_delay": 50.0, "nas_delay": 50.0}
        | changes for m in range(1, 9)])


def test_report_of_a_passing_run(spark):
    report = one(validation.assess(_history(spark), _generated(spark), "last5").report())
    assert report["status"] == "PASS_WITH_WARNINGS" and report["errors"] == []
    assert report["generated_warnings"] == [
        "GENERATED: 1 carriers have multiple carrier_name values (e.g. ['AA'])",
        "GENERATED: 1 rows have carrier_name not matching canonical mapping (examples: "
        "[{'carrier': 'AA', 'carrier_name': 'Old', 'carrier_name_expected': 'AA Air'}])",
        "KPI delay_rate: generated=0.3000 vs original=0.2000 (abs diff=0.1000 > 0.02)",
        "Low airport coverage in generated: 1",
        "Low carrier coverage in generated: 1",
        "Monthly seasonality check: only 8/12 months comparable; correlation may be unreliable",
    ]
    assert report["reference_notes"] == [
        "Filtered ORIGINAL to last 5 years: 2020-2024",
        "Filled 1 numeric nulls with 0 in ORIGINAL",
        "Clipped 1 negative numeric values to 0 in ORIGINAL",
        "ORIGINAL: 1 records have arr_flights <= 0",
    ]
    assert report["seasonality"] == {"seasonality_months_compared": 8.0}
    assert report["powerbi_outputs"]["canonicalization_notes"] == ["Canonicalized carrier_name for 1 rows"]
    assert report["original"]["total_flights"] == 4800.0 and report["generated"]["delay_rate"] == 0.3
    assert report["original"]["share_nas_delay"] == 1.0


def test_gates(spark):
    failed = one(validation.assess(_history(spark), _generated(spark, arr_flights=0.0)).report())
    assert failed["status"] == "FAIL"
    assert failed["errors"][:2] == [
        "GENERATED: 8 records have arr_flights <= 0", "GENERATED: 8 records have arr_del15 > arr_flights"]
    unknown = one(validation.assess(_history(spark), _generated(spark, airport="O'H")).report())
    assert unknown["errors"] == ["GENERATED: 1 airport codes not in original dataset (e.g. [\"O'H\"])"]
    short = one(validation.assess(_history(spark), _generated(spark).drop("month", "carrier")).report())
    assert short["errors"] == ["GENERATED: Missing required columns: ['month', 'carrier']"]


def test_run_writes_outputs(spark):
    out = work_path(spark, "test")
    candidate = _generated(spark).withColumn("id", F.concat(F.lit("g"), F.col("month"))).withColumn("sequence", F.col("month") * 2)
    assert validation.run(_history(spark), candidate, out) == "PASS_WITH_WARNINGS"
    report = json.loads(one(spark.read.text(f"{out}/validation_report.json"))[0])
    assert report["status"] == "PASS_WITH_WARNINGS" and report["powerbi_outputs"]["dim_carrier_csv"] == "dim_carrier.csv"
    dims = {r[0]: r[1] for r in files.read_csv(spark, f"{out}/dim_carrier.csv").collect()}
    assert dims == {"AA": "AA Air", "BB": "BB Air"}
    rows, bad = files.load_json_lines(spark, f"{out}/generated_powerbi.ndjson")
    assert bad == 0 and {r["carrier_name"] for r in rows.collect()} == {"AA Air"}
    written = files.read_csv(spark, f"{out}/generated_powerbi.csv")
    assert written.columns == S.REQUIRED + ["id", "sequence"]
    expected = {(f"g{m}", str(2 * m)) for m in range(1, 9)}
    assert {tuple(r) for r in written.select("id", "sequence").collect()} == expected
    every, _ = files.load_json_lines(spark, f"{out}/generated_powerbi.ndjson", columns=None)
    assert every.columns == S.REQUIRED + ["id", "sequence"]
    assert {tuple(r) for r in every.select("id", "sequence").collect()} == expected


def test_failed_run_writes_only_the_report(spark):
    out = work_path(spark, "test")
    assert validation.run(_history(spark), _generated(spark, carrier="ZZ"), out) == "FAIL"
    report = json.loads(one(spark.read.text(f"{out}/validation_report.json"))[0])
    assert report["status"] == "FAIL"
    assert report["powerbi_outputs"] == {k: None for k in validation.OUTPUT_NAMES} | {"canonicalization_notes": []}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/dim_carrier.csv")
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_reference_errors_are_reported(spark):
    bad = one(validation.assess(_history(spark).withColumn("month", F.lit(13)), _generated(spark)).report())
    assert bad["reference_errors"] == ["ORIGINAL: 97 records have invalid month"]


def test_year_note_needs_years(spark):
    empty = one(validation.assess(_history(spark).filter("year > 3000"), _generated(spark), "last5").report())
    assert not [n for n in empty["reference_notes"] if "last 5 years" in n]


def test_texts_are_quoted_as_in_a_list(spark):
    texts = ["plain", "O'H", 'both \' and "', "back\\slash", "two\nlines\t"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    shown = [r[0] for r in rows.orderBy("i").select(validation._python_text(F.col("t"))).collect()]
    assert shown == [repr(t) for t in texts]
