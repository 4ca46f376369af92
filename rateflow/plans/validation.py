"""The full validation job: compare generated data with a historical reference.

Each dataset is scanned once, into a profile: one row per distinct period,
carrier, airport and labels, with row counts, rule counts and the sums over
valid rows. All checks, KPIs, dimensions and seasonal profiles come from the two
profiles, whose size follows the number of keys and not the number of rows.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.functions.scalars import total
from rateflow.operators import clean, compare, dimensions, kpi, quality, seasonality
from rateflow.session import settle
from rateflow.sources.files import write_csv, write_json_lines, write_report

PASS, PASS_WITH_WARNINGS, FAIL = "PASS", "PASS_WITH_WARNINGS", "FAIL"
NAME_EXAMPLES = 8
CODE_EXAMPLES = 10
# Names of the written files, as the report gives them.
OUTPUT_NAMES = {
    "dim_carrier_csv": "dim_carrier.csv",
    "dim_airport_csv": "dim_airport.csv",
    "canonicalized_generated_csv": "generated_powerbi.csv",
    "canonicalized_generated_ndjson": "generated_powerbi.ndjson",
}


def profile(df, extra_sums=()):
    """Reduce normalized rows to one row per key with counts and sums over valid rows."""
    marked = df.withColumn("_ok", clean.valid_predicate())
    return marked.groupBy(*S.PERIOD, *S.TEXT_COLUMNS).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("_ok").alias("n_valid"),
        *[F.expr(f"coalesce(sum(CASE WHEN _ok THEN {c} END), 0) AS {c}") for c in S.MEASURES],
        *quality.tally_columns(),
        *[total(c).alias(c) for c in extra_sums],
    )


def reference_rows(original, years="all"):
    """Normalize, restrict to a year window and clean the reference; count the cleaned cells per row."""
    rows = clean.filter_years(clean.normalize(original), years)

    counted = rows.withColumns({
        "_filled": F.expr(" + ".join(f"CAST({c} IS NULL AS INT)" for c in S.MEASURES)),
        "_clipped": F.expr(" + ".join(f"CAST(coalesce({c}, 0) < 0 AS INT)" for c in S.MEASURES)),
    })
    return clean.clean_reference(counted)


def _python_text(c):
    """Text quoted as in a Python list."""
    double = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    quote = F.when(double, F.lit('"')).otherwise(F.lit("'"))
    shown = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for mark, name in (("\n", "n"), ("\r", "r"), ("\t", "t")):
        shown = F.replace(shown, F.lit(mark), F.lit("\\" + name))
    shown = F.when(double, shown).otherwise(F.replace(shown, F.lit("'"), F.lit("\\'")))
    return F.concat(quote, shown, quote)


def _listed(codes):
    return F.concat(F.lit("["), F.array_join(F.transform(codes, _python_text), ", "), F.lit("]"))


def _lines(df, section, stage, message=None, order=None, key=None, value=None):
    """Rows of the report in long form."""
    return df.select(
        (F.lit(section) if isinstance(section, str) else section).alias("section"), F.lit(stage).alias("stage"),
        (F.lit(0) if order is None else order).cast("int").alias("ord"),
        (F.lit(None) if key is None else key).cast("string").alias("key"),
        (F.lit(None) if value is None else value).cast("double").alias("value"),
        (F.lit(None) if message is None else message).cast("string").alias("message"),
    )


def _finding_lines(found, stage):
    section = F.when(F.col("severity") == quality.ERROR, "error").otherwise("warning")
    return _lines(found, section, stage, F.col("message"), F.col("ord"))


def _domain_lines(generated, original):
    out = []
    for i, code in enumerate(["airport", "carrier"]):
        unknown = dimensions.summarize_codes(dimensions.unknown_codes(generated, original, code), CODE_EXAMPLES)
        out.append(_lines(unknown, "error", 2, F.concat(
            F.lit("GENERATED: "), F.col("n").cast("string"),
            F.lit(f" {code} codes not in original dataset (e.g. "), _listed(F.col("examples")), F.lit(")")), F.lit(i)))
        several = dimensions.summarize_codes(dimensions.multi_label_codes(generated, code), CODE_EXAMPLES)
        out.append(_lines(several, "warning", 2, F.concat(
            F.lit("GENERATED: "), F.col("n").cast("string"),
            F.lit(f" {code}s have multiple {code}_name values (e.g. "), _listed(F.col("examples")), F.lit(")")),
            F.lit(i)))
    return out


def _name_lines(wrong, code, order):
    label = S.LABELS[code]
    shown = dimensions.first_per_domain(wrong, ["code", "label"], NAME_EXAMPLES).select("domain", "position", F.concat(
        F.lit(f"{{'{code}': "), _python_text(F.col("code")),
        F.lit(f", '{label}': "), _python_text(F.col("label")),
        F.lit(f", '{label}_expected': "), _python_text(F.col("expected")), F.lit("}")).alias("example"))
    examples = shown.groupBy("domain").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("position", "example"))), lambda e: e["example"]), ", ").alias("examples"))
    rows = wrong.groupBy("domain").agg(F.sum("n").alias("n"))
    return _lines(rows.join(examples, "domain"), "warning", 3, F.concat(
        F.lit("GENERATED: "), F.col("n").cast("string"),
        F.lit(f" rows have {label} not matching canonical mapping (examples: ["), F.col("examples"), F.lit("])")),
        F.lit(order))


@dataclass
class Assessment:
    """Everything the validation derives; all frames are lazy over the settled profiles."""

    lines: DataFrame
    carriers: dimensions.Measured
    airports: dimensions.Measured
    original_months: DataFrame
    generated_months: DataFrame
    original_index: DataFrame
    generated_index: DataFrame
    generated_rows: DataFrame | None

    def report(self):
        """One row: both KPI vectors, seasonality, outputs, warnings, status, notes, errors."""
        c = {n: F.col(n) for n in self.lines.columns}

        def vector(section):
            pairs = F.collect_list(F.when(c["section"] == section, F.struct(c["key"], c["value"])))
            return F.map_from_entries(F.sort_array(pairs)).alias(section)

        def messages(section, name):
            found = F.collect_list(F.when(c["section"] == section, F.struct(c["stage"], c["ord"], c["message"])))
            return F.transform(F.sort_array(found), lambda m: m["message"]).alias(name)

        # After an error nothing but the report is written.
        failed = F.count_if(c["section"] == "error") > 0
        none = F.array().cast("array<string>")
        outputs = F.struct(
            *[F.when(~failed, F.lit(v)).alias(k) for k, v in OUTPUT_NAMES.items()],
            F.when(failed, none).otherwise(messages("canonicalization", "notes")).alias("canonicalization_notes"))
        status = (
            F.when(failed, FAIL)
            .when(F.count_if(c["section"] == "warning") > 0, PASS_WITH_WARNINGS).otherwise(PASS))
        return self.lines.agg(
            vector("original"), vector("generated"), vector("seasonality"), outputs.alias("powerbi_outputs"),
            messages("warning", "generated_warnings"), status.alias("status"),
            messages("note", "reference_notes"), messages("error", "errors"),
            messages("reference_error", "reference_errors"))

    def status(self):
        """Status with the number of errors and warnings."""
        return self.report().select(
            "status", F.size("errors").cast("bigint").alias("errors"),
            F.size("generated_warnings").cast("bigint").alias("warnings"))


def _schema_failure(spark, frames):
    """Findings when a dataset lacks required columns; nothing else can be evaluated then."""
    lines = []
    for dataset, missing in frames.items():
        if missing:
            lines.append(_finding_lines(quality.schema_findings(spark, dataset, missing), 1))
    return reduce(DataFrame.unionByName, lines) if lines else None


@dataclass(frozen=True)
class Reference:
    """What a validation needs of the reference, computed once."""

    profile: DataFrame
    carriers: dimensions.Measured
    airports: dimensions.Measured
    found: DataFrame
    kpi: DataFrame
    index: DataFrame
    years: object

    @classmethod
    def of(cls, original, years="all"):
        o = settle(profile(reference_rows(original, years), ["_filled", "_clipped"]), "profile")
        valid = o.filter("n_valid > 0")
        return cls(
            o, dimensions.measure(dimensions.canonical(o, "carrier", "n_rows"), "carrier"),
            dimensions.measure(dimensions.canonical(o, "airport", "n_rows"), "airport"),
            quality.findings(quality.merge_tallies(o), "ORIGINAL"), kpi.overall_long(valid), seasonality.seasonal_index(valid), years)


def merge_profiles(parts):
    """Add up profiles of increments: the profile of all rows."""
    keys = [*S.PERIOD, *S.TEXT_COLUMNS]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in parts.columns if c not in keys])


def assess(original, generated, years="all"):
    """Evaluate the validation of `generated` against `original` (raw or typed observation rows)."""
    spark = original.sparkSession
    failed = _schema_failure(spark, {
        "ORIGINAL": quality.missing_columns(original), "GENERATED": quality.missing_columns(generated)})
    if failed is not None:
        return Assessment(failed, None, None, None, None, None, None, None)

    candidate = clean.normalize(generated)
    return assess_profile(Reference.of(original, years), settle(profile(candidate), "profile"), candidate)


def assess_profile(reference, g, candidate=None):
    """Evaluate a profile of generated rows against a reference."""
    o, carriers, airports = reference.profile, reference.carriers, reference.airports
    o_found, o_kpi, o_index, years = reference.found, reference.kpi, reference.index, reference.years
    o_valid, g_valid = o.filter("n_valid > 0"), g.filter("n_valid > 0")
    g_found = quality.findings(quality.merge_tallies(g), "GENERATED").unionByName(quality.year_findings(g))
    g_kpi, g_index = kpi.overall_long(g_valid), seasonality.seasonal_index(g_valid)
    season = seasonality.compare(o_index, g_index)
    season_long = season.select(
        F.col("seasonality_months_compared").cast("double").alias("seasonality_months_compared"),
        "seasonality_corr", "seasonality_mad",
    ).unpivot([], ["seasonality_months_compared", "seasonality_corr", "seasonality_mad"], "metric", "value").filter(
        F.col("value").isNotNull())

    wrong = {dim.code: dimensions.mismatches(g, dim.frame, dim.code, "n_rows") for dim in (carriers, airports)}
    changed = {code: rows.groupBy("domain").agg(F.sum("n").alias("n")) for code, rows in wrong.items()}
    cells = o.agg(total("_filled").alias("filled"), total("_clipped").alias("clipped"))
    reference_errors = o_found.filter(F.col("severity") == quality.ERROR)
    comparison = compare.warnings(compare.compare(o_kpi, g_kpi))
    seasonal = seasonality.warnings(season)
    lines = [
        _finding_lines(g_found, 1),
        *_domain_lines(g, o),
        _name_lines(wrong["carrier"], "carrier", 0),
        _name_lines(wrong["airport"], "airport", 1),
        _lines(comparison, "warning", 4, F.col("message"), F.col("ord")),
        _lines(seasonal, "warning", 5, F.col("message"), F.col("ord")),
        _lines(o_kpi, "original", 0, key=F.col("metric"), value=F.col("value")),
        _lines(g_kpi, "generated", 0, key=F.col("metric"), value=F.col("value")),
        _lines(season_long, "seasonality", 0, key=F.col("metric"), value=F.col("value")),
        *[_lines(rows, "canonicalization", 0, F.format_string(
            f"Canonicalized {S.LABELS[code]} for %,d rows", F.col("n")), F.lit(i))
          for i, (code, rows) in enumerate(changed.items())],
        *_year_note(o, years),
        _lines(cells.filter("filled > 0"), "note", 1, F.format_string(
            "Filled %d numeric nulls with 0 in ORIGINAL", F.col("filled")), F.lit(0)),
        _lines(cells.filter("clipped > 0"), "note", 1, F.format_string(
            "Clipped %d negative numeric values to 0 in ORIGINAL", F.col("clipped")), F.lit(1)),
        _lines(o_found.filter(F.col("severity") == quality.WARNING), "note", 2, F.col("message"), F.col("ord")),
        _lines(reference_errors, "reference_error", 1, F.col("message"), F.col("ord")),
    ]
    return Assessment(
        reduce(DataFrame.unionByName, lines), carriers, airports,
        kpi.on_month_spine(kpi.by_month(o_valid)), kpi.on_month_spine(kpi.by_month(g_valid)),
        o_index, g_index, candidate)


def _year_note(rows, years):
    if years == "all":
        return []
    if years == "last5":
        span = rows.agg(F.max("year").alias("hi")).filter("hi IS NOT NULL")
        return [_lines(span, "note", 0, F.format_string(
            "Filtered ORIGINAL to last 5 years: %d-%d", F.col("hi") - 4, F.col("hi")))]
    try:
        low, high = sorted(int(y) for y in years)
        text = f"Filtered ORIGINAL to year range: {low}-{high}"
    except (TypeError, ValueError):
        text = "Invalid range input; using ALL years"
    return [_lines(rows.sparkSession.range(1), "note", 0, F.lit(text))]


def run(original, generated, out, years="all"):
    """Validate and write: always the report; dimensions and canonicalized rows unless an error stopped it.

    The canonicalized rows keep every column of the candidate. Returns the status.
    """
    result = assess(original, generated, years)
    report = settle(result.report(), "report")
    write_report(report, f"{out}/validation_report.json")
    status = report.first()["status"]
    if status != FAIL:
        write_csv(result.carriers.frame.orderBy("carrier"), f"{out}/{OUTPUT_NAMES['dim_carrier_csv']}")
        write_csv(result.airports.frame.orderBy("airport"), f"{out}/{OUTPUT_NAMES['dim_airport_csv']}")
        labelled = dimensions.canonicalize(result.generated_rows, result.carriers, result.airports)
        labelled = settle(labelled, "canonicalized")
        write_csv(labelled, f"{out}/{OUTPUT_NAMES['canonicalized_generated_csv']}", line_breaks=True)
        write_json_lines(labelled, f"{out}/{OUTPUT_NAMES['canonicalized_generated_ndjson']}")
    return status
