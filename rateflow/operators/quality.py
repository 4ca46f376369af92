"""The quality-rule catalogue and its one-pass evaluation."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from rateflow import schema as S

MAX_DELAY = 100_000
MAX_FLIGHTS = 5_000_000
EXPECTED_YEARS = (2025,)
DELAY_SUM_SLACK = 1

ERROR, WARNING = "error", "warning"


@dataclass(frozen=True)
class Rule:
    """A row predicate in SQL, with its wording and its severity for reference and candidate data.

    A predicate that is NULL, because a value is missing, does not count.
    """

    name: str
    wording: str
    broken: str
    original: str
    generated: str

    def severity(self, dataset):
        return self.original if dataset == "ORIGINAL" else self.generated


def row_rules():
    """The rules in report order."""
    causes = " + ".join(f"coalesce({c}, 0)" for c in S.CAUSE_MINUTES)
    signed = [c for c in S.MEASURES if c != "arr_flights"]
    return [
        Rule("invalid_month", "have invalid month", "month < 1 OR month > 12", ERROR, ERROR),
        Rule("no_flights", "have arr_flights <= 0", "arr_flights <= 0", WARNING, ERROR),
        Rule("delayed_over_flights", "have arr_del15 > arr_flights", "arr_del15 > arr_flights", WARNING, ERROR),
        *[Rule(f"negative_{c}", f"have negative {c}", f"{c} < 0", WARNING, ERROR) for c in signed],
        Rule("delay_too_big", f"have arr_delay > {MAX_DELAY}", f"arr_delay > {MAX_DELAY}", WARNING, WARNING),
        Rule("flights_too_big", f"have arr_flights > {MAX_FLIGHTS}", f"arr_flights > {MAX_FLIGHTS}", WARNING, WARNING),
        *[Rule(f"{c}_over_delayed", f"have {c} > arr_del15", f"{c} > arr_del15", WARNING, ERROR)
          for c in S.CAUSE_COUNTS],
        Rule("delay_sum_mismatch", "have delay sum mismatch > 1 minute",
             f"abs(arr_delay - ({causes})) > {DELAY_SUM_SLACK}", WARNING, ERROR),
    ]


RULES = row_rules()
TALLY_NAMES = [f"null_{c}" for c in S.REQUIRED] + [f"rule_{r.name}" for r in RULES]


def missing_columns(df):
    """Required columns the schema lacks. The other rules need all of them."""
    return [c for c in S.REQUIRED if c not in df.columns]


def null_counts(df):
    """Required columns with missing values and how many. One pass over the data."""
    counted = df.agg(*[F.expr(f"count_if({c} IS NULL) AS {c}") for c in S.REQUIRED])
    return counted.unpivot([], S.REQUIRED, "column", "n").filter(F.col("n") > 0)


def violation_counts(df):
    """Rows breaking each rule, zero included. All rules share one pass over the data."""
    counted = df.agg(*[F.expr(f"count_if({r.broken}) AS {r.name}") for r in RULES])
    return counted.unpivot([], [r.name for r in RULES], "rule", "n")


def tally_columns():
    """Aggregates counting missing values and broken rules, for a shared aggregation with other sums."""
    return (
        [F.expr(f"count_if({c} IS NULL) AS null_{c}") for c in S.REQUIRED]
        + [F.expr(f"count_if({r.broken}) AS rule_{r.name}") for r in RULES]
    )


def tally(df):
    """One row with every missing-value and rule count."""
    return df.agg(*tally_columns())


def merge_tallies(df):
    """Add up tallies that were grouped by some key; an empty input counts as zero."""
    return df.agg(*[F.expr(f"coalesce(sum({n}), 0) AS {n}") for n in TALLY_NAMES])


def findings(tally_row, dataset):
    """Turn a tally into findings: (dataset, ord, severity, rule, n, message), only rules that fired."""
    shown = ", ".join(
        f"CASE WHEN null_{c} > 0 THEN concat(\"'{c}': \", null_{c}) END" for c in S.REQUIRED)
    cells = " + ".join(f"null_{c}" for c in S.REQUIRED)
    nulls_severity = WARNING if dataset == "ORIGINAL" else ERROR
    rows = [
        f"1, '{nulls_severity}', 'missing_values', {cells}, "
        f"concat('{dataset}: Nulls in required columns: {{', concat_ws(', ', {shown}), '}}')"]
    for i, r in enumerate(RULES):
        # The year check sits after the month rule in the report.
        order = 2 if i == 0 else i + 3
        rows.append(
            f"{order}, '{r.severity(dataset)}', '{r.name}', rule_{r.name}, "
            f"concat('{dataset}: ', rule_{r.name}, ' records {r.wording}')")
    unfolded = f"stack({len(rows)}, {', '.join(rows)}) AS (ord, severity, rule, n, message)"
    return tally_row.selectExpr(f"'{dataset}' AS dataset", unfolded).filter(F.col("n") > 0)


def schema_findings(spark, dataset, missing):
    """The single finding of a dataset whose schema lacks required columns."""
    shown = "[" + ", ".join(f"'{c}'" for c in missing) + "]"
    return spark.range(1).select(
        F.lit(dataset).alias("dataset"), F.lit(0).alias("ord"), F.lit(ERROR).alias("severity"),
        F.lit("missing_columns").alias("rule"), F.lit(len(missing)).cast("bigint").alias("n"),
        F.lit(f"{dataset}: Missing required columns: {shown}").alias("message"),
    )


def year_findings(df, expected=EXPECTED_YEARS):
    """A warning when the distinct years of candidate data are not the expected ones.

    Years are 16-bit on the wire. Distinct years within 0..65535 are listed, which
    bounds the list; normalized files may hold any other number, and those years
    are counted behind the list.
    """
    listable = F.col("year").between(0, S.UINT16_MAX)
    years = df.filter(F.col("year").isNotNull()).select("year").distinct().agg(
        F.sort_array(F.collect_set(F.when(listable, F.col("year")))).alias("years"), F.count_if(~listable).alias("odd"))
    wanted = F.array(*[F.lit(y) for y in sorted(expected)])
    others = F.when(F.col("odd") > 0, F.concat(F.lit(" and "), F.col("odd").cast("string"), F.lit(" out of range")))
    listed = F.concat(
        F.lit("["), F.array_join(F.col("years").cast("array<string>"), ", "), F.lit("]"), F.coalesce(others, F.lit("")))
    only = ", ".join(str(y) for y in sorted(expected))
    return years.filter((F.col("years") != wanted) | (F.col("odd") > 0)).select(
        F.lit("GENERATED").alias("dataset"), F.lit(3).alias("ord"), F.lit(WARNING).alias("severity"),
        F.lit("unexpected_years").alias("rule"), (F.size("years") + F.col("odd")).cast("bigint").alias("n"),
        F.concat(F.lit("GENERATED: unexpected year values "), listed, F.lit(f" (expected only {only})")).alias("message"),
    )


def dataset_findings(df, dataset):
    """All findings of one dataset."""
    missing = missing_columns(df)
    if missing:
        return schema_findings(df.sparkSession, dataset, missing)
    found = findings(tally(df), dataset)
    return found.unionByName(year_findings(df)) if dataset == "GENERATED" else found
