"""KPI comparison of a candidate dataset with its reference, by absolute tolerance."""

from pyspark.sql import functions as F

# Allowed absolute difference per KPI, and least coverage of the candidate.
TOLERANCES = {"delay_rate": 0.02, "cancel_rate": 0.01, "divert_rate": 0.005, "avg_delay_per_flight": 2.0}
COVERAGE = {"unique_airports": 50, "unique_carriers": 10}


def _lookup(values, metric):
    """Value of a small fixed mapping for a metric, NULL when it has none."""
    out = F.lit(None).cast("double")
    for name, value in values.items():
        out = F.when(metric == name, F.lit(float(value))).otherwise(out)
    return out


def align(original, generated):
    """Full outer join of two (metric, value) vectors; a metric one side lacks is 0 there."""
    o = original.withColumnRenamed("value", "original")
    g = generated.withColumnRenamed("value", "generated")
    return o.join(g, "metric", "full").select(
        "metric",
        F.coalesce("original", F.lit(0.0)).alias("original"),
        F.coalesce("generated", F.lit(0.0)).alias("generated"),
    )


def compare(original, generated):
    """Every metric with its difference, tolerance, least coverage and whether it raises a warning."""
    metric = F.col("metric")
    out = align(original, generated).withColumns({
        "abs_diff": F.abs(F.col("generated") - F.col("original")),
        "tolerance": _lookup(TOLERANCES, metric),
        "least": _lookup(COVERAGE, metric),
    })
    return out.withColumn(
        "warns",
        F.coalesce(F.col("abs_diff") > F.col("tolerance"), F.lit(False))
        | F.coalesce(F.col("generated") < F.col("least"), F.lit(False)),
    )


def warnings(comparison):
    """Findings of the comparison as (ord, rule, message) rows in report order."""
    order = {m: i for i, m in enumerate([*TOLERANCES, *COVERAGE])}
    metric = F.col("metric")
    tolerance_text = F.lit(None).cast("string")
    for name, value in TOLERANCES.items():
        tolerance_text = F.when(metric == name, F.lit(str(value))).otherwise(tolerance_text)
    tolerance_message = F.concat(
        F.format_string("KPI %s: generated=%.4f vs original=%.4f (abs diff=%.4f > ",
                        metric, F.col("generated"), F.col("original"), F.col("abs_diff")),
        tolerance_text, F.lit(")"))
    coverage_message = F.concat(
        F.lit("Low "), F.regexp_extract(metric, "unique_(.*)s$", 1), F.lit(" coverage in generated: "),
        F.col("generated").cast("bigint").cast("string"))
    return comparison.filter("warns").select(
        _lookup(order, metric).cast("int").alias("ord"),
        metric.alias("rule"),
        F.when(F.col("least").isNotNull(), coverage_message).otherwise(tolerance_message).alias("message"),
    )
