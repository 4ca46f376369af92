"""Seasonal index of the delay rate and its comparison between two datasets."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow.functions.scalars import is_infinite, ratio_null, total
from rateflow.operators.kpi import on_month_spine

MIN_MONTHS = 10
MIN_CORRELATION = 0.70
MAX_MEAN_DIFFERENCE = 0.10


def seasonal_index(df):
    """Twelve rows: the delay rate of a month relative to its year, averaged over years by volume.

    All steps after the first aggregation run on one row per (year, month).
    """
    rates = (
        df.filter(F.col("year").isNotNull() & F.col("month").isNotNull())
        .groupBy("year", "month")
        .agg(total("arr_flights").alias("flights"), total("arr_del15").alias("delayed"))
        .withColumn("rate", ratio_null(F.col("delayed"), F.col("flights")))
    )
    indexed = rates.withColumn(
        "idx", ratio_null(F.col("rate"), F.avg("rate").over(Window.partitionBy("year"))))
    usable = indexed.filter(F.col("idx").isNotNull() & ~is_infinite(F.col("idx")) & (F.col("flights") > 0))
    averaged = usable.groupBy("month").agg(
        ratio_null(F.sum(F.col("idx") * F.col("flights")), F.sum("flights")).alias("seasonal_index"))
    return on_month_spine(averaged)


def compare(original_index, generated_index):
    """Comparable months, correlation and mean absolute difference of two profiles.

    With fewer than ten comparable months, or when one side is all zero, only
    the number of months is given. A constant side gives no correlation.
    """
    pairs = (
        original_index.withColumnRenamed("seasonal_index", "o")
        .join(generated_index.withColumnRenamed("seasonal_index", "g"), "month")
        .filter(F.col("o").isNotNull() & F.col("g").isNotNull())
    )
    stats = pairs.agg(
        F.count(F.lit(1)).alias("months"),
        F.max(F.abs("o")).alias("top_o"), F.max(F.abs("g")).alias("top_g"),
        F.covar_pop("o", "g").alias("cov"),
        F.stddev_pop("o").alias("sd_o"), F.stddev_pop("g").alias("sd_g"),
        F.avg(F.abs(F.col("o") - F.col("g"))).alias("mad"),
    )
    enough = (F.col("months") >= MIN_MONTHS) & (F.col("top_o") > 0) & (F.col("top_g") > 0)
    return stats.select(
        F.col("months").alias("seasonality_months_compared"),
        F.when(enough, F.try_divide(F.col("cov"), F.col("sd_o") * F.col("sd_g"))).alias("seasonality_corr"),
        F.when(enough, F.col("mad")).alias("seasonality_mad"),
        F.when(F.col("months") < MIN_MONTHS, "too_few_months").when(~enough, "all_zero").otherwise("compared")
        .alias("outcome"),
    )


def warnings(comparison):
    """Seasonality findings as (ord, message) rows."""
    corr, mad = F.col("seasonality_corr"), F.col("seasonality_mad")
    outcome = F.col("outcome")
    messages = F.array(
        F.when(outcome == "too_few_months", F.format_string(
            "Monthly seasonality check: only %d/12 months comparable; correlation may be unreliable",
            F.col("seasonality_months_compared"))),
        F.when(outcome == "all_zero", F.lit("Monthly seasonality check: seasonal index is all zeros in one dataset")),
        F.when(corr < MIN_CORRELATION, F.format_string(
            "Monthly delay_rate seasonal-index correlation is low: corr=%.2f (expected >= 0.70)", corr)),
        F.when(mad > MAX_MEAN_DIFFERENCE, F.format_string(
            "Monthly delay_rate seasonal-index mean abs diff is high: %.3f (expected <= 0.10)", mad)),
    )
    return comparison.select(F.posexplode(messages).alias("ord", "message")).filter(F.col("message").isNotNull())
