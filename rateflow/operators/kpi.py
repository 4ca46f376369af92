"""KPI vectors, trends, cause breakdowns and top-n reports. All are ratios of sums."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow import schema as S
from rateflow.functions.scalars import month_name, percent, ratio_null, ratio_zero, total
from rateflow.operators.clean import slice_period

# Display names of the causes.
CAUSE_TITLES = {
    "carrier_delay": "Carrier",
    "weather_delay": "Weather",
    "nas_delay": "NAS",
    "security_delay": "Security",
    "late_aircraft_delay": "Late Aircraft",
}

OVERALL_METRICS = [
    "total_flights", "total_delayed", "delay_rate", "cancel_rate", "divert_rate",
    "avg_delay_per_flight", "avg_delay_per_delayed", "unique_airports", "unique_carriers",
] + [f"share_{c}" for c in S.CAUSE_MINUTES]


def _add(columns):
    return reduce(lambda a, b: a + b, columns)


def overview(df, year, months=None):
    """The headline KPIs of one slice, as a single row; ratios are 0 without a denominator."""
    sums = slice_period(df, year, months).agg(
        total("arr_flights").alias("flights"),
        total("arr_del15").alias("delayed"),
        total("arr_delay").alias("minutes"),
        total("arr_cancelled").alias("cancelled"),
        total("arr_diverted").alias("diverted"),
    )
    c = {n: F.col(n) for n in sums.columns}
    return sums.select(
        ratio_zero(c["delayed"], c["flights"]).alias("delay_rate"),
        ratio_zero(c["minutes"], c["flights"]).alias("avg_delay_per_flight"),
        ratio_zero(c["minutes"], c["delayed"]).alias("avg_delay_per_delayed"),
        ratio_zero(c["cancelled"], c["flights"]).alias("cancel_rate"),
        ratio_zero(c["diverted"], c["flights"]).alias("divert_rate"),
        c["flights"].cast("double").alias("flights"),
    )


def delay_rate_by_month(df, year):
    """Monthly delay rate of a year, in month order."""
    monthly = slice_period(df, year).groupBy("month").agg(
        total("arr_flights").alias("flights"), total("arr_del15").alias("delayed"))
    return monthly.select(
        "month", "flights", "delayed",
        ratio_zero(F.col("delayed"), F.col("flights")).alias("delay_rate"),
        month_name(F.col("month")).alias("month_name"),
    ).orderBy("month")


def cause_breakdown(df, year, months=None):
    """Minutes per cause of a slice, in long form."""
    sums = slice_period(df, year, months).agg(*[total(c).cast("double").alias(CAUSE_TITLES[c]) for c in S.CAUSE_MINUTES])
    return sums.unpivot([], list(CAUSE_TITLES.values()), "cause", "minutes")


def top_by_delay(df, code, year, months=None, limit=10):
    """Codes with the highest delay percentage. Ties are broken by code, a code's label is its smallest."""
    label = S.LABELS[code]
    return (
        slice_period(df, year, months).groupBy(code)
        .agg(F.min(label).alias(label), total("arr_flights").alias("total_flights"),
             total("arr_del15").alias("delayed_flights"))
        .withColumn("delay_percentage", percent(F.col("delayed_flights"), F.col("total_flights")))
        .orderBy(F.desc_nulls_last("delay_percentage"), code)
        .limit(limit)
    )


def overall(df):
    """The overall KPI vector as one row.

    Sums are first reduced per (airport, carrier), so the two distinct counts
    run on that small result and not on the rows.
    """
    pairs = df.groupBy("airport", "carrier").agg(
        *[total(c).alias(c) for c in S.COUNTS + ["arr_delay"] + S.CAUSE_MINUTES])
    sums = pairs.agg(
        *[total(c).cast("double").alias(c) for c in S.COUNTS + ["arr_delay"] + S.CAUSE_MINUTES],
        F.count_distinct("airport").cast("double").alias("unique_airports"),
        F.count_distinct("carrier").cast("double").alias("unique_carriers"),
    )
    return finish_overall(sums)


def finish_overall(sums):
    """The overall KPI vector from one row of sums and distinct counts."""
    c = {n: F.col(n) for n in sums.columns}
    causes = _add([c[m] for m in S.CAUSE_MINUTES])
    return sums.select(
        c["arr_flights"].alias("total_flights"),
        c["arr_del15"].alias("total_delayed"),
        ratio_zero(c["arr_del15"], c["arr_flights"]).alias("delay_rate"),
        ratio_zero(c["arr_cancelled"], c["arr_flights"]).alias("cancel_rate"),
        ratio_zero(c["arr_diverted"], c["arr_flights"]).alias("divert_rate"),
        ratio_zero(c["arr_delay"], c["arr_flights"]).alias("avg_delay_per_flight"),
        ratio_zero(c["arr_delay"], c["arr_del15"]).alias("avg_delay_per_delayed"),
        "unique_airports", "unique_carriers",
        *[F.when(causes > 0, ratio_null(c[m], causes)).alias(f"share_{m}") for m in S.CAUSE_MINUTES],
    )


def overall_long(df):
    """The KPI vector as (metric, value) rows; a metric that is absent has no row."""
    return overall(df).unpivot([], OVERALL_METRICS, "metric", "value").filter(F.col("value").isNotNull())


def by_month(df):
    """Sums, rates and cause shares per month. Rows without a month are left out."""
    summed = S.COUNTS + ["arr_delay"] + S.CAUSE_MINUTES
    monthly = df.filter(F.col("month").isNotNull()).groupBy("month").agg(*[total(c).alias(c) for c in summed])
    flights = F.col("arr_flights")
    causes = _add([F.col(c) for c in S.CAUSE_MINUTES])
    return monthly.select(
        "month", *summed,
        ratio_null(F.col("arr_del15"), flights).alias("delay_rate"),
        ratio_null(F.col("arr_cancelled"), flights).alias("cancel_rate"),
        ratio_null(F.col("arr_diverted"), flights).alias("divert_rate"),
        ratio_null(F.col("arr_delay"), flights).alias("avg_delay_per_flight"),
        *[ratio_null(F.col(c), causes).alias(f"share_{c}") for c in S.CAUSE_MINUTES],
    )


def on_month_spine(monthly):
    """Exactly the months 1..12; a month without data has NULL values."""
    spine = monthly.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    return spine.join(monthly, "month", "left")


def month_mean_index(monthly):
    """Each month's delay rate over the mean monthly rate. The window spans the 12 spine rows."""
    whole = Window.partitionBy()
    return on_month_spine(monthly.select("month", "delay_rate")).select(
        "month", "delay_rate",
        ratio_null(F.col("delay_rate"), F.avg("delay_rate").over(whole)).alias("month_index"),
    )
