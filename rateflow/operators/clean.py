"""Normalization, cleaning, row filters and slices."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateflow import schema as S
from rateflow.functions.scalars import (
    blank_to_null, computed_once, month_label, month_name, nan_to_null, number_or_missing, or_zero)

MAX_DELAY_MINUTES = 100_000


def normalize(df):
    """Coerce numeric columns (bad values to NULL) and trim text (blank to NULL).

    Columns that are absent are left absent; the quality rules report them. A
    column that is a number already is not read as text. The coerced columns are
    computed once per row, whatever filters and sums follow.
    """
    typed = {}
    for c in df.columns:
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        number = nan_to_null(F.col(c).cast("double")) if numeric else number_or_missing(F.col(c))
        if c in S.PERIOD:
            typed[c] = number.try_cast("int")
        elif c in S.MEASURES:
            typed[c] = number
        elif c in S.TEXT_COLUMNS:
            typed[c] = blank_to_null(F.col(c).cast("string"))
    if not typed:
        return df
    return computed_once(df, [c for c in df.columns if c not in typed], typed).select(*df.columns)


def clean_reference(df):
    """Missing measures to 0, then negative measures to 0."""
    return df.withColumns({c: F.greatest(or_zero(F.col(c)), F.lit(0).cast(df.schema[c].dataType)) for c in S.MEASURES})


def clean_counts(df):
    """How many cells clean_reference changes: filled_cells and clipped_cells, in one pass."""
    filled = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in S.MEASURES])
    clipped = reduce(lambda a, b: a + b, [F.count_if(F.col(c) < 0) for c in S.MEASURES])
    return df.agg(filled.alias("filled_cells"), clipped.alias("clipped_cells"))


def fill_missing_columns(df, columns=S.REQUIRED):
    """Add every absent column as 0, decided from the schema when the plan is built."""
    absent = {c: F.lit(0) for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


def filter_years(df, window="all"):
    """Keep all years, the last five ('last5'), or a (low, high) range in either order.

    A range that is not two whole numbers keeps all years.
    """
    if window == "last5":
        newest = df.agg(F.max("year")).scalar()
        return df.filter(F.col("year") >= newest - 4)
    if window != "all":
        try:
            low, high = sorted(int(y) for y in window)
        except (TypeError, ValueError):
            return df
        return df.filter(F.col("year").between(low, high))
    return df


def valid_predicate():
    """One conjunction: a record that may enter KPIs. Missing measures count as 0."""
    v = {c: f"coalesce({c}, 0)" for c in S.MEASURES}
    terms = [
        f"{v['arr_flights']} > 0",
        f"{v['arr_del15']} <= {v['arr_flights']}",
        f"{v['arr_delay']} >= 0",
        f"{v['arr_delay']} < {MAX_DELAY_MINUTES}",
        *[f"{v[c]} >= 0" for c in S.CAUSE_MINUTES],
        *[f"{v[c]} BETWEEN 0 AND {v['arr_del15']}" for c in S.CAUSE_COUNTS],
    ]
    return F.expr(" AND ".join(terms))


def valid_records(df):
    return df.filter(valid_predicate())


def valid_counts(df):
    """Rows kept and dropped by the valid-record rule."""
    ok = valid_predicate()
    return df.agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"))


def slice_period(df, year, months=None):
    """One year, optionally some months. An empty month list means all months."""
    out = df.filter(F.col("year") == year)
    return out.filter(F.col("month").isin(list(months))) if months else out


def slicer_values(df):
    """Distinct (year, month) pairs with display name and slicer label, ordered."""
    return (
        df.select("year", "month").distinct()
        .withColumns({"month_name": month_name(F.col("month")), "month_label": month_label(F.col("month"))})
        .orderBy("year", "month")
    )
