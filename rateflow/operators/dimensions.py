"""Canonical code-to-label dimensions, label checks and domain checks."""

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow import schema as S
from rateflow.session import settle

# A dimension is broadcast only when it was measured to be within both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 32


def _present(*columns):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.col(c) != "") for c in columns])


def label_counts(df, code, weight=None):
    """Rows per (code, label). weight names a column holding row counts of pre-aggregated input."""
    label = S.LABELS[code]
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.filter(_present(code, label)).groupBy(code, label).agg(rows.alias("n"))


def canonical(df, code, weight=None):
    """The most frequent label of every code; equal counts go to the smallest label.

    Counting comes first, so the ranking sees one row per (code, label), and
    Spark keeps one candidate per code and task before it shuffles again.
    """
    label = S.LABELS[code]
    best = Window.partitionBy(code).orderBy(F.desc("n"), F.asc(label))
    return (
        label_counts(df, code, weight)
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") == 1)
        .select(code, label)
    )


@dataclass(frozen=True)
class Measured:
    """A dimension that was computed into the shared folder, and whether it is small enough to broadcast."""

    code: str
    frame: DataFrame
    small: bool


def measure(dimension, code):
    """Compute a dimension once and measure it, for any number of joins."""
    label = S.LABELS[code]
    frame = settle(dimension.select(code, label), "dimension")
    size = frame.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(code) + F.octet_length(label)), F.lit(0)).alias("bytes"),
    ).first()
    return Measured(code, frame, size["n"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES)


def _hashable(kind):
    return not re.search(r"\b(map|variant)\b", kind.simpleString())


def attach_expected(df, dimension):
    """Left-join the canonical label of a measured dimension as `<label>_expected`; unmatched rows are kept.

    A small dimension is broadcast. With another the join is salted: every
    dimension row is repeated per salt, so a code holding a large part of the
    rows is spread over that many tasks.
    """
    code = dimension.code
    label = S.LABELS[code]
    dim = dimension.frame.select(code, F.col(label).alias(f"{label}_expected"))
    if dimension.small:
        return df.join(F.broadcast(dim), code, "left")
    others = [f.name for f in df.schema.fields if f.name != code and _hashable(f.dataType)]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*others), F.lit(SALTS)).cast("int"))
    spread = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, [code, "_salt"], "left").drop("_salt")


def canonicalize(df, carriers, airports):
    """Replace labels by those of two measured dimensions. Codes stay, a missing label stays missing."""
    joined = attach_expected(attach_expected(df, carriers), airports)
    replaced = {
        label: F.when(F.col(label).isNotNull(), F.coalesce(f"{label}_expected", label))
        for label in S.LABELS.values()
    }
    return joined.withColumns(replaced).select(*df.columns)


def mismatches(df, dimension, code, weight=None):
    """Distinct (code, label, expected) combinations whose label is not canonical, with row counts.

    Rows are counted per (code, label) first, so the join with the dimension
    meets one row per label, however many rows carry it.
    """
    label = S.LABELS[code]
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    ours = df.filter(F.col(code).isNotNull() & F.col(label).isNotNull()).groupBy(code, label).agg(rows.alias("n"))
    theirs = dimension.select(code, F.col(label).alias("expected"))
    return ours.join(theirs, code).filter(F.col(label) != F.col("expected")).select(
        F.lit(code).alias("domain"), F.col(code).alias("code"), F.col(label).alias("label"), "expected", "n")


def canonicalized_counts(df, carriers, airports, weight=None):
    """Rows whose carrier and airport label canonicalize changes."""
    wrong = mismatches(df, carriers, "carrier", weight).unionByName(mismatches(df, airports, "airport", weight))
    return wrong.agg(*[
        F.coalesce(F.sum(F.when(F.col("domain") == code, F.col("n"))), F.lit(0)).alias(f"{code}_labels_changed")
        for code in S.LABELS])


def first_per_domain(df, order, limit):
    """The first rows of every domain. There are two domains; only `limit` rows per task and domain are shuffled."""
    ranked = Window.partitionBy("domain").orderBy(*order)
    return df.withColumn("position", F.row_number().over(ranked)).filter(F.col("position") <= limit)


def multi_label_codes(df, code):
    """Codes that appear with more than one label."""
    label = S.LABELS[code]
    return (
        df.filter(F.col(code).isNotNull() & F.col(label).isNotNull())
        .select(code, label).distinct()
        .groupBy(code).agg(F.count(F.lit(1)).alias("labels"))
        .filter(F.col("labels") > 1)
        .select(F.lit(code).alias("domain"), F.col(code).alias("code"), "labels")
    )


def unknown_codes(candidate, reference, code):
    """Distinct codes of candidate that reference does not have. Both sides are reduced before they meet."""
    ours = candidate.select(code).filter(F.col(code).isNotNull()).distinct()
    theirs = reference.select(code).filter(F.col(code).isNotNull()).distinct()
    return ours.join(theirs, code, "left_anti").select(F.lit(code).alias("domain"), F.col(code).alias("code"))


def summarize_codes(codes, examples=10):
    """Per domain the number of codes and the first ones in order."""
    counted = codes.groupBy("domain").agg(F.count(F.lit(1)).alias("n"))
    shown = (
        first_per_domain(codes.select("domain", "code"), ["code"], examples)
        .groupBy("domain").agg(F.sort_array(F.collect_list("code")).alias("examples"))
    )
    return counted.join(shown, "domain")
