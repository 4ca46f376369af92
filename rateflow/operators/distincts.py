"""Exact distinct counts that can be merged: codes get dense numbers from a dictionary, sets of numbers are bitmaps.

A bitmap covers 32,768 numbers, so a set is a row of 4 KB for every so many codes of the dictionary, however many rows it
stands for. Bitmaps are or-ed; sums are added; both may come from increments that share codes.
"""

from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.functions.scalars import total
from rateflow.operators import kpi, sampling

DOMAINS = ["airport", "carrier"]
SUMMED = S.COUNTS + ["arr_delay"] + S.CAUSE_MINUTES


def new_codes(known, codes):
    """(code, number) for the codes that `known` (the same columns, or None) lacks, numbered on from it.

    Numbering goes by buckets of a digest, without a global sort, and gives the same numbers again for the same input.
    """
    fresh = codes.where(F.col("code").isNotNull()).select("code").distinct()
    last = 0
    if known is not None:
        fresh = fresh.join(known.select("code"), "code", "left_anti")
        last = known.agg(F.max("number")).first()[0] or 0
    numbered = sampling.number_rows(fresh, F.sha2("code", 256), offset=last)
    return numbered.select("code", F.col("template_id").alias("number"))


def code_sets(df, dictionary, keys, code):
    """keys, bucket, codes: the set of a column's codes for every key. Pairs are made distinct before they are joined."""
    pairs = df.select(*keys, F.col(code).alias("code")).where("code IS NOT NULL").distinct()
    numbers = pairs.join(dictionary, "code")
    return numbers.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("codes"))


def merge_sets(sets, keys):
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("codes").alias("codes"))


def set_sizes(sets, keys):
    """The number of distinct codes of every key."""
    merged = merge_sets(sets, keys)
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("codes")).alias("n"))


def kpi_sums(df):
    """Additive part of the KPI vector per year and month."""
    return df.groupBy("year", "month").agg(*[total(c).cast("double").alias(c) for c in SUMMED])


def kpi_sets(df, dictionaries):
    """year, month, domain, bucket, codes. dictionaries maps each of DOMAINS to its (code, number) frame."""
    parts = [code_sets(df, dictionaries[d], ["year", "month"], d).withColumn("domain", F.lit(d)) for d in DOMAINS]
    return parts[0].unionByName(parts[1])


def kpi_overall(sums, sets):
    """The overall KPI vector from the sums and sets of any increments, or of those of some months."""
    row = sums.agg(*[total(c).cast("double").alias(c) for c in SUMMED])
    sizes = set_sizes(sets, ["domain"]).agg(*[
        F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)).cast("double").alias(f"unique_{d}s")
        for d in DOMAINS])
    return kpi.finish_overall(row.crossJoin(F.broadcast(sizes)))  # one row each
