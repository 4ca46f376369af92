"""Canonical labels from increments: additive label counts, and a bounded summary that tells which of them matter.

The summary keeps at most `size` labels of a code with counters, after Misra and Gries (Space-Saving keeps the same labels,
with counters raised by the cut): what a code's counters lose to make room is its `cut`. A counter plus
the cut is never under a label's true count, so a label that is not kept has at most `cut` rows. The best kept label by exact counts is
canonical for sure if it has more than that; the other codes are settled from all their counts. The result is always exact.
"""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow import schema as S

SIZE = 64


def count_labels(df, code):
    """code, label, n: rows per code and label, both known, the label possibly empty. Additive."""
    c, label = F.col(code), F.col(S.LABELS[code])
    known = df.where(c.isNotNull() & (c != "") & label.isNotNull())
    return known.groupBy(c.alias("code"), label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


def merge_counts(counts):
    return counts.groupBy("code", "label").agg(F.sum("n").alias("n"))


def summarize(counts, before=None, size=SIZE):
    """code, cut, kept (at most `size` of label and n): the summary `before` with an increment of counts.

    A code's labels are ranked, of which each task sends size + 1 at most; so a code with many labels stays small.
    """
    rows = counts.where("label <> ''").select("code", "label", "n", F.lit(0).cast("bigint").alias("cut"))
    if before is not None:
        held = before.select("code", F.explode_outer("kept").alias("k"), "cut")
        rows = rows.unionByName(held.select("code", "k.label", F.coalesce("k.n", F.lit(0).cast("bigint")).alias("n"), "cut"))
    rows = rows.groupBy("code", "label").agg(F.sum("n").alias("n"), F.max("cut").alias("cut"))
    by_count = Window.partitionBy("code").orderBy(F.desc("n"), F.asc("label"))
    top = rows.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= size + 1)
    entry = F.struct("label", "n")
    codes = top.groupBy("code").agg(
        F.coalesce(F.max(F.when(F.col("rank") == size + 1, F.col("n"))), F.lit(0)).alias("lost"),
        F.collect_list(F.when(F.col("rank") <= size, entry)).alias("all"))
    cuts = rows.groupBy("code").agg(F.max("cut").alias("cut"))
    left = F.filter(F.transform("all", lambda e: F.struct(e["label"].alias("label"), (e["n"] - F.col("lost")).alias("n"))),
                    lambda e: e["label"].isNotNull() & (e["n"] > 0))
    return codes.join(cuts, "code").select("code", (F.col("cut") + F.col("lost")).alias("cut"), F.array_sort(left).alias("kept"))


def _best(counts):
    order = Window.partitionBy("code").orderBy(F.desc("n"), F.asc("label"))
    return counts.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def canonical(counts, summary):
    """code, label, n: the most frequent label of every code, equal counts to the smallest, as from all rows.

    Only the counts of kept labels are added up, and all counts only of codes that those don't settle.
    """
    counts = counts.where("label <> ''")
    kept = summary.select("code", "cut", F.explode("kept").alias("k")).select("code", "k.label", "cut")
    exact = merge_counts(counts.join(kept.select("code", "label"), ["code", "label"], "left_semi"))
    best = _best(exact).join(summary.select("code", "cut"), "code", "right")
    sure = best.where(F.col("n") > F.col("cut")).select("code", "label", "n")
    open_codes = best.where(F.col("n").isNull() | (F.col("n") <= F.col("cut"))).select("code")
    return sure.unionByName(_best(merge_counts(counts.join(open_codes, "code", "left_semi"))))
