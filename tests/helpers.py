from pyspark.sql import functions as F

from rateflow import schema as S


def observations(spark, rows):
    """Typed observation rows from dicts; what a dict leaves out is 0 or a fixed label."""
    base = {c: 0.0 for c in S.MEASURES} | {
        "year": 2025, "month": 1, "carrier": "AA", "carrier_name": "Alpha", "airport": "AB1", "airport_name": "Base",
        "arr_flights": 10.0}
    types = {"year": "int", "month": "int"} | {c: "string" for c in S.TEXT_COLUMNS}
    ddl = ", ".join(f"{c} {types.get(c, 'double')}" for c in S.REQUIRED)
    return spark.createDataFrame([tuple((base | r)[c] for c in S.REQUIRED) for r in rows], ddl)


def collected(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def same_rows(a, b):
    """Both frames hold the same rows, repeated rows as often."""
    columns = sorted(a.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def lit_rows(spark, values, name="payload"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n int, {name} string").withColumn(
        "arrival", F.lit("2025-01-01 00:00:30.5").cast("timestamp"))
