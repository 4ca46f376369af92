"""File sources and sinks: CSV, line-delimited JSON, the partitioned fact table, the report."""

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateflow import schema as S
from rateflow.operators.decode import with_parsed_json
from rateflow.operators.ingest import field_text
from rateflow.functions.scalars import trimmed
from rateflow.session import work_path

# Cell texts that mean "missing" in the historical CSV.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

#: Files whose heads are read at a time.
HEADS = 16


def text_schema(columns):
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _first_line(spark, file):
    """A file's path and its first line, read without the rest; compressed files by the codec of their name."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(file))
    stream = where.getFileSystem(conf).open(where)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        plain = codec.createInputStream(stream) if codec is not None else stream
        return where.toString(), jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def _files_by_header(spark, path):
    """The files under a path by their first line; empty files are left out.

    The driver opens each file and reads its head alone, several at a time. It holds file names, as Spark's own listing does.
    """
    files = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(HEADS) as pool:
        heads = list(pool.map(lambda f: _first_line(spark, f), files))
    found = {}
    for file, header in heads:
        if header is not None:
            found.setdefault(header, []).append(file)
    return found


def read_csv(spark, path, columns=None, multi_line=False):
    """CSV with a header, every column as text; normalize() gives the types.

    Values go by the names in each file's own header, so a folder may hold files
    with absent or reordered columns; what a file lacks is NULL. columns picks
    and orders columns by name. multi_line also reads line breaks inside quotes;
    such files cannot be split, so each is read by one task.
    """
    parts = []
    for files in _files_by_header(spark, path).values():
        reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
        names = reader.option("multiLine", False).csv(files[0]).columns
        reader = reader.option("multiLine", multi_line).option("enforceSchema", False)
        parts.append(reader.schema(text_schema(names)).csv(files))
    if not parts:
        return spark.createDataFrame([], text_schema(columns or []))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    absent = [c for c in columns or [] if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df
    return df.select(*[
        F.when(~F.col(f"`{c}`").isin(MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in columns or df.columns])


def write_csv(df, path, line_breaks=False):
    """CSV with a header. A text with a line break is an error, unless line_breaks says that the reader takes multi_line."""
    def checked(c):
        broken = F.col(f"`{c}`").rlike("[\r\n]")
        return F.when(broken, F.raise_error(F.concat(F.lit(f"line break in column {c}: "), f"`{c}`"))).otherwise(F.col(f"`{c}`"))

    if not line_breaks:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.select(*[checked(c).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_json_lines(spark, path, columns):
    """Parsed lines: (value, bad, the named columns as text). Blank lines are gone, bad lines are kept and marked.

    load_json_lines finds the columns by itself.
    """
    lines = spark.read.text(path).filter(trimmed(F.col("value")) != "")
    parsed = with_parsed_json(lines, "value", "_record")
    return parsed.select(
        "value", F.col("_record").isNull().alias("bad"),
        *[field_text(F.col("_record"), c).alias(c) for c in columns])


def _field_names(shown):
    """The field names in the text of a VARIANT schema, required ones first, then by name."""
    if shown is None or not shown.startswith("OBJECT<") or shown == "OBJECT<>":
        return []
    # Only the type names of objects differ from DDL; a field name in backticks is left as it is.
    ddl = "".join(part if i % 2 else part.replace("OBJECT<", "STRUCT<").replace("STRUCT<>", "STRING")
                  for i, part in enumerate(re.split("(`(?:[^`]|``)*`)", shown)))
    found = T.StructType.fromDDL(f"_all {ddl}")[0].dataType.names
    return [c for c in S.REQUIRED if c in found] + sorted(set(found).difference(S.REQUIRED))


def load_json_lines(spark, path, columns=None):
    """Good records and the number of bad lines; an error when no line is valid.

    The lines are read once: the pass that stores the parsed records in the
    shared folder also counts good and bad lines and finds the fields. Every field
    that any record has becomes a column, the required ones first, unless
    columns names the wanted ones.
    """
    lines = spark.read.text(path).filter(trimmed(F.col("value")) != "")
    parsed = with_parsed_json(lines, "value", "_record").select("_record")
    record, seen = F.col("_record"), Observation()
    is_object = F.try_variant_get(record, "$", "map<string,variant>").isNotNull()
    watched = parsed.observe(
        seen, F.count_if(record.isNotNull()).alias("good"), F.count_if(record.isNull()).alias("bad"),
        F.schema_of_variant_agg(F.when(is_object, record)).alias("fields"))
    stored = work_path(spark, "jsonlines")
    watched.filter(record.isNotNull()).write.parquet(stored)
    if seen.get["good"] == 0:
        raise ValueError("No valid JSON records found in generated file")
    names = _field_names(seen.get["fields"]) if columns is None else columns
    records = spark.read.schema(parsed.schema).parquet(stored)
    return records.select(*[field_text(record, c).alias(c) for c in names]), seen.get["bad"]


def write_json_lines(df, path):
    """One JSON object per line; a missing value is written as null."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_partitioned(df, path, mode="append"):
    """The stored layout: month partitions, rows sorted by (year, month, carrier, airport) within files.

    The rebalance hint lets Spark size the write tasks from measured data: small
    months share a task, a month holding most rows is split over many.
    """
    laid_out = df.hint("rebalance", "year", "month").sortWithinPartitions(*S.KEYS)
    laid_out.write.mode(mode).partitionBy("year", "month").parquet(path)


def write_report(report, path):
    """The report is a single row; it becomes one JSON document."""
    report.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
