"""Session helpers: building a local session and finding the shared work folder."""

import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores="*", shuffle_partitions=8, app_name="rateflow"):
    """A session for tests and benchmarks; on a cluster use the cluster's own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.streaming.ui.enabled", "false")
        .getOrCreate()
    )


@functools.cache
def _local_folder():
    return tempfile.mkdtemp(prefix="rateflow-")


def shared_folder(spark):
    """The folder every executor can reach, as the session names it in spark.checkpoint.dir.

    A local session that names none gets a temporary folder; a cluster that
    names none is an error, because a machine-local folder is lost with its
    machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = _local_folder()
    return folder.rstrip("/")


def work_path(spark, name):
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/rateflow/{name}-{uuid.uuid4().hex}"


#: Rows for one task of costly work per row.
ROWS_PER_PIECE = 50_000


def pieces_for(df, least, rows=ROWS_PER_PIECE):
    """Tasks for a table's rows: at least `least`, and so many that each has about `rows` rows or fewer.

    Counts the rows, which Parquet files tell without being read.
    """
    return max(least, -(-df.count() // rows))


def spread(df, pieces):
    """For costly work per row on an input that comes in few pieces: rows are dealt out to so many tasks.

    No number leaves the rows where they are.
    """
    return df.repartition(pieces) if pieces else df


def settle(df, name):
    """Compute a reduced DataFrame once, as a table in the shared folder, and continue from that table.

    This cuts the lineage, survives lost executors, lets later steps read only
    the columns they need, and gives the optimizer the table's real size.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
