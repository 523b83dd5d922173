"""Sinks: snapshots, the run ledger, plans, batches, results and the serving tables."""

from __future__ import annotations

import datetime as dt
import json
import socket
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUNS = "stage string, started_at timestamp, finished_at timestamp, host string, items_processed long, items_failed long, report string, error string"
SERVING = ("songs", "versions", "files", "issues")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def snapshot(df: DataFrame, root: str, stamp: str, keep: int = 20) -> list[str]:
    """Write df under root/stamp and delete all but the newest `keep` snapshots; returns those left.

    The new one is read back before anything is deleted: one that is empty,
    or whose write was not finished, pushes no older one out and is an error.
    """
    df.write.mode("errorifexists").parquet(f"{root}/{stamp}")
    fs, p = _fs(df.sparkSession, root)
    _, done = _fs(df.sparkSession, f"{root}/{stamp}/_SUCCESS")
    if not fs.exists(done) or df.sparkSession.read.schema(df.schema).parquet(f"{root}/{stamp}").isEmpty():
        raise ValueError(f"snapshot {stamp} is empty or unfinished; the older ones stay")
    names = sorted((s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()), reverse=True)
    for old in names[keep:]:
        fs.delete(df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{root}/{old}"), True)
    return names[:keep]


@contextmanager
def ledger(spark: SparkSession, path: str, stage: str) -> Iterator[dict]:
    """One row per run appended to path, also when the body raises.

    The body fills in items_processed, items_failed and report.
    """
    run: dict = {"items_processed": 0, "items_failed": 0, "report": {}}
    started, error = dt.datetime.now(dt.UTC).replace(tzinfo=None), None
    try:
        yield run
    except BaseException as e:
        error = f"{type(e).__name__}: {e}"
        raise
    finally:
        row = (stage, started, dt.datetime.now(dt.UTC).replace(tzinfo=None), socket.gethostname(), run["items_processed"], run["items_failed"], json.dumps(run["report"]), error)
        spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(path)


def write_plan(df: DataFrame, path: str) -> None:
    """Every planned action as a tab-separated row, with a header."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_report(df: DataFrame, path: str, limit: int = 100_000) -> None:
    """A small frame, a row per finding, as one JSON file of lines; refuses one that is no report but a table."""
    if (rows := df.count()) > limit:
        raise ValueError(f"{rows} rows are more than the {limit} of a report")
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_batches(df: DataFrame, order: list[str], path: str, size: int = 200) -> None:
    """JSON batches of `size` rows in order, one folder each; refuses to overwrite a run.

    Rows are ranked by range partition, so no task sees more than its range.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id())
    counts = ordered.groupBy("__p").count()
    base = counts.withColumn("__base", F.coalesce(F.sum("count").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__p", "__base")
    rank = F.col("__base") + F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    out = ordered.join(F.broadcast(base), "__p").withColumn("position", rank).withColumn("batch", F.floor((F.col("position") - 1) / size).cast("int"))
    out.drop("__p", "__base").write.mode("errorifexists").partitionBy("batch").json(path)


def read_results(spark: SparkSession, path: str, schema: str, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(good, rejected with `reason`) of JSON lines: a line goes as a whole, by the first rule it breaks.

    rules: reason -> SQL condition that a good row meets.
    """
    raw = spark.read.text(path).withColumn("r", F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    flat = raw.select("value", F.col("r._bad").isNotNull().alias("__bad"), "r.*").drop("_bad")
    reason = F.when(F.col("__bad"), "json")
    for name, rule in rules.items():
        reason = reason.when(~F.coalesce(F.expr(rule), F.lit(False)), name)
    checked = flat.withColumn("reason", reason)
    return checked.where("reason IS NULL").drop("value", "__bad", "reason"), checked.where("reason IS NOT NULL").select("value", "reason")


def write_serving(tables: dict[str, DataFrame], root: str, force: bool = False) -> None:
    """The four serving tables; refuses to replace one unless forced. Absolute file paths fail the export."""
    if set(tables) != set(SERVING):
        raise ValueError(f"expected {SERVING}")
    if not tables["files"].where(F.col("relpath").isNull() | F.col("relpath").startswith("/")).isEmpty():
        raise ValueError("files hold a null or absolute path")
    for name in SERVING:
        tables[name].write.mode("overwrite" if force else "errorifexists").parquet(f"{root}/{name}")


def cached(requests: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits with `response`, misses) of requests (request) by the SHA-256 of the request."""
    keyed = requests.withColumn("query_hash", F.sha2("request", 256))
    hits = keyed.join(cache.select("query_hash", F.col("response_json").alias("response")), "query_hash")
    return hits, keyed.join(cache, "query_hash", "left_anti").dropDuplicates(["query_hash"])
