"""Collecting results while a job runs: pass after pass until nothing is open.

A pass lists the result files, reads those that the ledger does not hold, and appends what is new. A file goes to the ledger once all in it
was read and taken, or was a stub of a task that went elsewhere. One that is half written, or whose task is not completed yet, does
not, so the next pass reads it again; the lines of it that are good are taken meanwhile. A row is known by its job and file, so nothing
is taken twice, also when a pass dies between its two writes or a file is written anew.

Ledger and rows are Parquet tables below ``out``; a later run goes on where this one stopped.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.schema import INVENTORY_SCHEMA
from ..plans.settings import Settings
from ..shared import scoped, written
from ..sources import files, listing

ROWS = T.StructType([*INVENTORY_SCHEMA.fields, T.StructField("job_id", T.StringType())])
LEDGER = "place binary, size_bytes long, modified timestamp"
_PARSED = T.StructType([*ROWS.fields, T.StructField("forwarded", T.BooleanType()), T.StructField("unread", T.StringType())])
OPEN = ("pending", "processing")


class Pass(NamedTuple):
    taken: int  # rows that are new
    files_read: int  # files that need not be read again
    files_left: int  # files that could not be read in full, or whose task is open


def _table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _parsed(spark: SparkSession, found: DataFrame, root: str) -> DataFrame:
    """A row for each JSON object of each file: place, size_bytes, modified, x (struct of _PARSED; unread is set where it could not be parsed).

    A file holds one object, over any number of lines and with anything after it, or one object a line.
    """
    held = files.with_bytes(found, root, Settings().max_bytes).withColumn("text", files.text_of(F.coalesce("content", F.lit(b""))))
    object_of = lambda text: F.from_json(text, _PARSED, {"columnNameOfCorruptRecord": "unread", "mode": "PERMISSIVE"})
    lines = F.filter(F.split("text", "\r?\n"), lambda x: F.trim(x) != "")
    by_line = F.get(lines, F.lit(0)).rlike(r"^\s*\{.*\}\s*$")
    pieces = F.when(by_line & (F.size(lines) > 1), lines).otherwise(F.array("text"))
    rows = held.select("place", "rel_path", "size_bytes", "modified", F.explode(pieces).alias("piece"))
    rows = rows.select("place", "rel_path", "size_bytes", "modified", object_of(F.col("piece")).alias("x"), (F.trim("piece") == "").alias("empty"))
    folder = F.nullif(F.regexp_extract("rel_path", "(?:^|/)job_id=([^/]*)/", 1), F.lit(""))
    stub = F.coalesce("x.forwarded", F.lit(False)) | F.lower("rel_path").rlike("(^|/)forwarded\\.json$")
    unread = F.col("empty") | F.col("x.unread").isNotNull() | F.col("x").isNull() | (F.col("x.rel_path").isNull() & ~stub)
    values = [F.coalesce("x.job_id", folder).alias("job_id") if f.name == "job_id" else F.col(f"x.{f.name}") for f in ROWS]
    return rows.select("place", "size_bytes", "modified", unread.alias("bad"), stub.alias("stub"), F.struct(*values).alias("row"))


def pass_once(spark: SparkSession, tasks: DataFrame, results: str, out: str) -> Pass:
    """One pass over the result files below ``results``; tasks say which are completed (file_name is the row's rel_path)."""
    with scoped(spark):
        ledger, taken = _table(spark, f"{out}/files", LEDGER), _table(spark, f"{out}/rows", ROWS)
        found = listing.files_below(spark, results).filter(F.lower("rel_path").endswith(".json") & F.col("problem").isNull() & ~F.col("rel_path").rlike("(^|/)[_.][^/]*"))
        todo = written(found.join(ledger, ["place", "size_bytes", "modified"], "left_anti"), "watch-files")
        parsed = written(_parsed(spark, todo, results), "watch-parsed")
        done = tasks.filter("status = 'completed'").select(F.col("job_id").alias("done_job"), F.col("file_name").alias("done_file")).distinct()
        good = parsed.filter("NOT bad AND NOT stub").select("place", "row.*")
        # results without a job of their own count for any job that completed the file
        same = (F.col("rel_path") == F.col("done_file")) & (F.col("job_id").isNull() | (F.col("job_id") == F.col("done_job")))
        ready = written(good.join(done, same, "left_semi"), "watch-ready")
        new = ready.drop("place").dropDuplicates(["job_id", "rel_path"])
        old = taken.select(F.col("job_id").alias("old_job"), F.col("rel_path").alias("old_file"))
        new = written(new.join(old, F.col("job_id").eqNullSafe(F.col("old_job")) & (F.col("rel_path") == F.col("old_file")), "left_anti"), "watch-new")
        new.write.mode("append").parquet(f"{out}/rows")
        counts = parsed.groupBy("place").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad") & ~F.col("stub")).alias("rows"))
        counts = counts.join(ready.groupBy("place").agg(F.count("*").alias("ready")), "place", "left")
        whole = counts.filter((F.col("bad") == 0) & (F.col("rows") == F.coalesce("ready", F.lit(0)))).select("place")
        read = written(todo.join(whole, "place", "left_semi").select("place", "size_bytes", "modified"), "watch-read")
        read.write.mode("append").parquet(f"{out}/files")
        n = read.count()
        return Pass(new.count(), n, todo.count() - n)


def watch(spark: SparkSession, tasks: Callable[[], DataFrame], results: str, out: str, poll_s: float = 15.0, wait: Callable[[float], None] = time.sleep, most_passes: int = 0) -> Pass:
    """Passes until no task is pending or processing, and one more after that; returns their sums, and the files left by the last.

    ``tasks`` gives the task rows as they are at each pass. ``most_passes`` (0: no limit) is for callers that have no end.
    """
    taken = read = passes = 0
    while True:
        drained = tasks().filter(F.col("status").isin(*OPEN)).isEmpty()  # asked before the pass, so the pass sees what was written until then
        last = pass_once(spark, tasks(), results, out)
        taken, read, passes = taken + last.taken, read + last.files_read, passes + 1
        if drained or passes == most_passes:
            return Pass(taken, read, last.files_left)
        wait(poll_s)


def collected(spark: SparkSession, tasks: DataFrame, out: str) -> tuple[DataFrame, DataFrame]:
    """What was taken so far, and the completed tasks (job_id, file_name) without a row."""
    rows = _table(spark, f"{out}/rows", ROWS)
    done = tasks.filter("status = 'completed'").select("job_id", "file_name").distinct()
    have = rows.select(F.col("job_id").alias("j"), F.col("rel_path").alias("f"))
    missing = done.join(have, (F.col("file_name") == F.col("f")) & (F.col("j").isNull() | (F.col("job_id") == F.col("j"))), "left_anti")
    return rows, missing
