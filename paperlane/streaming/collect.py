"""Incremental versions: collecting finished results, throughput by window, growth of dead letters.

Each takes a streaming DataFrame and returns a started query or a streaming DataFrame; with ``availableNow`` the same
code drains what is there and stops. Results append through Spark's own file sink, so a restart neither loses nor
repeats a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import round_even


def collect(results: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("job_id", "row_key"), available_now: bool = True) -> StreamingQuery:
    """Appends each result once to a Parquet table; forwarded stubs are seen but give no row."""
    rows = results
    if "forwarded" in results.columns:
        rows = rows.filter(~F.coalesce("forwarded", F.lit(False))).drop("forwarded")
    if results.isStreaming and "completed_at" in results.columns:
        # keys are remembered for a day after completion, so the state does not grow for ever
        rows = rows.withWatermark("completed_at", "1 day").dropDuplicatesWithinWatermark(list(keys))
    else:
        rows = rows.dropDuplicates(list(keys))
    w = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 seconds")).start()


def windowed_throughput(tasks: DataFrame, window: str = "5 minutes", slide: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Completions by job and sliding window, with a watermark for late rows when streaming."""
    rows = tasks.filter((F.col("status") == "completed") & F.col("completed_at").isNotNull())
    if rows.isStreaming:
        rows = rows.withWatermark("completed_at", late)
    by = rows.groupBy("job_id", F.window("completed_at", window, slide).alias("w")).agg(F.count("*").alias("completed"), F.sum("tokens_in").alias("tokens_in"))
    return by.select("job_id", F.col("w.start").alias("window_start"), "completed", "tokens_in")


def dead_letter_growth(snapshots: DataFrame, limit: float = 0.05, least: int = 100) -> DataFrame:
    """Snapshots (job_id, at, completed by one worker, dead_lettered, workers): whether dead letters grew too fast since a job's first snapshot.

    Growth is held against the completions of all workers, once these are ``least`` or more.
    """
    first = snapshots.groupBy("job_id").agg(F.min_by("dead_lettered", "at").alias("at_start"))
    grown = F.greatest(F.lit(0), F.col("dead_lettered") - F.col("at_start"))
    done = F.col("completed") * F.col("workers")
    share = grown / F.nullif(done.cast("double"), F.lit(0.0))
    return snapshots.join(first, "job_id").select("job_id", "at", ((done >= least) & F.coalesce(share > limit, F.lit(False))).alias("tripped"))


def poll_rate(snapshots: DataFrame) -> DataFrame:
    """Snapshots (job_id, at, tokens): tokens a second since the snapshot before."""
    from pyspark.sql import Window

    w = Window.partitionBy("job_id").orderBy("at")
    s = (F.unix_micros("at") - F.unix_micros(F.lag("at").over(w))) / 1_000_000.0
    return snapshots.select("job_id", "at", round_even((F.col("tokens") - F.lag("tokens").over(w)) / F.nullif(s, F.lit(0.0)), 4).alias("tokens_per_s"))
