"""Metrics over task rows of processing jobs.

A task row: job_id, row_key, file_name, status (pending, processing, completed, failed, dead_lettered), enqueued_at,
started_at, completed_at, duration_ms, attempt_count, worker_instance, tokens_in, tokens_out, file_size_bytes,
checkpoints (array of label, duration_ms, tokens_in, tokens_out, waited), error_message.

"Now" is always a parameter, so a result depends on its rows only. Times are compared in microseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import round_even
from ..shared import written

TASK_SCHEMA = (
    "job_id string, row_key string, file_name string, status string, enqueued_at timestamp, started_at timestamp, completed_at timestamp, duration_ms bigint, "
    "attempt_count int, worker_instance string, tokens_in bigint, tokens_out bigint, file_size_bytes bigint, "
    "checkpoints array<struct<label:string,duration_ms:bigint,tokens_in:bigint,tokens_out:bigint>>, error_message string"
)
# Legacy formats and what they are converted to.
CONVERTED = {".doc": ".docx", ".xls": ".xlsx", ".ppt": ".pptx"}


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def latest(changes: DataFrame) -> DataFrame:
    """The last state of each (job_id, row_key) among status changes with ``changed_at``; at one instant the later state of a task's life."""
    step = F.when(F.col("status") == "pending", 0).when(F.col("status") == "processing", 1).otherwise(2)
    w = Window.partitionBy("job_id", "row_key").orderBy(F.desc("changed_at"), step.desc())
    return changes.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def collapse_pairs(tasks: DataFrame) -> DataFrame:
    """Tasks without a legacy file's row where its converted form is in the same job.

    A legacy file and its converted form meet under the converted name, so the tasks are read once and not joined with themselves.
    """
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    ext = F.lower(F.regexp_extract("file_name", r"(\.[^.]*)$", 1))
    target = None
    for a, b in CONVERTED.items():
        target = F.when(ext == a, F.concat(stem, F.lit(b))) if target is None else target.when(ext == a, F.concat(stem, F.lit(b)))
    # rows without a name have none to share and are dealt out by their key
    rows = tasks.withColumn("__target", target).withColumn("__pair", F.coalesce("__target", "file_name", "row_key"))
    converted = F.max(F.coalesce(F.col("file_name") == F.col("__pair"), F.lit(False))).over(Window.partitionBy("job_id", "__pair"))
    rows = rows.withColumn("__converted", converted).filter(F.col("__target").isNull() | ~F.col("__converted"))
    return rows.drop("__target", "__pair", "__converted")


def job_list(tasks: DataFrame) -> DataFrame:
    """Each job's tasks, states and span of enqueueing, latest first."""
    by = tasks.groupBy("job_id", "status").agg(F.count("*").alias("n"), F.min("enqueued_at").alias("a"), F.max("enqueued_at").alias("b"))
    out = by.groupBy("job_id").agg(F.sum("n").alias("total"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("status", "n")))).alias("states"), F.min("a").alias("first_enqueued"), F.max("b").alias("last_enqueued"))
    return out.orderBy(F.desc("last_enqueued"), "job_id")


def latest_job(tasks: DataFrame) -> DataFrame:
    return tasks.agg(F.max_by("job_id", F.struct("enqueued_at", "job_id")).alias("job_id"))


def _counters() -> list[Column]:
    n = lambda s: F.count_if(F.col("status") == s)
    done = F.col("status") == "completed"
    return [
        F.count("*").alias("total"), n("completed").alias("completed"), n("processing").alias("processing"), n("pending").alias("pending"),
        F.count_if(F.col("status").isin("failed", "dead_lettered")).alias("failed"),
        F.count_if(F.col("attempt_count") > 1).alias("retried"), F.sum(F.greatest(F.col("attempt_count") - 1, F.lit(0))).alias("extra_attempts"),
        F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("total_bytes"), F.coalesce(F.sum("tokens_in"), F.lit(0)).alias("tokens_in"), F.coalesce(F.sum("tokens_out"), F.lit(0)).alias("tokens_out"),
        F.sum(F.when(done, F.col("duration_ms"))).alias("processing_ms")]


def _span() -> Column:
    return (F.max(micros(F.col("completed_at"))) - F.min(micros(F.col("started_at")))).alias("span_us")


def job_metrics(tasks: DataFrame) -> DataFrame:
    """One row per job: counts, retries, sums, workers, tokens, span."""
    return tasks.groupBy("job_id").agg(*_counters(), F.countDistinct("worker_instance").alias("workers"), _span())


def concurrency(tasks: DataFrame) -> DataFrame:
    """Peak number of tasks at once per job: a running sum over starts and ends, ends before starts at one instant.

    The greatest of ``concurrency_series``; at one instant starts come last, so its last number is its greatest.
    """
    return concurrency_series(tasks).groupBy("job_id").agg(F.max("active").alias("peak"))


def concurrency_series(tasks: DataFrame) -> DataFrame:
    """(job_id, t_us, active): how many tasks run from each instant on at which one starts or ends; those of no length count nowhere.

    Events are first summed by instant, so equal instants cost one row. The running sum goes by job and hour: each hour
    starts from the number still open before it, taken from the hours' own small table, so no job meets in one task.
    """
    rows = tasks.filter(F.col("completed_at") > F.col("started_at")).select("job_id", F.explode(_events()).alias("x"))
    return _active(rows.groupBy("job_id", "x.t").agg(F.sum("x.up").alias("up"), F.sum("x.down").alias("down")))


def _events() -> Column:
    """A task's start and end as array of struct<t, up, down>."""
    event = lambda t, up, down: F.struct(micros(F.col(t)).alias("t"), F.lit(up).alias("up"), F.lit(down).alias("down"))
    return F.array(event("started_at", 1, 0), event("completed_at", 0, 1))


def _active(ev: DataFrame) -> DataFrame:
    """From starts (up) and ends (down) by job and instant (t): (job_id, t_us, active)."""
    ev = ev.withColumn("hour", F.floor(F.col("t") / F.lit(3_600_000_000)))
    hours = ev.groupBy("job_id", "hour").agg(F.sum(F.col("up") - F.col("down")).alias("net"))
    before = Window.partitionBy("job_id").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select(F.col("job_id").alias("j"), F.col("hour").alias("h"), F.coalesce(F.sum("net").over(before), F.lit(0)).alias("open"))
    run = Window.partitionBy("job_id", "hour").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ev = ev.join(hours, (F.col("job_id") == F.col("j")) & (F.col("hour") == F.col("h")))
    return ev.select("job_id", F.col("t").alias("t_us"), (F.col("open") + F.sum(F.col("up") - F.col("down")).over(run)).alias("active"))


def _monitor_cells(tasks: DataFrame, now: Column, window_s: int, visibility_s: int) -> DataFrame:
    """One grouped sum over the tasks: a row of counters for each job (kind task), of each step's label (step), of each instant at which tasks start or end (event)."""
    empty = F.array().cast("array<struct<kind:string,label:string,t:bigint,up:int,down:int,ms:bigint>>")
    cell = lambda kind, label=None, t=None, up=0, down=0, ms=0: F.struct(F.lit(kind).alias("kind"), F.lit(label).cast("string").alias("label"), F.lit(t).cast("bigint").alias("t"), F.lit(up).cast("int").alias("up"), F.lit(down).cast("int").alias("down"), F.lit(ms).cast("bigint").alias("ms"))
    events = F.when(F.col("completed_at") > F.col("started_at"), F.transform(_events(), lambda e: cell("event", None, e["t"], e["up"], e["down"]))).otherwise(empty)
    steps = F.coalesce(F.transform("checkpoints", lambda c: cell("step", c["label"], None, 1, 0, c["duration_ms"])), empty)
    rows = tasks.select(*(c for c in tasks.columns if c != "checkpoints"), F.explode(F.concat(F.array(cell("task")), events, steps)).alias("x"))
    end, at, done = micros(F.col("completed_at")), micros(now), (F.col("status") == "completed") & F.col("completed_at").isNotNull()
    late = (F.col("status") == "processing") & (at - micros(F.col("started_at")) > visibility_s * 1_000_000)
    workers = F.collect_set(F.when(F.col("x.kind") == "task", F.col("worker_instance")))  # a job's workers, not its tasks
    return rows.groupBy("job_id", "x.kind", "x.label", "x.t").agg(
        *_counters(), F.size(workers).cast("long").alias("workers"), _span(), F.sort_array(F.filter(workers, lambda w: w != "")).alias("worker_names"), F.count_if(late).alias("stuck"),
        F.min(F.when(done, end)).alias("first_done"), F.count_if(done & (end >= at - window_s * 1_000_000)).alias("in_window"), F.count_if(F.col("status").isin("pending", "processing")).alias("remaining"),
        F.sum("x.up").alias("up"), F.sum("x.down").alias("down"), F.sum("x.ms").alias("ms"))


def job_monitor(tasks: DataFrame, now: Column, window_s: int = 300, visibility_s: int = 300) -> DataFrame:
    """One row per job with all a monitor shows: counts without legacy twins, sums, worker names, checkpoints, peak, throughput, time left, stuck tasks.

    The tasks are read once; what is written and read again are sums.
    """
    cells = written(_monitor_cells(collapse_pairs(tasks), now, window_s, visibility_s), "monitor")
    steps = cells.filter("kind = 'step'").groupBy("job_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", F.struct(F.col("up").alias("n"), "ms").alias("v"))))).alias("checkpoints"))
    peaks = _active(cells.filter("kind = 'event'").select("job_id", "t", "up", "down")).groupBy("job_id").agg(F.max("active").alias("peak"))
    out = cells.filter("kind = 'task'").join(steps, "job_id", "left").join(peaks, "job_id", "left").na.fill(0, ["peak"])
    rates = _rates(F.col("first_done"), F.col("in_window"), F.col("remaining"), micros(now), window_s)
    return out.select(*MONITOR, *rates, "stuck")


MONITOR = ["job_id", "total", "completed", "processing", "pending", "failed", "retried", "extra_attempts", "total_bytes", "tokens_in", "tokens_out", "processing_ms", "workers", "span_us", "worker_names", "checkpoints", "peak"]


def _rates(first: Column, in_window: Column, remaining: Column, at: Column, window_s: int) -> list[Column]:
    """Completions a minute since the window's start, or the first, and the minutes left; null where too little was seen."""
    span_us = at - F.greatest(first, at - window_s * 1_000_000)
    ok = (span_us >= 10_000_000) & (in_window >= 1)
    rate = in_window / (span_us / 60_000_000.0)
    eta = F.when(ok & (remaining > 0), remaining / rate)
    return [F.when(ok, round_even(rate, 1)).alias("per_minute"), round_even(eta * 0.7, 0).cast("long").alias("eta_low_min"), round_even(eta * 1.4, 0).cast("long").alias("eta_high_min")]


def trailing_throughput(tasks: DataFrame, now: Column, window_s: int = 300) -> DataFrame:
    """Completions a minute over the last ``window_s`` seconds, or since the first, of jobs that have completed any; null where too little was seen."""
    done, end, at = (F.col("status") == "completed") & F.col("completed_at").isNotNull(), micros(F.col("completed_at")), micros(now)
    sums = tasks.groupBy("job_id").agg(F.min(F.when(done, end)).alias("first"), F.count_if(done & (end >= at - window_s * 1_000_000)).alias("in_window"), F.count_if(F.col("status").isin("pending", "processing")).alias("remaining"))
    return sums.filter(F.col("first").isNotNull()).select("job_id", *_rates(F.col("first"), F.col("in_window"), F.col("remaining"), at, window_s))


def checkpoint_rollup(tasks: DataFrame) -> DataFrame:
    rows = tasks.select(F.explode("checkpoints").alias("c")).select("c.*")
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.sum("duration_ms").alias("total_ms"), round_even(F.avg("duration_ms"), 6).alias("avg_ms"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))


def checkpoint_offsets(tasks: DataFrame) -> DataFrame:
    """Each checkpoint's start in its task: the sum of earlier durations, within the row's own array."""
    sums = F.aggregate("checkpoints", F.array(F.lit(0).cast("long")), lambda a, c: F.concat(a, F.array(F.element_at(a, -1) + c["duration_ms"])))
    rows = tasks.withColumn("__starts", sums).select("job_id", "row_key", "__starts", F.posexplode("checkpoints").alias("pos", "c"))
    return rows.select("job_id", "row_key", "pos", "c.label", F.get("__starts", F.col("pos")).alias("offset_ms"), "c.duration_ms")


def duration_stats(tasks: DataFrame, *by: str) -> DataFrame:
    """count, total, mean, median, p95 (by rank, not interpolated), least and greatest duration of completed tasks.

    Ranks are running sums over distinct durations, which the group's milliseconds bound, not its rows.
    """
    rows = tasks.filter((F.col("status") == "completed") & F.col("duration_ms").isNotNull())
    if not by:
        rows, by = rows.withColumn("all_tasks", F.lit("all")), ("all_tasks",)
    each = rows.groupBy(*by, "duration_ms").agg(F.count("*").alias("k"))
    whole = Window.partitionBy(*by)
    each = each.withColumn("upto", F.sum("k").over(whole.orderBy("duration_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("n", F.sum("k").over(whole))
    d, upto, n = F.col("duration_ms"), F.col("upto"), F.col("n")

    def at(rank: Column) -> Column:  # 0-based
        return F.min(F.when(upto > rank, d))

    median = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2.0
    return each.groupBy(*by).agg(F.sum("k").alias("n"), F.sum(d * F.col("k")).alias("total_ms"), round_even(F.sum(d * F.col("k")) / F.sum("k"), 6).alias("avg_ms"), median.alias("median_ms"), at(F.least(F.floor(n * 0.95), n - 1)).alias("p95_ms"), F.min(d).alias("min_ms"), F.max(d).alias("max_ms"))


def worker_hours(tasks: DataFrame, price_per_hour: float = 0.0) -> DataFrame:
    """Workers' spans (first start to last end) and tasks an hour, by job; each worker is counted once a job."""
    w = tasks.filter(F.col("completed_at").isNotNull()).groupBy("job_id", "worker_instance").agg((F.max(micros(F.col("completed_at"))) - F.min(micros(F.col("started_at")))).alias("us"), F.count("*").alias("n"))
    out = w.groupBy("job_id").agg(F.count("*").alias("workers"), F.sum("us").alias("worker_us"), F.sum("n").alias("tasks"))
    hours = F.col("worker_us") / 3_600_000_000.0
    return out.withColumns({"worker_hours": round_even(hours, 6), "cost": round_even(hours * price_per_hour, 4)})


def wall_throughput(tasks: DataFrame) -> DataFrame:
    """Completed tasks an hour over the span of completion."""
    t = micros(F.col("completed_at"))
    out = tasks.filter(F.col("status") == "completed").groupBy("job_id").agg(F.count("*").alias("n"), (F.max(t) - F.min(t)).alias("us"))
    return out.withColumn("per_hour", round_even(F.col("n") / F.nullif(F.col("us") / 3_600_000_000.0, F.lit(0.0)), 4))


def timeline(tasks: DataFrame, minutes: int = 1) -> DataFrame:
    """Completions and failures by minute from the job's first start, with running totals.

    Windows run over a job's minutes, not its tasks.
    """
    start = tasks.groupBy("job_id").agg(F.min(micros(F.col("started_at"))).alias("t0"))
    rows = tasks.filter(F.col("completed_at").isNotNull()).select("job_id", "status", micros(F.col("completed_at")).alias("t")).join(start, "job_id")
    by = rows.groupBy("job_id", F.floor((F.col("t") - F.col("t0")) / F.lit(60_000_000 * minutes)).cast("long").alias("minute")).agg(F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status").isin("failed", "dead_lettered")).alias("failed"))
    w = Window.partitionBy("job_id").orderBy("minute").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return by.withColumn("completed_so_far", F.sum("completed").over(w))


LLM_STEP, WAIT_STEP = "azure_openai", "azure_openai_rate_limit_wait"  # fixed values: labels of checkpoints


def minute_series(tasks: DataFrame, llm_step: str = LLM_STEP, wait_step: str = WAIT_STEP) -> DataFrame:
    """Each job's minutes from its first start, none left out: completions by class of worker, tokens, and rate-limit events.

    A worker is of the class windows if it ever took a legacy format. An event is a model step of three times the job's
    upper median of such steps or more (30 s at least, 3 steps at least), or a wait of more than a second; it counts in
    the minute in which the step began.
    """
    minute = lambda t: F.floor((t - F.col("t0")) / F.lit(60_000_000)).cast("long")
    done = tasks.filter((F.col("status") == "completed") & F.col("completed_at").isNotNull() & F.col("started_at").isNotNull())
    spans = done.groupBy("job_id").agg(F.min(micros(F.col("started_at"))).alias("t0"), F.max(micros(F.col("completed_at"))).alias("t1"))
    spans = spans.withColumn("minutes", F.greatest(F.lit(2), F.floor((F.col("t1") - F.col("t0")) / F.lit(60_000_000)) + 2))
    ext = F.lower(F.regexp_extract("file_name", r"(\.[^.]*)$", 1))
    windows = tasks.filter(ext.isin(*CONVERTED)).select("job_id", "worker_instance").distinct().withColumn("windows", F.lit(True))
    rows = done.join(windows, ["job_id", "worker_instance"], "left").join(spans, "job_id")
    at = F.least(F.col("minutes") - 1, F.greatest(F.lit(0), minute(micros(F.col("completed_at")))))
    windows_n, linux_n = F.count_if(F.col("windows")), F.count_if(F.col("windows").isNull())
    files = rows.groupBy("job_id", at.alias("minute")).agg(linux_n.alias("linux"), windows_n.alias("windows"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))
    steps = checkpoint_offsets(tasks.filter(F.col("started_at").isNotNull())).filter(F.col("label").isin(llm_step, wait_step))
    # the upper median over distinct durations, which a job's milliseconds bound
    each = steps.filter((F.col("label") == llm_step) & (F.col("duration_ms") > 0)).groupBy("job_id", "duration_ms").agg(F.count("*").alias("k"))
    whole = Window.partitionBy("job_id")
    each = each.withColumn("upto", F.sum("k").over(whole.orderBy("duration_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("n", F.sum("k").over(whole))
    median = F.min(F.when(F.col("upto") > F.floor(F.col("n") / 2), F.col("duration_ms")))
    limits = each.groupBy("job_id").agg(F.when(F.max("n") >= 3, F.greatest(F.lit(30_000), 3 * median)).alias("limit_ms"))
    starts = tasks.select("job_id", "row_key", micros(F.col("started_at")).alias("s"))
    late = (F.col("label") == llm_step) & (F.col("duration_ms") >= F.col("limit_ms")) | (F.col("label") == wait_step) & (F.col("duration_ms") > 1000)
    events = steps.join(limits, "job_id", "left").filter(late).join(starts, ["job_id", "row_key"]).join(spans, "job_id")
    begun = F.least(F.col("minutes") - 1, F.greatest(F.lit(0), minute(F.col("s") + F.col("offset_ms") * 1000)))
    events = events.groupBy("job_id", begun.alias("minute")).agg(F.count("*").alias("rate_limited"))
    spine = spans.select("job_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("minutes") - 1)).alias("minute"))
    out = spine.join(files, ["job_id", "minute"], "left").join(events, ["job_id", "minute"], "left")
    return out.na.fill(0, ["linux", "windows", "tokens_in", "tokens_out", "rate_limited"])


def rolling_failure(tasks: DataFrame, size: int = 1000, limit: float = 0.05) -> DataFrame:
    """For each job: whether, and when first, more than ``limit`` of the last ``size`` finished tasks had failed.

    The order is the time of completion within a job, then the key. Failures up to the n-th finish less those up to the
    (n - size)-th are those of the last ``size``: running numbers are made by job and hour on top of the hours' own sums,
    and a join brings both ends together, so no job meets in one task.
    """
    done = tasks.filter(F.col("status").isin("completed", "failed", "dead_lettered") & F.col("completed_at").isNotNull())
    done = done.select("job_id", "row_key", micros(F.col("completed_at")).alias("t"), (F.col("status") != "completed").cast("int").alias("bad")).withColumn("hour", F.floor(F.col("t") / F.lit(3_600_000_000)))
    before = Window.partitionBy("job_id").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = done.groupBy("job_id", "hour").agg(F.count("*").alias("k"), F.sum("bad").alias("b"))
    hours = hours.select(F.struct("job_id", "hour").alias("id"), F.coalesce(F.sum("k").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bad0"))
    run = Window.partitionBy("job_id", "hour").orderBy("t", "row_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = done.withColumns({"i": F.row_number().over(run), "s": F.sum("bad").over(run)}).withColumn("id", F.struct("job_id", "hour")).join(hours, "id")
    rows = rows.select("job_id", "t", (F.col("n0") + F.col("i")).alias("n"), (F.col("bad0") + F.col("s")).alias("failures"))
    earlier = rows.select("job_id", (F.col("n") + size).alias("n"), F.col("failures").alias("earlier"))
    rows = rows.join(earlier, ["job_id", "n"], "left")
    rate = F.when(F.col("n") >= size, (F.col("failures") - F.coalesce("earlier", F.lit(0))) / F.lit(size))
    return rows.groupBy("job_id").agg(F.count("*").alias("finished"), round_even(F.max(rate), 6).alias("worst_rate"), F.min(F.when(rate > limit, F.col("t"))).alias("tripped_at_us"))


def stuck(tasks: DataFrame, now: Column, visibility_s: int = 300) -> DataFrame:
    """Tasks in processing for longer than the queue hides them."""
    age = micros(now) - micros(F.col("started_at"))
    return tasks.filter((F.col("status") == "processing") & (age > visibility_s * 1_000_000)).select("job_id", "row_key", "worker_instance", F.floor(age / 1_000_000).alias("age_s"))


def processing(tasks: DataFrame, now: Column) -> DataFrame:
    """Tasks in processing, longest first, unknown starts last."""
    age = F.floor((micros(now) - micros(F.col("started_at"))) / 1_000_000)
    return tasks.filter(F.col("status") == "processing").select("job_id", "row_key", "file_name", age.alias("elapsed_s")).orderBy(F.desc_nulls_last("elapsed_s"), "row_key")


def failures(tasks: DataFrame) -> DataFrame:
    return tasks.filter(F.col("status").isin("failed", "dead_lettered")).select("job_id", "row_key", "file_name", "status", "attempt_count", "error_message")


def token_total(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("job_id").agg((F.coalesce(F.sum("tokens_in"), F.lit(0)) + F.coalesce(F.sum("tokens_out"), F.lit(0))).alias("tokens"), F.count_if(F.col("status").isin("pending", "processing")).alias("open"))


def linux_projection(tasks: DataFrame, workers: int) -> DataFrame:
    """Files an hour if every worker ran only tasks of converted or modern formats."""
    ext = F.lower(F.regexp_extract("file_name", r"(\.[^.]*)$", 1))
    rows = tasks.filter((F.col("status") == "completed") & ~ext.isin(*CONVERTED))
    return rows.agg(F.count("*").alias("files"), round_even(workers * 3600.0 / F.nullif(F.avg("duration_ms") / 1000.0, F.lit(0.0)), 4).alias("files_per_hour"))


def queue_of(ext: Column, windows_queue: bool, legacy: tuple[str, ...] = tuple(CONVERTED)) -> Column:
    """The queue of a file: legacy formats go to the Windows queue if there is one."""
    return F.when(F.lower(ext).isin(*legacy) & F.lit(windows_queue), "windows").otherwise("linux")


def work_list(files: DataFrame, job_id: str, windows_queue: bool = False, done: DataFrame | None = None, base: Column | None = None) -> DataFrame:
    """One message for each file of a job: job_id, row_key, file_name, target_queue; files with a row in ``done`` (rel_path) are left out."""
    from ..functions.text import extension

    rows = files if done is None else files.join(done.select("rel_path").distinct(), "rel_path", "left_anti")
    name = F.col("rel_path") if base is None else base
    return rows.select(F.lit(job_id).alias("job_id"), F.sha2("rel_path", 256).alias("row_key"), name.alias("file_name"), queue_of(extension(F.col("rel_path")), windows_queue).alias("target_queue"))


def job_dir_of(path: Column) -> Column:
    """The folder above the deepest ``files`` folder of a path."""
    return F.regexp_extract(path, "^(.*)/files/", 1)


def located(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """manifest (rel_path, dest_name, label) with the path found: the same path, else the first file of that base name."""
    from ..functions.text import base_name

    paths = files.select(F.col("path").alias("p1")).distinct()
    names = files.groupBy(F.lower(base_name(F.col("path"))).alias("b")).agg(F.min("path").alias("p2"))
    m = manifest.withColumn("base", F.lower(base_name(F.col("rel_path"))))
    m = m.join(paths, F.col("rel_path") == F.col("p1"), "left").join(names, F.col("base") == F.col("b"), "left")
    out_name = F.coalesce(F.nullif("dest_name", F.lit("")), base_name(F.col("rel_path")))
    return m.select("rel_path", F.coalesce("p1", "p2").alias("found"), F.concat_ws("/", F.nullif("label", F.lit("")), out_name).alias("target"))
