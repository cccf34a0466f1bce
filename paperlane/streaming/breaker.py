"""The failure breaker in event time: a job's finishes are judged in the order of their completion, whatever batch they come in.

Finishes wait in the job's state until the watermark has passed them and are then taken in order, so the same rows in one batch or in
many, in any order, trip alike, and the outcome is that of ``fleet.rolling_failure``. A finish that is later than the watermark
allows is dropped by Spark.

The state of a job: the finishes that wait (a time, a key and an outcome each) in packed pieces by day, its last ``size`` outcomes, and its
numbers so far. Days are judged one after another, so what a job finishes in a day must fit a worker, however long ``late`` is. It needs
RocksDB as the state's store, which ``breaker`` sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "job_id string, finished long, worst_rate double, tripped_at_us long"
FINISHED = ("completed", "failed", "dead_lettered")
#: A finish of no job at this time, the last that comes, lets all that wait pass: for streams that end.
END_OF_STREAM = "2262-01-01 00:00:00"
DAY_US = 86_400_000_000
HELD = 1 << 18  # finishes of a job that are put into its state at a time


def _packed(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as w:
        w.write_table(rows)
    return out.getvalue().to_pybytes()


def _unpacked(pieces: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in pieces])


class Breaker(StatefulProcessor):
    def __init__(self, size: int, limit: float):
        self.size, self.limit = size, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "day long, piece long", "rows binary")
        self.pieces = handle.getValueState("pieces", "n long")
        self.so_far = handle.getValueState("so_far", "ring string, finished long, failures_in_worst long, tripped_at_us long")

    def _put(self, rows: pa.Table) -> None:
        """Adds finishes to those that wait, a piece for each day."""
        n = self.pieces.get()[0] if self.pieces.exists() else 0
        days = rows["t"].to_numpy() // DAY_US
        order = np.argsort(days, kind="stable")
        rows, days = rows.take(pa.array(order)), days[order]
        ends = [*(np.flatnonzero(np.diff(days)) + 1), len(days)]
        for start, end in zip([0, *ends], ends):
            self.waiting.updateValue((int(days[start]), n), (_packed(rows.slice(start, end - start)),))
            n += 1
        self.pieces.update((n,))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        last, held, n = None, [], 0
        for b in rows:
            if not len(b):
                continue
            t = b["completed_at"].to_numpy("datetime64[us]").astype(np.int64)
            held.append(pa.table({"t": t, "row_key": pa.array(b["row_key"], pa.string()), "bad": pa.array(b["bad"].astype(bool))}))
            last, n = max(int(t.max()), int(t.max()) if last is None else last), n + len(b)
            if n >= HELD:
                self._put(pa.concat_tables(held))
                held, n = [], 0
        if held:
            self._put(pa.concat_tables(held))
        if last is not None:
            self.handle.registerTimer(last // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        days: dict[int, list[tuple]] = {}
        for k in self.waiting.keys():
            if k[0] * DAY_US < passed:
                days.setdefault(k[0], []).append(tuple(k))
        state = before = self.so_far.get() if self.so_far.exists() else ("", 0, None, None)
        for day in sorted(days):
            rows = _unpacked([self.waiting.getValue(k)[0] for k in days[day]])
            ready = rows["t"].to_numpy() < passed
            if not ready.any():
                continue
            for k in days[day]:
                self.waiting.removeKey(k)
            if not ready.all():
                self._put(rows.filter(pa.array(~ready)))
            rows = rows.filter(pa.array(ready)).sort_by([(c, "ascending") for c in ("t", "row_key", "bad")])
            state = self._judged(*state, rows["t"].to_numpy(), rows["bad"].to_numpy().astype(np.int64))
        if state is before:
            return
        self.so_far.update(state)
        _, finished, worst, tripped = state
        rate = None if worst is None else worst / self.size
        yield pd.DataFrame({"job_id": [key[0]], "finished": [finished], "worst_rate": pd.array([rate], "Float64"), "tripped_at_us": pd.array([tripped], "Int64")})

    def _judged(self, ring: str, finished: int, worst: int | None, tripped: int | None, t: np.ndarray, outcomes: np.ndarray) -> tuple:
        """The numbers so far, carried on over finishes in their order."""
        bad = np.concatenate([np.array([c == "1" for c in ring], dtype=np.int64), outcomes])
        if len(bad) >= self.size:
            sums = np.concatenate([[0], np.cumsum(bad)])
            first = max(self.size, len(ring) + 1)  # the first number of outcomes that ends with a new one
            failures = sums[first:] - sums[first - self.size : len(bad) - self.size + 1]
            if len(failures):
                worst = max(int(failures.max()), -1 if worst is None else worst)
                over = np.flatnonzero(failures / self.size > self.limit)
                if tripped is None and len(over):
                    tripped = int(t[first + int(over[0]) - len(ring) - 1])
        return "".join("01"[b] for b in bad[-self.size :]), finished + len(t), worst, tripped

    def close(self) -> None:
        pass


def breaker(finished: DataFrame, size: int = 1000, limit: float = 0.05, late: str = "10 minutes") -> DataFrame:
    """Streaming (job_id, finished, worst_rate, tripped_at_us) of a job whenever finishes of it have passed the watermark.

    worst_rate is the greatest share of failures in ``size`` successive finishes so far (null before there are so many), tripped_at_us the
    completion from which on it was first above ``limit``. Of a job's rows the one with most finishes is the latest.
    """
    finished.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = finished.filter(F.col("completed_at").isNotNull() & F.col("status").isin(*FINISHED))
    rows = rows.select("job_id", F.coalesce("row_key", F.lit("")).alias("row_key"), "completed_at", (F.col("status") != "completed").alias("bad"))
    rows = rows.withWatermark("completed_at", late)
    return rows.groupBy("job_id").transformWithStateInPandas(Breaker(size, limit), OUT, "append", "eventTime")


def latest(rows: DataFrame, limit: float = 0.05) -> DataFrame:
    """From what a breaker has written: (job_id, finished, worst_rate, tripped_at_us, tripped) as it is now."""
    now = rows.filter("job_id IS NOT NULL").groupBy("job_id").agg(F.max_by(F.struct("finished", "worst_rate", "tripped_at_us"), "finished").alias("x"))
    return now.select("job_id", "x.*").withColumn("tripped", F.coalesce(F.col("worst_rate") > limit, F.lit(False)))
