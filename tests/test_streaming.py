"""The breaker in event time, and collecting results while a job runs."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paperlane import cli, shared
from paperlane.operators import fleet
from paperlane.streaming import breaker, watch

T0 = datetime(2024, 1, 1)
FINISH = "job_id string, row_key string, status string, completed_at timestamp"


def run_breaker(spark, batches, folder, **options):
    """What the breaker has written once it has seen the batches, each a list of rows, and the end of the stream."""
    src, out, state = (f"{folder}/{x}" for x in ("in", "out", "state"))
    rows = None
    for b in [*batches, [(None, "end", "completed", datetime(2262, 1, 1))]]:
        spark.createDataFrame(b, FINISH).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(FINISH).parquet(src)
        rows = breaker.breaker(stream, **options)
        rows.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    written = spark.read.schema(rows.schema).parquet(out)
    return {r["job_id"]: (r["finished"], r["worst_rate"] and round(r["worst_rate"], 6), r["tripped_at_us"], r["tripped"]) for r in breaker.latest(written, options["limit"]).collect()}


def test_batches_do_not_matter(spark, tmp_path):
    """The same finishes in one batch and in several shuffled ones trip alike, and as the batch operator says."""
    rows = [(f"j{k}", f"{i:03d}", "failed" if (i * i + k) % (7 + k) == 0 else "completed", T0 + timedelta(seconds=i // 2)) for k in range(3) for i in range(60)]
    rows += [("few", "a", "failed", T0), ("few", "b", "processing", None)]
    shuffled = [rows[i::4] for i in (2, 0, 3, 1)]
    options = {"size": 20, "limit": 0.16, "late": "10 days"}
    once = run_breaker(spark, [rows], tmp_path / "one", **options)
    assert run_breaker(spark, shuffled, tmp_path / "many", **options) == once
    tasks = spark.createDataFrame([dict(zip(("job_id", "row_key", "status", "completed_at"), r)) for r in rows], FINISH)
    wanted = {r["job_id"]: (r["finished"], r["worst_rate"], r["tripped_at_us"]) for r in fleet.rolling_failure(tasks, 20, 0.16).collect()}
    assert {k: v[:3] for k, v in once.items()} == wanted and once["few"] == (1, None, None, False)
    assert {v[3] for v in once.values()} == {True, False} or all(v[3] for k, v in once.items() if k != "few")


def inventory_row(path, **more):
    return json.dumps({"rel_path": path, "file_name": path, "size_bytes": 3, "status": "ok", "searchable": True} | more)


def task_rows(spark, states):
    return spark.createDataFrame([("j", f"k{i}", name, status) for i, (name, status) in enumerate(states.items())], "job_id string, row_key string, file_name string, status string")


def test_files_are_read_until_they_are_whole(spark, tmp_path):
    """Half written, empty, of an open task, stubs, trailing data, one object over lines and one a line, and a rewrite."""
    root, out = tmp_path / "results", str(tmp_path / "out")
    whole = inventory_row("half.txt", job_id="j")
    bodies = {"a/a.json": inventory_row("a.txt", job_id="j") + " trailing {", "b/half.json": whole[:40], "c/empty.json": "", "d/open.json": inventory_row("open.txt", job_id="j"), "e/forwarded.json": '{"moved": 1}', "f/stub.json": '{"forwarded": true}',
              "job_id=j/part-0.json": "\n".join(inventory_row(f"p{i}.txt") for i in range(3)), "g/pretty.json": json.dumps(json.loads(inventory_row("pretty.txt")), indent=2), "_temporary/x.json": whole, "g/notes.txt": "no result", "h/twice.json": inventory_row("a.txt", job_id="j")}
    for name, body in bodies.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(body)
    done = ["a.txt", "half.txt", "p0.txt", "p1.txt", "p2.txt", "pretty.txt", "none.txt"]
    tasks = task_rows(spark, dict.fromkeys(done, "completed") | {"open.txt": "processing"})
    before = len(shared._made)
    assert watch.pass_once(spark, tasks, str(root), out) == watch.Pass(5, 6, 3) and len(shared._made) == before
    assert watch.pass_once(spark, tasks, str(root), out) == watch.Pass(0, 0, 3)
    (root / "b/half.json").write_text(whole)
    (root / "a/a.json").write_text(inventory_row("a.txt", job_id="j") + "\n\n")  # written anew: read again, taken once
    assert watch.pass_once(spark, tasks, str(root), out) == watch.Pass(1, 2, 2)
    tasks = task_rows(spark, dict.fromkeys([*done, "open.txt"], "completed"))
    (root / "c/empty.json").write_text(inventory_row("p9.txt"))
    assert watch.pass_once(spark, tasks, str(root), out) == watch.Pass(1, 1, 1)  # p9 has no task
    rows, missing = watch.collected(spark, tasks, out)
    assert sorted(r["rel_path"] for r in rows.collect()) == sorted(["a.txt", "half.txt", "p0.txt", "p1.txt", "p2.txt", "pretty.txt", "open.txt"])
    assert rows.filter("rel_path = 'p0.txt'").first()["job_id"] == "j" and [r["file_name"] for r in missing.collect()] == ["none.txt"]


def test_a_half_written_last_line(spark, tmp_path):
    root, out = tmp_path / "results", str(tmp_path / "out")
    root.mkdir()
    lines = [inventory_row(f"{i}.txt", job_id="j") for i in range(3)]
    (root / "r.json").write_text("\n".join(lines)[:-9])
    tasks = task_rows(spark, {f"{i}.txt": "completed" for i in range(3)})
    assert watch.pass_once(spark, tasks, str(root), out) == watch.Pass(2, 0, 1)
    (root / "r.json").write_text("\n".join(lines))
    assert watch.pass_once(spark, tasks, str(root), out) == watch.Pass(1, 1, 0)


def test_watch_ends_when_nothing_is_open(spark, tmp_path, capsys):
    """Results come while it waits; once no task is open it makes a last pass and ends. The shell does the same."""
    root, out = tmp_path / "results", str(tmp_path / "out")
    root.mkdir()
    states = {"a.txt": "completed", "b.txt": "processing", "c.txt": "pending"}
    (root / "a.json").write_text(inventory_row("a.txt", job_id="j"))
    waits = []

    def wait(s):
        waits.append(s)
        name = ["b.txt", "c.txt"][len(waits) - 1]
        states[name] = "completed"
        (root / f"{name}.json").write_text(inventory_row(name, job_id="j"))

    got = watch.watch(spark, lambda: task_rows(spark, states), str(root), out, 15, wait)
    assert got == watch.Pass(3, 3, 0) and waits == [15, 15]
    task_rows(spark, states | {"d.txt": "completed"}).write.parquet(str(tmp_path / "tasks"))
    cli.main(["collect", str(tmp_path / "tasks"), str(root), out, "--watch"], spark)
    assert json.loads(capsys.readouterr().out) == {"taken": 0, "files_read": 0, "files_left": 0}
    assert spark.read.option("header", True).csv(f"{out}/missing").collect()[0]["file_name"] == "d.txt" and spark.read.option("header", True).csv(f"{out}/inventory").count() == 3


def test_enqueue_and_diff(spark, tmp_path, capsys):
    root = tmp_path / "job7/files"
    root.mkdir(parents=True)
    for name in ("a.txt", "_b.doc", "c.txt"):
        (root / name).write_text("a@b.org" if name != "c.txt" else "nothing")
    cli.main(["scan", str(root), str(tmp_path / "inv")], spark)
    capsys.readouterr()
    cli.main(["enqueue", str(root), str(tmp_path / "work"), "--windows-queue", "--bde-threshold", "7"], spark)
    said = json.loads(capsys.readouterr().out)
    assert said["enqueued"] == 3 and said["job_id"].startswith("job7-job-") and json.loads((tmp_path / "job7/pii_job.json").read_text()) == {"bde_threshold": 7}
    assert {r["file_name"]: r["target_queue"] for r in spark.read.parquet(str(tmp_path / "work")).collect()} == {"a.txt": "linux", "_b.doc": "windows", "c.txt": "linux"}
    cli.main(["enqueue", str(root), str(tmp_path / "again"), "--inventory", str(tmp_path / "inv"), "--job-id", "x"], spark)
    assert json.loads(capsys.readouterr().out) == {"job_id": "x", "enqueued": 2}
    (root / "c.txt").write_text("SSN 123-45-6789")
    cli.main(["scan", str(root), str(tmp_path / "inv2")], spark)
    capsys.readouterr()
    cli.main(["diff", str(tmp_path / "inv"), str(tmp_path / "inv2")], spark)
    rows = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert {r["view"] for r in rows} == {"rules_decided", "verdicts", "columns", "transitions", "examples"}
    assert {"view": "verdicts", "before": "NR", "after": "R", "files": 1} in rows and any(r["view"] == "examples" and r["key"] == "c.txt" for r in rows)


def test_scopes_delete_what_they_hold(spark):
    kept = shared.written(spark.range(2), "kept")
    with pytest.raises(RuntimeError), shared.scoped(spark):
        inner = shared.written(spark.range(3), "inner")
        assert inner.count() == 3
        raise RuntimeError
    assert kept.count() == 2
    with pytest.raises(Exception):
        spark.read.schema("id long").parquet(inner.inputFiles()[0]).count()


def test_examples_are_few_before_they_are_sorted(spark):
    """The window keeps a few rows a column within each task before anything is shuffled."""
    from paperlane.operators import diff

    inv = spark.createDataFrame([(f"{i}", f"{i}.txt", i) for i in range(10)], "key string, rel_path string, row int")
    plan = diff.examples(inv, inv, ["rel_path"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and F is not None


class _Kept:
    """A state of one key in memory, with the number of its entries."""

    def __init__(self):
        self.rows, self.timers = {}, []

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return _Value()

    def registerTimer(self, ms):
        self.timers.append(ms)

    def keys(self):
        return iter(list(self.rows))

    def getValue(self, k):
        return self.rows[tuple(k)]

    def updateValue(self, k, v):
        self.rows[tuple(k)] = v

    def removeKey(self, k):
        del self.rows[tuple(k)]


class _Value:
    x = None

    def exists(self):
        return self.x is not None

    def get(self):
        return self.x

    def update(self, x):
        self.x = x


class _Watermark(int):
    def getCurrentWatermarkInMs(self):
        return int(self)


def test_the_breaker_keeps_pieces_of_days(tmp_path):
    """Twenty thousand finishes of three days are six entries of the state, not one each; passed in two steps, the first within a day, they are judged as in one."""
    import numpy as np
    import pandas as pd

    n, size = 20_000, 100
    rows = pd.DataFrame({"completed_at": pd.to_datetime(np.arange(n) // 2 * 25_000_000, unit="us"), "row_key": [f"{i:05d}" for i in range(n)]})
    rows["bad"] = [(i * i) % 13 == 0 for i in range(n)]
    shuffled = rows.sample(frac=1, random_state=3)
    kept = _Kept()
    b = breaker.Breaker(size, 0.075)
    b.init(kept)
    for half in (shuffled[: n // 2], shuffled[n // 2 :]):
        assert list(b.handleInputRows(("j",), iter([half[:3000], half[3000:]]), None)) == []
    days = rows["completed_at"].dt.date.nunique()
    assert days == 3 and len(kept.rows) == 6 and len(kept.timers) == 2
    middle = int(rows["completed_at"].iloc[n // 2].timestamp() * 1000)
    outs = [pd.concat(b.handleExpiredTimer(("j",), _Watermark(w), None)) for w in (middle, 10**13)]
    assert list(b.handleExpiredTimer(("j",), _Watermark(10**13), None)) == [] and not kept.rows
    failures = rows["bad"].rolling(size).sum().dropna()
    tripped = rows["completed_at"][failures.index[failures / size > 0.075][0]]
    assert [int(o["finished"].iloc[0]) for o in outs] == [n // 2, n] and outs[1]["worst_rate"].iloc[0] == failures.max() / size
    assert outs[1]["tripped_at_us"].iloc[0] == int(tripped.timestamp() * 1_000_000)
