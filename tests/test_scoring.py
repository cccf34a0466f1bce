"""Scoring, samples, comparison, fleet metrics and streams on small inputs."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paperlane.operators import diff, fleet, reports, score
from paperlane.plans.schema import COLUMNS, INVENTORY_SCHEMA, ZERO
from paperlane.streaming import collect as streaming


def inv(spark, rows):
    full = [tuple((r | {}).get(n, ZERO[k]) for n, k in COLUMNS) for r in rows]
    return spark.createDataFrame(full, INVENTORY_SCHEMA).withColumn("row", F.monotonically_increasing_id())


ROWS = [{"rel_path": f"{n}.txt", "file_name": f"{n}.txt", "suggested_lane": lane, "estimated_entities": e} for n, lane, e in (("a", "standard", 100), ("b", "likely_non_responsive", 0), ("c", "bde", 60), ("d", "likely_non_responsive", 3))]


def test_benchmark_modes(spark):
    gold = spark.createDataFrame([("a.txt", "R", ""), ("B.TXT", "NR", "")], "id string, responsive string, bde string")
    one = score.benchmark(inv(spark, ROWS), gold).first()
    assert (one["tp"], one["fp"], one["fn"], one["tn"]) == (1, 0, 0, 1)
    zero = score.benchmark(inv(spark, ROWS), gold, "zero").first()
    assert (zero["tp"], zero["fp"], zero["fn"], zero["tn"], zero["assumed_nr"]) == (1, 1, 0, 2, 2)


def test_benchmark_thresholds(spark):
    gold = spark.createDataFrame([("a.txt", "100", "100"), ("x/b.txt", "0", "0"), ("c.txt", "60", "60"), ("d.txt", "3", "3"), ("lost", "1", ""), ("a.txt", "", "")], "id string, responsive string, bde string")
    r = score.benchmark(inv(spark, ROWS), gold, bde_threshold=51).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"], r["unmatched"], r["unscored_blank_label"], r["bde_accuracy"]) == (2, 0, 1, 1, 1, 1, 1.0)
    few = inv(spark, [ROWS[0] | {"estimated_entities": 10}])
    yes = spark.createDataFrame([("a.txt", "yes", "yes")], "id string, responsive string, bde string")
    assert [score.benchmark(few, yes, bde_threshold=t).first()["bde_accuracy"] for t in (51, 7)] == [0.0, 1.0]


def test_headers():
    assert score.pick_column(["Doc", "File Name", "Responsive/NR"], score.ID_HINTS) == "File Name"
    assert score.pick_column(["My Determination x"], score.RESPONSIVE_HINTS) == "My Determination x"
    assert score.pick_column(["a"], score.ID_HINTS) is None


def test_verdicts(spark):
    df = spark.createDataFrame([("standard", True, "likely_non_responsive"), ("likely_non_responsive", True, "standard"), ("needs_parser", True, "standard"), ("bde", False, ""), ("needs_parser", False, "")], "suggested_lane string, s2_ran boolean, s2_lane string")
    got = [tuple(r) for r in df.select(score.stage1_call(), score.stage2_call(), score.pipeline_call(), score.verdict(), score.union_call()).collect()]
    assert got == [(True, False, False, False, True), (False, True, False, False, True), (None, True, None, True, True), (True, None, True, True, True), (None, None, None, None, None)]


def test_truth_join_and_counts(spark):
    rows = inv(spark, [r | {"is_bde": r["estimated_entities"] > 6} for r in ROWS])
    export = spark.createDataFrame([("A.pdf", "1,200"), ("a.txt", "3"), ("c", "10"), ("d", ""), ("d", "x")], "id string, total string")
    scored = score.joined_truth(rows, export)
    assert {r["id"]: r["human"] for r in scored.collect()} == {"a": 1200, "c": 10}
    assert {r["id"]: r["human"] for r in score.joined_truth(rows, export, "zero").collect()} == {"a": 1200, "b": 0, "c": 10, "d": 0}
    acc = score.count_accuracy(scored).first()
    assert (acc["n_true_bde"], acc["median_err"], acc["mean_err"]) == (2, 1100, 575.0)
    assert score.metrics_by_type(scored).count() == 70


def test_empty_scoring(spark):
    rows = inv(spark, [])
    gold = spark.createDataFrame([], "id string, responsive string, bde string")
    assert score.benchmark(rows, gold).first()["responsive_f1"] == 0.0
    assert reports.tally(rows).first()["files"] == 0


def test_extrapolation(spark):
    rows = inv(spark, [{"rel_path": f"{i}.pdf", "ext": ".pdf", "suggested_lane": "nonsearchable_sample", "complexity_bucket": "5-10 pages"} for i in range(100)])
    drawn = reports.draw_sample(rows)
    assert drawn.count() == 5 and sorted(map(tuple, drawn.collect())) == sorted(map(tuple, reports.draw_sample(rows).collect()))
    coded = spark.createDataFrame([("5-10 pages", "1", "True")] + [("5-10 pages", "0", "")] * 4, "complexity_bucket string, gold_responsive string, gold_bde string")
    r = reports.extrapolate(rows, coded).first()
    assert (r["# of Files"], r["# of Responsive (Predicted)"], r["# of BDEs (Predicted)"], r["% Responsive"], r["File Type"]) == (100, 20, 20, "20%", ".pdf")


def test_comparison(spark):
    a, b = inv(spark, ROWS), inv(spark, [ROWS[0] | {"suggested_lane": "bde"}, ROWS[1], ROWS[2] | {"llm_consulted": True, "suggested_lane": "standard"}])
    ka, kb = (diff.keyed(x, F.col("rel_path")) for x in (a, b))
    r = diff.rules_decided(ka, kb).first()
    assert (r["common"], r["only_a"], r["only_b"], r["rules_decided"], r["moved"]) == (3, 1, 0, 2, 1)
    assert {(x["column"], x["before"], x["after"]) for x in diff.column_changes(ka, kb, ["suggested_lane"]).collect()} == {("suggested_lane", "standard", "bde"), ("suggested_lane", "bde", "standard")}
    assert {(x["before"], x["after"]): x["files"] for x in diff.verdict_changes(ka, kb).collect()} == {("R", "R"): 2, ("NR", "NR"): 1, ("NR", "absent"): 1}
    assert diff.map_differences({"a": 1, "b": 2}, {"a": 1, "c": 3}) == {"b": (2, None), "c": (None, 3)}


T0 = datetime(2024, 1, 1)


def task(job, key, start, end, status="completed", name=None, worker="w1"):
    at = lambda s: None if s is None else T0 + timedelta(seconds=s)
    ms = None if start is None or end is None else int((end - start) * 1000)
    return (job, key, name or f"{key}.txt", status, T0, at(start), at(end), ms, 1, worker, 10, 1, 100, [("extract", 10, 1, 0), ("llm", 20, 2, 1)], None)


def tasks(spark, rows):
    return spark.createDataFrame(rows, fleet.TASK_SCHEMA)


def test_concurrency(spark):
    t = tasks(spark, [task("j", "a", 0, 10), task("j", "b", 10, 20), task("k", "a", 0, 10), task("k", "b", 5, 7), task("k", "c", 6, 6), task("k", "d", 9, 8000), task("k", "e", 7500, 7600)])
    assert {r["job_id"]: r["peak"] for r in fleet.concurrency(t).collect()} == {"j": 1, "k": 2}


def test_pairs(spark):
    t = tasks(spark, [task("j", "a", 0, 1, name="report.doc"), task("j", "b", 0, 1, name="report.docx"), task("j", "c", 0, 1, name="lone.doc"), task("k", "d", 0, 1, name="report.doc")])
    assert sorted(r["row_key"] for r in fleet.collapse_pairs(t).collect()) == ["b", "c", "d"]


def test_stats(spark):
    t = tasks(spark, [task("j", str(i), 0, i) for i in range(1, 21)])
    r = fleet.duration_stats(t).first()
    assert (r["n"], r["median_ms"], r["p95_ms"], r["min_ms"], r["max_ms"]) == (20, 10500.0, 20000, 1000, 20000)
    o = fleet.checkpoint_offsets(t.limit(1)).orderBy("pos").collect()
    assert [(x["label"], x["offset_ms"]) for x in o] == [("extract", 0), ("llm", 10)]


def test_throughput_and_stuck(spark):
    now = F.lit(T0 + timedelta(seconds=600))
    t = tasks(spark, [task("j", "a", 0, 590), task("j", "b", 0, 595), task("j", "c", 0, 100), task("j", "d", 0, None, "processing"), task("n", "e", None, None, "pending")])
    rows = {r["job_id"]: r for r in fleet.trailing_throughput(t, now).collect()}
    assert rows["j"]["per_minute"] == 0.4 and "n" not in rows
    assert [r["age_s"] for r in fleet.stuck(t, now).collect()] == [600]
    assert fleet.latest_job(t).first()[0] in ("j", "n")


def test_rolling_and_latest(spark):
    t = tasks(spark, [task("j", f"{i:03d}", 0, i + 1, "failed" if i in (5, 6) else "completed") for i in range(20)])
    r = fleet.rolling_failure(t, 10, 0.1).first()
    assert r["worst_rate"] == pytest.approx(0.2) and r["tripped_at_us"] == int((T0 - datetime(1970, 1, 1)).total_seconds() + 10) * 1_000_000
    states = spark.createDataFrame([("j", "a", "pending", 1), ("j", "a", "completed", 2)], "job_id string, row_key string, status string, changed_at int")
    assert fleet.latest(states).first()["status"] == "completed"


def test_streams(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    first = tasks(spark, [task("j", "a", 0, 10), task("j", "b", 0, 11)]).withColumn("forwarded", F.lit(False))
    first.unionByName(tasks(spark, [task("j", "s", 0, 12)]).withColumn("forwarded", F.lit(True))).write.parquet(src)
    stream = spark.readStream.schema(first.schema).parquet(src)
    streaming.collect(stream, out, state).awaitTermination()
    # a second drain sees only what is new, and a repeated key gives no second row
    tasks(spark, [task("j", "a", 0, 10), task("j", "c", 0, 13)]).withColumn("forwarded", F.lit(False)).write.mode("append").parquet(src)
    streaming.collect(stream, out, state).awaitTermination()
    assert sorted(r["row_key"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    batch = streaming.windowed_throughput(tasks(spark, [task("j", "a", 0, 30)])).collect()
    assert len(batch) == 5 and all(r["completed"] == 1 for r in batch)


def test_snapshots(spark):
    s = spark.createDataFrame([("j", T0, 0, 0, 0, 1), ("j", T0 + timedelta(seconds=10), 500, 100, 50, 2)], "job_id string, at timestamp, tokens long, completed long, dead_lettered long, workers int")
    assert [r["tokens_per_s"] for r in streaming.poll_rate(s).orderBy("at").collect()] == [None, 50.0]
    assert [r["tripped"] for r in streaming.dead_letter_growth(s).orderBy("at").collect()] == [False, True]


def test_manifest_files(spark):
    m = spark.createDataFrame([("a/x.txt", None, "good"), ("b/y.txt", "copy.txt", ""), ("c/z.txt", None, None)], "rel_path string, dest_name string, label string")
    f = spark.createDataFrame([("a/x.txt",), ("q/y.txt",), ("p/y.txt",)], "path string")
    assert {r["rel_path"]: (r["found"], r["target"]) for r in fleet.located(m, f).collect()} == {"a/x.txt": ("a/x.txt", "good/x.txt"), "b/y.txt": ("p/y.txt", "copy.txt"), "c/z.txt": (None, "z.txt")}


def test_monitor_reads_the_tasks_once(spark, tmp_path):
    """One scan of the tasks and no join of them with themselves; the views agree with the operators they are made of."""
    rows = [task(f"j{i % 3}", f"{i:03d}", i, i + 5 + i % 40, ["completed", "failed", "processing", "pending"][i % 4]) for i in range(200)]
    tasks(spark, rows).write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    now = F.lit(T0 + timedelta(seconds=400))
    plan = fleet._monitor_cells(fleet.collapse_pairs(read), now, 300, 300)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    got = {r["job_id"]: r for r in fleet.job_monitor(read, now).collect()}
    kept = fleet.collapse_pairs(read)
    for r in fleet.job_metrics(kept).collect():
        assert all(got[r["job_id"]][c] == r[c] for c in r.asDict())
    assert {k: r["peak"] for k, r in got.items()} == {r["job_id"]: r["peak"] for r in fleet.concurrency(kept).collect()}
    for r in fleet.trailing_throughput(kept, now).collect():
        assert all(got[r["job_id"]][c] == r[c] for c in r.asDict())
    assert sum(r["stuck"] for r in got.values()) == fleet.stuck(kept, now).count()


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def read_again(inv):
    """inv behind a step that shows in each plan that would run it."""
    return inv.mapInArrow(lambda batches: batches, inv.schema)


def small_inventory(spark):
    from paperlane.operators.pipeline import Services, inventory
    from paperlane.sources.tables import meta

    texts = ["Name: Ann Lee, SSN 123-45-6789", "mail a@b.org and c@d.org", "nothing", "12 Oak Street, $5.00", "mail a@b.org and c@d.org"]
    rows = spark.createDataFrame([(f"d/{i}.txt", f"{i}.txt", ".txt", 9, t) for i, t in enumerate(texts)], "rel_path string, file_name string, ext string, size_bytes long, text string").withColumn("meta", meta())
    return rows, inventory(rows, services=Services(stage2="offline")).withColumn("row", F.col("rel_path"))


def test_a_summary_reads_the_inventory_once(spark):
    _, inv = small_inventory(spark)
    got = reports.summary(read_again(inv))
    assert "MapInArrow" not in plan(got)
    labels = {r["name"]: r["value"] for r in got.filter("section = 'label'").collect()}
    assert labels == {r["label"]: r["files"] for r in reports.label_counts(inv).collect()} and labels["Email"] == 2


def test_a_benchmark_reads_the_inventory_once(spark):
    _, inv = small_inventory(spark)
    gold = spark.createDataFrame([("d/0.txt", "R", ""), ("2.TXT", "NR", ""), ("x/9.txt", "R", "")], "id string, responsive string, bde string")
    for mode in ("unreviewed", "zero"):
        got = score.benchmark(read_again(inv), gold, mode)
        assert "MapInArrow" not in plan(got) and (got.first()["tp"], got.first()["tn"] > 0, got.first()["unmatched"]) == (1, True, 1)
    lost = score.unmatched_gold(read_again(inv), gold)
    assert "MapInArrow" not in plan(lost) and [r.id for r in lost.collect()] == ["x/9.txt"]


def test_runs_over_one_scan(spark):
    """Inventories of several settings are those of each alone, from one scan."""
    from dataclasses import replace

    from paperlane.operators.pipeline import Services, inventories, inventory
    from paperlane.plans.rules import RuleList
    from paperlane.plans.settings import Settings

    rows, _ = small_inventory(spark)
    runs, offline = [Settings(), Settings(bde_threshold=1), Settings(bde_threshold=2, use_stage2=False)], Services(stage2="offline")
    for services in (offline, Services(judge=lambda prompt: {"responsive": "Ann" in prompt, "tokens": len(prompt)})):
        for got, s in zip(inventories(read_again(rows), runs, services), runs):
            assert "MapInArrow" not in plan(got) or services is not offline
            assert sorted(got.collect()) == sorted(inventory(rows, s, services).collect())
    with pytest.raises(ValueError, match="same rules"):
        inventories(rows, [Settings(), replace(Settings(), rules=RuleList(name="other"))])
