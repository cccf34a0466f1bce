"""A thin shell over the library: scan, report, sample, estimate, benchmark, score, diff, and for processing jobs enqueue, collect, status, copy-sample.

``python -m paperlane.cli scan ROOT OUT`` and so on; every command is a few calls that a program can make itself.
"""

from __future__ import annotations

import argparse
import json
import uuid
from collections.abc import Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import base_name
from .operators import diff, fleet, reports, score
from .operators.pipeline import Services, inventory
from .plans import rules
from .plans.schema import NR_LANE
from .plans.settings import Settings
from .shared import written
from .sources import files, listing, sinks, stores, workbook
from .streaming import watch


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="paperlane", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *places: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for place in places:
            c.add_argument(place)
        return c

    c = command("scan", "root", "out")
    c.add_argument("--rules")
    c.add_argument("--bde-threshold", type=int)
    c.add_argument("--resume", help="an inventory whose files are left out")
    c.add_argument("--stage2", choices=["rules", "offline", "off"], default="rules")
    command("report", "inventory", "out")
    c = command("sample", "inventory", "out")
    c.add_argument("--rate", type=float, default=0.05)
    c.add_argument("--seed", type=int, default=12345)
    command("estimate", "inventory", "coded", "out")
    c = command("benchmark", "inventory", "gold")
    c.add_argument("--absent-means", choices=["unreviewed", "zero"], default="unreviewed")
    c.add_argument("--bde-threshold", type=int)
    for name in ("--id-col", "--responsive-col", "--bde-col", "--sheet"):
        c.add_argument(name)
    command("diff", "before", "after")
    c = command("score", "inventory", "out")
    c.add_argument("--export", help="entity counts by reviewers; without it only what needs no truth")
    c.add_argument("--tasks", help="task rows as Parquet")
    c.add_argument("--workbook", help="the sheets as one .xlsx file, too")
    c.add_argument("--sheet")
    c.add_argument("--absent-means", choices=["unreviewed", "zero"], default="unreviewed")
    c.add_argument("--bde-threshold", type=int, default=6)
    c = command("collect", "tasks", "results", "out")
    c.add_argument("--watch", action="store_true", help="go on as results appear, until no task is open")
    c.add_argument("--poll", type=float, default=15.0, help="seconds between passes")
    c = command("enqueue", "root", "out")
    c.add_argument("--inventory", help="an earlier inventory; only its files are taken")
    c.add_argument("--exclude-lanes", default=NR_LANE, help="lanes of that inventory that are left out, by commas")
    c.add_argument("--job-id")
    c.add_argument("--bde-threshold", type=int, help="the job's own, written beside its files")
    c.add_argument("--windows-queue", action="store_true", help="there is a queue for legacy formats")
    c = command("status", "tasks")
    c.add_argument("--failures", action="store_true")
    command("copy-sample", "manifest", "root", "out")
    return p


def _copied(plan: DataFrame, out: str) -> DataFrame:
    """Copies each found file of a located manifest below out, on the executors; (rel_path, target, copied)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = []
            for found, target in zip(b["found"], b["target"]):
                if found is not None:
                    stores.copy(found, f"{out.rstrip('/')}/{target}")
                done.append(found is not None)
            yield pd.DataFrame({"rel_path": b["rel_path"], "target": b["target"], "copied": done})

    return plan.select("rel_path", "found", "target").mapInPandas(run, "rel_path string, target string, copied boolean")


def _numbered(inv: DataFrame) -> DataFrame:
    return inv.withColumn("row", F.monotonically_increasing_id())


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("paperlane").getOrCreate()
    match a.command:
        case "scan":
            found = rules.load(a.rules)
            settings = replace(Settings(), rules=found, bde_threshold=a.bde_threshold or found.bde_threshold, use_stage2=a.stage2 != "off")
            todo = files.scan(spark, a.root)
            if a.resume:
                todo = todo.join(sinks.read_csv(spark, a.resume).select("rel_path").distinct(), "rel_path", "left_anti")
            rows = inventory(files.extracted(todo, settings), settings, Services(stage2="offline" if a.stage2 == "offline" else None))
            sinks.write_csv(rows, a.out)
            sinks.write_manifest(reports.manifest(sinks.read_csv(spark, a.out), settings), f"{a.out}-manifest")
        case "report":
            sinks.write_csv(reports.review_table(sinks.read_csv(spark, a.inventory)), a.out)
        case "sample":
            drawn = reports.draw_sample(sinks.read_csv(spark, a.inventory), a.rate, a.seed)
            sinks.write_csv(drawn.withColumns({"gold_responsive": F.lit(""), "gold_bde": F.lit("")}), a.out)
        case "estimate":
            coded = spark.read.option("header", True).csv(a.coded).na.fill("")
            sinks.write_csv(reports.extrapolate(sinks.read_csv(spark, a.inventory), coded), a.out)
        case "benchmark":
            gold = sinks.read_gold(spark, a.gold, a.sheet, a.id_col, a.responsive_col, a.bde_col)
            print(score.benchmark(_numbered(sinks.read_csv(spark, a.inventory)), gold, a.absent_means, a.bde_threshold).toJSON().first())
        case "score":
            inv = _numbered(sinks.read_csv(spark, a.inventory))
            inv = written(inv, "scored-inventory")
            export = sinks.read_export(spark, a.export, a.sheet) if a.export else None
            tasks = spark.read.parquet(a.tasks) if a.tasks else None
            sheets = score.sheets(inv, export, tasks, {"inventory": a.inventory, "export": a.export or ""}, a.bde_threshold, a.absent_means)
            sinks.write_sheets(sheets, a.out)
            if a.workbook:
                workbook.write(sheets, a.workbook)
        case "collect":
            # results carry their file's rel_path; a result counts once its task is completed
            schema = spark.read.parquet(a.tasks).schema
            done = spark.read.schema(schema).parquet(a.tasks)
            if a.watch:
                tasks = lambda: spark.read.schema(schema).parquet(a.tasks)
                print(json.dumps(watch.watch(spark, tasks, a.results, a.out, a.poll)._asdict()))
                found, missing = watch.collected(spark, tasks(), a.out)
                sinks.write_csv(found, f"{a.out}/inventory", "overwrite")
                sinks.write_csv(missing, f"{a.out}/missing", "overwrite")
            else:
                found, missing = sinks.collected(done, sinks.read_results(spark, a.results))
                sinks.write_csv(found, f"{a.out}/inventory")
                sinks.write_csv(missing, f"{a.out}/missing")
        case "status":
            tasks = spark.read.parquet(a.tasks)
            rows = fleet.failures(tasks) if a.failures else fleet.job_monitor(tasks, F.current_timestamp())
            for line in rows.toJSON().toLocalIterator():
                print(line)
        case "copy-sample":
            manifest = spark.read.options(**sinks.CSV).csv(a.manifest)
            for name in ("dest_name", "label"):
                manifest = manifest if name in manifest.columns else manifest.withColumn(name, F.lit(None).cast("string"))
            listed = listing.files_below(spark, a.root).select("path", "rel_path")
            plan = fleet.located(manifest, listed.select(F.col("rel_path").alias("path"))).join(listed.select(F.col("rel_path").alias("found"), "path"), "found", "left")
            sinks.write_csv(_copied(plan.select("rel_path", F.col("path").alias("found"), "target"), a.out), f"{a.out}-copied")
        case "enqueue":
            listed = listing.files_below(spark, a.root).select("rel_path")
            if a.inventory:
                kept = reports.rescan_set(sinks.read_csv(spark, a.inventory), [x.strip() for x in a.exclude_lanes.split(",") if x.strip()])
                listed = listed.join(kept.select("rel_path").distinct(), "rel_path", "left_semi")
            folder = [x for x in a.root.split("/") if x]
            job = a.job_id or f"{(['job', *folder])[-2]}-{'rescan' if a.inventory else 'job'}-{uuid.uuid4().hex[:8]}"
            if a.bde_threshold is not None:
                stores.write(f"{a.root.rstrip('/').rsplit('/', 1)[0]}/pii_job.json", json.dumps({"bde_threshold": a.bde_threshold}).encode())
            fleet.work_list(listed, job, a.windows_queue, base=base_name(F.col("rel_path"))).write.parquet(a.out)
            print(json.dumps({"job_id": job, "enqueued": spark.read.parquet(a.out).count()}))
        case "diff":
            # kept once each: every view reads both runs
            before, after = (written(diff.keyed(_numbered(sinks.read_csv(spark, p)), F.col("rel_path")), "compared") for p in (a.before, a.after))
            views = {"rules_decided": diff.rules_decided, "verdicts": diff.verdict_changes, "columns": diff.column_totals, "transitions": diff.top_transitions, "examples": diff.examples}
            for name, view in views.items():
                rows = view(before, after)
                for row in rows.orderBy(*rows.columns).toJSON().collect():  # a few for each column
                    print(json.dumps({"view": name} | json.loads(row)))


if __name__ == "__main__":
    main()
