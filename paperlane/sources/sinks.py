"""Reading and writing inventories, sheets, manifests and results at the edges."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import to_int, truthy
from ..operators.score import BDE_HINTS, ID_HINTS, RESPONSIVE_HINTS, pick_column
from ..plans.schema import COLUMNS, INVENTORY_SCHEMA, ZERO
from . import stores
from .extract import sheets


# One way to quote on both sides: doubled quotes, line breaks and outer blanks kept.
CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(inv: DataFrame, path: str, mode: str = "error") -> None:
    inv.write.mode(mode).options(**CSV, emptyValue="").csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """An inventory from CSV: missing columns get their zero, booleans and numbers are read leniently, partial rows dropped."""
    raw = spark.read.options(**CSV, multiLine=True).csv(path)
    out = []
    for name, kind in COLUMNS:
        if name not in raw.columns:
            out.append(F.lit(ZERO[kind]).cast(kind).alias(name))
        elif kind == "boolean":
            out.append(truthy(F.col(name)).alias(name))
        elif kind == "double":
            out.append(F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)).alias(name))
        elif kind in ("int", "bigint"):
            out.append(to_int(F.col(name)).cast(kind).alias(name))
        else:
            out.append(F.coalesce(name, F.lit("")).alias(name))
    return raw.filter(F.coalesce("rel_path", F.lit("")) != "").select(*out)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result files of finished tasks, a JSON object to a line, by the inventory's schema."""
    return spark.read.schema(INVENTORY_SCHEMA).option("recursiveFileLookup", True).json(path)


def write_results(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Inventory rows with ``job_id`` as one JSON object a line, in a folder for each job; ``read_results`` reads them back."""
    rows.write.mode(mode).partitionBy("job_id").option("ignoreNullFields", False).json(path)


def write_files(rows: DataFrame, root: str) -> int:
    """Rows (rel_path, content) as files below root, written by the executors, each whole or not at all; returns their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, attempt = 0, TaskContext.get().taskAttemptId()
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1)):
                with stores.Replacing(f"{root.rstrip('/')}/{path}", attempt) as out:
                    out.write(data.as_buffer() if data.is_valid else b"")
                n += 1
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    return rows.select("rel_path", "content").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def key_values(text: str) -> dict[str, str]:
    """KEY=VALUE lines of a settings file: comments, blank lines and a leading ``export`` aside, quotes around a value off."""
    out = {}
    for line in map(str.strip, text.splitlines()):
        if line.startswith("#") or "=" not in line:
            continue
        key, _, value = line.removeprefix("export ").partition("=")
        key, value = key.strip(), value.strip()
        if len(value) >= 2 and value[0] == value[-1] and value[0] in "'\"":
            value = value[1:-1]
        if key:
            out.setdefault(key, value)
    return out


def write_sheets(sheets: dict[str, DataFrame], path: str) -> None:
    """Each sheet as a CSV folder of its name, nested columns as JSON."""
    for name, df in sheets.items():
        flat = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct") else F.col(f"`{f.name}`") for f in df.schema]
        write_csv(df.select(*flat), f"{path}/{name}")


def collected(tasks: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Results of completed tasks by rel_path, and the completed tasks that have none."""
    done = tasks.filter(F.col("status") == "completed").select(F.col("file_name").alias("rel_path")).distinct()
    return results.join(done, "rel_path", "left_semi"), done.join(results, "rel_path", "left_anti")


def archive(rows: DataFrame, path: str) -> int:
    """Writes rows as JSON lines and reads them back; raises unless the counts agree."""
    seen = Observation("archive")
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.option("ignoreNullFields", False).json(path)
    made, back = seen.get["n"], rows.sparkSession.read.schema(rows.schema).json(path).count()
    if made != back:
        raise RuntimeError(f"archive holds {back} of {made} rows")
    return back


def combined_json(texts: list[str]) -> dict:
    """Top-level keys of several JSON objects; the last one wins. Trailing data after an object is ignored."""
    out: dict = {}
    for t in texts:
        out |= json.JSONDecoder().raw_decode(t.lstrip("﻿ \n\r\t"))[0]
    return out


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.json(path)


def _rows_of(spark: SparkSession, path: str, tab: str | None, is_header: Callable[[list[str]], bool]) -> tuple[list[str], DataFrame]:
    if path.lower().endswith(".xlsx"):
        data = spark.read.format("binaryFile").load(path).select("content").first()[0]
        found = sheets(bytes(data))
        rows = next(r for n, r in found if tab is None or n == tab)
        # the header is the first of 25 rows that has the wanted columns; banners may stand above it
        top = next((i for i, r in enumerate(rows[:25]) if is_header([c.strip() for c in r])), None)
        if top is None:
            raise ValueError(f"no header with the wanted columns in the first 25 rows of {path}")
        headers = [c.strip() or f"column{i}" for i, c in enumerate(rows[top])]
        body = [tuple((r + [""] * len(headers))[: len(headers)]) for r in rows[top + 1 :]]
        return headers, spark.createDataFrame(body, ", ".join(f"`{h}` string" for h in headers))
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", "\t" if path.lower().endswith((".tsv", ".tab")) else ",").csv(path)
    headers = [c.lstrip("﻿").strip() for c in df.columns]
    return headers, df.toDF(*headers)


def read_gold(spark: SparkSession, path: str, tab: str | None = None, id_col: str | None = None, responsive_col: str | None = None, bde_col: str | None = None) -> DataFrame:
    """A reviewers' sheet as (id, responsive, bde); columns are found by their headers unless given."""
    headers, df = _rows_of(spark, path, tab, lambda cells: pick_column(cells, ID_HINTS, id_col) is not None and pick_column(cells, RESPONSIVE_HINTS, responsive_col) not in (None, pick_column(cells, ID_HINTS, id_col)))
    i, r, b = (pick_column(headers, h, g) for h, g in ((ID_HINTS, id_col), (RESPONSIVE_HINTS, responsive_col), (BDE_HINTS, bde_col)))
    if i is None or r is None:
        raise ValueError(f"no id or verdict column among {headers}")
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return df.select(text(i).alias("id"), text(r).alias("responsive"), (text(b) if b else F.lit("")).alias("bde"))


def read_export(spark: SparkSession, path: str, tab: str | None = None, id_col: str = "Control ID", total_col: str = "Total Entities") -> DataFrame:
    """An export of entity counts as (id, total)."""
    headers, df = _rows_of(spark, path, tab, lambda cells: all(pick_column(cells, (), c) is not None for c in (id_col, total_col)))
    return df.select(F.col(f"`{pick_column(headers, (), id_col)}`").alias("id"), F.col(f"`{pick_column(headers, (), total_col)}`").alias("total"))
