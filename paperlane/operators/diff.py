"""Comparing two inventories of one corpus."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.schema import INVENTORY
from .score import _first, verdict


def keyed(inv: DataFrame, key: Column, last: bool = False) -> DataFrame:
    """One row for each key; inv needs ``row``, its input order."""
    return _first(inv.withColumn("key", key), "key", F.desc("row") if last else F.col("row"))


def paired(a: DataFrame, b: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Full outer join of two keyed inventories: key, a.*, b.* as structs of the columns asked for, null where a side lacks the key."""
    of = lambda x: [c for c in x.columns if c not in ("key", "row")] if columns is None else list(columns)
    left, right = (x.select("key", F.struct(*of(x)).alias(n)) for x, n in ((a, "a"), (b, "b")))
    return left.join(right, "key", "full_outer")


def verdict_changes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys by verdict in both runs; ``absent`` where a run lacks the key, ``undetermined`` where it has no verdict."""
    def name(side: str) -> Column:
        return F.when(F.col(f"has_{side}").isNull(), "absent").when(F.col(f"v_{side}").isNull(), "undetermined").when(F.col(f"v_{side}"), "R").otherwise("NR")

    sides = [x.select("key", verdict().alias(f"v_{n}"), F.lit(1).alias(f"has_{n}")) for x, n in ((a, "a"), (b, "b"))]
    j = sides[0].join(sides[1], "key", "full_outer")
    return j.groupBy(name("a").alias("before"), name("b").alias("after")).agg(F.count("*").alias("files"))


def column_changes(a: DataFrame, b: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, before, after, files) for every value that differs between keys of both runs."""
    columns = columns or [c for c in INVENTORY if c not in ("rel_path", "elapsed_s")]
    j = paired(a, b, columns).filter("a IS NOT NULL AND b IS NOT NULL")
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"a.{c}").cast("string").alias("before"), F.col(f"b.{c}").cast("string").alias("after")) for c in columns)))
    rows = j.select(cells.alias("x")).select("x.*").filter(~F.col("before").eqNullSafe(F.col("after")))
    return rows.groupBy("column", "before", "after").agg(F.count("*").alias("files"))


def column_totals(a: DataFrame, b: DataFrame, columns: list[str] | None = None, top: int = 20) -> DataFrame:
    return column_changes(a, b, columns).groupBy("column").agg(F.sum("files").alias("files")).orderBy(F.desc("files"), "column").limit(top)


def top_transitions(a: DataFrame, b: DataFrame, columns: list[str] | None = None, top: int = 6) -> DataFrame:
    """Each column's most frequent value changes, ties by value."""
    w = Window.partitionBy("column").orderBy(F.desc("files"), F.col("before").asc_nulls_first(), F.col("after").asc_nulls_first())
    return column_changes(a, b, columns).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def examples(a: DataFrame, b: DataFrame, columns: list[str] | None = None, top: int = 5) -> DataFrame:
    """(column, key, before, after): the least keys with a changed value, a few for each column; kept map-side, never sorted whole."""
    columns = columns or [c for c in INVENTORY if c not in ("rel_path", "elapsed_s")]
    j = paired(a, b, columns).filter("a IS NOT NULL AND b IS NOT NULL")
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col("key"), F.col(f"a.{c}").cast("string").alias("before"), F.col(f"b.{c}").cast("string").alias("after")) for c in columns)))
    rows = j.select(cells.alias("x")).select("x.*").filter(~F.col("before").eqNullSafe(F.col("after")))
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("column").orderBy("key"))).filter(F.col("n") <= top).drop("n")


# Columns that only a model's answer may change.
MODEL_COLUMNS = ("llm_consulted", "llm_responsive", "llm_tokens", "llm_tokens_total", "bde_person_count", "s2_llm_consulted", "s2_llm_responsiveness", "s2_llm_responsive", "s2_llm_tokens", "s2_detail")


def rules_decided(a: DataFrame, b: DataFrame) -> DataFrame:
    """Of the keys in both runs that no model touched: how many, and how many changed lane. The second must be 0 for equal rules."""
    j = paired(a, b, ("llm_consulted", "suggested_lane"))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    no_model = both & ~F.col("a.llm_consulted") & ~F.col("b.llm_consulted")
    moved = no_model & ~F.col("a.suggested_lane").eqNullSafe(F.col("b.suggested_lane"))
    count = lambda x: F.count_if(F.coalesce(x, F.lit(False)))
    return j.agg(count(both).alias("common"), count(F.col("b").isNull()).alias("only_a"), count(F.col("a").isNull()).alias("only_b"), count(no_model).alias("rules_decided"), count(moved).alias("moved"))


def map_differences(a: dict, b: dict) -> dict:
    """Keys of two small maps whose values differ, with both values."""
    return {k: (a.get(k), b.get(k)) for k in sorted(a.keys() | b.keys()) if a.get(k) != b.get(k)}
