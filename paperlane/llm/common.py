"""What the operators of this subpackage share: text maps and the word rule, beside the shared tables.

Texts are never cut. A null text counts as the empty text wherever an operator does not say otherwise.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import new_folder, unused, written  # noqa: F401

# The characters that end a word, and the words' pattern, in regular-expression form.
WORD = r"[^\x20\x09-\x0D]+"
WORD_BREAKS = "\x20\x09\x0a\x0b\x0c\x0d"


def word_count(text: Column) -> Column:
    """Number of words of a text (long); null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else left as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def per_text(make: Callable[[], Callable[[str | None], tuple]], schema: str, fields: list[tuple[str, pa.DataType]]):
    """A column function from a text to a struct of ``fields``, Arrow batches in and out, one text at a time.

    ``make`` is called once in each Python worker's task and returns the function for a text. The result is
    declared non-deterministic only so that a filter on it does not make Spark evaluate it twice.
    """
    names, kinds = [n for n, _ in fields], [k for _, k in fields]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = make()
        for batch in batches:
            rows = [one(x) for x in batch.to_pylist()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.StructArray.from_arrays(columns, names)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, schema).asNondeterministic()


class Covered:
    """Spans (kind, start, end) of a text in any order; ``touches`` costs a binary search, however many there are."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        places = sorted((a, b) for _, a, b in spans)
        self.starts = [a for a, _ in places]
        self.reach = list(accumulate((b for _, b in places), max))  # how far the spans up to each one go

    def touches(self, start: int, end: int) -> bool:
        n = bisect_left(self.starts, end)  # spans that begin before the end
        return n > 0 and self.reach[n - 1] > start


RUN = 4096  # numbers in one array when a count is dealt out to rows


def offsets(leaves: DataFrame, path: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """leaves (within ..., path ..., n) with ``at``, the sum of n of the leaves before among those that agree in ``within``.

    Leaves are ordered by ``path``, whose columns go from coarse to fine and hold no nulls. Sums are made level by level, so a window
    meets only the children of one value of the level above. leaves are read once a level: hand in a written table.
    """
    upper = None
    for depth in range(1, len(path) + 1):
        above = [*within, *path[: depth - 1]]
        level = leaves if depth == len(path) else leaves.groupBy(*above, path[depth - 1]).agg(F.sum("n").alias("n"))
        before = Window.partitionBy(*above).orderBy(path[depth - 1]).rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0)))
        if upper is not None:
            level = level.join(upper.select(*above, F.col("at").alias("upper_at")), above).withColumn("at", F.col("at") + F.col("upper_at")).drop("upper_at")
        upper = level
    return upper


def each_of(n: Column) -> Column:
    """An array of arrays that together hold 0 .. n - 1, none of them long."""
    return F.transform(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / RUN)), lambda b: F.sequence(b * RUN, F.least((b + 1) * RUN, n) - 1))


def numbered(rows: DataFrame, within: list[str], order: list[str], at: str, number: str) -> DataFrame:
    """Distinct rows (..., equal) as all rows they stand for, with ``number``: at, plus the place from 0 among those that agree in ``within``, by ``order``.

    ``equal`` says how many rows a row stands for; the window meets them as one.
    """
    before = Window.partitionBy(*within).orderBy(*(F.col(c).asc_nulls_first() for c in order)).rowsBetween(Window.unboundedPreceding, -1)
    kept = [c for c in rows.columns if c not in ("equal", at)]
    rows = rows.withColumn("first_number", F.col(at) + F.coalesce(F.sum("equal").over(before), F.lit(0)))
    rows = rows.select(*kept, "first_number", F.explode(each_of(F.col("equal"))).alias("run"))
    return rows.select(*kept, "first_number", F.explode("run").alias("nth")).select(*kept, (F.col("first_number") + F.col("nth")).alias(number))
