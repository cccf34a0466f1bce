"""Mixing sources to target weights by systematic sampling. Column expressions only.

A source's target is its weight's share of all words, at most MAX_COPIES times its own words; the excess goes to
the others by weight (water filling). Each document of a source is expected target/size times. The expected copies
are summed along the source's documents, ordered by size, one random offset is added, and a document is emitted
once for each whole number its stretch crosses. Ordering by size keeps the words taken near the target.

The running sum is made in two steps, so that no source meets in one task: documents go to cells (source, size
class, hash digits of doc_id and text); cells get their offset from the table of cells, documents their place in the cell.

Defined results: a null text has no words; sources go by code point, null last, as a source of its own; a source
without words has target 0 and nothing is taken; repeated rows each count and are interchangeable; an empty
table gives an empty table; reruns with the same seed agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import unused, word_count, written

WEIGHTS = (1, 2, 3)  # by rank of the source, repeating
MAX_COPIES = 3
SEED = 7
RUN = 4096  # numbers in one array when a count is dealt out to rows


def _offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) drawn from the seed and the source."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """From (source, source_size), one row per source: source, source_size, target.

    The table of sources is the mixture's own dimension, a row for each source; windows over it are small.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    # Sources by how soon they are full; at each, the level if all before it are full and none after.
    soon = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before, after = soon.rowsBetween(Window.unboundedPreceding, -1), soon.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0))
    steps = ranked.withColumns({"left": left, "weights": F.sum("weight").over(after)})
    open_here = cap * F.col("source_size") * F.col("weights") >= F.col("left") * F.col("weight")
    level = F.min_by(F.struct("left", "weights"), F.when(open_here, F.struct(F.col("source_size") / F.col("weight"), "rank"))).over(whole)
    steps = steps.withColumn("level", level)
    share = F.col("level.left").cast("double") * F.col("weight") / F.col("level.weights")
    full = (cap * F.col("source_size")).cast("double")
    return steps.select("source", "source_size", F.when(full < share, full).otherwise(share).alias("target"))


def _each(n: Column) -> Column:
    """An array of arrays that together hold 0 .. n - 1, none of them long."""
    return F.transform(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / RUN)), lambda b: F.sequence(b * RUN, F.least((b + 1) * RUN, n) - 1))


def placed(rows: DataFrame) -> DataFrame:
    """rows (source, size, key, tie, ...) with place, the document's 1-based place among its source's by size class.

    Equal rows are counted first and take the places of their number, so no window meets them one by one.
    """
    columns = rows.columns
    rows = rows.groupBy(*columns).agg(F.count("*").alias("equal")).withColumns({
        "cell_class": F.length(F.bin("size")) * 4 + F.when(F.col("size") >= 4, F.floor(4 * (F.col("size") / F.pow(F.lit(2.0), F.length(F.bin("size")) - 1) - 1))).otherwise(F.col("size")).cast("int"),
        "cell": F.substring(F.md5(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), "tie").cast("binary")), 1, 3),
    })
    rows = written(rows, "mix-rows")
    cells = written(rows.groupBy("source", "cell_class", F.substring("cell", 1, 1).alias("block"), "cell").agg(F.sum("equal").alias("n")), "mix-cells")

    def starts(level: DataFrame, *by: str) -> DataFrame:
        """level (by ..., n) with the sum of n before each row among those that agree in all but the last of by."""
        before = Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
        return level.select(F.struct(*by).alias("id"), F.struct(*by[:-1]).alias("above"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at"))

    # from classes of a source to blocks of a class to cells of a block: no window meets more than 256 rows
    path = ["source", "cell_class", "block", "cell"]
    place = starts(cells.groupBy(*path[:2]).agg(F.sum("n").alias("n")), *path[:2])
    for level in (3, 4):
        upper = place.select(F.col("id").alias("above"), F.col("at").alias("upper"))
        place = starts(cells.groupBy(*path[:level]).agg(F.sum("n").alias("n")), *path[:level]).join(upper, "above").select("id", (F.col("upper") + F.col("at")).alias("at"))
    in_cell = Window.partitionBy("source", "cell_class", "cell").orderBy("size", "key", *(c for c in columns if c not in ("source", "size", "key"))).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("equal").over(in_cell), F.lit(0)))
    rows = rows.withColumn("id", F.struct("source", "cell_class", F.substring("cell", 1, 1).alias("block"), "cell")).join(place, "id")
    rows = rows.select(*columns, (F.col("at") + F.col("before") + 1).alias("start"), F.explode(_each(F.col("equal"))).alias("run"))
    return rows.select(*columns, "start", F.explode("run").alias("nth")).select(*columns, (F.col("start") + F.col("nth")).alias("place"))


def copies(rows: DataFrame, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """rows (source, size, key, tie, ...) with source_size, target and copies."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = written(targets(sizes, weights, cap), "mix-targets")
    wanted = wanted.select(F.col("source").alias("src"), "source_size", "target")
    rows = placed(rows)
    rows = rows.join(wanted, rows["source"].eqNullSafe(wanted["src"])).drop("src")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = _offset(F.col("source"), seed)
    crossed = F.floor(F.col("place") * rate + u) - F.floor((F.col("place") - 1) * rate + u)
    return rows.withColumn("copies", F.least(crossed.cast("long"), F.lit(cap).cast("long")))


def sized(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **more: Column) -> DataFrame:
    """(key, source, size, tie, more ...) of every document; tie orders and deals out different texts of one key and size."""
    tie = F.substring(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")), 1, 16)
    return docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), tie.alias("tie"), *(v.alias(k) for k, v in more.items()))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with docs' own columns.

    Documents are known by source, key and a hash of all columns but maps; of those equal in these, one is emitted as
    often as all are taken.
    """
    whole = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()))
    digest = written(sized(docs, text, source, key, row=whole), "mix-sizes")
    own, id_, n, run = (unused(docs, x) for x in ("mix_own", "mix_id", "mix_copies", "mix_run"))
    got = copies(digest, seed).groupBy(F.struct("source", "key", "row").alias(id_)).agg(F.sum("copies").alias(n), F.count("*").alias("equal"))
    got = written(got.filter(F.col(n) > 0), "mix-copies")
    rows = docs.withColumn(own, F.struct(F.col(source).alias("source"), F.col(key).alias("key"), whole.alias("row")))
    one = rows.join(got.filter("equal = 1").drop("equal"), F.col(own) == F.col(id_)).drop(id_)
    equal = got.filter("equal > 1").drop("equal")  # seldom any, so a small join beside the large one
    first = rows.join(equal, F.col(own) == F.col(id_)).drop(id_).dropDuplicates([own])
    both = one.unionByName(first).withColumn(run, F.explode(_each(F.col(n))))
    return both.withColumn(run, F.explode(run)).select(*(F.col(f"`{c}`") for c in docs.columns))
