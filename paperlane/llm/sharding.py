"""Sharding by a hierarchical weighted hash tree. Column expressions only.

The tree has regions, racks in them and shards in these, each shard with a weight; a rack's weight is that of its shards,
a region's that of its racks. A document goes down the tree: at each level every child draws a number from the
document's id and the child's name, -ln(u) / weight, and the least draw wins. A child so wins in proportion to its weight, and
when a weight changes, documents move only into or out of that child's subtree: all other draws stay what they were.

A new shard gets a rack and a region of its own (``grown``). It changes no weight on the way to any other shard, so it takes
documents only into itself. Were it put into a present rack, that rack and region would grow, and documents that
the region gains would also go to its other shards.

A document's slot is its number in its shard, from 0 without gaps: documents go to cells of a shard by a hash, cells get their
offset from the table of cells, documents their place in the cell, so no shard meets in one task.

Defined results: the id and the tree alone decide the shard; equal texts under different ids are dealt out like any others; a
null id draws as the empty id; a null text has no bytes and the crc of none; repeated rows go to one shard and take one
slot each; rows that agree in id, size and crc may stand in any order; a shard of weight 0 gets nothing; an empty table gives an
empty table; other columns, whatever their names, are ignored by ``placed`` and kept by ``sharded`` and ``save``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, offsets, unused, written

SHARDS = 24
SEED = 11
ROW_BYTES = 8  # what a row counts for beside its text


class Leaf(NamedTuple):
    shard: int
    region: int
    rack: int
    weight: float = 1.0


def layout(shards: int = SHARDS, per_rack: int = 4, racks: int = 2) -> tuple[Leaf, ...]:
    """Shards 0 .. shards - 1 of weight 1, so many to a rack and so many racks to a region."""
    return tuple(Leaf(i, i // (per_rack * racks), i // per_rack % racks) for i in range(shards))


def grown(tree: tuple[Leaf, ...], weight: float = 1.0) -> tuple[Leaf, ...]:
    """The tree with one more shard, in a region of its own."""
    return (*tree, Leaf(max((x.shard for x in tree), default=-1) + 1, max((x.region for x in tree), default=-1) + 1, 0, weight))


def _children(tree: tuple[Leaf, ...]) -> Column:
    """The tree as one constant: array of struct<name, weight, racks: array of struct<name, weight, shards: array of struct<name, weight, shard>>>."""
    live = [x for x in tree if x.weight > 0]

    def level(leaves: list[Leaf], path: tuple[str, ...], keys: tuple[str, ...]) -> Column:
        groups: dict[int, list[Leaf]] = {}
        for x in leaves:
            groups.setdefault(getattr(x, keys[0]), []).append(x)
        nodes = []
        for name, members in sorted(groups.items()):
            at = (*path, str(name))
            head = (F.lit("/".join(at)).alias("name"), F.lit(float(sum(m.weight for m in members))).alias("weight"))
            nodes.append(F.struct(*head, level(members, at, keys[1:]).alias("children") if len(keys) > 1 else F.lit(name).alias("shard")))
        return F.array(*nodes)

    return level(live, (), ("region", "rack", "shard"))


def _winner(children: Column, key: Column, field: str, seed: int) -> Column:
    """``field`` of the child with the least draw; children of one weight could only tie by equal hashes, then the first wins."""

    def draw(child: Column) -> Column:
        h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), child["name"], F.lit(":"), key).cast("binary")), 1, 8), 16, 10).cast("double")
        return F.struct((-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)) / child["weight"]).alias("draw"), child["name"].alias("name"), child[field].alias("of"))

    return F.array_min(F.transform(children, draw))["of"]


def _with_shard(rows: DataFrame, key: Column, tree: tuple[Leaf, ...], name: str, seed: int) -> DataFrame:
    id_, step = unused(rows, "drawn_id"), unused(rows, "tree_step")
    rows = rows.withColumn(id_, F.coalesce(key.cast("string"), F.lit("")))
    rows = rows.withColumn(step, _winner(_children(tree), F.col(id_), "children", seed))  # the region's racks
    rows = rows.withColumn(step, _winner(F.col(step), F.col(id_), "children", seed))  # the rack's shards
    return rows.withColumn(name, _winner(F.col(step), F.col(id_), "shard", seed)).drop(id_, step)


def sharded(docs: DataFrame, tree: tuple[Leaf, ...] = layout(), key: str = "doc_id", name: str = "shard", seed: int = SEED) -> DataFrame:
    """docs with their shard, without a shuffle."""
    if not any(x.weight > 0 for x in tree):
        raise ValueError("no shard has a weight")
    return _with_shard(docs, F.col(key), tree, name, seed)


def placed(docs: DataFrame, tree: tuple[Leaf, ...] = layout(), text: str = "text", key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """key, size, text_crc32, shard, slot and grown_shard (with one more shard) of every document."""
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), (F.octet_length(raw).cast("long") + ROW_BYTES).alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32"))
    rows = sharded(sharded(rows, tree, "key", "shard", seed), grown(tree), "key", "grown_shard", seed)
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("size"), F.col("text_crc32")).cast("binary"))
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("equal")).withColumns({"block": F.substring(digest, 1, 2), "cell": F.substring(digest, 1, 4)})
    rows = written(rows, "shard-rows")
    cells = written(rows.groupBy("shard", "block", "cell").agg(F.sum("equal").alias("n")), "shard-cells")
    starts = offsets(cells, ["block", "cell"], ("shard",)).drop("n")
    rows = rows.join(starts, ["shard", "block", "cell"])
    return numbered(rows, ["shard", "cell"], ["key", "size", "text_crc32"], "at", "slot").select("key", "size", "text_crc32", "shard", "slot", "grown_shard")


def save(docs: DataFrame, path: str, tree: tuple[Leaf, ...] = layout(), key: str = "doc_id", files: int = 8, seed: int = SEED) -> None:
    """docs as Parquet, a folder for each shard with about ``files`` files, dealt out by a hash so that no shard meets in one task."""
    part = unused(docs, "shard_file")
    rows = sharded(docs, tree, key, unused(docs, "shard"), seed)
    name = rows.columns[-1]
    rows = rows.withColumn(part, F.pmod(F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString())), F.lit(files)))
    rows.repartition(len(tree) * files, name, part).drop(part).write.partitionBy(name).parquet(path)
