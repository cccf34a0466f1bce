"""SimHash near-duplicates with BK-trees.

A document's fingerprint has 64 bits over its 3-word shingles. Fingerprints at ``radius`` or fewer differing bits are
linked, and linked documents form a component.

Equal fingerprints are one node from the start, so copies cost nothing. Nodes are dealt to shards by pigeonhole: the
64 bits are cut into bands, and two nodes within the radius agree on all but ``radius`` of them, so each choice of the
other bands is a table and its value a shard; a node is in one shard of each table. Where a shard's rows meet, its
BK-tree is built (children keyed by the Hamming distance to their parent) and searched along the edges within the
radius. A shard tree is not broadcast, because the trees together grow with the corpus. A shard above SHARD nodes is
cut into chunks, and every pair of chunks gets its own tree, so no task holds more than two chunks and no link is lost.
From each tree come only the links of a spanning forest, never all pairs.

``one_of_each``, the filter on documents, also catches near copies beyond that radius: at a similarity of 0.8 over
5-word shingles, fingerprints differ in some 7 bits, more than shards and trees can reach at any size. There, min-hash
signatures are cut into bands, and texts that share a band and agree within a wide margin are candidates of one group.
A candidate pair of a group becomes a link only if the whole sets of 5-word shingles have a Jaccard similarity of 0.8 or
more; the estimate never decides that two texts are alike. Groups of any size are searched.

Defined results: a null, empty or blank text has the fingerprint 0 and is linked like any other; a text of fewer than
3 words has one shingle, its word sequence; rows with one doc_id and several texts are one document only if those
are linked; a null doc_id gets the component of its fingerprint and never names one, so a component of null ids only
is null; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_text, unused, written
from .components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
SHARD = 2048
MEAN_SHARD = 512  # the number of bands rises until random fingerprints fill shards to no more than this


def fingerprint_of(text: str | None) -> int:
    """The fingerprint of a whole text as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        h = [digest(b" ".join(words), SEED)]
    else:
        h = [digest(b" ".join(x), SEED) for x in zip(*(words[i:] for i in range(SHINGLE)))]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):  # a long text needs no more memory than its words
        part = np.array(h[i : i + (1 << 16)], dtype=">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view(">i8")[0])


SIMILAR_SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 21, 6  # a pair at 0.8 agrees in one of 21 bands of 6 hashes with probability 0.998
MARGIN = 0.15  # of the signatures' estimate, over four of its standard deviations at 0.8; it only finds candidates
CHUNK = 4096  # signatures of a bucket that a task holds, twice
LOT, MOST_HOT = 512, 100_000  # rows of one key that a join leaves together; hot keys that may be broadcast, 12 bytes each
CHUNK_CHARS = 1 << 25  # characters of a group's texts that a task holds, twice
_rng = np.random.default_rng(SEED)
_FACTORS, _OFFSETS = (_rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(k) for k in (1, 0))


def shingles_of(text: str | None) -> np.ndarray:
    """The set of a whole text's 5-word shingles as sorted 64-bit hashes, A-Z in lower case; empty without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    digest, n = xxhash.xxh64_intdigest, SIMILAR_SHINGLE
    if len(words) < n:
        h = [digest(b" ".join(words))] if words else []
    else:
        h = [digest(b" ".join(x)) for x in zip(*(words[i:] for i in range(n)))]
    return np.unique(np.array(h, dtype=np.uint64))


Marks = tuple[list[int] | None, list[int] | None]


def banded(hashes: np.ndarray) -> Marks:
    """From a signature of min-hashes (32 bits): the hash of each band, and 8 bits of each min-hash."""
    h = np.ascontiguousarray(hashes, dtype=np.uint32)
    digest = xxhash.xxh64_intdigest
    return [digest(x.tobytes(), b) - (1 << 63) for b, x in enumerate(h.reshape(BANDS, ROWS))], (h & np.uint32(255)).astype(np.uint8).view(np.int8).tolist()


def _signature(shingles: np.ndarray) -> Marks:
    if not len(shingles):
        return None, None
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 2048):
        np.minimum(least, (_FACTORS[:, None] * shingles[i : i + 2048] + _OFFSETS[:, None]).min(axis=1), out=least)
    return banded((least >> np.uint64(32)).astype(np.uint32))


def signature_of(text: str | None) -> Marks:
    """Bands and sketch of the min-hashes of a whole text's 5-word shingles, A-Z in lower case; None without words."""
    return _signature(shingles_of(text))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact similarity of two sets as ``shingles_of`` gives them."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def marks_of(text: str | None) -> tuple[int, list[int] | None, list[int] | None, int | None]:
    """(fingerprint, bands, sketch, hash of the shingle set) of a whole text; texts of one set differ in order at most."""
    shingles = shingles_of(text)
    own = xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else None
    return fingerprint_of(text), *_signature(shingles), own


def candidate_groups(marks: DataFrame, similarity: float = SIMILARITY - MARGIN, chunk: int = CHUNK) -> DataFrame:
    """From distinct (fp, bands, sketch): (fp, root) of all fps in groups of two and more whose signatures share a band and agree.

    First every signature of a bucket of equal bands is held against the least and the greatest of the bucket, which is
    every pair in a bucket of three and links most larger ones whole. Buckets that are still in several pieces are
    searched exactly, each against all of its own, in chunks and pairs of chunks as in ``sharded``; only the links of a
    spanning forest leave a task. Sketches are compared, whose 8 bits agree by chance once in 256, so none is missed.
    """
    marks = written(marks.filter("bands IS NOT NULL").withColumn("sid", F.xxhash64("bands")), "signatures")
    sigs = marks.select("sid", "bands", "sketch").dropDuplicates(["sid"])
    rows = written(sigs.select("sid", F.posexplode("bands").alias("band", "key")), "signature-bands")
    sigs = sigs.select("sid", "sketch")
    ends = rows.groupBy("band", "key").agg(F.min("sid").alias("low"), F.max("sid").alias("high"), F.count("*").alias("n")).filter("low < high")
    met = rows.join(ends, ["band", "key"])
    wide = written(met.filter("n > 3").select("band", "key", "sid"), "wide-buckets")
    met = written(met.select("sid", F.explode(F.array("low", "high")).alias("other")).filter("sid <> other").distinct(), "signature-pairs")
    sigs = written(sigs, "sketches")
    hot = written(met.groupBy("other").agg(F.ceil(F.count("*") / LOT).cast("int").alias("lots")).filter("lots > 1"), "hot-keys")  # at most one row for each LOT rows
    met = met.join(sigs, "sid").select("sid", "other", F.col("sketch").alias("a"))
    met = _spread(met, "other", "sid", sigs.select(F.col("sid").alias("other"), F.col("sketch").alias("b")), hot)
    alike = F.aggregate(F.zip_with("a", "b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    good = written(met.filter(alike >= similarity * BANDS * ROWS).select(F.col("sid").alias("a"), F.col("other").alias("b")), "similar")
    roots = components(good.unionByName(_open_buckets(wide, good, sigs, similarity, chunk)).select(F.col("a").alias("u"), F.col("b").alias("v")))
    named = marks.select("fp", "sid").join(roots.withColumnRenamed("u", "sid"), "sid", "left").select("fp", F.coalesce("v", "sid").alias("group"))
    groups = named.groupBy("group").agg(F.min("fp").alias("root"), F.max("fp").alias("last")).filter("root < last")
    return named.join(groups.select("group", "root"), "group").select("fp", "root")


def _spread(rows: DataFrame, key: str, by: str, table: DataFrame, hot: DataFrame) -> DataFrame:
    """rows joined with table on key, which is unique in table; a key in hot (key, lots) is dealt out in lots by ``by``."""
    lots = F.coalesce("lots", F.lit(1))
    table = table.join(hot, key, "left").withColumn("lot", F.explode(F.sequence(F.lit(0), lots - 1))).drop("lots")
    rows = rows.join(F.broadcast(hot) if hot.count() <= MOST_HOT else hot, key, "left").withColumn("lot", F.pmod(F.xxhash64(by), lots).cast("int")).drop("lots")
    return rows.join(table, [key, "lot"]).drop("lot")


def _open_buckets(wide: DataFrame, good: DataFrame, sigs: DataFrame, similarity: float, chunk: int) -> DataFrame:
    """The links (a, b) that ``good`` lacks within buckets (band, key, sid) whose members it leaves in several pieces."""
    roots = components(good.select(F.col("a").alias("u"), F.col("b").alias("v")))
    wide = wide.join(roots.withColumnRenamed("u", "sid"), "sid", "left").select("band", "key", "sid", F.coalesce("v", "sid").alias("root"))
    wide = written(wide, "bucket-roots")
    pieces = wide.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    pieces = written(pieces.select("band", "key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")), "open-buckets")
    rows = wide.join(pieces, ["band", "key"]).select("band", "key", "sid", "root", F.explode(_chunk_pairs("sid")).alias("p"))
    rows = rows.join(sigs, "sid").select("band", "key", "p.a", "p.b", "sid", "root", "sketch")
    keys = ["band", "key", "a", "b"]
    found = rows.repartition(*keys).sortWithinPartitions(*keys, "sid").mapInArrow(_link_buckets(similarity), "a long, b long")
    return written(found.distinct(), "similar-in-buckets")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.RecordBatch]]:
    """The runs of equal leading columns of sorted batches, each as slices."""
    rest, held = None, []
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(keys)], axis=1)
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            if rest is not None and (rest != k[i]).any():
                yield held
                held = []
            rest = k[i]
            held.append(b.slice(i, j - i))
    if held:
        yield held


def forest_of(sigs: np.ndarray, pieces: np.ndarray, similarity: float, alike: Callable[[int, int], bool] | None = None) -> list[tuple[int, int]]:
    """Places (i, j) whose links join all rows of ``sigs`` that agree in ``similarity`` or more and, where given, are ``alike``, beyond those of one piece."""
    need, pieces, out = similarity * sigs.shape[1], pieces.copy(), []
    for i in range(len(sigs) - 1):
        others = i + 1 + np.flatnonzero(pieces[i + 1 :] != pieces[i])
        if len(others):
            for j in others[(sigs[others] == sigs[i]).sum(axis=1) >= need].tolist():
                if pieces[j] != pieces[i] and (alike is None or alike(i, j)):
                    out.append((i, j))
                    pieces[pieces == pieces[j]] = pieces[i]
    return out


def _link_buckets(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 4):
            sid, root = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in group]) for i in (4, 5))
            sigs = np.concatenate([b.column(6).flatten().to_numpy(zero_copy_only=False) for b in group]).reshape(len(sid), -1)
            found = forest_of(sigs, root, similarity)
            if found:
                i, j = zip(*found)
                yield pa.record_batch([pa.array(sid[list(x)], pa.int64()) for x in (i, j)], names=["a", "b"])

    return run


def verified_links(texts: DataFrame, marks: DataFrame, similarity: float = SIMILARITY, margin: float = MARGIN, chunk: int = CHUNK, chars: int = CHUNK_CHARS) -> DataFrame:
    """Links (u, v) of a spanning forest of all shingle sets (own) in one candidate group with this exact Jaccard similarity or more.

    ``marks`` has (own, bands, sketch, row), ``texts`` has (row, text). Each set's text is read once, from its least row, and only
    where the set is in a group; a group too large for one task is cut into chunks, and each pair of chunks is searched.
    """
    marks = marks.filter("own IS NOT NULL").groupBy("own").agg(F.min("row").alias("row"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    marks = written(marks, "shingle-sets")
    roots = written(candidate_groups(marks.select(F.col("own").alias("fp"), "bands", "sketch"), similarity - margin, chunk).withColumnRenamed("fp", "own"), "candidates")
    rows = marks.select("own", "row", "sketch").join(roots, "own")
    # several rows can have one id, all with the same text
    rows = texts.join(rows, "row").groupBy("own", "root").agg(F.first("sketch").alias("sketch"), F.first("text").alias("text"))
    rows = written(rows, "candidate-texts")
    sizes = rows.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / chunk), F.ceil(F.sum(F.length("text")) / chars)).cast("int").alias("chunks"))
    rows = rows.join(sizes, "root").select("root", "own", "sketch", "text", F.explode(_chunk_pairs("own")).alias("p"))
    keys = ["root", "a", "b"]
    rows = rows.select("root", "p.a", "p.b", "own", "sketch", "text").repartition(*keys).sortWithinPartitions(*keys, "own")
    return written(rows.mapInArrow(_link_groups(similarity, margin), "u long, v long").distinct(), "verified")


def _link_groups(similarity: float, margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            own = np.concatenate([b.column(3).to_numpy(zero_copy_only=False) for b in group])
            sigs = np.concatenate([b.column(4).flatten().to_numpy(zero_copy_only=False) for b in group]).reshape(len(own), -1)
            sets = [shingles_of(t.as_py()) for b in group for t in b.column(5)]
            found = forest_of(sigs, np.arange(len(own)), similarity - margin, lambda i, j: jaccard(sets[i], sets[j]) >= similarity)
            if found:
                i, j = zip(*found)
                yield pa.record_batch([pa.array(own[list(x)], pa.int64()) for x in (i, j)], names=["u", "v"])

    return run


def fingerprint(text: Column) -> Column:
    """Struct with the fingerprint (long) of each text."""
    return per_text(lambda: lambda t: (fingerprint_of(t),), "fp long", [("fp", pa.int64())])(text)


def band_limits(bands: int) -> list[tuple[int, int]]:
    """(shift, width) of each band of the 64 bits."""
    cuts = [64 * i // bands for i in range(bands + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def bands_for(nodes: int, radius: int = RADIUS, mean: int = MEAN_SHARD) -> int:
    """The least number of bands whose shards hold no more than ``mean`` random nodes each."""
    bands = radius + 1
    while bands < 2 * radius + 4 and nodes / 2 ** sum(w for _, w in band_limits(bands)[radius:]) > mean:
        bands += 1
    return bands


def _chunk_pairs(member: str) -> Column:
    """Array of the pairs (a, b) of a shard's ``chunks`` that a member goes to: its own chunk with each other one."""
    own = F.pmod(F.xxhash64(member, F.lit(1)), F.col("chunks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: j != own)
    single = F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))
    return F.when(F.col("chunks") == 1, single).otherwise(F.transform(others, lambda j: F.struct(F.least(own, j).alias("a"), F.greatest(own, j).alias("b"))))


def sharded(nodes: DataFrame, bands: int, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """nodes (fp) as rows (t, key, a, b, fp): table, shard and pair of chunks; every two nodes within the radius meet."""
    limits = band_limits(bands)
    tables = []
    for t, kept in enumerate(combinations(range(bands), bands - radius)):
        parts = [F.shiftrightunsigned("fp", limits[b][0]).bitwiseAND(F.lit((1 << limits[b][1]) - 1)) for b in kept]
        key = parts[0]
        for b, p in zip(kept[1:], parts[1:]):
            key = F.shiftleft(key, limits[b][1]).bitwiseOR(p)
        tables.append(F.struct(F.lit(t).alias("t"), key.alias("key")))
    rows = nodes.select("fp", F.explode(F.array(*tables)).alias("s")).select("s.t", "s.key", "fp")
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    large = written(sizes.filter(F.col("n") > shard).select("t", "key", F.ceil(F.col("n") / shard).cast("int").alias("chunks")), "large-shards")
    rows = rows.join(large, ["t", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    return rows.select("t", "key", "fp", F.explode(_chunk_pairs("fp")).alias("p")).select("t", "key", "p.a", "p.b", "fp")


def tree_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of all pairs of ``values`` within ``radius``, found through a BK-tree."""
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links, kids = [], [{}]
    for i in range(1, len(values)):
        x = values[i]
        stack = [0]
        while stack:  # search before the node goes in
            j = stack.pop()
            d = (values[j] ^ x).bit_count()
            if d <= radius:
                a, b = find(i), find(j)
                if a != b:
                    root[a] = b
                    links.append((i, j))
            below = kids[j]
            if below:
                for e in range(d - radius, d + radius + 1):
                    k = below.get(e)
                    if k is not None:
                        stack.append(k)
        j = 0
        while True:
            d = (values[j] ^ x).bit_count()
            k = kids[j].get(d)
            if k is None:
                kids[j][d] = i
                kids.append({})
                break
            j = k
    return links


def _link_shards(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, held = None, np.empty(0, dtype=np.int64)

        def links(values: np.ndarray) -> list[tuple[int, int]]:
            own = values.view(np.uint64).tolist()
            return [(values[i], values[j]) for i, j in tree_links(own, radius)]

        def batch(found: list) -> pa.RecordBatch:
            u, v = zip(*found) if found else ((), ())
            return pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
            fp = b.column(4).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            groups = np.split(fp, cuts)
            found = []
            if rest is not None and (rest == k[0]).all():
                groups[0] = np.concatenate([held, groups[0]])
            elif len(held) > 1:
                found += links(held)
            for g in groups[:-1]:
                if len(g) > 1:
                    found += links(g)
            rest, held = k[-1], groups[-1]
            if found:
                yield batch(found)
        if len(held) > 1:
            yield batch(links(held))

    return run


def links(nodes: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """From distinct fingerprints (fp): links (u, v) that join all fingerprints within the radius."""
    n = nodes.count()
    rows = sharded(nodes, bands_for(n, radius), radius, shard)
    keys = ["t", "key", "a", "b"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "fp").mapInArrow(_link_shards(radius), "u long, v long")


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp) of every document, written."""
    return written(docs.select(F.col(key).alias("key"), fingerprint(F.col(text)).alias("f")).select("key", "f.fp"), "fingerprints")


def clustered(prints: DataFrame, radius: int = RADIUS, more_links: DataFrame | None = None) -> DataFrame:
    """From written (key, fp) rows: (key, fp, component), component the least key of all that are linked."""
    nodes = written(prints.groupBy("fp").agg(F.min("key").alias("least")), "nodes")
    found = links(nodes.select("fp"), radius)
    roots = components(found if more_links is None else found.unionByName(more_links))
    named = nodes.join(roots.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("v", "fp"))
    of_root = named.groupBy("root").agg(F.min("least").alias("component"))
    names = written(named.join(of_root, "root").select("fp", "component"), "components")
    return prints.join(names, "fp").select("key", "fp", "component")


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """docs without the keys none of whose rows names its component; all rows of a kept key stay, as one document."""
    both = per_text(lambda: marks_of, "fp long, bands array<long>, sketch array<tinyint>, own long", [("fp", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int8())), ("own", pa.int64())])
    texts = docs.select(F.xxhash64(F.col(text)).alias("row"), F.col(text).alias("text"))
    marks = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("row"), both(F.col(text)).alias("m"))
    marks = written(marks.select("key", "row", "m.*"), "marks")
    least = marks.filter("own IS NOT NULL").groupBy("own").agg(F.min("fp").alias("fp"))  # one fingerprint stands for a set's texts
    alike = verified_links(texts, marks)
    alike = alike.join(least.select(F.col("own").alias("u"), F.col("fp").alias("a")), "u").join(least.select(F.col("own").alias("v"), F.col("fp").alias("b")), "v")
    same = marks.filter("own IS NOT NULL").select("own", "fp").distinct()  # copies meet before the join, not in it
    same = same.join(least.withColumnRenamed("fp", "b"), "own").select(F.col("fp").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct()
    more = alike.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").unionByName(same)
    rows = clustered(marks.select("key", "fp"), radius, more)
    extra = rows.groupBy("key").agg(F.max(F.col("key").eqNullSafe(F.col("component"))).alias("first")).filter("not first")
    name = unused(docs, "extra_copy")
    extra = written(extra.select(F.col("key").alias(name)), "extra-copies")
    return docs.join(extra, docs[key].eqNullSafe(extra[name]), "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
