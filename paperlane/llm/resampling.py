"""Target-distribution importance resampling over hashed word features.

A text's features are its runs of one to ``longest`` words, hashed into ``BUCKETS`` buckets. The first pass counts buckets
in the corpus and in the target: each task adds up one vector by np.bincount, and treeReduce merges the vectors, so that the
driver sees a few of 80 KB whatever the corpus. A bucket's gain is the log ratio of the smoothed shares of target and
corpus; the gains (80 KB) are broadcast. The second pass gathers them and sums a document's by np.bincount with weights.
Adding Gumbel noise drawn from the document's id to its weight and taking the highest scores is sampling without
replacement in proportion to the likelihood ratio.

Ranks need no global window: documents are counted by score, the counts summed level by level, and only documents whose
score reaches the draw are ordered among those of their own score.

Defined results: a null or empty text has no features, weight 0 and is never drawn while ``least_words`` is above 0; a null
doc_id draws its noise as the empty id and goes before others at equal scores; repeated rows count each and take successive
ranks; an empty corpus gives an empty table; an empty target gives gains from its smoothing alone; texts are read in pieces,
so a very long text needs little memory; other columns, whatever their names, are ignored by the scores and kept by ``resampled``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, offsets, unused, written

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
FAN_IN = 16  # vectors that are merged at one place, and about as many that reach the driver
PIECE = 1 << 19  # bytes of a text, and words of a batch, that are held as words at a time

_CAPITALS = bytes(range(65, 91))
#: A-Z to a-z; all other ASCII but digits and a-z to blanks; bytes of other characters as they are.
_WORDS_ONLY = bytes(c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if c in _CAPITALS else 32 for c in range(256))


def _pieces(text: str) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece."""
    data = text.encode("utf-8", "surrogatepass").translate(_WORDS_ONLY)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE) if start + PIECE < len(data) else -1
        end = len(data) if end < 0 else end
        if words := data[start:end].split():
            yield words
        start = end


def _buckets(texts: pa.Array, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of words, their numbers; rows of features, their buckets), for lots of texts or pieces of one."""
    rows, counts, found, held = [], [], [], 0

    def lot() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        owner, size = np.array(rows, np.int64), np.array([c for c, _ in counts], np.int64)
        hashes = np.fromiter(map(crc32, found), np.int64, len(found)) % BUCKETS
        return owner, size, np.repeat(owner, [n for _, n in counts]), hashes

    for i, text in enumerate(texts):
        tail: list[bytes] = []
        for words in _pieces(text.as_py() or ""):
            features = list(words)
            for n in range(2, longest + 1):
                run = tail[len(tail) - min(n - 1, len(tail)) :] + words
                features += (b" ".join(run[j : j + n]) for j in range(len(run) - n + 1))
            tail = (tail + words)[-(longest - 1) :] if longest > 1 else []
            rows.append(i)
            counts.append((len(words), len(features)))
            found += features
            held += len(features)
            if held >= PIECE:
                yield lot()
                rows, counts, found, held = [], [], [], 0
    if rows:
        yield lot()


def bucket_counts(texts: DataFrame, longest: int = LONGEST) -> np.ndarray:
    """How often each bucket occurs in the texts, the only column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, _, _, hashes in _buckets(b.column(0), longest):
                total += np.bincount(hashes, minlength=BUCKETS)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    vectors = texts.mapInArrow(run, "counts binary").rdd.map(lambda r: np.frombuffer(bytes(r[0]), np.int64))
    n = vectors.getNumPartitions()
    if not n:
        return np.zeros(BUCKETS, np.int64)
    return vectors.treeReduce(np.add, max(2, math.ceil(math.log(n, FAN_IN))))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of each bucket's share in the target over that in the corpus, rounded down."""
    s, t = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(corpus.tolist(), target.tolist())], np.int64)


def _weighed(spark, gain: np.ndarray, longest: int):
    """A column function: text to struct<n_words, n_features, weight>."""
    held = spark.sparkContext.broadcast(gain)  # BUCKETS numbers, always

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gain = held.value.astype(np.float64)  # whole numbers, exact in sums below 2^53
        for b in batches:
            words, features, weight = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for owner, size, rows, hashes in _buckets(b, longest):
                words += np.bincount(owner, weights=size, minlength=len(b)).astype(np.int64)
                features += np.bincount(rows, minlength=len(b))
                weight += np.bincount(rows, weights=gain[hashes], minlength=len(b)).astype(np.int64)
            yield pa.StructArray.from_arrays([pa.array(words), pa.array(features), pa.array(weight)], ["n_words", "n_features", "weight"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "n_words long, n_features long, weight long").asNondeterministic()


def noise(key: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel draw from the seed and the key, rounded down (long)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", target_text: str = "text", longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """docs' own columns and one more, ``own_score``: struct<n_words, n_features, weight, score>."""
    gain = gains(bucket_counts(docs.select(text), longest), bucket_counts(target.select(target_text), longest))
    own = unused(docs, "own_score")
    rows = docs.withColumn(own, _weighed(docs.sparkSession, gain, longest)(F.col(text)))
    score = (F.col(own)["weight"] + noise(F.col(key), seed)).alias("score")
    return rows.withColumn(own, F.struct(*(F.col(own)[c].alias(c) for c in ("n_words", "n_features", "weight")), score))


def drawn_size(rows: DataFrame, percent: int, least_words: int) -> int:
    return rows.filter(F.col("n_words") >= least_words).count() * percent // 100


def ranked(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """rows (key, n_words, n_features, weight, score) with rank: 1, 2, 3 ... by falling score, then key, for the drawn; else null.

    rows are read several times: hand in a written table.
    """
    size = drawn_size(rows, percent, least_words)
    able = F.col("n_words") >= least_words
    falling = [F.shiftright(-F.col("score"), 20).alias("high"), F.shiftright(-F.col("score"), 10).alias("middle"), (-F.col("score")).alias("low")]
    counts = written(rows.filter(able).groupBy("score").agg(F.count("*").alias("n")).select(*falling, "n"), "scores")
    reached = offsets(counts, ["high", "middle", "low"]).filter(F.col("at") < size).select((-F.col("low")).alias("reached"), "at")
    joined = written(rows.join(reached, able & (F.col("score") == F.col("reached")), "left").drop("reached"), "scores-reached")
    top = joined.filter("at IS NOT NULL").groupBy(*rows.columns, "at").agg(F.count("*").alias("equal"))
    top = numbered(top, ["score"], ["key", "n_words", "n_features", "weight"], "at", "place")
    rank = F.when(F.col("place") < size, F.col("place") + 1)
    rest = joined.filter("at IS NULL").select(*rows.columns, F.lit(None).cast("long").alias("rank"))
    return top.select(*rows.columns, rank.alias("rank")).unionByName(rest)


def ranks(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS, **options) -> DataFrame:
    """key, n_words, n_features, weight, score and rank of every document."""
    rows = scored(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), target, "text", "key", **options)
    return ranked(written(rows.select("key", "own_score.*"), "resampling"), percent, least_words)


def resampled(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS, **options) -> DataFrame:
    """The drawn documents, with docs' own columns. Of rows that agree in id and score at the border, as many as are drawn."""
    rows = scored(docs, target, text, key, **options)
    own = rows.columns[-1]
    narrow = written(rows.select(F.col(key).alias("key"), f"{own}.*"), "resampling")
    last = ranked(narrow, percent, least_words).filter("rank IS NOT NULL").orderBy(F.desc("rank")).limit(1).first()
    if last is None:
        return docs.limit(0)
    score, id_ = F.col(own)["score"], F.col(key)
    same_id = id_.eqNullSafe(F.lit(last["key"]))
    before_id = F.coalesce(id_ < F.lit(last["key"]), id_.isNull() & F.lit(last["key"] is not None))
    able = rows.filter(F.col(own)["n_words"] >= least_words)
    first = able.filter((score > last["score"]) | ((score == last["score"]) & before_id))
    border = narrow.filter((F.col("n_words") >= least_words) & ((F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & F.coalesce(F.col("key") < F.lit(last["key"]), F.col("key").isNull() & F.lit(last["key"] is not None)))))
    at_border = able.filter((score == last["score"]) & same_id).limit(last["rank"] - border.count())
    return first.unionByName(at_border).select(*(F.col(f"`{c}`") for c in docs.columns))
