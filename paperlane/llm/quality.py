"""Quality rules at host level.

Each document is measured (words, symbols, repeated lines, repeated 5-word windows). Failures are summed by
host, here the document's ``source``; a beta prior fitted to all hosts by moments shrinks each host's failure
rate, and a host whose rate is surely above ``max_host_rate`` is rejected with all its documents. The verdict is
joined back by host.

Defined results: a null text has no words and fails; an empty table gives an empty table; a null source is a host
of its own; repeated rows are judged one by one; other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BREAKS, per_text, unused, written

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
MAX_HOST_RATE = 0.5
Z = 1.645  # one-sided 95 %

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measures_of(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at exactly the word breaks
    chars = len(text) - sum(map(text.count, WORD_BREAKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), _repeated_words(words)


def _repeated_words(words: list[bytes]) -> int:
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    inside = bytearray(len(words))
    for i, w in enumerate(windows):
        if counts[w] > 1:
            inside[i : i + WINDOW] = b"\1" * WINDOW
    return sum(inside)


def measures(text: Column) -> Column:
    """A struct of MEASURES for each text."""
    udf = per_text(lambda: measures_of, ", ".join(f"{m} long" for m in MEASURES), [(m, pa.int64()) for m in MEASURES])
    return udf(text)


def failed(n_words: Column, n_repeat_words: Column) -> Column:
    """The document's own rules."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def measured(docs: DataFrame, text: str = "text", host: str = "source", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``host``, the measures and ``base_failed`` of every document."""
    df = docs.select(*(F.col(k) for k in keep), F.col(host).alias("host"), measures(F.col(text)).alias("m"))
    df = df.select(*keep, "host", "m.*")
    return df.withColumn("base_failed", failed(F.col("n_words"), F.col("n_repeat_words")))


def host_rates(rows: DataFrame) -> DataFrame:
    """From (host, base_failed) rows: host, n, k, rate (shrunk), low (its lower bound).

    The prior's mean is the overall rate; its weight comes from the variance between hosts beyond the binomial
    one, held within 1 and 1e6 documents. Hosts are few against documents and their sums are made map-side.
    """
    by = rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("k"))
    by = written(by, "host-counts")
    s = by.agg(F.count("*").alias("hosts"), F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk")).first()
    mean = s["k"] / s["n"] if s["n"] else 0.0
    between = s["kk"] / s["n"] - mean * mean - mean * (1 - mean) * s["hosts"] / s["n"] if s["n"] else 0.0
    weight = min(max(mean * (1 - mean) / between - 1, 1.0), 1e6) if between > 0 else 1e6
    a, b = F.col("k") + mean * weight, F.col("n") - F.col("k") + (1 - mean) * weight
    rate = a / (a + b)
    return by.select("host", "n", "k", rate.alias("rate"), (rate - Z * F.sqrt(rate * (1 - rate) / (a + b + 1))).alias("low"))


def judged(rows: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``measured`` rows with host_rate and kept. rows are read twice: hand in a written table."""
    hosts = host_rates(rows.select("host", "base_failed")).select(F.col("host").alias("h"), F.col("rate").alias("host_rate"), (F.col("low") > max_host_rate).alias("rejected"))
    hosts = written(hosts, "host-verdicts")  # its size is then known: Spark broadcasts it only below its threshold, else merges and splits hot hosts
    joined = rows.join(hosts, rows["host"].eqNullSafe(hosts["h"]), "left")
    return joined.withColumn("kept", ~(F.col("base_failed") | F.col("rejected"))).drop("h", "rejected")


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The documents that pass, with docs' own columns."""
    m, bad_host = unused(docs, "own_measures"), unused(docs, "bad_host")
    rows = docs.withColumn(m, measures(F.col(text)))
    rows = written(rows.withColumn(m, failed(F.col(m)["n_words"], F.col(m)["n_repeat_words"])), "judged-texts")  # texts are measured once
    bad = host_rates(rows.select(F.col(host).alias("host"), F.col(m).alias("base_failed"))).filter(F.col("low") > max_host_rate)
    bad = written(bad.select(F.col("host").alias(bad_host)), "bad-hosts")
    good = rows.filter(~F.col(m))
    good = good.join(bad, good[host].eqNullSafe(bad[bad_host]), "left_anti")
    return good.select(*(F.col(f"`{c}`") for c in docs.columns))
