"""Quality rules, URL filters and mixing against plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from paperlane.llm import mixing, quality, urls

SCHEMA = "doc_id long, text string, source string"
LONG = " ".join(f"w{i}" for i in range(50_000))


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside)


TEXTS = [None, "", " \n\t", "one", "a b c d e a b c d e f", "x y\nx y\n \nx  y\n", "é ü #$ <b>|*&%\u00a0z", "a " * 40, "r1 r2 r3 r4 r5 q r1 r2 r3 r4 r5 s r2 r3 r4 r5 q", "\r\v\fmixed\x1cword"]


def test_measures():
    for t in TEXTS:
        assert quality.measures_of(t) == brute(t), t
    assert quality.measures_of(LONG)[0] == 50_000


def test_verdicts(spark):
    good = " ".join(f"word{i}" for i in range(20))
    rows = [(i, f"{good} {i}", "fine") for i in range(40)] + [(100 + i, "bad", "spam") for i in range(60)] + [(200, good, "spam"), (None, good, None), (None, None, None), (0, f"{good} 0", "fine")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS host", "2 AS base_failed", "3 AS kept")
    got = quality.judged(quality.measured(docs.select("doc_id", "text", "source"))).collect()
    assert len(got) == len(rows)
    assert {(r["host"], r["base_failed"], r["kept"]) for r in got} == {("fine", False, True), ("spam", True, False), ("spam", False, False), (None, False, True), (None, True, False)}
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 42


def test_quality_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.judged(quality.measured(empty)).count() == 0 and quality.keep_good(empty).count() == 0


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def fit(host, path):
    best = None
    for verdict, rule in urls.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best


URLS = [None, "", "no scheme", "http://Example.ORG/es/x", "https://a.example.org/en/12?q", "http://example.org", "http://example.org?x=/es/", "ftp://x.com/fr/1#y", "http://x.com/de/", "://", "http://É.com/de/", "a://b://c.org/", "http://xexample.org/es/", "http://h.net/p", "http://com/fr/", "http://1.2.3.4:80/a"]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)], "page_id long, url string, host int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for r in urls.judged(pages, labels).collect():
        host, path = split(URLS[r["page_id"]])
        best = fit(host, path)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, best and best[1], best[0] if best else "allow")


def test_url_reputation(spark):
    rows = [(i, f"http://bad{i % 3}.farm.net/p{i}") for i in range(90)] + [(100 + i, f"http://ok{i}.fine.net/p") for i in range(90)] + [(300, "http://new.farm.net/x"), (301, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, 0, None) for i in range(90)] + [(100 + i, 1, 0) for i in range(90)] + [(300, None, None)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r["verdict"] for r in urls.judged(pages, labels).collect()}
    assert all(got[i] == "block" for i in range(90)) and all(got[100 + i] == "allow" for i in range(90)) and got[301] == "allow" and len(got) == len(rows)
    empty = pages.limit(0)
    assert urls.judged(empty, labels).count() == 0


def water(sizes, weights, cap=3):
    total, full, out = sum(sizes), set(), {}
    while True:
        rest, w = total - sum(cap * sizes[i] for i in full), sum(weights[i] for i in range(len(sizes)) if i not in full)
        out = {i: cap * sizes[i] if i in full else rest * weights[i] / w for i in range(len(sizes))}
        over = {i for i in out if i not in full and out[i] > cap * sizes[i]}
        if not over:
            return out
        full |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1000, 2, 3, 5000, 10], [5, 0, 7, 900], [1], [0, 0], [10, 10, 1, 1, 1, 1, 1, 500]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i:02d}", s) for i, s in enumerate(sizes)], "source string, source_size long")
    got = {int(r["source"][1:]): r["target"] for r in mixing.targets(df).collect()}
    expected = water(sizes, [i % 3 + 1 for i in range(len(sizes))])
    assert got.keys() == expected.keys() and all(got[i] == pytest.approx(expected[i]) for i in got)


def test_mix(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 97)), f"s{i % 5 if i % 3 else 0}") for i in range(3000)] + [(5000 + i, "a b c", None) for i in range(20)] + [(7, None, "s0"), (7, "", "s0"), (None, "x y", "s1"), (3, "a b", "s1"), (3, "a b", "s1")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS size", "2 AS copies")
    sized = mixing.sized(docs)
    got = mixing.copies(sized).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.copies(sized).collect()))
    assert {r["size"] for r in got if r["key"] == 7 and r["source"] == "s0"} >= {0}
    taken, target = {}, {}
    for r in got:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert all(taken[s] == pytest.approx(target[s], rel=0.05, abs=97) for s in taken)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.copies(mixing.sized(docs.limit(0))).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_clashing_names(spark):
    """Columns of documents that are named like an operator's own pass through as they are."""
    text = "one two three four five six seven eight nine ten eleven"
    names = ["own_measures", "bad_host", "__measures", "host", "mix_own", "mix_id", "mix_copies", "size", "tie", "row", "place", "equal", "copies"]
    rows = [(i, f"{text} {i}", "s", *range(len(names))) for i in range(9)] + [(None, None, None, *range(len(names)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} long" for n in names))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == sorted(rows[:9])
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns and {tuple(r) for r in mix.collect()} <= set(rows)


def test_mix_of_equal_rows(spark):
    """Null keys, one key for many texts and equal rows in number: places stay distinct and what is taken near the target."""
    rows = [(None, f"w {i}", "a") for i in range(3000)] + [(7, f"x y {i}", "a") for i in range(3000)] + [(8, "same text here", "b")] * 5000 + [(None, "same text here", "b")] * 5000 + [(i, "a b c d", "c") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    placed = mixing.placed(mixing.sized(docs))
    assert placed.groupBy("source").agg(F.countDistinct("place").alias("d"), F.min("place").alias("a"), F.max("place").alias("b"), F.count("*").alias("n")).filter("a = 1 AND b = n AND d = n").count() == 3
    got = mixing.copies(mixing.sized(docs)).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect()
    assert {r["source"]: r["n"] for r in got} == {"a": 6000, "b": 10_000, "c": 200}
    assert all(abs(r["taken"] - r["target"]) <= 0.01 * r["target"] + 8 for r in got)
    mix = mixing.mixed(docs).groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("taken")).collect()
    assert {r["source"]: r["taken"] for r in mix} == {r["source"]: r["taken"] for r in got}
