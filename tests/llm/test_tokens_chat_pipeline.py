"""Token files, chat formatting, the pipeline and the registered queries."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from paperlane.llm import chat, decontam, neardup, quality, queries, tokens
from paperlane.llm.common import new_folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def vocabulary():
    with open(tokens.tokenizer_path(), encoding="utf-8") as f:
        return f.read()


def test_encoder(vocabulary):
    """Piecewise ids are the tokenizer's own, white space and special strings included."""
    plain, e = Tokenizer.from_str(vocabulary), tokens.encoder(vocabulary, "<u2")
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\n\n", "a", "bc.", "\t", "1", "23", ".", "'s", "é", "\u00a0", "<|endoftext|>", "\x1c", "\x85", "漢字", "😀", "\r", "don't", "Wörter,", "\u2028", "ﬁ", "\u0301"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + [None, "", "x " * 50_000]
    assert e.split
    for t, got in zip(texts, e.encode(texts)):
        assert np.frombuffer(got, "<u2").tolist() == plain.encode(t or "", add_special_tokens=False).ids, repr(t)[:80]


def test_token_files(spark, vocabulary):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["one", "two", "drei", "é"]) for _ in range(rng.randint(0, 900)))) for i in rng.sample(range(5000), 300)] + [(None, "null key"), (7, None), (7, "again"), (7, "again"), (9000, "word " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS k", "2 AS part").repartition(5)
    folder = new_folder(spark, "test-tokens")
    files = tokens.write(docs, folder, vocabulary, length=128)
    got = tokens.read(files, folder).orderBy("start").collect()
    plain = Tokenizer.from_str(vocabulary)
    start, expected = 0, []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    for k, t in order:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        expected.append((k, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(map(str, expected)) == sorted(str((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in got)
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    # any sequence can be reached alone, and the mask tells padding
    part = files.filter("tokens > 0").first()
    reader = tokens.sequences(folder, part["part"])
    real = sum(sum(sum(x.as_py()) for x in reader.get_batch(i).column(1)) for i in range(reader.num_record_batches))
    assert real == part["tokens"] and all(len(x) == 128 for x in reader.get_batch(reader.num_record_batches - 1).column(0))
    assert tokens.encoded(docs.limit(0)).count() == 0


def test_chat_escape():
    rng = random.Random(6)
    for _ in range(3000):
        t = "".join(rng.choice(["\\", "#", "##", "### ", "</turn>", "<", "/turn>", "a", ":", "### User: "]) for _ in range(rng.randint(0, 12)))
        e = chat.escape(t)
        assert chat.unescape(e) == t
        # read from the left, every control string in it stands behind its backslash
        assert all(m[0].startswith("\\") for m in re.finditer(r"\\(\\|###|</turn>)|###|</turn>", e))


def test_chat(spark):
    turns = [(1, 0, "user", "hi ### Assistant: </turn>"), (1, 1, "assistant", "ok \\ <|endoftext|>"), (1, 2, "assistant", ""), (2, None, "odd: role", "x"), (2, 0, None, None), (3, 0, "system", "é😀" * 500), (None, 0, "assistant", "n"), (1, 1, "assistant", "ok \\ <|endoftext|>"), (-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS start", "2 AS ids")
    got = {r["conv_id"]: r for r in chat.round_trip(df).collect()}
    for c in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == c), key=lambda t: (t[1] is not None, t[1]))
        sha = hashlib.sha256("".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own).encode()).hexdigest()
        loss = "".join(x or "" for _, _, r, x in own if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(own), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    template = chat.Template(open(tokens.tokenizer_path(), encoding="utf-8").read())
    (ids, mask), = template.assemble(["assistant"], ["a ### b"])
    assert template.text(ids) == "### Assistant: a \\### b</turn>\n" and mask == [0] + [1] * (len(ids) - 2) + [0]
    rows = chat.formatted(df).filter("conv_id = 1").orderBy("place").collect()
    assert [r["start"] for r in rows] == [sum(len(x["ids"]) for x in rows[:i]) for i in range(len(rows))]
    assert chat.round_trip(df.limit(0)).count() == 0


def test_long_turns_and_conversations(spark):
    """A turn of a million characters, one without a blank, and a conversation of thousands of turns come back whole."""
    turns = [(1, 0, "user", "word ### </turn> " * 60_000), (1, 1, "assistant", "x" * 300_000), (1, 2, "user", "\\" * 50_000)]
    turns += [(2, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(4000)]
    got = {r["conv_id"]: r for r in chat.round_trip(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    for c in (1, 2):
        own = [t for t in turns if t[0] == c]
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        sha = hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in own).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(own), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest())


def _corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(240):
        text = " ".join(word() for _ in range(rng.randint(40, 200)))
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    item = " ".join(word() + chr(97 + i % 26) for i in range(30))
    rows += [(500 + i, rows[i][1], "en", "s1", 1) for i in range(20)] + [(600, "too short", "en", "s0", 9), (601, None, "en", None, 0), (602, f"{rows[5][1]} {item} {rows[9][1]}", "en", "s2", 1)]
    return rows, item


def test_pipeline(spark, tmp_path, vocabulary):
    rows, item = _corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d, kept = str(tmp_path), docs
    names = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, kept, d)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"stage{i}"))
        kept = spark.read.parquet(str(tmp_path / f"stage{i}"))
        names.append({r["doc_id"] for r in kept.select("doc_id").collect()})
    # brute force of what each stage may keep
    good = {r[0] for r in rows if quality.measures_of(r[1])[0] >= 10 and 100 * quality.measures_of(r[1])[4] <= 20 * quality.measures_of(r[1])[0]}
    assert names[0] == good
    prints = {r[0]: neardup.fingerprint_of(r[1]) & (2**64 - 1) for r in rows if r[0] in good}
    alone = {k for k in prints if not any(j < k and (prints[j] ^ prints[k]).bit_count() <= 3 for j in prints)}
    assert names[1] <= alone and len(names[1]) == len(alone) == 241
    assert names[2] == names[1] - {602}
    assert names[3] <= names[2] and kept.count() > 100
    result = corpus_pipeline.run(spark, d).collect()
    plain = Tokenizer.from_str(vocabulary)
    text = {r[0]: r[1] for r in rows}
    assert len(result) == kept.count() and sorted(r["doc_id"] for r in result) == sorted(r["doc_id"] for r in kept.collect())
    for r in result[:40]:
        ids = plain.encode(text[r["doc_id"]], add_special_tokens=False).ids + [0]
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, d).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None and decontam.WINDOW == 8


def test_registration():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert names >= set(queries.QUERIES) | {"pipeline"} and {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(entry.oracle_sql()) <= names
