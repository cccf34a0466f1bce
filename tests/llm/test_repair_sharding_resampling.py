"""Structure repair, sharding and importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlane.llm import repair, resampling, sharding

# ---- op11

TURNS = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """(cost, edits, lines) of the best repair of (role, text, fault) rows, by plain recursion over all edits."""
    n = len(rows)

    @cache
    def best(i, state, inserted):
        options = [(10**9, "", ())]  # no way on
        if i == n and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            due = "a" if state == "u" else "u"
            c, e, lines = best(i, due, inserted + 1)
            options.append((c + 5, "I" + e, ({"a": "assistant:", "u": "user:"}[due], *lines)))
        if i < n:
            role, text, fault = rows[i]
            c, e, lines = best(i + 1, state, 0)
            options.append((c + 2, "D" + e, lines))
            extra = 5 if fault == "truncated" else 0
            if fault not in ("blank", "duplicate"):
                due = "a" if state == "u" else "u"
                c, e, lines = best(i + 1, due, 0)
                options.append((c + 1 + extra, "R" + e, (f"{'assistant' if due == 'a' else 'user'}:{text}", *lines)))
                if (role[:1], state) in {("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")}:
                    c, e, lines = best(i + 1, role[:1], 0)
                    options.append((c + extra, "K" + e, (f"{role}:{text}", *lines)))
        return min(options)

    return best(0, "", 0)


def brute_repair(rows):
    """rows (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    cost, edits, lines = cheapest(tuple(out))
    turns = [t for t, _, _ in rows if t is not None]
    count = Counter(f for _, _, f in out)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["blank"], count["duplicate"], count["truncated"], illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_edits_are_the_cheapest_and_first():
    rng = np.random.default_rng(5)
    roles, faults = ["tool", "system", "user", "assistant"], ["", "blank", "duplicate", "truncated"]
    some = [rng.choice(16, size=n, p=[0.03, 0.07, 0.25, 0.25, 0.02, 0.02, 0.04, 0.04, 0.02, 0.02, 0.04, 0.04, 0.02, 0.04, 0.05, 0.05]).astype(np.uint8) for n in [0, 0, 1, 1, 2, 3, 5, 8, 13, 40, 41, 60] * 12]
    for kinds, (cost, edits) in zip(some, repair.edits_of(some)):
        wanted = cheapest(tuple((roles[k & 3], "t", faults[k >> 2]) for k in kinds.tolist()))
        assert (cost, edits.decode()) == wanted[:2], kinds


def test_long_conversations_go_by_blocks(monkeypatch):
    rng = np.random.default_rng(6)
    some = [rng.choice(16, size=n).astype(np.uint8) for n in (5000, 4999, 513, 512, 511, 3)]
    whole = repair.edits_of(some)
    monkeypatch.setattr(repair, "BLOCK", 7)
    assert repair.edits_of(some) == whole
    monkeypatch.setattr(repair, "BLOCK", 1 << 20)
    assert repair.edits_of(some) == whole
    for kinds, (_, edits) in zip(some, whole):
        assert sum(e != ord("I") for e in edits) == len(kinds)


CONVERSATIONS = {
    1: [(0, "system", "Be kind."), (1, "user", "Hi."), (2, "assistant", "Hello!"), (3, "user", "Hi."), (5, "user", "More?"), (6, "assistant", "cut off")],
    2: [(0, "assistant", "First."), (1, "assistant", "Second."), (1, "assistant", "Second.")],
    3: [(None, None, None), (0, "tool", "Result.")],
    4: [(0, "user", "a" * 200_000 + ". \n"), (9, "system", "late.")],
    None: [(None, "user", "No id."), (None, "user", "No id, too.")],
    6: [(0, "", "x."), (1, "user", " . ")],
}


def test_repair_of_tables(spark):
    rows = [(c, *t) for c, ts in CONVERSATIONS.items() for t in ts]
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "false AS gone", "1 AS kind", "2 AS digest", "3 AS place", "4 AS plan")
    turns = turns.unionByName(spark.createDataFrame([(7, 0, "user", "All.", True), (1, 4, "user", "Not here.", True)], f"{TURNS}, gone boolean").selectExpr("*", "1 AS kind", "2 AS digest", "3 AS place", "4 AS plan"))
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.digests(turns).collect()}
    blank = lambda x: " " if x is None else x
    for c, ts in CONVERSATIONS.items():
        order = sorted(ts, key=lambda t: (t[0] is not None, t[0] or 0, blank(t[1]), hashlib.md5(blank(t[2]).encode()).digest()))
        assert got.pop(c) == brute_repair([(t, blank(r), blank(x)) for t, r, x in order]), c
    assert got == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    fixed = repair.repaired(turns).filter("conv_id = 1").orderBy("place").collect()
    assert [(r["place"], r["role"][0], r["edit"]) for r in fixed] == [(i + 1, "suauaua"[i], e) for i, e in enumerate(r["edit"] for r in fixed)]


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert repair.digests(empty).count() == 0 and repair.repaired(empty).count() == 0 and repair.damaged(empty).count() == 0


def test_damage(spark):
    turns = spark.createDataFrame([(c, t, "assistant", f"Yes? No! {t}.") for c in range(40) for t in range(5)] + [(None, None, None, None)], TURNS)
    got = Counter(map(tuple, repair.damaged(turns).collect()))
    wanted = Counter()
    for c, t, role, text in [tuple(r) for r in turns.collect()]:
        what = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        wanted[(c, t, "user" if what == 4 else role, text, what == 0)] += 2 if what == 3 else 1
    assert got == wanted


def test_repair_query_against_brute_force(spark):
    from paperlane.llm import queries

    rows = [r for r in repair.damaged(queries.table(spark, "/root/testdata/sf0.01", "conversations")).collect()]
    by = {}
    for r in rows:
        by.setdefault(r["conv_id"], []).extend([] if r["gone"] else [(r["turn"], r["role"], r["text"])])
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op11_structure_repair(spark, "/root/testdata/sf0.01").collect()}
    assert got == {c: brute_repair(sorted(ts)) for c, ts in by.items()}


def test_one_conversation_holds_most_turns(spark):
    """Thousands of turns, many of them equal, beside short conversations: blocks, the stream and the hash hold for all."""
    long = [(i, ["user", "assistant", "system"][i * i % 3], f"text {i % 1500}" + "." * (i % 5 > 0)) for i in range(6000)]
    short = {c: [(0, "user", f"q{c}."), (1, "assistant", f"a{c}.")] for c in range(2, 40)}
    rows = [(1, *t) for t in long] + [(c, *t) for c, ts in short.items() for t in ts]
    got = {r["conv_id"]: r for r in repair.digests(spark.createDataFrame(rows, TURNS)).collect()}
    assert all((got[c]["cost"], got[c]["audit"]) == (0, "KK") for c in short) and len(got) == 39
    r, seen, kinds = got[1], set(), []
    for _, role, text in long:
        fault = 2 if (role, text) in seen else 0 if text.endswith(".") else 3
        seen.add((role, text))
        kinds.append({"system": 1, "user": 2, "assistant": 3}[role] + 4 * fault)
    (cost, edits), = repair.edits_of([np.array(kinds, np.uint8)])
    lines, at, state = [], 0, "a"
    for e in edits.decode():
        due = "assistant" if state == "u" else "user"
        if e in "DKR":
            _, role, text = long[at]
            at += 1
        if e != "D":
            role, text = (due, "") if e == "I" else (due, text) if e == "R" else (role, text)
            lines.append(f"{role}:{text}")
            state = role[0]
    assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, edits.decode(), hashlib.sha256("\n".join(lines).encode()).hexdigest()) and at == 6000


# ---- op12


def draws(tree, key, seed=sharding.SEED):
    """The shard of a key, by the plain rule."""
    at, members = (), [x for x in tree if x.weight > 0]
    for field in ("region", "rack", "shard"):
        best = None
        for name in sorted({getattr(x, field) for x in members}):
            h = int(hashlib.md5(f"{seed}:{'/'.join(map(str, (*at, name)))}:{key}".encode()).hexdigest()[:8], 16)
            draw = -math.log((h + 0.5) / 2**32) / sum(x.weight for x in members if getattr(x, field) == name)
            best = min(best or (draw, name), (draw, name))
        at, members = (*at, best[1]), [x for x in members if getattr(x, field) == best[1]]
    return at[-1]


def test_shards(spark):
    rows = [(i, f"text {i % 7}") for i in range(4000)] + [(None, "no id"), (None, None), (5, "text 5"), (5, "text 5"), (5, None), (9, "é" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS shard", "2 AS slot", "3 AS size", "4 AS key", "5 AS cell", "6 AS tree_step")
    got = sharding.placed(docs).collect()
    crc = lambda t: zlib.crc32((t or "").encode())
    assert Counter((r["key"], r["size"], r["text_crc32"]) for r in got) == Counter((k, len((t or "").encode()) + 8, crc(t)) for k, t in rows)
    tree = sharding.layout()
    for r in got:
        key = "" if r["key"] is None else r["key"]
        assert r["shard"] == draws(tree, key) and r["grown_shard"] == draws(sharding.grown(tree), key)
        assert r["grown_shard"] in (r["shard"], 24)
    for shard, n in Counter(r["shard"] for r in got).items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
        assert abs(n - 4000 / 24) < 60
    assert set(Counter(r["shard"] for r in got)) == set(range(24))
    moved = sum(r["grown_shard"] == 24 for r in got)
    assert abs(moved - 4006 / 25) < 60


def test_one_id_holds_most_rows(spark):
    """A null id for many texts and one row many times over: their slots stay without gaps, and cells spread them."""
    rows = [(None, f"text {i}") for i in range(3000)] + [(5, "same")] * 4000 + [(i, "x") for i in range(500)]
    got = sharding.placed(spark.createDataFrame(rows, "doc_id long, text string"))
    whole = got.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert all(r["n"] == r["d"] == r["m"] + 1 for r in whole) and sum(r["n"] for r in whole) == len(rows)
    assert got.filter("key IS NULL").select("shard").distinct().count() == 1 == got.filter("key = 5 AND size = 12").select("shard").distinct().count()


def test_weights_move_only_their_subtree(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id")
    tree = tuple(x._replace(weight=2.0 if x.shard < 8 else 1.0) for x in sharding.layout())
    heavier = tuple(x._replace(weight=5.0) if x.shard == 9 else x for x in tree)  # region 1, rack 0
    without = tuple(x._replace(weight=0.0) if x.shard == 9 else x for x in tree)
    rows = sharding.sharded(sharding.sharded(sharding.sharded(docs, tree, name="a"), heavier, name="b"), without, name="c").collect()
    region = {x.shard: x.region for x in tree}
    for r in rows:
        if region[r["a"]] != 1 and r["b"] != r["a"]:
            assert region[r["b"]] == 1  # only into the subtree that grew
        if r["c"] != r["a"]:
            assert region[r["a"]] == 1 and r["c"] != 9  # only out of the subtree that shrank
    n = Counter(r["a"] for r in rows)
    assert abs(sum(n[i] for i in range(8)) / 3000 - 0.5) < 0.05
    assert not any(r["c"] == 9 for r in rows) and Counter(r["b"] for r in rows)[9] > 2 * n[9]


def test_shards_of_nothing_and_files(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.placed(empty).count() == 0
    with pytest.raises(ValueError):
        sharding.sharded(empty, ())
    docs = spark.createDataFrame([(i, f"t{i}", "s") for i in range(300)], "doc_id long, text string, shard string")
    sharding.save(docs, str(tmp_path / "out"), files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 300 and back.select("doc_id", "text", "shard").exceptAll(docs).count() == 0
    own = sharding.layout()
    assert all(r["shard_"] == draws(own, r["doc_id"]) for r in back.collect())


def test_sharding_plan_has_no_python(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    plan = sharding.sharded(spark.read.parquet(str(tmp_path / "d")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---- op13


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute_ranks(docs, target, longest=1, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(bucket, features(x, longest)[1]))
    for x in target:
        t.update(map(bucket, features(x, longest)[1]))
    a, b = sum(s.values()), sum(t.values())
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (a + 10_000) / ((s[k] + 1) * (b + 10_000))))
    out = []
    for key, x in docs:
        words, fs = features(x, longest)
        weight = sum(gain(bucket(f)) for f in fs)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(words), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    size = len(able) * percent // 100
    drawn = [(*r, i + 1) for i, r in enumerate(able[:size])]
    rest = Counter(tuple(r) for r in out)
    rest.subtract(d[:-1] for d in drawn)
    return Counter(drawn) + Counter({(*k, None): n for k, n in rest.items() if n > 0})


WORDS = "The quick brown fox, JUMPS over 12 lazy dogs! naïve_Ünïcode sep x86-64 \x00 \x7f~ end".split(" ")


def corpus():
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(WORDS, size=int(n)))) for i, n in enumerate(rng.integers(0, 60, 300))]
    copy = " ".join(WORDS * 3)
    return rows + [(7, copy)] * 40 + [(None, copy)] * 5 + [(None, None), (400, ""), (401, " \n"), (None, " ".join(WORDS * 2)), (402, "fox " * 30_000)]


@pytest.mark.parametrize("longest", [1, 3])
def test_ranks(spark, longest, monkeypatch):
    docs, target = corpus(), ["lazy dogs over naïve foxes", None, "", "quick quick fox"]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS weight", "3 AS key", "4 AS own_score")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.ranks(frame, goal, longest=longest, percent=50)
    assert Counter(map(tuple, got.collect())) == brute_ranks(docs, target, longest, 50)
    drawn = resampling.resampled(frame, goal, longest=longest, percent=50)
    assert drawn.columns == frame.columns
    wanted = Counter(k[0] for k in brute_ranks(docs, target, longest, 50).elements() if k[-1])
    assert Counter(r["doc_id"] for r in drawn.collect()) == wanted


def test_pieces_of_long_texts(monkeypatch):
    text = " ".join(f"{w}{i}" for i, w in enumerate(WORDS * 500))
    one = list(resampling._buckets(resampling.pa.array([text, None, "a b c"]), 3))
    monkeypatch.setattr(resampling, "PIECE", 100)
    many = list(resampling._buckets(resampling.pa.array([text, None, "a b c"]), 3))
    assert len(many) > 50
    for row in range(3):
        assert sorted(np.concatenate([h[r == row] for _, _, r, h in one])) == sorted(np.concatenate([h[r == row] for _, _, r, h in many]))
        assert sum(int(s[o == row].sum()) for o, s, _, _ in one) == sum(int(s[o == row].sum()) for o, s, _, _ in many) == len(features([text, None, "a b c"][row], 1)[0])


def test_nothing_to_draw(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    docs = spark.createDataFrame([(1, "few words"), (2, None)], "doc_id long, text string")
    assert resampling.ranks(empty, docs).count() == 0 and resampling.resampled(empty, docs).count() == 0
    assert Counter(map(tuple, resampling.ranks(docs, empty).collect())) == brute_ranks([(1, "few words"), (2, None)], [])
    assert resampling.resampled(docs, empty).count() == 0
    empty.write.parquet(str(tmp_path / "e"))
    assert resampling.bucket_counts(spark.read.parquet(str(tmp_path / "e")).select("text")).sum() == 0
