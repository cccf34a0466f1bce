"""Benchmark decontamination by template canonicalisation. Column expressions only.

A text becomes a sequence of tokens: words in lower case, and slots, which are numbers (with their units) and words that
begin with a capital, so names. Two templates are read off one sequence: in the plain one only numbers are typed
placeholders, so it is the same in capitals, title case and lower case; in the one with names these are placeholders,
too, so a question whose figures and names were changed has its old template. All windows of WINDOW tokens of the
benchmark and of a document are joined on their templates' hash, so any run of WINDOW or more tokens that a document
shares with an item is met (with a larger ``stride`` only runs of WINDOW + stride - 1).

Two tests judge what met. A window is evidence if at least half its tokens are plain words or slots with the item's own
value; so a series of numbers counts when it is the item's, not when it only has its shape. Slot consistency: along one
alignment, equal values in the item must stand against equal values in the document; where they don't, the shared
template is chance. A document holds an item if such windows cover ``share`` of the item's tokens or more.

Items shorter than WINDOW are one window of their own length. Items of fewer than LEAST tokens would be met in running
text by chance: a document holds such an item, with its own values, where it stands as a sentence or line of its own, after a
label or a list mark, or is the whole text; a question of LEAST_QUESTION tokens or more is also met as the end of any question.

Only windows whose hash may be the benchmark's leave a document's row: a Bloom filter of all the benchmark's hashes, of
at most 2^MOST_BITS bits, is tested inside the array. Beyond that size it lets more windows through to the join, which
decides.

Defined results: null or empty texts, and texts without a letter or digit, match nothing; matches are reported by key
once, repeated items under each item_id; ``clean`` judges each distinct text of a key by itself, rows without a key, too;
empty tables give an empty table; other columns, whatever their names, pass through or are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused, written

WINDOW = 8
STRIDE = 1
SHARE = 0.5
LEAST = 5  # tokens of the shortest item that is searched for in running text
BROADCAST_WINDOWS = 100_000  # windows of the benchmark that may be broadcast, at 200 bytes each at most about 20 MB
BITS_EACH, MOST_BITS, PROBES = 32, 24, 2  # bits of the filter for each window, its greatest size as a power of 2, bits set for a hash

# Units that may follow a number and belong to it.
UNITS = "%|percent|km|cm|mm|kg|mg|g|lb|lbs|oz|m|s|h|min|mph|kmh|hours|hour|minutes|minute|seconds|days|day|years|year|miles|mile|meters|metres|feet|foot|inches|liters|litres|ml|l|dollars|euros|eur|usd|cents"
NUMBER = rf"(?<![\p{{L}}\p{{N}}])[$€£]?\p{{N}}+(?:[.,:/]\p{{N}}+)*(?: ?(?i:{UNITS})(?![\p{{L}}\p{{N}}]))?"
NAME = r"(?<![\p{L}\p{N}])(?<!\p{N} )\p{Lu}\p{L}+"  # what follows a digit and a blank is its unit

# A slot's token begins with its mark, and only slots are below END in order.
NUM, END, NAM = "\u0001", "\u0002", "\u0003"
WORDS_FROM = "\u0004"
# A label's colon ends a piece, too; a quotation mark or bracket may close it.
SENTENCES = r"[\n\r]+|(?<=[.!?:;])\s+|(?<=[.!?:;][\"')\]\u2019\u201d])\s+"
LIST_MARK = r"^\s*(?:[-*>#\u2022]+|\(?(?:[0-9]{1,3}|[A-Za-z])[.)])\s+"
QUESTION = r"\?[\s\"'\u2019\u201d)\]]*$"
LEAST_QUESTION = 3  # tokens of a short question that is met at the end of a longer one


Test = Callable[[Column], Column]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once: as a lambda's argument it is not repeated wherever body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _once(column: Column, name: str) -> Column:
    """A generator of one row: what stands above reads its column and does not make Spark compute it again."""
    return F.inline(F.array(F.struct(column.alias(name))))


def tokens(text: Column) -> Column:
    """The tokens of a text: words in lower case, slots between their marks.

    Case is folded through capitals, so letters that are two in capitals (as in German) are two; at once, Spark would
    leave the capitals out.
    """
    plain = F.regexp_replace(text, f"[{NUM}-{NAM}]", " ")
    marked = _let(plain, lambda p: F.when(p.rlike("\\p{N}"), F.regexp_replace(p, NUMBER, f" {NUM}$0{END} ")).otherwise(p))
    named = F.regexp_replace(marked, NAME, f"{NAM}$0{END}")
    token = F.lit(f"[{NUM}{NAM}][^{END}]*{END}|\\p{{L}}+")
    return _let(F.upper(named), lambda u: F.regexp_extract_all(F.lower(u), token, F.lit(0)))


def _value(token: Column) -> Column:
    return F.translate(token, NUM + END + NAM, "")


def _is_name(token: Column) -> Column:
    return (token >= NAM) & (token < WORDS_FROM)


def _codes(toks: Column) -> Column:
    """A number for each token: a hash that is even for words and numbers (one for all), odd for names."""
    odd = lambda t: F.xxhash64(_value(t)).bitwiseOR(F.lit(1))
    return F.transform(toks, lambda t: F.when(t >= WORDS_FROM, F.xxhash64(t).bitwiseAND(F.lit(-2))).when(t < END, F.lit(0).cast("long")).otherwise(odd(t)))


def _run(codes: Column, first: Column, length: int, form: int) -> Column:
    """The hash of a template's ``length`` tokens from the 0-based ``first`` on: names as words, or all alike."""
    def one(code: Column) -> Column:
        return F.when(code.bitwiseAND(F.lit(1)) == 1, F.lit(1).cast("long")).otherwise(code) if form else code.bitwiseAND(F.lit(-2))

    return F.xxhash64(*(one(F.get(codes, first + k)) for k in range(length)))


def windows(rows: DataFrame, lengths: list[int], window: int, stride: int = 1, heads: Test | None = None, whole: Test | None = None) -> DataFrame:
    """rows (..., toks) as rows (..., form, w, pos, head, h, slots): the windows of w tokens, in the form with names (1) only those that hold one.

    First places are tested by their first LEAST tokens, in a generated loop over the array of a text, which is not
    copied for each. The little that is left goes through expressions that would make that loop too long to compile.
    """
    ids = [c for c in rows.columns if c != "toks"]
    places = rows.filter(F.size("toks") >= LEAST).select("*", _once(_codes(F.col("toks")), "codes"))
    places = places.select("*", F.explode(F.sequence(F.lit(0), F.size("codes") - LEAST)).alias("first"))
    if heads is not None:
        both = F.struct(*(_run(F.col("codes"), F.col("first"), LEAST, form).alias(f"head{form}") for form in (0, 1)))
        places = places.select("*", F.inline(F.array(both))).filter(heads(F.col("head0")) | heads(F.col("head1"))).drop("head0", "head1")

    def window_at(i: Column, form: int, w: int) -> Column:
        h = _run(F.col("codes"), i, w, form)
        good = (i <= F.size("codes") - w) & (i % (stride if w == window else 1) == 0)
        if form:
            good = good & F.exists(F.slice("codes", i + 1, F.lit(w)), lambda c: c.bitwiseAND(F.lit(1)) == 1)
        if whole is not None:
            good = good & whole(h)
        each = F.transform(F.slice("toks", i + 1, F.lit(w)), lambda t, k: F.struct(k.alias("i"), t.alias("value")))
        slots = F.filter(each, lambda s: s["value"] < (WORDS_FROM if form else END))
        fields = {"form": F.lit(form), "w": F.lit(w), "pos": i + 1, "head": _run(F.col("codes"), i, LEAST, form), "h": h, "slots": slots}
        return F.when(good, F.struct(*(v.alias(k) for k, v in fields.items())))

    found = _let(F.col("first"), lambda i: F.array_compact(F.array(*(window_at(i, form, w) for form in (0, 1) for w in lengths))))
    return places.select(*ids, F.inline(found))


def _test_of(hashes: DataFrame, n: int) -> Test:
    """A test that holds for each of the n hashes (h) and for few others: a Bloom filter as one constant array.

    Only its words come to the driver, 2^MOST_BITS / 64 at most.
    """
    log = min(max((BITS_EACH * n - 1).bit_length() if n else 0, 12), MOST_BITS)

    def places(h: Column) -> list[Column]:
        return [F.shiftrightunsigned(h, k * log).bitwiseAND(F.lit((1 << log) - 1)) for k in range(PROBES)]

    bits = hashes.select(F.explode(F.array(*places(F.col("h")))).alias("at"))
    bits = bits.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS INT))")).alias("bits"))
    values = [0] * (1 << log - 6)
    for r in bits.collect():
        values[r["word"]] = r["bits"]
    table = F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # folded into one literal

    def bit(at: Column) -> Column:
        return F.bit_get(F.get(table, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1

    return lambda h: reduce(lambda a, b: a & b, map(bit, places(h)))


def _whole(toks: Column) -> Column:
    return F.xxhash64(F.transform(toks, _value))


def _held(docs: DataFrame, items: DataFrame, share: float, window: int, stride: int) -> DataFrame:
    """From docs (key, text) and items (item_key, text): key, t (the text's hash), item_key and the measures of what each text holds."""
    own = written(items.select(F.monotonically_increasing_id().alias("item"), "item_key", F.coalesce(F.col("text").rlike(QUESTION), F.lit(False)).alias("asks"), tokens(F.col("text")).alias("toks")).filter("size(toks) > 0"), "items")
    docs = docs.filter("text IS NOT NULL").select("key", F.xxhash64("text").alias("t"), "text")
    lengths = sorted(r[0] for r in own.select(F.least(F.size("toks"), F.lit(window))).distinct().collect())  # at most ``window`` numbers
    found = [_brief(docs, own.filter(F.size("toks") < LEAST))] if lengths and lengths[0] < LEAST else []
    long = own.filter(F.size("toks") >= LEAST)
    rows = None
    for w in (n for n in lengths if n >= LEAST):
        of_w = long.filter(F.size("toks") == w if w < window else F.size("toks") >= window)
        part = windows(of_w.select("item", "toks"), [w], window)
        rows = part if rows is None else rows.unionByName(part)
    if rows is not None:
        found.append(_covered(docs, written(rows, "item-windows"), long, [n for n in lengths if n >= LEAST], share, window, stride))
    if not found:
        found = [_brief(docs, own)]  # no items: an empty table
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _covered(docs: DataFrame, wanted: DataFrame, own: DataFrame, lengths: list[int], share: float, window: int, stride: int) -> DataFrame:
    n = wanted.count()
    small = n <= BROADCAST_WINDOWS
    tests = [_test_of(wanted.select(F.col(c).alias("h")), n) for c in ("head", "h")]
    wanted = wanted.select("item", "form", "w", "h", F.col("pos").alias("at"), F.col("slots").alias("item_slots"))
    rows = docs.select("key", "t", _once(tokens(F.col("text")), "toks"))
    rows = windows(rows, lengths, window, stride, *tests).drop("head")
    # The benchmark's size is counted first; beyond the bound the few windows left are shuffled by their hash and Spark splits hot ones.
    met = rows.join(F.broadcast(wanted) if small else wanted, ["h", "form", "w"])
    same = F.size(F.filter(F.zip_with("slots", "item_slots", lambda a, b: a["value"] == b["value"]), lambda x: x))
    met = met.filter(2 * (F.col("w") - F.size("slots") + same) >= F.col("w"))
    met = written(met.select("key", "t", "item", "form", "w", "at", (F.col("pos") - F.col("at")).alias("line"), "slots", "item_slots"), "met-windows")
    ids = ["key", "t", "item", "form", "line"]
    # numbers outside of names' windows bear on the form with names, too
    forms = F.when(F.col("form") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    pairs = met.select("key", "t", "item", F.explode(forms).alias("form"), "line", "slots", "item_slots").select(*ids, F.explode(F.arrays_zip("slots", "item_slots")).alias("z"))
    pairs = pairs.select(*ids, F.col("z.slots.value").alias("value"), F.col("z.item_slots.value").alias("item_value"))
    values = pairs.groupBy(*ids, "item_value").agg((F.min("value") == F.max("value")).alias("same"), F.max((F.col("value") != F.col("item_value")).cast("int")).alias("new"))
    lines = values.groupBy(*ids).agg(F.min("same").alias("consistent"), F.count("*").alias("n_slots"), F.max("new").alias("new"))
    lines = lines.select(F.struct(*ids).alias("id"), "consistent", "n_slots", "new")
    good = met.withColumn("id", F.struct(*ids)).join(lines, "id", "left").filter(F.coalesce("consistent", F.lit(True)))
    words = good.select("key", "t", "item", "n_slots", "new", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("w") - 1)).alias("word"))
    words = words.groupBy("key", "t", "item", "word").agg(F.max("n_slots").alias("n_slots"), F.max("new").alias("new"))
    held = words.groupBy("key", "t", "item").agg(F.count("*").alias("covered_words"), F.coalesce(F.max("n_slots"), F.lit(0)).cast("long").alias("n_slots"), F.coalesce(F.max("new"), F.lit(0)).alias("new"))
    held = held.join(own.select("item", "item_key", F.size("toks").alias("item_words")), "item").filter(F.col("covered_words") >= share * F.col("item_words"))
    return held.select("key", "t", "item_key", "covered_words", "item_words", (F.col("covered_words") / F.col("item_words")).alias("coverage"), "n_slots", "new")


def _brief(docs: DataFrame, own: DataFrame) -> DataFrame:
    """Items of few tokens that stand as a sentence, a line, behind a label or list mark, at the end of a question or as the whole of a text, with their own values."""
    own = own.select("item_key", "asks", _whole(F.col("toks")).alias("h"), F.size("toks").alias("item_words"), F.size(F.filter("toks", lambda t: t < WORDS_FROM)).cast("long").alias("n_slots"))
    pieces = docs.select("key", "t", F.explode(F.array_union(F.split("text", SENTENCES), F.array("text"))).alias("piece"))
    pieces = pieces.select("key", "t", F.regexp_replace("piece", LIST_MARK, "").alias("piece"))
    pieces = pieces.select("key", "t", F.col("piece").rlike(QUESTION).alias("question"), _once(tokens(F.col("piece")), "toks"))
    n = F.size("toks")
    alone = F.when(n.between(1, LEAST - 1), F.struct(_whole(F.col("toks")).alias("h"), F.lit(False).alias("tail")))
    tails = [F.when(F.col("question") & (n > k), F.struct(_whole(F.slice("toks", n - k + 1, F.lit(k))).alias("h"), F.lit(True).alias("tail"))) for k in range(LEAST_QUESTION, LEAST)]
    found = pieces.select("key", "t", F.explode(F.array_compact(F.array(alone, *tails))).alias("x")).select("key", "t", "x.*").distinct()
    held = found.join(own, "h").filter(F.col("asks") | ~F.col("tail"))
    held = held.select("key", "t", "item_key", F.col("item_words").cast("long").alias("covered_words"), "item_words", F.lit(1.0).alias("coverage"), "n_slots", F.lit(0).alias("new"))
    return held.distinct()


def matches(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", share: float = SHARE, window: int = WINDOW, stride: int = STRIDE) -> DataFrame:
    """(key, item_key, covered_words, item_words, coverage, n_slots, reworded) of every document and item it holds."""
    held = _held(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), items.select(F.col(item_key).alias("item_key"), F.col(item_text).alias("text")), share, window, stride)
    fields = ["coverage", "n_slots", "covered_words", "item_words", "new"]
    best = held.groupBy("key", "item_key").agg(F.max(F.struct(*fields)).alias("b")).select("key", "item_key", "b.*")
    return best.select(F.col("key").alias(key), F.col("item_key").alias(item_key), "covered_words", "item_words", "coverage", "n_slots", (F.col("new") > 0).alias("reworded"))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs without the texts that hold an item."""
    held = _held(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), items.select(F.col("item_id").alias("item_key"), F.col("text")), SHARE, WINDOW, STRIDE)
    k, t = unused(docs, "held_key"), unused(docs, "held_text")
    bad = written(held.select(F.col("key").alias(k), F.col("t").alias(t)).distinct(), "contaminated")
    same = docs[key].eqNullSafe(bad[k]) & (F.xxhash64(docs[text]) == bad[t])
    return docs.join(bad, same, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
