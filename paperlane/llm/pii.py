"""Personal data: fixed patterns as seeds, then contexts learned from them.

The fixed patterns' findings are seeds. What stands before a seed (a word with a label's mark, the two words, the label at the start
of its line) gives its lexical patterns, and so does what stands before any other token with digits or an @ sign, an unseen
instance. Patterns and instances form a
graph, which Spark scores in a few rounds: a pattern is worth the mean score of its distinct instances, damped while
they are few; an instance is worth its best pattern, seeds 1. Patterns that reach ``confidence`` with ``seeds`` or
more distinct seeds are accepted: their unseen instances are findings of the kind ``context`` and seeds of the next
turn, until no pattern is newly accepted. Within a turn the rounds stay few on purpose: their fixed point is s / (s + 1)
for s seeds, however many unseen instances a pattern has.

Defined results: a null text is empty; a text without findings has empty spans; repeated rows are scanned each and
count as one instance in the graph; an empty table gives an empty table; other columns are ignored. Instances are
kept as hashes: no value leaves the operator, only places.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Covered, per_text, written

# Patterns of the base findings and their kinds in order.
EMAIL_DOMAIN = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
EMAIL_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "context")

CONFIDENCE = 0.8
SEEDS = 5  # distinct seeds a pattern needs
DAMPING = 1.0
ROUNDS = 3

_DOMAIN, _CARD, _PHONE = re.compile(EMAIL_DOMAIN), re.compile(CARD), re.compile(PHONE)
_IP = re.compile("(?<![0-9])" + IP)  # a match can only begin where a run of digits does
_DIGIT_RUN = re.compile(r"[0-9]{4}")
LABEL_MARKS = (":", "=", "#")  # what ends a word that announces a value
MOST_CONTEXT = 256  # characters before a place that are read for its context
LEAST_INSTANCE = 5  # characters of an unseen instance; shorter tokens with digits are mostly counts, years and times
_INSTANCE = re.compile(rf"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]*[0-9@])[^\x20\x09-\x0D]{{{LEAST_INSTANCE},}}")
_DIGITS = re.compile("[0-9]+")
_NON_DIGITS = re.compile("[^0-9]")
_LOCAL = frozenset(EMAIL_LOCAL)
EDGES = ".,;:!?()[]{}<>\"'"

Span = tuple[str, int, int]


def _emails(text: str) -> list[Span]:
    """Leftmost matches without rescanning: each holds one @, and begins as far left of it as the local part goes."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > free and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            found.append(("email", a, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return found


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _ip_ok(value: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in value.split("."))


def base_spans(text: str | None) -> list[Span]:
    """The findings of the fixed patterns by kind, then start."""
    if not text:
        return []
    found = _emails(text) if "@" in text else []
    if "." in text:
        found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _ip_ok(m[0])]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NON_DIGITS.sub("", m[0])) <= 15]
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _contexts(text: str, start: int) -> list[str]:
    """What stands before a place, A-Z in lower case, edge marks off except a colon or equals sign, digits as 0.

    The last word if it is a label, the last two words, and the label at the start of a line of three words or fewer, marked by a line
    break. A common word alone stands before seeds by chance, so without a label's mark it is no pattern of its own. Nothing
    further back than MOST_CONTEXT characters counts, so a long word costs no more at each place that follows it.
    """
    size = 64
    while True:  # as far back as a label and the break before it need
        low = max(0, start - min(size, MOST_CONTEXT))
        left = text[low:start].rstrip("([{<\"'")  # what opens around the place is no word of its own
        words = left.split()
        if len(words) >= 5 or low == 0 or size >= MOST_CONTEXT:
            break
        size *= 4
    line = re.split("[\n\r]", left)[-1].split()
    words, line = ([_DIGITS.sub("0", w.lower().strip(".,;!?()[]{}<>\"'")) for w in x] for x in (words[-2:], line))
    own = words[-1:] if words and words[-1].endswith(LABEL_MARKS) else []
    out = [own, words if len(words) == 2 else [], ["\n", *line] if 1 <= len(line) <= 3 else []]
    return [" ".join(x) for x in out if x and all(x)]


def mentions(text: str | None, base: list[Span]) -> list[dict]:
    """Seeds and unseen instances with their pattern, both hashed, and place."""
    out = []
    if not text:
        return out

    def add(start: int, end: int, seed: bool) -> None:
        for pattern in _contexts(text, start):
            p, i = (xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for x in (pattern, text[start:end]))
            out.append({"pattern": p, "instance": i, "start": start, "end": end, "seed": seed})

    covered = Covered(base)
    for _, a, b in base:
        add(a, b, True)
    for m in _INSTANCE.finditer(text):
        token = m[0].strip(EDGES)
        a = m.start() + len(m[0]) - len(m[0].lstrip(EDGES))
        b = a + len(token)
        if len(token) >= LEAST_INSTANCE and any(c.isdigit() or c == "@" for c in token) and not covered.touches(a, b):
            add(a, b, False)
    return out


def scan(text: Column) -> Column:
    """Struct (n_email, n_ip, n_card, n_phone, base_sha256, base, found) of each whole text."""
    mention = pa.list_(pa.struct([("pattern", pa.int64()), ("instance", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_())]))

    def one(t: str | None) -> tuple:
        base = base_spans(t)
        n = [sum(k == kind for k, _, _ in base) for kind in KINDS[:4]]
        text = joined(base)
        return *n, hashlib.sha256(text.encode()).hexdigest(), text, mentions(t, base)

    fields = [(f"n_{k}", pa.int64()) for k in KINDS[:4]] + [("base_sha256", pa.string()), ("base", pa.string()), ("found", mention)]
    schema = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, found array<struct<pattern:bigint,instance:bigint,start:bigint,end:bigint,seed:boolean>>"
    return per_text(lambda: one, schema, fields)(text)


def scored(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """From distinct (pattern, instance, seed): pattern, score, n_seeds. Each round joins scores along the edges and sums map-side."""
    instances = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("worth"))
    patterns = None
    for _ in range(rounds):
        rated = edges.select("pattern", "instance", "seed").join(instances, "instance")
        patterns = rated.groupBy("pattern").agg((F.sum("worth") / (F.count("*") + DAMPING)).alias("score"), F.sum(F.col("seed").cast("long")).alias("n_seeds"))
        patterns = written(patterns, "pii-patterns")
        best = edges.select("pattern", "instance", "seed").join(patterns.select("pattern", "score"), "pattern")
        instances = written(best.groupBy("instance").agg(F.greatest(F.max("score"), F.max(F.col("seed").cast("double"))).alias("worth")), "pii-instances")
    return patterns


def accepted(edges: DataFrame, confidence: float = CONFIDENCE, seeds: int = SEEDS, rounds: int = ROUNDS) -> DataFrame:
    """From distinct (pattern, instance, seed): the accepted patterns, each turn with the instances of the last one's as seeds."""
    known = 0
    while True:
        good = written(scored(edges, rounds).filter((F.col("score") >= confidence) & (F.col("n_seeds") >= seeds)).select("pattern"), "pii-good")
        n = good.count()
        if n <= known:  # scores and seeds only rise, so no accepted pattern is lost
            return good
        known = n
        found = written(edges.join(good, "pattern").select("instance", F.lit(True).alias("found")).distinct(), "pii-found")
        edges = edges.join(found, "instance", "left").select("pattern", "instance", (F.col("seed") | F.coalesce("found", F.lit(False))).alias("seed"))
        edges = written(edges, "pii-graph")


def scanned(docs: DataFrame, text: str = "text", key: str = "doc_id", confidence: float = CONFIDENCE, seeds: int = SEEDS, rounds: int = ROUNDS) -> DataFrame:
    """key, the counts, base_sha256, n_context, spans and has_pii (whether there are any) of every document."""
    rows = docs.select(F.col(key), F.monotonically_increasing_id().alias("row"), scan(F.col(text)).alias("s")).select(key, "row", "s.*")
    rows = written(rows, "pii-rows")
    places = rows.select("row", F.inline("found"))
    edges = written(places.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-edges")
    # A pattern of one instance lends it no more than it has already; all others stay in the graph.
    useful = written(edges.groupBy("pattern").agg(F.count("*").alias("n")).filter("n > 1").select("pattern"), "pii-useful")
    good = accepted(written(edges.join(useful, "pattern"), "pii-graph"), confidence, seeds, rounds)
    new = places.filter("not seed").join(good, "pattern").groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("new"))
    new = written(new, "pii-new").withColumnRenamed("row", "r")
    rows = rows.drop("found").join(new, F.col("row") == F.col("r"), "left")
    added = F.transform("new", lambda s: F.concat_ws(":", F.lit("context"), s["start"], s["end"]))
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.array_join(added, ","))
    spans = F.when(F.col("new").isNull(), F.col("base")).otherwise(spans)
    n_context = F.when(F.col("new").isNull(), 0).otherwise(F.size("new")).cast("long")
    return rows.select(key, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", n_context.alias("n_context"), spans.alias("spans"), (spans != "").alias("has_pii"))
