"""Secret scans: fixed patterns first, then formats learned by grammar inference.

For each labelled credential format a prefix tree over character classes is built, and its states are merged where
their continuations agree statistically (Hoeffding bounds, red-blue order), which gives a probabilistic automaton.
Any long token that the patterns left over is scored by the best format's likelihood against that of an automaton
learned the same way from ordinary tokens; it is a finding if the format explains it much better.

The labelled strings are a parameter of bounded length. By default they are made from a seed after public
credential formats, and ordinary ones after names, paths, numbers and versions; no row of the corpus is used.

Defined results: a null text is empty and has no spans; spans never cross texts; repeated rows are scanned each;
empty tables give empty tables; other columns are ignored. No matched value leaves the operator, only places.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Covered, per_text

# Patterns of the base findings, their kinds in order, and the least lengths of what they find.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "format")
LEAST = {"assign": 12, "access": 18, "hex": 16}
CUES = ("passw", "secret", "token", "api")

CANDIDATE = r"[A-Za-z0-9+/_=.-]+"
LEAST_CANDIDATE = 16  # characters; shorter tokens are too few symbols to tell a format from a word with digits
MARGIN = 0.6  # nats a character by which a format must beat ordinary tokens
ALPHA = 0.05  # of the Hoeffding bounds

_ASSIGN, _ACCESS, _HEX, _CANDIDATE = re.compile(ASSIGN, re.I | re.A), re.compile(ACCESS), re.compile(HEX[:-1] + "{16,}"), re.compile(f"{CANDIDATE[:-1]}{{{LEAST_CANDIDATE},}}")

Span = tuple[str, int, int]


def base_spans(text: str | None) -> list[Span]:
    """The findings of the fixed patterns by start, then kind."""
    if not text:
        return []
    found = []
    lower = text.lower()
    if any(c in lower for c in CUES):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # a run of hex digits is matched as a whole, so asking for 16 or more is the same as dropping shorter ones
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_CLASSES = {**{c: "0" for c in "0123456789"}, **{c: "a" for c in "abcdef"}, **{c: "z" for c in "ghijklmnopqrstuvwxyz"}, **{chr(c): "A" for c in range(65, 91)}}


def classes(token: str) -> str:
    """Digits, a-f, g-z and A-Z by class, other characters as they are."""
    return "".join(_CLASSES.get(c, c) for c in token)


class Automaton:
    """A probabilistic automaton: counts of each state's transitions and endings."""

    def __init__(self, samples: list[str], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.end, self.seen = [0], [0]
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        for s in samples:
            self._add(classes(s))
        self._merge_all()

    def _add(self, s: str) -> None:
        q = 0
        self.seen[0] += 1
        for c in s:
            self.count[q][c] = self.count[q].get(c, 0) + 1
            if c not in self.next[q]:
                self.next[q][c] = len(self.next)
                self.next.append({})
                self.count.append({})
                self.end.append(0)
                self.seen.append(0)
            q = self.next[q][c]
            self.seen[q] += 1
        self.end[q] += 1

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _alike(self, a: int, b: int) -> bool:
        work = [(a, b)]
        while work:
            p, q = work.pop()
            if self._differ(self.end[p], self.seen[p], self.end[q], self.seen[q]):
                return False
            for c in self.count[p].keys() | self.count[q].keys():
                if self._differ(self.count[p].get(c, 0), self.seen[p], self.count[q].get(c, 0), self.seen[q]):
                    return False
                if c in self.next[p] and c in self.next[q]:
                    work.append((self.next[p][c], self.next[q][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree under b to the state a."""
        work = [(a, b)]
        while work:
            p, q = work.pop()
            self.end[p] += self.end[q]
            self.seen[p] += self.seen[q]
            for c, n in self.count[q].items():
                self.count[p][c] = self.count[p].get(c, 0) + n
                if c in self.next[p]:
                    work.append((self.next[p][c], self.next[q][c]))
                else:
                    self.next[p][c] = self.next[q][c]

    def _merge_all(self) -> None:
        red = [0]
        while True:
            blue = [(p, c) for p in red for c, q in sorted(self.next[p].items()) if q not in red]
            if not blue:
                break
            p, c = max(blue, key=lambda x: self.seen[self.next[x[0]][x[1]]])
            q = self.next[p][c]
            for r in red:
                if self._alike(r, q):
                    self.next[p][c] = r
                    self._fold(r, q)
                    break
            else:
                red.append(q)
        self.logs = [{c: math.log((n + 0.1) / (self.seen[q] + 5)) for c, n in self.count[q].items()} for q in range(len(self.next))]
        self.ends = [math.log((self.end[q] + 0.1) / (self.seen[q] + 5)) for q in range(len(self.next))]
        self.rare = [math.log(0.1 / (self.seen[q] + 5)) for q in range(len(self.next))]
        self.states = red

    def score(self, symbols: str) -> float:
        """Log-likelihood; a step that was never seen costs its smoothed share and goes back to the start."""
        q, total = 0, 0.0
        for c in symbols:
            got = self.logs[q].get(c)
            total += self.rare[q] if got is None else got
            q = self.next[q].get(c, 0)
        return total + self.ends[q]


def labelled_credentials(seed: int = 11, each: int = 120) -> dict[str, list[str]]:
    """Strings after public credential formats, made from the seed."""
    rng = random.Random(seed)
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    base62, url64 = digits + lower + upper, digits + lower + upper + "-_"

    def some(chars: str, n: int) -> str:
        return "".join(rng.choices(chars, k=n))

    forms = {
        "prefixed": lambda: rng.choice(["ghp_", "gho_", "sk_live_", "pk_live_", "rk_test_", "npm_"]) + some(base62, rng.choice([24, 32, 36])),
        "dashed": lambda: rng.choice(["xoxb-", "xoxp-", "sk-", "glpat-"]) + some(base62, rng.choice([20, 32, 48])),
        "signed": lambda: ".".join(["eyJ" + some(url64, 20), "eyJ" + some(url64, rng.randint(30, 60)), some(url64, 43)]),
        "base64": lambda: some(base62 + "+/", rng.choice([40, 43, 64])) + rng.choice(["", "=", "=="]),
        "alphanumeric": lambda: some(base62, rng.choice([24, 32, 40])),
        "upper": lambda: some(upper + digits, rng.choice([20, 24, 32])),
    }
    return {name: [make() for _ in range(each)] for name, make in forms.items()}


def ordinary_tokens(seed: int = 12, each: int = 120) -> list[str]:
    """Strings after names, paths, hosts, versions, numbers, UUIDs and other ids, and joined words, made from the seed."""
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choice(["th", "re", "an", "in", "on", "er", "st", "ou", "ti", "le", "ment", "ion", "ung", "sch", "de", "ra"]) for _ in range(rng.randint(1, 5)))

    def number() -> str:
        return str(rng.randint(0, 10 ** rng.randint(1, 6)))

    def some(chars: str, n: int) -> str:
        return "".join(rng.choices(chars, k=n))

    hexes = "0123456789abcdef"

    forms = [
        lambda: "".join(word() for _ in range(6)),
        lambda: "".join(word().capitalize() for _ in range(5)),
        lambda: "_".join(word() for _ in range(rng.randint(3, 6))),
        lambda: "-".join([*(word() for _ in range(rng.randint(3, 6))), number()]),
        lambda: ".".join([word() + rng.choice(["", number()]), word(), rng.choice(["com", "org", "net"])]) + "/" + "/".join(rng.choice([word(), number()]) for _ in range(4)),
        lambda: "/" + "/".join(word() for _ in range(5)) + rng.choice([".py", ".html", ".tar.gz", ""]),
        lambda: f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}T{rng.randint(0, 23):02d}.{rng.randint(0, 59):02d}.{rng.randint(0, 59):02d}",
        lambda: "".join(rng.choices("0123456789", k=rng.randint(20, 40))),
        lambda: rng.choice("-=_./+") * rng.randint(20, 60),
        lambda: "_".join(word().upper() for _ in range(6)),
        lambda: "-".join(number() for _ in range(6)),
        lambda: "".join(word().upper() for _ in range(6)),
        lambda: "-".join(some(hexes, n) for n in (8, 4, 4, 4, 12)),  # UUIDs
        lambda: "-".join(some(hexes, n) for n in (8, 4, 4, 4, 12)).upper(),
        lambda: "-".join(some(hexes, 2) for _ in range(rng.choice([6, 8]))),  # hardware addresses
        lambda: word().upper() + "-" + str(rng.randint(2000, 2030)) + "-" + some("0123456789", rng.randint(4, 10)) + rng.choice(["", "-" + word().upper()]),  # record numbers
        lambda: "v" + ".".join(number() for _ in range(3)) + "-" + word() + "." + some(hexes, rng.randint(7, 12)),  # versions
    ]
    return [make() for make in forms for _ in range(each)]


class Model:
    """Automata of the formats and of ordinary tokens."""

    def __init__(self, labelled: dict[str, list[str]] | None = None, ordinary: list[str] | None = None):
        self.formats = {k: Automaton(v) for k, v in sorted((labelled or labelled_credentials()).items())}
        self.ordinary = Automaton(ordinary or ordinary_tokens())

    def margin(self, token: str) -> float:
        """Nats a character by which the best format beats ordinary tokens."""
        s = classes(token)
        return (max(a.score(s) for a in self.formats.values()) - self.ordinary.score(s)) / (len(s) + 1)

    def spans(self, text: str | None, base: list[Span], margin: float = MARGIN) -> list[Span]:
        """Candidates with digits and letters that no base span touches and that a format explains."""
        found, covered = [], Covered(base)
        for m in _CANDIDATE.finditer(text or ""):
            token = m[0].rstrip(".")
            kinds = set(classes(token))
            if "0" not in kinds or not kinds & {"a", "z", "A"}:
                continue
            a, b = m.start(), m.start() + len(token)
            if covered.touches(a, b):
                continue
            if len(token) >= LEAST_CANDIDATE and self.margin(token) > margin:
                found.append(("format", a, b))
        return found


@lru_cache(1)
def default_model() -> Model:
    return Model()


def scan(text: Column, model: Model | None = None) -> Column:
    """Struct (n_assign, n_access, n_hex, base_sha256, spans) of each whole text; spans as ``kind:start:end``, comma-joined."""
    own = model or default_model()

    def one(t: str | None) -> tuple:
        base = base_spans(t)
        n = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
        every = ordered(base + own.spans(t, base))
        return *n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)

    fields = [("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())]
    return per_text(lambda: one, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", fields)(text)


def scanned(docs: DataFrame, text: str = "text", key: str = "doc_id", model: Model | None = None) -> DataFrame:
    """key and the findings of every document."""
    return docs.select(F.col(key), scan(F.col(text), model).alias("s")).select(key, "s.*")
