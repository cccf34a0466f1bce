"""Detectors against the findings they must and must not make."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from paperlane.functions import detectors as d
from paperlane.functions import text as tx
from paperlane.operators import detect
from paperlane.plans import rules as R
from paperlane.plans.settings import Settings
from paperlane.sources import extract, files

RULES = R.RuleList()


def counts(spark, texts, rules=RULES):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = detect.counted(df, rules).orderBy("i").collect()
    return [{r.key: row[f"c_{r.key}"] for r in rules.rules} for row in rows]


def test_mixed_text(spark):
    (c,) = counts(spark, ["Dr. Jane Roe, SSN 123-45-6789, mail A@x.org a@x.org, card 4111 1111 1111 1111, call (555) 123-4567, 12 Oak Street."])
    assert {k: c[k] for k in ("SSN", "EMAIL", "CARD", "PHONE")} == {"SSN": 1, "EMAIL": 1, "CARD": 1, "PHONE": 1}
    assert c["NAME"] >= 1 and c["ADDRESS"] >= 1


CASES = [
    ("CARD", "4111111111111111", 1), ("CARD", "1234 5678 9012 3456", 0), ("CARD", "12345678", 0), ("CARD", "order 8888880000000000", 0),
    ("SSN", "12-3456789", 0), ("SSN", "123456789", 0), ("SSN", "SSN on file. 123456789", 1), ("SSN", "000-12-3456 666-12-3456 900-12-3456 123-00-4567 123-45-0000", 0), ("SSN", "123 45 6789 and 123-45-6789", 1),
    ("NAME", "Mr. Smith and Name: Anna Lee; Dear Bob Jones,", 3), ("NAME", "Acme Widgets", 0), ("NAME", "PATIENT: Ann", 1), ("NAME", "patient: ann", 0),
    ("ADDRESS", "12 Oak Street", 1), ("ADDRESS", "Springfield, IL 62704", 1), ("ADDRESS", "62704", 0),
    ("MONEY", "$1,234.56", 1), ("MONEY", "USD 1,000", 1), ("MONEY", "12,345.00", 1), ("MONEY", "500.00 dollars", 1), ("MONEY", "1234 5678", 0), ("MONEY", "108.51.216.133 and 108.51.216.133", 1), ("MONEY", "5.10 5.10 $7 $7", 2),
    ("PASSPORT", "passport required", 0), ("PASSPORT", "Passport No: X1234567", 1), ("PASSPORT", "passport A1234567 passport a1234567", 1),
    ("DOB", "date of birth: 1/2/1980", 1), ("DOB", "Date of birth ______", 0), ("DOB", "born on Jan 3, 1999", 1), ("BANK_ACCOUNT", "account number 12345678", 1),
    ("TIN", "tax id 12-3456789", 1), ("NATIONAL_ID", "national insurance no. AB123456C", 1), ("DRIVER_LICENSE", "Driver's license # D1234567", 1),
    ("CREDENTIALS", "your PASSWORD is", 1), ("CREDENTIALS", "passwords", 0), ("HEALTH", "diagnosed", 1), ("MILITARY_ID", "dod id", 1), ("WORK", "salary", 1), ("CARD_REF", "pay by credit card", 1),
]


def test_rules(spark):
    got = counts(spark, [text for _, text, _ in CASES])
    assert [(k, t, c[k]) for (k, t, _), c in zip(CASES, got)] == CASES


def test_null_and_empty(spark):
    for c in counts(spark, [None, "", " "]):
        assert not any(c.values())


def test_against_python_re(spark):
    """Each plain pattern finds in Spark what Python's re finds."""
    texts = ["a@b.co x +1 555.123.4567 (555)123-4567 12345551234567", "4111-1111-1111-1111 5500 0000 0000 0004", "é mail: ü.x@y.de, 555-123-4567", "$5 USD 7 1,000 2.50 9 euros"]
    got = counts(spark, texts)
    for t, c in zip(texts, got):
        for key in ("EMAIL", "PHONE"):
            rule = next(r for r in RULES.rules if r.key == key)
            assert c[key] == len({v.lower() for v in re.findall(rule.patterns[0], t)})
        assert c["MONEY"] == len({m.group().strip() for m in re.finditer(d.MONEY, t)})


def test_labeled_windows_overlap(spark):
    def expected(text, near, value, window, least):
        hits = set()
        for m in re.finditer(near, text, re.I):
            for v in re.findall(value, text[m.end() : m.end() + window], re.I):
                if sum(ch.isdigit() for ch in v) >= least:
                    hits.add(v.strip().lower())
                    break
        return len(hits)

    rule = next(r for r in RULES.rules if r.key == "PASSPORT")
    texts = ["passport passport X12345 passport", "passport no. abc-def 99999 passport number 4444", "passport" * 20 + "A77777", "Passport\nNo\t12345", "😀 passport 😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀 12345"]
    for t, c in zip(texts, counts(spark, texts)):
        assert c["PASSPORT"] == expected(t, rule.label_pattern, rule.value_pattern, rule.window, rule.min_digits), t


def test_hints_change_nothing(spark):
    texts = ["Passport no 123456 dob 1/1/2000 tin 123456789 DIAGNOSIS a-number pin code iris scan", "MOTHER'S MAIDEN NAME, workers comp, exp. date, mastercard, nino AB123456C", "DL # A123456"]
    bare = R.RuleList(rules=tuple(R.Rule(**{**r.__dict__, "hints": (), "openings": ()}) for r in RULES.rules))
    texts += [o.join(around) for r in RULES.rules for o in d.openings_of(r) for around in (("", ""), ("x", "x"), ("\u00e9", " number"), ("_", "."), ("\n", "s"), ("(", ":"))]
    texts += ["RACEETHNICITY", "race/ethnicity", "mx. Ann Lee", "MX. Ann Lee", "Mx Ann Lee", "dear Ann", "Dear Ann", "Name: Ann", "full name - Ann", "xname: Ann", "master card number ending"]
    got = counts(spark, texts)
    assert got == counts(spark, texts, bare)
    # names have no hints to take away: they are held against the cues themselves
    assert [c["NAME"] for c in got] == [len({v.strip().lower() for p in d.NAME_CUES for v in re.findall(p, t)}) for t in texts]


def test_openings(spark):
    """All openings at beginnings of words, overlapping ones and those within longer ones, too; rules as data may have their own."""
    rules = R.from_dict({"entities": [{"key": k, "method": "keyword", "patterns": [rf"\b{o}"], "openings": [o]} for k, o in (("A", "card"), ("B", "card number"), ("C", "number"), ("D", "\u00e9tat"), ("E", "n"))]})
    got = counts(spark, ["the card number", "discard numbers", "CARD", "card numb", "", None, "l'état, c'est", "xétat"], rules)
    assert [[k for k, v in c.items() if v] for c in got] == [list("ABCE"), list("CE"), ["A"], ["A", "E"], [], [], ["D"], []]


# Findings that begin or end beside an accented letter; words are ASCII, as in the SQL, on Java 17 and on later ones.
BESIDE = [
    ("ADDRESS", "+1 (467) 555-3280 zuch st\u00f6be", 1), ("ADDRESS", "214 geieein. St\u00e4\u00e4 zu", 1), ("ADDRESS", "\u00fc12 Oak Street", 1), ("ADDRESS", "12 Oak Streets", 0), ("ADDRESS", "\u00e9Springfield, IL 62704\u00e9", 1), ("ADDRESS", "Springfield, IL 62704x", 0),
    ("EMAIL", "a@b.org\u00e4 a@b.orgx9", 1), ("EMAIL", "\u00fca@b.org a@b.org", 1), ("SSN", "\u00df123-45-6789\u00e9", 1), ("SSN", "ssn\u00e9 \u00e9123456789", 1), ("CARD", "\u00e94111111111111111\u00e9", 1), ("CARD", "x4111111111111111", 0),
    ("MONEY", "\u00e91.50\u00e9 1.50", 1), ("MONEY", "\u00e9USD 7 and 9 euros\u00e9", 2), ("MONEY", "x1.50 1.50x", 0), ("NAME", "\u00e9Mr. Smith, \u00e9name: Anna", 2), ("CREDENTIALS", "\u00e9password\u00e9", 1), ("CREDENTIALS", "passwordx", 0), ("TIN", "\u00e9tin\u00e9 12-3456789", 1),
]


def test_words_are_ascii(spark):
    import duckdb

    from paperlane import catalogue_sql as S

    got = counts(spark, [text for _, text, _ in BESIDE])
    assert [(k, t, c[k]) for (k, t, _), c in zip(BESIDE, got)] == BESIDE
    for r in RULES.rules:
        rows = duckdb.sql(f"SELECT i, {S.count(r)} FROM (SELECT unnest($1) AS i, unnest($2) AS t) ORDER BY i", params=[list(range(len(BESIDE))), [t for _, t, _ in BESIDE]]).fetchall()
        assert [n for _, n in rows] == [c[r.key] for c in got], r.key
    person, _ = files._person_tests(Settings())
    rows = [t for k, t, _ in BESIDE if k in ("EMAIL", "SSN", "CARD")]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string").orderBy("i")
    assert [person(t) for t in rows] == [r[0] for r in df.select(d.row_has_identifier(F.col("t"), RULES)).collect()]


def test_value_signal(spark):
    texts = ["mail a@b.org", "SSN: 123-45-6789", "we accept credit cards", "Mr. Smith", "nothing", "Patient: Jane Doe -- diagnosis", "Mr. Smith paid $5.00", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r[0] for r in detect.detected(df, RULES).orderBy("i").select("value_signal").collect()]
    assert got == [True, True, False, False, False, True, True, False]


def test_capture_groups():
    assert d.groups_of("ab") == 0 and d.groups_of("(a)b") == 1
    with pytest.raises(ValueError, match="one capturing group"):
        d.groups_of("(a)(b)")


def test_row_tests(spark):
    rows = ["Smith, John 12", "Total, 1,234", "Smith, John7", "Doe, Jane A. B", "123-45-6789", "x@y.org", None, "  Lee, Ann", "lee, ann"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string")
    got = df.orderBy("i").select(d.row_has_identifier(F.col("t"), RULES), d.is_roster_line(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(False, True), (False, False), (False, False), (False, True), (True, False), (True, False), (False, False), (False, True), (False, False)]


def test_text_functions(spark):
    df = spark.createDataFrame([("a/b/Report.DOCX", "Q00897.01-0000000003", "x.pdf", "<p>a<script>var b='<p>'</script>c</p>", "7.0", "junk")], "p string, q string, r string, h string, n string, j string")
    row = df.select(tx.extension(F.col("p")), tx.base_name(F.col("p")), tx.norm_id(F.col("p")), tx.norm_id(F.col("q")), tx.norm_id(F.col("r")), tx.strip_html(F.col("h")), tx.to_int(F.col("n")), tx.to_int(F.col("j")), tx.type_of(F.lit(".docx")), tx.type_of(F.lit(".zzz"))).first()
    assert list(row) == [".docx", "Report.DOCX", "report", "q00897.01-0000000003", "x", " a c ", 7, 0, "MS Word", "Other"]


def test_sample_for_model(spark):
    text = "".join(chr(97 + i % 26) for i in range(1000))
    got = spark.range(1).select(tx.sample_for_model(F.lit(text), 100)).first()[0]
    assert got.startswith(text[:50]) and got.endswith(text[-25:]) and text[487:512] in got
    assert spark.range(1).select(tx.sample_for_model(F.lit("short"), 100)).first()[0] == "short"


def test_rule_lists(tmp_path):
    older = R.from_dict({"patterns": {"EMAIL": "[a-z]+@x"}, "keywords": {"K": "word"}, "per_person_types": ["EMAIL"]})
    assert [(r.key, r.method, r.casefold, r.weak, r.per_person) for r in older.rules] == [("EMAIL", "regex", True, False, True), ("K", "keyword", False, True, False)]
    (tmp_path / "r.yaml").write_text("version: '9'\nbde_threshold: 7\nentities:\n- {key: A, method: keyword, patterns: [x]}\n")
    got = R.load(str(tmp_path / "r.yaml"))
    assert (got.version, got.bde_threshold, [r.key for r in got.rules]) == ("9", 7, ["A"])
    assert R.load().fingerprint() == R.RuleList().fingerprint() != got.fingerprint()
    assert R.RuleList().per_person == ["NAME", "EMAIL", "PHONE", "SSN", "CARD"]
    assert len(R.RuleList().rules) == 27 and R.RuleList().value_keys == ["ADDRESS", "EMAIL", "PHONE", "SSN", "PASSPORT", "DRIVER_LICENSE", "TIN", "NATIONAL_ID", "DOB", "CARD", "BANK_ACCOUNT"]


def fuzzed(alphabets, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_patterns_entered_once_find_the_same(spark):
    """The forms for the JVM against the plain patterns in Python, on texts that are put together to break them."""
    amounts = fuzzed([list("1250"), list("12,.,. "), ["1,234", ",000", "123", ",", ".", ".50", "1.50,000 USD"], ["$", "USD", " EUR", "usd ", "dollars", "x", "é", "_", " ", "pound"]], 6000, 1)
    mails = fuzzed([list("ab1@.-_%+ "), ["a@b.com", ".co", "@", "x.y", "é", ".-", "@a.b", "a.a.a."], list("@@..a")], 6000, 2)
    df = spark.createDataFrame(list(zip(amounts, mails)), "a string, m string").repartition(4)
    rows = df.select("a", "m", F.regexp_extract_all("a", F.lit(d.MONEY_ONCE), F.lit(2)).alias("x"), F.regexp_extract_all("m", F.lit(d.EMAIL_ONCE), F.lit(1)).alias("y"), F.col("m").rlike(d.EMAIL_ONCE).alias("any")).collect()
    money, mail = re.compile(d.MONEY), re.compile(d.EMAIL)
    first = re.compile(d.EMAIL_ONCE.replace(r"|\G", ""))
    hits = 0
    for r in rows:
        wanted = [m[0] for m in money.finditer(r["a"])]
        assert r["x"] == wanted, r["a"]
        wanted = [m[0] for m in mail.finditer(r["m"])]
        assert r["y"] == wanted and r["any"] == bool(wanted) == bool(first.search(r["m"])), r["m"]
        hits += len(r["x"]) > 1 and len(r["y"]) > 1
    assert hits > 20 and {r.method for r in R.RuleList().rules if set(r.patterns) & set(d.ONCE)} == {"regex"}


# Labels, values, and what a matcher may take for a letter, a space or the end of a word.
PIECES = ["dob ", "born on ", "passport ", "dl # ", "tin ", "tax id ", "nino ", "account no ", "iban ", "sort code", "ssn ", "\u017fsn ", "1/2/1990 ", "12-3456789 ", "X1234567 ", "123456789 ", "123-45-6789 ", "GB12ABCDEF1234567 ", "555-123-4567", "(555)123-4567 ", "4111 1111 1111 1111 ",
          "\x0b", "\x0c", "\x1c", "\x85", "\u00a0", "\t", "\r\n", " ", "\u017f", "\u212a", "\u0130", "\u0131", "\u2019", "\u00e9", "_", ".", "aaaaaaaaaaaa ", "Mr. ", "Dear ", "cu\u017ftomer: ", "Anna ", "12 ", "Oak ", "Street ", "st", "Springfield, IL 62704", "a@b.org ", "$5 ", "9 euro\u017f", "password ", "pin: ", "ma\u017ftercard ", "\u017falary", "wor\u212aers comp", "1", "9"]


def test_reading_of_re2(spark):
    """Every rule against the SQL on texts that are put together to tell the matchers apart; without that reading some differ."""
    import duckdb

    from paperlane import catalogue_sql as S

    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    got, plain = counts(spark, texts, R.RuleList(as_re2=True)), counts(spark, texts)
    for r in RULES.rules:
        rows = duckdb.sql(f"SELECT i, {S.count(r)} FROM (SELECT unnest($1) AS i, unnest($2) AS t) ORDER BY i", params=[list(range(len(texts))), texts]).fetchall()
        assert [(t, n) for t, (_, n) in zip(texts, rows)] == [(t, c[r.key]) for t, c in zip(texts, got)], r.key
    assert {k for c, o in zip(got, plain) for k in c if c[k] != o[k]} >= {"PHONE", "PASSPORT", "NAME"}


def plain_html(t):
    return re.sub("<[^>]+>", " ", re.sub(r"(?is)<(script|style)\b.*?</\1>", " ", t))


def test_markup_is_taken_away_as_before(spark):
    pieces = ["<script", "<STYLE>", "</script>", "</style>", "</Script>", "<script>", "<p>", "<", ">", "x", " y ", "<b", "scripts", "<style a='>'>", "\n", "<>", "é"]
    texts = ["".join(p) for p in ([random.Random(i).choice(pieces) for i in range(k, k + random.Random(k).randint(0, 12))] for k in range(0, 60_000, 15))]
    got = {r["t"]: r["s"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.strip_html(F.col("t")).alias("s")).collect()}
    for t in set(texts):
        assert got[t] == plain_html(t) == extract.strip_tags(t), t
        assert extract._without_tags(t) == re.sub("<[^>]+>", " ", t)


LONG = {"numbers": "1," * 500_000, "numbers and a word": "1," * 500_000 + " pounds", "grouped": "123,456,7," * 100_000, "decimals": "1.50," * 200_000, "dotted": "a." * 500_000 + "@", "addresses": "a.b@c.de," * 110_000,
        "open": "<" * 1_000_000, "scripts": "<script " * 125_000, "styles": "<style></script>" * 60_000, "closed late": "<script " * 100_000 + "</style>" + "<style " * 20_000}


def test_long_texts_in_linear_time(spark):
    """1 MB each, in seconds, in the JVM and in the parsers."""
    for name, text in LONG.items():
        df = spark.createDataFrame([(text,)], "t string").cache()
        df.count()
        start = time.time()
        df.select(d.count_money(F.col("t")), d.count_regex(F.col("t"), next(r for r in R.RuleList().rules if r.key == "EMAIL")), F.length(tx.strip_html(F.col("t")))).collect()
        assert time.time() - start < 15, name
        start = time.time()
        extract.strip_tags(text), extract._without_tags(text)
        person, roster = files._person_tests(Settings())
        person(text), roster(text)
        assert time.time() - start < 15, name
