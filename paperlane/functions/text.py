"""Text functions beside the detectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed values of this module: the patterns of markup, rich text and ids, and the marks of left-out text.


_HELD = "\uf8ff"  # stands behind the < of a block that nothing closes while the others are taken away


def _behind(text: Column, head: Column) -> Column:
    return F.substring(text, F.length(head) + 1, F.length(text))


def strip_html(html: Column, in_turn: bool = False) -> Column:
    """script and style blocks away, then every tag a blank. ``in_turn``: first all script blocks, then the style blocks of what is left, as in the SQL.

    Behind the last closing mark of its kind no block ends, and behind the last ``>`` no tag. The beginnings there are taken out of the
    search first, so each of the others finds its end and no part of a page is read twice.
    """
    bare = html
    for kind in ("script", "style"):
        word = rf"{kind}(?!\w)" if in_turn else rf"{kind}\b"
        head = F.regexp_extract(bare, rf"(?is)\A.*</{kind}>", 0)
        held = F.concat(head, F.regexp_replace(_behind(bare, head), rf"(?i)<(?={word})", f"<{_HELD}"))
        if in_turn:
            held = F.regexp_replace(held, rf"(?is)<{word}.*?</{kind}>", " ")
        bare = F.when(bare.rlike(rf"(?i)<{word}"), held).otherwise(bare)
    if not in_turn:
        bare = F.regexp_replace(bare, r"(?is)<(script|style)\b.*?</\1>", " ")
    head = F.regexp_extract(bare, r"(?s)\A.*>", 0)
    return F.concat(F.regexp_replace(head, "<[^>]+>", " "), F.regexp_replace(_behind(bare, head), f"<{_HELD}", "<"))


def strip_rtf(rtf: Column) -> Column:
    """Control words and braces of rich text away."""
    return F.regexp_replace(F.regexp_replace(rtf, r"\\[a-zA-Z]+-?\d* ?", " "), "[{}]", " ")


def sample_for_model(text: Column, limit: int) -> Column:
    """A text of at most about ``limit`` characters: half from the head, a quarter each from the middle and the tail."""
    half = limit // 2
    quarter = (limit - half) // 2
    tail = limit - half - quarter
    n = F.length(text)
    middle = F.substring(text, F.greatest(F.lit(half), F.floor((n - quarter) / 2).cast("int")) + 1, F.lit(quarter))
    cut = F.concat(F.substring(text, 1, half), F.lit("\n...[sampled from middle of file]...\n"), middle, F.lit("\n...[sampled from end of file]...\n"), F.substring(text, n - tail + 1, F.lit(tail)))
    return text if limit <= 0 else F.when(n <= limit, text).otherwise(cut)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """From the last dot of the base name on, in lower case; names that only begin with dots have none."""
    return F.lower(F.regexp_extract(base_name(path), r"^\.*[^.].*?(\.[^.]*)$", 1))


def norm_id(value: Column) -> Column:
    """Base name without an extension that holds a letter, trimmed, in lower case."""
    name = base_name(F.trim(value))
    return F.lower(F.trim(F.regexp_replace(name, r"\.(?=[A-Za-z0-9]{1,5}$)(?=[A-Za-z0-9]*[A-Za-z])[A-Za-z0-9]{1,5}$", "")))


def truthy(value: Column) -> Column:
    """The one reader of booleans that went through CSV."""
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def to_int(value: Column) -> Column:
    """Whole number of a text such as ``7`` or ``7.0``; anything else 0."""
    return F.coalesce(value.try_cast("double").try_cast("int"), F.lit(0))


def text_fingerprint(text: Column) -> Column:
    """sha256 of a text with every line break as a line feed, so files that differ only there are equal."""
    return F.sha2(F.regexp_replace(text, "\r\n?", "\n"), 256)


# What a printed scorecard shows in its pipeline section, and where the number stands.
_SHOWN = {
    "scored": r"(?m)^\s*scored\s+([\d,]+)",
    "excluded": r"excluded:\s*([\d,]+)",
    "recall": r"(?m)^\s*recall\s+([\d.]+)",
    "precision": r"(?m)^\s*precision\s+([\d.]+)",
    "accuracy": r"(?m)^\s*accuracy\s+([\d.]+)",
    "f1": r"\bF1\s+([\d.]+)",
    "nr_accuracy": r"(?m)^\s*NR accuracy\s+([\d.]+)",
    "r_accuracy": r"(?m)^\s*R accuracy\s+([\d.]+)",
    "flagged": r"(?m)^\s*flagged\s+([\d.]+)",
    "over_call": r"over-call\s+([\d.]+)",
    "under_call": r"under-call\s+([\d.]+)",
}
_COUNTS, _COUNT_NAMES = r"TP=([\d,]+)\s+FP=([\d,]+)\s+FN=([\d,]+)\s+TN=([\d,]+)", ("tp", "fp", "fn", "tn")


def score_summary(printed: Column) -> Column:
    """Map of the headline numbers in a printed scorecard's PIPELINE section; without one it is empty. The four counts are taken together or not at all."""
    block = F.regexp_extract(printed, r"(?s)(PIPELINE.*?)(?:NR/R --|$)", 1)
    places = [(k, p, 1) for k, p in _SHOWN.items()] + [(k, _COUNTS, n) for n, k in enumerate(_COUNT_NAMES, 1)]
    found = F.array(*(F.struct(F.lit(k).alias("k"), F.nullif(F.regexp_replace(F.regexp_extract(block, p, n), ",", ""), F.lit("")).alias("v")) for k, p, n in places))
    return F.map_from_entries(F.filter(found, lambda x: x["v"].isNotNull()))


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(a / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))


def round_even(x: Column, digits: int) -> Column:
    """x to so many digits, halves to the even one, by scaling as DuckDB's round_even does; Spark's bround rounds the decimal that x prints as instead."""
    scale = float(10**digits)
    return F.rint(x.cast("double") * scale) / scale


# File types by extension.
FILE_TYPES = {
    "PDF": (".pdf",),
    "Excel": (".xls", ".xlsx", ".xlsm", ".xlsb"),
    "Messages": (".msg", ".eml"),
    "MS Word": (".doc", ".docx"),
    "Text": (".txt", ".csv"),
    "MS PowerPoint": (".ppt", ".pptx"),
    "HTML": (".html", ".htm"),
    "Images": (".png", ".jpg", ".jpeg", ".tif", ".tiff", ".gif", ".bmp"),
}
TYPE_ORDER = sorted([*FILE_TYPES, "Other"])


def type_of(ext: Column) -> Column:
    out = None
    for name, exts in FILE_TYPES.items():
        out = F.when(ext.isin(*exts), name) if out is None else out.when(ext.isin(*exts), name)
    return out.otherwise("Other")
