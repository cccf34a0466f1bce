"""Folders of files as extracted rows.

Plain text, markup and flags are column expressions on the bytes; only formats that need a parser go through
``mapInPandas``, in a child process with a deadline and a limit of memory. Extension and size are tested first, so
unsupported and oversized files are never opened.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name, extension, strip_html, strip_rtf
from ..plans.schema import EXTRACTED_SCHEMA, META
from ..plans.settings import Settings
from ..shared import written
from . import extract, listing, stores
from .guarded import Died, Guard
from .tables import meta


def _described(listing: DataFrame) -> DataFrame:
    return listing.select("path", "rel_path", base_name(F.col("rel_path")).alias("file_name"), extension(F.col("rel_path")).alias("ext"), F.coalesce("size_bytes", F.lit(0)).cast("long").alias("size_bytes"), "problem", "place")


READ_BATCH = 16 << 20  # bytes of files that are handed on at a time


def _with_content(listing: DataFrame, root: str, settings: Settings, readers: extract.Registry) -> DataFrame:
    """Adds content: bytes of files that have a reader and are within the limit of size; what cannot be read says why in ``problem``.

    Only these are read, one at a time, by the tasks; all others pass with null content.
    """
    wanted = F.coalesce(F.col("ext").isin(*readers.opened()), F.lit(False)) & (F.col("size_bytes") <= settings.max_bytes) & F.col("problem").isNull()
    rows = listing.withColumn("wanted", wanted)
    schema = "path string, rel_path string, file_name string, ext string, size_bytes long, problem string, content binary"
    return rows.mapInArrow(lambda batches: _read(batches, root, settings.max_bytes, ("path", "rel_path", "file_name", "ext", "size_bytes")), schema)


def _read(batches: Iterator[pa.RecordBatch], root: str, most: int, names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The named columns of listed files with ``problem`` and ``content``, handed on whenever READ_BATCH bytes are held; files that are not ``wanted``, or have a problem, are not opened."""
    store, _ = stores.opened(root)
    for b in batches:
        at, held, contents, problems = 0, 0, [], []

        def part(end: int, b: pa.RecordBatch = b) -> pa.RecordBatch:
            cut = b.slice(at, end - at)
            return pa.record_batch([*(cut.column(n) for n in names), pa.array(problems, pa.string()), pa.array(contents, pa.binary())], names=[*names, "problem", "content"])

        found = b.column("problem").to_pylist()
        wanted = b.column("wanted").to_pylist() if "wanted" in b.schema.names else [x is None for x in found]
        for i, (place, problem, wanted) in enumerate(zip(b.column("place").to_pylist(), found, wanted)):
            data = None
            if wanted:
                try:
                    data = stores.read(store, place, most)
                except Exception as e:  # gone since it was listed, or not ours to read
                    problem = type(e).__name__
            contents.append(data)
            problems.append(problem)
            held += len(data or b"")
            if held >= READ_BATCH:
                yield part(i + 1)
                at, held, contents, problems = i + 1, 0, [], []
        if at < b.num_rows:
            yield part(b.num_rows)


def with_bytes(found: DataFrame, root: str, most: int) -> DataFrame:
    """A listing with the bytes of all its files up to ``most``: content, and a ``problem`` where they could not be read."""
    names = ("path", "rel_path", "place", "size_bytes", "modified")
    return found.mapInArrow(lambda batches: _read(batches, root, most, names), f"{listing.SCHEMA}, content binary")


def scan(spark: SparkSession, root: str, settings: Settings = Settings(), readers: extract.Registry = extract.Registry()) -> DataFrame:
    """Every file below root: path, rel_path, file_name, ext, size_bytes, problem, content; hidden and empty ones, too.

    Executors list the folders once (``listing``) and read bytes of files that have a reader and are not too large; all others are
    listed with null content and never opened. Files are dealt out anew between the two, so a folder that holds most of
    them is read by all tasks. What cannot be listed or read is a row with a ``problem``.
    """
    found = _described(listing.files_below(spark, root)).repartition(F.xxhash64("place"))
    return _with_content(found, root, settings, readers)


def stream(spark: SparkSession, root: str, settings: Settings = Settings(), readers: extract.Registry = extract.Registry()) -> DataFrame:
    """As ``scan``, as a stream of files as they appear below root, and again when they change."""
    return _with_content(_described(listing.new_files(spark, root)), root, settings, readers)


def kind_of(ext: Column, readers: extract.Registry = extract.Registry()) -> Column:
    kinds: dict[str, list[str]] = {}
    for e, kind in readers.extensions.items():
        kinds.setdefault(kind, []).append(e)
    out = F.lit(None).cast("string")
    for kind, exts in kinds.items():
        out = F.when(ext.isin(*exts), kind).otherwise(out)
    return out


def text_of(content: Column) -> Column:
    """Bytes as UTF-8 text without what is not valid in them; a replacement character that stands in the file stays."""
    mark = "\U0010fffd"
    raw = content.cast("string")
    valid = F.replace(F.make_valid_utf8(F.replace(raw, F.lit("\ufffd"), F.lit(mark))), F.lit("\ufffd"), F.lit(""))
    return F.when(F.is_valid_utf8(raw), raw).otherwise(F.replace(valid, F.lit(mark), F.lit("\ufffd")))


def _person_tests(settings: Settings):
    """Row tests for the parsers, from the same rule list as the column expressions."""
    from ..functions import detectors as d

    def digits(v: str) -> str:
        return re.sub(r"[^0-9]", "", v)

    def luhn(n: str) -> bool:
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(n))]
        return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0

    def card(n: str) -> bool:
        return 13 <= len(n) <= 19 and luhn(n) and any(len(n) in lengths and low <= int(n[:k]) <= high for k, low, high, lengths in d.CARD_NETWORKS)

    def compiled(p: str) -> re.Pattern:
        return re.compile(p, 0 if d.names_letters(p) else re.ASCII)  # words as in the columns

    plain, cards = [], []
    for r in settings.rules.rules:
        if r.per_person and r.method == "ssn":
            plain.append(compiled(d.SSN_SEPARATED))
        elif r.per_person and r.method == "regex":
            # the first match of a line needs no place where another ended
            (cards if r.luhn else plain).extend(compiled(d.ONCE[p][0].replace(r"|\G", "") if p in d.ONCE else p) for p in r.patterns)
    roster = re.compile(d.ROSTER_LINE)

    def is_person(line: str) -> bool:
        return any(p.search(line) for p in plain) or any(card(digits(m[0])) for p in cards for m in p.finditer(line))

    def is_name(line: str) -> bool:
        head = line.strip()
        m = roster.match(head)
        return bool(m) and not head[m.end() : m.end() + 1].isdigit()

    return is_person, is_name


def extracted(files: DataFrame, settings: Settings = Settings(), readers: extract.Registry = extract.Registry()) -> DataFrame:
    """Rows of the extracted schema for scanned files."""
    s = settings
    of = F.coalesce(kind_of(F.col("ext"), readers), F.lit("none"))
    problem = F.col("problem") if "problem" in files.columns else F.lit(None).cast("string")
    files = files.withColumn("problem", problem).withColumn("kind", F.when(F.col("problem").isNotNull(), "unread").when((F.col("size_bytes") > s.max_bytes) & (of != "none"), "large").otherwise(of))
    raw = text_of(F.col("content"))
    head = F.substring(raw, 1, min(2 * s.max_scan_chars, (1 << 31) - 1))
    flags = {
        "none": ("unknown", "no_parser", "unsupported_ext"), "large": ("", "skipped_too_large", f"size>{s.max_bytes}"), "convert": ("needs_conversion", "no_parser", None),
        "image": ("image_only", None, None), "container": ("none", "container", "expand_first"), "unread": ("", "error", F.col("problem")),
    }
    native = {"text": F.substring(raw, 1, s.max_scan_chars), "markup": F.substring(strip_html(head), 1, s.max_scan_chars), "rtf": F.substring(strip_rtf(head), 1, s.max_scan_chars)}
    kind = F.col("kind")

    def pick(values: dict) -> Column:
        out = F.lit(None).cast("string")
        for k, v in values.items():
            out = F.when(kind == k, v).otherwise(out)
        return out

    text = F.coalesce(pick(native), F.lit(""))
    m = meta(text_extractable=pick({k: F.lit(v[0]) for k, v in flags.items()} | {k: F.lit("text") for k in native}), status=pick({k: F.lit(v[1]) for k, v in flags.items()}), detail=pick({k: v[2] if isinstance(v[2], Column) else F.lit(v[2]) for k, v in flags.items()}))
    own = kind.isin(*readers.parsers)
    simple = files.filter(~own).select("rel_path", "file_name", "ext", "size_bytes", text.alias("text"), m.alias("meta"))
    parsed = files.filter(own).select("rel_path", "file_name", "ext", "size_bytes", "kind", "content")
    tests = _person_tests(s)

    def parse(data: bytes, header: tuple[str, str]) -> extract.Extracted:
        kind, ext = header
        return readers.parsers[kind](data, ext, extract.RowCounter(*tests, s), s)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with Guard(parse, s.timeout_s, s.parser_memory_mb) as guard:
            for b in batches:
                texts, metas = [], []
                for kind, ext, data in zip(b["kind"], b["ext"], b["content"]):
                    try:
                        text, got = guard(bytes(data), (kind, ext))
                    except TimeoutError:
                        text, got = "", {"status": "timeout", "detail": "per_file_timeout"}
                    except Died:
                        text, got = "", {"status": "error", "detail": "parser_died"}
                    except RuntimeError as e:  # one bad file is a row with a status, never the end of a run
                        text, got = "", {"status": "error", "detail": str(e)}
                    texts.append(text.encode("utf-8", "replace").decode())
                    metas.append(dict.fromkeys(META.names) | got)
                yield pd.DataFrame({"rel_path": b["rel_path"], "file_name": b["file_name"], "ext": b["ext"], "size_bytes": b["size_bytes"], "text": texts, "meta": metas})

    return simple.unionByName(parsed.mapInPandas(run, EXTRACTED_SCHEMA))


def with_jobs(rows: DataFrame, jobs: DataFrame) -> DataFrame:
    """extracted rows with what their job's folder says: job_dir, job_bde_threshold, job_rules_version, job_protocol (null where nothing is said).

    jobs (job_dir, and any of bde_threshold, rules_version, protocol_text) holds a row for each job folder; of several the greatest
    counts. Empty values are none. The table is written first, so Spark knows its size and sends it to all tasks only if it is small.
    """
    from ..operators.fleet import job_dir_of

    given = {"bde_threshold": ("job_bde_threshold", "int"), "rules_version": ("job_rules_version", "string"), "protocol_text": ("job_protocol", "string")}
    values = [(F.nullif(F.trim(F.col(a).cast("string")), F.lit("")).try_cast(kind) if a in jobs.columns else F.lit(None).cast(kind)).alias(b) for a, (b, kind) in given.items()]
    j = jobs.select(F.regexp_replace("job_dir", "/+$", "").alias("job_dir"), *values)
    j = written(j.groupBy("job_dir").agg(*(F.max(b).alias(b) for b, _ in given.values())), "jobs")
    return rows.withColumn("job_dir", job_dir_of(F.col("rel_path"))).join(j, "job_dir", "left")


PROTOCOL_KINDS = (".pdf", ".docx", ".doc", ".txt", ".rtf")  # fixed value: the first that is there counts


def jobs_below(spark: SparkSession, root: str, settings: Settings = Settings()) -> DataFrame:
    """The job folders below root for ``with_jobs``: folders that hold pii_job.json or a protocol file beside ``files``.

    The JSON's bde_threshold counts where it is a whole number above 0; names count in either case.
    """
    found = _described(listing.files_below(spark, root)).filter(F.lower("file_name").isin("pii_job.json", *(f"protocol{e}" for e in PROTOCOL_KINDS)) & ~F.col("rel_path").rlike("(^|/)files/"))
    readers = extract.Registry()
    readers = extract.Registry(readers.extensions | {".json": "text"}, readers.parsers)
    texts = extracted(_with_content(found, root, settings, readers), settings, readers).select(F.regexp_extract("rel_path", "^(.*)/[^/]*$", 1).alias("job_dir"), F.lower("file_name").alias("name"), "text")
    is_json = F.col("name") == "pii_job.json"
    said = F.get_json_object("text", "$.bde_threshold").try_cast("int")
    rank = F.array_position(F.array(*(F.lit(f"protocol{e}") for e in PROTOCOL_KINDS)), F.col("name"))
    return texts.groupBy("job_dir").agg(F.max(F.when(is_json & (said > 0), said)).alias("bde_threshold"), F.max(F.when(is_json, F.get_json_object("text", "$.rules_version"))).alias("rules_version"), F.min_by(F.nullif(F.trim("text"), F.lit("")), F.when(~is_json, rank)).alias("protocol_text"))
