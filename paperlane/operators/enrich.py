"""Calls to outside services, injected as Python functions; without them the rules decide.

A function gets the rows that need it and no others, as narrow rows of a number and what it asks about; its answers are
written and joined back by that number. So the table that the calls stand on is written first (``numbered``): however
many services there are, the corpus is read and its patterns are run once. A Python function inside CASE WHEN would be
called for every row. Calls of a task run side by side, within limits, and failed ones are tried again (``Calls``).
"""

from __future__ import annotations

import random
import threading
import time
from collections import Counter, deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..plans.schema import META, struct_of
from ..shared import written

ModelFn = Callable[[str], dict]

ANSWER_FIELDS = "failed string, responsive boolean, n_names int, person_count int, is_roster boolean, level string, tokens int"
ANSWER = struct_of(ANSWER_FIELDS)


def _number(value: object) -> int:
    try:
        return int(value)
    except (TypeError, ValueError):
        return 0


def _answer(call: ModelFn, text: str, line: Line) -> dict:
    try:
        got = line.ask(call, text) or {}
    except Exception as e:  # a failed call is a note on its row, never the end of a run
        return dict.fromkeys(ANSWER.names) | {"failed": type(e).__name__}
    return {
        "failed": None,
        "responsive": bool(got.get("responsive")),
        "n_names": len(got.get("names") or ()),
        "person_count": _number(got.get("person_count")),
        "is_roster": bool(got.get("is_roster")),
        "level": str(got.get("responsiveness") or "").strip(),
        "tokens": _number(got.get("tokens")),
    }


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df as a written table with a number ``call_id`` for each row, to which answers are joined back."""
    return written(df.withColumn("call_id", F.monotonically_increasing_id()), name)


@dataclass(frozen=True)
class Calls:
    """How a task calls a service: so many calls at once, so many begun a second, and again after a failure, each pause twice the one before.

    A service that names a pause in its error (``retry_after``, in seconds) is given it. Errors in ``final`` are not tried again.
    The limits hold for a task: divide what a service allows by the number of tasks that run at once.
    """

    at_once: int = 4
    a_second: float = 0.0  # 0: no limit
    tries: int = 4
    pause_s: float = 0.5
    most_pause_s: float = 60.0
    final: tuple[type[BaseException], ...] = (TypeError, ValueError, KeyError, AttributeError, NotImplementedError)


class Line:
    """A task's line to a service, shared by its threads: ``ask`` waits for its turn and tries again."""

    def __init__(self, how: Calls, clock: Callable[[], float] = time.monotonic, wait: Callable[[float], None] = time.sleep):
        self.how, self.clock, self.wait = how, clock, wait
        self.lock, self.turn = threading.Lock(), clock()

    def _take_turn(self) -> None:
        if self.how.a_second > 0:
            with self.lock:  # turns are a fixed time apart; one that nobody took is not saved up
                self.turn = max(self.turn, self.clock())
                pause, self.turn = self.turn - self.clock(), self.turn + 1 / self.how.a_second
            if pause > 0:
                self.wait(pause)

    def ask(self, call: Callable, *what: object) -> object:
        for nth in range(1, max(self.how.tries, 1) + 1):
            self._take_turn()
            try:
                return call(*what)
            except self.how.final:
                raise
            except Exception as e:
                if nth >= self.how.tries:
                    raise
                wanted = getattr(e, "retry_after", None)
                pause = float(wanted) if isinstance(wanted, int | float) else self.how.pause_s * 2 ** (nth - 1) * random.uniform(0.5, 1.5)
                self.wait(min(max(pause, 0.0), self.how.most_pause_s))
        raise AssertionError


ANSWER_BATCH = 64  # answers that are handed on at a time


def _answers(todo: DataFrame, answer: Callable[[SimpleNamespace, Line], dict], fields: str, how: Calls) -> DataFrame:
    """todo (call_id, ...) with the answer's ``fields`` for each row, written: a call is made once, whatever reads its answer.

    A task's calls run in a pool of threads; at most twice as many rows as calls at once are read ahead.
    """
    schema = T.StructType([T.StructField("call_id", T.LongType()), *struct_of(fields).fields])
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line, waiting, done = Line(how), deque(), []

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pylist(done, schema=kinds)
            done.clear()
            return out

        def take() -> None:
            id_, future = waiting.popleft()
            done.append({"call_id": id_} | future.result())

        with ThreadPoolExecutor(max(how.at_once, 1)) as pool:
            for b in batches:
                for row in b.to_pylist():
                    waiting.append((row["call_id"], pool.submit(answer, SimpleNamespace(**row), line)))
                    if len(waiting) >= 2 * max(how.at_once, 1):
                        take()
                    if len(done) >= ANSWER_BATCH:
                        yield batch()
            while waiting:
                take()
        if done:
            yield batch()

    return written(todo.mapInArrow(run, schema), "answers")


def asked(df: DataFrame, gate: Column, call: ModelFn | None, into: str, prompt: Column, how: Calls = Calls()) -> DataFrame:
    """df with a struct column ``into``: the answer where the gate is open, null elsewhere. df is ``numbered`` if there is a call."""
    if call is None:
        return df.withColumn(into, F.lit(None).cast(ANSWER))
    todo = df.filter(gate).select("call_id", prompt.alias("prompt"))
    got = _answers(todo, lambda row, line: _answer(call, row.prompt or "", line), ANSWER_FIELDS, how)
    return df.join(got.select("call_id", F.struct(*ANSWER.names).alias(into)), "call_id", "left")


OCR_FIELDS = "failed string, new_text string, pages int, has_tables boolean, rows int"


def recognised(df: DataFrame, call: Callable[[str], dict] | None, how: Calls = Calls()) -> DataFrame:
    """OCR of image-only files: success replaces text and meta, failure leaves a note and still counts as a call.

    ``call`` gets the path and returns text, pages, has_tables and structured_entity_rows.
    """
    if call is None:
        return df

    def one(row: SimpleNamespace, line: Line) -> dict:
        try:
            got = line.ask(call, row.rel_path)
            return {"failed": None, "new_text": got.get("text", ""), "pages": _number(got.get("pages")), "has_tables": bool(got.get("has_tables")), "rows": _number(got.get("structured_entity_rows"))}
        except Exception as e:
            return {"failed": type(e).__name__, "new_text": None, "pages": None, "has_tables": None, "rows": None}

    got = _answers(df.filter(F.col("meta.text_extractable") == "image_only").select("call_id", "rel_path"), one, OCR_FIELDS, how)
    got = got.withColumn("answered", F.lit(True))
    df = df.join(got, "call_id", "left")
    good = F.coalesce(F.col("answered") & F.col("failed").isNull(), F.lit(False))
    read = {"text_extractable": F.lit("text"), "is_structured": F.col("has_tables"), "page_or_sheet_count": F.col("pages"), "structured_entity_rows": F.col("rows"), "ocr": F.lit(True), "ocr_attempted": F.lit(True), "ocr_pages": F.col("pages")}
    note = F.concat_ws(" ", "meta.detail", F.concat(F.lit("ocr_failed:"), F.col("failed")))
    meta = F.when(good, _meta_of(read)).when(F.col("answered"), F.col("meta").withField("ocr_attempted", F.lit(True)).withField("detail", note)).otherwise(F.col("meta"))
    return df.withColumns({"text": F.when(good, F.col("new_text")).otherwise(F.col("text")), "meta": meta}).drop("answered", *(f.name for f in struct_of(OCR_FIELDS)))


def _meta_of(values: dict[str, Column]) -> Column:
    return F.struct(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in META))


LEAST_IMAGE_BYTES = 1024
IMAGE_FIELDS = "added string, calls int, good int, note string"


def images_read(df: DataFrame, call: Callable[[bytes], str] | None, max_chars: int, how: Calls = Calls()) -> DataFrame:
    """OCR of images embedded in searchable files: their texts are appended, up to ``max_chars`` in all.

    Adds img_ocr_qualifying (images found), img_ocr_calls (those of LEAST_IMAGE_BYTES or more, each a call whether it succeeds or not),
    img_ocr_ok (calls that gave text) and img_note: the pages that gave text, of how many images, with how many
    characters, and what failed. Files without such images, and all files without ``call``, keep their text.
    """
    found = F.coalesce("meta.content_images", F.array().cast(META["content_images"].dataType))
    n = F.when(F.coalesce(F.col("meta.text_extractable") == "text", F.lit(False)), F.size(found)).otherwise(0)
    if call is None:
        return df.withColumns({"img_ocr_qualifying": n, "img_ocr_calls": F.lit(0), "img_ocr_ok": F.lit(0), "img_note": F.lit("")})

    def one(row: SimpleNamespace, line: Line) -> dict:
        large = [i for i in row.images if len(i["jpeg"] or b"") >= LEAST_IMAGE_BYTES]
        texts, failed = [], Counter()
        for image in large:
            try:
                text = line.ask(call, bytes(image["jpeg"])) or ""
            except Exception as e:
                failed[type(e).__name__] += 1
                continue
            if text.strip():
                texts.append((image["page"], text))
        size = sum(len(t) for _, t in texts)
        notes = [f"img_ocr:{','.join(f'p{p}' for p, _ in texts)}({len(texts)}/{len(row.images)},+{size}chars)" if texts else f"img_ocr:none({len(large)} calls,0 chars)"] if large else []
        notes += [f"img_ocr_failed:{k}x{v}" for k, v in sorted(failed.items())]
        return {"added": "\n".join(t for _, t in texts), "calls": len(large), "good": len(texts), "note": " ".join(notes)}

    df = df.withColumn("img_ocr_qualifying", n)
    got = _answers(df.filter("img_ocr_qualifying > 0").select("call_id", found.alias("images")), one, IMAGE_FIELDS, how)
    df = df.join(got, "call_id", "left")
    text = F.array_join(F.filter(F.array(F.coalesce("text", F.lit("")), "added"), lambda x: x != ""), "\n")
    return df.withColumns({
        "text": F.when(F.col("calls") > 0, F.substring(text, 1, max_chars)).otherwise(F.col("text")), "img_ocr_calls": F.coalesce("calls", F.lit(0)),
        "img_ocr_ok": F.coalesce("good", F.lit(0)), "img_note": F.coalesce("note", F.lit("")),
    }).drop("added", "calls", "good", "note")
