"""Chat formatting by token-level assembly.

A turn is a heading, its text and a closing mark. Headings and marks are reserved ids beyond the tokenizer's own, put
between separately encoded segments, so nothing in a text can become one. The text form of a turn stays readable too:
control strings within a text are escaped with a backslash, and so is the backslash, so the text comes back exactly.
The loss mask of a turn is the prefix sum of +1 where an assistant's text begins and -1 where it ends; the place of a
turn in its conversation is the prefix sum of the turns' lengths.

Defined results: a null text is empty; a null role is the empty role; roles without a heading of their own get the
general heading with the escaped role; turns order by turn, null first, then by a hash of role and text, so repeated rows
stand side by side; a null conv_id is a conversation of its own; an empty table gives an empty table; other columns are
ignored. A conversation is read as a stream, never held whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .tokens import tokenizer_path

# The template's control strings. Their ids follow the tokenizer's, in this order.
ROLES = ("system", "user", "assistant", "tool")
HEADINGS = tuple(f"### {r.capitalize()}: " for r in ROLES)
OTHER, ROLE_END, TURN_END = "### ", ": ", "</turn>\n"
CONTROL = (*HEADINGS, OTHER, ROLE_END, TURN_END)
TRAINED_ROLE = "assistant"
_UNSAFE, _ESCAPED = re.compile(r"\\|###|</turn>"), re.compile(r"\\(\\|###|</turn>|:)")


def escape(text: str) -> str:
    return _UNSAFE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Template:
    """Assembles turns of ids and takes them apart."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True  # the tokenizer's own special strings are text here
        self.base = self.tokenizer.get_vocab_size()
        self.ids = {c: self.base + i for i, c in enumerate(CONTROL)}

    def _segments(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def assemble(self, roles: list[str | None], texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """(ids, mask) of each turn."""
        contents = self._segments([escape(t or "") for t in texts])
        out = []
        for role, content in zip(roles, contents):
            role = role or ""
            if role in ROLES:
                ids = [self.ids[HEADINGS[ROLES.index(role)]]]
            else:
                ids = [self.ids[OTHER], *self._segments([escape(role).replace(":", "\\:")])[0], self.ids[ROLE_END]]
            step = np.zeros(len(ids) + len(content) + 2, dtype=np.int8)
            if role == TRAINED_ROLE:
                step[len(ids)] += 1
                step[len(ids) + len(content)] -= 1
            ids = [*ids, *content, self.ids[TURN_END]]
            out.append((ids, np.cumsum(step)[: len(ids)].tolist()))
        return out

    def _text(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def take_apart(self, ids: list[int], mask: list[int]) -> tuple[str, str, str | None, int]:
        """role, text, the text under the mask (None without one) and the length of the turn's text form."""
        if ids[0] == self.ids[OTHER]:
            end = ids.index(self.ids[ROLE_END])
            name = self._text(ids[1:end])
            role, heading = unescape(name), OTHER + name + ROLE_END
        else:
            end = 0
            heading = CONTROL[ids[0] - self.base]
            role = ROLES[HEADINGS.index(heading)]
        body = self._text(ids[end + 1 : -1])
        trained = None
        if role == TRAINED_ROLE:
            trained = unescape(self._text([i for i, m in zip(ids, mask) if m]))
        return role, unescape(body), trained, len(heading) + len(body) + len(TURN_END)

    def text(self, ids: list[int]) -> str:
        """The text form of assembled ids."""
        out, run = [], []
        for i in ids:
            if i < self.base:
                run.append(i)
                continue
            out += [self._text(run), CONTROL[i - self.base]]
            run = []
        return "".join([*out, self._text(run)])


def _vocabulary(tokenizer: str | None) -> str:
    with open(tokenizer or tokenizer_path(), encoding="utf-8") as f:
        return f.read()


def formatted(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """conv_id, place (of the turn in its conversation), start (id before which the turn begins), ids, mask; one row per turn."""
    spark = turns.sparkSession
    vocabulary = spark.sparkContext.broadcast(_vocabulary(tokenizer))  # a fixed few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = None
        for whole in batches:
            template = template or Template(vocabulary.value)
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                made = template.assemble(b.column(2).to_pylist(), b.column(3).to_pylist())
                ids, mask = (pa.array(x, pa.list_(t)) for x, t in zip(zip(*made), (pa.int32(), pa.int8())))
                lengths = pa.array([len(x) for x, _ in made], pa.int64())
                yield pa.record_batch([b.column(0), b.column(1), b.column(4), lengths, ids, mask], names=["conv_id", "turn", "tie", "n", "ids", "mask"])

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", F.xxhash64("role", "text").alias("tie"))
    rows = written(rows.mapInArrow(run, "conv_id long, turn long, tie long, n long, ids array<int>, mask array<tinyint>"), "chat-turns")
    # Windows run over a row of four numbers for each distinct turn; turns that are equal in all stand side by side.
    each = rows.groupBy("conv_id", "turn", "tie").agg(F.count("*").alias("rows"), F.max("n").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("turn", "tie").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select(
        F.struct("conv_id", "turn", "tie").alias("id"), "rows",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"), F.coalesce(F.sum(F.col("rows") * F.col("n")).over(before), F.lit(0)).alias("start"))
    single = rows.withColumn("id", F.struct("conv_id", "turn", "tie")).join(each, "id")
    nth = F.when(F.col("rows") == 1, F.lit(0))
    twins = single.filter("rows > 1").withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy("n")) - 1)
    both = single.filter("rows = 1").withColumn("nth", nth).unionByName(twins)
    return both.select("conv_id", (F.col("first") + F.col("nth") + 1).cast("int").alias("place"), (F.col("start") + F.col("nth") * F.col("n")).alias("start"), "ids", "mask")


def digests(rows: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """From written ``formatted`` rows: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    vocabulary = rows.sparkSession.sparkContext.broadcast(_vocabulary(tokenizer))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, open_conv, state = Template(vocabulary.value), object(), None

        def closed() -> tuple:
            return open_conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        def batch(done: list[tuple]) -> pa.RecordBatch:
            columns = zip(*done) if done else [[]] * len(kinds)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for b in batches:
            done = []
            for i in range(b.num_rows):
                conv = b.column(0)[i].as_py()
                if state is None or conv != open_conv:
                    if state:
                        done.append(closed())
                    open_conv, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, trained, chars = template.take_apart(b.column(1)[i].as_py(), b.column(2)[i].as_py())
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if trained is not None:
                    state[2] += len(trained)
                    state[3].update(trained.encode())
                state[4] += chars
            if done:
                yield batch(done)
        if state:
            yield batch([closed()])

    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "ids", "mask")
    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def round_trip(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """turns formatted, written, read back and summed up by conversation."""
    return digests(written(formatted(turns, tokenizer), "chat"), tokenizer)
