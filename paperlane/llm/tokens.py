"""Token ids as Arrow files of equal-length sequences, and their reader.

Documents are put in ascending order, encoded, each closed with the end id, and the stream of ids is cut into
sequences of ``length``. A file holds record batches of two fixed-size-list columns, ``ids`` and ``mask`` (true where an
id is real, false in the padding of the file's last sequence), uncompressed, so a reader maps the file and reaches
sequence i of batch b without copying. Beside it lies an index stream file with doc_id, first id and number of ids.

Files are named by their partition, written under another name first and then moved, so a repeated task leaves the
same file. Paths are those of the shared folder and are opened through pyarrow's file systems.

Defined results: the key is a whole number or null, as the index holds 64-bit numbers; a null or empty text is only the end id; rows order by key, null first, then by text hash, repeated
rows each count; an empty table gives no files and an empty index; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import new_folder, written

LENGTH = 2048
BATCH = 64  # sequences in a record batch
END = 0
CACHE = 700_000  # pieces whose ids a worker process keeps; beyond it starts anew


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


MARKS = ".,;:!?"  # closing marks that are taken from a piece before it is looked up


class _Bytes(dict):
    """str.translate table from a character to the byte-level alphabet, filled as characters occur."""

    def __missing__(self, code: int) -> str:
        from tokenizers import pre_tokenizers

        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self[code] = level.pre_tokenize_str(chr(code))[0][0]
        return self[code]


class _Alone(Exception):
    """A piece may not be encoded on its own."""


class _Pieces(dict):
    """Ids of pieces that follow ``lead``, as bytes, found when first asked for."""

    def __init__(self, encoder: Encoder, lead: str):
        self.encoder, self.lead = encoder, lead

    def __missing__(self, piece: str) -> bytes:
        e = self.encoder
        word = piece.rstrip(MARKS)
        if word.isalpha():  # letters are one unit to the tokenizer, and so are marks after them
            ids = self.get(word)
            if ids is None:
                ids = self[word] = e.letters(self.lead + word)
            if len(word) < len(piece):
                marks = piece[len(word) :]
                if marks not in e.marks:
                    e.marks[marks] = e.whole(marks)
                ids = self[piece] = ids + e.marks[marks]
            return ids
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Alone
        ids = e.whole(self.lead + piece)
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Encoder:
    """Ids of whole texts by a byte-level BPE tokenizer, with the ids of recurring pieces kept.

    Such a tokenizer never joins what a single line feed or a single blank before a non-blank separates; the blank goes
    with what follows it. So a text falls into lines and these into pieces that are encoded on their own, each
    distinct piece once. A text with other white space next to a cut is encoded whole.
    """

    def __init__(self, tokenizer_json: str, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype = Tokenizer.from_str(tokenizer_json), dtype
        self.model, self.code = self.tokenizer.model, {"<u2": "H", "<u4": "I"}[dtype]
        parts = json.loads(tokenizer_json)
        before = parts.get("pre_tokenizer") or {}
        self.split = before.get("type") == "ByteLevel" and before.get("add_prefix_space") is False and before.get("use_regex", True) and parts.get("normalizer") is None
        self.marks: dict[str, bytes] = {}
        self.table = _Bytes()
        self.feed = self.whole("\n") if self.split else b""
        self.first, self.later = _Pieces(self, ""), _Pieces(self, " ")

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, word: str) -> bytes:
        """Ids of a run of letters straight from the tokenizer's model."""
        return array(self.code, [t.id for t in self.model.tokenize(word.translate(self.table))]).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as the bytes of dtype."""
        if not self.split:
            return [self.whole(t) if t else b"" for t in texts]
        if len(self.first) + len(self.later) > CACHE:
            self.first, self.later = _Pieces(self, ""), _Pieces(self, " ")
        first, later = self.first.__getitem__, self.later.__getitem__
        out = []
        for text in texts:
            if not text:
                out.append(b"")
                continue
            try:
                lines = [line.split(" ") for line in text.split("\n")]
                out.append(self.feed.join([first(x[0]) + b"".join(map(later, x[1:])) for x in lines]))
            except _Alone:
                out.append(self.whole(text))
        return out


@lru_cache(1)
def encoder(tokenizer_json: str, dtype: str) -> Encoder:
    """The encoder of this worker process: one for all its tasks, since each holds a vocabulary and what it has seen."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return Encoder(tokenizer_json, dtype)


def dtype_for(tokenizer_json: str, end: int) -> str:
    """The smallest type that holds all ids."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_str(tokenizer_json).get_vocab_size(), end + 1) <= 1 << 16 else "<u4"


# Names that Hadoop has for stores which pyarrow knows by another.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}


def _open(path: str) -> tuple[fs.FileSystem, str]:
    scheme, mark, rest = path.partition("://")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}{mark}{rest}")


def _sequence_schema(dtype: str, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(np.dtype(dtype)), length)), ("mask", pa.list_(pa.bool_(), length))])


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _Writer:
    """One file of sequences and its index."""

    def __init__(self, folder: str, part: int, attempt: int, dtype: str, length: int):
        self.files, root = _open(folder)
        self.files.create_dir(root, recursive=True)
        self.names = [f"{root}/part-{part:05d}.{kind}.arrow" for kind in ("ids", "docs")]
        self.temporary = [f"{n}.{attempt}" for n in self.names]
        self.dtype, self.length = np.dtype(dtype), length
        self.sinks = [self.files.open_output_stream(n) for n in self.temporary]
        self.schema = _sequence_schema(dtype, length)
        self.out = pa.ipc.new_file(self.sinks[0], self.schema)
        self.index = pa.ipc.new_stream(self.sinks[1], INDEX)
        self.held, self.docs, self.n_tokens = [], 0, 0
        self.waiting = 0

    def _put(self, ids: np.ndarray, real: int) -> None:
        values = pa.array(ids)
        mask = pa.array(np.arange(len(ids)) < real)
        lists = [pa.FixedSizeListArray.from_arrays(x, self.length) for x in (values, mask)]
        self.out.write_batch(pa.record_batch(lists, schema=self.schema))

    def add(self, keys: list, encoded: list[bytes]) -> None:
        counts = np.array([len(e) // self.dtype.itemsize for e in encoded], dtype=np.int64)
        starts = self.n_tokens + np.cumsum(counts) - counts
        self.index.write_batch(pa.record_batch([pa.array(keys, pa.int64()), pa.array(starts), pa.array(counts)], schema=INDEX))
        self.held.append(b"".join(encoded))
        self.docs += len(keys)
        self.n_tokens += int(counts.sum())
        self.waiting += int(counts.sum())
        block = self.length * BATCH
        if self.waiting >= block:
            ids = np.frombuffer(b"".join(self.held), dtype=self.dtype)
            whole = len(ids) // block * block
            for i in range(0, whole, block):
                self._put(ids[i : i + block], block)
            self.held = [ids[whole:].tobytes()]
            self.waiting -= whole

    def close(self) -> tuple:
        ids = np.frombuffer(b"".join(self.held), dtype=self.dtype)
        if len(ids):
            padded = np.zeros(-(-len(ids) // self.length) * self.length, dtype=self.dtype)
            padded[: len(ids)] = ids
            self._put(padded, len(ids))
        self.out.close()
        self.index.close()
        for sink, a, b in zip(self.sinks, self.temporary, self.names):
            sink.close()
            self.files.move(a, b)
        return self.docs, self.n_tokens


def write(docs: DataFrame, folder: str, tokenizer_json: str, text: str = "text", key: str = "doc_id", length: int = LENGTH, end: int = END, dtype: str | None = None) -> DataFrame:
    """Writes the files under folder; returns one row per file: part, docs, tokens, first (ids in the files before it).

    Without ``dtype`` ids take 16 bits if the vocabulary allows it, else 32.
    """
    spark = docs.sparkSession
    dtype = dtype or dtype_for(tokenizer_json, end)
    vocabulary = spark.sparkContext.broadcast(tokenizer_json)  # a fixed few MB
    closing = np.array([end], dtype=dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, writer = TaskContext.get(), None
        for batch in batches:
            if writer is None:
                enc = encoder(vocabulary.value, dtype)
                writer = _Writer(folder, context.partitionId(), context.taskAttemptId(), dtype, length)
            for i in range(0, batch.num_rows, 256):  # a few texts at a time
                part = batch.slice(i, 256)
                writer.add(part.column(0).to_pylist(), [x + closing for x in enc.encode(part.column(1).to_pylist())])
        if writer is not None:
            n, tokens = writer.close()
            yield pa.record_batch([pa.array([context.partitionId()], pa.int32()), pa.array([n], pa.int64()), pa.array([tokens], pa.int64())], names=["part", "docs", "tokens"])

    # equal rows, however many, have a number of their own, so they don't all fall in one range
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("n"))
    rows = rows.repartitionByRange("k", "h", "n").sortWithinPartitions("k", "h", "n").select("k", "t")
    files = written(rows.mapInArrow(run, "part int, docs long, tokens long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read(files: DataFrame, folder: str) -> DataFrame:
    """From the rows of ``write``, one row per document in the files: doc_id, start, n_tokens, ids_crc32 (of little-endian 32-bit ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _documents(folder, part, first)

    spread = files.select("part", "first").repartition("part")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def sequences(folder: str, part: int) -> pa.ipc.RecordBatchFileReader:
    """The mapped file of one part: any batch, and in it any sequence, without copying."""
    files, root = _open(folder)
    name = f"{root}/part-{part:05d}.ids.arrow"
    source = pa.memory_map(name) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(name)
    return pa.ipc.open_file(source)


def _documents(folder: str, part: int, first: int) -> Iterator[pa.RecordBatch]:
    files, root = _open(folder)
    reader = sequences(folder, part)
    at, block = 0, np.empty(0, dtype=np.uint32)  # ids of the current batch, from position ``at`` of the file
    number = 0
    with files.open_input_stream(f"{root}/part-{part:05d}.docs.arrow") as source:
        for index in pa.ipc.open_stream(source):
            crcs = []
            for start, n in zip(index.column(1).to_pylist(), index.column(2).to_pylist()):
                crc, done = 0, 0
                while done < n:
                    if start + done >= at + len(block):
                        at += len(block)
                        block = reader.get_batch(number).column(0).values.to_numpy()
                        number += 1
                        continue
                    ids = block[start + done - at : start + n - at]
                    crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    done += len(ids)
                crcs.append(crc)
            starts = pa.array(index.column(1).to_numpy() + first)
            yield pa.record_batch([index.column(0), starts, index.column(2), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def encoded(docs: DataFrame, tokenizer: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs written and read back: doc_id, start, n_tokens, ids_crc32."""
    folder = new_folder(docs.sparkSession, "tokens")
    with open(tokenizer or tokenizer_path(), encoding="utf-8") as f:
        vocabulary = f.read()
    return read(write(docs, folder, vocabulary, text, key), folder)
