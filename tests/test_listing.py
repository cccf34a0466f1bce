"""Complete listings, parsers that are stopped, calls in a pool, and job folders."""

import ctypes
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from paperlane.operators import enrich
from paperlane.operators.pipeline import Services, inventory
from paperlane.plans.schema import EXTRACTED_SCHEMA, META
from paperlane.plans.settings import Settings
from paperlane.sources import extract, files, guarded, listing, stores

NAMES = ["a.txt", "_b.txt", ".c.txt", "_sub/d.txt", "E.TXT", "f.doc", "g.zip", "empty.txt", "_empty.txt"]


def filled(root, names):
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"" if "empty" in name else name.encode())
    return root


def test_every_file_is_listed(spark, tmp_path):
    """Hidden and empty files and folders below hidden ones, links, and names that are not UTF-8; one listing in the plan."""
    root = filled(tmp_path / "in", [*NAMES, ".hidden/_deep/x y%41é.txt"])
    raw = os.fsencode(str(root)) + b"/bad\xff.txt"
    with open(raw, "wb") as f:
        f.write(b"raw")
    (root / "nowhere.txt").symlink_to(root / "not there")
    (root / "loop").symlink_to(root)
    (root / "alias.txt").symlink_to(root / "a.txt")
    found = files.scan(spark, str(root))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and "binaryFile" not in plan
    rows = {r["rel_path"]: r for r in found.collect()}
    assert set(rows) == {*NAMES, ".hidden/_deep/x y%41é.txt", "bad\\xff.txt", "nowhere.txt", "loop", "alias.txt"}
    assert bytes(rows["bad\\xff.txt"]["content"]) == b"raw" and bytes(rows["alias.txt"]["content"]) == b"a.txt" and rows["g.zip"]["content"] is None
    assert rows["nowhere.txt"]["problem"] == "FileNotFoundError" and rows["loop"]["problem"] == "LinkToFolder" and rows["empty.txt"]["size_bytes"] == 0
    got = {r["rel_path"]: r["meta"]["status"] for r in files.extracted(found).collect()}
    assert got["nowhere.txt"] == "error" and got["_sub/d.txt"] is None and got["loop"] == "error"
    lanes = {r["rel_path"]: r["suggested_lane"] for r in inventory(files.extracted(found)).collect()}
    assert lanes["nowhere.txt"] == "review_error" and lanes[".c.txt"] == "likely_non_responsive" and len(lanes) == len(rows)


def test_prefixes_hold_each_file_once(tmp_path):
    names = [f"d{i % 7}/e{i % 5}/f{i % 3}/{i}.txt" for i in range(300)] + ["top.txt", "d1/one.txt"]
    root = str(filled(tmp_path / "in", names))
    for wanted in (1, 2, 8, 40, 10_000):
        parts = listing.prefixes(root, wanted)
        got = [r for p in parts for b in listing.listed(root, p) for r in b.column("rel_path").to_pylist()]
        assert sorted(got) == sorted(names), wanted
        assert all(isinstance(p.folder, bytes) for p in parts) and (wanted > 100 or len(parts) >= min(wanted, 1))
    assert [r for b in listing.listed(root + "/no", listing.Prefix(f"{root}/no".encode(), True)) for r in b.column("problem").to_pylist()] == ["FolderFileNotFoundError"]


def test_places_of_stores():
    assert stores.split("s3a://bucket/a b") == ("s3a://", "bucket/a b") and stores.split("file:/x/y") == ("file://", "/x/y") == stores.split("file:///x/y") and stores.split("/x") == ("", "/x")
    assert stores.SCHEMES["s3a"] == "s3"


def test_a_stream_takes_late_files_with_old_dates(spark, tmp_path):
    root, out, state = filled(tmp_path / "in", ["a.txt", "_b.txt"]), str(tmp_path / "out"), str(tmp_path / "state")

    def drained():
        rows = listing.new_files(spark, str(root)).select("rel_path", "size_bytes")
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(out).collect())

    assert drained() == [("_b.txt", 6), ("a.txt", 5)]
    filled(root, ["late.txt"])
    os.utime(root / "late.txt", (1, 1))
    assert drained() == [("_b.txt", 6), ("a.txt", 5), ("late.txt", 8)]
    (root / "a.txt").write_text("longer now")
    assert drained() == [("_b.txt", 6), ("a.txt", 5), ("a.txt", 10), ("late.txt", 8)]


def test_parsers_are_stopped(spark, tmp_path):
    """Asleep in native code, hungry for memory, dead, and a cell far outside the sheet: each costs its own row."""

    def parse(data, ext, rows, s):
        if data == b"sleep":
            ctypes.CDLL(None).sleep(60)
        elif data == b"eat":
            held = []
            while True:
                held.append(bytearray(64 << 20))
        elif data == b"die":
            os._exit(3)
        return data.decode(), {"text_extractable": "text"}

    for name, body in {"1.dwg": "sleep", "2.dwg": "fine", "3.dwg": "eat", "4.dwg": "fine", "5.dwg": "die", "6.dwg": "fine"}.items():
        (tmp_path / name).write_text(body)
    readers = extract.Registry().with_parser("drawing", (".dwg",), parse)
    settings = Settings(timeout_s=1.5, parser_memory_mb=512)
    start = time.time()
    scanned = files.scan(spark, str(tmp_path), settings, readers).coalesce(1)
    got = {r["rel_path"]: (r["text"], r["meta"]["status"], r["meta"]["detail"]) for r in files.extracted(scanned, settings, readers).collect()}
    assert time.time() - start < 40
    assert got == {"1.dwg": ("", "timeout", "per_file_timeout"), "3.dwg": ("", "error", "MemoryError"), "5.dwg": ("", "error", "parser_died"), **{f"{i}.dwg": ("fine", None, None) for i in (2, 4, 6)}}


def test_a_guard_alone():
    with guarded.Guard(lambda data, header: (len(data), header), 20) as g:
        assert g(b"x" * (5 << 20), "a") == (5 << 20, "a") and g(b"", None) == (0, None)
        pid = g.pid
        assert g(b"abc", 1) == (3, 1) and g.pid == pid
    with pytest.raises(ProcessLookupError):
        os.kill(pid, 0)
    with guarded.Guard(lambda data, header: 1 / 0, 20) as g, pytest.raises(RuntimeError, match="ZeroDivisionError"):
        g(b"", None)
    with guarded.Guard(lambda data, header: os._exit(1), 20) as g:
        for _ in range(2):
            with pytest.raises(guarded.Died):
                g(b"x" * (1 << 20), None)


def test_cells_outside_the_sheet():
    from test_sources import cells, counter, workbook

    far = '<row r="1"><c r="ZZZZZZ1" t="inlineStr"><is><t>x</t></is></c></row>'
    with pytest.raises(extract.BadCell):
        extract.spreadsheet(workbook(far), counter())
    assert extract.sheets(workbook('<row r="1"><c r="XFD1"><v>7</v></c></row>'))[0][1][0][-1] == "7"
    assert extract.spreadsheet(workbook(cells(1, "a")), counter())[1]["structured_total_rows"] == 1


def doc(name, text, **meta):
    return (name, name, ".txt", len(text), text, tuple(({"text_extractable": "text"} | meta).get(n) for n in META.names))


def test_calls_are_tried_again_within_limits(spark, tmp_path):
    """Every third call fails at first: all rows are answered, never more than four at once, and a final error is not repeated."""
    folder = str(tmp_path)

    class Flaky:
        def __call__(self, text):
            mark = os.path.join(folder, f"{os.getpid()}")
            lock, held, seen = threading.__dict__.setdefault("of_this_test", (threading.Lock(), [], {}))
            with lock:
                held.append(1)
                most = len(held)
                seen[text] = seen.get(text, 0) + 1
            with open(mark, "a") as f:
                f.write(f"{most} {seen[text]}\n")
            time.sleep(0.01)
            with lock:
                held.pop()
            if "never" in text:
                raise ValueError(text)
            if int(text.split()[-1]) % 3 == 0 and seen[text] < 3:
                raise ConnectionError(text)
            return {"responsive": True, "tokens": 1}

    rows = [doc(f"{i}.txt", f"a@b.org {i}") for i in range(60)] + [doc("n.txt", "a@b.org never")]
    inv = inventory(spark.createDataFrame(rows, EXTRACTED_SCHEMA).repartition(2), services=Services(judge=Flaky(), calls=enrich.Calls(at_once=4, pause_s=0.001)))
    got = {r["rel_path"]: (r["llm_responsive"], r["detail"]) for r in inv.collect()}
    assert got.pop("n.txt") == ("", "llm_failed:ValueError") and set(got.values()) == {("yes", "")}
    lines = [tuple(map(int, x.split())) for p in tmp_path.iterdir() for x in p.read_text().splitlines()]
    assert len(lines) == 61 + 2 * 20 and 1 < max(m for m, _ in lines) <= 4


def test_pauses_and_turns():
    now, waits = [0.0], []

    def wait(s):
        waits.append(s)
        now[0] += s

    class Busy(Exception):
        retry_after = 7

    line = enrich.Line(enrich.Calls(tries=3, a_second=2), lambda: now[0], wait)
    calls = []

    def fail():
        calls.append(now[0])
        raise Busy

    with pytest.raises(Busy):
        line.ask(fail)
    assert len(calls) == 3 and [w for w in waits if w == 7] == [7, 7]
    calls.clear()
    for _ in range(4):
        line.ask(lambda: calls.append(now[0]))
    assert all(b - a >= 0.5 for a, b in zip(calls, calls[1:]))
    line = enrich.Line(enrich.Calls(tries=4, pause_s=1), lambda: 0.0, waits.append)
    waits.clear()
    with pytest.raises(OSError):
        line.ask(lambda: (_ for _ in ()).throw(OSError()))
    assert len(waits) == 3 and all(0.5 * 2**i <= w <= 1.5 * 2**i for i, w in enumerate(waits))


def test_jobs_have_their_own_protocol(spark, tmp_path):
    """Thresholds and protocols from the jobs' folders; two jobs get two prompts."""
    for name, body in {"one/files/a.txt": "mail a@b.org", "two/files/deep/b.txt": "mail c@d.org", "three/files/c.txt": "mail e@f.org", "one/pii_job.json": '{"bde_threshold": 1, "rules_version": "9"}', "two/pii_job.json": '{"bde_threshold": "x"}',
                       "one/protocol.txt": "only one", "two/PROTOCOL.RTF": r"{\rtf1 only two}", "two/protocol.txt": "not the last", "one/files/protocol.txt": "a file like others"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(body)
    jobs = files.jobs_below(spark, str(tmp_path))
    assert {r["job_dir"]: (r["bde_threshold"], r["rules_version"], r["protocol_text"]) for r in jobs.collect()} == {"one": (1, "9", "only one"), "two": (None, None, "not the last")}
    rows = files.with_jobs(files.extracted(files.scan(spark, str(tmp_path)).filter(F.col("rel_path").contains("/files/"))), jobs)
    assert {(r["rel_path"], r["job_rules_version"]) for r in rows.collect()} == {("one/files/a.txt", "9"), ("one/files/protocol.txt", "9"), ("two/files/deep/b.txt", None), ("three/files/c.txt", None)}
    judge = lambda prompt: {"responsive": "only one" in prompt, "responsiveness": "clear_yes" if "not the last" in prompt else "", "tokens": len(prompt.split("\n"))}
    got = {r["rel_path"]: (r["llm_responsive"], r["is_bde"], r["s2_llm_responsiveness"]) for r in inventory(rows, Settings(protocol_text="general"), Services(judge=judge, stage2=judge)).collect()}
    assert got["one/files/a.txt"] == ("yes", True, "") and got["two/files/deep/b.txt"][:2] == ("no", False) and got["three/files/c.txt"][:2] == ("no", False)


def test_bytes_are_handed_on_together(tmp_path, monkeypatch):
    """Small files share a batch, up to READ_BATCH bytes; one that is gone is a row with a problem."""
    import pyarrow as pa

    from paperlane.sources import files

    for i in range(5):
        (tmp_path / f"{i}").write_bytes(b"x" * i)
    rows = [{"rel_path": f"{i}", "place": str(tmp_path / f"{i}").encode(), "problem": "seen" if i == 2 else None} for i in range(6)]
    batch = pa.RecordBatch.from_pylist(rows, schema=pa.schema([("rel_path", pa.string()), ("place", pa.binary()), ("problem", pa.string())]))
    got = list(files._read(iter([batch]), str(tmp_path), 9, ("rel_path",)))
    assert [b.num_rows for b in got] == [6]
    assert [(r["content"], r["problem"]) for r in got[0].to_pylist()] == [(b"", None), (b"x", None), (None, "seen"), (b"xxx", None), (b"xxxx", None), (None, "FileNotFoundError")]
    monkeypatch.setattr(files, "READ_BATCH", 3)
    assert [b.num_rows for b in files._read(iter([batch]), str(tmp_path), 9, ("rel_path",))] == [4, 1, 1]


def test_a_wide_folder_takes_no_more_memory(tmp_path):
    """A walk holds the folders it is in, not the names of all that are to come; nor does the driver, where there are too many to open."""
    import tracemalloc

    def peak(n):
        root = tmp_path / str(n)
        for i in range(n):
            (root / f"c{i}").mkdir(parents=True)
        (root / "c7/a.txt").write_text("x")
        tracemalloc.start()
        rows = [r for b in listing.listed(str(root), listing.Prefix(str(root).encode(), True)) for r in b.column("rel_path").to_pylist()]
        shut = [(p.folder, p.whole) for p in listing.prefixes(str(root), 2)]
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == ["c7/a.txt"] and shut == [(str(root).encode(), True)]
        return most

    peak(200)  # what is loaded once
    assert peak(8000) < peak(2000) + 150_000


def test_a_deep_tree_keeps_few_folders_open(tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "OPEN", 3)
    deep = tmp_path / "/".join("abcdefgh")
    deep.mkdir(parents=True)
    for folder in (deep, *list(deep.parents)[:8]):
        (folder / "x.txt").write_text("x")
    got = [r for b in listing.listed(str(tmp_path), listing.Prefix(str(tmp_path).encode(), True)) for r in b.column("rel_path").to_pylist()]
    assert sorted(got) == sorted("/".join([*"abcdefgh"[:n], "x.txt"]) for n in range(9))
