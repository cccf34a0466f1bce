"""Files that try to break a scan, readers beside the common ones, services in the plan, and round trips."""

import io
import json
import sys
import types
import zipfile
from datetime import datetime
from email.message import EmailMessage

import pytest
from pyspark.sql import functions as F

from paperlane import cli, shared
from paperlane.functions import detectors
from paperlane.functions.text import score_summary
from paperlane.operators import fleet, reports, score
from paperlane.operators.pipeline import Services, inventory
from paperlane.plans.schema import EXTRACTED_SCHEMA, META
from paperlane.plans.settings import Settings
from paperlane.sources import extract, files, sinks

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def counter(settings=Settings()):
    return extract.RowCounter(lambda line: "@" in line, lambda line: line.startswith("Miller, "), settings)


def workbook(rows, rels="worksheets/sheet1.xml"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="{rels}"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")
    return out.getvalue()


def cells(i, *values):
    return f'<row r="{i}">' + "".join(f'<c r="{chr(65 + k)}{i}" t="inlineStr"><is><t>{v}</t></is></c>' for k, v in enumerate(values)) + "</row>"


def test_hostile_files(spark, tmp_path):
    """A bad byte, a file over the limit, an archive over the reader's own limit and empty files are rows, never the end of a run."""
    (tmp_path / "in" / "deep" / "er").mkdir(parents=True)
    bodies = {"bad.txt": b"\xff\xfe SSN 123-45-6789 \xe2\x82 caf\xc3\xa9 \xef\xbf\xbd end", "big.txt": b"x" * 5000, "BIG.TXT": b"y" * 100, "huge.zip": b"z" * 9000, "video.mp4": b"v" * 9000, "deep/er/empty.txt": b"", "deep/empty.dwg": b"", "old.ppt": b"p", "old.xls": b"p", "old.doc": b"p", "m.msg": b"m"}
    for name, body in bodies.items():
        (tmp_path / "in" / name).write_bytes(body)
    settings = Settings(max_bytes=1000)
    found = files.scan(spark, f"file://{tmp_path}/in", settings=settings)
    assert found.filter("size_bytes > 1000 AND content IS NOT NULL").count() == 0
    rows = {r["rel_path"]: r for r in files.extracted(found, settings).collect()}
    assert set(rows) == set(bodies)
    assert rows["bad.txt"]["text"] == " SSN 123-45-6789  café � end" and rows["BIG.TXT"]["text"] == "y" * 100
    status = {k: r["meta"]["status"] for k, r in rows.items()}
    assert status["big.txt"] == "skipped_too_large" and status["huge.zip"] == "skipped_too_large" and status["video.mp4"] == "no_parser" and rows["big.txt"]["size_bytes"] == 5000
    got = {r["rel_path"]: r["suggested_lane"] for r in inventory(spark.createDataFrame(list(rows.values()), EXTRACTED_SCHEMA)).collect()}
    assert [got[k] for k in ("old.ppt", "old.xls", "old.doc", "m.msg", "deep/empty.dwg")] == ["convert_lane"] * 3 + ["needs_parser"] * 2
    assert got["deep/er/empty.txt"] == "likely_non_responsive" and got["bad.txt"] == "standard"


def test_file_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("mail a@b.org")
    (tmp_path / "in" / "b.mp4").write_text("x")
    rows = inventory(files.extracted(files.stream(spark, f"file://{tmp_path}/in")))
    rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r["rel_path"], r["suggested_lane"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a.txt", "standard"), ("b.mp4", "needs_parser")]


def test_large_workbooks():
    """Rows are read one by one: far more XML than the limit of characters, and more rows than the limit of rows."""
    data = workbook("".join(cells(i, f"name {i}", f"p{i}@x.org" if i % 3 else "Miller, Anna") for i in range(1, 90_001)))
    text, meta = extract.spreadsheet(data, counter(Settings(max_scan_chars=100_000)))
    assert meta["structured_total_rows"] == 90_000 and meta["structured_entity_rows"] == 60_000 and not meta["estimate_truncated"] and text.count("\n") == 49
    text, meta = extract.spreadsheet(data, counter(Settings(max_scan_rows=1000)))
    assert meta["structured_total_rows"] == 1000 and meta["estimate_truncated"] and meta["page_or_sheet_count"] == 1
    gap = extract.sheets(workbook(cells(2, "a") + '<row r="4"><c r="B4" t="b"><v>1</v></c></row>'))
    assert gap == [("S", [[], ["a"], [], ["", "True"]])]


def test_mail_parts():
    m = EmailMessage()
    m["Subject"] = "Hello"
    m.set_content("plain body")
    m.add_alternative("<p>html <b>body</b></p>", subtype="html")
    m.add_attachment("secret text", filename="inline.txt", disposition="inline")
    m.add_attachment(b"x", maintype="image", subtype="png", filename="p.png")
    text, meta = extract.mail(m.as_bytes(), Settings())
    assert meta["attachment_count"] == 2 and "secret" not in text and "plain body" in text and "html  body" in text and text.startswith("Hello\n")
    alone = EmailMessage()
    alone["Subject"] = "S"
    alone.set_content("<p>x</p>", subtype="html")
    assert extract.mail(alone.as_bytes(), Settings())[0].split() == ["S", "x"]


class _Obj(dict):
    def get_object(self):
        return self


class _Page:
    def __init__(self, text, pictures=(), images=()):
        self.text, self.images = text, images
        self.dict = {"/Resources": {"/XObject": _Obj({f"/I{i}": _Obj({"/Subtype": "/Image", "/Width": w, "/Height": h}) for i, (w, h) in enumerate(pictures)})}} if pictures else {}

    def get(self, key, default=None):
        return self.dict.get(key, default)

    def extract_text(self):
        if isinstance(self.text, Exception):
            raise self.text
        return self.text


class _Image:
    def __init__(self, name, size=None):
        self.name, self.size = name, size

    @property
    def image(self):
        if self.size is None:
            raise ImportError
        return self

    def convert(self, mode):
        return self

    def save(self, out, format):
        out.write(b"jpeg" + bytes(2000))


def _pypdf(monkeypatch, pages, fields=None, opened=None):
    def reader(data):
        if opened:
            opened()
        return types.SimpleNamespace(pages=pages, get_fields=lambda: fields)

    monkeypatch.setitem(sys.modules, "pypdf", types.SimpleNamespace(PdfReader=reader))


def test_pdf_kinds(monkeypatch):
    """Text, thin text layers over scans, pages that are images, form fields, images with text of their own, and files that do not open."""
    prose, s = "words of a page that has a text of its own " * 5, Settings()
    _pypdf(monkeypatch, [_Page(prose), _Page(ValueError())], {"Name": {"/V": "Ann Lee"}, "Empty": {"/V": None}})
    text, meta = extract.pdf(b"%PDF", s)
    assert meta["text_extractable"] == "text" and text.endswith("Name: Ann Lee") and meta["page_or_sheet_count"] == 2
    _pypdf(monkeypatch, [_Page("stamp")] * 4)
    assert extract.pdf(b"%PDF", s)[1]["text_extractable"] == "image_only"
    _pypdf(monkeypatch, [_Page(prose, [(1200, 1700)])] * 2 + [_Page(prose)])
    assert extract.pdf(b"%PDF", s)[1]["text_extractable"] == "image_only"
    _pypdf(monkeypatch, [_Page(prose, [(300, 90)])])
    assert extract.pdf(b"%PDF", s)[1]["text_extractable"] == "text" and extract.pdf(b"%PDF" + bytes(400_000), s)[1]["text_extractable"] == "image_only"
    images = [_Image("a", (450, 300)), _Image("a", (450, 300)), _Image("logo", (100, 100)), _Image("page", (900, 900)), _Image("bad")]
    _pypdf(monkeypatch, [_Page(prose, images=images)])
    meta = extract.pdf(b"%PDF", s)[1]
    assert [i["page"] for i in meta["content_images"]] == [1] and meta["content_images"][0]["jpeg"].startswith(b"jpeg")
    assert meta["pdf_images_decode_failed"] == 1 and meta["pdf_images_seen"] == 4
    better = [_Page(prose, images=[_Image("a", (10, 10)), _Image("b", (500, 200))]), _Page(prose, images=[_Image("a", (400, 100)), _Image("b", (500, 200))])]
    _pypdf(monkeypatch, better)
    meta = extract.pdf(b"%PDF", s)[1]
    assert [i["page"] for i in meta["content_images"]] == [1, 2] and meta["pdf_images_seen"] == 3
    _pypdf(monkeypatch, [_Page(prose)] * 9)
    text, meta = extract.pdf(b"%PDF", Settings(pdf_max_pages=3))
    assert meta["detail"] == "pdf_text_capped:3/9" and meta["page_or_sheet_count"] == 9
    import time

    _pypdf(monkeypatch, [], opened=lambda: time.sleep(5))
    got = extract.pdf(b"/Type /Page /Type/Page ", Settings(pdf_open_timeout_s=0.1))
    assert got == ("", {"text_extractable": "pdf_unreadable", "page_or_sheet_count": 2, "detail": "pdf_open_failed:TimeoutError"})


def test_optional_readers(monkeypatch):
    """Outlook files and old sheets through libraries that may be missing; a registry takes further parsers."""
    assert extract.outlook(b"", Settings())[1]["status"] == "no_parser" and extract.old_spreadsheet(b"", counter())[1] == {"text_extractable": "needs_conversion", "status": "no_parser", "is_structured": True}
    message = types.SimpleNamespace(subject="Sub", body="body", htmlBody=b'<a href="mailto:a@b.org">x</a><a href="tel:+123">y</a>', attachments=[1, 2], close=lambda: None)
    monkeypatch.setitem(sys.modules, "extract_msg", types.SimpleNamespace(Message=lambda data: message))
    text, meta = extract.outlook(b"", Settings())
    assert text.split("\n")[:2] == ["Sub", "body"] and "a@b.org" in text and "+123" in text and meta["attachment_count"] == 2
    sheet = types.SimpleNamespace(nrows=2, row_values=lambda i: ["Miller, Anna", 3.0] if i else ["x", "a@b"])
    monkeypatch.setitem(sys.modules, "xlrd", types.SimpleNamespace(open_workbook=lambda file_contents: types.SimpleNamespace(sheets=lambda: [sheet], nsheets=1)))
    assert extract.old_spreadsheet(b"", counter())[1]["structured_entity_rows"] == 2
    more = extract.Registry().with_parser("drawing", (".DWG",), lambda data, ext, rows, s: (f"drawing {ext} {len(data)}", {"text_extractable": "text"}))
    assert ".dwg" in more.opened() and ".zip" not in more.opened() and more.parsers["drawing"](b"ab", ".dwg", None, None)[0] == "drawing .dwg 2"


def test_registry_in_a_scan(spark, tmp_path):
    (tmp_path / "a.dwg").write_bytes(b"abc")
    more = extract.Registry().with_parser("drawing", (".dwg",), lambda data, ext, rows, s: (data.decode(), {"text_extractable": "text"}))
    (row,) = files.extracted(files.scan(spark, f"file://{tmp_path}", readers=more), readers=more).collect()
    assert row["text"] == "abc" and row["meta"]["status"] is None


def test_services_read_the_corpus_once(spark, tmp_path):
    """With all services the corpus is scanned once and its patterns run once; rows without an id of their own keep their answers."""
    rows = [("a.txt", "a.txt", ".txt", 9, f"mail a{i}@b.org", tuple({"text_extractable": "text"}.get(n) for n in META.names)) for i in range(3)] + [("s.png", "s.png", ".png", 9, "", tuple({"text_extractable": "image_only"}.get(n) for n in META.names))]
    spark.createDataFrame(rows, EXTRACTED_SCHEMA).repartition(1).write.parquet(str(tmp_path / "rows"))
    asked = []
    judge = lambda text: asked.append(text) or {"responsive": "a1@" in text, "names": ["x"], "person_count": 9, "tokens": 1}
    services = Services(ocr=lambda path: {"text": "SSN 123-45-6789", "pages": 2}, ocr_image=lambda b: "", judge=judge, count_people=judge, stage2=judge)
    out = inventory(spark.read.schema(EXTRACTED_SCHEMA).parquet(str(tmp_path / "rows")), Settings(protocol_text="only people count"), services)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 0 and str(tmp_path / "rows") not in plan and plan.count("Relation") <= 5
    got = sorted((r["rel_path"], r["llm_responsive"], r["s2_llm_responsive"], r["ocr"]) for r in out.collect())
    assert got == [("a.txt", "no", "", False), ("a.txt", "no", "", False), ("a.txt", "yes", "yes", False), ("s.png", "", "no", True)]


def test_csv_keeps_texts(spark, tmp_path):
    names = ['a"b, c\\.txt', " q .txt", 'x\n"y".txt', "é,;'.txt", '""', "\\"]
    meta = tuple({"text_extractable": "text"}.get(n) for n in META.names)
    inv = inventory(spark.createDataFrame([(n, n, ".txt", 1, "x", meta) for n in names], EXTRACTED_SCHEMA))
    sinks.write_csv(inv, str(tmp_path / "inv"))
    back = sinks.read_csv(spark, str(tmp_path / "inv"))
    assert {r["rel_path"] for r in back.collect()} == set(names) and back.exceptAll(inv).count() == 0 and reports.todo(inv.select("rel_path"), back).count() == 0


def test_header_below_a_banner(spark, tmp_path):
    (tmp_path / "e.xlsx").write_bytes(workbook(cells(1, "Export of entities", "made by hand") + cells(2, "x") + cells(3, "Control ID", "other", "Total Entities") + cells(4, "a.pdf", "", "1,200")))
    assert [tuple(r) for r in sinks.read_export(spark, str(tmp_path / "e.xlsx")).collect()] == [("a.pdf", "1,200")]
    with pytest.raises(ValueError):
        sinks.read_export(spark, str(tmp_path / "e.xlsx"), total_col="No such")
    gold = str(tmp_path / "g.xlsx")
    (tmp_path / "g.xlsx").write_bytes(workbook(cells(1, "Reviewed 2020", "by us") + cells(2, "File Name", "Responsive") + cells(3, "a.txt", "R")))
    assert [tuple(r) for r in sinks.read_gold(spark, gold).collect()] == [("a.txt", "R", "")]


def test_numbers_that_are_none(spark):
    words = spark.createDataFrame([(w,) for w in ("nan", "inf", "1e3", "-1", "x")], "w string")
    assert [r[0] for r in words.select(score.parse_responsive(F.col("w"))).collect()] == [False, True, True, False, None]


def test_addresses_in_linear_time(spark):
    """The pattern finds what the plain one finds, and a long text of capitalised words takes no time."""
    import re
    import time

    plain = r"\b[A-Z][A-Za-z.'\- ]+,\s*[A-Z]{2}\s+\d{5}(?:-\d{4})?\b"
    texts = ["Foo, Bar, IL 62704", "in Springfield, IL 62704-1234 and St. Paul,MN 55101, Ames, IA  50010", "5Springfield, IL 62704", "x A, IL 62704 A b, IL 62704", "no City, il 62704 or City, IL 6270", "New York, NY 10001New York, NY 10001", "O'Fallon-West B, MO 63366.", "a\nBig City, TX 75001", "City Town Village, TX 7500", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(F.regexp_extract_all("t", F.lit(detectors.CITY_ZIP), F.lit(1))).collect()]
    assert got == [re.findall(plain, t) for t in texts]
    start = time.time()
    long = spark.createDataFrame([(" ".join(["Capital"] * 200_000),)], "t string")
    assert long.select(detectors.count_addresses(F.col("t"))).first()[0] == 0 and time.time() - start < 20


def test_patterns_typed_out(spark):
    """Counts against patterns written here by hand, so a wrong constant in the rule list would show."""
    from paperlane.operators import detect
    from paperlane.plans.rules import RuleList

    text = "Dear Ann Lee, Mr. Bob Ray (name: Cy Dee) dob: 1/2/1990, ssn 123-45-6789 or 666-12-3456, card 4111 1111 1111 1111, mail A@b.org a@B.org, +1 (212) 555-0100, $5.00 and 7 EUR, 12 Main Street, Ames, IA 50010, passport no. X1234567, iban DE44500105175407324931, password"
    row = detect.counted(spark.createDataFrame([(text,)], "text string"), RuleList()).first().asDict()
    want = {"NAME": 3, "ADDRESS": 2, "EMAIL": 1, "PHONE": 1, "SSN": 1, "PASSPORT": 1, "DOB": 1, "CARD": 1, "BANK_ACCOUNT": 1, "CREDENTIALS": 1, "MONEY": 2, "HEALTH": 0, "TIN": 0}
    assert {k: row[f"c_{k}"] for k in want} == want


def test_sample_is_the_least_draws(spark):
    meta = tuple({"text_extractable": "image_only", "page_or_sheet_count": 1}.get(n) for n in META.names)
    inv = inventory(spark.createDataFrame([(f"f{i}.png", f"f{i}.png", ".png", 1, "", meta) for i in range(300)], EXTRACTED_SCHEMA))
    import hashlib

    want = sorted((f"f{i}.png" for i in range(300)), key=lambda p: hashlib.md5((p + "12345").encode()).hexdigest())
    for rate in (0.0, 0.05, 0.5, 1.0):
        got = {r["rel_path"] for r in reports.draw_sample(inv, rate).collect()}
        assert got == set(want[: max(1, -(-int(300 * rate * 1000) // 1000))])


def test_small_readers(spark, tmp_path):
    assert sinks.key_values("# c\nexport A = 'x y'\nB=\"1\"\nA=2\n\nnone\nC=a=b") == {"A": "x y", "B": "1", "C": "a=b"}
    printed = "STAGE 1\n scored 9\nPIPELINE\n  scored   1,234 (excluded: 5)\n  recall  0.75  F1 0.8\n TP=1,000 FP=2 FN=3 TN=4\nNR/R -- UNION\n  recall 0.1"
    row = spark.createDataFrame([(printed,), ("nothing",), (None,)], "t string").select(score_summary(F.col("t")).alias("m")).collect()
    assert row[0]["m"] == {"scored": "1234", "excluded": "5", "recall": "0.75", "f1": "0.8", "tp": "1000", "fp": "2", "fn": "3", "tn": "4"} and row[1]["m"] == {}
    df = shared.written(spark.range(3), "trial")
    assert df.count() == 3 and shared.removed(spark) >= 1 and not shared._made


def test_shell_of_jobs(spark, tmp_path, capsys):
    """collect, status, copy-sample and score, with and without truth."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("a@b.org")
    cli.main(["scan", f"file://{tmp_path}/in", str(tmp_path / "inv")], spark)
    inv = sinks.read_csv(spark, str(tmp_path / "inv"))
    task = ("j", "k", "a.txt", "completed", None, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1), 60_000, 1, "w", 5, 6, 7, [], None)
    spark.createDataFrame([task, ("j", "m", "b.txt", *task[3:])], fleet.TASK_SCHEMA).write.parquet(str(tmp_path / "tasks"))
    sinks.write_results(inv.withColumn("job_id", F.lit("j")), str(tmp_path / "results"))
    cli.main(["collect", str(tmp_path / "tasks"), str(tmp_path / "results"), str(tmp_path / "got")], spark)
    assert sinks.read_csv(spark, str(tmp_path / "got/inventory")).count() == 1 and spark.read.option("header", True).csv(str(tmp_path / "got/missing")).collect()[0][0] == "b.txt"
    capsys.readouterr()
    cli.main(["status", str(tmp_path / "tasks")], spark)
    shown = json.loads(capsys.readouterr().out)
    assert shown["total"] == 2 and shown["peak"] == 2 and shown["worker_names"] == ["w"]
    (tmp_path / "m.csv").write_text("rel_path,label\na.txt,good\nnone.txt,\n")
    cli.main(["copy-sample", str(tmp_path / "m.csv"), f"file://{tmp_path}/in", f"file://{tmp_path}/copy"], spark)
    assert (tmp_path / "copy/good/a.txt").read_text() == "a@b.org"
    cli.main(["score", str(tmp_path / "inv"), str(tmp_path / "card"), "--tasks", str(tmp_path / "tasks"), "--workbook", str(tmp_path / "card.xlsx")], spark)
    assert {n for n, _ in extract.sheets((tmp_path / "card.xlsx").read_bytes())} == {p.name for p in (tmp_path / "card").iterdir()}
    assert {p.name for p in (tmp_path / "card").iterdir()} == {"Run Info", "Summary", "Overview", "Timing", "Run Timeline", "Per-file Timing", "File Detail"}
    (tmp_path / "e.csv").write_text("Control ID,Total Entities\na.txt,3\n")
    sheets = score.sheets(inv.withColumn("row", F.lit(1)), sinks.read_export(spark, str(tmp_path / "e.csv")))
    assert len(sheets) == 12 and sheets["NR-R"].filter("view = 'stage1'").first()["tp"] == 1


def test_sheets_in_one_workbook(spark, tmp_path, monkeypatch):
    """Read back by the reader: kinds of values, order, characters that XML has not, clashing and long names, and tables longer than a sheet."""
    from decimal import Decimal

    from paperlane.sources import workbook

    one = spark.createDataFrame([(i, f"t{i} <&>\"\n é\u0001", i % 2 == 0, i / 4, [i]) for i in range(25)] + [(None, None, None, None, None)], "n long, t string, b boolean, d double, a array<int>").orderBy(F.desc_nulls_last("n"))
    two = spark.createDataFrame([(float("nan"), Decimal("1.50"), b"xy", datetime(2024, 1, 2))], "f double, m decimal(9,2), raw binary, at timestamp")
    path = f"file://{tmp_path}/deep/book.xlsx"
    assert workbook.write({"First": one, "a/b[c]" + "x" * 40: two, "FIRST": two.limit(0)}, path) == ["First", "a_b_c_" + "x" * 25, "FIRST (2)"]
    (_, rows), (_, other), (_, empty) = extract.sheets((tmp_path / "deep/book.xlsx").read_bytes())
    assert rows[0] == ["n", "t", "b", "d", "a"] and len(rows) == 27 and rows[1] == ["24", 't24 <&>"\n é\ufffd', "True", "6.0", "[24]"] and rows[2][2] == "False" and rows[-1] == [""] * 5
    assert other[1] == ["NaN", "1.50", "eHk=", "2024-01-02 00:00:00"] and empty == [["f", "m", "raw", "at"]]
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["book.xlsx"]
    out = io.BytesIO()
    monkeypatch.setattr(workbook, "MOST_ROWS", 10)
    book = workbook._Book(out, ["Long"])
    for cells in (["shead"], *([f"n{i}"] for i in range(25))):
        book.add(0, cells)
    assert book.close() == ["Long", "Long (2)", "Long (3)"]
    got = extract.sheets(out.getvalue())
    assert all(r[0] == ["head"] for _, r in got) and [x[0] for _, r in got for x in r[1:]] == [str(i) for i in range(25)]
