"""Decisions, the inventory, files and outside calls."""

import io
import zipfile
from email.message import EmailMessage

from pyspark.sql import functions as F

from paperlane.operators import reports, route
from paperlane.operators.enrich import Calls
from paperlane.operators.pipeline import Services, inventory
from paperlane.plans.rules import RuleList
from paperlane.plans.schema import EXTRACTED_SCHEMA, INVENTORY, INVENTORY_SCHEMA, LANES, LEGACY, META
from paperlane.plans.settings import Settings
from paperlane.sources import extract, files, sinks


QUICK = Calls(pause_s=0.001)


def file(name, text="", size=100, **meta):
    ext = name[name.rfind("."):] if "." in name else ""
    return (name, name.split("/")[-1], ext, size, text, tuple(({"text_extractable": "text"} | meta).get(n) for n in META.names))


def inv_of(spark, rows, settings=Settings(), services=Services()):
    df = spark.createDataFrame(rows, EXTRACTED_SCHEMA)
    return {r["rel_path"]: r.asDict() for r in inventory(df, settings, services).collect()}


def test_schema():
    assert len(INVENTORY) == 49 and len(LEGACY) == 27 and LEGACY[-1] == "detail" and len(LANES) == 11
    assert sum(n.startswith("s2_") for n in INVENTORY) == 10


def test_buckets(spark):
    n = spark.createDataFrame([(i,) for i in (0, 10, 15, 20, 21, 50, 51, 75, 100, 101)], "n int")
    assert [r[0] for r in n.orderBy("n").select(route.bucket_of(F.col("n"), (10, 20, 50, 100))).collect()] == ["0-10", "0-10", "10-20", "10-20", "20-50", "20-50", "50-100", "50-100", "50-100", "100+"]
    p = spark.createDataFrame([(3,), (0,), (60,), (5,), (None,)], "n int")
    assert sorted(r[0] for r in p.select(route.complexity_bucket(F.col("n"))).collect()) == ["1-4 pages", "1-4 pages", "1-4 pages", "5-10 pages", "51+ pages"]


def test_roster(spark):
    cases = [(3, 500, True, 51, 500), (40, 55, True, 51, 55), (0, 500, True, 51, 500), (60, 500, True, 51, 60), (3, 30, True, 51, 3), (3, 500, False, 51, 3), (3, 500, True, 0, 3)]
    got = spark.range(1).select(*(route.roster_estimate(F.lit(b), F.lit(t), F.lit(s), F.lit(n)).alias(f"c{i}") for i, (b, t, s, n, _) in enumerate(cases))).first()
    assert list(got) == [c[-1] for c in cases]


def test_ambiguity_and_lanes(spark):
    got = inv_of(spark, [
        file("ssn.txt", "SSN 123-45-6789"), file("none.txt", "policy text"), file("mail.txt", "a@b.org"), file("money.txt", "total $5.00"),
        file("roster.csv", "x", is_structured=True, structured_entity_rows=60, structured_total_rows=60),
        file("rows.csv", "x", is_structured=True, structured_entity_rows=2, structured_total_rows=9),
        file("bare.csv", "x", is_structured=True, structured_entity_rows=3, structured_total_rows=500),
        file("dark.xlsx", "", 50_000, is_structured=True), file("small.xlsx", "", 1000, is_structured=True),
        file("scan.pdf", text_extractable="image_only", page_or_sheet_count=7), file("bad.pdf", text_extractable="pdf_unreadable"),
        file("old.doc", text_extractable="needs_conversion", status="no_parser"), file("old.xls", text_extractable="needs_conversion", status="no_parser", is_structured=True), file("m.msg", text_extractable="unknown", status="no_parser"), file("a.zip", text_extractable="none", status="container", detail="expand_first"),
        file("x.dwg", text_extractable="unknown", status="no_parser", detail="unsupported_ext"), file("big.txt", text_extractable="", status="skipped_too_large"), file("err.docx", text_extractable="", status="error", detail="KeyError"), file("blank.txt", "  "),
    ])
    lanes = {k: v["suggested_lane"] for k, v in got.items()}
    assert lanes == {
        "ssn.txt": "standard", "none.txt": "likely_non_responsive", "mail.txt": "standard", "money.txt": "likely_non_responsive", "roster.csv": "structured_bde", "rows.csv": "standard", "bare.csv": "structured_bde",
        "dark.xlsx": "structured_unreadable", "small.xlsx": "likely_non_responsive", "scan.pdf": "nonsearchable_sample", "bad.pdf": "nonsearchable_sample", "old.doc": "convert_lane", "old.xls": "convert_lane", "m.msg": "needs_parser", "a.zip": "container_expand", "x.dwg": "needs_parser",
        "big.txt": "manual_oversize", "err.docx": "review_error", "blank.txt": "likely_non_responsive"}
    assert {k: got[k]["ambiguity"] for k in ("ssn.txt", "none.txt", "mail.txt", "money.txt", "rows.csv", "scan.pdf")} == {"ssn.txt": "clear_responsive", "none.txt": "clear_non_responsive", "mail.txt": "ambiguous", "money.txt": "clear_non_responsive", "rows.csv": "ambiguous", "scan.pdf": ""}
    assert got["bare.csv"]["detail"] == "roster_by_rowcount" and got["bare.csv"]["estimated_entities"] == 500
    assert got["scan.pdf"]["complexity_bucket"] == "5-10 pages" and got["x.dwg"]["complexity_bucket"] == ""
    # a reader that could not read is not an early end: such rows keep a bucket and a reason of their own
    assert all((got[k]["complexity_bucket"], got[k]["s2_skip_reason"]) == ("1-4 pages", "not_searchable") for k in ("old.doc", "old.xls", "m.msg")) and got["x.dwg"]["s2_skip_reason"] == "no_parser"
    assert all(v["s2_ran"] or v["s2_skip_reason"] for v in got.values())
    assert got["err.docx"]["s2_skip_reason"] == "extract_error" and got["scan.pdf"]["s2_skip_reason"] == "not_searchable" and got["none.txt"]["s2_skip_reason"] == "stage1_nr"
    assert not any("123-45" in str(v) or "a@b" in str(v) for row in got.values() for v in row.values())  # no matched value leaves


def test_one_narrow_stage(spark):
    plan = inventory(spark.createDataFrame([file("a.txt", "x")], EXTRACTED_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan


def test_model_calls(spark):
    def judge(text):
        if "boom" in text:
            raise KeyError("x")
        return {"responsive": "good" in text, "names": ["A"], "person_count": 70 if "many" in text else 0, "tokens": 5}

    rows = [file("good.txt", "a@b.org good"), file("bad.txt", "a@b.org bad"), file("boom.txt", "a@b.org boom"), file("many.txt", "a@b.org good many"), file("plain.txt", "policy")]
    got = inv_of(spark, rows, services=Services(judge=judge))
    assert {k: (v["llm_consulted"], v["llm_responsive"], v["suggested_lane"]) for k, v in got.items()} == {
        "good.txt": (True, "yes", "standard"), "bad.txt": (True, "no", "likely_non_responsive"), "boom.txt": (False, "", "standard"), "many.txt": (True, "yes", "bde"), "plain.txt": (False, "", "likely_non_responsive")}
    assert got["boom.txt"]["detail"] == "llm_failed:KeyError" and got["many.txt"]["estimated_entities"] == 70 and got["good.txt"]["entities_found"] == "Name | Email" and got["good.txt"]["llm_tokens_total"] == 5


def test_people_counter(spark):
    calls = Services(count_people=lambda t: {"person_count": 614, "is_roster": "roster" in t, "tokens": 2})
    rows = [file("s.csv", "roster", is_structured=True), file("t.csv", "table", is_structured=True, structured_entity_rows=90, structured_total_rows=90), file("few.txt", "a@b.org c@d.org"), file("blank.csv", " ", is_structured=True)]
    got = inv_of(spark, rows, services=calls)
    assert {k: (v["bde_person_count"], v["is_bde"]) for k, v in got.items()} == {"s.csv": (614, True), "t.csv": (614, True), "few.txt": (0, False), "blank.csv": (0, False)}
    assert got["s.csv"]["detail"] == "bde_llm_count_roster"

    def fails(text):
        raise ValueError

    assert inv_of(spark, rows[:1], services=Services(count_people=fails))["s.csv"]["detail"] == "bde_count_failed:ValueError"


LEVELS = [("clear_yes", "yes", ""), ("likely_yes", "yes", ""), ("borderline", "no", ""), ("clear_no", "no", ""), ("odd", "yes", "unknown_level:odd"), ("legacy_true", "yes", "legacy_boolean"), ("legacy_false", "no", "legacy_boolean")]


def test_stage2_levels(spark):
    def grade(text):
        level = text.split()[-1]
        return ({"responsive": level == "legacy_true"} if level.startswith("legacy") else {"responsiveness": level}) | {"tokens": 3}

    got = inv_of(spark, [file(level, f"a@b.org {level}") for level, _, _ in LEVELS], services=Services(stage2=grade))
    assert [(n, got[n]["s2_llm_responsive"], got[n]["s2_detail"]) for n, _, _ in LEVELS] == LEVELS
    assert all(r["s2_llm_tokens"] == 3 and r["suggested_lane"] == "standard" for r in got.values())


def test_stage2_without_model(spark):
    r = inv_of(spark, [file("a.txt", "a@b.org")])["a.txt"]
    assert (r["s2_detail"], r["s2_llm_responsive"], r["s2_llm_consulted"]) == ("no_llm:rules_fallback", "yes", False)
    assert inv_of(spark, [file("a.txt", "a@b.org")], Settings(use_stage2=False))["a.txt"]["s2_skip_reason"] == "stage2_disabled"
    assert inv_of(spark, [file("a.txt", "policy")], Settings(stage2_on_all=True), Services(stage2="offline"))["a.txt"]["s2_llm_responsiveness"] == "borderline"


def test_ocr(spark):
    def ocr(path):
        if "bad" in path:
            raise OSError
        return {"text": "SSN 123-45-6789", "pages": 3}

    got = inv_of(spark, [file("good.png", text_extractable="image_only"), file("bad.png", text_extractable="image_only"), file("t.txt", "x")], services=Services(ocr=ocr, calls=QUICK))
    assert {k: (v["searchable"], v["ocr"], v["ocr_attempted"], v["di_calls"]) for k, v in got.items()} == {"good.png": (True, True, True, 1), "bad.png": (False, False, True, 1), "t.txt": (True, False, False, 0)}
    assert got["bad.png"]["detail"] == "ocr_failed:OSError" and got["good.png"]["ocr_pages"] == 3


def test_embedded_images(spark):
    def read(image):
        if image.startswith(b"bad"):
            raise OSError
        return "SSN 123-45-6789" if image.startswith(b"ssn") else ""

    big = b"x" * 1024
    rows = [file("a.pdf", "policy", content_images=[(1, b"ssn" + big), (1, b"bad" + big), (3, b"nothing" + big), (4, b"small"), (7, b"ssn" + big)]), file("b.pdf", "policy", content_images=[(1, b"small")]), file("c.pdf", "policy"), file("d.pdf", text_extractable="image_only", content_images=[(1, b"ssn" + big)])]
    got = inv_of(spark, rows, services=Services(ocr_image=read, calls=QUICK))
    assert {k: (v["img_ocr_qualifying"], v["img_ocr_calls"], v["img_ocr_ok"], v["di_calls"], v["suggested_lane"]) for k, v in got.items()} == {
        "a.pdf": (5, 4, 2, 4, "standard"), "b.pdf": (1, 0, 0, 0, "likely_non_responsive"), "c.pdf": (0, 0, 0, 0, "likely_non_responsive"), "d.pdf": (0, 0, 0, 0, "nonsearchable_sample")}
    assert got["a.pdf"]["detail"] == "img_ocr:p1,p7(2/5,+30chars) img_ocr_failed:OSErrorx1"
    off = inv_of(spark, rows[:1])["a.pdf"]
    assert (off["img_ocr_qualifying"], off["img_ocr_calls"], off["di_calls"]) == (5, 0, 0)


def _zip(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in parts.items():
            z.writestr(name, body)
    return out.getvalue()


XLSX = {
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>',
    "xl/sharedStrings.xml": '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>Control ID</t></si><si><t>Total Entities</t></si><si><t>a.pdf</t></si></sst>',
    "xl/worksheets/sheet1.xml": '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row><c r="A2" t="s"><v>2</v></c><c r="B2"><v>12</v></c></row></sheetData></worksheet>',
}


def test_folder_scan(spark, tmp_path):
    mail = EmailMessage()
    mail["Subject"] = "Hello"
    mail.set_content("my ssn: 123-45-6789")
    mail.add_attachment(b"x", maintype="application", subtype="octet-stream", filename="x.bin")
    (tmp_path / "sub").mkdir()
    bodies = {
        "ssn.txt": b"SSN 123-45-6789", "sub/policy.txt": b"policy on passports", "roster.csv": b"name,mail\n" + b"".join(b"n%d,p%d@x.org\n" % (i, i) for i in range(60)), "empty.txt": b"", "draw.dwg": b"?", "page.html": b"<p>a@b.org</p>",
        "note.eml": mail.as_bytes(), "w.docx": _zip({"word/document.xml": "<w>Dear <b>Ann</b> Lee</w>"}), "b.xlsx": _zip(XLSX), "broken.docx": b"no zip", "bomb.docx": _zip({"word/document.xml": "0" * 5_000_000}), "s.pptx": _zip({"ppt/slides/slide1.xml": "<a>hi</a>"}), "o.odt": _zip({"content.xml": "<a>open</a>"}),
        "p.png": b"x", "z.zip": b"x", "f.pdf": b"%PDF /Type /Page /Type /Pages /Type /Page "}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    rows = files.extracted(files.scan(spark, f"file://{tmp_path}"))
    got = {r["rel_path"]: r.asDict() for r in inventory(rows).collect()}
    assert set(got) == set(bodies)
    lanes = {k: v["suggested_lane"] for k, v in got.items()}
    assert lanes["ssn.txt"] == "standard" and lanes["roster.csv"] == "structured_bde" and lanes["draw.dwg"] == "needs_parser" and lanes["broken.docx"] == lanes["bomb.docx"] == "review_error" and lanes["z.zip"] == "container_expand" and lanes["p.png"] == "nonsearchable_sample"
    assert got["note.eml"]["attachment_count"] == 1 and "SSN" in got["note.eml"]["entities_found"] and got["w.docx"]["entities_found"] == "Name" and got["roster.csv"]["estimated_entities"] == 60
    assert got["bomb.docx"]["detail"] == "ZipBomb" and got["broken.docx"]["status"] == "error" and got["f.pdf"]["status"] in ("no_parser", "ok")
    assert extract.pdf_pages_raw(bodies["f.pdf"]) == 2
    # the inventory goes through CSV unchanged, and a second run has nothing left to do
    inv = inventory(rows)
    sinks.write_csv(inv, str(tmp_path / "inv"))
    back = sinks.read_csv(spark, str(tmp_path / "inv"))
    assert back.schema.simpleString() == INVENTORY_SCHEMA.simpleString() and back.exceptAll(inv).count() == 0 and reports.todo(inv.select("rel_path"), back).count() == 0
    assert sinks.archive(back, str(tmp_path / "archive")) == len(bodies)


def test_sheets_and_json(spark, tmp_path):
    (tmp_path / "e.xlsx").write_bytes(_zip(XLSX))
    assert [tuple(r) for r in sinks.read_export(spark, str(tmp_path / "e.xlsx")).collect()] == [("a.pdf", "12")]
    (tmp_path / "g.csv").write_text("﻿File Name,Final Determination\na.txt,R\n")
    assert [tuple(r) for r in sinks.read_gold(spark, str(tmp_path / "g.csv")).collect()] == [("a.txt", "R", "")]
    assert sinks.combined_json(['{"a": 1, "b": 2} trailing', '{"a": 3}']) == {"a": 3, "b": 2}


def test_job_thresholds(spark):
    jobs = spark.createDataFrame([("in/job1", 1)], "job_dir string, bde_threshold int")
    rows = files.with_jobs(spark.createDataFrame([file("in/job1/files/a.txt", "a@b.org"), file("in/job2/files/a.txt", "a@b.org")], EXTRACTED_SCHEMA), jobs)
    got = {r["rel_path"]: r["is_bde"] for r in inventory(rows).collect()}
    assert got == {"in/job1/files/a.txt": True, "in/job2/files/a.txt": False}


def test_no_rules(spark):
    got = inv_of(spark, [file("a.txt", "word")], Settings(rules=RuleList(rules=())))
    assert got["a.txt"]["suggested_lane"] == "likely_non_responsive"


def test_manifest_and_shell(spark, tmp_path, capsys):
    import json

    from paperlane import cli

    (tmp_path / "in").mkdir()
    for name, body in {"ssn.txt": "SSN 123-45-6789", "policy.txt": "policy", "scan.png": "x"}.items():
        (tmp_path / "in" / name).write_text(body)
    inv, gold = str(tmp_path / "inv"), tmp_path / "gold.csv"
    cli.main(["scan", f"file://{tmp_path}/in", inv], spark)
    (made,) = [p for p in (tmp_path / "inv-manifest").iterdir() if p.suffix == ".json"]
    manifest = json.loads(made.read_text())
    assert manifest["counters"]["files"] == 3 and manifest["lanes"] == {"likely_non_responsive": 1, "nonsearchable_sample": 1, "standard": 1} and len(manifest["rules_sha256"]) == 64
    cli.main(["scan", f"file://{tmp_path}/in", str(tmp_path / "again"), "--resume", inv], spark)
    assert sinks.read_csv(spark, str(tmp_path / "again")).count() == 0
    cli.main(["report", inv, str(tmp_path / "table")], spark)
    cli.main(["sample", inv, str(tmp_path / "sample")], spark)
    gold.write_text("file name,responsive\nssn.txt,yes\npolicy.txt,no\n")
    capsys.readouterr()
    cli.main(["benchmark", inv, str(gold)], spark)
    assert json.loads(capsys.readouterr().out)["responsive_f1"] == 1.0
    cli.main(["diff", inv, inv], spark)
    shown = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert shown[0]["view"] == "rules_decided" and shown[0]["moved"] == 0 and {r["view"] for r in shown} == {"rules_decided", "verdicts"}  # nothing differs
