"""From extracted documents to the inventory: one row of 49 columns for each, in one narrow stage.

``extracted`` rows are (rel_path, file_name, ext, size_bytes, text, meta). Without outside calls there is no shuffle
and no Python: scan, detection, routing and stage 2 are one projection chain. With calls the extracted rows (for OCR) and
the detected rows (for a model) are each written once, and what follows reads these.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.detectors import as_read
from ..functions.text import sample_for_model
from ..plans.schema import COLUMNS, META, NR_LANE
from ..plans.settings import Settings
from ..shared import written
from . import detect, enrich, route


PROTOCOL_CHARS = 8000  # fixed value: characters of a protocol that a model gets


@dataclass(frozen=True)
class Services:
    """Outside calls; each may be missing. stage2 may be ``"offline"`` for the keyword grading."""

    ocr: Callable[[str], dict] | None = None
    ocr_image: Callable[[bytes], str] | None = None
    judge: enrich.ModelFn | None = None
    count_people: enrich.ModelFn | None = None
    stage2: enrich.ModelFn | str | None = None
    calls: enrich.Calls = enrich.Calls()


def inventory(extracted: DataFrame, settings: Settings = Settings(), services: Services = Services()) -> DataFrame:
    """The inventory of extracted documents. A job's own threshold and protocol may come as columns ``job_bde_threshold`` and ``job_protocol`` (``files.with_jobs``)."""
    return _decided(_scanned(extracted, settings, services), settings, services)


def inventories(extracted: DataFrame, runs: list[Settings], services: Services = Services()) -> list[DataFrame]:
    """An inventory for each of several settings that read the same text by the same rules: it is scanned once and what was found is written once."""
    if any((s.rules, s.max_scan_chars) != (runs[0].rules, runs[0].max_scan_chars) for s in runs):
        raise ValueError("runs that are scanned together have the same rules and the same limit of text")
    found = _scanned(extracted, runs[0], services).drop("text")
    found = written(found if _asks(services) else found.drop("scanned"), "scanned")
    return [_decided(found, s, services) for s in runs]


def _asks(services: Services) -> bool:
    """Whether a model gets to see text."""
    return bool(services.judge or services.count_people or services.stage2 and services.stage2 != "offline")


def _scanned(extracted: DataFrame, settings: Settings, services: Services) -> DataFrame:
    """What does not depend on thresholds: OCR, detection and what else the text itself says."""
    c, rules = F.col, settings.rules
    df = extracted.filter("true")
    if "job_bde_threshold" not in df.columns:
        df = df.withColumn("job_bde_threshold", F.lit(None).cast("int"))
    if services.ocr or services.ocr_image:
        df = enrich.numbered(df, "extracted")
    df = enrich.recognised(df, services.ocr, services.calls)
    df = enrich.images_read(df, services.ocr_image, settings.max_scan_chars, services.calls)
    meta = {f.name: c(f"meta.{f.name}") for f in META}
    # rows that no reader got to see; a reader's own no_parser (legacy formats, missing libraries) goes on to routing
    early = F.coalesce(meta["status"].isin("skipped_too_large", "timeout", "error") | (meta["status"] == "no_parser") & (meta["detail"] == "unsupported_ext"), F.lit(False))
    df = df.withColumns({
        "early": early,
        "status": F.coalesce(meta["status"], F.lit("ok")),
        "text_extractable": F.coalesce(meta["text_extractable"], F.when(early, "").otherwise("text")),
        "is_structured": F.coalesce(meta["is_structured"], F.lit(False)),
        "page_or_sheet_count": F.coalesce(meta["page_or_sheet_count"], F.lit(0)),
        "attachment_count": F.coalesce(meta["attachment_count"], F.lit(0)),
        "estimate_truncated": F.coalesce(meta["estimate_truncated"], F.lit(False)),
        "structured_entity_rows": meta["structured_entity_rows"],
        "structured_total_rows": meta["structured_total_rows"],
        "ocr_attempted": F.coalesce(meta["ocr_attempted"], F.lit(False)),
        "ocr": F.coalesce(meta["ocr"], F.lit(False)),
        "ocr_pages": F.coalesce(meta["ocr_pages"], F.lit(0)),
        "img_decode_failed": F.coalesce(meta["pdf_images_decode_failed"], F.lit(0)),
        "meta_detail": F.coalesce(meta["detail"], F.lit("")),
    }).drop("meta")
    df = df.withColumn("searchable", (c("text_extractable") == "text") & ~c("early"))
    df = df.withColumns({
        "text": F.substring("text", 1, settings.max_scan_chars),
        "programmatic": c("is_structured"),
    })
    df = df.withColumn("di_calls", c("ocr_attempted").cast("int") + c("img_ocr_calls"))
    # ---- stage 1: detection, of searchable files only
    df = df.withColumn("scanned", F.when(c("searchable"), F.coalesce("text", F.lit(""))).otherwise(F.lit("")))
    df = detect.detected(df, rules, "scanned")
    df = df.withColumn("blank", route.is_blank(as_read(c("scanned"), rules)))
    return df.withColumn("offline_level", route.offline_level(c("scanned"))) if services.stage2 == "offline" else df


def _decided(df: DataFrame, settings: Settings, services: Services) -> DataFrame:
    """The inventory of scanned documents."""
    c, rules = F.col, settings.rules
    df = df.withColumn("threshold", F.coalesce("job_bde_threshold", F.lit(settings.bde_threshold)))
    df = df.withColumn("base_estimate", route.estimate_entities(rules))
    review = F.lit(settings.structured_review_rows) if settings.structured_review_rows else c("threshold")
    total = F.when(c("is_structured"), F.coalesce("structured_total_rows", F.lit(0))).otherwise(0)
    bumped = route.roster_estimate(c("base_estimate"), total, c("is_structured"), review)
    df = df.withColumn("estimated_entities", F.when(c("searchable"), bumped).otherwise(0))
    ssn = c(detect.count_column("SSN")) if any(r.key == "SSN" for r in rules.rules) else F.lit(0)
    kind = route.classify_ambiguity(ssn, c("labels"), c("is_structured"), c("estimated_entities"), total)
    decode = F.when((c("img_decode_failed") > 0) & (c("img_ocr_qualifying") == 0), F.format_string("img_decode_failed:%d(pillow?)", "img_decode_failed"))
    df = df.withColumns({
        "ambiguity": F.when(c("searchable"), kind).otherwise(""),
        "entities_found": F.array_join("labels", " | "),
        "pi_categories": F.array_join("categories", " | "),
        "detail": route.notes(c("img_note"), decode, c("meta_detail"), F.when(c("searchable") & (c("estimated_entities") != c("base_estimate")), "roster_by_rowcount")),
    }).drop("base_estimate", "meta_detail", "img_note", "labels", "categories", *(detect.count_column(r.key) for r in rules.rules))
    # ---- the model on ambiguous files, then the counter of people
    if _asks(services):
        # what follows needs no text but a sample of each that may be asked about
        own = F.nullif("job_protocol", F.lit("")) if "job_protocol" in df.columns else F.lit(None)
        rules_of = F.substring(F.coalesce(own, F.lit(settings.protocol_text)), 1, PROTOCOL_CHARS)
        protocol = F.when(rules_of != "", F.concat(F.lit("Protocol of the matter, to be applied:\n"), rules_of, F.lit("\n\n"))).otherwise("")
        prompt = F.concat(protocol, sample_for_model(c("scanned"), settings.llm_input_chars))
        df = df.withColumn("prompt", F.when(c("searchable") & ~c("blank"), prompt))
        df = enrich.numbered(df.drop("text", "scanned", "call_id", "job_protocol"), "detected")
    prompt = c("prompt") if "prompt" in df.columns else F.lit("")
    df = enrich.asked(df, c("ambiguity") == "ambiguous", services.judge, "judged", prompt, services.calls)
    j = c("judged")
    answered = j.isNotNull() & j["failed"].isNull()
    people = F.when(j["person_count"] > 0, j["person_count"]).otherwise(j["n_names"])
    named = F.when(c("entities_found") == "", "Name").otherwise(F.concat(F.lit("Name | "), c("entities_found")))
    df = df.withColumns({
        "llm_consulted": answered,
        "llm_responsive": F.when(answered, F.when(j["responsive"], "yes").otherwise("no")).otherwise(""),
        "judge_tokens": F.when(answered, j["tokens"]).otherwise(0),
        "detail": route.notes(c("detail"), F.concat(F.lit("llm_failed:"), j["failed"])),
        "estimated_entities": F.when(answered & (people > c("estimated_entities")), people).otherwise(c("estimated_entities")),
        "entities_found": F.when(answered & (j["n_names"] > 0) & ~c("entities_found").contains("Name"), named).otherwise(c("entities_found")),
    }).drop("judged")
    floor = settings.bde_count_floor
    gate = c("searchable") & ~c("blank") & (c("is_structured") | (c("estimated_entities") >= floor))
    hint = F.when(c("estimated_entities") >= floor, F.format_string("This file has about %d rows; the text may be a part of it.\n\n", "estimated_entities")).otherwise("")
    df = enrich.asked(df, gate, services.count_people, "people", F.concat(hint, prompt), services.calls)
    p = c("people")
    counted = p.isNotNull() & p["failed"].isNull()
    n = F.greatest(p["person_count"], F.lit(0))
    tier = F.when(counted & p["is_roster"], F.greatest(n, c("estimated_entities"))).when(counted, n).otherwise(c("estimated_entities"))
    df = df.withColumns({
        "bde_person_count": F.when(counted, n).otherwise(0),
        "llm_tokens": c("judge_tokens") + F.when(counted, p["tokens"]).otherwise(0),
        "detail": route.notes(c("detail"), F.concat(F.lit("bde_count_failed:"), p["failed"]), F.when(counted, F.when(p["is_roster"], "bde_llm_count_roster").otherwise("bde_llm_count"))),
        "is_bde": c("searchable") & (tier >= c("threshold")),
        "was_counted": counted,
    }).drop("people")
    df = df.withColumns({
        "bde_confirmed": c("is_bde") if settings.confirm_heuristic_bde else c("is_bde") & c("was_counted"),
        "entity_bucket": F.when(c("searchable"), route.bucket_of(c("estimated_entities"), rules.bucket_edges)).otherwise(""),
        "complexity_bucket": F.when(~c("searchable") & ~c("early"), route.complexity_bucket(c("page_or_sheet_count"))).otherwise(""),
    })
    df = df.withColumn("suggested_lane", route.choose_lane(settings.unreadable_bytes))
    df = df.withColumns({"nr_stage1": c("suggested_lane") == NR_LANE, "bde_stage1": c("is_bde")})
    df = _stage2(df, settings, services)
    df = df.withColumns({"elapsed_s": F.lit(0.0), "llm_tokens_total": c("llm_tokens") + c("s2_llm_tokens")})
    return df.select(*(F.col(name).cast(kind) for name, kind in COLUMNS))


def _stage2(df: DataFrame, settings: Settings, services: Services) -> DataFrame:
    """Grades what stage 1 did not clear; writes only its own columns."""
    c = F.col
    cleared = c("nr_stage1") if not settings.stage2_on_all else F.lit(False)
    early_reason = F.when(c("status") == "error", "extract_error").otherwise(c("status"))
    reason = (
        F.when(c("early"), early_reason).when(F.lit(not settings.use_stage2), "stage2_disabled").when(cleared, "stage1_nr")
        .when(~c("searchable"), "not_searchable").when(c("blank"), "no_text").otherwise("")
    )
    df = df.withColumn("s2_skip_reason", reason).withColumn("s2_ran", c("s2_skip_reason") == "")
    offline = services.stage2 == "offline"
    df = enrich.asked(df, c("s2_ran"), None if offline else services.stage2, "graded", c("prompt") if "prompt" in df.columns else F.lit(""), services.calls)
    g = c("graded")
    answered = c("s2_ran") if offline else c("s2_ran") & g.isNotNull() & g["failed"].isNull()
    level = F.when(answered, c("offline_level") if offline else F.coalesce(g["level"], F.lit(""))).otherwise("")
    df = df.withColumns({"s2_llm_consulted": answered, "s2_llm_responsiveness": level, "s2_legacy": F.lit(False) if offline else F.coalesce(g["responsive"], F.lit(False))})
    by_rules = c("value_signal") | (c("is_structured") & (c("estimated_entities") > 0))
    yes = F.when(c("s2_llm_consulted"), route.level_responsive(c("s2_llm_responsiveness"), c("s2_legacy"))).otherwise(by_rules)
    known = c("s2_llm_responsiveness").isin(*route.YES_LEVELS, *route.NO_LEVELS)
    note = (
        F.when(c("s2_llm_consulted") & known, "")
        .when(c("s2_llm_consulted") & (c("s2_llm_responsiveness") != ""), F.concat(F.lit("unknown_level:"), F.substring("s2_llm_responsiveness", 1, 24)))
        .when(c("s2_llm_consulted"), "legacy_boolean")
        .when(g["failed"].isNotNull(), F.concat(F.lit("llm_failed:"), g["failed"]))
        .otherwise("no_llm:rules_fallback")
    )
    threshold = F.lit(settings.s2_bde_threshold) if settings.s2_bde_threshold else c("threshold")
    df = df.withColumns({
        "s2_yes": yes,
        "s2_llm_tokens": F.coalesce(F.when(c("s2_llm_consulted"), g["tokens"]), F.lit(0)),
        "s2_detail": F.when(c("s2_ran"), note).otherwise(""),
        "s2_is_bde": c("s2_ran") & (c("estimated_entities") >= threshold),
    })
    lane = F.when(~c("s2_yes"), NR_LANE).when(c("s2_is_bde") & c("is_structured"), "structured_bde").when(c("s2_is_bde"), "bde").otherwise("standard")
    df = df.withColumns({
        "s2_llm_responsive": F.when(c("s2_ran"), F.when(c("s2_yes"), "yes").otherwise("no")).otherwise(""),
        "s2_lane": F.when(c("s2_ran"), lane).otherwise(""),
    })
    return df.withColumn("s2_nr", c("s2_lane") == NR_LANE)
