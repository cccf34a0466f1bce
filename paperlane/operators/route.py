"""Estimates, ambiguity, buckets and lanes as column expressions over an inventory row in the making."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.rules import RuleList
from ..plans.schema import NR_LANE
from .detect import count_column


def bucket_of(n: Column, edges: tuple[int, ...]) -> Column:
    """``previous-edge`` for the first edge that n does not exceed, else ``last+``."""
    out, low = None, 0
    for edge in edges:
        name = f"{low}-{edge}"
        out = F.when(n <= edge, name) if out is None else out.when(n <= edge, name)
        low = edge
    return out.otherwise(f"{low}+")


def complexity_bucket(pages: Column) -> Column:
    n = F.when(F.coalesce(pages, F.lit(0)) == 0, 1).otherwise(pages)
    return F.when(n <= 4, "1-4 pages").when(n <= 10, "5-10 pages").when(n <= 50, "11-50 pages").otherwise("51+ pages")


def estimate_entities(rules: RuleList) -> Column:
    """Rows with identifiers of a structured file; else the largest per-person count, 1 for any label at all."""
    most = F.greatest(F.lit(0), F.lit(0), *(F.col(count_column(k)) for k in rules.per_person))
    plain = F.when(most > 0, most).when(F.size("labels") > 0, 1).otherwise(0)
    return F.when(F.col("is_structured"), F.coalesce("structured_entity_rows", F.lit(0))).otherwise(plain)


def roster_estimate(estimate: Column, total_rows: Column, structured: Column, threshold: Column) -> Column:
    """A long structured file that was read as holding few people counts by its rows; a threshold of 0 turns that off."""
    total = F.coalesce(total_rows, F.lit(0))
    return F.when((threshold > 0) & structured & (estimate < threshold) & (total >= threshold), total).otherwise(estimate)


def classify_ambiguity(ssn: Column, labels: Column, structured: Column, rows: Column, total_rows: Column) -> Column:
    telling = F.size(F.filter(labels, lambda x: x != "Money/Amount")) > 0
    in_rows = structured & ((rows > 0) | (F.coalesce(total_rows, F.lit(0)) > 0))
    return F.when(ssn > 0, "clear_responsive").when(telling | in_rows, "ambiguous").otherwise("clear_non_responsive")


def choose_lane(unreadable_bytes: int) -> Column:
    """The ordered decision list over inventory columns."""
    c = F.col
    responsive = F.when(c("llm_consulted"), c("llm_responsive") == "yes").otherwise(c("value_signal") | (c("is_structured") & (c("estimated_entities") > 0)))
    return (
        F.when(c("status") == "container", "container_expand")
        .when((c("status") != "ok") & (c("text_extractable") == "needs_conversion"), "convert_lane")
        .when(c("status") == "no_parser", "needs_parser")
        .when(c("status") == "skipped_too_large", "manual_oversize")
        .when(c("status") != "ok", "review_error")
        .when(~c("searchable"), "nonsearchable_sample")
        .when(c("bde_confirmed") & c("is_structured"), "structured_bde")
        .when(c("bde_confirmed"), "bde")
        .when(c("is_structured") & (c("estimated_entities") == 0) & (c("size_bytes") > unreadable_bytes), "structured_unreadable")
        .when(~responsive, NR_LANE)
        .when(c("is_bde") & c("is_structured"), "structured_bde")
        .when(c("is_bde"), "bde")
        .otherwise("standard")
    )


def notes(*parts: Column) -> Column:
    """Notes joined by a blank; null or empty ones leave no trace."""
    return F.concat_ws(" ", *(F.when(p != "", p) for p in parts))


# Graded answers that mean yes and no; below, the words that grade without a model.
YES_LEVELS, NO_LEVELS = ("clear_yes", "likely_yes"), ("borderline", "likely_no", "clear_no")


def level_responsive(level: Column, legacy: Column) -> Column:
    """A graded answer as a boolean: an unknown level is not cleared, an empty one leaves it to the older boolean."""
    return F.when(level.isin(*YES_LEVELS), True).when(level.isin(*NO_LEVELS), False).when(level != "", True).otherwise(F.coalesce(legacy, F.lit(False)))


def offline_level(text: Column) -> Column:
    """A crude grading by keywords, for runs without a model."""
    t = F.lower(F.coalesce(text, F.lit("")))

    def holds(*words: str) -> Column:
        out = F.lit(False)
        for w in words:
            out = out | t.contains(w)
        return out

    return (
        F.when(holds("ssn", "social security"), "clear_yes")
        .when(holds("dob", "date of birth", "passport", "account number"), "likely_yes")
        .when(holds("invoice", "purchase order", "inventory"), "likely_no")
        .when(~is_blank(t), "borderline")
        .otherwise("clear_no")
    )


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(r"\S")
