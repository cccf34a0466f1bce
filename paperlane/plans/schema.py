"""The inventory's fixed columns, and the closed sets of values in them."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "images": T.ArrayType(T.StructType([T.StructField("page", T.IntegerType()), T.StructField("jpeg", T.BinaryType())]))}


def struct_of(fields: str, separator: str = ",") -> T.StructType:
    """A struct from ``name type`` pairs; unlike a DDL parser it needs no session."""
    pairs = (f.split() for f in fields.replace("\n", " ").split(separator))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Names, order and types of the 49 columns. The first 27 are the older contract.
_COLUMNS = """
rel_path string; file_name string; ext string; size_bytes bigint; status string; searchable boolean;
programmatic boolean; text_extractable string; is_structured boolean; page_or_sheet_count int; attachment_count int;
estimated_entities int; estimate_truncated boolean; bde_person_count int; bde_confirmed boolean; entity_bucket string;
entities_found string; value_signal boolean; pi_categories string; is_bde boolean; complexity_bucket string;
ambiguity string; llm_consulted boolean; llm_responsive string; llm_tokens int; suggested_lane string; detail string;
ocr_attempted boolean; ocr boolean; ocr_pages int; img_ocr_qualifying int; img_ocr_calls int; img_ocr_ok int;
img_decode_failed int; di_calls int; elapsed_s double;
nr_stage1 boolean; bde_stage1 boolean;
s2_ran boolean; s2_skip_reason string; s2_llm_consulted boolean; s2_llm_responsiveness string;
s2_llm_responsive string; s2_llm_tokens int; s2_is_bde boolean; s2_lane string; s2_nr boolean; s2_detail string;
llm_tokens_total int
"""

COLUMNS: list[tuple[str, str]] = [tuple(c.split()) for c in _COLUMNS.replace("\n", " ").split(";")]
INVENTORY = [name for name, _ in COLUMNS]
LEGACY = INVENTORY[:27]
INVENTORY_SCHEMA = struct_of(_COLUMNS, ";")
ZERO = {"string": "", "boolean": False, "int": 0, "bigint": 0, "double": 0.0}

NR_LANE = "likely_non_responsive"
BDE_LANES = ("bde", "structured_bde")
RESPONSIVE_LANES = ("standard", *BDE_LANES)
LANES = (*RESPONSIVE_LANES, NR_LANE, "structured_unreadable", "nonsearchable_sample", "container_expand", "convert_lane", "needs_parser", "manual_oversize", "review_error")

META = struct_of(
    "text_extractable string, is_structured boolean, page_or_sheet_count int, attachment_count int, structured_entity_rows int, "
    "structured_total_rows int, estimate_truncated boolean, status string, detail string, pdf_images_decode_failed int, "
    "ocr boolean, ocr_attempted boolean, ocr_pages int, content_images images, pdf_images_seen int"
)
EXTRACTED_SCHEMA = struct_of("rel_path string, file_name string, ext string, size_bytes bigint, text string").add("meta", META)
