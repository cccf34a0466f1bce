"""DuckDB SQL for the catalogue, built from the same rule list as the column expressions.

RE2 has no look-around, so a phone number takes its neighbours with it and a labelled value its whole window; on the
tables here both count the same. Accents are no word characters to RE2, which moves where a match begins, not how
many there are.
"""

from __future__ import annotations

from .functions import detectors as d
from .operators.route import NO_LEVELS, YES_LEVELS
from .plans.rules import Rule, RuleList
from .plans.schema import BDE_LANES, NR_LANE, RESPONSIVE_LANES

RULES = RuleList()


def q(text: str) -> str:
    """A SQL string literal; Java's and Python's escape for a code point becomes the character."""
    return "'" + text.replace("\\u2019", "’").replace("'", "''") + "'"


def names(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(map(q, values)) + ")"


def as_bigint(sql: str) -> str:
    """sql with every count_if(...) cast to BIGINT, as counts are."""
    out, at = "", 0
    while (start := sql.find("count_if(", at)) >= 0:
        end, depth = start + len("count_if("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        out += f"{sql[at:end]}::BIGINT"
        at = end
    return out + sql[at:]


def found(t: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({t}, {q(pattern)}, {group})"


def distinct(*lists: str) -> str:
    both = lists[0]
    for x in lists[1:]:
        both = f"list_concat({both}, {x})"
    return f"len(list_distinct({both}))"


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def card(x: str) -> str:
    luhn = f"list_sum([CASE WHEN (length({x}) - i) % 2 = 0 THEN substr({x}, i, 1)::INT WHEN substr({x}, i, 1)::INT > 4 THEN 2 * substr({x}, i, 1)::INT - 9 ELSE 2 * substr({x}, i, 1)::INT END FOR i IN range(1, length({x}) + 1)]) % 10 = 0"
    issuer = " OR ".join(f"(length({x}) IN ({', '.join(map(str, ls))}) AND substr({x}, 1, {k})::INT BETWEEN {a} AND {b})" for k, a, b, ls in d.CARD_NETWORKS)
    return f"length({x}) BETWEEN 13 AND 19 AND {luhn} AND ({issuer})"


def ssn_ok(x: str) -> str:
    return f"length({x}) = 9 AND substr({x}, 1, 3) NOT IN ('000', '666') AND substr({x}, 1, 3) < '900' AND substr({x}, 4, 2) <> '00' AND substr({x}, 6, 4) <> '0000'"


def cleaned(x: str) -> str:
    return f"[lower(trim(v)) FOR v IN {x}]"


# typed out here, apart from the expression that the columns use
CITY_ZIP = r"\b[A-Z][A-Za-z.'\- ]+,\s*[A-Z]{2}\s+\d{5}(?:-\d{4})?\b"
PHONE = r"(?:^|\D)((?:\+?1[-.\s]?)?(?:\(\d{3}\)|\d{3})[-.\s]?\d{3}[-.\s]?\d{4})(?:\D|$)"


def count(rule: Rule, t: str = "t") -> str:
    match rule.method:
        case "regex" if rule.luhn:
            return distinct(f"[n FOR n IN [{digits('v')} FOR v IN {found(t, rule.patterns[0])}] IF {card('n')}]")
        case "regex" if rule.key == "PHONE":
            return distinct(found(t, PHONE, 1))
        case "regex":
            return distinct(f"[lower(v) FOR v IN {found(t, rule.patterns[0])}]" if rule.casefold else found(t, rule.patterns[0]))
        case "keyword":
            return "(" + " OR ".join(f"regexp_matches({t}, {q('(?i)' + p)})" for p in rule.patterns) + ")::INT"
        case "name":
            return distinct(*(cleaned(found(t, p, 1)) for p in d.NAME_CUES))
        case "address":
            return distinct(*(cleaned(found(t, p)) for p in (d.STREET, CITY_ZIP)))
        case "money":
            return distinct(f"[trim(v) FOR v IN {found(t, d.MONEY)}]")
        case "ssn":
            apart = f"[n FOR n IN [{digits('v')} FOR v IN {found(t, d.SSN_SEPARATED)}] IF {ssn_ok('n')}]"
            bare = f"CASE WHEN regexp_matches({t}, {q(d.SSN_LABEL)}) THEN [n FOR n IN {found(t, d.SSN_BARE)} IF {ssn_ok('n')}] ELSE [] END"
            return distinct(apart, bare)
        case "labeled_value":
            windows = found(t, rf"(?i)(?:{rule.label_pattern})([\s\S]{{0,{rule.window}}})", 1)
            first = f"[[x FOR x IN {found('w', '(?i)' + rule.value_pattern)} IF length({digits('x')}) >= {rule.min_digits}][1] FOR w IN {windows}]"
            return distinct(cleaned(f"[v FOR v IN {first} IF v IS NOT NULL]"))
    raise ValueError(rule.method)


def file_row(folder: str, key: str, ext: str, text: str, table: str, size: str | None = None, structured: str = "false", people: str = "NULL::BIGINT", total: str = "NULL::BIGINT") -> str:
    return (f"SELECT '{folder}/' || {key} || '{ext}' AS rel_path, {key} || '{ext}' AS file_name, '{ext}' AS ext, coalesce({size or f'strlen({text})'}, 0)::BIGINT AS size_bytes, "
            f"coalesce({text}, '') AS t, {structured} AS is_structured, {people} AS people, {total} AS total FROM {table}")


STRIPPED = r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g')"
_line = "concat_ws(' ', c_custkey::VARCHAR, coalesce(c_name, ''), coalesce(c_nationkey::VARCHAR, ''), coalesce(c_mktsegment, ''))"


def _roster_line(t: str) -> str:
    head = f"regexp_replace({t}, '^\\s+|\\s+$', '', 'g')"
    m = f"regexp_extract({head}, {q(d.ROSTER_LINE)})"
    return f"({m} <> '' AND NOT regexp_matches(substr({head}, length({m}) + 1, 1), '^[0-9]'))"


def _identifier(t: str) -> str:
    email, phone, cards = (next(r for r in RULES.rules if r.key == k) for k in ("EMAIL", "PHONE", "CARD"))
    return f"(regexp_matches({t}, {q(email.patterns[0])}) OR regexp_matches({t}, {q(PHONE)}) OR regexp_matches({t}, {q(d.SSN_SEPARATED)}) OR {count(cards, t)} > 0)"


def _form() -> str:
    def n(k: int, f: int) -> str:
        return f"lpad(((o_orderkey * {f}) % {10**k})::VARCHAR, {k}, '0')"

    def on(m: int, text: str) -> str:
        return f"CASE WHEN o_orderkey % {m} = 0 THEN {text} ELSE '' END"

    first = "['Anna', 'Boris', 'Clara', 'Dmitri'][(o_orderkey % 4 + 1)::INT]"
    return " || ".join([
        on(2, f"'Name: ' || {first} || ' Miller. '"), on(3, f"'SSN: ' || {n(3, 7)} || '-' || {n(2, 3)} || '-' || {n(4, 11)} || ' . '"),
        on(5, f"'Account No: ' || {n(8, 13)} || ' . '"), on(7, f"'Date of birth: 1/2/19' || {n(2, 1)} || ' . '"), on(11, f"'Passport number X' || {n(7, 17)} || ' . '"),
        on(13, f"{n(3, 1)} || ' Main Street . '"), on(17, f"'Card 4' || {n(15, 7919 * 104729)} || ' . '"), on(19, "'Please see the invoice. '")])


FILES = {
    "documents": file_row("documents", "doc_id", ".txt", "text", "documents"),
    "pages": file_row("pages", "page_id", ".html", STRIPPED, "pages", "strlen(html)"),
    "threads": file_row("threads", "conv_id", ".eml", "tt", "(SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS tt FROM conversations GROUP BY conv_id)"),
    "forms": file_row("forms", "o_orderkey", ".txt", _form(), "orders"),
    "customers": file_row("customers", "c_nationkey", ".csv", "tt", f"""(
        SELECT c_nationkey, string_agg(line, chr(10) ORDER BY rk) FILTER (rk <= 50) AS tt, sum(strlen(line) + 1) AS bytes, count(*) AS total, sum((person OR name)::INT) AS people
        FROM (SELECT c_nationkey, line, {_identifier('line')} AS person, {_roster_line('line')} AS name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey, line) AS rk FROM (SELECT *, {_line} AS line FROM customer))
        GROUP BY c_nationkey)""", "bytes", "true", "people::BIGINT", "total::BIGINT"),
}
ALL = tuple(FILES)


def counts_cte(sources: tuple[str, ...]) -> str:
    every = " UNION ALL ".join(FILES[s] for s in sources)
    cells = ", ".join(f"{count(r)}::INT AS c_{r.key}" for r in RULES.rules)
    return f"files AS ({every}),\ncounted AS (SELECT *, {cells} FROM files)"


def inventory_cte(sources: tuple[str, ...] = ALL, threshold: int = 51, name: str = "inv", stage2: bool = True, counted: bool = True) -> str:
    """CTEs that end in ``name``: the 49 columns of the corpus."""
    labels = "[x FOR x IN [" + ", ".join(f"CASE WHEN c_{r.key} > 0 THEN {q(r.label)} END" for r in RULES.rules) + "] IF x IS NOT NULL]"
    kinds = "[x FOR x IN [" + ", ".join(f"CASE WHEN c_{r.key} > 0 THEN {q(r.category)} END" for r in RULES.rules if r.category) + "] IF x IS NOT NULL]"
    some = lambda keys: "greatest(0, " + ", ".join(f"c_{k}" for k in keys) + ") > 0"
    value = f"({some(RULES.value_keys)} OR (c_NAME > 0 AND {some([r.key for r in RULES.rules if r.key != 'NAME'])}))"
    most = "greatest(" + ", ".join(f"c_{k}" for k in RULES.per_person) + ")"
    category_order = list(dict.fromkeys(r.category for r in RULES.rules if r.category))
    by_kind = ", ".join(f"CASE WHEN list_contains(kinds, {q(k)}) THEN {q(k)} END" for k in category_order)
    bucket, low = "CASE ", 0
    for e in RULES.bucket_edges:
        bucket += f"WHEN est <= {e} THEN '{low}-{e}' "
        low = e
    bucket += f"ELSE '{low}+' END"
    x = counts_cte(sources) + ",\n" if counted else ""
    x += f"""{name}1 AS (SELECT *, {labels} AS labels, {kinds} AS kinds, {value} AS value_signal FROM counted),
{name}2 AS (SELECT *, CASE WHEN is_structured THEN coalesce(people, 0) WHEN {most} > 0 THEN {most} WHEN len(labels) > 0 THEN 1 ELSE 0 END AS base FROM {name}1),
{name}3 AS (SELECT *, CASE WHEN is_structured AND base < {threshold} AND coalesce(total, 0) >= {threshold} THEN total ELSE base END AS est FROM {name}2),
{name}4 AS (SELECT *, est >= {threshold} AS bde,
  CASE WHEN c_SSN > 0 THEN 'clear_responsive' WHEN len([l FOR l IN labels IF l <> 'Money/Amount']) > 0 OR (is_structured AND (est > 0 OR coalesce(total, 0) > 0)) THEN 'ambiguous' ELSE 'clear_non_responsive' END AS ambiguity FROM {name}3),
{name}5 AS (SELECT *, CASE WHEN bde AND is_structured THEN 'structured_bde' WHEN bde THEN 'bde' WHEN is_structured AND est = 0 AND size_bytes > 6000 THEN 'structured_unreadable'
  WHEN NOT (value_signal OR (is_structured AND est > 0)) THEN '{NR_LANE}' ELSE 'standard' END AS lane, lower(t) AS low FROM {name}4),
{name}6 AS (SELECT *, CASE WHEN {str(not stage2).lower()} THEN 'stage2_disabled' WHEN lane = '{NR_LANE}' THEN 'stage1_nr' WHEN NOT regexp_matches(t, '\\S') THEN 'no_text' ELSE '' END AS skip,
  CASE WHEN contains(low, 'ssn') OR contains(low, 'social security') THEN 'clear_yes' WHEN contains(low, 'dob') OR contains(low, 'date of birth') OR contains(low, 'passport') OR contains(low, 'account number') THEN 'likely_yes'
       WHEN contains(low, 'invoice') OR contains(low, 'purchase order') OR contains(low, 'inventory') THEN 'likely_no' WHEN regexp_matches(t, '\\S') THEN 'borderline' ELSE 'clear_no' END AS level0 FROM {name}5),
{name}7 AS (SELECT *, skip = '' AS ran, CASE WHEN skip = '' THEN level0 ELSE '' END AS level, level0 IN {names(YES_LEVELS)} AS yes FROM {name}6),
{name} AS (SELECT rel_path, file_name, ext, size_bytes, 'ok' AS status, true AS searchable, is_structured AS programmatic, 'text' AS text_extractable, is_structured,
  0 AS page_or_sheet_count, 0 AS attachment_count, est::INT AS estimated_entities, false AS estimate_truncated, 0 AS bde_person_count, bde AS bde_confirmed,
  {bucket} AS entity_bucket, array_to_string(labels, ' | ') AS entities_found, value_signal, coalesce(array_to_string([c FOR c IN [{by_kind}] IF c IS NOT NULL], ' | '), '') AS pi_categories, bde AS is_bde, '' AS complexity_bucket,
  ambiguity, false AS llm_consulted, '' AS llm_responsive, 0 AS llm_tokens, lane AS suggested_lane, CASE WHEN est <> base THEN 'roster_by_rowcount' ELSE '' END AS detail,
  false AS ocr_attempted, false AS ocr, 0 AS ocr_pages, 0 AS img_ocr_qualifying, 0 AS img_ocr_calls, 0 AS img_ocr_ok, 0 AS img_decode_failed, 0 AS di_calls, 0.0::DOUBLE AS elapsed_s,
  lane = '{NR_LANE}' AS nr_stage1, bde AS bde_stage1, ran AS s2_ran, skip AS s2_skip_reason, ran AS s2_llm_consulted, level AS s2_llm_responsiveness,
  CASE WHEN ran AND yes THEN 'yes' WHEN ran THEN 'no' ELSE '' END AS s2_llm_responsive, 0 AS s2_llm_tokens, ran AND bde AS s2_is_bde,
  CASE WHEN NOT ran THEN '' WHEN NOT yes THEN '{NR_LANE}' WHEN bde AND is_structured THEN 'structured_bde' WHEN bde THEN 'bde' ELSE 'standard' END AS s2_lane,
  ran AND NOT yes AS s2_nr, '' AS s2_detail, 0 AS llm_tokens_total FROM {name}7)"""
    return x


TASKS = """tasks0 AS (SELECT *, (round(value * 1000))::BIGINT AS duration_ms, epoch_us(ts) AS us,
  CASE WHEN event_type = 'signup' THEN 'pending' WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN 'processing' WHEN event_type = 'error' AND event_id % 10 = 0 THEN 'dead_lettered' WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status FROM events),
tasks AS (SELECT 'job-' || (user_id % 7) AS job_id, event_id::VARCHAR AS row_key, 'f' || (event_id // 2) || CASE event_id % 4 WHEN 0 THEN '.doc' WHEN 1 THEN '.docx' WHEN 2 THEN '.xls' ELSE '.pdf' END AS file_name, status,
  us - 60000000 AS enq, CASE WHEN status <> 'pending' THEN us END AS s, CASE WHEN status IN ('completed', 'failed', 'dead_lettered') THEN us + duration_ms * 1000 END AS e, duration_ms, (1 + event_id % 3)::INT AS attempt_count,
  'w' || (user_id % 12) AS worker_instance, event_id % 997 AS tokens_in, event_id % 89 AS tokens_out, 1000 + event_id % 50000 AS file_size_bytes, CASE WHEN event_type = 'error' THEN 'E' || (event_id % 4) END AS error_message FROM tasks0)"""

CALLS = f"""CASE WHEN suggested_lane IN {names(RESPONSIVE_LANES)} THEN true WHEN suggested_lane = '{NR_LANE}' THEN false END AS s1,
  CASE WHEN s2_ran THEN CASE WHEN s2_lane IN {names(RESPONSIVE_LANES)} THEN true WHEN s2_lane = '{NR_LANE}' THEN false END END AS s2"""
HUMAN = "CASE WHEN toxic = 1 THEN 7 + doc_id % 60 WHEN quality = 1 THEN doc_id % 7 ELSE 0 END"
SCORED = f"scored AS (SELECT inv.*, ({HUMAN})::BIGINT AS human FROM inv JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) AS l ON rel_path = 'documents/' || l.doc_id || '.txt')"
CELLS = "count_if(coalesce(pred AND truth, false)) AS tp, count_if(coalesce(pred AND NOT truth, false)) AS fp, count_if(coalesce(NOT pred AND truth, false)) AS fn, count_if(coalesce(NOT pred AND NOT truth, false)) AS tn, count_if(pred IS NULL) AS undetermined"


def ratio(a: str, b: str, n: int = 6) -> str:
    return f"round_even(coalesce(({a}) / nullif(({b})::DOUBLE, 0), 0), {n})"


RATES = "tp + fp + fn + tn AS n, " + ", ".join(f"{ratio(a, b)} AS {k}" for k, (a, b) in {
    "accuracy": ("tp + tn", "tp + fp + fn + tn"), "precision": ("tp", "tp + fp"), "recall": ("tp", "tp + fn"), "f1": ("2 * tp", "2 * tp + fp + fn"), "specificity": ("tn", "tn + fp"),
    "nr_error": ("fn", "fn + tn"), "r_error": ("fp", "fp + tp"), "over_call": ("fp", "tp + fp + fn + tn"), "under_call": ("fn", "tp + fn"), "flagged": ("tp + fp", "tp + fp + fn + tn")}.items())
LANES_BDE = names(BDE_LANES)
EFFECTIVE = "CASE WHEN is_structured AND bde_person_count > 0 THEN bde_person_count ELSE greatest(estimated_entities, bde_person_count) END"
