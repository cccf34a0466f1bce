"""Reports over an inventory: tallies, cost, labels, the review table, samples and their extrapolation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ratio, round_even
from ..plans.schema import NR_LANE
from ..plans.settings import Settings
from ..shared import written


def _n(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def tally(inv: DataFrame) -> DataFrame:
    """One row with the run's counters, all in one pass."""
    return inv.agg(*(v.cast("long").alias(k) for k, v in _tally_cells().items()))


def _tally_cells() -> dict[str, Column]:
    c = F.col
    ambiguous = c("ambiguity") == "ambiguous"
    return {
        "files": F.count("*"),
        **{f"status_{s}": _n(c("status") == s) for s in ("ok", "no_parser", "skipped_too_large", "timeout", "error", "container")},
        "image_only": _n(c("text_extractable") == "image_only"),
        "bde": _n(c("is_bde")),
        "nr": _n(c("suggested_lane") == NR_LANE),
        "full_file_calls": _n(c("ocr_attempted")),
        "full_file_ok": _n(c("ocr_attempted") & c("ocr")),
        "full_file_failed": _n(c("ocr_attempted") & ~c("ocr")),
        "pages": _total("ocr_pages"), "img_qualifying": _total("img_ocr_qualifying"), "img_calls": _total("img_ocr_calls"),
        "img_ok": _total("img_ocr_ok"), "img_decode_failed": _total("img_decode_failed"), "di_calls": _total("di_calls"),
        "files_with_di": _n(c("di_calls") > 0),
        "s2_ran": _n(c("s2_ran")), "s2_consulted": _n(c("s2_ran") & c("s2_llm_consulted")),
        "s2_nr": _n(c("s2_ran") & c("s2_nr")), "s2_responsive": _n(c("s2_ran") & ~c("s2_nr")),
        "s2_tokens": _total("s2_llm_tokens"), "llm_tokens": _total("llm_tokens"),
        "ambiguous": _n(ambiguous), "consulted": _n(ambiguous & c("llm_consulted")),
        "responsive": _n(ambiguous & c("llm_consulted") & (c("llm_responsive") == "yes")),
        "cleared": _n(ambiguous & c("llm_consulted") & (c("llm_responsive") != "yes")),
        "failed": _n(ambiguous & ~c("llm_consulted")),
    }


def counts_by(inv: DataFrame, *columns: str) -> DataFrame:
    """Files by the given columns."""
    return inv.groupBy(*columns).agg(F.count("*").alias("files"))


def stage2_counts(inv: DataFrame) -> DataFrame:
    """Files by stage-2 level where it ran, by skip reason where it didn't."""
    key = F.when(F.col("s2_ran"), F.concat(F.lit("level:"), F.coalesce(F.nullif("s2_llm_responsiveness", F.lit("")), F.lit("(none)")))).otherwise(
        F.concat(F.lit("skip:"), F.coalesce(F.nullif("s2_skip_reason", F.lit("")), F.lit("(unset)"))))
    return inv.groupBy(key.alias("outcome")).agg(F.count("*").alias("files"))


def model_failures(inv: DataFrame) -> DataFrame:
    """Ambiguous files that no model judged, by the failure noted."""
    kind = F.nullif(F.regexp_extract("detail", r"llm_failed:(\w+)", 1), F.lit(""))
    open_files = inv.filter((F.col("ambiguity") == "ambiguous") & ~F.col("llm_consulted"))
    return open_files.groupBy(F.coalesce(F.concat(F.lit("fail:"), kind), F.lit("not_run(off?)")).alias("failure")).agg(F.count("*").alias("files"))


def cost(inv: DataFrame, settings: Settings) -> DataFrame:
    """One row: units always, money only for prices that are set; a range where the two token prices differ."""
    return priced(inv.agg(*_cost_sums()), settings)


COST_UNITS = ("llm_tokens_stage1", "llm_tokens_stage2", "di_calls", "di_pages_billable")


def _cost_sums() -> list[Column]:
    sums = (_total("llm_tokens"), _total("s2_llm_tokens"), _total("di_calls"), _total("ocr_pages") + _total("img_ocr_calls"))
    return [s.alias(n) for s, n in zip(sums, COST_UNITS)]


def priced(t: DataFrame, settings: Settings) -> DataFrame:
    """Units (COST_UNITS) with their sums of money."""
    t = t.withColumn("llm_tokens_total", F.col("llm_tokens_stage1") + F.col("llm_tokens_stage2"))
    prices = [p for p in (settings.price_per_1k_in, settings.price_per_1k_out) if p]
    low, high = (min(prices), max(prices)) if prices else (None, None)

    def money(units: str, price: float | None, scale: int = 2) -> Column:
        return round_even(F.col(units) / 1000.0 * price, scale) if price else F.lit(None).cast("double")

    t = t.withColumns({"llm_cost_low": money("llm_tokens_total", low), "llm_cost_high": money("llm_tokens_total", high), "di_cost": money("di_pages_billable", settings.price_per_1k_pages)})
    share = 100.0 * F.col("di_cost") / F.greatest(F.col("di_cost") + F.coalesce("llm_cost_high", F.lit(0.0)), F.lit(1e-9))
    return t.withColumn("di_share_of_spend_pct", round_even(share, 1))


def summary(inv: DataFrame, per_1k_tokens: float = 0.0, per_1k_pages: float = 0.0, top: int = 20) -> DataFrame:
    """What a results screen shows, as rows (section, name, value): decisions, OCR, tokens and money, files by lane, status and grade, top labels.

    Tokens are priced as a whole, because an inventory does not split them. The inventory is read once: its sums by the
    columns that the sections group by and by the labels found, a row for each combination there is, are written, and all sections read these.
    """
    c = F.col
    no_model = ~c("llm_consulted") & ~c("s2_llm_consulted")
    sums = {
        "nr_stage1": _n(c("nr_stage1")), "is_bde": _n(c("is_bde")), "s2_is_bde": _n(c("s2_is_bde")), "s2_nr": _n(c("s2_nr")), "llm_consulted": _n(c("llm_consulted")), "s2_consulted": _n(c("s2_llm_consulted")), "rules_decided": _n(no_model),
        "di_calls": _total("di_calls"), "ocr_attempted": _n(c("ocr_attempted")), "ocr_pages": _total("ocr_pages"), "img_ocr_calls": _total("img_ocr_calls"),
        "tokens_total": _total("llm_tokens_total"), "tokens_stage1": _total("llm_tokens"), "tokens_stage2": _total("s2_llm_tokens"), "files": F.count("*"),
    }
    blank = lambda n, other: F.coalesce(F.nullif(F.trim(n), F.lit("")), F.lit(other))
    keys = {"lane": blank("suggested_lane", "(blank)"), "s2_lane": blank("s2_lane", ""), "status": blank("status", "(blank)"), "grade": blank("s2_llm_responsiveness", "")}
    by = written(inv.groupBy(*(v.alias(k) for k, v in keys.items()), "entities_found").agg(*(v.cast("long").alias(k) for k, v in sums.items())), "summary")
    row = lambda section, name, value: F.struct(F.lit(section).alias("section"), (F.lit(name) if isinstance(name, str) else name).alias("name"), value.cast("double").alias("value"))
    grouped = by.select(F.inline(F.array(*(row(k, c(k), c("files")) for k in keys)))).filter("name <> ''").groupBy("section", "name").agg(F.sum("value").alias("value"))
    t = by.agg(*(_total(k).alias(k) for k in sums))
    tokens = F.when((c("tokens_total") == 0), c("tokens_stage1") + c("tokens_stage2")).otherwise(c("tokens_total"))
    pages = c("ocr_pages") + c("img_ocr_calls")
    llm, di = round_even(tokens / 1000.0 * per_1k_tokens, 2), round_even(pages / 1000.0 * per_1k_pages, 2)
    cells = [row("decision", k, c(k)) for k in ("files", "nr_stage1", "is_bde", "s2_is_bde", "s2_nr", "llm_consulted", "s2_consulted", "rules_decided")]
    cells += [row("decision", "responsive_stage1", c("files") - c("nr_stage1")), row("decision", "model_decided", c("files") - c("rules_decided"))]
    cells += [row("ocr", k, c(k)) for k in ("di_calls", "ocr_attempted", "ocr_pages", "img_ocr_calls")] + [row("ocr", "di_pages_billable", pages)]
    cells += [row("tokens", "total", tokens), row("tokens", "stage1", c("tokens_stage1")), row("tokens", "stage2", c("tokens_stage2"))]
    cells += [row("cost", "di", di), row("cost", "llm", llm), row("cost", "total", round_even(di + llm, 2))]
    labels = label_counts(by, top, F.sum("files")).select(row("label", c("label"), c("files")).alias("r")).select("r.*")
    return t.select(F.inline(F.array(*cells))).unionByName(grouped).unionByName(labels)


def label_counts(inv: DataFrame, top: int = 20, files: Column | None = None) -> DataFrame:
    """The most frequent labels; ties by label. ``files`` says how to count where a row stands for several files."""
    each = inv.filter(F.coalesce(F.col("entities_found"), F.lit("")) != "").withColumn("label", F.explode(F.split("entities_found", r"\|"))).withColumn("label", F.trim("label"))
    return each.filter("label <> ''").groupBy("label").agg((F.count("*") if files is None else files).alias("files")).orderBy(F.desc("files"), "label").limit(top)


def review_table(inv: DataFrame) -> DataFrame:
    """Searchable files that were read, as the six columns reviewers get."""
    yes = F.when(F.col("programmatic"), "Yes").otherwise("No")
    return inv.filter(F.col("searchable") & (F.col("status") == "ok")).select(
        F.col("rel_path").alias("File ID"), F.col("ext").alias("File Type"), F.lit("Yes").alias("Searchable"), yes.alias("Programmatic"),
        F.col("entities_found").alias("Entities Found"), F.col("entity_bucket").alias("Entity Bucket"))


def nonsearchable(inv: DataFrame) -> DataFrame:
    return inv.filter(F.col("suggested_lane") == "nonsearchable_sample").withColumn("complexity_bucket", F.coalesce(F.nullif("complexity_bucket", F.lit("")), F.lit("unknown")))


def draw_sample(inv: DataFrame, rate: float = 0.05, seed: int = 12345) -> DataFrame:
    """ceil(rate * n), at least 1, files of each bucket: those with the least md5 of path and seed.

    Which files are drawn differs from another generator's choice; sizes and reproducibility are the same.
    """
    draw = F.md5(F.concat(F.col("rel_path"), F.lit(str(seed))).cast("binary"))
    rows = nonsearchable(inv).select("rel_path", "complexity_bucket", F.col("ext").alias("file_type"), draw.alias("draw"), F.substring(draw, 1, 4).alias("head"))
    # Files are counted by the first digits of their draw; only those at the border of the quota are ranked.
    heads = rows.groupBy("complexity_bucket", "head").agg(F.count("*").alias("k"))
    whole = Window.partitionBy("complexity_bucket")
    heads = heads.withColumn("n", F.sum("k").over(whole)).withColumn("before", F.coalesce(F.sum("k").over(whole.orderBy("head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    heads = heads.withColumn("open", F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(rate))) - F.col("before")).filter("open > 0")
    drawn = rows.join(heads.select("complexity_bucket", "head", "k", "open"), ["complexity_bucket", "head"])
    rank = F.row_number().over(Window.partitionBy("complexity_bucket", "head").orderBy("draw", "rel_path"))
    border = drawn.filter("k > open").withColumn("rank", rank).filter("rank <= open").drop("rank")
    return drawn.filter("k <= open").unionByName(border).select("rel_path", "complexity_bucket", "file_type")


def extrapolate(inv: DataFrame, coded: DataFrame) -> DataFrame:
    """Coded shares carried over to each bucket's files. coded has complexity_bucket, gold_responsive, gold_bde as texts."""
    rows = nonsearchable(inv)
    by_type = rows.groupBy("complexity_bucket", "ext").agg(F.count("*").alias("n"), F.min("rel_path").alias("first"))
    kinds = by_type.groupBy("complexity_bucket").agg(F.sum("n").alias("n_files"), F.min_by("ext", F.struct((-F.col("n")).alias("n"), "first")).alias("File Type"))
    programmatic = rows.groupBy("complexity_bucket").agg(F.max("programmatic").alias("p"))

    def marked(name: str) -> Column:
        return _n(F.trim(F.col(name)).isin("1", "true", "True"))

    shares = coded.groupBy("complexity_bucket").agg(F.count("*").alias("s"), marked("gold_responsive").alias("r"), marked("gold_bde").alias("b"))
    t = kinds.join(programmatic, "complexity_bucket").join(shares, "complexity_bucket", "left").na.fill(0, ["s", "r", "b"])
    pr, pb = ratio(F.col("r"), F.col("s")), ratio(F.col("b"), F.col("s"))
    # a row for each bucket, of which there are five at most
    number = F.row_number().over(Window.orderBy("complexity_bucket"))

    def percent(x: Column) -> Column:
        return F.concat(round_even(x * 100, 0).cast("int").cast("string"), F.lit("%"))

    return t.select(
        number.cast("long").alias("Bucket ID"), F.col("complexity_bucket").alias("Bucket"), "File Type", F.lit("No").alias("Searchable"), F.when(F.col("p"), "Yes").otherwise("No").alias("Programmatic"),
        F.col("n_files").alias("# of Files"), percent(pr).alias("% Responsive"), percent(pb).alias("% BDE"),
        round_even(pr * F.col("n_files"), 0).cast("long").alias("# of Responsive (Predicted)"), round_even(pb * F.col("n_files"), 0).cast("long").alias("# of BDEs (Predicted)"), F.col("s").alias("Sample Size"))


def rescan_set(inv: DataFrame, exclude_lanes: list[str]) -> DataFrame:
    """Paths whose lane is not excluded; a missing lane is kept."""
    return inv.filter(~F.coalesce("suggested_lane", F.lit("")).isin(*exclude_lanes)).select("rel_path").distinct()


def todo(paths: DataFrame, done: DataFrame) -> DataFrame:
    """Paths that no finished row has."""
    return paths.join(done.select("rel_path").distinct(), "rel_path", "left_anti")


def extension_counts(paths: DataFrame, top: int = 12) -> DataFrame:
    return paths.groupBy("ext").agg(F.count("*").alias("files")).orderBy(F.desc("files"), "ext").limit(top)


def manifest(inv: DataFrame, settings: Settings, extra: dict[str, str] | None = None) -> DataFrame:
    """One row for a run: its tally, cost, lanes as a map, rule list and fingerprint; ``toJSON`` makes the file.

    The inventory is read once: counters are summed by lane, and the few rows of lanes are summed up.
    """
    cells = _tally_cells() | dict(zip(COST_UNITS, _cost_sums()))
    by = inv.groupBy("suggested_lane").agg(*(v.cast("long").alias(k) for k, v in cells.items()))
    lanes = F.map_from_entries(F.sort_array(F.collect_list(F.struct("suggested_lane", "files")))).alias("lanes")
    own = by.agg(lanes, *(_total(n).alias(n) for n in cells))
    out = priced(own, settings).select(F.struct(*_tally_cells()).alias("counters"), F.struct(*COST_UNITS, "llm_tokens_total", "llm_cost_low", "llm_cost_high", "di_cost", "di_share_of_spend_pct").alias("cost"), "lanes")
    notes = {"rules_name": settings.rules.name, "rules_version": settings.rules.version, "rules_sha256": settings.rules.fingerprint(), "bde_threshold": str(settings.bde_threshold)} | (extra or {})
    return out.withColumns({k: F.lit(v) for k, v in notes.items()})
