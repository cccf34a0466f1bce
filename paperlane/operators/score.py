"""Scoring an inventory against reviewed truth: benchmark, scorecard views, BDE definitions, breakdowns.

Verdicts are three-valued: null is undetermined and counted apart. Every matrix is one grouped sum over rows
(group, pred, truth), so all views of a scorecard come from one pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import TYPE_ORDER, base_name, ratio, round_even, type_of
from ..plans.schema import BDE_LANES, NR_LANE, RESPONSIVE_LANES
from ..shared import written

# Words that stand for a verdict in reviewers' sheets, and header hints in order.
TRUE_WORDS = ("responsive", "r", "yes", "y", "1", "true", "t", "resp", "responsive (r)")
FALSE_WORDS = ("non-responsive", "nonresponsive", "non responsive", "not responsive", "nr", "no", "n", "0", "false", "f", "non-responsive (nr)")
ID_HINTS = ("rel_path", "relpath", "file_name", "filename", "file name", "file", "document name", "doc name", "docname", "document", "control number", "control", "bates", "begdoc", "beg doc", "name", "path")
RESPONSIVE_HINTS = ("gold_responsive", "responsive", "responsiveness", "responsive_nr", "responsive/nr", "responsive nr", "resp", "determination", "coding", "decision", "nr")
BDE_HINTS = ("gold_bde", "bde", "big data", "51+", "big data extraction")


def pick_column(headers: list[str], hints: tuple[str, ...], given: str | None = None) -> str | None:
    """A given header, else the first that equals a hint, else the first that holds one, hints in order."""
    clean = {h: (h or "").strip().lower() for h in headers}
    wanted = [given.strip().lower()] if given else list(hints)
    for w in wanted:
        for h in headers:
            if clean[h] == w:
                return h
    for w in [] if given else wanted:
        for h in headers:
            if w in clean[h]:
                return h
    return None


def _number(value: Column) -> Column:
    """A text's number; what is no number counts as less than any."""
    n = value.try_cast("double")
    return F.when(F.isnan(n), F.lit(float("-inf"))).otherwise(n)


def parse_responsive(value: Column) -> Column:
    """True, False or null from a reviewer's word or count."""
    v = F.lower(F.trim(value.cast("string")))
    return F.when(v.isin(*TRUE_WORDS), True).when(v.isin(*FALSE_WORDS), False).otherwise(_number(v) > 0)


def manual_status(value: Column) -> Column:
    """True, False or null from a data-entry status."""
    v = F.lower(F.trim(value))
    return F.when(v.contains("complete") | v.contains("further review") | v.contains("51+"), True).when(v.startswith("no"), False)


def lane_call(lane: Column) -> Column:
    return F.when(lane.isin(*RESPONSIVE_LANES), True).when(lane == NR_LANE, False)


def stage1_call() -> Column:
    return lane_call(F.col("suggested_lane"))


def stage2_call() -> Column:
    return F.when(F.col("s2_ran"), lane_call(F.col("s2_lane")))


def pipeline_call() -> Column:
    """Stage 2 where both ran and stage 1 flagged; undetermined where stage 1 is."""
    one, two = stage1_call(), stage2_call()
    return F.when(one.isNull(), F.lit(None).cast("boolean")).when(~one, False).otherwise(F.coalesce(two, F.lit(True)))


def verdict() -> Column:
    """As pipeline_call, but stage 2 decides where stage 1 is undetermined."""
    one, two = stage1_call(), stage2_call()
    return F.when(one.isNull(), two).when(~one, False).otherwise(F.coalesce(two, F.lit(True)))


def union_call() -> Column:
    one, two = stage1_call(), stage2_call()
    return F.when(one.isNotNull() | two.isNotNull(), F.coalesce(one, F.lit(False)) | F.coalesce(two, F.lit(False)))


def effective_count() -> Column:
    n, people = F.col("estimated_entities"), F.col("bde_person_count")
    return F.when(F.col("is_structured") & (people > 0), people).otherwise(F.greatest(n, people))


def confusion(rows: DataFrame, *by: str) -> DataFrame:
    """tp, fp, fn, tn, undetermined of (pred, truth) rows, by the given columns."""
    p, t = F.col("pred"), F.col("truth")
    cells = {"tp": p & t, "fp": p & ~t, "fn": ~p & t, "tn": ~p & ~t, "undetermined": p.isNull()}
    return rows.groupBy(*by).agg(*(F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in cells.items()))


def rates(m: DataFrame, digits: int = 6) -> DataFrame:
    """A confusion table with n and its ratios, half-even rounded."""
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    of = {
        "accuracy": (tp + tn, n), "precision": (tp, tp + fp), "recall": (tp, tp + fn), "f1": (2 * tp, 2 * tp + fp + fn), "specificity": (tn, tn + fp),
        "nr_error": (fn, fn + tn), "r_error": (fp, fp + tp), "over_call": (fp, n), "under_call": (fn, tp + fn), "flagged": (tp + fp, n),
    }
    return m.withColumns({"n": n, **{k: round_even(ratio(a, b), digits) for k, (a, b) in of.items()}})


def _first(df: DataFrame, key: str, order: Column) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("__n = 1").drop("__n")


def matched(inv: DataFrame, gold: DataFrame) -> DataFrame:
    """gold (id, row, ...) with the inventory row it names: by path (last row wins), else by file name, else by base name (first row wins).

    inv needs ``row``, its input order. Each probe is an equi-join on a key that is unique on the build side.
    """
    inv = inv.filter(F.col("row").isNotNull())
    inv_key = inv.select(F.trim("rel_path").alias("path"), F.lower(F.trim(F.coalesce(F.nullif("file_name", F.lit("")), base_name(F.col("rel_path"))))).alias("base"), "row")
    by_path = _first(inv_key.filter("path <> ''").select("path", F.col("row").alias("r1")), "path", F.desc("r1"))
    by_base = _first(inv_key.filter("base <> ''").select("base", F.col("row").alias("r2")), "base", F.col("r2"))
    g = gold.withColumns({"path": F.trim("id"), "base": F.lower(F.trim("id")), "tail": F.lower(base_name(F.trim("id")))})
    g = g.join(by_path, "path", "left").join(by_base, "base", "left").join(by_base.select(F.col("base").alias("tail"), F.col("r2").alias("r3")), "tail", "left")
    return g.withColumn("inv_row", F.coalesce("r1", "r2", "r3")).drop("path", "base", "tail", "r1", "r2", "r3")


def benchmark(inv: DataFrame, gold: DataFrame, absent_means: str = "unreviewed", bde_threshold: int | None = None) -> DataFrame:
    """One row: the confusion of lanes against gold, with precision, recall and F1 of both classes, and BDE accuracy.

    inv needs ``row``; gold has id, responsive and bde as texts. ``absent_means="zero"`` also scores the inventory
    rows that no gold row names, as non-responsive.
    """
    inv = written(inv.select("row", "rel_path", "file_name", "suggested_lane", "estimated_entities", "is_bde"), "calls")  # read for each probe
    gold = gold.withColumn("truth", parse_responsive(F.col("responsive")))
    hits = matched(inv, gold.filter("truth IS NOT NULL"))
    calls = inv.select(F.col("row").alias("inv_row"), lane_call(F.col("suggested_lane")).alias("pred"), "estimated_entities", "is_bde")
    joined = hits.join(calls, "inv_row", "left")
    gb = F.lower(F.trim("bde"))
    yes = gb.isin("1", "true", "yes", "y", "bde")
    if bde_threshold is None:
        same = F.col("is_bde") == yes
    else:
        same = (F.col("estimated_entities") >= bde_threshold) == F.coalesce(_number(gb) >= bde_threshold, yes)
    scored = F.col("pred").isNotNull() & F.coalesce(gb != "", F.lit(False))
    p, t = F.col("pred"), F.col("truth")

    def n(x: Column) -> Column:
        return F.count_if(F.coalesce(x, F.lit(False)))

    out = joined.agg(
        n(p & t).alias("tp"), n(p & ~t).alias("fp"), n(~p & t).alias("fn"), n(~p & ~t).alias("tn"),
        n(F.col("inv_row").isNotNull() & p.isNull()).alias("undetermined"), n(F.col("inv_row").isNull()).alias("unmatched"), F.count("inv_row").alias("matched"),
        n(scored).alias("bde_total"), n(scored & same).alias("bde_correct"))
    blank = gold.agg(n(F.col("truth").isNull()).alias("unscored_blank_label"), F.count("*").alias("gold_rows"))
    out = out.join(blank)  # one row each
    if absent_means == "zero":
        absent = calls.join(hits.select("inv_row").filter("inv_row IS NOT NULL").distinct(), "inv_row", "left_anti")
        out = out.join(absent.agg(n(p).alias("absent_fp"), n(~p).alias("absent_tn")))
        out = out.withColumns({"fp": F.col("fp") + F.col("absent_fp"), "tn": F.col("tn") + F.col("absent_tn"), "assumed_nr": F.col("absent_fp") + F.col("absent_tn")}).drop("absent_fp", "absent_tn")
    else:
        out = out.withColumn("assumed_nr", F.lit(0).cast("long"))

    def prf(prefix: str, a: str, b: str, c: str) -> dict[str, Column]:
        tp, fp, fn = F.col(a), F.col(b), F.col(c)
        return {f"{prefix}_precision": round_even(ratio(tp, tp + fp), 4), f"{prefix}_recall": round_even(ratio(tp, tp + fn), 4), f"{prefix}_f1": round_even(ratio(2 * tp, 2 * tp + fp + fn), 4)}

    out = out.withColumns(prf("responsive", "tp", "fp", "fn") | prf("nr", "tn", "fn", "fp"))
    return out.withColumn("bde_accuracy", round_even(F.col("bde_correct") / F.nullif(F.col("bde_total").cast("double"), F.lit(0.0)), 4)).drop("bde_correct")


def unmatched_gold(inv: DataFrame, gold: DataFrame) -> DataFrame:
    inv = written(inv.select("row", "rel_path", "file_name"), "names")
    return matched(inv, gold.filter(parse_responsive(F.col("responsive")).isNotNull())).filter("inv_row IS NULL").select("id")


VIEWS = {"stage1": stage1_call, "stage2": stage2_call, "pipeline": pipeline_call, "union": union_call}


def _stacked(df: DataFrame, calls: dict[str, Column]) -> DataFrame:
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("view"), v.alias("pred")) for k, v in calls.items())))
    return df.select("*", pairs.alias("v")).select("*", "v.view", "v.pred").drop("v")


def scorecard(scored: DataFrame) -> DataFrame:
    """Matrices of stage 1, stage 2, pipeline and union. scored is the inventory with ``human`` (entities counted), truth = human > 0."""
    rows = _stacked(scored.withColumn("truth", F.col("human") > 0), {k: f() for k, f in VIEWS.items()})
    return rates(confusion(rows, "view"))


def bde_definitions(scored: DataFrame, threshold: int = 6) -> DataFrame:
    """Matrices of five ways to call a file about many people, against human > threshold."""
    lane = F.col("suggested_lane").isin(*BDE_LANES)
    calls = {"flag": F.col("is_bde"), "lane": lane, "effective": effective_count() > threshold, "lane_or_people": lane | (F.col("bde_person_count") > threshold), "stage2": F.col("s2_is_bde")}
    return rates(confusion(_stacked(scored.withColumn("truth", F.col("human") > threshold), calls), "view"))


def count_accuracy(scored: DataFrame, threshold: int = 6) -> DataFrame:
    """How well true BDEs were counted. The median is the upper one, by rank."""
    t = threshold + 1
    rows = scored.filter(F.col("human") > threshold).select(F.col("estimated_entities").alias("raw"), effective_count().alias("eff"), F.abs(effective_count() - F.col("human")).alias("err"))
    sums = rows.agg(F.count("*").alias("n_true_bde"), F.count_if(F.col("raw") >= t).alias("raw_ge"), F.count_if(F.col("eff") >= t).alias("eff_ge"), round_even(F.avg("err"), 6).alias("mean_err"))
    # rank over counts by error: a row for each distinct error, not for each file
    by = rows.groupBy("err").agg(F.count("*").alias("k"))
    run = by.withColumn("upto", F.sum("k").over(Window.orderBy("err"))).withColumn("all", F.sum("k").over(Window.partitionBy()))
    median = run.filter(F.col("upto") > F.floor(F.col("all") / 2)).agg(F.min("err").alias("median_err"))
    out = sums.join(median)
    return out.withColumns({"rescued": F.col("eff_ge") - F.col("raw_ge"), "still_missed": F.col("n_true_bde") - F.col("eff_ge")})


def missed_bde(scored: DataFrame, threshold: int = 6) -> DataFrame:
    """True BDEs whose effective count stays below them, by type and searchable."""
    rows = scored.filter((F.col("human") > threshold) & (effective_count() < threshold + 1))
    return rows.groupBy(type_of(F.col("ext")).alias("ftype"), "searchable").agg(F.count("*").alias("files"))


def overview(inv: DataFrame) -> DataFrame:
    """What a scorecard says without truth: files by type, searchable, lane, stage-2 lane and final verdict."""
    final = F.when(verdict().isNull(), "undetermined").when(verdict(), "R").otherwise("NR")
    keys = [type_of(F.col("ext")).alias("ftype"), "searchable", "suggested_lane", "s2_lane", final.alias("verdict")]
    return inv.groupBy(*keys).agg(F.count("*").alias("files"), F.count_if("is_bde").alias("bde"), F.sum("estimated_entities").alias("estimated_entities"), F.sum("di_calls").alias("di_calls"), F.sum("llm_tokens_total").alias("tokens"))


def file_detail(scored: DataFrame) -> DataFrame:
    """One row per file with every call on it beside the truth, where there is one (column human)."""
    calls = {f"{k}_call": f() for k, f in VIEWS.items()}
    human = [F.col("human"), (F.col("human") > 0).alias("truth")] if "human" in scored.columns else []
    return scored.select("rel_path", type_of(F.col("ext")).alias("ftype"), "searchable", "programmatic", "suggested_lane", "s2_lane", *(v.alias(k) for k, v in calls.items()), "estimated_entities", "bde_person_count", effective_count().alias("effective_count"), "is_bde", "s2_is_bde", "detail", *human)


def sheets(inv: DataFrame, export: DataFrame | None = None, tasks: DataFrame | None = None, run_info: dict[str, str] | None = None, threshold: int = 6, absent_means: str = "unreviewed") -> dict[str, DataFrame]:
    """The scorecard's sheets by name, in order. Without an export those on accuracy are left out, without tasks those on time.

    inv needs ``row``; the same table is read for each sheet, so hand in a written one.
    """
    from . import fleet, reports

    info = inv.sparkSession.createDataFrame(sorted((run_info or {}).items()), "item string, value string")
    out = {"Run Info": info, "Summary": reports.summary(inv), "Overview": overview(inv)}
    if tasks is not None:
        done = tasks.filter(F.col("status") == "completed")
        per_file = done.select("job_id", "file_name", "worker_instance", "duration_ms", "attempt_count", "tokens_in", "tokens_out", F.element_at(F.split("file_name", r"\."), -1).alias("ext"))
        out |= {"Timing": fleet.duration_stats(tasks, "job_id"), "Run Timeline": fleet.minute_series(tasks), "Per-file Timing": per_file}
    if export is None:
        return out | {"File Detail": file_detail(inv)}
    scored = joined_truth(inv, export, absent_means)
    return out | {
        "NR-R": scorecard(scored), "BDE": bde_definitions(scored, threshold), "Count Accuracy": count_accuracy(scored, threshold), "Missed BDE": missed_bde(scored, threshold), "Metrics by Type": metrics_by_type(scored),
        "Stage 2": level_distribution(scored), "OCR Yield": ocr_yield(scored, threshold), "File Detail": file_detail(scored), "Misses": misses(scored)}


def metrics_by_type(scored: DataFrame) -> DataFrame:
    """Stage-1 matrices overall, by type, searchable, and (searchable, programmatic), each also by type: one grouping-sets sum, zero-filled."""
    rows = scored.select(type_of(F.col("ext")).alias("ftype"), "searchable", "programmatic", stage1_call().alias("pred"), (F.col("human") > 0).alias("truth"))
    p, t = F.col("pred"), F.col("truth")
    cells = {"tp": p & t, "fp": p & ~t, "fn": ~p & t, "tn": ~p & ~t, "undetermined": p.isNull()}
    aggs = [F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in cells.items()]
    f, s, g = F.col("ftype"), F.col("searchable"), F.col("programmatic")
    m = rows.groupingSets([[], [f], [s], [s, f], [s, g], [s, g, f]], f, s, g).agg(F.grouping_id().cast("int").alias("level"), *aggs)
    spark = scored.sparkSession
    types = [(x,) for x in TYPE_ORDER]
    both = [True, False]
    spine = [(7, None, None, None)] + [(3, x, None, None) for (x,) in types] + [(5, None, a, None) for a in both] + [(1, x, a, None) for (x,) in types for a in both]
    spine += [(4, None, a, b) for a in both for b in both] + [(0, x, a, b) for (x,) in types for a in both for b in both]
    wanted = spark.createDataFrame(spine, "level int, ftype string, searchable boolean, programmatic boolean")
    same = reduce(lambda a, b: a & b, (wanted[c].eqNullSafe(m[c]) for c in ("level", "ftype", "searchable", "programmatic")))
    out = wanted.join(m, same, "left").select(*(wanted[c] for c in wanted.columns), *(F.coalesce(m[k], F.lit(0)).alias(k) for k in cells))
    return rates(out)


def level_distribution(scored: DataFrame) -> DataFrame:
    """Stage-2 levels with the share of truly responsive files."""
    rows = scored.filter("s2_ran").withColumn("level", F.coalesce(F.nullif("s2_llm_responsiveness", F.lit("")), F.lit("(none)")))
    return rows.groupBy("level").agg(F.count("*").alias("files"), F.count_if(F.col("human") > 0).alias("truly_responsive")).withColumn("truth_rate", round_even(ratio(F.col("truly_responsive"), F.col("files")), 6))


def ocr_yield(scored: DataFrame, threshold: int = 6) -> DataFrame:
    """Files that gained text from embedded images, and what became of them."""
    return scored.filter(F.col("img_ocr_ok") > 0).groupBy("suggested_lane").agg(F.count("*").alias("files"), F.count_if(~F.col("nr_stage1")).alias("flagged"), F.count_if(F.col("human") > 0).alias("truly_responsive"), F.count_if(F.col("human") > threshold).alias("truly_bde"))


def two_pass_saving(inv: DataFrame) -> DataFrame:
    """Calls and pages that a second reading of the survivors would have cost."""
    on = ~F.col("nr_stage1")
    pages = F.col("ocr_pages") + F.col("img_ocr_calls")
    out = inv.agg(F.count("*").alias("files"), F.count_if(on).alias("survivors"), F.coalesce(F.sum("di_calls"), F.lit(0)).alias("di_calls"), F.coalesce(F.sum(F.when(on, F.col("di_calls"))), F.lit(0)).alias("repeat_di_calls"), F.coalesce(F.sum(F.when(on, pages)), F.lit(0)).alias("repeat_pages"))
    return out.withColumn("saved_pct", round_even(100 * ratio(F.col("repeat_di_calls"), F.col("di_calls") + F.col("repeat_di_calls")), 2))


def misses(scored: DataFrame, top: int = 25) -> DataFrame:
    """Truly responsive files that stage 1 cleared, most entities first."""
    return scored.filter((F.col("human") > 0) & ~stage1_call()).select("rel_path", "human", "suggested_lane").orderBy(F.desc("human"), "rel_path").limit(top)


def status_cross_check(scored: DataFrame, status: DataFrame) -> DataFrame:
    """How often reviewers' statuses (id, status) agree with the counts they exported (id = norm_id)."""
    j = status.withColumn("manual", manual_status(F.col("status"))).join(scored.select("id", (F.col("human") > 0).alias("truth")), "id")
    return j.agg(F.count("*").alias("matched"), F.count("manual").alias("recognised"), round_even(F.avg((F.col("manual") == F.col("truth")).cast("double")), 6).alias("agreement"))


def joined_truth(inv: DataFrame, export: DataFrame, absent_means: str = "unreviewed", inv_id: Column | None = None, export_id: Column | None = None) -> DataFrame:
    """The inventory with ``human``: the export's largest count for the same id; without one left out, or 0 for ``zero``.

    inv needs ``row``; the first inventory row of an id wins. export has id and total.
    """
    from ..functions.text import norm_id

    inv = inv.withColumn("id", norm_id(F.col("rel_path")) if inv_id is None else inv_id)
    inv = _first(inv, "id", F.col("row"))
    best = export.select((norm_id(F.col("id")) if export_id is None else export_id).alias("id"), F.regexp_replace(F.col("total").cast("string"), ",", "").try_cast("double").try_cast("long").alias("n")).filter("n IS NOT NULL").groupBy("id").agg(F.max("n").alias("human"))
    if absent_means == "zero":
        return inv.join(best, "id", "left").withColumn("human", F.coalesce("human", F.lit(0)))
    return inv.join(best, "id")
