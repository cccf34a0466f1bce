"""URL filters: host reputation by empirical Bayes, after explicit rules. Column expressions only.

Labelled outcomes of pages are summed by host, registered domain (the last two labels) and suffix (the last
label). Suffix rates shrink to the overall rate, domain rates to their suffix's, host rates to their domain's, each
through a beta-binomial prior whose weight is fitted by moments. A host whose lower posterior bound of the bad rate
is above ``max_bad`` is blocked; explicit rules go first.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule and is judged like any
other host; pages without labels get their domain's or suffix's rate; without any label everything is allowed;
labels whose fields are all null are no labels; repeated pages and labels count each time; other columns of the
inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

# The rules, verdict and host/path prefix.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
MAX_BAD = 0.5
Z = 1.645
MIN_WEIGHT, MAX_WEIGHT = 1.0, 1000.0


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null. rules is a parameter of bounded length."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _weight(rows: DataFrame, prior: Column) -> float:
    """The prior's weight from the variance of children's rates around ``prior``; rows have n and k."""
    rate = F.col("k") / F.col("n")
    s = rows.filter("n > 0").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (rate - prior) * (rate - prior)).alias("spread"),
        F.sum(prior * (1 - prior)).alias("noise"),
        F.sum(F.col("n") * prior * (1 - prior)).alias("binomial"),
    ).first()
    if not s["n"]:
        return MAX_WEIGHT
    between = (s["spread"] - s["noise"]) / s["n"]
    return min(max(s["binomial"] / s["n"] / between - 1, MIN_WEIGHT), MAX_WEIGHT) if between > 0 else MAX_WEIGHT


def reputations(outcomes: DataFrame) -> DataFrame:
    """From (host, n, k), one row per host with n labelled and k bad pages: host, rate, low.

    Tables by host, domain and suffix are joined on their keys; only single numbers come to the driver.
    """
    labels = F.split("host", r"\.")
    hosts = outcomes.withColumns({
        "domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
        "suffix": F.element_at(labels, -1),
    })
    hosts = written(hosts, "url-hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    mean = total["k"] / total["n"] if total["n"] else 0.0
    w = _weight(suffixes, F.lit(mean))
    suffixes = suffixes.select("suffix", ((F.col("k") + w * mean) / (F.col("n") + w)).alias("suffix_rate"))
    domains = written(domains.join(suffixes, "suffix"), "url-domains")
    w = _weight(domains, F.col("suffix_rate"))
    domains = domains.select("domain", ((F.col("k") + w * F.col("suffix_rate")) / (F.col("n") + w)).alias("domain_rate"))
    hosts = written(hosts.select("host", "domain", "n", "k").join(domains, "domain"), "url-host-priors")
    w = _weight(hosts, F.col("domain_rate"))
    rate = (F.col("k") + w * F.col("domain_rate")) / (F.col("n") + w)
    return hosts.select("host", rate.alias("rate"), (rate - Z * F.sqrt(rate * (1 - rate) / (F.col("n") + w + 1))).alias("low"))


def judged(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """page_id, host, path, rule, verdict, host_rate of every page.

    labels name a page in doc_id; a page is bad if its quality is 0 or it is toxic.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = labels.select(F.col("doc_id").alias("page_id"), (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad")).where(F.col("quality").isNotNull() | F.col("toxic").isNotNull())
    seen = parts.select("page_id", "host").join(known, "page_id", "left")
    outcomes = seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("k"))
    hosts = written(reputations(outcomes), "url-reputations")
    # An equi-join on the host: Spark broadcasts the reputations only below its size threshold and splits hot hosts otherwise.
    rows = parts.join(hosts, "host", "left")
    rows = rows.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    by_host = F.when(F.col("low") > max_bad, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", by_host).alias("verdict"), F.col("rate").alias("host_rate"))
