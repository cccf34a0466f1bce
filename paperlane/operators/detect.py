"""Detection over a text column: counts by rule, labels, categories and the value signal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.detectors import as_read, count_of, has_digit, lowered, openings_found
from ..plans.rules import RuleList


def count_column(key: str) -> str:
    return f"c_{key}"


def counted(df: DataFrame, rules: RuleList, text: str = "text") -> DataFrame:
    """df with a column ``c_<KEY>`` for every rule.

    The counts leave a generator of one row. A filter on anything derived from them then stays above it, where a count
    is a plain column; through a projection it would be pushed with every pattern in it, as often as its count is used.
    Filters on df's own columns are still pushed below.
    """
    df = df.withColumn("__text", as_read(F.col(text), rules))
    df = df.withColumns({"__lower": lowered(F.col("__text")), "__digit": has_digit(F.col("__text"))})
    df = df.withColumn("__opened", openings_found(F.col("__text"), F.col("__lower"), rules))
    counts = F.struct(*(count_of(F.col("__text"), F.col("__lower"), F.col("__opened"), r, F.col("__digit"), rules.as_re2).alias(count_column(r.key)) for r in rules.rules))
    return df.select("*", F.inline(F.array(counts))).drop("__text", "__lower", "__digit", "__opened")


def labels_found(rules: RuleList) -> Column:
    return F.filter(F.array(*(F.when(F.col(count_column(r.key)) > 0, r.label) for r in rules.rules)), lambda x: x.isNotNull())


def categories_found(rules: RuleList) -> Column:
    found = F.array(*(F.when(F.col(count_column(r.key)) > 0, r.category) for r in rules.rules if r.category))
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull()))


def _some(keys: list[str]) -> Column:
    return F.greatest(F.lit(0), F.lit(0), *(F.col(count_column(k)) for k in keys)) > 0


def value_signal(rules: RuleList) -> Column:
    """Real personal data: any value-bearing finding, or a name with anything else."""
    out = _some(rules.value_keys)
    keys = [r.key for r in rules.rules]
    if "NAME" in keys:
        out = out | ((F.col(count_column("NAME")) > 0) & _some([k for k in keys if k != "NAME"]))
    return out


def detected(df: DataFrame, rules: RuleList, text: str = "text") -> DataFrame:
    """df with counts, labels, categories and value_signal."""
    df = counted(df, rules, text)
    return df.withColumns({"labels": labels_found(rules), "categories": categories_found(rules), "value_signal": value_signal(rules)})
