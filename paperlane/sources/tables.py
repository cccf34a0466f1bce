"""Tables as document corpora: each adapter gives rows of the extracted schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.detectors import as_read, is_roster_line, row_has_identifier
from ..functions.text import strip_html
from ..plans.rules import RuleList
from ..plans.schema import META


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def meta(**values: Column) -> Column:
    """The meta struct with the given fields, null elsewhere."""
    return F.struct(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in META))


def as_files(df: DataFrame, folder: str, key: str, ext: str, text: Column, size: Column | None = None, **fields: Column) -> DataFrame:
    """df's rows as extracted files ``folder/key.ext``."""
    name = F.concat(F.col(key).cast("string"), F.lit(ext))
    size = F.octet_length(text) if size is None else size
    return df.select(
        F.concat(F.lit(f"{folder}/"), name).alias("rel_path"), name.alias("file_name"), F.lit(ext).alias("ext"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size_bytes"), text.alias("text"), meta(**({"text_extractable": F.lit("text")} | fields)).alias("meta"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_files(table(spark, sf_dir, "documents"), "documents", "doc_id", ".txt", F.col("text"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_files(table(spark, sf_dir, "pages"), "pages", "page_id", ".html", strip_html(F.col("html"), in_turn=True), F.octet_length("html"))


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as one mail-like file each, turns in order, those without a number last."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(F.isnull("turn").alias("last"), "turn", "text"))).alias("t"))
    return as_files(turns, "threads", "conv_id", ".eml", F.array_join("t.text", "\n"), attachment_count=F.lit(0))


def structured(rows: DataFrame, key: str, row_text: Column, order: str, rules: RuleList, folder: str, sample_rows: int = 50, max_rows: int = (1 << 31) - 1) -> DataFrame:
    """Rows of a table as one structured file for each key: counts of rows, and the first rows as its text.

    Counts are summed map-side. The sample is the ``sample_rows`` least rows by order, kept by a bounded aggregate
    over ranks, so a key with many rows is never gathered.
    """
    flagged = rows.select(F.col(key).alias("k"), row_text.alias("line"), F.col(order).alias("o"))
    read = as_read(F.col("line"), rules)
    flagged = flagged.withColumn("person", row_has_identifier(read, rules)).withColumn("name", ~F.col("person") & is_roster_line(read))
    sums = flagged.groupBy("k").agg(F.count("*").alias("total"), F.sum((F.col("person") | F.col("name")).cast("long")).alias("people"), F.sum(F.octet_length("line").cast("long") + 1).alias("bytes"))
    from pyspark.sql import Window

    top = flagged.select("k", "line", "o").withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(F.asc_nulls_last("o"), "line"))).filter(F.col("r") <= sample_rows)
    text = top.groupBy("k").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "line"))), lambda x: x["line"]), "\n").alias("text"))
    files = sums.join(text.withColumnRenamed("k", "of"), F.col("k").eqNullSafe(F.col("of")))
    total = F.least(F.col("total"), F.lit(max_rows))
    return as_files(
        files, folder, "k", ".csv", F.col("text"), F.col("bytes"), is_structured=F.lit(True), structured_entity_rows=F.col("people"),
        structured_total_rows=total, estimate_truncated=F.col("total") > max_rows,
    )


def customers(spark: SparkSession, sf_dir: str, rules: RuleList) -> DataFrame:
    """Customers as one spreadsheet for each nation."""
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    line = F.concat_ws(" ", F.col("c_custkey").cast("string"), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols if c not in ("c_custkey", "c_acctbal")))
    return structured(table(spark, sf_dir, "customer"), "c_nationkey", line, "c_custkey", rules, "customers")


def forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filled-in forms: every kind of labelled value with real volume, by rule from the keys."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")

    def digits(n: int, factor: int) -> Column:
        return F.lpad(((k * factor) % (10**n)).cast("string"), n, "0")

    ssn = F.concat(digits(3, 7), F.lit("-"), digits(2, 3), F.lit("-"), digits(4, 11))
    first = F.element_at(F.array(*map(F.lit, ["Anna", "Boris", "Clara", "Dmitri"])), (k % 4 + 1).cast("int"))
    parts = [
        F.when(k % 2 == 0, F.concat(F.lit("Name: "), first, F.lit(" Miller. "))).otherwise(""),
        F.when(k % 3 == 0, F.concat(F.lit("SSN: "), ssn, F.lit(" . "))).otherwise(""),
        F.when(k % 5 == 0, F.concat(F.lit("Account No: "), digits(8, 13), F.lit(" . "))).otherwise(""),
        F.when(k % 7 == 0, F.concat(F.lit("Date of birth: 1/2/19"), digits(2, 1), F.lit(" . "))).otherwise(""),
        F.when(k % 11 == 0, F.concat(F.lit("Passport number X"), digits(7, 17), F.lit(" . "))).otherwise(""),
        F.when(k % 13 == 0, F.concat(digits(3, 1), F.lit(" Main Street . "))).otherwise(""),
        F.when(k % 17 == 0, F.concat(F.lit("Card 4"), digits(15, 7919 * 104729), F.lit(" . "))).otherwise(""),
        F.when(k % 19 == 0, F.lit("Please see the invoice. ")).otherwise(""),
    ]
    return as_files(o, "forms", "o_orderkey", ".txt", F.concat(*parts))
