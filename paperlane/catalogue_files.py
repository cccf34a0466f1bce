"""Registered queries over files: rows of the tables are written as files, listed, read and parsed again, and held against SQL on the rows."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalogue_sql as S
from .catalogue import _ROW, WHOLE, T, query, tasks
from .shared import new_folder
from .sources import files, sinks, workbook
from .sources.tables import table
from .streaming import watch

#: No file here is cut off.
ALL = replace(WHOLE, max_scan_rows=1 << 62)


def _folder(spark: SparkSession, name: str, *parts: DataFrame) -> str:
    """A new folder that holds the files (rel_path, content) of all parts."""
    root = new_folder(spark, name)
    for rows in parts:
        sinks.write_files(rows, root)
    return root


def _bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


_PATH = "CASE doc_id % 4 WHEN 0 THEN 'd' || doc_id % 7 || '/' || doc_id || '.txt' WHEN 1 THEN '_hidden/' || doc_id || '.TXT' WHEN 2 THEN '.h/_' || doc_id || '.txt' ELSE '.' || doc_id || '.md' END"


@query(f"""SELECT {_PATH} AS rel_path, CASE doc_id % 4 WHEN 3 THEN '.md' ELSE '.txt' END AS ext, octet_length(encode(coalesce(text, '')))::BIGINT AS size_bytes, CASE doc_id % 4 WHEN 3 THEN 'no_parser' ELSE 'ok' END AS status,
  sha256(CASE doc_id % 4 WHEN 3 THEN '' ELSE coalesce(text, '') END) AS text_sha256 FROM documents""")
def listed_files(spark, d):
    """Documents as files, most of them hidden by their name or their folder's."""
    rows = table(spark, d, "documents").select(F.expr(_PATH).alias("rel_path"), _bytes(F.col("text")).alias("content"))
    got = files.extracted(files.scan(spark, _folder(spark, "listed", rows), ALL), ALL)
    return got.select("rel_path", "ext", "size_bytes", F.coalesce("meta.status", F.lit("ok")).alias("status"), F.sha2("text", 256).alias("text_sha256"))


@query("SELECT 'c' || conv_id || '/' || turn || '.eml' AS rel_path, sha256(coalesce(role, '') || chr(10) || coalesce(text, '')) AS text_sha256, 0 AS attachments FROM conversations")
def mail_files(spark, d):
    """Turns as mails: the role is the subject, the text the body."""
    mail = F.concat(F.lit("Subject: "), F.coalesce("role", F.lit("")), F.lit("\nMIME-Version: 1.0\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n"), F.coalesce("text", F.lit("")))
    rows = table(spark, d, "conversations").select(F.concat(F.lit("c"), "conv_id", F.lit("/"), "turn", F.lit(".eml")).alias("rel_path"), _bytes(mail).alias("content"))
    got = files.extracted(files.scan(spark, _folder(spark, "mails", rows), ALL), ALL)
    return got.select("rel_path", F.sha2("text", 256).alias("text_sha256"), F.col("meta.attachment_count").alias("attachments"))


@query(f"""WITH r AS (SELECT 'n' || c_nationkey || '/p' || c_custkey // 100 || '.csv' AS rel_path, {_ROW} || ' ' || c_custkey AS line FROM customer)
SELECT rel_path, count(*)::INT AS total_rows, count_if({S._identifier('line')} OR {S._roster_line('line')})::INT AS people FROM r GROUP BY rel_path""")
def delimited_files(spark, d):
    """Customers as files of rows, a hundred numbers of a nation to a file: rows, and rows that name a person."""
    line = F.expr(_ROW.replace("::VARCHAR", "::STRING"))
    rows = table(spark, d, "customer").select(F.concat(F.lit("n"), "c_nationkey", F.lit("/p"), F.floor(F.col("c_custkey") / 100), F.lit(".csv")).alias("rel_path"), "c_custkey", F.concat(F.lit('"'), line, F.lit('",'), "c_custkey").alias("row"))
    rows = rows.groupBy("rel_path").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", "row"))), lambda x: x["row"]), "\n").alias("text"))  # at most a hundred
    got = files.extracted(files.scan(spark, _folder(spark, "rows", rows.select("rel_path", _bytes(F.col("text")).alias("content"))), ALL), ALL)
    return got.select("rel_path", F.col("meta.structured_total_rows").alias("total_rows"), F.col("meta.structured_entity_rows").alias("people"))


_BOOKS = ("region", "nation", "supplier")


@query(f"SELECT 'tables.xlsx' AS rel_path, {len(_BOOKS)}::INT AS sheets, ({' + '.join(f'(SELECT count(*) FROM {t})' for t in _BOOKS)} + {len(_BOOKS)})::INT AS total_rows")
def workbook_files(spark, d):
    """Tables as the sheets of one workbook, read back from it."""
    root = new_folder(spark, "book")
    workbook.write({t: table(spark, d, t) for t in _BOOKS}, f"{root}/tables.xlsx")
    got = files.extracted(files.scan(spark, root, ALL), ALL)
    return got.select("rel_path", F.col("meta.page_or_sheet_count").alias("sheets"), F.col("meta.structured_total_rows").alias("total_rows"))


@query(f"""{T} SELECT DISTINCT job_id || '/files/' || file_name AS rel_path, job_id AS job_dir, CASE WHEN right(job_id, 1)::INT < 4 THEN right(job_id, 1)::INT + 10 END AS job_bde_threshold,
  CASE WHEN right(job_id, 1)::INT % 2 = 0 THEN 'only ' || job_id END AS job_protocol FROM tasks""")
def job_protocols(spark, d):
    """Each job's threshold and protocol, from the files beside its own."""
    jobs = tasks(spark, d).select("job_id", F.right("job_id", F.lit(1)).cast("int").alias("n")).distinct()
    given = jobs.filter("n < 4").select(F.concat("job_id", F.lit("/pii_job.json")).alias("rel_path"), _bytes(F.to_json(F.struct((F.col("n") + 10).alias("bde_threshold")))).alias("content"))
    told = jobs.filter("n % 2 = 0").select(F.concat("job_id", F.lit("/Protocol.txt")).alias("rel_path"), _bytes(F.concat(F.lit("only "), "job_id")).alias("content"))
    rows = tasks(spark, d).select(F.concat("job_id", F.lit("/files/"), "file_name").alias("rel_path")).distinct()
    return files.with_jobs(rows, files.jobs_below(spark, _folder(spark, "jobs", given, told))).select("rel_path", "job_dir", "job_bde_threshold", "job_protocol")


@query(f"{T} SELECT DISTINCT job_id, file_name AS rel_path FROM tasks WHERE status = 'completed' AND row_key::BIGINT % 3 <> 0")
def watched_results(spark, d):
    """Results of completed tasks, collected in two passes: at the first, a fifth of the files are half written."""
    rows = tasks(spark, d).filter("CAST(row_key AS BIGINT) % 3 <> 0").select("job_id", (F.col("row_key").cast("long") / 500).cast("long").alias("part"), F.to_json(F.struct(F.col("file_name").alias("rel_path"), "job_id", F.lit("ok").alias("status"))).alias("line"))
    rows = rows.groupBy("job_id", "part").agg(F.array_join(F.collect_list("line"), "\n").alias("text"))  # at most five hundred, about fifty
    name = F.concat("job_id", F.lit("/"), "part", F.lit(".json")).alias("rel_path")
    half = F.when(F.col("part") % 5 == 0, F.substring("text", F.lit(1), F.length("text") - 9)).otherwise(F.col("text"))
    root, out = _folder(spark, "results", rows.select(name, _bytes(half).alias("content"))), new_folder(spark, "watched")
    watch.pass_once(spark, tasks(spark, d), root, out)
    sinks.write_files(rows.filter("part % 5 = 0").select(name, _bytes(F.col("text")).alias("content")), root)
    watch.pass_once(spark, tasks(spark, d), root, out)
    return watch.collected(spark, tasks(spark, d), out)[0].select("job_id", "rel_path")
