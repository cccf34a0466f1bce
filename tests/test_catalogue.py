"""Registered queries against their SQL, on tables made to tell them apart."""

import pytest
from pyspark.sql import functions as F

TABLES = {
    "documents": ("doc_id long, text string", [(i, f"{3280 + i} zuch stöbe" + " und so fort" * i) for i in range(4)] + [(9, "1,200.50"), (10, None)]),
    "pages": ("page_id long, html string", [(1, "<p>12 zuch stö</p>")]),
    "conversations": ("conv_id long, turn int, role string, text string", [(1, 1, "user", "7 alte stößel"), (1, 2, "assistant", "ja")]),
    "orders": ("o_orderkey long", [(15,), (16,)]),
    "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "Customer#1", 3, 1.0, "BUILDING")]),
}


@pytest.mark.parametrize("name", ["cost_summary", "model_failures", "model_failures_noted"])
def test_accented_words_count_as_in_the_sql(spark, tmp_path, name):
    import duckdb

    import __spark_entry__ as e

    db = duckdb.connect()
    for t, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = e.queries()[name](spark, str(tmp_path))
    wanted = db.sql(f"SELECT {', '.join(got.columns)} FROM ({e.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(wanted) and wanted


# Rows on which a matcher with look-around, the JVM's letters and spaces, or another order would differ from the SQL.
ODD = TABLES | {
    "documents": ("doc_id long, text string", list(enumerate(["dob aaaaaaaaaaaaaaaaaaaa dob 1/2/1990", "passport iban passport st12-3456789", "dl # dl # 9Street pin 12345", "(555)123-4567 555-123-4567", "Mr.\x0bSmith", "12 \u017ft", "9\u017falary", "\u212apassword", "born on aaaaaaaaaaaa born on 1/2/1990"]))),
    "pages": ("page_id long, html string", [(1, "<style>a<script>b</style>Mr. Smith</script>"), (2, "<style>a</style><script>b</script>Mr. Smith")]),
    "conversations": ("conv_id long, turn int, role string, text string", [(1, None, "user", "Mr."), (1, 2, "assistant", "Smith"), (2, 1, "user", None), (2, None, "user", None)]),
    "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "Smith, John", 3, 1.0, "BUILDING"), (2, "x", None, 1.0, None), (3, "y", None, 1.0, None)]),
}


def held_against_sql(spark, folder, tables, name):
    import duckdb

    import __spark_entry__ as e

    db = duckdb.connect()
    for t, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    got = e.queries()[name](spark, str(folder))
    wanted = db.sql(f"SELECT {', '.join(got.columns)} FROM ({e.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted)) and wanted


@pytest.mark.parametrize("name", ["model_failures", "model_failures_noted", "entity_buckets", "ambiguity_classes", "html_strip_pages"])
def test_odd_rows_count_as_in_the_sql(spark, tmp_path, name):
    held_against_sql(spark, tmp_path, ODD, name)


def test_customers_without_a_key_have_the_size_of_the_sql(spark, tmp_path):
    rows = [(None, "x", 5, 1.0, "BUILDING"), (1, "y", 5, 1.0, None), (None, "z", 6, 1.0, "BUILDING")]
    held_against_sql(spark, tmp_path, TABLES | {"customer": (TABLES["customer"][0], rows)}, "model_failures_noted")


def test_a_comparison_shuffles_only_what_it_compares(spark, tmp_path):
    from paperlane.operators import diff

    rows = [(k, k, lane, False, "many labels") for k, lane in (("a", "x"), ("b", "y"))]
    runs = [diff.keyed(spark.createDataFrame(r, "rel_path string, row string, suggested_lane string, llm_consulted boolean, entities_found string"), F.col("rel_path")) for r in (rows, rows[:1])]
    out = diff.rules_decided(*runs)
    assert tuple(out.first()) == (1, 1, 0, 1, 0)
    join = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" in join and "entities_found" not in join.split("LogicalRDD")[0]


@pytest.mark.parametrize("units", [1005, 1015, 1035, 66060])
def test_money_is_rounded_as_in_the_sql(spark, tmp_path, units):
    """Sums such as 1.015 lie a little off the half that they print as."""
    import duckdb

    import __spark_entry__ as e

    db = duckdb.connect()
    sizes = [899] * (units // 899) + [units % 899]
    for t, (schema, _) in TABLES.items():
        rows = [(i, "-" * n) for i, n in enumerate(sizes)] if t == "documents" else []
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = e.queries()["cost_summary"](spark, str(tmp_path))
    wanted = db.sql(f"SELECT {', '.join(got.columns)} FROM ({e.oracle_sql()['cost_summary']})").fetchall()
    assert list(map(tuple, got.collect())) == wanted and wanted[0][4] == units
