"""Queries on tables that are larger than the limits of a scan of files, against their SQL."""

from __future__ import annotations

import plain_core as P
from oracle import compared
from pyspark.sql import functions as F

from veilscan import cases as C
from veilscan import queries
from veilscan.functions import text
from veilscan.functions import vocab as V
from veilscan.operators import video
from veilscan.sources.files import html_text


def customers(spark, folder, n: int, nations: int = 1) -> str:
    spark.range(n).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", f"cast(id % {nations} AS int) AS c_nationkey").write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def agrees(spark, name: str, folder: str) -> bool:
    mine, theirs = compared(queries.QUERIES[name](spark, folder), queries.SQL[name], folder)
    return mine == theirs and bool(theirs)


def test_rows_beyond_the_detail_of_a_scan_are_read(spark, tmp_path):
    assert agrees(spark, "table_row_pii", customers(spark, tmp_path, 5003))


def test_summary_beyond_the_detail_of_a_scan(spark, tmp_path):
    assert agrees(spark, "table_summary", customers(spark, tmp_path, 5003))


def test_summary_beyond_the_rows_of_a_scan(spark, tmp_path):
    assert agrees(spark, "table_private", customers(spark, tmp_path, 50_003))


def tasks(df) -> int:
    return df.rdd.getNumPartitions()


def test_texts_of_one_small_file_are_scored_in_many_tasks(spark):
    assert tasks(queries.people(spark, "/root/testdata/sf0.001")) >= spark.sparkContext.defaultParallelism > 1


def test_cases_of_one_small_file_are_scored_in_many_tasks(spark):
    assert tasks(queries._cases(spark, "/root/testdata/sf0.001", C.RISKS)) >= spark.sparkContext.defaultParallelism


def test_regions_of_one_small_file_are_made_in_many_tasks(spark):
    assert tasks(queries.frame_regions(spark, "/root/testdata/sf0.001")) >= spark.sparkContext.defaultParallelism


def test_regions_agree_with_those_of_one_frame(spark):
    shapes = [(w, h, d) for w in (79, 80, 100, 640, 1999) for h in (79, 80, 101, 640, 1100) for d in (None, (-5, -5, w + 5, 300), (0, 0, 9999, 9999), (10, 10, 50, 50))]
    rows = spark.createDataFrame(shapes, "w int, h int, d array<int>")
    got = rows.select("w", "h", "d", video.regions(F.col("w"), F.col("h"), F.col("d")).alias("r")).collect()
    for r in got:
        assert [(b.name, tuple(b.box)) for b in r.r] == video.bands(r.w, r.h, r.d), r


def test_lost_ligatures_take_a_few_replacements_a_text(spark):
    """Not three for each of the 41 words; all words get their letters back in the case they have."""
    words = [w for bad in V.LOST_LIGATURES for w in (bad, bad.upper(), bad.capitalize(), bad[0] + bad[1:].upper(), f"x{bad}", f"{bad}-{bad}")]
    texts = [(i, f"nd, {w}. {words[i * 7 % len(words)]} Nds\tNDING  {w}x \0") for i, w in enumerate(words)]
    df = spark.createDataFrame(texts, "i int, t string").select("i", text.normalize(F.col("t")).alias("t"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") < 20
    assert {r.i: r.t for r in df.collect()} == {i: P.normalized(t) for i, t in texts}


def test_pages_go_to_python_in_small_batches(spark):
    """Arrow's batches have ten thousand pages of any size, which a worker holds together."""
    pages = spark.createDataFrame([(0, "<p>a<script>b</script></p>"), (1, None)], "i int, html string")
    df = pages.select("i", html_text("html").alias("t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert {r.i: r.t for r in df.collect()} == {0: "a", 1: None}
