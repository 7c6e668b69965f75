"""Line deduplication against DuckDB on whole tables and on odd rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from censuskit.llm import lines
from tests.conftest import SF001, SF01


@pytest.mark.parametrize("folder", [SF001, SF01])
def test_report_equals_sql(spark, folder):
    got = lines.page_report(spark.read.parquet(f"{folder}/pages.parquet")).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    want = con.sql(lines.REPORT_SQL).fetchall()
    assert sorted(tuple(r) for r in got) == sorted(want)
    if folder == SF01:
        assert sum(r.n_dropped for r in got) > 0


def test_odd_pages(spark):
    rows = [(i, "http://A.org/x", f"<p>menu</p><p>own {i}</p><script>menu</script><p> menu </p>") for i in range(12)]
    rows += [(50, "http://b.org", "<p>menu</p>"), (51, None, "<p>menu</p>"), (52, "nonsense", "<p>menu"), (53, "http://a.org:80/", None), (54, "ftp://u:p@a.org?q", ""), (1, *rows[1][1:]), (None, "http://a.org", "x" * 300_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, lines int")
    got = {(str(r.page_id), r.host, r.n_lines, r.n_dropped) for r in lines.page_report(df).collect()}
    assert {("0", "a.org", 3, 2), ("50", "b.org", 1, 0), ("51", None, 1, 0), ("52", None, 1, 0), ("53", "a.org", 0, 0), ("54", "a.org", 0, 0), ("None", "a.org", 1, 0)} <= got
    assert lines.page_report(df).count() == len(rows)
    assert lines.page_report(df.limit(0)).count() == 0


def test_text_lines(spark):
    rows = [(i, f"top\n\nbody {i}\n top ", "s") for i in range(20)] + [(30, "top", None), (31, None, "s"), (32, "top", "t"), (33, "", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in lines.drop_text_lines(df).collect()}
    assert got == {**{i: f"\nbody {i}" for i in range(20)}, 30: "top", 31: None, 32: "top", 33: ""}
    wide = df.withColumn("lines", F.split("text", "\n")).drop("text")
    one, two = (sorted(map(str, lines.drop_lines(wide, "source", "lines", broadcast_marks=n).collect())) for n in (0, 100))
    assert one == two  # joined by site, and broadcast
    few = df.where("doc_id < 4")
    assert {r.text for r in lines.drop_text_lines(few, least_pages=5).collect()} == {t for _, t, _ in rows[:4]}
    assert lines.drop_text_lines(df).schema == df.schema
    # At the ratio itself a line stays.
    assert {r.text for r in lines.drop_text_lines(df.where("doc_id < 20"), ratio=1.0).collect()} == {t for _, t, _ in rows[:20]}
