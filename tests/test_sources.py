"""Census readers: CSV folder layout, Parquet round trip, derived census."""

import os

import pytest
from pyspark.sql import functions as F

from censuskit.schema import CENSUS_COLUMNS, MEASURES, PERIOD, STATE, TOTAL
from censuskit.sources import census
from censuskit.sources.fixtures import quota_split
from tests.conftest import SF001, rows


def test_csv_layout_by_name(spark, tmp_path):
    base = tmp_path / "census_csv"
    for year, state, order in [("2018_2019", "Kerala", 1), ("2019_2020", "Karnataka", -1)]:
        d = base / year / state
        os.makedirs(d)
        cols = ["State_Name", "District_Name", "location ", "Total_Number_of_Schools", "Ramps", "Building"][::order]
        vals = {"State_Name": state, "District_Name": "x", "location ": "Rural",
                "Total_Number_of_Schools": "10", "Ramps": "4", "Building": "9"}
        (d / "part.csv").write_text(",".join(cols) + "\n" + ",".join(vals[c] for c in cols) + "\n")
    os.makedirs(base / "2019_2020" / "Empty")  # a folder without files is skipped
    df = census.read_census_csv(spark, str(base))
    assert df.columns == CENSUS_COLUMNS
    assert rows(df, STATE, PERIOD, TOTAL, "Ramps") == [("Karnataka", "2019_2020", 10, 4), ("Kerala", "2018_2019", 10, 4)]
    assert {r[0] for r in df.select("Location").collect()} == {"Rural"}
    zero = census.read_census_csv(spark, str(base), null_policy="zero")
    assert zero.where(F.col("Playground").isNull()).count() == 0


def test_csv_column_order_may_differ_inside_a_folder(spark, tmp_path):
    d = tmp_path / "base" / "2018_2019" / "Tamil Nadu+x"
    os.makedirs(d)
    (d / "a.csv").write_text("Total_Number_of_Schools,Ramps\n10,4\n")
    (d / "b.csv").write_text("Ramps,Total_Number_of_Schools\n4,10\nx,7\n")
    (d / "c.csv").write_text("")
    df = census.read_census_csv(spark, str(tmp_path / "base"))
    assert sorted(map(tuple, df.select(STATE, PERIOD, TOTAL, "Ramps").collect()), key=str) == [
        ("Tamil Nadu+x", "2018_2019", 10, 4), ("Tamil Nadu+x", "2018_2019", 10, 4), ("Tamil Nadu+x", "2018_2019", 7, None)]
    bad = {r[0]: r[1] for r in census.bad_census_values(spark, str(tmp_path / "base")).collect() if r[1]}
    assert bad == {"Ramps": 1}


@pytest.mark.parametrize("layouts", [1, 3])
def test_csv_bytes_are_read_once_whatever_the_headers(spark, tmp_path, layouts):
    names = ["Total_Number_of_Schools", "Ramps", "Newspaper", "District_Name"]
    for i in range(layouts):
        d = tmp_path / "base" / "2018_2019" / f"S{i}"
        os.makedirs(d)
        cols = names[i:] + names[:i]
        value = {"Total_Number_of_Schools": "10", "Ramps": str(i), "Newspaper": "2", "District_Name": '"a, b"'}
        good = ",".join(value[c] for c in cols)
        (d / "a.csv").write_text("\n".join([",".join(cols), good, good + ",extra", "", ",".join(value[c] for c in cols[:2]), good]) + "\n")
    base = str(tmp_path / "base")
    once = census._csv_text(spark, f"{base}/*/*/*.csv")._jdf.queryExecution().executedPlan().toString()
    assert once.count("FileScan text") == 1
    df = census.read_census_csv(spark, base)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "FileScan csv" not in plan and plan.count("FileScan parquet") == 2  # rows and headers
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    whole = [r for r in df.select(STATE, TOTAL, "Ramps", "Newspaper", "District_Name").collect() if r.District_Name and r.Newspaper and r[1]]
    assert sorted(map(tuple, whole)) == sorted((f"S{i}", 10, i, 2, "a, b") for i in range(layouts) for _ in range(3))
    assert {tuple(r) for r in census.bad_census_rows(spark, base).collect()} == {("2018_2019", f"S{i}", 4, 2) for i in range(layouts)}
    # Files that change are read again.
    (tmp_path / "base" / "2018_2019" / "S0" / "b.csv").write_text("Ramps,Total_Number_of_Schools\n1,1\n")
    assert census.read_census_csv(spark, base).count() == 4 * layouts + 1


def test_csv_problems_are_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        census.read_census_csv(spark, str(tmp_path / "none"))
    d = tmp_path / "base" / "2018_2019" / "A"
    os.makedirs(d)
    (d / "a.csv").write_text("1,2\n3,4\n")
    with pytest.raises(ValueError):
        census.read_census_csv(spark, str(tmp_path / "base"))


def test_census_files_do_not_grow_with_tasks(spark, tmp_path):
    many = census.derived_rows(spark, SF001).repartition(40)
    census._write_partitioned(many, str(tmp_path / "many"))
    files = [f for _, _, names in os.walk(tmp_path / "many") for f in names if f.endswith(".parquet")]
    assert len(files) == 7 * 5  # a file for each year and state


def test_checkpoint_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from censuskit.sources import storage

    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, applicationId="a")
    with pytest.raises(RuntimeError):
        storage.checkpoint_root(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: d)))


def test_parquet_round_trip(spark, tmp_path):
    df = quota_split(spark)
    for m in MEASURES:
        df = df.withColumn(m, F.lit(None).cast("int"))
    path = str(tmp_path / "census")
    census.write_census(df, path)
    back = census.read_census(spark, path)
    assert back.columns == CENSUS_COLUMNS
    assert back.count() == 300
    assert dict(back.dtypes)[PERIOD] == "string"
    parts = sorted(p for p in os.listdir(path) if p.startswith(PERIOD))
    assert parts == ["Academic_Year=2019_2020"]


def test_derived_census_shape(spark):
    c = census.census_table(spark, SF001)
    assert c.columns == CENSUS_COLUMNS
    assert {r[0] for r in c.select(PERIOD).distinct().collect()} == {f"{y}_{y + 1}" for y in range(2017, 2024)}
    assert c.where(F.col(TOTAL) == 0).count() > 0
    assert c.where(F.col("Ramps").isNull()).count() > 0
    assert c.where(F.col("Ramps") > F.col(TOTAL)).count() == 0
    # Materialised once per session: same files on a second call.
    assert census.census_table(spark, SF001).inputFiles() == c.inputFiles()


def test_content_fingerprint_tracks_changes(spark, tmp_path):
    from censuskit.sources import storage

    d = tmp_path / "table"
    d.mkdir()
    (d / "part-0.csv").write_text("a\n1\n")
    before = storage.content_fingerprint(spark, [str(d)])
    assert storage.content_fingerprint(spark, [str(d)]) == before
    (d / "part-1.csv").write_text("a\n2\n")
    assert storage.content_fingerprint(spark, [str(d)]) != before
    assert storage.path_exists(spark, str(d / "part-1.csv"))
    assert not storage.path_exists(spark, str(d / "missing"))


def test_union_all_balanced(spark):
    from censuskit.sources.census import union_all

    frames = [spark.range(i, i + 1) for i in range(9)]
    assert sorted(r[0] for r in union_all(frames).collect()) == list(range(9))
