"""Many files with differing headers."""

import re

import pytest

from caselabel.sources import files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_csv_files_of_three_headers_are_three_scans(spark, tmp_path):
    headers = ("a,b", "ndd,relato,extra", "numero del caso,texto")
    paths, want = [], []
    for i in range(60):
        year = 2000 + i % 20
        path = tmp_path / f"robos {i} %41 {year}-x.csv"
        path.write_text(f"{headers[i % 3]}\n{i},text {i}{',z' if i % 3 == 1 else ''}\n", encoding="utf8")
        paths.append(str(path))
        want.append((f"{i:015}", f"text {i}", year))
    out = files.read_yearly_files(spark, paths, fmt="csv")
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert len(re.findall("FileScan csv", plan(out))) == 3


def test_same_names_of_other_types_are_another_header(spark, tmp_path):
    spark.range(3).selectExpr("id AS k", "'x' AS t").write.parquet(str(tmp_path / "2019"))
    spark.range(3).selectExpr("CAST(id + 5 AS STRING) AS k", "'y' AS t").write.parquet(str(tmp_path / "2020"))
    out = files.read_yearly_files(spark, [str(tmp_path / "2019"), str(tmp_path / "2020/")])
    assert sorted(map(tuple, out.collect())) == [(f"{i:015}", "x", 2019) for i in range(3)] + [(f"{i + 5:015}", "y", 2020) for i in range(3)]


def test_paths_without_year_repeated_paths_and_no_paths(spark, tmp_path):
    path = tmp_path / "robos 123 12345.csv"
    path.write_text("a,b\n1,uno\n", encoding="utf8")
    out = files.read_yearly_files(spark, [str(path), str(path)], fmt="csv")
    assert [tuple(r) for r in out.collect()] == [("0" * 14 + "1", "uno", None)] * 2
    with pytest.raises(ValueError):
        files.read_yearly_files(spark, [])
