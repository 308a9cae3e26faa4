"""CSV with an account of every line, and tables in folders by year."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from delaylab.plans.inspect import physical
from delaylab.session import scratch_path
from delaylab.sources import layout, rejects


@pytest.fixture()
def files(tmp_path):
    (tmp_path / "a.csv").write_text(
        'Year,Origin,Delay\n2006,"San, Jose",5\n2006,X\n\n2007,Y,7,extra\n2007,"q, x",NA\n')
    (tmp_path / "b.csv").write_text("Year,Origin,Delay\n2008,Z,\n2008,é,1\n2008,only,a,b,c\n")
    return str(tmp_path)


def test_every_line_is_accounted_for(spark, files):
    found = rejects.ingest(spark, files)
    assert sorted(map(tuple, found.good.collect()), key=str) == sorted([
        ("2006", "San, Jose", "5"), ("2007", "q, x", "NA"), ("2008", "Z", None),
        ("2008", "é", "1")], key=str)
    lost = sorted((r.line, r.reason, r.n_fields, os.path.basename(r.file))
                  for r in found.rejected.collect())
    assert lost == [("2006,X", "too few fields", 2, "a.csv"),
                    ("2007,Y,7,extra", "too many fields", 4, "a.csv"),
                    ("2008,only,a,b,c", "too many fields", 5, "b.csv")]
    lines = [x for f in ("a.csv", "b.csv") for x in open(f"{files}/{f}") if x.strip()]
    assert (found.n_good, found.n_rejected) == (4, 3)
    assert found.n_good + found.n_rejected == len(lines) - 2
    assert sorted((r.reason, r.n) for r in rejects.rejected_summary(found).collect()) == [
        ("too few fields", 1), ("too many fields", 1), ("too many fields", 1)]


def test_the_files_are_parsed_once(spark, files):
    found = rejects.ingest(spark, files)
    for part in (found.good, found.rejected):
        plan = physical(part)
        assert "csv" not in plan.lower().replace(files, "") and "PartitionFilters" in plan


def test_quoted_separators_do_not_count(spark):
    lines = ['a,b,c', '"a,b",c', '"a ""x,y"" b",c,d', '', ',', '"unended,a']
    df = spark.createDataFrame([(x,) for x in lines], "l string")
    assert [r[0] for r in df.select(rejects.field_count(F.col("l"))).collect()] == [
        3, 2, 3, 1, 2, 2]


def test_a_file_with_another_header_is_an_error(spark, files):
    with open(f"{files}/c.csv", "w") as f:
        f.write("Year,Dest,Delay\n2008,Z,1\n")
    with pytest.raises(Exception):
        rejects.ingest(spark, files, ["Year", "Origin", "Delay"])


def test_reserved_names(spark, files):
    with pytest.raises(ValueError):
        rejects.ingest(spark, files, ["Year", "_line", "Delay"])


def years(spark, sign=1):
    return spark.range(3000).select(
        F.when(F.col("id") % 10 == 9, F.lit(None)).otherwise(
            (F.lit(2005) + F.col("id") % 3).cast("string")).alias("Year"),
        F.col("id"), (F.col("id") * sign).alias("v"))


def listing(path):
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.startswith("part-"))
            for d in sorted(os.listdir(path)) if "=" in d}


def local(path):
    return path.removeprefix("file:")


def test_rewriting_one_year_leaves_the_others(spark):
    path = scratch_path(spark, "years-test")
    layout.write_partitioned(years(spark), path)
    before = listing(local(path))
    assert set(before) == {"Year=2005", "Year=2006", "Year=2007",
                           "Year=__HIVE_DEFAULT_PARTITION__"}
    layout.write_partitioned(years(spark, -1).where("Year = '2006'"), path)
    after = listing(local(path))
    assert {d: f for d, f in after.items() if d != "Year=2006"} == {
        d: f for d, f in before.items() if d != "Year=2006"}
    assert after["Year=2006"] != before["Year=2006"]
    back = layout.read_partitioned(spark, path)
    assert back.schema["Year"].dataType.simpleString() == "string" and back.count() == 3000
    expected = years(spark).withColumn(
        "v", F.when(F.col("Year") == "2006", -F.col("v")).otherwise(F.col("v")))
    assert back.select("Year", "id", "v").exceptAll(expected).isEmpty()
    layout.write_partitioned(years(spark).where("id < 5"), path, replace="none")
    assert layout.read_partitioned(spark, path).count() == 3005
    layout.write_partitioned(years(spark).where("id < 5"), path, replace="all")
    assert layout.read_partitioned(spark, path).count() == 5


def test_reading_years_reads_their_folders_only(spark):
    path = scratch_path(spark, "years-test")
    layout.write_partitioned(years(spark), path)
    two = layout.read_partitioned(spark, path, only={"Year": ["2005", "2007"]})
    plan = physical(two)
    part = plan[plan.index("PartitionFilters"):]
    assert "2005" in part.split("]")[0] and "PushedFilters: []" in plan
    assert {r[0] for r in two.select("Year").distinct().collect()} == {"2005", "2007"}
    typed = layout.read_partitioned(spark, path, only={"Year": 2006}, types={"Year": "int"})
    assert typed.schema["Year"].dataType.simpleString() == "int" and typed.count() == 900
    with pytest.raises(ValueError):
        layout.read_partitioned(spark, path, only={"id": 3})
    with pytest.raises(ValueError):
        layout.write_partitioned(years(spark), path, replace="some")


def test_a_large_year_is_written_by_several_tasks(spark):
    path = scratch_path(spark, "years-test")
    layout.write_partitioned(years(spark), path, max_rows_per_file=200)
    assert len(listing(local(path))["Year=2005"]) >= 4


def test_convert_years(spark, flights_csv):
    path = scratch_path(spark, "years-test")
    found = layout.convert_years(spark, flights_csv, path)
    back = layout.read_partitioned(spark, path)
    assert back.count() == found.n_good > 0
    assert "ArrTime" not in back.columns and "Year" in back.columns
    layout.convert_years(spark, flights_csv, path)
    assert layout.read_partitioned(spark, path).count() == found.n_good
