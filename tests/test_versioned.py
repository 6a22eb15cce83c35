"""Transactions on versioned tables: all or nothing, one writer a version, old readers undisturbed."""

import os

import pytest
from pyspark.sql import functions as F

from sensorlab.operators import quality
from sensorlab.sources.versioned import CheckFailed, Conflict, VersionedTable

ROWS = [(1, 0, "Power Failure"), (2, 1, "No Failure"), (3, 1, "Tool Wear Failure"), (4, 0, None), (5, None, "No Failure")]


@pytest.fixture()
def table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "sensors"))
    t.create(spark.createDataFrame(ROWS, "udi long, target int, failure_type string"))
    return t


def content(df):
    return sorted(map(tuple, df.collect()))


def folders(table):
    return sorted(n for n in os.listdir(table.path) if n.startswith("data-"))


def test_repair_is_one_version(table):
    before = table.read()
    assert quality.repair_labels(table) == 1
    assert content(table.read()) == [(1, 0, None), (2, 1, "Unspecified Failure"), (3, 1, "Tool Wear Failure"), (4, 0, None),
                                     (5, None, "No Failure")]
    assert content(before) == content(table.read(0)) == sorted(ROWS)      # a reader that had begun
    assert table.vacuum() == [0] and table.versions() == [1] and len(folders(table)) == 1


def test_a_failure_midway_keeps_the_old_table(table):
    broken = F.udf(lambda x: 1 // (3 - x), "int")                         # fails on one row, after others
    with pytest.raises(Exception, match="ZeroDivisionError"):
        table.transaction(lambda df: df.withColumn("target", broken("udi")))
    assert content(table.read()) == sorted(ROWS) and table.versions() == [0] and len(folders(table)) == 1
    assert quality.repair_labels(table) == 1


@pytest.mark.parametrize("change", [lambda df: df, lambda df: quality.fix_labels(df).where("udi > 1")])
def test_a_failed_check_keeps_the_old_table(table, change):
    with pytest.raises(CheckFailed):
        table.transaction(change, quality.repair_problem)
    assert content(table.read()) == sorted(ROWS) and len(folders(table)) == 1


def test_only_one_writer_commits_a_version(table):
    def slow(df):
        table.transaction(lambda x: x.where("udi <> 3"))                  # another writer is faster
        return df.where("udi <> 4")

    with pytest.raises(Conflict):
        folder = "data-1-mine"
        slow(table.read()).write.parquet(f"{table.path}/{folder}")
        table._commit(1, folder)
    assert content(table.read()) == [r for r in sorted(ROWS) if r[0] != 3]


def test_an_unfinished_manifest_is_no_version(table, spark):
    with open(f"{table.path}/_versions/1", "w") as f:
        f.write("data-1-half")
    assert table.versions() == [0] and content(table.read()) == sorted(ROWS)
    assert quality.repair_labels(table) == 2
    with pytest.raises(FileNotFoundError):
        table.read(1)
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, table.path + "-none").read()
