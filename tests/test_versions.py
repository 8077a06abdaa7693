"""Versioned tables: pointer, manifests, failed batches, vacuum."""

import pytest
from pyspark.sql import functions as F

from firn.sources.versions import VersionedStore

SCHEMA = "day date, k long, v string"


@pytest.fixture
def store(spark, tmp_path):
    return VersionedStore(spark, str(tmp_path / "s"), {"t": ("day", SCHEMA), "u": ("k", "k long, w long")})


def rows(spark, *r):
    return spark.createDataFrame([(d, k, v) for d, k, v in r], "day string, k long, v string").withColumn("day", F.to_date("day"))


def test_empty_and_first(spark, store):
    assert store.version() == 0 and store.read("t").collect() == []
    store.stage("t", rows(spark, ("2024-01-01", 1, "a"), (None, 2, "b")))
    assert store.read("t").count() == 0
    assert store.commit() == 1
    assert sorted((str(r.day), r.k, r.v) for r in store.read("t").collect()) == [("2024-01-01", 1, "a"), ("None", 2, "b")]


def test_only_changed_partitions_are_written(spark, store):
    store.stage("t", rows(spark, ("2024-01-01", 1, "a"), ("2024-01-02", 1, "a")))
    store.commit()
    assert store.stage("t", rows(spark, ("2024-01-02", 1, "b"))) == ["day=2024-01-02"]
    store.stage("u", spark.range(2).selectExpr("id AS k", "id AS w"))
    store.commit()
    assert store.folders("t") == {"day=2024-01-01": 1, "day=2024-01-02": 2}
    assert {(str(r.day), r.v) for r in store.read("t").collect()} == {("2024-01-01", "a"), ("2024-01-02", "b")}
    assert {(str(r.day), r.v) for r in store.read("t", version=1).collect()} == {("2024-01-01", "a"), ("2024-01-02", "a")}
    assert [str(r.day) for r in store.read("t", only=["day=2024-01-02"]).collect()] == ["2024-01-02"]


def test_failed_batch_leaves_the_old_version_and_its_repeat_counts_once(spark, store):
    store.stage("t", rows(spark, ("2024-01-01", 1, "a")))
    store.commit()
    store.stage("t", rows(spark, ("2024-01-01", 1, "lost"), ("2024-01-05", 9, "lost")))  # crash before commit
    again = VersionedStore(spark, store.path, store.tables)
    assert [r.v for r in again.read("t").collect()] == ["a"]
    again.stage("u", spark.range(1).selectExpr("id AS k", "id AS w"))
    again.commit()  # another table's commit does not publish what the crash left
    assert [r.v for r in again.read("t").collect()] == ["a"]
    again.stage("t", rows(spark, ("2024-01-01", 1, "b")))
    again.commit()
    assert [r.v for r in again.read("t").collect()] == ["b"]


def test_vacuum(spark, store):
    for v in "abc":
        store.stage("t", rows(spark, ("2024-01-01", 1, v), ("2024-01-0" + str(ord(v) - 95), 1, v)))
        store.commit()
    store.vacuum(keep=1)
    assert len(store.read("t").collect()) == 4
    with pytest.raises(Exception):
        store.read("t", version=1).collect()
    store.stage("t", rows(spark, ("2024-02-01", 1, "z")), drop=True)
    store.commit()
    assert [r.v for r in store.read("t").collect()] == ["z"]
