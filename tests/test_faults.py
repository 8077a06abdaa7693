"""Damaged files: found, listed, left out as a whole; hours matched to the expected ones."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from firn.operators import quality as Q
from firn.operators import zonal as Z
from firn.sources import faults as FT

SCHEMA = "k int, time timestamp_ntz, v string, name string, month date"
KEYS = ["name", "month"]


def write(spark, path, name, n, month="2024-01-01", v="x" * 50):
    rows = spark.range(n).select(F.col("id").cast("int").alias("k"),
                                 (F.lit(month).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("time"),
                                 F.concat(F.lit(v), F.col("id")).alias("v"))
    rows.coalesce(1).write.mode("append").option("compression", "none").option("parquet.block.size", 4096).parquet(f"{path}/name={name}/month={month}")
    return sorted(glob.glob(f"{path}/name={name}/month={month}/*.parquet"))


def test_every_kind_of_damage(spark, tmp_path):
    path = str(tmp_path)
    write(spark, path, "good", 744)
    cut = write(spark, path, "cut", 744)[0]
    os.truncate(cut, os.path.getsize(cut) // 2)
    write(spark, path, "empty", 0)
    two = [write(spark, path, "two", 400)[0], write(spark, path, "two", 300)[-1]]
    open(two[1], "wb").write(b"not a file of rows")
    for crc in glob.glob(f"{path}/*/*/.*.crc"):
        os.remove(crc)
    units = {r.name: r for r in FT.check_units(spark, path, SCHEMA, KEYS).collect()}
    assert {n: r.reason for n, r in units.items()} == {"good": None, "cut": "no rows", "empty": "no rows", "two": "no rows"}
    assert units["two"].n_files == 2 and units["good"].n_rows == 744 and str(units["good"].month) == "2024-01-01"
    rows = FT.good_rows(spark, path, SCHEMA, FT.check_units(spark, path, SCHEMA, KEYS), KEYS)
    assert {(r.name, r["count"]) for r in rows.groupBy("name").count().collect()} == {("good", 744)}
    found = {r.name: (r.n_present, r.n_missing, r.reason)
             for r in Q.file_completeness(FT.check_units(spark, path, SCHEMA, KEYS), rows, ["name"]).collect()}
    assert found == {"good": (744, 0, None), "cut": (0, 744, "no rows"), "empty": (0, 744, "no rows"), "two": (0, 744, "no rows")}


def test_deep_check_finds_a_file_that_breaks_in_the_middle(spark, tmp_path):
    path = str(tmp_path)
    write(spark, path, "good", 5000)
    broken = write(spark, path, "broken", 5000)[0]
    data = bytearray(open(broken, "rb").read())
    data[4:len(data) // 4] = b"\xff" * (len(data) // 4 - 4)  # pages, not the footer
    open(broken, "wb").write(bytes(data))
    for crc in glob.glob(f"{path}/*/*/.*.crc"):
        os.remove(crc)
    assert all(r.reason is None for r in FT.check_units(spark, path, SCHEMA, KEYS).collect())
    assert {r.name: r.reason for r in FT.check_units(spark, path, SCHEMA, KEYS, deep=True).collect()} == {"good": None, "broken": "cut off"}


def test_an_hour_off_does_not_hide_a_gap(spark):
    hours = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(744)]
    late = [t.replace(minute=30) if t.day == 1 and t.hour == 5 else t for t in hours]
    rows = spark.createDataFrame([("a", t) for t in hours + hours[:3]] + [("b", t) for t in late], "s string, time timestamp_ntz")
    got = {r.s: (r.n_present, r.n_missing, r.complete) for r in Q.month_completeness(rows, ["s"]).collect()}
    assert got == {"a": (744, 0, True), "b": (743, 1, False)}


def test_times_of_another_month_do_not_count(spark):
    units = spark.createDataFrame([("a", dt.date(2024, 2, 1), None), (None, dt.date(2024, 2, 1), "no rows")], "s string, month date, reason string")
    rows = spark.createDataFrame([("a", dt.date(2024, 2, 1), dt.datetime(2024, 3, 1))], "s string, month date, time timestamp_ntz")
    got = {r.s: (r.n_present, r.n_missing, r.reason) for r in Q.file_completeness(units, rows, ["s"]).collect()}
    assert got == {"a": (0, 29 * 24, "missing hours"), None: (0, 29 * 24, "no rows")}


def test_a_bad_raster_is_null_on_every_day_of_its_month(spark):
    values = spark.createDataFrame([("SWE", dt.date(2024, 1, 2), "z", 4.0)], "variable string, date date, zone string, value double")
    units = spark.createDataFrame([("SWE", dt.date(2024, 1, 1), None), ("HS", dt.date(2024, 2, 1), "no rows")], "variable string, month date, reason string")
    zones = spark.createDataFrame([("z",), ("y",)], "zone string")
    got = Z.zonal_mean_of_files(values, units, zones).collect()
    assert {(r.variable, r.zone, str(r.date), r.mean) for r in got if r.variable == "SWE"} == {("SWE", "z", "2024-01-02", 4.0), ("SWE", "y", "2024-01-02", None)}
    assert sum(r.variable == "HS" and r.mean is None for r in got) == 2 * 29 == len(got) - 2
