"""Daily rasters (IO09): few, large files that repeat as bytes, and no text in their rows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from firn.plans import q_publish as QP
from firn.plans import registry
from firn.sources import files as FL
from firn.sources import standins as S
from firn.sources.tables import Tables

registry.load_all()


@pytest.fixture(scope="module")
def rasters(spark, tmp_path_factory):
    """The rasters of the query as files, and its result."""
    at = tmp_path_factory.mktemp("io09")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(QP, "scratch_path", lambda s, name: str(at / name))
        out = registry.QUERIES["io09_raster_per_day"](spark, SF_SMALL).collect()
    return at / "rasters", out


def test_units_are_in_the_path(spark, rasters):
    path, out = rasters
    units = {(p.parts[-3], p.parts[-2]) for p in path.glob("variable=*/unit=*/month=*")}
    assert units == {("variable=SWE", "unit=mm"), ("variable=SND", "unit=m"), ("variable=ROF", "unit=mm"), ("variable=GST", "unit=k")}
    one = next(path.glob("variable=SWE/unit=mm/month=*/*.parquet"))
    assert spark.read.parquet(str(one)).columns == ["pixel", "row_i", "col_i", "date", "value"]
    back, t = spark.read.parquet(str(path)), Tables(spark, SF_SMALL)
    want = S.s4a(t).join(S.s4b(t), "cluster")
    assert back.count() == 4 * want.count() and sum(r.n_pixels for r in out) == 4 * want.count()
    got = back.where("variable = 'SND'").select("pixel", "row_i", "col_i", "date", "value")
    want = want.select("pixel", "row_i", "col_i", "date", F.col("snd").alias("value"))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_days_stand_together(spark, rasters):
    files = [*rasters[0].glob("variable=ROF/unit=mm/month=1995*/*.parquet")]
    assert files
    for f in files[:12]:
        days = [r.date for r in spark.read.parquet(str(f)).select("date").collect()]
        assert days == sorted(days)


def test_one_pixel_order_takes_few_bytes(spark, tmp_path):
    """A hundred days of two thousand pixels, in one order on each day."""
    px = spark.range(2000).select(F.xxhash64("id").alias("pixel"), F.hash("id").alias("row_i"), F.hash(F.col("id") + 7).alias("col_i"))
    days = spark.range(100).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    rows = days.crossJoin(px.coalesce(1)).coalesce(1).sortWithinPartitions("date", "pixel")
    FL.write_partitioned(rows.withColumn("v", F.lit(1)), str(tmp_path / "r"), ["v"], gather=False, **QP.RASTER_FORMAT)
    assert sum(f.stat().st_size for f in (tmp_path / "r").rglob("*.parquet")) < 100 * 2000 * 16 / 20


def test_pieces_of_a_share(spark, monkeypatch):
    from firn.operators import common as CM
    monkeypatch.setattr(CM, "TASK_ROWS", 200)
    t = Tables(spark, SF_SMALL)
    n = t.lineitem.count()
    cores = spark.sparkContext.defaultParallelism
    assert S.s4b(t).rdd.getNumPartitions() == max(cores, -(-n // 200)) > 2 * cores
    assert S.s4b(t, 2).rdd.getNumPartitions() == max(cores, -(-(n // 2) // 200))
    assert S.s4b(t, 2).exceptAll(S.s4b(t)).count() == 0 and S.s4b(t, 2).count() == S.s4b(t).count()
