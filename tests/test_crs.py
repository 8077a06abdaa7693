"""Projections and datum shifts against published worked examples; round trips to the centimetre."""

import pytest
from pyspark.sql import functions as F

from firn.functions import crs as C
from firn.functions import geodesy as GD
from firn.operators import geometry as G

FOOT = 1200 / 3937  # US survey foot


def row(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_published_examples(spark):
    # transverse Mercator with an origin latitude: British grid, 50 30 N, 0 30 E
    p = dict(C.by_code("EPSG:27700").params)
    x, y = GD.tm_forward(F.lit(0.5), F.lit(50.5), **p, **C.by_code("EPSG:27700").axes)
    r = row(spark, x=x, y=y)
    assert (r.x, r.y) == (pytest.approx(577274.99, abs=0.01), pytest.approx(69740.50, abs=0.01))
    # Lambert conic with two parallels, in feet: 28 30 N, 96 W
    a, inverse = C.ELLIPSOIDS["Clarke1866"]
    x, y = GD.lcc_forward(F.lit(-96.0), F.lit(28.5), -99.0, 27 + 50 / 60, 28 + 23 / 60, 30 + 17 / 60, 2e6 * FOOT, 0.0, a, 1 / inverse)
    r = row(spark, x=x / FOOT, y=y / FOOT)
    assert (r.x, r.y) == (pytest.approx(2963503.91, abs=0.02), pytest.approx(254759.80, abs=0.02))
    # geocentric coordinates (given at 73 m above the ellipsoid) and seven parameters
    x, y, z = GD.helmert(F.lit(3657660.66), F.lit(255768.55), F.lit(5201382.11), (0, 0, 4.5, 0, 0, 0.554, 0.219))
    r = row(spark, x=x, y=y, z=z)
    assert (r.x, r.y, r.z) == (pytest.approx(3657660.78, abs=0.01), pytest.approx(255778.43, abs=0.01), pytest.approx(5201387.75, abs=0.01))
    lon, lat = GD.from_geocentric(F.lit(3771793.968), F.lit(140253.342), F.lit(5124304.349), **C.Crs().axes)
    r = row(spark, lon=lon, lat=lat)
    assert r.lat == pytest.approx(53 + 48 / 60 + 33.820 / 3600, abs=1e-8) and r.lon == pytest.approx(2 + 7 / 60 + 46.380 / 3600, abs=1e-8)


@pytest.mark.parametrize("code,lon,lat", [("EPSG:32642", 70.2, 38.5), ("EPSG:32643", 70.2, 38.5), ("EPSG:32719", -70.1, -33.4), ("EPSG:2154", 2.3, 48.8),
                                          ("EPSG:3034", 25.0, 60.0), ("EPSG:27700", -3.2, 55.9), ("EPSG:28412", 70.0, 39.0), ("EPSG:31467", 9.1, 48.7)])
def test_inverse_undoes_forward(spark, code, lon, lat):
    crs = C.by_code(code)
    plain = C.Crs(crs.ellipsoid, crs.projection, crs.params)
    pts = F.array(*[F.struct(F.lit(lon + d).alias("lon"), F.lit(lat + d / 3).alias("lat")) for d in (-0.9, 0.0, 1.1)])
    r = row(spark, pts=pts, back=C.to_lonlat(C.from_lonlat(pts, plain), plain))
    for p, b in zip(r.pts, r.back):
        assert (b.lon, b.lat) == (pytest.approx(p.lon, abs=1e-8), pytest.approx(p.lat, abs=1e-8))


def test_datum_shift_moves_points(spark):
    """Some hundred metres between the datums, as the three-metre shift of the old one implies; the identity moves none."""
    pts = F.array(F.struct(F.lit(70.0).alias("lon"), F.lit(39.0).alias("lat")))
    r = row(spark, p=C.to_lonlat(pts, C.by_code("EPSG:4284"))[0], q=C.to_lonlat(pts, C.Crs("WGS84", shift=(0,) * 7))[0])
    assert 20 < abs(r.p.lon - 70) * 86000 + abs(r.p.lat - 39) * 111000 < 300
    assert (r.q.lon, r.q.lat) == (pytest.approx(70, abs=1e-11), pytest.approx(39, abs=1e-11))


def test_rings_by_code(spark):
    zones = spark.createDataFrame([("z", "r", [(69.0, 40.0), (69.1, 40.0), (69.0, 40.1)])], "zone string, region string, ring array<struct<lon:double,lat:double>>")
    a, b, c = (G.project_rings(zones, crs=x).first().ring for x in (None, "epsg:4326", "EPSG:4258"))
    assert a == b and abs(a[0].x - 500000) < 1e-6 and all(abs(p.y - q.y) < 0.01 for p, q in zip(a, c))
    grid = spark.createDataFrame([("z", "r", [(1.0, 2.0)])], "zone string, region string, ring array<struct<x:double,y:double>>")
    assert G.project_rings(grid, crs="EPSG:32642").first().ring[0].x == 1.0
    with pytest.raises(ValueError):
        G.project_rings(grid, crs="EPSG:99999")
    C.register("LOCAL:1", C.transverse(69.0, 1.0, 0.0, 0.0))
    assert G.project_rings(grid, crs="local:1").first().ring[0].x == pytest.approx(500000 + 0.9996, abs=1e-3)
