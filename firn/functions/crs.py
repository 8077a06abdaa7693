"""Coordinate systems of zone files: parameters by code, and steps between them as array expressions (IO11).

A system is an ellipsoid, a projection of it (or none) and the shift of its datum to WGS84.  Families of zones come from
a rule, others from a table; ``register`` adds one.  Heights are not carried: a datum shift starts on the
ellipsoid, which moves a point by less than a millimetre sideways.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from firn.functions import geodesy as G

# Half axis (m) and inverse flattening of ellipsoids.
ELLIPSOIDS = {"WGS84": (6378137.0, 298.257223563), "GRS80": (6378137.0, 298.257222101), "Airy1830": (6377563.396, 299.3249646),
              "Bessel1841": (6377397.155, 299.1528128), "Clarke1866": (6378206.4, 294.978698214), "International1924": (6378388.0, 297.0),
              "Krassowsky1940": (6378245.0, 298.3)}
# Shifts to WGS84 (position vector: m, m, m, seconds of arc, ppm).
SHIFTS = {"Pulkovo1942": (23.92, -141.27, -80.9, 0.0, 0.35, 0.82, -0.12), "ED50": (-87.0, -98.0, -121.0, 0.0, 0.0, 0.0, 0.0),
          "DHDN": (598.1, 73.7, 418.2, 0.202, 0.045, -2.455, 6.7), "OSGB36": (446.448, -125.157, 542.06, 0.15, 0.247, 0.842, -20.489)}


@dataclass(frozen=True)
class Crs:
    ellipsoid: str = "WGS84"
    projection: str | None = None  # tm, lcc or none (lon, lat in degrees)
    params: tuple = ()  # of the projection, by name
    shift: tuple | None = None

    @property
    def axes(self) -> dict:
        a, inverse = ELLIPSOIDS[self.ellipsoid]
        return {"a": a, "f": 1 / inverse}


def transverse(lon0: float, k0: float, fe: float, fn: float, lat0: float = 0.0, ellipsoid: str = "WGS84", shift=None) -> Crs:
    a, inverse = ELLIPSOIDS[ellipsoid]
    fn = fn - k0 * G.meridian_distance(lat0, a, 1 / inverse)
    return Crs(ellipsoid, "tm", (("lon0", lon0), ("k0", k0), ("fe", fe), ("fn", fn)), shift)


def conic(lon0: float, lat0: float, lat1: float, lat2: float, fe: float, fn: float, ellipsoid: str = "GRS80", shift=None) -> Crs:
    return Crs(ellipsoid, "lcc", (("lon0", lon0), ("lat0", lat0), ("lat1", lat1), ("lat2", lat2), ("fe", fe), ("fn", fn)), shift)


# Systems by code.
KNOWN = {
    "EPSG:4326": Crs(), "OGC:CRS84": Crs(), "WGS84": Crs(), "EPSG:4258": Crs("GRS80"), "EPSG:4269": Crs("GRS80"),
    "EPSG:4284": Crs("Krassowsky1940", shift=SHIFTS["Pulkovo1942"]), "EPSG:4230": Crs("International1924", shift=SHIFTS["ED50"]),
    "EPSG:27700": transverse(-2.0, 0.9996012717, 400000.0, -100000.0, 49.0, "Airy1830", SHIFTS["OSGB36"]),
    "EPSG:2154": conic(3.0, 46.5, 49.0, 44.0, 700000.0, 6600000.0), "EPSG:3034": conic(10.0, 52.0, 35.0, 65.0, 4000000.0, 2800000.0),
}


def register(code: str, crs: Crs) -> None:
    KNOWN[code.upper()] = crs


def by_code(code: str | None) -> Crs:
    """The system of a code; none means WGS84, as for a file without one."""
    code = (code or "EPSG:4326").upper()
    if code in KNOWN:
        return KNOWN[code]
    if code.startswith("EPSG:") and code[5:].isdigit():
        family, zone = divmod(int(code[5:]), 100)
        utm = dict(lon0=6.0 * zone - 183.0, k0=0.9996, fe=500000.0)
        if 1 <= zone <= 60 and family in (326, 327):  # UTM north and south
            return transverse(**utm, fn=1e7 if family == 327 else 0.0)
        if 28 <= zone <= 38 and family == 258:
            return transverse(**utm, fn=0.0, ellipsoid="GRS80")
        if 28 <= zone <= 38 and family == 230:
            return transverse(**utm, fn=0.0, ellipsoid="International1924", shift=SHIFTS["ED50"])
        if 2 <= zone <= 32 and family == 284:  # six-degree zones, the zone's number in the easting
            return transverse(6.0 * zone - 3.0, 1.0, zone * 1e6 + 500000.0, 0.0, 0.0, "Krassowsky1940", SHIFTS["Pulkovo1942"])
        if 66 <= zone <= 69 and family == 314:  # three-degree zones 2 to 5
            return transverse(3.0 * (zone - 64), 1.0, (zone - 64) * 1e6 + 500000.0, 0.0, 0.0, "Bessel1841", SHIFTS["DHDN"])
    raise ValueError(f"unknown coordinate system {code}; register its parameters")


def to_lonlat(points: Column, crs: Crs, x: str = "x", y: str = "y") -> Column:
    """Array of points of a system -> array of (lon, lat) in WGS84.  Each step is an array of its own, so
    the expression is as long as its steps together."""
    if crs.projection:
        inverse = G.tm_inverse if crs.projection == "tm" else G.lcc_inverse

        def step(p):
            lon, lat = inverse(p[x], p[y], **dict(crs.params), **crs.axes)
            return F.struct(lon.alias("lon"), lat.alias("lat"))
        points = F.transform(points, step)
    if not crs.shift:
        return points
    wgs = Crs().axes

    def there(p):
        return F.struct(*[c.alias(n) for c, n in zip(G.to_geocentric(p["lon"], p["lat"], **crs.axes), "XYZ")])

    def moved(p):
        return F.struct(*[c.alias(n) for c, n in zip(G.helmert(p["X"], p["Y"], p["Z"], crs.shift), "XYZ")])

    def back(p):
        lon, lat = G.from_geocentric(p["X"], p["Y"], p["Z"], **wgs)
        return F.struct(lon.alias("lon"), lat.alias("lat"))
    return F.transform(F.transform(F.transform(points, there), moved), back)


def from_lonlat(points: Column, crs: Crs) -> Column:
    """Array of (lon, lat) in WGS84 -> array of (x, y) of a projected system without datum shift."""
    if crs.shift or not crs.projection:
        raise ValueError("a grid is a projection of WGS84 or of an ellipsoid that needs no shift")
    forward = G.tm_forward if crs.projection == "tm" else G.lcc_forward

    def step(p):
        ex, ny = forward(p["lon"], p["lat"], **dict(crs.params), **crs.axes)
        return F.struct(ex.alias("x"), ny.alias("y"))
    return F.transform(points, step)
