"""Physics and map-projection column expressions.

The transverse Mercator pair uses the third-order Krueger series as
published for UTM (public formulas); all terms are native Spark math, so
reprojection runs inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 ellipsoid and the UTM zone-42N projection.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM42N = dict(lon0=69.0, k0=0.9996, false_easting=500000.0, false_northing=0.0)

# Gas constant for dry air and standard gravity.
R_DRY = 287.0
G0 = 9.81


def geopotential_surface(t: Column, p: Column, p0: Column) -> Column:
    """Surface geopotential 287 * T * ln(P0 / P)."""
    return F.lit(R_DRY) * t * F.log(p0 / p)


def geopotential_level(gh: Column) -> Column:
    """Geopotential of a pressure level from geopotential height."""
    return gh * F.lit(G0)


def _series(a: float = WGS84_A, f: float = WGS84_F):
    n = f / (2 - f)
    a_rect = a / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    alpha = (n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16, 13 * n ** 2 / 48 - 3 * n ** 3 / 5, 61 * n ** 3 / 240)
    beta = (n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96, n ** 2 / 48 + n ** 3 / 15, 17 * n ** 3 / 480)
    delta = (2 * n - 2 * n ** 2 / 3 - 2 * n ** 3, 7 * n ** 2 / 3 - 8 * n ** 3 / 5, 56 * n ** 3 / 15)
    return n, a_rect, alpha, beta, delta


def tm_forward(lon: Column, lat: Column, lon0=UTM42N["lon0"], k0=UTM42N["k0"],
               fe=UTM42N["false_easting"], fn=UTM42N["false_northing"], a: float = WGS84_A, f: float = WGS84_F) -> tuple[Column, Column]:
    """(lon, lat) degrees -> (easting, northing) metres, on the ellipsoid of half axis ``a`` and flattening ``f``."""
    n, a_rect, alpha, _, _ = _series(a, f)
    c = 2 * math.sqrt(n) / (1 + n)
    phi = F.radians(lat)
    dlam = F.radians(lon - F.lit(lon0))
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(c) * F.atanh(F.lit(c) * F.sin(phi)))
    xi_p = F.atan(t / F.cos(dlam))
    eta_p = F.atanh(F.sin(dlam) / F.sqrt(F.lit(1.0) + t * t))
    e_sum, n_sum = eta_p, xi_p
    for j, a_j in enumerate(alpha, start=1):
        e_sum = e_sum + F.lit(a_j) * F.cos(F.lit(2.0 * j) * xi_p) * F.sinh(F.lit(2.0 * j) * eta_p)
        n_sum = n_sum + F.lit(a_j) * F.sin(F.lit(2.0 * j) * xi_p) * F.cosh(F.lit(2.0 * j) * eta_p)
    return F.lit(fe) + F.lit(k0 * a_rect) * e_sum, F.lit(fn) + F.lit(k0 * a_rect) * n_sum


def tm_inverse(x: Column, y: Column, lon0=UTM42N["lon0"], k0=UTM42N["k0"],
               fe=UTM42N["false_easting"], fn=UTM42N["false_northing"], a: float = WGS84_A, f: float = WGS84_F) -> tuple[Column, Column]:
    """(easting, northing) metres -> (lon, lat) degrees."""
    _, a_rect, _, beta, delta = _series(a, f)
    xi = (y - F.lit(fn)) / F.lit(k0 * a_rect)
    eta = (x - F.lit(fe)) / F.lit(k0 * a_rect)
    xi_p, eta_p = xi, eta
    for j, b_j in enumerate(beta, start=1):
        xi_p = xi_p - F.lit(b_j) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
        eta_p = eta_p - F.lit(b_j) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    lam = F.radians(F.lit(lon0)) + F.atan(F.sinh(eta_p) / F.cos(xi_p))
    return F.degrees(lam), F.degrees(_latitude(chi, delta))


def _latitude(chi: Column, delta) -> Column:
    """Latitude from conformal latitude."""
    phi = chi
    for j, d_j in enumerate(delta, start=1):
        phi = phi + F.lit(d_j) * F.sin(F.lit(2.0 * j) * chi)
    return phi


def meridian_distance(lat: float, a: float = WGS84_A, f: float = WGS84_F) -> float:
    """Northing of a latitude (degrees) on the central meridian with scale 1, for the origin of a projection."""
    n, a_rect, alpha, _, _ = _series(a, f)
    c, phi = 2 * math.sqrt(n) / (1 + n), math.radians(lat)
    xi = math.atan(math.sinh(math.atanh(math.sin(phi)) - c * math.atanh(c * math.sin(phi))))
    return a_rect * (xi + sum(a_j * math.sin(2 * j * xi) for j, a_j in enumerate(alpha, start=1)))


def _cone(lat0, lat1, lat2, a, f):
    """Constant, scaled radius and radius of the origin of a Lambert cone with two standard parallels (degrees)."""
    e = math.sqrt(f * (2 - f))

    def parallel(lat):
        s = math.sin(math.radians(lat))
        m = math.cos(math.radians(lat)) / math.sqrt(1 - (e * s) ** 2)
        return m, math.exp(-(math.atanh(s) - e * math.atanh(e * s)))
    (m1, t1), (m2, t2), (_, t0) = parallel(lat1), parallel(lat2), parallel(lat0)
    n = math.sin(math.radians(lat1)) if lat1 == lat2 else (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
    big = a * m1 / (n * t1 ** n)
    return e, n, big, big * t0 ** n


def lcc_forward(lon: Column, lat: Column, lon0: float, lat0: float, lat1: float, lat2: float, fe: float, fn: float,
                a: float = WGS84_A, f: float = WGS84_F) -> tuple[Column, Column]:
    """(lon, lat) degrees -> Lambert conformal conic metres."""
    e, n, big, r0 = _cone(lat0, lat1, lat2, a, f)
    s = F.sin(F.radians(lat))
    r = F.lit(big) * F.exp(F.lit(-n) * (F.atanh(s) - F.lit(e) * F.atanh(F.lit(e) * s)))
    angle = F.lit(n) * F.radians(lon - F.lit(lon0))
    return F.lit(fe) + r * F.sin(angle), F.lit(fn + r0) - r * F.cos(angle)


def lcc_inverse(x: Column, y: Column, lon0: float, lat0: float, lat1: float, lat2: float, fe: float, fn: float,
                a: float = WGS84_A, f: float = WGS84_F) -> tuple[Column, Column]:
    """Lambert conformal conic metres -> (lon, lat) degrees."""
    _, n, big, r0 = _cone(lat0, lat1, lat2, a, f)
    sign = 1.0 if n > 0 else -1.0
    dx, dy = (x - F.lit(fe)) * sign, (F.lit(fn + r0) - y) * sign
    t = F.pow(F.sqrt(dx * dx + dy * dy) / F.lit(abs(big)), F.lit(1 / n))
    chi = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t)
    return F.degrees(F.atan2(dx, dy) / F.lit(n)) + F.lit(lon0), F.degrees(_latitude(chi, _series(a, f)[4]))


def to_geocentric(lon: Column, lat: Column, a: float, f: float) -> tuple[Column, Column, Column]:
    """(lon, lat) degrees on the ellipsoid -> geocentric X, Y, Z metres."""
    e2, s, c = f * (2 - f), F.sin(F.radians(lat)), F.cos(F.radians(lat))
    nu = F.lit(a) / F.sqrt(F.lit(1.0) - F.lit(e2) * s * s)
    return nu * c * F.cos(F.radians(lon)), nu * c * F.sin(F.radians(lon)), nu * F.lit(1 - e2) * s


def from_geocentric(x: Column, y: Column, z: Column, a: float, f: float) -> tuple[Column, Column]:
    """Geocentric metres -> (lon, lat) degrees; exact to micrometres near the ellipsoid."""
    e2, b = f * (2 - f), a * (1 - f)
    p = F.sqrt(x * x + y * y)
    q = F.atan2(z * F.lit(a), p * F.lit(b))
    lat = F.atan2(z + F.lit(e2 / (1 - e2) * b) * F.pow(F.sin(q), F.lit(3.0)), p - F.lit(e2 * a) * F.pow(F.cos(q), F.lit(3.0)))
    return F.degrees(F.atan2(y, x)), F.degrees(lat)


def helmert(x: Column, y: Column, z: Column, shift: tuple) -> tuple[Column, Column, Column]:
    """Seven-parameter shift in the position vector sense: metres, arc seconds, parts per million."""
    tx, ty, tz, rx, ry, rz, ppm = shift
    rx, ry, rz = (math.radians(r / 3600) for r in (rx, ry, rz))
    m = F.lit(1 + ppm * 1e-6)
    return (F.lit(float(tx)) + m * (x - F.lit(rz) * y + F.lit(ry) * z), F.lit(float(ty)) + m * (F.lit(rz) * x + y - F.lit(rx) * z),
            F.lit(float(tz)) + m * (F.lit(-ry) * x + F.lit(rx) * y + z))


def tm_forward_sql(lon: str, lat: str, lon0=UTM42N["lon0"], k0=UTM42N["k0"],
                   fe=UTM42N["false_easting"], fn=UTM42N["false_northing"]) -> tuple[str, str]:
    """The same forward projection as SQL text (for DuckDB oracles)."""
    n, a_rect, alpha, _, _ = _series()
    c = 2 * math.sqrt(n) / (1 + n)
    phi = f"radians({lat})"
    dlam = f"radians({lon} - {lon0!r})"
    t = f"sinh(atanh(sin({phi})) - {c!r} * atanh({c!r} * sin({phi})))"
    xi_p = f"atan(({t}) / cos({dlam}))"
    eta_p = f"atanh(sin({dlam}) / sqrt(1.0 + ({t}) * ({t})))"
    e_sum, n_sum = f"({eta_p})", f"({xi_p})"
    for j, a_j in enumerate(alpha, start=1):
        e_sum += f" + {a_j!r} * cos({2.0 * j!r} * {xi_p}) * sinh({2.0 * j!r} * {eta_p})"
        n_sum += f" + {a_j!r} * sin({2.0 * j!r} * {xi_p}) * cosh({2.0 * j!r} * {eta_p})"
    return (f"({fe!r} + {k0 * a_rect!r} * ({e_sum}))", f"({fn!r} + {k0 * a_rect!r} * ({n_sum}))")
