"""Scalar expressions: NULL for NaN, rounding, geometry, projections, colour indices."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DEG = math.pi / 180


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def no_nan(c: str | Column) -> Column:
    """NaN means missing in rasters; Spark sorts and averages it, so it becomes NULL at ingest."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def r6(c: str | Column) -> Column:
    return F.round(col(c), 6)


def clip(c: str | Column, low, high) -> Column:
    """NULL stays NULL (least and greatest would skip it)."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def dms(d, m, s, ref) -> Column:
    v = col(d) + col(m) / 60 + col(s) / 3600
    return F.when(col(ref).isin("S", "W"), -v).otherwise(v)


def local_east(lon, lon0, lat0) -> Column:
    return (col(lon) - col(lon0)) * F.lit(111320.0) * F.cos(F.radians(col(lat0)))


def local_north(lat, lat0) -> Column:
    return (col(lat) - col(lat0)) * F.lit(110540.0)


def utm(lat: str | Column, lon: str | Column, zone: int = 32) -> tuple[Column, Column]:
    """WGS84 to UTM by Krüger's series to the fourth order (northern hemisphere): below a millimetre within the zone."""
    a, f = 6378137.0, 1 / 298.257223563
    n = f / (2 - f)
    big_a = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3 + 41 / 180 * n**4, 13 / 48 * n**2 - 3 / 5 * n**3 + 557 / 1440 * n**4,
             61 / 240 * n**3 - 103 / 140 * n**4, 49561 / 161280 * n**4)
    e = 2 * math.sqrt(n) / (1 + n)
    lam = (col(lon) - F.lit(float(6 * zone - 183))) * DEG
    s = F.sin(col(lat) * DEG)
    t = F.sinh(F.atanh(s) - F.lit(e) * F.atanh(F.lit(e) * s))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    north, east = xi, eta
    for j, k in enumerate(alpha, 1):
        north = north + F.lit(k) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + F.lit(k) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return F.lit(500000.0) + F.lit(0.9996 * big_a) * east, F.lit(0.9996 * big_a) * north


def grid_cell(x, y, x0: float, y0: float, size: float) -> tuple[Column, Column]:
    """(row, col) of a raster whose rows grow southwards from (x0, y0)."""
    return F.floor((F.lit(y0) - col(y)) / F.lit(size)).cast("int"), F.floor((col(x) - F.lit(x0)) / F.lit(size)).cast("int")


def cell_centre(row, c, x0: float, y0: float, size: float) -> tuple[Column, Column]:
    return F.lit(x0) + (col(c) + 0.5) * F.lit(size), F.lit(y0) - (col(row) + 0.5) * F.lit(size)


def colour_indices(r="r", g="g", b="b", nir: str | None = None) -> dict[str, Column]:
    """ExG on normalised channels, NGRDI, VARI, GLI, and NDVI if a near-infrared band is named. 1e-6 keeps the
    denominators off zero."""
    r, g, b, e = col(r).cast("double"), col(g).cast("double"), col(b).cast("double"), F.lit(1e-6)
    total = r + g + b + e
    out = {"ExG": 2 * (g / total) - r / total - b / total, "NGRDI": (g - r) / (g + r + e),
           "VARI": F.try_divide(g - r, g + r - b + e), "GLI": (2 * g - r - b) / (2 * g + r + b + e)}
    if nir:
        out["NDVI"] = (col(nir) - r) / (col(nir) + r + e)
    return out


def pair_id(a, b) -> Column:
    """Order-free key of an image pair."""
    return F.least(col(a), col(b)).cast("long") * F.lit(2147483647) + F.greatest(col(a), col(b)).cast("long")


def bilinear(corners: list[tuple[float, float]], u: Column, v: Column) -> tuple[Column, Column]:
    """Corners in the order top left, top right, bottom right, bottom left."""
    w = ((1 - u) * (1 - v), u * (1 - v), u * v, (1 - u) * v)
    return tuple(sum((w[k] * F.lit(float(corners[k][d])) for k in range(1, 4)), w[0] * F.lit(float(corners[0][d]))) for d in (0, 1))


def dot(coeffs, *cols) -> Column:
    out = None
    for k, c in zip(coeffs, cols, strict=True):
        term = F.lit(float(k)) * col(c)
        out = term if out is None else out + term
    return out


def similarity(scale: float, rotation, shift, x="x", y="y", z="z") -> tuple[Column, ...]:
    return tuple(F.lit(float(scale)) * dot(rotation[k], x, y, z) + F.lit(float(shift[k])) for k in range(3))


def similarity_inverse(scale: float, rotation, shift, x="x", y="y", z="z") -> tuple[Column, ...]:
    moved = [(col(c) - F.lit(float(s))) / F.lit(float(scale)) for c, s in zip((x, y, z), shift, strict=True)]
    return tuple(dot([rotation[j][k] for j in range(3)], *moved) for k in range(3))


def nadir_angle(fx, fy, fz) -> Column:
    """Degrees between a viewing direction and straight down."""
    norm = F.sqrt(col(fx) ** 2 + col(fy) ** 2 + col(fz) ** 2) + F.lit(1e-12)
    return F.degrees(F.acos(F.least(F.greatest(-col(fz) / norm, F.lit(-1.0)), F.lit(1.0))))


def pinhole(x, y, z, fx: float, fy: float, cx: float, cy: float) -> tuple[Column, Column]:
    ok = col(z) > 1e-6
    return F.when(ok, F.lit(fx) * col(x) / col(z) + F.lit(cx)), F.when(ok, F.lit(fy) * col(y) / col(z) + F.lit(cy))


def back_project(u, v, d, fx: float, fy: float, cx: float, cy: float) -> tuple[Column, Column, Column]:
    return (col(u) - F.lit(cx)) / F.lit(fx) * col(d), (col(v) - F.lit(cy)) / F.lit(fy) * col(d), col(d)


def view_weight(radius, r_max, power: int = 6) -> Column:
    return F.pow(clip(1 - col(radius) / col(r_max), 0.0, 1.0), F.lit(float(power)))


def feather(w1, w2, low: float = 0.9) -> Column:
    """Share of the second view: 0 below ``low`` of the first one's weight, a half at equal weight."""
    return clip((col(w2) / col(w1) - F.lit(low)) / F.lit(1 - low), 0.0, 1.0) / 2


def rotated(x, y, degrees: float, cx: float, cy: float) -> tuple[Column, Column]:
    """Points turned about a centre; turned by the negative angle they are back."""
    a = math.radians(degrees)
    dx, dy = col(x) - cx, col(y) - cy
    return F.lit(cx) + dx * math.cos(a) - dy * math.sin(a), F.lit(cy) + dx * math.sin(a) + dy * math.cos(a)


def feature_tile(x, y, width: int, height: int, rows: int = 3, cols: int = 4) -> tuple[Column, Column, Column, Column]:
    """Tile row and column of a keypoint, and its place within the tile; the last tiles take what is left over."""
    tw, th = width // cols, height // rows
    r = F.least(F.greatest(F.floor(col(y) / th), F.lit(0)), F.lit(rows - 1)).cast("int")
    c = F.least(F.greatest(F.floor(col(x) / tw), F.lit(0)), F.lit(cols - 1)).cast("int")
    return r, c, col(x) - c * tw, col(y) - r * th
