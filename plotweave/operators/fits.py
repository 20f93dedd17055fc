"""Fits from moments: one aggregation over the data, a solve of at most 6 x 6 on the driver."""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def medians(df: DataFrame, value: str, by: tuple[str, ...] = (), bins: int = 1024) -> DataFrame:
    """``n, median`` of each group, exactly, without a group in any task's memory.

    A histogram of ``bins`` a group (map-side counts) tells the bin of the middle ranks; only that bin's rows are ordered, by
    a window that spills."""
    rows = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__v"))
    ext = rows.groupBy(*by).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.count(F.lit(1)).alias("n"))
    rows = rows.join(ext, list(by)) if by else rows.crossJoin(F.broadcast(ext))
    width = (F.col("__hi") - F.col("__lo")) / bins
    rows = rows.withColumn("__bin", F.when(width > 0, F.least(F.floor((F.col("__v") - F.col("__lo")) / width), F.lit(bins - 1))).otherwise(0).cast("int"))
    upto = Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = rows.groupBy(*by, "n", "__bin").agg(F.count(F.lit(1)).alias("__c")).withColumn("__to", F.sum("__c").over(upto))
    first, last = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)  # ranks from 0
    middle = hist.withColumn("__from", F.col("__to") - F.col("__c")).filter((F.col("__from") <= last) & (F.col("__to") > first))
    within = Window.partitionBy(*by, "__bin").orderBy("__v")
    inside = rows.drop("n").join(middle.select(*by, "n", "__bin", "__from"), [*by, "__bin"]).withColumn("__rank", F.col("__from") + F.row_number().over(within) - 1)
    return inside.filter(F.col("__rank").between(first, last)).groupBy(*by, "n").agg(F.avg("__v").alias("median"))


def median_mad(df: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Median (``offset``), ``n``, and median absolute deviation about it."""
    med = medians(df, value, by).withColumnRenamed("median", "offset")
    joined = df.join(med, list(by)) if by else df.crossJoin(F.broadcast(med))
    mad = medians(joined.withColumn("__d", F.abs(F.col(value) - F.col("offset"))), "__d", by)
    mad = mad.select(*by, F.col("median").alias("mad"))
    return med.join(mad, list(by)) if by else med.crossJoin(F.broadcast(mad))


def datum_verdict(mad: str = "mad") -> Column:
    return F.when(F.col(mad) < 0.03, "ok").when(F.col(mad) < 0.08, "SUSPECT").otherwise("NOT ALIGNED")


def umeyama(pairs: DataFrame) -> dict:
    """Similarity that maps (sx, sy, sz) to (dx, dy, dz) with least squares: scale, rotation, shift, n.

    Means, cross moments and the source's variance come from two aggregations; the SVD is of a 3 x 3 matrix."""
    s, d = ("sx", "sy", "sz"), ("dx", "dy", "dz")
    m = pairs.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in (*s, *d)]).first()
    if not m["n"]:
        raise ValueError("no common points")
    if m["n"] < 3:
        raise ValueError("a similarity needs three points")
    centred = {c: F.col(c) - F.lit(m[c]) for c in (*s, *d)}
    q = pairs.agg(*[F.avg(centred[a] * centred[b]).alias(f"{a}{b}") for a in d for b in s],
                  F.avg(sum((centred[c] ** 2 for c in s[1:]), centred[s[0]] ** 2)).alias("v")).first()
    cov = np.array([[q[f"{a}{b}"] for b in s] for a in d])
    u, e, vt = np.linalg.svd(cov)
    sign = np.diag([1.0, 1.0, np.sign(np.linalg.det(u @ vt))])
    rot = u @ sign @ vt
    scale = float((e * np.diag(sign)).sum() / q["v"])
    src, dst = np.array([m[c] for c in s]), np.array([m[c] for c in d])
    return {"scale": scale, "rotation": rot.tolist(), "shift": (dst - scale * rot @ src).tolist(), "n": m["n"]}


def doming(residuals: DataFrame, by: tuple[str, ...] = (), least: int = 8) -> DataFrame:
    """Quadratic of the height residual ``dz`` over the radius ``r``: ``n, bowl, r2, z_rms, z_max`` for each group.

    Cramer's rule on power sums of the radius scaled to its maximum, so the whole fit is one aggregation a group after
    the radii. NULL with fewer than ``least`` points or a flat radius."""
    ext = residuals.groupBy(*by).agg(F.max("r").alias("__rmax"), F.min("r").alias("__rmin"), F.count(F.lit(1)).alias("n"))
    x = residuals.join(ext, list(by)) if by else residuals.crossJoin(F.broadcast(ext))
    t = F.when(F.col("__rmax") > 0, F.col("r") / F.col("__rmax")).otherwise(0.0)
    x = x.withColumn("t", t)
    sums = {"s1": F.col("t"), "s2": F.col("t") ** 2, "s3": F.col("t") ** 3, "s4": F.col("t") ** 4, "y0": F.col("dz"),
            "y1": F.col("dz") * F.col("t"), "y2": F.col("dz") * F.col("t") ** 2, "yy": F.col("dz") ** 2}
    g = x.groupBy(*by, "n", "__rmax", "__rmin").agg(*[F.sum(c).alias(k) for k, c in sums.items()], F.max(F.abs("dz")).alias("z_max"))
    n, s1, s2, s3, s4, y0, y1, y2 = (F.col(c) for c in ("n", "s1", "s2", "s3", "s4", "y0", "y1", "y2"))
    det3 = lambda m: (m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
                      + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0]))
    rows = ((s4, s3, s2), (s3, s2, s1), (s2, s1, n))
    rhs = (y2, y1, y0)
    det = det3(rows)
    coef = [F.try_divide(det3([[rhs[i] if j == k else rows[i][j] for j in range(3)] for i in range(3)]), det) for k in range(3)]
    ok = (n >= least) & (F.col("__rmax") - F.col("__rmin") > 1e-6)
    res = F.col("yy") - coef[0] * y2 - coef[1] * y1 - coef[2] * y0
    tot = F.col("yy") - y0 * y0 / n
    return g.select(*by, "n", F.when(ok, coef[0]).alias("bowl"),
                    F.when(ok, F.when(tot <= 1e-12, 0.0).otherwise(1 - res / tot)).alias("r2"),
                    F.when(ok, F.sqrt(F.col("yy") / n)).alias("z_rms"), F.when(ok, F.col("z_max")).alias("z_max"))


def doming_report(r2: str = "r2", bowl: str = "bowl", limit: float = 0.05) -> Column:
    b = F.abs(F.col(bowl))
    return (F.when(F.col(bowl).isNull(), "not assessed").when((F.col(r2) > 0.4) & (b > limit), "significant")
            .when(b > 0.05, "unstructured").otherwise("none"))


def trend_surface(points: DataFrame, degree: int = 2, sigma: float = 3.0, rounds: int = 3) -> dict:
    """Polynomial surface by least squares with clipping: x0, y0, scale, coefficients by (i, j), kept.

    Coordinates are centred and scaled first, which keeps the normal equations of full rank. A round is one aggregation of
    moments and one of the residuals' spread; the data stay where they are. A point once clipped stays out; clipping ends
    when the spread is round-off (1e-9 of the heights' range)."""
    points = points.select("x", "y", "z").filter("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL").persist(StorageLevel.MEMORY_AND_DISK)
    c = points.agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.max(F.abs("x")).alias("m"), F.min("x").alias("x0"), F.max("x").alias("x1"),
                   F.min("y").alias("y0"), F.max("y").alias("y1"), (F.max("z") - F.min("z")).alias("range")).first()
    if c["x"] is None:
        points.unpersist()
        raise ValueError("no points")
    scale = max(c["x1"] - c["x0"], c["y1"] - c["y0"]) / 2 or 1.0
    terms = [(i, j) for i in range(degree + 1) for j in range(degree + 1 - i)]
    p = points.select(((F.col("x") - c["x"]) / scale).alias("u"), ((F.col("y") - c["y"]) / scale).alias("v"), "z")
    basis = [F.pow("u", F.lit(float(i))) * F.pow("v", F.lit(float(j))) for i, j in terms]
    kept, coef = F.lit(True), None
    for _ in range(rounds):
        rows = p.filter(kept)
        pairs = [(a, b) for a in range(len(terms)) for b in range(a, len(terms))]
        m = rows.agg(*[F.sum(basis[a] * basis[b]) for a, b in pairs], *[F.sum(b * F.col("z")) for b in basis], F.count(F.lit(1))).first()
        normal = np.zeros((len(terms),) * 2)
        for k, (a, b) in enumerate(pairs):
            normal[a, b] = normal[b, a] = m[k] or 0.0
        coef = np.linalg.lstsq(normal, np.array([x or 0.0 for x in m[len(pairs):-1]]), rcond=None)[0]
        resid = F.col("z") - sum((F.lit(float(coef[k])) * basis[k] for k in range(1, len(terms))), F.lit(float(coef[0])) * basis[0])
        spread = rows.agg(F.stddev_pop(resid)).first()[0] or 0.0
        if spread <= 1e-9 * c["range"]:
            break
        kept = kept & (F.abs(resid) < sigma * spread)
    n = p.filter(kept).count()
    points.unpersist()
    return {"x0": c["x"], "y0": c["y"], "scale": scale, "terms": terms, "coef": coef.tolist(), "kept": n}


def surface_value(fit: dict, x: str = "x", y: str = "y") -> Column:
    u, v = (F.col(x) - fit["x0"]) / fit["scale"], (F.col(y) - fit["y0"]) / fit["scale"]
    return sum((F.lit(k) * F.pow(u, F.lit(float(i))) * F.pow(v, F.lit(float(j))) for k, (i, j) in zip(fit["coef"], fit["terms"], strict=True)), F.lit(0.0))
