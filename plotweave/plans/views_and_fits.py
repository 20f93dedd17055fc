"""Camera, compositing and fit queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..operators import compose, fits, flightlines
from .registering import query
from .views import images, read, surface, view, views_of_pixels


@query("""SELECT CASE WHEN tilt < 5 THEN '00-05' WHEN tilt < 10 THEN '05-10' WHEN tilt < 20 THEN '10-20' WHEN tilt < 30 THEN '20-30' WHEN tilt < 45 THEN '30-45' ELSE '45-90' END AS bucket, count(*) AS n FROM
(SELECT round(tilt, 6) AS tilt FROM poses) WHERE tilt < 90 GROUP BY 1""", "poses")
def nadir_hist(spark, d):
    a = F.round(N.nadir_angle(F.sin(F.radians("tilt")), F.lit(0.0), -F.cos(F.radians("tilt"))), 6)
    x = view(spark, d, "poses").select(a.alias("a")).filter("a < 90")
    return x.groupBy(flightlines.angle_histogram(F.col("a")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT round(median(z - (SELECT median(z) FROM points)) FILTER (WHERE z > (SELECT median(z) FROM points)) / 37005e-1, 9) AS gsd, count(*) AS cameras FROM poses", "points", "poses")
def native_gsd(spark, d):
    x = flightlines.native_gsd(view(spark, d, "points"), view(spark, d, "poses"), 3700.5)
    return x.select(F.round("gsd", 9).alias("gsd"), "cameras")


@query("""SELECT round(CASE WHEN p.x0 < c.x0 - 30 THEN c.x0 - 30 ELSE p.x0 END, 6) AS x0, round(CASE WHEN p.x1 > c.x1 + 30 THEN c.x1 + 30 ELSE p.x1 END, 6) AS x1,
round(CASE WHEN p.y0 < c.y0 - 30 THEN c.y0 - 30 ELSE p.y0 END, 6) AS y0, round(CASE WHEN p.y1 > c.y1 + 30 THEN c.y1 + 30 ELSE p.y1 END, 6) AS y1 FROM
(SELECT min(x) - 5e-1 AS x0, max(x) + 5e-1 AS x1, min(y) - 5e-1 AS y0, max(y) + 5e-1 AS y1 FROM points) p, (SELECT min(e) AS x0, max(e) AS x1, min(n) AS y0, max(n) AS y1 FROM poses WHERE tilt <= 20) c""", "points", "poses")
def camera_bounds(spark, d):
    p = view(spark, d, "points").agg(F.min("x").alias("px0"), F.max("x").alias("px1"), F.min("y").alias("py0"), F.max("y").alias("py1"))
    c = view(spark, d, "poses").filter("tilt <= 20").agg(F.min("e").alias("cx0"), F.max("e").alias("cx1"), F.min("n").alias("cy0"), F.max("n").alias("cy1"))
    b = p.crossJoin(c)
    low = lambda a: N.r6(F.greatest(F.col(f"p{a}0") - 0.5, F.col(f"c{a}0") - 30)).alias(f"{a}0")
    high = lambda a: N.r6(F.least(F.col(f"p{a}1") + 0.5, F.col(f"c{a}1") + 30)).alias(f"{a}1")
    return b.select(low("x"), high("x"), low("y"), high("y"))


@query("SELECT row, col, k, round(w, 6) AS w FROM pixviews WHERE w > 0", "pixviews")
def view_weights(spark, d):
    return views_of_pixels(spark, d).filter("w > 0").select("row", "col", "k", N.r6("w").alias("w"))


_TOP = "(SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY w DESC, k) AS place FROM pixviews WHERE w > 0 AND gated)"


@query(f"SELECT row, col, CAST(place AS INT) AS place, k, round(w, 6) AS w FROM {_TOP} WHERE place <= 2", "pixviews")
def top2_views(spark, d):
    return compose.top_views(views_of_pixels(spark, d).filter("gated"), ["row", "col"]).select("row", "col", "place", "k", N.r6("w").alias("w"))


@query(f"SELECT row, col, CAST(place AS INT) AS place, k, c FROM (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY w DESC, k) AS place FROM pixviews WHERE w > 0) WHERE place <= 3", "pixviews")
def topk_per_pixel(spark, d):
    return compose.top_views(views_of_pixels(spark, d), ["row", "col"], 3).select("row", "col", "place", "k", "c")


_SEAM = f"""(SELECT row, col, CASE WHEN c2 IS NULL THEN c1 ELSE c1 * (1 - a) + c2 * a END AS blend FROM (SELECT *, CASE WHEN w2 IS NULL THEN 0e0 ELSE least(greatest((w2 / w1 - 9e-1) / (1 - 9e-1), 0e0), 1e0) / 2 END AS a FROM
(SELECT row, col, max(w) FILTER (WHERE place = 1) AS w1, max(w) FILTER (WHERE place = 2) AS w2, max(c) FILTER (WHERE place = 1) AS c1, max(c) FILTER (WHERE place = 2) AS c2 FROM {_TOP} WHERE place <= 2 GROUP BY 1, 2)))"""
_BEST = "(SELECT row, col, c AS fallback, k FROM (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY w DESC, k) AS p FROM pixviews WHERE w > 0) WHERE p = 1)"


@query(f"SELECT f.row, f.col, round(coalesce(s.blend, f.fallback), 6) AS colour, s.blend IS NULL AS is_fallback FROM {_BEST} f LEFT JOIN {_SEAM} s ON s.row = f.row AND s.col = f.col", "pixviews")
def seam_feather(spark, d):
    return compose.composite(views_of_pixels(spark, d), ["row", "col"]).select("row", "col", N.r6("colour").alias("colour"), "is_fallback")


@query(f"SELECT f.row, f.col, f.k, f.fallback AS c FROM {_BEST} f LEFT JOIN {_SEAM} s ON s.row = f.row AND s.col = f.col WHERE s.blend IS NULL", "pixviews")
def ungated_fallback(spark, d):
    v = views_of_pixels(spark, d)
    best = compose.best_view(v, ["row", "col"], keep=("c",))
    return best.join(v.filter("gated AND w > 0").select("row", "col").distinct(), ["row", "col"], "left_anti").select("row", "col", "k", "c")


@query("""SELECT v.row, v.col, v.k, CASE WHEN s.d IS NULL THEN true ELSE s.d > 0 AND abs(s.d - 10) <= 15e-1 END AS passes FROM pixviews v LEFT JOIN
(SELECT s_suppkey AS k, r.r AS row, CAST((s_suppkey + r.r) % 13 AS DOUBLE) AS d FROM supplier, (SELECT CAST(i AS INT) AS r FROM range(15) t(i)) r WHERE s_suppkey % 2 = 0) s ON s.k = v.k AND s.row = v.row""", "pixviews")
def depth_gate(spark, d):
    rows = spark.range(15).select(F.col("id").cast("int").alias("row"))
    maps = view(spark, d, "poses").filter("k % 2 = 0").select("k").crossJoin(F.broadcast(rows))
    maps = maps.withColumn("d", ((F.col("k") + F.col("row")) % 13).cast("double"))
    x = views_of_pixels(spark, d).join(maps, ["k", "row"], "left").withColumn("expected", F.lit(10.0))
    return x.select("row", "col", "k", compose.depth_gate("d", "expected", 1.5).alias("passes"))


@query("SELECT k, round(greatest(z - 4305e-1, 1e0) * 2500 / 37005e-1 + 2, 6) AS radius FROM poses", "poses")
def footprint_radius(spark, d):
    return view(spark, d, "poses").select("k", N.r6(flightlines.footprint_radius(F.col("z") - 430.5, 2500, 3700.5)).alias("radius"))


_R, _T = [[0.0, -1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 1.0]], [541000.0, 5215000.0, 400.0]


@query("SELECT k, round(2 * -((n - 5215000e0) * 1e0) + 541000e0, 5) AS x, round(2 * (e - 541000e0) + 5215000e0, 5) AS y, round(2 * (z - 400) + 400, 5) AS z, round(e, 5) AS e_back FROM poses", "poses")
def similarity_transform(spark, d):
    p = view(spark, d, "poses").select("k", (F.col("e") - 541000).alias("x"), (F.col("n") - 5215000).alias("y"), (F.col("z") - 400).alias("z"))
    x, y, z = N.similarity(2.0, _R, _T)
    p = p.select("k", x.alias("x"), y.alias("y"), z.alias("z"))
    back = N.similarity_inverse(2.0, _R, _T)
    return p.select("k", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"), F.round("z", 5).alias("z"), F.round(back[0] + 541000, 5).alias("e_back"))


@query("""SELECT l_orderkey AS o, l_linenumber AS l, count(*) AS n, round(sum((l_suppkey % 40 - 20) / 3e1 * (l_quantity / 5)), 4) AS x, round(sum((l_partkey % 30 - 15) / 3e1 * (l_quantity / 5)), 4) AS y FROM lineitem
WHERE l_suppkey % 3 = 0 AND l_partkey % 3 = 0 GROUP BY 1, 2""")
def backproject_depth(spark, d):
    p = read(spark, d, "lineitem").selectExpr("l_orderkey AS o", "l_linenumber AS l", "l_suppkey % 40 AS u", "l_partkey % 30 AS v", "l_quantity / 5 AS d", "l_suppkey AS s", "l_partkey AS p")
    x, y, _ = N.back_project("u", "v", "d", 30.0, 30.0, 20.0, 15.0)
    return p.filter("s % 3 = 0 AND p % 3 = 0").groupBy("o", "l").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(x), 4).alias("x"), F.round(F.sum(y), 4).alias("y"))


@query("SELECT k, CASE WHEN depth > 1e-6 THEN round(3700e0 * (e - 541020e0) / depth + 2000, 6) END AS u, CASE WHEN depth > 1e-6 THEN round(3700e0 * (n - 5214985e0) / depth + 1500, 6) END AS v FROM (SELECT k, e, n, z - 4405e-1 AS depth FROM poses)", "poses")
def pinhole_project(spark, d):
    p = view(spark, d, "poses").select("k", (F.col("e") - 541020).alias("x"), (F.col("n") - 5214985).alias("y"), (F.col("z") - 440.5).alias("z"))
    u, v = N.pinhole("x", "y", "z", 3700.0, 3700.0, 2000.0, 1500.0)
    return p.select("k", N.r6(u).alias("u"), N.r6(v).alias("v"))


def residuals(spark, d) -> DataFrame:
    """Model minus prior for images of the model, by system: radius and height residual."""
    p = images(spark, d).join(view(spark, d, "priors"), "image_id").withColumn("grp", F.col("image_id") % 5)
    r = F.sqrt((F.col("px") - 45) ** 2 + (F.col("py") - 12) ** 2)
    p = p.withColumn("r", r)
    return p.withColumn("dz", 0.0004 * F.col("r") * F.col("r") + 0.01 * (F.col("image_id") % 7))


_RES = """(SELECT image_id % 5 AS grp, r, 4e-4 * r * r + 1e-2 * (image_id % 7) AS dz FROM (SELECT i.image_id, sqrt((px - 45) ** 2 + (py - 12) ** 2) AS r FROM images i JOIN priors USING (image_id)))"""
_S = "(SELECT *, r / rmax AS t FROM (SELECT *, max(r) OVER (PARTITION BY grp) AS rmax FROM " + _RES + "))"
_MOM = f"(SELECT grp, count(*) AS n, sum(t) AS s1, sum(t ** 2) AS s2, sum(t ** 3) AS s3, sum(t ** 4) AS s4, sum(dz) AS y0, sum(dz * t) AS y1, sum(dz * t ** 2) AS y2, sum(dz ** 2) AS yy, max(abs(dz)) AS z_max FROM {_S} GROUP BY grp)"
_FIT = f"""(SELECT *, (y2 * (s2 * n - s1 * s1) - s3 * (y1 * n - s1 * y0) + s2 * (y1 * s1 - s2 * y0)) / det AS a, (s4 * (y1 * n - s1 * y0) - y2 * (s3 * n - s1 * s2) + s2 * (s3 * y0 - y1 * s2)) / det AS b,
(s4 * (s2 * y0 - y1 * s1) - s3 * (s3 * y0 - y1 * s2) + y2 * (s3 * s1 - s2 * s2)) / det AS c FROM (SELECT *, s4 * (s2 * n - s1 * s1) - s3 * (s3 * n - s1 * s2) + s2 * (s3 * s1 - s2 * s2) AS det FROM {_MOM}))"""
_DOME = f"(SELECT grp, n, a AS bowl, 1 - (yy - a * y2 - b * y1 - c * y0) / (yy - y0 * y0 / n) AS r2, sqrt(yy / n) AS z_rms, z_max FROM {_FIT})"


@query(f"SELECT grp, n, round(bowl, 4) AS bowl, round(r2, 4) AS r2, round(z_rms, 6) AS z_rms, round(z_max, 6) AS z_max FROM {_DOME}", "images", "priors")
def doming_fit(spark, d):
    x = fits.doming(residuals(spark, d), ("grp",))
    return x.select("grp", "n", F.round("bowl", 4).alias("bowl"), F.round("r2", 4).alias("r2"), N.r6("z_rms").alias("z_rms"), N.r6("z_max").alias("z_max"))


@query(f"SELECT grp, CASE WHEN r2 > 4e-1 AND abs(bowl) > 5e-2 THEN 'significant' WHEN abs(bowl) > 5e-2 THEN 'unstructured' ELSE 'none' END AS verdict FROM {_DOME}", "images", "priors")
def doming_verdict(spark, d):
    return fits.doming(residuals(spark, d), ("grp",)).select("grp", fits.doming_report().alias("verdict"))


@query(f"SELECT grp, round(abs(round(bowl, 4)) * tan(radians(25)), 6) AS smear FROM {_DOME}", "images", "priors")
def smear_estimate(spark, d):
    return fits.doming(residuals(spark, d), ("grp",)).select("grp", N.r6(F.abs(F.round("bowl", 4)) * F.tan(F.radians(F.lit(25.0)))).alias("smear"))


@query("SELECT image_id % 5 AS grp, count(*) AS n, round(median(dist), 6) AS median, round(max(dist), 6) AS most FROM (SELECT i.image_id, sqrt((px - 45) ** 2 + (py - 12) ** 2 + (pz - 430) ** 2) AS dist FROM images i JOIN priors USING (image_id)) GROUP BY 1", "images", "priors")
def georef_residuals(spark, d):
    p = images(spark, d).join(view(spark, d, "priors"), "image_id")
    dist = F.sqrt((F.col("px") - 45) ** 2 + (F.col("py") - 12) ** 2 + (F.col("pz") - 430) ** 2)
    return p.select((F.col("image_id") % 5).alias("grp"), dist.alias("d")).groupBy("grp").agg(F.count(F.lit(1)).alias("n"), N.r6(F.median("d")).alias("median"), N.r6(F.max("d")).alias("most"))


_KNOWN = [("scale", 2.0)] + [(f"r{i}{j}", _R[i][j]) for i in range(3) for j in range(3)] + [(f"t{i}", _T[i]) for i in range(3)]


@query(f"SELECT part, value FROM (VALUES {', '.join(f'({k!r}, CAST({v} AS DOUBLE))' for k, v in _KNOWN)}) t(part, value)")
def umeyama(spark, d):
    """Scale, rotation and shift recovered from a known similarity."""
    p = view(spark, d, "poses").select((F.col("e") - 541000).alias("x"), (F.col("n") - 5215000).alias("y"), "z")
    x, y, z = N.similarity(2.0, _R, _T)
    fit = fits.umeyama(p.select(F.col("x").alias("sx"), F.col("y").alias("sy"), F.col("z").alias("sz"), x.alias("dx"), y.alias("dy"), z.alias("dz")))
    rows = [("scale", fit["scale"])] + [(f"r{i}{j}", fit["rotation"][i][j]) for i in range(3) for j in range(3)] + [(f"t{i}", fit["shift"][i]) for i in range(3)]
    return spark.createDataFrame([(k, round(float(v), 6) + 0.0) for k, v in rows], "part string, value double")


@query("SELECT k, CAST(trunc(tilt * 2.7e0) AS INT) % 256 AS u8, CAST(trunc(-tilt / 7e0) AS INT) AS cut, round(CAST(CAST(e AS FLOAT) AS DOUBLE), 4) AS f32 FROM poses", "poses")
def lossy_casts(spark, d):
    p = view(spark, d, "poses")
    return p.select("k", ((F.col("tilt") * 2.7).cast("int") % 256).alias("u8"), (-F.col("tilt") / 7).cast("int").alias("cut"), F.round(F.col("e").cast("float").cast("double"), 4).alias("f32"))


@query("""SELECT k, round(sum(w * coalesce(s.z, 0e0)), 6) AS c FROM (SELECT k, CAST(floor(fr) AS INT) + i AS row, CAST(floor(fc) AS INT) + j AS col, (CASE WHEN i = 1 THEN fr - floor(fr) ELSE 1 - (fr - floor(fr)) END) * (CASE WHEN j = 1 THEN fc - floor(fc) ELSE 1 - (fc - floor(fc)) END) AS w
FROM (SELECT p_partkey AS k, (p_partkey % 113) / 4e0 AS fr, (p_partkey % 151) / 4e0 AS fc FROM part), (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j)) n LEFT JOIN surface s ON s.row = n.row AND s.col = n.col WHERE w > 0 GROUP BY k""", "surface")
def photo_sample(spark, d):
    """Colours at projected places of a photo; what lies outside it counts as 0."""
    at = read(spark, d, "part").selectExpr("p_partkey AS k", "(p_partkey % 113) / 4e0 AS v", "(p_partkey % 151) / 4e0 AS u")
    photo = surface(spark, d).select("row", "col", F.col("z").alias("c"))
    return compose.sample_photo(at, photo).select("k", N.r6("c").alias("c"))
