"""Surface queries: cell maxima, openings, gates, ground filters, datum, resampling, smoothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..operators import clouds, fits, raster
from ..operators.compose import alpha
from ..operators.joins import resample_bilinear as resample
from .plots import plot_pixels
from ..session import scratch
from .registering import query
from .views import SQL, cells, surface, view


@query("SELECT flight, row, col, round(dsm, 6) AS dsm, n FROM cells", "cells")
def dsm_cellmax(spark, d):
    return cells(spark, d).select("flight", "row", "col", N.r6("dsm").alias("dsm"), "n")


def _window(fn: str, c: str, part: str, order: str, before: int, after: int) -> str:
    return f"{fn}({c}) OVER (PARTITION BY {part} ORDER BY {order} RANGE BETWEEN {before} PRECEDING AND {after} FOLLOWING)"


_DENSE = """(SELECT f.row, f.col, coalesce(s.z, (SELECT min(z) FROM surface)) AS z FROM (SELECT CAST(r AS INT) AS row, CAST(c AS INT) AS col FROM (SELECT unnest(range((SELECT min(row) FROM surface), (SELECT max(row) + 1 FROM surface))) AS r),
(SELECT unnest(range((SELECT min(col) FROM surface), (SELECT max(col) + 1 FROM surface))) AS c)) f LEFT JOIN surface s ON s.row = f.row AND s.col = f.col)"""
_OPEN = (f"(SELECT row, col, {_window('max', 'z', 'col', 'row', 2, 2)} AS z FROM (SELECT row, col, {_window('max', 'z', 'row', 'col', 2, 2)} AS z FROM "
         f"(SELECT row, col, {_window('min', 'z', 'col', 'row', 2, 2)} AS z FROM (SELECT row, col, {_window('min', 'z', 'row', 'col', 2, 2)} AS z FROM {_DENSE}))))")


@query(f"SELECT row, col, round(z, 6) AS dtm FROM {_OPEN}", "surface")
def dtm_opening(spark, d):
    return raster.grey_opening(surface(spark, d), "z", 5).select("row", "col", N.r6("dtm").alias("dtm"))


@query(f"SELECT s.row, s.col, round(least(greatest(s.z - o.z, 0e0), 5e-1), 6) AS chm FROM surface s JOIN {_OPEN} o ON o.row = s.row AND o.col = s.col", "surface")
def chm_clip(spark, d):
    s = surface(spark, d)
    x = s.join(raster.grey_opening(s, "z", 5).select("row", "col", "dtm"), ["row", "col"])
    return x.select("row", "col", N.r6(N.clip(F.col("z") - F.col("dtm"), 0.0, 0.5)).alias("chm"))


@query("""SELECT CAST(floor((5214995e0 - y) / 5e-1) AS INT) AS row, CAST(floor((x - 541005e0) / 5e-1) AS INT) AS col, round(max(z), 6) AS z, count(*) AS n FROM points
WHERE x >= 541005e0 AND x < 541030e0 AND y > 5214980e0 AND y <= 5214995e0 AND z BETWEEN 4302e-1 AND 4308e-1 GROUP BY 1, 2""", "points")
def splat_bounds(spark, d):
    return clouds.splat(view(spark, d, "points"), (541005.0, 5214980.0, 541030.0, 5214995.0), (430.2, 430.8), 0.5).select("row", "col", N.r6("z").alias("z"), "n")


@query("""SELECT flight, count(*) AS n, round(min(z), 6) AS low, round(max(z), 6) AS high FROM points WHERE z >= (SELECT median(z) - 3e-1 FROM points) AND z <= (SELECT min(z) - 92e-1 FROM poses) GROUP BY flight""", "points", "poses")
def z_gate(spark, d):
    x = clouds.z_gate(view(spark, d, "points"), view(spark, d, "poses"), 0.3, 9.2)
    return x.groupBy("flight").agg(F.count(F.lit(1)).alias("n"), N.r6(F.min("z")).alias("low"), N.r6(F.max("z")).alias("high"))


def _iqr_sql(c: str) -> str:
    return f"{c} BETWEEN q{c}[1] - 3e-1 * (q{c}[2] - q{c}[1]) AND q{c}[2] + 3e-1 * (q{c}[2] - q{c}[1])"


@query(f"""SELECT flight, count(*) AS n, round(min(x), 6) AS x0, round(max(x), 6) AS x1, round(min(z), 6) AS z0, round(max(z), 6) AS z1 FROM points,
(SELECT {', '.join(f'quantile_cont({c}, [25e-2, 75e-2]) AS q{c}' for c in 'xyz')} FROM points) WHERE {' AND '.join(_iqr_sql(c) for c in 'xyz')} GROUP BY flight""", "points")
def iqr_trim(spark, d):
    x = clouds.iqr_trim(view(spark, d, "points"), ("x", "y", "z"), 0.3)
    return x.groupBy("flight").agg(F.count(F.lit(1)).alias("n"), N.r6(F.min("x")).alias("x0"), N.r6(F.max("x")).alias("x1"),
                                   N.r6(F.min("z")).alias("z0"), N.r6(F.max("z")).alias("z1"))


_HIST = "(SELECT CAST(CASE WHEN hi > lo THEN least(floor((dsm - lo) / ((hi - lo) / 256)), 255) ELSE 0 END AS INT) AS bin, count(*) AS c, lo, hi FROM cells, (SELECT min(dsm) AS lo, max(dsm) AS hi FROM cells) GROUP BY 1, 3, 4)"


@query(f"""SELECT round(arg_max(lo + bin * (hi - lo) / 256, struct_pack(v := round((mt * w - m) ** 2 / (w * (1 - w)), 9), b := -bin)), 6) AS threshold FROM
(SELECT bin, lo, hi, sum(c) OVER (ORDER BY bin) / sum(c) OVER () AS w, sum(c * (lo + (bin + 5e-1) * (hi - lo) / 256)) OVER (ORDER BY bin) / sum(c) OVER () AS m, sum(c * (lo + (bin + 5e-1) * (hi - lo) / 256)) OVER () / sum(c) OVER () AS mt FROM {_HIST})
WHERE w > 0 AND w < 1""", "cells")
def otsu_threshold(spark, d):
    return raster.otsu(cells(spark, d), "dsm").select(N.r6("threshold").alias("threshold"))


@query("""SELECT row // 8 AS br, col // 8 AS bc, count(*) AS n, round(quantile_cont(dsm, 15e-2), 6) AS seed FROM cells GROUP BY 1, 2
HAVING count(*) >= 30 AND quantile_cont(dsm, 75e-2) - quantile_cont(dsm, 25e-2) <= 35e-2""", "cells")
def cell_seeds(spark, d):
    return clouds.cell_seeds(cells(spark, d)).select("br", "bc", "n", N.r6("seed").alias("seed"))


@query("""SELECT a.row, a.col, count(*) AS n, round(avg(b.z), 6) AS local_mean, CASE WHEN count(*) >= 3 THEN round(stddev_pop(b.z), 4) END AS local_std FROM surface a JOIN surface b
ON abs(a.row - b.row) <= 2 AND abs(a.col - b.col) <= 2 GROUP BY 1, 2""", "surface")
def local_roughness(spark, d):
    s = surface(spark, d)
    x = raster.local_std(s.withColumn("z", F.col("z") - 430), "z")  # near zero, squares keep their digits
    n = raster.dense(s, "z").select("row", "col", F.col("z").isNotNull().cast("int").alias("has"))
    w1 = Window.partitionBy("row").orderBy("col").rangeBetween(-2, 2)
    w2 = Window.partitionBy("col").orderBy("row").rangeBetween(-2, 2)
    n = n.withColumn("h", F.sum("has").over(w1)).withColumn("n", F.sum("h").over(w2)).select("row", "col", "n")
    return x.join(n, ["row", "col"]).select("row", "col", "n", N.r6(F.col("local_mean") + 430).alias("local_mean"), F.round("local_std", 4).alias("local_std"))


_GROUND = "(SELECT row, col, round(arg_min(dsm, flight), 6) AS z, count(*) AS hits FROM cells WHERE dsm < 4306e-1 GROUP BY row, col)"


@query(f"SELECT row, col, z, hits FROM {_GROUND}", "cells")
def mosaic_first(spark, d):
    return raster.mosaic_first(cells(spark, d).filter("dsm < 4306e-1"), "flight").select("row", "col", N.r6("z").alias("z"), "hits")


def _high(spark, d) -> DataFrame:
    return surface(spark, d).filter("(row * row + col * 3) % 7 < 3").select("row", "col")


_BLOB = """WITH RECURSIVE p AS (SELECT * FROM (SELECT CAST(floor(5215000e0 - y) AS INT) AS row, CAST(floor(x - 541000e0) AS INT) AS col, min(z) AS z FROM ({points}) GROUP BY 1, 2) WHERE (row * 40 + col) % 11 <> 0 AND (row * row + col * 3) % 7 < 3),
m AS (SELECT row, col, row * 2147483648 + col AS id FROM p),
r AS (SELECT id, id AS root FROM m UNION SELECT m.id, r.root FROM r JOIN m n ON n.id = r.id JOIN m ON abs(m.row - n.row) + abs(m.col - n.col) = 1),
b AS (SELECT id, min(root) AS blob FROM r GROUP BY id)
SELECT row, col, blob, size FROM (SELECT m.row, m.col, b.blob, count(*) OVER (PARTITION BY b.blob) AS size FROM m JOIN b USING (id)) WHERE size >= 4""".format(points=SQL["points"])


@query(_BLOB)
def blob_filter(spark, d):
    _checkpoints(spark)
    b = raster.blobs(_high(spark, d))
    return b.filter("size >= 4").select("row", "col", "blob", "size")


@query("""SELECT DISTINCT c.row, c.col FROM surface c JOIN surface m ON (m.row * m.row + m.col * 3) % 7 < 3 AND (c.row - m.row) * (c.row - m.row) + (c.col - m.col) * (c.col - m.col) <= 6.25e0""", "surface")
def near_band(spark, d):
    return raster.near(_high(spark, d), surface(spark, d).select("row", "col"), 2.5)


@query("""SELECT DISTINCT c.row, c.col FROM surface c JOIN surface m ON (m.row * m.row + m.col * 3) % 7 < 3 AND abs(c.row - m.row) + abs(c.col - m.col) <= 2""", "surface")
def mask_dilation(spark, d):
    s = surface(spark, d).select("row", "col")
    return s.join(raster.dilate(_high(spark, d), 2), ["row", "col"], "left_semi")


_DIFF = f"(SELECT c.flight, c.dsm - g.z AS diff FROM cells c JOIN {_GROUND} g ON g.row = c.row AND g.col = c.col)"
_OFFSET = f"(SELECT flight, median(diff) AS o, count(*) AS n FROM {_DIFF} GROUP BY flight)"
_MAD = f"(SELECT d.flight, o.o AS offset, o.n, median(abs(d.diff - o.o)) AS mad FROM {_DIFF} d JOIN {_OFFSET} o ON o.flight = d.flight GROUP BY 1, 2, 3)"
_GROUND_OFF = '"offset"'


def _datum(spark, d) -> DataFrame:
    c = cells(spark, d)
    g = c.filter("dsm < 4306e-1").groupBy("row", "col").agg(N.r6(F.min_by("dsm", "flight")).alias("g"))
    _checkpoints(spark)
    # written once: the medians read it several times
    diff = c.join(g, ["row", "col"]).select("flight", (F.col("dsm") - F.col("g")).alias("diff")).checkpoint()
    return fits.median_mad(diff, "diff", ("flight",))


@query(f"""SELECT flight, n, round({_GROUND_OFF}, 6) AS off, round(mad, 6) AS mad, CASE WHEN mad < 3e-2 THEN 'ok' WHEN mad < 8e-2 THEN 'SUSPECT' ELSE 'NOT ALIGNED' END AS verdict FROM {_MAD.replace('AS offset', 'AS ' + _GROUND_OFF)}""", "cells")
def datum_offset_mad(spark, d):
    return _datum(spark, d).select("flight", "n", N.r6("offset").alias("off"), N.r6("mad").alias("mad"), fits.datum_verdict().alias("verdict"))


@query(f"""SELECT flight, last_value(CASE WHEN n >= (SELECT median(n) FROM {_OFFSET}) THEN round(o, 6) END IGNORE NULLS) OVER (ORDER BY flight) AS off FROM {_OFFSET}""", "cells")
def datum_carry_forward(spark, d):
    x = _datum(spark, d)
    least = x.agg(F.median("n").alias("least"))
    x = x.crossJoin(F.broadcast(least)).withColumn("field", F.lit("all"))  # one field here: the state is kept a field
    return raster.carry_forward(x, "offset", F.col("n") >= F.col("least")).select("flight", N.r6("off").alias("off"))


@query(f"""SELECT c.flight, c.row, c.col, round(c.dsm - (g.z + o.o), 6) AS height FROM cells c JOIN {_GROUND} g ON g.row = c.row AND g.col = c.col JOIN {_OFFSET} o ON o.flight = c.flight""", "cells")
def ref_height(spark, d):
    g = mosaic_first(spark, d).select("row", "col", F.col("z").alias("g"))
    o = _datum(spark, d).select("flight", "offset")
    return cells(spark, d).join(g, ["row", "col"]).join(o, "flight").select("flight", "row", "col", N.r6(F.col("dsm") - (F.col("g") + F.col("offset"))).alias("height"))


@query("""SELECT k, CASE WHEN count(*) = count(s.z) THEN round(sum(w * s.z), 6) END AS z FROM (SELECT k, CAST(floor(fr) AS INT) + i AS row, CAST(floor(fc) AS INT) + j AS col, (CASE WHEN i = 1 THEN fr - floor(fr) ELSE 1 - (fr - floor(fr)) END) * (CASE WHEN j = 1 THEN fc - floor(fc) ELSE 1 - (fc - floor(fc)) END) AS w
FROM (SELECT p_partkey AS k, (p_partkey % 113) / 4e0 AS fr, (p_partkey % 151) / 4e0 AS fc FROM part), (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j)) n LEFT JOIN surface s ON s.row = n.row AND s.col = n.col WHERE w > 0 GROUP BY k""", "surface")
def resample_bilinear(spark, d):
    t = view(spark, d, "design").selectExpr("plot_id AS k", "(plot_id % 113) / 4e0 AS frow", "(plot_id % 151) / 4e0 AS fcol")
    return resample(surface(spark, d), t).select("k", N.r6("z").alias("z"))


@query("""SELECT row, col, round(z, 6) AS z FROM (SELECT f.row, f.col, s.z, row_number() OVER (PARTITION BY f.row, f.col ORDER BY (f.row - s.row) * (f.row - s.row) + (f.col - s.col) * (f.col - s.col), s.row, s.col) AS k FROM
(SELECT row, col FROM """ + _DENSE + """) f, surface s) WHERE k = 1""", "surface")
def nearest_fill(spark, d):
    return raster.nearest_fill(surface(spark, d), "z").select("row", "col", N.r6("z").alias("z"))


_K = "exp(-((a.{0} - b.{0}) * (a.{0} - b.{0})) / 2e0)"


@query(f"""SELECT a.row, a.col, round(sum(b.s * {_K.format('row')}) / sum({_K.format('row')}), 6) AS smooth FROM surface a JOIN
(SELECT a.row, a.col, sum(b.z * {_K.format('col')}) / sum({_K.format('col')}) AS s FROM surface a JOIN surface b ON a.row = b.row AND abs(a.col - b.col) <= 4 GROUP BY 1, 2) b ON a.col = b.col AND abs(a.row - b.row) <= 4 GROUP BY 1, 2""", "surface")
def gaussian_smooth(spark, d):
    return raster.gaussian(surface(spark, d), "z", 1.0).select("row", "col", N.r6("smooth").alias("smooth"))


@query("""SELECT row // 2 AS row, col // 2 AS col, round(avg(z), 6) AS area, round(max(CASE WHEN row % 2 = 0 AND col % 2 = 0 THEN z END), 6) AS nearest FROM surface GROUP BY 1, 2""", "surface")
def resize_raster(spark, d):
    return raster.resize(surface(spark, d), "z").select("row", "col", N.r6("area").alias("area"), N.r6("nearest").alias("nearest"))


_BARE = ("(SELECT flight, row, col, dsm, plot_id, plot_id % 3 <> 0 AND row % 7 <> 0 AND dsm - 4302e-1 BETWEEN -25e-2 AND 12e-2 AS bare, row % 7 <> 0 AS outside FROM pixels)")


@query(f"SELECT flight, row, col, round(dsm, 6) AS z FROM {_BARE} WHERE bare", "pixels")
def bare_ground_filter(spark, d):
    return _bare(spark, d).filter("bare").select("flight", "row", "col", N.r6("dsm").alias("z"))


def _bare(spark, d) -> DataFrame:
    return clouds.bare_ground(plot_pixels(spark, d), F.col("plot_id") % 3 != 0, F.col("row") % 7 != 0, F.col("dsm") - 430.2)


@query(f"SELECT row, col, round(min(dsm), 6) AS z FROM {_BARE} WHERE bare OR (flight = (SELECT min(flight) FROM pixels) AND plot_id % 3 = 0 AND dsm < 4305e-1) GROUP BY row, col", "pixels")
def base_flight_ground(spark, d):
    return clouds.base_ground(_bare(spark, d), F.col("plot_id") % 3 == 0, 430.5).select("row", "col", N.r6("z").alias("z"))


@query(f"SELECT flight, count(*) FILTER (WHERE bare) AS n_bare, round(avg(CASE WHEN bare THEN 1 ELSE 0 END), 6) AS of_all, round(avg(CASE WHEN bare THEN 1 ELSE 0 END) FILTER (WHERE outside), 6) AS of_outside FROM {_BARE} GROUP BY flight", "pixels")
def bare_fraction(spark, d):
    b = F.col("bare").cast("int")
    return _bare(spark, d).groupBy("flight").agg(F.count_if("bare").alias("n_bare"), N.r6(F.avg(b)).alias("of_all"), N.r6(F.avg(F.when(F.col("outside"), b))).alias("of_outside"))


@query("SELECT a.flight AS fa, b.flight AS fb, count(*) AS n, round(median(a.dsm - b.dsm), 6) AS diff FROM cells a JOIN cells b ON a.row = b.row AND a.col = b.col AND a.flight < b.flight GROUP BY 1, 2", "cells")
def ref_crosscheck(spark, d):
    return raster.crosscheck(cells(spark, d)).select("fa", "fb", "n", N.r6("diff").alias("diff"))


@query("SELECT row, col, bool_and(dsm < 4308e-1) AS every, bool_or(dsm < 4304e-1) AS any, NOT bool_or(n > 3) AS calm FROM cells GROUP BY row, col", "cells")
def mask_algebra(spark, d):
    return cells(spark, d).groupBy("row", "col").agg(F.bool_and(F.col("dsm") < 430.8).alias("every"), F.bool_or(F.col("dsm") < 430.4).alias("any"), (~F.bool_or(F.col("n") > 3)).alias("calm"))


@query("SELECT flight, round(100 * count(*) / 19200e0, 6) AS hit_pct, round(100 * count(*) FILTER (WHERE n = 1) / 19200e0, 6) AS single_pct FROM cells GROUP BY flight", "cells")
def coverage_shares(spark, d):
    return raster.shares(cells(spark, d), "flight", 19200).select("flight", N.r6(100 * F.col("hit")).alias("hit_pct"), N.r6(100 * F.col("single")).alias("single_pct"))


@query("SELECT flight, round(max(dsm) - min(dsm), 6) AS relief, round(count(*) / 19200e0, 6) AS hit FROM cells GROUP BY flight", "cells")
def dsm_relief(spark, d):
    return raster.shares(cells(spark, d), "flight", 19200).select("flight", N.r6("relief").alias("relief"), N.r6("hit").alias("hit"))


@query("SELECT flight, CASE WHEN a > 0 AND r > 60 THEN 255 ELSE 0 END AS alpha, count(*) AS n, sum(CASE WHEN a > 0 AND r > 60 THEN g ELSE 0 END)::BIGINT AS green FROM rgb GROUP BY 1, 2", "rgb")
def alpha_mask(spark, d):
    x = view(spark, d, "rgb").withColumn("alpha", alpha(F.col("r") > 60, F.col("a") > 0))
    return x.groupBy("flight", "alpha").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("alpha") == 255, F.col("g")).otherwise(0)).alias("green"))


@query("SELECT flight, round(min(x), 6) AS x0, round(max(x), 6) AS x1, round(min(y), 6) AS y0, round(max(y), 6) AS y1, round(max(z) - min(z), 6) AS ptp_z FROM points GROUP BY flight", "points")
def cloud_extent(spark, d):
    return raster.extent(view(spark, d, "points"), "flight").select("flight", *[N.r6(c).alias(c) for c in ("x0", "x1", "y0", "y1", "ptp_z")])


@query("SELECT flight, CAST(trunc((max(x) - min(x) + 40) / 25e-2) AS INT) AS w, CAST(trunc((max(y) - min(y) + 40) / 25e-2) AS INT) AS h, round(min(x) - 20, 6) AS x0, round(max(y) + 20, 6) AS y1 FROM points GROUP BY flight", "points")
def canvas_size(spark, d):
    return raster.canvas(view(spark, d, "points"), "flight", 0.25, 20.0).select("flight", "w", "h", N.r6("x0").alias("x0"), N.r6("y1").alias("y1"))


@query("SELECT greatest(least(CAST(trunc((x - 541005e0) / 5e-1) AS INT), 40), 0) AS ix, greatest(least(CAST(trunc((5214995e0 - y) / 5e-1) AS INT), 30), 0) AS iy, count(*) AS n FROM points GROUP BY 1, 2", "points")
def cell_index(spark, d):
    cut = lambda c, top: F.greatest(F.least(c.cast("int"), F.lit(top)), F.lit(0))
    return (view(spark, d, "points").groupBy(cut((F.col("x") - 541005.0) / 0.5, 40).alias("ix"), cut((F.lit(5214995.0) - F.col("y")) / 0.5, 30).alias("iy"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("SELECT row, col, round(541000e0 + (col + 5e-1) * 25e-2, 6) AS x, round(5215000e0 - (row + 5e-1) * 25e-2, 6) AS y FROM (SELECT DISTINCT row, col FROM cells)", "cells")
def pixel_centres(spark, d):
    x, y = N.cell_centre("row", "col", 541000.0, 5215000.0, 0.25)
    return cells(spark, d).select("row", "col").distinct().select("row", "col", N.r6(x).alias("x"), N.r6(y).alias("y"))


@query("SELECT k, CAST(floor((5215000e0 - n) / 25e-2) AS INT) AS row, CAST(floor((e - 541000e0) / 25e-2) AS INT) AS col FROM poses", "poses")
def world_to_pixel(spark, d):
    row, col = N.grid_cell("e", "n", 541000.0, 5215000.0, 0.25)
    return view(spark, d, "poses").select("k", row.alias("row"), col.alias("col"))


def robust_trend(spark, d):
    """Coefficients of the clipped trend of the surface (σ-clip; checked against numpy in the tests)."""
    fit = fits.trend_surface(surface(spark, d).selectExpr("541000e0 + col + 5e-1 AS x", "5215000e0 - row - 5e-1 AS y", "z"))
    rows = [(f"x{i}y{j}", round(float(k), 6), int(fit["kept"])) for (i, j), k in zip(fit["terms"], fit["coef"], strict=True)]
    return spark.createDataFrame(rows, "term string, coef double, kept long")


def ref_surface(spark, d):
    """Trend plus smoothed residual; cells without an observation are extrapolated (checked in the tests)."""
    s = surface(spark, d).withColumn("x", F.lit(541000.5) + F.col("col")).withColumn("y", F.lit(5214999.5) - F.col("row"))
    fit = fits.trend_surface(s.select("x", "y", "z"))
    t = fits.surface_value(fit)
    full = raster.dense(s, "z").withColumn("x", F.lit(541000.5) + F.col("col")).withColumn("y", F.lit(5214999.5) - F.col("row"))
    full = full.withColumn("trend", t).withColumn("resid", F.coalesce(F.col("z") - F.col("trend"), F.lit(0.0)))
    smooth = raster.gaussian(full.select("row", "col", "resid"), "resid", 3.0)
    x = full.join(smooth, ["row", "col"])
    return x.select("row", "col", N.r6(F.col("trend") + F.col("smooth")).alias("ref"), F.col("z").isNull().alias("extrapolated"))


query()(robust_trend)
query()(ref_surface)


def _checkpoints(spark) -> None:
    """Lineage is cut in the folder that the session names; a default only where it names none."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch(spark))
