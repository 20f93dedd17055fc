"""Photo queries: metadata, local and projected coordinates, flight axes, overlap graphs, matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import photo as P
from ..operators import catalog, flightlines
from ..operators.joins import band_pairs
from .registering import query
from .views import read, view

GROUP = ["crop", "flight"]
_XMP = ("'<x:xmpmeta drone:GpsLatitude=\"' || cast(user_id as string) || '.25\" drone:GpsLongtitude=\"-' || cast(event_id % 180 as string) || '.5\"' || "
        "CASE WHEN event_id % 3 = 0 THEN '' ELSE ' AbsoluteAltitude=\"+' || cast(event_id % 50 as string) || '\"' END || "
        "CASE WHEN event_id % 4 = 0 THEN ' FlightYawDegree=\"n/a\" GimbalYawDegree=\"' || cast((event_id * 37) % 360 as string) || '.0\"' ELSE ' FlightYawDegree=\"' || cast((event_id * 37) % 360 as string) || '\"' END || "
        "' GimbalPitchDegree=\"-' || CASE WHEN event_id % 9 = 0 THEN '60' ELSE '90' END || '.0\"' || "
        "' RtkStdLon=\"0.0' || cast(event_id % 9 as string) || '\" RtkStdLat=\"0.01\" RtkStdHgt=\"0.0' || cast(event_id % 7 as string) || '\" RtkFlag=\"' || CASE WHEN event_id % 5 = 0 THEN '16' ELSE '50' END || '\"' || "
        "' DewarpData=\"2024-01-01;3713.29,3713.29,7.02,-8.72,-0.11,0.01,-0.0001,0.0002' || CASE WHEN event_id % 6 = 0 THEN '' ELSE ',-0.0' || cast(event_id % 8 as string) END || '\"></x:xmpmeta>'")


def xmp(spark, d) -> DataFrame:
    return read(spark, d, "events").selectExpr("event_id", "event_type AS crop", "cast(cast(ts as date) as string) AS flight", f"{_XMP} AS xmp")


_YAW = "CAST((event_id * 37) % 360 AS DOUBLE)"


@query(f"SELECT event_id, CAST(user_id AS DOUBLE) + 25e-2 AS lat, {_YAW} AS yaw FROM events")
def xmp_float(spark, d):
    return xmp(spark, d).select("event_id", P.xmp_number("xmp", *P.LAT_TAGS).alias("lat"), P.heading("xmp").alias("yaw"))


@query("SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN 371329e-2 END AS fx, CASE WHEN event_id % 6 <> 0 THEN -872e-2 END AS cy, CASE WHEN event_id % 6 <> 0 THEN round(-(event_id % 8) / 1e2, 6) + 0e0 END AS k3 FROM events")
def xmp_dewarp(spark, d):
    x = xmp(spark, d).select("event_id", P.xmp_dewarp("xmp").alias("w"))
    return x.select("event_id", "w.fx", "w.cy", (F.round("w.k3", 6) + F.lit(0.0)).alias("k3"))


@query("""SELECT event_id, round(CASE WHEN event_id % 5 <> 0 THEN (event_id % 90) + 30 / 6e1 + 36 / 36e2 ELSE user_id + 25e-2 END, 6) AS lat,
round(CASE WHEN event_id % 5 <> 0 THEN -((event_id % 180) + 15 / 6e1) ELSE -((event_id % 180) + 5e-1) END, 6) AS lon, CASE WHEN event_id % 3 = 0 THEN 0e0 ELSE CAST(event_id % 50 AS DOUBLE) END AS alt FROM events""")
def gps_coalesce(spark, d):
    x = xmp(spark, d).withColumn("g", P.gps("xmp"))
    has = F.col("event_id") % 5 != 0  # EXIF first, XMP second
    lat = F.when(has, N.dms(F.col("event_id") % 90, F.lit(30), F.lit(36), F.lit("N")))
    lon = F.when(has, N.dms(F.col("event_id") % 180, F.lit(15), F.lit(0), F.lit("W")))
    return x.select("event_id", F.round(F.coalesce(lat, "g.lat"), 6).alias("lat"), F.round(F.coalesce(lon, "g.lon"), 6).alias("lon"), F.col("g.alt").alias("alt")).filter("lat IS NOT NULL")


@query("""SELECT crop, flight, round(median(greatest((event_id % 9) / 1e2, 1e-2)), 6) AS xy, round(median((event_id % 7) / 1e2), 6) AS z, round(avg(CASE WHEN event_id % 5 <> 0 THEN 1 ELSE 0 END), 6) AS fixed
FROM frames GROUP BY crop, flight""", "frames")
def rtk_quality(spark, d):
    x = flightlines.rtk_quality(xmp(spark, d).withColumn("rtk", P.rtk("xmp")), GROUP)
    return x.select(*GROUP, *[N.r6(c).alias(c) for c in ("xy", "z", "fixed")])


@query("""SELECT event_id, round((f.lon - o.lon) * 111320e0 * cos(radians(o.lat)), 6) + 0e0 AS e, round((f.lat - o.lat) * 110540e0, 6) + 0e0 AS n FROM frames f
JOIN (SELECT crop, flight, arg_min(lat, name) AS lat, arg_min(lon, name) AS lon FROM frames GROUP BY 1, 2) o USING (crop, flight)""", "frames")
def local_en(spark, d):
    x = view(spark, d, "frames")
    o = x.groupBy(*GROUP).agg(F.min_by(F.struct("lat", "lon"), "name").alias("o"))
    x = x.join(o, GROUP)
    return x.select("event_id", (N.r6(N.local_east("lon", "o.lon", "o.lat")) + 0.0).alias("e"), (N.r6(N.local_north("lat", "o.lat")) + 0.0).alias("n"))


def _utm_sql() -> str:
    import math

    f = 1 / 298.257223563
    n = f / (2 - f)
    big_a = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    a = (n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3 + 41 / 180 * n**4, 13 / 48 * n**2 - 3 / 5 * n**3 + 557 / 1440 * n**4, 61 / 240 * n**3 - 103 / 140 * n**4, 49561 / 161280 * n**4)
    e = 2 * math.sqrt(n) / (1 + n)
    east = " + ".join(f"{k!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, k in enumerate(a, 1))
    north = " + ".join(f"{k!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, k in enumerate(a, 1))
    return f"""SELECT event_id, round(5e5 + {0.9996 * big_a!r} * (eta + {east}), 3) AS e, round({0.9996 * big_a!r} * (xi + {north}), 3) AS n FROM
(SELECT event_id, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM (SELECT event_id, lam, sinh(atanh(s) - {e!r} * atanh({e!r} * s)) AS t
FROM (SELECT event_id, radians(lon - 9e0) AS lam, sin(radians(lat)) AS s FROM frames)))"""


@query(_utm_sql(), "frames")
def utm_project(spark, d):
    e, n = N.utm("lat", "lon", 32)
    return view(spark, d, "frames").select("event_id", F.round(e, 3).alias("e"), F.round(n, 3).alias("n"))


@query("""SELECT event_id, round(e - avg(e) OVER (), 4) + 0e0 AS e, round(n - avg(n) OVER (), 4) + 0e0 AS n, round(alt - avg(alt) OVER (), 4) + 0e0 AS alt FROM (SELECT event_id, east AS e, north AS n, alt FROM frames)""", "frames")
def centroid_shift(spark, d):
    x = flightlines.centred(view(spark, d, "frames").select("event_id", F.col("east").alias("e"), F.col("north").alias("n"), "alt"), ["e", "n", "alt"])
    return x.select("event_id", *[(F.round(c, 4) + 0.0).alias(c) for c in ("e", "n", "alt")])


_AXIS = "SELECT crop, flight, atan2(round(avg(sin(2 * radians(heading))), 9), round(avg(cos(2 * radians(heading))), 9)) / 2 AS axis FROM frames WHERE pitch <= -80 GROUP BY 1, 2"


@query(f"SELECT crop, flight, round(axis, 6) AS axis FROM ({_AXIS})", "frames")
def axis_azimuth(spark, d):
    return flightlines.axis(view(spark, d, "frames"), GROUP).select(*GROUP, N.r6("axis").alias("axis"))


@query(f"SELECT event_id, round(east * sin(axis) + north * cos(axis), 5) AS along, round(east * cos(axis) - north * sin(axis), 5) AS across FROM frames JOIN ({_AXIS}) USING (crop, flight)", "frames")
def track_rotation(spark, d):
    x = flightlines.tracks(view(spark, d, "frames"), GROUP)
    return x.select("event_id", F.round("along", 5).alias("along"), F.round("across", 5).alias("across"))


_STEPS = """SELECT crop, flight, step FROM (SELECT crop, flight, sqrt((east - pe) ** 2 + (north - pn) ** 2) AS step, abs(((h - ph + 180 + 360) % 360) - 180) AS turn FROM (SELECT crop, flight, heading AS h, east, north,
lag(heading) OVER w AS ph, lag(east) OVER w AS pe, lag(north) OVER w AS pn FROM frames WHERE pitch <= -80 WINDOW w AS (PARTITION BY crop, flight ORDER BY name))) WHERE turn < 20 AND step > 1e-1 AND step < 20"""


@query(f"""SELECT f.crop, f.flight, coalesce(s.n, 0) AS n, round(coalesce(s.p / 2e-1 / 3e3, 317e-5), 8) AS gsd FROM (SELECT DISTINCT crop, flight FROM frames) f
LEFT JOIN (SELECT crop, flight, count(*) AS n, quantile_cont(step, 25e-2) AS p FROM ({_STEPS}) GROUP BY 1, 2) s ON s.crop = f.crop AND s.flight = f.flight""", "frames")
def gsd_estimate(spark, d):
    return flightlines.gsd(view(spark, d, "frames"), GROUP).select(*GROUP, "n", F.round("gsd", 8).alias("gsd"))


@query("""SELECT crop, flight, count(gap) AS n_gaps, round(median(gap), 6) AS spacing FROM (SELECT crop, flight, c - lag(c) OVER (PARTITION BY crop, flight ORDER BY c) AS gap FROM
(SELECT crop, flight, median(north) AS c FROM frames GROUP BY crop, flight, round_even(north / 5, 0) HAVING count(*) >= 2)) GROUP BY crop, flight""", "frames")
def row_spacing(spark, d):
    return flightlines.row_spacing(view(spark, d, "frames"), GROUP).select(*GROUP, "n_gaps", N.r6("spacing").alias("spacing"))


def pairs(spark, d) -> DataFrame:
    x = view(spark, d, "frames").filter("pitch <= -80").select("event_id", *GROUP, "north", "east")
    return band_pairs(x, "event_id", [("north", 4.0), ("east", 4.0)], tuple(GROUP))


_PAIRS = """SELECT a.crop, a.flight, a.event_id AS a, b.event_id AS b, a.east AS ea, b.east AS eb FROM frames a JOIN frames b ON a.crop = b.crop AND a.flight = b.flight AND a.event_id < b.event_id
AND abs(a.north - b.north) < 4e0 AND abs(a.east - b.east) < 4e0 WHERE a.pitch <= -80 AND b.pitch <= -80"""


@query(f"SELECT a, b FROM ({_PAIRS})", "frames")
def overlap_pairs(spark, d):
    return pairs(spark, d).select(F.col("a_event_id").alias("a"), F.col("b_event_id").alias("b"))


@query("""SELECT least(o.event_id, x.event_id) AS a, greatest(o.event_id, x.event_id) AS b FROM frames o JOIN frames x ON o.crop = x.crop AND o.flight = x.flight
WHERE o.pitch > -80 AND (x.pitch <= -80 OR x.event_id > o.event_id)""", "frames")
def oblique_pairs(spark, d):
    return flightlines.oblique_pairs(view(spark, d, "frames"), GROUP, "event_id")


@query(f"SELECT a, b, a * 2147483647 + b AS pair_id, (a * 2147483647 + b) % 2147483647 AS second FROM ({_PAIRS})", "frames")
def pair_ids(spark, d):
    p = pairs(spark, d).select(F.col("b_event_id").alias("b"), F.col("a_event_id").alias("a"))
    p = p.withColumn("pair_id", N.pair_id("b", "a"))
    return p.select("a", "b", "pair_id", (F.col("pair_id") % 2147483647).alias("second"))


@query(f"""SELECT crop, flight, min(deg) AS least, round(median(deg), 6) AS median, max(deg) AS most, count(*) FILTER (WHERE deg = 0) AS alone FROM (SELECT f.crop, f.flight, f.event_id, count(p.i) AS deg FROM frames f
LEFT JOIN (SELECT a AS i FROM ({_PAIRS}) UNION ALL SELECT b FROM ({_PAIRS})) p ON p.i = f.event_id WHERE f.pitch <= -80 GROUP BY 1, 2, 3) GROUP BY crop, flight""", "frames")
def degree_stats(spark, d):
    nodes = view(spark, d, "frames").filter("pitch <= -80")
    x = flightlines.degrees(nodes, pairs(spark, d), "event_id", GROUP, "a_event_id", "b_event_id")
    return x.select(*GROUP, "least", N.r6("median").alias("median"), "most", "alone")


@query(f"""SELECT CASE WHEN a % 4 = 0 THEN 'src2' ELSE 'src' END AS origin_a, CASE WHEN b % 4 = 0 THEN 'src2' ELSE 'src' END AS origin_b, count(*) AS n FROM ({_PAIRS}) GROUP BY 1, 2""", "frames")
def cross_folder_pairs(spark, d):
    o = lambda c: F.when(F.col(c) % 4 == 0, "src2").otherwise("src")
    return pairs(spark, d).groupBy(o("a_event_id").alias("origin_a"), o("b_event_id").alias("origin_b")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT CASE WHEN a % 9 = 1 OR b % 9 = 1 THEN 'oblique' WHEN abs(ea - eb) < 4e-1 * 4 THEN 'same row' ELSE 'cross row' END AS kind, count(*) AS n FROM ({_PAIRS}) GROUP BY 1", "frames")
def edge_class(spark, d):
    tilted = (F.col("a_event_id") % 9 == 1) | (F.col("b_event_id") % 9 == 1)
    kind = flightlines.edge_class(tilted, F.col("a_east") - F.col("b_east"), 4.0)
    return pairs(spark, d).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, name, coalesce(pitch > -80, false) AS oblique FROM frames", "frames")
def oblique_filter(spark, d):
    return view(spark, d, "frames").select("event_id", "name", P.is_oblique(F.col("pitch")).alias("oblique"))


@query("SELECT event_id, CASE WHEN event_id % 9 = 0 THEN -60e0 ELSE -90e0 END AS pitch, event_id % 9 = 0 AS oblique FROM events")
def xmp_pitch(spark, d):
    p = P.pitch("xmp")
    return xmp(spark, d).select("event_id", p.alias("pitch"), P.is_oblique(p).alias("oblique"))


@query("""SELECT crop, flight, bool_or(event_id % 6 <> 0) AS ok FROM (SELECT *, row_number() OVER (PARTITION BY crop, flight ORDER BY name) AS k FROM frames) WHERE k <= 5 GROUP BY crop, flight""", "frames")
def preflight_dewarp(spark, d):
    x = xmp(spark, d).withColumn("name", F.lpad(F.col("event_id").cast("string"), 9, "0"))
    return catalog.preflight_dewarp(x, GROUP)


@query("SELECT l_suppkey % 200 AS a, l_linenumber AS b, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 15")
def min_matches(spark, d):
    x = read(spark, d, "lineitem").selectExpr("l_suppkey % 200 AS a", "l_linenumber AS b")
    return catalog.min_matches(x, ["a", "b"])


_TURN = 0.5235987755982988  # 30 degrees


@query(f"""SELECT k, CAST(least(floor(y / 1000), 2) AS INT) AS tile_row, CAST(least(floor(x / 1000), 3) AS INT) AS tile_col, round(x - 1000 * least(floor(x / 1000), 3), 6) AS tx, round(y - 1000 * least(floor(y / 1000), 2), 6) AS ty,
round(2000 + (x - 2000) * cos({_TURN}) - (y - 1500) * sin({_TURN}), 6) AS rx, round(1500 + (x - 2000) * sin({_TURN}) + (y - 1500) * cos({_TURN}), 6) AS ry, round(x, 6) AS bx, round(y, 6) AS by
FROM (SELECT p_partkey AS k, (p_partkey * 37 % 4000) + 25e-2 AS x, (p_partkey * 53 % 3000) + 5e-1 AS y FROM part)""")
def keypoint_tiles(spark, d):
    """Feature tiles, and keypoints turned with the photo and mapped back."""
    x = read(spark, d, "part").selectExpr("p_partkey AS k", "(p_partkey * 37 % 4000) + 25e-2 AS x", "(p_partkey * 53 % 3000) + 5e-1 AS y")
    r, c, tx, ty = N.feature_tile("x", "y", 4000, 3000)
    rx, ry = N.rotated("x", "y", 30.0, 2000.0, 1500.0)
    x = x.select("k", r.alias("tile_row"), c.alias("tile_col"), N.r6(tx).alias("tx"), N.r6(ty).alias("ty"), rx.alias("rx"), ry.alias("ry"))
    bx, by = N.rotated("rx", "ry", -30.0, 2000.0, 1500.0)
    return x.select("k", "tile_row", "tile_col", "tx", "ty", N.r6("rx").alias("rx"), N.r6("ry").alias("ry"), N.r6(bx).alias("bx"), N.r6(by).alias("by"))


@query(f"""SELECT p.crop, p.flight, p.a, p.b, a.north AS a_north, a.east AS a_east, b.north AS b_north, b.east AS b_east, round(sqrt((a.north - b.north) ** 2 + (a.east - b.east) ** 2), 6) AS length
FROM ({_PAIRS}) p JOIN frames a ON a.event_id = p.a JOIN frames b ON b.event_id = p.b""", "frames")
def match_graph(spark, d):
    """Edges of the match graph with both ends' places, as a figure draws them."""
    p = pairs(spark, d)
    length = F.sqrt((F.col("a_north") - F.col("b_north")) ** 2 + (F.col("a_east") - F.col("b_east")) ** 2)
    return p.select(F.col("a_crop").alias("crop"), F.col("a_flight").alias("flight"), F.col("a_event_id").alias("a"), F.col("b_event_id").alias("b"), "a_north", "a_east", "b_north", "b_east", N.r6(length).alias("length"))


@query("""SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN 'SIMPLE_RADIAL' WHEN 1 THEN 'PINHOLE' ELSE 'OPENCV' END AS model,
CASE s_suppkey % 3 WHEN 0 THEN '3700.5,2010.0,1490.0,0.1' WHEN 1 THEN '3700.5,3700.5,2010.0,1490.0' ELSE '3700.5,3700.5,2010.0,1490.0,0.1,0.0,0.0,0.0' END AS params FROM supplier""")
def camera_params(spark, d):
    k = F.col("k") % 3
    told = {n: catalog.camera_params(n, 4000, 3000, 3700.5, cx=10.0, cy=-10.0, k=(0.1,)) for n in ("SIMPLE_RADIAL", "PINHOLE", "OPENCV")}
    pick = lambda f: F.when(k == 0, f("SIMPLE_RADIAL")).when(k == 1, f("PINHOLE")).when(k == 2, f("OPENCV")).otherwise(F.raise_error(F.lit("unknown camera model")))
    return view(spark, d, "poses").select("k", pick(F.lit).alias("model"), pick(lambda n: F.lit(",".join(map(str, told[n][1])))).alias("params"))


@query("SELECT image_id, round((1e-2 * (1 + image_id % 5)) ** 2, 9) AS xx, 0e0 AS xy, round(3e-2 ** 2, 9) AS zz FROM priors", "priors")
def prior_cov(spark, d):
    sxy, sz, z = 0.01 * (1 + F.col("image_id") % 5), F.lit(0.03), F.lit(0.0)
    cov = F.array(sxy * sxy, z, z, z, sxy * sxy, z, z, z, sz * sz)
    x = view(spark, d, "priors").select("image_id", cov.alias("c"))
    return x.select("image_id", F.round(F.col("c")[0], 9).alias("xx"), F.col("c")[1].alias("xy"), F.round(F.col("c")[8], 9).alias("zz"))


_DOT = "list_reduce(list_transform(range(1, 65), lambda i: CAST(a.e[i] AS DOUBLE) * b.e[i]), lambda x, y: x + y)"


@query(f"""WITH v AS (SELECT vec_id, label, embedding AS e, sqrt(list_reduce(list_transform(range(1, 65), lambda i: CAST(embedding[i] AS DOUBLE) * embedding[i]), lambda x, y: x + y)) AS n FROM embeddings),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, round({_DOT} / (a.n * b.n), 6) AS cos FROM v a JOIN v b ON a.label = b.label AND a.vec_id % 2 = 0 AND b.vec_id % 2 = 1),
x AS (SELECT a, b, cos, row_number() OVER (PARTITION BY a ORDER BY cos DESC, b) AS ra, row_number() OVER (PARTITION BY b ORDER BY cos DESC, a) AS rb FROM s) SELECT a, b, cos FROM x WHERE ra = 1 AND rb = 1""")
def descriptor_matches(spark, d):
    """Mutual nearest neighbours by cosine within a label: the baseline for an external matcher."""
    x = read(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda e: e.cast("double")).alias("e"))
    return catalog.mutual_nearest(x.filter("vec_id % 2 = 0"), x.filter("vec_id % 2 = 1"), "label").select("a", "b", F.round("cos", 6).alias("cos"))
