"""Operators on small fixtures against numpy twins and hand-computed answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotweave.functions import numeric as N
from plotweave.functions import photo as P
from plotweave.operators import catalog, compose, fits, flightlines, joins, raster, zonal


def grid_of(spark, a: np.ndarray):
    rows = [(i, j, None if np.isnan(v) else float(v)) for (i, j), v in np.ndenumerate(a)]
    return spark.createDataFrame(rows, "row int, col int, z double")


def back(df, shape, value):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["row"], r["col"]] = np.nan if r[value] is None else r[value]
    return out


def holes(seed, shape=(14, 17), share=0.15):
    rng = np.random.default_rng(seed)
    a = rng.normal(0, 1, shape)
    a[rng.random(shape) < share] = np.nan
    a[0, 0] = a[-1, -1] = 0.5
    return a


def test_opening_is_idempotent_and_below(spark):
    a = holes(1)
    for size in (3, 4):
        one = back(raster.grey_opening(grid_of(spark, a).filter("z IS NOT NULL"), "z", size), a.shape, "dtm")
        full = np.where(np.isnan(a), np.nanmin(a), a)
        assert (one <= full + 1e-12).all()
        two = back(raster.grey_opening(grid_of(spark, one), "z", size), a.shape, "dtm")
        assert np.array_equal(one, two)
        b, f = size // 2, (size - 1) // 2
        er = np.array([[full[max(0, i - b):i + f + 1, max(0, j - b):j + f + 1].min() for j in range(a.shape[1])] for i in range(a.shape[0])])
        di = np.array([[er[max(0, i - f):i + b + 1, max(0, j - f):j + b + 1].max() for j in range(a.shape[1])] for i in range(a.shape[0])])
        assert np.array_equal(one, di)


def test_local_std_skips_holes(spark):
    a = holes(2)
    got = back(raster.local_std(grid_of(spark, a).filter("z IS NOT NULL"), "z"), a.shape, "local_std")
    for i, j in np.argwhere(~np.isnan(a)):
        w = a[max(0, i - 2):i + 3, max(0, j - 2):j + 3]
        w = w[~np.isnan(w)]
        assert got[i, j] == pytest.approx(w.std(), abs=1e-9) if len(w) >= 3 else np.isnan(got[i, j])


def test_nearest_fill_and_blobs(spark):
    a = holes(3, share=0.6)
    got = back(raster.nearest_fill(grid_of(spark, a).filter("z IS NOT NULL"), "z"), a.shape, "z")
    have = np.argwhere(~np.isnan(a))
    for i, j in np.ndindex(a.shape):
        d = ((have - (i, j)) ** 2).sum(axis=1)
        assert got[i, j] == a[tuple(have[np.lexsort((have[:, 1], have[:, 0], d))[0]])]
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    mask = ["##..#", "#...#", "#.#.#", "###.#", "....."]
    cells = [(i, j) for i, r in enumerate(mask) for j, c in enumerate(r) if c == "#"]
    sizes = sorted(r["size"] for r in raster.blobs(spark.createDataFrame(cells, "row int, col int")).select("blob", "size").distinct().collect())
    assert sizes == [4, 8]


def test_otsu_splits_two_humps(spark):
    v = np.concatenate((np.random.default_rng(0).normal(0, 0.1, 500), np.random.default_rng(1).normal(3, 0.1, 300)))
    t = raster.otsu(spark.createDataFrame([(float(x),) for x in v], "z double"), "z").first()["threshold"]
    assert 300 <= (v > t).sum() <= 303  # the left edge of its bin
    assert raster.otsu(spark.createDataFrame([(1.0,)], "z double"), "z").first()["threshold"] is None


def test_bilinear_and_null_neighbours(spark):
    a = np.arange(20.0).reshape(4, 5)
    a[2, 2] = np.nan
    t = spark.createDataFrame([(0, 0.5, 0.5), (1, 1.0, 3.0), (2, 1.5, 2.0), (3, 9.0, 9.0)], "k int, frow double, fcol double")
    got = {r.k: r.z for r in joins.resample_bilinear(grid_of(spark, a).filter("z IS NOT NULL"), t).collect()}
    assert got == {0: 3.0, 1: 8.0, 2: None, 3: None}


def test_band_join_equals_the_theta_join(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(k, float(x), float(y), int(g)) for k, (x, y, g) in enumerate(zip(rng.normal(0, 20, 300), rng.normal(0, 20, 300), rng.integers(0, 2, 300)))],
                               "id int, x double, y double, g int")
    pick = lambda p: sorted((r.a_id, r.b_id) for r in p.select("a_id", "b_id").collect())
    dims = [("x", 4.0), ("y", 7.0)]
    a, b = pick(joins.band_pairs(df, "id", dims, ("g",))), pick(joins.band_pairs_theta(df, "id", dims, ("g",)))
    assert a == b and len(a) == len(set(a)) > 50


def test_quads_share_no_point(spark):
    corners = [(0.0, 10.0), (10.0, 11.0), (11.0, 1.0), (1.0, 0.0)]
    quads = zonal.plot_grid(spark, corners, 3, 4)
    rng = np.random.default_rng(1)
    pts = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(-1, 12, (500, 2)))], "k int, x double, y double")
    got = joins.points_in_quads(pts, quads.select("plot_id", "quad"), 2.0)
    assert got.count() == got.select("k").distinct().count() > 200
    centre = joins.points_in_quads(spark.createDataFrame([(0, 5.5, 5.5)], "k int, x double, y double"), zonal.plot_grid(spark, corners, 1, 1), 1.0)
    assert centre.count() == 1


def test_grid_margins_and_errors(spark):
    unit = [(0, 1), (1, 1), (1, 0), (0, 0)]
    width = lambda compat: (lambda q: (round(q[0].x, 6), round(q[1].x, 6)))(zonal.plot_grid(spark, unit, 1, 1, col_margin=0.2, compat=compat).first().quad)
    assert width(False) == (0.2, 0.8) and width(True) == (0.2, 0.84)
    with pytest.raises(ValueError):
        zonal.plot_grid(spark, unit[:3], 1, 1)
    with pytest.raises(ValueError):
        zonal.assign_ids(zonal.plot_grid(spark, unit, 1, 2), spark.createDataFrame([(1,)], "plot_id long"))
    with pytest.raises(ValueError):
        zonal.with_lines(spark.createDataFrame([(1,)], "plot_id long"), spark.createDataFrame([(1,)], "x long"))


def test_umeyama_and_trend_recover_what_made_the_data(spark):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    rot = q * np.sign(np.linalg.det(q))
    src = rng.normal(size=(40, 3))
    dst = 2.5 * src @ rot.T + [1, 2, 3]
    fit = fits.umeyama(spark.createDataFrame(np.hstack((src, dst)).tolist(), ["sx", "sy", "sz", "dx", "dy", "dz"]))
    assert fit["scale"] == pytest.approx(2.5) and np.allclose(fit["rotation"], rot) and np.allclose(fit["shift"], [1, 2, 3])
    with pytest.raises(ValueError):
        fits.umeyama(spark.createDataFrame([], "sx double, sy double, sz double, dx double, dy double, dz double"))
    x, y = 541000 + rng.uniform(0, 40, 400), 5215000 - rng.uniform(0, 30, 400)
    u, v = x - 541020, y - 5214985
    z = 430 + 0.01 * u - 0.02 * v + 0.001 * u * v + 0.0005 * u * u
    z[:8] += 50
    t = fits.trend_surface(spark.createDataFrame(np.stack((x, y, z), 1).tolist(), ["x", "y", "z"]))
    pred = spark.createDataFrame(np.stack((x, y, z), 1)[8:].tolist(), ["x", "y", "z"]).select(F.max(F.abs(fits.surface_value(t) - F.col("z")))).first()[0]
    assert pred < 1e-3 and 380 <= t["kept"] <= 392


def test_doming(spark):
    r = np.linspace(0, 40, 60)
    df = spark.createDataFrame([(float(a), float(0.001 * a * a + 0.2)) for a in r], "r double, dz double")
    got = fits.doming(df).first()
    assert got.bowl == pytest.approx(1.6) and got.r2 == pytest.approx(1)
    few = fits.doming(df.limit(5)).first()
    assert few.bowl is None and few.r2 is None
    verdicts = spark.createDataFrame([(0.03 - 1e-9,), (0.03,), (0.08,)], "mad double").select(fits.datum_verdict().alias("v")).collect()
    assert [x.v for x in verdicts] == ["ok", "SUSPECT", "NOT ALIGNED"]


def test_utm_known_values(spark):
    e, n = N.utm("lat", "lon", 32)
    got = spark.createDataFrame([(0.0, 12.0), (47.0, 9.0)], "lat double, lon double").select(e.alias("e"), n.alias("n")).collect()
    assert got[0].e == pytest.approx(833978.5569, abs=1e-3) and got[0].n == pytest.approx(0, abs=1e-6) and got[1].e == pytest.approx(500000, abs=1e-6)


def test_xmp_forms(spark):
    xs = ['<x drone:GpsLatitude="+47.25" GpsLongtitude="-8.5"/>', "<drone:GpsLatitude>47.5</drone:GpsLatitude>", 'GpsLatitude="junk" Latitude="1e1"', 'RtkStdHgt="0.02"', "", None]
    df = spark.createDataFrame([(x,) for x in xs], "xmp string").select(P.gps("xmp").alias("g")).collect()
    assert [r.g.lat for r in df] == [47.25, 47.5, 10.0, None, None, None] and df[0].g.lon == -8.5 and df[3].g.alt == 0.0
    eight, nine = ",".join("12345678"), ",".join("123456789")
    w = spark.createDataFrame([(f'DewarpData="d;{eight}"',), (f'DewarpData="d;{nine}"',)], "xmp string").select(P.xmp_dewarp("xmp").alias("w")).collect()
    assert w[0].w is None and w[1].w.k3 == 9
    t = spark.createDataFrame([("DJI_20240102030405_x",), ("DJI_202401020304",), ("DJI_none",)], "n string").select(P.flight_time("n").alias("t")).collect()
    assert [str(x.t) for x in t] == ["2024-01-02 03:04:05", "2024-01-02 03:04:00", "None"]


def test_top_views_ties_and_fallback(spark):
    v = spark.createDataFrame([(0, 0, 2, 0.5, True, 10.0), (0, 0, 1, 0.5, True, 20.0), (0, 0, 3, 0.9, False, 99.0), (0, 1, 4, 0.3, False, 7.0), (0, 2, 5, 0.0, True, 1.0)],
                              "row int, col int, k int, w double, gated boolean, c double")
    got = {(r.row, r.col): (r.colour, r.is_fallback) for r in compose.composite(v, ["row", "col"]).collect()}
    assert got == {(0, 0): (15.0, False), (0, 1): (7.0, True)}


def test_catalog_rules(spark):
    p = spark.createDataFrame([("/r/Bean/DJI_1",), ("/r/Bean/./DJI_1",), ("/r/_x/DJI_2",), ("/r/.h/DJI_3",), ("/r/Bean/other",), ("/DJI_9",)], "path string")
    assert sorted(r.flight for r in catalog.flights_of(p).collect()) == ["DJI_1", "DJI_9"]
    with pytest.raises(ValueError):
        catalog.camera_params("FISHEYE", 10, 10, 1.0)
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert catalog.pick_column(df, ["zz", "a", "b"]) == "b" and catalog.pick_column(df, ["a"]) is None


def test_oblique_pairs_are_those_of_sql_and_never_shuffled(spark, tmp_path):
    import duckdb

    from plotweave import registry

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(60).withColumn("event_type", F.lit("c")).withColumn("ts", F.lit("2024-05-01").cast("timestamp_ntz"))
    events = events.unionByName(events.limit(20)).unionByName(events.limit(3).withColumn("event_id", F.lit(None).cast("long")))  # repeated rows, null keys
    events.write.parquet(f"{tmp_path}/events.parquet")
    out = registry.queries()["oblique_pairs"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    got, want = [tuple(r) for r in out.collect()], con.execute(registry.oracle_sql()["oblique_pairs"]).fetchall()
    assert len(set(want)) < len(want)
    assert sorted(got) == sorted(want)
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()  # pairs are not sent anywhere


def test_oblique_pairs_are_dealt_by_blocks_and_compress_in_files(spark, tmp_path):
    import os

    n = 9000  # one flight, of several blocks
    photos = spark.range(n).select(F.lit("c").alias("crop"), (F.col("id") * 7 % n).alias("k"), F.when(F.col("id") % 3 == 0, -60.0).otherwise(-90.0).alias("pitch"))
    flightlines.oblique_pairs(photos, ["crop"], "k").write.parquet(f"{tmp_path}/pairs")
    got, o = spark.read.parquet(f"{tmp_path}/pairs"), n // 3
    r = got.agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"), F.bool_and(F.col("a") < F.col("b")).alias("ordered")).first()
    tilted = np.zeros(n, bool)
    tilted[np.arange(n)[::3] * 7 % n] = True
    before, at = np.concatenate([[0], np.cumsum(tilted)[:-1]]), np.arange(n)
    low = np.where(tilted, n - 1 - at, o - before - tilted)  # pairs in which the photo is the lesser one
    high = np.where(tilted, at, before)
    assert (r.n, r.a, r.b, r.ordered) == (o * (n - o) + o * (o - 1) // 2, int((low * at).sum()), int((high * at).sum()), True)
    sizes = [os.path.getsize(f"{tmp_path}/pairs/{f}") for f in os.listdir(f"{tmp_path}/pairs") if f.endswith(".parquet")]
    assert sum(sizes) < 0.5 * r.n  # bytes a pair
    assert sum(s > 1000 for s in sizes) > 1  # a flight's pairs are made by several tasks


def test_oblique_pairs_of_names_and_photos_without_pitch(spark):
    rows = [("c", 1, f"p{i:02d}", [-60.0, -90.0, None, -80.0][i % 4]) for i in range(30)] + [("c", 2, "p00", -60.0), ("c", 2, "p01", None), (None, 2, "p03", -60.0), (None, 2, "p02", -90.0), ("c", 2, None, -90.0), ("c", 2, None, -60.0)]
    df = spark.createDataFrame(rows, "crop string, flight int, name string, pitch double")
    want = []
    for c, f, o, p in rows:
        for d, g, x, q in rows:
            if c and (c, f) == (d, g) and p is not None and p > -80 and ((q is not None and q <= -80) or (o and x and x > o)):
                known = [v for v in (o, x) if v]
                want.append((min(known, default=None), max(known, default=None)))
    got = [tuple(r) for r in flightlines.oblique_pairs(df, ["crop", "flight"], "name").collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 100
