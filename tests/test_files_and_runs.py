"""Sinks, strict readers, options, gates, streams with late rows."""

import io
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotweave.functions import photo
from plotweave.operators import catalog, clouds, fits, raster
from plotweave.session import Options
from plotweave.sources import files as S
from plotweave.sources import sinks
from plotweave.streaming import flights as T


def test_sinks_round_trip(spark, tmp_path):
    px = spark.createDataFrame([(r, c, float(10 * r + c), r, c, 7) for r in range(5) for c in range(6) if (r, c) != (1, 1)], "row int, col int, z double, r int, g int, b int")
    out = str(tmp_path / "tif")
    assert sinks.save_files(sinks.rasters(px, ["z"], 100.0, 200.0, 0.5, tile=4), out) == 4
    got = {(r.x, r.y): r.bands[0] for r in S.read_geotiff(S.binary(spark, out, "*.tif")).collect()}
    assert got[100.25, 199.75] == 0.0 and got[102.75, 197.75] == 45.0 and got[100.75, 199.25] is None
    sinks.save_files(sinks.rasters(px, ["r", "g", "b"], 0.0, 0.0, 1.0), str(tmp_path / "rgb"))
    rgb = {(r.row, r.col): r.bands for r in S.read_geotiff(S.binary(spark, str(tmp_path / "rgb"))).collect()}
    assert rgb[2, 3] == [2.0, 3.0, 7.0, 255.0] and rgb[1, 1] == [0.0] * 4
    pts = spark.createDataFrame([("f", float(k), k / 3, -1.0) for k in range(50)], "flight string, x double, y double, z double")
    for ascii in (False, True):
        where = str(tmp_path / f"ply{ascii}")
        sinks.save_files(sinks.clouds(pts, ("flight",), ascii, rows=20), where)
        r = S.read_ply(S.binary(spark, where)).selectExpr("count(*) AS n", "sum(x) AS x", "sum(y) AS y").first()
        assert r.n == 50 and r.x == 1225 and abs(r.y - 1225 / 3) < 0.05
    priors = spark.createDataFrame([("a", 1, 2.5, None), ("a", 2, None, "x"), ("b", 3, 1.0, "y")], "flight string, image_id long, z double, name string")
    sinks.save_files(sinks.databases(priors, "pose_priors", "flight"), str(tmp_path / "db"))
    back = S.read_sqlite(S.binary(spark, str(tmp_path / "db")), "SELECT image_id, z, name FROM pose_priors", "image_id long, z double, name string").drop("path")
    assert sorted(map(tuple, back.collect())) == [(1, 2.5, None), (2, None, "x"), (3, 1.0, "y")]
    poses = spark.createDataFrame([("p", [1.0] * 8)], "name string, params array<double>")
    sinks.write_ortho_inputs(poses, spark.createDataFrame([(1.0,)], "scale double"), pts, str(tmp_path / "ortho"))
    assert len(spark.read.parquet(str(tmp_path / "ortho/poses")).first().params) == 4 and spark.read.parquet(str(tmp_path / "ortho/cloud")).count() == 50
    for _ in range(2):
        sinks.append_rows(priors, str(tmp_path / "rows"))
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 6
    feats = spark.createDataFrame([("a", [[1.0, 2.0]], [[0.5, 0.25, 3.0]]), ("b", [], [])], "name string, keypoints array<array<float>>, descriptors array<array<float>>")
    sinks.write_features(feats, str(tmp_path / "feats"))
    assert sorted(map(tuple, sinks.read_features(spark, str(tmp_path / "feats")).collect())) == sorted(map(tuple, feats.collect()))


def packed_tiff(a, packing, predictor, pack):
    """One strip of bytes, as other tools write it."""
    h, w = a.shape
    body = np.diff(a, axis=1, prepend=np.zeros((h, 1), a.dtype)).astype(a.dtype) if predictor == 2 else a
    body = pack(body.tobytes())
    tags = [(256, w), (257, h), (258, 8), (259, packing), (273, 8), (277, 1), (278, h), (279, len(body)), (317, predictor), (339, 1)]
    return (b"II*\0" + struct.pack("<I", 8 + len(body)) + body + struct.pack("<H", len(tags))
            + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in tags) + b"\0" * 4)


def lzw_pack(data):
    """Literal codes with a reset before codes grow."""
    codes = [256]
    for k, b in enumerate(data):
        if k and k % 200 == 0:
            codes.append(256)
        codes.append(b)
    bits = "".join(f"{c:09b}" for c in [*codes, 257])
    return bytes(int(bits[k:k + 8].ljust(8, "0"), 2) for k in range(0, len(bits), 8))


def lzw_full(data):
    """The usual growing codes."""
    table, out, w, width = {bytes([k]): k for k in range(256)}, [(256, 9)], b"", 9
    n = 258
    for b in data:
        if w + bytes([b]) in table:
            w += bytes([b])
            continue
        out.append((table[w], width))
        table[w + bytes([b])] = n
        n += 1
        width = max(9, n.bit_length())
        w = bytes([b])
    out += [(table[w], width), (257, max(9, (n + 1).bit_length()))]
    bits = "".join(f"{c:0{k}b}" for c, k in out)
    return bytes(int(bits[k:k + 8].ljust(8, "0"), 2) for k in range(0, len(bits), 8))


def test_packed_rasters_and_unreadable_files(spark, tmp_path):
    a = (np.arange(35 * 41) * 7 % 251).astype("u1").reshape(35, 41)
    for name, packing, predictor, pack in (("z", 8, 2, zlib.compress), ("lzw", 5, 1, lzw_pack), ("grown", 5, 2, lzw_full), ("plain", 1, 1, bytes)):
        (tmp_path / f"{name}.tif").write_bytes(packed_tiff(a, packing, predictor, pack))
    rows = S.read_geotiff(S.binary(spark, str(tmp_path), "*.tif")).select(F.element_at(F.split("path", "/"), -1).alias("f"), "row", "col", F.get("bands", F.lit(0)).alias("v")).collect()
    for name in ("z", "lzw", "grown", "plain"):
        assert {(r.row, r.col): r.v for r in rows if r.f == f"{name}.tif"} == {(i, j): float(v) for (i, j), v in np.ndenumerate(a)}, name
    (tmp_path / "bad.tif").write_bytes(b"II*\0nonsense")
    (tmp_path / "odd.tif").write_bytes(packed_tiff(a, 7, 1, bytes))
    every = S.binary(spark, str(tmp_path), "*.tif")
    assert S.read_geotiff(every, strict=False).count() == 4 * a.size
    assert sorted(r.path.split("/")[-1] for r in S.failures(every, "geotiff").collect()) == ["bad.tif", "odd.tif"]
    with pytest.raises(Exception, match="bad.tif|odd.tif"):
        S.read_geotiff(every).count()


def test_long_header_and_late_exif(spark, tmp_path):
    from .test_sources import gps_block

    head = "ply\nformat ascii 1.0\n" + f"comment {'x' * 20_000}\n" + "element vertex 1\nproperty float x\nproperty float y\nproperty float z\nend_header\n1 2 3\n"
    (tmp_path / "a.ply").write_text(head)
    assert S.ply_counts(S.binary(spark, str(tmp_path), "*.ply")).first().points == 1
    block = gps_block()
    (tmp_path / "a.jpg").write_bytes(block[:2] + b"\xff\xe2" + b"p" * 300_000 + block[2:])
    assert S.read_gps(S.binary(spark, str(tmp_path), "*.jpg")).first().lat == pytest.approx(47.51)
    xmp = b'\xff\xe1\x80\xff<x:xmpmeta a="1" drone:GimbalPitchDegree="-45.5"></x:xmpmeta>\xfe' + b"\xd8" * 1000
    (tmp_path / "b.jpg").write_bytes(xmp)
    one = S.binary(spark, str(tmp_path), "b.jpg").select(photo.xmp_packet("content").alias("x"))
    assert one.select(photo.pitch("x").alias("p")).first().p == -45.5


def test_sparse_model(spark, tmp_path):
    (tmp_path / "cameras.bin").write_bytes(struct.pack("<Q", 2) + struct.pack("<IiQQ4d", 1, 1, 400, 300, 1, 2, 3, 4) + struct.pack("<IiQQ8d", 2, 4, 40, 30, *range(8)))
    (tmp_path / "points3D.bin").write_bytes(struct.pack("<Q", 1) + struct.pack("<Q3d3BdQ", 9, 1.0, 2.0, 3.0, 4, 5, 6, 0.5, 2) + struct.pack("<4I", 1, 2, 3, 4))
    got = [tuple(r)[1:] for r in S.read_model_cameras(S.binary(spark, str(tmp_path), "cameras.bin")).collect()]
    assert got == [(1, "PINHOLE", 400, 300, [1.0, 2.0, 3.0, 4.0]), (2, "OPENCV", 40, 30, [float(k) for k in range(8)])]
    assert tuple(S.read_model_points(S.binary(spark, str(tmp_path), "points3D.bin")).first())[1:] == (9, 1.0, 2.0, 3.0, 4, 5, 6, 0.5, 2)
    buf = io.BytesIO()
    np.savez(buf, names=np.array(["p", "q"]), K=np.ones((2, 4)), R=np.stack([np.eye(3)] * 2), t=np.zeros((2, 3)), pts=np.arange(6.0).reshape(2, 3))
    (tmp_path / "ortho.npz").write_bytes(buf.getvalue())
    poses, points = S.read_ortho_inputs(S.binary(spark, str(tmp_path), "*.npz"))
    assert [r.name for r in poses.orderBy("name").collect()] == ["p", "q"] and points.count() == 2
    buf = io.BytesIO()
    np.savez(buf, a=np.arange(3), b=np.arange(3) / 2)
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat/c.npz").write_bytes(buf.getvalue())
    assert sorted((r.a, r.b) for r in S.read_npz(S.binary(spark, str(tmp_path / "flat")), ["a", "b"]).collect()) == [(0.0, 0.0), (1.0, 0.5), (2.0, 1.0)]


def test_options():
    o, changed = Options().set(min_matches=20, do_dense=True)
    assert o.min_matches == 20 and changed == {"min_matches": (15, 20)}
    with pytest.raises(KeyError):
        Options().set(nonsense=1)
    for bad, error in ((dict(min_matches=0), ValueError), (dict(do_dense=1), TypeError), (dict(iqr_factor="x"), TypeError)):
        with pytest.raises(error):
            Options(**bad)


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(4)
    for values in (rng.normal(size=3000), np.round(rng.normal(size=3000), 1), np.full(50, 3.0), np.array([1.0]), np.concatenate([np.zeros(2000), [1e9]])):
        df = spark.createDataFrame([(float(v), float(-v)) for v in values] + [(None, 0.0)], "a double, b double")
        got = clouds.quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.9, 1.0], bins=16, most=40)
        assert np.allclose(got["a"], np.percentile(values, [0, 25, 50, 90, 100]))
        assert np.allclose(got["b"], np.percentile(np.append(-values, 0.0), [0, 25, 50, 90, 100]))
    assert clouds.quantiles(df.limit(0), ["a"], [0.5]) == {"a": [None]}


def test_medians_of_groups_are_exact(spark):
    rng = np.random.default_rng(6)
    groups = {"a": rng.normal(size=1001), "b": np.append(rng.normal(size=500), 1e7), "c": np.full(7, 2.0), "d": np.array([1.0, 4.0]), "e": np.round(rng.normal(size=900), 1)}
    df = spark.createDataFrame([(g, float(v)) for g, vv in groups.items() for v in vv] + [("a", None), ("f", None)], "g string, v double")
    got = {r.g: r for r in fits.median_mad(df, "v", ("g",)).collect()}
    assert set(got) == set(groups)
    for g, vv in groups.items():
        assert got[g].n == len(vv) and np.isclose(got[g].offset, np.median(vv)) and np.isclose(got[g].mad, np.median(abs(vv - np.median(vv))))
    one = fits.median_mad(df, "v").first()
    every = np.concatenate(list(groups.values()))
    assert np.isclose(one.offset, np.median(every)) and np.isclose(one.mad, np.median(abs(every - np.median(every))))


def test_envelope_against_brute_force():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 40):
        for _ in range(60):
            rows = np.arange(100, 100 + n)
            dx = np.where(rng.random(n) < 0.4, np.nan, rng.integers(0, 12, n).astype(float))
            if np.isnan(dx).all():
                continue
            cost = (rows[:, None] - rows[None, :]) ** 2 + np.where(np.isnan(dx), np.inf, dx)[None, :] ** 2
            assert raster.envelope(rows, dx).tolist() == cost.argmin(axis=1).tolist()


def test_a_clipped_point_stays_out(spark):
    rng = np.random.default_rng(8)
    x, y = rng.uniform(0, 40, 300), rng.uniform(0, 30, 300)
    z = 430 + 0.01 * x + rng.normal(0, 0.01, 300)
    z[:6] += np.array([9, 3, 1, 0.3, 0.1, 0.06])
    u, v = (x - x.mean()) / (np.ptp(x) / 2), (y - y.mean()) / (np.ptp(x) / 2)
    a, keep = np.stack([u ** i * v ** j for i in range(3) for j in range(3 - i)], 1), np.ones(300, bool)
    for _ in range(3):
        coef = np.linalg.lstsq(a[keep], z[keep], rcond=None)[0]
        resid = z - a @ coef
        keep = keep & (abs(resid) < 3 * resid[keep].std())
    t = fits.trend_surface(spark.createDataFrame(np.stack((x, y, z), 1).tolist(), ["x", "y", "z"]))
    assert t["kept"] == keep.sum() < 300 and np.allclose(t["coef"], coef, atol=1e-6)


def test_first_source_and_priors(spark):
    some = spark.range(3)
    opened = []
    name, df = catalog.first_source([("bundle", lambda: None), ("workspace", lambda: some.limit(0)), ("dense", lambda: some), ("sparse", lambda: opened.append(1))])
    assert name == "dense" and df.count() == 3 and not opened
    assert catalog.first_source([("bundle", lambda: None)]) == ("none", None)
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    priors = spark.createDataFrame([("a", 1.0)], "name string, z double")
    assert catalog.model_priors(names, priors)[1] == "few"
    with pytest.raises(ValueError):
        catalog.model_priors(names, priors.limit(0))


def test_components_that_do_not_settle_are_an_error(spark):
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    snake = [(r, c) for r in range(0, 21) for c in range(12) if r % 2 == 0 or c == (11 if r % 4 == 1 else 0)]
    mask = spark.createDataFrame(snake, "row int, col int")
    assert raster.blobs(mask).select("blob").distinct().count() == 1
    with pytest.raises(RuntimeError):
        raster.blobs(mask, max_rounds=1)


def test_late_rows_go_and_sessions_close(spark, tmp_path):
    src, n = str(tmp_path / "in"), 0

    def put(*times):
        nonlocal n
        n += 1
        spark.createDataFrame([("k", t) for t in times], "kind string, t string").select("kind", F.to_timestamp("t").alias("ts")).coalesce(1).write.parquet(f"{src}/{n}")

    def drain(make, name):
        q = (make(spark.readStream.schema("kind string, ts timestamp").parquet(f"{src}/*")).writeStream.outputMode("append").format("parquet")
             .option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-cp")).trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.read.parquet(str(tmp_path / name))

    windows = lambda df: T.windowed_counts(df, "ts", ["kind"], "10 minutes", late="5 minutes").select("kind", F.col("window.start").alias("start"), "n")
    runs = lambda df: T.sessions(df, "ts", ["kind"], "10 minutes", late="5 minutes").select("kind", F.col("session_window.start").alias("start"), "n")
    put("2024-01-01 10:01:00", "2024-01-01 10:05:00")
    drain(windows, "w"), drain(runs, "s")
    put("2024-01-01 11:00:00")
    drain(windows, "w"), drain(runs, "s")
    put("2024-01-01 10:02:00", "2024-01-01 12:00:00")  # the first is later than the watermark: it goes
    w, s = drain(windows, "w"), drain(runs, "s")
    assert sorted((str(r.start)[11:16], r.n) for r in w.collect()) == [("10:00", 2), ("11:00", 1)]
    assert sorted((str(r.start)[11:16], r.n) for r in s.collect()) == [("10:01", 2), ("11:00", 1)]


def test_a_status_is_replaced_by_key(spark, tmp_path):
    p = str(tmp_path / "status")
    assert T.current(spark, p) is None
    T.replace_by_key(spark.createDataFrame([("a", "failed"), ("b", "ok")], "k string, s string"), ["k"], p, 0)
    for _ in range(2):  # a batch that runs again
        T.replace_by_key(spark.createDataFrame([("a", "ok"), ("c", "ok")], "k string, s string"), ["k"], p, 1)
    assert sorted(map(tuple, T.current(spark, p).collect())) == [("a", "ok"), ("b", "ok"), ("c", "ok")]


def test_flights_out_of_order_end_as_the_ordered_table(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [[("f", "2024-03", 100, 3.0), ("f", "2024-05", 1, 5.0), ("g", "2024-01", 100, 9.0)], [("f", "2024-04", 100, 4.0)], [("f", "2024-01", 1, 1.0), ("f", "2024-02", 100, 2.0)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "field string, flight string, n long, offset double").coalesce(1).write.parquet(f"{src}/{k}")
        T.to_table(T.carry_forward(spark.readStream.schema("field string, flight string, n long, offset double").parquet(f"{src}/*"), 60), ["field", "flight"], out, str(tmp_path / "cp"))
        if k == 0:
            assert {(r.flight, r.off) for r in T.current(spark, out).filter("field = 'f'").collect()} == {("2024-03", 3.0), ("2024-05", 3.0)}
    got = {(r.field, r.flight): r.off for r in T.current(spark, out).collect()}
    assert got == {("f", "2024-01"): None, ("f", "2024-02"): 2.0, ("f", "2024-03"): 3.0, ("f", "2024-04"): 4.0, ("f", "2024-05"): 4.0, ("g", "2024-01"): 9.0}
