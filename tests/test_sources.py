"""Readers and writers round trip on small files."""

import io
import sqlite3
import struct
import zipfile

import numpy as np
import pytest

from plotweave.sources import files as S
from plotweave.sources import sinks


def test_ply(spark, tmp_path):
    xyz = np.random.default_rng(0).normal(size=(1000, 3)).astype("f4")
    (tmp_path / "a.ply").write_bytes(S.ply_bytes(xyz))
    (tmp_path / "b.ply").write_text("ply\nformat ascii 1.0\nelement vertex 2\nproperty float x\nproperty float y\nproperty float z\nend_header\n1 2 3\n4 5 6\n")
    (tmp_path / "c.ply").write_text("nonsense")
    f = S.binary(spark, str(tmp_path), "*.ply")
    assert sorted(r.points for r in S.ply_counts(f).collect()) == [0, 2, 1000]
    got = S.read_ply(f, strict=False)
    assert got.count() == 1002
    assert got.filter("path LIKE '%a.ply'").selectExpr("sum(x)").first()[0] == pytest.approx(float(xyz[:, 0].astype("f8").sum()))


def test_rasters_and_depth(spark, tmp_path):
    a = np.arange(12, dtype="f4").reshape(3, 4)
    a[1, 1] = np.nan
    (tmp_path / "a.tif").write_bytes(S.geotiff_bytes(a, 541000.0, 5215000.0, 0.5))
    got = {(r.row, r.col): (r.x, r.y, r.bands[0]) for r in S.read_geotiff(S.binary(spark, str(tmp_path), "*.tif")).collect()}
    assert len(got) == 12 and got[1, 1][2] is None and got[2, 3] == (541001.75, 5214998.75, 11.0)
    (tmp_path / "v.bin").write_bytes(b"4&3&1&" + np.nan_to_num(a).astype("<f4").reshape(3, 4, 1).transpose(1, 0, 2).tobytes(order="F"))
    d = {(r.row, r.col): r.d for r in S.read_depth_maps(S.binary(spark, str(tmp_path), "*.bin")).collect()}
    assert d == {(i, j): float(v) for (i, j), v in np.ndenumerate(np.nan_to_num(a)) if v > 0}
    buf = io.BytesIO()
    np.savez(buf, names=np.array(["p", "q"]), d0000=np.eye(2, dtype="f2"), d0001=np.zeros((2, 2), "f2"))
    (tmp_path / "b.npz").write_bytes(buf.getvalue())
    bundle = S.read_depth_bundle(S.binary(spark, str(tmp_path), "*.npz"))
    assert sorted((r["view"], r["row"], r["col"], r["d"]) for r in bundle.collect()) == [("p", 0, 0, 1.0), ("p", 1, 1, 1.0)]
    sinks.write_depth(bundle, str(tmp_path / "depth"))
    assert spark.read.parquet(str(tmp_path / "depth")).count() == 1
    sinks.write_tiles(S.read_geotiff(S.binary(spark, str(tmp_path), "*.tif")).select("row", "col"), str(tmp_path / "tiles"), 2)
    assert spark.read.parquet(str(tmp_path / "tiles")).filter("tile_row = 1").count() == 4


def gps_block():
    def entry(tag, kind, n, value):
        return struct.pack("<HHI", tag, kind, n) + value

    ifd0 = 8
    gps = ifd0 + 2 + 12 + 4
    far = gps + 2 + 12 * 5 + 4
    lat, lon, alt = struct.pack("<6I", 47, 1, 30, 1, 36, 1), struct.pack("<6I", 8, 1, 15, 1, 0, 1), struct.pack("<2I", 4301, 10)
    body = b"II*\0" + struct.pack("<I", ifd0) + struct.pack("<H", 1) + entry(34853, 4, 1, struct.pack("<I", gps)) + b"\0" * 4
    body += struct.pack("<H", 5) + entry(1, 2, 2, b"N\0\0\0") + entry(2, 5, 3, struct.pack("<I", far)) + entry(3, 2, 2, b"W\0\0\0")
    body += entry(4, 5, 3, struct.pack("<I", far + 24)) + entry(6, 5, 1, struct.pack("<I", far + 48)) + b"\0" * 4 + lat + lon + alt
    return b"\xff\xd8\xff\xe1\0\0Exif\0\0" + body


def test_photos(spark, tmp_path):
    for k in range(5):
        (tmp_path / f"p{k}.{'JPG' if k % 2 else 'jpeg'}").write_bytes(gps_block() if k else b"no exif")
    got = [r.lat for r in S.read_gps(S.binary(spark, str(tmp_path))).orderBy("path").collect()]
    assert got[0] is None and got[1] == pytest.approx(47.51)
    assert S.exif_gps(gps_block()) == pytest.approx((47.51, -8.25, 430.1))
    assert [r.name for r in S.images(spark, str(tmp_path)).collect()][0] == "p0.jpeg"
    with pytest.raises(ValueError):
        S.images(spark, str(tmp_path), 6)


def test_design_and_database(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "d.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t> plot_id </t></si><si><t>line_name</t></si><si><t>L1</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>'
                   '<row><c r="A2"><v>7</v></c><c r="B2" t="s"><v>2</v></c></row><row><c r="A3"><v>8.0</v></c></row></sheetData></worksheet>')
    assert [tuple(r) for r in S.load_design(spark, str(tmp_path / "d.xlsx")).collect()] == [(7, "L1"), (8, None)]
    (tmp_path / "d.csv").write_text(" plot_id , line_name\n1,a\n")
    assert S.load_design(spark, str(tmp_path / "d.csv")).first().plot_id == 1
    (tmp_path / "bad.csv").write_text("x\n1\n")
    with pytest.raises(ValueError):
        S.load_design(spark, str(tmp_path / "bad.csv"))
    con = sqlite3.connect(tmp_path / "m.db")
    con.execute("CREATE TABLE images (image_id INTEGER, name TEXT)")
    con.executemany("INSERT INTO images VALUES (?, ?)", [(1, "a"), (2, "b")])
    con.commit()
    con.close()
    got = S.read_sqlite(S.binary(spark, str(tmp_path), "*.db"), "SELECT image_id, name FROM images", "image_id long, name string")
    assert sorted((r.image_id, r.name) for r in got.collect()) == [(1, "a"), (2, "b")]
    raw = struct.pack("<Q", 1) + struct.pack("<I7dI", 5, 1, 0, 0, 0, 1.0, 2.0, 3.0, 9) + b"n.jpg\0" + struct.pack("<Q", 1) + b"\0" * 24
    (tmp_path / "images.bin").write_bytes(raw)
    r = S.read_model_images(S.binary(spark, str(tmp_path), "images.bin")).first()
    assert (r.image_id, r.name, r.camera_id, list(r.t)) == (5, "n.jpg", 9, [1.0, 2.0, 3.0])
    sinks.write_pairs(spark.createDataFrame([(1, 2)], "a int, b int"), str(tmp_path / "pairs"))
    assert spark.read.text(str(tmp_path / "pairs")).first()[0] == "1 2"
