"""File formats of survey folders, read where the files are: ``binaryFile`` rows in, typed rows out.

Each reader is a generator over the bytes of one file inside ``mapInPandas``, so files spread over executors and come by
Spark's own file systems. Unreadable files are errors (scans, unless ``strict=False``) or a NULL (headers), as each
docstring says.
"""

from __future__ import annotations

import io
import re
import sqlite3
import struct
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PLY = {"char": "i1", "uchar": "u1", "short": "i2", "ushort": "u2", "int": "i4", "uint": "u4", "float": "f4", "double": "f8",
        "int8": "i1", "uint8": "u1", "int16": "i2", "uint16": "u2", "int32": "i4", "uint32": "u4", "float32": "f4", "float64": "f8"}


def binary(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return (r.option("pathGlobFilter", glob) if glob else r).load(path)


_UNREADABLE = (ValueError, KeyError, IndexError, struct.error, zlib.error, zipfile.BadZipFile, EOFError, sqlite3.DatabaseError)


def _each(files: DataFrame, schema: str, parse: Callable[[bytes], Iterator[pd.DataFrame]], strict: bool = True) -> DataFrame:
    """Rows of every file with its ``path``. A file that can't be parsed is an error that names it; with ``strict=False`` it
    gives the rows before the fault, and ``failures`` lists it."""

    def run(frames):
        for pdf in frames:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    for out in parse(bytes(content)):
                        out.insert(0, "path", path)
                        yield out
                except _UNREADABLE as e:
                    if strict:
                        raise ValueError(f"{path}: {e!r}") from e

    return files.select("path", "content").mapInPandas(run, f"path string, {schema}")


def failures(files: DataFrame, kind: str) -> DataFrame:
    """``path, error`` of the files that a reader can't parse to the end; ``kind``: ply, depth_map, depth_bundle, geotiff,
    model_images, model_cameras or model_points."""
    parse = {"ply": _ply, "depth_map": lambda data: iter([_colmap_array(data)]), "depth_bundle": _bundle, "geotiff": _geotiff,
             "model_images": _model_images, "model_cameras": _model_cameras, "model_points": _model_points}[kind]

    def run(frames):
        for pdf in frames:
            told = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    for _ in parse(bytes(content)):
                        pass
                except _UNREADABLE as e:
                    told.append((path, repr(e)))
            yield pd.DataFrame(told, columns=["path", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, error string")


def images(spark: SparkSession, path: str, least: int = 5) -> DataFrame:
    """JPEG files by name, any case of the suffix; fewer than ``least`` are an error."""
    name = F.element_at(F.split("path", "/"), -1)
    out = binary(spark, path).select("path", "length", name.alias("name")).filter(F.lower("name").rlike(r"\.jpe?g$"))
    if out.limit(least).count() < least:
        raise ValueError(f"fewer than {least} photos in {path}")
    return out.orderBy("name")


def ply_header(data: bytes) -> tuple[int, str, list[tuple[str, str]], int]:
    """Vertex count, format, vertex properties, length of the header (64 lines at most)."""
    at, count, fmt, props, inside = 0, 0, "", [], False
    for _ in range(64):
        end = data.index(b"\n", at)
        word = data[at:end].decode("ascii", "replace").split()
        at = end + 1
        if word[:1] == ["format"]:
            fmt = word[1]
        elif word[:1] == ["element"]:
            inside = word[1] == "vertex"
            count = int(word[-1]) if inside else count
        elif word[:1] == ["property"] and inside:
            props.append((word[-1], _PLY[word[1]]))
        elif word == ["end_header"]:
            return count, fmt, props, at
    raise ValueError("no header")


def ply_count(data: bytes) -> int:
    try:
        return ply_header(data)[0]
    except (ValueError, KeyError, IndexError):
        return 0


def _ply(data: bytes, rows: int = 1 << 18) -> Iterator[pd.DataFrame]:
    count, fmt, props, at = ply_header(data)
    if fmt == "ascii":
        table = np.loadtxt(io.BytesIO(data[at:]), max_rows=count, ndmin=2)
        names = [p for p, _ in props]
        yield pd.DataFrame({c: table[:, names.index(c)] for c in "xyz"})
        return
    order = "<" if fmt == "binary_little_endian" else ">"
    v = np.frombuffer(data, np.dtype([(n, order + t) for n, t in props]), count, at)
    for a in range(0, count, rows):
        yield pd.DataFrame({c: v[c][a:a + rows].astype("f8") for c in "xyz"})


def read_ply(files: DataFrame, strict: bool = True) -> DataFrame:
    return _each(files, "x double, y double, z double", _ply, strict)


def ply_counts(files: DataFrame) -> DataFrame:
    """``path, points`` from the headers; 0 where there is none to read."""

    def run(frames):
        for pdf in frames:
            yield pd.DataFrame({"path": pdf["path"], "points": [ply_count(bytes(c)) for c in pdf["content"]]})

    # up to the end of the header, wherever that is in the first MiB: a header has 64 lines at most
    start = F.substring("content", 1, 1 << 20)
    end = F.instr(F.decode(start, "ISO-8859-1"), "end_header")
    head = files.select("path", F.when(end > 0, F.substr(start, F.lit(1), end + 11)).otherwise(F.lit(b"")).alias("content"))
    return head.mapInPandas(run, "path string, points long")


def ply_bytes(xyz: np.ndarray) -> bytes:
    head = f"ply\nformat binary_little_endian 1.0\nelement vertex {len(xyz)}\nproperty float x\nproperty float y\nproperty float z\nend_header\n"
    return head.encode() + np.ascontiguousarray(xyz, "<f4").tobytes()


def _colmap_array(data: bytes) -> np.ndarray:
    w, h, c, rest = data.split(b"&", 3)
    w, h, c = int(w), int(h), int(c)
    return np.frombuffer(rest, "<f4", w * h * c).reshape((w, h, c), order="F").transpose(1, 0, 2)


def _depth_rows(a: np.ndarray) -> pd.DataFrame:
    row, col = np.nonzero(a > 0)  # 0 is no depth
    return pd.DataFrame({"row": row.astype("i4"), "col": col.astype("i4"), "d": a[row, col].astype("f4")})


def read_depth_maps(files: DataFrame, strict: bool = True) -> DataFrame:
    """Depth maps with a ``w&h&c&`` header: one row a valid pixel."""
    return _each(files, "row int, col int, d float", lambda data: iter([_depth_rows(_colmap_array(data)[..., 0])]), strict)


def _bundle(data: bytes) -> Iterator[pd.DataFrame]:
    with np.load(io.BytesIO(data), allow_pickle=False) as z:
        for k, name in enumerate(z["names"].tolist()):
            out = _depth_rows(z[f"d{k:04d}"].astype("f4"))
            out.insert(0, "view", str(name))
            yield out


def read_depth_bundle(files: DataFrame, strict: bool = True) -> DataFrame:
    """NPZ bundles of ``names`` and one array a view, in order."""
    return _each(files, "view string, row int, col int, d float", _bundle, strict)


def read_ortho_inputs(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Poses (``path, name, params, rotation, t``: row-major 3 x 3) and cloud points (``path, x, y, z``) of NPZ files of
    ``names, K, R, t, pts``."""

    def poses(data: bytes):
        with np.load(io.BytesIO(data), allow_pickle=False) as z:
            n = len(z["names"])
            yield pd.DataFrame({"name": [str(x) for x in z["names"]], "params": list(z["K"].astype("f8").reshape(n, -1)),
                                "rotation": list(z["R"].astype("f8").reshape(n, 9)), "t": list(z["t"].astype("f8").reshape(n, 3))})

    def points(data: bytes):
        with np.load(io.BytesIO(data), allow_pickle=False) as z:
            yield pd.DataFrame(z["pts"].astype("f8"), columns=list("xyz"))

    return (_each(files, "name string, params array<double>, rotation array<double>, t array<double>", poses),
            _each(files, "x double, y double, z double", points))


def read_npz(files: DataFrame, arrays: list[str]) -> DataFrame:
    """Equally long one-dimensional arrays of NPZ files as double columns."""

    def parse(data: bytes):
        with np.load(io.BytesIO(data), allow_pickle=False) as z:
            yield pd.DataFrame({a: z[a].astype("f8") for a in arrays})

    return _each(files, ", ".join(f"{a} double" for a in arrays), parse)


_TAG_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 7: 1, 11: 4, 12: 8, 16: 8}
_TAG_CODE = {1: "B", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}


def tiff_tags(data: bytes, at: int | None = None, base: int = 0) -> dict[int, tuple]:
    """Tags of a classic TIFF directory."""
    order = {b"II": "<", b"MM": ">"}[data[base:base + 2]]
    at = struct.unpack_from(order + "I", data, base + 4)[0] if at is None else at
    out = {}
    for k in range(struct.unpack_from(order + "H", data, base + at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", data, base + at + 2 + 12 * k)
        size = _TAG_SIZE.get(kind, 1) * n
        place = base + at + 10 + 12 * k
        if size > 4:
            place = base + struct.unpack_from(order + "I", data, place)[0]
        if kind == 2:
            out[tag] = (data[place:place + n].rstrip(b"\0").decode("latin-1"),)
        elif kind == 5:
            raw = struct.unpack_from(f"{order}{2 * n}I", data, place)
            out[tag] = tuple(a / b if b else float("nan") for a, b in zip(raw[::2], raw[1::2], strict=True))
        elif kind in _TAG_CODE:
            out[tag] = struct.unpack_from(f"{order}{n}{_TAG_CODE[kind]}", data, place)
    return out


def lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bit first; 256 starts anew, 257 ends; codes widen one entry early, as TIFF has it."""
    out, table, width, last, held, have = [], [], 9, b"", 0, 0
    for byte in data:
        held, have = (held << 8 | byte) & 0xFFFFFFFF, have + 8
        if have < width:
            continue
        have -= width
        code = held >> have & ((1 << width) - 1)
        if code == 256:
            table, width, last = [bytes([k]) for k in range(256)] + [b"", b""], 9, b""
            continue
        if code == 257:
            break
        if code > len(table) or (code == len(table) and not last):
            raise ValueError("LZW code")
        here = table[code] if code < len(table) else last + last[:1]
        out.append(here)
        if last:
            table.append(last + here[:1])
            width = min(12, max(9, (len(table) + 1).bit_length()))
        last = here
    return b"".join(out)


def _geotiff(data: bytes) -> Iterator[pd.DataFrame]:
    t = tiff_tags(data)
    order = "<" if data[:2] == b"II" else ">"
    w, h, bands = t[256][0], t[257][0], t.get(277, (1,))[0]
    kind = {1: "u", 2: "i", 3: "f"}[t.get(339, (1,))[0]] + str(t[258][0] // 8)
    packing = t.get(259, (1,))[0]
    predictor = t.get(317, (1,))[0]
    if packing not in (1, 5, 8, 32946) or predictor not in (1, 2) or (bands > 1 and t.get(284, (1,))[0] != 1):
        raise ValueError(f"packing {packing}, predictor {predictor}, planes {t.get(284, (1,))[0]}")
    unpack = {1: bytes, 5: lzw}.get(packing, zlib.decompress)
    tiled = 322 in t
    bw, bh = (t[322][0], t[323][0]) if tiled else (w, t.get(278, (h,))[0])
    offsets, counts = (t[324], t[325]) if tiled else (t[273], t[279])
    scale, tie = t.get(33550, (1.0, 1.0, 0.0)), t.get(33922, (0.0,) * 6)
    across = -(-w // bw)
    for k, (o, n) in enumerate(zip(offsets, counts, strict=True)):  # a block at a time
        raw = unpack(data[o:o + n])
        r0, c0 = k // across * bh, k % across * bw
        rows = bh if tiled else min(bh, h - r0)
        a = np.frombuffer(raw, np.dtype(order + kind), rows * bw * bands).reshape(rows, bw, bands)
        if predictor == 2:  # differences along the row
            a = np.cumsum(a, axis=1, dtype=a.dtype.newbyteorder("="))
        a = a[:h - r0, :w - c0]
        row, col = np.indices(a.shape[:2])
        row, col = row.ravel() + r0, col.ravel() + c0
        out = pd.DataFrame({"row": row.astype("i4"), "col": col.astype("i4"), "x": tie[3] + (col + 0.5) * scale[0], "y": tie[4] - (row + 0.5) * scale[1]})
        v = a.reshape(-1, bands).astype("f8")
        out["bands"] = [[None if np.isnan(x) else x for x in p] for p in v.tolist()]
        yield out


def read_geotiff(files: DataFrame, strict: bool = True) -> DataFrame:
    """Pixels of plain, LZW or deflated, chunky GeoTIFFs, with or without a horizontal predictor: ``path, row, col, x, y,
    bands``; NaN is NULL. Other packings are errors."""
    return _each(files, "row int, col int, x double, y double, bands array<double>", _geotiff, strict)


def geotiff_bytes(a: np.ndarray, x0: float, y0: float, res: float) -> bytes:
    """One deflated strip: rows x columns of float32, or rows x columns x bands of bytes (the fourth is alpha)."""
    a = np.ascontiguousarray(a, "u1" if a.ndim == 3 else "<f4")
    body, bands = zlib.compress(a.tobytes()), a.shape[2] if a.ndim == 3 else 1
    tags = [(256, 4, (a.shape[1],)), (257, 4, (a.shape[0],)), (258, 3, (8 * a.itemsize,) * bands), (259, 3, (8,)), (262, 3, (2 if bands > 2 else 1,)),
            (273, 4, (8,)), (277, 3, (bands,)), (278, 4, (a.shape[0],)), (279, 4, (len(body),)), *([(338, 3, (2,))] if bands == 4 else []),
            (339, 3, (1 if a.ndim == 3 else 3,) * bands), (33550, 12, (res, res, 0.0)), (33922, 12, (0.0, 0.0, 0.0, x0, y0, 0.0))]
    at = 8 + len(body) + len(body) % 2
    far, extra = at + 2 + 12 * len(tags) + 4, b""
    out = struct.pack("<H", len(tags))
    for tag, kind, v in tags:
        raw = struct.pack(f"<{len(v)}{_TAG_CODE[kind]}", *v)
        if len(raw) > 4:
            out += struct.pack("<HHII", tag, kind, len(v), far + len(extra))
            extra += raw
        else:
            out += struct.pack("<HHI", tag, kind, len(v)) + raw.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", at) + body + b"\0" * (len(body) % 2) + out + b"\0\0\0\0" + extra


def exif_gps(data: bytes) -> tuple[float, float, float] | None:
    """Latitude, longitude, altitude of a JPEG's EXIF block; None if anything is missing."""
    try:
        at = data.index(b"Exif\0\0") + 6
        top = tiff_tags(data, base=at)
        g = tiff_tags(data, top[34853][0], at)
        deg = lambda k, ref: (g[k][0] + g[k][1] / 60 + g[k][2] / 3600) * (-1 if g[ref][0] in ("S", "W") else 1)
        out = deg(2, 1), deg(4, 3), float(g[6][0]) if 6 in g else 0.0
        return None if any(v != v for v in out) else out
    except (ValueError, KeyError, IndexError, struct.error):
        return None


def read_gps(files: DataFrame) -> DataFrame:
    """``path, lat, lon, alt`` from EXIF; NULLs where there is none (XMP is the fallback)."""

    def run(frames):
        for pdf in frames:
            got = [exif_gps(bytes(c)) or (None,) * 3 for c in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"], **{n: pd.array([g[k] for g in got], dtype="Float64") for k, n in enumerate(("lat", "lon", "alt"))}})

    # the block is found wherever it stands; its segment has 64 KiB at most
    at = F.instr(F.decode("content", "ISO-8859-1"), "Exif\0\0")
    block = F.when(at > 0, F.substr("content", at, F.lit(1 << 16))).otherwise(F.lit(b""))
    return files.select("path", block.alias("content")).mapInPandas(run, "path string, lat double, lon double, alt double")


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def xlsx_rows(data: bytes, sheet: int = 1) -> list[dict[str, str | None]]:
    """Rows of a sheet by its first row's headers, stripped; all values as text."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            root = ElementTree.fromstring(z.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in root.findall("m:si", _NS)]
        root = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml"))
    table = []
    for row in root.iter(f"{{{_NS['m']}}}row"):
        cells = {}
        for c in row.findall("m:c", _NS):
            letters = re.match(r"[A-Z]+", c.get("r"))[0]
            at = 0
            for ch in letters:
                at = at * 26 + ord(ch) - 64
            v = c.find("m:v", _NS)
            text = v.text if v is not None else "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")) or None
            cells[at] = shared[int(text)] if c.get("t") == "s" and text is not None else text
        table.append(cells)
    if not table:
        return []
    heads = {k: str(v).strip() for k, v in table[0].items() if v is not None}
    return [{h: r.get(k) for k, h in heads.items()} for r in table[1:]]


def load_design(spark: SparkSession, path: str, sheet: int = 1) -> DataFrame:
    """Trial design from .xlsx or .csv; headers are stripped, ``plot_id`` is required."""
    if path.lower().endswith(".xlsx"):
        rows = xlsx_rows(bytes(binary(spark, path).select("content").first()[0]), sheet)  # one small workbook
        names = list(rows[0]) if rows else []
        df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"`{n}` string" for n in names)) if rows else None
    else:
        df = spark.read.option("header", True).csv(path)
        df = df.toDF(*[c.strip() for c in df.columns])
    if df is None or "plot_id" not in df.columns:
        raise ValueError("the design needs a plot_id")
    return df.withColumn("plot_id", F.col("plot_id").try_cast("double").cast("long"))


def read_sqlite(files: DataFrame, sql: str, schema: str) -> DataFrame:
    """A query over each SQLite file; BLOBs come as binary."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def parse(data: bytes):
        with tempfile.NamedTemporaryFile(suffix=".db") as f:  # the library needs a file; it lives as long as the task's step
            f.write(data)
            f.flush()
            con = sqlite3.connect(f"file:{f.name}?mode=ro", uri=True)
            try:
                cur = con.execute(sql)
                while rows := cur.fetchmany(10_000):
                    yield pd.DataFrame(rows, columns=names)
            finally:
                con.close()

    return _each(files, schema, parse)


def _cstring(data: bytes, at: int) -> tuple[str, int]:
    end = data.index(b"\0", at)
    return data[at:end].decode(), end + 1


def _model_images(data: bytes) -> Iterator[pd.DataFrame]:
    n, at, rows = struct.unpack_from("<Q", data)[0], 8, []
    for _ in range(n):
        v = struct.unpack_from("<I7dI", data, at)
        name, at = _cstring(data, at + 64)
        at += 8 + 24 * struct.unpack_from("<Q", data, at)[0]
        rows.append((v[0], name, v[8], list(v[1:5]), list(v[5:8])))
    yield pd.DataFrame(rows, columns=["image_id", "name", "camera_id", "q", "t"])


#: Camera models by number, and how many parameters each has.
CAMERA_MODELS = {0: ("SIMPLE_PINHOLE", 3), 1: ("PINHOLE", 4), 2: ("SIMPLE_RADIAL", 4), 3: ("RADIAL", 5), 4: ("OPENCV", 8), 6: ("FULL_OPENCV", 12)}


def _model_cameras(data: bytes) -> Iterator[pd.DataFrame]:
    n, at, rows = struct.unpack_from("<Q", data)[0], 8, []
    for _ in range(n):
        camera, model, w, h = struct.unpack_from("<IiQQ", data, at)
        name, size = CAMERA_MODELS[model]
        rows.append((camera, name, w, h, list(struct.unpack_from(f"<{size}d", data, at + 24))))
        at += 24 + 8 * size
    yield pd.DataFrame(rows, columns=["camera_id", "model", "width", "height", "params"])


def _model_points(data: bytes, rows: int = 1 << 16) -> Iterator[pd.DataFrame]:
    n, at, out = struct.unpack_from("<Q", data)[0], 8, []
    for _ in range(n):
        point, x, y, z, r, g, b, error, track = struct.unpack_from("<Q3d3BdQ", data, at)
        at += 51 + 8 * track
        out.append((point, x, y, z, r, g, b, error, track))
        if len(out) == rows:
            yield pd.DataFrame(out, columns=["point_id", *"xyzrgb", "error", "n_views"])
            out = []
    yield pd.DataFrame(out, columns=["point_id", *"xyzrgb", "error", "n_views"])


def read_model_cameras(files: DataFrame, strict: bool = True) -> DataFrame:
    """Cameras of a binary sparse model."""
    return _each(files, "camera_id long, model string, width long, height long, params array<double>", _model_cameras, strict)


def read_model_points(files: DataFrame, strict: bool = True) -> DataFrame:
    """Points of a binary sparse model with colour, error and how many views see them."""
    return _each(files, "point_id long, x double, y double, z double, r int, g int, b int, error double, n_views long", _model_points, strict)


def read_model_images(files: DataFrame, strict: bool = True) -> DataFrame:
    """Registered images of a binary sparse model: rotation quaternion (w first) and translation."""
    return _each(files, "image_id long, name string, camera_id long, q array<double>, t array<double>", _model_images, strict)
