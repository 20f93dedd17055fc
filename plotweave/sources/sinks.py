"""Sinks. Parquet is the primary format; these serve tools outside."""

from __future__ import annotations

import sqlite3
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import geotiff_bytes, ply_bytes


def write_csv(df: DataFrame, path: str) -> None:
    """One file with a header: for result tables of plots and flights, not for pixels."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_status(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_pairs(pairs: DataFrame, path: str, a: str = "a", b: str = "b") -> None:
    pairs.select(F.concat_ws(" ", F.col(a).cast("string"), F.col(b).cast("string")).alias("value")).write.mode("overwrite").text(path)


def write_tiles(pixels: DataFrame, path: str, tile: int = 1024) -> None:
    """Pixels by tile: a reader of a window opens its tiles only."""
    t = lambda c: F.floor(F.col(c) / tile)
    (pixels.withColumn("tile_row", t("row")).withColumn("tile_col", t("col")).repartition("tile_row", "tile_col")
     .write.mode("overwrite").partitionBy("tile_row", "tile_col").parquet(path))


def write_depth(depth: DataFrame, path: str, scale: int = 2) -> None:
    """Depth thinned by nearest, single precision; invalid pixels go."""
    keep = (F.col("row") % scale == 0) & (F.col("col") % scale == 0) & (F.col("d") > 0)
    thin = depth.filter(keep).select("view", (F.col("row") / scale).cast("int").alias("row"), (F.col("col") / scale).cast("int").alias("col"), F.col("d").cast("float"))
    thin.write.mode("overwrite").partitionBy("view").parquet(path)


def rasters(pixels: DataFrame, values: list[str], x0: float, y0: float, res: float, by: tuple[str, ...] = (), tile: int = 1024) -> DataFrame:
    """``name, content``: a GeoTIFF for each ``by`` and tile, for ``save_files``. One value makes a float32 raster, NaN where
    there is no pixel; three or four make bytes of red, green, blue and alpha (255 where there is a pixel, if not given)."""
    t = lambda c: F.floor(F.col(c) / tile).cast("int")

    def make(key, pdf):
        *names, tr, tc = key
        row, col = pdf["row"].to_numpy() - tr * tile, pdf["col"].to_numpy() - tc * tile
        shape = (int(row.max()) + 1, int(col.max()) + 1)
        if len(values) == 1:
            a = np.full(shape, np.nan, "f4")
            a[row, col] = pdf[values[0]]
        else:
            a = np.zeros((*shape, 4), "u1")
            a[row, col, 3] = 255
            a[row, col, :len(values)] = pdf[values].to_numpy()
        name = "-".join(map(str, (*names, tr, tc))) + ".tif"
        return pd.DataFrame({"name": [name], "content": [geotiff_bytes(a, x0 + tc * tile * res, y0 - tr * tile * res, res)]})

    dealt = pixels.select(*by, "row", "col", *values, t("row").alias("tile_row"), t("col").alias("tile_col"))
    return dealt.groupBy(*by, "tile_row", "tile_col").applyInPandas(make, "name string, content binary")


def clouds(points: DataFrame, by: tuple[str, ...], ascii: bool = False, rows: int = 1 << 20) -> DataFrame:
    """``name, content``: PLY files of at most about ``rows`` points for each ``by``, for ``save_files``; ascii has three decimals."""
    n = points.count()

    def make(key, pdf):
        xyz = pdf[list("xyz")].to_numpy("f8")
        if ascii:
            head = ply_bytes(xyz[:0]).decode().replace("binary_little_endian", "ascii").replace("vertex 0", f"vertex {len(xyz)}")
            content = (head + "".join(f"{x:.3f} {y:.3f} {z:.3f}\n" for x, y, z in xyz.tolist())).encode()
        else:
            content = ply_bytes(xyz)
        return pd.DataFrame({"name": ["-".join(map(str, key)) + ".ply"], "content": [content]})

    part = F.pmod(F.xxhash64("x", "y", "z"), F.lit(-(-n // rows) or 1)).cast("int").alias("part")
    return points.select(*by, "x", "y", "z", part).groupBy(*by, "part").applyInPandas(make, "name string, content binary")


def save_files(files: DataFrame, folder: str) -> int:
    """Write ``name, content`` rows as files of a folder that the executors share; returns how many. A file appears whole or
    not at all, and a task that runs again replaces its own."""

    def save(frames):
        from pyarrow import fs

        for pdf in frames:
            for name, content in zip(pdf["name"], pdf["content"], strict=True):
                system, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
                system.create_dir(base)
                part = f"{base}/.{name}-{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(bytes(content))
                system.move(part, f"{base}/{name}")
            yield pdf[["name"]]

    return files.mapInPandas(save, "name string").count()


def write_ortho_inputs(poses: DataFrame, georef: DataFrame, cloud: DataFrame, path: str) -> None:
    """Three tables: poses with the first four camera parameters, the transform, the cloud."""
    poses.withColumn("params", F.slice("params", 1, 4)).write.mode("overwrite").parquet(f"{path}/poses")
    georef.write.mode("overwrite").parquet(f"{path}/georef")
    cloud.select(*[F.col(c).cast("float") for c in "xyz"]).write.mode("overwrite").parquet(f"{path}/cloud")


def append_rows(df: DataFrame, path: str) -> None:
    """Keypoints, matches and priors as a table that grows."""
    df.write.mode("append").parquet(path)


def databases(df: DataFrame, table: str, by: str) -> DataFrame:
    """``name, content``: an SQLite file for each ``by`` (a flight's priors or matches), for ``save_files``."""
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "float": "REAL", "binary": "BLOB"}
    columns = [(c, kinds.get(t, "TEXT")) for c, t in df.dtypes if c != by]

    def make(key, pdf):
        con = sqlite3.connect(":memory:")
        con.execute(f"CREATE TABLE {table} ({', '.join(f'{c} {k}' for c, k in columns)})")
        rows = pdf[[c for c, _ in columns]].astype(object).where(pdf[[c for c, _ in columns]].notna(), None).values.tolist()
        con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(columns))})", rows)
        con.commit()
        content = con.serialize()
        con.close()
        return pd.DataFrame({"name": [f"{key[0]}.db"], "content": [content]})

    return df.groupBy(by).applyInPandas(make, "name string, content binary")


def write_features(features: DataFrame, path: str) -> None:
    """Feature cache of ``name, keypoints array<array<float>>, descriptors``: descriptors in half precision."""

    def half(frames):
        for pdf in frames:
            pdf["width"] = [len(d[0]) if len(d) else 0 for d in pdf["descriptors"]]
            pdf["descriptors"] = [np.array([list(r) for r in d], "f2").tobytes() for d in pdf["descriptors"]]
            yield pdf

    out = features.select("name", "keypoints", "descriptors").mapInPandas(half, "name string, keypoints array<array<float>>, descriptors binary, width int")
    out.write.mode("overwrite").parquet(path)


def read_features(spark, path: str) -> DataFrame:
    def whole(frames):
        for pdf in frames:
            pdf["descriptors"] = [np.frombuffer(d, "f2").astype("f4").reshape(-1, max(w, 1)).tolist() if w else [] for d, w in zip(pdf["descriptors"], pdf["width"], strict=True)]
            yield pdf.drop(columns="width")

    return spark.read.parquet(path).mapInPandas(whole, "name string, keypoints array<array<float>>, descriptors array<array<float>>")
