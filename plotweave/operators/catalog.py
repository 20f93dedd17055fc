"""Flights, files, runs: discovery, completeness, audits, resolution, incremental batches."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flights_of(paths: DataFrame, path: str = "path") -> DataFrame:
    """``crop, flight, path`` of flight folders: root/crop/DJI_* or root/DJI_*, no hidden or underscored folder; of one
    resolved path the first stays."""
    parts = F.split(F.col(path), "/")
    flight, parent = F.element_at(parts, -1), F.try_element_at(parts, F.lit(-2))
    ok = flight.startswith("DJI_") & ~parent.rlike("^[._]")
    resolved = F.regexp_replace(F.col(path), "/[.]?(?=/)|/[.]$", "")
    w = Window.partitionBy("resolved").orderBy("path")
    return (paths.select(F.col(path).alias("path"), parent.alias("crop"), flight.alias("flight"), resolved.alias("resolved"), ok.alias("ok"))
            .filter("ok").withColumn("n", F.row_number().over(w)).filter("n = 1").select("crop", "flight", "path"))


def completeness(do_dense: bool = True, need_bundle: bool = False, least_points: int = 1000) -> Column:
    """The first failing check of a flight's files is the reason; NULL when complete."""
    c = F.when(~F.col("has_npz"), "no ortho inputs").when(F.col("npz_bytes") < 1024, "ortho inputs truncated")
    c = c.when(F.col("sfm_files") < 3, "model incomplete")
    if do_dense:
        c = c.when(F.col("ply_points") < least_points, "dense cloud too small")
    if need_bundle:
        c = c.when(F.coalesce("bundle_bytes", F.lit(0)) < 1024, "no depth bundle")
    return c


def not_done(flights: DataFrame, status: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Flights without an ``ok`` status."""
    return flights if force else flights.join(status.filter("status = 'ok'").select(*keys).distinct(), keys, "left_anti")


def name_diff(now: DataFrame, before: DataFrame, name: str = "name") -> DataFrame:
    a, b = now.select(name).distinct(), before.select(name).distinct()
    return (a.join(b, name, "left_anti").withColumn("change", F.lit("added"))
            .unionByName(b.join(a, name, "left_anti").withColumn("change", F.lit("removed"))))


def merge_folders(first: DataFrame, second: DataFrame, name: str = "name", prefix: str = "f2_") -> DataFrame:
    """Both listings; names of the second that the first has are prefixed. No row is lost."""
    taken = first.select(F.col(name).alias("__t")).distinct()
    renamed = (second.join(taken, second[name] == taken["__t"], "left")
               .withColumn(name, F.when(F.col("__t").isNotNull(), F.concat(F.lit(prefix), F.col(name))).otherwise(F.col(name))).drop("__t"))
    return first.withColumn("origin", F.lit("src")).unionByName(renamed.withColumn("origin", F.lit("src2")))


def resolve_first(names: DataFrame, listings: list[DataFrame], name: str = "name", path: str = "path") -> DataFrame:
    """Each name with its path in the first listing that has it."""
    every = reduce(DataFrame.unionByName, [d.select(name, path).withColumn("priority", F.lit(k)) for k, d in enumerate(listings)])
    best = every.groupBy(name).agg(F.min(F.struct("priority", path)).alias("b"))
    return names.join(best, name, "left").select(name, F.col(f"b.{path}").alias(path), F.col("b.priority").alias("priority"))


def first_n(df: DataFrame, n: int, by: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def pick_column(df: DataFrame, names: list[str]) -> str | None:
    """The first of ``names`` that exists with any value; one aggregation decides all."""
    there = [n for n in names if n in df.columns]
    if not there:
        return None
    got = df.agg(*[F.bool_or(F.col(n).isNotNull()).alias(n) for n in there]).first()
    return next((n for n in there if got[n]), None)


def camera_params(model: str, width: int, height: int, fx: float, fy: float | None = None, cx: float = 0.0, cy: float = 0.0,
                  k: tuple[float, ...] = ()) -> tuple[str, list[float]]:
    """Parameter list of a camera model; the principal point is given as an offset from the image centre."""
    px, py = width / 2 + cx, height / 2 + cy
    fy = fx if fy is None else fy
    k = (*k, 0.0, 0.0, 0.0, 0.0, 0.0)
    models = {"SIMPLE_RADIAL": [fx, px, py, k[0]], "PINHOLE": [fx, fy, px, py], "OPENCV": [fx, fy, px, py, *k[:4]],
              "FULL_OPENCV": [fx, fy, px, py, *k[:5], 0.0, 0.0, 0.0]}
    if model not in models:
        raise ValueError(f"unknown camera model {model}")
    return model, models[model]


#: Photo suffixes, in the cases that are looked for.
PHOTO_SUFFIXES = (".JPG", ".jpg", ".JPEG", ".jpeg")


def has_images(flights: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """Flights whose folder itself holds a photo; ``files`` are all files below."""
    folder = F.regexp_extract(F.col(path), "^(.*)/[^/]*$", 1)
    suffix = F.regexp_extract(F.col(path), r"([.][^./]*)$", 1)
    photos = files.filter(suffix.isin(*PHOTO_SUFFIXES)).select(folder.alias(path))
    return flights.join(photos, path, "left_semi")


def preflight_dewarp(photos: DataFrame, by: list[str], name: str = "name", xmp: str = "xmp", n: int = 5) -> DataFrame:
    """``ok``: whether any of the first ``n`` photos by name has a calibration; only these are parsed."""
    from ..functions.photo import xmp_dewarp

    return first_n(photos, n, by, [name]).groupBy(*by).agg(F.bool_or(xmp_dewarp(xmp).isNotNull()).alias("ok"))


def min_matches(matches: DataFrame, pair: list[str], least: int = 15) -> DataFrame:
    """Pairs with ``least`` matches or more, and their number."""
    return matches.groupBy(*pair).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def resume_flags(flights: DataFrame, matched: Column, verified: Column, raw: Column, refined: Column, fused: Column) -> DataFrame:
    """What of a run is there to resume from; a later stage counts only where the earlier it builds on is there."""
    return flights.select("*", matched.alias("matched"), (matched & verified).alias("verified"), raw.alias("raw"), (raw & refined).alias("refined"), fused.alias("fused"))


def stamp_changes(now: DataFrame, before: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """``key, before, now`` of settings that differ between two stamps, missing ones included; no row: the workspace holds."""
    a = before.select(F.col(key).alias("key"), F.col(value).alias("before"), F.lit(True).alias("had"))
    b = now.select(F.col(key).alias("key"), F.col(value).alias("now"), F.lit(True).alias("has"))
    both = a.join(b, "key", "full")
    return both.filter(F.col("had").isNull() | F.col("has").isNull() | ~F.col("before").eqNullSafe(F.col("now"))).select("key", "before", "now")


def first_source(candidates: list[tuple[str, Callable[[], DataFrame | None]]]) -> tuple[str, DataFrame | None]:
    """The first candidate with any row, by its name: depth bundle, live workspace, largest dense cloud, sparse cloud. Later
    ones are never opened."""
    for name, opened in candidates:
        df = opened()
        if df is not None and not df.isEmpty():
            return name, df
    return "none", None


def model_priors(names: DataFrame, priors: DataFrame, name: str = "name", warn: int = 5) -> tuple[DataFrame, str]:
    """Registered images with their priors, and a verdict: ``ok``, ``few`` below ``warn``. None at all is an error."""
    both = names.join(priors, name)
    n = both.limit(warn).count()
    if not n:
        raise ValueError("no registered image has a prior")
    return both, "ok" if n >= warn else "few"


def head(df: DataFrame, order: list[str], n: int = 8) -> DataFrame:
    """The first rows for a message; a top-n a task, never a full sort."""
    return df.orderBy(*order).limit(n)


def mutual_nearest(first: DataFrame, second: DataFrame, block: str, key: str = "vec_id", vector: str = "e", salts: int = 16, digits: int = 6) -> DataFrame:
    """``a, b, cos``: pairs of a ``block`` (a photo pair, a label) that are each other's nearest by cosine, ties to the smaller
    key. A hot block is met by ``salts`` tasks, each with a part of the first side; nearest ones are aggregated map-side."""
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda s, t: s * t), F.lit(0.0), lambda s, t: s + t)
    a = first.select(F.col(key).alias("a"), block, F.col(vector).alias("ea"), F.sqrt(dot(vector, vector)).alias("na"), F.pmod(F.xxhash64(key), F.lit(salts)).alias("salt"))
    b = second.select(F.col(key).alias("b"), block, F.col(vector).alias("eb"), F.sqrt(dot(vector, vector)).alias("nb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    s = a.join(b, [block, "salt"]).select("a", "b", F.round(dot("ea", "eb") / (F.col("na") * F.col("nb")), digits).alias("cos"))
    best_a = s.groupBy("a").agg(F.max_by("b", F.struct("cos", -F.col("b"))).alias("b"), F.max("cos").alias("cos"))
    best_b = s.groupBy("b").agg(F.max_by("a", F.struct("cos", -F.col("a"))).alias("a"))
    return best_a.join(best_b, ["a", "b"]).select("a", "b", "cos")


def audit(images: DataFrame, priors: DataFrame, key: str, system: str) -> DataFrame:
    """``n_images, n_priors, n_missing, n_systems`` in one row."""
    told = priors.agg(F.count(F.lit(1)).alias("n_priors"), F.countDistinct(system).alias("n_systems"))
    missing = images.join(priors, key, "left_anti").agg(F.count(F.lit(1)).alias("n_missing"))
    return images.agg(F.count(F.lit(1)).alias("n_images")).crossJoin(told).crossJoin(missing)


def batch_summary(flights: DataFrame, status: str = "status", photos: str = "n") -> DataFrame:
    return flights.groupBy(status).agg(F.count(F.lit(1)).alias("n_flights"), F.sum(photos).alias("n_photos"))


def counts_by_origin(photos: DataFrame, by: str, origin: str, names: list[str]) -> DataFrame:
    return photos.groupBy(by).pivot(origin, names).count()


def stale(flights: DataFrame, version: int, column: str = "version") -> DataFrame:
    """Flights whose products an older version made, or none that told its own."""
    return flights.filter(F.col(column).isNull() | (F.col(column) < version))


def latest(files: DataFrame, by: str, name: str, order: list[str]) -> DataFrame:
    """The largest file of each group by ``order``, and its size, the first of these."""
    return files.groupBy(by).agg(F.max_by(name, F.struct(*order)).alias(name), F.max(order[0]).alias(order[0]))


def submodels(images: DataFrame, by: str, model: str) -> DataFrame:
    """``n, rank, share`` of each sub-model by size."""
    g = images.groupBy(by, model).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(by)
    return g.select(by, model, "n", F.row_number().over(w.orderBy(F.desc("n"), model)).alias("rank"), (F.col("n") / F.sum("n").over(w)).alias("share"))


def select_flights(flights: DataFrame, crops: list[str] | None = None, only: str | None = None) -> DataFrame:
    """Flights of some crops, whatever their case, with a piece of text in their name; ``key`` is crop/flight."""
    if crops is not None:
        flights = flights.filter(F.lower("crop").isin(*[c.lower() for c in crops]))
    if only is not None:
        flights = flights.filter(F.contains("flight", F.lit(only)))
    return flights.withColumn("key", F.concat_ws("/", "crop", "flight"))


def photo_listing(files: DataFrame, by: list[str], name: str, least: int = 5) -> DataFrame:
    """``n, first, any_jpeg`` of the folders with ``least`` photos or more, suffixes in any case."""
    x = files.filter(F.lower(name).rlike("[.]jpe?g$"))
    return x.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("first"), F.bool_or(F.lower(name).endswith(".jpeg")).alias("any_jpeg")).filter(F.col("n") >= least)


def without_prior(images: DataFrame, priors: DataFrame, key: str) -> DataFrame:
    return images.join(priors, key, "left_anti")
