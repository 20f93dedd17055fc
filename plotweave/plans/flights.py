"""Catalog queries: flights, files, runs, priors, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.photo import flight_key
from ..operators import catalog
from ..session import scratch
from .registering import query
from .views import images, read, view

_PATH = ("CASE WHEN user_id % 50 = 0 THEN '/data/_' || event_type WHEN user_id % 50 = 1 THEN '/data/.hidden' ELSE '/data/' || event_type END "
         "|| '/DJI_' || replace(cast(cast(ts as date) as string), '-', '') || lpad(cast(user_id % 24 as string), 2, '0') || '00'")
_FILES = ("event_type AS crop, cast(cast(ts as date) as string) AS flight, count(*) AS n, sum(value) AS v, min(event_id) AS first, max(event_id) AS last")
_STATUS = "CASE WHEN first % 3 = 0 THEN 'ok' WHEN first % 3 = 1 THEN 'failed' ELSE 'incomplete' END"


def flight_files(spark, d) -> DataFrame:
    """One row a flight with facts about its files."""
    g = view(spark, d, "frames").groupBy("crop", "flight").agg(F.min("event_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return g.select("crop", "flight", "n", "first", (F.col("first") % 5 != 0).alias("has_npz"), (F.col("first") % 7 * 400).alias("npz_bytes"),
                    (F.col("first") % 4 + 2).alias("sfm_files"), (F.col("n") * 40).alias("ply_points"),
                    F.when(F.col("first") % 2 == 0, 2048).alias("bundle_bytes"), F.expr(_STATUS).alias("status"))


_FLIGHTS = f"(SELECT crop, flight, n, first, {_STATUS} AS status FROM (SELECT event_type AS crop, cast(cast(ts as date) as string) AS flight, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1, 2))"


@query(f"""SELECT crop, flight, path FROM (SELECT DISTINCT path, split_part(path, '/', 3) AS crop, split_part(path, '/', 4) AS flight FROM (SELECT {_PATH} AS path FROM events))
WHERE left(crop, 1) NOT IN ('_', '.')""")
def flight_catalog(spark, d):
    return catalog.flights_of(read(spark, d, "events").selectExpr(f"{_PATH} AS path"))


@query(f"SELECT crop, flight, n FROM {_FLIGHTS} WHERE status <> 'ok'")
def new_flights(spark, d):
    f = flight_files(spark, d)
    return catalog.not_done(f.select("crop", "flight", "n"), f.select("crop", "flight", "status"), ["crop", "flight"])


@query(f"""SELECT crop, flight, CASE WHEN first % 5 = 0 THEN 'no ortho inputs' WHEN first % 7 * 400 < 1024 THEN 'ortho inputs truncated' WHEN first % 4 + 2 < 3 THEN 'model incomplete'
WHEN n * 40 < 1000 THEN 'dense cloud too small' WHEN first % 2 <> 0 THEN 'no depth bundle' END AS reason FROM {_FLIGHTS}""")
def pipeline_status(spark, d):
    return flight_files(spark, d).select("crop", "flight", catalog.completeness(need_bundle=True).alias("reason"))


_SOURCE = "CASE WHEN first % 2 = 0 THEN 'bundle' WHEN first % 4 = 3 THEN 'workspace' WHEN n * 40 >= 1000 THEN 'dense' ELSE 'sparse' END"


@query(f"SELECT crop, flight, {_SOURCE} AS source FROM {_FLIGHTS}")
def depth_source(spark, d):
    """A flight's depth: bundle, live workspace, dense cloud, else the sparse one."""
    has = lambda name, cond: F.when(cond, name)
    return flight_files(spark, d).select("crop", "flight", F.coalesce(
        has("bundle", F.col("bundle_bytes").isNotNull()), has("workspace", F.col("sfm_files") == 5), has("dense", F.col("ply_points") >= 1000), F.lit("sparse")).alias("source"))


_SUFFIX = "CASE WHEN event_id % 400 = 0 THEN '.jpg' WHEN event_id % 400 = 1 THEN '.jPg' ELSE '.txt' END"


@query(f"SELECT DISTINCT '/data/' || crop || '/' || flight AS path FROM frames WHERE {_SUFFIX} = '.jpg'", "frames")
def flights_with_images(spark, d):
    f = view(spark, d, "frames").withColumn("path", F.concat(F.lit("/data/"), "crop", F.lit("/"), "flight"))
    return catalog.has_images(f.select("path").distinct(), f.select(F.concat("path", F.lit("/"), "name", F.expr(_SUFFIX)).alias("path")))


@query("""SELECT coalesce(a.key, b.key) AS key, a.value AS before, b.value AS now FROM (SELECT n_name AS key, CAST(n_regionkey AS VARCHAR) AS value FROM nation WHERE n_nationkey < 20) a FULL JOIN
(SELECT n_name AS key, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST(n_regionkey AS VARCHAR) END AS value FROM nation WHERE n_nationkey >= 5) b ON a.key = b.key
WHERE a.key IS NULL OR b.key IS NULL OR a.value IS DISTINCT FROM b.value""")
def stamp_changes(spark, d):
    """Two stamps of the same workspace, each without some of the other's settings."""
    n = read(spark, d, "nation").withColumn("key", F.col("n_name")).withColumn("value", F.col("n_regionkey").cast("string"))
    now = n.filter("n_nationkey >= 5").withColumn("value", F.when(F.col("n_nationkey") % 4 != 0, F.col("value")))
    return catalog.stamp_changes(now, n.filter("n_nationkey < 20"))


@query("SELECT i.image_id, i.name, p.py, 'ok' AS verdict FROM images i JOIN priors p USING (image_id)", "images", "priors")
def model_priors(spark, d):
    i = images(spark, d)
    p = view(spark, d, "priors").join(i, "image_id").select("name", "py")
    both, verdict = catalog.model_priors(i, p)
    return both.select("image_id", "name", "py", F.lit(verdict).alias("verdict"))


@query("SELECT image_id, name FROM images WHERE image_id NOT IN (SELECT image_id FROM priors) ORDER BY name LIMIT 8", "images", "priors")
def first_without_prior(spark, d):
    """A message's first eight names."""
    return catalog.head(images(spark, d).join(view(spark, d, "priors"), "image_id", "left_anti"), ["name"])


@query("""SELECT (SELECT count(*) FROM images) AS n_images, (SELECT count(*) FROM priors) AS n_priors, (SELECT count(*) FROM images WHERE image_id NOT IN (SELECT image_id FROM priors)) AS n_missing,
(SELECT count(DISTINCT coordinate_system) FROM priors) AS n_systems""", "images", "priors")
def prior_audit(spark, d):
    return catalog.audit(images(spark, d), view(spark, d, "priors"), "image_id", "coordinate_system")


@query("SELECT i.image_id, i.name, round(p.px, 6) AS px, p.py, p.pz, p.coordinate_system FROM images i JOIN priors p USING (image_id)", "images", "priors")
def priors_join_images(spark, d):
    return images(spark, d).join(view(spark, d, "priors"), "image_id").select(
        "image_id", "name", F.round("px", 6).alias("px"), "py", "pz", "coordinate_system")


@query("SELECT image_id, name FROM images WHERE image_id NOT IN (SELECT image_id FROM priors)", "images", "priors")
def images_without_prior(spark, d):
    return catalog.without_prior(images(spark, d), view(spark, d, "priors"), "image_id")


@query("""SELECT name, 'added' AS change FROM (SELECT name FROM images WHERE image_id % 3 <> 0 EXCEPT SELECT name FROM images WHERE image_id % 4 <> 0)
UNION ALL SELECT name, 'removed' FROM (SELECT name FROM images WHERE image_id % 4 <> 0 EXCEPT SELECT name FROM images WHERE image_id % 3 <> 0)""", "images")
def name_diff(spark, d):
    i = images(spark, d)
    return catalog.name_diff(i.filter("image_id % 3 <> 0").select("name"), i.filter("image_id % 4 <> 0").select("name"))


@query("""SELECT name, 'src' AS origin FROM images WHERE image_id % 2 = 0 UNION ALL
SELECT CASE WHEN image_id % 2 = 0 THEN 'f2_' || name ELSE name END, 'src2' FROM images WHERE image_id % 3 = 0""", "images")
def merge_folders(spark, d):
    i = images(spark, d)
    return catalog.merge_folders(i.filter("image_id % 2 = 0").select("name"), i.filter("image_id % 3 = 0").select("name"))


@query("SELECT DISTINCT crop || '/' || flight AS key, crop, flight FROM frames WHERE lower(crop) IN ('click', 'view') AND contains(flight, '-01-0')", "frames")
def filter_flights(spark, d):
    f = view(spark, d, "frames").select("crop", "flight").distinct()
    return catalog.select_flights(f, ["Click", "view"], "-01-0").select("key", "crop", "flight")


_FILE = "name || CASE event_id % 4 WHEN 0 THEN '.JPG' WHEN 1 THEN '.jpeg' WHEN 2 THEN '.Jpg' ELSE '.txt' END"


@query(f"""SELECT crop, flight, count(*) AS n, min(file) AS first, bool_or(lower(file) LIKE '%.jpeg') AS any_jpeg FROM (SELECT *, {_FILE} AS file FROM frames)
WHERE regexp_matches(lower(file), '[.]jpe?g$') GROUP BY crop, flight HAVING count(*) >= 5""", "frames")
def list_images(spark, d):
    return catalog.photo_listing(view(spark, d, "frames").withColumn("file", F.expr(_FILE)), ["crop", "flight"], "file")


@query("""SELECT name, CASE WHEN image_id % 2 = 0 THEN '/a/' || name WHEN image_id % 3 = 0 THEN '/b/' || name END AS path,
CASE WHEN image_id % 2 = 0 THEN 0 WHEN image_id % 3 = 0 THEN 1 ELSE -1 END AS priority FROM images""", "images")
def resolve_images(spark, d):
    i = images(spark, d)
    listing = lambda folder, cond: i.filter(cond).select("name", F.concat(F.lit(folder), "name").alias("path"))
    return catalog.resolve_first(i.select("name"), [listing("/a/", "image_id % 2 = 0"), listing("/b/", "image_id % 3 = 0")]).withColumn(
        "priority", F.coalesce("priority", F.lit(-1)))


@query("SELECT crop, arg_max(flight, size * 1000000 + first) AS flight, max(size) AS size FROM (SELECT crop, flight, first, n * 40 AS size FROM " + _FLIGHTS + ") GROUP BY crop")
def latest_artifact(spark, d):
    return catalog.latest(flight_files(spark, d).withColumnRenamed("ply_points", "size"), "crop", "flight", ["size", "first"])


@query(f"SELECT crop, flight, first % 2 = 0 AS matched, first % 2 = 0 AND first % 3 = 0 AS verified, first % 5 <> 0 AS raw, first % 5 <> 0 AND n >= 10 AS refined, n * 40 >= 1000 AS fused FROM {_FLIGHTS}")
def resume_flags(spark, d):
    c = F.col
    x = catalog.resume_flags(flight_files(spark, d), c("first") % 2 == 0, c("first") % 3 == 0, c("has_npz"), c("n") >= 10, c("ply_points") >= 1000)
    return x.select("crop", "flight", "matched", "verified", "raw", "refined", "fused")


@query(f"SELECT status, count(*) AS n_flights, sum(n)::BIGINT AS n_photos FROM {_FLIGHTS} GROUP BY status")
def batch_summary(spark, d):
    return catalog.batch_summary(flight_files(spark, d))


@query("""SELECT crop, count(*) FILTER (WHERE event_id % 4 = 0) AS src2, count(*) FILTER (WHERE event_id % 4 <> 0) AS src FROM frames GROUP BY crop""", "frames")
def origin_counts(spark, d):
    x = view(spark, d, "frames").withColumn("origin", F.when(F.col("event_id") % 4 == 0, "src2").otherwise("src"))
    return catalog.counts_by_origin(x, "crop", "origin", ["src2", "src"])


@query(f"SELECT crop, flight, CASE WHEN first % 3 = 0 THEN 11 ELSE 10 END AS version FROM {_FLIGHTS} WHERE first % 3 <> 0")
def invalidate_stale(spark, d):
    f = flight_files(spark, d).select("crop", "flight", F.when(F.col("first") % 3 == 0, 11).otherwise(10).alias("version"))
    return catalog.stale(f, 11)


@query("SELECT event_type AS crop, count(*) AS n, count(DISTINCT cast(ts as date)) AS flights, CAST('{\"n\":' || count(*) || ',\"flights\":' || count(DISTINCT cast(ts as date)) || '}' AS VARCHAR) AS status FROM events GROUP BY 1")
def status_json(spark, d):
    g = view(spark, d, "frames").groupBy("crop").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("flight").alias("flights"))
    told = g.withColumn("status", F.to_json(F.struct("n", "flights")))
    back = told.withColumn("s", F.from_json("status", "n long, flights long", {"mode": "PERMISSIVE"}))
    return back.select("crop", F.col("s.n").alias("n"), F.col("s.flights").alias("flights"), "status")


@query("SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def csv_roundtrip(spark, d):
    import uuid

    x = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "n_regionkey", "r_name")
    path = f"{scratch(spark)}/csv-{uuid.uuid4().hex}"
    x.coalesce(1).write.option("header", True).csv(path)
    return spark.read.option("header", True).schema(x.schema).csv(path)


@query("SELECT crop, flight, name, fx FROM (SELECT *, 371329e-2 AS fx, row_number() OVER (PARTITION BY crop ORDER BY flight, name) AS k FROM frames WHERE event_id % 6 <> 0) WHERE k = 1", "frames")
def first_calibration(spark, d):
    """The first photo by flight and name whose XMP has a calibration."""
    from ..functions.photo import xmp_dewarp
    from .photos import xmp

    x = xmp(spark, d).withColumn("name", F.lpad(F.col("event_id").cast("string"), 9, "0")).withColumn("w", xmp_dewarp("xmp"))
    x = x.withColumn("cal", F.when(F.col("w").isNotNull(), F.struct("flight", "name", F.col("w.fx").alias("fx"))))
    return x.groupBy("crop").agg(F.min("cal").alias("c")).filter("c IS NOT NULL").select("crop", "c.*")


@query("""SELECT crop, sub, n, rank, share FROM (SELECT *, CAST(row_number() OVER (PARTITION BY crop ORDER BY n DESC, sub) AS INT) AS rank, round(n * 1e0 / sum(n) OVER (PARTITION BY crop), 6) AS share
FROM (SELECT crop, event_id % 4 AS sub, count(*) AS n FROM frames GROUP BY 1, 2))""", "frames")
def submodel_rank(spark, d):
    x = catalog.submodels(view(spark, d, "frames").withColumn("sub", F.col("event_id") % 4), "crop", "sub")
    return x.select("crop", "sub", "n", "rank", F.round("share", 6).alias("share"))


@query("SELECT crop, flight, CAST(k AS INT) AS k FROM (SELECT crop, flight, row_number() OVER (PARTITION BY crop ORDER BY flight) AS k FROM (SELECT DISTINCT crop, flight FROM frames)) WHERE k <= 2", "frames")
def earliest_flights(spark, d):
    w = Window.partitionBy("crop").orderBy("flight")
    f = view(spark, d, "frames").select("crop", "flight").distinct()
    return f.withColumn("k", F.row_number().over(w)).filter("k <= 2")


@query("SELECT split_part(path, '/', 4) AS key, count(*) AS n FROM (SELECT " + _PATH + " AS path FROM events) GROUP BY 1")
def flight_keys(spark, d):
    x = read(spark, d, "events").selectExpr(f"{_PATH} AS path")
    return x.groupBy(flight_key("path").alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT name, 'a' AS parts, CAST(NULL AS VARCHAR) AS rank FROM images WHERE image_id % 7 = 0 UNION ALL SELECT name, NULL, CAST(image_id AS VARCHAR) FROM images WHERE image_id % 11 = 0", "images")
def union_frames(spark, d):
    i = images(spark, d)
    return catalog.union_all([i.filter("image_id % 7 = 0").select("name", F.lit("a").alias("parts")), i.filter("image_id % 11 = 0").select("name", F.col("image_id").cast("string").alias("rank"))])
