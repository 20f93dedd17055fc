"""Survey-shaped rows projected from the star-schema tables; each view's columns are one list for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

X0, Y0, CELL = 541000.0, 5215000.0, 0.25
PLOT_W, PLOT_H, N_ROWS, N_COLS = 0.8, 0.75, 40, 50
CORNERS = [(541000.0, 5215000.0), (541040.0, 5215000.0), (541040.0, 5214970.0), (541000.0, 5214970.0)]

COLUMNS = {
    "frames": ("events", [
        "event_id", "lpad(cast(event_id as string), 9, '0') as name", "crc", "event_type as crop",
        "cast(cast(ts as date) as string) as flight", "47.2e0 + user_id * 1e-5 as lat", "9.5e0 + value * 1e-5 as lon",
        "430e0 + event_id % 7 as alt", "cast((event_id * 37) % 360 as double) as heading",
        "case when event_id % 9 = 0 then -60e0 else -90e0 end as pitch", "user_id * 1.1054e0 as north", "value * 0.756e0 as east"]),
    "points": ("lineitem", [
        "541000e0 + (l_partkey % 400) * 1e-1 as x", "5215000e0 - ((l_suppkey * 7 + l_linenumber * 13) % 300) * 1e-1 as y",
        "430e0 + l_quantity * 2e-2 as z", "substr(cast(l_shipdate as string), 1, 4) as flight"]),
    "rgb": ("lineitem", [
        "541000e0 + (l_partkey % 400) * 1e-1 as x", "5215000e0 - ((l_suppkey * 7 + l_linenumber * 13) % 300) * 1e-1 as y",
        "substr(cast(l_shipdate as string), 1, 4) as flight", "cast(l_quantity * 5 as int) as r",
        "cast(floor(l_extendedprice) as bigint) % 256 as g", "cast(round((l_discount + l_tax) * 1000) as int) as b",
        "case when l_returnflag = 'R' then 0 else 255 end as a"]),
    "design": ("part", ["p_partkey as plot_id", "p_brand as line_name", "p_size as rep"]),
    "poses": ("supplier", [
        "s_suppkey as k", "s_name as name", "541000e0 + ((s_suppkey * 37) % 400) * 1e-1 as e", "5215000e0 - ((s_suppkey * 53) % 300) * 1e-1 as n",
        "440e0 + (s_nationkey % 5) * 5e-1 as z", "s_nationkey * 4e0 as tilt"]),
    "priors": ("customer", ["c_custkey as image_id", "c_acctbal * 1e-2 as px", "c_nationkey * 1e0 as py", "430e0 + c_custkey % 11 as pz",
                            "case when c_custkey % 97 = 0 then -1 else 1 end as coordinate_system"]),
}
COLUMNS["frames"][1].remove("crc")


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def view(spark: SparkSession, d: str, name: str) -> DataFrame:
    table, columns = COLUMNS[name]
    df = read(spark, d, table)
    if name == "priors":
        df = df.filter("c_custkey % 10 <> 0")
    return df.selectExpr(*columns)


def images(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_custkey").alias("image_id")).distinct().withColumn(
        "name", F.concat(F.lit("IMG_"), F.lpad(F.col("image_id").cast("string"), 7, "0")))


def cells(spark: SparkSession, d: str) -> DataFrame:
    """Surface cells by flight: (flight, row, col, dsm, n)."""
    from ..functions.numeric import grid_cell

    row, c = grid_cell("x", "y", X0, Y0, CELL)
    return view(spark, d, "points").groupBy("flight", row.alias("row"), c.alias("col")).agg(F.max("z").alias("dsm"), F.count(F.lit(1)).alias("n"))


def surface(spark: SparkSession, d: str) -> DataFrame:
    """One surface of all flights on 1 m cells: (row, col, z); cells whose number is divisible by 11 are holes."""
    from ..functions.numeric import grid_cell

    row, c = grid_cell("x", "y", X0, Y0, 1.0)
    return (view(spark, d, "points").groupBy(row.alias("row"), c.alias("col")).agg(F.min("z").alias("z"))
            .filter("(row * 40 + col) % 11 <> 0"))


def views_of_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Views of 2 m pixels by the cameras nearer than 6 m: (row, col, k, w, gated, c)."""
    from ..operators.joins import within_radius

    px = spark.range(15 * 20).select((F.col("id") / 20).cast("int").alias("row"), (F.col("id") % 20).cast("int").alias("col"))
    px = px.withColumn("x", F.lit(X0) + (F.col("col") + 0.5) * 2).withColumn("y", F.lit(Y0) - (F.col("row") + 0.5) * 2)
    cams = view(spark, d, "poses").filter("tilt <= 20").select("k", F.col("e").alias("cx"), F.col("n").alias("cy"), F.lit(6.0).alias("radius"))
    near = within_radius(px, cams, 6.0)
    w = F.round(F.pow(F.least(F.greatest(1 - F.col("distance") / 6, F.lit(0.0)), F.lit(1.0)), F.lit(6.0)), 9)
    return near.select("row", "col", "k", w.alias("w"), ((F.col("k") + F.col("row") + F.col("col")) % 3 != 0).alias("gated"),
                       ((F.col("k") * 7 + F.col("row") * 3 + F.col("col")) % 256).cast("double").alias("c"))


#: The same views for the SQL twins.
SQL = {name: f"SELECT {', '.join(cols)} FROM {table}" + (" WHERE c_custkey % 10 <> 0" if name == "priors" else "")
       for name, (table, cols) in COLUMNS.items()}
SQL["images"] = "SELECT DISTINCT o_custkey AS image_id, 'IMG_' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS name FROM orders"
SQL["cells"] = ("SELECT flight, CAST(floor((5215000e0 - y) / 25e-2) AS INT) AS row, CAST(floor((x - 541000e0) / 25e-2) AS INT) AS col, "
                "max(z) AS dsm, count(*) AS n FROM points GROUP BY 1, 2, 3")
SQL["surface"] = ("SELECT * FROM (SELECT CAST(floor(5215000e0 - y) AS INT) AS row, CAST(floor(x - 541000e0) AS INT) AS col, min(z) AS z "
                  "FROM points GROUP BY 1, 2) WHERE (row * 40 + col) % 11 <> 0")
SQL["plots"] = ("SELECT r * 50 + c AS plot_id, CAST(r AS INT) AS r, CAST(c AS INT) AS c FROM range(40) a(r), range(50) b(c)")
SQL["pixels"] = ("SELECT flight, row, col, dsm, CAST(floor((row + 5e-1) * 25e-2 / 75e-2) AS BIGINT) * 50 + CAST(floor((col + 5e-1) * 25e-2 / 8e-1) AS BIGINT) AS plot_id FROM cells")
SQL["facts"] = ("SELECT flight, plot_id, n, m - p5 AS canopy_height_mean, h_median, h_std, h_p90, h_p95, h_max FROM (SELECT flight, plot_id, count(*) AS n, "
                "avg(dsm) AS m, quantile_cont(dsm, 5e-2) AS p5, median(dsm) AS h_median, stddev_pop(dsm) AS h_std, quantile_cont(dsm, 9e-1) AS h_p90, "
                "quantile_cont(dsm, 95e-2) AS h_p95, max(dsm) AS h_max FROM pixels GROUP BY flight, plot_id) WHERE n >= 3")
SQL["pixviews"] = ("SELECT row, col, k, w, (k + row + col) % 3 <> 0 AS gated, CAST((k * 7 + row * 3 + col) % 256 AS DOUBLE) AS c FROM (SELECT p.row, p.col, s.k, "
                   "round(pow(least(greatest(1 - sqrt((x - e) * (x - e) + (y - n) * (y - n)) / 6, 0e0), 1e0), 6e0), 9) AS w, sqrt((x - e) * (x - e) + (y - n) * (y - n)) AS dist "
                   "FROM (SELECT CAST(i // 20 AS INT) AS row, CAST(i % 20 AS INT) AS col, 541000e0 + (i % 20 + 5e-1) * 2 AS x, 5215000e0 - (i // 20 + 5e-1) * 2 AS y FROM range(300) t(i)) p, "
                   "poses s WHERE s.tilt <= 20) WHERE dist < 6")
#: A view's views, in order.
NEEDS = {"cells": ["points"], "surface": ["points"], "pixels": ["points", "cells"], "facts": ["points", "cells", "pixels"], "pixviews": ["poses"]}


def twin(body: str, *views: str) -> str:
    """SQL with the views it reads in front."""
    names: list[str] = []
    for v in views:
        names += [n for n in (*NEEDS.get(v, []), v) if n not in names]
    return (f"WITH {', '.join(f'{n} AS ({SQL[n]})' for n in names)} " if names else "") + body
