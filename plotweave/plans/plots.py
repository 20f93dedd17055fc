"""Plot queries: grids, zonal heights, cover, growth, quality of the datum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import bilinear, cell_centre, colour_indices, r6
from ..operators import raster, zonal
from ..operators.catalog import pick_column
from ..operators.joins import points_in_quads
from .registering import query
from .views import CELL, CORNERS, N_COLS, N_ROWS, X0, Y0, cells, read, view


def grid(spark) -> DataFrame:
    return zonal.plot_grid(spark, CORNERS, N_ROWS, N_COLS)


def plot_pixels(spark, d) -> DataFrame:
    x, y = cell_centre("row", "col", X0, Y0, CELL)
    px = cells(spark, d).select("flight", "row", "col", "dsm", x.alias("x"), y.alias("y"))
    return points_in_quads(px, F.broadcast(grid(spark).select("plot_id", "quad")), 1.0)  # a layout of 2,000 plots


def facts(spark, d) -> DataFrame:
    return zonal.height_stats(plot_pixels(spark, d), ["flight", "plot_id"], min_share=0.3, expected=10)


def rounded(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes if not keep or c in keep])


_FACT = ", ".join(f"round({c}, 6) AS {c}" for c in ("canopy_height_mean", "h_median", "h_std", "h_p90", "h_p95", "h_max"))


@query("""SELECT line_name, flight, count(*) AS n_plots, round(avg(canopy_height_mean), 6) AS mean, round(stddev_samp(canopy_height_mean), 6) AS std
FROM facts JOIN design USING (plot_id) GROUP BY line_name, flight""", "facts", "design")
def entry_plot_growth(spark, d):
    x = zonal.with_lines(facts(spark, d), view(spark, d, "design")).filter("line_name IS NOT NULL")
    return x.groupBy("line_name", "flight").agg(F.count(F.lit(1)).alias("n_plots"), r6(F.avg("canopy_height_mean")).alias("mean"),
                                                r6(F.stddev_samp("canopy_height_mean")).alias("std"))


@query(f"SELECT flight, plot_id, n, {_FACT} FROM facts", "facts")
def plot_height_stats(spark, d):
    return rounded(facts(spark, d))


_IDX = {"ExG": "2 * (g / t) - r / t - b / t", "NGRDI": "(g - r) / (g + r + 1e-6)", "VARI": "(g - r) / nullif(g + r - b + 1e-6, 0)",
        "GLI": "(2 * g - r - b) / (2 * g + r + b + 1e-6)"}


@query(f"""SELECT plot_id, count(*) AS n, round(100 * avg(CASE WHEN ExG > 5e-2 THEN 1 ELSE 0 END), 6) AS canopy_cover_pct,
{', '.join(f'round(avg({k}) FILTER (WHERE ExG > 5e-2), 6) AS {k}_mean, round(median({k}) FILTER (WHERE ExG > 5e-2), 6) AS {k}_median' for k in _IDX)}
FROM (SELECT plot_id, {', '.join(f'{v} AS {k}' for k, v in _IDX.items())} FROM (SELECT CAST(floor((5215000e0 - y) / 75e-2) AS BIGINT) * 50 + CAST(floor((x - 541000e0) / 8e-1) AS BIGINT) AS plot_id,
CAST(r AS DOUBLE) AS r, CAST(g AS DOUBLE) AS g, CAST(b AS DOUBLE) AS b, CAST(r AS DOUBLE) + g + b + 1e-6 AS t FROM rgb WHERE a > 0)) GROUP BY plot_id""", "rgb")
def plot_cover_index(spark, d):
    px = view(spark, d, "rgb").withColumn(
        "plot_id", F.floor((F.lit(Y0) - F.col("y")) / 0.75) * 50 + F.floor((F.col("x") - F.lit(X0)) / 0.8))
    return rounded(zonal.cover_and_indices(px, ["plot_id"]))


@query("""SELECT flight, count(v) AS n, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(stddev_pop(v), 6) AS std
FROM (SELECT flight, CASE WHEN flight >= '1995' THEN CASE WHEN plot_id % 3 = 0 THEN h_p95 - 430 END ELSE canopy_height_mean END AS v FROM facts) GROUP BY flight""", "facts")
def datum_qc(spark, d):
    x = facts(spark, d).withColumn("ref", F.when((F.col("flight") >= "1995") & (F.col("plot_id") % 3 == 0), F.col("h_p95") - 430))
    return rounded(zonal.datum_qc(x, "ref", "canopy_height_mean"))


@query("""SELECT l.line_name, f.flight, round(g.mean, 6) AS mean, round(g.std, 6) AS std FROM
(SELECT DISTINCT line_name FROM facts JOIN design USING (plot_id)) l CROSS JOIN (SELECT DISTINCT flight FROM facts) f LEFT JOIN
(SELECT line_name, flight, avg(h_p90) AS mean, stddev_samp(h_p90) AS std FROM facts JOIN design USING (plot_id) GROUP BY 1, 2) g
ON g.line_name = l.line_name AND g.flight = f.flight""", "facts", "design")
def growth_calendar(spark, d):
    every = zonal.with_lines(facts(spark, d), view(spark, d, "design"))
    some = every.filter("line_name IS NOT NULL")
    g = zonal.growth(some, "h_p90")
    calendar = some.select("line_name").distinct().crossJoin(every.select("flight").distinct())  # lines x flights
    return rounded(calendar.join(g, ["line_name", "flight"], "left"))


@query("SELECT plot_id, r, c, round(541000e0 + c * 8e-1, 6) AS left_x, round(5215000e0 - r * 75e-2, 6) AS top_y, round(541000e0 + (c + 1) * 8e-1, 6) AS right_x, round(5215000e0 - (r + 1) * 75e-2, 6) AS bottom_y FROM plots", "plots")
def bilinear_grid(spark, d):
    q = grid(spark)
    at = lambda k, c: r6(F.get("quad", F.lit(k))[c])
    return q.select("plot_id", "r", "c", at(0, "x").alias("left_x"), at(0, "y").alias("top_y"), at(2, "x").alias("right_x"), at(2, "y").alias("bottom_y"))


@query("SELECT flight, row, col, plot_id FROM pixels", "pixels")
def rasterize_plots(spark, d):
    return plot_pixels(spark, d).select("flight", "row", "col", "plot_id")


@query("""SELECT p.plot_id, count(x.plot_id) AS n, round(count(x.plot_id) / (SELECT CAST(count(*) AS DOUBLE) FROM pixels), 9) AS share
FROM plots p LEFT JOIN pixels x ON x.plot_id = p.plot_id GROUP BY p.plot_id HAVING count(x.plot_id) > 0""", "pixels", "plots")
def plot_pixel_counts(spark, d):
    g = plot_pixels(spark, d).groupBy("plot_id").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over one row a plot
    return g.select("plot_id", "n", F.round(F.col("n") / total, 9).alias("share"))


@query("SELECT row // 32 AS tile_row, col // 32 AS tile_col, count(*) AS n, round(avg(dsm), 6) AS mean, round(max(dsm) - min(dsm), 6) AS relief FROM cells GROUP BY 1, 2", "cells")
def tile_stats(spark, d):
    return raster.tile_stats(cells(spark, d), "dsm", 32).select("tile_row", "tile_col", "n", r6("mean").alias("mean"), r6("relief").alias("relief"))


@query("SELECT g.plot_id AS grid_id, n.id AS plot_id FROM (SELECT plot_id, row_number() OVER (ORDER BY r, c) AS k FROM plots) g JOIN (SELECT 7 * plot_id + 3 AS id, row_number() OVER (ORDER BY plot_id) AS k FROM plots) n USING (k)", "plots")
def assign_ids(spark, d):
    """All plots of the layout get the ids of a design of equal length, by place."""
    g = grid(spark).withColumn("grid_id", F.col("plot_id"))
    return zonal.assign_ids(g, grid(spark).select((7 * F.col("plot_id") + 3).alias("plot_id"))).select("grid_id", "plot_id")


@query("SELECT p.plot_id, f.flight, round(f.h_max, 6) AS v FROM plots p LEFT JOIN facts f USING (plot_id)", "facts", "plots")
def plot_values(spark, d):
    return grid(spark).select("plot_id").join(facts(spark, d).select("plot_id", "flight", r6("h_max").alias("v")), "plot_id", "left")


@query("SELECT flight, plot_id, round(h_max, 6) AS h_max FROM facts ORDER BY plot_id, flight", "facts")
def sorted_results(spark, d):
    return rounded(facts(spark, d), "flight", "plot_id", "h_max").orderBy("plot_id", "flight")


@query("SELECT 'VARI' AS chosen, count(VARI) AS n, round(avg(VARI), 6) AS mean FROM (SELECT (g - r) / (g + r - b + 1e-6) AS VARI FROM (SELECT CAST(r AS DOUBLE) AS r, CAST(g AS DOUBLE) AS g, CAST(b AS DOUBLE) AS b FROM rgb))", "rgb")
def pick_columns(spark, d):
    idx = colour_indices()
    x = view(spark, d, "rgb").select(F.lit(None).cast("double").alias("NDVI"), F.lit(None).cast("double").alias("ExG"), idx["VARI"].alias("VARI"))
    c = pick_column(x, ["NDVI", "ExG", "NGRDI", "VARI", "GLI"])
    return x.agg(F.lit(c).alias("chosen"), F.count(c).alias("n"), r6(F.avg(c)).alias("mean"))


@query("""SELECT flight, round(quantile_cont(h_p95, 2e-2), 6) AS low, round(quantile_cont(h_p95, 98e-2), 6) AS high FROM facts GROUP BY flight
UNION ALL SELECT 'all', round(quantile_cont(h_p95, 2e-2), 6), round(quantile_cont(h_p95, 98e-2), 6) FROM facts""", "facts")
def color_limits(spark, d):
    x = facts(spark, d)
    p = F.percentile("h_p95", F.array(F.lit(0.02), F.lit(0.98)))
    return (x.rollup("flight").agg(p.alias("p")).select(F.coalesce("flight", F.lit("all")).alias("flight"), r6(F.col("p")[0]).alias("low"), r6(F.col("p")[1]).alias("high")))


@query("""SELECT i AS k, round((1 - u) * (1 - v) * 10 + u * (1 - v) * 30 + u * v * 34 + (1 - u) * v * 8, 6) AS x, round((1 - u) * (1 - v) * 50 + u * (1 - v) * 52 + u * v * 20 + (1 - u) * v * 18, 6) AS y
FROM (SELECT p_partkey AS i, (p_partkey % 11) / 1e1 AS u, (p_size % 7) / 6e0 AS v FROM part)""")
def world_points(spark, d):
    x, y = bilinear([(10, 50), (30, 52), (34, 20), (8, 18)], F.col("u"), F.col("v"))
    p = read(spark, d, "part").selectExpr("p_partkey AS k", "(p_partkey % 11) / 1e1 AS u", "(p_size % 7) / 6e0 AS v")
    return p.select("k", r6(x).alias("x"), r6(y).alias("y"))
