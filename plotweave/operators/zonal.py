"""Plots: grids, zonal statistics, cover and indices, growth over the season."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import bilinear, colour_indices


def plot_grid(spark: SparkSession, corners: list[tuple[float, float]], n_rows: int, n_cols: int, row_margin: float = 0.0,
              col_margin: float = 0.0, compat: bool = False) -> DataFrame:
    """``plot_id, r, c, quad`` row by row over a quadrilateral (corners: top left, top right, bottom right, bottom left).

    Margins inset both sides of a plot alike; ``compat`` measures the far side from the moved near side instead."""
    if len(corners) != 4 or any(len(p) != 2 for p in corners):
        raise ValueError("corners: four points of two coordinates")
    if n_rows < 1 or n_cols < 1 or not 0 <= row_margin < 0.5 or not 0 <= col_margin < 0.5:
        raise ValueError("rows and columns from 1, margins from 0 to below 0.5")
    far = lambda m: (1 - m * (1 - m)) if compat else 1 - m
    df = (spark.range(n_rows).select(F.col("id").cast("int").alias("r"))
          .crossJoin(spark.range(n_cols).select(F.col("id").cast("int").alias("c"))))
    u = lambda s: (F.col("c") + F.lit(s)) / n_cols
    v = lambda s: (F.col("r") + F.lit(s)) / n_rows
    us, vs = (u(col_margin), u(far(col_margin))), (v(row_margin), v(far(row_margin)))
    pts = [bilinear(corners, us[i], vs[j]) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1))]
    quad = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in pts])
    return df.select((F.col("r").cast("long") * n_cols + F.col("c")).alias("plot_id"), "r", "c", quad.alias("quad"))


def assign_ids(grid: DataFrame, design: DataFrame) -> DataFrame:
    """Row-major plots get the design's ids by position; unlike lengths are an error. Both are driver-sized layouts."""
    from pyspark.sql import Window

    n, m = grid.count(), design.count()
    if n != m:
        raise ValueError(f"{n} plots, {m} design rows")
    a = grid.withColumn("__n", F.row_number().over(Window.orderBy("r", "c")))
    b = design.select(F.col("plot_id").alias("__id"), F.row_number().over(Window.orderBy("plot_id")).alias("__n"))
    return a.join(b, "__n").withColumn("plot_id", F.col("__id")).drop("__n", "__id")


def height_stats(pixels: DataFrame, by: list[str], value: str = "dsm", min_share: float | None = None, expected: int = 0) -> DataFrame:
    """Plot heights over the fifth percentile: mean, median, population std, p90, p95, max; plots under the coverage go."""
    v = F.col(value)
    g = pixels.filter(v.isNotNull()).groupBy(*by).agg(
        F.count(v).alias("n"), F.avg(v).alias("m"), F.median(v).alias("h_median"), F.stddev_pop(v).alias("h_std"),
        F.percentile(v, F.array(F.lit(0.05), F.lit(0.9), F.lit(0.95))).alias("p"), F.max(v).alias("h_max"))
    if min_share is not None:
        g = g.filter(F.col("n") >= min_share * expected)
    return g.select(*by, "n", (F.col("m") - F.col("p")[0]).alias("canopy_height_mean"), "h_median", "h_std",
                    F.col("p")[1].alias("h_p90"), F.col("p")[2].alias("h_p95"), "h_max")


def cover_and_indices(pixels: DataFrame, by: list[str], threshold: float = 0.05, mask_alpha: bool = True, nir: str | None = None) -> DataFrame:
    """Canopy cover in percent and mean and median of each index over vegetation (ExG above the threshold).

    Transparent pixels don't count; ``mask_alpha=False`` lets them count as bare ground."""
    rows = pixels.filter("a > 0") if mask_alpha else pixels
    idx = colour_indices(nir=nir)
    rows = rows.select(*by, *[c.alias(k) for k, c in idx.items()])
    veg = F.col("ExG") > threshold
    aggs = [F.count(F.lit(1)).alias("n"), (100 * F.avg(veg.cast("int"))).alias("canopy_cover_pct")]
    for k in idx:
        aggs += [F.avg(F.when(veg, F.col(k))).alias(f"{k}_mean"), F.median(F.when(veg, F.col(k))).alias(f"{k}_median")]
    return rows.groupBy(*by).agg(*aggs)


def with_lines(facts: DataFrame, design: DataFrame) -> DataFrame:
    """Left join to the trial design; duplicate design rows fan out, missing ones give a NULL line."""
    if "plot_id" not in design.columns:
        raise ValueError("the design needs a plot_id")
    return facts.join(design, "plot_id", "left")


def growth(facts: DataFrame, value: str, all_flights: DataFrame | None = None, line: str = "line_name") -> DataFrame:
    """Mean and sample std by (line, flight); with ``all_flights`` every line has a row for each."""
    g = facts.filter(F.col(line).isNotNull()).groupBy(line, "flight").agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    if all_flights is None:
        return g
    calendar = g.select(line).distinct().crossJoin(all_flights.select("flight").distinct())
    return calendar.join(g, [line, "flight"], "left")


def datum_qc(facts: DataFrame, reference: str, legacy: str) -> DataFrame:
    """Per flight: n, mean, median, population std of the reference heights where the flight has any, else legacy ones."""
    has = facts.groupBy("flight").agg(F.bool_or(F.col(reference).isNotNull()).alias("has"))
    v = F.when(F.col("has"), F.col(reference)).otherwise(F.col(legacy))
    x = facts.join(has, "flight").withColumn("__v", v)
    return x.groupBy("flight").agg(F.count("__v").alias("n"), F.avg("__v").alias("mean"), F.median("__v").alias("median"),
                                   F.stddev_pop("__v").alias("std"))
