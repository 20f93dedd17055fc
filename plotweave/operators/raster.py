"""Raster operators over (row, col, value) tables: windows, neighbourhoods, thresholds, blobs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cell_max(points: DataFrame, by: tuple[str, ...], z: str = "z", out: str = "dsm") -> DataFrame:
    return points.groupBy(*by, "row", "col").agg(F.max(z).alias(out))


def dense(raster: DataFrame, value: str, by: tuple[str, ...] = (), fill: bool = False) -> DataFrame:
    """Every cell of each raster's extent; absent cells NULL, or the raster's minimum with ``fill``."""
    ext = raster.groupBy(*by).agg(F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"),
                                  F.max("col").alias("c1"), F.min(value).alias("__least"))
    full = (ext.withColumn("row", F.explode(F.sequence("r0", "r1"))).withColumn("col", F.explode(F.sequence("c0", "c1")))
            .select(*by, "row", "col", "__least"))
    out = full.join(raster.select(*by, "row", "col", F.col(value)), [*by, "row", "col"], "left")
    return out.withColumn(value, F.coalesce(value, "__least") if fill else F.col(value)).drop("__least")


def _slide(df: DataFrame, value: str, out: str, by, fn, axis: str, before: int, after: int) -> DataFrame:
    other = "row" if axis == "col" else "col"
    w = Window.partitionBy(*by, other).orderBy(axis).rangeBetween(-before, after)
    return df.withColumn(out, fn(value).over(w))


def grey_opening(raster: DataFrame, value: str, size: int, by: tuple[str, ...] = (), out: str = "dtm") -> DataFrame:
    """Erosion, then dilation with a ``size`` x ``size`` square, holes filled with the minimum first.

    Separable: four sliding windows, one task a raster line, none a raster. An even window reaches one cell further back
    in the erosion and forth in the dilation."""
    df = dense(raster, value, by, fill=True).withColumn(out, F.col(value))
    b, a = size // 2, (size - 1) // 2
    for fn, before, after in ((F.min, b, a), (F.max, a, b)):
        for axis in ("col", "row"):
            df = _slide(df, out, out, by, fn, axis, before, after)
    return df


def local_std(raster: DataFrame, value: str, reach: int = 2, by: tuple[str, ...] = (), least: int = 3) -> DataFrame:
    """Mean and standard deviation of the cells present within ``reach``, by two separable passes of sums over the dense extent.

    Result: the raster's own cells; NULL with fewer than ``least`` cells: a hole never spreads beyond its neighbours."""
    df = dense(raster, value, by).withColumn("__n", F.when(F.col(value).isNotNull(), 1).otherwise(0)).withColumn("__s", F.coalesce(value, F.lit(0.0)))
    df = df.withColumn("__q", F.col("__s") * F.col("__s"))
    for axis in ("col", "row"):
        for c in ("__n", "__s", "__q"):
            df = _slide(df, c, c + "2", by, F.sum, axis, reach, reach)
        df = df.drop("__n", "__s", "__q").withColumnsRenamed({f"{c}2": c for c in ("__n", "__s", "__q")})
    mean = F.col("__s") / F.col("__n")
    ok = F.col("__n") >= least
    return (df.filter(F.col(value).isNotNull()).withColumn("local_mean", F.when(ok, mean))
            .withColumn("local_std", F.when(ok, F.sqrt(F.greatest(F.col("__q") / F.col("__n") - mean * mean, F.lit(0.0)))))
            .drop("__n", "__s", "__q"))


def gaussian(raster: DataFrame, value: str, sigma: float, by: tuple[str, ...] = (), out: str = "smooth") -> DataFrame:
    """Two one-dimensional passes with a kernel cut at four sigma, normalised over the cells that are there.

    Cells are sent to their neighbours and summed, so a pass is one shuffle however wide the raster."""
    reach = max(1, int(4 * sigma + 0.5))
    kernel = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(math.exp(-d * d / (2 * sigma * sigma))).alias("w")) for d in range(-reach, reach + 1)])
    df = raster.select(*by, "row", "col", F.col(value).alias(out))
    there = raster.select(*by, "row", "col")
    for axis in ("col", "row"):
        other = "row" if axis == "col" else "col"
        sent = df.filter(F.col(out).isNotNull()).withColumn("k", F.explode(kernel))
        sent = sent.select(*by, other, (F.col(axis) + F.col("k.d")).alias(axis), (F.col(out) * F.col("k.w")).alias("s"), F.col("k.w").alias("w"))
        df = (sent.groupBy(*by, "row", "col").agg((F.sum("s") / F.sum("w")).alias(out))
              .join(there, [*by, "row", "col"], "left_semi"))
    return df


def dilate(mask: DataFrame, reach: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Cells within ``reach`` steps along rows and columns of a cell of the mask."""
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-reach, reach + 1)
                        for j in range(-reach + abs(i), reach - abs(i) + 1)])
    return (mask.select(*by, "row", "col", F.explode(offsets).alias("o"))
            .select(*by, (F.col("row") + F.col("o.i")).alias("row"), (F.col("col") + F.col("o.j")).alias("col")).distinct())


def near(mask: DataFrame, cells: DataFrame, reach: float, by: tuple[str, ...] = ()) -> DataFrame:
    """Cells within the Euclidean distance ``reach`` (in cells) of a cell of the mask."""
    n = int(reach)
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-n, n + 1) for j in range(-n, n + 1)
                        if i * i + j * j <= reach * reach])
    zone = (mask.select(*by, "row", "col", F.explode(offsets).alias("o"))
            .select(*by, (F.col("row") + F.col("o.i")).alias("row"), (F.col("col") + F.col("o.j")).alias("col")).distinct())
    return cells.join(zone, [*by, "row", "col"], "left_semi")


def nearest_fill(raster: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Holes take the value of the Euclidean nearest cell; ties go to the smaller row, then column.

    Pass one finds each cell's nearest filled cell within its row by windows; pass two walks each column once over the
    lower envelope of these distances, so a raster takes work linear in its cells and a task holds one column."""
    df = dense(raster, value, by)
    row = Window.partitionBy(*by, "row").orderBy("col")
    back = F.last(F.when(F.col(value).isNotNull(), F.struct("col", value)), ignorenulls=True).over(row.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(F.when(F.col(value).isNotNull(), F.struct("col", value)), ignorenulls=True).over(row.rowsBetween(0, Window.unboundedFollowing))
    df = df.withColumn("b", back).withColumn("a", ahead)
    db, da = F.col("col") - F.col("b.col"), F.col("a.col") - F.col("col")
    pick_b = F.col("a").isNull() | (F.col("b").isNotNull() & (db <= da))
    df = df.select(*by, "row", "col", F.when(pick_b, db).otherwise(da).alias("dx"), F.when(pick_b, F.col(f"b.{value}")).otherwise(F.col(f"a.{value}")).alias(value))
    schema = df.drop("dx").schema

    def column(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row").reset_index(drop=True)
        pdf[value] = pdf[value].to_numpy()[envelope(pdf["row"].to_numpy(), pdf["dx"].to_numpy("f8"))] if pdf["dx"].notna().any() else None
        return pdf.drop(columns="dx")

    return df.groupBy(*by, "col").applyInPandas(column, schema)


def envelope(rows: np.ndarray, dx: np.ndarray) -> np.ndarray:
    """For each of rising ``rows`` the index of the one with the least (r - row)^2 + dx^2, the first of equals; NaN never wins."""
    hull: list[tuple[int, int]] = []  # (index, first row at which it is the nearest)
    for k in np.flatnonzero(~np.isnan(dx)).tolist():
        r, h = int(rows[k]), int(dx[k]) ** 2 + int(rows[k]) ** 2
        while hull:
            j, start = hull[-1]
            rj = int(rows[j])
            # beyond this row k is strictly nearer than j
            since = (h - int(dx[j]) ** 2 - rj * rj) // (2 * (r - rj)) + 1
            if since > start:
                break
            hull.pop()
        else:
            since = int(rows[0])
        hull.append((k, since))
    starts = np.array([s for _, s in hull])
    return np.array([k for k, _ in hull])[np.searchsorted(starts, rows, side="right") - 1]


def otsu(values: DataFrame, value: str, by: tuple[str, ...] = (), bins: int = 256) -> DataFrame:
    """Threshold of the largest between-class variance: the left edge of the first best bin.

    One aggregation for the range, one to bins; the running sums go over the bins only."""
    ext = values.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    joined = values.join(ext, list(by)) if by else values.crossJoin(F.broadcast(ext))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(width > 0, F.least(F.floor((F.col(value) - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    hist = joined.filter(F.col(value).isNotNull()).groupBy(*by, "lo", "hi", b.cast("int").alias("bin")).count()
    run = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*by)
    width = (F.col("hi") - F.col("lo")) / bins
    centre = F.col("lo") + (F.col("bin") + 0.5) * width
    h = (hist.withColumn("n", F.sum("count").over(every)).withColumn("w", F.sum("count").over(run) / F.col("n"))
         .withColumn("m", F.sum(F.col("count") * centre).over(run) / F.col("n")).withColumn("mt", F.sum(F.col("count") * centre).over(every) / F.col("n")))
    var = F.round((F.col("mt") * F.col("w") - F.col("m")) ** 2 / (F.col("w") * (1 - F.col("w"))), 9)
    h = h.filter("w > 0 AND w < 1").withColumn("between_var", var)
    return h.groupBy(*by).agg(F.max_by(F.col("lo") + F.col("bin") * width, F.struct("between_var", -F.col("bin"))).alias("threshold"))


def blobs(mask: DataFrame, by: tuple[str, ...] = (), max_rounds: int = 200) -> DataFrame:
    """4-connected components: each cell of the mask with its ``blob`` (the smallest cell number) and ``size``.

    Labels first fall to the start of their run within a row (a window), so rounds follow the shape, not the width."""
    key = F.col("row").cast("long") * (1 << 31) + F.col("col")
    run_w = Window.partitionBy(*by, "row").orderBy("col")
    cells = mask.select(*by, "row", "col").distinct().withColumn("g", F.col("col") - F.row_number().over(run_w))
    cells = cells.withColumn("run", F.min(key).over(Window.partitionBy(*by, "row", "g"))).select(*by, "row", "col", "run").checkpoint()
    down = cells.select(*by, (F.col("row") + 1).alias("row"), "col", F.col("run").alias("up"))
    links = cells.join(down, [*by, "row", "col"]).select(*by, "run", "up").distinct()
    links = links.union(links.select(*by, F.col("up").alias("run"), F.col("run").alias("up"))).checkpoint()
    labels = cells.select(*by, "run").distinct().withColumn("blob", F.col("run"))
    for _ in range(max_rounds):
        told = links.join(labels.select(*by, F.col("run").alias("up"), "blob"), [*by, "up"]).select(*by, "run", "blob")
        least = told.union(labels.select(*by, "run", "blob")).groupBy(*by, "run").agg(F.min("blob").alias("blob"))
        # pointer jumping: a label's own label may be smaller still
        jump = least.select(*by, F.col("run").alias("blob"), F.col("blob").alias("next"))
        then = (least.join(jump, [*by, "blob"], "left").select(*by, "run", F.coalesce("next", "blob").alias("blob"))).checkpoint()
        changed = then.join(labels.withColumnRenamed("blob", "old"), [*by, "run"]).filter("blob <> old").limit(1).count()
        labels = then
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    out = cells.join(labels, [*by, "run"]).drop("run")
    return out.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy(*by, "blob")))


def mosaic_first(surfaces: DataFrame, order: str, value: str = "dsm") -> DataFrame:
    """``row, col, z, hits``: each cell's value on the first surface that has it, and on how many it is."""
    return surfaces.groupBy("row", "col").agg(F.min_by(value, order).alias("z"), F.count(F.lit(1)).alias("hits"))


def resize(raster: DataFrame, value: str, factor: int = 2) -> DataFrame:
    """``row, col, area, nearest``: the mean of ``factor`` x ``factor`` cells, and the value of their first."""
    cut = lambda c: F.floor(F.col(c) / factor)
    corner = (F.col("row") % factor == 0) & (F.col("col") % factor == 0)
    return (raster.groupBy(cut("row").alias("row"), cut("col").alias("col"))
            .agg(F.avg(value).alias("area"), F.max(F.when(corner, F.col(value))).alias("nearest")))


def crosscheck(surfaces: DataFrame, by: str = "flight", value: str = "dsm") -> DataFrame:
    """``fa, fb, n, diff``: median difference of each two surfaces over the cells that both have."""
    c = surfaces.select(F.col(by).alias("fa"), "row", "col", F.col(value).alias("__a"))
    b = surfaces.select(F.col(by).alias("fb"), "row", "col", F.col(value).alias("__b"))
    x = c.join(b, ["row", "col"]).filter("fa < fb")
    return x.groupBy("fa", "fb").agg(F.count(F.lit(1)).alias("n"), F.median(F.col("__a") - F.col("__b")).alias("diff"))


def shares(cells: DataFrame, by: str, total: int, hits: str = "n", value: str = "dsm") -> DataFrame:
    """Of ``total`` cells: ``hit`` and ``single`` (one observation only), and the surface's ``relief``."""
    return cells.groupBy(by).agg((F.count(F.lit(1)) / total).alias("hit"), (F.count_if(F.col(hits) == 1) / total).alias("single"), (F.max(value) - F.min(value)).alias("relief"))


def extent(points: DataFrame, by: str) -> DataFrame:
    return points.groupBy(by).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), (F.max("z") - F.min("z")).alias("ptp_z"))


def canvas(points: DataFrame, by: str, cell: float, margin: float) -> DataFrame:
    """``w, h, x0, y1``: size in cells and origin of a raster over the points and a margin."""
    cut = lambda c: ((F.max(c) - F.min(c) + 2 * margin) / cell).cast("int")
    return points.groupBy(by).agg(cut("x").alias("w"), cut("y").alias("h"), (F.min("x") - margin).alias("x0"), (F.max("y") + margin).alias("y1"))


def tile_stats(cells: DataFrame, value: str, tile: int) -> DataFrame:
    t = lambda c: F.floor(F.col(c) / tile)
    return cells.groupBy(t("row").alias("tile_row"), t("col").alias("tile_col")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), (F.max(value) - F.min(value)).alias("relief"))


def carry_forward(flights: DataFrame, value: str, good, field: str = "field", order: str = "flight") -> DataFrame:
    """``off``: the last value of a good flight of the field, the flight itself included."""
    w = Window.partitionBy(field).orderBy(order)
    return flights.withColumn("off", F.last(F.when(good, F.col(value)), ignorenulls=True).over(w))
