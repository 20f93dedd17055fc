"""Point clouds and surfaces: gates, trims, ground seeds and masks, with their thresholds as parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quantiles(df: DataFrame, columns: list[str], shares: list[float], bins: int = 1024, most: int = 100_000) -> dict[str, list[float | None]]:
    """Exact percentiles, linear between ranks as ``F.percentile``, in bounded memory: histograms by range find the bins
    that hold the wanted ranks, the next round looks into these bins only, until at most ``most`` distinct values are left
    to sort. A round is one aggregation of at most ``bins`` counts a rank and task; NULLs are left out."""
    ext = df.agg(*[f(c).alias(f"{k}_{c}") for c in columns for k, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]).first()
    wanted = {}  # (column, rank): [low, high, rows below low]
    places = {c: [s * (ext[f"n_{c}"] - 1) for s in shares] for c in columns if ext[f"n_{c}"]}
    for c, at in places.items():
        for rank in {r for p in at for r in (int(p), min(int(p) + 1, ext[f"n_{c}"] - 1))}:
            wanted[c, rank] = [float(ext[f"lo_{c}"]), float(ext[f"hi_{c}"]), 0]
    found: dict[tuple[str, int], float] = {k: v[0] for k, v in wanted.items() if v[0] == v[1]}
    while open_ := [k for k in wanted if k not in found]:
        cells = sorted({(c, *wanted[c, r][:2]) for c, r in open_})
        told = F.array(*[F.when((F.col(c) >= lo) & (F.col(c) <= hi),
                                F.struct(F.lit(k).alias("k"), F.least(F.floor((F.col(c) - lo) / ((hi - lo) / bins)), F.lit(bins - 1)).cast("int").alias("bin"), F.col(c).cast("double").alias("v")))
                         for k, (c, lo, hi) in enumerate(cells)])
        hist = (df.select(F.explode(F.array_compact(told)).alias("t")).groupBy("t.k", "t.bin")
                .agg(F.count(F.lit(1)).alias("n"), F.min("t.v").alias("lo"), F.max("t.v").alias("hi")).collect())  # bins only
        by_cell: dict[int, list] = {}
        for r in hist:
            by_cell.setdefault(r["k"], []).append((r["bin"], r["n"], r["lo"], r["hi"]))
        for c, rank in open_:
            low, high, below = wanted[c, rank]
            for _, n, lo, hi in sorted(by_cell[cells.index((c, low, high))]):
                if below + n > rank:
                    wanted[c, rank] = [lo, hi, below]
                    if lo == hi or (low, high) == (lo, hi):
                        found[c, rank] = lo
                    elif n <= most:
                        rows = df.filter(F.col(c).between(lo, hi)).select(F.col(c).cast("double")).collect()  # at most ``most``
                        found[c, rank] = sorted(x[0] for x in rows)[rank - below]
                    break
                below += n
    out: dict[str, list[float | None]] = {c: [None] * len(shares) for c in columns}
    for c, at in places.items():
        for k, p in enumerate(at):
            a, b = found[c, int(p)], found[c, min(int(p) + 1, ext[f"n_{c}"] - 1)]
            out[c][k] = a + (p - int(p)) * (b - a)
    return out


def z_gate(points: DataFrame, poses: DataFrame, below: float, above: float, z: str = "z") -> DataFrame:
    """Points from ``below`` under the median height up to ``above`` under the lowest camera."""
    low = quantiles(points, [z], [0.5])[z][0]
    top = poses.agg(F.min(z)).first()[0]
    if low is None or top is None:
        return points.limit(0)
    return points.filter(F.col(z).between(low - below, top - above))


def iqr_trim(points: DataFrame, columns: tuple[str, ...] = ("x", "y"), factor: float = 0.3) -> DataFrame:
    """Points within the quartiles of every column, widened by ``factor`` times their distance; all quartiles come before
    any trim."""
    q = quantiles(points, list(columns), [0.25, 0.75])
    for c in columns:
        lo, hi = q[c]
        if lo is not None:
            points = points.filter(F.col(c).between(lo - factor * (hi - lo), hi + factor * (hi - lo)))
    return points


def splat(points: DataFrame, bounds: tuple[float, float, float, float], heights: tuple[float, float], cell: float) -> DataFrame:
    """``row, col, z, n``: highest point and hits of the cells of ``bounds`` (x0, y0, x1, y1)."""
    from ..functions.numeric import grid_cell

    x0, y0, x1, y1 = bounds
    inside = (F.col("x") >= x0) & (F.col("x") < x1) & (F.col("y") > y0) & (F.col("y") <= y1) & F.col("z").between(*heights)
    row, col = grid_cell("x", "y", x0, y1, cell)
    return points.filter(inside).groupBy(row.alias("row"), col.alias("col")).agg(F.max("z").alias("z"), F.count(F.lit(1)).alias("n"))


def cell_seeds(surface: DataFrame, value: str = "dsm", cell_px: int = 8, least: int = 30, share: float = 0.15, rough: float = 0.35) -> DataFrame:
    """``br, bc, n, seed``: a low percentile of each square of ``cell_px`` pixels with enough of them and quartiles at most
    ``rough`` apart. A square has cell_px x cell_px pixels a raster, which bounds the percentile's memory."""
    p = F.percentile(value, F.array(F.lit(share), F.lit(0.25), F.lit(0.75)))
    g = (surface.filter(F.col(value).isNotNull())
         .groupBy(F.floor(F.col("row") / cell_px).alias("br"), F.floor(F.col("col") / cell_px).alias("bc")).agg(F.count(F.lit(1)).alias("n"), p.alias("p")))
    return g.filter((F.col("n") >= least) & (F.col("p")[2] - F.col("p")[1] <= rough)).select("br", "bc", "n", F.col("p")[0].alias("seed"))


def bare_ground(pixels: DataFrame, outside_plots: Column, outside_canopy: Column, deviation: Column, low: float = -0.25, high: float = 0.12) -> DataFrame:
    """``outside`` and ``bare`` added: off the plots, off the canopy's margin, and about as high as the seed surface."""
    return pixels.withColumn("outside", outside_canopy).withColumn("bare", F.coalesce(outside_plots & outside_canopy & deviation.between(low, high), F.lit(False)))


def base_ground(pixels: DataFrame, inside_plots: Column, most: float, value: str = "dsm") -> DataFrame:
    """``row, col, z``: lowest bare pixel, and in the plots the first flight's, where it is below ``most``. ``pixels`` come from
    ``bare_ground`` with their ``flight``."""
    first = pixels.agg(F.min("flight")).first()[0]
    keep = F.col("bare") | ((F.col("flight") == F.lit(first)) & inside_plots & (F.col(value) < most))
    return pixels.filter(keep).groupBy("row", "col").agg(F.min(value).alias("z"))
