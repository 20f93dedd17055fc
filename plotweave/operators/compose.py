"""Compositing: best views of a pixel, seams, fallbacks, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import feather


def top_views(views: DataFrame, pixel: list[str], n: int = 2, weight: str = "w", rank: str = "k") -> DataFrame:
    """The ``n`` heaviest views of a pixel; ties keep the earlier camera, weight 0 never wins.

    Spark pushes the limit on the rank below the exchange, so a map task sends at most ``n`` views a pixel."""
    w = Window.partitionBy(*pixel).orderBy(F.desc(weight), F.asc(rank))
    return views.filter(F.col(weight) > 0).withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def best_view(views: DataFrame, pixel: list[str], weight: str = "w", rank: str = "k", keep: tuple[str, ...] = ("c",)) -> DataFrame:
    """Top one by weight as an aggregate, with partial combining."""
    take = F.struct(F.col(rank).alias(rank), *[F.col(c) for c in keep])
    return (views.filter(F.col(weight) > 0).groupBy(*pixel).agg(F.max_by(take, F.struct(F.col(weight), -F.col(rank))).alias("v"))
            .select(*pixel, "v.*"))


def composite(views: DataFrame, pixel: list[str]) -> DataFrame:
    """Feathered colour of a pixel from gated views ``(k, w, gated, c)``, else of the best ungated one."""
    top = top_views(views.filter("gated"), pixel)
    two = top.groupBy(*pixel).agg(*[F.max(F.when(F.col("place") == p, F.col(x))).alias(f"{x}{p}") for p in (1, 2) for x in ("w", "c")])
    a2 = F.when(F.col("w2").isNotNull(), feather("w1", "w2")).otherwise(0.0)
    blend = F.when(F.col("c2").isNotNull(), F.col("c1") * (1 - a2) + F.col("c2") * a2).otherwise(F.col("c1"))
    two = two.select(*pixel, blend.alias("blend"))
    fallback = best_view(views, pixel).select(*pixel, F.col("c").alias("fallback"))
    both = fallback.join(two, pixel, "left")
    return both.select(*pixel, F.coalesce("blend", "fallback").alias("colour"), F.col("blend").isNull().alias("is_fallback"))


def depth_gate(sampled: str, expected: str, tolerance: float) -> Column:
    """No depth map (NULL) passes; a depth of 0 is no measurement and fails."""
    s = F.col(sampled)
    return F.when(s.isNull(), True).otherwise((s > 0) & (F.abs(s - F.col(expected)) <= F.lit(tolerance)))


def alpha(near: Column, painted: Column) -> Column:
    return F.when(near & painted, 255).otherwise(0)


def sample_photo(points: DataFrame, pixels: DataFrame, by: tuple[str, ...] = (), values: tuple[str, ...] = ("c",)) -> DataFrame:
    """Bilinear photo colours at ``u`` (column) and ``v`` (row) of ``points``; a neighbour outside the photo counts as 0.

    Four equi-joins' worth in one: each point asks for its neighbours of weight above 0, which are summed by ``k``."""
    u, v = F.floor("u"), F.floor("v")
    du, dv = F.col("u") - u, F.col("v") - v
    four = F.array(*[F.struct((v + i).cast("int").alias("row"), (u + j).cast("int").alias("col"), ((dv if i else 1 - dv) * (du if j else 1 - du)).alias("w"))
                     for i in (0, 1) for j in (0, 1)])
    asked = points.select("k", *by, F.explode(F.filter(four, lambda s: s["w"] > 0)).alias("s")).select("k", *by, "s.*")
    got = asked.join(pixels.select(*by, "row", "col", *values), [*by, "row", "col"], "left")
    return got.groupBy("k", *by).agg(*[F.sum(F.col("w") * F.coalesce(c, F.lit(0.0))).alias(c) for c in values])
