"""Joins without an equality: bucketed bands, points in quadrilaterals, raster alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def band_pairs(df: DataFrame, key: str, dims: list[tuple[str, float]], by: tuple[str, ...] = ()) -> DataFrame:
    """Pairs ``a < b`` (by ``key``) of rows nearer than each threshold in each dimension.

    Each row is dealt to the bucket of its own cell; its partner copy goes to the neighbouring cells as well, so the
    theta join becomes an equi-join on cells with the exact test left over. Extra columns come as ``a_*`` and ``b_*``."""
    own = [F.floor(F.col(c) / F.lit(t)).cast("long") for c, t in dims]
    left = df.select(*[F.col(c).alias(f"a_{c}") for c in df.columns], *[b.alias(f"__c{k}") for k, b in enumerate(own)])
    right = df.select(*[F.col(c).alias(f"b_{c}") for c in df.columns], *[b.alias(f"__c{k}") for k, b in enumerate(own)])
    for k in range(len(dims)):
        right = right.withColumn(f"__c{k}", F.explode(F.array(*[F.col(f"__c{k}") + d for d in (-1, 0, 1)])))
    cond = [F.col(f"a_{key}") < F.col(f"b_{key}")]
    cond += [F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) < F.lit(t) for c, t in dims]
    eq = [left[f"__c{k}"] == right[f"__c{k}"] for k in range(len(dims))] + [F.col(f"a_{c}") == F.col(f"b_{c}") for c in by]
    on = eq[0]
    for e in eq[1:] + cond:
        on = on & e
    return left.join(right, on).drop(*[f"__c{k}" for k in range(len(dims))])


def band_pairs_theta(df: DataFrame, key: str, dims: list[tuple[str, float]], by: tuple[str, ...] = ()) -> DataFrame:
    """The same pairs by nested loops: what the bucketed plan is tested against."""
    a = df.select(*[F.col(c).alias(f"a_{c}") for c in df.columns])
    b = df.select(*[F.col(c).alias(f"b_{c}") for c in df.columns])
    on = F.col(f"a_{key}") < F.col(f"b_{key}")
    for c, t in dims:
        on = on & (F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) < F.lit(t))
    for c in by:
        on = on & (F.col(f"a_{c}") == F.col(f"b_{c}"))
    return a.join(b, on)


def within_radius(points: DataFrame, centres: DataFrame, cell: float) -> DataFrame:
    """Points (x, y) and centres (cx, cy, radius) closer than the centre's own radius; ``cell`` is any bucket size."""
    reach = F.col("radius")
    span = lambda c: F.sequence(F.floor((F.col(c) - reach) / cell).cast("long"), F.floor((F.col(c) + reach) / cell).cast("long"))
    dealt = centres.withColumn("__i", F.explode(span("cx"))).withColumn("__j", F.explode(span("cy")))
    at = points.withColumn("__i", F.floor(F.col("x") / cell).cast("long")).withColumn("__j", F.floor(F.col("y") / cell).cast("long"))
    d = F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy"))
    return at.join(dealt, ["__i", "__j"]).filter(d < reach).withColumn("distance", d).drop("__i", "__j")


def points_in_quads(points: DataFrame, quads: DataFrame, cell: float) -> DataFrame:
    """Points (x, y) with the convex quads (``quad``: array of 4 struct<x,y>) they lie in.

    An edge belongs to the quad where it is the top or left one (half-open, so neighbours never share a point). Quads are
    dealt to the cells their bounding boxes meet, points to their own, then four half-plane tests decide."""
    low = lambda c: F.floor(F.array_min(F.transform("quad", lambda p: p[c])) / cell).cast("long")
    high = lambda c: F.floor(F.array_max(F.transform("quad", lambda p: p[c])) / cell).cast("long")
    dealt = (quads.withColumn("__i", F.explode(F.sequence(low("x"), high("x"))))
             .withColumn("__j", F.explode(F.sequence(low("y"), high("y")))))
    at = points.withColumn("__i", F.floor(F.col("x") / cell).cast("long")).withColumn("__j", F.floor(F.col("y") / cell).cast("long"))

    def side(k: int) -> Column:
        a, b = F.get("quad", F.lit(k)), F.get("quad", F.lit((k + 1) % 4))
        cross = (b["x"] - a["x"]) * (F.col("y") - a["y"]) - (b["y"] - a["y"]) * (F.col("x") - a["x"])
        return cross <= 0 if k in (0, 3) else cross < 0  # clockwise from the top left

    inside = side(0) & side(1) & side(2) & side(3)
    return at.join(dealt, ["__i", "__j"]).filter(inside).drop("__i", "__j", "quad")


def resample_bilinear(raster: DataFrame, targets: DataFrame, value: str = "z", by: tuple[str, ...] = ()) -> DataFrame:
    """``raster`` (row, col, value) at fractional places (frow, fcol) of ``targets``, by the four neighbours.

    A place with a missing neighbour gets NULL. The neighbours are an equi-join, the sum one aggregation by target."""
    r0, c0 = F.floor("frow").cast("int"), F.floor("fcol").cast("int")
    fr, fc = F.col("frow") - r0, F.col("fcol") - c0
    corners = F.array(*[F.struct((r0 + i).alias("row"), (c0 + j).alias("col"),
                                 ((fr if i else 1 - fr) * (fc if j else 1 - fc)).alias("w")) for i in (0, 1) for j in (0, 1)])
    keys = list(targets.columns)
    need = targets.withColumn("__n", F.explode(corners)).select(*keys, "__n.*").filter("w > 0")
    cells = raster.select(*by, F.col("row"), F.col("col"), F.col(value).alias("__v"))
    hit = need.join(cells, [*by, "row", "col"], "left")
    total = F.when(F.count(F.lit(1)) == F.count("__v"), F.sum(F.col("w") * F.col("__v")))
    return hit.groupBy(*keys).agg(total.alias(value))
