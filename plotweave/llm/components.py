"""Connected components by alternating large and small stars.

Edges are rows; each round rewires them towards the smallest neighbour until every node hangs on its component's
smallest. A hub, however large, only takes part through aggregated minima and an equi-join that Spark may split. Each
round is written to the shared folder, so a lost executor costs no more than the round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import discard, materialise


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` has two comparable columns ``u`` and ``v``; result: ``node, root`` for nodes that aren't their
    component's smallest. Loops and repeated edges do no harm, no edges give no rows; null ends are ignored."""
    now = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = materialise(now, "cc-edges")
    state = _state(now)
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pulled = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        then = materialise(pulled.union(least.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        discard(now)
        now, before, state = then, state, _state(then)
        if state == before:
            out = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            out.scratch_path = now.scratch_path
            return out
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
