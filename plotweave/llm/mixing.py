"""Mixing sources to target weights by hash-threshold histograms (native).

Targets come from one row per source. Whole passes over a source are plain arithmetic; the rest of its target is
filled by the documents whose hash lies under a threshold. Thresholds are nested: token sums by (source, hash bucket)
give the boundary bucket, only that bucket is refined by the next bits, until single hash values are told apart. So
no document is ever sorted: each level shuffles at most 4096 partial sums a source and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import broadcast_if_small, column, materialise, word_count

HASH_BITS, LEVEL_BITS = 60, 12


def doc_hash(doc_id: str | Column) -> Column:
    """60 bits of the MD5 of the id's text: stable between runs, engines and partitionings."""
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """``skey, source_size, target, passes, rest`` per source; ``sizes`` has ``skey, size``.

    Water filling: a source stops at ``cap`` times its size and what it can't take is shared by weight among the
    others, until none is above. Sources by rising cap/weight stop first, so prefix sums find the level directly: of the
    levels that leave their own source uncapped, the highest is the one that stops the fewest.
    One row per source meets in one task here, never documents.
    """
    per = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    by_key = Window.orderBy("skey")
    cycle = F.array(*[F.lit(w) for w in weights])
    per = per.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_key) - 1) % len(weights) + 1).cast("int")))
    limit = F.col("source_size") * F.lit(float(cap))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "skey")
    per = per.withColumn("limit", limit)
    per = (per.withColumn("total", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
           .withColumn("limits_before", F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
           .withColumn("weights_left", F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))))
    per = per.withColumn("level", (F.col("total") - F.col("limits_before")) / F.col("weights_left"))
    per = per.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level")))
                         .over(Window.partitionBy()))
    target = F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return (per.withColumn("target", target).withColumn("passes", passes)
            .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
            .select("skey", "source_size", "target", "passes", "rest"))


def thresholds(sizes: DataFrame, targets: DataFrame, sources: int) -> DataFrame:
    """``skey, cut, with_cut``: hashes under ``cut`` are in, ``cut`` itself where that comes nearer to ``rest``."""
    state = targets.select("skey", F.lit(0).cast("long").alias("prefix"), F.col("rest").alias("left"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = sizes.join(broadcast_if_small(state, sources), "skey").filter(
            F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
        sums = (inside.groupBy("skey", "left", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("tokens")))
        upto = F.sum("tokens").over(Window.partitionBy("skey").orderBy("bucket"))
        # the boundary: the first bucket whose running sum passes what is left; all before it is taken
        state = (sums.withColumn("upto", upto).filter(F.col("upto") > F.col("left"))
                 .groupBy("skey").agg(F.min(F.struct("bucket", "tokens", "upto", "left")).alias("b"))
                 .select("skey", F.col("b.bucket").alias("prefix"),
                         (F.col("b.left") - (F.col("b.upto") - F.col("b.tokens"))).alias("left"),
                         F.col("b.tokens").alias("tokens")))
        last = state
        state = state.drop("tokens")
    return last.select("skey", F.col("prefix").alias("cut"),
                       (F.col("tokens") - F.col("left") < F.col("left")).alias("with_cut"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken, copies``.

    ``size`` counts words (null text: 0); sources go by code point, null last, and cycle through ``weights``. The
    word sum of a source's takes is the nearest to its target that a hash threshold gives, so it is off by at most
    half of one document (all rows of one id fall on the same side). Ids are hashed as text; a null id as ''.
    A source of size 0 takes 0. Empty input gives an empty result; other columns of ``docs`` are ignored.
    """
    skey = F.when(column(source_col).isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), column(source_col).cast("string")))
    sizes = materialise(docs.select(column(id_col).alias("doc_id"), skey.alias("skey"),
                                    word_count(column(text_col)).alias("size"), doc_hash(column(id_col)).alias("h")),
                        "mix-sizes")
    targets = materialise(source_targets(sizes, weights, share, cap), "mix-targets")
    sources = targets.count()
    cuts = thresholds(sizes, targets, sources)
    plan = materialise(targets.join(cuts, "skey", "left").select("skey", "source_size", "target", "passes", "cut", "with_cut"),
                       "mix-cuts")
    # no boundary: nothing of the source is left to take
    under = F.coalesce((F.col("h") < F.col("cut")) | ((F.col("h") == F.col("cut")) & F.col("with_cut")), F.lit(False))
    copies = F.col("passes") + F.when(under, 1).otherwise(0)
    return sizes.join(broadcast_if_small(plan, sources), "skey").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"),
        copies.cast("long").alias("copies"))


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM documents),
     s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
     w AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight,
                  CAST(source_size AS DOUBLE) * 2 AS lim, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5e0 AS total FROM s),
     l AS (SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM w),
     t AS (SELECT *, least(lim, coalesce(max(lvl) FILTER (WHERE lvl * weight <= lim) OVER () * weight, lim)) AS target FROM l),
     p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
     c AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
                  CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS BIGINT) AS upto,
                  CAST(sum(d.size) OVER (PARTITION BY d.source, d.h) AS BIGINT) AS same
           FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       size * (passes + CASE WHEN upto <= rest OR (upto - same <= rest AND upto - rest < rest - (upto - same)) THEN 1 ELSE 0 END) AS taken,
       passes + CASE WHEN upto <= rest AND rest > 0 OR (upto - same <= rest AND upto - rest < rest - (upto - same)) THEN 1 ELSE 0 END AS copies
FROM c
"""
