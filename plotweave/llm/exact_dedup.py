"""Exact deduplication by skew-safe combining (native).

Three combining stages, each grouping by digest *and* full normalised content:

1. within a map task, copies collapse before anything is shuffled (partial aggregation);
2. ``(digest, salt, content)``: a group of copies, however large, is merged by as many tasks as there are salts;
3. ``(digest, content)``: at most ``salts`` winners a text meet.

Only groups of two or more rows are joined back, by digest alone, those of more than a thousandth of the rows by
broadcast: stage 3 has proven, on full contents, which
digests stand for one content. Digests that stand for several (never seen with SHA-256, but handled) are joined by
content as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import SPACE, column, join_counted, materialise, own_names, whole_text


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(whole_text(text), f"{SPACE}+", " ")


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32,
                digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null text counts as empty. A null id never wins against another id; a group of null ids only keeps null.
    Repeated rows (same id, same text) are one document told twice: all are marked kept, each counts in
    ``group_size``. Empty input gives an empty result; further columns of ``docs`` are ignored.
    """
    rows = docs.select(column(id_col).alias("doc_id"), normalised(text_col).alias("content"))
    rows = rows.select("doc_id", "content", digest(F.col("content")).alias("digest"),
                       F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"))
    merged = (rows.groupBy("digest", "salt", "content")
              .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")))
    winners = (merged.repartition("digest").groupBy("digest", "content")
               .agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n")))
    groups = materialise(
        winners.groupBy("digest").agg(F.count(F.lit(1)).alias("contents"), F.min("keep_id").alias("keep_id"),
                                      F.sum("n").alias("n")).filter("n > 1"), "exact-groups")

    members = materialise(rows.select("doc_id", "digest"), "exact-members")
    total = members.count()
    single = groups.filter("contents = 1").select("digest", "keep_id", "n")
    if groups.filter("contents > 1").isEmpty():
        found = join_counted(members, single, "digest", total, how="left")
    else:
        shared = rows.join(groups.filter("contents > 1").select("digest"), "digest", "left_semi")
        per_content = (shared.groupBy("digest", "salt", "content")
                       .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
                       .groupBy("digest", "content")
                       .agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n")))
        told_apart = shared.join(per_content, ["digest", "content"]).select("digest", "doc_id", "keep_id", "n")
        clear = members.join(groups.filter("contents > 1").select("digest"), "digest", "left_anti")
        found = join_counted(clear, single, "digest", total, how="left").unionByName(told_apart.select("digest", "doc_id", "keep_id", "n"))
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """``docs`` with one row of each normalised text: that of the smallest id; of rows that share it, that of the smallest hash
    of all columns, so rows alike in everything leave one. Null ids lose against others, null and empty texts are one
    text, columns stay as they are, empty input stays empty."""
    content, digest, salt, row, at = own_names(docs, "__content", "__digest", "__salt", "__row", "__at")
    every = [column(c) for c in docs.columns]
    order = F.struct(column(id_col).isNull(), column(id_col), F.xxhash64(*every))
    rows = docs.select(F.struct(*every).alias(row), order.alias(at), normalised(text_col).alias(content))
    rows = rows.withColumn(digest, F.sha2(content, 256)).withColumn(salt, F.pmod(F.xxhash64(at), F.lit(salts)))
    best = lambda g: g.agg(F.min_by(row, at).alias(row), F.min(at).alias(at))
    merged = best(rows.groupBy(digest, salt, content))
    return best(merged.groupBy(digest, content)).select(f"{row}.*")


SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents),
     g AS (SELECT content, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY content)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256 FROM d JOIN g USING (content)
"""
