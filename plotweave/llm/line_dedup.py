"""Line deduplication by distinct-site spread (native).

Every line hash gets a HyperLogLog sketch of the sites it stands on; sketches merge by aggregation, so a line that a
third of all documents carry costs one small sketch a task. Lines whose estimate is clear of the threshold are decided
by it; lines near it get an exact distinct count. Lines on ``min_sites`` sites or more are boilerplate and go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import SPACE, broadcast_if_small, column, let, materialise, own_names, text_key, whole_text

LG_K = 10  # standard error 1.04 / sqrt(2^10) = 3.3 %


def line_hash(line: Column) -> list[Column]:
    """128 bits, so that unlike lines don't meet even among 10^12 of them."""
    trimmed = F.regexp_replace(line, rf"^{SPACE}+|{SPACE}+$", "")
    return [F.xxhash64(trimmed).alias("h1"), F.xxhash64(trimmed, F.lit(1)).alias("h2")]


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``doc_id, tkey, site, pos, h1, h2`` of the lines that hold anything but white space; texts are read and hashed once."""
    rows = docs.select(column(id_col).alias("doc_id"), text_key(text_col).alias("tkey"), column(site_col).alias("site"), whole_text(text_col).alias("text"))
    # the key is worked out below, else it would be for every line
    rows = rows.select("doc_id", "tkey", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    rows = rows.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return materialise(rows.select("doc_id", "tkey", "site", "pos", *line_hash(F.col("line"))), "line-hashes")


def boilerplate_lines(lines: DataFrame, min_sites: int, margin: float = 0.25) -> DataFrame:
    """``h1, h2, n`` of lines on ``min_sites`` distinct sites or more (a null site counts as none), and on how many rows.

    ``margin``: estimates within this share of the threshold are counted exactly; it is 7 standard errors of the
    sketch. A line on fewer rows than ``min_sites`` can't be on that many sites, so its sketch isn't looked at.
    """
    sketches = (lines.groupBy("h1", "h2")
                .agg(F.count("site").alias("told"), F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
                .filter(F.col("told") >= min_sites)
                .select("h1", "h2", "n", F.hll_sketch_estimate("sketch").alias("sites")))
    sketches = materialise(sketches.filter(F.col("sites") >= min_sites * (1 - margin)), "line-sketches")
    near = sketches.filter(F.col("sites") <= min_sites * (1 + margin) + 1).select("h1", "h2", "n")
    exact = (lines.select("h1", "h2", "site").join(near, ["h1", "h2"]).groupBy("h1", "h2", "site").agg(F.max("n").alias("n"))
             .groupBy("h1", "h2").agg(F.count("site").alias("sites"), F.max("n").alias("n")).filter(F.col("sites") >= min_sites))
    clear = sketches.filter(F.col("sites") > min_sites * (1 + margin) + 1)
    return clear.select("h1", "h2", "n").unionByName(exact.select("h1", "h2", "n"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                min_sites: int = 8) -> DataFrame:
    """``docs`` with boilerplate lines cut from the text, and ``__n_lines, __n_removed`` added last (with underscores
    appended where ``docs`` has columns of these names).

    All rows and columns stay, in whatever order; a document of boilerplate only keeps an empty text, a null text stays
    null. Lines compare without the white space at their ends; blank lines are never boilerplate. Rows equal in id and
    text get equal results, repeated rows each stay. Work is linear in a text's lines. Empty input gives an empty result.
    """
    lines = _lines(docs, id_col, text_col, site_col)
    spread = materialise(boilerplate_lines(lines, min_sites), "line-boilerplate")
    key, tkey, own_id, cut, n_lines, n_removed = own_names(docs, "__key", "__tkey", "__id", "__cut", "__n_lines", "__n_removed")
    hot = broadcast_if_small(spread.select("h1", "h2"), spread.count())
    hits = (lines.join(hot, ["h1", "h2"], "left_semi")
            .groupBy(F.col("doc_id").alias(own_id), F.col("tkey").alias(tkey)).agg(F.collect_set("pos").alias(cut)))
    rows = docs.withColumn(key, text_key(column(text_col)))
    rows = rows.join(hits, column(id_col).eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(tkey)), "left")
    parts = F.split(whole_text(column(text_col)), "\n")
    rest = lambda p: F.transform(F.array_except(F.sequence(F.lit(0), F.size(p) - 1), cut), lambda k: F.get(p, k))
    kept = let(parts, lambda p: F.array_join(rest(p), "\n"))
    return rows.select(
        *[F.when(F.col(cut).isNotNull(), kept).otherwise(column(c)).alias(c) if c == text_col else column(c) for c in docs.columns],
        F.when(column(text_col).isNull(), 0).otherwise(F.regexp_count(column(text_col), F.lit("\n")) + 1).cast("long").alias(n_lines),
        F.when(F.col(cut).isNotNull(), F.size(cut)).otherwise(0).cast("long").alias(n_removed))


def line_report(docs: DataFrame, min_sites: int = 8) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_sha256`` per document."""
    out = dedup_lines(docs.select("doc_id", "text", "source"), min_sites=min_sites)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
                      F.sha2(whole_text("text"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
                  unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
     t AS (SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS key FROM l),
     b AS (SELECT key FROM t WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= 8),
     k AS (SELECT t.doc_id, t.pos, t.line, b.key IS NOT NULL AS cut FROM t LEFT JOIN b ON t.key = b.key),
     g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE cut) AS n_removed,
                  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '') AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.n_lines, 0) AS n_lines, coalesce(g.n_removed, 0) AS n_removed,
       sha256(coalesce(g.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""
