"""A corpus pipeline of five stages; each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotweave.llm import decontaminate, line_dedup, mixing, simhash, toxicity
from plotweave.llm._shared import column, discard, documents, materialise, own_names, passing_scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null, blank and repeated texts are scored like any other; an empty
    table stays empty; very long texts are scored whole; columns stay as they are."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, documents stay, repeated rows each; null texts stay null, empty tables empty, further columns
    as they are."""
    return line_dedup.dedup_lines(docs).select(*[column(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: fingerprints within 2 bits, or a Jaccard similarity of five-word
    shingles of 0.8 or more. Null and blank texts are one group, repeated rows too; an empty table stays empty."""
    return simhash.keep_representatives(docs, similarity=0.8)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go, and documents that are little else. Null and clean texts stay untouched, repeated rows are
    treated alike; an empty table stays empty."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of times it takes them: ``copies``, or ``mix_copies`` where that name
    is taken (underscores follow where that is taken, too). Rows of one id are taken alike; documents without words,
    null texts included, go by their hash like others; an empty table stays empty."""
    name = "copies" if "copies" not in {c.lower() for c in docs.columns} else own_names(docs, "mix_copies")[0]
    own_id = own_names(docs, "__id")[0]
    plan = mixing.mix_sources(docs).filter("copies > 0").groupBy("doc_id").agg(F.max("copies").alias("copies"))
    ids = materialise(plan.select(F.col("doc_id").alias(own_id), F.col("copies").alias(name)), "mix-plan")
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids[own_id])).drop(own_id)


STAGES = [("toxicity", drop_toxic), ("line dedup", dedup_lines), ("simhash near-dedup", near_dedup),
          ("benchmark decontamination", drop_leaks), ("mixing", mix)]

#: Classifier and fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        with passing_scratch() as made:  # what the stage has written for itself goes once its result stands
            before, docs = docs, materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
            made.remove(docs)
        discard(before)
    return docs
