"""The pipeline on the smallest tables: what each stage must and must not do, and the registered names."""

import pytest

import corpus_pipeline as C
from plotweave.llm import decontaminate as D
from plotweave.llm import queries as Q
from plotweave.llm import simhash as H
from plotweave.llm._shared import documents, materialise

from .cases import CLASHES, empty, huge, odd, odd_rows

SF = "/root/testdata/sf0.001"


def test_names_and_sql():
    names = [n for n in Q.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert set(Q.oracle_sql()) <= set(Q.queries()) and len(C.STAGES) == 5 and C.ORACLE_SQL is None


def test_stages(spark):
    docs = documents(spark, SF)
    columns = docs.columns
    outs = [docs]
    for k, (name, stage) in enumerate(C.STAGES):
        docs = materialise(stage(spark, docs, SF), f"test-stage{k}")
        if k < 4:
            assert docs.columns == columns, name
        outs.append(docs)
    n = [o.count() for o in outs]
    assert n[0] >= n[1] > 0.6 * n[0] and n[2] == n[1] and n[3] <= n[2] and n[4] <= n[3] and 0 < n[5] <= n[4]
    groups = H.near_duplicates(outs[2]).select("component_id").distinct().count()
    assert 0.9 * groups < n[3] <= groups  # groups of two bits, and copies further apart
    left = D.contamination_report(outs[4], spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert left.filter("contaminated").count() == 0
    size = lambda df: df.selectExpr("sum(regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+') * copies) AS s").first().s
    every = outs[4].selectExpr("sum(regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+')) AS s").first().s
    assert size(outs[5]) == pytest.approx(1.5 * every, rel=0.25)


def stage(name):
    return dict(C.STAGES)[name]


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_rows(spark, k):
    """Nulls in every column, blanks, long texts, repeated rows, clashing names, and an empty table."""
    run = C.STAGES[k][1]
    docs = odd(spark)
    out = run(spark, docs, SF)
    assert out.columns[:len(docs.columns)] == docs.columns
    got = materialise(out, "test-odd").collect()
    assert all(r[c] == f"x {c}" for r in got for c in CLASHES) and len(got) <= len(odd_rows())
    if k < 4:
        assert out.columns == docs.columns
    else:
        assert out.columns[-1] == "mix_copies_"
    assert run(spark, empty(spark), SF).count() == 0
    long = materialise(run(spark, huge(spark), SF), "test-huge")
    if k < 4:  # the mix may leave any of them out
        assert long.filter("length(text) > 5e6").count() == 1
    assert long.filter("doc_id = 2").count() <= (1 if k == 2 else 2)


def test_run_leaves_its_result_only(spark):
    import os

    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(base))
    out = C.run(spark, SF)
    assert out.count() > 0
    left = [n for n in set(os.listdir(base)) - before if not n.startswith("cc-edges") or os.listdir(f"{base}/{n}")]
    assert [n.rsplit("-", 1)[0] for n in left] == ["stage-mixing"]
