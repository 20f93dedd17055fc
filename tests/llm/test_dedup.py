"""Exact, line and substring deduplication against brute force and on odd rows."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from plotweave.llm import exact_dedup as E
from plotweave.llm import line_dedup as L
from plotweave.llm import substring_dedup as S

from .cases import CLASHES, SCHEMA, empty, odd, odd_rows, random_docs


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def exact_brute(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t, *_ in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[norm(t)]), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_on_odd_rows(spark):
    got = [tuple(r) for r in E.exact_dedup(odd(spark)).collect()]
    assert sorted(got, key=str) == exact_brute(odd_rows())
    assert E.exact_dedup(empty(spark)).count() == 0


def test_exact_tells_colliding_digests_apart(spark):
    rows = [(k, f"t{k % 7}", "en", "s") for k in range(60)] + [(100 + k, "hot", "en", "s") for k in range(200)]
    weak = lambda c: F.concat(F.lit("d"), F.length(c).cast("string"))
    got = E.exact_dedup(spark.createDataFrame(rows, SCHEMA), digest=weak).select("doc_id", "keep_id", "group_size").collect()
    assert sorted(tuple(r) for r in got) == sorted((a, b, c) for a, b, c, *_ in exact_brute(rows))


def test_drop_copies_leaves_one_row_a_text(spark):
    rows = odd_rows() + [(9, "same  text\there", "en", "z")] + [(50, "hot", "en", f"s{k}") for k in range(80)] + [(k, "hot", "en", "s") for k in range(60, 90)]
    docs = odd(spark).limit(0).unionByName(spark.createDataFrame(rows, SCHEMA), allowMissingColumns=True)
    got = E.drop_copies(docs, salts=3)
    assert got.columns == docs.columns
    want = {}
    for i, t, *_ in rows:
        key = norm(t)
        if key not in want or (i is not None and (want[key] is None or i < want[key])):
            want[key] = i
    assert sorted(((norm(r.text), r.doc_id) for r in got.collect()), key=str) == sorted(want.items(), key=str)
    assert E.drop_copies(empty(spark)).count() == 0


def line_brute(rows, least):
    sites = {}
    for _, t, _, s in rows:
        for line in (t or "").split("\n"):
            sites.setdefault(line.strip(" \t\n\x0b\x0c\r"), set()).add(s)
    gone = {k for k, v in sites.items() if k and len(v - {None}) >= least}
    keep = lambda t: "\n".join(x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r") not in gone)
    return sorted(((i, None if t is None else keep(t)) for i, t, *_ in rows), key=str)


def test_lines(spark):
    rng = random.Random(3)
    rows = [(k, "\n".join(rng.choice([f"site line {rng.randrange(30)}", " common ", "", f"own {k}"]) for _ in range(8)), "en", f"s{rng.randrange(14)}") for k in range(150)]
    rows += odd_rows()
    got = L.dedup_lines(spark.createDataFrame(rows, SCHEMA), min_sites=6).select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in got), key=str) == line_brute(rows, 6)


def test_line_spread_far_from_the_threshold_uses_the_sketch(spark):
    rows = [(k, "everywhere\nhere only", "en", f"s{k}") for k in range(60)] + [(1000, "here only", "en", "s1")]
    got = L.dedup_lines(spark.createDataFrame(rows, SCHEMA), min_sites=20).filter("__n_removed = 2").count()
    assert got == 60 and L.dedup_lines(empty(spark)).count() == 0
    out = L.dedup_lines(odd(spark))
    assert out.columns == [*odd(spark).columns, "__n_lines_", "__n_removed_"]
    got = out.collect()
    assert len(got) == len(odd_rows()) and all(r[c] == f"x {c}" for r in got for c in CLASHES)


def substring_brute(rows, window=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    ids = [S.NO_ID if i is None else i for i, *_ in rows]
    own = {}
    for i, w in zip(ids, words):
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            own[key] = min(i, own.get(key, i))
    out = []
    for (i, *_), j, w in zip(rows, ids, words):
        cut = {x for k in range(len(w) - window + 1) if own[tuple(w[k:k + window])] < j for x in range(k, k + window)}
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in cut), len(w), len(cut)))
    return sorted(out, key=str)


def test_substring_on_random_and_odd_rows(spark):
    rows = [(k, t, "en", "s") for k, t, *_ in random_docs(120, 5, vocabulary=2, longest=50)] + [(i and i + 200, t, a, b) for i, t, a, b in odd_rows()]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for options in ({}, {"batches": 5, "piece_bytes": 500, "bucket_windows": 50}):
        got = [tuple(r) for r in S.dedup_substrings(df, **options).select("doc_id", "text", "n_words", "n_removed").collect()]
        assert sorted(got, key=str) == substring_brute(rows)
    assert S.dedup_substrings(empty(spark)).count() == 0
    assert S.dedup_substrings(odd(spark), window=3, batches=1).count() == len(odd_rows())


def test_index_compacts_and_remembers(spark, tmp_path):
    index = S.WindowIndex(spark, f"file://{tmp_path}/index", window=3, buckets=2, groups=5, fanout=2)
    rows = lambda ids: spark.createDataFrame([(i, 0, f"a b c d x{i} y{i} z{i}".encode()) for i in ids], "doc long, part long, text binary")
    runs = []
    for lo in range(0, 20, 4):
        found = index.add(rows(range(lo, lo + 4)))
        runs.append(len(index.runs()))
        hits = found.collect()
        seen = {int(d) for r in hits for d in S.unpacked(r["a"], r["n"], np.int64, True)}
        assert seen == set(range(max(lo, 1), lo + 4))  # "a b c" and "b c d" have stood in document 0
    assert runs == [1, 2, 1, 2, 1]
    again = S.WindowIndex(spark, f"file://{tmp_path}/index", window=3, buckets=2, groups=5, fanout=2)
    plan = again._read(again.runs()[0], S.HASHES).groupBy("key").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # history lies as the merge needs it
    again.drop()
    assert again.runs() == []


def test_a_lasting_index_counts_earlier_calls(spark, tmp_path):
    rows = [(k, t, "en", "s") for k, t, *_ in random_docs(80, 11, vocabulary=2, longest=40)]
    index = S.WindowIndex(spark, f"file://{tmp_path}/lasting", window=5, buckets=4, groups=3)
    got = []
    for lo in (0, 30, 60):
        part = spark.createDataFrame(rows[lo:lo + 30], SCHEMA)
        got += [tuple(r) for r in S.dedup_substrings(part, batches=2, index=index).select("doc_id", "text", "n_words", "n_removed").collect()]
    assert sorted(got, key=str) == substring_brute(rows, 5)


def test_stretches_hold_each_window_once():
    rng = random.Random(3)
    for window in (1, 2, 5):
        words = [f"w{rng.randrange(50)}".encode() for _ in range(400)]
        text = b"  ".join(words)
        seen = [(p + k, tuple(w[k:k + window])) for p, w in S.stretches(text, 37, window) for k in range(len(w) - window + 1)]
        assert sorted(seen) == [(k, tuple(words[k:k + window])) for k in range(len(words) - window + 1)]


def test_bytes_sent_do_not_grow_with_the_buckets():
    import pyarrow as pa
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(300)).encode() for _ in range(400)]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(400)), "part": [0] * 400, "text": texts})
    sent = [sum(len(r[c]) for b in S.piece_runs(13, n, 7, 1 << 20)([batch]) for r in b.to_pylist() for c in "abcde") for n in (4, 256)]
    assert sent[1] < 1.5 * sent[0]


def test_one_hash_for_unlike_windows_is_told_apart_by_the_check():
    h = np.array([5, 5, 5, 9], np.uint64)
    check = np.array([1, 2, 1, 1], np.uint32)
    order, starts = S._groups(h, check)
    assert [sorted(x.tolist()) for x in np.split(order, starts[1:])] == [[0, 2], [1], [3]]


def test_packing_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        v = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
        assert (S.unpacked(S.packed(v, True), n, np.uint64, True) == v).all()
        w = rng.integers(0, 2**31, n).astype(np.uint32)
        assert (S.unpacked(S.packed(w), n, np.uint32) == w).all()
