"""The near-dedup stage keeps one of each group at five-word Jaccard 0.8 or more, however many bits the fingerprints differ in."""

import random

import numpy as np

import corpus_pipeline as C
from plotweave.llm import near_shingles as N
from plotweave.llm import simhash as H

from .cases import SCHEMA, empty, odd


def brute(rows, similarity=0.8):
    sets = [N.shingle_hashes((t or "").encode()) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if N.jaccard(sets[a], sets[b]) >= similarity:
                up[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, r in enumerate(rows):
        least[find(k)] = min(least.get(find(k), r[0]), r[0])
    return sorted((r[0], least[find(k)]) for k, r in enumerate(rows))


def planted():
    rng, rows = random.Random(3), []
    for g in range(30):
        base = [f"w{rng.randrange(4000)}" for _ in range(120)]
        for _ in range(1 + g % 5):
            copy = list(base)
            for at in rng.sample(range(120), rng.randrange(4)):
                copy[at] = "edited"
            rows.append((len(rows), " ".join(copy), "en", f"s{g}"))
    return rows


def test_stage_keeps_one_of_each_group(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    for options in ({}, {"block": 2}):
        got = sorted((r.doc_id, r.component_id) for r in N.shingle_groups(docs, **options).collect())
        assert got == want
    kept = sorted(r.doc_id for r in C.near_dedup(spark, docs, "").collect())
    assert kept == sorted({c for _, c in want})
    assert len(kept) < H.near_duplicates(docs).select("component_id").distinct().count()  # two bits miss pairs


def test_odd_rows(spark):
    assert H.keep_representatives(empty(spark), similarity=0.8).count() == 0
    out = H.keep_representatives(odd(spark), similarity=0.8)
    assert out.columns == odd(spark).columns
    ids = sorted((r.doc_id for r in out.collect()), key=str)
    assert ids == sorted([1, 4, 6, 6, 7, 8], key=str)  # 1-3 are blank, 4 and 5 alike, both texts of 6 stay


def test_blocks_of_unlike_near_copies():
    """A large group whose members aren't alike one by one sends a row a node and part, and blocks find what links there are."""
    import pyarrow as pa

    rng = random.Random(5)
    base = [f"w{rng.randrange(9000)}" for _ in range(200)]
    rows = []
    for k in range(240):
        copy = list(base)
        for at in rng.sample(range(200), 2 if k % 6 == 0 else 7):
            copy[at] = f"own{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    sets = [N.shingle_hashes(t.encode()) for _, t in rows]
    first, second = np.arange(0, 100), np.arange(60, 240)
    want = [[len(np.intersect1d(sets[a], sets[b])) for b in second] for a in first]
    unlike = first[:, None] != second[None, :]
    assert (N.overlaps(sets, first, second, width=64) == np.array(want))[unlike].all()
    table = pa.table({"i": [0] * 240, "j": [0] * 240, "part": [0] * 240, "node": [f"{k:03d}".encode() for k in range(240)], "root": [f"{k:03d}".encode() for k in range(240)],
                      "hashes": [s.tobytes() for s in sets]})
    up = list(range(240))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    links = list(zip(*N.block_links(0.8)(table).to_pydict().values()))
    for u, v in links:
        assert N.jaccard(sets[int(u)], sets[int(v)]) >= 0.8
        up[max(find(int(u)), find(int(v)))] = min(find(int(u)), find(int(v)))
    got = sorted((k, find(k)) for k in range(240))
    assert got == brute([(k, t) for k, t in rows]) and len(links) < 240
