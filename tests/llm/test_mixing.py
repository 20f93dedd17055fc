import hashlib
import re

import pytest

from plotweave.llm.mixing import mix_sources

DOCS = "doc_id long, text string, source string"


def water_fill(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2.0) -> dict:
    """Targets by resharing until none is above, as the contract words it."""
    keys = sorted(sizes, key=lambda k: (k is None, k or ""))
    w = {k: weights[n % len(weights)] for n, k in enumerate(keys)}
    left, target, free = share * sum(sizes.values()), {}, set(keys)
    while free:
        level = left / sum(w[k] for k in free)
        over = {k for k in free if level * w[k] > cap * sizes[k]}
        if not over:
            target |= {k: level * w[k] for k in free}
            break
        for k in over:
            target[k] = cap * sizes[k]
            left -= target[k]
        free -= over
    return target


def test_targets_and_takes(spark):
    rows = [(n, "w " * (1 + n * 7 % 90), ["a", "b", "c", "é", None, "z"][n % 6]) for n in range(3000)]
    rows += [(10_000 + n, "hot word here", "b") for n in range(1500)]
    got = mix_sources(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    want = water_fill(size)
    assert sum(want.values()) == pytest.approx(1.5 * sum(size.values()))
    source = {i: s for i, _, s in rows}
    taken = {}
    for r in got:
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 45.5  # half of the longest document


def test_threshold_is_the_nearest_cut(spark):
    rows = [(n, "x " * (n % 5 + 1), s) for n in range(60) for s in ("p", "q")]
    got = mix_sources(spark.createDataFrame(rows, DOCS))
    per = {}
    for r, (i, t, s) in zip(sorted(got.collect(), key=lambda r: (r.source_size, r.doc_id)), rows, strict=True):
        assert r.source_size
    for s in ("p", "q"):
        mine = [(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), len(t.split())) for i, t, x in rows if x == s]
        total = sum(n for _, n in mine)
        target = water_fill({"p": total, "q": total})[s]
        rest = target - int(target // total) * total
        sums, run = [0], 0
        for _, n in sorted(mine):
            run += n
            sums.append(run)
        per[s] = int(target // total) * total + min(sums, key=lambda x: abs(x - rest))
    taken = sorted(r[0] for r in got.groupBy("target").sum("taken").select("sum(taken)").collect())
    assert taken == sorted(per.values())


def test_edges(spark):
    assert mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, None, "a"), (1, None, "a"), (2, "", None), (None, "one two", "b")]
    got = mix_sources(spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS size", "2 AS h", "3 AS skey")).collect()
    assert len(got) == 4 and sum(r.size for r in got) == 2
    assert all(r.taken == 0 for r in got if r.size == 0)
    again = mix_sources(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_words_are_cut_at_ascii_space_only(spark):
    rows = [(1, "a b\tc\x0bd\x0ce\rf\ng\x1ch", "a")]
    assert mix_sources(spark.createDataFrame(rows, DOCS)).first()["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", rows[0][1]))
