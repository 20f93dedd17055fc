"""SimHash, components, decontamination, token counts against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from plotweave.llm import components, decontaminate as D, simhash as H, token_counts as T

from .cases import SCHEMA, empty, odd, odd_rows


def simhash_brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    for _, t, *_ in odd_rows():
        assert H.simhash64(None if t is None else t.encode()) == simhash_brute(t)
    assert H.simhash64(b"A b C d") == H.simhash64(b"a B\tc\x0bD") and H.simhash64(b"one") == xxhash.xxh64_intdigest("one", 42)


def brute_roots(fps, radius):
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[k + 1:] ^ fps[k]) <= radius) + k + 1:
            a, b = find(k), find(int(j))
            up[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(fps))]


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    seeds = rng.integers(0, 2**63, n // 8 + 1).astype(np.uint64)
    out = rng.choice(seeds, n)
    for _ in range(2):
        out = out ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)) * rng.integers(0, 2, n).astype(np.uint64)
    return np.unique(out)


def test_shard_search_is_exact():
    for seed in range(4):
        fps = clustered(900, seed)
        got = H.shard_links(fps, np.ones(len(fps), bool), 2, cell=16)
        assert got.tolist() == brute_roots(fps, 2)


@pytest.mark.parametrize("bands", [1, 2, 3])
def test_trees_lose_no_link(bands):
    fps = clustered(1500, 9)
    near = [(a, b) for a in range(len(fps)) for b in np.flatnonzero(np.bitwise_count(fps ^ fps[a]) <= 2) if a < b]
    met = set()
    for mask in H.band_masks(bands):
        tree = H.VantageTree(fps[::3], mask, 9)  # deeper than its sample can fit
        assert len(tree.points) < 9
        leaves, at, home = tree.visits(fps, 2 // bands)
        assert home.sum() == len(fps) == len(set(at[home].tolist()))
        for leaf in set(leaves.tolist()):
            visiting, res = set(at[leaves == leaf].tolist()), set(at[(leaves == leaf) & home].tolist())
            met |= {(a, b) for a, b in near if (a in res and b in visiting) or (b in res and a in visiting)}
    assert met == set(near)


def test_deeper_trees_visit_only_what_boundaries_ask_for():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    mask = H.band_masks(2)[0]
    for depth in (0, 4, 12):
        leaf, at, home = H.VantageTree(fps[:500], mask, depth).visits(fps, 1)
        assert len(at) <= len(fps) * 1.35 ** depth and leaf.max() < 1 << depth


def test_near_duplicates_end_to_end(spark):
    rng = random.Random(2)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(300)) for _ in range(12)]
    rows = [(k, (base[k % 12] + f" tail{k % 5}") if k % 3 else base[k % 12], "en", "s") for k in range(150)]
    rows += [(i and i + 1000, t, a, b) for i, t, a, b in odd_rows()]
    got = H.near_duplicates(spark.createDataFrame(rows, SCHEMA), shard_size=2).collect()
    fps = [simhash_brute(t) for _, t, *_ in rows]
    roots = brute_roots(np.array(fps, np.uint64), 2)
    first = {}
    for (i, *_), r in zip(rows, roots):
        first[r] = i if first.get(r) is None else first[r] if i is None else min(i, first[r])
    want = sorted(((i, f"{f:016x}", first[r]) for (i, *_), f, r in zip(rows, fps, roots)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    kept = H.keep_representatives(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(kept) == len(set(roots))
    assert H.near_duplicates(empty(spark)).count() == 0 and H.near_duplicates(odd(spark)).count() == len(odd_rows())


def test_components_with_a_hub_and_a_chain(spark):
    edges = [(0, k) for k in range(1, 300)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (2001, 2000), (2000, 2001), (None, 3)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(1, 300)}, **{k: 1000 for k in range(1001, 1061)}, 2001: 2000}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def hits_brute(text, items, window):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = fold(text), set(), set()
    for i, t in items:
        p = fold(t)
        n = min(window, len(p))
        for k in range(len(p) - n + 1 if n else 0):
            for a in range(len(w) - n + 1):
                if w[a:a + n] == p[k:k + n]:
                    hit.update(range(a, a + n))
                    found.add(i)
    return hit, found


def test_automaton_against_brute_force():
    rng = random.Random(4)
    some = lambda n, v: " ".join(f"T{rng.randrange(v)}" for _ in range(n))
    for v in (2, 3, 8):
        items = [(f"i{k}", some(rng.randrange(12), v)) for k in range(12)] + [("null", None), ("one", "t1"), ("punct", "!!! ,")]
        auto = D.ItemAutomaton([(i, t and t.encode()) for i, t in items], 4)
        for _ in range(60):
            text = some(rng.randrange(40), v + 1)
            spans, found = auto.scan(D.folded_words(text.encode()))
            hit, want = hits_brute(text, items, 4)
            assert {x for a, b in spans for x in range(a, b)} == hit and found == want


def test_decontaminate(spark):
    item = "The quick brown fox, jumps over the lazy dog again and again"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    rows = [(1, f"Before it. {item}! After it, many more words stand here.", "en", "s"), (2, item, "en", "s"), (3, "clean", "en", "s"), (4, None, "en", "s")]
    got = {r.doc_id: r.text for r in D.decontaminate(spark.createDataFrame(rows, SCHEMA), bench).collect()}
    assert got == {1: "Before it. ! After it, many more words stand here.", 3: "clean", 4: None}
    out = D.contamination_report(odd(spark), bench)
    assert out.count() == len(odd_rows()) and out.filter("contaminated").count() == 0
    assert D.contamination_report(empty(spark), bench).count() == 0
    assert D.contamination_report(odd(spark), bench.limit(0)).filter("n_hit > 0").count() == 0


def test_shards_of_items_agree_with_one_automaton(spark):
    rng = random.Random(8)
    some = lambda n: " ".join(f"t{rng.randrange(4)}" for _ in range(n))
    bench = spark.createDataFrame([(k, some(9)) for k in range(10)], "item_id long, text string")
    docs = spark.createDataFrame([(k, some(40), "en", "s") for k in range(30)] + [(3, "t1", "en", "s")], SCHEMA)
    a, b = (sorted(map(tuple, D.contamination_report(docs, bench, window=5, shard_words=n).collect())) for n in (10**6, 40))
    assert a == b


def test_decontaminate_with_shards_cuts_as_with_one(spark):
    words = [f"x{k}" for k in range(16)]
    bench = spark.createDataFrame([(k, " ".join(words[k:k + 8])) for k in range(9)], "item_id long, text string")
    half = [(20 + k, " ".join(f"{c}{n}" for n in range(9))) for k, c in enumerate("abcd")]
    bench = bench.union(spark.createDataFrame(half, bench.schema))
    rows = [(1, "before it " + " ".join(words) + " and many more words that stand after it in this text here", "en", "s"),
            (2, " ".join(t for _, t in half) + " few others", "en", "s"), (3, "clean", "en", "s"), (4, None, "en", "s"), (3, "clean", "en", "s")]
    docs = spark.createDataFrame(rows, SCHEMA)
    one, many = (sorted(((r.doc_id, r.text) for r in D.decontaminate(docs, bench, window=5, shard_words=n).collect()), key=str) for n in (10**6, 30))
    assert many == one == sorted([(1, "before it  and many more words that stand after it in this text here"), (3, "clean"), (3, "clean"), (4, None)], key=str)


def pieces_brute(word, begin, follow):
    n = p = 0
    while p < len(word):
        for q in range(len(word), p, -1):
            if word[p:q] in (follow if p else begin):
                break
        else:
            return 0
        p, n = q, n + 1
    return n


def test_longest_match_against_brute_force():
    rng = random.Random(6)
    for letters in ("ab", "abc"):
        for _ in range(40):
            some = lambda: {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 10))}
            begin, follow = some(), some()
            auto = T.PieceAutomaton(sorted(begin), sorted(follow))
            for _ in range(60):
                w = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 12)))
                assert auto.count(w) == pieces_brute(w, begin, follow), (w, begin, follow)


def test_token_counts(spark, tmp_path):
    (tmp_path / "v.txt").write_text("un\naff\n##aff\n##able\na\n##b\n")
    auto = T.PieceAutomaton(*T.load_vocabulary(str(tmp_path / "v.txt")))
    docs = spark.createDataFrame([(1, "unaffable a ab zz", "en", "s"), (2, None, "en", "s")], SCHEMA)
    assert sorted(tuple(r) for r in T.count_tokens(docs, auto).collect()) == [(1, 4, 7, 1), (2, 0, 0, 0)]
    assert T.count_tokens(empty(spark), auto).count() == 0 and T.count_tokens(odd(spark), auto).count() == len(odd_rows())


def test_default_vocabulary_cuts_every_word():
    begin, follow = T.load_vocabulary()
    auto = T.PieceAutomaton(begin, follow, T.has_byte_pieces())
    assert auto.count("123") == 4  # the lone mark and three digits
    assert auto.count("\U0001F9FF\U0001F9FF") == 1 + 8  # outside the vocabulary: the mark and four bytes each
    whole, rest = set(begin), set(follow)

    def brute(word):
        n = at = 0
        while at < len(word):
            have = whole if n == 0 else rest
            end = next((q for q in range(len(word), at, -1) if word[at:q] in have), None)
            if n == 0 and end is None:
                n = 1
            else:
                n, at = (n + 1, end) if end else (n + len(word[at].encode()), at + 1)
        return n

    for w in ("2024-05-06", "Привет", "Ωμέγα", "我们今天去公园", "naïve", "éclair", "(a", "x\U0001F9FFy7", "\u0e01"):
        assert auto.count(w) == brute(w) > 0, w


def test_token_counts_of_whole_texts_against_brute_force(spark):
    begin, follow = map(set, T.load_vocabulary())
    longest = max(map(len, begin | follow))

    def brute(word):
        n = at = 0
        while at < len(word):
            have = follow if n else begin
            end = next((q for q in range(min(len(word), at + longest), at, -1) if word[at:q] in have), None)
            if n == 0 and end is None:
                n = 1
            else:
                n, at = (n + 1, end) if end else (n + len(word[at].encode()), at + 1)
        return n

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    known = {w: brute(w) for t in texts.values() for w in set(cut(t))}
    want = {i: (len(cut(t)), sum(known[w] for w in cut(t)), 0) for i, t in texts.items()}
    assert {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in T.count_tokens(docs).collect()} == want


def test_report_and_removal_against_brute_force(spark):
    import hashlib

    rng = random.Random(14)
    some = lambda n: " ".join(f"T{rng.randrange(5)}" for _ in range(n))
    items = [(f"i{k}", some(rng.randrange(10))) for k in range(14)] + [("n", None)]
    rows = [(k, some(rng.randrange(50)), "en", "s") for k in range(60)] + [(100, None, "en", "s")]
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: r for r in D.contamination_report(docs, bench, window=6).collect()}
    left = {r.doc_id: r.text for r in D.decontaminate(docs, bench, window=6, max_coverage=0.7).collect()}
    for i, t, *_ in rows:
        hit, found = hits_brute(t, items, 6)
        n = len((t or "").split())
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) == (n, len(hit), len(found), bool(hit))
        assert got[i].items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        if len(hit) > 0.7 * n:
            assert i not in left
        elif t is not None:
            assert left[i].split() == [w for k, w in enumerate(t.split()) if k not in hit]
