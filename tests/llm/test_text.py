"""License scans, personal data, toxicity against brute force, planted cases and odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from plotweave.llm import license_scan as L
from plotweave.llm import pii as P
from plotweave.llm import toxicity as X

from .cases import SCHEMA, empty, odd, odd_rows


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def license_brute(text, threshold=0.8):
    w, at, base, more, best = words(text), [], set(), set(), 0.0
    for phrase, label in L.PHRASES:
        p = phrase.split(" ")
        here = [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
        at += here
        if here:
            base.add(label)
    for label, t, marks in L.TEMPLATES:
        need, size = set(t.split(" ")), 16 if len(t.split(" ")) <= 12 else 48
        for k in range(0, len(w), size // 4):
            have = set(w[k:k + size])
            if have >= set(marks.split(" ")) and len(have & need) >= math.ceil(threshold * len(need) - 1e-9):
                more.add(label)
                best = max(best, len(have & need) / len(need))
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if at else best)


def test_licenses(spark):
    rng = random.Random(1)
    pool = sorted({x for _, t, _ in L.TEMPLATES for x in t.split(" ")}) + ["foo", "bar"]
    texts = ["Licensed under CC BY-NC 4.0.", "cc by cc by cc by", "GNU general\npublic license", "Released under the MIT-License!", None, ""]
    texts += ["intro line\n" + " ".join(x for x in t.split(" ") if rng.random() < 0.85) + " foo" for _, t, _ in L.TEMPLATES for _ in range(4)]
    texts += [" ".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(60)]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)] + odd_rows()[:6]
    got = [tuple(r) for r in L.scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(((i, *license_brute(t)) for i, t, *_ in rows), key=str)
    assert L.scan_licenses(empty(spark)).count() == 0 and L.scan_licenses(odd(spark)).count() == len(odd_rows())


def test_wrapped_notices_and_short_templates(spark):
    mit = L.TEMPLATES[4][1].split(" ")
    wrapped = "x " * 100 + "\n".join(" ".join(mit[k:k + 7]) for k in range(0, len(mit), 7)) + " y" * 100
    bsd = "// Redistribution and use in source and binary forms, with or without\n// modification, are permitted provided that the following conditions\n// are met:"
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0."
    far = "released " + "a " * 60 + "under the " + "b " * 60 + "mit license"
    texts = {1: wrapped, 2: "Released under the Apache License", 3: "Released under the BSD license", 4: "Licensed under CC BY 4.0", 5: bsd, 6: mpl, 7: far,
             8: "Licensed under CC BY-NC 4.0"}
    got = {r.doc_id: r.labels for r in L.scan_licenses(spark.createDataFrame([(k, t, "en", "s") for k, t in texts.items()], SCHEMA)).collect()}
    assert got == {1: "mit", 2: "apache", 3: "", 4: "cc-by", 5: "bsd", 6: "mpl", 7: "mit", 8: "cc-by,cc-by-nc"}  # 7: by the phrase


def test_no_license_link_at_the_threshold_is_lost(spark):
    rng = random.Random(5)
    own = (("plain", "use this as you like without any promise", ""), ("named", "Copying is allowed for Everyone here now", "acme"), *L.TEMPLATES)
    texts = ["use this as you like without promise", "copying is allowed for everyone here now says acme", "copying is allowed for everyone here now",
             "Released under the BSD license", "x " * 30 + L.TEMPLATES[0][1].replace("gnu ", "") + " y" * 30, None, "use this"]
    texts += [" ".join(x for x in rng.choice(own)[1].split(" ") if rng.random() < 0.88) + " acme" * rng.randrange(2) for _ in range(60)]
    docs = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(texts)] + [(0, texts[0], "en", "s")], SCHEMA)
    want, marked = Counter(), {k: set() for k in range(len(texts))}
    for k, t in enumerate(texts):
        w = words(t)
        for tid, (label, text, marks) in enumerate(own):
            need, size = set(words(text)), 16 if len(words(text)) <= 12 else 48
            for b, a in enumerate(range(0, len(w), size // 4)):
                have = set(w[a:a + size])
                if len(have & need) >= math.ceil(0.8 * len(need) - 1e-9):
                    want[k, size, b, tid, have >= set(words(marks))] += 1 + (k == 0)
                    marked[k] |= {label} if have >= set(words(marks)) else set()
    read = L.read_texts(docs, templates=own)
    links = L.template_matches(read.select("doc_id", "tkey", "marked"), own).collect()
    assert Counter((r.doc_id, r["size"], r.block, r.template, r.distinguished) for r in links) == want
    assert len({d for *_, d in want}) == 2
    got = {r.doc_id: r for r in L.scan_licenses(docs, templates=own, links=True).collect()}
    for k in got:
        assert set(got[k].labels.split(",")) - {""} - set(got[k].base_labels.split(",")) <= marked[k] <= set(got[k].labels.split(",")) | {""}
        assert got[k].n_links == len({tid for d, _, _, tid, _ in want if d == k})
    assert got[0].labels == "plain" and got[1].labels == "named" and got[2].labels == got[3].labels == "" and got[2].n_links == got[3].n_links == 1


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def pii_brute(t):
    t, out = t or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in out).encode()).hexdigest()


def test_base_entities_match_the_plain_patterns(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab@..--+ 0123456789()_%é😀\n") for _ in range(rng.randrange(120))) for _ in range(400)]
    texts += ["a@b.c_d@e.f", "x" * 20_000 + "@", "1 " * 4_000, "9" * 40_000, "4111 1111 1111 1111, 4111-1111-1111-1112", "001.002.0255.256 1.2.3.4.5", "+1 (938) 555-1226 +12"]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)] + [(900 + k, t, "en", "s") for k, (_, t, *_) in enumerate(odd_rows())]
    got = {r.doc_id: r.base_sha256 for r in P.pii_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: pii_brute(t) for i, t, *_ in rows}


def test_contexts_find_what_the_patterns_miss(spark):
    rng = random.Random(2)
    rows = [(k, f"some words {k} then reach me at user{k}@mail.example.com or so", "en", "s") for k in range(40)]
    rows += [(100 + k, f"please reach me at user{k}(at)mail.example.com soon", "en", "s") for k in range(3)]
    rows += [(200 + k, f"it was built in the year {1900 + k} by {rng.randrange(9)} people", "en", "s") for k in range(40)]
    got = {r.doc_id: r for r in P.find_pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k in range(3):
        t = rows[40 + k][1]
        assert [t[s.start:s.end] for s in got[100 + k].context] == [f"user{k}(at)mail.example.com"]
    assert not any(got[k].context for k in got if k < 100 or k >= 200)
    assert P.find_pii(empty(spark)).count() == 0 and P.find_pii(odd(spark)).count() == len(odd_rows())


def labelled(n, seed):
    rng = random.Random(seed)
    common = [f"{lang}w{k}" for lang in ("en", "fr") for k in range(300)]
    bad = {"en": ["vilestuff", "nastyword"], "fr": ["malpropreA", "malpropreB", "malpropreC"]}
    out = []
    for k in range(n):
        lang = "fr" if k % 3 == 0 else "en"
        w = [rng.choice([c for c in common[:300]] if lang == "en" else common[300:]).replace("w", rng.choice("xyz")) for _ in range(rng.randrange(20, 120))]
        toxic = int(rng.random() < 0.25)
        for _ in range(2 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad[lang]))
        out.append((" ".join(w), toxic, lang))
    return out


def test_classifier_learns_and_reads_whole_texts():
    s = X.Settings(buckets=1 << 13, epochs=6)
    m = X.train(labelled(700, 1), s, labelled(250, 2))
    test = labelled(400, 3)
    p = X.Scorer(m).scores([t for t, _, _ in test]) >= 0.5
    y = np.array([v for _, v, _ in test], bool)
    assert (p == y).mean() > 0.95
    long = test[0][0] + " clean" * 50_000
    whole, pieces = X.Scorer(m, piece=10**9), X.Scorer(m, piece=1000)
    texts = [long, long + " vilestuff nastyword", "", None, "one"]
    a, b = whole.logits(texts), pieces.logits(texts)
    assert np.allclose(a[0], b[0], atol=1e-4) and (a[1] == b[1]).all()
    assert a[0][1] > a[0][0] + 1
    assert ((0 <= whole.scores(texts)) & (whole.scores(texts) <= 1)).all()


def test_found_instances_lend_support_to_patterns_without_seeds(spark):
    first = [("one", f"a{k}", True) for k in range(20)] + [("one", "x0", False)]
    hop = [("one", f"x{k}", False) for k in range(1, 4)] + [("two", f"x{k}", False) for k in range(4)] + [("two", f"a{k}", True) for k in range(4)]
    edges = spark.createDataFrame(first + hop + [("weak", "z", False), ("weak", "a0", True)], "pattern string, instance string, seed boolean")
    got = {r.pattern: r for r in P.score_patterns(edges).collect()}
    assert set(got) == {"one", "two"} and got["two"].seeds == 8 and got["two"].confidence >= 0.8  # four seeds, four found


def test_every_training_language_counts():
    rows = [(f"word{k} again{k} more{k}", k % 2, f"l{k:02d}") for k in range(40)]
    m = X.train(rows, X.Settings(buckets=1 << 10, epochs=1))
    assert m.langs == [f"l{k:02d}" for k in range(40)]
    assert m.lang_logp.shape[1] == len(m.thresholds) == 40


def test_gradients_reach_every_part():
    before = X.Settings(buckets=1 << 10, epochs=0)
    m0, m1 = X.train(labelled(60, 4), before), X.train(labelled(60, 4), X.Settings(buckets=1 << 10, epochs=1))
    assert not np.allclose(m0.emb, m1.emb) and all(not np.allclose(a, b) for a, b in zip(m0.conv, m1.conv)) and not np.allclose(m0.out, m1.out)


def test_toxicity_report(spark):
    data = labelled(300, 5)
    docs = spark.createDataFrame([(k, t, lang, "s") for k, (t, _, lang) in enumerate(data)] + [(k and k + 1000, t, a, b) for k, t, a, b in odd_rows()], SCHEMA)
    labels = spark.createDataFrame([(k, v) for k, (_, v, _) in enumerate(data)] + [(None, 1), (5, None), (10**9, 1)], "doc_id long, toxic int")
    s = X.Settings(buckets=1 << 12, epochs=5)
    got = X.toxicity_report(docs, labels, settings=s).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) or r.doc_id is None
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.predicted, data[r.doc_id][1]) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert sum(a == b for a, b in held) / len(held) > 0.85
    flat = X.toxicity_report(odd(spark), labels.limit(0), settings=s)
    assert flat.count() == len(odd_rows()) and flat.filter("predicted = 1").count() == 0
    assert X.toxicity_report(empty(spark), labels, settings=s).count() == 0
    m = X.fit(docs, labels, settings=s)
    assert X.drop_toxic(odd(spark), m).columns == odd(spark).columns
    assert docs.filter(F.col("doc_id") < 0).count() == 0


def test_training_takes_every_labelled_row_and_its_whole_text(spark):
    data = [(t + " clean" * 4000 * y, y, lang) for t, y, lang in labelled(300, 6)]  # toxic texts have over 20,000 characters
    rows = [(k, t, lang, "s") for k, (t, _, lang) in enumerate(data)]
    docs, labels = spark.createDataFrame(rows + rows[:20], SCHEMA), spark.createDataFrame([(k, v) for k, (_, v, _) in enumerate(data)], "doc_id long, toxic int")
    s = X.Settings(buckets=1 << 12)
    m = X.fit(docs, labels, settings=s)
    fold = {k: zlib.crc32(str(k).encode()) % 5 for k in range(300)}
    assert not m.flat
    held = [k for k in fold if fold[k] == 0]
    got = X.Scorer(m).scores([data[k][0] for k in held]) >= 0.5
    assert np.mean(got == [data[k][1] == 1 for k in held]) > 0.85
    # statistics are those of all rows however they are dealt, and training doesn't depend on where rows lie
    one, dealt = X.replace(s, epochs=0), X.replace(s, epochs=2, shard_rows=20)
    want = X.train([data[k] for k in fold if fold[k] > 1], one, [data[k] for k in fold if fold[k] == 1])
    some = X.fit(docs, labels, settings=X.replace(one, shard_rows=20))
    assert np.array_equal(some.emb, want.emb) and np.array_equal(some.lang_logp, want.lang_logp) and np.allclose(some.thresholds, want.thresholds)
    a, b = X.fit(docs, labels, settings=dealt), X.fit(docs.repartition(7), labels.repartition(3), settings=dealt)
    assert not np.allclose(a.emb, want.emb)
    assert np.array_equal(X.flattened(a), X.flattened(b)) and np.array_equal(a.thresholds, b.thresholds)


def test_running_sums(spark):
    for n in (1, 2, 3, 4, 5, 17, 100, 1000):
        assert spark.range(1).select(P._running(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: k % 7)).alias("s")).first().s == np.cumsum(np.arange(1, n + 1) % 7).tolist()


def test_a_text_of_many_numbers_takes_seconds(spark):
    import time
    text = " ".join(str(k % 1000) if k % 50 else f"u{k}@mail.example.org" for k in range(400_000))
    began = time.perf_counter()
    r = P.pii_report(spark.createDataFrame([(1, text, "en", "s")], SCHEMA)).first()
    assert r.n_email == 8000 and r.base_sha256 == pii_brute(text) and r.has_pii
    assert time.perf_counter() - began < 60


def score_brute(edges, rounds=3, support=5, confidence=0.8):
    seed = {(p, i): s for p, i, s in edges}
    score = {e: float(s) for e, s in seed.items()}
    for k in range(rounds):
        own = {}
        for p, i in seed:
            own.setdefault(p, []).append(i)
        conf = {p: sum(score[p, i] for i in ii) / (len(ii) + 1) for p, ii in own.items()}
        seeds = {p: sum(seed[p, i] for i in ii) for p, ii in own.items()}
        if k + 1 == rounds:
            return {p: (round(conf[p], 9), seeds[p]) for p in own if seeds[p] >= support}
        at = {}
        for p, i in seed:
            at.setdefault(i, []).append(p)
        vote = {i: 1 - math.prod(1 - min(conf[p], 0.999) for p in pp) for i, pp in at.items()}
        found = {i: any(conf[p] >= confidence and seeds[p] >= support for p in pp) for i, pp in at.items()}
        first = {(p, i): s for p, i, s in edges}
        seed = {(p, i): first[p, i] or found[i] for p, i in first}
        score = {(p, i): 1.0 if seed[p, i] else vote[i] for p, i in seed}


def test_pattern_scores_against_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    kind = {i: rng.random() < 0.6 for i in range(60)}
    edges = sorted({(f"p{rng.randrange(12)}", f"i{i}", kind[i]) for i in (rng.randrange(60) for _ in range(300))})
    df = spark.createDataFrame(edges, "pattern string, instance string, seed boolean")
    for most in (100_000, 0):  # by broadcast, and by joins that part hot keys from the others
        monkeypatch.setattr(P, "BROADCAST_ROWS", most)
        got = {r.pattern: (round(r.confidence, 9), r.seeds) for r in P.score_patterns(df).collect()}
        assert got == score_brute(edges)


def test_unseen_identifiers_recall_and_precision(spark):
    rng = random.Random(12)
    leads = ["please reach me at", "write to our desk", "forward it to", "my contact is", "send mail to"]
    rows, planted = [], {}
    for k in range(600):
        lead, filler = leads[k % 5], " ".join(rng.choice("some words of a text that tells nothing much".split()) for _ in range(12))
        if k % 4:
            rows.append((k, f"{filler} {lead} user{k}@host{k % 40}.example.com today {filler}"))
        else:
            unseen = rng.choice((f"user{k}(at)host.example", f"id{k}x{k * 7}", f"u{k}_at_h{k}_org"))
            planted[k] = unseen
            rows.append((k, f"{filler} {lead} {unseen} today {filler}"))
    rows += [(1000 + k, f"{filler} in the year {1900 + k % 120} the price was {k} dollars {filler}") for k in range(600)]
    got = {r.doc_id: [text[s.start:s.end] for s in r.context] for text, r in
           ((dict(rows)[r.doc_id], r) for r in P.find_pii(spark.createDataFrame([(k, t, "en", "s") for k, t in rows], SCHEMA)).collect())}
    found = sum(planted[k] in got[k] for k in planted)
    wrong = sum(len([x for x in v if x != planted.get(k)]) for k, v in got.items())
    assert found / len(planted) >= 0.9 and wrong / max(1, found + wrong) <= 0.1


def forward_brute(m, text):
    """The classifier word by word, as its equations say."""
    s = m.settings
    words = X.words_of(text)
    x = [sum(m.emb[f].astype(float) for f in X.hashed_forms(w, s)) for w in words]
    pooled = []
    for conv in m.conv:
        for q in range(s.filters):
            sums = [sum(float(x[i + j] @ conv[j, :, q]) for j in range(len(conv)) if i + j < len(x)) for i in range(len(x))]
            pooled.append(max(sums, default=None))
    if not words:
        return float(m.out_bias), 0
    logit = sum(max(p + b, 0.0) * w for p, b, w in zip(pooled, m.bias.astype(float), m.out.astype(float))) + m.out_bias
    told = [sum(float(m.lang_logp[X.hashed_forms(w, s)[0] % s.lang_buckets, k]) for w in words) for k in range(len(m.langs))]
    return logit, int(np.argmax(told))


def test_scores_against_a_forward_pass_by_hand():
    m = X.train(labelled(200, 8), X.Settings(buckets=1 << 11, epochs=2), labelled(60, 9))
    texts = [t for t, _, _ in labelled(25, 10)] + ["", None, "one", "two words", "vilestuff"]
    logit, lang = X.Scorer(m, piece=64).logits(texts)
    for t, a, b in zip(texts, logit, lang):
        want = forward_brute(m, t)
        assert abs(a - want[0]) < 1e-3 and (not t or b == want[1]), t
    got = X.Scorer(m).scores(texts)
    assert np.allclose(got, [1 / (1 + math.exp(-(forward_brute(m, t)[0] - m.thresholds[b]))) for t, b in zip(texts, lang)], atol=1e-3)


def test_one_class_gives_scores_of_zero():
    m = X.train([("a b c", 1, "en"), ("d e", 1, "fr")], X.Settings(buckets=1 << 10, epochs=1))
    assert X.Scorer(m).scores(["a b c", None, "zz"]).tolist() == [0, 0, 0]


def test_a_word_is_hashed_once_while_it_is_in_use(monkeypatch):
    class Counted:
        def __init__(self):
            self.seen = Counter()

        def xxh32_intdigest(self, text):
            self.seen[text] += 1
            return xxhash.xxh32_intdigest(text)

    s = X.Settings(buckets=1 << 11, epochs=1, cache=500)
    m = X.train(labelled(60, 13), s)
    name = lambda k: "word" + "".join(chr(97 + int(c)) for c in str(k))
    texts = [f"often {' '.join(name(k) for k in range(a, a + 100))} usual" for a in range(0, 5000, 100)]
    want = X.Scorer(m, piece=10**9).logits(texts)
    counted = Counted()
    monkeypatch.setattr(X, "xxhash", counted)
    got = X.Scorer(m, piece=100).logits(texts)  # the cache overflows about twenty times
    assert np.allclose(got[0], want[0], atol=1e-4) and (got[1] == want[1]).all()
    assert counted.seen["=often"] == counted.seen["=usual"] == 1
    assert counted.seen.total() == 5002  # beginnings are hashed as columns, not one by one


def test_words_are_the_runs_of_letters_whatever_the_alphabet():
    every = [chr(k) for k in range(0x110000)]
    for text in ("-".join(every[:256]), "".join(every[:256]), "a".join(every[:0x3000]), "é1ü_ß\xa0ª²x\x85y", "Straße’s İ ΑΣ", "\ud800a", "", "12"):
        assert X.words_of(text) == X.LETTERS.findall(text.lower())
    assert X.words_of(None) == []


def test_beginnings_share_a_bucket_and_short_words_have_their_own():
    s = X.Settings()
    words = ["abcdefgh", "abcdefgz", "abcdefg", "abcx", "abc", "ab", "é", "Ωmega" * 10_000]
    forms = X.hashed_forms(words, s)
    for a, u in zip(words, forms):
        assert (X.hashed_forms(a, s) == u).all() and ((0 <= u) & (u < s.buckets)).all()
        assert all(u[k] == u[0] for k, n in enumerate(s.beginnings, 1) if len(a) < n)
        for b, v in zip(words, forms):
            for k, n in enumerate(s.beginnings, 1):
                if min(len(a), len(b)) >= n:
                    assert (u[k] == v[k]) == (a[:n] == b[:n])
    some = X.hashed_forms([f"{a}{b}{c}dxyz" for a in "abcdefghijklmno" for b in "abcdefghijklmno" for c in "abcdefghijklmno"], s)
    assert len(np.unique(some[:, 1])) > 3200  # of 3,375 beginnings in 65,536 buckets


def test_peaks_against_every_place():
    rng = np.random.default_rng(3)
    for widths, piece in (((1, 2, 3), 100_000), ((1, 2, 3), 4), ((2, 5), 3), ((1,), 1)):
        s = X.Settings(widths=widths, filters=2, piece=piece)
        columns = rng.integers(-3, 4, (2 * sum(widths), 9)).astype(np.float32)  # small whole numbers: ties are frequent
        sizes = rng.integers(1, 14, 40)
        words, ends = rng.integers(0, 9, sizes.sum()), np.cumsum(sizes)
        best, place = X.peaks(columns, words, sizes, s)
        for q, (end, size) in enumerate(zip(ends, sizes)):
            at = 0
            for i, w in enumerate(widths):
                for f in range(2):
                    sums = [sum(columns[at + 2 * k + f, words[p + k]] for k in range(w) if p + k < end) for p in range(end - size, end)]
                    assert best[q, 2 * i + f] == max(sums) and place[q, 2 * i + f] == end - size + int(np.argmax(sums))
                at += 2 * w
