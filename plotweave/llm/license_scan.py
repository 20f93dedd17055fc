"""License scans: phrase places and an exact set-similarity join of text blocks with license templates (native).

A block is a window of 16 words (for templates of up to 12) or 48 (for longer ones), taken as the set of its words; blocks
start at every fourth part of their length and run across line ends, so 13 or 37 words in a row always lie in one, however
a notice is wrapped. A block and a template are linked where the block holds at least ``threshold`` of the template's words;
the join returns every link. A link gives its label only where the block holds the template's distinguishing words too
("released under the bsd license" is linked to the mit template, but isn't labelled mit); a template may have none. Words are
ordered by their frequency over the blocks of the whole corpus, rarest first, and three filters leave few pairs to verify:

* prefix: a link shares one of the template's ``n - need + 1`` rarest words, so only those are joined;
* length: a block with fewer than ``need`` template words can't be linked;
* position: from the place of the shared word in both orders, the words still to come must suffice.

Only template words can overlap, so blocks are cut to the templates' vocabulary first (distinguishing words included), and
texts that don't hold enough words of any template have no blocks. That vocabulary, its counts and the prefix index are bounded by the templates, which
are a parameter; they never grow with the documents. Each text is cut into words once.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import ALNUM, LOWER, UPPER, ascii_lower, column, materialise, text_key, whole_text

#: The phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Openings of well-known license notices, their labels, and the words that tell them from others.
TEMPLATES = (
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu"),
    ("apache", "licensed under the apache license version 2 0", "apache"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "compliance"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "associated"),
    ("mit", "released under the mit license", "mit"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
)
#: Words of a block for templates of at most SHORT_WORDS words, and for longer ones.
SHORT_WORDS, BLOCKS = 12, (16, 48)


def words_of(text: str | Column) -> Column:
    return F.regexp_extract_all(ascii_lower(whole_text(text)), F.lit(ALNUM), F.lit(0))


def phrase_places(words: Column, phrase: str) -> Column:
    """Starts of the phrase in an array of words."""
    first, *rest = phrase.split(" ")

    def here(w: Column, i: Column) -> Column:
        cond = w == first
        for k, part in enumerate(rest, 1):
            cond = cond & (F.get(words, i + k) == part)
        return cond

    at = F.transform(words, lambda w, i: F.when(here(w, i), i))
    return F.filter(at, lambda i: i.isNotNull())


def template_words(text: str) -> list[str]:
    """A template's words as ``words_of`` cuts a text's."""
    return re.findall(ALNUM, text.translate(str.maketrans(UPPER, LOWER)))


class Template:
    def __init__(self, tid: int, label: str, text: str, marks: str, threshold: float):
        words = template_words(text)
        self.tid, self.label, self.words, self.marks = tid, label, sorted(set(words)), template_words(marks)
        self.need = max(1, math.ceil(threshold * len(self.words) - 1e-9))
        self.size = BLOCKS[len(words) > SHORT_WORDS]


def _templates(templates, threshold: float) -> list[Template]:
    return [Template(k, *t, threshold) for k, t in enumerate(templates)]


def _vocabulary(templates: list[Template]) -> list[str]:
    return sorted({w for t in templates for w in (*t.words, *t.marks)})


def _strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def _could_match(have: Column, t: Template) -> Column:
    """Whether a block of a text with this set of words can hold the threshold of the template's words."""
    return F.size(F.array_intersect(have, _strings(t.words))) >= t.need


def _marked(words: Column, have: Column, templates: list[Template]) -> Column:
    """The words with null for those in no template; null where no template can be linked to the text."""
    vocabulary = _vocabulary(templates)
    some = F.lit(False)
    for t in templates:
        some = some | _could_match(have, t)
    return F.when(some, F.transform(words, lambda w: F.when(w.isin(*vocabulary), w)))


def _blocks(marked: DataFrame, size: int, least: int) -> DataFrame:
    """``doc_id, tkey, size, block, tokens`` of the blocks of ``size`` words that hold ``least`` template words or more."""
    step = size // 4
    last = F.floor(F.greatest(F.size("marked") - 1, F.lit(0)) / step).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.array_distinct(F.array_compact(F.slice(F.col("marked"), k * step + 1, F.lit(size)))))
    blocks = marked.filter("marked IS NOT NULL").select("doc_id", "tkey", F.lit(size).alias("size"), F.posexplode(cut).alias("block", "tokens"))
    return blocks.filter(F.size("tokens") >= least)


def _prefix_index(blocks: DataFrame, templates: list[Template]) -> tuple[DataFrame, list[str]]:
    """Prefix index, and the vocabulary by rising frequency."""
    seen = blocks.select(F.explode("tokens").alias("token")).groupBy("token").count().collect()  # vocabulary only
    count = {r["token"]: r["count"] for r in seen}
    order = sorted(_vocabulary(templates), key=lambda w: (count.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    index = []
    for t in templates:
        words = t.words = sorted(t.words, key=rank.get)
        index += [(w, t.tid, t.size, i, len(words), t.need) for i, w in enumerate(words[:len(words) - t.need + 1])]
    return blocks.sparkSession.createDataFrame(index, "token string, tid int, size int, i int, n int, need int"), order


def template_matches(marked: DataFrame, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """``doc_id, tkey, size, block, label, template, containment, distinguished`` for every block and template that are
    linked; ``distinguished``: the block holds the template's distinguishing words.

    ``marked``: rows of ``doc_id, tkey, marked``, see ``read_texts``."""
    kinds = _templates(templates, threshold)
    blocks = None
    for size in sorted({t.size for t in kinds}):
        some = _blocks(marked, size, min(t.need for t in kinds if t.size == size))
        blocks = some if blocks is None else blocks.unionByName(some)
    blocks = materialise(blocks, "license-blocks")
    index, order = _prefix_index(blocks, kinds)
    # sort a block's words by corpus frequency: keep the globally ordered vocabulary's words that it has
    blocks = blocks.withColumn("tokens", F.array_intersect(_strings(order), F.col("tokens")))
    probes = blocks.select("doc_id", "tkey", "size", "block", "tokens", F.size("tokens").alias("m"), F.posexplode("tokens").alias("j", "token"))
    pairs = probes.join(F.broadcast(index), ["token", "size"]).filter(
        (F.col("m") >= F.col("need"))
        & (1 + F.least(F.col("n") - 1 - F.col("i"), F.col("m") - 1 - F.col("j")) + F.least("i", "j") >= F.col("need")))
    of = lambda what: F.element_at(F.array(*what), F.col("tid") + 1)
    shared = F.size(F.array_intersect("tokens", of([_strings(t.words) for t in kinds])))
    marks = of([_strings(t.marks) for t in kinds])
    prefix = of([_strings(t.words[:len(t.words) - t.need + 1]) for t in kinds])
    return (pairs.withColumn("shared", shared).filter((F.col("shared") >= F.col("need")) & (F.array_intersect("tokens", prefix)[0] == F.col("token")))  # a pair comes once
            .select("doc_id", "tkey", "size", "block", of([F.lit(t.label) for t in kinds]).alias("label"),
                    F.col("tid").alias("template"), (F.col("shared") / F.col("n")).alias("containment"),
                    (F.size(F.array_except(marks, "tokens")) == 0).alias("distinguished")))


def read_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES,
               threshold: float = 0.8) -> DataFrame:
    """One pass over the texts: ``doc_id, tkey, n_words, p0, p1 ..., marked``; ``p<k>`` are the places of phrase k."""
    lower = docs.select(column(id_col).alias("doc_id"), text_key(text_col).alias("tkey"), words_of(text_col).alias("words"))
    vocabulary = sorted({w for _, p in phrases for w in p.split(" ")} | set(_vocabulary(_templates(templates, threshold))))
    lower = lower.withColumn("have", F.array_intersect(_strings(vocabulary), "words"))
    none = F.array().cast("array<int>")
    places = []
    for k, (p, _) in enumerate(phrases):  # looked for only where all its words stand
        hinted = F.lit(True)
        for w in sorted(set(p.split(" "))):
            hinted = hinted & F.array_contains("have", w)
        places.append(F.when(hinted, phrase_places(F.col("words"), p)).otherwise(none).alias(f"p{k}"))
    return lower.select("doc_id", "tkey", F.size("words").cast("long").alias("n_words"), *places,
                        _marked(F.col("words"), F.col("have"), _templates(templates, threshold)).alias("marked"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES,
                  templates=TEMPLATES, threshold: float = 0.8, links: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``; with ``links``
    also ``n_links``, the number of templates that a block of it is linked to, labelled or not.

    Null text is empty: 0 words, empty labels, score 0, null first and last. ``score`` is 1 where a phrase stands, else
    the largest containment of a link that gives its label, else 0. Rows equal in id and text get equal results, other columns
    of ``docs`` are ignored, empty input gives an empty result, work is linear in a text's words.
    """
    read = materialise(read_texts(docs, id_col, text_col, phrases, templates, threshold), "license-words")
    places = F.concat(*[F.col(f"p{k}") for k in range(len(phrases))])
    found = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(phrases)]))
    base = read.select("doc_id", "tkey", "n_words", F.size(places).cast("long").alias("n_base"),
                       F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
                       found.alias("base"))
    hits = (template_matches(read.select("doc_id", "tkey", "marked"), templates, threshold).groupBy("doc_id", "tkey")
            .agg(F.collect_set(F.when(F.col("distinguished"), F.col("label"))).alias("more"), F.max(F.when(F.col("distinguished"), F.col("containment"))).alias("containment"),
                 F.size(F.collect_set("template")).cast("long").alias("n_links"))
            .select(F.col("doc_id").alias("hit_id"), F.col("tkey").alias("hit_key"), "more", "containment", "n_links"))
    out = base.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("tkey") == F.col("hit_key")), "left")
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", listed(F.col("base")).alias("base_labels"),
                      listed(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
                      F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
                      *[F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")] * links)


def sql(threshold: float = 0.8) -> str:
    """The same rows by plain containment of every block and template."""
    fold = lambda c: f"regexp_extract_all(translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ALNUM}')"
    places = []
    for phrase, _ in PHRASES:
        test = " AND ".join(f"w[i{f' + {k}' if k else ''}] = '{p}'" for k, p in enumerate(phrase.split(" ")))
        places.append(f"list_filter(range(1, len(w) + 1), lambda i: {test})")
    base = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(PHRASES))
    rows = []
    for t in _templates(TEMPLATES, threshold):
        listed = lambda words: f"[{', '.join(map(repr, words))}]"
        rows.append(f"('{t.label}', {t.need}, {t.size}, {listed(t.words)}, {listed(t.marks)})")
    blocks = " UNION ALL ".join(f"SELECT doc_id, {size} AS size, list_distinct(list_slice(w, s + 1, s + {size})) AS toks "
                                f"FROM (SELECT doc_id, w, unnest(range(0, len(w), {size // 4})) AS s FROM d)" for size in BLOCKS)
    every = " || ".join(f"p{k}" for k in range(len(PHRASES)))
    return f"""
WITH d AS (SELECT doc_id, {fold("coalesce(text, '')")} AS w FROM documents),
     p AS (SELECT *, {', '.join(f'{c} AS p{k}' for k, c in enumerate(places))} FROM d),
     t(label, need, size, toks, marks) AS (VALUES {', '.join(rows)}),
     b AS ({blocks}),
     m AS (SELECT b.doc_id, list(DISTINCT t.label) AS more, max(len(list_intersect(b.toks, t.toks)) / len(t.toks)) AS best
           FROM b JOIN t ON b.size = t.size AND list_has_all(b.toks, t.marks) AND len(list_intersect(b.toks, t.toks)) >= t.need GROUP BY b.doc_id),
     x AS (SELECT p.doc_id, len(w) AS n_words, {every} AS places, list_filter([{base}], lambda l: l IS NOT NULL) AS base, m.more, m.best FROM p LEFT JOIN m ON m.doc_id = p.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, list_min(places) - 1 AS first_word, list_max(places) - 1 AS last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels, coalesce(array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ','), '') AS labels,
       CASE WHEN len(places) > 0 THEN 1e0 ELSE coalesce(best, 0e0) END AS score
FROM x
"""
