"""Rows that every operator must take: nulls, blanks, very long texts, ties, repeats, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string"


def odd_rows():
    long = " ".join(f"w{k % 977}" for k in range(30_000))
    return [(1, None, "en", "s1"), (2, "", None, None), (3, " \t\n ", "en", "s1"), (4, long, "en", "s2"), (5, long, "de", "s2"),
            (6, "same text here", "en", "s3"), (6, "same text here", "en", "s3"), (6, "another text", "en", "s3"),
            (None, "same text here", "en", "s1"), (None, None, None, None), (7, "é ß 😀 ünï code", "fr", "s4"), (8, "x" * 50_000, "en", "s5")]


#: Names that the operators use themselves, in either case, and one with a dot.
CLASHES = ("h", "size", "digest", "content", "salt", "tkey", "key", "n", "g", "fp", "pos", "site", "copies", "score", "label", "base", "words", "line", "u", "v",
           "__key", "__id", "__cut", "__keep", "__tkey", "__ROW", "__N_LINES", "__n_removed", "__spans", "mix_copies", "text_", "node", "root", "part", "doc",
           "component_id", "spans", "items", "found", "near", "marked", "id", "y", "a.b")


def odd(spark):
    """With columns named like the operators' own."""
    return spark.createDataFrame(odd_rows(), SCHEMA).selectExpr("*", *[f"'x {c}' AS `{c}`" for c in CLASHES])


def huge(spark):
    """A text of 5 MB among short ones, repeated rows and a null."""
    text = "\n".join(f"line {k % 5000} of a long text with number {k}" for k in range(130_000))
    return spark.createDataFrame([(1, text, "en", "s1"), (2, "short", "en", "s2"), (2, "short", "en", "s2"), (3, None, None, None)], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def random_docs(n, seed, vocabulary=6, longest=60):
    rng = random.Random(seed)
    return [(k, " ".join(f"v{rng.randrange(vocabulary)}" for _ in range(rng.randrange(longest))), "en", f"s{rng.randrange(4)}") for k in range(n)]
