"""Personal data: base patterns, and bootstrapped contextual extraction (native).

Base entities (e-mail, IP address, card, phone) are the seeds. Every token that could be an identifier (it holds a digit
or an at sign) is an instance, its neighbouring words are patterns: the two words before it, and the word on either side.
Instances and patterns make a bipartite graph of the whole corpus. Seeds have score 1; in each round a pattern is scored
by the share of its distinct instances that score, an instance by the noisy-or of its patterns, and the instances of
patterns above ``confidence`` with ``support`` distinct seeds become seeds of the next round. After the last round,
patterns above ``confidence`` with ``support`` distinct seeds or more mark the instances in their slots that no base
pattern has found. All of this is DataFrame aggregation and equi-joins; counts are of distinct strings, so copies of a
document lend a pattern no weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import BROADCAST_ROWS, ascii_lower, broadcast_if_small, column, join_counted, let, materialise, text_key, whole_text

_S = r"\x20\x09-\x0D"
#: The base patterns. Those below match the same stretches; possessive repeats and the checks of what
#: stands before keep the matcher linear and off the stack on very long runs.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: A phone-like run, or a token that holds a digit or an at sign.
CANDIDATE = rf"\+[0-9][\x20().0-9-]+[0-9]|(?<![^{_S}])[^{_S}0-9@]*+[0-9@][^{_S}]*+"
KINDS = ("email", "ip", "card", "phone")
SPAN = "struct<start:int,end:int,text:string>"
_NONE = f"array<{SPAN}>"


def _running(lengths: Column) -> Column:
    """Running sums of a non-empty array of integers.

    Appending copies an array, so sums run over about sqrt(n) stretches of sqrt(n) elements: n^1.5 copied integers."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends"))
    after = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["ends"], acc["at"] + x).alias("ends"))
    before = lambda acc, x: F.struct((acc["at"] + F.element_at(x, -1)).alias("at"), F.array_append(acc["ends"], acc["at"]).alias("ends"))

    def stretches(every: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(every))).cast("int")
        last = F.floor((F.size(every) - 1) / width).cast("int")
        return F.transform(F.sequence(F.lit(0), last),
                           lambda j: F.aggregate(F.slice(every, j * width + 1, width), start, after, lambda acc: acc["ends"]))

    def joined(parts: Column) -> Column:
        return F.flatten(F.zip_with(parts, F.aggregate(parts, start, before, lambda acc: acc["ends"]),
                                    lambda own, at: F.transform(own, lambda end: end + at)))

    return let(lengths, lambda every: let(stretches(every), joined))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their places in code points, for texts with one or more: array of (start, end, text)."""
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(f: Column) -> Column:
        lengths = F.slice(F.zip_with(parts, f, lambda p, m: F.length(p) + F.length(m)), 1, F.size(f))
        return F.zip_with(_running(lengths), f, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("text")))

    return let(found, placed)


def _guarded(text: Column, pattern: str, hint: Column) -> Column:
    """Matches are worked out only where there is one."""
    return F.when(hint & text.rlike(pattern), matches(text, pattern)).otherwise(F.array().cast(_NONE))


def base_spans(text: Column) -> dict[str, Column]:
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    some_digit = text.rlike("[0-9]")
    return {
        "email": _guarded(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(_guarded(text, IP, some_digit), lambda s: s["text"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")),
        "card": F.filter(_guarded(text, CARD, some_digit), lambda s: F.length(digits(s["text"])).between(13, 19)
                         & F.call_function("luhn_check", digits(s["text"]))),
        "phone": F.filter(_guarded(text, PHONE, F.contains(text, F.lit("+"))), lambda s: F.length(digits(s["text"])).between(9, 15)),
    }


def _flags(spans: Column) -> Column:
    """A byte for each code point up to the last span's end: 1 within a span, else 0. Bytes, so that a place is found at once."""

    def bytes_of(s: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(s, lambda x: x["end"]))
        return F.array_join(F.zip_with(s, F.slice(ends, 1, F.size(s)), lambda x, end: F.concat(
            F.repeat(F.lit("0"), x["start"] - end), F.repeat(F.lit("1"), x["end"] - x["start"]))), "")

    return F.when(F.size(spans) > 0, let(spans, bytes_of)).cast("binary")


def _neighbourhoods(candidates: Column, parts: Column, flags: Column) -> Column:
    """For each candidate its place, whether a base span meets it, and its two patterns: the two words before it, and the
    word on either side. Small rows, so that exploding them stays linear."""
    n = F.size(candidates)
    words = F.transform(parts, lambda p: F.trim(ascii_lower(F.regexp_replace(p, f"[{_S}]+", " "))))

    def row(x: Column, flags: Column) -> Column:
        c, before, after = x["candidates"], x["1"], x["2"]
        met = F.lit(False)
        for k in KINDS:
            met = met | F.coalesce(F.contains(F.substr(flags[k], c["start"] + 1, c["end"] - c["start"]), F.lit("1").cast("binary")), F.lit(False))
        two = F.concat(F.lit("L "), F.substring_index(before, " ", -2))
        around = F.concat(F.lit("C "), F.substring_index(before, " ", -1), F.lit(" _ "), F.substring_index(after, " ", 1))
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), ascii_lower(c["text"]).alias("instance"), met.alias("seed"),
                        F.array(two, around).alias("patterns"))

    return let(flags, lambda f: let(words, lambda w: F.transform(F.arrays_zip(candidates, F.slice(w, 1, n), F.slice(w, 2, n)), lambda x: row(x, f))))


def _occurrences(found: DataFrame) -> DataFrame:
    """A row for each identifier-like token: where it stands, whether a base span meets it, and its patterns."""
    return found.select("doc_id", "tkey", F.explode("near").alias("c")).select("doc_id", "tkey", "c.*")


def score_patterns(edges: DataFrame, rounds: int = 3, support: int = 5, confidence: float = 0.8) -> DataFrame:
    """``edges``: distinct (pattern, instance, seed). Result: ``pattern, confidence, seeds`` of patterns with ``support``
    distinct seed instances or more after the last round. Every edge takes part in every round; instances in the slots of
    patterns at ``confidence`` with that support are seeds of the next round.

    A pattern or instance that a third of all edges share is never one task's: scores are aggregated map-side first, and
    joined back by broadcast (few patterns, or the hot ones)."""
    edges = materialise(edges.select("pattern", "instance", "seed"), "pii-edges")
    rows = edges.count()
    scores = edges.withColumn("score", F.when(F.col("seed"), 1.0).otherwise(0.0))
    for k in range(rounds):
        graded = scores.groupBy("pattern").agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("confidence"), F.count_if("seed").alias("seeds"),
                                               F.count(F.lit(1)).alias("n"))
        graded = materialise(graded, "pii-patterns")
        if k + 1 == rounds:
            break
        telling = graded.filter("confidence > 0")
        if telling.count() <= BROADCAST_ROWS:
            told = edges.join(F.broadcast(telling), "pattern", "left")
        else:
            told = join_counted(edges, graded, "pattern", rows)
        share = F.coalesce("confidence", F.lit(0.0))
        strong = F.coalesce((F.col("seeds") >= support) & (share >= confidence), F.lit(False))
        votes = materialise(told.groupBy("instance").agg((1 - F.exp(F.sum(F.log(1 - F.least(share, F.lit(0.999)))))).alias("vote"),
                                                         F.bool_or(strong).alias("found"), F.count(F.lit(1)).alias("n")), "pii-votes")
        seed = F.col("seed") | F.col("found")
        scores = join_counted(edges, votes, "instance", rows).select(
            "pattern", "instance", seed.alias("seed"), F.when(seed, 1.0).otherwise(F.col("vote")).alias("score"))
    return graded.filter(F.col("seeds") >= support).select("pattern", "confidence", "seeds")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, support: int = 5,
             confidence: float = 0.8) -> DataFrame:
    """One row per input row: ``doc_id, email, ip, card, phone, context``, arrays of (start, end) in code points.

    Null text is empty. Rows equal in id and text get equal results; other columns are ignored; empty input gives an
    empty result. ``context`` spans never meet a base span. A text of n candidates takes n^1.5 integer copies and
    otherwise linear work, whatever its length.
    """
    text = whole_text(text_col)
    rows = docs.select(column(id_col).alias("doc_id"), text_key(text_col).alias("tkey"), text.alias("text"))
    spans = base_spans(F.col("text"))
    some = F.col("text").rlike(CANDIDATE)
    rows = rows.select("doc_id", "tkey", *[c.alias(k) for k, c in spans.items()], F.when(some, matches(F.col("text"), CANDIDATE)).alias("candidates"),
                       F.when(some, F.split("text", CANDIDATE, -1)).alias("parts"))
    flags = F.struct(*[_flags(F.col(k)).alias(k) for k in KINDS])
    near = F.when(F.size("candidates") > 0, _neighbourhoods(F.col("candidates"), F.col("parts"), flags))
    # whatever is needed later, without the texts
    found = materialise(rows.select("doc_id", "tkey", *KINDS, near.alias("near")), "pii-found")
    seen = _occurrences(found.filter("near IS NOT NULL"))
    edges = (seen.select(F.explode("patterns").alias("pattern"), "instance", "seed")
             .groupBy("pattern", "instance").agg(F.bool_or("seed").alias("seed")))
    strong = materialise(score_patterns(edges, rounds, support, confidence).filter(F.col("confidence") >= confidence).select("pattern"), "pii-strong")
    strong = broadcast_if_small(strong, strong.count())
    more = (seen.filter(~F.col("seed")).select("doc_id", "tkey", "start", "end", F.explode("patterns").alias("pattern"))
            .join(strong, "pattern", "left_semi").groupBy("doc_id", "tkey")
            .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("context"))
            .select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key"), "context"))
    out = found.join(more, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tkey") == F.col("__key")), "left")
    place = lambda k: F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k)
    return out.select("doc_id", *[place(k) for k in KINDS],
                      F.coalesce("context", F.array().cast("array<struct<start:int,end:int>>")).alias("context"))


def pii_report(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, n_context, n_spans, has_pii, base_sha256, spans`` per row."""
    found = find_pii(docs, **options)
    told = lambda k: F.transform(k, lambda s: F.concat_ws(":", F.lit(k), s["start"].cast("string"), s["end"].cast("string")))
    base = F.concat(*[told(k) for k in KINDS])
    every = sum((F.size(k) for k in KINDS), F.size("context")).cast("long")
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in (*KINDS, "context")], every.alias("n_spans"), (every > 0).alias("has_pii"),
                        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                        F.array_join(F.concat(base, told("context")), ",").alias("spans"))
