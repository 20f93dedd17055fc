"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The automaton holds every word sequence of every item in states linear in the items' words. A document's words are
streamed through it once; the longest match that ends at each word tells the hit words, and the state tells which
items hold the last ``window`` words. Documents never shuffle: they are mapped against the broadcast automaton. Items
are counted first; beyond ``shard_words`` they are dealt into shards, one bounded automaton and one pass each.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import column, map_whole_rows, materialise, own_names, text_key, whole_text

#: A-Z to a-z; whatever is neither letter, digit nor beyond ASCII becomes a blank.
FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
FOLDED_WORD = re.compile(b"[^ ]+")


def folded_words(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


SPANS = T.ArrayType(T.StructType().add("a", "integer").add("b", "integer"))


class ItemAutomaton:
    """``items``: (item_id, text as bytes). Windows have ``window`` words, an item of fewer is one window."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.window, self.vocab = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        words = [(item, [self.vocab.setdefault(w, len(self.vocab)) for w in folded_words(text)]) for item, text in items]
        for _, ids in words:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        # the state that stands for the last `window` words of a longer match
        self.tail = [-1] * len(self.link)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            if self.length[v] >= window:
                self.tail[v] = v if self.length[self.link[v]] < window else self.tail[self.link[v]]
        self.items_at: dict[int, set[str]] = {}
        short: dict[int, list[tuple[int, str]]] = {}
        for item, ids in words:
            v = 0
            for k, c in enumerate(ids, 1):
                v = self.next[v][c]
                if k >= window:
                    # the whole prefix is a path from the root, so the tail state is exact
                    self.items_at.setdefault(self.tail[v], set()).add(item)
            if 0 < len(ids) < window:
                short.setdefault(v, []).append((len(ids), item))
        self.short = short
        #: nearest state on the way to the root, itself included, where a short item ends
        self.short_at = [-1] * len(self.link)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.short_at[v] = v if v in short else self.short_at[self.link[v]]
        self.least = min([window, *(n for at in short.values() for n, _ in at)])

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(link)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        new = len(self.link)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches of words (start, end exclusive; merged) and the ids of the items hit."""
        n, get = len(words), self.vocab.get
        if n < self.least:
            return [], set()
        ids = np.fromiter((get(w, -1) for w in words), np.int64, n)
        # a match lies within a stretch of known words; shorter stretches can't hold a window
        edge = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).astype(np.int8), [0]))))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a >= self.least:
                self._scan_known(ids[a:b].tolist(), a, spans, found)
        return _merged(spans), found

    def _scan_known(self, ids: list[int], base: int, spans: list, found: set) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        v = matched = 0
        for i, c in enumerate(ids, base):
            to = nxt[v].get(c)
            while to is None and v:
                v = link[v]
                matched = length[v]
                to = nxt[v].get(c)
            if to is None:
                continue
            v, matched = to, matched + 1
            if matched >= window:
                spans.append((i - matched + 1, i + 1))
                found |= self.items_at[self.tail[v]]
            s = self.short_at[v]
            while s > 0:
                for size, item in self.short[s]:
                    if size <= matched:
                        spans.append((i - size + 1, i + 1))
                        found.add(item)
                s = self.short_at[link[s]] if link[s] > 0 else -1


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _items(benchmark: DataFrame, id_col: str, text_col: str, shard_words: int) -> tuple[DataFrame, int]:
    """``item, text`` and the number of shards."""
    items = benchmark.select(F.coalesce(column(id_col).cast("string"), F.lit("")).alias("item"),
                             whole_text(text_col).cast("binary").alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    return items, 1 + total // (2 * shard_words)  # a word takes two bytes at least, its separator included


def automata(items: DataFrame, shards: int, window: int):
    """Bounded automata, one a shard; they are made one after another."""
    for k in range(shards):
        part = items if shards == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == k)
        yield ItemAutomaton([(r["item"], bytes(r["text"])) for r in part.toLocalIterator()], window)


def _texts(batch: pa.RecordBatch, at: str | int) -> list[bytes | None]:
    return batch.column(at).cast(pa.binary()).to_pylist()


def find_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10,
              shard_words: int = 2_000_000) -> DataFrame:
    """One row per input row: ``doc_id, tkey, n_words, spans array<struct<a,b>>, items array<string>``.

    Null text has no words, null or empty items match nothing, a null item id counts as ''. Items of one id are one
    item. Rows equal in id and text get equal results. Empty tables give empty results or no hits.
    """
    spark = docs.sparkSession
    rows = docs.select(column(id_col).alias("doc_id"), text_key(text_col).alias("tkey"), column(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["tkey"]])
    schema = schema.add("n_words", "long").add("spans", SPANS).add("items", T.ArrayType(T.StringType()))
    parts = []
    for automaton in automata(*_items(benchmark, item_id_col, item_text_col, shard_words), window):
        shared = spark.sparkContext.broadcast(automaton)

        def scan(batches, shared=shared):
            auto = shared.value
            for batch in batches:
                counts, spans, items = [], [], []
                for text in _texts(batch, "text"):
                    words = folded_words(text)
                    at, found = auto.scan(words)
                    counts.append(len(words))
                    spans.append([{"a": a, "b": b} for a, b in at])
                    items.append(sorted(found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("tkey"), pa.array(counts, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                     pa.array(items, pa.list_(pa.string()))], names=["doc_id", "tkey", "n_words", "spans", "items"])

        parts.append(rows.mapInArrow(scan, schema))
    if len(parts) == 1:
        return parts[0]
    # rows that no shard hits needn't meet; of the others the shards' findings do
    out = parts[0]
    for more in parts[1:]:
        hit = (more.filter(F.size("items") > 0).dropDuplicates(["doc_id", "tkey"])
               .select(F.col("doc_id").alias("r_id"), F.col("tkey").alias("r_key"), F.col("spans").alias("r_spans"), F.col("items").alias("r_items")))
        out = (out.join(hit, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("tkey") == F.col("r_key")), "left")
               .select("doc_id", "tkey", "n_words",
                       F.concat("spans", F.coalesce("r_spans", F.array().cast("array<struct<a:int,b:int>>"))).alias("spans"),
                       F.array_sort(F.array_union("items", F.coalesce("r_items", F.array().cast("array<string>")))).alias("items")))

    def merge(batches):
        for batch in batches:
            spans = [[{"a": a, "b": b} for a, b in _merged([(s["a"], s["b"]) for s in row])] for row in batch.column("spans").to_pylist()]
            at = batch.schema.get_field_index("spans")
            yield batch.set_column(at, batch.schema.field(at), pa.array(spans, batch.schema.field(at).type))

    return out.mapInArrow(merge, schema)


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per row."""
    hits = find_hits(docs, benchmark, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of the spans, from each span's first letter to its last."""
    places = [m.span() for m in FOLDED_WORD.finditer(text.translate(FOLD))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, max_coverage: float = 0.8,
                  shard_words: int = 2_000_000) -> DataFrame:
    """``docs`` with every span of a benchmark window cut; documents covered beyond ``max_coverage`` go.

    Columns stay as they are; documents without hits, null and blank texts included, stay untouched; repeated rows are
    treated alike; an empty table stays empty, an empty benchmark leaves all as it was; a text of any length is scanned
    once a shard. Cutting may leave two halves side by side; they are not searched again. Every shard of items reads the texts as they came; what the shards find in
    a text is merged before its coverage is tested and it is cut once.
    """
    spark = docs.sparkSession
    items, shards = _items(benchmark, item_id_col, item_text_col, shard_words)
    at = docs.columns.index(text_col)

    def cleaned(batch, found):
        """``batch`` with ``found``, the merged spans of each row, cut."""
        texts, keep = _texts(batch, at), []
        for k, (text, spans) in enumerate(zip(texts, found, strict=True)):
            if spans:
                if sum(b - a for a, b in spans) > max_coverage * len(folded_words(text)):
                    continue
                texts[k] = cut_spans(text, spans)
            keep.append(k)
        new = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
        return batch.set_column(at, batch.schema.field(at), new).take(pa.array(keep, pa.int64()))

    if shards == 1:
        shared = spark.sparkContext.broadcast(next(automata(items, shards, window)))

        def clean(batches):
            for batch in batches:
                yield cleaned(batch, [shared.value.scan(folded_words(t))[0] for t in _texts(batch, at)])

        return map_whole_rows(docs, clean)

    # spans depend on the text alone, so each distinct text hit has one row a shard; texts don't move with them
    key = lambda: F.struct(text_key(text_col).alias("h"), F.length(whole_text(text_col)).alias("n"))
    rows = docs.select(key().alias("key"), column(text_col).cast("string").alias("text"))
    parts = []
    for automaton in automata(items, shards, window):
        shared = spark.sparkContext.broadcast(automaton)

        def scan(batches, shared=shared):
            for batch in batches:
                spans = [[{"a": a, "b": b} for a, b in shared.value.scan(folded_words(t))[0]] for t in _texts(batch, "text")]
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(spans, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))],
                                                 names=["key", "spans"])

        hits = rows.mapInArrow(scan, T.StructType([rows.schema["key"]]).add("spans", SPANS))
        parts.append(materialise(hits.filter(F.size("spans") > 0).dropDuplicates(["key"]), "leak-spans"))
        shared.unpersist()
    own_key, found_key, all_spans = own_names(docs, "__key", "__found", "__spans")
    # one row a shard for each text hit, so what is collected is bounded by the shards
    every = reduce(DataFrame.unionByName, parts).groupBy(F.col("key").alias(found_key)).agg(F.flatten(F.collect_list("spans")).alias(all_spans))
    joined = docs.withColumn(own_key, key()).join(every, F.col(own_key) == F.col(found_key), "left").select(*[column(c) for c in docs.columns], all_spans)

    def cut(batches):
        for batch in batches:
            found = [_merged([(s["a"], s["b"]) for s in spans or ()]) for spans in batch.column(batch.num_columns - 1).to_pylist()]
            yield cleaned(batch.select(batch.schema.names[:-1]), found)

    return map_whole_rows(joined, cut, len(docs.columns))


_SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark),
     t AS (SELECT item, least(len(w), 10) AS n, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0),
     g AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS words FROM t),
     d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
     x AS (SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS words
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
     h AS (SELECT x.doc_id, x.s, x.n, g.item FROM x JOIN g ON g.n = x.n AND g.words = x.words),
     c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
     f AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN f ON f.doc_id = d.doc_id
"""

__all__ = ["SQL", "ItemAutomaton", "contamination_report", "cut_spans", "decontaminate", "find_hits", "folded_words"]
