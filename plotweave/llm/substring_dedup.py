"""Substring deduplication with a log-structured index of window hashes.

The index is a list of sorted, immutable runs in the shared folder, dealt into buckets by hash range. A batch of
documents goes through three steps:

1. Pieces of about ``piece_bytes`` of text turn into sorted hash runs where they are read; a longer text goes in
   stretches. A window that several documents of a piece hold is settled there but for its smallest document, so a
   passage that a third of all documents carry sends one entry a piece. An entry is hash, check, document and place, at
   most 32 bytes and about 15 packed; nothing else travels with it, so the bytes sent stay in proportion to the windows
   however many pieces and buckets there are.
2. Each bucket merges the batch's runs and merge-joins them with the historical runs, one at a time. Equal hashes are
   verified by a second, independent hash of the window's words. Windows of a smaller document or of history are
   repeats; new hashes become a new immutable run, written by the same job.
3. Where that would make more than ``fanout`` runs, the job writes history and new hashes as one run instead, which
   replaces the others: compaction reads nothing that the merge has not read already.

A run is a bucketed table, so history is merged where it lies: only the batch is shuffled.

Batches come in order of ids, so history always stands for smaller ids. At last, words under repeated windows are cut
from the texts, which meet their repeats by id.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import arrow_rows, broadcast_if_small, column, discard, materialise, shared_dir, shuffle_cleanup

#: What a null id counts as: larger than any other.
NO_ID = (1 << 63) - 1
#: A row is a sorted run of ``n`` entries. HASHES: hashes, checks, ids, places, text keys (the last three empty in
#: history). REPEATS: ids, text keys and places of repeated windows of the documents of group ``g``.
RUN = "kind int, key int, g long, n long, a binary, b binary, c binary, d binary, e binary"
REPEATS, HASHES = 0, 1
#: Entries of one historical row, so that a merge unpacks a bounded part of history at a time.
ROW_ENTRIES = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _odd_constants(n: int, seed: int) -> list[int]:
    return [xxhash.xxh3_64_intdigest(str(k), seed) | 1 for k in range(n)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class WindowHasher:
    """Two independent hashes, 64 and 32 bits, of every window of ``size`` words."""

    def __init__(self, size: int, cache: int = 100_000):
        self.size, self.cache = size, cache
        self.weights = [np.array(_odd_constants(size, s), np.uint64) for s in (1, 2)]
        self.seen: dict[bytes, int] = {}
        self.table = np.zeros((2, 4096), np.uint64)

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        seen = self.seen
        if len(seen) > self.cache:
            seen.clear()
        fresh = [w for w in set(words) if w not in seen]
        at = len(seen)
        for k, w in enumerate(fresh, at):
            seen[w] = k
        if len(seen) > self.table.shape[1]:
            grown = np.zeros((2, 2 * len(seen)), np.uint64)
            grown[:, :at] = self.table[:, :at]
            self.table = grown
        for row in (0, 1):
            self.table[row, at:len(seen)] = [xxhash.xxh3_64_intdigest(w, row + 11) for w in fresh]
        return self.table[:, np.fromiter(map(seen.__getitem__, words), np.int64, len(words))]

    def windows(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of the windows that start at each word but the last ``size - 1``."""
        h = self.word_hashes(words)
        n = len(words) - self.size + 1
        out = []
        for row, weights in enumerate(self.weights):
            total = np.zeros(n, np.uint64)
            for k, w in enumerate(weights):
                total += h[row, k:k + n] * w
            out.append(_mixed(total))
        return out[0], (out[1] >> np.uint64(32)).astype(np.uint32)


def packed(values: np.ndarray, delta: bool = False) -> bytes:
    """Byte planes, compressed; sorted values as differences."""
    if delta and len(values):
        values = np.concatenate((values[:1], values[1:] - values[:-1]))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T.copy()
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, dtype, delta: bool = False) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True) if n else b""
    values = np.frombuffer(raw, np.uint8).reshape(size, n).T.copy().view(dtype).reshape(n)
    return np.cumsum(values, dtype=dtype) if delta else values


def _groups(h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and group starts of equal (hash, check) pairs."""
    order = np.argsort(h, kind="stable")
    hs, cs = h[order], check[order]
    same = hs[1:] == hs[:-1]
    if (same & (cs[1:] != cs[:-1])).any():  # one hash, unlike windows: told apart by the check
        order = np.lexsort((check, h))
        hs, cs = h[order], check[order]
        same = (hs[1:] == hs[:-1]) & (cs[1:] == cs[:-1])
    return order, np.flatnonzero(np.concatenate(([True], ~same))) if len(h) else np.zeros(0, np.int64)


def _repeat_rows(key_of, groups: int, doc: np.ndarray, part: np.ndarray, pos: np.ndarray) -> list[tuple]:
    """Rows of repeated windows by the group that their document belongs to."""
    if not len(doc):
        return []
    g = (doc ^ part) % groups
    order = np.lexsort((pos, part, doc, g))
    g, doc, part, pos = g[order], doc[order], part[order], pos[order]
    cuts = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))).tolist()
    return [(REPEATS, key_of(int(g[a])), int(g[a]), b - a, packed(doc[a:b], True), packed(part[a:b], True), packed(pos[a:b], True), b"", b"")
            for a, b in zip(cuts, [*cuts[1:], len(g)], strict=True)]


def _batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=["kind", "key", "g", "n", "a", "b", "c", "d", "e"])


def _settled(h, check, doc):
    """Entries that a smaller document of the same piece repeats, and those that only others can settle."""
    order, starts = _groups(h, check)
    least = np.minimum.reduceat(doc[order], starts) if len(starts) else doc[:0]
    sizes = np.diff(np.append(starts, len(h)))
    repeat = doc[order] > np.repeat(least, sizes)
    return order[repeat], order[~repeat]


def stretches(text: bytes, size: int, window: int):
    """(place of the first word, words) of stretches of about ``size`` bytes; each window lies in exactly one."""
    if len(text) <= size:
        yield 0, text.split()
        return
    at = place = 0
    tail: list[bytes] = []
    while at < len(text):
        cut = _BLANK.search(text, at + size)
        end = cut.start() if cut else len(text)
        words = tail + text[at:end].split()
        yield place, words
        tail = words[max(0, len(words) - window + 1):]
        place += len(words) - len(tail)
        at = end


def piece_runs(window: int, buckets: int, groups: int, piece_bytes: int):
    """A function from batches of (doc, part, text) to run rows, for mapInArrow."""
    shift = np.uint64(64 - buckets.bit_length() + 1)

    def emit(hasher, held):
        words: list[bytes] = []
        starts = [0]
        for *_, own in held:
            words += own
            starts.append(len(words))
        if len(words) < window:
            return
        starts = np.array(starts, np.int64)
        h, check = hasher.windows(words)
        del words
        at = np.arange(len(h))
        owner = np.searchsorted(starts, at, side="right") - 1
        inside = at + window <= starts[owner + 1]  # windows don't cross documents
        h, check, at, owner = h[inside], check[inside], at[inside], owner[inside]
        doc, part, place = (np.array([x[k] for x in held], np.int64) for k in range(3))
        pos = (at - starts[owner] + place[owner]).astype(np.uint32)
        settled, rest = _settled(h, check, doc[owner])
        rows = _repeat_rows(lambda g: g % buckets, groups, doc[owner[settled]], part[owner[settled]], pos[settled])
        h, check, pos, owner = h[rest], check[rest], pos[rest], owner[rest]
        edges = np.searchsorted(h >> shift, np.arange(buckets + 1, dtype=np.uint64)).tolist() if buckets > 1 else [0, len(h)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            if b > a:
                rows.append((HASHES, k, 0, b - a, packed(h[a:b], True), packed(check[a:b]), packed(doc[owner[a:b]]), packed(pos[a:b]), packed(part[owner[a:b]])))
        for a in range(0, len(rows), 512):
            yield _batch_of(rows[a:a + 512])

    def run(batches):
        hasher = WindowHasher(window)
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc, part, text in zip(*(batch.column(c) for c in ("doc", "part", "text")), strict=True):
                for place, words in stretches(text.as_py(), piece_bytes, window):
                    held.append((doc.as_py(), part.as_py(), place, words))
                    size += sum(map(len, words)) + len(words)
                    if size >= piece_bytes:
                        yield from emit(hasher, held)
                        held, size = [], 0
        if held:
            yield from emit(hasher, held)

    return run


def _runs_of(rows: list[dict], kind: int):
    return [r for r in rows if r["kind"] == kind]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    h, check = (np.concatenate(c) for c in zip(*parts, strict=True))
    order, starts = _groups(h, check)
    at = order[starts]
    return h[at], check[at]


def merge_bucket(groups: int, compact: bool):
    """A function for cogrouped (batch runs, historical runs) of a bucket."""

    def run(batch: pa.Table, history: pa.Table) -> pa.Table:
        rows = batch.to_pylist()
        out = [tuple(r.values()) for r in _runs_of(rows, REPEATS)]
        fresh, past = _runs_of(rows, HASHES), history.to_pylist()
        del rows, batch, history
        if not fresh:
            if compact and past:
                out += _run_rows(past[0]["key"], *_merged([_hashes(r) for r in past]))
            return _table_of(out)
        key = fresh[0]["key"]
        h, check = (np.concatenate(c) for c in zip(*map(_hashes, fresh), strict=True))
        doc, pos, part = (np.concatenate([unpacked(r[c], r["n"], t) for r in fresh]) for c, t in (("c", np.int64), ("d", np.uint32), ("e", np.int64)))
        del fresh
        order, starts = _groups(h, check)
        sizes = np.diff(np.append(starts, len(h)))
        least = np.minimum.reduceat(doc[order], starts)
        own_h, own_check = h[order[starts]], check[order[starts]]
        del h, check
        known = np.zeros(len(starts), bool)
        for r in past:
            known |= _held(own_h, own_check, *_hashes(r))
        repeat = order[np.repeat(known, sizes) | (doc[order] > np.repeat(least, sizes))]
        out += _repeat_rows(lambda _: key, groups, doc[repeat], part[repeat], pos[repeat])
        del doc, pos, part, order, repeat
        own_h, own_check = own_h[~known], own_check[~known]
        if compact and past:
            own_h, own_check = _merged([*map(_hashes, past), (own_h, own_check)])
        out += _run_rows(key, own_h, own_check)
        return _table_of(out)

    return run


def _hashes(r: dict) -> tuple[np.ndarray, np.ndarray]:
    return unpacked(r["a"], r["n"], np.uint64, True), unpacked(r["b"], r["n"], np.uint32)


def _held(h: np.ndarray, check: np.ndarray, run_h: np.ndarray, run_check: np.ndarray) -> np.ndarray:
    """Which pairs the sorted run has. Beyond the first turn only where one hash stands for unlike windows."""
    out = np.zeros(len(h), bool)
    at = np.searchsorted(run_h, h)
    while True:
        there = at < len(run_h)
        there[there] = run_h[at[there]] == h[there]
        if not there.any():
            return out
        out[there] |= run_check[at[there]] == check[there]
        at = at + there


def _run_rows(key: int, h: np.ndarray, check: np.ndarray) -> list[tuple]:
    return [(HASHES, key, 0, len(h[a:a + ROW_ENTRIES]), packed(h[a:a + ROW_ENTRIES], True), packed(check[a:a + ROW_ENTRIES]), b"", b"", b"")
            for a in range(0, len(h), ROW_ENTRIES)]


def _table_of(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch_of(rows) if rows else _batch_of([(0, 0, 0, 0, b"", b"", b"", b"", b"")]).slice(0, 0)])


class WindowIndex:
    """Runs under ``path``: each a bucketed table of its own, complete once its job has committed it.

    ``buckets`` is fixed for the life of an index: a bucket's batch (about 100 bytes a window) and packed history (9 bytes
    a window) meet in one task, so choose it by the size that the index is to reach. ``groups``: how many groups the
    documents of a batch are dealt into to be cut."""

    def __init__(self, spark: SparkSession, path: str, window: int = 13, buckets: int = 16, groups: int = 1, fanout: int = 1,
                 piece_bytes: int = 2 << 20):
        if buckets & (buckets - 1) or buckets < 1:
            raise ValueError("buckets: a power of two")
        self.spark, self.path, self.window, self.buckets, self.groups = spark, path.rstrip("/"), window, buckets, groups
        self.fanout, self.piece_bytes = fanout, piece_bytes
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def runs(self) -> list[str]:
        """Committed runs, oldest first."""
        root = self._fs_path(self.path)
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root) if s.isDirectory()]
        return sorted(n for n in names if self._fs.exists(self._fs_path(f"{self.path}/{n}/_SUCCESS")))

    def _table(self, run: str) -> str:
        return f"plotweave_{xxhash.xxh64_hexdigest(self.path)}_{run.replace('-', '_')}"

    def _read(self, run: str, kind: int) -> DataFrame:
        """Rows of a run; a session that hasn't written it learns of the table first."""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._table(run)} ({RUN}) USING parquet CLUSTERED BY (key) SORTED BY (key) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/{run}'")
        return self.spark.table(self._table(run)).filter(F.col("kind") == kind)

    def add(self, rows: DataFrame, keep: bool = True) -> DataFrame:
        """Merge a batch of (doc long, part long, text binary) into the index. Its ids must not be below earlier batches'.

        Returns its repeated windows. ``keep=False``: no later batch follows, so no run is written. A failure between the
        new run's commit and the old ones' removal leaves hashes twice, never missing: sets don't mind."""
        spark = self.spark
        fresh = rows.mapInArrow(piece_runs(self.window, self.buckets, self.groups, self.piece_bytes), RUN)
        past = self.runs()
        compact = keep and len(past) + 1 > self.fanout
        history = reduce(DataFrame.unionByName, [self._read(r, HASHES) for r in past]) if past else spark.createDataFrame([], RUN)
        merged = (fresh.groupBy("key").cogroup(history.groupBy("key"))
                  .applyInArrow(merge_bucket(self.groups, compact), RUN))
        with shuffle_cleanup(spark), arrow_rows(spark, 1000):  # whole texts are long rows
            if not keep:
                return materialise(merged.filter(F.col("kind") == REPEATS), "window-repeats")
            name = f"run-{1 + max([0, *(int(n.split('-')[1]) for n in past)]):06d}"
            spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
            self._delete(name)  # what an attempt without a commit has left
            merged.write.bucketBy(self.buckets, "key").sortBy("key").format("parquet").option("path", f"{self.path}/{name}").saveAsTable(self._table(name))
            repeats = materialise(self._read(name, REPEATS), "window-repeats")
        if compact:
            self.drop(past)
        return repeats

    def _delete(self, name: str) -> None:
        self._fs.delete(self._fs_path(f"{self.path}/{name}" if name else self.path), True)

    def drop(self, runs: list[str] | None = None) -> None:
        """Forget some runs, or the whole index."""
        for run in self.runs() if runs is None else runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(run)}")
            self._delete(run)
        if runs is None:
            self._delete("")


def cut_repeats(window: int, piece_bytes: int):
    """A function for cogrouped (documents, repeats): texts without the words of repeated windows."""

    def cut(text: bytes, at: np.ndarray) -> tuple[bytes, int, int]:
        """Kept words, how many words there were and how many go. ``at``: starts of repeated windows, sorted."""
        out, n, gone = [], 0, 0
        for place, words in stretches(text, piece_bytes, 1):
            near = at[np.searchsorted(at, place - window + 1):np.searchsorted(at, place + len(words))] - place
            n += len(words)
            if len(near):
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, np.maximum(near, 0), 1)
                np.add.at(cover, np.minimum(near + window, len(words)), -1)
                stay = (np.cumsum(cover)[:-1] == 0).tolist()
                words = [w for w, s in zip(words, stay, strict=True) if s]
                gone += len(stay) - len(words)
            if words:
                out.append(b" ".join(words))
        return b" ".join(out), n, gone

    def run(docs: pa.Table, repeats: pa.Table) -> pa.Table:
        found: dict[tuple[int, int], list[np.ndarray]] = {}
        for r in repeats.to_pylist():
            doc, part = unpacked(r["a"], r["n"], np.int64, True), unpacked(r["b"], r["n"], np.int64, True)
            pos = unpacked(r["c"], r["n"], np.uint32, True)
            edges = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])))).tolist()
            for a, b in zip(edges, [*edges[1:], len(doc)], strict=True):
                found.setdefault((int(doc[a]), int(part[a])), []).append(pos[a:b])
        texts, n_words, n_removed = [], [], []
        none = np.zeros(0, np.int64)
        for doc, part, text in zip(*(docs.column(c) for c in ("doc", "part", "text")), strict=True):
            hit = found.get((doc.as_py(), part.as_py()))
            kept, n, gone = cut(text.as_py(), none if hit is None else np.sort(np.concatenate(hit)).astype(np.int64))
            texts.append(kept)
            n_words.append(n)
            n_removed.append(gone)
        return pa.table({"doc_id": docs.column("doc_id"), "text": pa.array(texts, pa.binary()).cast(pa.string()),
                         "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "rows": docs.column("rows")})

    return run


def _told_apart(rows: DataFrame) -> DataFrame:
    """``doc_id, doc, part, text, rows``: ``part`` is 0, or a hash of the text where several rows share the id; rows equal in
    id and text become one, with their number."""
    shared = materialise(rows.groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc"), "window-ids")
    n = shared.count()
    if not n:
        discard(shared)
        return rows.select("doc_id", "doc", F.lit(0).cast("long").alias("part"), "text", F.lit(1).cast("long").alias("rows"))
    told = rows.join(broadcast_if_small(shared.withColumn("twice", F.lit(True)), n), "doc", "left")
    told = told.withColumn("part", F.when(F.col("twice"), F.xxhash64("text")).otherwise(F.lit(0).cast("long")))
    return materialise(told.groupBy("doc_id", "doc", "part").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("rows")), "window-rows")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, batches: int = 3,
                     bucket_windows: int = 500_000, piece_bytes: int = 2 << 20, index: WindowIndex | None = None) -> DataFrame:
    """One row per input row: ``doc_id, text, n_words, n_removed``; kept words are joined by a blank.

    A word goes if a window over it also starts in a document of a smaller id. Words are cut at blank and \\x09-\\x0D; a
    null text has none. Ids are whole numbers; a null id counts as larger than any other. Rows that share an id never
    remove each other's words; each is a row of the result. Other columns are ignored, empty input gives an empty result;
    very long texts are read in stretches of ``piece_bytes``.

    ``index``: a lasting index whose history counts as smaller ids and takes in this call's windows (its window, buckets
    and groups hold then); without one, the call's history is dropped at its end.
    """
    spark = docs.sparkSession
    text = F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(column(id_col).alias("doc_id"), F.coalesce(column(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), text.alias("text"))
    marks = [k / (batches + 0.6) for k in range(1, batches)]  # the last batch writes no run, so it may be larger
    told = rows.agg(F.sum(F.length("text")), F.percentile_approx("doc", F.array(*[F.lit(m) for m in marks]), F.lit(1000)) if marks else F.lit(None)).first()
    size, bounds = told[0] or 0, sorted(set(told[1] or []))
    rows = _told_apart(rows)
    lasting = index is not None
    if not lasting:
        buckets = 1 << max(0, int(np.ceil(np.log2(max(1, size / 5 / (len(bounds) + 1) / bucket_windows)))))
        index = WindowIndex(spark, f"{shared_dir(spark)}/window-index-{uuid.uuid4().hex}", window, buckets, _prime(size // (2 << 20)), piece_bytes=piece_bytes)
    found = []
    for low, high in zip([None, *bounds], [*bounds, None], strict=True):
        part = rows
        if low is not None:
            part = part.filter(F.col("doc") > low)
        if high is not None:
            part = part.filter(F.col("doc") <= high)
        found.append(index.add(part.select("doc", "part", "text"), keep=lasting or high is not None))
    if not lasting:
        index.drop()  # this call's history ends here
    dealt = rows.withColumn("g", F.pmod(F.col("doc").bitwiseXOR(F.col("part")), F.lit(index.groups)))
    out_type = dict(docs.select(column(id_col).alias("doc_id")).dtypes)["doc_id"]
    out = (dealt.groupBy("g").cogroup(reduce(DataFrame.unionByName, found).select("g", "n", "a", "b", "c").groupBy("g"))
           .applyInArrow(cut_repeats(index.window, index.piece_bytes), f"doc_id {out_type}, text string, n_words long, n_removed long, rows long"))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    return out.select("doc_id", "text", "n_words", "n_removed", again.alias("k")).drop("k")


def _prime(least: int) -> int:
    """The smallest prime from ``least`` on: ids in steps still spread over all groups."""
    n = max(2, least)
    while any(n % k == 0 for k in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     g AS (SELECT doc_id, s, array_to_string(list_slice(w, s, s + 12), ' ') AS words FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
     f AS (SELECT words, min(doc_id) AS first FROM g GROUP BY words),
     c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM g JOIN f USING (words) WHERE first < doc_id),
     k AS (SELECT x.doc_id, count(c.p) AS n_removed, string_agg(x.word, ' ' ORDER BY x.p) FILTER (WHERE c.p IS NULL) AS kept
           FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) x LEFT JOIN c ON c.doc_id = x.doc_id AND c.p = x.p GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
