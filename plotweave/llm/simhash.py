"""SimHash near-deduplication with vantage-point trees.

Fingerprints are made where the texts are; only 64-bit values are dealt out afterwards, each distinct value once.

Two fingerprints at ``max_distance`` or less differ in at most ``max_distance // bands`` bits of one of ``bands`` bit
bands at least. For each band a vantage-point tree over the band's Hamming distance partitions the fingerprints: a node
has a vantage point and a radius, near fingerprints go left, others right, a leaf is a shard. A fingerprint lives in one
shard a band and visits every shard that the triangle bound can't exclude, i.e. those whose boundary lies within the
band's share of the distance. Searching bands rather than all 64 bits keeps the overlap of neighbouring shards small.

Within a shard, an exact vantage-point search on all 64 bits compares visitors with residents. It returns a spanning
set of links, not all pairs, so a group of thousands of near copies stays linear; components join the shards.

The upper nodes are fitted on a documented, bounded sample (``sample`` fingerprints: those of the smallest hash). Nodes
below, and those whose sample can't be halved, take a vantage point drawn from their own number and half the band's bits
as radius, so trees are as deep as ``shard_size`` asks for at any number of fingerprints, without a model that grows.
Every fingerprint is indexed and queried. Which tree is fitted changes the balance of the shards, never the links.

With ``similarity``, groups of that Jaccard similarity of five-word shingles join too (see ``near_shingles``): copies at
0.8 differ in about ten bits, a radius at which vantage-point trees exclude next to nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import near_shingles
from ._shared import column, discard, join_counted, materialise, own_names, text_key
from .components import connected_components
from .near_shingles import _LOWER, SEED

_ONES = np.uint64(0x0101010101010101)
_LANE = 255


def simhash64(text: bytes | None, shingle: int = 3) -> int:
    """Majority bits of the shingles' XXH64; 0 without words. Words are cut at blank and \\x09-\\x0D, A-Z folded."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    if n == 1:
        hashes = np.array([digest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:n - 1])).tolist()
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)),
                             np.uint64, n)
    counts = np.zeros((8, 8), np.int64)  # [bit within byte, byte]; bytes of a word count 255 hashes at a time
    cuts = np.arange(0, n, _LANE)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _ONES, cuts)
        counts[k] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).T.reshape(64)  # byte-major: bit 8 * byte + k, little endian
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, tkey, fp`` (the 64 bits as a long) per row."""
    rows = docs.select(column(id_col).alias("doc_id"), text_key(column(text_col)).alias("tkey"), column(text_col).cast("string").alias("text"))

    def make(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = np.fromiter((simhash64(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tkey"), pa.array(fps.view(np.int64))], names=["doc_id", "tkey", "fp"])

    return rows.mapInArrow(make, T.StructType([rows.schema["doc_id"], rows.schema["tkey"]]).add("fp", "long"))


def band_masks(bands: int) -> list[int]:
    edges = [round(64 * k / bands) for k in range(bands + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]


def distance(a: np.ndarray, b, mask: int = (1 << 64) - 1) -> np.ndarray:
    return np.bitwise_count((a ^ np.uint64(b)) & np.uint64(mask)).astype(np.int16)


class VantageTree:
    """A complete tree of ``depth`` levels; node k has the children 2 k (near) and 2 k + 1 (far), the root is 1."""

    def __init__(self, sample: np.ndarray, mask: int, depth: int, least: int = 16):
        self.mask, self.depth = mask, depth
        self.points: list[np.ndarray] = []
        self.radii: list[np.ndarray] = []
        parts = {1: sample}
        for level in range(depth):
            at = np.arange(1 << level, 2 << level, dtype=np.uint64)
            points, radii = self._drawn(at)
            below = {}
            for node, own in parts.items():
                if len(own) >= least and (fit := self._fitted(own)):
                    points[node - (1 << level)], radii[node - (1 << level)] = fit
                    d = distance(own, fit[0], mask)
                    below[2 * node], below[2 * node + 1] = own[d <= fit[1]], own[d > fit[1]]
            if not below:
                break
            self.points.append(points)
            self.radii.append(radii)
            parts = below

    def _drawn(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vantage points by splitmix64 of the node's number."""
        z = nodes * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31)), np.full(len(nodes), self.mask.bit_count() // 2, np.int16)

    def _fitted(self, own: np.ndarray) -> tuple[int, int] | None:
        best = None
        for v in own[:: max(1, len(own) // 8)][:8].tolist():
            d = distance(own, v, self.mask)
            mid = int(np.median(d))
            split = min((d <= mid).sum(), (d > mid).sum())
            if split and (best is None or (d.std(), split) > best[0]):
                best = (d.std(), split), (v, mid)
        return best and best[1]

    def visits(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(leaf, index of the fingerprint that visits it, whether it lives there) for every visit."""
        node, at, home = np.ones(len(fps), np.uint64), np.arange(len(fps)), np.ones(len(fps), bool)
        for level in range(self.depth):
            if level < len(self.points):
                place = (node - np.uint64(1 << level)).astype(np.int64)
                v, mid = self.points[level][place], self.radii[level][place]
            else:
                v, mid = self._drawn(node)
            d = np.bitwise_count((fps[at] ^ v) & np.uint64(self.mask)).astype(np.int16)
            sides = []
            for bit, near, own in ((0, d <= mid + radius, d <= mid), (1, d >= mid + 1 - radius, d > mid)):
                sides.append((node[near] * np.uint64(2) + np.uint64(bit), at[near], home[near] & own[near]))
            node, at, home = (np.concatenate(c) for c in zip(*sides, strict=True))
        return (node - np.uint64(1 << self.depth)).astype(np.int64), at, home


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def shard_links(fps: np.ndarray, home: np.ndarray, radius: int, cell: int = 64) -> np.ndarray:
    """For sorted distinct ``fps``, the index of the smallest fingerprint that each is linked to through this shard.

    Residents are halved by distance to a vantage point until a cell is small; visitors follow wherever the triangle
    bound leaves a chance.
    """
    sets = _Union(len(fps))
    stack = [(np.flatnonzero(home), np.arange(len(fps)))]
    while stack:
        res, vis = stack.pop()
        if not len(res) or not len(vis):
            continue
        if len(res) > cell:
            d = distance(fps[res], fps[res[len(res) // 2]])
            mid = int(np.median(d))
            if (d <= mid).all():
                mid = int(d.max()) - 1
            e = distance(fps[vis], fps[res[len(res) // 2]])
            stack.append((res[d <= mid], vis[e <= mid + radius]))
            stack.append((res[d > mid], vis[e >= mid + 1 - radius]))
            continue
        for a in range(0, len(vis), 65536):
            part = vis[a:a + 65536]
            near = np.bitwise_count(fps[res][:, None] ^ fps[part][None, :]) <= radius
            linked = near.sum(axis=0)
            firsts = near.argmax(axis=0)
            some = np.flatnonzero(linked)
            for r, v in zip(res[firsts[some]].tolist(), part[some].tolist(), strict=True):
                if r != v:
                    sets.join(r, v)
            if (many := near[:, linked > 1]).size:  # residents that one visitor links
                both = np.argwhere(np.triu(many.astype(np.float32) @ many.T.astype(np.float32) > 0, 1))
                for r, s in both.tolist():
                    sets.join(int(res[r]), int(res[s]))
    return np.fromiter((sets.find(k) for k in range(len(fps))), np.int64, len(fps))


def near_links(values: DataFrame, count: int, max_distance: int, bands: int, shard_size: int, sample: int, tasks: int = 16) -> DataFrame:
    """``u, v``: links that connect all distinct fingerprints ``fp`` of ``values`` at ``max_distance`` or less.

    Shards number ``tasks`` at most until ``shard_size`` fingerprints a shard ask for more."""
    spark = values.sparkSession
    drawn = [r["fp"] for r in values.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()]
    points = np.array(drawn, np.int64).view(np.uint64)
    leaves = max(-(-count // shard_size), min(tasks // bands, count // 4096), 1)
    depth = (leaves - 1).bit_length()
    trees = [VantageTree(points, mask, depth) for mask in band_masks(bands)]
    radius = max_distance // bands
    shared = spark.sparkContext.broadcast(trees)

    def deal(batches):
        for batch in batches:
            every = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for fps in (every[a:a + 4096] for a in range(0, len(every), 4096)):  # deep trees make many visits
                for band, tree in enumerate(shared.value):
                    leaf, at, home = tree.visits(fps, radius)
                    yield pa.RecordBatch.from_arrays([pa.array(leaf * bands + band), pa.array(fps[at].view(np.int64)), pa.array(home)],
                                                     names=["shard", "fp", "home"])

    def link(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(fps)
        fps, home = fps[order], table.column("home").to_numpy(zero_copy_only=False)[order]
        root = shard_links(fps, home, max_distance)
        tied = np.flatnonzero(root != np.arange(len(fps)))
        return pa.table({"u": pa.array(fps[tied].view(np.int64)), "v": pa.array(fps[root[tied]].view(np.int64))})

    dealt = values.select("fp").mapInArrow(deal, "shard long, fp long, home boolean")
    return dealt.groupBy("shard").applyInArrow(link, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2,
                    bands: int = 2, shard_size: int = 1 << 18, sample: int = 8_192) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    Null and blank texts have fingerprint 0 and are linked like any other; ``component_id`` is the smallest id reachable
    over links of ``max_distance`` bits or fewer (null only where all ids of a component are null). Rows with one id are
    rows of their own that share what their fingerprints reach. Empty input gives an empty result.
    """
    groups = near_groups(docs, id_col, text_col, shingle, max_distance, bands, shard_size, sample)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2,
                bands: int = 2, shard_size: int = 1 << 18, sample: int = 8_192) -> DataFrame:
    """``doc_id, tkey, fp, root, component_id`` per row; ``root`` is the smallest fingerprint of the component."""
    if not 1 <= bands <= 64:
        raise ValueError("bands: 1 to 64")
    made = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    values = materialise(made.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-values")
    count, total = values.agg(F.count(F.lit(1)), F.sum("n")).first()
    links = near_links(values, count, max_distance, bands, shard_size, sample)
    roots = connected_components(links)
    tied = (values.join(roots, values["fp"] == roots["node"], "left")
            .select("fp", "first", "n", F.coalesce("root", "fp").alias("root")))
    named = materialise(tied, "simhash-roots")
    firsts = named.groupBy("root").agg(F.min("first").alias("component_id"))
    members = materialise(named.join(firsts, "root").select("fp", "n", "root", "component_id"), "simhash-members")
    discard(values, named, roots)
    return join_counted(made, members, "fp", total or 0).select("doc_id", "tkey", "fp", "root", "component_id")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float | None = None,
                         **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: a row whose id is the group's smallest (null if all are).

    ``similarity``: of the rows left, one stays of each group at that Jaccard similarity of five-word shingles, too.
    Where several rows of a group repeat its smallest id, one of them stays; groups never share a row, even if they share
    ids. Columns stay as they are, whatever their names. Null and blank texts are one group; empty input gives an empty result.
    """
    kept = keep_first(docs, near_groups(docs, id_col, text_col, **options), id_col, text_col)
    if similarity is None:
        return kept
    kept = materialise(kept, "simhash-kept")
    return keep_first(kept, near_shingles.shingle_groups(kept, id_col, text_col, similarity=similarity), id_col, text_col)


def keep_first(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with one row of each of ``groups`` (``doc_id, tkey, root, component_id``)."""
    keep, tkey, key, own_id, row = own_names(docs, "__keep", "__tkey", "__key", "__id", "__row")
    own = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "doc_id").agg(
        F.min("tkey").alias(tkey), F.count(F.lit(1)).alias("n"))
    own = materialise(own.select(F.col("doc_id").alias(keep), tkey, "n"), "simhash-own")
    rows = docs.withColumn(key, text_key(column(text_col)))
    same = column(id_col).eqNullSafe(F.col(keep)) & (F.col(key) == F.col(tkey))
    rows = rows.join(own.select(keep, tkey), same, "left_semi")
    if own.filter("n > 1").isEmpty():
        return rows.drop(key)
    every = [column(c) for c in docs.columns]
    one = rows.groupBy(column(id_col).alias(own_id), key).agg(F.min_by(F.struct(*every), F.xxhash64(*every)).alias(row))
    return one.select(f"{row}.*")
