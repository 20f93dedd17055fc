"""The SimHash operator's search beyond a few bits: rows whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Equal sets are one node. Min-hash bands find candidates: ``bands`` keys of ``rows`` minima each, so a pair at similarity
s meets in a bucket with probability 1 - (1 - s^rows)^bands, 0.9977 at 0.8 with the defaults and more above. No bucket is
dropped or shortened. Every candidate link is verified by the exact Jaccard similarity of the two texts' shingles.

First each bucket's members are compared with its smallest and its largest node, which joins a group of any size in
linear work. Buckets that still hold several components are searched whole, in blocks: a bucket of at most ``block``
nodes is one block, whose overlaps are counted at once; a larger one is dealt into parts and each two parts are a block, so
a node is sent once for every ``block`` nodes of its bucket and pairs are never rows. Blocks return links that connect what
is linked, not all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import column, discard, join_counted, materialise, text_key
from .components import connected_components

SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: bytes | None, shingle: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a text of fewer words is one shingle, one without words has none."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    if n <= 1:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:n - 1])).tolist()
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)),
                                 np.uint64, n))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of sorted distinct hashes; two empty sets are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


class MinHash:
    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(SEED)
        self.bands, self.rows = bands, rows
        self.mul = rng.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
        self.xor = rng.integers(0, 1 << 63, bands * rows, np.uint64)

    def keys(self, hashes: np.ndarray) -> list[int]:
        """A key a band; none for an empty set."""
        if not len(hashes):
            return []
        least = np.empty(len(self.mul), np.uint64)
        for k, (m, x) in enumerate(zip(self.mul, self.xor, strict=True)):
            mixed = (hashes ^ x) * m
            least[k] = (mixed ^ (mixed >> np.uint64(32))).min()
        return [xxhash.xxh64_intdigest(least[k * self.rows:(k + 1) * self.rows].tobytes(), k) - (1 << 63) for k in range(self.bands)]


def _sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, tkey, node, size, keys`` per row; rows of one ``node`` (a 128-bit hash) have equal shingle sets."""
    told = docs.select(column(id_col).alias("doc_id"), text_key(text_col).alias("tkey"), column(text_col).cast("string").alias("text"))

    def make(batches):
        hasher = MinHash(bands, rows)
        for batch in batches:
            nodes, sizes, keys = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                hashes = shingle_hashes(text.as_py(), shingle)
                nodes.append(xxhash.xxh3_128_digest(hashes.tobytes(), SEED))
                sizes.append(len(hashes))
                keys.append(hasher.keys(hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tkey"), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "tkey", "node", "size", "keys"])

    schema = T.StructType([told.schema["doc_id"], told.schema["tkey"]]).add("node", "binary").add("size", "long")
    return told.mapInArrow(make, schema.add("keys", T.ArrayType(T.LongType())))


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``node, hashes`` (sorted 64-bit hashes, packed) from ``node, text``."""

    def make(batches):
        for batch in batches:
            packed = [shingle_hashes(t.as_py(), shingle).tobytes() for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(packed, pa.binary())], names=["node", "hashes"])

    return texts.select("node", "text").mapInArrow(make, "node binary, hashes binary")


def _unpacked(column) -> list[np.ndarray]:
    return [np.frombuffer(h.as_py(), np.uint64) for h in column]


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``u, v``: the pairs of nodes whose shingle sets are similar enough."""
    a, b = (sets.select(F.col("node").alias(c), F.col("hashes").alias(f"{c}_hashes")) for c in "uv")
    full = pairs.join(a, "u").join(b, "v").select("u", "v", "u_hashes", "v_hashes")

    def check(batches):
        for batch in batches:
            both = zip(_unpacked(batch.column("u_hashes")), _unpacked(batch.column("v_hashes")), strict=True)
            keep = [k for k, pair in enumerate(both) if jaccard(*pair) >= similarity]
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).take(pa.array(keep, pa.int64()))

    return full.mapInArrow(check, "u binary, v binary")


def overlaps(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of the sets numbered ``first`` (rows) and ``second`` (columns)."""
    shingle, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    column = np.cumsum(times > 1) - 1  # shingles of one set only can't overlap
    inside = times[where] > 1
    owner, column = owner[inside], column[where[inside]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(first), len(second)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (low, low + width))
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        out += held[first] @ held[second].T
    return out


def block_links(similarity: float):
    """A function over a block (``i, j, part, node, root, hashes``): verified links that connect what differs in ``root``."""

    def run(table: pa.Table) -> pa.Table:
        part, sets = table.column("part").to_numpy(), _unpacked(table.column("hashes"))
        names, roots = table.column("node").to_pylist(), table.column("root").to_pylist()
        number = {r: k for k, r in enumerate(dict.fromkeys(roots))}
        root = np.array([number[r] for r in roots])
        first, second = np.flatnonzero(part == table.column("i")[0].as_py()), np.flatnonzero(part == table.column("j")[0].as_py())
        sizes = np.array([len(s) for s in sets], np.float64)
        both = overlaps(sets, first, second).astype(np.float64)
        alike = both / (sizes[first][:, None] + sizes[second][None, :] - both) >= similarity
        alike &= root[first][:, None] != root[second][None, :]
        up, links = list(range(len(number))), []

        def find(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for x, y in np.argwhere(alike).tolist():
            x, y = int(first[x]), int(second[y])
            p, q = find(int(root[x])), find(int(root[y]))
            if p != q:
                up[max(p, q)] = min(p, q)
                links.append((names[x], names[y]))
        return pa.table({"u": pa.array([a for a, _ in links], pa.binary()), "v": pa.array([b for _, b in links], pa.binary())})

    return run


def shingle_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8,
                   bands: int = 20, rows: int = 6, block: int = 2048, block_shingles: int = 4_000_000) -> DataFrame:
    """``doc_id, tkey, root, component_id`` per row; ``root`` is the group's smallest node, ``component_id`` its smallest id
    (null only where all are). Texts without words, nulls included, are one group."""
    made = materialise(_sketches(docs, id_col, text_col, shingle, bands, rows), "shingle-sketches")
    nodes = materialise(made.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("tkey").alias("tkey"), F.max("size").alias("size"),
                                                 F.max("keys").alias("keys")), "shingle-nodes")
    dealt = nodes.select("node", "size", F.explode("keys").alias("bucket"))
    ends = dealt.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("n")).filter("low < high")
    # only buckets of two nodes or more are looked at again
    many = nodes.count() * bands
    shared = materialise(join_counted(dealt, ends, "bucket", many), "shingle-buckets")
    near = lambda a, b: F.least(a, b) >= similarity * F.greatest(a, b) - 1e-9  # noqa: E731  sizes further apart exclude it
    wanted = shared.select("node").distinct().join(nodes.select("node", "tkey"), "node")
    own = docs.select(text_key(text_col).alias("tkey"), column(text_col).cast("string").alias("text"))
    texts = own.join(wanted.select("tkey").distinct(), "tkey", "left_semi").groupBy("tkey").agg(F.any_value("text").alias("text"))
    sets = materialise(_sets(wanted.join(texts, "tkey"), shingle), "shingle-sets")

    stars = (shared.select("node", F.explode(F.array_distinct(F.array("low", "high"))).alias("end")).filter("node <> end")
             .select(F.least("node", "end").alias("u"), F.greatest("node", "end").alias("v")).distinct())
    size = nodes.select(F.col("node").alias("u"), F.col("size").alias("u_size")), nodes.select(F.col("node").alias("v"), F.col("size").alias("v_size"))
    stars = stars.join(size[0], "u").join(size[1], "v").filter(near(F.col("u_size"), F.col("v_size"))).select("u", "v")
    links = materialise(_verified(stars, sets, similarity), "shingle-links")
    roots = connected_components(links)

    placed = shared.join(roots, "node", "left").select("bucket", "node", "size", F.coalesce("root", "node").alias("root"))
    mixed = (placed.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
             .filter("a < b AND n > 2"))
    parts = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("shingles") / block_shingles)).cast("int")
    left = join_counted(placed, mixed.select("bucket", "n", parts.alias("parts")), "bucket", many)
    left = left.select("bucket", "node", "root", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    left = left.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    left = left.select("bucket", "node", "root", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    more = materialise(left.join(sets, "node").groupBy("bucket", "i", "j").applyInArrow(block_links(similarity), "u binary, v binary"), "shingle-links")
    if not more.isEmpty():
        roots = connected_components(links.union(more))

    named = materialise(nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), "shingle-roots")
    firsts = named.groupBy("root").agg(F.min("first").alias("component_id"))
    out = made.select("doc_id", "tkey", "node").join(named.join(firsts, "root").select("node", "root", "component_id"), "node")
    out = materialise(out.select("doc_id", "tkey", "root", "component_id"), "shingle-groups")
    discard(made, nodes, shared, sets, links, more, named)
    return out
