"""Toxicity: a convolutional text classifier on hashed word embeddings, trained in numpy.

A word is the sum of the embeddings of its hashed form and of its hashed beginnings, so that compounds share what their
stems tell. Filters of several widths run over the words; each keeps its maximum over the whole text, and a logistic
layer weighs the maxima. Texts are never cut: the maxima are taken piece by piece.

Training takes every labelled row and its whole text. Word statistics are exact counts over all of them. The rows are dealt
by the hash of their id to shards of bounded size; in each round every shard trains one epoch from the common parameters,
and the results are averaged, weighted by rows. The number of shards follows from the rows, so reruns agree wherever they
run, and the driver holds one set of parameters. One fold of the labelled rows, all of it, calibrates one threshold a
language, from counts by cells of 1/256 of a logit; the language of a text is told from the text alone, by the word
statistics of the training languages. Nothing but the text enters a score.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field, replace
from itertools import count, islice, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import broadcast_if_small, column, discard, map_whole_rows, materialise, shuffle_cleanup, whole_text

LETTERS = re.compile(r"[^\W\d_]+")
#: Latin-1 with all but its letters made blanks.
LATIN = "".join(chr(k) if LETTERS.fullmatch(chr(k)) else " " for k in range(256)).encode("latin-1")


@dataclass(frozen=True)
class Settings:
    shard_rows: int = 4_000         # of a shard, on average
    shard_chars: int = 16_000_000
    buckets: int = 1 << 16
    beginnings: tuple[int, ...] = (3, 4, 5, 6, 7)
    dims: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 6
    epochs: int = 5
    batch: int = 64
    rate: float = 0.01
    decay: float = 1e-4
    lang_buckets: int = 1 << 12
    seed: int = 7
    cache: int = 150_000
    piece: int = 100_000            # words of a text that training looks at together
    cells: int = 256                # of a logit, for thresholds


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    if not text:
        return []
    text = text.lower()
    try:
        return text.encode("latin-1").translate(LATIN).decode("latin-1").split()
    except UnicodeEncodeError:
        return LETTERS.findall(text)


def numbered(keys: list[str] = ()) -> defaultdict:
    """``keys`` by their place; each new key gets the number of keys before it."""
    return defaultdict(count(len(keys)).__next__, zip(keys, range(len(keys))))


def hashed_forms(words: list[str] | str, s: Settings) -> np.ndarray:
    """A row a word (one word: its row): bucket of the word, then one of each beginning (the word itself where it is shorter)."""
    if isinstance(words, str):
        return hashed_forms([words], s)[0]
    top = max(s.beginnings, default=1)
    out = np.empty((len(words), 1 + len(s.beginnings)), np.int32)
    out[:, 0] = np.fromiter((xxhash.xxh32_intdigest("=" + w) for w in words), np.int64, len(words)) % s.buckets
    letters = np.array(words, f"U{top}").view(np.uint32).reshape(len(words), top)  # zeros follow a shorter word
    state = np.full(len(words), s.seed + 1, np.uint64)
    for n in range(1, top + 1):
        state = (state ^ letters[:, n - 1]) * np.uint64(0x9E3779B97F4A7C15)
        state ^= state >> np.uint64(29)
        for k in (k for k, size in enumerate(s.beginnings, 1) if size == n):
            mixed = (state * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
            out[:, k] = np.where(letters[:, n - 1] > 0, mixed % np.uint64(s.buckets), out[:, 0])
    return out


@dataclass
class Model:
    settings: Settings
    emb: np.ndarray          # buckets x dims
    conv: list[np.ndarray]   # a width: width x dims x filters
    bias: np.ndarray         # all filters
    out: np.ndarray          # all filters
    out_bias: float
    lang_logp: np.ndarray    # lang_buckets x languages
    langs: list[str] = field(default_factory=list)
    thresholds: np.ndarray | None = None   # a logit for each language
    flat: bool = False       # trained on one class only: scores are 0

    def kernel(self) -> np.ndarray:
        """All filters at all their offsets, side by side."""
        return np.concatenate([w[k] for w in self.conv for k in range(len(w))], axis=1)

    def project(self, forms: np.ndarray) -> np.ndarray:
        """A column a word: what it adds to each filter at each offset; then the language log-probabilities."""
        x = summed(self.emb, forms)
        return np.concatenate([self.kernel().T @ x.T, self.lang_logp[forms[:, 0] % len(self.lang_logp)].T]).astype(np.float32)

    def pool(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``words``: projections of all words of some texts (none of them empty), one after another.

        Maxima of the filters' sums, and summed language log-probabilities, per text. A text shorter than a filter is
        padded with nothing."""
        s, f = self.settings, self.settings.filters
        ends = np.cumsum(sizes)
        starts, at = ends - sizes, 0
        maxima, last = [], np.zeros(0, np.int64)
        lasts = [last := np.concatenate([last, ends[sizes >= k] - k]) for k in range(1, max(s.widths))]  # each text's last k words
        for w in s.widths:
            total = words[at:at + f].copy()
            for k, last in enumerate(lasts[:w - 1], 1):
                held = total[:, last]
                total[:, :-k] += words[at + k * f:at + (k + 1) * f, k:]
                total[:, last] = held  # what follows is another text
            at += w * f
            maxima.append(np.maximum.reduceat(total, starts, axis=1))
        return np.concatenate(maxima).T, np.add.reduceat(words[at:], starts, axis=1).T

    def head(self, maxima: np.ndarray) -> np.ndarray:
        return np.maximum(maxima + self.bias, 0) @ self.out + self.out_bias


class Scorer:
    """Scores texts by pieces of bounded size; projections of frequent words are kept."""

    def __init__(self, model: Model, piece: int = 100_000):
        self.m, self.piece, self.seen = model, piece, numbered()
        self.table, self.uses = None, np.zeros(0, np.int64)  # a column and a count for each word in ``seen``

    def _forget(self) -> None:
        """The half that was used least goes."""
        words, n = list(self.seen), self.m.settings.cache // 2
        keep = np.sort(np.argsort(-self.uses, kind="stable")[:n])
        self.seen = numbered([words[k] for k in keep])
        for row in self.table:
            row[:len(keep)] = row[keep]
        self.uses = self.uses[keep] // 2

    def _index(self, words: list[str]) -> np.ndarray:
        s = self.m.settings
        if len(self.seen) > s.cache:
            self._forget()
        seen, old = self.seen, len(self.seen)
        at = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
        if fresh := len(seen) - old:
            columns = self.m.project(hashed_forms(list(islice(reversed(seen), fresh))[::-1], s))
            if self.table is None or len(seen) > self.table.shape[1]:
                grown = np.zeros((len(columns), max(2 * s.cache, 2 * len(seen))), np.float32)  # memory is taken as it is filled
                if old:
                    grown[:, :old] = self.table[:, :old]
                self.table = grown
            self.table[:, old:len(seen)] = columns
            self.uses = np.concatenate([self.uses, np.zeros(fresh, np.int64)])
        self.uses += np.bincount(at, minlength=len(seen))
        return at

    def logits(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Logit and language of each text. Long texts go in pieces that overlap by the widest filter."""
        m = self.m
        over = max(m.settings.widths) - 1
        maxima, langs, owner = [], [], []
        words: list[str] = []
        sizes: list[int] = []

        def flush():
            if words:
                mx, lg = m.pool(self.columns(words), np.array(sizes))
                maxima.append(mx)
                langs.append(lg)
                words.clear()
                sizes.clear()

        n = 0
        for text in texts:
            own = words_of(text)
            for a in range(0, max(1, len(own) - over) if own else 0, self.piece):
                part = own[a:a + self.piece + over]
                words += part
                sizes.append(len(part))
                owner.append(n)
                if len(words) >= self.piece:
                    flush()
            n += 1
        flush()
        k = len(m.bias)
        best, total = np.full((n, k), -1e9, np.float32), np.zeros((n, len(m.langs)), np.float64)
        if owner:
            at = np.array(owner)
            np.maximum.at(best, at, np.concatenate(maxima))
            np.add.at(total, at, np.concatenate(langs))
        empty = np.full(n, True)
        empty[owner] = False
        best[empty] = -m.bias - 1  # no word, nothing found
        return m.head(best), total.argmax(axis=1)

    def columns(self, words: list[str]) -> np.ndarray:
        at = self._index(words)
        return np.take(self.table, at, axis=1)

    def scores(self, texts) -> np.ndarray:
        """0 to 1; the language's threshold is moved to 0.5."""
        if self.m.flat:
            return np.zeros(sum(1 for _ in texts))
        logit, lang = self.logits(texts)
        return 1 / (1 + np.exp(-np.clip(logit - self.m.thresholds[lang], -30, 30)))


@dataclass
class Shard:
    """Training rows as numbers: the words of all texts one after another, and the hashed forms of each distinct word."""
    tokens: np.ndarray
    sizes: np.ndarray
    y: np.ndarray
    forms: np.ndarray

    def pack(self) -> bytes:
        head = np.array([len(self.tokens), len(self.sizes), len(self.forms)], np.int64)
        return b"".join(a.tobytes() for a in (head, self.sizes.astype(np.int64), self.tokens.astype(np.int32), self.y.astype(np.float32), self.forms.astype(np.int32)))

    @classmethod
    def unpack(cls, data: bytes, s: Settings) -> Shard:
        n, rows, _ = np.frombuffer(data, np.int64, 3)
        at = 24 + 8 * rows
        return cls(np.frombuffer(data, np.int32, n, at), np.frombuffer(data, np.int64, rows, 24), np.frombuffer(data, np.float32, rows, at + 4 * n),
                   np.frombuffer(data, np.int32, offset=at + 4 * (n + rows)).reshape(-1, 1 + len(s.beginnings)))


def shard_of(rows, s: Settings) -> Shard:
    """``rows``: (text, label, language)."""
    vocab, docs, y = numbered(), [], []
    for text, label, _ in rows:
        words = words_of(text)
        docs.append(np.fromiter(map(vocab.__getitem__, words), np.int32, len(words)))
        y.append(label)
    return Shard(np.concatenate(docs) if docs else np.zeros(0, np.int32), np.array([len(d) for d in docs], np.int64), np.array(y, np.float32), hashed_forms(list(vocab), s))


def statistics(shard: Shard, langs: list[int], n_langs: int, s: Settings) -> np.ndarray:
    """Texts without and with the label that hold each hashed form, then each language's words by bucket, in one line."""
    held = np.zeros((2, s.buckets), np.int64)
    there = np.zeros(s.buckets, bool)
    for d, label in zip(np.split(shard.tokens, np.cumsum(shard.sizes)[:-1]), shard.y):
        there[shard.forms[d]] = True
        buckets = np.flatnonzero(there)
        held[int(label), buckets] += 1
        there[buckets] = False
    word = (shard.forms[:, 0] % s.lang_buckets)[shard.tokens]
    counts = np.bincount(np.repeat(np.array(langs, np.int64), shard.sizes) * s.lang_buckets + word, minlength=n_langs * s.lang_buckets)
    return np.concatenate([held.ravel(), counts])


def start(stats: np.ndarray, langs: list[str], p: float, s: Settings) -> Model:
    """The model before its first epoch; ``p``: the share of rows with the label."""
    rng = np.random.default_rng(s.seed)
    no, yes = stats[:2 * s.buckets].reshape(2, -1)
    # smoothed log odds of the texts that hold a hashed form start the first dimension
    odds = np.log((yes + 6 * p) / (no + 6 * (1 - p))) - np.log(p / (1 - p))
    emb = rng.normal(0, 0.05, (s.buckets, s.dims)).astype(np.float32)
    emb[:, 0] = odds / (1 + len(s.beginnings)) * 2
    conv = [rng.normal(0, 0.2, (w, s.dims, s.filters)).astype(np.float32) for w in s.widths]
    for c in conv:
        c[:, 0, 0] = 1 / len(c)
    counts = 1 + stats[2 * s.buckets:].reshape(len(langs), -1).T
    f = len(s.widths) * s.filters
    return Model(s, emb, conv, np.full(f, -0.5, np.float32), np.full(f, 0.3, np.float32), -2.0, np.log(counts / counts.sum(axis=0)).astype(np.float32), langs)


def flattened(m: Model) -> np.ndarray:
    return np.concatenate([*(a.ravel() for a in (m.emb, m.bias, m.out, *m.conv)), [m.out_bias]]).astype(np.float32)


def with_parameters(m: Model, flat: np.ndarray) -> Model:
    parts, at = [], 0
    for a in (m.emb, m.bias, m.out, *m.conv):
        parts.append(flat[at:at + a.size].reshape(a.shape).astype(np.float32))
        at += a.size
    return replace(m, emb=parts[0], bias=parts[1], out=parts[2], conv=parts[3:], out_bias=float(flat[at]))


def at_rest(m: Model) -> np.ndarray:
    """Parameters, both moments of each, and the number of steps made, in one line."""
    flat = flattened(m)
    return np.concatenate([flat, np.zeros(2 * len(flat) + 1, np.float32)])


def summed(emb: np.ndarray, forms: np.ndarray) -> np.ndarray:
    """The sum of the embeddings in each row."""
    out = np.take(emb, forms[:, 0], axis=0)
    for k in range(1, forms.shape[1]):
        out += np.take(emb, forms[:, k], axis=0)
    return out


def peaks(columns: np.ndarray, words: np.ndarray, sizes: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The largest sum of each filter in each text (none of them empty), and the word where it starts, the first of equals.

    ``columns``: what each word adds to each filter at each offset; ``words``: the columns of all texts' words, one after
    another. They are looked at ``piece`` words at a time, long texts in pieces, none cut short."""
    f, ends = s.filters, np.cumsum(sizes)
    best, place = np.full((len(sizes), len(s.widths) * f), -np.inf, np.float32), np.zeros((len(sizes), len(s.widths) * f), np.int64)
    a = 0
    while a < len(words):
        q, stop = np.searchsorted(ends, (a, a + s.piece), side="right")
        b = int(ends[stop - 1]) if stop > q else a + s.piece
        texts = np.arange(q, max(stop, q + 1))
        edges = np.append(np.maximum(ends[texts] - sizes[texts], a), b) - a
        g = np.take(columns, words[a:b + max(s.widths) - 1], axis=1)
        lasts, at = [np.zeros(0, np.int64)], 0
        for k in range(1, max(s.widths)):
            last = ends[texts][sizes[texts] >= k] - k
            lasts.append(np.concatenate([lasts[-1], last[(last >= a) & (last < b)] - a]))  # the next word but k - 1 is another text's
        for i, w in enumerate(s.widths):
            total = g[at:at + f, :b - a].copy()
            for k in range(1, w):
                held, n = total[:, lasts[k]], min(b - a, g.shape[1] - k)
                total[:, :n] += g[at + k * f:at + (k + 1) * f, k:k + n]
                total[:, lasts[k]] = held
            at += w * f
            here = np.array([low + total[:, low:high].argmax(axis=1) for low, high in pairwise(edges.tolist())])
            value, cols = total[np.arange(f), here], slice(i * f, (i + 1) * f)
            place[texts, cols] = np.where(value > best[texts, cols], a + here, place[texts, cols])
            best[texts, cols] = np.maximum(best[texts, cols], value)
        a = b
    return best, place


def epoch(m: Model, state: np.ndarray, shard: Shard, p: float, seed: list[int]) -> np.ndarray:
    """The state after one pass of Adam over the shard's rows."""
    flat, first, second = state[:-1].reshape(3, -1)
    m, first, second, step = with_parameters(m, flat), with_parameters(m, first), with_parameters(m, second), round(float(state[-1]))
    s, rng, y = m.settings, np.random.default_rng(seed), shard.y
    named = lambda x: {"emb": x.emb, "bias": x.bias, "out": x.out, **{f"conv{k}": c for k, c in enumerate(x.conv)}}
    params, a1, b1 = named(m), named(first), named(second)
    mom = {k: (a1[k], b1[k]) for k in params}
    weight = np.where(y > 0, 0.5 / p, 0.5 / (1 - p))
    bias_m, bias_v = first.out_bias, second.out_bias
    ends = np.cumsum(shard.sizes)

    def adam(key, grad, rows_at=None):
        v = params[key] if rows_at is None else params[key][rows_at]
        a, b = mom[key]
        if rows_at is None:
            a[...] = 0.9 * a + 0.1 * grad
            b[...] = 0.999 * b + 0.001 * grad ** 2
            params[key][...] = v - s.rate * (a / (1 - 0.9 ** step) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8) + s.decay * v)
        else:  # only the rows that the batch has touched
            a[rows_at] = 0.9 * a[rows_at] + 0.1 * grad
            b[rows_at] = 0.999 * b[rows_at] + 0.001 * grad ** 2
            params[key][rows_at] = v - s.rate * 0.3 * (a[rows_at] / (1 - 0.9 ** step) / (np.sqrt(b[rows_at] / (1 - 0.999 ** step)) + 1e-8) + s.decay * v)

    usable = np.flatnonzero(shard.sizes)
    rng.shuffle(usable)
    for lo in range(0, len(usable), s.batch):
        at = usable[lo:lo + s.batch]
        step += 1
        words, inverse = np.unique(np.concatenate([shard.tokens[ends[k] - shard.sizes[k]:ends[k]] for k in at]), return_inverse=True)
        stops = np.cumsum(shard.sizes[at])
        x = summed(m.emb, shard.forms[words])
        grad_x = np.zeros_like(x)
        best, where = peaks(m.kernel().T @ x.T, inverse, shard.sizes[at], s)
        z = best + m.bias
        h = np.maximum(z, 0)
        logit = h @ m.out + m.out_bias
        g = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[at]) * weight[at] / len(at)).astype(np.float32)
        gz = np.where(z > 0, g[:, None] * m.out, 0)
        grads = {"out": h.T @ g, "bias": gz.sum(axis=0)}
        col = 0
        for k, c in enumerate(m.conv):
            gk, place = gz[:, col:col + s.filters], where[:, col:col + s.filters]
            col += s.filters
            gc = np.zeros_like(c)
            for j in range(len(c)):
                there = place + j < stops[:, None]
                word = inverse[np.minimum(place + j, len(inverse) - 1)]
                gg = np.where(there, gk, 0)
                for q in range(s.filters):
                    gc[j, :, q] = x[word[:, q]].T @ gg[:, q]
                    np.add.at(grad_x, word[:, q], gg[:, q, None] * c[j, :, q])
            grads[f"conv{k}"] = gc
        for key, value in grads.items():
            adam(key, value)
        touched = np.flatnonzero(grad_x.any(axis=1))
        if len(touched):
            buckets, inv = np.unique(shard.forms[words[touched]], return_inverse=True)
            ge = np.zeros((len(buckets), s.dims), np.float32)
            np.add.at(ge, inv.reshape(len(touched), -1), grad_x[touched][:, None, :])
            adam("emb", ge, buckets)
        gb = float(g.sum())
        bias_m, bias_v = 0.9 * bias_m + 0.1 * gb, 0.999 * bias_v + 0.001 * gb * gb
        m.out_bias -= s.rate * bias_m / (1 - 0.9 ** step) / (np.sqrt(bias_v / (1 - 0.999 ** step)) + 1e-8)
    first.out_bias, second.out_bias = bias_m, bias_v
    return np.concatenate([*map(flattened, (m, first, second)), [step]]).astype(np.float32)


def _share(positive: int, rows: int) -> float:
    return min(max(positive / rows if rows else 0.5, 1e-3), 1 - 1e-3)


def train(rows: list[tuple[str, int, str]], settings: Settings = Settings(), calibrate: list[tuple[str, int, str]] = ()) -> Model:
    """One shard in this process. ``rows``: (text, label, language), languages only to tell texts' languages apart and to
    set thresholds."""
    s = settings
    langs = sorted({lang or "" for _, _, lang in rows}) or [""]
    shard = shard_of(rows, s)
    p = _share(int(shard.y.sum()), len(rows))
    m = start(statistics(shard, [langs.index(lang or "") for _, _, lang in rows], len(langs), s), langs, p, s)
    state = at_rest(m)
    for k in range(s.epochs):
        state = epoch(m, state, shard, p, [s.seed, k, 0])
    m = with_parameters(m, state)
    m.flat = not 0 < shard.y.sum() < len(rows)
    told = list(calibrate) or rows
    logit, lang = Scorer(m).logits([t for t, _, _ in told])
    cells = Counter()
    for c, k, (_, label, _) in zip(_cells(logit, s), lang, told):
        cells[int(k), int(c), int(label)] += 1
    m.thresholds = calibrated(m, [(*key, n) for key, n in cells.items()])
    return m


def _cells(logit: np.ndarray, s: Settings) -> np.ndarray:
    return np.floor(np.clip(logit, -1e4, 1e4) * s.cells).astype(np.int64)


def calibrated(m: Model, counts: list[tuple[int, int, int, int]], least: int = 15) -> np.ndarray:
    """``counts``: (language, cell of the logit, label, rows). The logit of best F1 for each language; a language of fewer
    than ``least`` positive rows takes the overall one."""
    lang, cell, y, n = np.array(counts, np.int64).reshape(-1, 4).T

    def best(at: np.ndarray) -> float:
        c, inv = np.unique(-cell[at], return_inverse=True)  # falling logits
        every, yes = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
        np.add.at(every, inv, n[at])
        np.add.at(yes, inv, n[at] * y[at])
        f1 = 2 * np.cumsum(yes) / (np.cumsum(every) + yes.sum())
        run = np.flatnonzero(f1 >= f1.max() - 1e-9)
        k = run[len(run) // 2]
        low = -c[k]  # this cell is still above the threshold, the next one below
        return float((low + -c[k + 1] + 1) / 2 / m.settings.cells) if k + 1 < len(c) else float(low / m.settings.cells - 1e-3)

    every = np.arange(len(y))
    overall = best(every) if 0 < (n * y).sum() < n.sum() else 0.0
    out = []
    for k in range(len(m.langs)):
        at = np.flatnonzero(lang == k)
        out.append(best(at) if least <= (n * y)[at].sum() < n[at].sum() else overall)
    return np.array(out)


def fold_of(doc_id) -> F.Column:
    """crc32 of the id's text, modulo 5; 0 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_col: str) -> DataFrame:
    """``id, text, lang, y, cal`` of every labelled row whose fold isn't 0, one row an id."""
    marks = labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("y")).na.drop().groupBy("id").agg(F.max("y").alias("y"))
    marks = materialise(marks.filter((fold_of(F.col("id")) != 0) & F.col("y").isin(0, 1)), "toxicity-labels")
    lang = F.coalesce(column(lang_col).cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    rows = docs.select(column(id_col).alias("id"), whole_text(text_col).alias("text"), lang.alias("lang"))
    rows = rows.filter((F.length("text") > 0) & (fold_of(F.col("id")) != 0)).join(broadcast_if_small(marks, marks.count()), "id")
    one = rows.groupBy("id", "y").agg(F.min(F.struct("text", "lang")).alias("r"))  # repeated ids count once
    out = materialise(one.select("id", F.col("r.text").alias("text"), F.col("r.lang").alias("lang"), "y", (fold_of(F.col("id")) == 1).alias("cal")), "toxicity-rows")
    discard(marks)
    return out


def _shards(rows: DataFrame, n: int, langs: list[str], s: Settings) -> DataFrame:
    """Each shard's packed rows (``shard, blob``), and the parts of its statistics that aren't 0 (``place, value``)."""
    at = {lang: k for k, lang in enumerate(langs)}

    def run(table: pa.Table) -> pa.Table:
        own = sorted(zip(*(table.column(c).to_pylist() for c in ("key", "text", "y", "lang", "shard"))))
        shard = shard_of([(text, y, lang) for _, text, y, lang, _ in own], s)
        stats = statistics(shard, [at[lang] for *_, lang, _ in own], len(langs), s)
        places = np.flatnonzero(stats)
        none, number = [None] * len(places), own[0][-1]
        return pa.table({"shard": pa.array([number] * (len(places) + 1), pa.int32()), "place": pa.array([None, *places.tolist()], pa.int64()),
                         "value": pa.array([None, *stats[places].tolist()], pa.int64()), "blob": pa.array([shard.pack(), *none], pa.binary())})

    key = F.col("id").cast("string")
    dealt = rows.select(key.alias("key"), "text", "y", "lang", F.pmod(F.xxhash64(key, F.lit(s.seed)), F.lit(n)).cast("int").alias("shard"))
    return materialise(dealt.repartition(n, "shard").groupBy("shard").applyInArrow(run, "shard int, place long, value long, blob binary"), "toxicity-shards")


#: Numbers of a block, and blocks of one place that a task sums up.
BLOCK, SUMMED = 8192, 64


def _averaged(shards: DataFrame, n: int, m: Model, state: np.ndarray, p: float, k: int) -> np.ndarray:
    """The mean of the states after epoch ``k`` of every shard, weighted by rows. Means are made by blocks in the order of
    the shards; no task sees more than ``SUMMED`` sets of a block, the driver sees one."""
    shared = shards.sparkSession.sparkContext.broadcast((m, state))
    kind = "block int, shard int, weight double, mean binary"

    def run(batches):
        start_at, begun = shared.value
        for batch in batches:
            for number, blob in zip(batch.column("shard").to_pylist(), batch.column("blob")):
                shard = Shard.unpack(blob.as_buffer(), start_at.settings)
                own = epoch(start_at, begun, shard, p, [start_at.settings.seed, k, number])
                blocks = [own[a:a + BLOCK].tobytes() for a in range(0, len(own), BLOCK)]
                yield pa.RecordBatch.from_pydict({"block": pa.array(range(len(blocks)), pa.int32()), "shard": pa.array([number] * len(blocks), pa.int32()),
                                                  "weight": pa.array([float(len(shard.sizes))] * len(blocks), pa.float64()), "mean": pa.array(blocks, pa.binary())})

    def mean(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        weights = table.column("weight").to_pylist()
        total = sum(w * np.frombuffer(b.as_buffer(), np.float32).astype(np.float64) for w, b in zip(weights, table.column("mean"), strict=True))
        return pa.table({"block": table.column("block")[:1], "shard": pa.array([table.column("shard")[0].as_py() // SUMMED], pa.int32()),
                         "weight": pa.array([sum(weights)], pa.float64()), "mean": pa.array([(total / sum(weights)).astype(np.float32).tobytes()], pa.binary())})

    with shuffle_cleanup(shards.sparkSession):  # as the plan is made, too: it then says what becomes of its files
        means = shards.select("shard", "blob").mapInArrow(run, kind)
        while n > 1:
            means = means.withColumn("part", F.floor(F.col("shard") / SUMMED)).groupBy("block", "part").applyInArrow(lambda t: mean(t.drop_columns("part")), kind)
            n = -(-n // SUMMED)
        got = sorted((r["block"], bytes(r["mean"])) for r in means.collect())
    shared.destroy()
    return np.concatenate([np.frombuffer(b, np.float32) for _, b in got])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        label_col: str = "toxic", settings: Settings = Settings()) -> Model:
    """Learn from all labelled rows whose fold isn't 0, and their whole texts: fold 1 calibrates, the others train.

    Null labels and null ids are ignored, several labels of a row count as their maximum, null or blank texts don't
    train. Without a positive or a negative row all scores are 0.
    """
    s, spark = settings, docs.sparkSession
    rows = _labelled(docs, labels, id_col, text_col, lang_col, label_col)
    by = rows.filter("NOT cal").groupBy("lang", "y").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).collect()
    total, positive, chars = sum(r["n"] for r in by), sum(r["n"] * r["y"] for r in by), sum(r["chars"] for r in by)
    langs = sorted({r["lang"] for r in by}) or [""]
    p, n = _share(positive, total), max(-(-total // s.shard_rows), -(-chars // s.shard_chars))
    stats = np.zeros(2 * s.buckets + len(langs) * s.lang_buckets, np.int64)
    flat = not 0 < positive < total
    if flat:
        m = start(stats, langs, p, s)
        m.flat, m.thresholds = True, np.zeros(len(langs))
        discard(rows)
        return m
    parts = _shards(rows.filter("NOT cal"), n, langs, s)
    counted = parts.filter("place IS NOT NULL").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    stats[counted.column("place").to_numpy()] = counted.column("value").to_numpy()
    m = start(stats, langs, p, s)
    shards = parts.filter("blob IS NOT NULL")
    state = at_rest(m)
    for k in range(s.epochs):
        state = _averaged(shards, n, m, state, p, k)
    m = with_parameters(m, state)
    told = rows.filter("cal")
    told = told if not told.isEmpty() else rows
    shared = spark.sparkContext.broadcast(m)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            logit, lang = scorer.logits(t.as_py() for t in batch.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int64()), pa.array(_cells(logit, s), pa.int64()), batch.column("y")], names=["lang", "cell", "y"])

    counts = told.select("text", "y").mapInArrow(run, "lang long, cell long, y int").groupBy("lang", "cell", "y").count().collect()
    m.thresholds = calibrated(m, sorted(tuple(r) for r in counts))
    discard(rows, parts)
    return m


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` per row; null and blank texts have the score of no evidence.

    Repeated rows are scored alike, texts of any length whole (piece by piece); other columns are ignored; empty input
    gives an empty result."""
    rows = docs.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = batch.column("text")
            got = scorer.scores(t.as_py() for t in texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got.astype(np.float64))], names=["doc_id", "score"])

    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"]]).add("score", "double"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows scored 0.5 or more; all columns as they are, whatever their names.

    Null and blank texts have the score of no evidence; repeated rows go or stay together; texts of any length are scored
    whole; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            keep = scorer.scores(t.as_py() for t in batch.column(at)) < 0.5
            yield batch.filter(pa.array(keep))

    return map_whole_rows(docs, run)


def toxicity_report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; a null id counts as the text ''. See ``fit`` and ``score``."""
    out = score(docs, fit(docs, labels, **options))
    return out.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
