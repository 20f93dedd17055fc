"""Token counts by a linear longest-match automaton.

Greedy longest-match-first word pieces of a word are counted without building them: a trie of the vocabulary (pieces
that begin a word under one root, pieces that continue it under another) has a failure link at each node, and with the
link the number of pieces that following it pops off. A word is read once, each step either goes down the trie or pops
pieces, so the work is linear in its letters whatever the pieces are.

The automaton's size is bounded by the vocabulary, a parameter, and is broadcast. Documents never shuffle.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import column

DEFAULT_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def load_vocabulary(path: str = DEFAULT_VOCABULARY) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that continue one.

    A sentencepiece model's pieces begin a word where they carry the word mark; its lone mark is an empty beginning. In a
    text file (one piece a line) those that begin with ``##`` continue a word. Control and unknown pieces don't count;
    byte pieces aren't listed, see ``has_byte_pieces``."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(k) for k in range(sp.get_piece_size()) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k))]
        mark = "▁"
        return [p[1:] for p in pieces if p and p[0] == mark], [p for p in pieces if p and mark not in p]
    with open(path, encoding="utf-8") as f:
        pieces = [line.rstrip("\n") for line in f]
    return [p for p in pieces if p and not p.startswith("##")], [p[2:] for p in pieces if len(p) > 2 and p.startswith("##")]


def has_byte_pieces(path: str = DEFAULT_VOCABULARY) -> bool:
    """Whether the model has a piece for each of the 256 bytes."""
    if not path.endswith(".model"):
        return False
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return sum(sp.is_byte(k) for k in range(sp.get_piece_size())) == 256


class PieceAutomaton:
    """``count(word)``: pieces of the greedy longest match, or 0 where the word can't be cut into pieces.

    An empty piece in ``begin`` is the beginning of a word that no other piece begins. With ``byte_pieces`` a character at
    which no piece starts counts as one piece for each of its UTF-8 bytes, so every word can be cut."""

    def __init__(self, begin: list[str], follow: list[str], byte_pieces: bool = False):
        self.byte_pieces, self.longest = byte_pieces, max(map(len, [*begin, *follow]), default=0)
        # node 0: start of a word, node 1: start of a continuation
        self.goto: list[dict[str, int]] = [{}, {}]
        self.final = [False, False]
        depth = [0, 0]
        for root, pieces in ((0, begin), (1, follow)):
            for piece in pieces:
                v = root
                for c in piece:
                    if c not in self.goto[v]:
                        self.goto[v][c] = len(self.goto)
                        self.goto.append({})
                        self.final.append(False)
                        depth.append(depth[v] + 1)
                    v = self.goto[v][c]
                self.final[v] = True
        self.fail = [-1] * len(self.goto)
        self.pops = [0] * len(self.goto)
        if self.final[0]:
            self.fail[0], self.pops[0] = 1, 1
        level = [0, 1]
        while level:  # breadth first: a node's link needs those of shorter strings only
            below = []
            for v in level:
                for c, u in self.goto[v].items():
                    below.append(u)
                    if self.final[u]:  # the whole string is a piece: popped, and nothing is left
                        self.fail[u], self.pops[u] = 1, 1
                        continue
                    z, n = self.fail[v], self.pops[v]
                    while z >= 0 and c not in self.goto[z]:
                        n += self.pops[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[u], self.pops[u] = self.goto[z][c], n
            level = below

    def count(self, word: str) -> int:
        goto, fail, pops = self.goto, self.fail, self.pops
        v = n = 0
        for c in word:
            u = goto[v].get(c)
            while u is None:
                n += pops[v]
                v = fail[v]
                if v < 0:
                    return self._with_bytes(word) if self.byte_pieces else 0
                u = goto[v].get(c)
            v = u
        while v > 1:  # the rest is popped until nothing is left
            n += pops[v]
            v = fail[v]
        return n if v == 1 else self._with_bytes(word) if self.byte_pieces else 0

    def _with_bytes(self, word: str) -> int:
        """The same greedy match piece by piece, with bytes where no piece starts."""
        n = at = v = 0
        while at < len(word):
            end, node = -1, v
            for k in range(at, min(len(word), at + self.longest)):
                node = self.goto[node].get(word[k])
                if node is None:
                    break
                if self.final[node]:
                    end = k + 1
            if end > 0:
                n, at = n + 1, end
            elif v == 0 and self.final[0]:
                n += 1
            else:
                n, at = n + len(word[at].encode("utf-8", "replace")), at + 1
            v = 1
        return n


def count_tokens(docs: DataFrame, automaton: PieceAutomaton | None = None, id_col: str = "doc_id", text_col: str = "text",
                 cache: int = 500_000) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_tokens, n_unknown``.

    Words are cut at blank and ``\\x09-\\x0D``. A word that can't be cut into pieces is one unknown token; the default
    vocabulary has byte pieces, with which every word can be cut. Null and blank texts have none. Repeated rows are counted
    alike; words of any length are read once, letter by letter; further columns are ignored; empty input gives an empty
    result.
    """
    automaton = automaton or PieceAutomaton(*load_vocabulary(), has_byte_pieces())
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    rows = docs.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text"))

    class Counts(dict):
        def __missing__(self, word: bytes) -> int:
            n = shared.value.count(word.decode("utf-8", "replace"))
            if len(word) <= 64:  # a bound on what is kept
                self[word] = n
            return n

    def run(batches):
        known = Counts()
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                parts = (text.as_py() or b"").split()
                if len(known) > cache:
                    known.clear()
                counts = [known[w] for w in parts]
                bad = counts.count(0)
                words.append(len(parts))
                tokens.append(sum(counts) + bad)
                unknown.append(bad)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                                             names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"]]).add("n_words", "long").add("n_tokens", "long").add("n_unknown", "long"))
