"""Token counts by greedy longest match, with an automaton that never makes a piece.

A trie holds the vocabulary. Where a word leaves the trie, a failure link leads to the state of
what is left after the longest pieces have been taken from the front, and a number stored with
it says how many those were. Each letter follows one trie edge, so a word costs time in
proportion to its length. (Song et al., "Fast WordPiece Tokenization", 2021.)

Pieces that begin a word carry the mark of a space, the others continue it. A character
without piece counts as its UTF-8 bytes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MEMO = 1 << 19
MEMO_CHARS = 48
WORDS = re.compile("[^\x20\x09-\x0D]+")


def vocabulary(path: str = MODEL) -> list[str]:
    """The pieces of a model file, without control and byte pieces."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    other = lambda i: p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i)
    return [p.id_to_piece(i) for i in range(p.get_piece_size()) if not other(i)]


class Automaton:
    """States are numbers, 0 the root; ``edges`` has (state, character) -> state."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.edges: list[dict[str, int]] = [{}]
        whole = [False]
        for piece in pieces:
            at = 0
            for c in piece:
                to = self.edges[at].get(c)
                if to is None:
                    to = self.edges[at][c] = len(whole)
                    self.edges.append({})
                    whole.append(False)
                at = to
            whole[at] = True
        n = len(whole)
        self.link, self.popped = [0] * n, [0] * n
        level = [0]
        while level:
            below = []
            for s in level:
                for c, to in self.edges[s].items():
                    below.append(to)
                    if whole[to]:
                        self.popped[to] = 1
                        continue
                    at, pops = (self.link[s], self.popped[s]) if s else (0, 0)
                    while at and c not in self.edges[at]:
                        pops += self.popped[at]
                        at = self.link[at]
                    if s and c in self.edges[at]:
                        self.link[to], self.popped[to] = self.edges[at][c], pops
                    else:  # a character that is no piece
                        self.popped[to] = pops + len(c.encode())
            level = below
        self.memo: dict[str, int] = {}

    def __getstate__(self):
        return {"pieces": self.pieces}

    def __setstate__(self, state):
        self.__init__(state["pieces"])

    def length(self, text: str) -> int:
        """Pieces of a word that greedy longest match takes, byte counts for what has none."""
        edges, link, popped = self.edges, self.link, self.popped
        at = count = 0
        for c in text:
            to = edges[at].get(c)
            while to is None and at:
                count += popped[at]
                at = link[at]
                to = edges[at].get(c)
            if to is None:
                count += len(c.encode("utf-8", "surrogatepass"))
            else:
                at = to
        while at:
            count += popped[at]
            at = link[at]
        return count

    def count(self, text: str | None) -> tuple[int, int]:
        """Words and tokens of a text."""
        words = WORDS.findall(text or "")
        memo = self.memo
        found = list(map(memo.get, words))
        if None in found:
            for k, n in enumerate(found):
                if n is None:
                    word = words[k]
                    n = memo.get(word)
                    if n is None:
                        n = self.length(MARK + word)
                        if len(word) <= MEMO_CHARS:
                            if len(memo) >= MEMO:
                                memo.clear()
                            memo[word] = n
                    found[k] = n
        return len(words), sum(found)


def token_counts(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every row.

    Words are runs without white space. Null and empty texts have no words. Null ids and
    repeated rows stay as they are; an empty table gives an empty result; other columns aren't
    read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(automaton)

    def work(batches):
        automaton = sent.value
        for batch in batches:
            pairs = [automaton.count(t) for t in batch.column(1).to_pylist()]
            counts = np.array(pairs, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts[:, 0]), pa.array(counts[:, 1])],
                ["doc_id", "n_words", "n_tokens"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(work, "doc_id long, n_words long, n_tokens long")
