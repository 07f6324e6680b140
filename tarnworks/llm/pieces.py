"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The vocabulary and its order come from a public model file. Its scores are merge ranks, not
probabilities, so a piece's log-probability is taken from its rank by Zipf's law. The search
keeps only a window of the text as long as the longest piece: whenever all paths that are still
alive go through one boundary, the ids up to there are committed and forgotten.

A piece holds spaces at its beginning only. Where the model keeps to that, a space that follows
another character is such a boundary, and what lies between two of them is remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # stands for a space in pieces
UNKNOWN = 10.0  # a character without piece scores so much below the worst piece
MEMO = 1 << 19
MEMO_CHARS = 48
NEVER = float("-inf")
RUN = re.compile(" *[^ ]+| +$")


@dataclass
class Vocabulary:
    """Pieces with ids and log-probabilities; ``raw``: the id of each byte."""

    pieces: list[str]
    kinds: list[int]  # 0: piece, 1: byte, 2: other
    trie: dict = field(default_factory=dict)
    raw: list[int] = field(default_factory=list)
    bytes_of: list[bytes] = field(default_factory=list)
    unknown: float = 0.0
    longest: int = 1
    splits: bool = True
    memo: dict = field(default_factory=dict)

    @staticmethod
    def load(path: str = MODEL) -> Vocabulary:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        kinds = [
            1 if p.is_byte(i) else 2 if p.is_control(i) or p.is_unknown(i) or p.is_unused(i) else 0
            for i in range(len(pieces))
        ]
        return Vocabulary(pieces, kinds).ready()

    def ready(self) -> Vocabulary:
        self.trie, self.memo, self.longest, self.splits = {}, {}, 1, True
        self.raw, self.bytes_of = [0] * 256, []
        rank = 0
        norm = log(sum(1 / k for k in range(1, self.kinds.count(0) + 1)) or 1)
        worst = 0.0
        for i, (piece, kind) in enumerate(zip(self.pieces, self.kinds)):
            if kind == 0:
                rank += 1
                text = piece.replace(SPACE, " ")
                worst = -log(rank) - norm
                node = [self.trie, -1, 0.0]  # next characters, id of the piece that ends here, score
                for c in text:
                    node = node[0].setdefault(c, [{}, -1, 0.0])
                node[1:] = i, worst
                self.longest = max(self.longest, len(text))
                self.splits &= " " not in text.lstrip(" ")
                self.bytes_of.append(text.encode())
            elif kind == 1:
                value = int(piece[3:5], 16)
                self.raw[value] = i
                self.bytes_of.append(bytes([value]))
            else:
                self.bytes_of.append(b"")
        self.unknown = worst - UNKNOWN
        return self

    def __getstate__(self):
        return {"pieces": self.pieces, "kinds": self.kinds}

    def __setstate__(self, state):
        self.__init__(**state)
        self.ready()


def viterbi(text: str, v: Vocabulary) -> Iterator[list[int]]:
    """Ids of the best segmentation, in runs as they are committed.

    Of equally good ways to a boundary, that with the longer last piece is taken.
    """
    n, trie, unknown, raw, longest = len(text), v.trie, v.unknown, v.raw, v.longest
    # Of the boundaries from ``done`` on: score, boundary before, id of the piece between (-1: bytes).
    done = reach = 0
    score, before, piece = [0.0], [0], [-1]

    def path(to: int) -> list[int]:
        out: list[int] = []
        while to > done:
            end, i = to, piece[to - done]
            to = before[end - done]
            if i < 0:
                out += [raw[x] for x in reversed(text[to:end].encode("utf-8", "surrogatepass"))]
            else:
                out.append(i)
        out.reverse()
        return out

    for at in range(n):
        here = score[at - done]
        kids, end, k = trie, at, at - done
        single = False
        while end < n:
            node = kids.get(text[end])
            if node is None:
                break
            end += 1
            k += 1
            kids, i, own = node
            if i >= 0:
                if end > reach:
                    for _ in range(end - reach):
                        score.append(NEVER)
                        before.append(at)
                        piece.append(-1)
                    reach = end
                if end == at + 1:
                    single = True
                if here + own > score[k]:
                    score[k] = here + own
                    before[k] = at
                    piece[k] = i
        if not single:
            k = at + 1 - done
            if reach <= at:
                score.append(NEVER)
                before.append(at)
                piece.append(-1)
                reach = at + 1
            if here + unknown > score[k]:
                score[k], before[k], piece[k] = here + unknown, at, -1
        if reach == at + 1:
            meets = reach
        elif at - done >= 2 * longest and at % longest == 0:
            alive = {b for b in range(at + 1, reach + 1) if score[b - done] > NEVER}
            while len(alive) > 1:  # go back until the paths are one
                last = max(alive)
                alive.discard(last)
                alive.add(before[last - done])
            (meets,) = alive
        else:
            continue
        if meets == n or meets - done >= longest:  # not for every letter
            yield path(meets)
            gone, done = meets - done, meets
            del score[:gone], before[:gone], piece[:gone]


def encode(text: str | None, v: Vocabulary) -> np.ndarray:
    """Ids of a text; nothing for null or empty texts. A space is put in front, as the model
    does; a character that stands for spaces in pieces is written as bytes."""
    if not text:
        return np.zeros(0, np.int32)
    if not v.splits:
        return np.array([i for run in viterbi(" " + text, v) for i in run], np.int32)
    memo = v.memo
    runs = RUN.findall(" " + text)
    found = list(map(memo.get, runs))
    if None in found:
        for k, ids in enumerate(found):
            if ids is None:
                run = runs[k]
                ids = memo.get(run)
                if ids is None:
                    ids = np.array([i for part in viterbi(run, v) for i in part], np.int32).tobytes()
                    if len(run) <= MEMO_CHARS:
                        if len(memo) >= MEMO:
                            memo.clear()
                        memo[run] = ids
                found[k] = ids
    return np.frombuffer(b"".join(found), np.int32)


def decode(ids: Iterable[int], v: Vocabulary) -> str:
    """The text of ids, without the space in front."""
    table = v.bytes_of
    text = b"".join([table[i] for i in ids]).decode("utf-8", "surrogatepass")
    return text[1:] if text.startswith(" ") else text


def encoded(docs: DataFrame, v: Vocabulary, keep: list[str] = ()) -> DataFrame:
    """``doc_id, ids, n_ids, round_trip`` of every row, and the columns to ``keep``.

    ``round_trip``: whether decoding gives the text back. Null and empty texts have no ids and
    come back empty. Null ids and repeated rows stay as they are; an empty table gives an empty
    result; other columns aren't read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(v)
    kept = [f for f in docs.schema.fields if f.name in keep]

    def work(batches):
        v = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(1).to_pylist()
                ids = [encode(t, v) for t in texts]
                same = [decode(i.tolist(), v) == (t or "") for i, t in zip(ids, texts)]
                sizes = np.array([len(i) for i in ids])
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *part.columns[2:], lists, pa.array(sizes, pa.int64()), pa.array(same, pa.bool_())],
                    ["doc_id", *[f.name for f in kept], "ids", "n_ids", "round_trip"],
                )

    schema = ", ".join(
        ["doc_id long", *[f"`{f.name}` {f.dataType.simpleString()}" for f in kept],
         "ids array<int>, n_ids long, round_trip boolean"]
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        *[f.name for f in kept],
    )
    return rows.mapInArrow(work, schema)


def decoded(rows: DataFrame, v: Vocabulary) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give an empty text."""
    sent = rows.sparkSession.sparkContext.broadcast(v)

    def work(batches):
        v = sent.value
        for batch in batches:
            texts = [decode(i or [], v) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(work, "doc_id long, text string")
