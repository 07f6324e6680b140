"""The trie of conversations against one built node by node."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarnworks.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def key(turn):
    role, text = (x or "" for x in turn)
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def plain_rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, key((role, text)), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - int(math.fmod(c, 20))  # towards zero, as SQL has it
        out[c] = tuple(own.get(first, [])[:h] + ts[h:])
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    out = []
    below = {}

    def visit(node):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved, leaves = (len(members[node]) - 1) * words, 0 if children[node] else 1
        for child in children[node]:
            saved, leaves = saved + below[child][0], leaves + below[child][1]
        below[node] = saved, leaves

    for node in sorted(members, key=len, reverse=True):
        visit(node)
    for node, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if convs[c] == node)))
        out.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
            len(children[node]), below[node][1], below[node][0], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    extra = {c: F.lit(7) for c in ("path", "words", "shard", "at", "key", "_head")}
    return df.withColumns(extra).repartition(3)


def got(df):
    assert df.columns == COLUMNS
    return sorted([tuple(r) for r in df.collect()], key=str)


def conversations(rng, n, texts=3, most=5):
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, most)):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(["word"] * rng.randint(0, texts))))
    return rows


def odd_rows(rng):
    rows = conversations(rng, 130)
    rows += [(40, 1, "user", "tie"), (40, 1, "user", "a tie"), (40, None, None, None), (41, None, "", "x")]
    rows += [rows[3], rows[3]]  # a repeated row is one more turn
    rows += [(None, 0, "user", "nobody's"), (None, None, None, None)]
    rows += [(205, 0, "user", "short")]  # no first of its family
    rows += [(-3, 0, "user", "below zero"), (10**12, 0, "user", "far " * 5000)]
    return rows


@pytest.mark.parametrize("shard_turns", [200_000, 11])
def test_against_plain_trie(spark, shard_turns):
    rows = odd_rows(random.Random(4))
    assert got(prefix_trie.prefix_trie(frame(spark, rows), shard_turns=shard_turns)) == plain_trie(plain_rebuilt(rows))


def test_one_conversation_held_by_most(spark, monkeypatch):
    """Equal conversations fill many shards, and their ids many packed rows."""
    monkeypatch.setattr(prefix_trie, "PACKED", 7)
    rows = []
    for c in range(0, 4000, 20):  # first of a family: kept as it is
        rows += [(c, t, "user", f"turn {t}") for t in range(4)]
        if c % 60 == 0:
            rows.append((c, 4, "user", f"own {c % 7}"))
    assert got(prefix_trie.prefix_trie(frame(spark, rows), shard_turns=20)) == plain_trie(plain_rebuilt(rows))


def test_long_conversations(spark, monkeypatch):
    """Beyond the turns that deal the rows to shards."""
    monkeypatch.setattr(prefix_trie, "DEEP", 3)
    monkeypatch.setattr(prefix_trie, "SKELETON_BYTES", 1)
    rng = random.Random(8)
    rows = []
    for c in range(0, 1200, 20):
        rows += [(c, t, "user", f"same {t}") for t in range(rng.choice([2, 3, 4, 30]))]
        rows += [(c, 100 + t, "user", rng.choice("ab")) for t in range(rng.randint(0, 3))]
    assert got(prefix_trie.prefix_trie(frame(spark, rows), shard_turns=30)) == plain_trie(plain_rebuilt(rows))


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).collect() == []


def test_few_rows_reach_the_driver(spark):
    """The skeleton has at most the splitters' prefixes, whatever the number of rows."""
    rows = conversations(random.Random(5), 400, most=6)
    skeleton = prefix_trie.Skeleton([(b"a" * 32, b"a" * 48), (b"a" * 48, b"b" * 16), (b"b" * 16, b"c" * 16)])
    assert skeleton.depth == [0, 1, 2, 3, 1]
    assert len(got(prefix_trie.prefix_trie(frame(spark, rows), shard_turns=50))) == len(plain_trie(plain_rebuilt(rows)))
