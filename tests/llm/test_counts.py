"""Mixing, shards and token counts against plain Python."""

import re
import zlib
from collections import defaultdict

import pytest
from fixtures import documents, empty, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from tarnworks.llm import mixture, queries, shards, wordpiece

def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, most=3):
    """Reshare the excess until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    total, full = float(sum(sizes.values())), {}
    while True:
        left = total - sum(full.values())
        rest = sum(w for s, w in weight.items() if s not in full)
        dealt = {s: left * w / rest for s, w in weight.items() if s not in full}
        above = [s for s in dealt if dealt[s] > most * sizes[s] + 1e-9]
        if not above:
            return full | dealt
        full |= {s: float(most * sizes[s]) for s in above}


def test_mix_against_plain_targets(spark):
    rows = documents(spark)
    got = [r.asDict(True) for r in mixture.mix(frame(spark, rows)).collect()]
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += size_of(text)
    targets = plain_targets(dict(sizes))
    assert len(got) == len(rows)
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(d), size_of(t)) for d, t, *_ in rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert all(0 <= p["position"] <= 1 for p in r["passes"])
        assert [p["position"] for p in r["passes"]] == sorted(p["position"] for p in r["passes"])
    for source, target in targets.items():
        taken = sum(r["taken"] for r in got if r["source"] == source)
        assert taken == int(target + 1e-9)


def test_mix_is_the_same_each_time_and_for_any_slices(spark):
    rows = frame(spark, documents(spark))
    first = sorted(map(str, mixture.mix(rows).collect()))
    assert first == sorted(map(str, mixture.mix(rows.repartition(7)).collect()))
    held = mixture.SLICE_ROWS
    try:
        mixture.SLICE_ROWS = 2
        mixture.sliced_offsets.__defaults__ = (2,)
        assert first == sorted(map(str, mixture.mix(rows).collect()))
    finally:
        mixture.SLICE_ROWS = held
        mixture.sliced_offsets.__defaults__ = (held,)


def test_mix_of_no_words_and_no_rows(spark):
    assert mixture.mix(empty(spark)).collect() == []
    blank = frame(spark, [(1, None, None, "a"), (2, "", None, None)])
    assert [(r.target, r.taken) for r in mixture.mix(blank).collect()] == [(0.0, 0), (0.0, 0)]


def test_positions_follow_the_schedule(spark):
    """Where a weight falls over time, more than half of the words come in the first half."""
    rows = frame(spark, [(i, "w " * 10, None, s) for i in range(400) for s in "abc"])
    halves = defaultdict(lambda: [0, 0])
    for r in mixture.mix(rows).collect():
        for p in r["passes"]:
            halves[r["source"]][p["position"] >= 0.5] += p["words"]
    assert halves["a"][0] > 1.2 * halves["a"][1]
    assert halves["c"][1] > 1.2 * halves["c"][0]


def test_order_is_total_over_partitions(spark):
    mixed = mixture.mix(frame(spark, documents(spark)))
    from pyspark.sql import functions as F

    flat = mixed.select("doc_id", F.explode("passes").alias("p")).select("doc_id", "p.position")
    got = [r.position for r in mixture.in_order(flat, "position").collect()]
    assert got == sorted(got)


def test_shards_are_whole_and_near_equal(spark):
    rows = documents(spark, n=800, long_words=300)
    df, slot_map = shards.sharded(frame(spark, rows))
    got = df.collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert all(sorted(x.slot for x in v) == list(range(len(v))) for v in by.values())
    totals = [sum(x.size for x in by[s]) for s in range(40)]
    assert max(totals) - min(totals) <= max(r.size for r in got)
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    assert sorted((r.size, r.text_crc32) for r in got) == want
    assert slot_map.version == 2
    again, _ = shards.sharded(frame(spark, rows).repartition(5))
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_equal_rows_spread_over_the_shards(spark, monkeypatch):
    monkeypatch.setattr(shards, "COPY_BLOCK", 700)  # several blocks
    rows = [(None, "the same text", "en", "a")] * 3000 + [(7, "other", "en", "a")] * 1000
    rows += [(i, f"text {i}", "en", "b") for i in range(100, 2100)]
    df, _ = shards.sharded(frame(spark, rows))
    got = df.collect()
    assert sorted((str(r.doc_id), r.text_crc32) for r in got) == sorted((str(d), zlib.crc32(t.encode())) for d, t, *_ in rows)
    totals, places = defaultdict(int), defaultdict(list)
    for r in got:
        totals[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert len(totals) == 40 and max(totals.values()) - min(totals.values()) <= 64
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    again, _ = shards.sharded(frame(spark, rows).repartition(5))
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_one_more_shard_moves_few_slots(spark, tmp_path):
    sizes = {s: 100 + s % 37 for s in range(shards.SLOTS)}
    first = shards.SlotMap.first().edited(sizes, 40)
    grown = first.edited(sizes, 41)
    moved = sum(a != b for a, b in zip(first.shards, grown.shards))
    assert moved < 2 * shards.SLOTS / 41
    totals = [0] * 41
    for slot, shard in enumerate(grown.shards):
        totals[shard] += sizes[slot]
    assert max(totals) - min(totals) <= 0.01 * sum(totals) / 41
    for m in (first, grown):
        shards.write_map(spark, m, str(tmp_path / "maps"))
    assert shards.read_map(spark, str(tmp_path / "maps")) == grown
    assert shards.read_map(spark, str(tmp_path / "maps"), 2).shards == first.shards
    assert shards.sharded(empty(spark))[0].collect() == []


def test_query_places_by_the_stored_map(spark, monkeypatch):
    stored, read = [], shards.read_map
    monkeypatch.setattr(shards, "read_map", lambda s, folder, *v: stored.append(folder) or read(s, folder, *v))
    monkeypatch.setattr(queries, "table", lambda *_: frame(spark, documents(spark)))
    got = queries.op10_shards(spark, "").collect()
    (folder,) = stored
    assert read(spark, folder, 1) == shards.SlotMap.first()
    last = read(spark, folder)
    assert last.version == 2 and {(r.shard, r.version) for r in got} == {(last.shards[r.vslot], 2) for r in got}


def greedy(pieces, text):
    known, n, at = set(pieces), 0, 0
    while at < len(text):
        end = next((e for e in range(len(text), at, -1) if text[at:e] in known), None)
        n += 1 if end else len(text[at].encode())
        at = end or at + 1
    return n


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.text("abcé▁", min_size=1, max_size=5), max_size=12),
    st.lists(st.text("abcé▁z", max_size=12), max_size=6),
)
def test_automaton_counts_as_greedy_search(pieces, words):
    automaton = wordpiece.Automaton(pieces)
    for w in words:
        assert automaton.length(w) == greedy(pieces, w)


def test_token_counts_with_the_public_vocabulary(spark):
    rows = documents(spark)
    pieces = wordpiece.vocabulary()
    got = wordpiece.token_counts(frame(spark, rows), wordpiece.Automaton(pieces)).collect()
    known = set(pieces)
    longest = max(map(len, pieces))

    def quick(text):
        n, at = 0, 0
        while at < len(text):
            ends = range(min(len(text), at + longest), at, -1)
            end = next((e for e in ends if text[at:e] in known), None)
            n += 1 if end else len(text[at].encode())
            at = end or at + 1
        return n

    want = sorted((str(d), size_of(t), sum(quick("▁" + w) for w in (t or "").split())) for d, t, *_ in rows)
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in got) == want
    assert wordpiece.token_counts(empty(spark), wordpiece.Automaton(["a"])).collect() == []
