"""Near-duplicates, nearest vectors and URL verdicts against brute force."""

import random
import re
import time

import numpy as np
import pytest
import xxhash
from fixtures import documents, empty, frame, prose

from tarnworks.llm import nearest, simhash, urls


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_groups(rows, radius=3):
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[top(i)] = top(j)
    low = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return sorted((str(d), f"{fps[i]:016x}", str(low.get(top(i)))) for i, (d, *_) in enumerate(rows))


def found(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_groups_against_all_pairs(spark):
    rows = documents(spark)
    assert found(simhash.near_groups(frame(spark, rows))) == plain_groups(rows)
    assert simhash.near_groups(empty(spark)).collect() == []


@pytest.mark.parametrize("radius", [0, 3, 6])
def test_crowds_in_blocks(spark, monkeypatch, radius):
    """Chains of fingerprints that differ in few bits, some values held by many."""
    rng = random.Random(radius)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "CROWD", 8)
    fps = {0}
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(60):
            for b in rng.sample(range(64), rng.randint(0, 5)):
                at ^= 1 << b
            fps.add(at - (1 << 64) if at >> 63 else at)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = simhash.links(df, len(fps), radius).collect()
    nodes = sorted(fps)
    want, have = (groups_of(nodes, pairs) for pairs in (
        [(a, b) for a in nodes for b in nodes if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius],
        [(r.src, r.dst) for r in got],
    ))
    assert have == want


def groups_of(nodes, pairs):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_thresholds_lose_nothing():
    rng = np.random.default_rng(1)
    fp = rng.integers(-(2**63), 2**63, 500)
    for parts in (2, 3, 4):
        groups = simhash.grouped_bits(np.abs(rng.standard_normal((64, 64))), parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        counts = [[np.bincount(simhash.part_value(fp, p), minlength=1 << len(p)) for p in simhash.pieces_of(g)] for g in groups]
        for radius in (1, 3, 7):
            t = simhash.Plan(groups, counts, len(fp), radius).thresholds(fp)
            assert ((t.astype(int) + 1).sum(axis=0) == radius + 1).all()


def test_ball_counts():
    table = np.random.default_rng(2).integers(0, 5, 64)
    rings = simhash.ball_counts(table, 3)
    for v in (0, 13, 63):
        for e in range(4):
            assert rings[e][v] == sum(table[x] for x in range(64) if (x ^ v).bit_count() == e)


def near_copies(n, flips, seed):
    """Different fingerprints around a few centres, most of them few bits off."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(-(2**63), 2**63, 3)
    bits = (rng.random((n, 64)) < flips).astype(np.uint64) << np.arange(64, dtype=np.uint64)
    own = rng.choice(centres, n, p=[0.8, 0.1, 0.1]).view(np.uint64) ^ np.bitwise_or.reduce(bits, axis=1)
    return np.unique(own.view(np.int64))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("flips, many", [(0.02, 100), (0.06, 10**6), (0.06, 100), (0.12, 10**6), (0.12, 100)])
def test_crowd_links_against_all_pairs(monkeypatch, radius, flips, many):
    monkeypatch.setattr(simhash, "MANY", many)
    fps = near_copies(700, flips, radius)
    near = np.bitwise_count((fps[:, None] ^ fps).view(np.uint64)) <= radius
    a, b = np.nonzero(near)
    src, dst = simhash.crowd_links(fps, radius)
    assert (np.bitwise_count((src ^ dst).view(np.uint64)) <= 64).all()
    nodes = fps.tolist()
    assert groups_of(nodes, list(zip(src.tolist(), dst.tolist()))) == groups_of(
        nodes, list(zip(fps[a].tolist(), fps[b].tolist()))
    )


def test_crowd_of_near_copies_without_pairs(spark, monkeypatch):
    """4,000 near copies: few compared pairs, the groups of all pairs."""
    fps = near_copies(4200, 0.06, 1)[:4000]
    asked = []
    count = np.bitwise_count

    def counted(x):
        asked.append(x.size)
        return count(x)

    values = {i: simhash.part_value(fps, g) for i, g in enumerate(simhash.grouped_bits(np.ones((64, 64)), 4))}
    key = np.concatenate([v + (i << 20) for i, v in values.items()])
    order = np.argsort(key, kind="stable")
    rows = np.concatenate([fps] * 4)[order]
    lying = simhash.verified(np.repeat(key[order], 2), np.repeat(rows, 2), np.tile([False, True], len(rows)), 3)
    monkeypatch.setattr(simhash.np, "bitwise_count", counted)
    again = simhash.verified(np.repeat(key[order], 2), np.repeat(rows, 2), np.tile([False, True], len(rows)), 3)
    monkeypatch.undo()
    assert [x.tolist() for x in lying] == [x.tolist() for x in again]
    assert sum(asked) <= 50 * len(fps)
    df = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    got = simhash.links(df, len(fps), 3).collect()
    near = count((fps[:, None] ^ fps).view(np.uint64)) <= 3
    a, b = np.nonzero(np.triu(near, 1))
    low = dict(zip(*(x.tolist() for x in simhash.forest(fps[a], fps[b]))))
    have = dict(zip(*(x.tolist() for x in simhash.forest(*np.array([(r.src, r.dst) for r in got]).T))))
    assert have == low


def test_few_and_many_links_give_the_same_groups(spark, monkeypatch):
    rows = documents(spark)
    want = found(simhash.near_groups(frame(spark, rows)))
    monkeypatch.setattr(simhash, "FEW_LINKS", 0)
    assert found(simhash.near_groups(frame(spark, rows))) == want


def vectors(n=400, dim=16, seed=4):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, dim)).astype(np.float32).tolist()
    rows = [(i, x) for i, x in enumerate(v)]
    rows[1] = (1, rows[0][1])
    rows[2] = (2, [float(2 * x) for x in rows[0][1]])
    rows[3] = (3, None)
    rows[4] = (4, [0.0] * dim)
    rows[5] = (5, [float("nan")] * dim)
    rows[6] = (6, [None, *rows[7][1][1:]])
    rows[8] = (8, [float("inf"), *rows[7][1][1:]])
    rows[9] = (9, [1.0, 2.0])
    rows += [(None, rows[0][1]), (0, rows[0][1])]
    return rows


def test_nearest_against_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.withColumn("score", df.vec_id).repartition(3)
    got = nearest.nearest(df, df.filter("vec_id % 10 = 0"), block=64).collect()
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and len(v) == 16 and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    hits = total = 0
    for q in range(0, 400, 10):
        own = dict(reversed(good))[q]
        near = [(-float(v @ own / np.linalg.norm(v) / np.linalg.norm(own)), i) for i, v in good if i != q]
        want = sorted((round(s, 12), i) for s, i in near)[:5]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        scores = dict((i, -s) for s, i in near)
        assert all(m[2] == pytest.approx(scores[m[1]], abs=1e-12) for m in mine)
        hits += len({i for _, i in want} & {m[1] for m in mine})
        total += 5
    assert hits / total >= 0.9
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 0][:2] == [1, 2]


def test_nearest_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = nearest.nearest(df, df.filter("vec_id = 0")).collect()
    assert [(r.rank, r.vec_id) for r in got] == [(1, 1), (2, 2)]
    assert nearest.nearest(df.limit(0), df.limit(0)).collect() == []
    huge = spark.createDataFrame([(0, [1e300, 1e300]), (1, [1e-300, 1e-300])], "vec_id long, embedding array<double>")
    (one,) = nearest.nearest(huge, huge.filter("vec_id = 0")).collect()
    assert one.score == pytest.approx(1.0)


URLS = [
    (1, "http://a.example.org/es/x"), (2, "https://EXAMPLE.org/en/1?x=/es/"), (3, "https://example.org/en/2"),
    (4, "http://x.com/fr/1#a"), (5, "http://x.com/de/"), (6, "http://com/de/"), (7, "http://xcom/de/"),
    (8, None), (9, "no scheme"), (10, "a://b.org"), (11, "http://x.com/FR/"), (12, "://://x.org/"),
    (13, "http://x.com?u=http://example.org/es/"), (14, ""), (14, "http://x.net/de/"), (None, "http://x.com/de/é"),
]


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), v, h + p) for v, h, p in rules
        if url and "://" in url and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_url_verdicts(spark):
    df = spark.createDataFrame(URLS, "page_id long, url string")
    df = df.withColumn("verdict", df.page_id).withColumn("key", df.url)
    got = urls.judged(df, urls.rule_table(spark)).collect()
    want = sorted((str(i), *map(str, plain_verdict(u, urls.RULES))) for i, u in URLS)
    assert sorted(tuple(map(str, (r.page_id, r.host, r.path, r.rule, r.verdict))) for r in got) == want
    assert urls.judged(df.limit(0), urls.rule_table(spark)).collect() == []
    none = urls.judged(df, urls.rule_table(spark, ())).collect()
    assert {r.verdict for r in none} == {"allow"} and len(none) == len(URLS)


def test_long_list_of_urls(spark):
    listed = spark.range(3000).selectExpr("concat('h', id, '.net') AS host", "concat('/p', id % 7) AS path", "'block' AS verdict")
    pages = spark.range(6000).selectExpr("id AS page_id", "concat('http://www.h', id, '.net/p', id % 7, '/x') AS url")
    got = urls.judged(pages, listed).groupBy("verdict").count().collect()
    assert {r["verdict"]: r["count"] for r in got} == {"block": 3000, "allow": 3000}
    table = urls.bloom(urls.canonical(listed), 3000)
    line, words = urls._spots([f"g{i}" for i in range(20000)], len(table))
    assert ((table[line] & words) == words).all(axis=1).mean() < 0.02


def test_host_of_many_labels(spark):
    long = "a." * 100_000
    rows = [(1, f"http://{long}example.org/es/x"), (2, f"http://{long}com/de/"), (3, f"http://{long}net/"), (4, "http://.com/de/")]
    started = time.perf_counter()
    got = urls.judged(spark.createDataFrame(rows, "page_id long, url string"), urls.rule_table(spark)).collect()
    assert time.perf_counter() - started < 20
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == [
        (i, *plain_verdict(u, urls.RULES)[:2], rule, verdict)
        for (i, u), rule, verdict in zip(rows, ("example.org/es/", "com/de/", None, "com/de/"), ("block", "block", "allow", "block"))
    ]


def test_hosts_of_more_and_fewer_labels_than_listed(spark):
    listed = [("block", "a.b.c.d", "/x.y"), ("block", "c.d", "/"), ("allow", "exa", "mple.org/")]
    urls_of = ("z.a.b.c.d/x.y/q", "b.c.d/x.y", "y.c.d", "d/x.y", "z.z.z.z.z.d/", "example.org/", "..c.d/", "/p")
    rows = [(i, f"http://{u}") for i, u in enumerate(urls_of)]
    got = urls.judged(spark.createDataFrame(rows, "page_id long, url string"), urls.rule_table(spark, listed)).collect()
    want = sorted((i, *plain_verdict(u, listed)) for i, u in rows)
    assert sorted((r.page_id, r.host, r.path, r.verdict, r.rule) for r in got) == [(i, h, p, v, k) for i, h, p, k, v in want]
