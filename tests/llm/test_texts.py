"""Fingerprints, toxicity, licences and pieces against plain Python."""

import dataclasses
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import documents, empty, frame, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from tarnworks.llm import licenses, pieces, sketches, toxicity


def test_sketches_of_edited_texts(spark):
    rows = [r for r in documents(spark) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    got = {r.doc_id: r for r in sketches.fingerprinted(frame(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for (d, text, *_), (_, after, *_) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        r = got[d]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in ((r.near_edited, edited), (r.near_next, after)):
            a, b = counted(text), counted(other)
            want = len(a & b) / len(a | b) if a | b else 1.0
            assert near == pytest.approx(want)
    assert len({got[k].fingerprint for k in (6, 7, 8, 9)}) == 1
    assert got[6].fingerprint != got[10].fingerprint


def counted(text):
    out, seen = set(), {}
    for p in sketches.pieces(text):
        seen[p] = seen.get(p, -1) + 1
        out.add((p, seen[p]))
    return out


SPACELESS = "".join(chr(0x4E00 + random.Random(1).randrange(2000) + k * 7 % 500) for k in range(900))


@pytest.mark.parametrize("text", [
    SPACELESS, "、".join(SPACELESS[i : i + 9] for i in range(0, 900, 9)), SPACELESS[:60],
    "".join(random.Random(2).choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(20_000)),
    "\t".join(f"cell{i * i}" for i in range(400)), "a short text of nine words that goes on", "seven little words are in this text",
    "x" * 5000,
])
def test_texts_without_spaces_and_short_ones_share_pieces(text):
    edited = sketches.edited_text(text, "OTHER 1234 " * (len(text) // 10 + 1))
    a, b = counted(text), counted(edited)
    assert len(a & b) / len(a | b) > 0.3
    assert max(map(len, sketches.pieces(text))) <= 4 * sketches.PIECE_CHARS
    assert "".join(sketches.pieces(text)) == text.replace("\n", "")
    inserted = text[: len(text) // 2] + "Q" + text[len(text) // 2 :]
    if len(set(text)) > 1:
        a, b = counted(text), counted(inserted)
        assert len(a & b) / len(a | b) > 0.3


def plain_pieces(text):
    """The rule, code point by code point."""
    m, out, start = 2**64 - 1, [], 0
    for i, c in enumerate(text):
        w = [ord(text[i - k]) if i >= k else 0 for k in range(4)]
        h = (w[0] * 0x9E3779B97F4A7C15 ^ w[1] << 8 ^ w[2] << 29 ^ w[3] * 0xC2B2AE3D27D4EB4F) & m
        chance = ((h ^ h >> 29) * 0xBF58476D1CE4E5B9 & m) >> 40
        stop = ord(c) in sketches.ENDS and not (i + 1 < len(text) and ord(text[i + 1]) in sketches.ENDS)
        word = ord(c) in sketches.SPACES and chance * 16 < 6 << 24
        if c == "\n" or stop or word or chance * 64 >= 63 << 24 or i + 1 - start == 64:
            out.append(text[start : i + 1].strip("\n"))
            start = i + 1
    return [p for p in [*out, text[start:].strip("\n")] if p]


@pytest.mark.parametrize("chunk", [1 << 20, 700])
def test_pieces_follow_the_rule(monkeypatch, chunk):
    """Also where a text is cut in chunks."""
    monkeypatch.setattr(sketches, "CHUNK", chunk)
    rng = random.Random(chunk)
    texts = [t for _, t, *_ in documents(None) if t] + [SPACELESS, "x" * 5000, "\n" * 2000, "a\n" * 900, "?!" * 800, "", "\0\0a"]
    texts += ["".join(rng.choices("ab .\n，。é\U0001f600", k=3000)) for _ in range(5)]
    for text in texts:
        assert sketches.pieces(text) == plain_pieces(text)
    a, b = sketches._pieces(texts), [sketches._pieces([t]) for t in texts]
    for k in range(len(texts)):
        mine = a[3] == k
        order = np.argsort(a[0][mine], kind="stable")
        assert (a[2][mine][order] == b[k][2]).all() and len(b[k][2]) == mine.sum()


def test_likeness_does_not_jump_with_the_length():
    """A few characters more, at any length: at least 0.8 of the share that is kept."""
    rng = random.Random(3)
    text, shares = prose(rng, 400), []
    for n in range(20, 1200, 3):
        more = "".join(rng.choices("abcdefgh ij", k=rng.randint(1, 30)))
        a, b = counted(text[:n]), counted(text[:n] + more)
        shares.append(len(a & b) / len(a | b) / (n / (n + len(more))))
    assert sum(shares) / len(shares) >= 0.8
    assert min(shares[60:]) > 0.5


def test_sketches_of_odd_tables(spark):
    assert sketches.fingerprinted(empty(spark)).collect() == []
    (one,) = sketches.fingerprinted(frame(spark, [(1, "abcdef", None, None)])).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    rows = documents(spark)  # repeated and null ids
    got = sketches.fingerprinted(frame(spark, rows)).collect()
    assert len(got) == len(rows)


def test_next_rows_where_ids_are_missing_or_shared(spark):
    """Most rows have no id or one id; each still has the row after it as its next."""
    rng = random.Random(7)
    rows = [(rng.choice([None, None, 5, 5, 5, k]), f"text {k} " * rng.randint(1, 9), None, None) for k in range(400)]
    df = sketches.with_next(frame(spark, rows))
    parts = [list(p) for p in df.rdd.glom().collect()]
    sizes = Counter(r.part for p in parts for r in p)
    assert max(sizes.values()) < 60
    following = {}
    for part in parts:
        for a, b in zip(part, part[1:]):
            if a.part == b.part and not a.guest:
                following[a.doc_id, a.text] = (b.doc_id, b.text)
    at = start = (rows[0][0], rows[0][1])
    seen = [at]
    while (at := following[at]) != start:
        seen.append(at)
    assert len(seen) == len({r[:2] for r in rows})
    ids = [d for d, _ in seen]
    top = ids.index(max(d for d in ids if d is not None))
    turned = ids[top:] + ids[:top]
    known = [d for d in turned if d is not None]
    assert known == sorted(known, reverse=True) and turned[len(known):] == [None] * (len(ids) - len(known))


def test_peeling_finds_both_sides():
    a = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    b = np.concatenate([a[5:], a[:3] ^ np.uint64(77)])
    zeros = lambda x: np.zeros(len(x), int)
    s = sketches.sketched(a, zeros(a), 1, 48).minus(sketches.sketched(b, zeros(b), 1, 48))
    keys, _, sign, good = s.peel()
    assert good[0]
    assert {int(k) for k, x in zip(keys, sign) if x == 1} == set(map(int, a[:5]))
    assert {int(k) for k, x in zip(keys, sign) if x == -1} == set(map(int, b[-3:]))
    differ, tries = sketches.differences((a, zeros(a)), (a[:0], zeros(a[:0])), 1)
    assert differ[0] == len(a) and tries[0] > 1


def plain_segments(s, base=0):
    """The best segment (shortest, first), then the same left and right of it."""
    best = None
    for i in range(len(s)):
        total = 0
        for j in range(i, len(s)):
            total += s[j]
            if total > 0 and (best is None or total > best[2]):
                best = (i, j + 1, total)
    if best is None:
        return []
    i, j, total = best
    return [*plain_segments(s[:i], base), (base + i, base + j, total), *plain_segments(s[j:], base + j)]


def test_versions_of_licences():
    scanner = licenses.Scanner(licenses.rules())
    for text, versions in (
        ("under the GPLv3 or the GNU General Public License, version 2", {"gpl-3.0", "gpl-2.0"}),
        ("3-clause BSD, BSD License 2 Clause", {"bsd-3-clause", "bsd-2-clause"}), ("CC0 1.0 Universal", {"cc0-1.0"}),
        ("SPDX-License-Identifier: LPPL-1.3c", {"lppl-1.3c"}), ("MIT/X11 License", set()), ("CC BY-SA 4.0", {"cc-by-sa-4.0"}),
        ("Apache License, Version 2.0", {"apache-2.0"}), ("PHP License 3.01", {"php-3.01"}), ("GPL", set()),
    ):
        assert {f[4] for f in scanner.scan(text)[2]} - {None} == versions, text


def test_keywords_hide_no_rule():
    """With and without the keywords the same detections, for each rule's own words too."""
    gated = licenses.Scanner(licenses.rules())
    free = licenses.Scanner([dataclasses.replace(r, keywords=()) for r in licenses.rules()])
    texts = [text for line in NAMED.split("\n") for text in line.split(": ", 1)[1].split("|")]
    for label, name, versions, spdx, _ in licenses.FAMILIES:
        plain = re.sub(r"\(\?:([^|()]*)[^()]*\)\??", r"\1", name).replace(" ?", " ").replace("\\w*", "")
        texts += [f"{plain} license version {v}" for v in versions] + [f"license {plain}", f"spdx license identifier {spdx.format(versions[0])}"]
    texts += [wording for _, wording, *_ in licenses.SINGLE]
    for text in texts:
        assert gated.scan(text) == free.scan(text), text
        assert gated.scan(f"submit {text} here") == free.scan(f"submit {text} here"), text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-40, 40).map(lambda x: x + 0.5), max_size=14))
def test_segments_against_all_spans(scores):
    got = [(b - a, t) for a, b, t in toxicity.segments(np.array(scores))]
    want = [(b - a, t) for a, b, t in plain_segments(scores)]
    assert sorted(t for _, t in got) == pytest.approx(sorted(t for _, t in want))


def test_segments_of_a_long_clean_text_take_linear_time():
    scores = np.where(np.arange(400_000) % 10 == 0, 0.5, -0.25)
    start = time.process_time()
    got = toxicity.segments(scores)
    assert len(got) == 40_000 and time.process_time() - start < 5


def toxic_rows(n=600, seed=5):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        text = prose(rng, rng.randint(5, 80))
        bad = rng.random() < 0.2
        if bad:
            w = text.split(" ")
            for _ in range(rng.randint(2, 6)):
                w.insert(rng.randrange(len(w) + 1), rng.choice(["idjot" + rng.choice(["", "en", "ha"]), "skum", "lozer"]))
            text = " ".join(w)
        docs.append((i, text, "en", "a"))
        if rng.random() < 0.8:
            labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_rows()
    table = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fitted(frame(spark, docs), table)
    extra = [(None, "skum lozer skum", None, None), (9001, None, None, None), (9002, "", None, None)]
    got = toxicity.scored(frame(spark, docs + extra), model, ["text", "score"]).collect()
    assert len(got) == len(docs) + 3
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert {r.predicted for r in got if r.doc_id in (9001, 9002)} == {0}
    assert all(r.row.score == r.doc_id for r in got)
    assert toxicity.scored(empty(spark), model).collect() == []


def test_fit_is_bounded_where_an_id_has_many_texts(spark):
    docs = [(1, f"text {i}", "en", "a") for i in range(500)] + [(i, f"own {i}", "en", "a") for i in range(2, 40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, toxic int")
    got = toxicity.fit_rows(frame(spark, docs), labels, 100).collect()
    assert len(got) == 100 == len({r.text for r in got})
    again = toxicity.fit_rows(frame(spark, docs).repartition(5), labels, 100).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert got[0].asDict().keys() == {"text", "toxic", "part"}


def test_toxicity_without_labels(spark):
    docs, _ = toxic_rows(50)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.scored(frame(spark, docs), toxicity.fitted(frame(spark, docs), none)).collect()
    assert {r.predicted for r in got} == {0}


def test_rate_solves_its_equation():
    values, counts = np.array([-0.25, 3.0]), np.array([9999.0, 1.0])
    rate = toxicity.rate_of(values, counts)
    assert 0.9999 * math.exp(-0.25 * rate) + 0.0001 * math.exp(3 * rate) == pytest.approx(1, abs=1e-6)


LICENSED = [
    (1, "Released under the MIT License. Also MIT License, and mit\nlicense!", None, None),
    (2, "GNU General Public License version 3, or the Apache License 2.0", None, None),
    (3, "SPDX-License-Identifier: MPL-2.0", None, None),
    (4, "submit license and permit licenses", None, None),
    (5, None, None, None),
    (6, "Ämit license ämit license mit license", None, None),
    (7, "ISC License", None, None),
    (None, "apache license", None, None),
]


def test_licence_places_of_a_long_text_take_linear_time():
    scanner = licenses.Scanner(licenses.rules())
    started = time.perf_counter()
    n, base, found = scanner.scan("mit license " * 100_000)
    assert time.perf_counter() - started < 60
    assert n == 200_000 and [w for w, _ in base] == list(range(0, n, 2))
    assert all(0 <= a < b <= n for a, b, *_ in found)


def test_license_places(spark):
    got = {r.doc_id: r for r in licenses.scanned(frame(spark, LICENSED)).collect()}
    for d, text, *_ in LICENSED:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = sorted(
            (i, label)
            for phrase, label in licenses.BASE.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        )
        r = got[d]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert got[3].labels == "mpl" and got[7].labels == "isc" and got[4].labels == ""
    assert licenses.scanned(empty(spark)).collect() == []
    assert len(licenses.rules()) > 300


NAMED = """mit: licensed under MIT|MIT/X11 license|an MIT-style license|licensed under the GPLv2 or MIT
apache: Apache 2.0 License|under Apache-2.0|Apache v2|Apache License v2.0|Apache License 2.0|license: ASL 2.0
gpl: licensed under GPLv3|released under the GPL v3|GPL-2.0-or-later|GPL 3|version 2 of the GPL|GNU GPL|under the GPL
gpl: GPL version 3 or any later version|GNU General Public License v3.0
lgpl: LGPLv2.1|LGPL version 3|version 2.1 of the GNU Lesser General Public License|under the LGPL|GNU Lesser General Public License v3
agpl: AGPLv3|GNU Affero General Public License v3.0|under the GNU AGPL
gfdl: GFDL 1.3|GNU Free Documentation License v1.2
bsd: BSD 3-Clause License|3-clause BSD|two-clause BSD license|BSD three clause|BSD3|a BSD-style license|licensed under the modified BSD
mpl: MPL 2.0|Mozilla Public License v2.0|Mozilla Public 2.0 License
epl: EPL-2.0|Eclipse Public License v1.0|Eclipse Distribution License
cddl: CDDL 1.0|under the CDDL
cpl: CPL-1.0|Common Public License v1.0
isc: ISC-style license|licensed under ISC
zlib: zlib/libpng license|licensed under zlib
unlicense: under the Unlicense
artistic: Artistic 2.0 License|Artistic License v2|under the same terms as Perl itself
bsl: Boost 1.0 license|Boost Software License v1.0|BSL-1.0
eupl: EUPL v1.2|European Union Public Licence v1.1
osl: OSL 3.0|Open Software License v3.0
afl: AFL-2.1|Academic Free License v3.0
ofl: OFL-1.1|under the SIL OFL
wtfpl: WTFPL v2
psf: PSF-2.0|PSF license
php: PHP 3.01 license|PHP License v3.01
ms-pl: under the MS-PL|Ms-PL license
ms-rl: under the MS-RL|Ms-RL license
ncsa: UIUC license|licensed under the NCSA
zpl: ZPL 2.1|Zope Public License v2.1
qpl: QPL-1.0|under the QPL
lppl: LPPL 1.3c|LaTeX Project Public License v1.3c
cecill: CeCILL-B v1|CeCILL 2.1|under the CeCILL-C
postgresql: Postgres license|licensed under PostgreSQL
upl: UPL 1.0|Universal Permissive License v1.0
mulan: MulanPSL-2.0|Mulan PSL v2|Mulan Permissive Software License v2
cc-by: licensed under CC BY 4.0|CC-BY|Creative Commons Attribution 4.0 International License
cc-by-sa: licensed under CC BY-SA 4.0|under the Creative Commons Attribution-ShareAlike 4.0 International License
cc-by-nc: CC BY-NC 4.0|Creative Commons Attribution-NonCommercial 3.0 Unported License
cc-by-nd: CC BY-ND 4.0|Creative Commons Attribution-NoDerivatives 4.0 International License
cc-by-nc-sa: CC BY-NC-SA 4.0|Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License
cc-by-nc-nd: CC BY-NC-ND 4.0|Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License
cc0: CC0 1.0 Universal|dedicated under CC0|Creative Commons Zero v1.0 Universal
proprietary: the End User License Agreement"""


def test_short_names_and_joined_versions():
    scanner, used = licenses.Scanner(licenses.rules()), set()
    wrong = []
    for line in NAMED.split("\n"):
        label, texts = line.split(": ", 1)
        for text in texts.split("|"):
            _, _, found = scanner.scan(f"This work is here, {text}, see below.")
            if label not in {f[2] for f in found} or {f[2] for f in found} - {label} and " or " not in text:
                wrong.append((label, text, found))
    for r, p, keys in scanner.rules:
        for line in NAMED.split("\n"):
            words = re.sub(r"[^a-z0-9]+", " ", line.split(": ", 1)[1].replace("|", "\n").lower())
            used |= {r} if r.priority == licenses.SHORT_PRIORITY and p.search(words.encode()) else set()
    assert wrong == []
    assert len(used) == len(licenses.SHORT)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 20), st.integers(1, 9)), max_size=12))
def test_contained_detections_go(spans):
    found = sorted(((-p, a, a + n, None) for p, a, n in spans), key=lambda f: (f[0], f[1] - f[2], f[1]))
    kept = []
    for f in found:
        if not any(k[1] <= f[1] and f[2] <= k[2] for k in kept):
            kept.append(f)
    assert licenses.outermost(found) == kept


def tiny(words):
    return pieces.Vocabulary(["<unk>", "▁", *words], [2, *[0] * (len(words) + 1)]).ready()


def best_score(text, v):
    best = [0.0] + [-math.inf] * len(text)
    rank = {p.replace("▁", " "): k + 1 for k, p in enumerate(p for p, kind in zip(v.pieces, v.kinds) if kind == 0)}
    norm = math.log(sum(1 / k for k in range(1, len(rank) + 1)))
    for j in range(1, len(text) + 1):
        for i in range(j):
            p = text[i:j]
            if p in rank:
                best[j] = max(best[j], best[i] - math.log(rank[p]) - norm)
            elif j == i + 1:
                best[j] = max(best[j], best[i] + v.unknown)
    return best[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab▁", min_size=1, max_size=4), unique=True, max_size=10), st.text("ab c", max_size=40))
def test_streamed_path_is_a_best_one(words, text):
    v = tiny([w for w in words if w != "▁"])
    rank = {i: k + 1 for k, i in enumerate(i for i, kind in enumerate(v.kinds) if kind == 0)}
    norm = math.log(sum(1 / k for k in range(1, len(rank) + 1)))
    ids = [i for run in pieces.viterbi(text, v) for i in run]
    # Unknown characters come out as bytes, here all with the id of <unk>.
    got = sum(-math.log(rank[i]) - norm if i in rank else v.unknown for i in ids)
    assert got == pytest.approx(best_score(text, v))


def test_round_trip_with_the_public_model(spark):
    v = pieces.Vocabulary.load()
    rows = [*documents(spark), (900, "  two  spaces\nand\ttabs ▁ 日本語 🙂 ", None, None), (901, "x" * 5000, None, None)]
    df = pieces.encoded(frame(spark, rows), v, ["source"])
    got = df.collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    assert all(r.n_ids == len(r.ids) for r in got)
    texts = sorted(r.text for r in pieces.decoded(df, v).collect())
    assert texts == sorted(t or "" for _, t, *_ in rows)
    assert pieces.encoded(empty(spark), v).collect() == []
    for text in ("The idea of the thing", "ré " * 30):
        ids = list(pieces.encode(text, v))
        whole = [i for run in pieces.viterbi(" " + text, v) for i in run]
        assert ids == whole  # runs between spaces give what the whole text gives


def test_window_stays_short():
    v = tiny(["a", "aa", "ab", "b"])
    runs = list(pieces.viterbi("aabab" * 2000, v))
    assert max(map(len, runs)) <= 4 * v.longest + 2
