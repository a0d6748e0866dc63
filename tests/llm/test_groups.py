"""Near-duplicates of texts and vectors, components and license finds."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from quarry.llm import embedding_dedup, graph, license_scan, setsketch
from quarry.llm.shingles import WordHashes, shingle_set


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(400, 600)] + \
        [(700, i) for i in range(701, 900)] + [(5, 5)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = roots(900, edges)
    assert all(got.get(i, i) == want[i] for i in range(900))
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[i:] for i in range(5)]))


def check_groups(rows, got, percent=85):
    sets = [brute_shingles(t) for _, t in rows]
    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    links = []
    for i, s in enumerate(sets):
        for j, k in Counter(j for g in s for j in where[g] if j < i).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                links.append((i, j))
    root = roots(len(rows), links)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root[i]] = min(least.get(root[i], doc), doc)
    want = Counter((doc, len(sets[i]), least[root[i]], doc == least[root[i]]) for i, (doc, _) in enumerate(rows))
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == want


def varied(seed, n):
    """Texts in families: copies with a growing number of changed words, and short and blank ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    while len(rows) < n:
        base = [word() for _ in range(rng.choice([3, 6, 40, 200]))]
        for k in range(rng.choice([1, 2, 9])):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 20 * k)):
                text[rng.randrange(len(text))] = word()
            rows.append((len(rows), rng.choice(["\n", " ", "\t "]).join(text)))
    return rows + [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n"), (0, rows[0][1]), (0, "other text of one id"),
                   (3, rows[7][1].upper())]


def test_near_duplicates_against_brute_force(spark, sf_small):
    rows = varied(1, 150)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, component string")
    check_groups(rows, setsketch.groups(docs).collect())
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    check_groups([(r.doc_id, r.text) for r in docs.collect()], setsketch.groups(docs).collect())


def test_chain_of_near_copies_without_a_common_centre(spark):
    """Links reach from one end to the other although the ends, and most pairs, are not similar."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10 ** 9)}" for _ in range(400)]
    rows = [(60 - i, " ".join(words[4 * i:4 * i + 160])) for i in range(60)]
    got = setsketch.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_groups(rows, got)
    assert len({r.component_id for r in got}) < 20


def test_buckets_of_several_blocks(spark, monkeypatch):
    """Near copies of one text with edits of every size: many members of a bucket do not link to its smallest."""
    monkeypatch.setattr(setsketch, "BLOCK", 6)
    rng = random.Random(10)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(70):
        text = list(base)
        for _ in range(i % 14):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10 ** 9)}"
        rows.append((i, " ".join(text)))
    got = setsketch.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_groups(rows, got)
    assert 2 < len({r.component_id for r in got}) < 70


def test_keep_one(spark):
    rows = varied(2, 60)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, id string, n int")
    kept = setsketch.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {(r.doc_id, r.component_id) for r in setsketch.groups(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in groups}
    empty = spark.createDataFrame([], docs.schema)
    assert setsketch.groups(empty).count() == 0 and setsketch.keep_one(empty).count() == 0


def test_sketches_estimate_and_merge():
    rng = np.random.default_rng(6)
    common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (850, 75, 75))
    x, y = np.unique(np.concatenate([common, a])), np.unique(np.concatenate([common, b]))
    s = setsketch.sketch_sets([x, y, np.union1d(x, y)])
    assert (setsketch.merge(s[0], s[1]) == s[2]).all()
    j = setsketch.estimate(np.array([(s[0] > s[1]).sum()]), np.array([(s[0] < s[1]).sum()]),
                           np.array([len(x)]), np.array([len(y)]))[0]
    assert abs(j - 0.85) < 5 * math.sqrt(0.85 * 0.15 / setsketch.REGISTERS)
    assert len(shingle_set(WordHashes().of("A b c D e f"))) == 2
    assert (shingle_set(WordHashes().of("A b")) == shingle_set(WordHashes().of("a  B"))).all()


def brute_vectors(rows):
    usable = {i: np.array(v, float) for i, (_, v, label) in enumerate(rows)
              if label is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    unit = {i: v / np.sqrt((v * v).sum()) for i, v in usable.items()}
    links = [(i, j) for i in unit for j in unit if j < i and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93]
    n = Counter(x for pair in links for x in pair)
    root = roots(len(rows), links)
    least = {}
    for i, r in enumerate(rows):
        least[root[i]] = min(least.get(root[i], r[0]), r[0])
    return Counter((r[0], n[i], least[root[i]], r[0] == least[root[i]]) for i, r in enumerate(rows)), len(links)


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    monkeypatch.setattr(embedding_dedup, "COMPONENT_BLOCK", 50)
    rng = np.random.default_rng(8)
    rows = []
    for k in range(60):
        centre = rng.standard_normal(32)
        for _ in range([1, 2, 5, 120][k % 4] if k < 8 else 1 + k % 3):
            rows.append((len(rows), (centre + rng.standard_normal(32) * 0.15).astype(float).tolist(), k % 3))
    same = rows[5][1]
    rows += [(len(rows) + i, v, label) for i, (v, label) in enumerate([
        (same, rows[5][2]), (same, rows[5][2]), ([2 * x for x in same], rows[5][2]), (same, None), (None, 1), ([], 1),
        ([0.0] * 32, 1), ([float("nan")] * 32, 1), ([None, *same[1:]], 1), ([float("inf"), *same[1:]], 1), ([1.0], 1),
        ([1.0], 1), ([-1.0], 1)])]
    rows.append((3, rows[3][1], rows[3][2]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect())
    want, n = brute_vectors(rows)
    assert n > 5000
    assert sum((got & want).values()) >= 0.99 * len(rows)
    assert sum(k[1] * c for k, c in got.items()) >= 0.99 * sum(k[1] * c for k, c in want.items())
    assert all(sum(c for k, c in got.items() if k[0] == i) == sum(c for k, c in want.items() if k[0] == i) for i in range(len(rows)))
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_vectors_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want, _ = brute_vectors([(r.vec_id, list(r.embedding), r.label) for r in df.collect()])
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect())
    assert sum((got & want).values()) >= 0.99 * sum(want.values())


def test_vectors_of_a_large_label_lose_no_pair(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "COMPONENT_BLOCK", 3000)
    rng = np.random.default_rng(12)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    # rows 2k and 2k + 1 for k < 300 are pairs at cosine 0.94
    a, b = x[0:600:2], x[1:600:2]
    b = b - (a * b).sum(axis=1, keepdims=True) * a
    x[1:600:2] = 0.94 * a + math.sqrt(1 - 0.94 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": list(x), "label": np.zeros(len(x), np.int32)}),
                   tmp_path / "vectors.parquet")
    near = x @ x.T >= 0.93
    assert near.sum() == len(x) + 600
    got = {r.vec_id: (r.n_links, r.component_id, r.kept)
           for r in embedding_dedup.near_duplicates(spark.read.parquet(str(tmp_path / "vectors.parquet"))).collect()}
    assert got == {i: (int(i < 600), i - i % 2 if i < 600 else i, i >= 600 or i % 2 == 0) for i in range(len(x))}


def test_passes_follow_the_label(monkeypatch):
    """Pairs at the threshold meet in some pass, whatever the label's size and shape; clusters need more passes."""
    monkeypatch.setattr(embedding_dedup, "WINDOW", 64)
    rng = np.random.default_rng(4)
    flat = rng.standard_normal((8000, 32))
    cone = flat * 0.35 + rng.standard_normal(32)
    for x in (flat, cone):
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    few, many = (embedding_dedup.passes_for(flat[:n], n) for n in (500, 8000))
    assert embedding_dedup.passes_for(flat[:60], 60) == 1
    assert 1 < few < many < embedding_dedup.passes_for(cone, 8000)
    a = flat[:1000]
    b = rng.standard_normal(a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.93 * a + math.sqrt(1 - 0.93 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    x = np.concatenate([flat[:8000], b])
    met = np.zeros(1000, bool)
    for p in range(embedding_dedup.passes_for(x, len(x))):
        place = np.empty(len(x), int)
        place[np.argsort(embedding_dedup.hashes(x, p), kind="stable")] = np.arange(len(x))
        met |= abs(place[:1000] - place[8000:]) <= 64
    assert met.mean() >= 0.99


def test_vectors_of_sorted_windows(spark, monkeypatch):
    """Small windows, so that links are found over many passes and blocks of a label."""
    monkeypatch.setattr(embedding_dedup, "WINDOW", 32)
    monkeypatch.setattr(embedding_dedup, "PART_BLOCKS", 4)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((1500, 24))
    x[1000:1300] = x[:300] + rng.standard_normal((300, 24)) * 0.12
    x[1300:1400] = x[5] + rng.standard_normal((100, 24)) * 0.05
    rows = [(i, v.tolist(), i % 2 if i < 1000 else (i - 1000) % 2 if i < 1300 else 1) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows],
                               "vec_id long, embedding array<double>, label int, root string, c int")
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect())
    want, n = brute_vectors(rows)
    assert n > 4000 and sum((got & want).values()) >= 0.99 * len(rows)


def brute_finds(text):
    """Templates with a window that holds enough of their shingles."""
    hashes = WordHashes()
    values = license_scan.shingles(text, hashes)
    found = set()
    for name, wording in license_scan.all_templates().items():
        t = license_scan.Template(name, wording, hashes)
        if any(len(set(values[s:s + t.window].tolist()) & set(t.shingles.tolist())) >= 0.8 * t.size
               for s in range(0, max(1, len(values)), t.stride)):
            found.add(name)
    return found


def licensed(seed):
    rng = random.Random(seed)
    prose = lambda n: " ".join(rng.choice(["under", "the", "license", "software", "cat", "this", "permitted", "of"])
                               for _ in range(n))
    texts = []
    for wording in license_scan.TEMPLATES.values():
        words = wording.split()
        for changes in (0, 1, len(words) // 30, len(words) // 8):
            some = list(words)
            for _ in range(changes):
                some[rng.randrange(len(some))] = "changed"
            texts.append(f"{prose(rng.randrange(60))} {' '.join(some)} {prose(rng.randrange(60))}")
    return texts


def test_license_finds_against_brute_force(spark):
    texts = licensed(9) + [None, "", "MIT", "Released under the MIT License", "released UNDER\nthe (MIT) license!"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert len(got) == len(texts)
    full = 0
    for i, t in enumerate(texts):
        want = brute_finds(t)
        names = set(got[i].licenses.split(",")) - {""}
        assert names <= want
        # finds inside a longer find are left out
        assert bool(names) == bool(want)
        full += names == want
        assert got[i].n_finds == len([s for s in got[i].spans.split(",") if s])
    assert full >= 0.7 * len(texts)
    assert "MIT line" in got[len(texts) - 1].licenses
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_usual_lines_are_found():
    matcher = license_scan.Matcher(license_scan.all_templates())
    for line, short in [("Licensed under the MIT License.", "MIT"), ("Distributed under the MIT License.", "MIT"),
                        ("This work is licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"), ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
                        ("code is available under the BSD 3-Clause License", "BSD-3-Clause"),
                        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
                        ("released under the GNU General Public License, version 2", "GPL-2.0")]:
        found = matcher(f"some words before it {line} and some words after")
        assert len(found) == 1 and found[0][2].startswith(short) and found[0][3] == 1.0, (line, found)
    assert not matcher("the license says that software is released and distributed to the public under a name")


def test_license_span_and_copies():
    matcher = license_scan.Matcher(license_scan.TEMPLATES)
    text = "one two released under the MIT License. three " * 3
    assert [f[:3] for f in matcher(text)] == [(2 + 8 * i, 7 + 8 * i, "MIT line") for i in range(3)]
    with pytest.raises(ValueError):
        license_scan.Matcher({"short": "too few words"})


@pytest.mark.parametrize("name", ["Apache-2.0 notice", "MIT permission", "GPL notice", "BSD conditions"])
@pytest.mark.parametrize("lead", [0, 1, 7, 33])
def test_adjacent_copies_of_a_notice_are_finds_of_their_own(name, lead):
    matcher = license_scan.Matcher(license_scan.TEMPLATES)
    notice = " ".join(license_scan.TEMPLATES[name].split())
    words = len(license_scan.WORD.findall(notice.lower().encode()))
    for copies in (1, 2, 3, 12):
        text = "word " * lead + " ".join([notice] * copies) + " and more" * 20
        got = [f for f in matcher(text) if f[2] == name]
        assert got == [(lead + i * words, lead + (i + 1) * words, name, 1.0) for i in range(copies)]
    # changed and cut copies, and words between them
    some, cut = notice.split(), notice.split()
    some[len(some) // 2] = "changed"
    del cut[:len(cut) // 8]
    parts = [notice, " ".join(some), notice, "two words", " ".join(cut), notice, notice.upper()]
    want, at = [], 0
    for part in parts:
        n = len(license_scan.WORD.findall(part.lower().encode()))
        want += [(at, at + n)] if n > 2 else []
        at += n
    assert [f[:2] for f in matcher(" ".join(parts)) if f[2] == name] == want
