"""Repeated windows, centroid clusters and source divergences against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from quarry.llm import centroid_clusters, source_divergence, substring_dedup

# ------------------------------------------------------------------ repeated windows


def brute_repeats(rows):
    least = {}
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (doc, _), w in zip(rows, split):
        for i in range(len(w) - 12):
            key = tuple(w[i:i + 13])
            if doc is not None:
                least[key] = min(least.get(key, doc), doc)
    out = []
    for (doc, _), w in zip(rows, split):
        keep = [True] * len(w)
        for i in range(len(w) - 12):
            if doc is not None and least[tuple(w[i:i + 13])] < doc:
                keep[i:i + 13] = [False] * 13
        text = " ".join(x for x, k in zip(w, keep) if k)
        out.append((doc, len(w), keep.count(False), hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def passages(seed, n):
    """Texts of few and of many words, with shared passages, copies, repeated lines and rare words."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "été", "the", f"w{rng.randrange(60)}", f"rare{rng.randrange(10 ** 9)}"])
    shared = [[word() for _ in range(rng.choice([12, 13, 14, 30, 60]))] for _ in range(6)]
    rows = []
    for i in range(n):
        text = [word() for _ in range(rng.choice([0, 5, 13, 40, 200]))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice(shared) * rng.choice([1, 1, 3])
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(text)))
    rows += [(n + i, rows[i][1]) for i in range(20)]
    return rows + [(None, rows[3][1]), (None, "x " * 40), (7, rows[9][1]), (7, rows[9][1]), (7, rows[7][1]),
                   (-5, rows[30][1]), (n + 50, None), (n + 51, ""), (n + 52, " \n"), (n + 53, "same " * 3000),
                   (n + 54, "same " * 2000), (n + 55, " ".join("ab" * 20) + " tail")]


def removed(spark, rows):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, digest string, doc int")
    return Counter(map(tuple, substring_dedup.digests(docs).collect()))


def test_repeats_against_brute_force(spark):
    rows = passages(3, 150)
    assert removed(spark, rows) == brute_repeats(rows)


@pytest.mark.parametrize("held, large, codes, per_bucket", [(1, 300_000, 20, 500), (200_000, 20, 5, 2_000), (40, 60, 0, 300)])
def test_repeats_over_many_flushes_and_large_buckets(spark, monkeypatch, held, large, codes, per_bucket):
    """Strings of many flushes meet; buckets that are too large give their windows one by one; words without codes."""
    monkeypatch.setattr(substring_dedup, "HELD", held)
    monkeypatch.setattr(substring_dedup, "LARGE", large)
    monkeypatch.setattr(substring_dedup, "PER_BUCKET", per_bucket)
    monkeypatch.setattr(substring_dedup, "LONGEST", 7)
    frequencies = substring_dedup._frequencies
    monkeypatch.setattr(substring_dedup, "_frequencies", lambda d: ((f := frequencies(d))[0][:codes], f[1], f[2]))
    rows = passages(4, 60)
    assert removed(spark, rows) == brute_repeats(rows)


def test_repeats_of_a_hot_passage(spark):
    rng = random.Random(6)
    hot = [f"h{i}" for i in range(50)]
    rows = [(1000 - i, " ".join([f"x{rng.randrange(10 ** 6)}" for _ in range(8)] + hot + [f"y{rng.randrange(10 ** 6)}"
                                                                                      for _ in range(8)])) for i in range(400)]
    got = removed(spark, rows)
    assert got == brute_repeats(rows)
    assert sum(n * count for (_, _, n, _), count in got.items()) == 50 * 399


def test_windows_whose_hashes_meet_are_told_apart(monkeypatch):
    """The exact comparison decides, even if all window hashes are equal."""
    texts = [b"a b a b a a b b a b a a b b b".split(), b"c a b a b a a b b a b a a b d".split()]
    cutter = substring_dedup.Cutter([b"a", b"b"], np.zeros(substring_dedup.COUNTERS, bool), 1)
    strings = []
    for doc, text in enumerate(texts):
        cutter.add([(doc, 9, text)])
        strings += [s for b in cutter.flush() for s in b.column(1).to_pylist() if s is not None]
    monkeypatch.setattr(substring_dedup, "splitmix", lambda x: x * np.uint64(0))
    block = substring_dedup.Block(strings)
    found = [x.tolist() for x in block.ranges(block.smaller())]
    assert found == [[1], [9], [1], [14]]


def test_no_documents_to_repeat(spark):
    assert removed(spark, []) == Counter()
    assert removed(spark, [(1, None), (None, None)]) == brute_repeats([(1, None), (None, None)])


# ------------------------------------------------------------------ centroid clusters


def brute_clusters(rows, k=16, rounds=3):
    kept = [(i, [int(np.floor(np.float64(x) * 64)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) and abs(x) < 2 ** 21 for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    cents = [list(v) for _, v in sorted(kept, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        members = defaultdict(list)
        for (_, v), (_, j) in zip(kept, assign()):
            members[j].append(v)
        for j, vs in members.items():
            cents[j] = [sum(col) // len(vs) for col in zip(*vs)]
    final = assign()
    per = Counter()
    for d, j in final:
        per[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return Counter((i, j, d, per[j], sum(per.values()), digest[j]) for (i, _), (d, j) in zip(kept, final))


def clustered(spark, rows, **kw):
    vectors = spark.createDataFrame([(i, v, "clash", 0) for i, v in rows],
                                    "vec_id long, embedding array<double>, cluster string, d int")
    return Counter(map(tuple, centroid_clusters.cluster(vectors, **kw).collect()))


def points(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, 64))
    rows = [(i, (centres[i % 9] + rng.normal(size=64) * (0.02 if i % 3 else 0.6)).tolist()) for i in range(n)]
    odd = [None, [], [1.0] * 63, [None] + [1.0] * 63, [float("nan")] + [0.0] * 63, [float("inf")] * 64, [0.0] * 64, [0.0] * 64,
           [1e300] * 64, [-2000.0] * 64, [2.0 ** 21] * 64, [2.0 ** 20] * 64, rows[5][1]]
    return rows + [(n + i, v) for i, v in enumerate(odd)] + [(3, rows[8][1]), (3, rows[3][1]), (None, rows[4][1]), (None, None)]


def test_clusters_against_brute_force(spark):
    rows = points(1, 260)
    assert clustered(spark, rows) == brute_clusters(rows)
    assert clustered(spark, rows, k=3, rounds=1, pivots=2) == brute_clusters(rows, 3, 1)


def test_few_equal_and_no_vectors(spark):
    same = [(i, [0.25] * 64) for i in range(30)]
    assert clustered(spark, same) == brute_clusters(same)
    few = points(2, 9)[:5]
    assert clustered(spark, few) == brute_clusters(few)
    assert clustered(spark, []) == Counter()
    assert clustered(spark, [(1, None), (2, [1.0])]) == Counter()


def test_ties_on_a_grid_go_to_the_smaller_centroid(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 1 / 64]) if j < 5 else 0.0 for j in range(64)]) for i in range(200)]
    assert clustered(spark, rows) == brute_clusters(rows)


def test_apex_bounds_enclose_distances_and_filter():
    rng = np.random.default_rng(5)
    centres = rng.integers(-300, 300, size=(16, 64))
    v = centres[rng.integers(0, 16, 2000)] + rng.integers(-20, 20, size=(2000, 64))
    simplex = centroid_clusters.Simplex(v[:64], 12)
    to_pivots = centroid_clusters.squared(v, simplex.pivots)
    (x, h), (y, g) = simplex.apex(to_pivots), simplex.apex(centroid_clusters.squared(centres, simplex.pivots))
    d = centroid_clusters.squared(v, centres)
    flat = ((x[:, None] - y[None]) ** 2).sum(axis=2)
    assert (flat + (h[:, None] - g[None]) ** 2 <= d + 1e-3).all()
    assert (flat + (h[:, None] + g[None]) ** 2 >= d - 1e-3).all()
    may = simplex.candidates(to_pivots, centres)
    assert may[np.arange(2000), d.argmin(axis=1)].all()
    assert may.sum() < 3 * len(v)                     # of 16 centroids each, most are dropped by bounds


# ------------------------------------------------------------------ source divergence


def brute_divergence(rows, min_docs, top=50):
    pattern = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    n, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        found = [w.translate(lower) for w in pattern.findall(text or "")]
        groups[lang or ""].add(source or "")
        n[lang or "", source or ""].update(found)
        df[lang or ""].update(set(found))
    out = Counter()
    for lang, sources in groups.items():
        kept = sorted(t for t, c in df[lang].items() if c >= min_docs)
        v = len(kept)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 5) // (total + 5 * v) for t in kept}

        q = shares(sum((n[lang, s] for s in sources), Counter()))
        p = {s: shares(n[lang, s]) for s in sources}
        for s in sources:
            parts = {"pair": [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s],
                     "term": [(p[s][t] - q[t], t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]}
            for part, items in parts.items():
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(ranked[:top] if part == "term" else ranked, 1):
                    out[lang, s, part, item, value, rank] += 1
    return out


def sourced(seed, n):
    rng = random.Random(seed)
    words = ["Été", "ß", "The", "the", "x y", "ÄÖ", "日本", *(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8))]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "é", "Z", None, "hot", "hot"])
        some = rng.sample(words, 12) if source != "hot" else words[:9]
        rows.append((rng.choice([" ", "-1 ", "\n"]).join(rng.choice(some) for _ in range(rng.choice([0, 3, 60]))), lang, source))
    return rows + [(None, "en", "empty"), ("", "fr", "one"), ("only", "it", "one"), ("12 34", "fr", "two"), rows[0], rows[0]]


def audited(spark, rows, **kw):
    docs = spark.createDataFrame([(t, la, s, 1, "clash") for t, la, s in rows],
                                 "text string, lang string, source string, rank int, term string")
    return Counter(map(tuple, source_divergence.audit(docs, **kw).collect()))


@pytest.mark.parametrize("min_docs, top", [(30, 50), (3, 4), (10 ** 6, 50)])
def test_divergences_against_brute_force(spark, min_docs, top):
    rows = sourced(1, 400)
    assert audited(spark, rows, min_docs=min_docs, top=top) == brute_divergence(rows, min_docs, top)


def test_divergences_over_many_cells_and_flushes(spark, monkeypatch):
    for name, value in (("GROUP_BLOCK", 2), ("TERM_BLOCK", 7), ("HELD", 30)):
        monkeypatch.setattr(source_divergence, name, value)
    rows = sourced(2, 300)
    assert audited(spark, rows, min_docs=5) == brute_divergence(rows, 5)


def test_no_sources(spark):
    assert audited(spark, []) == Counter()
    assert audited(spark, [(None, None, None)]) == Counter()


# ------------------------------------------------------------------ the queries' SQL


@pytest.mark.parametrize("name", ["op11_substring_dedup", "op12_centroid_clustering", "op13_source_divergence"])
def test_queries_match_their_sql(spark, sf_small, name):
    from quarry.llm.catalog import REGISTRY

    fn, sql = REGISTRY[name]
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = fn(spark, sf_small)
    cur = con.execute(sql)
    place = [[c[0] for c in cur.description].index(c) for c in df.columns]
    assert Counter(map(tuple, df.collect())) == Counter(tuple(r[i] for i in place) for r in cur.fetchall())
