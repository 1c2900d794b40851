import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paysignal.llm import ann, lm, minhash, topk
from paysignal.llm.components import components
from paysignal.llm.langid import remainder
from paysignal.llm.scratch import Scratch


def shingle_sets(texts, k):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


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


def brute_components(ids, texts, k):
    """All pairs of all documents; rows without an id take no part."""
    own = shingle_sets(texts, k)
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, i))
    links = []
    for x, i in enumerate(order):
        for y in range(x):
            j = order[y]
            if ids[i] is None or ids[j] is None:
                continue
            inter = len(own[i] & own[j])
            if inter and 100 * inter >= 80 * (len(own[i]) + len(own[j]) - inter):
                links.append((x, y))
    root = roots(len(order), links)
    return {(ids[i], texts[i]): (len(own[i]), ids[order[root[x]]]) for x, i in enumerate(order)}


def edited(rnd, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
    return " ".join(words)


def planted(seed):
    """Copies, near copies at and around the threshold, chains, shared passages and short texts."""
    rnd = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(300)]
    passage = " ".join(rnd.choices(vocabulary, k=60))
    texts = []
    for _ in range(12):
        base = rnd.choices(vocabulary, k=rnd.randrange(20, 200))
        texts += [" ".join(base)] * 2 + [edited(rnd, base, c) for c in (1, 1, 2, 3, 4, 6, 9)]
    texts += [passage + " " + " ".join(rnd.choices(vocabulary, k=rnd.randrange(5, 60))) for _ in range(40)]
    hub = rnd.choices(vocabulary, k=120)
    texts += [edited(rnd, hub, rnd.randrange(0, 4)) for _ in range(60)]
    chain = rnd.choices(vocabulary, k=100)
    for i in range(25):
        texts.append(" ".join(chain))
        chain = chain[3:] + [f"c{i}a", f"c{i}b", f"c{i}c"]
    texts += ["", None, "one", "one", "two words", "Two Words", "a b c", "a b c d"]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize(("words", "small"), [(4, 16), (5, 3)])
def test_near_duplicates_equal_all_pairs(spark, words, small):
    texts = planted(words)
    ids = [3 * i + 1 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, key string, n int, rep int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, words=words, small=small).collect()}
    want = brute_components(ids, texts, words)
    assert got == {i: want[i, t] for i, t in zip(ids, texts, strict=True)}


def test_rows_of_one_id_are_linked_by_their_texts_alone(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(5, a), (5, b), (3, a + " x"), (7, b + " y"), (8, b + " y")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [
        (3, 3, True), (5, 3, False), (5, 5, True), (7, 5, False), (8, 5, False)
    ]


def test_dense_groups_leave_their_tasks_as_members(spark, monkeypatch):
    """Two groups of near copies just too different to be linked across: no pair of them becomes a row."""
    rnd = random.Random(5)
    base = [f"t{i}" for i in range(400)]
    other = [w if rnd.random() > 0.035 else f"o{i}" for i, w in enumerate(base)]
    texts = [edited(rnd, side, 1) for side in (base, other) for _ in range(70)]
    monkeypatch.setattr(minhash, "SHINGLES", 20_000)
    monkeypatch.setattr(minhash, "ONES", 16)
    monkeypatch.setattr(minhash, "ALLS", 32)
    counts = []
    screened = minhash._Join._screened

    def counted(self, members, last):
        out = self.scratch.table(screened(self, members, last), "counted")
        counts.append((out.filter("a IS NOT NULL").count(), out.filter("rep IS NOT NULL").count(), members.count()))
        return out

    monkeypatch.setattr(minhash._Join, "_screened", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, words=4, recall=0.99, small=8).collect()}
    want = brute_components(list(range(len(texts))), texts, 4)
    assert got == {i: root for (i, _), (_, root) in want.items()}
    assert any(dense for _, dense, _ in counts)
    assert all(pairs <= 20 * members for pairs, _, members in counts)


def test_trees_follow_the_target_recall():
    assert minhash.trees_for(0.9, 0.8) < minhash.trees_for(0.999, 0.8) < minhash.trees_for(0.999999, 0.8)
    assert minhash.trees_for(0.999, 0.9) < minhash.trees_for(0.999, 0.8)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    out = minhash.near_duplicates(odd_docs, words=4).collect()
    assert len(out) == odd_docs.count()
    by = {r.doc_id: r for r in out}
    assert by[1].component_id == by[2].component_id == 1 and by[1].kept and not by[2].kept
    assert all(r.component_id is None and r.kept for r in out if r.doc_id is None)
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0
    assert by[9].n_shingles == by[10].n_shingles == 1
    assert minhash.near_duplicates(no_docs).collect() == []


def test_intersections_by_matrix_equal_those_by_pair(monkeypatch):
    rng = np.random.default_rng(2)
    left, right = ([np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in rng.integers(0, 90, 20)] for _ in range(2))
    x, y = (a.ravel() for a in np.meshgrid(np.arange(20), np.arange(20)))
    want = [len(set(left[i]) & set(right[j])) for i, j in zip(x, y)]
    monkeypatch.setattr(minhash, "COLUMNS", 37)
    assert minhash.intersections(left, right, x, y).tolist() == want
    monkeypatch.setattr(minhash, "MATRIX", 10**9)
    assert minhash.intersections(left, right, x, y).tolist() == want


def test_components(spark, tmp_dir):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 200)] + [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(df, Scratch(spark, "test")).collect()}
    root = roots(400, links)
    assert got == {x: root[x] for pair in links if pair[0] != pair[1] for x in pair}
    assert components(df.limit(0), Scratch(spark, "test")).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0.5, "x") for i, v in rows], "vec_id long, embedding array<float>, score double, list string")


def odd_vectors(seed, n=900, dims=24):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dims))
    made = (centres[rng.integers(0, 6, n)] + 0.6 * rng.standard_normal((n, dims))) * rng.uniform(0.2, 2, (n, 1)) / 6
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(made)]
    rows += [(1000 + i, rows[20][1]) for i in range(30)]  # ties
    bad = [(2000, None), (2020, []), (2040, [0.0] * dims), (2060, [float("nan")] + [0.1] * (dims - 1)), (2080, [float("inf")] * dims)]
    bad += [(2100, [None] + [0.1] * (dims - 1)), (None, rows[0][1]), (2120, rows[3][1][:5]), (40, rows[40][1])]
    return rows + bad


def brute_search(rows, k, every, score, zero_ok):
    full = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not zero_ok and not any(v):
            continue
        full.append((i, np.array(v + [0.0] * (24 - len(v)))))
    out = {}
    for i, q in full:
        if i % every == 0 and i not in out:
            found = sorted((-score(q, v), j) for j, v in full if j != i)[:k]
            out[i] = [(j, -s) for s, j in found]
    return out


def grouped(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("block", [100, 2048])
def test_topk_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 16)
    rows = odd_vectors(5)
    got = grouped(topk.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=5))
    assert got == brute_search(rows, 5, 20, lambda q, v: int(np.floor(256 * q) @ np.floor(256 * v)), True)


def test_topk_few_rows(spark):
    df = vectors(spark, [(0, [1.0, 2.0]), (1, [1.0]), (50, [-1.0, 0.0])])
    assert grouped(topk.search(df, F.col("vec_id") % 50 == 0, k=5)) == {0: [(1, 65536), (50, -65536)], 50: [(0, -65536), (1, -65536)]}
    assert topk.search(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.search(df.filter("vec_id = 0"), F.col("vec_id") % 50 == 0).collect() == []
    with pytest.raises(Exception, match="too large"):
        topk.search(vectors(spark, [(0, [1e9]), (1, [1e9])]), F.col("vec_id") % 50 == 0).collect()


def test_lists_stop_early(monkeypatch):
    """Outsiders are dropped before the lists end when a few vectors stand out."""
    rng = np.random.default_rng(0)
    x = rng.integers(-20, 20, (4000, 16))
    x[:8] = 400
    block = topk.Lists(np.arange(4000), x)
    read = []
    bincount = np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **b: read.append(len(a[0])) or bincount(*a, **b))
    at, score = block.top(np.full(16, 7), -1, 5)
    assert at.tolist() == [0, 1, 2, 3, 4] and set(score) == {7 * 400 * 16} and sum(read) <= x.size / 2


@pytest.mark.parametrize("chunk", [64, 2048])
def test_neighbours_reach_the_recall(spark, monkeypatch, chunk):
    monkeypatch.setattr(ann, "CHUNK", chunk)
    monkeypatch.setattr(ann, "QUERIES", 8)
    rows = odd_vectors(6)
    got = grouped(ann.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=20))
    want = brute_search(rows, 20, 20, lambda q, v: float((q * v).sum()), False)
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    true = {(q, v): s for q, found in want.items() for v, s in found}
    # By score, as ties make several sets of neighbours right.
    hits = sum(s >= want[q][-1][1] - 1e-12 for q, found in got.items() for _, s in found)
    assert hits >= 0.9 * len(true)
    assert all(abs(true[q, v] - s) < 1e-12 for q, found in got.items() for v, s in found if (q, v) in true)


def test_neighbours_few_rows(spark):
    df = vectors(spark, [(0, [1.0, 2.0]), (1, [1.0]), (20, [-1.0, 0.0]), (3, [0.0, 0.0]), (4, None)])
    assert grouped(ann.search(df, F.col("vec_id") % 20 == 0, k=20)) == {0: [(1, 1.0), (20, -1.0)], 20: [(0, -1.0), (1, -1.0)]}
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert ann.search(df.filter("vec_id = 1"), F.col("vec_id") % 20 == 0).collect() == []


def brute_base(rows):
    words = [(t or "").encode().lower().split() + [None] for _, t in rows]
    held = [zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for own, h in zip(words, held, strict=True) if not h for w in own)
    n, v = sum(c.values()), len(c)
    return [
        (h, len(own), sum(c[w] > 0 for w in own), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own))
        for own, h in zip(words, held, strict=True)
    ]


def lm_rows(spark, df):
    return lm.score(df, held_out=remainder(F.col("doc_id"), 7) == 2).collect()


@pytest.mark.parametrize("common", [50, lm.COMMON])
def test_lm_counts_and_base_equal_brute_force(spark, odd_docs, monkeypatch, common):
    monkeypatch.setattr(lm, "COMMON", common)  # 50: nearly all words go through the join
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    df = docs.unionByName(odd_docs.select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    out = lm_rows(spark, df)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert got == sorted((str(i), h, n, k, t, round(b, 6)) for (i, _), (h, n, k, t, b) in zip(rows, brute_base(rows), strict=True))
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in out)


def test_lm_probabilities_sum_to_one(spark, tmp_dir):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    counts = Scratch(spark, "test").table(lm._counts(docs), "counts")
    model = lm.fit(docs, counts)
    words = counts.collect()
    word = np.array([r.word for r in words]).view(np.uint64)
    t = lm.Tokens(word, np.array([r.tail for r in words]).astype(np.uint16), np.zeros(0, int), np.zeros(0, int))
    cls = lm.classes(t, model.top)
    inside = 10 ** model.log_inside(cls, np.array([r.c for r in words]))
    sums = np.bincount(cls, weights=inside, minlength=lm.CLASSES)
    sums[1 + lm.TOP :] += 10 ** model.unknown[1 + lm.TOP :]
    assert np.allclose(sums, 1)
    rows = np.random.default_rng(0).integers(0, lm.ROWS, (3, 5)).astype(np.int16)
    p = [np.exp(lm.log_class(model.weights, rows, np.full(5, k))) for k in range(lm.CLASSES)]
    assert np.allclose(np.sum(p, axis=0), 1, atol=1e-4)


def test_lm_features_see_three_words_back():
    assert (lm.CLASSES, lm.TOP, lm.TAILS) == (96, 63, 32)
    t = lm.tokens([b"a b c d", b"x b c d", b"a x c d", b"a b x d"])
    rows = lm.features(t)[:, t.first + 3]  # of "d"
    differs = [(rows[:, i] != rows[:, 0]).tolist() for i in (1, 2, 3)]
    # word before, second before, both together, third before
    assert differs == [[False, False, False, True], [False, True, True, False], [True, False, True, False]]


def test_lm_without_rows_to_learn_from(spark, no_docs, odd_docs):
    assert lm.score(no_docs).collect() == []
    out = lm.score(odd_docs, held_out=F.lit(True)).collect()
    assert len(out) == odd_docs.count()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 and r.score < 0 for r in out)
