"""Repeated byte strings, spelling variants and the conversation trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paysignal.llm import convtrie, queries, suffixdedup, variants
from paysignal.llm.scratch import Scratch

SMALL = "/root/testdata/sf0.001"


# ---- repeated byte strings ----


def brute_repeats(texts, length):
    """(bytes, removed, runs, sha256 of the rest) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs = sum(1 for i in range(len(raw)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeats(df, spark, **kw):
    rows = suffixdedup.remove_repeats(df, Scratch(spark, "test"), **kw).collect()
    out = []
    for r in rows:
        removed = sum(e - s for s, e in zip(r.starts, r.ends))
        out.append((r.rec.doc_id, (len(r.kept) + removed, removed, len(r.starts), hashlib.sha256(r.kept).hexdigest())))
    return sorted(out, key=str)


def passages(seed, n=120):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(1, 9))) for _ in range(60)]
    shared = [" ".join(rnd.choices(words, k=30)) for _ in range(6)]
    texts = []
    for _ in range(n):
        x = " ".join(rnd.choices(words, k=rnd.randint(0, 40)))
        if rnd.random() < 0.6:
            x = x[: rnd.randint(0, len(x))] + rnd.choice(shared)[rnd.randint(0, 40) :] + x[: rnd.randint(0, 20)]
        if rnd.random() < 0.1:
            x += rnd.choice(["ab", "é", "x"]) * rnd.randint(1, 100)
        texts.append(x)
    return [*texts, texts[3], texts[3], None, "", "q" * 300, "\x00" * 150]


@pytest.mark.parametrize(("length", "block", "limit"), [(40, 2000, 10), (40, 400, 10**6), (24, 300, 0)])
def test_repeats_equal_all_substrings(spark, length, block, limit):
    texts = passages(length + block)
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, key string").repartition(3)
    want = sorted(((i, x) for i, x in enumerate(brute_repeats(texts, length))), key=str)
    assert repeats(df, spark, length=length, block=block, limit=limit) == want


def test_long_texts_are_read_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "STRETCH", 97)
    texts = passages(7, 40)
    items = [r for t in texts for b in range(0, max(0, len((t or "").encode()) - 39), 97)
             for r in suffixdedup._stretch_items(b"k", (t or "").encode()[b : b + 97 + 39], b, 40)]
    places = Counter()
    for _, _, _, _, lo, hi, mid, *_ in items:
        if mid is not None:
            places[lo, hi] += 1
    assert places and max(hi - lo for lo, hi in places) < 97


def test_repeats_of_odd_rows(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    want = sorted(zip([r.doc_id for r in rows], brute_repeats([r.text for r in rows], 400)), key=str)
    assert repeats(odd_docs, spark) == want
    assert repeats(no_docs, spark) == []


def test_suffix_order():
    rnd = random.Random(3)
    for n in (1, 2, 3, 4, 5, 10, 60, 400):
        for k in (1, 2, 6):
            s = np.array([rnd.randint(1, k) for _ in range(n)], dtype=np.int64)
            got = np.argsort(suffixdedup.suffix_ranks(s, 10**9), kind="stable").tolist()
            assert got == sorted(range(n), key=lambda i: s[i:].tolist())


def test_query_equals_all_substrings(spark):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op11_repeats(spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert got == dict(zip([r.doc_id for r in rows], brute_repeats([r.text for r in rows], 400)))


# ---- spelling variants ----

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows, least_length=7, every=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n > 1}


def apart_by_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n, ratio=10):
    near, form = {w: [x for x in n if x != w and apart_by_one(w, x)] for w in n}, {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root))
    return sorted(out)


def found(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


@pytest.mark.parametrize(("seed", "small", "symbols"), [(1, True, 8), (2, False, 8), (3, False, 2)])
def test_variants_equal_all_pairs(spark, seed, small, symbols):
    rnd = random.Random(seed)
    n = {"".join(rnd.choices("abé", k=rnd.randint(1, 6))): rnd.choice([2, 3, 5, 25, 60, 700, 8000]) for _ in range(250)}
    n |= {"x" * 3000: 2, "x" * 3001: 50, "aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000}
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    assert found(variants.variants(df, Scratch(spark, "test"), symbols=symbols, small=small)) == brute_variants(n)


def test_neighbourhoods_of_long_words_go_on_in_further_rows(spark, monkeypatch):
    monkeypatch.setattr(variants, "ROW_KEYS", 50)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"word": ["abcdefghij", "k"], "n": pa.array([2, 3], type=pa.int64())})
    rows = [r for b in variants.neighbourhoods(8)(iter([batch])) for r in b.to_pylist()]
    mine = [r for r in rows if r["word"] == "abcdefghij"]
    keys = [k for r in mine for k in r["keys"]]
    assert len(mine) > 1 and sum(r["own"] is not None for r in mine) == 1 and len(set(keys)) == len(keys)


def test_words_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(20, "Forêts ÉTÉÀÀÀÀ aeiouxyz AEIOUXYZ forêts×÷")] * 2
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows[-2:], "doc_id long, text string"))
    got = {r.word: r.n for r in variants.vocabulary(docs, least_length=3, every=2).collect()}
    assert got == brute_words(rows, 3, 2) and got
    assert found(variants.variants(variants.vocabulary(no_docs), Scratch(spark, "test"))) == []


def test_variants_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    n = brute_words(rows)
    by, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            by[w[:i] + "*" + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in n:
                near[w].add(w[:i] + w[i + 1 :]), near[w[:i] + w[i + 1 :]].add(w)
    for ws in by.values():
        for w in ws:
            near[w] |= ws - {w}
    got = found(queries.op12_spelling(spark, SMALL))
    assert [(w, k, m) for w, k, m, *_ in got] == sorted((w, n[w], len(near[w])) for w in n)


# ---- conversation trie ----

TRIE = "depth conv_id parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute_trie(rows, family=5, heads=9):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    members, built = defaultdict(list), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:]
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += not children[k]
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
        parent = min(members[k[:-1]]) if k else None
        out.append((len(k), min(m), parent, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(df):
    return sorted((tuple(r[c] for c in TRIE) for r in df.collect()), key=str)


def talks(seed, n=60):
    """Shared beginnings, repeated conversations and rows, one long conversation, odd values."""
    rnd = random.Random(seed)
    rows = []
    for c in range(-4, n):
        if rnd.random() < 0.15:
            continue
        say = ["hello", "bé", "", None, "x"] if rnd.random() < 0.8 else ["only"]
        rows += [(c, t, rnd.choice(["user", "user", None]), rnd.choice(say)) for t in range(rnd.randint(1, 10))]
    rows += [(70, t, "user", "hello") for t in range(120)] + [(71, t, "user", "hello") for t in range(120)]
    rows += [(72, None, "user", "z"), (72, 0, "a", "b"), (72, 0, "a", "a"), (72, 0, "a", "a"), (None, 1, "user", "lost"), (-10, 0, "u", "t")]
    return rows


@pytest.mark.parametrize(("seed", "band", "shard_rows", "limit"), [(1, 4096, 250_000, 10**6), (2, 2, 20, 3), (3, 3, 100, 1), (4, 40, 7, 10)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, band, shard_rows, limit):
    monkeypatch.setattr(convtrie, "PIECE_BYTES", 8)
    rows = talks(seed)
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "conv_id long, turn long, role string, text string, depth int, node string").repartition(3)
    scratch = Scratch(spark, "test")
    rebuilt = convtrie.grafted(convtrie.turns(df, scratch))
    got = convtrie.prefix_trie(rebuilt, scratch, band=band, shard_rows=shard_rows, limit=limit)
    assert trie(got) == brute_trie(rows)


def test_queue_gives_back_what_was_pushed():
    rnd = np.random.default_rng(1)
    queue, want = convtrie.SpillingQueue(50), Counter()
    for _ in range(30):
        keys = np.array([bytes([rnd.integers(0, 40)]) * 16 for _ in range(17)], dtype="S16")
        sums = rnd.integers(0, 9, size=(17, 2))
        for k, s in zip(keys.tolist(), sums.tolist()):
            want[k, 0] += s[0]
            want[k, 1] += s[1]
        queue.push(keys, sums)
    assert queue.spilled > 3
    got, runs = Counter(), queue.drain()
    for upto in sorted({k for k, _ in want}):
        for run in runs:
            for keys, sums in run.take(upto):
                assert (keys <= upto).all()
                for k, s in zip(keys.tolist(), sums.tolist()):
                    got[k, 0] += s[0]
                    got[k, 1] += s[1]
    assert +got == +want


def test_trie_of_no_and_of_small_tables(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    scratch = Scratch(spark, "test")
    assert convtrie.prefix_trie(convtrie.grafted(convtrie.turns(empty, scratch)), scratch).count() == 0
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert trie(queries.op13_prefix_trie(spark, SMALL)) == brute_trie(rows)
    assert empty.select(F.count("*")).first()[0] == 0
