"""What the corpus operators hold in a Python worker."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline as cp
from paysignal.llm import batches, bpe, minhash, mixing
from paysignal.session import bound_batches


def peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def members(ones: int, alls: int) -> pa.Table:
    r, n = np.random.default_rng(3), ones + alls
    return pa.table(
        {
            "grp": np.zeros(n, dtype=np.int64),
            "side": np.repeat(np.array([0, 1], dtype=np.int32), [ones, alls]),
            "rep": pa.array([r.bytes(16) for _ in range(n)]),
            "label": pa.array([r.bytes(16) for _ in range(n)]),
            "n": np.full(n, 100),
            "s0": np.where(np.arange(n) % 50 == 0, 5, r.integers(-(2**62), 2**62, n)),
            "s1": np.where(np.arange(n) % 50 == 0, 5, r.integers(-(2**62), 2**62, n)),
        }
    )


def test_candidates_hold_few_pairs_at_once():
    ones, alls = minhash.ONES, minhash.ALLS
    groups, found = minhash._Groups(members(ones, alls), (80, 100)), []
    assert peak_mb(lambda: found.extend(groups.candidates())) < 25  # 68 MB for all pairs at once
    of, one, other = (np.concatenate(x) for x in zip(*found))
    same = np.flatnonzero(np.arange(ones + alls) % 50 == 0)
    left, right = same[same < ones], same[same >= ones]
    met = set(zip(one.tolist(), other.tolist()))
    assert not of.any() and {(i, j) for i in left.tolist() for j in right.tolist()} <= met


def test_released_passes_all_batches_on():
    made = [pa.RecordBatch.from_pydict({"x": [i]}) for i in range(3)]
    assert list(batches.released(lambda found: (b for b in found))(iter(made))) == made


def test_pair_table_is_made_without_a_list_of_pairs():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert peak_mb(lambda: bpe.Vocabulary(path)) < 25  # 30 MB with a list of pairs


def test_mix_needs_no_python_worker(odd_docs, capsys):
    mixing.mix(odd_docs.select("doc_id", "text", "source")).select("copies").explain()
    # a list of rows would be an RDD, which Python workers of its own make
    assert "LocalTableScan" in capsys.readouterr().out


def test_texts_reach_python_in_bounded_batches(spark, no_docs):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        cp.tokens(spark, no_docs, "")  # as every stage with Python does
        docs = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("text"))
        found = docs.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"rows": [b.num_rows], "size": [b.nbytes]}) for b in bs), "rows long, size long")
        got = found.collect()
    finally:
        spark.conf.set(key, before)
    assert sum(r["rows"] for r in got) == 6000
    assert max(r["size"] for r in got) < (4 << 20) + 8000  # 12 MB in one batch before


def test_a_limit_of_the_cluster_stays():
    class Conf(dict):
        contains = dict.__contains__

        def set(self, *_):
            raise AssertionError

    conf = Conf({"spark.sql.execution.arrow.maxBytesPerBatch": "1m"})
    bound_batches(SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf), conf=conf))
