"""Training steps of the language model."""

import tracemalloc

import numpy as np

from paysignal.llm import lm


def peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_training_step_reuses_its_matrices():
    r, n = np.random.default_rng(5), 4 * lm.STEP
    rows, wanted = r.integers(0, lm.ROWS, (4, n)).astype(np.int16), r.integers(0, lm.CLASSES, n)
    rows[0, : n // 2] = 7  # a row with very many occurrences
    learner = lm.Learner(np.zeros((lm.ROWS + 1, lm.CLASSES), dtype=np.float32))
    matrix = lm.STEP * lm.CLASSES * 4 / 1e6
    assert peak_mb(lambda: learner.learn(rows, wanted)) < 2 * matrix
    assert learner.touched[7] and np.isfinite(learner.weights).all()


def test_sums_of_rows_are_the_sums_of_their_values():
    r = np.random.default_rng(7)
    rows = np.concatenate((np.full(300, 4), np.repeat(np.arange(10, 40), 3), r.integers(50, 900, 500))).astype(np.int16)
    rows, values = r.permutation(rows), r.normal(size=(len(rows), lm.CLASSES)).astype(np.float32)
    own, sums = lm.sums_of(rows, values, lm.Buffers())
    assert own.tolist() == sorted(set(rows.tolist()))
    for i, row in enumerate(own.tolist()):
        np.testing.assert_allclose(sums[i], values[rows == row].sum(axis=0), rtol=1e-3, atol=1e-3)
