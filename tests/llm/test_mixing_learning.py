"""The mixing of bit predictors learns from every byte of every training text."""

import numpy as np
import pytest

from loanloom.llm import lm_score

SCHEMA = "doc_id long, text string"


def _texts():
    """Long texts of one kind, and a few short ones of another."""
    rng = np.random.default_rng(8)
    words = ["alpha", "beta", "gamma", "delta", "epsilon"]
    long = [" ".join(words[k] for k in rng.integers(0, 5, 600)) for _ in range(6)]
    return [*long, "0192837465 564738", "", "x\0y"]


def _tables(texts):
    tables = [np.zeros((2, 1 << b), np.int64) for b in (8, *lm_score.BITS)]
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        g = lm_score.coded(data, np.array([0, len(data)]))[0]
        for bit in range(8):
            node, one = (1 << bit) | ((g & 255) >> (8 - bit)), (g >> (7 - bit)) & 1
            np.add.at(tables[0], (one, node), 1)
            for k, h in enumerate(lm_score._slots(g)):
                np.add.at(tables[k + 1], (one, lm_score._cell(h, node, lm_score.BITS[k])), 1)
    return tables


def test_mixing_learns_from_all_bytes(spark):
    texts = _texts()
    want = lm_score.learn_mixer(_tables(texts), [t.encode() for t in texts], lm_score.Params())
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], SCHEMA)
    for parts in (1, 5):
        got = lm_score.train_mixer(docs.repartition(parts))
        assert np.array_equal(got.weights, want.weights) and np.allclose(got.refine, want.refine)
    # every coded bit of every text has been counted in the refining map of the last pass
    packed = [lm_score._packed_counts(t) for t in _tables(texts)]
    sums = lm_score.Sums.none()
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        g = lm_score.coded(data, np.array([0, len(data)]))[0]
        lm_score.mixing_sums(packed, want.weights, g, np.ones(len(g), np.int64), 100, sums)
    assert sums.seen.sum() == 8 * sum(len(t.encode().replace(b"\0", b"\0\1")) + 2 for t in texts)


def test_newton_steps_lower_the_cost():
    texts = _texts()
    packed = [lm_score._packed_counts(t) for t in _tables(texts)]
    data = np.frombuffer("".join(texts[:6]).encode(), np.uint8)
    g, n = np.unique(lm_score.coded(data, np.array([0, len(data)]))[0], return_counts=True)
    costs = []

    def run(weights):
        sums = lm_score.Sums.none()
        lm_score.mixing_sums(packed, weights, g, n, 1 << 15, sums)
        costs.append(sums.cost.sum())
        return sums

    lm_score.fit_mixing(run, 3)
    assert costs[-1] < 0.95 * costs[0]


def test_counts_beyond_16_bits_keep_their_odds():
    table = np.array([[70_000, 0, 1 << 20, 3, 0], [35_000, 65_535, 1 << 10, 4, 0]])
    packed = lm_score._packed_counts(table).astype(np.int64)
    zeros, ones = packed & lm_score.MOST, packed >> 16
    assert zeros[3] == 3 and ones[1] == 65_535 and ones[4] == zeros[4] == 0
    assert ones[0] / zeros[0] == pytest.approx(0.5) and ones[2] / zeros[2] == pytest.approx(1 / 1024, rel=0.05)
