"""The trainer's step touches the weights that a window has gradients for, and is plain Adagrad."""

import numpy as np

from milepost.llm import lm


def test_a_step_equals_adagrad_over_all_weights():
    rng = np.random.default_rng(1)
    counts = np.sort(rng.integers(1, 50, 300))[::-1]
    vocabulary = lm.Vocabulary.of(np.arange(1, 301, dtype=np.uint64), counts, int(counts.sum()), 300)
    trainer = lm.Trainer(lm.Gru(lm.Gru.start(vocabulary).flat.copy()), 0)
    weights, sums = trainer.model.flat.copy(), trainer.sums.flat.copy()
    for n_lanes in (5, 3):
        x, y = rng.integers(0, 200, (2, 7, n_lanes))
        mask = np.ones(x.shape, bool)
        trainer.model.window(x, y, mask, np.zeros((n_lanes, lm.HIDDEN), np.float32), trainer.grads)
        assert np.array_equal(trainer.grads.used, np.unique(x))
        g = trainer.grads.flat / x.size
        sums += g * g
        weights -= lm.Trainer.RATE * g / np.sqrt(sums)
        trainer.step(x.size)
        assert np.array_equal(trainer.model.flat, weights) and np.array_equal(trainer.sums.flat, sums)
        assert not trainer.grads.flat.any()
