"""Slopes and scores of the language model against plain formulas, and the room they take."""

import tracemalloc
import warnings

import numpy as np

from basketry.llm import lblm


def vocabulary(n):
    counts = np.arange(n, 0, -1)
    return lblm.Vocabulary([b"%d" % k for k in range(n)], counts, int(counts.sum()), n, np.ones(lblm.BUCKETS), np.zeros(lblm.BUCKETS))


def test_slopes_against_plain_formulas():
    vocab, dice = vocabulary(300), np.random.default_rng(2)
    model = lblm.untrained(vocab)
    model.vectors[:, :lblm.WIDTH] = dice.normal(size=(len(model.vectors), lblm.WIDTH))
    model.vectors[0], model.vectors[1] = 40, -40  # scores beyond what e^x can hold
    trainer = lblm.Trainer(model, vocab.sizes(), 3)
    hidden = dice.normal(size=(50, lblm.WIDTH + 1)).astype(np.float32)
    hidden[:, lblm.WIDTH] = 1
    real, drawn = dice.integers(0, 300, 50), np.array([0, 1, 5, 9, 9, 200])
    groups = model.groups[model.classes[real]]
    h, v, g = (x.astype(np.float64) for x in (hidden, model.vectors, model.group_vectors))
    of = lambda x: 1 / (1 + np.exp(-np.clip(x, -700, 700)))
    up = 1 - of((h * v[real]).sum(1) - trainer.shift[real])
    down = -lblm.NOISE / len(drawn) * of(h @ v[drawn].T - trainer.shift[drawn])
    all_groups = -trainer.group_noise * of(h @ g.T - trainer.group_shift)
    all_groups[np.arange(50), groups] += 1 - of((h * g[groups]).sum(1) - trainer.group_shift[groups])
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        back, words = trainer.contrast(hidden, real, drawn)
        back_of_groups = trainer.contrast_groups(hidden, groups)
    assert np.allclose(back, up[:, None] * v[real] + down @ v[drawn], rtol=1e-3, atol=1e-3)
    assert np.allclose(words, up[:, None] * h, rtol=1e-3, atol=1e-3)
    assert np.allclose(back_of_groups, all_groups @ g, rtol=1e-3, atol=1e-3)


def test_scores_of_groups_are_made_in_blocks():
    model = lblm.untrained(vocabulary(60_000))
    model.gather_classes()
    dice, n = np.random.default_rng(2), 1 << 16
    hidden = dice.normal(size=(n, lblm.WIDTH + 1)).astype(np.float32)
    entries, tree = np.unique(model.classes, return_index=True)[1], model.members()
    entries = dice.choice(entries, n)  # so that no class has many of the words
    tracemalloc.start()
    found = model.descend(hidden, entries, tree)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2 * hidden.nbytes + 6 * entries.nbytes  # two copies of the hidden vectors, no scores of all groups
    few = np.arange(0, n, 6007)  # they reach into every block
    assert np.allclose(found[few], model.descend(hidden[few], entries[few], tree), atol=1e-5)
