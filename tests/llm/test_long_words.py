"""Sums over all segmentations of words of any length, against plain loops."""

from collections import Counter

import numpy as np
import pytest

from pitmark.llm import language_id
from pitmark.llm.pieces import piece_table

TABLE = piece_table("piece_bpe_32k.model")
MODEL = np.vstack([np.random.default_rng(1).random((TABLE.size, 2)) ** 8 * 1e-4 + 1e-9, np.zeros((1, 2))])
NORMAL = {TABLE.pieces[i]: int(i) for i in TABLE.ids}


def logs(word):
    """log of the sum, place by place, in logarithms."""
    total = [np.zeros(2)]
    for j in range(1, len(word) + 1):
        ways = [total[i] + np.log(MODEL[NORMAL[word[i:j]]]) for i in range(max(0, j - TABLE.longest), j) if word[i:j] in NORMAL]
        if word[j - 1] not in NORMAL:
            ways.append(total[j - 1] + np.log(language_id._STRANGE))
        total.append(np.logaddexp.reduce(ways))
    return total[-1]


@pytest.mark.parametrize("size", [1, 39, 40, 41, 42, 79, 80, 81, 300, 3000])
def test_words_are_summed_whole(size):
    words = ["▁" + ("therewasahouse☃ination" * 200)[i : i + size - 1] for i in range(3)]
    got = language_id.log_sums(MODEL, TABLE, words)
    assert np.allclose(got, [logs(w) for w in words], rtol=1e-9)


def test_groups_of_lengths_close_by():
    words = ["▁" + "thinghouse" * n + "x" * k for n in range(4, 9) for k in range(3)] + ["▁the", "▁and"]
    groups = list(language_id._groups(words, 100))
    assert sorted(i for g in groups for i in g) == list(range(len(words))) and len(groups) < len(words)
    for g in groups:
        some = [words[i] for i in g]
        assert np.allclose(language_id.log_sums(MODEL, TABLE, some), [logs(w) for w in some], rtol=1e-9)


def test_expected_counts_of_long_words():
    words = ["▁" + "thinghouse" * 5, "▁" + "housething" * 5 + "qz"]
    lattice, lengths = language_id._lattice(TABLE, words), np.array(list(map(len, words)))
    steps = language_id._probabilities(MODEL, lattice)
    a = language_id._forward(steps)
    long = list(language_id._expected(MODEL, lattice, lengths))
    for w, n in enumerate(lengths):
        # each character lies in one piece: the shares of the pieces over it add up to 1
        over = np.zeros((n, 2))
        for k, share in enumerate(long):
            for i in range(n - k):
                over[i : i + k + 1] += share[i, w]
        assert np.allclose(over, 1)
    one = words[0]
    alone = language_id._lattice(TABLE, [one])
    b = language_id._backward(language_id._probabilities(MODEL, alone))
    for k, share in enumerate(long):
        m = len(one) - k
        want = a[:m, 0] * steps[k][0, :m] * b[k + 1 : k + 1 + m, 0] / a[len(one), 0]
        assert np.allclose(share[:m, 0], want, rtol=1e-9)


def test_learning_from_long_words():
    counts = [Counter({"thing" * 20: 3, "the": 5}), Counter({"maison" * 20: 3, "la": 5})]
    model = language_id.fit_pieces(counts, TABLE, 3)
    assert np.allclose(model.sum(0), 1) and (model[:-1] > 0).all()
    got = language_id.log_sums(model, TABLE, ["▁" + "thing" * 30])
    assert got[0, 0] > got[0, 1]
