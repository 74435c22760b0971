"""Decontamination's verification in arrays against plain edit distances."""

import random

import numpy as np

from aerolith.llm import decontam


def distance_to_runs(item, window):
    """The least edit distance of the item to any run of the window, and where the
    first such run ends (plain dynamic programming)."""
    row = list(range(len(item) + 1))
    best, end = row[-1], 0
    for j, t in enumerate(window, 1):
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(new[-1] + 1, row[i] + 1, row[i - 1] + (x != t)))
        row = new
        if row[-1] < best:
            best, end = row[-1], j
    return best, end


def words(rng, n, vocabulary):
    return np.array([rng.choice(vocabulary) for _ in range(n)], np.uint64)


def test_windows_together_equal_windows_alone():
    rng = random.Random(6)
    vocabulary = [rng.randrange(1, 1 << 63) for _ in range(40)]
    items = [words(rng, n, vocabulary) for n in (1, 5, 13, 20, 63, 64)]
    index = decontam.Index(list(range(len(items))), items, 0.2, 1, {1, 5})
    tokens = np.concatenate([words(rng, 400, vocabulary), *items, words(rng, 100, [7, 8, *vocabulary])])
    item, a, b = [], [], []
    for _ in range(400):
        k = rng.randrange(len(items))
        start = rng.randrange(len(tokens))
        item.append(k)
        a.append(start)
        b.append(min(len(tokens), start + len(items[k]) + rng.randrange(30)))
    item, a, b = map(np.array, (item, a, b))
    codes = np.minimum(np.searchsorted(index.words, tokens), len(index.words) - 1)
    codes = np.where(index.words[codes] == tokens, codes, -1)
    distance, end = index._distances(item, a, b, codes)
    near = 0
    for k, x, y, d, e in zip(item, a, b, distance, end):
        want = distance_to_runs(items[k].tolist(), tokens[x:y].tolist())
        if want[0] <= index.edits[k]:
            near += 1
            assert (d, e) == want
        else:
            assert d > index.edits[k]
        assert decontam.best_match(index.masks[k], len(items[k]), tokens[x:y].tolist()) == want
    assert near > 10


def test_matches_against_all_windows():
    """Every text that holds an item within the allowed edits, and no other, with
    the least distance; items of all lengths, one longer than a machine word."""
    rng = random.Random(8)
    vocabulary = [rng.randrange(1, 1 << 63) for _ in range(3000)]
    lengths = [4, 9, 12, 13, 20, 31, 64, 90]
    items = [words(rng, n, vocabulary) for n in lengths]
    # Lengths over the walks' steps are found with the target recall; here a few more
    # are looked up by pieces, which miss none, and the others are left unedited.
    index = decontam.Index(list(range(len(items))), items, 0.2, 3, {4, 9, 12, 13, 20})
    texts, edit = [], np.random.Generator(np.random.Philox(5))
    for k in range(60):
        own = items[k % len(items)]
        rate = (0.2, 0.35, 0.0)[k % 3] if len(own) <= 20 else 0.0
        planted = decontam._edited(own, rate, edit) if k % 4 else words(rng, 10, vocabulary)
        texts.append(np.concatenate([words(rng, rng.randrange(30), vocabulary), planted,
                                     words(rng, rng.randrange(30), vocabulary)]))
    texts[7] = np.zeros(0, np.uint64)
    w = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    found = {(t, k): (d, first, end) for t, k, d, first, end in
             index.matches(np.concatenate(texts), w)}
    want = {}
    for t, text in enumerate(texts):
        for k, item in enumerate(items):
            d, end = distance_to_runs(item.tolist(), text.tolist())
            if d <= index.edits[k]:
                want[t, k] = (d, max(end - len(item), 0), end)
    assert set(found) == set(want) and len(want) > 20
    for key, value in want.items():
        assert found[key][0] == value[0]
    assert index.matches(np.zeros(0, np.uint64), np.zeros(1, np.int64)) == []


def test_no_items_match_nothing():
    index = decontam.Index([], [], 0.2, 1, set())
    assert index.matches(np.arange(5, dtype=np.uint64), np.array([0, 5])) == []
    empty = decontam.Index([1], [np.zeros(0, np.uint64)], 0.2, 1, set())
    assert empty.matches(np.arange(5, dtype=np.uint64), np.array([0, 5])) == []
