"""Stretches of merged links, arrays of verification, shuffle files of stored stages."""

import random

import numpy as np

from aerolith.llm import common as C, passages


def test_stretches_are_the_links_union(spark):
    rng = random.Random(3)
    least, rows = 46, []
    for _ in range(1500):
        lo = rng.randrange(900)
        rows.append((rng.randrange(4), 10 + rng.randrange(3), rng.choice((0, 7, 30, 31, -60)) + rng.randrange(3),
                     lo, lo + least - 1 + rng.randrange(60)))
    links = spark.createDataFrame(rows + rows[:300], "_id long, to long, off int, lo int, hi int")
    merged = passages._merged(links, least)
    assert merged.count() < 0.8 * len(rows)
    want = set()
    for pair in {r[:2] for r in rows}:
        of = sorted(r[2:] for r in rows if r[:2] == pair)
        cuts = [k for k in range(1, len(of)) if of[k][0] - of[k - 1][0] > passages.SLACK]
        for a, b in zip([0, *cuts], [*cuts, len(of)]):
            at = sorted({x for _, lo, hi in of[a:b] for x in range(lo, hi + 1)})
            first = at[0]
            for x, y in zip(at, [*at[1:], None]):
                if y != x + 1:
                    want.add((*pair, first, x + 1, of[a][0], of[b - 1][0]))
                    first = y
    assert {tuple(r) for r in passages._stretches(merged, least).collect()} == want


def test_alike_against_the_definition():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = (rng.integers(0, 60, rng.integers(0, 90)) for _ in range(2))
        least, held = 9, set(b.tolist())
        inside = np.zeros(len(a) + 2, bool)
        for i in range(len(a) - least + 1):
            if 9 * sum(x in held for x in a[i:i + least].tolist()) >= 8 * least:
                inside[i + 1:i + least + 1] = True
        step = np.diff(inside.astype(int))
        assert passages.alike(a, b, least) == list(zip(np.flatnonzero(step == 1).tolist(),
                                                       np.flatnonzero(step == -1).tolist()))


def test_setting_of_shuffle_files_is_restored(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with C.shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before
