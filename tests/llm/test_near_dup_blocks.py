"""Groups of near copies that the rounds leave to the blocks."""

import random

from aerolith.llm import near_dup


def group():
    rng = random.Random(23)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base = [word() for _ in range(160)]
    texts = []
    for k in range(180):
        w = list(base)
        for _ in range(2 + k % 5):
            w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    return [(7 * i % 997, t) for i, t in enumerate(texts)]


def components(rows, size):
    """Every pair compared, then the smallest id that can be reached."""
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b])
             >= 80 * len(sets[a] | sets[b])]
    while any(label[a] != label[b] for a, b in links):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label, links


def test_blocks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "GAIN", 1)
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    given = {}
    plain = near_dup._block_links

    def blocks(*args):
        given["links"] = plain(*args)
        return given["links"]

    monkeypatch.setattr(near_dup, "_block_links", blocks)
    rows = group()
    expected, links = components(rows, 4)
    # Links and pairs a little below the threshold stand in one group.
    assert 0 < len(links) < len(rows) * (len(rows) - 1) / 4
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = near_dup.near_duplicates(docs, shingle=4, percent=80).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    # The blocks give links, and no more than their members need to meet.
    pairs = {(r["a"], r["b"]) for r in given["links"].collect()}
    assert pairs <= set(links) and len(pairs) > 0


def test_ids_of_unequal_texts_and_empty_sets(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "GAIN", 1)
    rows = group()[:40] + [(3000, ""), (3001, None), (None, "a b c d e")]
    rows += [(rows[0][0], "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dup.near_duplicates(docs, shingle=4, percent=80).collect()
    assert len(found) == len(rows)
    expected = components([r for r in rows[:40]], 4)[0]
    got = {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None}
    assert all(got[i] == c for i, c in expected.items())
    assert got[3000] == 3000 and got[3001] == 3001
