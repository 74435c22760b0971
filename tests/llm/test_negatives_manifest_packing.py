"""Hard negatives, Merkle manifest and packing against brute force."""

import math
import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aerolith.llm import hard_negatives, merkle, packing
from aerolith.llm.queries import QUERIES, tokenizer_path

BYTE_BPE = tokenizer_path("byte_bpe_50k.json")


# ---------------------------------------------------------------- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, score long, vec int, id string, part int"


def vectors():
    """Rows with ties, equal vectors, repeated rows, nulls, NaN, infinity, short
    and empty vectors, components of any size; the last columns clash."""
    rng = random.Random(5)
    vec = lambda: [rng.gauss(0, 0.2) for _ in range(6)]
    hot = [0.25, -0.5, 0.125, 0.5, 0.0, 0.25]
    rows = []
    for i in range(1400):
        v = hot if rng.random() < 0.3 else vec()
        if rng.random() < 0.05:
            v = v[:3]
        rows.append((i, v, rng.choice([0, 0, 0, 1, 2, 3, 100 + i])))
    rows[100] = (100, hot, 0)
    rows[200] = (200, [-x for x in hot], 1)
    rows[300] = (300, [], 0)
    rows[400] = (400, [0.0] * 6, 2)
    rows[500] = (500, None, 1)
    rows[600] = (600, vec(), None)
    rows[700] = (700, [0.1, None, 0.2, 0.1, 0.1, 0.1], 1)
    rows[800] = (800, [0.1, float("nan"), 0.2, 0.1, 0.1, 0.1], 1)
    rows[801] = (801, [0.1, float("inf"), 0.2, 0.1, 0.1, 0.1], 1)
    rows[802] = (802, [1e30] * 6, 1)
    rows[803] = (803, [3e4] * 6, 1)
    rows += [rows[100], rows[11], rows[12], (None, hot, 0), (12, hot, 1)]
    return [(*r, 7, 8, "x", 9) for r in rows]


def mined(rows, anchors):
    part = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or \
                any(x is None or not math.isfinite(x) or abs(np.float32(x)) * 256 >= 1 << 26 for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        part[i, str(label), tuple(q + [0] * (6 - len(q)))] = None
    part = list(part)
    out = []
    for a, al, av in part:
        if not anchors(a):
            continue
        seen = sorted((-sum(x * y for x, y in zip(av, v)), i, label) for i, label, v in part if i != a)
        for s, p, _ in [x for x in seen if x[2] == al][:5]:
            fit = [(i, -t) for t, i, label in seen if label != al and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a, p, r, i, -s, t) for r, (i, t) in enumerate(fit[:10], 1)]
    return sorted(out)


def test_hard_negatives_against_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    want = mined(rows, lambda i: i % 100 == 0)
    assert len(want) > 200
    for setting in ({}, {"leaf": 4, "fan": 2, "shard_rows": 150}):
        found = hard_negatives.mine(spark, df, F.col("vec_id") % 100 == 0, **setting)
        assert sorted(tuple(r) for r in found.collect()) == want
    none = hard_negatives.mine(spark, df.limit(0), F.col("vec_id") % 100 == 0)
    assert none.count() == 0 and none.columns == found.columns
    assert hard_negatives.mine(spark, df, F.col("vec_id") == 500).count() == 0


def test_tree_skips_boxes():
    """On vectors in clusters, a search opens few of the leaves, and its boxes'
    intervals hold every row's score."""
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 300, (32, 8))
    v = np.floor(np.repeat(centres, 256, axis=0) + rng.normal(0, 10, (8192, 8))).astype(np.int64)
    ids, labels = np.arange(8192), np.full(8192, "a", object)
    shard = hard_negatives.Shard.build(ids, labels, v, leaf=64, fan=8)
    assert [len(x.start) for x in shard.levels][-1] == 1
    assert sorted(shard.ids.tolist()) == ids.tolist()
    leaves = shard.levels[0]
    q = v[5]
    for a, b, low, high in zip(leaves.start, leaves.end, leaves.low, leaves.high):
        s = shard.vectors[a:b] @ q
        assert np.minimum(q * low, q * high).sum() <= s.min()
        assert s.max() <= np.maximum(q * low, q * high).sum()
    again = hard_negatives.Shard.from_bytes(shard.to_bytes())
    opened = []
    search = hard_negatives.Search(q[None].astype(float), np.array([5]), np.array(["a"], object),
                                   np.array([0]), True, 5, np.array([-1 << 60]), np.array([1 << 60]))
    leaf = search._leaf
    search._leaf = lambda *a: (opened.append(1), leaf(*a))
    search._file(again)
    s = v @ q
    best = sorted((x for x in range(8192) if x != 5), key=lambda x: (-s[x], x))[:5]
    assert search.ids[0].tolist() == best and search.scores[0].tolist() == s[best].tolist()
    assert len(opened) < len(leaves.start) / 4


# ---------------------------------------------------------------- manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, g string, i int, h int"


def manifest_rows():
    rng = random.Random(9)
    rows = [(k, f"Text {rng.random()} É", "en", rng.choice(["a", None]), k) for k in range(1300)]
    rows += [(k, "ABC" if k % 2 else "abc", f"l{k % 11}", "b", None) for k in range(2000, 2060)]
    rows += [(k, None if k % 2 else "", None, "c", 1) for k in range(3000, 3020)]
    rows += [(None, "Null id", "en", "a", 1), (None, "Null id", "en", "a", 1), (7, "Other 7", "en", "a", 2),
             rows[8], rows[9], (1, "One", "only", "z", 5), (2, "x" * 100_000, "L", "z", 5), (3, "E", "", "z", 5)]
    rng.shuffle(rows)
    return [(*r, "clash", 1, 2) for r in rows]


def hashed(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lower=False):
    doc, text, lang, source, n, *_ = row
    if lower and text is not None:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    return hashed("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text))


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([hashed(low[k:k + 8]) for k in range(0, len(low), 8)])
    return levels


def path_of(levels, k):
    out = []
    for level in levels[:-1]:
        at = k // 8 * 8
        out.append((level[at:k], level[k + 1:at + 8]))
        k //= 8
    return out


def manifest_of(rows, tampered):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf_of(r), leaf_of(r, tampered(r[0])), r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in order}
    crown = tree([trees[g][-1][0] for g in order])
    root, out = crown[-1][0], []
    for at, g in enumerate(order):
        for k, (_, _, leaf, second, doc) in enumerate(sorted(groups[g])):
            path = path_of(trees[g], k) + path_of(crown, at)
            node = second
            for left, right in path:
                node = hashed([*left, node, *right])
            out.append((doc, leaf, trees[g][-1][0], root,
                        hashed(x for left, right in path for x in left + right), node, node == root))
    return sorted(out, key=str)


def test_manifest_against_brute_force(spark):
    rows = manifest_rows()
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    found = merkle.manifest(df, fields, "doc_id", "lang", {"text": lowered}, hit)
    want = manifest_of(rows, lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 0)
    assert sorted((tuple(r) for r in found.drop("lang").collect()), key=str) == want
    assert {x[-1] for x in want} == {True, False}
    # Without altered fields every row verifies; one group, one row, no row.
    one = df.where("lang = 'only'")
    r = merkle.manifest(one, fields, "doc_id", "lang").first()
    assert r.verified and r.leaf == r.subroot == r.root == r.folded_root
    assert r.proof_sha256 == sha256().hexdigest()
    assert merkle.manifest(df.limit(0), fields, "doc_id", "lang").count() == 0


def test_changed_row_changes_the_root(spark):
    rows = manifest_rows()[:80]
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    root = lambda x: merkle.manifest(spark.createDataFrame(x, DOCS), fields, "doc_id", "lang") \
        .first().root
    assert root(rows) == root(rows[::-1]) != root([*rows[1:], (*rows[0][:1], "new", *rows[0][2:])])


# ---------------------------------------------------------------- packing

TRICKY = [" ", "  ", "\n", "\t", " ", " ", "\u0085", "é", "Ã", "×", "中", "🙂", "a", "B's", "'ll", "don't",
          "9", "3.14", ",", "<|endoftext|>", "word", " the", "naïve", "\r\n", "́", "_", "\x00", "\x1f", " x "]


def test_stretches_give_the_whole_texts_ids():
    rng = random.Random(3)
    plain = Tokenizer.from_file(BYTE_BPE)
    encoder = packing.encoder_of(BYTE_BPE)
    texts = ["".join(rng.choices(TRICKY, k=rng.randint(0, 40))) for _ in range(1500)]
    texts += ["", " ", "  a", "a ", " a", "a b", "é é", "é  é", "a  b c"]
    data = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    ids, at = encoder.encode(np.frombuffer(b"".join(data), np.uint8), offs)
    for t, a, b in zip(texts, at, at[1:]):
        assert ids[a:b].tolist() == plain.encode(t, add_special_tokens=False).ids + [0], t


def test_windows_are_full_and_few():
    rng = random.Random(2)
    done = []
    w = packing.Windows(64, 4, done.append)
    ids = lambda n: np.arange(n, dtype=np.uint32)
    total = 0
    for k in range(500):
        n = rng.randint(1, 63)
        total += n
        w.place([(k, 0, n, ids(n))])
        assert len(w.open) <= 4 and all(0 < u < 64 for u, _ in w.open)
    assert all(sum(len(p[3]) for p in s) == 64 for s in done)
    # A piece that fits goes where the least room holds it, uncut.
    fresh = packing.Windows(64, 4, done.append)
    for n in (40, 60, 20):
        fresh.place([(n, 0, n, ids(n))])
    assert [u for u, _ in fresh.open] == [60, 60] and [p[0] for p in fresh.open[0][1]] == [40, 20]
    w.finish()
    sizes = [sum(len(p[3]) for p in s) for s in done]
    assert sum(sizes) == total and all(x & (x - 1) == 0 for x in sizes)
    assert sum(x < 64 for x in sizes) <= 6


PACKED = "doc_id long, text string, ids int, task string, sequence_id int"


@pytest.mark.parametrize("parts", [1, 5, 70])
def test_packing_round_trip(spark, parts):
    rng = random.Random(parts)
    words = ["alpha", "beta,", "gamma", "É", "x\n", " \t", "42"]
    texts = [" ".join(rng.choices(words, k=rng.choice([3, 40, 300, 2000]))) for _ in range(60)]
    texts += ["", None, None, "a" * 30_000, " ".join(words * 3000), texts[0], texts[0]]
    rows = [(i if i != 7 else None, t, 1, "t", 2) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, PACKED).repartition(parts)
    packed = packing.pack(df, BYTE_BPE).cache()
    plain = Tokenizer.from_file(BYTE_BPE)
    docs = defaultdict(list)
    for r in packed.collect():
        docs[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    assert set(docs) == {r[0] for r in rows}
    for i, t, *_ in rows:
        got = [x for _, x, _ in sorted(docs[i])]
        want = plain.encode(t or "", add_special_tokens=False).ids + [0]
        assert sum(got, []) == want and {n for *_, n in docs[i]} == {len(want)}
        assert all(got) and [s for s, *_ in sorted(docs[i])] == \
            np.cumsum([0] + [len(x) for x in got])[:-1].tolist()
    held = defaultdict(list)
    for r in packing.packed_report(packed).collect():
        held[r.sequence_id].append((r.offset, r.length))
    sizes = []
    for places in held.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0] + [n for _, n in places])[:-1].tolist()
        sizes.append(sum(n for _, n in places))
    assert all(x <= 1024 and x & (x - 1) == 0 for x in sizes)
    assert sum(x < 1024 for x in sizes) <= 10
    stored = {r.sequence_id: (r.n_tokens, len(r.ids)) for r in packing.sequences(packed).collect()}
    assert sorted(stored.values()) == sorted((x, 4 * x) for x in sizes)
    assert packing.pack(df.limit(0), BYTE_BPE).count() == 0


def test_sequences_are_padded(spark):
    df = spark.createDataFrame([(1, 0, 3, bytearray(b"\1\0\0\0\2\0\0\0"), 5, 1),
                                (2, 0, 1, bytearray(b"\3\0\0\0"), 5, 0)],
                               "doc_id long, start long, doc_tokens long, ids binary, sequence_id long, offset long")
    r = packing.sequences(df, length=4, pad=9).first()
    assert (r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (3, [3, 1, 2, 9])


def test_packing_query_checksums(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    plain = Tokenizer.from_file(BYTE_BPE)
    seen = defaultdict(int)
    for r in QUERIES["op13_open_windows"](spark, sf).collect():
        ids = np.array(plain.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0], "<u4")
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        seen[r.doc_id] += r.length
    assert seen == {i: len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts.items()}
