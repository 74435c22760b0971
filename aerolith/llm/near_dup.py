"""Near-duplicate documents by MinHash bands and odd sketches.

A document is the set of its distinct shingles (runs of ``shingle`` words; a
shorter text is one shingle). Per document one pass over the text gives

* the set's fingerprint: documents with equal sets are one *class* and only the
  class's smallest id takes part in the search;
* ``BANDS`` band keys of ``ROWS`` MinHash values each: two sets of similarity
  0.8 share none with a probability of 5e-8;
* an odd sketch: each of ``SAMPLES`` MinHash values toggles one of ``SKETCH``
  bits, so the population count of two sketches' XOR estimates the samples'
  symmetric difference, most precisely at high similarity.

Candidates come from band buckets without making the pairs of a bucket: in each
round every bucket links its members to one member drawn by a hash of the round,
unless they are in the same component already. When rounds of this leave few
buckets with members of two components, every pair across components in
those buckets is compared once, in the first band it shares, blocks of members
against blocks, by sketch. Every candidate whose sketches allow the threshold
(with a margin of four standard deviations) is verified on the full sets; blocks carry
their members' sets, so they give links alone, at most one fewer than they have members,
whatever number of pairs their sketches leave. So a link is only
ever left out where its two ends are in one component anyway.

Defined results: null and empty texts and those without words have an empty set,
linked with nothing (their component is their own id); rows of equal id count as
one document; a row without an id is returned with null component and kept.
Very long texts are handled alone; an empty table gives an empty result; only
the id and text columns are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm import common as C
from aerolith.llm.graph import components

BANDS, ROWS = 32, 4
SAMPLES, SKETCH = 512, 4096
#: Most rounds of linking buckets to one member before blocks are compared; a
#: round that adds less than this share of the links is the last one.
ROUNDS, GAIN = 4, 1 / 16
#: Members of a bucket, and shingles of theirs, that make one block.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Subtracted from the threshold before a sketch estimate may rule a pair out.
MARGIN = 0.07

_U = np.uint64


def shingle_sets(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' distinct shingle hashes, ascending in each text, and offsets."""
    tokens, w = C.word_hashes(buf, offs, lower=True)
    n_words = np.diff(w)
    hashes = C.window_hashes(tokens, size)
    text = C.owner(w)
    inside = text[:len(hashes)] == text[size - 1:] if len(hashes) else np.zeros(0, bool)
    owner, hashes = text[:len(hashes)][inside], hashes[inside]
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        extra = np.array([C.window_hashes(tokens[w[i]:w[i + 1]], int(n_words[i]))[0]
                          for i in short], _U)
        owner, hashes = np.concatenate([owner, short]), np.concatenate([hashes, extra])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    owner, hashes = owner[new], hashes[new]
    return hashes, np.searchsorted(owner, np.arange(len(offs)))


def _features(hashes: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints, band keys and odd sketches of the sets (none empty)."""
    mult = C.constants(21, SAMPLES).astype(np.uint32) | np.uint32(1)
    at = offs[:-1]
    short = C.mix(hashes).astype(np.uint32)
    with np.errstate(over="ignore"):
        print_ = np.stack([np.add.reduceat(C.mix(hashes + _U(s)), at) for s in (1, 2)], 1)
        print_ += np.diff(offs).astype(_U)[:, None]
        low = np.empty((len(at), SAMPLES), np.uint32)
        # A product with an odd constant reorders the 32-bit hashes.
        for j in range(SAMPLES):
            low[:, j] = np.minimum.reduceat(short * mult[j], at)
        rows = low[:, :BANDS * ROWS].reshape(len(at), BANDS, ROWS).astype(_U)
        bands = C.mix((C.mix(rows) * C.constants(22, ROWS)).sum(2, dtype=_U))
    odd = np.zeros((len(at), SKETCH), np.uint8)
    every = np.arange(len(at))
    for j in range(SAMPLES):
        # Sample j's value toggles a bit that depends on j and the value.
        with np.errstate(over="ignore"):
            bit = C.mix(low[:, j].astype(_U) * _U(SAMPLES) + _U(j)) % _U(SKETCH)
        odd[every, bit] ^= 1
    return print_, bands, np.packbits(odd, axis=1).view(_U)


def estimate(differing: np.ndarray) -> np.ndarray:
    """The similarity that ``differing`` unequal bits of two sketches tell."""
    z = np.minimum(differing / SKETCH, 0.4999)
    return 1 + SKETCH / (4 * SAMPLES) * np.log(1 - 2 * z)


def most_differing(threshold: float) -> int:
    """The largest number of unequal bits that doesn't rule a pair out."""
    bits = np.arange(SKETCH + 1)
    return int(bits[estimate(bits) >= threshold - MARGIN].max())


def _profiles(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in C.chunks(batches, "_text"):
            hashes, s = shingle_sets(buf, offs, size)
            n = np.diff(s)
            full = np.flatnonzero(n > 0)
            prints = np.zeros((len(n), 2), _U)
            bands = odd = np.zeros((0, 1), _U)
            if len(full):
                at = np.append(s[:-1][full], s[-1])
                prints[full], bands, odd = _features(hashes, at)
            some = (n > 0).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                rows.column("_id").combine_chunks(), pa.array(n, pa.int64()),
                pa.array(C.signed(prints[:, 0]), mask=n == 0),
                pa.array(C.signed(prints[:, 1]), mask=n == 0),
                C.lists(C.signed(bands).ravel(), some * BANDS, pa.int64()),
                C.lists(C.signed(odd).ravel(), some * (SKETCH // 64), pa.int64())],
                names=["_id", "n_shingles", "p1", "p2", "bands", "odd"])

    return docs.mapInArrow(run, "_id long, n_shingles long, p1 long, p2 long, "
                                "bands array<long>, odd array<long>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in C.chunks(batches, "_text"):
            hashes, s = shingle_sets(buf, offs, size)
            yield pa.RecordBatch.from_arrays([
                rows.column("_id").combine_chunks(),
                C.lists(C.signed(hashes), np.diff(s), pa.int64())], names=["_id", "shingles"])

    return docs.mapInArrow(run, "_id long, shingles array<long>")


def _of(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows whose ``_id`` is in the stored pairs."""
    ends = [pairs.select(F.col(c).alias("_id")).distinct() for c in ("a", "b")]
    return rows.join(C.few(C.stored(ends[0].union(ends[1]).distinct(), "ends")),
                     "_id", "left_semi")


def _near(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose sketches and set sizes don't rule the threshold out."""
    own = _of(reps, pairs)
    side = lambda x: own.select(F.col("_id").alias(x), F.col("n_shingles").alias(f"n{x}"),
                                F.col("odd").alias(f"o{x}"))
    differing = F.aggregate(F.zip_with("oa", "ob", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                            F.lit(0), lambda s, x: s + x)
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter((differing <= most_differing(threshold))
                    & (F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb")))
            .select("a", "b"))


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The stored pairs that have the similarity on their full sets."""
    sets = C.stored(_sets(_of(docs, pairs), size).dropDuplicates(["_id"]), "sets")
    side = lambda x: sets.select(F.col("_id").alias(x), F.col("shingles").alias(f"s{x}"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(100 * both >= percent * (F.size("sa") + F.size("sb") - both))
            .select("a", "b"))


def _block_links(cells: DataFrame, reps: DataFrame, docs: DataFrame, size: int,
                 percent: int) -> DataFrame:
    """Links across components in buckets, blocks of members against blocks, as
    many as their components need to meet. A pair that shares several buckets is
    compared in its first band alone."""
    threshold = percent / 100
    most = most_differing(threshold)
    mixed = (cells.groupBy("band", "key")
             .agg(F.min("label").alias("x"), F.max("label").alias("y"),
                  F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES))
                  .cast("int").alias("blocks"))
             .filter("x <> y").drop("x", "y"))
    own = F.pmod(F.xxhash64("_id", "band"), F.col("blocks")).cast("int")
    dealt = C.stored(
        cells.join(mixed, ["band", "key"]).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("band", "key", F.least("own", "other").alias("i"),
                F.greatest("own", "other").alias("j"), "own", "_id", "label"), "blocks")
    some = C.few(C.stored(dealt.select("_id").distinct(), "members"))
    sets = _sets(docs.join(some, "_id", "left_semi"), size) \
        .filter(F.size("shingles") > 0).dropDuplicates(["_id"])
    wide = C.stored(reps.drop("n_shingles").join(some, "_id", "left_semi").join(sets, "_id"),
                    "members")

    def run(keys: tuple, group: pa.Table) -> pa.Table:
        band, i, j = keys[0].as_py(), keys[2].as_py(), keys[3].as_py()
        own, ids, label = (group.column(c).to_numpy() for c in ("own", "_id", "label"))
        matrix = lambda c: np.stack(group.column(c).to_numpy()).view(_U)
        odd, before = matrix("odd"), matrix("bands")[:, :band]
        sets = group.column("shingles").to_numpy()
        n = np.array([len(s) for s in sets])
        code = np.unique(np.concatenate(sets), return_inverse=True)[1]
        sets = np.split(code, np.cumsum(n)[:-1])
        mark = np.zeros(len(code) + 1, bool)
        label = label.copy()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        found: list[tuple[int, int]] = []
        for x in left:
            to = right if i != j else right[right > x]
            to = to[label[to] != label[x]]
            to = to[np.minimum(n[to], n[x]) >= threshold * np.maximum(n[to], n[x])]
            to = to[~(before[to] == before[x]).any(1)]
            to = to[np.bitwise_count(odd[to] ^ odd[x]).sum(1, dtype=np.int64) <= most]
            if not len(to):
                continue
            mark[sets[x]] = True
            hits = mark[np.concatenate([sets[y] for y in to])]
            both = np.add.reduceat(hits, np.cumsum(n[to]) - n[to], dtype=np.int64)
            mark[sets[x]] = False
            # What carries one label is in one component: one link does for it.
            for y in to[100 * both >= percent * (n[x] + n[to] - both)]:
                if label[y] != label[x]:
                    found.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                    label[label == label[y]] = label[x]
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return (dealt.join(wide, "_id").groupBy("band", "key", "i", "j")
            .applyInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: the id, ``n_shingles``, ``component_id`` (the
    smallest id reachable over links of at least ``percent`` similarity) and
    ``kept`` (whether that is the row's own id)."""
    spark = docs.sparkSession
    C.small_batches(spark)
    threshold = percent / 100
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    known = texts.filter("_id is not null")
    profile = C.stored(_profiles(texts, shingle), "profiles")
    classes = C.stored(profile.filter("p1 is not null and _id is not null").groupBy("p1", "p2")
                       .agg(F.min("_id").alias("rep")), "classes")
    reps = C.stored(profile.filter("p1 is not null")
                    .join(classes.select("p1", "p2", F.col("rep").alias("_id")),
                          ["p1", "p2", "_id"], "left_semi")
                    .dropDuplicates(["p1", "p2"]).select("_id", "n_shingles", "bands", "odd"),
                    "reps")
    cells = reps.select("_id", "n_shingles", F.posexplode("bands").alias("band", "key"))
    shared = cells.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    cells = C.stored(cells.join(shared, ["band", "key"], "left_semi"), "cells")
    links, labels, n_links = None, None, 0
    for turn in range(ROUNDS):
        now = cells
        if labels is not None:
            now = cells.join(labels.withColumnRenamed("node", "_id"), "_id", "left")
            now = now.withColumn("label", F.coalesce("component", "_id")).drop("component")
        else:
            now = now.withColumn("label", F.col("_id"))
        chosen = now.groupBy("band", "key").agg(
            F.min(F.struct(F.xxhash64("_id", F.lit(turn)), "_id", "label")).alias("to"))
        pairs = (now.join(chosen, ["band", "key"]).filter("label <> to.label")
                 .select(F.least("_id", "to._id").alias("a"), F.greatest("_id", "to._id").alias("b"))
                 .distinct())
        near = C.stored(_near(C.stored(pairs, "pairs"), reps, threshold), "pairs")
        found = _verified(near, known, shingle, percent)
        links = C.stored(found if links is None else links.union(found), "links")
        labels = components(links)
        had, n_links = n_links, links.count()
        if n_links - had <= GAIN * n_links:
            break
    now = cells.join(labels.withColumnRenamed("node", "_id"), "_id", "left").select(
        "_id", "n_shingles", "band", "key", F.coalesce("component", "_id").alias("label"))
    links = links.union(C.stored(_block_links(now, reps, known, shingle, percent), "links"))
    # Equal sets, and rows of one id, are links as well.
    same = profile.join(classes, ["p1", "p2"]).select(F.col("_id").alias("a"),
                                                     F.col("rep").alias("b"))
    label = components(links.union(same)).select(F.col("node").alias("_id"), "component")
    component = F.coalesce("component", "_id")
    return (profile.select("_id", "n_shingles").join(label, "_id", "left")
            .select(F.col("_id").alias(id_col), "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept")))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept, one row of each id, with all their
    columns; rows without an id stay."""
    found = C.stored(near_duplicates(docs, id_col, text_col, shingle, percent), "components")
    gone = found.filter("not kept").select(id_col).distinct()
    left = docs.join(C.few(gone), id_col, "left_anti").select(docs.columns)
    twice = found.filter("kept").groupBy(id_col).count() \
        .filter((F.col("count") > 1) & F.col(id_col).isNotNull()).select(id_col)
    if twice.isEmpty():
        return left
    again = left.join(twice, id_col, "left_semi").dropDuplicates([id_col])
    return left.join(twice, id_col, "left_anti").select(docs.columns).union(
        again.select(docs.columns))
