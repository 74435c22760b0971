"""Passages that repeat across documents, by compact windows.

A document is the sequence of its shingles (``SHINGLE`` words, A-Z lower-cased).
For each of ``HASHES`` hash functions, the Cartesian tree over a document's
shingle hashes groups all its runs of at least ``least`` shingles by the place of
their smallest hash: the compact window (l, c, r) stands for every run within
l..r that holds c. Only the minima of sliding windows of ``least`` shingles can be
such a place, so the tree is built over these alone (about 2 in ``least``).

Windows of different documents with the same smallest hash share signatures. A
common run of ``least`` shingles reaches at least half as far from that place on
one of its sides, so windows are grouped by the shingle there or the one half-way
as well, for either side: a short line that many documents hold makes no group. One
of these four groups is enough; a changed word, which alters ``SHINGLE`` shingles
in a row, cannot be in both of a side's. So two passages of 50 words that differ in
one word are candidates unless no hash has its smallest value in what they share, at
most 1 in 100 of them (1 / 5 for each hash: 10 of 51 shingles are in one alone). Each group is linked to its smallest document, window against window at the same
shingle, never pair by pair. Per pair of documents an interval join finds the
stretches that windows of any hash cover on about one diagonal, and each stretch
is verified on both documents' full shingles: it
counts where of every ``least`` shingles in a row 8/9 are in the other stretch
(for runs of one length, a similarity of 0.8).

The smallest document need not be the one that a member shares a passage with. The
groups in which it did not verify some member are split further, all their windows
at once: every run of ``least`` shingles in them is grouped by all its words, one
document stands for each such group, and these runs are grouped by all their words
but one (first by all but ``MASK`` in a row, which drops most). All runs of such a
group are alike, so linking them to its smallest document leaves nothing for
another pass, whatever other documents hold.

Defined results: null and empty texts and texts under ``min_words`` words have no
passages; rows without an id take no part; rows of equal id are one document (a
repeated row gives the same passages once); very long texts are handled alone;
an empty table gives an empty result; only the id and text columns are read,
whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm import common as C

SHINGLE, MIN_WORDS = 5, 50
HASHES = 3
#: Shingles by which a stretch's diagonals may differ.
SLACK = 16
#: Words in a row that are left out of a run's first keys.
MASK = 10
#: Runs whose words are handled at once.
RUNS = 20_000
#: Stretches cut out of one document row at a time.
REQUESTS = 500
#: Shingles of stretches that a task gives on, or compares, at once.
VALUES = 1 << 18

_U = np.uint64
_PLACE = _U(0xFFFFFF)


def shingles(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes at all places of a chunk, whether each lies inside one
    text, and the texts' offsets in the words."""
    tokens, w = C.word_hashes(buf, offs, lower=True)
    hashes = C.window_hashes(tokens, SHINGLE)
    text = C.owner(w)
    inside = text[:len(hashes)] == text[SHINGLE - 1:] if len(hashes) else np.zeros(0, bool)
    return hashes, inside, w


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` values in a row, by blocks' running minima."""
    n = len(x)
    if n < size:
        return x[:0]
    blocks = -(-n // size)
    padded = np.full(blocks * size, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    grid = padded.reshape(blocks, size)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - size + 1], ahead[size - 1:n])


def compact_windows(order: np.ndarray, wall: np.ndarray, least: int,
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(l, c, r)`` of all compact windows of ``least`` places and more.

    ``order`` ranks the places (no two alike), ``wall`` flags places that no
    window may hold."""
    n = len(order)
    key = np.where(wall, _U(0), order)
    low = sliding_min(key, least)
    low = np.unique(low[low > 0])
    if not len(low):
        none = np.zeros(0, np.int64)
        return none, none, none
    c = np.sort((low & _PLACE).astype(np.int64))
    edge = np.flatnonzero(wall & ~(np.append(wall[1:], True) & np.append(True, wall[:-1])))
    at = np.sort(np.concatenate([c, edge]))
    # The Cartesian tree's stack: a place's parents are its nearest smaller ones.
    left, right = [-1] * len(at), [n] * len(at)
    places, values = at.tolist(), key[at].tolist()
    stack: list[int] = []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = places[i]
        if stack:
            left[i] = places[stack[-1]]
        if v:
            stack.append(i)
        else:
            stack = [i]
    l, r = np.array(left) + 1, np.array(right) - 1
    ok = (key[at] > 0) & (r - l + 1 >= least)
    return l[ok], at[ok], r[ok]


def windows(docs: DataFrame, least: int) -> DataFrame:
    """``(key, _id, l, c, r, lead, k0, k1, k2, k3)`` of all documents' compact
    windows: ``key`` is the smallest hash, the others are that with a shingle of a
    side, null where no run reaches on there; a bit of ``lead`` tells for each side
    whether the window is the first of its document with this key; places are the
    document's shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in C.chunks(batches, "_text"):
            hashes, inside, w = shingles(buf, offs)
            place = np.arange(len(hashes)).astype(_U)
            for j in range(HASHES):
                with np.errstate(over="ignore"):
                    value = C.mix(hashes + C.constants(81, HASHES)[j])
                # Equal shingles rank by place; the rank's low bits tell it.
                order = (value & ~_PLACE) | place
                l, c, r = compact_windows(order, ~inside, least)
                text = np.searchsorted(w, c, "right") - 1
                half = least // 2
                fore, back = c + half <= r, c - half >= l
                sides, lead = [], np.zeros(len(c), np.int8)
                for k, (salt, d, there) in enumerate(zip(
                        C.constants(82, 4), (half, -half, half // 2, -(half // 2)), (fore, back) * 2)):
                    far = hashes[np.where(there, c + d, c)]
                    with np.errstate(over="ignore"):
                        key = C.mix(value[c] + far * salt)
                        own = np.where(there, key + text.astype(_U) * C.constants(85, 1)[0], place[c])
                    lead[np.unique(own, return_index=True)[1]] |= 1 << k
                    sides.append(pa.array(C.signed(key), mask=~there))
                ids = rows.column("_id").combine_chunks().take(pa.array(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(C.signed(value[c])), ids,
                     *(pa.array(x - w[text], pa.int32()) for x in (l, c, r)), pa.array(lead), *sides],
                    names=["key", "_id", "l", "c", "r", "lead", "k0", "k1", "k2", "k3"])

    return docs.mapInArrow(run, "key long, _id long, l int, c int, r int, lead byte, "
                                "k0 long, k1 long, k2 long, k3 long")


def _shared(rows: DataFrame, *more: Column) -> DataFrame:
    """The stored rows whose key rows of another document have too, with the key's
    smallest and largest document ``a`` and ``b`` and the aggregates ``more``.

    The keys are written before they are joined, so the join has a stage of its
    own and its skewed partitions can be split between tasks."""
    keys = C.stored(rows.groupBy("key").agg(F.min("_id").alias("a"), F.max("_id").alias("b"), *more)
                    .filter("a < b"), "keys")
    shared = C.stored(rows.join(keys.hint("shuffle_hash"), "key"), "shared")
    C.dropped(keys)
    return shared


def _merged(links: DataFrame, least: int) -> DataFrame:
    """The links ``(_id, to, off, lo, hi)``, those of a diagonal that hold the same
    multiple of ``least`` as one: each is as long and holds one at least."""
    return links.groupBy("_id", "to", "off", F.ceil(F.col("lo") / least).alias("grid")).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("grid")


def _stretches(links: DataFrame, least: int) -> DataFrame:
    """Interval join per pair of documents: what merged links cover where their
    diagonals follow each other within ``SLACK``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("links")
            if not len(column):
                continue
            row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
            off, lo, hi = (column.flatten().field(c).to_numpy().astype(np.int64)
                           for c in ("off", "lo", "hi"))
            order = np.lexsort((off, row))
            row, off, lo, hi = row[order], off[order], lo[order], hi[order]
            new = np.append(True, (np.diff(row) > 0) | (np.diff(off) > SLACK))
            chain, first = np.cumsum(new) - 1, np.flatnonzero(new)
            last = np.append(first[1:], len(off)) - 1
            # Each chain's places are moved beyond those of the one before.
            moved = chain * (int(hi.max()) + 2)
            order = np.lexsort((lo, chain))
            lo, reach = (lo + moved)[order], np.maximum.accumulate((hi + moved)[order])
            start = np.flatnonzero(np.append(True, lo[1:] > reach[:-1] + 1))
            end = np.append(start[1:], len(lo)) - 1
            lo, hi, chain = lo[start] - moved[start], reach[end] - moved[start] + 1, chain[start]
            long = hi - lo >= least
            pair, chain = pa.array(row[start[long]]), chain[long]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(pair), batch.column("to").take(pair),
                 *(pa.array(x, pa.int32()) for x in (lo[long], hi[long], off[first[chain]],
                                                     off[last[chain]]))],
                names=["_id", "to", "lo", "hi", "off_lo", "off_hi"])

    return links.groupBy("_id", "to").agg(F.collect_list(F.struct("off", "lo", "hi")).alias("links")) \
        .mapInArrow(run, "_id long, to long, lo int, hi int, off_lo int, off_hi int")


def _slices(docs: DataFrame, stretches: DataFrame) -> DataFrame:
    """``(pid, own, at, part)``: the shingles of each stretch in both its
    documents, cut out in one pass and stored; a document's many stretches are
    dealt to several rows."""
    wanted = stretches.select("pid", F.explode(F.array(
        F.struct(F.col("_id").alias("doc"), F.lit(True).alias("own"), F.col("lo").alias("a"),
                 F.col("hi").alias("b")),
        F.struct(F.col("to").alias("doc"), F.lit(False).alias("own"),
                 F.greatest(F.col("lo") - F.col("off_hi"), F.lit(0)).alias("a"),
                 (F.col("hi") - F.col("off_lo")).alias("b")))).alias("x")).select("pid", "x.*")
    share = wanted.groupBy("doc").agg(F.ceil(F.count("*") / REQUESTS).alias("n"))
    dealt = C.stored(wanted.join(share, "doc")
                     .groupBy("doc", F.pmod(F.xxhash64("pid"), F.col("n")).alias("deal"))
                     .agg(F.collect_list(F.struct("pid", "own", "a", "b")).alias("cuts")), "cuts")
    texts = docs.join(C.few(dealt.select(F.col("doc").alias("_id")).distinct()), "_id", "left_semi") \
        .dropDuplicates(["_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in C.chunks(batches, "_text"):
            hashes, _, w = shingles(buf, offs)
            column = rows.column("cuts").combine_chunks()
            row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
            cuts = column.flatten()
            a, b = (cuts.field(c).to_numpy() + w[row] for c in ("a", "b"))
            n = np.maximum(np.minimum(b, np.maximum(w[row + 1] - SHINGLE + 1, w[row])) - a, 0)
            ends = np.cumsum(n)
            i = 0
            while i < len(n):
                j = max(int(np.searchsorted(ends, ends[i] - n[i] + VALUES, "right")), i + 1)
                part = [hashes[x:x + k] for x, k in zip(a[i:j].tolist(), n[i:j].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*(cuts.field(c).slice(i, j - i) for c in ("pid", "own", "a")),
                     C.lists(C.signed(np.concatenate(part)), n[i:j], pa.int64())],
                    names=["pid", "own", "at", "part"])
                i = j

    slices = C.stored(dealt.withColumnRenamed("doc", "_id").join(texts, "_id")
                      .select("_text", "cuts")
                      .mapInArrow(run, "pid long, own boolean, at int, part array<long>"), "slices", **C.HASHED)
    C.dropped(dealt)
    return slices


def _alike_runs(hits: np.ndarray, row: np.ndarray, least: int,
                ) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs in which of any ``least`` places in a row 8/9
    are hits, within the rows (that stand one after the other)."""
    n = len(hits)
    if n < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    count = C.before(hits)
    good = (9 * (count[least:] - count[:-least]) >= 8 * least) & (row[least - 1:] == row[:n - least + 1])
    step = np.zeros(n + 1, np.int64)
    step[:len(good)] += good
    step[least:] -= good
    flag = np.cumsum(step)[:-1] > 0
    joined = flag[1:] & flag[:-1] & (row[1:] == row[:-1])
    return (np.flatnonzero(flag & ~np.append(False, joined)),
            np.flatnonzero(flag & ~np.append(joined, False)) + 1)


def alike(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Runs of ``a`` in which of any ``least`` places in a row 8/9 are in ``b``."""
    first, end = _alike_runs(np.isin(a, b), np.zeros(len(a), np.int64), least)
    return list(zip(first.tolist(), end.tolist()))


def _verified(docs: DataFrame, stretches: DataFrame, least: int) -> DataFrame:
    """``(_id, to, own, first, end)`` (shingles) of what is alike on both sides, stored."""
    parts = _slices(docs, stretches)
    side = lambda own: parts.filter(F.col("own") == own).select(
        "pid", F.col("at").alias(f"at_{own}".lower()), F.col("part").alias(f"part_{own}".lower()))
    both = stretches.select("pid", "_id", "to").join(side(True), "pid").join(side(False), "pid")

    def compared(rows: pa.RecordBatch) -> pa.RecordBatch:
        """``alike`` of both sides of all rows at once: a place's key holds its row."""
        salt = C.constants(86, 1)[0]
        keys, owner, n = [], [], rows.num_rows
        for c in ("part_true", "part_false"):
            row = np.repeat(np.arange(n), rows.column(c).value_lengths().to_numpy())
            with np.errstate(over="ignore"):
                keys.append(rows.column(c).flatten().to_numpy().view(_U) + row.astype(_U) * salt)
            owner.append(row)
        alone, place = np.unique(np.concatenate(keys), return_inverse=True)
        places = np.split(place, [len(keys[0])])
        there = []
        for x in places:
            has = np.zeros(len(alone), bool)
            has[x] = True
            there.append(has)
        found = [_alike_runs(there[1 - k][places[k]], owner[k], least) for k in (0, 1)]
        of = [owner[k][found[k][0]] for k in (0, 1)]
        out = []
        for k, c in enumerate(("true", "false")):
            ok = np.isin(of[k], of[1 - k])
            row = of[k][ok]
            moved = rows.column(f"at_{c}").to_numpy()[row] - np.searchsorted(owner[k], row)
            take = lambda x: rows.column(x).take(pa.array(row))  # noqa: E731, B023
            out.append([take("_id"), take("to"), pa.array(np.full(len(row), not k)),
                        *(pa.array(x[ok] + moved, pa.int32()) for x in found[k])])
        return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(*out)],
                                          names=["_id", "to", "own", "first", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(sum(batch.column(c).value_lengths().to_numpy().astype(np.int64)
                                 for c in ("part_true", "part_false")))
            i = 0
            while i < batch.num_rows:
                j = max(int(np.searchsorted(ends, (ends[i - 1] if i else 0) + VALUES, "right")), i + 1)
                yield compared(batch.slice(i, j - i))
                i = j

    found = C.stored(both.mapInArrow(run, "_id long, to long, own boolean, first int, end int"),
                     "verified")
    C.dropped(parts)
    return found


def _runs(docs: DataFrame, wanted: DataFrame, width: int, single: bool) -> DataFrame:
    """Keys of the runs of ``width`` words that begin at the shingles ``a..b`` of
    the rows ``(_id, a, b, part)``: ``(key, _id, s, lead, p0, p1, ...)`` by all words,
    whether it is the first of its document, and the keys that leave out ``MASK`` words
    each; or, ``single``, ``(key, _id, s)`` that leave out one word each of the part."""
    names = ["key", "_id", "s"] if single else \
        ["key", "_id", "s", "lead", *(f"p{k}" for k in range(-(-width // MASK)))]
    cuts = wanted.groupBy("_id").agg(F.collect_set(F.struct("a", "b", "part")).alias("cuts"))
    texts = docs.join(C.few(wanted.select("_id").distinct()), "_id", "left_semi") \
        .dropDuplicates(["_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = C.constants(83, width)
        salt = C.constants(84, width)
        for rows, buf, offs in C.chunks(batches, "_text"):
            tokens, w = C.word_hashes(buf, offs, lower=True)
            column = rows.column("cuts").combine_chunks()
            row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
            a, b, part = (column.flatten().field(c).to_numpy().astype(np.int64)
                          for c in ("a", "b", "part"))
            n = b - a + 1
            at = np.repeat(a + w[row] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            row, part = np.repeat(row, n), np.repeat(part, n)
            ok = at + width <= w[row + 1]
            at, row, part = np.unique(np.stack([at[ok], row[ok], part[ok]]), axis=1)
            ids = rows.column("_id").combine_chunks()
            keys: list[np.ndarray] = []
            masked: list[np.ndarray] = []
            for k in range(0, len(at), RUNS):
                i, x, p = at[k:k + RUNS], row[k:k + RUNS], part[k:k + RUNS]
                with np.errstate(over="ignore"):
                    word = tokens[i[:, None] + np.arange(width)] * scale
                    whole = word.sum(1, dtype=_U)
                    if single:
                        out = p[:, None] * MASK + np.arange(MASK)
                        there = out < width
                        out = np.minimum(out, width - 1)
                        key = C.mix(whole[:, None] - np.take_along_axis(word, out, 1)
                                    + salt[out])[there]
                        more = np.repeat(np.arange(len(i)), there.sum(1))
                        i, x = i[more], x[more]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(C.signed(key)), ids.take(pa.array(x)),
                             pa.array(i - w[x], pa.int32())], names=names)
                    else:
                        keys.append(C.mix(whole))
                        block = np.add.reduceat(word, np.arange(0, width, MASK), axis=1)
                        masked.append(C.mix(whole[:, None] - block + salt[:block.shape[1]]))
            if keys:
                key, parts = np.concatenate(keys), np.concatenate(masked)
                lead = np.zeros(len(key), bool)
                with np.errstate(over="ignore"):
                    lead[np.unique(key + row.astype(_U) * scale[0], return_index=True)[1]] = True
                for k in range(0, len(key), RUNS):
                    x = row[k:k + RUNS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(C.signed(key[k:k + RUNS])), ids.take(pa.array(x)),
                         pa.array(at[k:k + RUNS] - w[x], pa.int32()), pa.array(lead[k:k + RUNS]),
                         *(pa.array(C.signed(y)) for y in parts[k:k + RUNS].T)], names=names)

    return cuts.join(texts, "_id").select("_id", "_text", "cuts").mapInArrow(
        run, "key long, _id long, s int" + ("" if single else ", lead boolean")
        + "".join(f", {x} long" for x in names[4:]))


def _to_least(runs: DataFrame, least_run: DataFrame, least: int) -> DataFrame:
    """Links of runs to the smallest document's of the same key, by the rows
    ``(key, to, to_s, b)``, where ``b`` is the largest document."""
    shared = least_run.filter("to < b").select("key", "to", "to_s")
    return runs.join(shared.hint("shuffle_hash"), "key").filter("_id <> to").select(
        "_id", "to", (F.col("s") - F.col("to_s")).alias("off"), F.col("s").alias("lo"),
        (F.col("s") + F.lit(least - 1)).alias("hi"))


def _split(docs: DataFrame, windows: DataFrame, least: int, min_words: int) -> DataFrame:
    """Links of the runs in the windows ``(_id, l, c, r)`` that are alike but for
    one word at most, each to the smallest document with such a run; stored."""
    starts = windows.select(
        "_id", F.greatest("l", F.col("c") - (least - 1)).alias("a"),
        F.least("c", F.col("r") - (least - 1)).alias("b"), F.lit(0).alias("part")).filter("a <= b")
    starts = C.stored(starts.distinct(), "starts")
    runs = C.stored(_runs(docs, starts, min_words, False), "runs", **C.HASHED)
    C.dropped(starts)
    # Equal runs have equal parts.
    parts = runs.columns[4:]
    first = C.stored(runs.groupBy("key").agg(
        F.min("_id").alias("to"), F.max("_id").alias("b"),
        F.min_by("s", F.when(F.col("lead"), F.col("_id"))).alias("to_s"),
        *(F.min(x).alias(x) for x in parts)), "first", **C.HASHED)
    equal = _to_least(runs.select("key", "_id", "s"), first, least)
    masked = first.select(F.col("to").alias("_id"), F.col("to_s").alias("s"),
                          F.posexplode(F.array(*parts)).alias("part", "key"))
    shared = _shared(masked)
    near = C.stored(_runs(docs, shared.select("_id", F.col("s").alias("a"),
                                              F.col("s").alias("b"), "part").distinct(),
                          min_words, True), "near", **C.HASHED)
    alike_runs = _shared(near)
    C.dropped(shared, near)
    near_first = alike_runs.filter("_id = a").groupBy("key", F.col("a").alias("to"), "b") \
        .agg(F.min("s").alias("to_s"))
    links = equal.union(_to_least(alike_runs.select("key", "_id", "s"), near_first, least))
    links = C.stored(_merged(links, least), "links")
    C.dropped(alike_runs, runs, first)
    return links


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_words: int = MIN_WORDS) -> DataFrame:
    """One row per passage of a document that another document repeats: the id,
    ``first_word`` and ``end_word``, and ``class_id``, the smallest document it
    was verified with (the document itself, where others were verified with it)."""
    C.small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")) \
        .filter("_id is not null")
    with C.shuffles_dropped(docs.sparkSession):
        found = _found(texts, min_words)
    doc = F.when(F.col("own"), F.col("_id")).otherwise(F.col("to"))
    return found.select(doc.alias(id_col), F.col("first").alias("first_word"),
                        (F.col("end") + SHINGLE - 1).alias("end_word"),
                        F.col("to").alias("class_id")).distinct()


def _found(texts: DataFrame, min_words: int) -> DataFrame:
    """``(_id, to, own, first, end)`` of all verified passages, stored."""
    least = min_words - SHINGLE + 1
    every = C.stored(windows(texts, least), "windows", **C.HASHED)
    # Windows that share a side's key share the smallest hash: it is tried first.
    alike_hash = _shared(every)
    C.dropped(every)
    side = alike_hash.select("_id", "l", "c", "r", "lead",
                             F.posexplode(F.array("k0", "k1", "k2", "k3")).alias("side", "key")) \
        .filter("key is not null").select(
            "key", "_id", "l", "c", "r", F.expr("shiftright(lead, side) & 1 = 1").alias("lead"))
    # The first window of the smallest document: one row of a key, so its parts agree.
    leads = F.when(F.col("lead"), F.col("_id"))
    left = _shared(side, *(F.min_by(x, leads).alias(f"to_{x}") for x in ("l", "c", "r")))
    C.dropped(alike_hash)
    before = F.least(F.col("c") - F.col("l"), F.col("to_c") - F.col("to_l"))
    after = F.least(F.col("r") - F.col("c"), F.col("to_r") - F.col("to_c"))
    links = (left.filter("_id <> a")
             .select("_id", F.col("a").alias("to"), (F.col("c") - F.col("to_c")).alias("off"),
                     (F.col("c") - before).alias("lo"), (F.col("c") + after).alias("hi"))
             .filter(F.col("hi") - F.col("lo") + 1 >= least))
    links = _merged(links, least)

    def verified(links: DataFrame) -> DataFrame:
        stretches = C.stored(_stretches(links, least)
                             .withColumn("pid", F.monotonically_increasing_id()), "stretches")
        found = _verified(texts, stretches, least)
        C.dropped(stretches)
        return found

    found = verified(links)
    # A group is done if its smallest document verified every member there.
    spans = found.filter("own").groupBy("_id", F.col("to").alias("a")).agg(
        F.collect_set(F.struct("first", "end")).alias("spans"))
    open_keys = left.filter("_id <> a").select("key", "_id", "a", "c").join(spans, ["_id", "a"], "left") \
        .filter(~F.coalesce(F.exists(
            "spans", lambda s: (s["first"] <= F.col("c")) & (F.col("c") < s["end"])),
            F.lit(False))).select("key").distinct()
    open_keys = C.stored(open_keys, "open")
    rest = C.stored(left.join(C.few(open_keys), "key", "left_semi")
                    .select("_id", "l", "c", "r").distinct(), "left")
    C.dropped(left, open_keys)
    if not rest.isEmpty():
        more = _split(texts, rest, least, min_words)
        found = found.union(verified(more))
        C.dropped(more)
    C.dropped(rest)
    return found
