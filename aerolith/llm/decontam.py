"""Benchmark decontamination by the CGK embedding.

Texts and benchmark items are sequences of words, lower-cased and without
punctuation. The CGK embedding walks a sequence: step t writes the current word
and moves on if bit t of that word's hash is set, so two sequences within few
edits fall into step again and agree in most steps: edit distance becomes Hamming
distance. A table of the index samples ``SAMPLED`` of the walk's steps; its key is
a hash of the words written there. Keys of all walks that begin at any word of an
item (and end inside it) are looked up with the keys of walks from every word of
every document, in several walks and tables. How many are needed follows from the
target recall: the chance that an item with random edits at the largest rate
shares a key is measured for every length of the items, on copies of items of it.

Items of lengths that ``MOST_WALKS`` don't bring to the target, and those of
``STEPS`` words or fewer, whose walks could begin at one word alone, are looked up
by pieces: an item of which k words may be edited is cut in k + 1 pieces, and one
of them stands unedited in any match, so no match is missed.

Walks from neighbouring words meet and stay together, so a chunk's walks are kept
as the distinct places they have reached, and keys are summed backwards from the
last step: the cost a word falls with every step.

Every candidate is verified by exact edit distance (bit-parallel, over the whole
item against the item-sized window around the place, overlapping windows joined; a
chunk's windows go through the recurrence together): a document contains an item if
some window is within ``max_edits`` of the item's words.

Benchmark items are taken in blocks of ``BLOCK_ITEMS``; every block meets all
documents. Defined results: null and empty texts, and items without words, match
nothing; items of equal id are tested each and their best match counts; repeated
documents are matched row by row; a match of a document without an id is returned
with a null id; very long texts are handled alone; empty tables give an empty
result; only the id and text columns are read, whatever other columns are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.llm import common as C

#: The part of an item's words that edits may change.
MAX_EDITS = 0.2
TARGET_RECALL = 0.99
#: Steps of a walk and how many of them a table samples.
STEPS, SAMPLED = 12, 5
#: Tables of one walk, and the most walks.
TABLES, MOST_WALKS = 2, 6
#: Copies of items of one length that the recall is measured on, at least.
COPIES = 400
#: Words of the copies walked at once.
LOT_WORDS = 100_000
#: Places of pieces, and words of candidates' windows, handled at once.
PLACES, WINDOW_WORDS = 100_000, 1_000_000
#: Words of an item whose edit distance is computed in one machine word.
WORD_BITS = 64
BLOCK_ITEMS = 10_000

_U = np.uint64


def tokens_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words without case and punctuation, and texts' offsets."""
    s, e, w = C.words(buf, offs, C.PUNCTUATION)
    return C.range_hash(buf, s, e, lower=True), w


def steps_for(length: int) -> int:
    """The steps of the walks from an item: a walk of so many ends inside it."""
    return min(STEPS, length)


def _samples(walk: int, table: int, steps: int) -> np.ndarray:
    rng = np.random.Generator(np.random.Philox(1000 * walk + 10 * table + 7))
    # The first and last steps and others between them.
    inner = rng.permutation(max(steps - 2, 0))[:max(min(SAMPLED, steps) - 2, 0)] + 1
    return np.unique(np.concatenate([[0, steps - 1], inner])).astype(np.int64)


class Walks:
    """One embedding of all suffixes of a token sequence, as coalescing walks."""

    def __init__(self, tokens: np.ndarray, walk: int, steps: int):
        self.walk = walk
        with np.errstate(over="ignore"):
            coins = C.mix(tokens * C.constants(41 + walk, 1)[0])
        coins = np.append(coins, _U(0))  # a walk stays at the sequence's end
        self.tokens = np.append(tokens, _U(0))
        place = np.arange(len(tokens), dtype=np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for t in range(steps):
            after = place + ((coins[place] >> _U(t)) & _U(1)).astype(np.int64)
            new = np.ones(len(after), bool)
            new[1:] = after[1:] != after[:-1]
            self.levels.append((place, np.cumsum(new) - 1))
            place = after[new]
        self.last = len(place)

    def keys(self, table: int, steps: int) -> np.ndarray:
        """The table's key of the walk from each token."""
        chosen = set(_samples(self.walk, table, steps).tolist())
        c = C.constants(60 + 97 * self.walk + table, STEPS)
        size = len(self.levels[steps][0]) if steps < len(self.levels) else self.last
        value = np.zeros(size, _U)
        with np.errstate(over="ignore"):
            for t in range(steps - 1, -1, -1):
                place, to = self.levels[t]
                value = value[to]
                if t in chosen:
                    value = value + self.tokens[place] * c[t]
            return C.mix(value + _U(steps))


def edit_masks(item: np.ndarray) -> dict[int, int]:
    """For each word of an item, the places where it stands, as bits."""
    masks: dict[int, int] = {}
    for i, t in enumerate(item.tolist()):
        masks[t] = masks.get(t, 0) | 1 << i
    return masks


def best_match(masks: dict[int, int], length: int, window: list[int]) -> tuple[int, int]:
    """The least edit distance of the item to any run of ``window`` and where
    such a run ends, by the bit-parallel column recurrence."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    vp, vn, score = full, 0, length
    best, end = length, 0
    for j, t in enumerate(window):
        x = masks.get(t, 0) | vn
        d0 = ((((x & vp) + vp) ^ vp) | x) & full
        hn, hp = vp & d0, (vn | ~(vp | d0)) & full
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1 & full, hn << 1 & full
        vp, vn = (hn | ~(d0 | hp)) & full, hp & d0
        if score < best:
            best, end = score, j + 1
    return best, end


def _edited(item: np.ndarray, rate: float, rng: np.random.Generator) -> np.ndarray:
    """A copy of an item with so many random edits of its words."""
    out = item.tolist()
    for _ in range(int(rate * len(item))):
        at, kind = int(rng.integers(len(out))), int(rng.integers(3))
        fresh = int(rng.integers(1, 1 << 63))
        if kind == 0:
            out[at] = fresh
        elif kind == 1:
            out.insert(at, fresh)
        elif len(out) > 1:
            del out[at]
    return np.array(out, _U)


def _first_walks(items: list[np.ndarray], rate: float, rng: np.random.Generator) -> np.ndarray:
    """For each item the first walk in which a copy of it with random edits shares a
    key with it; ``MOST_WALKS`` if none does. All copies are walked at once."""
    pad = lambda: rng.integers(1, 1 << 63, 2 * STEPS).astype(_U)
    lengths = np.array([len(x) for x in items])
    found = np.full(len(items), MOST_WALKS)
    sides = [[np.concatenate([pad(), y, pad()]) for y in ys]
             for ys in (items, [_edited(x, rate, rng) for x in items])]
    tokens = [np.concatenate(x) for x in sides]
    owner = [np.repeat(np.arange(len(items)), [len(y) for y in x]) for x in sides]
    place = np.concatenate([np.arange(len(y)) for y in sides[0]]) - 2 * STEPS
    inside = (place >= 0) & (place <= lengths[owner[0]] - STEPS)
    for walk in range(MOST_WALKS):
        # Only what earlier walks missed is walked again.
        left = [found[o] == MOST_WALKS for o in owner]
        tokens, owner = ([x[k] for x, k in zip(y, left)] for y in (tokens, owner))
        inside = inside[left[0]]
        both = [Walks(x, walk, STEPS) for x in tokens]
        for table in range(TABLES):
            # The copy's number in a key: only its own text can give it.
            mine, its = (C.mix(w.keys(table, STEPS) ^ C.mix(o.astype(_U) + _U(1)))
                         for w, o in zip(both, owner))
            hit = owner[0][inside & np.isin(mine, its)]
            found[hit] = np.minimum(found[hit], walk)
    return found


def _walks_of_length(items: list[np.ndarray], rate: float, recall: float) -> int:
    """Walks that bring items of one length to the recall, on ``COPIES`` copies of
    them in lots of about ``LOT_WORDS`` words; more than ``MOST_WALKS`` if none do."""
    rng = np.random.Generator(np.random.Philox(77 + len(items[0])))
    tests = (items * COPIES)[:max(COPIES, min(len(items), 2 * COPIES))]
    lot = max(1, LOT_WORDS // (len(items[0]) + 4 * STEPS))
    first = np.concatenate([_first_walks(tests[at:at + lot], rate, rng)
                            for at in range(0, len(tests), lot)])
    for walks in range(1, MOST_WALKS + 1):
        if (first < walks).mean() >= recall:
            return walks
    return MOST_WALKS + 1


def walks_needed(spark: SparkSession, items: list[np.ndarray], rate: float, recall: float,
                 ) -> tuple[int, set[int]]:
    """Walks that bring all lengths to the recall, or ``MOST_WALKS``, and the lengths
    that are looked up by pieces. The trial of a length is a row of a Spark job, so
    the driver's part does not grow with the lengths."""
    by: dict[int, list[list[int]]] = {}
    for x in items:
        if len(x) > STEPS:
            by.setdefault(len(x), []).append(C.signed(x).tolist())
    short = {len(x) for x in items if 0 < len(x) <= STEPS}
    if not by:
        return 1, short

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("n").to_pylist()
            needed = [_walks_of_length([np.array(x, np.int64).view(_U) for x in own], rate, recall)
                      for own in batch.column("items").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lengths, pa.int32()), pa.array(needed, pa.int32())], names=["n", "walks"])

    rows = spark.createDataFrame([(n, own[:2 * COPIES]) for n, own in sorted(by.items())],
                                 "n int, items array<array<long>>")
    found = rows.repartition(min(len(by), spark.sparkContext.defaultParallelism * 4)) \
        .mapInArrow(run, "n int, walks int").collect()
    missed = {r.n for r in found if r.walks > MOST_WALKS}
    return max((r.walks for r in found if r.walks <= MOST_WALKS), default=1), short | missed


def pieces_of(length: int, edits: int) -> list[tuple[int, int]]:
    """An item's pieces, one more than its words that may be edited."""
    cut = [length * k // (edits + 1) for k in range(edits + 2)]
    return list(zip(cut, cut[1:]))


class Index:
    """The keys of a block of items: per walk, steps and table, sorted keys with
    the item and the word they begin at, behind a table of the keys' top bits. Items
    of the lengths ``pieces`` are there by their pieces, by the pieces' lengths."""

    BITS = 18

    def __init__(self, ids: list, items: list[np.ndarray], max_edits: float, walks: int,
                 pieces: set[int]):
        self.ids, self.lengths = ids, [len(x) for x in items]
        self.masks = [edit_masks(x) for x in items]
        self.edits = [math.floor(max_edits * len(x) + 1e-9) for x in items]
        self.items = items
        self.walks = walks
        # The items' words, and for each item of a machine word and word of it the
        # places where it stands, as bits, under item * words + word.
        self.words = np.unique(np.concatenate([*items, np.zeros(0, _U)]))
        pairs = [(k, t, m) for k, masks in enumerate(self.masks) if len(items[k]) <= WORD_BITS
                 for t, m in masks.items()]
        at = np.array([k for k, _, _ in pairs], np.int64) * len(self.words) + np.searchsorted(
            self.words, np.array([t for _, t, _ in pairs], _U))
        order = np.argsort(at)
        self.pairs = at[order]
        self.bits = np.array([m for _, _, m in pairs], _U)[order]
        self.steps = sorted({steps_for(n) for n in self.lengths if n and n not in pieces})
        found: dict[tuple, list] = {}
        for k, item in enumerate(items):
            if not len(item):
                continue
            if len(item) in pieces:
                for a, b in pieces_of(len(item), self.edits[k]):
                    found.setdefault((b - a,), []).append(
                        (C.window_hashes(item[a:b], b - a), np.array([k]), np.array([a])))
                continue
            steps = steps_for(len(item))
            starts = np.arange(len(item) - steps + 1)
            for walk in range(walks):
                w = Walks(item, walk, steps)
                for table in range(TABLES):
                    found.setdefault((walk, steps, table), []).append(
                        (w.keys(table, steps)[starts], np.full(len(starts), k), starts))
        self.tables = {}
        for at, parts in found.items():
            keys, item, start = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(keys, kind="stable")
            top = np.zeros(1 << self.BITS, bool)
            top[(keys >> _U(64 - self.BITS)).astype(np.int64)] = True
            self.tables[at] = (keys[order], item[order], start[order], top)

    def candidates(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and the words where they may begin (in the chunk's words)."""
        items, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for walk in range(self.walks if self.steps else 0):
            w = Walks(tokens, walk, max(self.steps))
            for steps in self.steps:
                for table in range(TABLES):
                    item, place = self._hits(self.tables[walk, steps, table], w.keys(table, steps))
                    items.append(item)
                    places.append(place)
        for size, in (at for at in self.tables if len(at) == 1):
            item, place = self._hits(self.tables[size,], C.window_hashes(tokens, size))
            item, place = self._likely(item, place, tokens)
            items.append(item)
            places.append(place)
        # One number a pair; a place may lie before the first word.
        margin = max(self.lengths, default=0)
        size = len(tokens) + 2 * margin
        pair = np.unique(np.concatenate(items) * size + np.concatenate(places) + margin)
        return pair // size, pair % size - margin

    @classmethod
    def _hits(cls, table: tuple, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items with one of the keys, and where they would begin."""
        keys, item, start, top = table
        at = np.flatnonzero(top[(mine >> _U(64 - cls.BITS)).astype(np.int64)])
        lo = np.searchsorted(keys, mine[at], "left")
        n = np.searchsorted(keys, mine[at], "right") - lo
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        hit = np.repeat(lo, n) + k
        return item[hit], np.repeat(at, n) - start[hit]

    def _likely(self, item: np.ndarray, place: np.ndarray, tokens: np.ndarray,
                ) -> tuple[np.ndarray, np.ndarray]:
        """Those places around which all but the edited words of the item stand
        (short pieces are common): no match fails this."""
        order = np.argsort(item, kind="stable")
        item, place = item[order], place[order]
        kept = np.zeros(len(item), bool)
        cuts = np.append(np.flatnonzero(np.diff(item, prepend=-1)), len(item))
        for a, b in zip(cuts, cuts[1:]):
            k = int(item[a])
            length, allowed = self.lengths[k], self.edits[k]
            around = np.arange(-allowed, length + allowed)
            for c in range(a, b, PLACES // len(around) + 1):
                d = min(b, c + PLACES // len(around) + 1)
                at = place[c:d, None] + around
                there = np.isin(tokens[np.clip(at, 0, len(tokens) - 1)], self.items[k])
                there &= (at >= 0) & (at < len(tokens))
                kept[c:d] = there.sum(1) >= length - allowed
        return item[kept], place[kept]

    def _windows(self, item: np.ndarray, place: np.ndarray, w: np.ndarray, known: np.ndarray,
                 ) -> tuple[np.ndarray, ...]:
        """The item-sized windows around candidates, cut at the texts' borders, with
        overlapping ones of a text and item joined: text, item, first and end word.
        Windows with too few words that stand in any item are left out."""
        lengths, edits = np.array(self.lengths), np.array(self.edits)
        lo, hi = place - edits[item], place + lengths[item] + edits[item]
        # The place may lie before the text of the walk that gave it: every text
        # that the window meets is tried.
        first = np.maximum(np.searchsorted(w, np.maximum(lo, 0), "right") - 1, 0)
        n = np.maximum(np.searchsorted(w[:-1], hi, "left") - first, 0)
        row = np.repeat(np.arange(len(item)), n)
        text = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        item, a, b = item[row], np.maximum(lo[row], w[text]), np.minimum(hi[row], w[text + 1])
        least = lengths[item] - edits[item]
        ok = (b - a >= least) & (known[np.maximum(b, 0)] - known[np.maximum(a, 0)] >= least)
        text, item, a, b = text[ok], item[ok], a[ok], b[ok]
        order = np.lexsort((b, a, item, text))
        text, item, a, b = text[order], item[order], a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (a[1:] > b[:-1])
        heads = np.flatnonzero(new)
        return text[heads], item[heads], a[heads], b[np.append(heads[1:], len(a)) - 1] \
            if len(heads) else b

    def _distances(self, item: np.ndarray, a: np.ndarray, b: np.ndarray, codes: np.ndarray,
                   ) -> tuple[np.ndarray, np.ndarray]:
        """The least edit distance of each item to any run of its window and where
        such a run ends: ``best_match`` for many windows at once, a column a step.
        Windows with too few of the item's words have the item's length."""
        lengths, edits = np.array(self.lengths)[item], np.array(self.edits)[item]
        best, end = lengths.copy(), np.zeros(len(item), np.int64)
        size = b - a
        starts = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(a - starts, size)
        key = np.repeat(item, size) * len(self.words) + codes[at]
        slot = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        here = (codes[at] >= 0) & (self.pairs[slot] == key)
        eq = np.where(here, self.bits[slot], _U(0))
        total = C.before(here)
        # All but the edited words of the item stand in the window.
        live = np.flatnonzero(total[starts + size] - total[starts] >= lengths - edits)
        live = live[np.argsort(-size[live], kind="stable")]
        if not len(live):
            return best, end
        one = _U(1)
        top = one << (lengths[live] - 1).astype(_U)
        full = top | (top - one)
        vp, vn, score = full.copy(), np.zeros(len(live), _U), lengths[live].copy()
        low, stop = score.copy(), np.zeros(len(live), np.int64)
        sizes, first = size[live], starts[live]
        with np.errstate(over="ignore"):
            for j in range(int(sizes[0])):
                m = int(np.searchsorted(-sizes, -j, "left"))  # windows longer than j
                p, t, f = vp[:m], top[:m], full[:m]
                x = eq[first[:m] + j] | vn[:m]
                d0 = ((((x & p) + p) ^ p) | x) & f
                hn, hp = p & d0, (vn[:m] | ~(p | d0)) & f
                score[:m] += (hp & t != 0).astype(np.int64) - (hn & t != 0)
                hp, hn = hp << one & f, hn << one & f
                vp[:m], vn[:m] = (hn | ~(d0 | hp)) & f, hp & d0
                less = score[:m] < low[:m]
                low[:m][less], stop[:m][less] = score[:m][less], j + 1
        best[live], end[live] = low, stop
        return best, end

    def matches(self, tokens: np.ndarray, w: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """``(text, item, distance, first word, end word)`` of the items that the
        texts contain, each at its best place."""
        item, place = self.candidates(tokens)
        if not len(item):
            return []
        codes = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        codes = np.where(self.words[codes] == tokens, codes, -1)
        text, item, a, b = self._windows(item, place, w, C.before(codes >= 0))
        distance, end = np.array(self.lengths)[item], np.zeros(len(item), np.int64)
        short = np.flatnonzero(distance <= WORD_BITS)
        lots = np.cumsum((b - a)[short]) // WINDOW_WORDS
        for lot in np.split(short, np.flatnonzero(np.diff(lots)) + 1):
            if len(lot):
                distance[lot], end[lot] = self._distances(item[lot], a[lot], b[lot], codes)
        for k in np.flatnonzero(np.array(self.lengths)[item] > WORD_BITS).tolist():
            masks, window = self.masks[item[k]], tokens[a[k]:b[k]].tolist()
            length = self.lengths[item[k]]
            if sum(map(masks.__contains__, window)) >= length - self.edits[item[k]]:
                distance[k], end[k] = best_match(masks, length, window)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for k in np.flatnonzero(distance <= np.array(self.edits)[item]).tolist():
            at, length = int(a[k] + end[k] - w[text[k]]), self.lengths[item[k]]
            new = (int(distance[k]), max(at - length, 0), at)
            mine = (int(text[k]), int(item[k]))
            best[mine] = min(best.get(mine, new), new)
        return [(t, k, *v) for (t, k), v in best.items()]


def _blocks(items: DataFrame, item_id: str, item_text: str, max_edits: float, recall: float,
            ) -> Iterator[tuple[Index, int]]:
    """The indexes of the blocks of items, and how many there are. Items of one
    id are in one block."""
    items = items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text"))
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        rows.sort(key=lambda r: (r.item is None, r.item or 0, r.text or ""))
        buf, offs = C.text_bytes(pa.array([r.text for r in rows], pa.string()))
        tokens, w = tokens_of(buf, offs)
        parts = [tokens[a:b] for a, b in zip(w, w[1:])]
        yield Index([r.item for r in rows], parts, max_edits,
                    *walks_needed(items.sparkSession, parts, max_edits, recall)), blocks


def cleaned(docs: DataFrame, items: DataFrame, text_col: str = "text",
            item_id: str = "item_id", item_text: str = "text", max_edits: float = MAX_EDITS,
            recall: float = TARGET_RECALL) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    C.small_batches(docs.sparkSession)
    for index, blocks in _blocks(items, item_id, item_text, max_edits, recall):
        renamed, schema = C.carried(docs, text_col)
        kept = C.restored(renamed.mapInArrow(_keeper(index, schema), schema), docs)
        docs = C.stored(kept, "clean") if blocks > 1 else kept
    return docs


def _keeper(index: Index, schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in C.chunks(batches, "_text"):
            tokens, w = tokens_of(buf, offs)
            clean = np.ones(len(offs) - 1, bool)
            clean[[m[0] for m in index.matches(tokens, w)]] = False
            yield from rows.select(schema.names).filter(pa.array(clean)).to_batches()

    return run


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                 max_edits: float = MAX_EDITS, recall: float = TARGET_RECALL) -> DataFrame:
    """One row per document row and item it contains: both ids, ``distance`` (edits in
    words), ``n_words`` of the item, ``first_word`` and ``end_word`` (about
    where, in the document's words without punctuation)."""
    C.small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    found = None
    for index, blocks in _blocks(items, item_id, item_text, max_edits, recall):
        part = _search(texts, index)
        if blocks > 1:
            part = C.stored(part, "matches")
        found = part if found is None else found.union(part)
    return found.select(F.col("_id").alias(id_col), F.col("item").alias(item_id), "distance",
                        "n_words", "first_word", "end_word")


def _search(texts: DataFrame, index: Index) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in C.chunks(batches, "_text"):
            tokens, w = tokens_of(buf, offs)
            best: dict[tuple, tuple] = {}
            for text, k, *place in index.matches(tokens, w):
                at = (text, index.ids[k])
                value = (place[0], index.lengths[k], *place[1:])
                best[at] = min(best.get(at, value), value)
            ids = rows.column("_id").combine_chunks()
            cols = [list(c) for c in zip(*((t, i, *v) for (t, i), v in best.items()))] or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(cols[0], pa.int64())),
                 *(pa.array(c, pa.int64()) for c in cols[1:])],
                names=["_id", "item", "distance", "n_words", "first_word", "end_word"])

    return texts.mapInArrow(run, "_id long, item long, distance long, n_words long, "
                                 "first_word long, end_word long")
