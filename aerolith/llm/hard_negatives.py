"""Hard negatives by best-first search in a packed R-tree.

Vectors become integers (``floor(scale * x)``), so inner products are exact. The
index is built by sort-tile-recursive packing: rows are range-partitioned by label,
first coordinate and id (ids part equal vectors, so no key is too hot), and each
task sorts its rows of a label into slabs along one coordinate after the other,
widest first, until a leaf's size is reached; leaves in a row are packed into nodes,
up to one root. A task writes one file with its leaves and the minimum bounding
boxes of all its nodes; a small table holds the files' root boxes, one row per
``SHARD_ROWS`` rows.

A box bounds a query's inner product between the sums, coordinate by coordinate, of
the smaller and of the larger of ``q * low`` and ``q * high``. Anchors are searched
in blocks, each in one task, first for their positives (same label, highest scores),
then, per anchor and distinct positive score, for the highest scores of other labels
inside that score's window. A queue holds the files, and inside a file its nodes,
by the best score that they can hold for any search of the block. A box is skipped
by a search if it holds no fitting label, if its interval misses the window, or if
its bound is strictly below the search's k-th result (a tie with it only counts if
the box has a smaller id). One file is open at a time, so a task's memory follows
the block and the file, not the index. The result is exact.

Defined results: rows with a null id, label or vector, or with any null or
non-finite component, take no part; nor do rows with a scaled component of
2**26 and more, whose scores would not fit a long. A shorter vector is taken as
filled up with zeros. Rows that repeat an id with its label and vector count once;
an anchor is never its own positive or negative, nor is another row with its id.
Ties go to the smaller id. An empty table gives no rows; only the named columns are
read, whatever other columns are called.
"""

from __future__ import annotations

import heapq
import io
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import common as C
from aerolith.llm.line_dedup import file_system, read_file, write_file

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Window of a negative's score in percent of its positive's.
LOW, HIGH = 30, 90
#: Rows of a leaf, nodes packed into one, rows of a file, anchors of a block.
LEAF, FAN, SHARD_ROWS, BLOCK = 256, 16, 1 << 16, 1024
#: Anchors that are worth a task of their own while executors are idle.
LEAST = 64
LIMIT = 1 << 26

_NONE = np.iinfo(np.int64).min
_LAST = np.iinfo(np.int64).max


def taking_part(rows: DataFrame, id_col: str, vec_col: str, label_col: str,
                scale: int = SCALE) -> DataFrame:
    """``id``, ``label`` (as text) and the scaled ``vec`` of the rows that take part."""
    fits = lambda x: (x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) * scale < F.lit(float(LIMIT))))
    out = rows.select(F.col(id_col).cast("long").alias("id"),
                      F.col(label_col).cast("string").alias("label"),
                      F.col(vec_col).cast("array<double>").alias("vec"))
    whole = out.where(F.col("id").isNotNull() & F.col("label").isNotNull()
                      & F.col("vec").isNotNull() & F.forall("vec", fits))
    return whole.withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("int")))


def _by_place(rows: DataFrame, tasks: int) -> DataFrame:
    """Range-partitioned by label, first coordinate and id."""
    return rows.repartitionByRange(tasks, "label", F.get("vec", F.lit(0)), "id")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of an Arrow list column, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, lens = column.flatten().to_numpy(), column.value_lengths().to_numpy().astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    out[np.repeat(np.arange(len(lens)), lens), at] = flat
    return out


def _tiles(rows: np.ndarray, order: np.ndarray, leaf: int) -> Iterator[np.ndarray]:
    """Sort-tile-recursive packing of ``rows[order]``: runs of about ``leaf``."""
    pages = -(-len(order) // leaf)
    if pages <= 1:
        yield order
        return
    widest = np.argsort(-np.ptp(rows[order], axis=0), kind="stable")
    yield from _slabs(rows, order, widest.tolist(), leaf)


def _slabs(rows: np.ndarray, order: np.ndarray, axes: list[int], leaf: int,
           ) -> Iterator[np.ndarray]:
    pages = -(-len(order) // leaf)
    if pages <= 1 or not axes:
        for at in range(0, len(order), leaf):
            yield order[at:at + leaf]
        return
    slabs = max(2, int(np.ceil(pages ** (1 / len(axes)))))
    size = leaf * -(-pages // slabs)
    order = order[np.argsort(rows[order, axes[0]], kind="stable")]
    for at in range(0, len(order), size):
        yield from _slabs(rows, order[at:at + size], axes[1:], leaf)


@dataclass
class Nodes:
    """Boxes of one level: children ``start`` to ``end`` of the level below (rows
    for leaves), coordinate bounds, smallest and largest label code, smallest id."""

    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    last: np.ndarray
    least: np.ndarray

    FIELDS = ("start", "end", "low", "high", "first", "last", "least")


def _over(ends: np.ndarray, low, high, first, last, least) -> Nodes:
    """Nodes over runs of children that end at ``ends``."""
    starts = np.append(0, ends[:-1])
    at = lambda f, x: f.reduceat(x, starts, axis=0)
    return Nodes(starts, ends, at(np.minimum, low), at(np.maximum, high),
                 at(np.minimum, first), at(np.maximum, last), at(np.minimum, least))


class Shard:
    """The rows and the tree of one file."""

    def __init__(self, labels: list[str], ids, codes, vectors, levels: list[Nodes]):
        self.labels, self.ids, self.codes, self.vectors = labels, ids, codes, vectors
        self.levels = levels  # leaves first, the root last

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray,
              leaf: int = LEAF, fan: int = FAN) -> Shard:
        names, codes = np.unique(labels, return_inverse=True)
        sizes = np.bincount(codes)
        # Rows of a label that fills a leaf are tiled alone, rarer labels together.
        kind = np.where(sizes[codes] >= leaf, codes, -1)
        by = np.lexsort((ids, kind))
        runs = np.split(by, np.flatnonzero(np.diff(kind[by])) + 1)
        tiles = [t for run in runs for t in _tiles(vectors, run, leaf)]
        order = np.concatenate(tiles)
        ids, codes, vectors = ids[order], codes[order].astype(np.int32), vectors[order]
        ends = np.cumsum([len(t) for t in tiles])
        levels = [_over(ends, vectors, vectors, codes, codes, ids)]
        while len(levels[-1].start) > 1:
            x = levels[-1]
            n = len(x.start)
            ends = np.append(np.arange(fan, n, fan), n)
            levels.append(_over(ends, x.low, x.high, x.first, x.last, x.least))
        return cls(names.tolist(), ids, codes, vectors, levels)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        arrays = {"labels": np.frombuffer(json.dumps(self.labels).encode(), np.uint8),
                  "ids": self.ids, "codes": self.codes, "vectors": self.vectors.astype(np.int32),
                  "levels": np.array(len(self.levels))}
        for k, level in enumerate(self.levels):
            for f in Nodes.FIELDS:
                x = getattr(level, f)
                arrays[f"{f}{k}"] = x.astype(np.int32) if f in ("low", "high") else x
        np.savez(out, **arrays)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        with np.load(io.BytesIO(data)) as z:
            levels = [Nodes(*(z[f"{f}{k}"] for f in Nodes.FIELDS)) for k in range(int(z["levels"]))]
            labels = json.loads(z["labels"].tobytes())
            return cls(labels, z["ids"], z["codes"], z["vectors"], levels)


def _distinct(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """One of the equal rows each."""
    _, codes = np.unique(labels, return_inverse=True)
    same = np.lexsort((codes, ids))
    again = np.append(False, (np.diff(ids[same]) == 0) & (np.diff(codes[same]) == 0))
    if not again.any():
        return same
    same = np.lexsort((*vectors.T, codes, ids))
    whole = np.column_stack([vectors, codes, ids])[same]
    return same[np.append(True, (whole[1:] != whole[:-1]).any(axis=1))]


def build_index(rows: DataFrame, path: str, leaf: int = LEAF, fan: int = FAN,
                shard_rows: int = SHARD_ROWS) -> tuple[int, int]:
    """Write the index of ``rows`` (as ``taking_part`` gives them) under ``path``.
    Returns the number of rows read and the vectors' width."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("w")).first()
    count, width = int(size["n"]), int(size["w"] or 0)
    if not count:
        return 0, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        t = pa.Table.from_batches(table)
        ids = t.column("id").to_numpy()
        labels = np.array(t.column("label").to_pylist(), object)
        vectors = _matrix(t.column("vec"), width)
        # Equal rows are in one task, as it holds all rows of their key.
        keep = _distinct(ids, labels, vectors)
        shard = Shard.build(ids[keep], labels[keep], vectors[keep], leaf, fan)
        name = f"shard-{TaskContext.get().partitionId():06d}"
        write_file(f"{path}/shards/{name}", shard.to_bytes())
        root = shard.levels[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([root.low[0].tolist()], pa.list_(pa.int64())),
             pa.array([root.high[0].tolist()], pa.list_(pa.int64())), pa.array([shard.labels[0]]),
             pa.array([shard.labels[-1]]), pa.array([int(root.least[0])], pa.int64())],
            names=["file", "low", "high", "first", "last", "least"])

    dealt = _by_place(rows, -(-count // shard_rows))
    dealt.mapInArrow(run, "file string, low array<long>, high array<long>, first string, "
                          "last string, least long").write.parquet(f"{path}/roots")
    return count, width


def _roots(path: str) -> list[dict]:
    store, at = file_system(f"{path}/roots")
    return pq.read_table(at, filesystem=store).to_pylist()


class Search:
    """Searches that run together: each has a vector (of anchor ``of``), a label
    to keep to or away from, a score window, and its best ``k`` so far."""

    def __init__(self, queries: np.ndarray, anchor_ids: np.ndarray, labels: np.ndarray,
                 of: np.ndarray, same: bool, k: int, low: np.ndarray, high: np.ndarray):
        self.q, self.of, self.same, self.k = queries, of, same, k
        self.plus, self.minus = np.maximum(queries, 0), np.minimum(queries, 0)
        self.anchor_ids, self.labels = anchor_ids, labels
        self.low, self.high = low, high
        self.scores = np.full((len(of), k), _NONE)
        self.ids = np.full((len(of), k), _LAST)

    def _wants(self, low: np.ndarray, high: np.ndarray, least: np.ndarray, label_ok: np.ndarray,
               ) -> tuple[np.ndarray, np.ndarray]:
        """For boxes (rows) and searches (columns): whether the search needs the
        box, and the best score it can have there."""
        top = (high @ self.plus.T + low @ self.minus.T).astype(np.int64)[:, self.of]
        bottom = (low @ self.plus.T + high @ self.minus.T).astype(np.int64)[:, self.of]
        best = np.minimum(top, self.high)
        kth, kid = self.scores[:, -1], self.ids[:, -1]
        need = label_ok & (top >= self.low) & (bottom <= self.high) \
            & ((best > kth) | ((best == kth) & (least[:, None] < kid)))
        return need, best

    def _labels_ok(self, first: np.ndarray, last: np.ndarray, mine: np.ndarray) -> np.ndarray:
        """Whether boxes hold labels that a search takes. ``mine`` are the
        searches' labels in the order that ``first`` and ``last`` are in."""
        first, last = first[:, None], last[:, None]
        if self.same:
            return (first <= mine) & (mine <= last)
        return (first != last) | (first != mine)

    def run(self, path: str, roots: list[dict]) -> None:
        if not len(self.of):
            return
        kind = self.q.dtype
        low = np.array([r["low"] for r in roots], kind)
        high = np.array([r["high"] for r in roots], kind)
        least = np.array([r["least"] for r in roots])
        first = np.array([r["first"] for r in roots], object)
        last = np.array([r["last"] for r in roots], object)
        names = np.unique(np.concatenate([self.labels, first, last]))
        first, last, mine = (np.searchsorted(names, x) for x in (first, last, self.labels))
        queue: list[tuple[int, int]] = []

        def wants(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
            ok = self._labels_ok(first[a:b], last[a:b], mine[self.of])
            return self._wants(low[a:b], high[a:b], least[a:b], ok)

        for at in range(0, len(roots), FAN):
            need, best = wants(at, at + FAN)
            for j in np.flatnonzero(need.any(axis=1)).tolist():
                queue.append((-int(best[j][need[j]].max()), at + j))
        heapq.heapify(queue)
        while queue:
            _, k = heapq.heappop(queue)
            if wants(k, k + 1)[0].any():
                self._file(Shard.from_bytes(read_file(f"{path}/shards/{roots[k]['file']}")))

    def _file(self, shard: Shard) -> None:
        kind = self.q.dtype
        for level in shard.levels:
            level.low, level.high = level.low.astype(kind), level.high.astype(kind)
        names = np.array(shard.labels, object)
        at = np.minimum(np.searchsorted(names, self.labels), len(names) - 1)
        mine = np.where(names[at] == self.labels, at, -1)[self.of]
        queue: list[tuple[int, int, int]] = []

        def push(up: int, a: int, b: int) -> None:
            x = shard.levels[up]
            ok = self._labels_ok(x.first[a:b], x.last[a:b], mine)
            need, best = self._wants(x.low[a:b], x.high[a:b], x.least[a:b], ok)
            for j in np.flatnonzero(need.any(axis=1)).tolist():
                heapq.heappush(queue, (-int(best[j][need[j]].max()), up, a + j))

        push(len(shard.levels) - 1, 0, 1)
        while queue:
            _, up, j = heapq.heappop(queue)
            x = shard.levels[up]
            a, b = int(x.start[j]), int(x.end[j])
            if up:
                push(up - 1, a, b)
                continue
            one = slice(j, j + 1)
            ok = self._labels_ok(x.first[one], x.last[one], mine)
            need = np.flatnonzero(self._wants(x.low[one], x.high[one], x.least[one], ok)[0][0])
            if len(need):
                self._leaf(need, shard.vectors[a:b].astype(kind), shard.ids[a:b],
                           shard.codes[a:b], mine[need])

    def _leaf(self, need: np.ndarray, vectors: np.ndarray, ids: np.ndarray, codes: np.ndarray,
              mine: np.ndarray) -> None:
        anchors, back = np.unique(self.of[need], return_inverse=True)
        scores = (self.q[anchors] @ vectors.T).astype(np.int64)[back]
        kth, kid = self.scores[need, -1][:, None], self.ids[need, -1][:, None]
        take = (scores >= np.maximum(self.low[need][:, None], kth)) \
            & (scores <= self.high[need][:, None])
        row, col = np.nonzero(take)
        score, found = scores[row, col], ids[col]
        label = codes[col] == mine[row]
        ok = ((score > kth[row, 0]) | (found < kid[row, 0])) \
            & (found != self.anchor_ids[self.of[need]][row]) & (label if self.same else ~label)
        row, score, found = need[row[ok]], score[ok], found[ok]
        if not len(row):
            return
        hit = np.unique(row)
        row = np.concatenate([row, np.repeat(hit, self.k)])
        score = np.concatenate([score, self.scores[hit].ravel()])
        found = np.concatenate([found, self.ids[hit].ravel()])
        order = np.lexsort((found, ~score, row))
        row, score, found = row[order], score[order], found[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < self.k
        self.scores[row[best], place[best]] = score[best]
        self.ids[row[best], place[best]] = found[best]


_OUT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
        "negative_score long")


def _searched(path: str, width: int, positives: int, negatives: int, low: int,
              high: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def block(roots: list[dict], t: pa.Table) -> pa.RecordBatch:
        ids = t.column("id").to_numpy()
        labels = np.array(t.column("label").to_pylist(), object)
        q = _matrix(t.column("vec"), width)
        most = max(max(map(abs, r["low"] + r["high"]), default=0) for r in roots)
        # Sums below 2**53 are exact in doubles, whose products are faster.
        if most * max(int(np.abs(q).max(initial=0)), 1) * max(width, 1) < 1 << 53:
            q = q.astype(np.float64)
        n = len(ids)
        first = Search(q, ids, labels, np.arange(n), True, positives, np.full(n, _NONE + 1),
                       np.full(n, _LAST))
        first.run(path, roots)
        of, place = np.nonzero(first.ids != _LAST)
        score, positive = first.scores[of, place], first.ids[of, place]
        # One search per anchor and distinct positive score.
        by = np.stack([of, score], axis=1)
        windows, search = np.unique(by, axis=0, return_inverse=True)
        search = search.reshape(-1)
        least, most = -(-low * windows[:, 1] // 100), high * windows[:, 1] // 100
        second = Search(q, ids, labels, windows[:, 0], False, negatives, least, most)
        second.run(path, roots)
        found = second.ids[search] != _LAST
        row, rank = np.nonzero(found)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[of[row]]), pa.array(positive[row]), pa.array(rank + 1, pa.int32()),
             pa.array(second.ids[search[row], rank]), pa.array(score[row]),
             pa.array(second.scores[search[row], rank])],
            names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                   "negative_score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = None
        for batch in batches:
            if batch.num_rows:
                roots = roots or _roots(path)
                for at in range(0, batch.num_rows, BLOCK):
                    yield block(roots, pa.Table.from_batches([batch.slice(at, BLOCK)]))
    return run


def mine(spark: SparkSession, rows: DataFrame, anchors: Column, id_col: str = "vec_id",
         vec_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, leaf: int = LEAF, fan: int = FAN,
         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For each row that the predicate ``anchors`` (over ``id_col``) picks and each
    of its first ``positives`` rows of the same label: the first ``negatives`` rows
    of other labels with a score from ``low`` to ``high`` percent of the
    positive's. Columns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score`` and ``negative_score``."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK))
    path = C.work_dir(spark, "rtree")
    count, width = build_index(taking_part(rows, id_col, vec_col, label_col, scale), path,
                               leaf, fan, shard_rows)
    if not count:
        return spark.createDataFrame([], _OUT)
    picked = C.stored(taking_part(rows.where(anchors), id_col, vec_col, label_col, scale)
                      .dropDuplicates(["id", "label", "vec"]), "anchors")
    n = picked.count()
    tasks = max(-(-n // BLOCK), min(spark.sparkContext.defaultParallelism, -(-n // LEAST)), 1)
    return _by_place(picked, tasks).mapInArrow(
        _searched(path, width, positives, negatives, low, high), _OUT)
