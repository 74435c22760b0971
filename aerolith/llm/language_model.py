"""Language-model scores: unigram base and a gated recurrent model (``gru``).

Words are white-space words, A-Z lower-cased. The documents whose crc32 of the
id's text leaves ``HELD_OUT`` modulo ``FOLDS`` are held out; all others are
counted, whole, in one grouped sum. The most frequent words are the network's own
vocabulary; all others share ``TAIL`` ids by their last two bytes, and such a
word's probability is its tail id's by the network times its share of the tail
id's counts (one added, for words never seen). So the score is a probability of
the whole text, in the closed form the base has.

The network is trained on all counted documents, each once: a hash of id and words
deals them to rounds and workers. In a round workers take truncated-backpropagation
passes over their texts from the same weights, and the weights are averaged by words,
slice by slice in two steps, so that no task and not the driver gathers more than some
workers' slices. A worker has about ``EACH`` words a round. Copies of a row are dealt
apart, and a worker's texts are ordered by their hashes, so the network depends on the
rows alone, not on how they lie in files. Documents are scored whole, the state carried
across windows.

The ``MID`` most frequent words' counts go to the tasks as two arrays (a fixed
bound); the rarer words of each document meet the counts in a join.

Defined results: null and empty texts are the end alone; a null id counts as the
empty text in the hold-out rule; repeated rows count and score each; very long
texts are handled alone; without counted documents N and V are 0 and the network
is its start; an empty table gives an empty result; only the id and text columns
are read, whatever other columns are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm import common as C, gru

FOLDS, HELD_OUT = 7, 2
#: Ids that words outside the vocabulary share, by their last two bytes.
TAIL = 127
END = gru.VOCABULARY - 1
HEAD = gru.VOCABULARY - 1 - TAIL
#: Words whose counts are sent to the tasks (16 bytes each).
MID = 1 << 19
#: Rounds, a worker's words a round, and the workers that smaller inputs are dealt
#: to as long as each has ``LEAST`` words.
ROUNDS, EACH, WORKERS, LEAST = 4, 4 << 20, 6, 1 << 16
#: Parts that the weights are averaged in, and workers averaged at once.
SLICES, TOGETHER = 64, 64
RATE = 0.02
#: Words scored side by side in a task.
BUFFER = 4 << 20

_U = np.uint64


def held_out(id_col) -> F.Column:
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT


def words_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and tail number of each word, and the texts' offsets."""
    s, e, w = C.words(buf, offs)
    low = buf.copy()
    low[(buf >= 65) & (buf <= 90)] += 32
    last = low[e - 1].astype(np.int64) if len(e) else np.zeros(0, np.int64)
    before = np.where(e - s > 1, low[np.maximum(e - 2, 0)] if len(e) else 0, 0).astype(np.int64)
    return C.range_hash(low, s, e), (last * 257 + before) * 31 % 8191 % TAIL, w


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, tail, n)`` over all documents given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            word = np.concatenate([h for h, _ in held])
            tail = np.concatenate([t for _, t in held])
            held.clear()
            word, first, n = np.unique(word, return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(C.signed(word)), pa.array(tail[first], pa.int16()),
                 pa.array(n, pa.int64())], names=["word", "tail", "n"])

        size = 0
        for _, buf, offs in C.chunks(batches, "_text"):
            h, t, _ = words_of(buf, offs)
            held.append((h, t))
            size += len(h)
            if size > 1 << 20:
                yield flush()
                size = 0
        if held:
            yield flush()

    return (docs.select("_text").mapInArrow(run, "word long, tail short, n long")
            .groupBy("word").agg(F.first("tail").alias("tail"), F.sum("n").alias("n")))


class Lexicon:
    """The frequent words' ranks and counts, in a hash table."""

    def __init__(self, word: np.ndarray, n: np.ndarray):
        """``word`` (hashes) and ``n`` (counts) in order of frequency."""
        self.word, self.n = pd.Index(C.signed(word)), np.append(n, 0)

    def find(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's rank and count, or -1 and 0."""
        rank = self.word.get_indexer(pd.Index(C.signed(word)))
        return rank, self.n[rank]


def _frequent(counts: DataFrame) -> pa.Table:
    """At most ``MID`` words, the most frequent first: all from some count on,
    which follows from how many words have which counts."""
    size = F.when(F.col("n") < 64, F.col("n")) \
        .otherwise(64 + F.floor(8 * F.log2(F.col("n") / 64))).cast("int")
    by_size = {r.size: r.words for r in counts.groupBy(size.alias("size"))
               .agg(F.count("*").alias("words")).collect()}
    least, held = 1 << 30, 0
    for s in sorted(by_size, reverse=True):
        held += by_size[s]
        if held > MID:
            break
        least = s
    return counts.filter(size >= least).toArrow() \
        .sort_by([("n", "descending"), ("word", "ascending")])


def word_ids(rank: np.ndarray, tail: np.ndarray) -> np.ndarray:
    return np.where((rank >= 0) & (rank < HEAD), rank, HEAD + tail)


def _dealt(texts: DataFrame, words: int) -> tuple[DataFrame, int]:
    """The counted texts' word ids by ``(turn, worker)``, and the workers."""
    workers = max(1, min(WORKERS, words // (ROUNDS * LEAST)), -(-words // (ROUNDS * EACH)))
    key = F.xxhash64("_id", "ids", "copy")
    rows = (texts.filter("not held_out").groupBy("_id", "ids").agg(F.count("*").alias("n"))
            .select("_id", "ids", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
            .select("ids", key.alias("key"), F.pmod(key, F.lit(workers * ROUNDS)).alias("slot"))
            .select("ids", "key", (F.col("slot") % ROUNDS).cast("int").alias("turn"),
                    F.floor(F.col("slot") / ROUNDS).cast("int").alias("worker"))
            .sortWithinPartitions("turn"))
    return C.stored(rows, "dealt"), workers


def _pass(params: gru.Params, rate: float):
    """A worker's pass over its texts, from the given weights: ``(worker, slice,
    n, weights)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gru.keep_memory()
        worker = TaskContext.get().partitionId()
        texts = sorted((key, ids) for batch in batches for key, ids in zip(
            batch.column("key").to_pylist(), batch.column("ids").to_pylist()))
        end = np.array([END], np.int16).tobytes()
        whole = np.frombuffer(b"".join(x for _, ids in texts for x in (ids, end)), np.int16)
        del texts
        new, n = gru.train(params, whole, END, rate)
        if n:
            flat = np.concatenate([new[k].ravel() for k in sorted(new)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([worker] * SLICES, pa.int32()), pa.array(range(SLICES), pa.int32()),
                 pa.array([n] * SLICES, pa.int64()),
                 pa.array([x.tobytes() for x in np.array_split(flat, SLICES)], pa.binary())],
                names=["worker", "slice", "n", "weights"])

    return run


def _mean(keys: tuple, group: pa.Table) -> pa.Table:
    """A slice's weights averaged by the words they were trained on."""
    group = group.sort_by("worker")
    n = group.column("n").to_numpy()
    mean = sum(np.frombuffer(w.as_py(), np.float32) * (k / n.sum())
               for w, k in zip(group.column("weights"), n))
    return pa.table({"worker": pa.array([keys[1].as_py() if len(keys) > 1 else 0], pa.int32()),
                     "slice": pa.array([keys[0].as_py()], pa.int32()),
                     "n": pa.array([n.sum()], pa.int64()),
                     "weights": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})


def _round(dealt: DataFrame, workers: int, params: gru.Params, turn: int) -> tuple[gru.Params, int]:
    """A round over its share of the texts: the averaged weights and the words passed."""
    kind = "worker int, slice int, n long, weights binary"
    rows = dealt.filter(F.col("turn") == turn).repartitionById(workers, F.col("worker")) \
        .select("key", "ids").mapInArrow(_pass(params, RATE * (1 - turn / ROUNDS)), kind)
    group = F.floor(F.col("worker") / TOGETHER).cast("int")
    some = rows.groupBy("slice", group.alias("some")).applyInArrow(_mean, kind)
    found = sorted(some.groupBy("slice").applyInArrow(_mean, kind).collect(), key=lambda r: r.slice)
    if not found:
        return params, 0
    mean = np.concatenate([np.frombuffer(r.weights, np.float32) for r in found])
    at, new = 0, {}
    for k in sorted(params):
        new[k] = mean[at:at + params[k].size].reshape(params[k].shape)
        at += params[k].size
    return new, found[0].n


def _train(texts: DataFrame, words: int) -> gru.Params:
    dealt, workers = _dealt(texts, words)
    params = gru.start()
    for turn in range(ROUNDS):
        params, _ = _round(dealt, workers, params, turn)
    return params


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (both log10)."""
    spark = docs.sparkSession
    C.small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")) \
        .withColumn("held_out", held_out(F.col("_id")))
    counts = C.stored(word_counts(texts.filter("not held_out")), "counts")
    ends = texts.filter("not held_out").count()
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = (total.n or 0) + ends, total.v + (ends > 0)
    top = _frequent(counts)
    lexicon = Lexicon(top.column("word").to_numpy().view(_U), top.column("n").to_numpy())
    # What the words outside the network's vocabulary hold, by tail number.
    sums = {r.tail: (r.n, r.v) for r in counts.groupBy("tail").agg(
        F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    room = np.ones(TAIL)
    for t, (tn, tv) in sums.items():
        room[t] += tn + tv
    head = top.slice(0, HEAD)
    np.subtract.at(room, head.column("tail").to_numpy(), head.column("n").to_numpy() + 1)
    unit = math.log10(n + v + 1)
    end_base = math.log10(ends + 1) - unit
    log_room = np.log10(room)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 33
        for rows, buf, offs in C.chunks(batches, "_text"):
            h, tail, w = words_of(buf, offs)
            rank, c = lexicon.find(h)
            sums = lambda x: np.diff(np.append(0.0, np.cumsum(x))[w])
            found = rank >= 0
            log_c = np.log10(c + 1.0)
            base = sums(log_c - unit) + end_base
            # A tail word's share; a rare word's count follows from the join.
            outside = ~found | (rank >= HEAD)
            extra = sums(np.where(outside, log_c - log_room[tail], 0.0))
            known = np.diff(C.before(found)[w]) + (ends > 0)
            ids = word_ids(rank, tail).astype(np.int16)
            uid = made + np.arange(len(w) - 1)
            made += len(uid)
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid), rows.column("_id").combine_chunks(),
                 rows.column("held_out").combine_chunks(), pa.array(np.diff(w) + 1),
                 pa.array(known), pa.array(base), pa.array(extra),
                 C.lists(C.signed(h[~found]), np.diff(C.before(~found)[w]), pa.int64()),
                 pa.array([ids[x:y].tobytes() for x, y in zip(w[:-1], w[1:])], pa.binary())],
                names=["uid", "_id", "held_out", "n_tokens", "n_known", "base", "extra", "rare",
                       "ids"])

    part = C.stored(texts.mapInArrow(
        encode, "uid long, _id long, held_out boolean, n_tokens long, n_known long, base double, "
                "extra double, rare array<long>, ids binary"), "encoded")
    params = _train(part, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gru.keep_memory()
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            texts = rows.column("ids").to_pylist()
            offs = np.append(0, np.cumsum([len(x) // 2 for x in texts]))
            net = gru.score(params, np.frombuffer(b"".join(texts), np.int16), offs, END)
            net = net / math.log(10) + rows.column("extra").to_numpy()
            rows = rows.drop_columns(["ids", "extra"]).append_column("net", pa.array(net))
            return rows.to_batches()[0]

        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.column("ids").nbytes // 2
            if size > BUFFER:
                yield flush()
                size = 0
        if sum(len(b) for b in held):
            yield flush()

    scored = part.drop("rare").mapInArrow(
        run, "uid long, _id long, held_out boolean, n_tokens long, n_known long, base double, "
             "net double")
    rare = part.select("uid", F.explode("rare").alias("word")).groupBy("uid", "word") \
        .agg(F.count("*").alias("times"))
    late = (rare.join(counts.select("word", "n"), "word")
            .groupBy("uid").agg(F.sum("times").alias("more"),
                                F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log_c")))
    log_c = F.coalesce("log_c", F.lit(0.0))
    return scored.join(late, "uid", "left").select(
        F.col("_id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + log_c).alias("base_score"),
        (F.col("net") + log_c).alias("score"))
