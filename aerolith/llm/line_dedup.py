"""Line dedup with sharded minimal perfect hashes.

A line's key is the line without the white space at its ends, A-Z lower-cased;
keys of ``min_chars`` code points and more count. One pass over the texts gives
each document's distinct key hashes (128 bits); counted per hash (combined before
the shuffle, documents counted once), those found in ``min_docs`` documents are
dealt to shards by hash. Each shard becomes one file in the shared folder: a
minimal perfect hash (levels of bit arrays with rank) that sends a key to its
place in compact arrays of fingerprint, document count and the largest id that
holds the line. Documents then probe the arrays: a task hashes its lines, opens
the shards they fall in (a few at a time, whatever the index's whole size) and
decides each line; lines are never joined, shuffled or broadcast for it.
The 64-bit fingerprint is independent of the hash that places a key, so a line
outside the index is taken for one inside with a probability of 2**-64.

A line of an indexed key stays in the largest id that holds it and goes from all
other documents. Defined results: null and empty texts are one empty line (a
null text comes back null); rows of equal id count as one document; a row
without an id counts for no line and loses the indexed ones. Very long texts
are handled alone; an empty table gives an empty result; only the id and text
columns are read, whatever other columns are called.
"""

from __future__ import annotations

import io
import os
import re
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm import common as C

MIN_CHARS, MIN_DOCS = 40, 5
#: Keys of one shard (about 24 bytes each), and shards open in a task at once.
SHARD_KEYS = 1 << 18
OPEN_SHARDS = 8

_U = np.uint64


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a shared folder, as tasks open it."""
    plain = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(plain)


def write_file(path: str, data: bytes) -> None:
    """Write a file under a name of its own, then move it in place, so that a
    repeated or lost task leaves a whole file or none."""
    store, at = file_system(path)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    part = f"{at}.{os.getpid()}-{os.urandom(4).hex()}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, at)


def read_file(path: str) -> bytes:
    store, at = file_system(path)
    with store.open_input_stream(at) as src:
        return src.read()


class PerfectHash:
    """A minimal perfect hash of 128-bit keys: per level, keys that are alone at
    their place in a bit array stay there; the others go on to the next level.
    A key's number is the rank of its bit."""

    GAMMA = 2.0

    def __init__(self, planes: list[np.ndarray]):
        self.planes = planes
        self.ranks, before = [], 0
        for p in planes:
            ones = np.bitwise_count(p).astype(np.int64)
            self.ranks.append(before + np.cumsum(ones) - ones)
            before += int(ones.sum())

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, bits: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (C.mix(a + _U(level) * _U(0x9E3779B97F4A7C15) ^ (b >> _U(7)))
                    % _U(bits)).astype(np.int64)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> "PerfectHash":
        planes = []
        while len(a):
            bits = 64 * max(1, int(np.ceil(cls.GAMMA * len(a) / 64)))
            at = cls._place(a, b, len(planes), bits)
            alone = np.bincount(at, minlength=bits)[at] == 1
            flags = np.zeros(bits, np.uint8)
            flags[at[alone]] = 1
            planes.append(np.packbits(flags, bitorder="little").view(_U))
            a, b = a[~alone], b[~alone]
        return cls(planes)

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Each key's number; -1 or any number for keys it wasn't built from."""
        out = np.full(len(a), -1, np.int64)
        left = np.arange(len(a))
        for level, (plane, rank) in enumerate(zip(self.planes, self.ranks)):
            if not len(left):
                break
            at = self._place(a[left], b[left], level, 64 * len(plane))
            word, bit = plane[at >> 6], (at & 63).astype(_U)
            hit = (word >> bit) & _U(1) == 1
            below = np.bitwise_count(word & ((_U(1) << bit) - _U(1))).astype(np.int64)
            out[left[hit]] = (rank[at >> 6] + below)[hit]
            left = left[~hit]
        return out


class Shard:
    """A shard's perfect hash and arrays, to and from the bytes of its file."""

    def __init__(self, hashes: PerfectHash, prints: np.ndarray, counts: np.ndarray,
                 keepers: np.ndarray):
        self.hashes, self.prints, self.counts, self.keepers = hashes, prints, counts, keepers

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray, counts: np.ndarray,
              keepers: np.ndarray) -> "Shard":
        hashes = PerfectHash.build(a, b)
        order = np.empty(len(a), np.int64)
        order[hashes.number(a, b)] = np.arange(len(a))
        return cls(hashes, b[order], np.minimum(counts[order], 2**32 - 1).astype(np.uint32),
                   keepers[order])

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, prints=self.prints, counts=self.counts, keepers=self.keepers,
                 **{f"p{i}": p for i, p in enumerate(self.hashes.planes)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> "Shard":
        with np.load(io.BytesIO(data)) as f:
            planes = [f[f"p{i}"] for i in range(len(f.files) - 3)]
            return cls(PerfectHash(planes), f["prints"], f["counts"], f["keepers"])

    def probe(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which keys it holds, and their counts and keepers."""
        at = self.hashes.number(a, b)
        if not len(self.prints):
            return np.zeros(len(a), bool), at, at
        safe = np.maximum(at, 0)
        return (at >= 0) & (self.prints[safe] == b), self.counts[safe], self.keepers[safe]


def line_keys(buf: np.ndarray, offs: np.ndarray, min_chars: int,
              ) -> tuple[np.ndarray, ...]:
    """Line borders, each text's offsets in the lines, and of the lines with a
    long enough key their numbers and both halves of the key's hash."""
    s, e, rows = C.lines(buf, offs)
    inside = np.flatnonzero(C.word_bytes(buf))
    chars = C.before(C.code_points(buf))
    if not len(inside):
        none = np.zeros(0, _U)
        return s, e, rows, np.zeros(0, np.int64), none, none
    a, b = np.searchsorted(inside, s), np.searchsorted(inside, e) - 1
    some = a <= b
    ks = np.where(some, inside[np.minimum(a, len(inside) - 1)], s)
    ke = np.where(some, inside[np.maximum(b, 0)] + 1, s)
    at = np.flatnonzero(chars[ke] - chars[ks] >= min_chars)
    return (s, e, rows, at, C.range_hash(buf, ks[at], ke[at], lower=True, seed=31),
            C.range_hash(buf, ks[at], ke[at], lower=True, seed=32))


def frequent_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``(a, b, docs, keeper)`` of the line keys of ``min_docs`` documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in C.chunks(batches, "_text"):
            _, _, lines, at, a, b = line_keys(buf, offs, min_chars)
            text = C.owner(lines)[at]
            order = np.lexsort((b, a, text))
            a, b, text = a[order], b[order], text[order]
            new = np.ones(len(a), bool)
            new[1:] = (text[1:] != text[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            ids = rows.column("_id").combine_chunks().take(pa.array(text[new]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(C.signed(a[new])), pa.array(C.signed(b[new])), ids],
                names=["a", "b", "_id"])

    return (docs.filter("_id is not null").mapInArrow(run, "a long, b long, _id long")
            .groupBy("a", "b").agg(F.count_distinct("_id").alias("docs"),
                                   F.max("_id").alias("keeper"))
            .filter(F.col("docs") >= min_docs))


def build_index(lines: DataFrame, path: str) -> int:
    """Write the shards of a line table under ``path``; their number."""
    shards = max(1, -(-lines.count() // SHARD_KEYS))

    def write(group: pa.Table) -> pa.Table:
        a, b = (group.column(c).to_numpy().view(_U) for c in ("a", "b"))
        shard = group.column("shard")[0].as_py()
        data = Shard.build(a, b, group.column("docs").to_numpy(),
                           group.column("keeper").to_numpy()).to_bytes()
        write_file(f"{path}/{shard}.mph", data)
        return pa.table({"shard": pa.array([shard], pa.int32()),
                         "keys": pa.array([len(a)], pa.int64())})

    dealt = lines.withColumn("shard", F.pmod("a", F.lit(shards)).cast("int"))
    written = {r.shard for r in dealt.groupBy("shard").applyInArrow(
        write, "shard int, keys long").collect()}
    for shard in set(range(shards)) - written:
        none = np.zeros(0, _U)
        write_file(f"{path}/{shard}.mph", Shard.build(
            none, none, np.zeros(0, np.int64), np.zeros(0, np.int64)).to_bytes())
    return shards


def probe_documents(docs: DataFrame, path: str, shards: int, min_chars: int) -> DataFrame:
    """Each document's line counts and its text without the dropped lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: OrderedDict[int, Shard] = OrderedDict()

        def shard(k: int) -> Shard:
            if k not in opened:
                opened[k] = Shard.from_bytes(read_file(f"{path}/{k}.mph"))
                if len(opened) > OPEN_SHARDS:
                    opened.popitem(last=False)
            opened.move_to_end(k)
            return opened[k]

        for rows, buf, offs in C.chunks(batches, "_text"):
            s, e, lines, at, a, b = line_keys(buf, offs, min_chars)
            ids = rows.column("_id").combine_chunks()
            text = C.owner(lines)
            own = ids.fill_null(0).to_numpy()[text[at]]
            known = ids.is_valid().to_numpy(zero_copy_only=False)[text[at]]
            drop = np.zeros(len(s), bool)
            home = (C.signed(a) % shards).astype(np.int64)
            for k in np.unique(home):
                of = home == k
                held, _, keeper = shard(int(k)).probe(a[of], b[of])
                drop[at[of]] = held & ((keeper != own[of]) | ~known[of])
            dropped = np.diff(C.before(drop)[lines])
            texts = rows.column("_text").combine_chunks()
            changed = np.flatnonzero(dropped)
            if len(changed):
                new = []
                for i in changed:
                    kept = [n for n in range(lines[i], lines[i + 1]) if not drop[n]]
                    new.append(b"\n".join(buf[s[n]:e[n]].tobytes() for n in kept).decode())
                mask = np.zeros(len(texts), bool)
                mask[changed] = True
                texts = pa.compute.replace_with_mask(texts, pa.array(mask),
                                                     pa.array(new, texts.type))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(lines), pa.int64()), pa.array(dropped, pa.int64()),
                 texts], names=["_id", "n_lines", "n_dropped", "text"])

    return docs.mapInArrow(run, "_id long, n_lines long, n_dropped long, text string")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per input row: the id, ``n_lines``, ``n_dropped`` and the text
    that is left."""
    spark = docs.sparkSession
    C.small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    path = C.work_dir(spark, "line-index")
    lines = C.stored(frequent_lines(texts, min_chars, min_docs), "lines")
    shards = build_index(lines, path)
    return probe_documents(texts, path, shards, min_chars).select(
        F.col("_id").alias(id_col), "n_lines", "n_dropped", F.col("text").alias(text_col))
