"""Token ids as binary files: one wavelet matrix per shard.

Documents are dealt by id range and sorted; each task encodes its documents, ends
each with the end id, and writes shards of at most ``shard_tokens`` ids (a longer
document has a shard alone). A shard's file holds the ids as bit-planes, highest
bit first: each plane's zeros come first in the next plane, in order. Planes are
cut into blocks, each compressed alone, with a directory of the blocks' places
and of the ones before each block. So any id, the number of an id's occurrences
in a range (rank) and the place of its n-th occurrence (select) are read from
the one file by opening one block per plane and step.

Words between white space are encoded alone and repeated words once per task:
the tokenizer drops white space and never joins what it separates, so the ids are
those of the whole text. Files are written under a name of their own and moved
in place, and the job's table names them: a repeated task leaves no mark.

Defined results: null and empty texts are the end id alone; rows without an id
come first; rows of equal id are ordered by a hash of their text; very long texts
are handled alone; an empty table gives no files and no rows; only the id and
text columns are read, whatever other columns are called.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.llm import common as C
from aerolith.llm.line_dedup import write_file

END_ID = 2
SHARD_TOKENS = 1 << 19
#: Bits of a block of a plane.
BLOCK = 1 << 15
MAGIC = b"WMX1"


def matrix_bytes(tokens: np.ndarray, doc_ids: np.ndarray, known: np.ndarray,
                 lengths: np.ndarray) -> bytes:
    """The file of a shard: its tokens, and its documents' ids and lengths."""
    n = len(tokens)
    levels = max(1, int(tokens.max()).bit_length()) if n else 1
    pack = zstandard.ZstdCompressor(level=1)
    zeros, ranks, sizes, blocks = [], [], [], []
    kind = np.uint16 if levels <= 16 else np.uint32
    x = tokens.astype(kind)
    for level in range(levels):
        bit = x & kind(1 << (levels - 1 - level)) != 0
        zeros.append(n - int(np.count_nonzero(bit)))
        before = 0
        for at in range(0, n, BLOCK):
            part = bit[at:at + BLOCK]
            data = pack.compress(np.packbits(part, bitorder="little").tobytes())
            ranks.append(before)
            sizes.append(len(data))
            blocks.append(data)
            before += int(np.count_nonzero(part))
        x = np.concatenate([x[~bit], x[bit]])
    docs = pack.compress(doc_ids.astype("<i8").tobytes() + known.astype("u1").tobytes()
                         + lengths.astype("<u8").tobytes())
    head = struct.pack("<4sQQQQ", MAGIC, n, levels, len(doc_ids), len(docs))
    return b"".join([head, docs, np.array(zeros, "<u8").tobytes(), np.array(ranks, "<u8").tobytes(),
                     np.array(sizes, "<u4").tobytes(), *blocks])


class WaveletMatrix:
    """Token access, counting and occurrence lookup from a shard's file."""

    def __init__(self, data: bytes):
        magic, self.n, self.levels, self.n_docs, packed = struct.unpack_from("<4sQQQQ", data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        at = struct.calcsize("<4sQQQQ")
        self._unpack = zstandard.ZstdDecompressor()
        docs = self._unpack.decompress(data[at:at + packed])
        d = self.n_docs
        self.doc_ids = np.frombuffer(docs, "<i8", d)
        self.known = np.frombuffer(docs, "u1", d, 8 * d) == 1
        self.lengths = np.frombuffer(docs, "<u8", d, 9 * d).astype(np.int64)
        at += packed
        per = -(-self.n // BLOCK)
        self.zeros = np.frombuffer(data, "<u8", self.levels, at).astype(np.int64)
        at += 8 * self.levels
        self.ranks = np.frombuffer(data, "<u8", per * self.levels, at) \
            .astype(np.int64).reshape(self.levels, per)
        at += 8 * per * self.levels
        sizes = np.frombuffer(data, "<u4", per * self.levels, at).astype(np.int64)
        at += 4 * per * self.levels
        self._ends = at + np.cumsum(sizes)
        self._starts = self._ends - sizes
        self._data, self._per = data, per
        self._last: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint8))

    def _bits(self, level: int, block: int) -> np.ndarray:
        k = level * self._per + block
        if self._last[0] != k:
            raw = self._unpack.decompress(self._data[self._starts[k]:self._ends[k]])
            size = min(BLOCK, self.n - block * BLOCK)
            self._last = (k, np.unpackbits(np.frombuffer(raw, np.uint8), count=size,
                                           bitorder="little"))
        return self._last[1]

    def _ones(self, level: int, i: int) -> int:
        """Ones before place ``i`` of a plane."""
        if i >= self.n:
            return self.n - int(self.zeros[level])
        block, rest = divmod(i, BLOCK)
        return int(self.ranks[level, block]) + int(self._bits(level, block)[:rest].sum())

    def access(self, i: int) -> int:
        """The token at place ``i``."""
        value = 0
        for level in range(self.levels):
            bit = int(self._bits(level, i // BLOCK)[i % BLOCK])
            ones = self._ones(level, i)
            value = value << 1 | bit
            i = int(self.zeros[level]) + ones if bit else i - ones
        return value

    def _narrow(self, token: int, lo: int, hi: int) -> tuple[int, int, list[int]]:
        starts = []
        for level in range(self.levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            starts.append(lo)
            if token >> (self.levels - 1 - level) & 1:
                z = int(self.zeros[level])
                lo, hi = z + a, z + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi, starts

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in places ``lo`` to ``hi``."""
        hi = self.n if hi is None else min(hi, self.n)
        if token >> self.levels or lo >= hi:
            return 0
        a, b, _ = self._narrow(token, lo, hi)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The place of a token's occurrence number ``k`` (from 0)."""
        if k < 0 or k >= self.count(token):
            raise IndexError(k)
        i = self._narrow(token, 0, self.n)[0] + k
        for level in range(self.levels - 1, -1, -1):
            one = token >> (self.levels - 1 - level) & 1
            i = self._select_bit(level, i - int(self.zeros[level]) if one else i, one)
        return i

    def _select_bit(self, level: int, k: int, one: int) -> int:
        starts = self.ranks[level]
        if not one:
            starts = np.arange(self._per) * BLOCK - starts
        block = int(np.searchsorted(starts, k, "right")) - 1
        places = np.flatnonzero(self._bits(level, block) == one)
        return block * BLOCK + int(places[k - int(starts[block])])

    def decode(self) -> np.ndarray:
        """All tokens, from the last plane up."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        x = np.zeros(self.n, kind)
        for level in range(self.levels - 1, -1, -1):
            bit = np.concatenate([self._bits(level, b) for b in range(self._per)]) == 1 \
                if self._per else np.zeros(0, bool)
            z, y = int(self.zeros[level]), np.empty(self.n, kind)
            y[~bit] = x[:z]
            y[bit] = x[z:] | kind(1 << (self.levels - 1 - level))
            x = y
        return x.astype(np.uint32)


_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,!?;:"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


_SIGN = "\x01"


class _Grown:
    """An array that is added to."""

    def __init__(self, kind: type):
        self.data, self.size = np.zeros(1024, kind), 0

    def add(self, x: np.ndarray) -> None:
        if self.size + len(x) > len(self.data):
            self.data = np.concatenate(
                [self.data, np.zeros(max(len(self.data), len(x)), self.data.dtype)])
        self.data[self.size:self.size + len(x)] = x
        self.size += len(x)


class WordEncoder:
    """Ids of texts by their words; a word is encoded once while it is kept."""

    KEEP = 1_000_000

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.starts, self.lens, self.pool = _Grown(np.int64), _Grown(np.int64), _Grown(np.uint32)
        self.starts.add(np.zeros(1, np.int64))  # slot 0: the end id
        self.lens.add(np.ones(1, np.int64))
        self.pool.add(np.full(1, END_ID, np.uint32))

    @staticmethod
    def pieces(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
        """Starts, ends, text offsets and hashes of the parts encoded alone:
        words, and apart from them the full stops, commas and the like that end
        a word behind an ASCII letter (the tokenizer always splits there). As it
        lowers letters, words that differ in A-Z's case alone have one hash,
        unless they could hold a special token's string."""
        s, e, w = C.words(buf, offs)
        if not len(s):
            return s, e, w, np.zeros(0, np.uint64)
        body = np.where(_MARK[buf], 0, np.arange(len(buf)))
        last = np.maximum.accumulate(body)[e - 1]
        cut = (last + 1)[(last >= s) & (last < e - 1) & _LETTER[buf[last]]]
        s, e = np.sort(np.concatenate([s, cut])), np.sort(np.concatenate([e, cut]))
        hashes = C.range_hash(buf, s, e, lower=True)
        angle = np.flatnonzero(np.diff(C.before(buf == 0x3C)[np.stack([s, e])], axis=0)[0])
        hashes[angle] = C.range_hash(buf, s[angle], e[angle], seed=12)
        return s, e, np.searchsorted(s, offs), hashes

    def _encoded(self, words: list[str]) -> list[list[int]]:
        """Each word's ids: runs of words are encoded together, parted by a sign
        that is an id of its own and that none of them holds."""
        mark = self.tokenizer.encode(_SIGN, add_special_tokens=False).ids
        out: list[list[int]] = []
        for at in range(0, len(words), 256):
            run = words[at:at + 256]
            if len(mark) != 1 or any(_SIGN in w for w in run):
                out += [x.ids for x in self.tokenizer.encode_batch(run, add_special_tokens=False)]
                continue
            ids = self.tokenizer.encode_batch_fast([f" {_SIGN} ".join(run)],
                                                   add_special_tokens=False)[0].ids
            lo = 0
            for _ in range(len(run) - 1):
                hi = ids.index(mark[0], lo)
                out.append(ids[lo:hi])
                lo = hi + 1
            out.append(ids[lo:])
        return out

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, each text's followed by the end id, and their offsets."""
        s, e, w, hashes = self.pieces(buf, offs)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > self.KEEP:
            self._clear()
        keys = distinct.tolist()
        new = [k for k, h in enumerate(keys) if h not in self.known]
        if new:
            at = first[new]
            words = [buf[a:b].tobytes().decode() for a, b in zip(s[at], e[at])]
            found = self._encoded(words)
            lens = np.fromiter(map(len, found), np.int64, len(found))
            base = self.pool.size + np.cumsum(lens) - lens
            self.known.update(zip([keys[k] for k in new],
                                  range(self.lens.size, self.lens.size + len(new))))
            self.starts.add(base)
            self.lens.add(lens)
            self.pool.add(np.fromiter(chain.from_iterable(found), np.uint32, int(lens.sum())))
        slot = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))[back]
        # A piece of its own, the end id, closes each text.
        ends = w[1:] + np.arange(len(w) - 1)
        whole = np.zeros(len(slot) + len(ends), np.int64)
        word = np.ones(len(whole), bool)
        word[ends] = False
        whole[word] = slot
        lens, starts = self.lens.data[whole], self.starts.data[whole]
        upto = np.zeros(len(lens) + 1, np.int64)
        np.cumsum(lens, out=upto[1:])
        source = np.arange(int(upto[-1]), dtype=np.int32)
        source += np.repeat((starts - upto[:-1]).astype(np.int32), lens)
        return self.pool.data[source], upto[np.append(0, ends + 1)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(tokenizer: str) -> WordEncoder:
    """The worker's encoder: its known words outlast a task."""
    if tokenizer not in _ENCODERS:
        from tokenizers import Tokenizer
        _ENCODERS[tokenizer] = WordEncoder(Tokenizer.from_file(tokenizer))
    return _ENCODERS[tokenizer]


def write_shards(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shard files under ``path``. One row per file, in the order of
    ids: ``file``, ``part`` and ``seq`` (its place), ``n_docs``, ``n_tokens``."""
    C.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, size
            ids, known, lens, toks = (np.concatenate(x) for x in zip(*held))
            name = f"part-{part:06d}-{seq:06d}.wm"
            write_file(f"{path}/{name}", matrix_bytes(toks, ids, known, lens))
            row = pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                 pa.array([len(ids)], pa.int64()), pa.array([len(toks)], pa.int64())],
                names=["file", "part", "seq", "n_docs", "n_tokens"])
            held.clear()
            seq, size = seq + 1, 0
            return row

        for rows, buf, offs in C.chunks(batches, "_text"):
            toks, at = encoder.encode(buf, offs)
            col = rows.column("_id").combine_chunks()
            ids = col.fill_null(0).to_numpy()
            known = col.is_valid().to_numpy(zero_copy_only=False)
            lo = 0
            while lo < len(ids):
                hi = int(np.searchsorted(at, at[lo] + shard_tokens - size, "right")) - 1
                if hi <= lo and size:
                    yield flush()
                    continue
                hi = min(max(hi, lo + 1), len(ids))
                held.append((ids[lo:hi], known[lo:hi], np.diff(at[lo:hi + 1]),
                             toks[at[lo]:at[hi]]))
                size += int(at[hi] - at[lo])
                lo = hi
        if held:
            yield flush()

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return C.stored(texts.repartitionByRange("_id")
                    .sortWithinPartitions("_id", F.xxhash64("_text"))
                    .mapInArrow(run, "file string, part int, seq int, n_docs long, n_tokens long"),
                    "files")


def read_shards(spark: SparkSession, path: str, files: DataFrame, id_col: str = "doc_id",
                ) -> DataFrame:
    """Per document, from the files: the id, ``start`` (ids before it in all
    files), ``n_tokens``, ``ids_crc32`` and ``file``."""
    # Files are summed in their part, and parts (a row per task) among themselves.
    earlier = lambda w: F.coalesce(
        F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).select(
        "part", earlier(Window.orderBy("part")).alias("before"))
    starts = files.join(C.few(parts), "part").select(
        "file", (F.col("before") + earlier(Window.partitionBy("part").orderBy("seq"))).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base, data in zip(*(batch.column(c) for c in ("file", "base", "content"))):
                m = WaveletMatrix(data.as_py())
                toks = m.decode().astype("<u4")
                at = np.zeros(m.n_docs + 1, np.int64)
                np.cumsum(m.lengths, out=at[1:])
                crc = [zlib.crc32(toks[a:b].tobytes()) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(m.doc_ids.astype(np.int64), mask=~m.known),
                     pa.array(base.as_py() + at[:-1]), pa.array(m.lengths),
                     pa.array(crc, pa.int64()), pa.array([file.as_py()] * m.n_docs, pa.string())],
                    names=["_id", "start", "n_tokens", "ids_crc32", "file"])

    if files.isEmpty():
        return spark.createDataFrame(
            [], f"{id_col} long, start long, n_tokens long, ids_crc32 long, file string")
    data = (spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(path)
            .select(F.substring_index("path", "/", -1).alias("file"), "content"))
    return (data.join(C.few(starts), "file")
            .mapInArrow(run, "_id long, start long, n_tokens long, ids_crc32 long, file string")
            .withColumnRenamed("_id", id_col))


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``(file, count, first)`` of a token id in each file, from its planes alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column("file"), batch.column("content")):
                m = WaveletMatrix(data.as_py())
                n = m.count(token)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.as_py()]), pa.array([n], pa.int64()),
                     pa.array([m.select(token, 0) if n else None], pa.int64())],
                    names=["file", "count", "first"])

    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(path)
            .select(F.substring_index("path", "/", -1).alias("file"), "content")
            .mapInArrow(run, "file string, count long, first long"))


def token_files(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write all documents' ids as shard files and read them back."""
    spark = docs.sparkSession
    path = path or C.work_dir(spark, "tokens")
    files = write_shards(docs, tokenizer, path, id_col, text_col, shard_tokens)
    return read_shards(spark, path, files, id_col)
