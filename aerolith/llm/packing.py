"""Packing documents into sequences with a bounded number of open windows.

Each task encodes its documents, ends each with the end id and places them online.
Whole windows of a long document are sequences of their own; its rest is a piece.
A task keeps ``OPEN`` windows open. A piece goes where it fits best (the least room
that holds it); while fewer windows are open, one that fits nowhere opens another.
When none fits and all are open, the fullest is emitted: the piece's first tokens
fill its room and the remainder opens a window in its place. So an emitted window
is always full, and a piece is cut only where padding would stand instead.

Leftover windows are then merged: those of ``FAN`` tasks go through the same
placing in one task, and so on in rounds until one task has at most ``OPEN`` of
them. There the last tokens, fewer than a sequence, end as sequences of a power of
two, which need no padding. A task holds ``OPEN`` windows and the texts of a chunk,
a merging task ``FAN * OPEN`` windows, whatever the table's size.

The byte-level tokenizer starts a new token at a single space between two visible
characters, and at a comma or the like behind a letter, so texts are encoded by the
stretches between such places and repeated stretches once per worker; the ids are
those of the whole text.

Defined results: null and empty texts are the end id alone; a row without an id is
packed as any other; repeated rows are documents of their own; very long texts are
handled alone; an empty table gives no rows; only the id and text columns are read,
whatever other columns are called. Results depend on how the input's files are
split into tasks, but not on which task runs where or is run again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm import common as C
from aerolith.llm.wavelet import _Grown

END_ID = 0
LENGTH = 1024
#: Windows a task keeps open, and tasks whose leftovers are merged in one.
OPEN, FAN = 16, 64

_SPACE, _BREAK = 0x20, "\n"
# Bytes that are certainly no white space: visible ASCII, and the second byte of
# the letters U+00C0 to U+00FF behind their lead byte.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_LEAD = 0xC3
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,!?;:"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class StretchEncoder:
    """Ids of a byte-level tokenizer, by stretches that begin at a single space
    between two characters that are surely visible, or at a mark behind a letter.
    A stretch is encoded once while it is kept; known ones are found by their
    hashes in a sorted array."""

    KEEP = 1_000_000
    #: Stretches encoded in one call, parted by line breaks.
    RUN = 4096

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        mark = tokenizer.encode(_BREAK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.lens, self.pool = _Grown(np.int64), _Grown(np.int64), _Grown(np.uint32)
        self._add(np.full(1, END_ID, np.uint32), np.ones(1, np.int64))  # slot 0: the end id

    def _add(self, ids: np.ndarray, lens: np.ndarray) -> None:
        self.starts.add(self.pool.size + np.cumsum(lens) - lens)
        self.lens.add(lens)
        self.pool.add(ids)

    @staticmethod
    def pieces(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
        """Starts, ends, text offsets and hashes of the stretches."""
        n = len(buf)
        cut = np.zeros(n + 1, bool)
        if n:
            before = _VISIBLE[buf[:-2]]
            before[1:] |= (buf[:-3] == _LEAD) & (buf[1:-2] >= 0x80)
            after = _VISIBLE[buf[2:]] | (buf[2:] == _LEAD)
            cut[1:n - 1] = (buf[1:-1] == _SPACE) & before & after
            # The two neighbours belong to the same text.
            edge = offs[1:-1]
            edge = edge[(edge > 0) & (edge < n)]
            cut[edge] = cut[edge - 1] = False
            # A mark behind an ASCII letter begins a token as well.
            cut[1:n] |= _MARK[buf[1:]] & _LETTER[buf[:-1]]
        cut[offs[:-1][np.flatnonzero(np.diff(offs))]] = True
        starts = np.flatnonzero(cut[:n])
        ends = np.append(starts[1:], n) if len(starts) else starts
        return starts, ends, np.searchsorted(starts, offs), C.range_hash(buf, starts, ends)

    @staticmethod
    def _joins(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Whether a line break may stand before and behind a stretch without
        changing its ids: it begins, behind one space at most, and ends with a
        character that is surely visible, and holds no line break."""
        head = s + (buf[s] == _SPACE)
        first = buf[np.minimum(head, e - 1)]
        last = _VISIBLE[buf[e - 1]] | ((buf[e - 1] >= 0x80) & (buf[np.maximum(e - 2, 0)] == _LEAD))
        breaks = C.before(buf == 0x0A)
        return (head < e) & (_VISIBLE[first] | (first == _LEAD)) & last & (breaks[s] == breaks[e])

    def _learn(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Encode stretches and keep their ids; their slots."""
        joins = self._joins(buf, s, e) & (self.mark is not None)
        slots = np.empty(len(s), np.int64)
        run = np.flatnonzero(joins)
        slots[run] = self.lens.size + np.arange(len(run))
        for at in range(0, len(run), self.RUN):
            a, size = s[run[at:at + self.RUN]], (e - s)[run[at:at + self.RUN]] + 1
            to = np.cumsum(size)
            source = np.arange(to[-1]) + np.repeat(a - to + size, size)
            text = buf[np.minimum(source, len(buf) - 1)]
            text[to - 1] = 0x0A
            ids = np.array(self.tokenizer.encode_batch_fast(
                [text.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(ids == self.mark)
            self._add(ids[ids != self.mark], np.diff(ends, prepend=-1) - 1)
        alone = np.flatnonzero(~joins)
        slots[alone] = self.lens.size + np.arange(len(alone))
        words = [buf[x:y].tobytes().decode() for x, y in zip(s[alone], e[alone])]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lens = np.fromiter(map(len, found), np.int64, len(found))
        self._add(np.fromiter(chain.from_iterable(found), np.uint32, int(lens.sum())), lens)
        return slots

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, each text's followed by the end id, and their offsets."""
        s, e, w, hashes = self.pieces(buf, offs)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > self.KEEP:
            self._clear()
        at = np.searchsorted(self.hashes, distinct)
        fresh = np.ones(len(distinct), bool)
        inside = at < len(self.hashes)
        fresh[inside] = self.hashes[at[inside]] != distinct[inside]
        if fresh.any():
            mine = self._learn(buf, s[first[fresh]], e[first[fresh]])
            self.slots = np.insert(self.slots, at[fresh], mine)
            self.hashes = np.insert(self.hashes, at[fresh], distinct[fresh])
            at = np.searchsorted(self.hashes, distinct)
        slot = self.slots[at][back]
        # A stretch of its own, the end id, closes each text.
        ends = w[1:] + np.arange(len(w) - 1)
        whole = np.zeros(len(slot) + len(ends), np.int64)
        word = np.ones(len(whole), bool)
        word[ends] = False
        whole[word] = slot
        lens, starts = self.lens.data[whole], self.starts.data[whole]
        upto = np.zeros(len(lens) + 1, np.int64)
        np.cumsum(lens, out=upto[1:])
        source = np.arange(int(upto[-1])) + np.repeat(starts - upto[:-1], lens)
        return self.pool.data[source], upto[np.append(0, ends + 1)]


_ENCODERS: dict[str, StretchEncoder] = {}


def encoder_of(tokenizer: str) -> StretchEncoder:
    """The worker's encoder: its known stretches outlast a task."""
    if tokenizer not in _ENCODERS:
        from tokenizers import Tokenizer
        _ENCODERS[tokenizer] = StretchEncoder(Tokenizer.from_file(tokenizer))
    return _ENCODERS[tokenizer]


#: A piece: document id, start in its document, tokens of that document, ids.
Piece = tuple[int | None, int, int, np.ndarray]


def _split(piece: Piece, at: int) -> tuple[Piece, Piece]:
    doc, start, total, ids = piece
    return (doc, start, total, ids[:at]), (doc, start + at, total, ids[at:])


class Windows:
    """At most ``most`` open windows; full ones are handed to ``emit``."""

    def __init__(self, length: int, most: int, emit):
        self.length, self.most, self.emit = length, most, emit
        self.open: list[tuple[int, list[Piece]]] = []  # tokens, pieces

    def place(self, pieces: list[Piece]) -> None:
        """Place pieces that stay together while they fit."""
        size = sum(len(p[3]) for p in pieces)
        while size >= self.length:
            head, pieces = self._cut(pieces, self.length)
            self.emit(head)
            size -= self.length
        if not size:
            return
        fits = [k for k, (used, _) in enumerate(self.open) if used + size <= self.length]
        if fits:
            best = max(fits, key=lambda k: self.open[k][0])
            used, held = self.open[best]
            held.extend(pieces)
            self.open[best] = (used + size, held)
            if used + size == self.length:
                self.emit(self.open.pop(best)[1])
        elif len(self.open) < self.most:
            self.open.append((size, list(pieces)))
        else:
            fullest = max(range(len(self.open)), key=lambda k: self.open[k][0])
            used, held = self.open[fullest]
            head, rest = self._cut(pieces, self.length - used)
            self.emit(held + head)
            self.open[fullest] = (size - (self.length - used), rest)

    @staticmethod
    def _cut(pieces: list[Piece], room: int) -> tuple[list[Piece], list[Piece]]:
        head, rest = [], []
        for p in pieces:
            if room >= len(p[3]):
                head.append(p)
                room -= len(p[3])
            elif room:
                first, second = _split(p, room)
                head.append(first)
                rest.append(second)
                room = 0
            else:
                rest.append(p)
        return head, rest

    def finish(self) -> None:
        """Emit what is open: whole sequences, then ones of powers of two."""
        pieces = [p for _, held in sorted(self.open, key=lambda w: -w[0]) for p in held]
        size, at = sum(len(p[3]) for p in pieces), self.length
        while size:
            while at > size:
                at //= 2
            head, pieces = self._cut(pieces, at)
            self.emit(head)
            size -= at
        self.open = []


_SCHEMA = ("doc_id long, start long, doc_tokens long, ids binary, sequence_id long, "
           "offset long, task long, open int")


class _Rows:
    """Emitted windows as rows. Ids of sequences hold the round, the task and the
    number in the task, so no two rounds or tasks share one."""

    def __init__(self, turn: int, task: int):
        self.first, self.task, self.seq = turn << 56 | task << 28, task, 0
        self.columns: list[list] = [[] for _ in range(8)]

    def add(self, pieces: list[Piece], still_open: int | None = None) -> None:
        offset = 0
        for doc, start, total, ids in pieces:
            row = (doc, start, total, ids.tobytes(), None if still_open is not None
                   else self.first + self.seq, offset, self.task, still_open)
            for column, value in zip(self.columns, row):
                column.append(value)
            offset += len(ids)
        self.seq += still_open is None

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3 + [pa.int32()]
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(self.columns, kinds)],
            names=["doc_id", "start", "doc_tokens", "ids", "sequence_id", "offset", "task", "open"])
        self.columns = [[] for _ in kinds]
        return out


def _merged(turn: int, last: bool, length: int, most: int):
    """A round's task: the leftover windows of its tasks are placed as wholes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        left = table.sort_by([("task", "ascending"), ("open", "ascending"), ("offset", "ascending")])
        rows = left.to_pylist()
        out = _Rows(turn, rows[0]["task"] // FAN)
        windows = Windows(length, most, out.add)
        held: list[Piece] = []
        for r, following in zip(rows, rows[1:] + [None]):
            held.append((r["doc_id"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], "<u4")))
            if following is None or (following["task"], following["open"]) != (r["task"], r["open"]):
                windows.place(held)
                held = []
        if last:
            windows.finish()
        for k, (_, pieces) in enumerate(windows.open):
            out.add(pieces, k)
        yield out.batch()
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         length: int = LENGTH, most: int = OPEN) -> DataFrame:
    """Pieces of all documents in their sequences: the id, ``start`` (ids of its
    document before it), ``doc_tokens``, ``ids`` (little-endian unsigned 32-bit),
    ``sequence_id`` and ``offset``. ``length`` is a power of two."""
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    C.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        out = _Rows(0, TaskContext.get().partitionId())
        windows = Windows(length, most, out.add)
        for rows, buf, offs in C.chunks(batches, "text"):
            ids, at = encoder.encode(buf, offs)
            ids = ids.astype("<u4")
            for doc, a, b in zip(rows.column("id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                # Copies, so that an open window doesn't hold its whole chunk.
                whole = (b - a) // length * length
                for lo in range(a, a + whole, length):
                    out.add([(doc, lo - a, b - a, ids[lo:lo + length])])
                if a + whole < b:
                    windows.place([(doc, whole, b - a, ids[a + whole:b].copy())])
            yield out.batch()
        for k, (_, pieces) in enumerate(windows.open):
            out.add(pieces, k)
        yield out.batch()

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    packed = C.stored(texts.mapInArrow(run, _SCHEMA), "pieces")
    done = packed.where("open is null")
    open_ = packed.where("open is not null")
    tasks = open_.agg(F.max("task")).first()[0]
    turn = 0
    while tasks is not None:
        turn, tasks = turn + 1, tasks // FAN
        merged = C.stored(open_.groupBy(F.expr(f"task div {FAN}").alias("group"))
                          .applyInArrow(_group(_merged(turn, tasks == 0, length, most)), _SCHEMA),
                          f"merged-{turn}")
        done = done.unionByName(merged.where("open is null"))
        open_ = merged.where("open is not null")
        tasks = tasks or None
    return done.drop("task", "open").withColumnRenamed("doc_id", id_col)


def _group(run):
    return lambda table: pa.Table.from_batches(run(table.to_batches()))


def sequences(packed: DataFrame, length: int = LENGTH, pad: int = END_ID) -> DataFrame:
    """``sequence_id``, ``n_tokens`` and the sequence's ``ids`` as stored for
    training: padded to ``length`` unless its tokens are a power of two."""
    size = F.octet_length("ids")
    one = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"),
        (F.sum(size) / 4).cast("long").alias("n_tokens"))
    ids = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    power = F.bit_count("n_tokens") == 1
    padded = F.when(power, ids).otherwise(
        F.rpad(ids, 4 * length, F.lit(pad.to_bytes(4, "little"))))
    return one.select("sequence_id", "n_tokens", padded.alias("ids"))


def packed_report(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The pieces' places, lengths and checksums in place of their ids."""
    return packed.select(
        id_col, "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
