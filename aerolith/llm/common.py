"""Shared helpers of the training-data operators: inputs, the shared work
folder, and vectorised splitting and hashing of text held in Arrow batches.

Texts are handled as the UTF-8 bytes of an Arrow string column. White space is
the six ASCII characters ``[\\x20\\x09-\\x0D]``; none of these bytes (nor ``\\n``)
can occur inside a multi-byte character, so byte positions split words exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.session import ensure_checkpoint_dir

#: Text bytes handled at once in a task; one longer text is handled alone.
CHUNK_BYTES = 2 << 20
#: Rows of an Arrow batch: texts can be long, so batches hold few of them.
BATCH_ROWS = 256

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table, read by Spark alone (any store that Spark can reach)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what an Arrow batch of long texts can hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` for tables a job writes and
    reads again. Only a local session may run without that setting."""
    local = spark.sparkContext.master.startswith("local") \
        and not spark.sparkContext.master.startswith("local-cluster")
    base = spark.conf.get("spark.checkpoint.dir", None) \
        or ensure_checkpoint_dir(spark, allow_local=local)
    return f"{base.rstrip('/')}/aerolith-llm/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete each job's shuffle files when it ends: for jobs that store what they make."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


#: For ``stored`` tables of hashes, which no dictionary makes smaller.
HASHED = {"parquet.enable.dictionary": "false"}


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared work folder and read back: later jobs start
    from the files, whichever executors are lost meanwhile."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete ``stored`` tables. Everything made from them must be stored already:
    a task that runs again after an executor is lost would miss them."""
    for table in tables:
        session = table.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def carried(docs: DataFrame, text_col: str) -> tuple[DataFrame, T.StructType]:
    """``docs`` with its columns renamed c0, c1, ... and the text again as
    ``_text``, for passing whole rows through a task whatever their columns are
    called; and the schema of the renamed columns. ``restored`` undoes it."""
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)])
    renamed = docs.toDF(*plain.names)
    text = plain.names[docs.columns.index(text_col)]
    return renamed.withColumn("_text", F.col(text)), plain


def carry(rows: pa.Table, schema: T.StructType) -> list[pa.Array]:
    return [rows.column(c).combine_chunks() for c in schema.names]


def restored(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*(f"c{i}" for i in range(len(docs.columns)))).toDF(*docs.columns)


def hash_sample(df: DataFrame, rows: int, total: int) -> DataFrame:
    """About ``rows`` of the ``total`` rows, by a hash of the whole row; repeated
    rows count once. No task gathers more than its share."""
    return df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(max(total, rows))) < rows).distinct()


#: Rows of a few numbers that may be broadcast.
FEW_ROWS = 1_000_000


def few(df: DataFrame, rows: int = FEW_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to have few rows; beyond
    that it is joined by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each text's offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offs[0]:offs[-1]], offs - offs[0]


def chunks(batches: Iterable[pa.RecordBatch], text: str, size: int = CHUNK_BYTES,
           ) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Regroup batches into runs of whole rows of about ``size`` text bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        buf, offs = text_bytes(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offs, offs[at] + size, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield rows.slice(at, to - at), buf[offs[at]:offs[to]], offs[at:to + 1] - offs[at]
            at = to


# The white space of the word rule, as byte values.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: ASCII but for letters and digits: parts words that are compared without
#: their punctuation.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(_U, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> _U(32)
        x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(32)
        x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(32)
    return x


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit constants that depend only on the seed."""
    return np.random.Generator(np.random.Philox(seed)).integers(
        0, 1 << 64, n, dtype=_U) | _U(1)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)


def range_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False,
               seed: int = 11) -> np.ndarray:
    """A 64-bit hash of each byte range; equal bytes have equal hashes wherever
    they stand. Eight bytes are taken at a time."""
    lens = ends - starts
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = _LOWER[buf] if lower else buf
    eights = np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,))
    k0, k1, k2 = constants(seed, 3)
    with np.errstate(over="ignore"):
        out = (lens.astype(_U) + k0) * k1
        at, left, mine = starts, lens, None
        while True:
            x = out if mine is None else out[mine]
            x = (x ^ (eights[at] & _KEEP[np.minimum(left, 8)])) * k2
            x ^= x >> _U(31)
            if mine is None:
                out = x
            else:
                out[mine] = x
            more = np.flatnonzero(left > 8)
            if not len(more):
                return mix(out)
            mine = more if mine is None else mine[more]
            at, left = at[more] + 8, left[more] - 8


def words(buf: np.ndarray, offs: np.ndarray, parts: np.ndarray = _SPACE,
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's offsets in them;
    ``parts`` flags the byte values that part words."""
    n = len(buf)
    if n == 0:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64))
    inside = ~parts[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def lines(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all lines (texts split at ``\\n``, without it)
    and each text's offsets in them. An empty text is one empty line."""
    breaks = np.flatnonzero(buf == 0x0A)
    starts = np.sort(np.concatenate([offs[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offs[1:]]))
    count = np.searchsorted(breaks, offs) + np.arange(len(offs))
    return starts, ends, count


def before(mask: np.ndarray) -> np.ndarray:
    """How many elements before each position (and the end) are set."""
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def code_points(buf: np.ndarray) -> np.ndarray:
    """Mask of the bytes that begin a character."""
    return (buf & 0xC0) != 0x80


def word_bytes(buf: np.ndarray) -> np.ndarray:
    """Mask of the bytes that aren't white space."""
    return ~_SPACE[buf]


def word_hashes(buf: np.ndarray, offs: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and each text's offsets in them."""
    s, e, w = words(buf, offs)
    return range_hash(buf, s, e, lower), w


def window_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of ``size`` consecutive tokens at each position where that
    many follow (over text borders too; see ``window_owner``)."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    c = constants(5 + size, size)
    out = np.zeros(n, _U)
    with np.errstate(over="ignore"):
        for i in range(size):
            out += tokens[i:i + n] * c[i]
    return mix(out)


def owner(offs: np.ndarray) -> np.ndarray:
    """For each element, the row it belongs to, given the rows' offsets."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from the rows' values in a row and their counts."""
    offs = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values, kind))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)

