"""Quality rules by suffix-array repetition.

Each text is a sequence of words. Prefix doubling sorts the suffixes of all
texts of a chunk at once (a suffix never compares beyond its own text), and the
ranks of each doubling level give the longest common prefix of neighbours in
the suffix array. A suffix's longest repeat is the larger of its two
neighbours' prefixes; the LCP intervals of the maximal repeated substrings are
exactly the runs of such neighbours, so the union of their occurrences' spans
is the union of ``[i, i + longest(i))`` over all suffixes ``i``. A text fails if
spans of at least ``min_repeat`` words cover more than ``max_covered`` of it,
or if its longest repeat is over ``max_longest`` of its words.

Texts: null or without words have no repeats. Very long texts are handled
alone, in memory that grows with the one text. Repeated rows, ties and null ids
are judged row by row and returned as they are; an empty table gives an empty
result. ``verdicts`` reads the id and text columns alone, ``filtered`` passes all
columns through, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.llm import common as C

#: A repeat counts from this many words; shorter ones are ordinary phrases.
MIN_REPEAT = 10
#: The largest part of a text that repeats may cover.
MAX_COVERED = 0.5
#: The longest repeat, as a part of the text's words.
MAX_LONGEST = 0.3

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_covered", "longest_repeat")




def longest_repeats(tokens: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """For each token position, the length of the longest run from it that
    occurs again in the same text (occurrences may overlap).

    ``tokens`` holds the token hashes of all texts, ``offs`` the texts' offsets.
    A suffix's rank is the place of the first suffix of its group; doubling
    refines the groups of two and more until none is left.
    """
    n = len(tokens)
    if n == 0:
        return np.zeros(0, np.int64)
    text = C.owner(offs)
    end = offs[1:][text]
    with np.errstate(over="ignore"):
        key = C.mix(tokens + text.astype(np.uint64) * C.constants(3, 1)[0])
    suffixes = np.argsort(key)
    slots, new = np.arange(n), np.ones(n, bool)
    new[1:] = key[suffixes[1:]] != key[suffixes[:-1]]
    rank = np.empty(n, np.int64)
    same = ~new  # whether a suffix shares its first token with the one before
    levels: list[np.ndarray] = []
    size, moved = 1, suffixes
    while True:
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(new)))
        rank[moved] = np.repeat(slots[first], sizes)
        levels.append(rank.astype(np.int32))
        many = np.repeat(sizes > 1, sizes)
        slots, moved = slots[many], moved[many]
        if not len(moved):
            break
        nxt = moved + size
        second = np.where(nxt < end[moved], rank[np.minimum(nxt, n - 1)], -1)
        key = rank[moved] * (n + 1) + second + 1
        order = np.argsort(key)
        moved, key = moved[order], key[order]
        suffixes[slots] = moved
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        size *= 2
    at = np.flatnonzero(same)
    a, b = suffixes[at - 1], suffixes[at]
    common = np.zeros(len(at), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        ok = (x < end[a]) & (y < end[b])
        eq = levels[j][np.minimum(x, n - 1)] == levels[j][np.minimum(y, n - 1)]
        common[ok & eq] += 1 << j
    lcp = np.zeros(n + 1, np.int64)
    lcp[at] = common
    out = np.empty(n, np.int64)
    out[suffixes] = np.maximum(lcp[:-1], lcp[1:])
    return out


def covered(longest: np.ndarray, offs: np.ndarray, least: int, most: int | None = None,
            ) -> np.ndarray:
    """Words of each text in the union of the repeats of ``least`` words and
    more (each shortened to ``most``)."""
    n = len(longest)
    at = np.flatnonzero(longest >= least)
    span = longest[at] if most is None else np.minimum(longest[at], most)
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + span, -1)
    return np.diff(C.before(np.cumsum(step)[:n] > 0)[offs])


# The symbols counted by the rule.
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _duplicate_lines(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    s, e, rows = C.lines(buf, offs)
    inside = C.before(C.word_bytes(buf))
    text = C.owner(rows)
    with_word = inside[e] > inside[s]
    s, e, text = s[with_word], e[with_word], text[with_word]
    with np.errstate(over="ignore"):
        key = C.mix(C.range_hash(buf, s, e) + text.astype(np.uint64) * C.constants(4, 1)[0])
    first = np.zeros(len(key), bool)
    first[np.unique(key, return_index=True)[1]] = True
    return np.bincount(text[~first], minlength=len(offs) - 1)


def _measured(docs: DataFrame, text_col: str, min_repeat: int) -> DataFrame:
    """The renamed columns of ``docs`` and the counts of ``MEASURES``."""
    C.small_batches(docs.sparkSession)
    renamed, schema = C.carried(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in C.chunks(batches, "_text"):
            tokens, w = C.word_hashes(buf, offs, lower=False)
            longest = longest_repeats(tokens, w)
            at_word = np.diff(w) > 0
            top = np.zeros(len(w) - 1, np.int64)
            if at_word.any():
                top[at_word] = np.maximum.reduceat(longest, w[:-1][at_word])
            yield pa.RecordBatch.from_arrays([
                *C.carry(rows, schema), *(pa.array(x, pa.int64()) for x in (
                    np.diff(w),
                    np.diff(C.before(C.word_bytes(buf) & C.code_points(buf))[offs]),
                    np.diff(C.before(_SYMBOLS[buf])[offs]),
                    _duplicate_lines(buf, offs),
                    covered(longest, w, 3, 3),
                    covered(longest, w, min_repeat),
                    top))], names=[*schema.names, *MEASURES])

    out = T.StructType([*schema.fields, *(T.StructField(n, T.LongType()) for n in MEASURES)])
    return renamed.mapInArrow(run, out)


def _verdict(min_repeat: int, max_covered: float, max_longest: float) -> tuple[Column, Column]:
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    repeats = ((F.col("n_covered") > F.lit(max_covered) * F.col("n_words"))
               | ((F.col("longest_repeat") >= min_repeat)
                  & (F.col("longest_repeat") > F.lit(max_longest) * F.col("n_words"))))
    return base, ~base & ~repeats


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
             max_longest: float = MAX_LONGEST) -> DataFrame:
    """One row per input row: the id, the counts of ``MEASURES``, ``base_failed``
    (under 50 words, or over half of the words in repeated 3-word windows) and
    ``kept``: neither that nor a text that its repeats of ``min_repeat`` words
    fill."""
    base, kept = _verdict(min_repeat, max_covered, max_longest)
    return (_measured(docs.select(id_col, text_col), text_col, min_repeat)
            .withColumn("base_failed", base).withColumn("kept", kept)
            .drop("c1").withColumnRenamed("c0", id_col))


def filtered(docs: DataFrame, text_col: str = "text", min_repeat: int = MIN_REPEAT,
             max_covered: float = MAX_COVERED, max_longest: float = MAX_LONGEST) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    _, kept = _verdict(min_repeat, max_covered, max_longest)
    return C.restored(_measured(docs, text_col, min_repeat).filter(kept), docs)
