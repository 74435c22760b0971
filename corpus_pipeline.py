"""From raw documents to token files: quality rules, near duplicates, benchmark
decontamination, mixing and encoding, each over all that the stage before kept.

``STAGES`` lists (name, function) in order. A function takes (spark, docs, sf_dir)
and returns the documents that stay, with the columns of ``docs``; the last one
returns one row per document as read back from the token files. ``run`` writes
each stage's rows as Parquet in the shared folder and reads them again, so a lost
executor never costs more than the stage it worked on.

Rows with null ids, texts, sources or languages, empty and very long texts,
repeated rows, empty tables and further columns are treated as each operator's
module states; no stage fails on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolith.llm import common as C
from aerolith.llm import decontam, mixing, near_dup, repetition, wavelet
from aerolith.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of near duplicates (five-word shingles,
    similarity of 0.8 and more)."""
    return near_dup.deduplicated(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.cleaned(docs, C.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights."""
    return mixing.sampled(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, written as wavelet-matrix files and read back."""
    return wavelet.token_files(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token output", token_output),
]

#: SQL has no suffix arrays and no tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
