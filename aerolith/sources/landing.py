"""Landed files with their provenance, and the records that cannot be read.

Landed JSON is read leniently: a record that is no JSON keeps its text in a column
of its own instead of stopping the job or turning into a row of NULLs. Every record
carries the file it came from (path, size and time of modification, from the scan's
metadata). Bad records go to a quarantine table; a landing ledger has one row per
file with its counts and a hash of its records that does not depend on their order,
so bronze can be reconciled with the files and a file that changed is noticed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import AIR_BRONZE

BAD = "_corrupt_record"
FILE = "fitxer"
_PROVENANCE = {FILE: "file_path", "bytes": "file_size", "modificat": "file_modification_time"}


class BadRecords(ValueError):
    """More landed records cannot be read than a refresh may leave out."""


def with_bad(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])


def read_air_landing(spark: SparkSession, path: str | Sequence[str],
                     multi_line: bool = True) -> DataFrame:
    """All landed air-quality records, good and bad, with their provenance. A cut
    array (``multi_line``) is one bad record with the file's text; in JSON Lines
    each line that is no JSON object is one."""
    raw = (spark.read.schema(with_bad(AIR_BRONZE))
           .option("multiLine", multi_line)
           .option("primitivesAsString", True)
           .option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", BAD)
           .json(path))
    return raw.select("*", *(F.col(f"_metadata.{m}").alias(c) for c, m in _PROVENANCE.items()))


def parse_records(texts: DataFrame, text: str, schema: T.StructType = AIR_BRONZE) -> DataFrame:
    """Records that landed as text in a column: the schema's columns and the bad
    text, the same way as from files; further columns stay."""
    parsed = F.from_json(F.col(text), with_bad(schema),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD,
                          "primitivesAsString": "true"})
    rest = [c for c in texts.columns if c != text]
    return texts.select(*rest, parsed.alias("_r")).select(*rest, "_r.*")


def is_bad() -> Column:
    return F.col(BAD).isNotNull()


def good(landed: DataFrame) -> DataFrame:
    return landed.where(~is_bad()).drop(BAD)


def quarantine(landed: DataFrame) -> DataFrame:
    """The bad records' texts and where they came from."""
    return landed.where(is_bad()).select(F.col(BAD).alias("registre"), *_PROVENANCE)


def ledger(landed: DataFrame) -> DataFrame:
    """One row per file: size, time, records, bad records and the records' hash (a
    sum over the records' hashes, so repeated records count and order does not)."""
    content = F.xxhash64(*(c for c in landed.columns if c not in _PROVENANCE))
    return landed.groupBy(*_PROVENANCE).agg(
        F.count(F.lit(1)).alias("registres"), F.count_if(is_bad()).alias("dolents"),
        F.sum(F.shiftrightunsigned(content, 24)).alias("empremta"))


def reconcile(landing: DataFrame, bronze: DataFrame) -> DataFrame:
    """Per file: its records, those that bronze holds, the bad ones and those left
    out by the selection (municipality, newest N). ``ok``: they add up."""
    held = bronze.groupBy(FILE).agg(F.count(F.lit(1)).alias("bronze"))
    both = landing.join(held, FILE, "full_outer").withColumns({
        c: F.coalesce(c, F.lit(0)) for c in ("registres", "dolents", "bronze")})
    left = F.col("registres") - F.col("dolents") - F.col("bronze")
    return both.select(FILE, "registres", "dolents", "bronze", left.alias("fora_seleccio"),
                       (left >= 0).alias("ok"))


def check_limit(spark: SparkSession, landing: DataFrame, most: int, quarantine_at: str) -> int:
    """The number of bad records; more than ``most`` stop the job, with the files
    that hold them in the message."""
    bad = int(landing.agg(F.coalesce(F.sum("dolents"), F.lit(0))).first()[0])
    if bad > most:
        worst = landing.where("dolents > 0").orderBy(F.desc("dolents"), FILE).limit(5).collect()
        raise BadRecords(f"{bad} landed records cannot be read ({most} allowed), kept in "
                         f"{quarantine_at}; in " + ", ".join(r[FILE] for r in worst))
    return bad
