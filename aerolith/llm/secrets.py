"""Secret scans by two character Markov models.

One model learns random strings, the other ordinary identifiers: first-order
transition counts, smoothed by each character's own frequency, over the alphabet
of keys. A run of at
least ``MIN_CHARS`` key characters is a secret if the log-likelihood ratio of the
two models is over ``MIN_RATIO`` a character. Labelled samples train them: random
are the strings that the fixed patterns find and generated digests, ordinary are
the other words of a bounded sample of documents (about ``TRAIN_DOCS``,
by hash). Scanning covers every document and its whole text.

Built from SQL expressions alone: matches come from ``regexp_extract_all``, and
their places from the lengths of the pieces that ``split`` leaves between them.

Fixed patterns, leftmost and non-overlapping per kind: ``assign``, ``access``,
``hex``. The models add spans of kind ``markov`` where no fixed span overlaps.
Places are code points, ends exclusive.

Defined results: null and empty texts have no spans; rows are scanned one by one
(repeated rows alike, null ids kept); an empty table gives an empty result; only
the id and text columns are read, whatever other columns are called.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm import common as C

# The patterns.
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_CHARS = 12

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_CHARS = 20
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+"
#: Natural logarithms a character by which random must be likelier.
MIN_RATIO = 0.8
#: Bounds of the labelled samples: documents, generated strings.
TRAIN_DOCS, TRAIN_RANDOM = 2000, 4096
#: Shortest words of the ordinary sample.
TRAIN_CHARS = 8
_SIZE = len(ALPHABET) + 1  # place 0 stands before the first character


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _placed(text: Column, matches: Column, pattern: str, kind: int) -> Column:
    """Each match as (start, kind, end, string)."""
    pieces = F.split(text, pattern, -1)
    start = lambda acc, x: acc["at"] + F.length(x["piece"])
    item = "struct<start:int,kind:int,end:int,part:string>"
    out = F.aggregate(
        F.arrays_zip(pieces.alias("piece"), matches.alias("part")),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{item}>").alias("out")),
        lambda acc, x: F.when(x["part"].isNull(), acc).otherwise(F.struct(
            (start(acc, x) + F.length(x["part"])).alias("at"),
            F.array_append(acc["out"], F.struct(
                start(acc, x).alias("start"), F.lit(kind).alias("kind"),
                (start(acc, x) + F.length(x["part"])).alias("end"),
                x["part"].alias("part"))).alias("out"))),
        lambda acc: acc["out"])
    return F.when(F.size(matches) > 0, out).otherwise(F.array().cast(f"array<{item}>"))


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the array columns ``assign``, ``access`` and ``hex``."""
    t = F.col(text)
    for k, (kind, pattern) in enumerate((("assign", ASSIGN), ("access", ACCESS), ("hex", HEX))):
        df = df.withColumn(f"_m_{kind}", _found(t, pattern)) \
            .withColumn(kind, _placed(t, F.col(f"_m_{kind}"), pattern, k)).drop(f"_m_{kind}")
    return df.withColumn("assign", F.filter("assign", lambda x: F.length(
        F.regexp_extract(x["part"], ASSIGN, 1)) >= ASSIGN_CHARS))


def labelled_samples(docs: DataFrame, text: str) -> DataFrame:
    """``(part, random)``: strings of both kinds, from a bounded sample."""
    spark = docs.sparkSession
    values = F.transform("assign", lambda x: F.regexp_extract(x["part"], ASSIGN, 1))
    matched = base_spans(docs, text).select(
        F.explode(F.concat(values, F.col("access.part"), F.col("hex.part"))).alias("part"),
        F.lit(True).alias("random"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), ACCESS, " "),
                            HEX, " ")
    plain = docs.select(F.explode(_found(rest, RUN % TRAIN_CHARS)).alias("part"),
                        F.lit(False).alias("random"))
    digest = F.sha2(F.concat(F.lit("random "), F.col("id").cast("string")), 256)
    made = spark.range(TRAIN_RANDOM).select(
        F.explode(F.array(digest, F.base64(F.unhex(digest)))).alias("part"),
        F.lit(True).alias("random"))
    return matched.union(plain).union(made)


def train(samples: DataFrame) -> list[float]:
    """The models' log-likelihood ratio of each transition, by
    ``previous * size + next``. A transition that a single string holds doesn't
    count, so that a secret among the ordinary words can't vouch for itself. Counts are summed by Spark; at most two
    numbers a transition reach the driver."""
    place = lambda s, i: F.expr(f"instr('{ALPHABET}', substring({s}, {i}, 1))")
    steps = samples.filter(F.length("part") > 0).select(
        "random", "part", F.explode(F.sequence(F.lit(1), F.length("part"))).alias("i"))
    counts = (steps.select("random", "part", F.when(F.col("i") == 1, 0).otherwise(
        place("part", "i - 1")).alias("a"), place("part", "i").alias("b"))
        .filter("b > 0").groupBy("random", "a", "b")
        .agg(F.count("*").alias("count"), F.count_distinct("part").alias("strings"))
        .filter("strings > 1").collect())
    table = {True: {}, False: {}}
    rows = {True: {}, False: {}}
    single = {True: {}, False: {}}
    for r in counts:
        table[r.random][r.a, r.b] = r["count"]
        for sums, key in ((rows, r.a), (single, r.b)):
            sums[r.random][key] = sums[r.random].get(key, 0) + r["count"]
    size = len(ALPHABET)
    total = {kind: sum(single[kind].values()) for kind in single}

    def log_p(kind: bool, a: int, b: int) -> float:
        alone = (single[kind].get(b, 0) + 0.5) / (total[kind] + 0.5 * size)
        return math.log((table[kind].get((a, b), 0) + 0.5 * size * alone)
                        / (rows[kind].get(a, 0) + 0.5 * size))

    return [log_p(True, a, b) - log_p(False, a, b) if b else 0.0
            for a in range(_SIZE) for b in range(_SIZE)]


def ratio(part: Column, table: Column) -> Column:
    """A string's log-likelihood ratio a character."""
    place = lambda c: F.call_function("instr", F.lit(ALPHABET), c)
    score = F.aggregate(
        F.split(part, ""), F.struct(F.lit(0).alias("a"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(
            place(c).alias("a"),
            (acc["sum"] + F.get(table, acc["a"] * _SIZE + place(c))).alias("sum")),
        lambda acc: acc["sum"])
    return score / F.length(part)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         model: list[float] | None = None) -> DataFrame:
    """The id and the spans of each kind, as arrays of (start, kind, end, part).

    Without ``model`` (of ``train``) it is trained from the documents."""
    texts = docs.select(F.col(id_col).alias("_id"),
                        F.coalesce(text_col, F.lit("")).alias("_text"))
    if model is None:
        sample = C.hash_sample(texts, TRAIN_DOCS, texts.count()).select("_text")
        model = train(labelled_samples(sample, "_text"))
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    pattern = RUN % MIN_CHARS
    runs = _placed(F.col("_text"), F.col("_runs"), pattern, 3)
    base = F.concat("assign", "access", "hex")
    free = lambda x: ~F.exists("_base", lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"]))
    return (base_spans(texts, "_text").withColumn("_base", base)
            .withColumn("_runs", _found(F.col("_text"), pattern))
            .withColumn("_runs", F.filter(runs, lambda x: free(x)))
            .withColumn("markov", F.filter("_runs", lambda x: ratio(x["part"], table) > MIN_RATIO))
            .select(F.col("_id").alias(id_col), "assign", "access", "hex", "markov"))


def listed(*kinds: str) -> Column:
    """Spans as ``kind:start:end``, by start and then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(F.concat(*kinds)), lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"], x["end"])), ",")
