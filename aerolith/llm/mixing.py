"""Mixing sources to target weights by iterative proportional fitting.

The tokens of each (source, language, topic) cell are the start weights. Each
sweep scales the cells so that the sources' shares meet their targets, then the
languages', then the topics'; sweeps converge to the weights nearest to the
start that meet all three. A document's probability is its cell's weight over the
cell's tokens, scaled so that the largest is 1; the draw is a hash of the id, so
a repeated task draws alike and the expected tokens meet every target.

Built from DataFrame operations alone: sums per marginal are combined before the
shuffle, cells are few against documents, and documents meet their cell by a
broadcast if the cells were counted to be few, else by a shuffle join (AQE
splits the hot ones). The fit is written to the shared folder after every sweep,
which also keeps its plan small.

Targets default to each category's share of tokens raised to ``flatten`` (1 keeps
the mix, 0 makes it even). The tables have no topic column: unless ``topic`` is
given, it is the text's form (tabular, marked up, long or short prose).

Defined results: a null or missing category is one of its own, named ``(none)``;
null and empty texts have 0 tokens and the probability of their cell, or 0 in a
cell without tokens; a null id draws by its text; repeated rows draw alike; an
empty table gives an empty result. ``mix``'s result columns replace input columns
of the same names; all other columns, and all of ``sampled``, pass unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm import common as C

SWEEPS = 10
#: Exponents of the default targets.
FLATTEN = {"source": 0.7, "lang": 0.7, "topic": 0.9}
NONE = "(none)"
_WORD = r"[^\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD)).cast("long")


def form(text: Column, tokens: Column) -> Column:
    """The default topic: what a text's signs and length say about its form."""
    t = F.coalesce(text, F.lit(""))
    signs = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    return (F.when(10 * signs("|") >= F.greatest(tokens, F.lit(1)), "table")
            .when(10 * signs("#*$%") >= F.greatest(tokens, F.lit(1)), "markup")
            .when(tokens >= 1000, "long").otherwise("short"))


def draw(id_col: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on the id (or, without one, the text)."""
    key = F.coalesce(id_col.cast("string"), text, F.lit(""))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(2.0 ** 52)


def default_targets(cells: DataFrame, dim: str, flatten: float) -> DataFrame:
    by = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), F.lit(flatten)).alias("_t"))
    return by.crossJoin(F.broadcast(by.agg(F.sum("_t").alias("_all")))) \
        .select(dim, F.try_divide("_t", "_all").alias("target"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (with ``tokens``) and their fitted ``weight``; every dimension
    has a target table ``(dimension, target)``."""
    w = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dim, target in targets.items():
        w = w.join(target.withColumnRenamed("target", f"_t_{dim}"), dim, "left")
    w = C.stored(w, "rake")
    for _ in range(sweeps):
        for dim in targets:
            total = w.groupBy(dim).agg(F.sum("weight").alias("_sum"))
            w = (w.join(total, dim)
                 .withColumn("weight", F.coalesce(F.try_divide(
                     F.col("weight") * F.coalesce(f"_t_{dim}", F.lit(0.0)), F.col("_sum")),
                     F.lit(0.0))).drop("_sum"))
        w = C.stored(w, "rake")
    return w.drop(*(f"_t_{dim}" for dim in targets))


def _prefix(docs: DataFrame) -> str:
    """Begins the names of the columns added meanwhile; no column of ``docs`` has it."""
    prefix = "__mix_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix


def _drawn(docs: DataFrame, targets: Mapping[str, DataFrame] | None, id_col: str, text_col: str,
           topic: Column | None, sweeps: int) -> DataFrame:
    """``docs`` with the columns of the category, tokens and draw, named by ``_prefix``."""
    own = _prefix(docs)
    category = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE)) \
        if c in docs.columns else F.lit(NONE)
    dims = {dim: f"{own}{dim}" for dim in FLATTEN}
    keyed = docs.withColumn(f"{own}tokens", n_tokens(F.col(text_col)))
    about = topic if topic is not None else form(F.col(text_col), F.col(f"{own}tokens"))
    keyed = (keyed.withColumn(f"{own}topic", F.coalesce(about, F.lit(NONE)))
             .withColumn(f"{own}source", category("source"))
             .withColumn(f"{own}lang", category("lang")))
    cells = C.stored(keyed.groupBy(*(F.col(c).alias(dim) for dim, c in dims.items()))
                     .agg(F.sum(f"{own}tokens").alias("tokens")), "cells")
    goal = {dim: (targets or {}).get(dim) for dim in FLATTEN}
    goal = {dim: g if g is not None else default_targets(cells, dim, FLATTEN[dim])
            for dim, g in goal.items()}
    fit = rake(cells, goal, sweeps).withColumn(
        "rate", F.coalesce(F.try_divide("weight", "tokens"), F.lit(0.0)))
    top = fit.agg(F.max("rate").alias("top"))
    fit = C.stored(fit.crossJoin(F.broadcast(top)).select(
        *(F.col(dim).alias(c) for dim, c in dims.items()),
        F.round(F.coalesce(F.try_divide("rate", "top"), F.lit(0.0)), 9).alias(f"{own}p")), "fit")
    return keyed.join(C.few(fit), list(dims.values())).withColumn(
        f"{own}kept", draw(F.col(id_col), F.col(text_col)) < F.col(f"{own}p"))


def mix(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None,
        id_col: str = "doc_id", text_col: str = "text", topic: Column | None = None,
        sweeps: int = SWEEPS) -> DataFrame:
    """The documents with ``topic``, ``n_tokens``, ``probability`` and ``kept``.

    ``targets`` gives target tables for some of source, lang and topic."""
    own = _prefix(docs)
    out = _drawn(docs, targets, id_col, text_col, topic, sweeps)
    for name, short in (("topic", "topic"), ("n_tokens", "tokens"), ("probability", "p"),
                        ("kept", "kept")):
        out = out.withColumn(name, F.col(f"{own}{short}"))
    return out.drop(*(c for c in out.columns if c.startswith(own)))


def sampled(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None,
            id_col: str = "doc_id", text_col: str = "text", topic: Column | None = None,
            sweeps: int = SWEEPS) -> DataFrame:
    """The documents that are drawn, with all their columns as they were."""
    return _drawn(docs, targets, id_col, text_col, topic, sweeps).filter(F.col(f"{_prefix(docs)}kept")) \
        .select(docs.columns)


def oracle_sql(sweeps: int = SWEEPS) -> str:
    """The same fit and draw in DuckDB, one step of a sweep per table."""
    steps, last = [], "w0"
    for k in range(sweeps):
        for dim in FLATTEN:
            name = f"w{k + 1}_{dim}"
            steps.append(f"""{name} as materialized (select * replace (coalesce(weight * t_{dim}
              / nullif(sum(weight) over (partition by {dim}), 0), 0) as weight) from {last})""")
            last = name
    targets = ", ".join(f"""t_{d} as (select {d}, pow(sum(tokens)::double, {f}) as p,
      p / nullif(sum(p) over (), 0) as t_{d} from cells group by {d})""" for d, f in FLATTEN.items())
    signs = lambda chars: f"length(t) - length(translate(t, '{chars}', ''))"
    return rf"""
with d0 as (select *, coalesce(text, '') as t,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as n_tokens,
    coalesce(source, '{NONE}') as source_, coalesce(lang, '{NONE}') as lang_ from documents),
d as (select *, case when 10 * ({signs('|')}) >= greatest(n_tokens, 1) then 'table'
    when 10 * ({signs('#*$%')}) >= greatest(n_tokens, 1) then 'markup'
    when n_tokens >= 1000 then 'long' else 'short' end as topic from d0),
cells as (select source_ as source, lang_ as lang, topic, sum(n_tokens)::bigint as tokens from d
    group by all),
{targets},
w0 as materialized (select cells.*, tokens::double as weight, t_source, t_lang, t_topic from cells
    join t_source using (source) join t_lang using (lang) join t_topic using (topic)),
{', '.join(steps)},
r as (select source, lang, topic, coalesce(weight / nullif(tokens, 0), 0) as rate from {last}),
p as (select *, round(coalesce(rate / nullif(max(rate) over (), 0), 0), 9) as probability from r)
select d.doc_id, d.source, d.lang, d.topic, d.n_tokens, p.probability,
    ('0x' || md5(d.doc_id::varchar)[1:13])::bigint / 4503599627370496.0 < p.probability as kept
from d join p on d.source_ = p.source and d.lang_ = p.lang and d.topic = p.topic"""
