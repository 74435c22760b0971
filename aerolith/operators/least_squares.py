"""Regressions of many series at once from their sufficient statistics.

The rows of a series enter as ``z = (x, y)``; a task sums ``z zᵀ`` over the rows of
each series that it holds (Arrow batches, one matrix product per series and batch),
and a plain grouped sum adds these partial matrices up, position by position. From
there on only one small matrix per series moves, however many rows a series has.
Nested models (fewer columns of the same ``x``) are solved from submatrices of the
same sums, so an ablation reads the rows once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Solver = Callable[[np.ndarray], tuple[np.ndarray, float]]


def gram(rows: DataFrame, keys: Sequence[str], z: str) -> DataFrame:
    """Per key: ``gram``, the upper triangle (row by row) of the sum of ``z zᵀ``.
    Rows with a NULL vector, component or NaN are left out; all vectors of a key
    have one length."""
    schema = T.StructType([rows.schema[k] for k in keys]
                          + [T.StructField("part", T.ArrayType(T.DoubleType()))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index("_z")
            vectors = np.array(batch.column(at).to_pylist(), float)
            owners: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(batch.column(k).to_pylist() for k in range(at)))):
                owners.setdefault(key, []).append(i)
            first, sums = [], []
            for own in owners.values():
                part = vectors[own]
                first.append(own[0])
                sums.append((part.T @ part)[np.triu_indices(part.shape[1])])
            heads = batch.take(pa.array(first)).columns[:at]
            yield pa.RecordBatch.from_arrays(
                [*heads, pa.array([s.tolist() for s in sums], pa.list_(pa.float64()))],
                schema=pa.schema([*(batch.schema.field(k) for k in range(at)),
                                  pa.field("part", pa.list_(pa.float64()))]))

    whole = F.col(z).isNotNull() & F.forall(z, lambda v: v.isNotNull() & ~F.isnan(v))
    parts = rows.where(whole).select(*keys, F.col(z).alias("_z")).mapInArrow(partial, schema)
    sums = (parts.select(*keys, F.posexplode("part").alias("_pos", "_v"))
            .groupBy(*keys, "_pos").agg(F.sum("_v").alias("_v")))
    return sums.groupBy(*keys).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("_pos", "_v"))), lambda s: s["_v"]).alias("gram"))


def solved(grams: DataFrame, keys: Sequence[str], solvers: dict[str, Solver]) -> DataFrame:
    """Per key and model: ``model``, its coefficients ``beta`` and the residuals'
    standard deviation ``sigma``. A solver gets the whole matrix of ``(x, y)``."""
    schema = T.StructType([grams.schema[k] for k in keys] + [
        T.StructField("model", T.StringType()), T.StructField("beta", T.ArrayType(T.DoubleType())),
        T.StructField("sigma", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.num_columns - 1
            rows, names, betas, sigmas = [], [], [], []
            for i, values in enumerate(batch.column(at).to_pylist()):
                p = int((np.sqrt(8 * len(values) + 1) - 1) / 2)
                g = np.zeros((p, p))
                g[np.triu_indices(p)] = values
                g += np.triu(g, 1).T
                for name, solve in solvers.items():
                    beta, sigma = solve(g)
                    rows.append(i)
                    names.append(name)
                    betas.append(beta.tolist())
                    sigmas.append(float(sigma))
            heads = batch.take(pa.array(rows, pa.int64())).columns[:at]
            yield pa.RecordBatch.from_arrays(
                [*heads, pa.array(names, pa.string()), pa.array(betas, pa.list_(pa.float64())),
                 pa.array(sigmas, pa.float64())],
                schema=pa.schema([*(batch.schema.field(k) for k in range(at)),
                                  pa.field("model", pa.string()),
                                  pa.field("beta", pa.list_(pa.float64())),
                                  pa.field("sigma", pa.float64())]))

    return grams.mapInArrow(run, schema)


def dot(x: Column | str, beta: Column | str) -> Column:
    """The product of ``beta`` with as many leading entries of ``x``; NULL if one
    of these is."""
    x, beta = (F.col(c) if isinstance(c, str) else c for c in (x, beta))
    terms = F.zip_with(F.slice(x, F.lit(1), F.size(beta)), beta, lambda a, b: a * b)
    return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)
