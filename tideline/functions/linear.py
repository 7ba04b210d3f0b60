"""Least squares from cross products.

A regression per state needs only the cross products of its columns. Spark sums those; what is
solved in Python is one k x k system per state, a batch of states at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The functions travel inside the UDFs, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SOLVE_FLOOR = 1e-9
# As objects, because type names can only be parsed once a session exists.
DOUBLE = T.DoubleType()
DOUBLES = T.ArrayType(DOUBLE)


def gram_columns(columns: Sequence[Column]) -> list[tuple[Column, Column]]:
    """Pairs of columns in the order of the upper triangle, row by row."""
    return list(combinations_with_replacement(columns, 2))


def gram_sums(columns: Sequence[Column]) -> Column:
    """Aggregate: cross products of the columns as an array (upper triangle)."""
    return F.array(*[F.sum(a * b) for a, b in gram_columns(columns)])


def unpack(grams: pd.Series, size: int) -> np.ndarray:
    """Stack of symmetric matrices from their upper triangles."""
    upper = np.stack([np.asarray(g, dtype=float) for g in grams])
    rows, cols = np.triu_indices(size)
    full = np.zeros((len(upper), size, size))
    full[:, rows, cols] = upper
    full[:, cols, rows] = upper
    return full


def summed_grams(rows: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 build: Callable[[pd.DataFrame], np.ndarray], width: int) -> DataFrame:
    """``gram`` per key: cross products of the ``width`` columns that ``build`` makes of the rows.

    Tasks read rows in runs of one key and emit one matrix per run, whatever its length. The
    matrices, not the rows, are shuffled, and added up entry by entry, however many runs a key
    comes in.
    """
    keys = list(keys)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(width)
        key, gram = None, None
        for batch in batches:
            done = []
            full = build(batch)
            own = list(zip(*[batch[name].tolist() for name in keys]))
            ends = [*(i for i in range(1, len(own)) if own[i] != own[i - 1]), len(own)]
            for start, end in zip([0, *ends], ends):
                if start == end:
                    continue
                run = full[start:end].T @ full[start:end]
                if own[start] == key:
                    gram += run
                    continue
                if gram is not None:
                    done.append((*key, gram[upper]))
                key, gram = own[start], run
            yield pd.DataFrame(done, columns=[*keys, "gram"])
        if gram is not None:
            yield pd.DataFrame([(*key, gram[upper])], columns=[*keys, "gram"])

    schema = T.StructType([*[rows.schema[name] for name in keys], T.StructField("gram", DOUBLES)])
    parts = rows.select(*keys, *columns).mapInPandas(partial, schema)
    entries = parts.repartition(*keys).select(*keys, F.posexplode("gram").alias("i", "x"))
    sums = entries.groupBy(*keys, "i").agg(F.sum("x").alias("x"))
    whole = F.array_sort(F.collect_list(F.struct("i", "x")))
    return sums.groupBy(*keys).agg(F.transform(whole, lambda e: e["x"]).alias("gram"))


def solve_subset(full: np.ndarray, keep: Sequence[int], penalty: np.ndarray) -> np.ndarray:
    """Coefficients of the last column on the ``keep`` columns, for every matrix of the stack.

    A column that never varies has a zero diagonal; a tiny floor there gives it weight 0.
    """
    keep = np.asarray(keep, dtype=int)
    left = full[:, keep[:, None], keep[None, :]] + np.diag(penalty)
    diagonal = np.einsum("nii->ni", left)
    diagonal += SOLVE_FLOOR * np.maximum(diagonal.max(axis=1, keepdims=True), SOLVE_FLOOR) * (
        diagonal <= 0
    )
    return solve_each(left, full[:, keep, -1])


def solve_each(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solutions of a stack of systems; NaN where one is not finite or singular.

    A bad series must not stop the others of its batch, so it is left out and keeps its NaN. Columns
    are first put in units of a power of two near their size, which changes no digit by itself but
    keeps amounts of different sizes from losing digits to each other.
    """
    out = np.full(right.shape, np.nan)
    good = np.isfinite(left).all(axis=(1, 2)) & np.isfinite(right).all(axis=1)
    size = np.sqrt(np.abs(np.einsum("nii->ni", left)))
    with np.errstate(all="ignore"):
        unit = np.exp2(-np.round(np.log2(size)))
    unit = np.where(np.isfinite(unit) & (unit > 0), unit, 1.0)
    left, right = left * unit[:, :, None] * unit[:, None, :], right * unit
    try:
        out[good] = np.linalg.solve(left[good], right[good][:, :, None])[:, :, 0]
    except np.linalg.LinAlgError:
        for i in np.flatnonzero(good):
            try:
                out[i] = np.linalg.solve(left[i], right[i])
            except np.linalg.LinAlgError:
                continue
    return out * unit


def solve_gram(k: int, penalty: Sequence[float]) -> Callable[[str], Column]:
    """Pandas UDF: ridge coefficients from the cross products of k regressors and the target."""
    weights = np.asarray(penalty, dtype=float)

    @F.pandas_udf(DOUBLES)
    def solve(grams: pd.Series) -> pd.Series:
        return pd.Series(list(solve_subset(unpack(grams, k + 1), range(k), weights)))

    return solve
