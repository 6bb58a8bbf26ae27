"""Aggregates in Python with partial and final state, so that no group is ever gathered in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.shipping import ship

#: Parameter: keys whose states a task holds before it sends them on.
HELD = 50_000


class UserAggregate(Protocol):
    """State is an array of doubles of a length that does not grow with rows."""

    def reduce(self, rows: pd.DataFrame) -> np.ndarray:
        """The state of some rows of a key."""

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray: ...

    def finish(self, state: np.ndarray) -> Sequence:
        """The values of the result columns."""


def user_aggregate(df: DataFrame, keys: Sequence[str], columns: Sequence[str], how: UserAggregate, result: str) -> DataFrame:
    """keys and the result columns (a schema string) of each key.

    Each Arrow batch is reduced by key, a task merges the states of its
    batches and sends a row for each key; the rows of states are shuffled by
    key, sorted and merged one after another. So a key with a third of all
    rows costs each task one state, and memory is bounded by HELD states and
    a batch. Null keys form groups, as in Spark.
    """
    ship(df.sparkSession)
    keys, columns = list(keys), list(columns)
    key_types = [df.schema[k] for k in keys]
    partial_type = T.StructType([*key_types, T.StructField("state", T.ArrayType(T.DoubleType()))])
    out_type = T.StructType([*key_types, *T._parse_datatype_string(result).fields])

    def plain(k):
        return tuple(None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else v for v in (k if isinstance(k, tuple) else (k,)))

    def sent(held: dict) -> pd.DataFrame:
        out = pd.DataFrame(list(held), columns=keys, dtype=object)
        return out.assign(state=[s.tolist() for s in held.values()])

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}
        for f in frames:
            for k, rows in f.groupby(keys, dropna=False, sort=False):
                k, s = plain(k), how.reduce(rows[columns])
                held[k] = how.merge(held[k], s) if k in held else s
            if len(held) > HELD:
                yield sent(held)
                held = {}
        if held:
            yield sent(held)

    def final(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, done = None, None, []
        for f in frames:
            for *k, s in f.itertuples(index=False):
                k, s = plain(tuple(k)), np.asarray(s, float)
                if state is not None and k == key:
                    state = how.merge(state, s)
                    continue
                if state is not None:
                    done.append((*key, *how.finish(state)))
                key, state = k, s
            if len(done) > 4096:
                yield pd.DataFrame(done, columns=out_type.names, dtype=object)
                done = []
        if state is not None:
            done.append((*key, *how.finish(state)))
        if done:
            yield pd.DataFrame(done, columns=out_type.names, dtype=object)

    states = df.select(*keys, *columns).mapInPandas(partial, partial_type)
    return states.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(final, out_type)


class LeastSquares:
    """Coefficients of a linear fit of the first column on a constant and the others; rows with a null are left out.

    The state holds the count, the means and the centred cross products,
    which merge without loss where sums of raw products would cancel. A fit
    without a unique solution gives the one of least norm.
    """

    def __init__(self, width: int):
        self.width = width  # columns, with the first

    def reduce(self, rows: pd.DataFrame) -> np.ndarray:
        x = rows.dropna().to_numpy(float)
        if not len(x):
            return np.zeros(1 + self.width + self.width**2)
        mean = x.mean(axis=0)
        x = x - mean
        return np.concatenate([[len(x)], mean, (x.T @ x).ravel()])

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not a[0] or not b[0]:
            return a if a[0] else b
        w, n = self.width, a[0] + b[0]
        apart = b[1 : 1 + w] - a[1 : 1 + w]
        mean = a[1 : 1 + w] + apart * (b[0] / n)
        return np.concatenate([[n], mean, a[1 + w :] + b[1 + w :] + (np.outer(apart, apart) * (a[0] * b[0] / n)).ravel()])

    def finish(self, state: np.ndarray) -> Sequence:
        w = self.width
        if not state[0]:
            return [None] * w
        mean, products = state[1 : 1 + w], state[1 + w :].reshape(w, w)
        slope = np.linalg.lstsq(products[1:, 1:], products[1:, 0], rcond=None)[0]
        return [float(mean[0] - slope @ mean[1:]), *slope.tolist()]
