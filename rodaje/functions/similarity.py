"""String distances the JVM has no function for, computed for whole Arrow batches at once.

Texts become rows of a matrix of characters, so each step of a distance's recurrence is one operation over all pairs of the
batch. Equal pairs are computed once. A null on either side gives null.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cells held at once; longer texts are taken in smaller groups.
_CELLS = 1 << 24


def _matrix(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters, padded with zeros, and lengths. Characters are moved up by one, so that no text holds the padding."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    out = np.zeros((len(texts), int(sizes.max(initial=0))), dtype=np.uint32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32) + 1
    return out, sizes


def _batched(of: Callable[..., np.ndarray], a: pd.Series, b: pd.Series) -> np.ndarray:
    """One value per pair, NaN for nulls; pairs are sorted by length, so that a group's matrix has little padding."""
    pairs = pd.DataFrame({"a": a.to_numpy(dtype=object), "b": b.to_numpy(dtype=object)})
    out = np.full(len(pairs), np.nan)
    known = np.flatnonzero((pairs["a"].notna() & pairs["b"].notna()).to_numpy())
    if not len(known):
        return out
    codes = pairs.iloc[known].groupby(["a", "b"], sort=False).ngroup().to_numpy()
    first = np.unique(codes, return_index=True)[1]
    x, y = (pairs[c].to_numpy()[known[first]].tolist() for c in ("a", "b"))
    size = np.array([max(len(p), len(q)) + 2 for p, q in zip(x, y)])
    order = np.argsort(size, kind="stable")
    value = np.empty(len(order))
    i = len(order)
    while i > 0:
        n = max(1, int(_CELLS // size[order[i - 1]] ** 2))
        take = order[max(0, i - n) : i]
        value[take] = of(*_matrix([x[t] for t in take]), *_matrix([y[t] for t in take]))
        i -= len(take)
    out[known] = value[codes]
    return out


def _jaro_winkler(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    reach = np.maximum(0, np.maximum(la, lb) // 2 - 1)[:, None]
    place = np.arange(b.shape[1])
    taken = np.zeros(b.shape, dtype=bool)
    mine = np.zeros(a.shape, dtype=bool)
    every = np.arange(len(a))
    for i in range(a.shape[1]):
        # The first free equal character within reach.
        ok = (b == a[:, i, None]) & (a[:, i, None] > 0) & ~taken & (place >= i - reach) & (place <= i + reach)
        mine[:, i] = ok.any(axis=1)
        hit = every[mine[:, i]]
        taken[hit, ok[hit].argmax(axis=1)] = True
    m = mine.sum(axis=1)
    front = lambda c, flag: np.take_along_axis(c, np.argsort(~flag, axis=1, kind="stable"), axis=1)
    width = min(a.shape[1], b.shape[1])
    moved = (front(a, mine)[:, :width] != front(b, taken)[:, :width]) & (np.arange(width) < m[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - moved.sum(axis=1) // 2) / m) / 3, 0.0)
    head = min(4, width)
    prefix = np.cumprod((a[:, :head] == b[:, :head]) & (a[:, :head] > 0), axis=1).sum(axis=1)
    out = np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)
    return np.where((la == 0) & (lb == 0), 1.0, out)


def _swaps(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Edits with swaps of neighbours, no part edited twice."""
    row = np.tile(np.arange(b.shape[1] + 1), (len(a), 1))
    out = np.where(la == 0, lb, 0)
    before = last = row
    for i in range(1, a.shape[1] + 1):
        before, last, row = row, before, np.empty_like(row)
        row[:, 0] = i
        differ = b != a[:, i - 1, None]
        swap = (b[:, :-1] == a[:, i - 1, None]) & (b[:, 1:] == a[:, i - 2, None]) if i > 1 else None
        for j in range(1, b.shape[1] + 1):
            best = np.minimum(np.minimum(before[:, j], row[:, j - 1]) + 1, before[:, j - 1] + differ[:, j - 1])
            if swap is not None and j > 1:
                best = np.where(swap[:, j - 2], np.minimum(best, last[:, j - 2] + 1), best)
            row[:, j] = best
        done = la == i
        out[done] = row[done, lb[done]]
    return out


def _damerau(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Edits with swaps of neighbours, whatever is edited between them."""
    n, w, h = len(a), a.shape[1], b.shape[1]
    every = np.arange(n)
    far = int(la.max(initial=0) + lb.max(initial=0)) + 1
    grid = np.full((n, w + 2, h + 2), far, dtype=np.int32)
    grid[:, 1:, 1] = np.arange(w + 1)
    grid[:, 1, 1:] = np.arange(h + 1)
    seen = np.zeros((n, h), dtype=np.int64)  # per character of b, its last place in a
    for i in range(1, w + 1):
        at = np.zeros(n, dtype=np.int64)
        for j in range(1, h + 1):
            r, c = seen[:, j - 1], at
            equal = b[:, j - 1] == a[:, i - 1]
            best = np.minimum(np.minimum(grid[:, i, j + 1], grid[:, i + 1, j]) + 1, grid[:, i, j] + ~equal)
            grid[:, i + 1, j + 1] = np.minimum(best, grid[every, r, c] + (i - r - 1) + 1 + (j - c - 1))
            at = np.where(equal, j, at)
        seen = np.where(b == a[:, i - 1, None], i, seen)
    return grid[every, la + 1, lb + 1]


def _common_subsequence(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    row = np.zeros((len(a), b.shape[1] + 1), dtype=np.int32)
    for i in range(a.shape[1]):
        before = row
        equal = (b == a[:, i, None]) & (a[:, i, None] > 0)
        # Best so far: extended where equal, carried along the row.
        row = np.zeros_like(before)
        row[:, 1:] = np.maximum.accumulate(np.where(equal, before[:, :-1] + 1, before[:, 1:]), axis=1)
    return row[:, -1] if row.shape[1] else np.zeros(len(a))


def _token_sort(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    both = la + lb
    return np.where(both == 0, 100.0, 200.0 * _common_subsequence(a, la, b, lb) / np.maximum(both, 1))


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(_batched(_jaro_winkler, a, b))


@F.pandas_udf(T.IntegerType())
def damerau_levenshtein(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(_batched(_damerau, a, b)).astype("Int32")


@F.pandas_udf(T.IntegerType())
def swap_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(_batched(_swaps, a, b)).astype("Int32")


@F.pandas_udf(T.DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two texts' sorted words, from 0 to 100."""
    ordered = lambda s: s.map(lambda t: " ".join(sorted(t.split())), na_action="ignore")
    return pd.Series(_batched(_token_sort, ordered(a), ordered(b)))


def swap_distances(words: list[str], name: str) -> np.ndarray:
    """Restricted edits with swaps between each word and a name, on the driver or in a worker."""
    return _batched(_swaps, pd.Series(words, dtype=object), pd.Series([name] * len(words), dtype=object))
