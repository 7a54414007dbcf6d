"""Ratcliff/Obershelp likeness of many pairs of strings at once, in numpy."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Longer strings are compared one by one; there are few, and the library's own rules for long texts hold for them.
LONGEST = 64
#: Stretches compared together.
TOGETHER = 8192


def _longest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start in a, start in b, length) of each row pair's longest common stretch, the earliest in a, then in b."""
    n, width = b.shape
    best, end_a, end_b = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    run, rows = np.zeros((n, width + 1), np.int16), np.arange(n)
    for i in range(a.shape[1]):
        run[:, 1:] = np.where(a[:, i : i + 1] == b, run[:, :-1] + 1, 0)
        at = run.argmax(1)
        size = run[rows, at]
        longer = size > best
        best[longer], end_a[longer], end_b[longer] = size[longer], i + 1, at[longer]
    return end_a - best, end_b - best, best


def _cut(texts: np.ndarray, which: np.ndarray, low: np.ndarray, high: np.ndarray, beyond: int) -> np.ndarray:
    at = low[:, None] + np.arange(int((high - low).max()))
    return np.where(at < high[:, None], texts[which[:, None], np.minimum(at, texts.shape[1] - 1)], beyond)


def _matched(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Letters in the matching stretches of each pair: the longest one, then what is left and right of it, round by round."""
    out, zero = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    work = np.stack([np.arange(len(a)), zero, size_a, zero, size_b], 1)
    while len(work):
        work = work[np.argsort((work[:, 2] - work[:, 1]) * (work[:, 4] - work[:, 3]), kind="stable")]
        more = []
        for k in range(0, len(work), TOGETHER):
            pair, a_low, a_high, b_low, b_high = work[k : k + TOGETHER].T
            x, y, n = _longest(_cut(a, pair, a_low, a_high, -1), _cut(b, pair, b_low, b_high, -2))
            np.add.at(out, pair, n)
            x, y = x + a_low, y + b_low
            both = np.concatenate([np.stack([pair, a_low, x, b_low, y], 1), np.stack([pair, x + n, a_high, y + n, b_high], 1)])
            open_ = (np.concatenate([n, n]) > 0) & (both[:, 1] < both[:, 2]) & (both[:, 3] < both[:, 4])
            more.append(both[open_])
        work = np.concatenate(more)
    return out


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(t) for t in texts], np.int64)
    out = np.zeros((len(texts), max(int(size.max(initial=1)), 1)), np.int32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    out[np.repeat(np.arange(len(texts)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out, size


def ratios(pairs: list[tuple[str, str]]) -> np.ndarray:
    """2 * matched letters / all letters of each pair."""
    out = np.zeros(len(pairs))
    short = [i for i, (x, y) in enumerate(pairs) if len(x) <= LONGEST and len(y) <= LONGEST]
    a, size_a = _codes([pairs[i][0] for i in short])
    b, size_b = _codes([pairs[i][1] for i in short])
    out[short] = 2.0 * _matched(a, b, size_a, size_b) / np.maximum(size_a + size_b, 1)
    for i in set(range(len(pairs))) - set(short):
        out[i] = SequenceMatcher(None, *pairs[i]).ratio()
    return out


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp likeness of two strings, case folded; 0 if one is empty or null. A batch's distinct pairs are compared together."""
    folded = [(x.casefold(), y.casefold()) if x and y else None for x, y in zip(a, b, strict=True)]
    kinds = sorted({p for p in folded if p})
    known = dict(zip(kinds, ratios(kinds).tolist(), strict=True)) if kinds else {}
    return pd.Series([known[p] if p else 0.0 for p in folded], dtype=float)
