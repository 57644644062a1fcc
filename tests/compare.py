"""Comparison of two result tables whose rows may come in any order."""

from __future__ import annotations

import pandas as pd


def _plain(df: pd.DataFrame) -> list[tuple]:
    def value(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        return x.isoformat() if isinstance(x, pd.Timestamp) else x

    df = df[sorted(df.columns)]
    rows = [tuple(value(x) for x in row) for row in df.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """None if both hold the same columns and rows, else what differs first."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    kinds = {
        c: (actual[c].dtype, expected[c].dtype)
        for c in actual.columns
        if not (actual[c].isna().any() or expected[c].isna().any())  # nulls change pandas' types
        and (actual[c].dtype.kind != expected[c].dtype.kind or actual[c].dtype.itemsize != expected[c].dtype.itemsize)
    }
    a, b = _plain(actual), _plain(expected)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0]}"
    return f"types {kinds}" if kinds else None
