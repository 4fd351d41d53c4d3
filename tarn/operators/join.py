"""merge(): equi-joins and the cross join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tarn.frame import Frame


def merge(x: Frame, y: Frame, by="common", by_x=None, by_y=None, all_x: bool = False, all_y: bool = False, all_rows: bool = False, suffixes: tuple[str, str] = ("_x", "_y"), coalesce: bool = False) -> Frame:
    """Keys (with x's names and values), x's other columns, y's other columns; names in both get suffixes. by=None, or no
    common names: every pair of rows. Null keys match nothing. coalesce: rows of y alone have y's key values."""
    a, b = x.df, y.df
    if by_x is None and by_y is None:
        keys = [n for n in a.columns if n in b.columns] if by == "common" else [by] if isinstance(by, str) else list(by or [])
        by_x = by_y = keys
    by_x, by_y = ([k] if isinstance(k, str) else list(k) for k in (by_x, by_y))
    left = a.toDF(*[f"x{i}" for i in range(len(a.columns))])
    right = b.toDF(*[f"y{i}" for i in range(len(b.columns))])
    xi, yi = {n: f"x{i}" for i, n in enumerate(a.columns)}, {n: f"y{i}" for i, n in enumerate(b.columns)}
    if not by_x:
        both = left.crossJoin(right)
    else:
        how = "full" if all_rows or (all_x and all_y) else "left" if all_x else "right" if all_y else "inner"
        both = left.join(right, reduce(lambda p, q: p & q, [F.col(xi[k]) == F.col(yi[m]) for k, m in zip(by_x, by_y, strict=True)]), how)
    rest_x, rest_y = [n for n in a.columns if n not in by_x], [n for n in b.columns if n not in by_y]
    out = [(F.coalesce(xi[k], yi[m]) if coalesce else F.col(xi[k])).alias(k) for k, m in zip(by_x, by_y, strict=True)]
    taken = set(by_x)
    out += [F.col(xi[n]).alias(n + suffixes[0] if n in rest_y or n in taken else n) for n in rest_x]
    out += [F.col(yi[n]).alias(n + suffixes[1] if n in rest_x or n in taken else n) for n in rest_y]
    return Frame(both.select(*out), key=x.key if x.key in by_x or x.key in rest_x else None)
