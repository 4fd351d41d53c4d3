"""Aggregates of frames, grouping, distinct rows. Several aggregates of one frame are one scan."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.frame import TIME, Col, Frame


def _agg(x: Frame, name: str, fn, kinds, empty: str = "double") -> Frame:
    out = []
    for c, t in zip(x.cols, x.types(), strict=True):
        if isinstance(t, T.ArrayType) and name != "array_agg" and name != "count":
            n = (x.source.select(F.size(c.expr)).filter(c.expr.isNotNull()).first() or [0])[0]
            e = F.array(*[fn(F.try_element_at(c.expr, F.lit(k + 1))) for k in range(n)])
        else:
            own = c.expr.cast("int") if isinstance(t, T.BooleanType) and T.BooleanType in kinds and name not in ("count", "array_agg") else c.expr
            e = fn(own) if isinstance(t, tuple(kinds)) else F.lit(None).cast(empty)
        out.append(Col(f"{c.name}_{name}", e))
    return x._with(out, agg=True, order=())


_NUM = (T.NumericType, T.BooleanType)


def mean(x): return _agg(x, "avg", lambda e: F.avg(e.cast("double")), _NUM)  # noqa: E704
def total(x): return _agg(x, "sum", F.sum, _NUM)  # noqa: E704
def count(x): return _agg(x, "count", F.count, (T.DataType,))  # noqa: E704
def largest(x): return _agg(x, "max", F.max, (T.NumericType, *TIME))  # noqa: E704
def smallest(x): return _agg(x, "min", F.min, (T.NumericType, *TIME))  # noqa: E704
def sd(x): return _agg(x, "stddev", F.stddev_samp, _NUM)  # noqa: E704
def var(x): return _agg(x, "variance", F.var_samp, _NUM)  # noqa: E704


col_means, col_sums = mean, total


def col_agg(x: Frame) -> Frame:
    """All values of each column as an array, nulls too, in ascending order."""
    return _agg(x, "array_agg", lambda e: F.transform(F.array_sort(F.collect_list(F.struct(e.alias("v")))), lambda s: s["v"]), (T.DataType,))


def by(x: Frame, indices, fn):
    """fn of each group of equal keys (null keys make a group). If fn gives an aggregate frame: one grouped query of
    keys and aggregates. If it gives another frame: keys and columns, distinct. Else: a list of (key values, result)."""
    if indices is None:
        return fn(x)
    keys = []
    for k in indices if isinstance(indices, (list, tuple)) else [indices]:
        k = x.col(k) if isinstance(k, str) else k
        x.need_lineage(k)
        keys += [c for c in k.cols if not any(c.name == o.name for o in keys)]
    first = fn(x)
    if isinstance(first, Frame):
        own = [c for c in first.cols if not any(c.name == k.name for k in keys)] if not first.agg else first.cols
        out = x._with(own, agg=first.agg, keys=tuple(keys), order=())
        return Frame(out.df)
    out = []
    kinds = [k.expr.alias(k.name) for k in keys]
    for row in x.source.select(*kinds).distinct().toLocalIterator():
        cond = None
        for k, v in zip(keys, row, strict=True):
            c = k.expr.isNull() if v is None else k.expr.eqNullSafe(F.lit(v))
            cond = c if cond is None else cond & c
        out.append((tuple(row), fn(x._with(where=cond if x.where is None else x.where & cond))))
    return out


def unique(x: Frame) -> Frame:
    if len(x.cols) != 1:
        raise ValueError("unique() takes one column")
    return Frame(x._with(order=()).df.distinct())
