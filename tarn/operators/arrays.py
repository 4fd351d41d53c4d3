"""Array columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.frame import Col, Frame


def array_of(x: Frame, *more, name: str = "agg_opr") -> Frame:
    """A row's columns, arrays (flattened) and constants as one array, of one type family."""
    parts = []
    for v in (x, *more):
        if isinstance(v, Frame):
            x.need_lineage(v)
            parts += [c.expr if isinstance(t, T.ArrayType) else F.array(c.expr) for c, t in zip(v.cols, v.types(), strict=True)]
        else:
            parts.append(F.array(F.lit(v)))
    return x._with([Col(name, F.concat(*parts))])


def length_of(x: Frame) -> list[int]:
    """Elements of each array column, from one row; 0 for others."""
    kinds = x.types()
    row = x._with(order=()).df.first()
    return [len(row[k]) if row is not None and isinstance(t, T.ArrayType) and row[k] is not None else 0 for k, t in enumerate(kinds)]


def expand(x: Frame) -> Frame:
    """Array columns as a column for each element, name[1]...; others unchanged."""
    out = []
    for c, n, t in zip(x.cols, length_of(x), x.types(), strict=True):
        out += [Col(f"{c.name}[{k + 1}]", F.try_element_at(c.expr, F.lit(k + 1))) for k in range(n)] if isinstance(t, T.ArrayType) else [c]
    return x._with(out)


def width(x: Frame) -> int:
    """Columns, counting array elements."""
    return sum(max(1, n) if not isinstance(t, T.ArrayType) else n for n, t in zip(length_of(x), x.types(), strict=True))


def collate(x: Frame, names: list[str], into: str) -> Frame:
    return x.assign(**{into: array_of(x.take(*names))})


def unnest(x: Frame) -> Frame:
    """A row for each element of the one array column: pos (from 1), value."""
    return Frame(x.df.select(F.posexplode(F.col(x.names[0])).alias("pos", "value")).withColumn("pos", F.col("pos") + 1))


def parse_array(text: str, kind=float) -> list:
    """Nested lists from braces text such as {1,2,{3,4}}."""
    import json
    import re

    def word(m):
        return m[0] if m[0] in ",{}" else json.dumps(None if m[0] == "NULL" else m[0].strip('"'))

    def conv(v):
        return [conv(u) for u in v] if isinstance(v, list) else None if v is None else kind(v)

    return conv(json.loads(re.sub(r'"[^"]*"|[^,{}]+|[{},]', word, text).replace("{", "[").replace("}", "]")))
