"""The lazy frame: a base DataFrame, a predicate, named column expressions, a sort order.

Nothing runs until rows are asked for. Two frames combine element-wise only if they have the same base and
equivalent predicates; anything across relations goes through merge(). Factors are column metadata."""

from __future__ import annotations

import operator
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.NumericType,)
TIME = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType, T.YearMonthIntervalType)


@dataclass(frozen=True)
class Meta:
    """Of a factor: the reference level (None: the smallest)."""

    factor: bool = False
    reference: str | None = None


@dataclass(frozen=True)
class Col:
    name: str
    expr: Column
    meta: Meta = field(default_factory=Meta)


class LineageError(ValueError):
    pass


class Frame:
    __hash__ = None

    def __init__(self, base: DataFrame, cols: list[Col] | None = None, where: Column | None = None, order: tuple = (), key: str | None = None, agg: bool = False, keys: tuple[Col, ...] = (), name: str | None = None):
        self.base, self.where, self.order, self.key, self.agg, self.keys, self.name = base, where, tuple(order), key, agg, tuple(keys), name
        self.cols = [Col(c, F.col(f"`{c}`")) for c in base.columns] if cols is None else list(cols)

    # ---- state

    def _with(self, cols: list[Col] | None = None, **changes) -> Frame:
        state = {"where": self.where, "order": self.order, "key": self.key, "agg": self.agg, "keys": self.keys} | changes
        return Frame(self.base, self.cols if cols is None else cols, **state)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.cols]

    columns = names

    def rename(self, names: list[str]) -> Frame:
        if len(names) != len(self.cols):
            raise ValueError("one name for each column")
        return self._with([replace(c, name=n) for c, n in zip(self.cols, names, strict=True)])

    def alias(self, name: str) -> Frame:
        return self.rename([name])

    @property
    def source(self) -> DataFrame:
        return self.base if self.where is None else self.base.filter(self.where)

    @property
    def df(self) -> DataFrame:
        """The query as a DataFrame."""
        d = self.source
        own = [c.expr.alias(c.name) for c in self.cols]
        if self.agg or self.keys:
            keys = [k.expr.alias(k.name) for k in self.keys]
            if not self.agg:
                return d.select(*keys, *own).distinct()
            return d.groupBy(*keys).agg(*own) if keys else d.agg(*own)
        if self.order:
            d = d.orderBy(*self.order)
        return d.select(*own)

    @property
    def schema(self) -> T.StructType:
        return self.df.schema

    def types(self) -> list[T.DataType]:
        d = self.source
        return [f.dataType for f in (d.agg(*[c.expr.alias(f"c{i}") for i, c in enumerate(self.cols)]) if self.agg else d.select(*[c.expr.alias(f"c{i}") for i, c in enumerate(self.cols)])).schema.fields]

    def col_types(self) -> list[str]:
        return [t.simpleString() for t in self.types()]

    def content(self) -> str:
        """The analysed plan as text."""
        return self.df._jdf.queryExecution().analyzed().toString()

    def dim(self) -> tuple[int, int]:
        if not hasattr(self, "_dim"):
            self._dim = (self.df.count(), len(self.df.columns))
        return self._dim

    def root(self) -> Frame:
        """A new lineage that starts at this query."""
        return Frame(self.df, key=self.key if self.key in self.df.columns else None)

    def __repr__(self) -> str:
        kind = "aggregate" if self.agg else "query"
        return f"<{kind} of {len(self.cols)} column(s): {', '.join(f'{n} {t}' for n, t in zip(self.names, self.col_types(), strict=True))}>"

    # ---- lineage

    def same_lineage(self, other: Frame) -> bool:
        if self.base is not other.base:
            return False
        if self.where is None or other.where is None:
            return self.where is other.where
        return self.where is other.where or self.base.filter(self.where).sameSemantics(self.base.filter(other.where))

    def need_lineage(self, *others: Frame) -> None:
        for o in others:
            if not self.same_lineage(o):
                raise LineageError("the frames don't come from the same rows; combine them with merge()")

    def eql(self, other: Frame) -> bool:
        return self is other or self.df.sameSemantics(other.df)

    # ---- selection

    def _find(self, j) -> int:
        if isinstance(j, str):
            if j not in self.names:
                raise KeyError(j)
            return self.names.index(j)
        if not -len(self.cols) <= j < len(self.cols):
            raise IndexError(j)
        return j % len(self.cols)

    def col(self, name: str | int) -> Frame:
        """One column; an unknown name gives None."""
        if isinstance(name, str) and name not in self.names:
            return None
        return self._with([self.cols[self._find(name)]])

    def __getattr__(self, name: str):
        if name.startswith("_") or name in ("base", "cols"):
            raise AttributeError(name)
        if name in [c.name for c in self.__dict__.get("cols", [])]:
            return self.col(name)
        raise AttributeError(name)

    def take(self, *js) -> Frame:
        """Columns by name or position (from 0)."""
        return self._with([self.cols[self._find(j)] for j in js])

    def drop(self, *js) -> Frame:
        gone = {self._find(j) for j in js}
        return self._with([c for k, c in enumerate(self.cols) if k not in gone])

    def filter(self, mask: Frame) -> Frame:
        """Rows where the mask of one boolean column is true, besides those left out already."""
        if len(mask.cols) != 1:
            raise ValueError("a mask has one column")
        self.need_lineage(mask)
        cond = mask.cols[0].expr
        return self._with(where=cond if self.where is None else self.where & cond)

    def rows(self, ids) -> Frame:
        """Rows whose key is one of ids."""
        if not self.key:
            raise ValueError("no key column is set")
        cond = F.col(f"`{self.key}`").isin(list(ids)) if len(ids) else F.lit(False)
        return self._with(where=cond if self.where is None else self.where & cond)

    def __getitem__(self, at):
        """x["a"], x[0]: a column. x[["a", "b"]]: columns. x[mask], x[mask, j]: filter. x[[ids], j]: by key.
        x[query of one row]: the column of that number (from 1)."""
        if isinstance(at, tuple):
            i, j = at
            out = self if isinstance(i, slice) and i == slice(None) else self.filter(i) if isinstance(i, Frame) else self.rows(i if isinstance(i, (list, tuple, range)) else [i])
            if isinstance(j, slice) and j == slice(None):
                return out
            if isinstance(j, Frame):
                return out.take(int(j.df.first()[0]) - 1)
            return out.take(*j) if isinstance(j, list) else out.take(j)
        if isinstance(at, Frame):
            if isinstance(at.types()[0], T.BooleanType):
                return self.filter(at)
            return self.take(int(at.df.first()[0]) - 1)
        if isinstance(at, list):
            return self.take(*at)
        return self.take(at)

    def subset(self, mask: Frame | None = None, select: list | None = None) -> Frame:
        out = self if mask is None else self.filter(mask)
        return out if select is None else out.take(*select)

    def element(self, k: int) -> Frame:
        """Element k (from 1) of each array column."""
        return self._with([Col(f"{c.name}[{k}]", F.try_element_at(c.expr, F.lit(k)), c.meta) for c in self.cols])

    def as_list(self, arrays: bool = False) -> list[Frame]:
        from tarn.operators.arrays import expand

        x = expand(self) if arrays else self
        return [x._with([c]) for c in x.cols]

    def evaluate(self, fn):
        """fn of a namespace with a frame for each column."""
        from types import SimpleNamespace

        return fn(SimpleNamespace(**{c.name: self._with([c]) for c in self.cols}))

    # ---- assignment

    def value_of(self, v) -> Column:
        """A column for a value: None, a number, text, date, or a frame of one column (an aggregate as a scalar subquery)."""
        if not isinstance(v, Frame):
            return F.lit(v)
        if v.agg and not v.keys:
            return v.df.scalar()
        self.need_lineage(v)
        if len(v.cols) != 1:
            raise ValueError("a value has one column")
        return v.cols[0].expr

    def assign(self, **values) -> Frame:
        """Replaces or adds columns."""
        cols = list(self.cols)
        for name, v in values.items():
            new = Col(name, self.value_of(v))
            at = [k for k, c in enumerate(cols) if c.name == name]
            cols[at[0] if at else len(cols) :] = [new, *cols[at[0] + 1 :]] if at else [new]
        return self._with(cols)

    def assign_where(self, mask: Frame, name: str, value) -> Frame:
        """The column's value where the mask is true, its old one elsewhere; its type stays."""
        if name not in self.names:
            raise KeyError("a new column can't have a condition")
        self.need_lineage(mask)
        k = self._find(name)
        kind = self._with([self.cols[k]]).types()[0]
        cols = list(self.cols)
        cols[k] = replace(cols[k], expr=F.when(mask.cols[0].expr, self.value_of(value).cast(kind)).otherwise(cols[k].expr))
        return self._with(cols)

    def cbind(self, *others: Frame, unique: bool = True) -> Frame:
        """Columns side by side, of the same lineage; repeated names get .1, .2."""
        cols = list(self.cols)
        for o in others:
            self.need_lineage(o)
            cols += o.cols
        if unique:
            seen: dict[str, int] = {}
            out = []
            for c in cols:
                n = seen.get(c.name, 0)
                seen[c.name] = n + 1
                out.append(replace(c, name=f"{c.name}.{n}") if n else c)
            cols = out
        return self._with(cols, agg=self.agg or any(o.agg for o in others))

    def na_omit(self, *variables) -> Frame:
        """Without rows that have a null in any column, or in the named columns or frames given."""
        exprs = [c.expr for c in self.cols] if not variables else [v.cols[0].expr if isinstance(v, Frame) else self.cols[self._find(v)].expr for v in variables]
        cond = reduce(operator.and_, [e.isNotNull() for e in exprs])
        return self._with(where=cond if self.where is None else self.where & cond)

    # ---- comparison, logic, arithmetic

    def _lift(self, other, op, fits, suffix: str, result: str | None = "boolean", left: bool = True) -> Frame:
        """op of every column and other (a value, a list of one for each column, or a frame; the narrower is repeated)."""
        n = len(self.cols)
        if isinstance(other, Frame) and not (other.agg and not other.keys and not self.agg):
            self.need_lineage(other)
            n = max(n, len(other.cols))
        elif isinstance(other, (list, tuple)):
            n = max(n, len(other))
        kinds = self.types()
        okinds = other.types() if isinstance(other, Frame) else None
        out = []
        for k in range(n):
            c, kind = self.cols[k % len(self.cols)], kinds[k % len(kinds)]
            name = f"{c.name}_{suffix}"
            if isinstance(other, Frame):
                oc, okind = other.cols[k % len(other.cols)], okinds[k % len(okinds)]
                v = other._with([oc]).df.scalar() if other.agg and not other.keys and not self.agg else oc.expr
                name = f"{c.name}_{oc.name}_{suffix}"
            else:
                v = other[k % len(other)] if isinstance(other, (list, tuple)) else other
                okind = None
            if isinstance(kind, T.ArrayType) or isinstance(okind, T.ArrayType):
                e = _array_op(c.expr, kind, v, okind, op, fits, left)
            else:
                e = _scalar_op(c.expr, kind, v, okind, op, fits, left)
            if e is None:
                e = F.lit(None).cast(result or "double")
            out.append(Col(name, e))
        return self._with(out, agg=self.agg)

    def __gt__(self, o):
        return self._lift(o, operator.gt, _ordered, "opr")

    def __lt__(self, o):
        return self._lift(o, operator.lt, _ordered, "opr")

    def __ge__(self, o):
        return self._lift(o, operator.ge, _ordered, "opr")

    def __le__(self, o):
        return self._lift(o, operator.le, _ordered, "opr")

    def __eq__(self, o):
        return self._lift(o, operator.eq, _comparable, "opr")

    def __ne__(self, o):
        return self._lift(o, operator.ne, _comparable, "opr")

    def __and__(self, o):
        return self._lift(o, operator.and_, _logical, "opr")

    def __or__(self, o):
        return self._lift(o, operator.or_, _logical, "opr")

    __rand__, __ror__ = __and__, __or__

    def __invert__(self):
        return self._with([Col(f"{c.name}_opr", ~c.expr if isinstance(t, T.BooleanType) else F.lit(None).cast("boolean")) for c, t in zip(self.cols, self.types(), strict=True)])

    def _arith(self, o, op, left=True):
        return self._lift(o, op, _arithmetic, "opr", "double", left)

    def __add__(self, o):
        return self._arith(o, _plus)

    def __radd__(self, o):
        return self._arith(o, _plus, False)

    def __sub__(self, o):
        return self._arith(o, _minus)

    def __rsub__(self, o):
        return self._arith(o, _minus, False)

    def __neg__(self):
        return self._arith(-1, operator.mul)

    def __mul__(self, o):
        if isinstance(o, (list, tuple)) and len(self.cols) == 1:
            return self._with([Col(f"{self.cols[0].name}_opr", F.array(*[self.cols[0].expr * F.lit(v) for v in o]))])
        return self._arith(o, operator.mul)

    __rmul__ = __mul__

    def __truediv__(self, o):
        return self._arith(o, lambda a, b: a.cast("double") / b)

    def __rtruediv__(self, o):
        return self._arith(o, lambda a, b: a.cast("double") / b, False)

    def __pow__(self, o):
        return self._arith(o, lambda a, b: F.pow(a.cast("double"), b))

    def __rpow__(self, o):
        return self._arith(o, lambda a, b: F.pow(a.cast("double"), b), False)

    def __mod__(self, o):
        return self._arith(o, lambda a, b: as_integer(a) % as_integer(b))

    def __rmod__(self, o):
        return self._arith(o, lambda a, b: as_integer(a) % as_integer(b), False)

    def __floordiv__(self, o):
        return self._arith(o, _idiv)

    def __rfloordiv__(self, o):
        return self._arith(o, _idiv, False)

    def is_na(self) -> Frame:
        """Nulls; an array also counts when it has one."""
        return self._with([Col(f"{c.name}_isnull", F.isnull(c.expr) | F.exists(c.expr, F.isnull) if isinstance(t, T.ArrayType) else F.isnull(c.expr)) for c, t in zip(self.cols, self.types(), strict=True)])


# ---- type families


def as_integer(c: Column) -> Column:
    """Rounded half to even."""
    return F.bround(c.cast("double")).cast("long")


def _idiv(a: Column, b: Column) -> Column:
    return F.call_function("div", as_integer(a), as_integer(b))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _minus(a: Column, b: Column) -> Column:
    return a - b


def _is(t, *kinds) -> bool:
    return isinstance(t, kinds)


def _family(t) -> str:
    return "number" if _is(t, T.NumericType) else "text" if _is(t, T.StringType) else "time" if _is(t, *TIME) else "logical" if _is(t, T.BooleanType) else "other"


def _value_family(v) -> str:
    import datetime as dt

    return "logical" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else "text" if isinstance(v, str) else "time" if isinstance(v, (dt.date, dt.datetime, dt.timedelta)) else "null" if v is None else "other"


def _ordered(a: str, b: str) -> bool:
    return (a == b and a in ("number", "text", "time")) or (a == "time" and b == "text") or (a == "text" and b == "time")


def _comparable(a: str, b: str) -> bool:
    return _ordered(a, b) or a == b == "logical"


def _logical(a: str, b: str) -> bool:
    return a == b == "logical"


def _arithmetic(a: str, b: str) -> bool:
    return (a == b and a in ("number", "time")) or {a, b} in ({"time", "number"}, {"time", "text"})


def _scalar_op(e: Column, kind, v, okind, op, fits, left: bool) -> Column | None:
    mine = _family(kind)
    theirs = _family(okind) if okind is not None else _value_family(v)
    if theirs == "null" or not fits(mine, theirs):
        return None
    other = v if isinstance(v, Column) else F.lit(v)
    if fits is _arithmetic and "time" in (mine, theirs):
        return _time_arithmetic(e, kind, other, okind, v, op, left)
    if mine == "time" and theirs == "text":
        other = other.cast(kind)
    elif mine == "text" and theirs == "time" and okind is not None:
        e = e.cast(okind)
    return op(e, other) if left else op(other, e)


def _time_arithmetic(e: Column, kind, other: Column, okind, v, op, left: bool) -> Column | None:
    """Dates move by days; text is an interval for + and a time of the column's type for -; dates differ by days."""
    if op is _plus:
        if okind is None and isinstance(v, str):
            return e + F.expr(f"INTERVAL {v}" if "'" in v else f"INTERVAL '{v.split()[0]}' {v.split()[1]}")
        if _is(kind, T.DateType):
            return F.date_add(e, other.cast("int"))
        return F.date_add(other, e.cast("int")) if _is(okind, T.DateType) else e + other
    if op is _minus:
        if okind is None and isinstance(v, (int, float)) and _is(kind, T.DateType):
            return F.date_sub(e, F.lit(int(v))) if left else None
        if okind is None and isinstance(v, str):
            other, okind = other.cast(kind), kind
        a, b = (e, other) if left else (other, e)
        if _is(kind, T.DateType) and (okind is None or _is(okind, T.DateType)):
            return F.datediff(a, b)
        if okind is not None and _family(okind) == "number":
            return F.date_sub(a, b.cast("int"))
        return a - b
    return None


def _array_op(e: Column, kind, v, okind, op, fits, left: bool) -> Column | None:
    """Element by element; arrays of one length, or an array and a scalar."""
    if _is(kind, T.ArrayType) and _is(okind, T.ArrayType):
        return F.zip_with(e, v, lambda a, b: op(a, b))
    if _is(kind, T.ArrayType):
        return F.transform(e, lambda a: _scalar_op(a, kind.elementType, v, okind, op, fits, left))
    return F.transform(v, lambda b: op(e, b) if left else op(b, e))
