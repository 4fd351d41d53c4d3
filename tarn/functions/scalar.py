"""Row functions of frames: mathematics, casts, row sums, conditions, patterns."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.frame import Col, Frame, Meta, as_integer


def _map(x: Frame, name: str, fn, integers_only: bool = False) -> Frame:
    """fn of each numeric column (booleans as 0 and 1, arrays by element); others become null. The sort is dropped."""

    def one(e, t):
        if isinstance(t, T.ArrayType):
            return F.transform(e, lambda a: one(a, t.elementType))
        if isinstance(t, T.BooleanType):
            e, t = e.cast("int"), T.IntegerType()
        ok = isinstance(t, T.IntegralType if integers_only else T.NumericType)
        return fn(e) if ok else F.lit(None).cast("double")

    return x._with([Col(f"{c.name}_{name}", one(c.expr, t)) for c, t in zip(x.cols, x.types(), strict=True)], order=())


def exp(x): return _map(x, "exp", F.exp)  # noqa: E704
def log(x): return _map(x, "ln", F.ln)  # noqa: E704
def log10(x): return _map(x, "log", F.log10)  # noqa: E704
def sqrt(x): return _map(x, "sqrt", F.sqrt)  # noqa: E704
def absolute(x): return _map(x, "abs", F.abs)  # noqa: E704
def sign(x): return _map(x, "sign", F.signum)  # noqa: E704
def factorial(x): return _map(x, "factorial", lambda e: F.factorial(e.cast("int")), True)  # noqa: E704
def sin(x): return _map(x, "sin", F.sin)  # noqa: E704
def cos(x): return _map(x, "cos", F.cos)  # noqa: E704
def tan(x): return _map(x, "tan", F.tan)  # noqa: E704
def asin(x): return _map(x, "asin", F.asin)  # noqa: E704
def acos(x): return _map(x, "acos", F.acos)  # noqa: E704
def atan(x): return _map(x, "atan", F.atan)  # noqa: E704


def atan2(y: Frame, x: Frame, quadrant: bool = False) -> Frame:
    """atan(y / x); with quadrant=True the angle in its quadrant."""
    if not quadrant:
        return atan(y / x)
    y.need_lineage(x)
    return y._with([Col(f"{a.name}_atan2", F.atan2(a.expr, b.expr)) for a, b in zip(y.cols, x.cols, strict=True)])


def row_sums(x: Frame) -> Frame:
    """Sum over the columns (and array elements) of a row; null if any is."""
    parts = [F.aggregate(c.expr, F.lit(0.0), lambda a, v: a + v.cast("double")) if isinstance(t, T.ArrayType) else c.expr for c, t in zip(x.cols, x.types(), strict=True)]
    return x._with([Col("row_sums", reduce(operator.add, parts))])


def row_means(x: Frame) -> Frame:
    s = row_sums(x)
    return s._with([Col("row_means", s.cols[0].expr / F.lit(float(len(x.cols))))])


def _cast(x: Frame, name: str, fn) -> Frame:
    return x._with([Col(f"{c.name}_{name}", F.transform(c.expr, lambda a, t=t: fn(a, t.elementType)) if isinstance(t, T.ArrayType) else fn(c.expr, t)) for c, t in zip(x.cols, x.types(), strict=True)])


def to_integer(x: Frame) -> Frame:
    """Doubles round half to even, decimals half away from zero."""
    return _cast(x, "integer", lambda e, t: F.round(e).cast("int") if isinstance(t, T.DecimalType) else as_integer(e).cast("int") if isinstance(t, T.FractionalType) else e.cast("int"))


def to_character(x): return _cast(x, "text", lambda e, t: e.cast("string"))  # noqa: E704
def to_numeric(x): return _cast(x, "double", lambda e, t: e.cast("double"))  # noqa: E704
def to_logical(x): return _cast(x, "boolean", lambda e, t: e.cast("boolean"))  # noqa: E704
def to_date(x, fmt=None): return _cast(x, "date", lambda e, t: F.to_date(e, fmt) if fmt else e.cast("date"))  # noqa: E704
def to_timestamp(x): return _cast(x, "timestamp", lambda e, t: e.cast("timestamp_ntz"))  # noqa: E704


# Units of interval texts.
_UNITS = {"y": r"years?|yrs?|y", "mon": r"months?|mons?", "w": r"weeks?|w", "d": r"days?|d", "h": r"hours?|hrs?|h", "m": r"minutes?|mins?|m", "s": r"seconds?|secs?|s"}


def to_interval(x: Frame, unit: str = "DAY") -> Frame:
    """Numbers of days (or of seconds), or text such as "3 days 04:05:06", "1 week -2 hours" or "1 year 2 mons" as an interval. Text
    of years and months alone gives one of months when unit is MONTH, else null; text that isn't an interval gives null."""

    def amount(e, u):
        found = F.regexp_extract_all(e, F.lit(rf"(?i)([-+]?\d+(?:\.\d+)?)\s*(?:{_UNITS[u]})(?![a-z])"), 1)
        return F.aggregate(F.transform(found, lambda v: v.cast("double")), F.lit(0.0), lambda a, v: a + v)

    def text(e):
        every = "|".join(_UNITS.values())
        fits = e.rlike(rf"(?i)^\s*(?:[-+]?\d+(?:\.\d+)?\s*(?:{every})(?![a-z])\s*)*(?:-?\d+:\d\d(?::\d\d(?:\.\d+)?)?)?\s*$") & e.rlike(r"\d")
        months = 12 * amount(e, "y") + amount(e, "mon")
        if unit == "MONTH":
            return F.when(fits, F.make_ym_interval(F.lit(0), F.round(months).cast("int")))
        clock = F.regexp_extract(e, r"(-?)(\d+):(\d\d)(?::(\d\d(?:\.\d+)?))?", 0)
        part = lambda k: F.coalesce(F.nullif(F.regexp_extract(clock, r"(-?)(\d+):(\d\d)(?::(\d\d(?:\.\d+)?))?", k), F.lit("")).cast("double"), F.lit(0.0))
        sign = F.when(F.startswith(clock, F.lit("-")), -1.0).otherwise(1.0)
        secs = 86400 * (7 * amount(e, "w") + amount(e, "d")) + 3600 * amount(e, "h") + 60 * amount(e, "m") + amount(e, "s") + sign * (3600 * part(2) + 60 * part(3) + part(4))
        return F.when(fits & (months == 0), F.make_dt_interval(secs=secs.cast("decimal(18,6)")))

    def one(e, t):
        if isinstance(t, T.StringType):
            return text(e)
        if unit == "MONTH":
            return F.make_ym_interval(F.lit(0), e.cast("int"))
        return F.make_dt_interval(secs=(e.cast("double") * (86400 if unit == "DAY" else 1)).cast("decimal(18,6)"))

    return _cast(x, "interval", one)


def to_time(x: Frame) -> Frame:
    x.base.sparkSession.conf.set("spark.sql.timeType.enabled", "true")
    return _cast(x, "time", lambda e, t: (F.date_format(e, "HH:mm:ss.SSSSSS") if isinstance(t, (T.TimestampType, T.TimestampNTZType)) else e).cast("time"))


def to_factor(x: Frame, reference: str | None = None) -> Frame:
    return x._with([Col(c.name, c.expr, Meta(True, reference)) for c in x.cols])


def is_factor(x: Frame) -> list[bool]:
    return [c.meta.factor for c in x.cols]


def relevel(x: Frame, reference: str) -> Frame:
    if not all(is_factor(x)):
        raise ValueError("only factors have a reference level")
    return to_factor(x, str(reference))


MAX_LEVELS = 10_000  #: of a factor; each becomes a column


def levels(x: Frame) -> list[str]:
    """Levels of a factor in descending order of text; the last is the reference unless another was chosen. More than
    MAX_LEVELS are an error."""
    c = x.cols[0]
    found = [r[0] for r in x.source.select(c.expr.cast("string").alias("v")).distinct().filter("v IS NOT NULL").orderBy(F.desc("v")).limit(MAX_LEVELS + 1).toLocalIterator()]
    if len(found) > MAX_LEVELS:
        raise ValueError(f"{c.name} has more than {MAX_LEVELS} levels")
    return found


def dummies(x: Frame, full: bool = False, na_as_level: bool = False) -> Frame:
    """Factors replaced by 0/1 columns name_level, without the reference level unless full."""
    out = []
    for c in x.cols:
        if not c.meta.factor:
            out.append(c)
            continue
        found = levels(x._with([c]))
        ref = c.meta.reference or (found[-1] if found else None)
        out += [Col(f"{c.name}_{v}", F.when(c.expr.cast("string") == v, 1).otherwise(0)) for v in found if full or v != ref]
        if na_as_level:
            out.append(Col(f"{c.name}_null", F.when(c.expr.isNull(), 1).otherwise(0)))
    return x._with(out)


def if_else(test: Frame, yes, no) -> Frame:
    """yes where the test is true, no elsewhere and where it is null."""
    return test._with([Col("ifelse", F.when(test.cols[0].expr.cast("boolean"), test.value_of(yes)).otherwise(test.value_of(no)))])


def grepl(pattern: str, x: Frame, ignore_case: bool = False, fixed: bool = False) -> Frame:
    def one(e):
        if fixed:
            return F.contains(F.lower(e), F.lit(pattern.lower())) if ignore_case else F.contains(e, F.lit(pattern))
        return e.rlike(("(?i)" if ignore_case else "") + pattern)

    return x._with([Col(f"{c.name}_grepl", one(c.expr) if isinstance(t, T.StringType) else F.lit(None).cast("boolean")) for c, t in zip(x.cols, x.types(), strict=True)])
