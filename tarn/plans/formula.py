"""Formulas: y ~ a + b - c + . + a:b + a*b + I(expr) + factor(s) - 1 | g1 + g2.

A formula becomes expression trees; a tree gives a Column, a value in numpy, and its derivative. Trees are tuples:
("num", v), ("var", name), ("idx", name, k), ("call", f, arg), ("op", sign, left, right)."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.frame import Frame

_WORD = re.compile(r"\s*(?:(\d+\.?\d*(?:[eE][-+]?\d+)?|\.\d+)|([A-Za-z_][\w]*(?:\.\w+)*)|(<=|>=|==|!=|\*\*|[-+*/^():\[\]<>,.|&!]))")
_FUNCTIONS = {"log": (F.ln, np.log), "log10": (F.log10, np.log10), "exp": (F.exp, np.exp), "sqrt": (F.sqrt, np.sqrt), "abs": (F.abs, np.abs), "sin": (F.sin, np.sin), "cos": (F.cos, np.cos), "tan": (F.tan, np.tan)}
_BINDING = {"+": 10, "-": 10, "*": 20, "/": 20, ":": 30, "^": 50, "<": 5, ">": 5, "<=": 5, ">=": 5, "==": 5, "!=": 5, "&": 3}


def parse(text: str):
    words, at = [], 0
    while text[at:].strip():
        m = _WORD.match(text, at)
        if not m:
            raise ValueError(f"cannot read the formula at {text[at:]!r}")
        words.append(("num", float(m[1])) if m[1] else ("name", m[2]) if m[2] else ("sign", "^" if m[3] == "**" else m[3]))
        at = m.end()
    words.append(("end", None))
    pos = 0

    def peek():
        return words[pos]

    def take(sign=None):
        nonlocal pos
        w = words[pos]
        if sign and w != ("sign", sign):
            raise ValueError(f"expected {sign} in the formula")
        pos += 1
        return w

    def atom():
        kind, v = take()
        if kind == "num":
            return ("num", v)
        if kind == "name":
            if peek() == ("sign", "("):
                take()
                arg = expression(0)
                take(")")
                return ("call", v, arg)
            if peek() == ("sign", "["):
                take()
                k = None if peek() == ("sign", "]") else int(take()[1])
                take("]")
                return ("idx", v, k)
            return ("var", v)
        if v == "(":
            e = expression(0)
            take(")")
            return e
        if v == ".":
            return ("dot",)
        if v == "-":
            return ("op", "-", ("num", 0.0), expression(15))
        if v == "+":
            return expression(15)
        raise ValueError(f"unexpected {v} in the formula")

    def expression(least):
        left = atom()
        while peek()[0] == "sign" and _BINDING.get(peek()[1], -1) > least:
            sign = take()[1]
            left = ("op", sign, left, expression(_BINDING[sign] - (sign == "^")))
        return left

    tree = expression(0)
    if peek()[0] != "end":
        raise ValueError("the formula goes on after its end")
    return tree


def variables(tree) -> set[str]:
    if tree[0] in ("var", "idx"):
        return {tree[1]}
    return set().union(*[variables(x) for x in tree[1:] if isinstance(x, tuple)]) if len(tree) > 1 else set()


def text_of(tree) -> str:
    k = tree[0]
    return f"{tree[1]:g}" if k == "num" else tree[1] if k == "var" else f"{tree[1]}[{tree[2]}]" if k == "idx" else f"{tree[1]}({text_of(tree[2])})" if k == "call" else f"{text_of(tree[2])}{tree[1]}{text_of(tree[3])}"


def column_of(tree, cols: dict[str, Column]) -> Column:
    k = tree[0]
    if k == "num":
        return F.lit(tree[1])
    if k == "var":
        return cols[tree[1]]
    if k == "idx":
        return F.element_at(cols[tree[1]], tree[2])
    if k == "call":
        a = column_of(tree[2], cols)
        return a if tree[1] == "I" else _FUNCTIONS[tree[1]][0](a)
    a, b, s = column_of(tree[2], cols), column_of(tree[3], cols), tree[1]
    ops = {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: a.cast("double") / b, "^": lambda: F.pow(a.cast("double"), b), ":": lambda: a * b, "<": lambda: a < b, ">": lambda: a > b, "<=": lambda: a <= b, ">=": lambda: a >= b, "==": lambda: a == b, "!=": lambda: a != b, "&": lambda: a & b}
    return ops[s]()


def derivative(tree, name: str):
    """d tree / d name."""
    k = tree[0]
    if k in ("num", "idx"):
        return ("num", 0.0)
    if k == "var":
        return ("num", float(tree[1] == name))
    if k == "call":
        a, d = tree[2], derivative(tree[2], name)
        if tree[1] == "I":
            return d
        outer = {"log": lambda: ("op", "/", ("num", 1.0), a), "log10": lambda: ("op", "/", ("num", 1 / np.log(10)), a), "exp": lambda: tree, "sqrt": lambda: ("op", "/", ("num", 0.5), tree), "sin": lambda: ("call", "cos", a), "cos": lambda: ("op", "*", ("num", -1.0), ("call", "sin", a)), "tan": lambda: ("op", "+", ("num", 1.0), ("op", "*", tree, tree)), "abs": lambda: ("op", "/", a, tree)}[tree[1]]()
        return _times(outer, d)
    s, a, b = tree[1:]
    da, db = derivative(a, name), derivative(b, name)
    if s in "+-":
        return da if db == ("num", 0.0) else ("op", s, da, db)
    if s in ("*", ":"):
        x, y = _times(da, b), _times(a, db)
        return y if x == ("num", 0.0) else x if y == ("num", 0.0) else ("op", "+", x, y)
    if s == "/":
        return ("op", "/", ("op", "-", _times(da, b), _times(a, db)), _times(b, b))
    if s == "^" and b[0] == "num":
        return _times(_times(b, ("op", "^", a, ("num", b[1] - 1))), da)
    raise ValueError(f"no derivative of {text_of(tree)}")


def _times(a, b):
    zero, one = ("num", 0.0), ("num", 1.0)
    return zero if zero in (a, b) else b if a == one else a if b == one else ("op", "*", a, b)


@dataclass
class Design:
    """The parts of a model: its dependent column, named columns of the design matrix, groups."""

    frame: Frame
    dep: Column
    dep_tree: tuple
    names: list[str]
    trees: list[tuple]
    groups: list[str]
    intercept: bool
    cols: dict[str, Column]
    factors: dict[str, tuple[str, list[str]]] = field(default_factory=dict)  #: variable: reference, other levels

    @property
    def matrix(self) -> list[Column]:
        return [column_of(t, self.cols).cast("double") for t in self.trees]

    @property
    def y(self) -> Column:
        return self.dep.cast("double")

    def over(self, frame: Frame) -> Design:
        """The same design on another frame, which needs the response only where its values are asked for."""
        cols = {c.name: c.expr for c in frame.cols}
        dep = column_of(self.dep_tree, cols | _dummies(cols, self.factors)) if variables(self.dep_tree) <= set(cols) else None
        return Design(frame, dep, self.dep_tree, self.names, self.trees, self.groups, self.intercept, cols | _dummies(cols, self.factors), self.factors)


def _dummies(cols, factors) -> dict[str, Column]:
    return {f"{v}|{lv}": F.when(cols[v].cast("string") == lv, 1.0).when(cols[v].isNotNull(), 0.0) for v, (_, lvs) in factors.items() for lv in lvs}


def design(formula: str, data: Frame, numeric_response: bool = False) -> Design:
    from tarn.functions.scalar import levels

    left, _, right = formula.partition("~")
    right, _, by = right.partition("|")
    groups = [g.strip() for g in by.split("+") if g.strip()]
    cols = {c.name: c.expr for c in data.cols}
    kinds = dict(zip(data.names, data.types(), strict=True))
    meta = {c.name: c.meta for c in data.cols}
    dep_tree = parse(left)
    terms: list[tuple] = []
    intercept = True
    factor_vars: set[str] = set()

    def expand(tree) -> list[tuple]:
        """Terms, each a tuple of factors."""
        if tree == ("dot",):
            out = []
            for n in data.names:
                if n not in groups and n not in variables(dep_tree):
                    out += expand(("var", n))
            return out
        if tree[0] == "call" and tree[1] in ("factor", "as.factor"):
            factor_vars.add(tree[2][1])
            return [(tree[2],)]
        if tree[0] == "idx" and tree[2] is None or tree[0] == "var" and isinstance(kinds.get(tree[1]), T.ArrayType):
            n = data.source.select(F.size(cols[tree[1]])).first()[0]
            return [(("idx", tree[1], k + 1),) for k in range(n)]
        if tree[0] == "op" and tree[1] == "+":
            return expand(tree[2]) + expand(tree[3])
        if tree[0] == "op" and tree[1] == ":":
            return [a + b for a in expand(tree[2]) for b in expand(tree[3])]
        if tree[0] == "op" and tree[1] == "*":
            a, b = expand(tree[2]), expand(tree[3])
            return a + b + [x + y for x in a for y in b]
        if tree[0] == "op" and tree[1] == "-":
            gone = [frozenset(t) for t in expand(tree[3])]
            return [t for t in (expand(tree[2]) if tree[2] != ("num", 0.0) else []) if frozenset(t) not in gone] + ([("minus",)] if tree[3] == ("num", 1.0) else [])
        return [(tree,)]

    for t in expand(parse(right)):
        if t == ("minus",) or t == (("num", 0.0),):
            intercept = False
        elif t == (("num", 1.0),):
            continue
        elif t and frozenset(t) not in [frozenset(o) for o in terms]:
            terms.append(t)
    for t in terms:
        for v in t:
            if v[0] == "var" and (isinstance(kinds[v[1]], (T.StringType, T.BooleanType)) or meta[v[1]].factor):
                factor_vars.add(v[1])
    factors = {}
    for v in sorted(factor_vars):
        found = levels(data._with([data.cols[data._find(v)]]))
        ref = meta[v].reference or found[-1]
        factors[v] = (ref, [lv for lv in found if lv != ref])
    names, trees = (["(Intercept)"], [("num", 1.0)]) if intercept else ([], [])
    for t in terms:
        own = [("", None)]
        for v in t:
            choices = [(f"{v[1]}{lv}", ("var", f"{v[1]}|{lv}")) for lv in factors[v[1]][1]] if v[0] == "var" and v[1] in factors else [(text_of(v), v)]
            own = [(f"{a}:{n}" if a else n, x if e is None else ("op", "*", e, x)) for a, e in own for n, x in choices]
        names += [n for n, _ in own]
        trees += [e for _, e in own]
    every = cols | _dummies(cols, factors)
    dep = column_of(dep_tree, every)
    if numeric_response and isinstance(data.source.select(dep.alias("y")).schema[0].dataType, (T.StringType, T.BooleanType)):
        raise ValueError("the response must be a number")
    return Design(data, dep, dep_tree, names, trees, groups, intercept, every, factors)
