"""Linear, logistic and generalised linear models; elastic net. Every pass is one grouped aggregate for all groups."""

from __future__ import annotations

import json
import math
import warnings
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.frame import Col, Frame
from tarn.models import dist
from tarn.operators.linalg import gram, key_text, pinv
from tarn.plans.formula import Design, design
from tarn.sources.catalog import drop_kept, keep


@dataclass
class Fit:
    """A fitted model of one group."""

    design: Design
    group: tuple
    coef: np.ndarray
    std_err: np.ndarray
    stats: np.ndarray
    p_values: np.ndarray
    n: int
    skipped: int
    extra: dict = field(default_factory=dict)
    family: str = "gaussian"
    link: str = "identity"

    def __getattr__(self, name):
        if name != "extra" and name in self.__dict__.get("extra", {}):
            return self.extra[name]
        raise AttributeError(name)

    def named(self) -> dict[str, float]:
        return dict(zip(self.design.names, self.coef.tolist(), strict=True))

    @property
    def data(self) -> Frame:
        d, cond = self.design, None
        for g, v in zip(d.groups, self.group, strict=True):
            c = d.cols[g].eqNullSafe(F.lit(v)) if v is not None else d.cols[g].isNull()
            cond = c if cond is None else cond & c
        x = d.frame
        return x if cond is None else x._with(where=cond if x.where is None else x.where & cond)


@dataclass
class Grouped:
    """Models in the order of their group keys."""

    fits: list[Fit]

    def __iter__(self):
        return iter(self.fits)

    def __len__(self):
        return len(self.fits)

    def __getitem__(self, k):
        return self.fits[k]


def coef(model):
    return {f.group: f.named() for f in model} if isinstance(model, Grouped) else model.named()


def groups(model) -> dict[str, list]:
    fits = model.fits if isinstance(model, Grouped) else [model]
    return {g: [f.group[k] for f in fits] for k, g in enumerate(fits[0].design.groups)}


def _result(fits: list[Fit], d: Design):
    return Grouped(sorted(fits, key=lambda f: [(v is not None, str(v)) for v in f.group])) if d.groups else fits[0]


def _prepared(formula: str, data: Frame, na_action=None, numeric=False) -> Design:
    return design(formula, na_action(data) if na_action else data, numeric)


def lm(formula: str, data: Frame, na_action=None, hetero: bool = False):
    """Least squares for every group: coefficients, errors, t, p, r2, condition number, rows used and skipped."""
    d = _prepared(formula, data, na_action, True)
    x, p = d.matrix, len(d.names)
    keys = [d.cols[g] for g in d.groups]
    mats = gram(d.frame.source, [*x, d.y, F.lit(1.0)], keys)
    named = d.frame.source.groupBy(*[k.alias(f"g{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("n")).toLocalIterator()
    rows = {tuple(r[f"g{i}"] for i in range(len(keys))): r["n"] for r in named}
    fits = []
    for key, (m, n) in mats.items():
        xx, xy, yy, sy = m[:p, :p], m[:p, p], m[p, p], m[p, p + 1]
        size = np.sqrt(np.maximum(np.diag(xx), 1e-300))
        inv = pinv(xx / np.outer(size, size)) / np.outer(size, size)
        b = inv @ xy
        rss = max(yy - 2 * b @ xy + b @ xx @ b, 0.0)
        tss = yy - sy * sy / n if d.intercept else yy
        s2 = rss / (n - p) if n > p else float("nan")
        se = np.sqrt(np.maximum(np.diag(inv) * s2, 0))
        t = b / np.where(se == 0, np.nan, se)
        ev = np.linalg.eigvalsh(xx)
        fits.append(Fit(d, key, b, se, t, np.array([dist.t_two_sided(v, n - p) for v in t]), n, rows.get(key, n) - n, {"r2": 1 - rss / tss if tss > 0 else float("nan"), "condition_no": math.sqrt(max(ev) / max(min(ev), 1e-300)), "rss": rss, "vcov": inv * s2, "t_stats": t}))
    if hetero:
        for f in fits:  # Breusch-Pagan: squared residuals on the regressors
            e = residuals(f)
            u = e.cols[0].expr * e.cols[0].expr
            m, n = next(iter(gram(f.data.source, [*x, u, F.lit(1.0)]).values()))
            g = pinv(m[:p, :p]) @ m[:p, p]
            mean = m[p, p + 1] / n
            tss = m[p, p] - n * mean * mean
            r2 = 1 - (m[p, p] - 2 * g @ m[:p, p] + g @ m[:p, :p] @ g) / tss if tss > 0 else 0.0
            f.extra |= {"bp_stats": n * r2, "bp_p_value": dist.chi2_upper(n * r2, max(p - d.intercept, 1))}
    return _result(fits, d)


# name: inverse link, its derivative, link, as columns and in numpy alike through the functions given
_LINKS = {
    "identity": (lambda e, m: e, lambda e, m: e * 0 + 1, lambda u, m: u),
    "log": (lambda e, m: m.exp(e), lambda e, m: m.exp(e), lambda u, m: m.log(u)),
    "inverse": (lambda e, m: 1 / e, lambda e, m: -1 / (e * e), lambda u, m: 1 / u),
    "sqrt": (lambda e, m: e * e, lambda e, m: 2 * e, lambda u, m: m.sqrt(u)),
    "logit": (lambda e, m: 1 / (1 + m.exp(-e)), lambda e, m: m.exp(-m.abs(e)) / ((1 + m.exp(-m.abs(e))) * (1 + m.exp(-m.abs(e)))), lambda u, m: m.log(u / (1 - u))),
    "probit": (lambda e, m: m.cdf(e), lambda e, m: m.exp(-e * e / 2) / math.sqrt(2 * math.pi), lambda u, m: m.log(u / (1 - u)) * math.sqrt(math.pi / 8)),
    "sqr_inverse": (lambda e, m: 1 / m.sqrt(e), lambda e, m: -0.5 / (e * m.sqrt(e)), lambda u, m: 1 / (u * u)),
}
_FAMILIES = {"gaussian": ("identity", lambda u: u * 0 + 1), "binomial": ("logit", lambda u: u * (1 - u)), "poisson": ("log", lambda u: u), "gamma": ("inverse", lambda u: u * u), "inverse_gaussian": ("sqr_inverse", lambda u: u * u * u)}
_DISPERSED = ("gaussian", "gamma", "inverse_gaussian")
REPEATED = 4  #: equal rows are fitted as one where there are, by estimate, so many of each on average
SMALL = 1_000_000  #: numbers in a table of coefficients that is broadcast


class _Cols:
    """Column functions for the link table; the normal distribution function by a rational approximation of erfc."""

    exp, log, sqrt, abs = F.exp, F.ln, F.sqrt, F.abs

    @staticmethod
    def cdf(z: Column) -> Column:
        # Coefficients of the fractional error approximation of erfc (Chebyshev fit, relative error below 1.2e-7).
        c = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)
        a = F.abs(z) / math.sqrt(2)
        t = 1 / (1 + 0.5 * a)
        poly = F.lit(c[-1])
        for k in reversed(c[:-1]):
            poly = poly * t + F.lit(k)
        erfc = t * F.exp(-a * a + poly)
        return F.when(z >= 0, 1 - erfc / 2).otherwise(erfc / 2)


def _lgamma(x: Column) -> Column:
    """The logarithm of the gamma function, for x of 1 or more."""
    # Coefficients of the published Lanczos approximation with g = 7 and nine terms.
    c = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)
    z = x - 1
    series = sum((F.lit(v) / (z + k) for k, v in enumerate(c[1:], 1)), F.lit(c[0]))
    t = z + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.ln(t) - t + F.ln(series)


def _likelihood(family: str, y: Column, u: Column) -> list[Column]:
    """Terms whose sums over the rows give the log likelihood."""
    if family == "binomial":
        return [y * F.ln(u) + (1 - y) * F.ln(1 - u)]
    if family == "poisson":
        return [y * F.ln(u) - u - _lgamma(y + 1)]
    if family == "gaussian":
        return [(y - u) * (y - u)]
    if family == "gamma":
        return [F.ln(y / u), y / u, F.ln(y)]
    return [(y - u) * (y - u) / (y * u * u), F.ln(y)]


def _log_likelihood(family: str, s: list[float], n: int) -> float:
    """From the sums; the dispersion of families that have one is the mean deviance."""
    if family in ("binomial", "poisson"):
        return s[0]
    if family == "gaussian":
        return -0.5 * n * (math.log(2 * math.pi * s[0] / n) + 1)
    if family == "gamma":
        a = n / max(2 * (s[1] - n - s[0]), 1e-300)
        return a * (s[0] - s[1]) - s[2] + n * (a * math.log(a) - math.lgamma(a))
    return -0.5 * (n * (math.log(2 * math.pi * s[0] / n) + 1) + 3 * s[1])


def _cases(d: Design) -> tuple[DataFrame, dict[tuple, int]]:
    """(stored rows g0.., x0.., y, n of the design without nulls; rows of each group with those that have nulls). Where rows repeat,
    equal ones are one with their number n, so that the steps of a fit don't read the table again."""
    keys, names = [d.cols[g] for g in d.groups], [f"g{i}" for i in range(len(d.groups))]
    values = [f"x{i}" for i in range(len(d.names))] + ["y"]
    rows = d.frame.source.select(*[k.alias(n) for k, n in zip(keys, names, strict=True)], *[c.alias(n) for c, n in zip([*d.matrix, d.y], values, strict=True)])
    used = F.lit(True)
    for v in values:
        used &= F.col(v).isNotNull() & ~F.isnan(v)  # as dropna has it
    sizes = rows.groupBy(*names).agg(F.count("*").alias("n"), F.count(F.when(used, 1)).alias("used"), F.approx_count_distinct(F.when(used, F.xxhash64(*values))).alias("differ"))
    whole, n, differ = {}, 0, 0
    for r in sizes.toLocalIterator():
        whole[tuple(r[: len(keys)])] = r["n"]
        n, differ = n + r["used"], differ + r["differ"]
    rows = rows.filter(used)
    if REPEATED * differ <= n:
        return keep(rows.groupBy(*names, *values).agg(F.count("*").alias("n"))), whole
    return keep(rows.withColumn("n", F.lit(1))), whole


def _link(family: str, link: str | None) -> tuple[str, str]:
    family = family.lower().replace("inverse.gaussian", "inverse_gaussian")
    if family == "multinomial":
        raise NotImplementedError("multinomial models aren't implemented")
    return family, {"1/mu^2": "sqr_inverse"}.get(link, link) or _FAMILIES[family][0]


def glm(formula: str, data: Frame, family: str = "gaussian", link: str | None = None, na_action=None, max_iter: int = 100, tolerance: float = 1e-8):
    """Iteratively reweighted least squares; one grouped aggregate an iteration for all groups that haven't converged."""
    return glms(formula, data, [(family, link)], na_action, max_iter, tolerance)[0]


def glms(formula: str, data: Frame, kinds: list[tuple[str, str | None]], na_action=None, max_iter: int = 100, tolerance: float = 1e-8) -> list:
    """A model of the formula for each (family, link). The table is read and its design stored once for all of them."""
    kinds = [_link(*k) for k in kinds]
    least = ("gaussian", "identity")
    d = _prepared(formula, data, na_action) if set(kinds) - {least} else None
    src, whole = _cases(d) if d else (None, {})
    out = [lm(formula, data, na_action) if k == least else _reweighted(d, src, whole, *k, max_iter, tolerance) for k in kinds]
    if d:
        drop_kept(src)
    return out


def _reweighted(d: Design, src: DataFrame, whole: dict[tuple, int], family: str, link: str, max_iter: int, tolerance: float):
    """The fit of a family and link over the stored rows of the design."""
    variance, (inverse, slope, forward) = _FAMILIES[family][1], _LINKS[link]
    keys, p = d.groups, len(d.names)
    xs, gs = [F.col(f"x{i}") for i in range(p)], [F.col(f"g{i}") for i in range(len(keys))]
    spark = src.sparkSession
    kinds = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(src.schema.fields[: len(keys)])] + [T.StructField("_b", T.ArrayType(T.DoubleType()))])
    beta: dict[tuple, np.ndarray] = {}
    state: dict[tuple, dict] = {}
    open_: set | None = None
    for it in range(1, max_iter + 2):
        rows = src
        if it == 1:  # start from means moved away from the edge of the family
            u = {"binomial": (F.col("y") + 0.5) / 2, "poisson": F.col("y") + 0.1, "gamma": F.greatest("y", F.lit(1e-6)), "inverse_gaussian": F.greatest("y", F.lit(1e-6))}.get(family, F.greatest("y", F.lit(1e-6)) if link in ("log", "inverse") else F.col("y"))
            eta = forward(u, _Cols)
        elif not keys:
            eta = sum((xs[i] * float(beta[()][i]) for i in range(1, p)), xs[0] * float(beta[()][0]))
        else:  # a table of coefficients; groups that have converged drop out. It is broadcast only if it is small
            left = [(*k, b.tolist()) for k, b in beta.items() if open_ is None or k in open_]
            table = spark.createDataFrame(left, kinds)
            table = F.broadcast(table) if len(left) * (p + len(keys)) <= SMALL else table
            on = [c.eqNullSafe(F.col(f"k{i}")) for i, c in enumerate(gs)]
            rows = src.join(table, on).drop(*[f"k{i}" for i in range(len(keys))])
            eta = sum((xs[i] * F.col("_b")[i] for i in range(1, p)), xs[0] * F.col("_b")[0])
        rows = rows.withColumn("_eta", eta).withColumn("_u", inverse(F.col("_eta"), _Cols))
        if family == "binomial":
            rows = rows.withColumn("_u", F.least(F.greatest("_u", F.lit(1e-12)), F.lit(1 - 1e-12)))
        du = slope(F.col("_eta"), _Cols)
        v = variance(F.col("_u"))
        rows = rows.withColumn("_w", du * du / v).withColumn("_z", F.col("_eta") + (F.col("y") - F.col("_u")) / du)
        total = lambda c: F.sum(c * F.col("n"))  # noqa: E731  over equal rows
        sums = [total(F.col("_w") * xs[i] * xs[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)] + [total(F.col("_w") * xs[i] * F.col("_z")).alias(f"t{i}") for i in range(p)]
        u_, y_ = F.col("_u"), F.col("y")
        terms = _likelihood(family, y_, u_)
        got = rows.groupBy(*[f"g{i}" for i in range(len(keys))]).agg(F.sum("n").alias("n"), total((y_ - u_) * (y_ - u_) / v).alias("pearson"), *[total(t).alias(f"l{i}") for i, t in enumerate(terms)], *sums)
        moved = 0.0
        for r in got.toLocalIterator():
            key = tuple(r[f"g{i}"] for i in range(len(keys)))
            if open_ is not None and key not in open_:
                continue
            m, t = np.zeros((p, p)), np.array([r[f"t{i}"] for i in range(p)], dtype=float)
            for i in range(p):
                for j in range(i, p):
                    m[i, j] = m[j, i] = r[f"s{i}_{j}"]
            old = beta.get(key)
            if old is not None:
                state[key] = {"m": m, "n": r["n"], "pearson": r["pearson"], "ll": _log_likelihood(family, [r[f"l{i}"] for i in range(len(terms))], r["n"]), "it": it - 1}
            new = np.linalg.lstsq(m, t, rcond=None)[0]
            done = old is not None and np.max(np.abs(new - old) / (np.abs(old) + 1e-8)) < tolerance
            if done:
                open_ = (open_ if open_ is not None else set(beta)) - {key}
            else:
                beta[key] = new
                moved = 1.0
        if not moved:
            break
    else:
        warnings.warn(f"{len(open_ if open_ is not None else beta)} model(s) did not converge in {max_iter} iterations", stacklevel=4)
    fits = []
    for key, s in state.items():
        b, inv = beta[key], pinv(s["m"])
        disp = s["pearson"] / max(s["n"] - p, 1) if family in _DISPERSED else 1.0
        se = np.sqrt(np.maximum(np.diag(inv) * disp, 0))
        z = b / np.where(se == 0, np.nan, se)
        pv = [dist.t_two_sided(v, s["n"] - p) if family in _DISPERSED else dist.normal_two_sided(v) for v in z]
        ev = np.linalg.eigvalsh(s["m"])
        fits.append(Fit(d, key, b, se, z, np.array(pv), s["n"], whole.get(key, s["n"]) - s["n"], {"log_likelihood": s["ll"], "num_iterations": s["it"], "dispersion": disp, "condition_no": math.sqrt(max(ev) / max(min(ev), 1e-300)), "odds_ratios": np.exp(b) if family == "binomial" else None, "z_stats": z, "vcov": inv * disp}, family, link))
    return _result(fits, d)


def linear_score(f: Fit, frame: Frame) -> Column:
    x = f.design.over(frame).matrix
    return sum((c * float(b) for c, b in zip(x[1:], f.coef[1:], strict=True)), x[0] * float(f.coef[0]))


def _coefficients(fits: list[Fit], frame: Frame) -> Column:
    """The coefficients of a row's group as an array, null for a group that has none. They are one constant of the plan, in buckets by
    the checksum of the key, so that a row looks at a few keys whatever the number of groups."""
    keys = [dict(zip(frame.names, (c.expr for c in frame.cols), strict=True))[g] for g in fits[0].design.groups]
    kinds = T.StructType([T.StructField(f"g{i}", f.dataType) for i, f in enumerate(frame.source.select(*keys).schema.fields)])
    spark = frame.base.sparkSession
    texts = [r[0] for r in spark.createDataFrame([(*f.group, k) for k, f in enumerate(fits)], T.StructType([*kinds.fields, T.StructField("k", T.LongType())])).orderBy("k").select(key_text([F.col(f"g{i}") for i in range(len(keys))])).toLocalIterator()]
    size = max(1, len(fits) // 4)
    buckets: list[dict] = [{} for _ in range(size)]
    for t, f in zip(texts, fits, strict=True):
        buckets[zlib.crc32(t.encode()) % size][t] = [None if math.isnan(b) else b for b in f.coef.tolist()]
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,array<double>>>")
    text = key_text(keys)
    return table[F.pmod(F.crc32(text.cast("binary")), F.lit(size)).cast("int")][text]


def predict(model, newdata: Frame | None = None, type: str = "response") -> Frame:  # noqa: A002
    """Fitted values as a column of newdata. Binomial: "response" is score > 0 (true or false), "prob" the probability.
    Poisson responses are rounded. Rows of no training group are null."""
    fits = model.fits if isinstance(model, Grouped) else [model]
    f = fits[0]
    frame = newdata if newdata is not None else f.design.frame
    if f.design.groups:
        x, b = f.design.over(frame).matrix, _coefficients(fits, frame)
        eta = F.aggregate(F.zip_with(F.array(*x), b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    else:
        eta = linear_score(f, frame)
    mean = _LINKS[f.link][0](eta, _Cols)
    value = (mean if type == "prob" else mean >= 0.5) if f.family == "binomial" else F.round(mean) if f.family == "poisson" and type == "response" else mean
    return frame._with([Col("predict", value)], order=())


def residuals(model) -> Frame:
    f = model.fits[0] if isinstance(model, Grouped) else model
    frame = f.design.frame if isinstance(model, Grouped) else f.data
    kind = "prob" if f.family == "binomial" else "mean"
    return frame._with([Col("residual", f.design.over(frame).y - predict(model, frame, kind).cols[0].expr.cast("double"))], order=())


def vcov(f: Fit) -> np.ndarray:
    return f.extra["vcov"]


def log_lik(f: Fit) -> tuple[float, int]:
    """(log likelihood, degrees of freedom)."""
    p = len(f.coef)
    if f.family == "gaussian" and f.link == "identity":
        return 0.5 * -f.n * (math.log(2 * math.pi) + 1 - math.log(f.n) + math.log(f.extra["rss"])), p + 1
    return f.extra["log_likelihood"], p


def extract_aic(f: Fit, k: float = 2) -> tuple[int, float]:
    p = len(f.coef)
    if f.family == "gaussian" and f.link == "identity":
        return p, f.n * math.log(f.extra["rss"] / f.n) + k * p
    return p, -2 * f.extra["log_likelihood"] + k * p


def aic(f: Fit, k: float = 2) -> float:
    ll, df = log_lik(f)
    return -2 * ll + k * df


# ------------------------------------------------------------------ elastic net


@dataclass
class ElasticNet:
    design: Design
    coef: np.ndarray
    intercept: float
    loglik: float
    iterations: int
    family: str
    scale: np.ndarray
    center: np.ndarray

    def predict(self, newdata: Frame | None = None, type: str = "response") -> Frame:  # noqa: A002
        frame = newdata if newdata is not None else self.design.frame
        x = self.design.over(frame).matrix
        eta = F.lit(float(self.intercept))
        for c, b in zip([m for m, n in zip(x, self.design.names, strict=True) if n != "(Intercept)"], self.coef, strict=True):
            eta = eta + c * float(b)
        if self.family == "binomial":
            eta = 1 / (1 + F.exp(-eta)) if type == "prob" else eta > 0
        return frame._with([Col("predict", eta)], order=())


def _descend(xx, xy, n, b, lam, alpha, max_iter, tol):
    """Cyclic coordinate descent on mean products: minimises half the quadratic form minus xy b plus the penalty."""
    for it in range(1, max_iter + 1):
        change = 0.0
        for i in range(len(b)):
            if xx[i, i] <= 0:
                continue
            z = xy[i] - xx[i] @ b + xx[i, i] * b[i]
            new = math.copysign(max(abs(z) - alpha * lam, 0.0), z) / (xx[i, i] + lam * (1 - alpha))
            change = max(change, abs(new - b[i]) / (abs(b[i]) + 1e-10) if new or b[i] else 0.0)
            b[i] = new
        if change < tol:
            break
    return it


def elnet(formula: str, data: Frame, family: str = "gaussian", alpha: float = 1.0, lambda_: float = 0.1, standardize: bool = True, method: str = "cd", na_action=None, glmnet: bool = False, max_iter: int = 1000, tolerance: float = 1e-7, warmup: bool = False, warmup_lambda_no: int = 15) -> ElasticNet:
    """Elastic net; all methods (fista, igd, sgd, cd) share one optimum, which coordinate descent finds on the Gram matrix.
    Gaussian: one scan. Binomial: one scan for each Newton step."""
    if method not in ("fista", "igd", "sgd", "cd"):
        raise ValueError(f"no method {method}")
    if not 0 <= alpha <= 1 or lambda_ < 0:
        raise ValueError("alpha is from 0 to 1 and lambda 0 or more")
    d = _prepared(formula, data, na_action)
    if d.groups:
        raise ValueError("elastic net has no groups")
    keep = [k for k, n in enumerate(d.names) if n != "(Intercept)"]
    x, y, p = [d.matrix[k] for k in keep], d.y, len(keep)
    src = d.frame.source.select(*[c.alias(f"x{i}") for i, c in enumerate(x)], y.alias("y")).dropna()
    xs = [F.col(f"x{i}") for i in range(p)]
    m, n = next(iter(gram(src, [*xs, F.col("y"), F.lit(1.0)]).values()))
    mean = m[:p, p + 1] / n if d.intercept else np.zeros(p)
    my = m[p, p + 1] / n if d.intercept else 0.0
    cov = m[: p + 1, : p + 1] / n - np.outer(np.r_[mean, my], np.r_[mean, my])
    sd = np.sqrt(np.maximum(np.diag(cov)[:p], 0)) if standardize else np.ones(p)
    sd = np.where(sd == 0, 1.0, sd)
    b = np.zeros(p)
    if family == "gaussian":
        sy = math.sqrt(max(cov[p, p], 1e-300)) if glmnet else 1.0
        its = _descend(cov[:p, :p] / np.outer(sd, sd), cov[:p, p] / sd, n, b, lambda_ if not glmnet else lambda_, alpha, max_iter, tolerance)
        beta = b / sd
        b0 = my - mean @ beta if d.intercept else 0.0
        rss = n * (cov[p, p] - 2 * beta @ cov[:p, p] + beta @ cov[:p, :p] @ beta)
        return ElasticNet(d, beta, b0, -(rss / n / 2 + lambda_ * ((1 - alpha) / 2 * b @ b + alpha * np.abs(b).sum())) / (sy * sy if glmnet else 1), its, family, sd, mean)
    zs = [(c - float(a)) / float(s) for c, a, s in zip(xs, mean, sd, strict=True)]
    path = [*np.exp(np.linspace(math.log(100 * lambda_), math.log(lambda_), warmup_lambda_no)).tolist()] if warmup and lambda_ > 0 else [lambda_]
    b0, its = 0.0, 0
    for lam in path:
        for _ in range(50):
            eta = sum((z * float(v) for z, v in zip(zs, b, strict=True)), F.lit(float(b0)))
            pr = 1 / (1 + F.exp(-eta))
            w = F.greatest(pr * (1 - pr), F.lit(1e-6))
            r = src.select(*[z.alias(f"z{i}") for i, z in enumerate(zs)], w.alias("w"), (eta + (F.col("y") - pr) / w).alias("t"), F.when(F.col("y") > 0.5, -F.ln(1 + F.exp(-eta))).otherwise(-F.ln(1 + F.exp(eta))).alias("ll"))
            root = F.sqrt("w")
            m, n = next(iter(gram(r, [*[F.col(f"z{i}") * root for i in range(p)], root * F.col("t"), root]).values()))
            m = m / n
            new, old0 = b.copy(), b0
            sw = m[p + 1, p + 1]
            zw, tw = (m[:p, p + 1] / sw, m[p, p + 1] / sw) if d.intercept else (np.zeros(p), 0.0)
            its += 1
            _descend(m[:p, :p] - sw * np.outer(zw, zw), m[:p, p] - sw * zw * tw, n, new, lam, alpha, max_iter, tolerance)
            b0 = tw - zw @ new if d.intercept else 0.0
            step = max(np.max(np.abs(new - b), initial=0.0), abs(b0 - old0))
            b = new
            if step < max(tolerance, 1e-8):
                break
    ll = r.agg(F.avg("ll")).first()[0] - lambda_ * ((1 - alpha) / 2 * b @ b + alpha * np.abs(b).sum())
    beta = b / sd
    return ElasticNet(d, beta, b0 - mean @ beta, ll, its, family, sd, mean)
