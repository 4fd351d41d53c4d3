"""Average marginal effects with standard errors by the delta method."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tarn.frame import Frame
from tarn.models import dist
from tarn.models.regression import Fit, Grouped
from tarn.plans.formula import column_of, derivative, variables


def model_vars(f: Fit) -> list[str]:
    """The variables of a model, in order."""
    out: list[str] = []
    for t in f.design.trees:
        out += [v for v in sorted(variables(t)) if v not in out]
    return list(dict.fromkeys(v.split("|")[0] for v in out))


def model_terms(f: Fit, which: list[int] | None = None) -> list[str]:
    names = [n for n in f.design.names if n != "(Intercept)"]
    return names if which is None else [names[k - 1] for k in which]


def margins(model, dydx: list[str] | None = None, newdata: Frame | None = None, at_mean: bool = False, factor_continuous: bool = False) -> pd.DataFrame:
    """A row for each variable (each level of a factor): effect, error, t or z, p. All averages are one aggregate.

    Continuous variables: the mean derivative of the response. Factors: the mean difference of the response with the level and
    with the reference, the other levels' dummies 0."""
    if isinstance(model, Grouped):
        return pd.concat([margins(f, dydx, newdata, at_mean, factor_continuous).assign(group=[f.group] * 0 or str(f.group)) for f in model], ignore_index=True)
    f: Fit = model
    d = f.design.over(newdata) if newdata is not None else f.design.over(f.data)
    logit = f.family == "binomial"
    cols, src = dict(d.cols), d.frame.source
    needed = sorted(set().union(*[variables(t) for t in d.trees]))
    if at_mean:
        row = src.agg(*[F.avg(cols[v].cast("double")).alias(f"m{k}") for k, v in enumerate(needed)]).first()
        cols |= {v: F.lit(float(row[k])) for k, v in enumerate(needed)}
        src = src.limit(1)

    def score(own):
        return sum((column_of(t, own).cast("double") * float(b) for t, b in zip(d.trees, f.coef, strict=True)), F.lit(0.0))

    def sigma(e):
        return 1 / (1 + F.exp(-e))

    eta = score(cols)
    effects, jac, labels = [], [], []
    p = len(f.coef)
    for v in dydx or model_vars(f):
        if v in d.factors and not factor_continuous:
            ref, others = d.factors[v]
            for lv in others:
                one = cols | {f"{v}|{o}": F.lit(float(o == lv)) for o in others}
                zero = cols | {f"{v}|{o}": F.lit(0.0) for o in others}
                x1, x0 = [column_of(t, one).cast("double") for t in d.trees], [column_of(t, zero).cast("double") for t in d.trees]
                if logit:
                    s1, s0 = sigma(score(one)), sigma(score(zero))
                    effects.append(s1 - s0)
                    jac.append([s1 * (1 - s1) * a - s0 * (1 - s0) * b for a, b in zip(x1, x0, strict=True)])
                else:
                    effects.append(score(one) - score(zero))
                    jac.append([a - b for a, b in zip(x1, x0, strict=True)])
                labels.append(f"{v}{lv}")
            continue
        for name in [v] if v not in d.factors else [f"{v}|{lv}" for lv in d.factors[v][1]]:
            dx = [column_of(derivative(t, name), cols).cast("double") for t in d.trees]
            de = sum((c * float(b) for c, b in zip(dx, f.coef, strict=True)), F.lit(0.0))
            if logit:
                s = sigma(eta)
                x = [column_of(t, cols).cast("double") for t in d.trees]
                effects.append(s * (1 - s) * de)
                jac.append([s * (1 - s) * (a + (1 - 2 * s) * de * b) for a, b in zip(dx, x, strict=True)])
            else:
                effects.append(de)
                jac.append(dx)
            labels.append(name.replace("|", ""))
    got = src.agg(*[F.avg(e) for e in effects], *[F.avg(c) for r in jac for c in r]).first()
    effect = np.array(got[: len(effects)], dtype=float)
    j = np.array(got[len(effects) :], dtype=float).reshape(len(effects), p)
    se = np.sqrt(np.maximum(np.einsum("ij,jk,ik->i", j, f.extra["vcov"], j), 0))
    stat = effect / np.where(se == 0, np.nan, se)
    pv = [dist.normal_two_sided(s) if logit else dist.t_two_sided(s, f.n - p) for s in stat]
    return pd.DataFrame({"variable": labels, "estimate": effect, "std_error": se, "z" if logit else "t": stat, "p_value": pv})
