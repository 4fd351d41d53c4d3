"""Cross products, scaling, principal components: one scan of Spark aggregates, small matrices on the driver."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.frame import Col, Frame
from tarn.operators.arrays import expand

WIDE = 40  #: up to so many columns the products are aggregate expressions; beyond, tasks sum matrices
HELD = 8_000_000  #: numbers of partial matrices that a task holds before it hands them on
_STAMPS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def key_text(columns: list) -> Column:
    """A group key as text: JSON of its values, whatever their types; group_of() reads it back."""
    return F.to_json(F.struct(*[c.alias(f"g{i}") for i, c in enumerate(columns)]), _STAMPS) if columns else F.lit("{}")


def group_of(text: Column, kinds: T.StructType) -> Column:
    return F.from_json(text, kinds, _STAMPS)


def gram(df, cols: list, groups: list | None = None):
    """{group key: (sum of x xT, rows)} for columns x, rows with a null left out."""
    groups = groups or []
    p, g = len(cols), len(groups)
    names = [f"x{i}" for i in range(p)]
    named = df.select(*[c.alias(f"g{i}") for i, c in enumerate(groups)], *[c.cast("double").alias(n) for c, n in zip(cols, names, strict=True)]).dropna(subset=names)
    if p <= WIDE:
        sums = [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]
        out = {}
        for r in named.groupBy(*[f"g{i}" for i in range(g)]).agg(F.count("*").alias("n"), *sums).toLocalIterator():
            m = np.zeros((p, p))
            for i in range(p):
                for j in range(i, p):
                    m[i, j] = m[j, i] = r[f"s{i}_{j}"] or 0.0
            out[tuple(r[f"g{i}"] for i in range(g))] = (m, r["n"])
        return out

    def rows(total: dict) -> pd.DataFrame:
        """A row for each row of each matrix, so that they are summed apart."""
        keys, at, n, values = [], [], [], []
        for key, (m, count) in total.items():
            keys += [key] * p
            at += range(p)
            n += [count] * p
            values += list(m)
        return pd.DataFrame({"key": keys, "i": at, "n": n, "m": values})

    def part(batches):
        total: dict = {}
        for b in batches:
            for key, own in b.groupby("key", sort=False):
                x = own[names].to_numpy()
                m, n = total.get(key, (np.zeros((p, p)), 0))
                total[key] = (m + x.T @ x, n + len(x))
            if len(total) * p * p > HELD:
                yield rows(total)
                total = {}
        if total:
            yield rows(total)

    def whole(own: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": [own["key"].iloc[0]], "i": [own["i"].iloc[0]], "n": [own["n"].sum()], "m": [np.stack(own["m"].to_numpy()).sum(axis=0)]})

    keyed = named.select(key_text([F.col(f"g{i}") for i in range(g)]).alias("key"), *names)
    schema = "key string, i int, n long, m array<double>"
    kinds = T.StructType([f for f in named.schema.fields if f.name not in names])
    got = keyed.mapInPandas(part, schema).groupBy("key", "i").applyInPandas(whole, schema)  # of a group: a row from each task
    out = {}
    for r in got.select(group_of(F.col("key"), kinds).alias("g") if g else F.lit(None).alias("g"), "i", "n", "m").toLocalIterator():
        m, _ = out.setdefault(tuple(r["g"]) if g else (), (np.zeros((p, p)), r["n"]))
        m[r["i"]] = r["m"]
    return out


def crossprod(x: Frame, y: Frame | None = None) -> np.ndarray:
    """XtX, or XtY of frames of one lineage. Rows with nulls are left out."""
    a = expand(x)
    if y is None:
        return next(iter(gram(a.source, [c.expr for c in a.cols]).values()))[0]
    x.need_lineage(y)
    b = expand(y)
    p = len(a.cols)
    return next(iter(gram(a.source, [c.expr for c in [*a.cols, *b.cols]]).values()))[0][:p, p:]


def scale(x: Frame, center=True, scale=True) -> tuple[Frame, dict]:  # noqa: A002
    """(the scaled frame, its statistics). The deviation is the root mean square about the centre, by n - 1; 0 counts as 1."""
    a = expand(x)
    row = a.source.agg(F.count("*").alias("n"), *[F.avg(c.expr.cast("double")).alias(f"m{i}") for i, c in enumerate(a.cols)], *[F.var_pop(c.expr.cast("double")).alias(f"v{i}") for i, c in enumerate(a.cols)]).first()
    n, p = row["n"], len(a.cols)
    mean = np.array([row[f"m{i}"] for i in range(p)], dtype=float)
    centre = mean if center is True else np.zeros(p) if center is False else np.asarray(center, dtype=float)
    if scale is True:
        dev = np.sqrt((np.array([row[f"v{i}"] for i in range(p)], dtype=float) + (mean - centre) ** 2) * n / max(n - 1, 1))
    else:
        dev = np.ones(p) if scale is False else np.asarray(scale, dtype=float)
    dev = np.where(dev == 0, 1.0, dev)
    out = a._with([Col(c.name, (c.expr.cast("double") - float(m)) / float(s)) for c, m, s in zip(a.cols, centre, dev, strict=True)])
    return out, {"scaled:center": centre, "scaled:scale": dev, "row.number": n}


def pinv(m: np.ndarray) -> np.ndarray:
    return np.linalg.pinv(m, rcond=float(np.sqrt(np.finfo(float).eps)))


def pca(x: Frame, scaled: bool = True) -> dict:
    """Standard deviations and loadings of the principal components."""
    z, stats = scale(x, True, scaled)
    values, vectors = np.linalg.eigh(crossprod(z) / max(stats["row.number"] - 1, 1))
    order = np.argsort(-values)
    return {"sdev": np.sqrt(np.maximum(values[order], 0)), "rotation": vectors[:, order], **stats}


def ols(x: Frame, y: Frame) -> np.ndarray:
    return np.linalg.solve(crossprod(x), crossprod(x, y)).ravel()
