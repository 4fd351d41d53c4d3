"""ARIMA by conditional sum of squares and Levenberg-Marquardt.

The errors of a chunk of the series are linear in the q errors before it. So a task returns, for each of its chunks and each set of
parameters that a step needs, the products of these errors' parts and how the chunk carries errors on; the driver links
the chunks, a small row for each CHUNK points, and no task and not the driver holds the series. A step is one pass over the
stored chunks. A series of at most CHUNK points is one chunk, and is fitted where it was collected."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.frame import Frame
from tarn.operators.order import number_rows
from tarn.sources.catalog import keep, ship

CHUNK = 10_000  #: points of a chunk


@dataclass
class Arima:
    coef: dict[str, float]
    std_err: dict[str, float]
    sigma2: float
    loglik: float
    iterations: int
    exec_time: float
    order: tuple[int, int, int]
    tail: np.ndarray  #: the last points, as many as a forecast needs
    errors: np.ndarray  #: the last q errors, the latest first
    chunks: DataFrame | None = None  #: of a series of several chunks
    local: np.ndarray | None = None  #: a series of one
    states: list = field(default_factory=list)

    def forecast(self, n_ahead: int = 10) -> pd.DataFrame:
        p, d, q = self.order
        w = np.diff(self.tail, d)
        mean = self.coef.get("mean", 0.0)
        x, e = list(w - mean), list(self.errors[::-1])
        for _ in range(n_ahead):
            x.append(sum(self.coef[f"ar{i + 1}"] * x[-1 - i] for i in range(p)) + sum(self.coef[f"ma{i + 1}"] * e[-1 - i] for i in range(q)))
            e.append(0.0)
        out = np.array(x[len(w) :]) + mean
        for k in range(d, 0, -1):
            out = np.cumsum(out) + np.diff(self.tail, k - 1)[-1]
        return pd.DataFrame({"steps_ahead": np.arange(1, n_ahead + 1), "forecast_value": out})

    def residuals(self):
        """Of one chunk: an array, from point p + d on. Else a frame of the number of each point (from 0) and its residual."""
        p, d, q = self.order
        b = np.array([list(self.coef.values())])
        if self.chunks is None:
            return _parts(np.diff(self.local, d), b, p, q, "mean" in self.coef)[q:, 0, 0]
        states, mean = self.states, "mean" in self.coef

        def run(batches):
            for batch in batches:
                for c, first, v in zip(batch["chunk"], batch["first"], batch["v"], strict=True):
                    e = _parts(np.diff(np.asarray(v), d), b, p, q, mean)[q:, 0] @ np.r_[1.0, states[c]]
                    yield pd.DataFrame({"point": first + p + d + np.arange(len(e)), "residual": e})

        return Frame(self.chunks.mapInPandas(run, "point long, residual double"), key="point")


def _parts(w: np.ndarray, b: np.ndarray, p: int, q: int, mean: bool) -> np.ndarray:
    """Errors of w from its point p on, by point, set of parameters (a row of b), and part: that without errors before, and that of each
    of the q errors before (the latest first). The first q points are those errors themselves."""
    x = w[:, None] - (b[:, -1] if mean else 0.0)
    y = x[p:] - sum((b[:, k] * x[p - 1 - k : len(x) - 1 - k] for k in range(p)), np.zeros((max(len(x) - p, 0), len(b))))
    e = np.zeros((q + len(y), len(b), 1 + q))
    for k in range(q):
        e[q - 1 - k, :, 1 + k] = 1.0
    e[q:, :, 0] = y
    if q:
        theta = b[:, p : p + q, None]
        for t in range(q, len(e)):
            e[t] -= (theta * e[t - q : t][::-1].transpose(1, 0, 2)).sum(axis=1)
    return e


def _chunk(w: np.ndarray, b: np.ndarray, p: int, q: int, mean: bool) -> tuple[np.ndarray, np.ndarray]:
    """Products of the parts of all sets of parameters, and the q errors that end the chunk (the latest first) by part."""
    e = _parts(w, b, p, q, mean)
    flat = e[q:].reshape(len(e) - q, -1)
    return flat.T @ flat, e[::-1][:q].transpose(1, 0, 2)


def _minimise(stats, p: int, q: int, mean: bool, start: float, points: int, max_iter: int, tolerance: float):
    """stats(b): products and carried errors of every chunk, in order. Returns b, sum of squares, J'J, steps."""

    def at(b: np.ndarray):
        h = 1e-6 * np.maximum(1.0, np.abs(b))
        sets = np.array([b, *[b + s * h[k] * (np.arange(len(b)) == k) for k in range(len(b)) for s in (1, -1)]])
        products, m = np.zeros((len(sets), len(sets))), 1 + q
        state = np.zeros((len(sets), q))
        for gram, carry in stats(sets):
            v = np.concatenate([np.ones((len(sets), 1)), state], axis=1)
            products += np.einsum("ia,iajb,jb->ij", v, gram.reshape(len(sets), m, len(sets), m), v)
            state = np.einsum("iqa,ia->iq", carry, v)
        d = (np.eye(len(sets))[1::2] - np.eye(len(sets))[2::2]) / (2 * h[:, None]) if len(b) else np.zeros((0, 1))
        return products[0, 0], d @ products @ d.T, d @ products[:, 0]

    b = np.zeros(p + q + mean)
    if mean:
        b[-1] = start
    damp, it = 1e-3, 0
    sse, a, g = at(b)
    while it < max_iter and len(b):
        it, better = it + 1, None
        for _ in range(30):
            new = b - np.linalg.solve(a + damp * np.diag(np.maximum(np.diag(a), 1e-12)), g)
            got = at(new)
            if got[0] <= sse:
                damp, better = max(damp / 10, 1e-12), got
                break
            damp *= 10
        if better is None:
            break
        small = sse - better[0] <= tolerance * max(sse, 1e-300)
        b, (sse, a, g) = new, better
        if small:
            break
    return b, sse, a, it


def _fitted(stats, order, mean: bool, start: float, points: int, tail: np.ndarray, began: float, max_iter: int, tolerance: float) -> Arima:
    p, d, q = order
    b, sse, a, it = _minimise(stats, p, q, mean, start, points, max_iter, tolerance)
    n = points - d - p
    s2 = float(sse) / n
    names = [f"ar{i + 1}" for i in range(p)] + [f"ma{i + 1}" for i in range(q)] + ["mean"] * mean
    se = np.sqrt(np.maximum(np.diag(np.linalg.pinv(a)) * s2, 0)) if len(b) else np.zeros(0)
    states, state = [], np.zeros(q)
    for _, carry in stats(b[None, :]):
        states.append(state)
        state = carry[0] @ np.r_[1.0, state]
    return Arima(dict(zip(names, b.tolist(), strict=True)), dict(zip(names, se.tolist(), strict=True)), s2, -n / 2 * (np.log(2 * np.pi * s2) + 1), it, time.time() - began, tuple(order), tail, state, states=states)


def fit(series: np.ndarray, order=(1, 1, 1), include_mean: bool = True, max_iter: int = 100, tolerance: float = 1e-10) -> Arima:
    """Of a series at hand, as one chunk."""
    began = time.time()
    p, d, q = order
    series = np.asarray(series, dtype=float)
    w, mean = np.diff(series, d), include_mean and d == 0
    out = _fitted(lambda b: [_chunk(w, b, p, q, mean)], order, mean, w.mean(), len(series), series[-(p + q + d + 1) :], began, max_iter, tolerance)
    out.local = series
    return out


def arima(x: Frame, ts: Frame | str, order=(1, 1, 1), include_mean: bool = True, max_iter: int = 100, tolerance: float = 1e-10) -> Arima:
    """Of one series: x in the order of ts. No seasons, no groups. Points of null are left out."""
    began = time.time()
    p, d, q = order
    t = x.col(ts) if isinstance(ts, str) else ts
    x.need_lineage(t)
    spark = x.base.sparkSession
    ship(spark)
    rows = x.source.select(t.cols[0].expr.alias("t"), x.cols[0].expr.cast("double").alias("v")).dropna().orderBy("t")
    numbered, total = number_rows(rows)
    if total <= CHUNK:
        return fit(numbered.orderBy("_row").select("v").toPandas()["v"].to_numpy(), order, include_mean, max_iter, tolerance)
    at = F.col("_row") % CHUNK
    also = F.when(at >= CHUNK - p - d, F.floor(F.col("_row") / CHUNK) + 1)  # the points that the next chunk's first ones look back to
    each = numbered.withColumn("chunk", F.explode(F.filter(F.array(F.floor(F.col("_row") / CHUNK), also), lambda c: c.isNotNull() & (c * CHUNK < total))))
    chunks = keep(each.groupBy("chunk").agg(F.min("_row").alias("first"), F.sort_array(F.collect_list(F.struct("_row", "v"))).getField("v").alias("v")))  # CHUNK points and a few
    mean = include_mean and d == 0
    start = numbered.agg(F.avg("v")).first()[0]
    tail = numbered.filter(F.col("_row") >= total - (p + q + d + 1)).orderBy("_row").toPandas()["v"].to_numpy()

    def stats(b: np.ndarray):
        def run(batches):
            for batch in batches:
                for c, v in zip(batch["chunk"], batch["v"], strict=True):
                    gram, carry = _chunk(np.diff(np.asarray(v), d), b, p, q, mean)
                    yield pd.DataFrame({"chunk": [c], "gram": [gram.ravel()], "carry": [carry.ravel()]})

        got = chunks.select("chunk", "v").mapInPandas(run, "chunk long, gram array<double>, carry array<double>").orderBy("chunk")
        size = len(b) * (1 + q)
        return [(np.array(r.gram).reshape(size, size), np.array(r.carry).reshape(len(b), q, 1 + q)) for r in got.toLocalIterator()]

    out = _fitted(stats, order, mean, start, total, tail, began, max_iter, tolerance)
    out.chunks = chunks
    return out


def arima_by_key(x: Frame, key: str, ts: str, value: str, order=(1, 1, 1), include_mean: bool = True) -> Frame:
    """A row of coefficients for each key, fitted in parallel, each series in one task."""

    def one(g: pd.DataFrame) -> pd.DataFrame:
        m = fit(g.sort_values("t")["v"].to_numpy(), order, include_mean)
        return pd.DataFrame({"key": [g["key"].iloc[0]], "names": [list(m.coef)], "coef": [list(m.coef.values())], "sigma2": [m.sigma2]})

    ship(x.base.sparkSession)
    rows = x.source.select(x.col(key).cols[0].expr.cast("string").alias("key"), x.col(ts).cols[0].expr.alias("t"), x.col(value).cols[0].expr.cast("double").alias("v")).dropna()
    return Frame(rows.groupBy("key").applyInPandas(one, "key string, names array<string>, coef array<double>, sigma2 double").withColumnRenamed("key", key).select(key, "names", "coef", "sigma2"))
