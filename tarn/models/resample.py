"""Cross-validation and bagging."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tarn.frame import Col, Frame
from tarn.operators.order import sample
from tarn.sources.catalog import keep


def folds(data: Frame, k: int = 10, approximate: bool = True, seed: int = 0) -> list[tuple[Frame, Frame]]:
    """(training, validation) frames of k folds; the fold of a row is stored before it is used. Exact folds differ by one row at most
    and come from numbers within and counts of partitions."""
    df = data.df
    if approximate:
        cut = keep(df.withColumn("_fold", F.floor(F.rand(seed) * k).cast("int")))
    else:
        rows = keep(df.orderBy(F.rand(seed)).withColumn("_at", F.monotonically_increasing_id()))
        parts = rows.groupBy(F.shiftright("_at", 33).alias("p")).count().orderBy("p").collect()  # one row a partition
        first, at = {}, 0
        for p, n in parts:
            first[p] = at
            at += n
        table = F.broadcast(df.sparkSession.createDataFrame(list(first.items()) or [(0, 0)], "p long, f long"))
        number = F.col("f") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
        cut = keep(rows.join(table, F.shiftright("_at", 33) == F.col("p")).withColumn("_fold", (number % k).cast("int")).drop("_at", "p", "f"))
    meta = {c.name: c.meta for c in data.cols}

    def part(cond) -> Frame:
        d = cut.filter(cond).drop("_fold")
        return Frame(d, [Col(c, F.col(f"`{c}`"), meta[c]) for c in d.columns], key=data.key)

    return [(part(F.col("_fold") != i), part(F.col("_fold") == i)) for i in range(k)]


def _number(v) -> float:
    return float(v.df.first()[0]) if isinstance(v, Frame) else float(v)


def cross_validate(train, predict, metric, data: Frame, params: dict[str, list] | None = None, k: int = 10, approximate: bool = True, find_min: bool = True, seed: int = 0):
    """Without params: mean and deviation of the folds' metric. With params (recycled to the longest list): those for each
    setting, the best setting, and the model refitted with it on all rows."""
    parts = folds(data, k, approximate, seed)
    n = max(map(len, params.values())) if params else 1
    grid = [{name: v[i % len(v)] for name, v in (params or {}).items()} for i in range(n)]
    values = np.array([[_number(metric(predict(train(a, **g), b), b)) for a, b in parts] for g in grid])
    mean, sd = values.mean(axis=1), values.std(axis=1, ddof=1) if k > 1 else np.zeros(n)
    if not params:
        return {"err": float(mean[0]), "err.std": float(sd[0])}
    best = int(np.argmin(mean) if find_min else np.argmax(mean))
    return {"metric": pd.DataFrame(grid).assign(avg=mean, std=sd), "values": values, "params": grid[best], "best": train(data, **grid[best])}


@dataclass
class Bagging:
    models: list
    predict_one: object

    def predict(self, newdata: Frame, combine: str = "mean") -> Frame:
        """combine "mean": the mean of the predictions (boolean: over half are true). "vote": the most frequent; of ties the smallest."""
        own = [self.predict_one(m, newdata).cols[0].expr for m in self.models]
        kind = newdata.source.select(own[0].alias("p")).schema[0].dataType.simpleString()
        if combine == "mean":
            share = sum((c.cast("int") if kind == "boolean" else c.cast("double") for c in own[1:]), own[0].cast("int") if kind == "boolean" else own[0].cast("double")) / float(len(own))
            out = share > 0.5 if kind == "boolean" else share
        else:
            a = F.array_sort(F.array(*own))
            ranked = F.transform(F.array_distinct(a), lambda v: F.struct((-F.size(F.filter(a, lambda u: u == v))).alias("n"), v.alias("v")))
            out = F.array_min(ranked)["v"]
        return newdata._with([Col("predict", out)], order=())


def bagging(train, data: Frame, nbags: int = 10, fraction: float = 1.0, predict=None, seed: int = 0) -> Bagging:
    """Models of nbags bootstrap samples of int(n * fraction) rows."""
    from tarn.models.regression import predict as standard

    size = int(data.df.count() * fraction)
    return Bagging([train(sample(data, size, True, seed + b)) for b in range(nbags)], predict or standard)
