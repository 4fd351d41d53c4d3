"""Clustering, topics, trees, forests, support vectors: Spark ML where it matches, aggregates elsewhere."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.frame import Frame
from tarn.models import topics
from tarn.operators.arrays import expand
from tarn.operators.order import number_rows
from tarn.plans.formula import design
from tarn.sources.catalog import keep, ship


MAX_CLASSES = 1000  #: of a response
MAX_GROUPS = 1000  #: models of a grouped fit that takes a job for each; more are an error


def _group_keys(data: Frame, d) -> list[tuple]:
    found = data.source.select(*[d.cols[g].alias(g) for g in d.groups]).distinct().limit(MAX_GROUPS + 1).collect()
    if len(found) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups")
    return sorted(map(tuple, found), key=lambda k: [(v is not None, str(v)) for v in k])


# ------------------------------------------------------------------ k-means


@dataclass
class KMeans:
    centers: np.ndarray
    withinss: np.ndarray
    size: np.ndarray
    iterations: int
    assigned: Frame

    @property
    def tot_withinss(self) -> float:
        return float(self.withinss.sum())


_DISTANCES = {
    "squared_dist_norm2": lambda v, c: ((v - c) ** 2).sum(axis=1),
    "dist_norm2": lambda v, c: np.sqrt(((v - c) ** 2).sum(axis=1)),
    "dist_norm1": lambda v, c: np.abs(v - c).sum(axis=1),
}


def _nearest(v: np.ndarray, centers: np.ndarray, distance: str) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centre (of equal ones the first) and the distance to it; a centre at a time."""
    near, best = np.zeros(len(v), np.int64), np.full(len(v), np.inf)
    for k, c in enumerate(centers):
        d = _DISTANCES[distance](v, c)
        near, best = np.where(d < best, k, near), np.minimum(d, best)
    return near, best


def kmeans(x: Frame, centers, key: str, max_iter: int = 10, nstart: int = 1, distance: str = "squared_dist_norm2", kmeanspp: bool = False, min_frac: float = 0.001, seed: int = 0) -> KMeans:
    """centers: a number (random or ++ seeds), a matrix, or a frame of one row a center. Clusters are numbered from 1.
    The best of nstart runs by objective is returned."""
    cols = [c for c in expand(x).cols if c.name != key]
    if distance not in _DISTANCES:
        raise ValueError(f"no distance {distance}")
    p = len(cols)
    rows = x.source.select(next(c.expr for c in x.cols if c.name == key).alias("key"), F.array(*[c.expr.cast("double") for c in cols]).alias("v")).filter(F.col("key").isNotNull() & ~F.exists("v", lambda e: e.isNull()))
    rows = keep(rows)  # the arrays, once for all rounds
    best = None

    def sums(c: np.ndarray) -> np.ndarray:
        """A row for each centre: sums of the rows nearest to it, their number, their distances."""

        def part(batches):
            total = np.zeros((len(c), p + 2))
            for b in batches:
                v = np.stack(b["v"].to_numpy()) if len(b) else np.zeros((0, p))
                near, d = _nearest(v, c, distance)
                np.add.at(total, near, np.c_[v, np.ones(len(v)), d])
            yield pd.DataFrame({"cluster": range(len(c)), "s": list(total)})

        got = rows.select("v").mapInPandas(part, "cluster int, s array<double>").select("cluster", F.posexplode("s").alias("j", "s")).groupBy("cluster", "j").agg(F.sum("s").alias("s"))
        out = np.zeros((len(c), p + 2))
        for r in got.toLocalIterator():  # centres times columns
            out[r.cluster, r.j] = r.s
        return out

    def assign(c: np.ndarray):
        @F.pandas_udf("int")
        def near(v: pd.Series) -> pd.Series:
            return pd.Series(_nearest(np.stack(v.to_numpy()), c, distance)[0] + 1) if len(v) else pd.Series([], dtype="int32")

        return near

    ship(x.base.sparkSession)
    for run in range(nstart if isinstance(centers, int) else 1):
        if isinstance(centers, int):
            if kmeanspp:
                from pyspark.ml.clustering import KMeans as Ml
                from pyspark.ml.functions import array_to_vector

                fit = Ml(k=centers, initMode="k-means||", maxIter=1, seed=seed + run).fit(rows.select(array_to_vector("v").alias("features")))
                c = np.array(fit.clusterCenters())
            else:
                c = np.array([r.v for r in rows.orderBy(F.xxhash64("key", F.lit(seed + run))).limit(centers).collect()])
        elif isinstance(centers, Frame):
            c = expand(centers).df.toPandas().to_numpy(dtype=float)
        else:
            c = np.asarray(centers, dtype=float)
        moved, it = True, 0
        got = sums(c)
        while moved and it < max_iter:
            new = np.where(got[:, p : p + 1] > 0, got[:, :p] / np.maximum(got[:, p : p + 1], 1), c)
            moved, c, it = not np.allclose(new, c, rtol=1e-9, atol=1e-12), new, it + 1
            if moved:
                got = sums(c)

        model = KMeans(c, got[:, p + 1], got[:, p].astype(np.int64), it, Frame(rows.select(F.col("key").alias(key), assign(c)("v").alias("cluster"))))
        if best is None or model.tot_withinss < best.tot_withinss:
            best = model
    return best


# ------------------------------------------------------------------ topics


def _term_counts(data: Frame, docid: str, words: str, topic_num: int = 1):
    """Stored counts of words by document, in blocks, and the vocabulary: every word."""
    blocks = topics.blocks_of(data, docid, words, topic_num)
    return blocks, topics.vocabulary_of(blocks)


def lda(data: Frame, docid: str, words: str, topic_num: int, alpha: float, beta: float, iter_num: int = 20, nstart: int = 1, best: bool = True, seed: int = 0):
    """Topic model by expectation maximisation (no assignments of single tokens). The best of nstart by perplexity, or all."""
    blocks, vocabulary = _term_counts(data, docid, words, topic_num)
    fits = [topics.fit(blocks, vocabulary, docid, topic_num, alpha, beta, iter_num, seed + r) for r in range(nstart)]
    return (fits[0] if nstart == 1 else min(fits, key=lambda f: f.perplexity())) if best else fits


# ------------------------------------------------------------------ trees


@dataclass
class Pruned:
    """A tree cut back by cost complexity. Node k (0 is the root) has children left[k] and right[k] (0: a leaf), a column and a
    threshold (up to it: left), and stats: counts of classes, or number, sum and sum of squares."""

    left: list[int]
    right: list[int]
    var: list[int]
    at: list[float]
    stats: list[list[float]]
    classes: bool
    importance: np.ndarray

    def values(self) -> np.ndarray:
        """The prediction of every node."""
        return np.array([np.argmax(s) if self.classes else s[1] / s[0] for s in self.stats], dtype=float)

    def transform(self, rows: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector

        left, right, var, at, values = (np.array(v) for v in (self.left, self.right, self.var, self.at, self.values()))

        @F.pandas_udf("int")
        def leaf(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="int32")
            m, node = np.stack(x.to_numpy()), np.zeros(len(x), np.int64)
            while (inner := left[node] > 0).any():
                node = np.where(inner, np.where(m[np.arange(len(m)), var[node]] <= at[node], left[node], right[node]), node)
            return pd.Series(node.astype(np.int32))

        out = rows.withColumn("_leaf", leaf("_x")).withColumn("prediction", F.array(*[F.lit(float(v)) for v in values])[F.col("_leaf")])
        if self.classes:
            shares = [F.array(*[F.lit(float(v)) for v in np.array(s) / sum(s)]) for s in self.stats]
            out = out.withColumn("probability", array_to_vector(F.array(*shares)[F.col("_leaf")]))
        return out.drop("_leaf")

    @property
    def toDebugString(self) -> str:  # noqa: N802  as Spark's models have it
        def lines(k: int, depth: int) -> list[str]:
            pad = " " * depth
            if not self.left[k]:
                return [f"{pad}Predict: {self.values()[k]:g}"]
            return [f"{pad}If (feature {self.var[k]} <= {self.at[k]:g})", *lines(self.left[k], depth + 1), f"{pad}Else", *lines(self.right[k], depth + 1)]

        return "\n".join(lines(0, 0))


def _nodes(model, classes: bool) -> Pruned:
    """The nodes of a tree of Spark's."""
    out = Pruned([], [], [], [], [], classes, model.featureImportances.toArray() if hasattr(model, "featureImportances") else np.zeros(0))

    def walk(n) -> int:
        k = len(out.left)
        leaf = n.getClass().getSimpleName() == "LeafNode"
        out.left.append(0), out.right.append(0), out.stats.append(list(n.impurityStats().stats()))
        out.var.append(-1 if leaf else n.split().featureIndex()), out.at.append(0.0 if leaf else n.split().threshold())
        if not leaf:
            out.left[k], out.right[k] = walk(n.leftChild()), walk(n.rightChild())
        return k

    walk(model._call_java("rootNode"))
    return out


def prune(tree: Pruned, cp: float, minsplit: int = 0) -> Pruned:
    """The smallest subtree of least risk plus cp times the root's risk for each leaf; the risk is the number of rows of other classes, or
    the sum of squares about the mean. Nodes of fewer than minsplit rows are leaves."""

    def count(k: int) -> float:
        return sum(tree.stats[k]) if tree.classes else tree.stats[k][0]

    def risk(k: int) -> float:
        s = tree.stats[k]
        return sum(s) - max(s) if tree.classes else max(s[2] - s[1] * s[1] / s[0], 0.0)

    price = cp * risk(0)
    out = Pruned([], [], [], [], [], tree.classes, tree.importance)

    def cost(k: int) -> tuple[float, bool]:
        """Of the best subtree below k, and whether k stays inner."""
        own = risk(k) + price
        if not tree.left[k] or count(k) < minsplit:
            return own, False
        below = cost(tree.left[k])[0] + cost(tree.right[k])[0]
        return (own, False) if own < below or (price > 0 and own <= below * (1 + 1e-12)) else (below, True)

    def copy(k: int) -> int:
        at, inner = len(out.left), cost(k)[1]
        out.left.append(0), out.right.append(0), out.stats.append(tree.stats[k]), out.var.append(tree.var[k] if inner else -1), out.at.append(tree.at[k] if inner else 0.0)
        if inner:
            out.left[at], out.right[at] = copy(tree.left[k]), copy(tree.right[k])
        return at

    copy(0)
    return out


@dataclass
class Trees:
    """Models by group key; labels of classes in order of their index."""

    models: dict[tuple, object]
    design: object
    id: str
    labels: list[str] | None
    importance: dict = field(default_factory=dict)
    permuted: dict = field(default_factory=dict)

    def predict(self, newdata: Frame | None = None, type: str = "response") -> Frame:  # noqa: A002
        frame = newdata if newdata is not None else self.design.frame
        out = None
        for key, m in self.models.items():
            rows = m.transform(_features(self.design, frame, self.id, key))
            if self.labels is not None:
                from pyspark.ml.functions import vector_to_array

                names = F.array(*[F.lit(v) for v in self.labels])
                cols = [names[F.col("prediction").cast("int")].alias("estimated")] if type == "response" else [vector_to_array("probability")[k].alias(f"estimated_prob_{v}") for k, v in enumerate(self.labels)]
            else:
                cols = [F.col("prediction").alias("estimated")]
            own = rows.select(F.col("_id").alias(self.id), *cols)
            out = own if out is None else out.unionByName(own)
        return Frame(out, key=self.id)

    def text(self) -> str:
        return "\n".join(f"{k}\n{m.toDebugString}" for k, m in self.models.items())

    def get_tree(self, k: int = 1, group: tuple = ()) -> pd.DataFrame:
        """Tree k of a forest: a row for each node, children by row number (from 1, 0: none), variable, threshold, status, prediction."""
        m = self.models[group]
        t = m if isinstance(m, Pruned) else _nodes(m.trees[k - 1] if hasattr(m, "trees") else m, self.labels is not None)
        rows = [[le + 1 if le else 0, r + 1 if r else 0, self.design.names[v] if v >= 0 else None, at if v >= 0 else None, 1 if le else -1, p] for le, r, v, at, p in zip(t.left, t.right, t.var, t.at, t.values().tolist(), strict=True)]
        return pd.DataFrame(rows, columns=["left daughter", "right daughter", "split var", "split point", "status", "prediction"])


def _features(d, frame: Frame, id_: str, key: tuple = (), label=None, weights: str | None = None) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    over = d.over(frame)
    src = frame.source
    for g, v in zip(d.groups, key, strict=True):
        src = src.filter(over.cols[g].eqNullSafe(F.lit(v)))
    out = [over.cols[id_].alias("_id"), F.array(*over.matrix).alias("_x")]
    if label is not None:
        out.append(label(over).cast("double").alias("label"))
    if weights:
        out.append(over.cols[weights].cast("double").alias("_w"))
    rows = src.select(*out)
    return rows.filter(~F.exists("_x", lambda v: v.isNull()) & (F.col("label").isNotNull() if label is not None else F.lit(True))).withColumn("features", array_to_vector("_x"))


def _trees(formula: str, data: Frame, id: str, make, weights: str | None = None, after=None) -> Trees:  # noqa: A002
    from pyspark.sql import types as T

    left, _, right = formula.partition("~")
    rhs, _, by = right.partition("|")
    rhs = f"{rhs} - {id}" if "." in rhs else rhs
    d = design(f"{left}~{rhs}-1" + (f"|{by}" if by else ""), data)
    kind = data.source.select(d.dep.alias("y")).schema[0].dataType
    classes = isinstance(kind, (T.StringType, T.BooleanType)) or any(c.meta.factor for c in data.cols if c.name == left.strip())
    labels = sorted(r[0] for r in data.source.select(d.dep.cast("string").alias("y")).distinct().dropna().limit(MAX_CLASSES + 1).collect()) if classes else None
    if labels and len(labels) > MAX_CLASSES:
        raise ValueError(f"the response has more than {MAX_CLASSES} classes")
    label = (lambda o: F.array_position(F.array(*[F.lit(v) for v in labels]), o.dep.cast("string")) - 1) if classes else (lambda o: o.dep)
    keys = _group_keys(data, d) if d.groups else [()]
    models = {}
    for k in keys:
        fitted = make(classes).fit(_features(d, data, id, k, label, weights))
        models[k] = after(fitted, classes) if after else fitted
    imp = {k: dict(zip(d.names, (m.importance if after else m.featureImportances.toArray()).tolist(), strict=True)) for k, m in models.items()}
    return Trees(models, d, id, labels, imp)


def rpart(formula: str, data: Frame, id: str, weights: str | None = None, split: str = "gini", minsplit: int = 20, minbucket: int | None = None, maxdepth: int = 30, cp: float = 0.01, nbins: int = 100) -> Trees:  # noqa: A002
    """Decision tree of Spark's, cut back by cost complexity (cp) and minsplit; surrogates don't exist."""

    def make(classes: bool):
        from pyspark.ml.classification import DecisionTreeClassifier
        from pyspark.ml.regression import DecisionTreeRegressor

        own = {"maxDepth": min(maxdepth, 30), "maxBins": nbins, "minInstancesPerNode": minbucket or max(1, round(minsplit / 3))} | ({"weightCol": "_w"} if weights else {})
        return DecisionTreeClassifier(impurity={"gini": "gini", "entropy": "entropy", "information": "entropy"}[split], **own) if classes else DecisionTreeRegressor(**own)

    ship(data.base.sparkSession)
    return _trees(formula, data, id, make, weights, lambda m, classes: prune(_nodes(m, classes), cp, minsplit))


def random_forest(formula: str, data: Frame, id: str, ntree: int = 100, mtry: int | None = None, maxdepth: int = 3, minsplit: int = 20, minbucket: int | None = None, nbins: int = 100, seed: int = 0, importance: bool = False, nperm: int = 1) -> Trees:  # noqa: A002
    """Random forest. Its importance is the decrease of impurity; with importance=True also, as `permuted`, by how much the error grows when a
    column's values change places: Spark keeps no out-of-bag rows, so a second forest is fitted without a fifth of the rows, which judge."""

    def make(classes: bool):
        from pyspark.ml.classification import RandomForestClassifier
        from pyspark.ml.regression import RandomForestRegressor

        kind = RandomForestClassifier if classes else RandomForestRegressor
        return kind(numTrees=ntree, maxDepth=maxdepth, maxBins=nbins, minInstancesPerNode=minbucket or max(1, round(minsplit / 3)), featureSubsetStrategy=str(mtry) if mtry else "auto", seed=seed)

    out = _trees(formula, data, id, make)
    if importance:
        out.permuted = {k: _permuted(out, data, k, make, nperm, seed) for k in out.models}
    return out


def _permuted(t: Trees, data: Frame, key: tuple, make, nperm: int, seed: int) -> dict[str, float]:
    from pyspark.ml.functions import array_to_vector

    classes = t.labels is not None
    label = (lambda o: F.array_position(F.array(*[F.lit(v) for v in t.labels]), o.dep.cast("string")) - 1) if classes else (lambda o: o.dep)
    rows = _features(t.design, data, t.id, key, label).drop("features")
    fifth = F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(5)) == 0
    held, _ = number_rows(rows.filter(fifth))
    model = make(classes).fit(rows.filter(~fifth).withColumn("features", array_to_vector("_x")))

    def error(d: DataFrame) -> float:
        wrong = (F.col("prediction") != F.col("label")).cast("double") if classes else (F.col("prediction") - F.col("label")) ** 2
        return model.transform(d.withColumn("features", array_to_vector("_x"))).agg(F.avg(wrong)).first()[0] or 0.0

    base, out = error(held), {}
    for j, name in enumerate(t.design.names):
        more = []
        for r in range(nperm):
            other, _ = number_rows(held.select(F.col("_x")[j].alias("_v")).orderBy(F.rand(seed + r)))
            x = F.concat(F.slice("_x", 1, j), F.array("_v"), F.slice("_x", j + 2, len(t.design.names)))
            more.append(error(held.join(other, "_row").withColumn("_x", x)) - base)
        out[name] = float(np.mean(more))
    return out


# ------------------------------------------------------------------ support vectors


@dataclass
class Svm:
    coef: np.ndarray
    loss: float
    norm_of_gradient: float
    iterations: int
    design: object
    type: str
    features: object
    labels: list | None
    group: tuple = ()
    tuning: pd.DataFrame | None = None  #: mean and deviation of the error of each setting tried

    def predict(self, newdata: Frame | None = None, id: str | None = None) -> Frame:  # noqa: A002
        """Of the rows of this model's group."""
        frame = newdata if newdata is not None else self.design.frame
        rows = _svm_rows(self.design.over(frame), self.features, frame, id, group=self.group)
        w = F.array(*[F.lit(float(v)) for v in self.coef])
        score = F.aggregate(F.zip_with("f", w, lambda a, b: a * b), F.lit(0.0), lambda s, a: s + a)
        out = score if self.type == "regression" else (score >= 0) if self.labels is None else F.when(score >= 0, F.lit(self.labels[1])).otherwise(F.lit(self.labels[0]))
        return Frame(rows.select(*([F.col("_id").alias(id)] if id else []), out.alias("prediction"), score.alias("decision_function")))


class SvmGroups(list):
    """Models in the order of their group keys."""

    def predict(self, newdata: Frame | None = None, id: str | None = None) -> Frame:  # noqa: A002
        """Of the rows of every group; rows of no training group have no prediction and are left out."""
        out = self[0].predict(newdata, id).df
        for m in self[1:]:
            out = out.unionByName(m.predict(newdata, id).df)
        return Frame(out)


def _lifted(m: np.ndarray, features) -> np.ndarray:
    """The random features of the rows of m, and a constant."""
    kind, w, b = features
    f = np.sqrt(2 / w.shape[1]) * np.cos(m @ w + b) if kind == "gaussian" else np.prod(np.einsum("np,dpk->dnk", m, w) + b, axis=0) / np.sqrt(w.shape[2])
    return np.c_[f, np.ones(len(m))]


def _svm_rows(d, features, frame: Frame, id_: str | None, label=None, group: tuple = ()) -> DataFrame:
    src = frame.source
    for g, v in zip(d.groups, group, strict=True):
        src = src.filter(d.cols[g].eqNullSafe(F.lit(v)))
    src = src.select(*([d.cols[id_].alias("_id")] if id_ else []), F.array(*d.matrix).alias("x"), *([label.cast("double").alias("y")] if label is not None else []))
    src = src.filter(~F.exists("x", lambda v: v.isNull()))
    if features is None:
        return src.withColumnRenamed("x", "f")

    ship(src.sparkSession)

    @F.pandas_udf("array<double>")
    def lift(x: pd.Series) -> pd.Series:
        return pd.Series(list(_lifted(np.stack(x.to_numpy()), features))) if len(x) else pd.Series([], dtype=object)

    return src.withColumn("f", lift("x")).drop("x")


def _tuned(formula: str, data: Frame, tried: dict[str, list], cross: int, seed: int, given: dict) -> Svm:
    from tarn.models.resample import folds

    n = max(map(len, tried.values()))
    grid = [{k: v[i % len(v)] for k, v in tried.items()} for i in range(n)]
    parts, errors = folds(data, cross, True, seed), np.zeros((n, cross))
    for j, (a, b) in enumerate(parts):
        for i, g in enumerate(grid):
            m = svm(formula, a, **given, **g)
            if isinstance(m, SvmGroups):
                raise ValueError("settings are tried without groups")
            dep = m.design.over(b).dep
            y = dep.cast("double") if m.type == "regression" else F.lit(1.0) if m.labels is None else F.when(dep == F.lit(m.labels[1]), 1.0).otherwise(-1.0)
            rows = _svm_rows(m.design.over(b), m.features, b, None, y).filter("y IS NOT NULL")
            score = F.aggregate(F.zip_with("f", F.array(*[F.lit(float(v)) for v in m.coef]), lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
            wrong = (score - F.col("y")) ** 2 if m.type == "regression" else ((score >= 0) != (F.col("y") > 0)).cast("double")
            errors[i, j] = rows.agg(F.avg(wrong)).first()[0] or 0.0
    best = grid[int(errors.mean(axis=1).argmin())]
    out = svm(formula, data, **given, **best)
    out.tuning = pd.DataFrame(grid).assign(avg=errors.mean(axis=1), std=errors.std(axis=1, ddof=1) if cross > 1 else 0.0)
    return out


def svm(formula: str, data: Frame, type: str = "classification", kernel: str = "linear", degree: int = 3, gamma: float | None = None, coef0: float = 1.0, lambda_: float = 0.01, epsilon: float = 0.1, class_weight: dict | None = None, max_iter: int = 100, init_stepsize: float = 1.0, decay: float = 0.9, tolerance: float = 1e-6, n_components: int = 100, seed: int = 0, norm: str = "L2", cross: int = 10) -> Svm | SvmGroups:  # noqa: A002
    """Hinge loss, epsilon-insensitive loss, or novelty detection, by subgradient steps: each is one aggregate over the rows.
    Gaussian kernels use random Fourier features, polynomial ones random products. With groups: a model for each. norm: the penalty, L2 or L1.
    Lists for lambda_, epsilon, max_iter, init_stepsize or decay (recycled to the longest) are tried by cross-validation over
    `cross` folds; the model is that of the best, by the share of wrong classes or the mean square."""
    if norm not in ("L1", "L2"):
        raise ValueError("norm is L1 or L2")
    tried = {k: list(v) for k, v in {"lambda_": lambda_, "epsilon": epsilon, "max_iter": max_iter, "init_stepsize": init_stepsize, "decay": decay}.items() if isinstance(v, (list, tuple))}
    if tried:
        fixed = {k: v for k, v in {"lambda_": lambda_, "epsilon": epsilon, "max_iter": max_iter, "init_stepsize": init_stepsize, "decay": decay}.items() if k not in tried}
        return _tuned(formula, data, tried, cross, seed, {"type": type, "kernel": kernel, "degree": degree, "gamma": gamma, "coef0": coef0, "class_weight": class_weight, "tolerance": tolerance, "n_components": n_components, "seed": seed, "norm": norm} | fixed)
    d = design(formula if type != "one-class" else f"1{formula}" if formula.strip().startswith("~") else formula, data)
    rng, p = np.random.default_rng(seed), len(d.names)
    features = None
    if kernel == "gaussian":
        g = gamma or 1 / p
        features = ("gaussian", rng.normal(size=(p, n_components)) * np.sqrt(2 * g), rng.uniform(0, 2 * np.pi, n_components))
    elif kernel == "polynomial":
        w = np.sqrt(gamma or 1.0) * rng.choice([-1.0, 1.0], size=(degree, p, n_components))
        features = ("polynomial", w, np.sqrt(coef0) * rng.choice([-1.0, 1.0], size=(degree, 1, n_components)))
    labels, y = None, d.dep
    if type == "classification":
        found = sorted(r[0] for r in data.source.select(d.dep.alias("y")).distinct().dropna().limit(3).collect())
        if len(found) != 2:
            raise ValueError("two classes are needed")
        labels = found
        y = F.when(d.dep == F.lit(found[1]), 1.0).otherwise(-1.0)
    elif type == "one-class":
        y = F.lit(1.0)

    def fit(group: tuple) -> Svm:
        rows = keep(_svm_rows(d, features, data, None, y, group).filter("y IS NOT NULL"))
        size = p if features is None else n_components + 1
        w, step, last, loss, length = np.zeros(size), init_stepsize, None, 0.0, 0.0
        weight = F.when(F.col("y") > 0, float((class_weight or {}).get(1, 1))).otherwise(float((class_weight or {}).get(-1, 1)))
        for it in range(1, max_iter + 1):
            score = F.aggregate(F.zip_with("f", F.array(*[F.lit(float(v)) for v in w]), lambda a, b: a * b), F.lit(0.0), lambda s, a: s + a)
            r = rows.withColumn("_s", score)
            if type == "regression":
                e = F.col("_s") - F.col("y")
                g, lo = F.when(F.abs(e) > epsilon, F.signum(e)).otherwise(0.0), F.greatest(F.abs(e) - epsilon, F.lit(0.0))
            else:
                m = F.col("y") * F.col("_s")
                g, lo = F.when(m < 1, -F.col("y") * weight).otherwise(0.0), F.greatest(1 - m, F.lit(0.0)) * weight
            got = r.withColumn("_g", g).withColumn("_l", lo).agg(F.avg("_l"), *[F.avg(F.col("f")[k] * F.col("_g")) for k in range(size)]).first()
            grad = np.array(got[1:], dtype=float) + lambda_ * (w if norm == "L2" else np.sign(w))
            loss, length = got[0] + lambda_ * (float(w @ w) / 2 if norm == "L2" else float(np.abs(w).sum())), float(np.linalg.norm(grad))
            if last is not None and abs(last - loss) < tolerance * max(abs(last), 1e-12):
                break
            if last is not None and loss > last:
                step *= decay
            last = loss
            w = w - step * grad / max(length, 1.0)
        return Svm(w, loss, length, it, d, type, features, labels, group)

    if not d.groups:
        return fit(())
    return SvmGroups(fit(k) for k in _group_keys(data, d))
