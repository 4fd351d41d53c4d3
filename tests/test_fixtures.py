"""Small published data sets whose answers are known."""

import numpy as np
import pandas as pd
import pytest

from tarn.frame import Frame
from tarn.functions import aggregates as A
from tarn.models import learners, regression, resample
from tarn.operators.order import sort

# The weather table of the decision-tree literature.
OUTLOOK = "sunny sunny overcast rain rain rain overcast sunny sunny rain sunny overcast overcast rain".split()
TEMPERATURE = [85, 80, 83, 70, 68, 65, 64, 72, 69, 75, 75, 72, 81, 71]
HUMIDITY = [85, 90, 78, 96, 80, 70, 65, 95, 70, 80, 70, 90, 75, 80]
WINDY = "false true false false false true true false false false true true false true".split()
PLAY = [k in (3, 4, 5, 7, 9, 10, 11, 12, 13) for k in range(1, 15)]
# Ten rows of thirteen measurements of wines.
WINES = [
    [14.23, 1.71, 2.43, 15.6, 127, 2.8, 3.06, 0.28, 2.29, 5.64, 1.04, 3.92, 1065],
    [13.2, 1.78, 2.14, 11.2, 1, 2.65, 2.76, 0.26, 1.28, 4.38, 1.05, 3.49, 1050],
    [13.16, 2.36, 2.67, 18.6, 101, 2.8, 3.24, 0.3, 2.81, 5.6799, 1.03, 3.17, 1185],
    [14.37, 1.95, 2.5, 16.8, 113, 3.85, 3.49, 0.24, 2.18, 7.8, 0.86, 3.45, 1480],
    [13.24, 2.59, 2.87, 21, 118, 2.8, 2.69, 0.39, 1.82, 4.32, 1.04, 2.93, 735],
    [14.2, 1.76, 2.45, 15.2, 112, 3.27, 3.39, 0.34, 1.97, 6.75, 1.05, 2.85, 1450],
    [14.39, 1.87, 2.45, 14.6, 96, 2.5, 2.52, 0.3, 1.98, 5.25, 1.02, 3.58, 1290],
    [14.06, 2.15, 2.61, 17.6, 121, 2.6, 2.51, 0.31, 1.25, 5.05, 1.06, 3.58, 1295],
    [14.83, 1.64, 2.17, 14, 97, 2.8, 2.98, 0.29, 1.98, 5.2, 1.08, 2.85, 1045],
    [13.86, 1.35, 2.27, 16, 98, 2.98, 3.15, 0.22, 1.85, 7.2199, 1.01, 3.55, 1045],
]


@pytest.fixture(scope="module")
def golf(spark):
    p = pd.DataFrame({"id": range(1, 15), "outlook": OUTLOOK, "temperature": np.float64(TEMPERATURE), "humidity": np.float64(HUMIDITY), "windy": WINDY, "play": np.where(PLAY, "Play", "Don't Play")})
    return Frame(spark.createDataFrame(p), key="id")


def test_tree_of_the_weather(golf):
    fit = learners.rpart("play ~ . - id", golf, "id", maxdepth=5, minsplit=3, minbucket=1, cp=0.0)
    got = fit.predict(golf).df.toPandas().set_index("id").estimated
    assert [got[k] == "Play" for k in range(1, 15)] == PLAY
    shares = fit.predict(golf, "prob").df.toPandas().set_index("id")
    assert np.allclose([shares["estimated_prob_Play"][k] for k in range(1, 15)], np.array(PLAY, float))
    assert learners.rpart("play ~ . - id", golf, "id", maxdepth=5, minsplit=3, minbucket=1, cp=1.0).get_tree().shape[0] == 1
    assert learners.rpart("play ~ . - id", golf, "id", maxdepth=5, minsplit=15, minbucket=1, cp=0.0).get_tree().shape[0] == 1
    t = fit.get_tree()
    assert (t["left daughter"] > 0).sum() == (t["status"] == 1).sum() and t["split var"].notna().sum() == (t["status"] == 1).sum()


def test_pruning_is_the_least_cost():
    """Against every subtree of a tree."""
    r = np.random.default_rng(2)
    for classes in (True, False):
        for _ in range(20):
            left, right = [1, 3, 5, 0, 0, 0, 0], [2, 4, 6, 0, 0, 0, 0]
            leaves = [r.integers(0, 9, 2) + 1.0 if classes else (lambda v: np.array([len(v), v.sum(), (v * v).sum()]))(r.normal(size=5)) for _ in range(4)]
            stats = [sum(leaves), leaves[0] + leaves[1], leaves[2] + leaves[3], *leaves]
            tree = learners.Pruned(left, right, [0, 1, 2, -1, -1, -1, -1], [0.0] * 7, [list(s) for s in stats], classes, np.zeros(3))
            risk = [sum(s) - max(s) if classes else s[2] - s[1] ** 2 / s[0] for s in stats]
            cp = float(r.uniform(0.01, 0.4))
            sides = [(risk[k], 1) if cut else (risk[a] + risk[b], 2) for k, a, b in ((1, 3, 4), (2, 5, 6)) for cut in (True, False)]
            whole = [(risk[0], 1)] + [(a[0] + b[0], a[1] + b[1]) for a in sides[:2] for b in sides[2:]]
            got = learners.prune(tree, cp)
            own = [s for s, le in zip(got.stats, got.left, strict=True) if not le]
            cost = sum(sum(s) - max(s) if classes else s[2] - s[1] ** 2 / s[0] for s in own) + cp * risk[0] * len(own)
            assert np.isclose(cost, min(v + cp * risk[0] * n for v, n in whole))


def test_forest_of_the_weather(golf):
    fit = learners.random_forest("play ~ . - id", golf, "id", ntree=20, mtry=2, maxdepth=5, minsplit=3, minbucket=1)
    got = fit.predict(golf).df.toPandas().set_index("id").estimated
    assert np.mean([(got[k] == "Play") == v for k, v in zip(range(1, 15), PLAY, strict=True)]) >= 0.85
    assert fit.get_tree(3).shape[1] == 6


def test_kmeans_of_wines(spark):
    names = [f"p{k}" for k in range(1, 14)]
    f = Frame(spark.createDataFrame([(k + 1, *map(float, r)) for k, r in enumerate(WINES)], ["pid", *names]))
    x = np.array(WINES)
    c = x[:2]
    for _ in range(10):
        near = ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)
        c = np.array([x[near == k].mean(axis=0) for k in (0, 1)])
    want = ((x - c[near]) ** 2).sum()
    table = Frame(spark.createDataFrame([tuple(map(float, r)) for r in WINES[:2]], names))
    for seeds in (x[:2], sort(table, False, "p2")):
        m = learners.kmeans(f, seeds, "pid")
        assert m.centers.shape == (2, 13) and np.isclose(m.tot_withinss, want)
    own = m.assigned.df.toPandas().set_index("pid").cluster
    assert [own[k + 1] - 1 for k in range(10)] == near.tolist() and sorted(m.size.tolist()) == sorted(np.bincount(near).tolist())
    for plus in (False, True):
        m = learners.kmeans(f, 2, "pid", kmeanspp=plus, nstart=3)
        assert np.isclose(m.withinss.sum(), m.tot_withinss) and m.tot_withinss <= ((x - x.mean(axis=0)) ** 2).sum()


def test_elastic_net_by_cross_validation(spark):
    r = np.random.default_rng(4)
    p = pd.DataFrame(r.normal(size=(100, 20)), columns=[f"x{k}" for k in range(1, 21)]).assign(y=r.normal(0.1, 2, 100))
    f = Frame(spark.createDataFrame(p))
    g = resample.cross_validate(lambda d, alpha, lam: regression.elnet("y ~ .", d, alpha=alpha, lambda_=lam), lambda m, d: m.predict(d), lambda q, d: A.mean((d["y"] - q) ** 2), f, {"alpha": [1.0], "lam": [0.0, 0.1, 0.2]}, k=5)
    assert g["metric"].shape == (3, 4) and g["params"]["lam"] == g["metric"].lam[g["metric"].avg.argmin()]
    assert len(g["best"].coef) == 20
