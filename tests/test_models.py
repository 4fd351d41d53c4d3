import math

import numpy as np
import pandas as pd
import pytest

from tarn.frame import Frame
from tarn.models import arima, dist, inference, learners, regression, topics
from tarn.operators.linalg import crossprod
from tarn.plans import queries as Q

SF = "/root/testdata/sf0.001"
ROWS = sorted(set(Q.QUERIES) - set(Q.SQL))


@pytest.mark.parametrize("name", ROWS)
def test_runs(spark, name):
    assert Q.QUERIES[name](spark, SF).count() > 0


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 400
    p = pd.DataFrame({"id": range(n), "a": rng.normal(size=n), "b": rng.normal(size=n), "g": rng.choice(["u", "v", "w"], n)})
    p["y"] = 1 + 2 * p.a - p.b + (p.g == "v") * 0.5 + rng.normal(size=n) * 0.3
    p["c"] = rng.poisson(np.exp(0.3 + 0.4 * p.a))
    p["z"] = (rng.random(n) < 1 / (1 + np.exp(-(0.2 + p.a)))).astype(int)
    return p, Frame(spark.createDataFrame(p), key="id")


def test_lm_matches_least_squares(data):
    p, f = data
    x = np.c_[np.ones(len(p)), p.a, p.b, p.a * p.b]
    b, rss = np.linalg.lstsq(x, p.y, rcond=None)[:2]
    m = regression.lm("y ~ a * b", f)
    assert np.allclose(m.coef, b)
    s2 = rss[0] / (len(p) - 4)
    assert np.allclose(m.std_err, np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * s2))
    assert regression.lm("y ~ a", f, hetero=True).bp_p_value <= 1


def test_glm_score_equations(data):
    p, f = data
    for family, link, y, inverse in (("binomial", "logit", p.z, lambda e: 1 / (1 + np.exp(-e))), ("poisson", "log", p.c, np.exp)):
        m = regression.glm(f"{y.name} ~ a + b", f, family, link)
        x = np.c_[np.ones(len(p)), p.a, p.b]
        assert np.abs(x.T @ (y - inverse(x @ m.coef))).max() < 1e-4
    grouped = regression.glm("z ~ a | g", f, "binomial")
    assert [m.group for m in grouped] == [("u",), ("v",), ("w",)]


def test_elnet_kkt(data):
    p, f = data
    lam, alpha = 0.2, 0.7
    m = regression.elnet("y ~ a + b", f, alpha=alpha, lambda_=lam, standardize=False, tolerance=1e-12)
    x = p[["a", "b"]].to_numpy()
    r = p.y - m.intercept - x @ m.coef
    g = x.T @ r / len(p) - lam * (1 - alpha) * m.coef
    for v, b in zip(g, m.coef, strict=True):
        assert abs(v - lam * alpha * np.sign(b)) < 1e-6 if b else abs(v) <= lam * alpha + 1e-6
    e = regression.elnet("z ~ a + b", f, family="binomial", lambda_=0.05, standardize=False)
    eta = e.intercept + x @ e.coef
    g = x.T @ (p.z - 1 / (1 + np.exp(-eta))) / len(p)
    for v, b in zip(g, e.coef, strict=True):
        assert abs(v - 0.05 * np.sign(b)) < 1e-4 if b else abs(v) <= 0.05 + 1e-4


def test_margins(data):
    p, f = data
    m = regression.glm("z ~ a + g", f, "binomial")
    out = inference.margins(m).set_index("variable")
    x = np.c_[np.ones(len(p)), p.a, p.g == "w", p.g == "v"]
    s = 1 / (1 + np.exp(-x @ m.coef))
    assert np.isclose(out.estimate["a"], (s * (1 - s) * m.coef[1]).mean())
    lin = inference.margins(regression.lm("y ~ I(a^2) + b", f)).set_index("variable")
    b = regression.lm("y ~ I(a^2) + b", f).coef
    assert np.isclose(lin.estimate["a"], (2 * b[1] * p.a).mean())


def test_tails():
    assert np.isclose(dist.t_two_sided(2.0, 10), 0.07338803, atol=1e-7)
    assert np.isclose(dist.chi2_upper(3.84, 1), 0.05004352, atol=1e-7)
    assert np.isclose(dist.f_upper(3.0, 2, 20), 0.07244, atol=1e-4)


def test_arima_recovers():
    rng = np.random.default_rng(1)
    x = np.zeros(2000)
    for t in range(1, 2000):
        x[t] = 0.6 * x[t - 1] + rng.normal()
    assert abs(arima.fit(x + 5, (1, 0, 0)).coef["ar1"] - 0.6) < 0.05


def test_svm_and_trees(data):
    p, f = data
    s = learners.svm("z ~ a", f, max_iter=10, kernel="gaussian", n_components=10)
    assert s.predict(f).df.count() == len(p)
    t = learners.rpart("g ~ a + b", f, "id", maxdepth=3)
    assert t.predict(f).df.count() == len(p) and len(t.get_tree()) > 0
    assert np.allclose(crossprod(f[["a", "b"]]), p[["a", "b"]].T @ p[["a", "b"]])


def test_lda_takes_whole_texts_and_every_word(spark, tmp_path):
    spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(250)) + " tail" * 100) for i in range(6)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert "tail" in {r.word for r in Q.QUERIES["lda_topics"](spark, str(tmp_path)).collect()}
    wide = spark.range(27).selectExpr("id", "transform(sequence(0, 9999), k -> concat_ws('x', id, k)) AS words")
    assert len(learners._term_counts(Frame(wide), "id", "words")[1]) == 270_000


def test_svm_groups_and_polynomials(data):
    p, f = data
    grouped = learners.svm("y ~ a + b | g", f, type="regression", max_iter=5)
    assert [m.group for m in grouped] == [("u",), ("v",), ("w",)]
    for m in grouped:
        own = learners.svm("y ~ a + b", f[f["g"] == m.group[0], :], type="regression", max_iter=5)
        assert np.allclose(m.coef, own.coef)
    got = grouped.predict(f, "id").df.toPandas().set_index("id").prediction
    x = np.c_[np.ones(len(p)), p.a, p.b]
    by = {m.group[0]: dict(zip(m.design.names, m.coef, strict=True)) for m in grouped}
    assert grouped[0].design.names[0] == "(Intercept)"
    assert np.allclose(got[p.id], [x[i] @ np.array(list(by[g].values())) for i, g in enumerate(p.g)])
    s = learners.svm("z ~ a + b", f, kernel="polynomial", degree=2, n_components=8, max_iter=3)
    _, w, b = s.features
    lifted = np.c_[(x @ w[0] + b[0]) * (x @ w[1] + b[1]) / np.sqrt(8), np.ones(len(p))]
    got = s.predict(f, "id").df.toPandas().set_index("id").decision_function
    assert np.allclose(got[p.id], lifted @ s.coef)


def test_grouped_models_of_many_columns_and_groups(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 50))
    p = pd.DataFrame(x, columns=[f"c{i}" for i in range(50)])
    p["day"] = pd.to_datetime(rng.choice(["2024-01-01", "2024-02-01", "2024-03-01"], 3000)).date
    p["h"] = rng.choice([1.5, 2.0], 3000)
    p.loc[::7, "h"] = None
    p["y"] = x @ np.arange(50) + rng.normal(size=3000)
    f = Frame(spark.createDataFrame(p.astype({"h": object}).where(p.notna(), None), ",".join(f"c{i} double" for i in range(50)) + ", day date, h double, y double"))
    m = regression.lm("y ~ " + " + ".join(f"c{i}" for i in range(50)) + " | day + h", f)
    assert len(m) == 9 and {type(k.group[0]).__name__ for k in m} == {"date"} and {k.group[1] for k in m} == {1.5, 2.0, None}
    for k in m:
        own = p[(p.day == k.group[0]) & (p.h.isna() if k.group[1] is None else p.h == k.group[1])]
        assert np.allclose(k.coef, np.linalg.lstsq(np.c_[np.ones(len(own)), own[[f"c{i}" for i in range(50)]]], own.y, rcond=None)[0])
    many = Frame(spark.range(20_000).selectExpr("cast(id % 5000 as int) AS g", "cast(id div 5000 as double) AS x", "cast((id % 5000) * (id div 5000) + id % 5000 as double) AS y"))
    m = regression.lm("y ~ x | g", many)
    assert len(m) == 5000
    new = Frame(spark.createDataFrame([(3, 10.0), (4999, 2.0), (None, 1.0), (77, None), (9000, 1.0)], "g int, x double"))
    got = {r.g: r.v for r in new.cbind(regression.predict(m, new).alias("v")).df.collect()}
    assert np.allclose([got[3], got[4999]], [33, 4999 * 3]) and got[None] is got[77] is got[9000] is None
    few = Frame(many.base.filter("g < 40").withColumn("z", (many.base.y % 3 > 0).cast("int")))
    assert len(regression.glm("y ~ x | g", Frame(few.base.filter("g > 0").withColumn("y", few.base.y.cast("int"))), "poisson")) == 39


def test_likelihoods(data):
    import math

    p, f = data
    m = regression.glm("c ~ a", f, "poisson")
    mu = np.exp(m.coef[0] + m.coef[1] * p.a)
    assert np.isclose(regression.log_lik(m)[0], sum(y * math.log(u) - u - math.lgamma(y + 1) for y, u in zip(p.c, mu, strict=True)))
    q = p.assign(w=np.exp(0.5 + 0.3 * p.a) * np.random.default_rng(1).gamma(4, 0.25, len(p)))
    g = Frame(f.base.sparkSession.createDataFrame(q[["a", "w"]]))
    m = regression.glm("w ~ a", g, "gamma", "log")
    mu = np.exp(m.coef[0] + m.coef[1] * q.a)
    d = (2 * ((q.w - mu) / mu - np.log(q.w / mu))).mean()
    assert np.isclose(regression.log_lik(m)[0], sum((1 / d - 1) * math.log(y) - y / (u * d) - math.log(u * d) / d - math.lgamma(1 / d) for y, u in zip(q.w, mu, strict=True)))
    m = regression.glm("w ~ a", g, "inverse_gaussian", "log")
    mu = np.exp(m.coef[0] + m.coef[1] * q.a)
    d = ((q.w - mu) ** 2 / (q.w * mu * mu)).mean()
    assert np.isclose(regression.log_lik(m)[0], sum(-0.5 * math.log(2 * math.pi * d * y**3) - (y - u) ** 2 / (2 * d * y * u * u) for y, u in zip(q.w, mu, strict=True)))
    m = regression.glm("w ~ a", g, "gaussian", "log")
    r = (q.w - np.exp(m.coef[0] + m.coef[1] * q.a)) ** 2
    assert np.isclose(regression.log_lik(m)[0], -0.5 * len(q) * (math.log(2 * math.pi * r.mean()) + 1))
    with pytest.warns(UserWarning, match="did not converge"):
        regression.glm("c ~ a", f, "poisson", max_iter=1)
    holes = Frame(g.base.withColumn("a", g.base.a * 1).selectExpr("CASE WHEN a > 0.5 THEN NULL ELSE a END AS a", "w"))
    m = regression.glm("w ~ a", holes, "gamma", "log")
    assert m.skipped == int((q.a > 0.5).sum()) and m.n + m.skipped == len(q)


@pytest.mark.parametrize("order", [(1, 0, 0), (2, 0, 1), (0, 1, 2), (1, 1, 1)])
def test_arima_in_chunks_is_that_of_the_whole(spark, monkeypatch, order):
    rng = np.random.default_rng(2)
    e = rng.normal(size=400)
    x = np.zeros(400)
    for t in range(1, 400):
        x[t] = 0.5 * x[t - 1] + e[t] + 0.3 * e[t - 1]
    x = (np.cumsum(x) if order[1] else x) + 4
    whole = arima.fit(x, order)
    f = Frame(spark.createDataFrame([(int(t), float(v)) for t, v in rng.permutation(list(enumerate(x)))], "t long, v double").repartition(4))
    monkeypatch.setattr(arima, "CHUNK", 50)
    m = arima.arima(f["v"], f["t"], order)
    assert m.chunks is not None and np.allclose(list(m.coef.values()), list(whole.coef.values()), atol=1e-5) and np.isclose(m.sigma2, whole.sigma2)
    assert np.allclose(m.forecast(5).forecast_value, whole.forecast(5).forecast_value, atol=1e-4)
    got = m.residuals().df.orderBy("point").toPandas()
    assert got.point.tolist() == list(range(order[0] + order[1], 400)) and np.allclose(got.residual, whole.residuals(), atol=1e-3)


def test_svm_tries_settings_and_norms(data):
    p, f = data
    m = learners.svm("z ~ a", f, lambda_=[0.01, 50.0], max_iter=8, cross=3)
    assert m.tuning.shape == (2, 3) and m.tuning.avg[0] == m.tuning.avg.min()
    sparse = learners.svm("y ~ a + b", f, type="regression", norm="L1", lambda_=5.0, max_iter=30)
    dense = learners.svm("y ~ a + b", f, type="regression", norm="L1", lambda_=0.001, max_iter=30)
    assert np.abs(sparse.coef).sum() < np.abs(dense.coef).sum()
    with pytest.raises(ValueError, match="norm"):
        learners.svm("z ~ a", f, norm="L3")
    with pytest.raises(TypeError):
        learners.svm("z ~ a", f, step=1)


def test_permuted_importance(data):
    p, f = data
    t = learners.random_forest("y ~ a + b + id", f, "id", ntree=10, maxdepth=5, importance=True)
    assert set(t.permuted[()]) == set(t.design.names) and t.permuted[()]["a"] == max(t.permuted[()].values())


def test_lda_assignments(spark):
    rows = [(i, (["sea", "ship", "wave", "sail"] if i % 2 else ["bread", "oven", "flour", "salt"]) * 6) for i in range(20)]
    m = learners.lda(Frame(spark.createDataFrame(rows, "id long, words array<string>")), "id", "words", 2, 0.5, 0.5, iter_num=30)
    a = m.assignments().df.toPandas()
    assert len(a) == 80 and a.n.sum() == 480 and a.groupby("word").topic.nunique().max() == 1
    assert a.topic[a.word == "sea"].iloc[0] == a.topic[a.word == "ship"].iloc[0] != a.topic[a.word == "oven"].iloc[0]
    assert m.topic_sums().df.agg({"n": "sum"}).first()[0] == 480 and m.document_sums().df.count() == 20
    assert m.perplexity() < 8.5


def test_lda_in_blocks_and_chunks(spark, monkeypatch):
    from pyspark.ml.feature import CountVectorizer

    def refuse(*a):
        raise AssertionError("a vocabulary came to the driver")

    monkeypatch.setattr(CountVectorizer, "fit", refuse)
    monkeypatch.setattr(topics, "TOKENS", 25)
    monkeypatch.setattr(topics, "CHUNK", 3)
    texts = [(["sea", "ship", "wave", "sail"] if i % 2 else ["bread", "oven", "flour", "salt"]) * 3 + ["and"] * (i % 4) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(50, None), (51, []), (52, [None, "and", None]), (52, ["and"])]
    f = Frame(spark.createDataFrame(rows, "id long, words array<string>"))
    blocks, vocabulary = learners._term_counts(f, "id", "words")
    assert len(vocabulary) == 9 and blocks.count() > 4
    m = learners.lda(f, "id", "words", 2, 1.5, 1.2, iter_num=25)
    got = {r.word: np.array(r.counts) for r in m.shares.collect()}
    flat = [w for _, t in rows for w in t or [] if w]
    assert set(got) == set(flat) and all(np.isclose(c.sum(), flat.count(w)) for w, c in got.items())
    names = sorted(got)  # a plain step from where the fit ended leads back there
    c, n = np.array([got[w] for w in names]), np.array([[(t or []).count(w) for w in names] for _, t in rows], dtype=float)
    phi, theta = (c + 0.2) / (c.sum(axis=0) + 9 * 0.2), np.ones((len(rows), 2))
    for _ in range(200):
        g = theta[:, None, :] * phi[None]
        g = g / g.sum(axis=2, keepdims=True) * n[:, :, None]
        theta = g.sum(axis=1) + 0.5
    assert np.allclose(g.sum(axis=0), c, atol=0.02)
    mix = theta / theta.sum(axis=1, keepdims=True)
    want = np.exp(-(n * np.log(mix @ phi.T)).sum() / n.sum())
    assert np.isclose(m.perplexity(), want, rtol=1e-4) and np.isclose(m.perplexity(f, "id", "words"), want, rtol=1e-4)
    p = m.predict(Frame(spark.createDataFrame([(1, ["sea", "unknown"]), (2, ["oven"] * 3), (3, ["unknown"])], "id long, words array<string>")), "id", "words").df
    by = {r.id: r.topics.toArray() for r in p.collect()}
    assert by[1].argmax() != by[2].argmax() and np.allclose(by[3], 0.5)


@pytest.mark.parametrize("repeated", [0, 10**9])
def test_glm_fits_equal_rows_as_one(spark, monkeypatch, repeated):
    monkeypatch.setattr(regression, "REPEATED", repeated)
    monkeypatch.setattr(regression, "SMALL", repeated)
    rows = [(g, float(x), float(k % 5 + x)) for g in ("u", "v", None) for k in range(200 if g else 50) for x in (0, 1)] + [("u", None, 1.0), (None, 1.0, None), ("v", float("nan"), 2.0), ("w", None, 1.0)]
    f = Frame(spark.createDataFrame(rows, "g string, x double, y double").repartition(4))
    kept, whole = regression._cases(regression._prepared("y ~ x | g", f))
    assert kept.count() == (30 if not repeated else 900) and kept.agg({"n": "sum"}).first()[0] == 900 and whole == {("u",): 401, ("v",): 401, (None,): 102 - 1, ("w",): 1}
    for family, link in (("poisson", "log"), ("gamma", "log"), ("gaussian", "log")):
        m = regression.glm("y + 1 ~ x | g", f, family, link)
        assert [k.group for k in m] == [(None,), ("u",), ("v",)] and [(k.n, k.skipped) for k in m] == [(100, 1), (400, 1), (400, 1)]
        for k in m:
            assert np.allclose([np.exp(k.coef[0]), np.exp(k.coef.sum())], [3, 4])
    one = regression.glm("y + 1 ~ x", f, "poisson")
    y, u = np.array([r[2] + 1 for r in rows[:900]]), np.array([3 + r[1] for r in rows[:900]])
    assert np.isclose(regression.log_lik(one)[0], sum(a * np.log(b) - b - math.lgamma(a + 1) for a, b in zip(y, u, strict=True)))
    se = 1 / np.sqrt(450 * 3)
    assert np.isclose(one.std_err[0], se)


def test_fits_of_one_formula_share_its_design(spark, data, monkeypatch):
    stored, cases, drop, gone = [], regression._cases, regression.drop_kept, []
    monkeypatch.setattr(regression, "_cases", lambda d: stored.append(d) or cases(d))
    monkeypatch.setattr(regression, "drop_kept", lambda s: gone.append(drop(s)))
    assert Q.QUERIES["glm_predict"](spark, SF).count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert len(stored) == 1 and gone == [1]
    _, f = data
    kinds = [("poisson", None), ("gaussian", None), ("gaussian", "log"), ("inverse.gaussian", "log")]
    for formula in ("c + 1 ~ a + b", "c + 1 ~ a | g"):
        for (family, link), m in zip(kinds, regression.glms(formula, f, kinds), strict=True):
            own = regression.glm(formula, f, family, link)
            for x, y in zip(m, own, strict=True) if isinstance(own, regression.Grouped) else [(m, own)]:
                assert (x.group, x.n, x.skipped, x.family, x.link) == (y.group, y.n, y.skipped, y.family, y.link)
                assert np.allclose(x.coef, y.coef) and np.allclose(x.std_err, y.std_err)
                assert np.isclose(regression.log_lik(x)[0], regression.log_lik(y)[0])


def test_lda_sends_no_pairs_and_no_words_of_one_document(spark, monkeypatch):
    stored, sent = [], []
    monkeypatch.setattr(topics, "TOKENS", 200)
    monkeypatch.setattr(topics, "BUCKETS", 2)
    monkeypatch.setattr(topics, "_dealt", lambda df, f=topics._dealt: (sent.append(df.collect()), f(df))[1])
    monkeypatch.setattr(topics, "_linked", lambda *a, f=topics._linked: (stored.append(f(*a)), stored[-1])[1])
    monkeypatch.setattr(topics, "drop_kept", lambda df, f=topics.drop_kept: (stored.append([r.asDict() for r in df.collect()]) if "code" in df.columns else None, f(df))[1])
    texts = [["sea", "ship"] * 3 + ["wave"] + [f"own{i}x{j}" for j in range(40)] + [f"twice{i}x{j}" for j in range(5)] * 2 for i in range(12)] + [["sea"] * 700, [], None]
    rows = list(enumerate(texts))
    m = learners.lda(Frame(spark.createDataFrame(rows, "id long, words array<string>").repartition(2)), "id", "words", 2, 1.5, 1.2, iter_num=8)
    pairs = next(x for x in stored if isinstance(x, list))
    assert len(pairs) > 2 and len({r["at"] for r in pairs}) == len(pairs) and not any(t.name in stored[0][1] for t in spark.catalog.listTables("default"))
    assert all(len(r["words"]) <= 3 * 2 for r in pairs)  # the others are in one document each
    assert sum(len(r["code"]) // 4 for r in pairs) == 12 * (3 + 2) + 3 and sum(sum(r["n"]) for r in pairs) == 12 * 57 + 700
    assert {r.part for s in sent for r in s} == {1, 2} and all(len(r.a) <= 3 * 4 for s in sent[:-1] for r in s if r.part == 2)
    own = {r.word: np.array(r.counts) for r in m.shares.collect()}
    assert len(own) == 3 + 12 * 45 and np.isclose(own["sea"].sum(), 736) and np.isclose(own["own3x7"].sum(), 1) and np.isclose(own["twice3x2"].sum(), 2)
    assert np.allclose(own["own3x7"], own["own3x8"]) and np.allclose(sum(own.values()), m.totals)
    theta, phi = {r.id: r.topics.toArray() for r in m.predict(Frame(spark.createDataFrame(rows, "id long, words array<string>")), "id", "words").df.collect()}, {w: (c + 0.2) / (m.totals + len(own) * 0.2) for w, c in own.items()}
    want = np.exp(-sum(np.log(theta[i] @ phi[w]) for i, t in rows for w in t or []) / (12 * 57 + 700))
    assert np.isclose(m.perplexity(), want, rtol=1e-6)


def test_lda_of_empty_texts(spark):
    m = learners.lda(Frame(spark.createDataFrame([(1, []), (2, None)], "id long, words array<string>")), "id", "words", 2, 1.5, 1.2, iter_num=2)
    assert m.totals.tolist() == [0, 0] and m.shares.count() == 0 and len(m.vocabulary) == 0


def test_lda_cuts_texts_as_split_does(spark):
    texts = ["", " a  b ", "a\x0bb\x0cc\x1cd\x85e", "a\xa0b\u2003c", None, "  ", "x\r\n\ty x", "é\tß"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    cut = [topics.blocks_of(Frame(f), "id", "text") for f in (df.repartition(1), df.repartition(1).selectExpr("id", r"split(text, '\\s+') AS text"))]
    a, b = ([{k: v for k, v in r.asDict().items() if k != "block"} for r in x.collect()] for x in cut)
    assert a == b and sorted(a[0]["words"]) == sorted({"", "a", "b", "c\x1cd\x85e", "a\xa0b\u2003c", "x", "y", "é", "ß"})
