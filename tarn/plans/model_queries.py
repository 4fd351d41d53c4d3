"""Queries of the models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tarn.frame import Frame
from tarn.functions import aggregates as A
from tarn.functions import scalar as S
from tarn.models import arima as AR
from tarn.models import inference, learners, regression, resample
from tarn.models.summary import summary
from tarn.operators.linalg import crossprod, ols, pca, pinv, scale
from tarn.plans.queries import query, sort


def table(x: Frame, rows: list[tuple], schema: str):
    return x.base.sparkSession.createDataFrame([tuple(float(v) if isinstance(v, np.floating) else v for v in r) for r in rows], schema)


def coefs(x: Frame, fit, digits: int = 6):
    return table(x, [(n, round(float(v), digits)) for n, v in fit.named().items()], "name string, value double")


@query("crossprod", "SELECT round(sum(l_quantity * l_quantity), 2) AS qq, round(sum(l_quantity * l_tax), 4) AS qt, round(sum(l_tax * l_tax), 6) AS tt FROM lineitem")
def _(t):
    x = t("lineitem")
    m = crossprod(x[["l_quantity", "l_tax"]])
    return table(x, [(round(m[0, 0], 2), round(m[0, 1], 4), round(m[1, 1], 6))], "qq double, qt double, tt double")


@query("scale", "SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev(p_size) FROM part), 6) AS v FROM part")
def _(t):
    x = t("part")
    z, _s = scale(x[["p_size"]])
    return x._with([x.cols[0], z.cols[0].__class__("v", F.round(z.cols[0].expr, 6))])


@query("pca")
def _(t):
    x = t("embeddings")
    r = pca(x[["embedding"]])
    return table(x, [(k + 1, round(float(v), 6)) for k, v in enumerate(r["sdev"])], "component int, sdev double")


@query("lm_coef", "SELECT '(Intercept)' AS name, round(regr_intercept(l_extendedprice, l_quantity), 4) AS value FROM lineitem UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem")
def _(t):
    x = t("lineitem")
    return coefs(x, regression.lm("l_extendedprice ~ l_quantity", x), 4)


@query("lm_r2", "SELECT round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n FROM lineitem")
def _(t):
    x = t("lineitem")
    f = regression.lm("l_extendedprice ~ l_quantity", x)
    return table(x, [(round(f.r2, 6), f.n)], "r2 double, n long")


@query("lm_grouped", "SELECT l_returnflag AS g, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS b0 FROM lineitem GROUP BY 1")
def _(t):
    x = t("lineitem")
    return table(x, [(f.group[0], round(float(f.coef[1]), 4), round(float(f.coef[0]), 3)) for f in regression.lm("l_extendedprice ~ l_quantity | l_returnflag", x)], "g string, slope double, b0 double")


_FITTED = "(SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)"


@query("lm_predict", f"SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 3) AS v FROM lineitem, {_FITTED}")
def _(t):
    x = t("lineitem")
    p = regression.predict(regression.lm("l_extendedprice ~ l_quantity", x), x)
    return x[["l_orderkey", "l_linenumber"]].cbind(p._with([p.cols[0].__class__("v", F.round(p.cols[0].expr, 3))]))


@query("lm_resid", f"SELECT l_orderkey, l_linenumber, round(l_extendedprice - a - b * l_quantity, 3) + 0 AS v FROM lineitem, {_FITTED}")
def _(t):
    x = t("lineitem")
    p = regression.residuals(regression.lm("l_extendedprice ~ l_quantity", x))
    return x[["l_orderkey", "l_linenumber"]].cbind(x._with([p.cols[0].__class__("v", F.round(p.cols[0].expr, 3) + 0)]))


@query("lm_factor", "SELECT l_linestatus AS level, round(avg(l_extendedprice), 3) AS mean FROM lineitem GROUP BY 1")
def _(t):
    x = t("lineitem")
    f = regression.lm("l_extendedprice ~ l_linestatus", x)
    b = f.named()
    base = b["(Intercept)"]
    ref, others = f.design.factors["l_linestatus"]
    return table(x, [(ref, round(base, 3))] + [(o, round(base + b[f"l_linestatus{o}"], 3)) for o in others], "level string, mean double")


@query("lm_margins", "SELECT 'l_quantity' AS variable, round(regr_slope(l_extendedprice, l_quantity), 4) AS estimate FROM lineitem")
def _(t):
    x = t("lineitem")
    m = inference.margins(regression.lm("l_extendedprice ~ l_quantity", x))
    return table(x, [(r.variable, round(r.estimate, 4)) for r in m.itertuples()], "variable string, estimate double")


@query("logit_factor", "SELECT l_linestatus AS level, round(avg(CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END), 6) AS p FROM lineitem GROUP BY 1")
def _(t):
    x = t("lineitem")
    f = regression.glm("l_quantity > 25 ~ l_linestatus", x, "binomial")
    b, (ref, others) = f.named(), f.design.factors["l_linestatus"]
    p = lambda e: round(1 / (1 + np.exp(-e)), 6)
    return table(x, [(ref, p(b["(Intercept)"]))] + [(o, p(b["(Intercept)"] + b[f"l_linestatus{o}"])) for o in others], "level string, p double")


# Newton's steps for three coefficients, each system solved by Cramer's rule
_NEWTON = """
WITH RECURSIVE d AS (SELECT l_discount AS u, l_tax AS v, CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END AS y FROM lineitem),
it(i, a, b, c) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT i + 1,
    a + (r * (suu * svv - suv * suv) - su * (ru * svv - suv * rv) + sv * (ru * suv - suu * rv)) / det,
    b + (s * (ru * svv - suv * rv) - r * (su * svv - suv * sv) + sv * (su * rv - ru * sv)) / det,
    c + (s * (suu * rv - ru * suv) - su * (su * rv - ru * sv) + r * (su * suv - suu * sv)) / det
  FROM (SELECT *, s * (suu * svv - suv * suv) - su * (su * svv - suv * sv) + sv * (su * suv - suu * sv) AS det FROM (
    SELECT i, a, b, c, sum(w) AS s, sum(w * u) AS su, sum(w * v) AS sv, sum(w * u * u) AS suu, sum(w * u * v) AS suv, sum(w * v * v) AS svv, sum(y - p) AS r, sum((y - p) * u) AS ru, sum((y - p) * v) AS rv
    FROM (SELECT *, p * (1 - p) AS w FROM (SELECT i, a, b, c, u, v, y, 1 / (1 + exp(-a - b * u - c * v)) AS p FROM it, d WHERE i < 12)) GROUP BY i, a, b, c)))
SELECT '(Intercept)' AS name, round(a, 6) + 0 AS value FROM it WHERE i = 12 UNION ALL SELECT 'l_discount', round(b, 6) + 0 FROM it WHERE i = 12 UNION ALL SELECT 'l_tax', round(c, 6) + 0 FROM it WHERE i = 12
"""


@query("logit_coef", _NEWTON)
def _(t):
    x = t("lineitem")
    return coefs(x, regression.glm("l_quantity > 25 ~ l_discount + l_tax", x, "binomial"))


@query("poisson_factor", "SELECT l_returnflag AS level, round(avg(l_linenumber), 6) AS mean FROM lineitem GROUP BY 1")
def _(t):
    x = t("lineitem")
    f = regression.glm("l_linenumber ~ l_returnflag", x, "poisson")
    b, (ref, others) = f.named(), f.design.factors["l_returnflag"]
    return table(x, [(ref, round(float(np.exp(b["(Intercept)"])), 6))] + [(o, round(float(np.exp(b["(Intercept)"] + b[f"l_returnflag{o}"])), 6)) for o in others], "level string, mean double")


@query("gamma_coef", """
WITH RECURSIVE it(i, a, b) AS (
  SELECT 0, ln(avg(p_retailprice)), 0.0::DOUBLE FROM part
  UNION ALL
  SELECT i + 1, regr_intercept(z, x), regr_slope(z, x) FROM (SELECT i, p_size AS x, a + b * p_size + p_retailprice / exp(a + b * p_size) - 1 AS z FROM it, part WHERE i < 25) GROUP BY i)
SELECT '(Intercept)' AS name, round(a, 6) + 0 AS value FROM it WHERE i = 25 UNION ALL SELECT 'p_size', round(b, 6) + 0 FROM it WHERE i = 25
""")
def _(t):
    x = t("part")
    return coefs(x, regression.glm("p_retailprice ~ p_size", x, "gamma", "log"))


@query("elnet_ridge", "SELECT round(covar_pop(p_retailprice, p_size) / stddev_pop(p_size) / (1 + 0.5) / stddev_pop(p_size), 6) AS b FROM part")
def _(t):
    x = t("part")
    e = regression.elnet("p_retailprice ~ p_size", x, alpha=0.0, lambda_=0.5, tolerance=1e-12)
    return table(x, [(round(float(e.coef[0]), 6),)], "b double")


@query("elnet_lasso")
def _(t):
    x = t("lineitem")
    e = regression.elnet("l_extendedprice ~ l_quantity + l_discount + l_tax", x, alpha=1.0, lambda_=100.0)
    return table(x, [(n, round(float(b), 6)) for n, b in zip(("l_quantity", "l_discount", "l_tax"), e.coef, strict=True)], "name string, value double")


_DIST = "list_sum(list_transform(range(1, 65), lambda i: (CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE)) ** 2))"


@query("kmeans_assign", f"SELECT vec_id, CAST(arg_min(k, d) AS INTEGER) AS cluster FROM (SELECT a.vec_id, b.vec_id + 1 AS k, {_DIST} AS d FROM embeddings a, embeddings b WHERE b.vec_id < 4) GROUP BY 1")
def _(t):
    x = t("embeddings")
    seeds = x[x["vec_id"] < 4, ["embedding"]]
    seeds = Frame(sort(x[x["vec_id"] < 4, ["vec_id", "embedding"]], False, "vec_id").df.select("embedding")) if seeds else seeds
    return learners.kmeans(x[["vec_id", "embedding"]], seeds, "vec_id", max_iter=0).assigned


@query("kmeans_fit")
def _(t):
    x = t("embeddings")
    m = learners.kmeans(x[["vec_id", "embedding"]], 5, "vec_id", max_iter=5)
    return table(x, [(k + 1, int(n), round(float(w), 6)) for k, (n, w) in enumerate(zip(m.size, m.withinss, strict=True))], "cluster int, size long, withinss double")


@query("summary", "SELECT 'p_size' AS target_column, count(*) AS row_count, count(DISTINCT p_size) AS distinct_values, round(avg(p_size), 6) AS mean, round(var_samp(p_size), 6) AS variance, CAST(min(p_size) AS DOUBLE) AS min, CAST(max(p_size) AS DOUBLE) AS max, quantile_cont(p_size, 0.25) AS first_quartile, quantile_cont(p_size, 0.5) AS median FROM part")
def _(t):
    d = summary(t("part"), ["p_size"]).df
    return d.select("target_column", "row_count", "distinct_values", F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance"), "min", "max", "first_quartile", "median")


@query("summary_grouped", "SELECT l_returnflag AS group_by_value, 'l_linestatus' AS target_column, count(*) AS row_count, count(DISTINCT l_linestatus) AS distinct_values FROM lineitem GROUP BY 1")
def _(t):
    return summary(t("lineitem"), ["l_linestatus"], ["l_returnflag"]).df.select("group_by_value", "target_column", "row_count", "distinct_values")


@query("summary_text", "SELECT 'c_mktsegment' AS target_column, 2 AS column_number, count(*) AS row_count, count(DISTINCT c_mktsegment) AS distinct_values, 0 AS missing_values, CAST(min(length(c_mktsegment)) AS DOUBLE) AS min, CAST(max(length(c_mktsegment)) AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS mean FROM customer UNION ALL SELECT 'c_acctbal', 1, count(*), count(DISTINCT c_acctbal), count(*) FILTER (c_acctbal IS NULL), min(c_acctbal), max(c_acctbal), round(avg(c_acctbal), 6) FROM customer")
def _(t):
    d = summary(t("customer"), ["c_acctbal", "c_mktsegment"]).df
    return d.select("target_column", "column_number", "row_count", "distinct_values", "missing_values", "min", "max", F.round("mean", 6).alias("mean"))


@query("summary_quantiles", "SELECT l_returnflag AS group_by_value, quantile_cont(l_extendedprice, 0.25) AS first_quartile, quantile_cont(l_extendedprice, 0.75) AS third_quartile, quantile_cont(l_extendedprice, 0.1) AS tenth FROM lineitem GROUP BY 1")
def _(t):
    d = summary(t("lineitem"), ["l_extendedprice"], ["l_returnflag"], ntile=[0.1, 0.9]).df
    return d.select("group_by_value", "first_quartile", "third_quartile", F.col("quantile_array")[0].alias("tenth"))


@query("summary_frequent", "SELECT l_returnflag AS group_by_value, (SELECT string_agg(concat(v, ':', n), ',' ORDER BY n DESC, v) FROM (SELECT CAST(l_linenumber AS VARCHAR) AS v, count(*) AS n FROM lineitem b WHERE b.l_returnflag = a.l_returnflag GROUP BY 1 ORDER BY n DESC, v LIMIT 3)) AS top FROM lineitem a GROUP BY 1")
def _(t):
    d = summary(t("lineitem"), ["l_linenumber"], ["l_returnflag"], n_mfv=3).df
    return d.select("group_by_value", F.array_join(F.zip_with("most_frequent_values", "mfv_frequencies", lambda v, n: F.concat_ws(":", v, n.cast("string"))), ",").alias("top"))


@query("lda_topics")
def _(t):
    x = t("documents")
    m = learners.lda(Frame(x.base.select("doc_id", "text")), "doc_id", "text", 3, 5.0, 1.1)
    return table(x, [(int(r.topic), str(w)) for r in m.topics(5).itertuples() for w in r.words], "topic int, word string")


@query("tree_predict")
def _(t):
    x = t("orders")
    return learners.rpart("o_orderstatus ~ o_totalprice + o_custkey", x, "o_orderkey", maxdepth=4).predict(x)


@query("forest_predict")
def _(t):
    x = t("orders")
    return learners.random_forest("o_totalprice ~ o_orderstatus + o_custkey", x, "o_orderkey", ntree=5).predict(x)


@query("svm_linear")
def _(t):
    x = t("lineitem")
    z = x.assign(q=(x["l_quantity"] - 25) / 15, p=(x["l_extendedprice"] - 38000) / 23000)
    m = learners.svm("l_quantity > 25 ~ q + p", z, max_iter=15)
    return table(x, [(n, round(float(v), 6)) for n, v in zip(m.design.names, m.coef, strict=True)], "name string, value double")


@query("arima_daily", """
WITH y AS (SELECT CAST(ts AS DATE) AS d, sum(value) AS v FROM events GROUP BY 1),
f AS (SELECT regr_slope(v, b) AS p, regr_intercept(v, b) / (1 - regr_slope(v, b)) AS m FROM (SELECT v, lag(v) OVER (ORDER BY d) AS b FROM y) WHERE b IS NOT NULL)
SELECT CAST(h AS INTEGER) AS step, round(m + p ** h * (arg_max(v, d) - m), 4) AS value FROM y, f, range(1, 6) r(h) GROUP BY h, p, m
""")
def _(t):
    x = t("events")
    y = x.assign(day=S.to_date(x["ts"]))
    daily = A.by(y, "day", lambda g: A.total(g["value"]).alias("v"))
    m = AR.arima(daily["v"], daily["day"], (1, 0, 0))
    return table(x, [(int(r.steps_ahead), round(float(r.forecast_value), 4)) for r in m.forecast(5).itertuples()], "step int, value double")


@query("cross_validation")
def _(t):
    x = t("part")[["p_retailprice", "p_size"]]
    r = resample.cross_validate(lambda d: regression.lm("p_retailprice ~ p_size", d), lambda m, d: regression.predict(m, d), lambda p, d: A.mean((p - d["p_retailprice"]) ** 2), x, k=3)
    return table(x, [(r["err"], r["err.std"])], "err double, err_std double")


@query("bagging_predict")
def _(t):
    x = t("part")[["p_partkey", "p_retailprice", "p_size"]]
    b = resample.bagging(lambda d: regression.lm("p_retailprice ~ p_size", d), x, nbags=3)
    return x[["p_partkey"]].cbind(b.predict(x).alias("v"))




# ---- linear algebra and inference in closed form

@query("crossprod_xy", "SELECT round(sum(l_quantity * l_tax), 4) AS qt, round(sum(l_discount * l_tax), 6) AS dt FROM lineitem")
def _(t):
    x = t("lineitem")
    m = crossprod(x[["l_quantity", "l_discount"]], x[["l_tax"]])
    return table(x, [(round(m[0, 0], 4), round(m[1, 0], 6))], "qt double, dt double")


@query("crossprod_inverse", "SELECT round(sum(b * b) / (sum(a * a) * sum(b * b) - sum(a * b) ** 2) * 1e6, 6) AS aa, round(-sum(a * b) / (sum(a * a) * sum(b * b) - sum(a * b) ** 2) * 1e6, 6) AS ab FROM (SELECT CAST(p_size AS DOUBLE) AS a, p_retailprice / 100 AS b FROM part)")
def _(t):
    x = t("part")
    m = pinv(crossprod(x.assign(a=S.to_numeric(x["p_size"]), b=x["p_retailprice"] / 100)[["a", "b"]]))
    return table(x, [(round(m[0, 0] * 1e6, 6), round(m[0, 1] * 1e6, 6))], "aa double, ab double")


@query("ols_coef", "SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS b0 FROM lineitem")
def _(t):
    x = t("lineitem")
    b = ols(x.assign(one=1.0)[["one", "l_quantity"]], x[["l_extendedprice"]])
    return table(x, [(round(float(b[1]), 4), round(float(b[0]), 3))], "slope double, b0 double")


@query("pca_two", "SELECT 1 AS component, round(sqrt(1 + abs(corr(p_size, p_retailprice))), 6) AS sdev FROM part UNION ALL SELECT 2, round(sqrt(1 - abs(corr(p_size, p_retailprice))), 6) FROM part")
def _(t):
    x = t("part")
    return table(x, [(k + 1, round(float(v), 6)) for k, v in enumerate(pca(x[["p_size", "p_retailprice"]])["sdev"])], "component int, sdev double")


_SSE = "(SELECT count(*) AS n, regr_syy(l_extendedprice, l_quantity) - regr_sxy(l_extendedprice, l_quantity) ** 2 / regr_sxx(l_extendedprice, l_quantity) AS sse, regr_sxx(l_extendedprice, l_quantity) AS sxx FROM lineitem)"


@query("lm_inference", f"SELECT round(sqrt(sse / (n - 2) / sxx), 6) AS std_err, round(sse / (n - 2) / sxx, 6) AS vcov, round(-0.5 * n * (ln(2 * pi()) + 1 - ln(n) + ln(sse)), 3) AS loglik, round(n * (ln(2 * pi()) + 1 - ln(n) + ln(sse)) + 6, 3) AS aic, round(n * ln(sse / n) + 4, 3) AS extracted FROM {_SSE}")
def _(t):
    x = t("lineitem")
    f = regression.lm("l_extendedprice ~ l_quantity", x)
    return table(x, [(round(float(f.std_err[1]), 6), round(float(regression.vcov(f)[1, 1]), 6), round(regression.log_lik(f)[0], 3), round(regression.aic(f), 3), round(regression.extract_aic(f)[1], 3))], "std_err double, vcov double, loglik double, aic double, extracted double")


_SHARE = "(SELECT l_linestatus AS s, count(*) AS n, avg(CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END) AS p FROM lineitem GROUP BY 1)"


@query("logit_inference", f"SELECT round(sum(n * (p * ln(p) + (1 - p) * ln(1 - p))), 3) AS loglik, round(4 - 2 * sum(n * (p * ln(p) + (1 - p) * ln(1 - p))), 3) AS aic, round(sum(1 / (n * p * (1 - p))), 9) AS vcov FROM {_SHARE}")
def _(t):
    x = t("lineitem")
    f = regression.glm("l_quantity > 25 ~ l_linestatus", x, "binomial")
    return table(x, [(round(regression.log_lik(f)[0], 3), round(regression.aic(f), 3), round(float(regression.vcov(f)[1, 1]), 9))], "loglik double, aic double, vcov double")


@query("logit_predict", f"SELECT l_orderkey, l_linenumber, round(p, 6) AS p, p >= 0.5 AS response FROM lineitem JOIN {_SHARE} ON l_linestatus = s")
def _(t):
    x = t("lineitem")
    f = regression.glm("l_quantity > 25 ~ l_linestatus", x, "binomial")
    p = regression.predict(f, x, "prob")
    return x[["l_orderkey", "l_linenumber"]].cbind(p._with([p.cols[0].__class__("p", F.round(p.cols[0].expr, 6))]), regression.predict(f, x).alias("response"))


@query("logit_one", """
WITH RECURSIVE d AS (SELECT l_tax * 10 AS x, CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END AS y FROM lineitem),
it(i, a, b) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT i + 1, a + (sxx * r - sx * rx) / (s * sxx - sx * sx), b + (s * rx - sx * r) / (s * sxx - sx * sx) FROM (
    SELECT i, a, b, sum(p * (1 - p)) AS s, sum(p * (1 - p) * x) AS sx, sum(p * (1 - p) * x * x) AS sxx, sum(y - p) AS r, sum((y - p) * x) AS rx
    FROM (SELECT i, a, b, x, y, 1 / (1 + exp(-a - b * x)) AS p FROM it, d WHERE i < 12) GROUP BY i, a, b))
SELECT '(Intercept)' AS name, round(a, 6) + 0 AS value FROM it WHERE i = 12 UNION ALL SELECT 'x', round(b, 6) + 0 FROM it WHERE i = 12
""")
def _(t):
    x = t("lineitem")
    f = regression.glm("l_quantity > 25 ~ x", x.assign(x=x["l_tax"] * 10), "binomial")
    return coefs(x, f)


_MEANS = "(SELECT l_returnflag AS g, count(*) AS n, avg(l_quantity) AS m FROM lineitem GROUP BY 1)"


@query("glm_predict", f"SELECT l_orderkey, l_linenumber, round(m, 5) AS gamma, round(m, 5) AS inverse, round(m, 5) AS loglinear, CAST(round(m) AS DOUBLE) AS poisson FROM lineitem JOIN {_MEANS} ON l_returnflag = g")
def _(t):
    x = t("lineitem")
    out = x[["l_orderkey", "l_linenumber"]]
    kinds = {"gamma": ("gamma", "inverse"), "inverse": ("inverse_gaussian", "log"), "loglinear": ("gaussian", "log"), "poisson": ("poisson", "log")}
    for name, m in zip(kinds, regression.glms("l_quantity ~ l_returnflag", x, list(kinds.values())), strict=True):
        p = regression.predict(m, x)
        out = out.cbind(p._with([p.cols[0].__class__(name, F.round(p.cols[0].expr, 0 if name == "poisson" else 5))]))
    return out


@query("probit_predict", f"SELECT s AS level, round(p, 5) AS p FROM {_SHARE}")
def _(t):
    x = t("lineitem")
    f = regression.glm("l_quantity > 25 ~ l_linestatus", x, "binomial", "probit")
    p = regression.predict(f, x, "prob")
    rows = x[["l_linestatus"]].rename(["level"]).cbind(p._with([p.cols[0].__class__("p", F.round(p.cols[0].expr, 5))])).df
    return rows.distinct()


@query("poisson_inference", "SELECT round(sum(l_linenumber * ln(m) - m - lgamma(l_linenumber + 1)), 3) AS loglik FROM lineitem JOIN (SELECT l_returnflag AS g, avg(l_linenumber) AS m FROM lineitem GROUP BY 1) ON l_returnflag = g")
def _(t):
    x = t("lineitem")
    return table(x, [(round(regression.log_lik(regression.glm("l_linenumber ~ l_returnflag", x, "poisson"))[0], 3),)], "loglik double")


@query("glm_grouped", "SELECT l_returnflag AS g, round(avg(l_linenumber) FILTER (l_linestatus = 'F'), 5) AS f, round(avg(l_linenumber) FILTER (l_linestatus = 'O'), 5) AS o FROM lineitem GROUP BY 1")
def _(t):
    x = t("lineitem")
    m = regression.glm("l_linenumber ~ s | l_returnflag", x.assign(s=S.if_else(x["l_linestatus"] == "O", 1.0, 0.0)), "poisson")
    return table(x, [(f.group[0], round(float(np.exp(f.coef[0])), 5), round(float(np.exp(f.coef.sum())), 5)) for f in m], "g string, f double, o double")


@query("lm_grouped_predict", "SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 3) AS v FROM lineitem JOIN (SELECT l_returnflag AS g, l_linestatus AS s, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem GROUP BY 1, 2) ON l_returnflag = g AND l_linestatus = s")
def _(t):
    x = t("lineitem")
    p = regression.predict(regression.lm("l_extendedprice ~ l_quantity | l_returnflag + l_linestatus", x), x)
    return x[["l_orderkey", "l_linenumber"]].cbind(p._with([p.cols[0].__class__("v", F.round(p.cols[0].expr, 3))]))


@query("elnet_lasso_one", "SELECT round(greatest(abs(covar_pop(p_retailprice, p_size) / stddev_pop(p_size)) - 20, 0) * sign(covar_pop(p_retailprice, p_size)) / stddev_pop(p_size), 6) + 0 AS b FROM part")
def _(t):
    x = t("part")
    e = regression.elnet("p_retailprice ~ p_size", x, alpha=1.0, lambda_=20.0, tolerance=1e-12)
    return table(x, [(round(float(e.coef[0]), 6),)], "b double")


@query("elnet_predict", "SELECT p_partkey, round(a + b * (p_size - m), 5) AS v FROM part, (SELECT avg(p_retailprice) AS a, avg(p_size) AS m, covar_pop(p_retailprice, p_size) / var_pop(p_size) / 1.5 AS b FROM part)")
def _(t):
    x = t("part")
    p = regression.elnet("p_retailprice ~ p_size", x, alpha=0.0, lambda_=0.5, tolerance=1e-12).predict(x)
    return x[["p_partkey"]].cbind(p._with([p.cols[0].__class__("v", F.round(p.cols[0].expr, 5))]))


# ---- learners on data whose answer is known

@query("kmeans_step", """
WITH e AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
a AS (SELECT e.vec_id, arg_min(s.vec_id, (e.x - s.x) ** 2 + (e.y - s.y) ** 2) AS k FROM e, e s WHERE s.vec_id < 4 GROUP BY 1),
c AS (SELECT k, avg(x) AS x, avg(y) AS y FROM e JOIN a USING (vec_id) GROUP BY 1),
b AS (SELECT e.vec_id, arg_min(k, (e.x - c.x) ** 2 + (e.y - c.y) ** 2) AS k, min((e.x - c.x) ** 2 + (e.y - c.y) ** 2) AS d FROM e, c GROUP BY 1)
SELECT CAST(k + 1 AS INTEGER) AS cluster, count(*) AS n, round(sum(d), 6) AS within, round(any_value(c.x), 6) AS x, round(any_value(c.y), 6) AS y FROM b JOIN c USING (k) GROUP BY 1
""")
def _(t):
    x = t("embeddings")
    y = x[["vec_id"]].cbind(x["embedding"].element(1).alias("x"), x["embedding"].element(2).alias("y"))
    seeds = np.array([[r.x, r.y] for r in sort(y, False, "vec_id").df.limit(4).collect()])
    m = learners.kmeans(y, seeds, "vec_id", max_iter=1)
    return table(x, [(k + 1, int(m.size[k]), round(float(m.withinss[k]), 6), *(round(float(v), 6) for v in m.centers[k])) for k in range(4)], "cluster int, n long, within double, x double, y double")


_CLASS = "CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END"


def _classed(t):
    x = t("part")
    return x.assign(kind=S.if_else(x["p_size"] > 25, "large", "small"), v=S.if_else(x["p_size"] > 25, 10.0, 3.0))[["p_partkey", "p_size", "p_retailprice", "kind", "v"]]


@query("tree_known", f"SELECT p_partkey, {_CLASS} AS estimated FROM part")
def _(t):
    x = _classed(t)
    return learners.rpart("kind ~ p_size + p_retailprice", x, "p_partkey").predict(x)


@query("tree_regression_known", "SELECT p_partkey, CAST(CASE WHEN p_size > 25 THEN 10 ELSE 3 END AS DOUBLE) AS estimated FROM part")
def _(t):
    x = _classed(t)
    return learners.rpart("v ~ p_size", x, "p_partkey").predict(x)


@query("forest_known", f"SELECT p_partkey, {_CLASS} AS estimated FROM part")
def _(t):
    x = _classed(t)
    return learners.random_forest("kind ~ p_size", x, "p_partkey", ntree=5).predict(x)


@query("svm_known", "SELECT p_partkey, p_size > 25 AS prediction FROM part WHERE abs(p_size - 25) > 5")
def _(t):
    x = _classed(t)
    x = x[(x["p_size"] > 30) | (x["p_size"] < 20), :]
    z = x.assign(s=(x["p_size"] - 25) / 15)
    m = learners.svm("p_size > 25 ~ s", z, max_iter=60)
    return Frame(m.predict(z, "p_partkey").df.select("p_partkey", "prediction"))


@query("arima_ar1", "SELECT round(sum(v * b) / sum(b * b), 5) AS ar1 FROM (SELECT v, lag(v) OVER (ORDER BY d) AS b FROM (SELECT CAST(ts AS DATE) AS d, sum(value) AS v FROM events GROUP BY 1)) WHERE b IS NOT NULL")
def _(t):
    x = t("events")
    y = x.assign(day=S.to_date(x["ts"]))
    daily = A.by(y, "day", lambda g: A.total(g["value"]).alias("v"))
    m = AR.arima(daily["v"], daily["day"], (1, 0, 0), include_mean=False)
    return table(x, [(round(m.coef["ar1"], 5),)], "ar1 double")


@query("arima_forecast", "WITH y AS (SELECT CAST(ts AS DATE) AS d, sum(value) AS v FROM events GROUP BY 1), f AS (SELECT sum(v * b) / sum(b * b) AS p FROM (SELECT v, lag(v) OVER (ORDER BY d) AS b FROM y) WHERE b IS NOT NULL) SELECT CAST(h AS INTEGER) AS step, round(arg_max(v, d) * p ** h, 2) AS value FROM y, f, range(1, 4) r(h) GROUP BY h, p")
def _(t):
    x = t("events")
    y = x.assign(day=S.to_date(x["ts"]))
    daily = A.by(y, "day", lambda g: A.total(g["value"]).alias("v"))
    m = AR.arima(daily["v"], daily["day"], (1, 0, 0), include_mean=False)
    return table(x, [(int(r.steps_ahead), round(float(r.forecast_value), 2)) for r in m.forecast(3).itertuples()], "step int, value double")


@query("lda_vocabulary", r"SELECT count(DISTINCT w) AS words FROM (SELECT unnest(string_split_regex(text, '\s+')) AS w FROM documents)")
def _(t):
    x = t("documents")
    d = Frame(x.base.select("doc_id", F.split("text", r"\s+").alias("words")))
    return table(x, [(len(learners._term_counts(d, "doc_id", "words")[1]),)], "words long")


# ---- resampling

@query("cut_approximate", "SELECT count(*) AS n, count(*) AS differ, 4 * count(*) - count(*) AS trained FROM part")
def _(t):
    parts = resample.folds(t("part")[["p_partkey"]], 4, True, seed=1)
    held = parts[0][1].df.unionByName(parts[1][1].df).unionByName(parts[2][1].df).unionByName(parts[3][1].df)
    return table(t("part"), [(held.count(), held.distinct().count(), sum(a.df.count() for a, _b in parts))], "n long, differ long, trained long")


@query("cut_exact", "SELECT 7 AS k, count(*) // 7 AS least, (count(*) + 6) // 7 AS most, count(*) AS differ FROM part")
def _(t):
    parts = [b.df for _a, b in resample.folds(t("part")[["p_partkey"]], 7, False, seed=1)]
    sizes = [b.count() for b in parts]
    held = parts[0]
    for b in parts[1:]:
        held = held.unionByName(b)
    return table(t("part"), [(len(sizes), min(sizes), max(sizes), held.distinct().count())], "k int, least long, most long, differ long")


@query("cross_validation_known", "SELECT round(avg(p_size * p_size), 4) AS err FROM part")
def _(t):
    x = t("part")[["p_partkey", "p_size"]]
    r = resample.cross_validate(lambda d: None, lambda m, d: None, lambda p, d: A.mean(d["p_size"] ** 2), x, k=4, approximate=False)
    return table(x, [(round(r["err"], 4),)], "err double")


@query("cross_validation_grid", "SELECT CAST(3 AS DOUBLE) AS best, true AS exact")
def _(t):
    x = t("part")[["p_partkey", "p_size"]]
    r = resample.cross_validate(lambda d, f: f, lambda f, d: d["p_size"] * f, lambda p, d: A.mean((p - d["p_size"] * 3) ** 2), x, {"f": [1.0, 3.0, 5.0]}, k=3)
    return table(x, [(float(r["params"]["f"]), r["best"] == 3.0 and bool(abs(r["metric"].avg[1]) < 1e-9))], "best double, exact boolean")


def _line(t):
    x = t("part")
    return x.assign(y=x["p_size"] * 2 + 1)[["p_partkey", "p_size", "y"]]


@query("bagging_known", "SELECT p_partkey, CAST(2 * p_size + 1 AS DOUBLE) AS v FROM part")
def _(t):
    x = _line(t)
    p = resample.bagging(lambda d: regression.lm("y ~ p_size", d), x, nbags=3).predict(x)
    return x[["p_partkey"]].cbind(p._with([p.cols[0].__class__("v", F.round(p.cols[0].expr, 6))]))


@query("bagging_vote", "SELECT p_partkey, 2 * p_size + 1 > 50 AS v FROM part")
def _(t):
    x = _line(t)
    b = resample.bagging(lambda d: regression.lm("y ~ p_size", d), x, nbags=3, predict=lambda m, d: regression.predict(m, d) > 50)
    return x[["p_partkey"]].cbind(b.predict(x, "vote").alias("v"))
