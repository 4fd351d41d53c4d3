"""Registered queries of the algebra and the models, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from tarn.frame import Col, Frame
from tarn.functions import aggregates as A
from tarn.functions import scalar as S
from tarn.operators import arrays as R
from tarn.operators.join import merge
from tarn.operators.order import sort

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark, sf_dir: str):
            out = fn(lambda t, key=None: Frame(spark.read.parquet(f"{sf_dir}/{t}.parquet"), key=key))
            return out.df if isinstance(out, Frame) else out

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return register


def simple(name: str, table: str, sql: str, build: Callable[[Frame], Frame]) -> None:
    query(name, sql)(lambda t: build(t(table)))


def named(x: Frame, *names: str) -> Frame:
    return x.rename(list(names))


# ---- projection and filters

simple("filter_num", "lineitem", "SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity > 45", lambda x: x[x["l_quantity"] > 45, ["l_orderkey", "l_quantity", "l_extendedprice"]])
simple("filter_date", "orders", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'", lambda x: x[x["o_orderdate"] >= "1996-01-01", ["o_orderkey", "o_orderdate"]])
simple("filter_and_or", "lineitem", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_quantity > 40 AND l_discount < 0.03) OR l_returnflag = 'R'", lambda x: x[((x["l_quantity"] > 40) & (x["l_discount"] < 0.03)) | (x["l_returnflag"] == "R"), ["l_orderkey", "l_linenumber"]])
simple("filter_not", "customer", "SELECT c_custkey, c_mktsegment FROM customer WHERE NOT (c_mktsegment = 'BUILDING')", lambda x: x[~(x["c_mktsegment"] == "BUILDING"), ["c_custkey", "c_mktsegment"]])
query("filter_isin_key", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (1, 5, 9, 100000000)")(lambda t: t("customer", "c_custkey")[[1, 5, 9, 100000000], ["c_custkey", "c_name"]])
query("cell_by_key", "SELECT c_name FROM customer WHERE c_custkey = 7")(lambda t: t("customer", "c_custkey")[[7], ["c_name"]])
_NULLED = "CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END"


def _nulled(x: Frame) -> Frame:
    return x.assign_where(x["l_discount"] == 0, "l_discount", None)


simple("filter_isnull", "lineitem", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_discount = 0", lambda x: (lambda y: y[y["l_discount"].is_na(), ["l_orderkey", "l_linenumber", "l_partkey"]])(_nulled(x)))
simple("na_omit", "lineitem", f"SELECT l_orderkey, {_NULLED} AS l_discount FROM lineitem WHERE l_discount <> 0", lambda x: _nulled(x)[["l_orderkey", "l_discount"]].na_omit())
simple("na_omit_vars", "lineitem", "SELECT l_orderkey FROM lineitem WHERE l_discount <> 0", lambda x: (lambda y: y.na_omit("l_discount")[["l_orderkey"]])(_nulled(x)))
simple("select_neg", "region", "SELECT r_name FROM region", lambda x: x.drop(0))
simple("subset", "part", "SELECT p_partkey, p_size FROM part WHERE p_size >= 40", lambda x: x.subset(x["p_size"] >= 40, ["p_partkey", "p_size"]))
simple("add_col", "lineitem", "SELECT l_orderkey, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem", lambda x: x.assign(revenue=x["l_extendedprice"] * (1 - x["l_discount"]))[["l_orderkey", "revenue"]])
simple("replace_col", "part", "SELECT p_partkey, p_size * 2 AS p_size FROM part", lambda x: x.assign(p_size=x["p_size"] * 2)[["p_partkey", "p_size"]])
simple("const_col", "region", "SELECT r_regionkey, 'k' AS tag, 7 AS n FROM region", lambda x: x.assign(tag="k", n=7)[["r_regionkey", "tag", "n"]])
simple("cond_replace", "lineitem", "SELECT l_orderkey, CASE WHEN l_quantity > 40 THEN 0 ELSE l_tax END AS l_tax FROM lineitem", lambda x: x.assign_where(x["l_quantity"] > 40, "l_tax", 0)[["l_orderkey", "l_tax"]])
simple("ifelse", "part", "SELECT p_partkey, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS size FROM part", lambda x: x[["p_partkey"]].cbind(S.if_else(x["p_size"] > 25, "big", "small").alias("size")))
simple("rename", "nation", "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation", lambda x: named(x, "id", "name", "region"))
simple("cbind_dup", "nation", 'SELECT n_name, n_nationkey, n_name AS "n_name.1" FROM nation', lambda x: x[["n_name", "n_nationkey"]].cbind(x["n_name"]))
simple("with_expr", "part", "SELECT p_retailprice / p_size AS v FROM part", lambda x: x.evaluate(lambda c: c.p_retailprice / c.p_size).alias("v"))

# ---- comparison and arithmetic

for _n, _op, _f in (("gt", ">", lambda a, b: a > b), ("lt", "<", lambda a, b: a < b), ("ge", ">=", lambda a, b: a >= b), ("le", "<=", lambda a, b: a <= b), ("eq", "=", lambda a, b: a == b), ("ne", "<>", lambda a, b: a != b)):
    simple(f"cmp_{_n}", "part", f"SELECT p_partkey, p_size {_op} 20 AS v, p_brand {_op} 'Brand#3' AS s FROM part", lambda x, f=_f: x[["p_partkey"]].cbind(f(x["p_size"], 20).alias("v"), f(x["p_brand"], "Brand#3").alias("s")))
simple("cmp_frames", "lineitem", "SELECT l_orderkey, l_tax > l_discount AS v FROM lineitem", lambda x: x[["l_orderkey"]].cbind((x["l_tax"] > x["l_discount"]).alias("v")))
simple("cmp_wrong_type", "nation", "SELECT n_nationkey, CAST(NULL AS BOOLEAN) AS v FROM nation", lambda x: x[["n_nationkey"]].cbind((x["n_name"] > 3).alias("v")))
for _n, _sql, _f in (
    ("add", "l_quantity + l_tax", lambda x: x["l_quantity"] + x["l_tax"]), ("sub", "l_quantity - l_linenumber", lambda x: x["l_quantity"] - x["l_linenumber"]), ("mul", "l_extendedprice * l_discount", lambda x: x["l_extendedprice"] * x["l_discount"]), ("div", "CAST(l_orderkey AS DOUBLE) / l_linenumber", lambda x: x["l_orderkey"] / x["l_linenumber"]),
    ("pow", "pow(CAST(l_linenumber AS DOUBLE), 2)", lambda x: x["l_linenumber"] ** 2), ("mod", "CAST(l_orderkey % 7 AS BIGINT)", lambda x: x["l_orderkey"] % 7), ("idiv", "CAST(l_orderkey // 7 AS BIGINT)", lambda x: x["l_orderkey"] // 7), ("scalar_left", "100 - l_quantity", lambda x: 100 - x["l_quantity"]), ("div_left", "1000 / l_quantity", lambda x: 1000 / x["l_quantity"]), ("neg", "-l_quantity", lambda x: -x["l_quantity"]), ("idiv_left", "CAST(1000000 // l_linenumber AS BIGINT)", lambda x: 1000000 // x["l_linenumber"]),
):
    simple(f"arith_{_n}", "lineitem", f"SELECT l_orderkey, l_linenumber, {_sql} AS v FROM lineitem", lambda x, f=_f: x[["l_orderkey", "l_linenumber"]].cbind(f(x).alias("v")))
simple("date_add_days", "orders", "SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS v FROM orders", lambda x: x[["o_orderkey"]].cbind((S.to_date(x["o_orderdate"]) + 30).alias("v")))
simple("date_diff_days", "orders", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INTEGER) AS v FROM orders", lambda x: x[["o_orderkey"]].cbind((S.to_date(x["o_orderdate"]) - "1995-01-01").alias("v")))
simple("ts_add_interval", "events", "SELECT event_id, ts + INTERVAL 2 HOUR AS v FROM events", lambda x: x[["event_id"]].cbind((x["ts"] + "2 hours").alias("v")))

# ---- mathematics and casts

_Q = "l_quantity"
for _n, _sql, _f in (("exp", "exp(l_discount)", lambda x: S.exp(x["l_discount"])), ("ln", "ln(l_quantity)", lambda x: S.log(x[_Q])), ("log10", "log10(l_quantity)", lambda x: S.log10(x[_Q])), ("sqrt", "sqrt(l_quantity)", lambda x: S.sqrt(x[_Q])), ("abs", "abs(l_quantity - 25)", lambda x: S.absolute(x[_Q] - 25)), ("sign", "sign(l_quantity - 25)", lambda x: S.sign(x[_Q] - 25)), ("sin", "sin(l_quantity)", lambda x: S.sin(x[_Q])), ("cos", "cos(l_quantity)", lambda x: S.cos(x[_Q])), ("tan", "tan(l_quantity)", lambda x: S.tan(x[_Q])), ("asin", "asin(l_discount)", lambda x: S.asin(x["l_discount"])), ("acos", "acos(l_discount)", lambda x: S.acos(x["l_discount"])), ("atan", "atan(l_quantity)", lambda x: S.atan(x[_Q])), ("atan2", "atan(l_discount / l_quantity)", lambda x: S.atan2(x["l_discount"], x[_Q]))):
    simple(f"math_{_n}", "lineitem", f"SELECT l_orderkey, l_linenumber, round(CAST({_sql} AS DOUBLE), 6) AS v FROM lineitem", lambda x, f=_f: x[["l_orderkey", "l_linenumber"]].cbind(f(x).alias("v"))._with([*x[["l_orderkey", "l_linenumber"]].cols, _rounded(f(x).cols[0].expr)]))


def _rounded(e, name: str = "v", digits: int = 6):
    from tarn.frame import Col

    return Col(name, F.round(e.cast("double"), digits))


simple("math_factorial", "lineitem", "SELECT l_orderkey, CAST(factorial(l_linenumber) AS BIGINT) AS v FROM lineitem", lambda x: x[["l_orderkey"]].cbind(S.factorial(x["l_linenumber"]).alias("v")))
simple("row_sums", "lineitem", "SELECT l_orderkey, l_quantity + l_discount + l_tax AS v FROM lineitem", lambda x: x[["l_orderkey"]].cbind(S.row_sums(x[["l_quantity", "l_discount", "l_tax"]]).alias("v")))
simple("row_means", "lineitem", "SELECT l_orderkey, round((l_quantity + l_discount + l_tax) / 3, 9) AS v FROM lineitem", lambda x: x[["l_orderkey"]].cbind(x._with([_rounded(S.row_means(x[["l_quantity", "l_discount", "l_tax"]]).cols[0].expr, "v", 9)])))
simple("cast_int", "lineitem", "SELECT l_orderkey, CAST(l_extendedprice / 2 AS INTEGER) AS v FROM lineitem", lambda x: x[["l_orderkey"]].cbind(S.to_integer(x["l_extendedprice"] / 2).alias("v")))
simple("cast_str", "part", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS v FROM part", lambda x: x[["p_partkey"]].cbind(S.to_character(x["p_size"]).alias("v")))
simple("cast_dbl", "part", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS v FROM part", lambda x: x[["p_partkey"]].cbind(S.to_numeric(x["p_size"]).alias("v")))
simple("cast_bool", "labels", "SELECT doc_id, CAST(quality AS BOOLEAN) AS v FROM labels", lambda x: x[["doc_id"]].cbind(S.to_logical(x["quality"]).alias("v")))
simple("cast_date", "orders", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS v FROM orders", lambda x: x[["o_orderkey"]].cbind(S.to_date(x["o_orderdate"]).alias("v")))
simple("cast_ts", "events", "SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS v FROM events", lambda x: x[["event_id"]].cbind(S.to_timestamp(S.to_date(x["ts"])).alias("v")))
simple("grepl", "part", "SELECT p_partkey, regexp_matches(p_type, '^S.*L$') AS v FROM part", lambda x: x[["p_partkey"]].cbind(S.grepl("^S.*L$", x["p_type"]).alias("v")))
simple("grepl_ci", "part", "SELECT p_partkey, regexp_matches(p_type, 'steel|tin', 'i') AS v FROM part", lambda x: x[["p_partkey"]].cbind(S.grepl("steel|tin", x["p_type"], ignore_case=True).alias("v")))
simple("grepl_fixed", "part", "SELECT p_partkey, contains(p_brand, '#1') AS v FROM part", lambda x: x[["p_partkey"]].cbind(S.grepl("#1", x["p_brand"], fixed=True).alias("v")))

# ---- aggregates

for _n, _sql, _f in (("mean", "round(avg(l_quantity), 6)", A.mean), ("sum", "round(sum(l_quantity), 4)", A.total), ("count", "count(l_quantity)", A.count), ("min", "min(l_quantity)", A.smallest), ("max", "max(l_quantity)", A.largest), ("sd", "round(stddev(l_quantity), 6)", A.sd), ("var", "round(var_samp(l_quantity), 6)", A.var)):
    simple(f"agg_{_n}", "lineitem", f"SELECT {_sql} AS v FROM lineitem", lambda x, f=_f, r="round" in _sql, d=4 if _n == "sum" else 6: x._with([_rounded(f(x[_Q]).cols[0].expr, "v", d)] if r else f(x[_Q]).alias("v").cols, agg=True))
simple("col_means", "lineitem", "SELECT round(avg(l_quantity), 6) AS a, round(avg(l_tax), 6) AS b FROM lineitem", lambda x: x._with([_rounded(c.expr, n) for c, n in zip(A.col_means(x[["l_quantity", "l_tax"]]).cols, "ab", strict=True)], agg=True))
simple("col_sums", "part", "SELECT CAST(sum(p_size) AS BIGINT) AS a, CAST(sum(p_partkey) AS BIGINT) AS b FROM part", lambda x: named(A.col_sums(x[["p_size", "p_partkey"]]), "a", "b"))
simple("col_agg", "region", "SELECT array_to_string(list(r_regionkey ORDER BY r_regionkey), ',') AS v FROM region", lambda x: (lambda y: y._with([type(y.cols[0])("v", F.array_join(y.cols[0].expr, ","))]))(A.col_agg(x["r_regionkey"])))
simple("agg_bool", "part", "SELECT round(avg(CASE WHEN p_size > 25 THEN 1 ELSE 0 END), 9) AS v FROM part", lambda x: x._with([_rounded(A.mean(x["p_size"] > 25).cols[0].expr, "v", 9)], agg=True))
simple("by_one", "lineitem", "SELECT l_returnflag, count(l_orderkey) AS n FROM lineitem GROUP BY 1", lambda x: A.by(x, "l_returnflag", lambda g: A.count(g["l_orderkey"]).alias("n")))
simple("by_two", "lineitem", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 4) AS sum_qty, round(avg(l_extendedprice), 6) AS avg_price, count(l_orderkey) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2", lambda x: A.by(x[x["l_shipdate"] <= "1998-09-02", :], ["l_returnflag", "l_linestatus"], lambda g: g._with([_rounded(A.total(g[_Q]).cols[0].expr, "sum_qty", 4), _rounded(A.mean(g["l_extendedprice"]).cols[0].expr, "avg_price"), A.count(g["l_orderkey"]).alias("n").cols[0]], agg=True)))
simple("by_filtered", "orders", "SELECT o_orderpriority, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1", lambda x: A.by(x[x["o_orderstatus"] == "F", :], "o_orderpriority", lambda g: A.largest(g["o_totalprice"]).alias("v")))
simple("by_null_key", "lineitem", "SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END AS l_returnflag, count(l_orderkey) AS n FROM lineitem GROUP BY 1", lambda x: (lambda y: A.by(y, "l_returnflag", lambda g: A.count(g["l_orderkey"]).alias("n")))(x.assign_where(x["l_returnflag"] == "R", "l_returnflag", None)))
simple("having", "orders", "SELECT o_custkey, count(o_orderkey) AS n FROM orders GROUP BY 1 HAVING count(o_orderkey) > 15", lambda x: (lambda y: y[y["n"] > 15, :])(A.by(x, "o_custkey", lambda g: A.count(g["o_orderkey"]).alias("n"))))
simple("unique", "orders", "SELECT DISTINCT o_orderpriority FROM orders", lambda x: A.unique(x["o_orderpriority"]))
simple("levels_by", "customer", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer", lambda x: A.by(x, ["c_mktsegment", "c_nationkey"], lambda g: g[["c_mktsegment", "c_nationkey"]]))
simple("agg_scalar_operand", "lineitem", "SELECT l_orderkey, l_linenumber, round(l_quantity - (SELECT avg(l_quantity) FROM lineitem), 6) AS v FROM lineitem", lambda x: x[["l_orderkey", "l_linenumber"]].cbind(x._with([_rounded((x[_Q] - A.mean(x[_Q])).cols[0].expr)])))

# ---- sorting

simple("sort_asc", "customer", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal", lambda x: sort(x[["c_custkey", "c_acctbal"]], False, "c_acctbal"))
simple("sort_desc_multi", "orders", "SELECT o_orderpriority, o_orderkey FROM orders ORDER BY 1 DESC, 2", lambda x: sort(x[["o_orderpriority", "o_orderkey"]], [True, False], ["o_orderpriority", "o_orderkey"]))
query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")(lambda t: sort(t("orders")[["o_orderkey", "o_totalprice"]], [True, False], ["o_totalprice", "o_orderkey"]).df.limit(25))

# ---- joins


def _joined(how: str, **kind) -> None:
    sql = f"SELECT a.k AS k, a.p, b.q FROM (SELECT n_nationkey AS k, n_name AS p FROM nation WHERE n_nationkey < 15) a {how} JOIN (SELECT s_nationkey AS k, s_suppkey AS q FROM supplier WHERE s_nationkey > 8) b ON a.k = b.k"

    @query(f"join_{how.split()[0].lower()}", sql)
    def run(t):
        n, s = t("nation"), t("supplier")
        a = named(n[n["n_nationkey"] < 15, ["n_nationkey", "n_name"]], "k", "p")
        b = named(s[s["s_nationkey"] > 8, ["s_nationkey", "s_suppkey"]], "k", "q")
        return merge(a, b, **kind)


_joined("INNER"), _joined("LEFT", all_x=True), _joined("RIGHT", all_y=True), _joined("FULL", all_rows=True)
query("join_cross", "SELECT r_name, n_name FROM region CROSS JOIN nation")(lambda t: merge(t("region")[["r_name"]], t("nation")[["n_name"]], by=None))
query("join_diff_names", "SELECT o_custkey, o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")(lambda t: merge(t("orders")[["o_custkey", "o_orderkey"]], t("customer")[["c_custkey", "c_name"]], by_x="o_custkey", by_y="c_custkey"))
query("join_suffix", "SELECT a.k AS k, a.v AS v_x, b.v AS v_y FROM (SELECT n_nationkey AS k, n_name AS v FROM nation) a JOIN (SELECT s_nationkey AS k, s_name AS v FROM supplier) b ON a.k = b.k")(lambda t: merge(named(t("nation")[["n_nationkey", "n_name"]], "k", "v"), named(t("supplier")[["s_nationkey", "s_name"]], "k", "v"), by="k"))
query("join_multi_key", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem JOIN (SELECT DISTINCT l_orderkey AS a, l_linenumber AS b FROM lineitem WHERE l_tax > 0.05) ON l_orderkey = a AND l_linenumber = b GROUP BY 1, 2")(lambda t: (lambda x: (lambda m: A.by(m, ["l_orderkey", "l_linenumber"], lambda g: A.count(g["l_orderkey"]).alias("n")))(merge(x[["l_orderkey", "l_linenumber"]], A.by(x[x["l_tax"] > 0.05, ["l_orderkey", "l_linenumber"]], ["l_orderkey", "l_linenumber"], lambda g: g[["l_orderkey", "l_linenumber"]]), by=["l_orderkey", "l_linenumber"])))(t("lineitem")))
query("star_join", "SELECT r_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")(
    lambda t: (lambda m: A.by(m, "r_name", lambda g: g._with([_rounded(A.total(g["l_extendedprice"] * (1 - g["l_discount"])).cols[0].expr, "revenue", 2)], agg=True)))(
        merge(merge(merge(merge(t("lineitem")[["l_orderkey", "l_extendedprice", "l_discount"]], t("orders")[["o_orderkey", "o_custkey"]], by_x="l_orderkey", by_y="o_orderkey"), t("customer")[["c_custkey", "c_nationkey"]], by_x="o_custkey", by_y="c_custkey"), t("nation")[["n_nationkey", "n_regionkey"]], by_x="c_nationkey", by_y="n_nationkey"), t("region"), by_x="n_regionkey", by_y="r_regionkey")
    )
)

# ---- arrays and factors

simple("db_array", "lineitem", "SELECT l_orderkey, l_linenumber, list_sum([l_quantity, l_tax, 1.0]) AS v FROM lineitem", lambda x: (lambda y: y[["l_orderkey", "l_linenumber"]].cbind(S.row_sums(y["a"]).alias("v")))(x.assign(a=R.array_of(x[["l_quantity", "l_tax"]], 1.0))))
simple("array_elem", "embeddings", "SELECT vec_id, embedding[3] AS v FROM embeddings", lambda x: x[["vec_id"]].cbind(x["embedding"].element(3).alias("v")))
simple("array_scale", "embeddings", "SELECT vec_id, CAST(embedding[2] AS DOUBLE) * 3 AS v FROM embeddings", lambda x: (lambda y: x[["vec_id"]].cbind(y.element(2).alias("v")))(S.to_numeric(x["embedding"]) * 3))
simple("array_product", "embeddings", "SELECT vec_id, CAST(embedding[1] AS DOUBLE) * CAST(embedding[1] AS DOUBLE) AS v FROM embeddings", lambda x: (lambda e: x[["vec_id"]].cbind((e * e).element(1).alias("v")))(S.to_numeric(x["embedding"])))
simple("array_agg_mean", "embeddings", "SELECT round(avg(CAST(embedding[1] AS DOUBLE)), 6) AS a, round(avg(CAST(embedding[64] AS DOUBLE)), 6) AS b FROM embeddings", lambda x: (lambda m: m._with([_rounded(F.element_at(m.cols[0].expr, k), n) for k, n in ((1, "a"), (64, "b"))], agg=True))(A.mean(x["embedding"])))
simple("array_expand", "embeddings", 'SELECT vec_id, embedding[64] AS v FROM embeddings', lambda x: x[["vec_id"]].cbind(R.expand(x["embedding"])["embedding[64]"].alias("v")))
simple("unnest", "embeddings", "SELECT count(*) AS n FROM embeddings, unnest(embedding)", lambda x: A.count(R.unnest(x["embedding"])["pos"]).alias("n"))
simple("factor_dummies", "lineitem", "SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS l_returnflag_R, CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS l_returnflag_N FROM lineitem", lambda x: x[["l_orderkey"]].cbind(S.dummies(S.to_factor(x["l_returnflag"]))))
simple("col_by_query", "nation", "SELECT n_name FROM nation", lambda x: x[A.smallest(x["n_nationkey"]) + 2])
simple("as_list", "nation", "SELECT n_name, n_nationkey FROM nation", lambda x: (lambda a: a[1].cbind(a[0]))(x.as_list()))
simple("array_columns", "embeddings", "SELECT vec_id, embedding[64] AS v, 65 AS width FROM embeddings", lambda x: (lambda y: x[["vec_id"]].cbind(y.as_list(True)[64].alias("v")).assign(width=R.width(y)))(x[["vec_id", "embedding"]]))
simple("collate", "lineitem", "SELECT l_orderkey, l_linenumber, l_tax AS v FROM lineitem", lambda x: (lambda y: y[["l_orderkey", "l_linenumber"]].cbind(y["both"].element(2).alias("v")))(R.collate(x, ["l_quantity", "l_tax"], "both")))
query("by_object", "SELECT l_returnflag AS g, count(*) AS n FROM lineitem GROUP BY 1")(lambda t: (lambda x: x.base.sparkSession.createDataFrame([(k[0], int(n)) for k, n in A.by(x, "l_returnflag", lambda g: g.dim()[0])], "g string, n long"))(t("lineitem")))
simple("by_none", "part", "SELECT max(p_size) AS v FROM part", lambda x: A.by(x, None, lambda g: A.largest(g["p_size"]).alias("v")))
simple("isnull_array", "embeddings", "SELECT vec_id, vec_id % 3 = 0 AS v FROM embeddings", lambda x: x[["vec_id"]].cbind(R.array_of(x.assign(n=S.if_else(x["vec_id"] % 3 == 0, None, x["label"]))["n"], 1).is_na().alias("v")))
simple("factor_relevel", "orders", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS s_P, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS s_F FROM orders", lambda x: x[["o_orderkey"]].cbind(S.dummies(S.relevel(S.to_factor(x["o_orderstatus"].alias("s")), "O"))))
simple("cast_time", "events", "SELECT event_id, hour(CAST(ts AS TIME)) * 3600 + minute(CAST(ts AS TIME)) * 60 + second(CAST(ts AS TIME)) AS v FROM events", lambda x: (lambda y: x[["event_id"]].cbind(y._with([Col("v", (F.hour(y.cols[0].expr) * 3600 + F.minute(y.cols[0].expr) * 60 + F.second(y.cols[0].expr)).cast("long"))])))(S.to_time(x["ts"])))
simple("cast_interval", "orders", "SELECT o_orderkey, o_orderdate + INTERVAL 26 HOUR AS v FROM orders", lambda x: (lambda y: x[["o_orderkey"]].cbind(y._with([Col("v", x["o_orderdate"].cols[0].expr + y.cols[0].expr)])))(S.to_interval(x.assign(t="1 day 02:00:00")["t"])))
simple("interval_days", "lineitem", "SELECT l_orderkey, l_linenumber, l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS v FROM lineitem", lambda x: (lambda y: x[["l_orderkey", "l_linenumber"]].cbind(y._with([Col("v", x["l_shipdate"].cols[0].expr + y.cols[0].expr)])))(S.to_interval(x["l_quantity"])))
query("table_sizes", "SELECT 'orders' AS t, count(*) AS n FROM orders UNION ALL SELECT 'part', count(*) FROM part")(lambda t: t("orders").df.groupBy(F.lit("orders").alias("t")).agg(F.count("*").alias("n")).unionByName(t("part").df.groupBy(F.lit("part").alias("t")).agg(F.count("*").alias("n"))))

from tarn.plans import model_queries, source_queries  # noqa: E402, F401  register more queries
