"""Queries of sessions, catalog, sources and sinks: each takes a round trip through them and returns rows that SQL knows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tarn.frame import Frame
from tarn.functions import aggregates as A
from tarn.functions import scalar as S
from tarn.operators.order import in_order, indexed, sample, sort
from tarn.plans.queries import QUERIES, SQL
from tarn.sources import catalog as K


def trip(name: str, sql: str):
    """Registers fn(connection id, folder of the tables): a frame, a DataFrame, or (rows, schema)."""

    def register(fn):
        def run(spark, sf_dir: str):
            c = K.connect(spark)
            try:
                out = fn(c, sf_dir)
            finally:
                K.disconnect(c)
            return out.df if isinstance(out, Frame) else spark.createDataFrame(*out) if isinstance(out, tuple) else out

        QUERIES[name], SQL[name] = run, sql
        return fn

    return register


def temp() -> str:
    return f"trip_{uuid.uuid4().hex[:12]}"


@trip("session", "SELECT true AS connected, true AS same, true AS known, true AS gone")
def _(c, d):
    s = K.connection(c)
    other = K.connect(s)
    same, known = K.same_database(c, other), other in K.connections() and K.connection_info(c)["dbms"] == f"Spark {s.version}"
    gone = K.disconnect(other) and other not in K.connections() and not K.disconnect(other)
    return [(c in K.connections(), same, known and "default" in K.list_databases(c), gone)], "connected boolean, same boolean, known boolean, gone boolean"


@trip("catalog_objects", "SELECT true AS there, true AS listed, true AS gone, true AS found, 1 AS path")
def _(c, d):
    name = temp()
    x = K.save(K.wrap(f"{d}/region.parquet", c), name, is_view=True)
    there, listed = K.exists(name, c) and K.exists(name, c, is_temp=True) == (True, name), any(n.endswith(name) for n in K.objects("trip_", c))
    found, path = K.resolve(name, c) == name and K.conn_id(x) is not None, len(K.search_path(c, K.search_path(c)))
    return [(there, listed, K.delete(x) and not K.exists(name, c) and not K.delete(name, c), found, path)], "there boolean, listed boolean, gone boolean, found boolean, path int"


@trip("wrap_path", "SELECT n_name, n_regionkey FROM nation WHERE n_nationkey IN (3, 5)")
def _(c, d):
    x = K.wrap(f"{d}/nation.parquet", c, key="n_nationkey")
    return x[[3, 5], ["n_name", "n_regionkey"]]


@trip("raw_sql", "SELECT CAST(n_regionkey AS BIGINT) AS n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def _(c, d):
    name = temp()
    K.save(K.wrap(f"{d}/nation.parquet", c), name, is_view=True)
    rows = K.query("SELECT n_regionkey, count(*) AS n", f"FROM {name} GROUP BY 1", nrows="all", conn_id=c)
    K.delete(name, c)
    return K.connection(c).createDataFrame(rows)


@trip("upload_rows", "SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey, r_name FROM region WHERE r_regionkey > 2")
def _(c, d):
    rows = K.as_data_frame(K.wrap(f"{d}/region.parquet", c)[["r_regionkey", "r_name"]])
    x = K.upload(rows, conn_id=c, is_temp=True)
    more = K.upload(rows[rows.r_regionkey > 2], conn_id=c, is_temp=True)
    return x.df.unionByName(more.df)


@trip("csv_load", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def _(c, d):
    path = K.shared_path(K.connection(c))
    K.wrap(f"{d}/part.parquet", c)[["p_partkey", "p_name", "p_size", "p_retailprice"]].df.write.option("sep", "|").option("header", True).csv(path)
    return K.upload(path, conn_id=c, is_temp=True, sep="|", types="p_partkey long, p_name string, p_size int, p_retailprice double")


@trip("csv_skip", "SELECT n_nationkey, n_name FROM nation")
def _(c, d):
    path = K.shared_path(K.connection(c))
    lines = K.connection(c).createDataFrame([(k, v) for k, v in enumerate(["made by hand", "second line to skip", "n_nationkey,n_name", *(f"{r.n_nationkey},{r.n_name}" for r in K.wrap(f"{d}/nation.parquet", c).df.collect())])], "k long, v string")
    lines.coalesce(1).sortWithinPartitions("k").select("v").write.option("lineSep", ";").text(path)
    return K.upload(path, conn_id=c, is_temp=True, skip=2, eol=";", types="n_nationkey int, n_name string")


@trip("materialise", "SELECT o_orderstatus, sum(o_totalprice) AS v FROM orders GROUP BY 1")
def _(c, d):
    x = K.wrap(f"{d}/orders.parquet", c)
    kept = K.save(A.by(x, "o_orderstatus", lambda g: A.total(g["o_totalprice"]).alias("v")), is_temp=True)
    return K.save(kept, is_temp=True, types={"v": "double"}).root()


@trip("materialise_factor", "SELECT n_nationkey, CASE WHEN n_regionkey = 4 THEN 1 ELSE 0 END AS r_4, CASE WHEN n_regionkey = 3 THEN 1 ELSE 0 END AS r_3, CASE WHEN n_regionkey = 2 THEN 1 ELSE 0 END AS r_2, CASE WHEN n_regionkey = 0 THEN 1 ELSE 0 END AS r_0 FROM nation")
def _(c, d):
    x = K.wrap(f"{d}/nation.parquet", c)[["n_nationkey", "n_regionkey"]].rename(["n_nationkey", "r"])
    return K.save(x[["n_nationkey"]].cbind(S.relevel(S.to_factor(x["r"]), "1")), is_temp=True)


@trip("dimensions", "SELECT 'orders' AS t, (SELECT count(*) FROM orders) AS n, 6 AS k UNION ALL SELECT 'part', (SELECT count(*) FROM part), 6")
def _(c, d):
    return [(t, *K.wrap(f"{d}/{t}.parquet", c).dim()) for t in ("orders", "part")], "t string, n long, k int"


@trip("description", "SELECT 'n_nationkey,n_name,n_regionkey' AS names, 'int,string,int' AS types, true AS equal, false AS unequal, true AS told")
def _(c, d):
    x, y = (K.wrap(f"{d}/nation.parquet", c)[["n_nationkey", "n_name", "n_regionkey"]] for _ in range(2))
    return [(",".join(x.names), ",".join(x.col_types()), x.eql(y), x.eql(y[y["n_nationkey"] > 3]), "3 column(s)" in repr(x) and "n_name" in x.content())], "names string, types string, equal boolean, unequal boolean, told boolean"


@trip("look", "SELECT 7 AS n, 7 AS known, (SELECT count(*) FROM nation) AS every, 'ALGERIA' IN (SELECT n_name FROM nation) AS value")
def _(c, d):
    x = K.wrap(f"{d}/nation.parquet", c, key="n_nationkey")
    seven = K.lookat(x, 7)
    names = set(K.lookat(x["n_name"], "all"))
    return [(len(seven), sum(n in names for n in seven.n_name), len(K.as_data_frame(x)), "ALGERIA" in names)], "n int, known int, every long, value boolean"


@trip("clean_up", "SELECT true AS some, true AS none_left, true AS files_gone")
def _(c, d):
    s = K.connection(c)
    x = K.save(K.wrap(f"{d}/region.parquet", c), is_temp=True)
    kept = x.base.inputFiles()
    dropped = K.clean_temp(c)
    p = s._jvm.org.apache.hadoop.fs.Path(kept[0])
    return [(dropped >= 1, not any(t.name.startswith(K.TEMP) for t in s.catalog.listTables()), not p.getFileSystem(s._jsc.hadoopConfiguration()).exists(p))], "some boolean, none_left boolean, files_gone boolean"


@trip("sort_random", "SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, true AS shuffled FROM orders")
def _(c, d):
    x = K.wrap(f"{d}/orders.parquet", c)["o_orderkey"]
    got = indexed(sort(x, False, None, seed=3), random=False)  # stored, with the place of each row
    n, keys = got.df.agg(F.count("*"), F.sum("o_orderkey")).first()
    return [(n, keys, not in_order(sort(got, False, "row_num")))], "n long, keys long, shuffled boolean"


@trip("limit_rows", "SELECT 9 AS n, 9 AS known, (SELECT count(*) FROM part) AS every")
def _(c, d):
    x = K.wrap(f"{d}/part.parquet", c)
    few, every = K.save(x["p_partkey"], is_temp=True, nrow=9), K.save(x["p_partkey"], is_temp=True, nrow=0)
    return [(few.dim()[0], few.df.join(x.df, "p_partkey").count(), every.dim()[0])], "n int, known int, every long"


@trip("sample_rows", "SELECT 100 AS n, 100 AS differ, 100 AS known, true AS refused")
def _(c, d):
    x = K.wrap(f"{d}/part.parquet", c)
    got = sample(x, 100, seed=5)
    try:
        refused = sample(x[["p_partkey"]], 10**7) is None
    except ValueError:
        refused = True
    return [(got.df.count(), got.df.select("p_partkey").distinct().count(), got.df.join(x.df, x.df.columns, "left_semi").count(), refused)], "n int, differ int, known int, refused boolean"


@trip("sample_replaced", "SELECT 3 * count(*) AS n, true AS repeats, true AS known FROM supplier")
def _(c, d):
    x = K.wrap(f"{d}/supplier.parquet", c)
    n = x.dim()[0]
    got = sample(x, 3 * n, replace=True, seed=5).df
    return [(got.count(), got.select("s_suppkey").distinct().count() < n, got.join(x.df, "s_suppkey", "left_anti").isEmpty())], "n long, repeats boolean, known boolean"


@trip("row_numbers", "SELECT count(*) AS n, count(*) AS differ, 1 AS least, count(*) AS most, true AS shuffled FROM orders")
def _(c, d):
    r = indexed(K.wrap(f"{d}/orders.parquet", c)[["o_orderkey"]], seed=2).df
    a = r.agg(F.count("*").alias("n"), F.count_distinct("row_num").alias("differ"), F.min("row_num").cast("int").alias("least"), F.max("row_num").alias("most"), (F.abs(F.corr("row_num", "o_orderkey")) < 0.2).alias("shuffled"))
    return a


@trip("row_numbers_in_order", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_num FROM orders")
def _(c, d):
    x = K.wrap(f"{d}/orders.parquet", c)[["o_orderkey"]]
    return indexed(sort(x, False, "o_orderkey"), random=False)
