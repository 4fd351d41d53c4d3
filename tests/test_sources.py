"""Sources, the catalog and casts on cases that the queries don't have."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from tarn.frame import Frame
from tarn.functions import scalar as S
from tarn.models import learners
from tarn.operators.linalg import pca
from tarn.operators.order import in_order, sample, sort
from tarn.plans.queries import QUERIES
from tarn.sources import catalog as K


@pytest.fixture
def conn(spark):
    c = K.connect(spark)
    yield c
    K.disconnect(c)


def test_csv_with_skip_quotes_and_types(conn, tmp_path):
    (tmp_path / "a.csv").write_text('made by\n\nk;name;v\n1;"a;b";2.5\n2;k;\n\n3;name;-1\nk;name;v\n')
    x = K.upload(str(tmp_path / "a.csv"), conn_id=conn, is_temp=True, sep=";", skip=2, types="k string, name string, v double")
    assert [tuple(r) for r in x.df.collect()] == [("1", "a;b", 2.5), ("2", "k", None), ("3", "name", -1.0), ("k", "name", None)]
    (tmp_path / "b.csv").write_text("1,2.5\n2,x\n")
    x = K.upload(str(tmp_path / "b.csv"), conn_id=conn, is_temp=True, header=False)
    assert x.df.dtypes == [("_c0", "int"), ("_c1", "string")] and x.df.count() == 2
    assert K.upload(str(tmp_path / "b.csv"), conn_id=conn, is_temp=True, header=False, skip=1).df.count() == 1
    assert K.upload(str(tmp_path / "b.csv"), conn_id=conn, is_temp=True, header=False, skip=9, types="a int, b string").df.count() == 0


def test_search_path_of_several_databases(spark, conn):
    for d in ("path_one", "path_two"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {d}")
    try:
        assert K.search_path(conn, "path_one, path_two") == ["path_one", "path_two"]
        K.save(Frame(spark.range(3).toDF("a")), "only_two")  # made in the first
        assert spark.catalog.tableExists("path_one.only_two")
        K.search_path(conn, ["path_two", "path_one"])
        x = K.wrap("only_two", conn)
        assert x.df.count() == 3 and K.resolve("only_two", conn) == "path_one.only_two" and K.conn_id(x) is not None
        with pytest.raises(ValueError, match="no database"):
            K.search_path(conn, ["nowhere"])
        assert K.delete("path_one.only_two", conn) and not spark.catalog.tableExists("path_one.only_two")
    finally:
        spark.catalog.setCurrentDatabase("default")
        for d in ("path_one", "path_two"):
            spark.sql(f"DROP DATABASE {d} CASCADE")


def test_deleting_what_is_stored(spark):
    f = Frame(spark.createDataFrame([(k, float(k % 5), float(k % 3)) for k in range(60)], "id long, a double, b double"), key="id")
    m = learners.kmeans(f, 2, "id")
    assert m.assigned.df.count() == 60 and K.delete(m) and not K.delete(np.float64(1.0))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|FAILED_READ_FILE|does not exist"):
        m.assigned.df.collect()
    s = sample(f, 10)
    assert s.df.count() == 10 and K.delete(s)
    assert not K.delete(f)


def test_intervals_of_text(spark):
    cases = {"3 days 04:05:06": dt.timedelta(days=3, hours=4, minutes=5, seconds=6), "1 week -2 hours": dt.timedelta(days=7, hours=-2), "-01:30": dt.timedelta(hours=-1, minutes=-30), "1.5 h 2 secs": dt.timedelta(hours=1.5, seconds=2), "10 mins": dt.timedelta(minutes=10), "1 year": None, "soon": None, "": None, None: None}
    f = Frame(spark.createDataFrame([(k, t) for k, t in enumerate(cases)], "k int, t string"))
    got = [r.i for r in f[["k"]].cbind(S.to_interval(f["t"]).alias("i")).df.orderBy("k").collect()]
    assert got == list(cases.values())
    months = S.to_interval(f.assign(t="1 year 2 mons")["t"], "MONTH")
    assert {str(r[0]) for r in months.source.select(months.cols[0].expr.cast("string")).collect()} == {"INTERVAL '1-2' YEAR TO MONTH"}


def test_bounds_are_errors(spark, monkeypatch):
    f = Frame(spark.createDataFrame([(k, str(k), float(k)) for k in range(30)], "id long, g string, y double"))
    monkeypatch.setattr(S, "MAX_LEVELS", 20)
    with pytest.raises(ValueError, match="levels"):
        S.levels(f["g"])
    monkeypatch.setattr(learners, "MAX_GROUPS", 20)
    with pytest.raises(ValueError, match="groups"):
        learners.rpart("y ~ id | g", f, "id")


def test_pca_is_numpys(spark):
    x = np.random.default_rng(3).normal(size=(200, 5)) @ np.random.default_rng(4).normal(size=(5, 5))
    f = Frame(spark.createDataFrame(pd.DataFrame(x, columns=list("abcde"))))
    got = pca(f)
    assert np.allclose(got["sdev"] ** 2, np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1])
    assert np.allclose(np.abs(np.linalg.det(got["rotation"])), 1)
    assert np.allclose(pca(f, scaled=False)["sdev"] ** 2, np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1])


def test_random_order_stays_on_the_executors(spark, monkeypatch):
    import tarn.plans.source_queries  # noqa: F401  registers the query

    def refuse(*a):
        raise AssertionError("the rows of a table came to the driver")

    monkeypatch.setattr(K, "lookat", refuse)
    assert QUERIES["sort_random"](spark, "/root/testdata/sf0.001").collect()[0].shuffled
    up = Frame(spark.range(1000).selectExpr("IF(id % 7 = 0, NULL, id) AS v", "id % 10 AS k", "CAST(id AS STRING) AS t", "id"))
    assert in_order(sort(up, False, "id")[["v"]]) and in_order(sort(up, False, "t")[["t"]]) and in_order(up[up["id"] < 0][["v"]])
    assert in_order(sort(up, False, "k")[["k"]]) and not in_order(sort(up, True, "id")[["v"]]) and not in_order(sort(up, False, "id")[["k"]])
    assert not in_order(Frame(spark.createDataFrame([(5,), (6,), (1,), (2,)], "v int").coalesce(1).unionByName(spark.createDataFrame([(7,)], "v int")))[["v"]])
