"""Sessions, catalog, sources and sinks."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from dataclasses import fields, is_dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.frame import Frame

_CONNECTIONS: dict[int, SparkSession] = {}
TEMP = "tarn_temp_"


_PATHS: dict[int, list[str]] = {}
_SHIPPED: set[str] = set()


def shared_path(spark: SparkSession) -> str:
    """A new path in the folder that spark.checkpoint.dir names. Where none is named, a local session takes a folder of its own, and
    one on a cluster is refused."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = "/tmp/checkpoints/" + uuid.uuid4().hex
        spark.sparkContext.setCheckpointDir(d)
    return f"{d.rstrip('/')}/{TEMP}{uuid.uuid4().hex}"


def keep(df: DataFrame, **options) -> DataFrame:
    """df written once to the shared folder, so that random rows don't change when read again and lost executors cost no recompute.
    options: of the writer."""
    path = shared_path(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_kept(df: DataFrame) -> int:
    """Deletes the folders written by keep() that df reads; their number."""
    spark = df.sparkSession
    found = {m[0] for f in df.inputFiles() if (m := re.match(rf".*/{TEMP}[0-9a-f]{{32}}(?=/)", f))}
    for path in found:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(found)


def ship(spark: SparkSession) -> None:
    """Makes this package importable on executors that don't share the driver's path."""
    sc = spark.sparkContext
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if sc.applicationId in _SHIPPED or top in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _SHIPPED.add(sc.applicationId)
    path = os.path.join(tempfile.mkdtemp(), "tarn_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(os.path.join(top, "tarn")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)


def connect(spark: SparkSession | None = None, default_schema: str | None = None, **conf) -> int:
    """A connection id for a session."""
    if spark is None:
        b = SparkSession.builder
        for k, v in conf.items():
            b = b.config(k.replace("__", "."), v)
        spark = b.getOrCreate()
    if default_schema:
        spark.catalog.setCurrentDatabase(default_schema)
    cid = max(_CONNECTIONS, default=0) + 1
    _CONNECTIONS[cid] = spark
    return cid


def disconnect(conn_id: int = 1, verbose: bool = False) -> bool:
    """Forgets the handle; the session belongs to its maker and goes on."""
    _PATHS.pop(conn_id, None)
    return _CONNECTIONS.pop(conn_id, None) is not None


def connection(conn_id: int = 1) -> SparkSession:
    if conn_id not in _CONNECTIONS:
        raise KeyError(f"no connection {conn_id}")
    return _CONNECTIONS[conn_id]


def connections() -> list[int]:
    return sorted(_CONNECTIONS)


def list_databases(conn_id: int = 1) -> list[str]:
    return [d.name for d in connection(conn_id).catalog.listDatabases()]


def connection_info(conn_id: int = 1) -> dict:
    s = connection(conn_id)
    return {"host": s.sparkContext.master, "dbname": s.catalog.currentDatabase(), "user": s.sparkContext.sparkUser(), "port": None, "dbms": f"Spark {s.version}", "package": "pyspark"}


def same_database(a: int, b: int) -> bool:
    return connection(a) is connection(b) or connection_info(a) == connection_info(b)


def objects(search: str = "", conn_id: int = 1) -> list[str]:
    s = connection(conn_id)
    found = [f"{t.namespace[0]}.{t.name}" if t.namespace else t.name for t in s.catalog.listTables()]
    return sorted(n for n in found if re.search(search, n))


def exists(name: str, conn_id: int = 1, is_temp: bool = False):
    found = connection(conn_id).catalog.tableExists(name)
    return (found, name) if is_temp else found


def search_path(conn_id: int = 1, set: str | list[str] | None = None) -> list[str]:  # noqa: A002
    """The databases in which names without one are looked up, in order; the first is where tables are made. set: a list, or
    names with commas between them."""
    s = connection(conn_id)
    if set:
        names = [n.strip() for n in set.split(",")] if isinstance(set, str) else list(set)
        missing = [n for n in names if not s.catalog.databaseExists(n)]
        if missing:
            raise ValueError(f"no database {', '.join(missing)}")
        s.catalog.setCurrentDatabase(names[0])
        _PATHS[conn_id] = names
    current = s.catalog.currentDatabase()
    own = _PATHS.get(conn_id, [current])
    return own if own[0] == current else [current]


def resolve(name: str, conn_id: int = 1) -> str:
    """The name with the first database of the search path that has it; as it is when it has one, or is a view."""
    s = connection(conn_id)
    if "." in name or s.catalog.tableExists(name):
        return name
    return next((f"{d}.{name}" for d in search_path(conn_id) if s.catalog.tableExists(f"{d}.{name}")), name)


def conn_id(x: Frame) -> int | None:
    """The connection that a frame's session belongs to."""
    return next((k for k, s in _CONNECTIONS.items() if s is x.base.sparkSession), None)


def wrap(x: str | DataFrame, conn_id: int = 1, key: str | None = None) -> Frame:
    """A frame over a table, view, Parquet path or DataFrame; no rows are read."""
    if isinstance(x, str):
        s = connection(conn_id)
        df = s.read.parquet(x) if "/" in x else s.table(resolve(x, conn_id))
        return Frame(df, key=key, name=x)
    return Frame(x, key=key)


def query(*text: str, nrows: int | str | None = 100, conn_id: int = 1, sep: str = " "):
    """Rows of a SQL text as a pandas frame, at most nrows (None, "all" or 0 and less: all)."""
    return _limited(connection(conn_id).sql(sep.join(text)), nrows).toPandas()


def _limited(df: DataFrame, n) -> DataFrame:
    return df if n is None or n == "all" or (not isinstance(n, str) and n <= 0) else df.limit(int(n))


def upload(x, name: str | None = None, conn_id: int = 1, key: str | None = None, append: bool = False, is_temp: bool = False, distributed_by: list[str] | None = None, header: bool = True, sep: str = ",", quote: str = '"', nrows: int = 50, types: str | None = None, skip: int = 0, eol: str | None = None) -> Frame:
    """A pandas frame or a CSV path as a table. CSV types are inferred from the first nrows rows unless given. skip: lines
    before the header of one file, in which no value goes over several lines; eol: what ends a line (one or two characters)."""
    s = connection(conn_id)
    if not isinstance(x, str):
        return save(Frame(s.createDataFrame(x), key=key), name, is_temp=is_temp, append=append, distributed_by=distributed_by)
    opts = {"sep": sep, "quote": quote} | ({"lineSep": eol} if eol else {})
    lines = s.read.options(**({"lineSep": eol} if eol else {})).text(x).withColumn("_at", F.monotonically_increasing_id())  # the first partition begins with the file
    head = [r.value for r in lines.filter(F.col("_at") >= skip).limit(nrows + header).collect()]
    sample = s.read.options(**{k: v for k, v in opts.items() if k != "lineSep"}, header=header, inferSchema=True).csv(s.sparkContext.parallelize(head, 1))
    schema = sample.schema if types is None else s.createDataFrame([], types).schema
    if skip:
        body = lines.filter((F.col("_at") >= skip + header) & (F.trim("value") != ""))
        df = body.select(F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), {k: v for k, v in opts.items() if k != "lineSep"}).alias("r")).select("r.*")
    else:
        df = s.read.options(**opts, header=header).schema(schema).csv(x)
    return save(Frame(df, key=key), name, is_temp=is_temp, append=append, distributed_by=distributed_by)


def save(x: Frame, name: str | None = None, is_view: bool = False, is_temp: bool = False, append: bool = False, pivot: bool = True, distributed_by: list[str] | None = None, buckets: int = 8, nrow: int | None = None, types: dict[str, str] | None = None, na_as_level: bool = False, factor_full: bool = False) -> Frame:
    """Materialises a query as a table, view or temporary view; factors become dummy columns when pivoting."""
    from tarn.functions.scalar import dummies

    if pivot and any(c.meta.factor for c in x.cols):
        x = dummies(x, full=factor_full, na_as_level=na_as_level)
    df = _limited(x.df, nrow)
    for c, t in (types or {}).items():
        df = df.withColumn(c, df[c].cast(t))
    s = df.sparkSession
    name = name or TEMP + uuid.uuid4().hex[:12]
    if is_view:
        df.createOrReplaceTempView(name)
    elif is_temp or name.startswith(TEMP):
        keep(df).createOrReplaceTempView(name)
    else:
        if not append and s.catalog.tableExists(name):
            raise ValueError(f"{name} exists")
        w = df.write.mode("append" if append else "errorifexists")
        if distributed_by:
            w = w.bucketBy(buckets, *distributed_by)
        w.saveAsTable(name)
    return Frame(s.table(name), key=x.key, name=name)


def lookat(x: Frame, nrows: int | str | None = 100, drop: bool = True, array: bool = False):
    """Rows of a frame: a pandas frame; one column becomes a Series (a value if it has one row) when dropping."""
    from tarn.operators.arrays import expand

    out = _limited((expand(x) if array else x).df, nrows).toPandas()
    if drop and len(out.columns) == 1:
        return out.iloc[:, 0] if len(out) != 1 else out.iloc[0, 0]
    return out


def as_data_frame(x: Frame):
    return lookat(x, None, drop=False)


def delete(x, conn_id: int | None = None) -> bool:
    """Drops a table or view by name or frame, with the files that keep() wrote for it, or the tables that a model keeps
    (its coefficients stay)."""
    if not isinstance(x, (str, Frame)):
        return sum(drop_kept(d) for d in _tables_of(x)) > 0
    s = x.base.sparkSession if isinstance(x, Frame) else connection(conn_id or 1)
    name = x.name if isinstance(x, Frame) else x
    if name is None:
        return drop_kept(x.base) > 0
    if not s.catalog.tableExists(name):
        return False
    if s.catalog.getTable(name).isTemporary:
        kept = s.table(name)
        found = s.catalog.dropTempView(name)
        drop_kept(kept)
        return found
    kind = "VIEW" if s.catalog.getTable(name).tableType == "VIEW" else "TABLE"
    s.sql(f"DROP {kind} IF EXISTS {name}")
    return True


def _tables_of(model) -> list[DataFrame]:
    """The frames among the fields of a model, or of the models of a group."""
    if isinstance(model, DataFrame):
        return [model]
    if isinstance(model, Frame):
        return [model.base]
    if isinstance(model, (list, tuple)):
        return [d for m in model for d in _tables_of(m)]
    if isinstance(model, dict):
        return _tables_of(list(model.values()))
    if is_dataclass(model):
        return [d for f in fields(model) if f.name != "design" for d in _tables_of(getattr(model, f.name))]
    return []


def clean_temp(conn_id: int = 1) -> int:
    """Drops this library's temporary views, with the files that keep() wrote for them."""
    s = connection(conn_id)
    return sum(delete(t.name, conn_id) for t in s.catalog.listTables() if t.name.startswith(TEMP))
