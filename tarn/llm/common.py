"""Shared pieces of the training-data operators: shared-folder tables, vectorised word hashing,
connected components and distributed numbering."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
_M = np.uint64(0x9E3779B97F4A7C15)
_STATE: dict = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it. Where none is named, a local session
    takes a folder of its own, and one on a cluster is refused."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = "/tmp/checkpoints/" + uuid.uuid4().hex
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder; sweep() knows it."""
    path = f"{shared_dir(spark)}/tarn-{name}-{uuid.uuid4().hex}"
    _STATE.setdefault("paths", []).append(path)
    return path


def table(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and lost executors cost no recompute."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """A point in the list of written paths, for sweep()."""
    return len(_STATE.setdefault("paths", []))


def sweep(spark: SparkSession, since: int, keep: tuple[DataFrame, ...] = ()) -> None:
    """Deletes what was written since mark() gave `since`, but for the files that the frames in keep read."""
    own = _STATE.setdefault("paths", [])
    read = [f for d in keep for f in d.inputFiles()]
    for path in own[since:]:
        name = path.rsplit("/", 1)[-1]
        if any(f"/{name}/" in f for f in read):
            continue
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        own.remove(path)


def fresh(df: DataFrame, name: str) -> str:
    """The name, with underscores until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_rows(df: DataFrame, name: str) -> DataFrame:
    """df stored with a number of its own for each row, which stays the same however often it is read."""
    return table(df.withColumn(name, F.monotonically_increasing_id()), "rows")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- vectorised words


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = 1_500_000):
    """Slices of a batch whose texts hold about `limit` bytes; a longer single text is a slice of its own."""
    col = batch.column(batch.schema.get_field_index(column))
    size = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def raw_text(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the offsets of each text (null counts as empty)."""
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64, count=len(col) + 1 + col.offset)[col.offset :]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None and off[-1] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_STATE.get("p", ())) < n:
        size = max(n, 1 << 20)
        base = 0xD1342543DE82EF95
        inverse = pow(base, -1, 1 << 64)
        with np.errstate(over="ignore"):
            for key, b in (("p", base), ("q", inverse)):
                a = np.full(size, b, dtype=np.uint64)
                a[0] = 1
                _STATE[key] = np.cumprod(a, dtype=np.uint64)
    return _STATE["p"], _STATE["q"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def span_hash(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each span of symbols: a polynomial over random values, from one running sum."""
    p, q = _powers(len(symbols) + 1)
    with np.errstate(over="ignore"):
        v = values[symbols] if values is not None else mix(symbols.astype(np.uint64) + _M)
        c = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(v * p[: len(symbols)], out=c[1:], dtype=np.uint64)
        return mix((c[ends] - c[starts]) * q[starts] + (ends - starts).astype(np.uint64) * _M)


def byte_values(fold: bool = True) -> np.ndarray:
    key = ("values", fold)
    if key not in _STATE:
        v = mix(np.arange(256, dtype=np.uint64) + _M)
        if fold:
            v[65:91] = v[97:123]
        _STATE[key] = v
    return _STATE[key]


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def words(raw: np.ndarray, off: np.ndarray, strip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between the six ASCII spaces, letters A-Z folded: hash of each, and first and end word of each text.

    strip: a mask of 256 byte values that separate words besides the spaces."""
    if not len(raw):
        return np.zeros(0, np.uint64), *(np.zeros(len(off) - 1, np.int64) for _ in range(2))
    solid = ~(_IS_SPACE if strip is None else strip)[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[off[off <= len(raw)]] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | edge[1:-1]
    s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return span_hash(raw, s, e, byte_values()), np.searchsorted(s, off[:-1]), np.searchsorted(s, off[1:])


def ngrams(w: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words; fewer words than n make one run of all of them, none make none."""
    if not len(w):
        return w
    n = min(n, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - n + 1, np.uint64(n), dtype=np.uint64)
        for k in range(n):
            h = mix(h * np.uint64(0xC2B2AE3D27D4EB4F) + w[k : len(w) - n + 1 + k])
    return h


# ---------------------------------------------------------------- numbering and components


def numbered(df: DataFrame, by: list[str], order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """Adds `name`: the gapless number from 0 of each row within `by`, in `order`. No group is gathered in a task.

    Rows are range-partitioned by `by` and `order`; each task counts its rows by group, and the counts of
    the tasks before (a row for each task and group, bounded by partitions and not by rows) are added."""
    parts = parts or n_parts(df)
    keys = [F.col(c).asc_nulls_first() for c in [*by, *order]]
    at = table(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    at = at.withColumn("_part", F.shiftright("_at", 33))
    first = at.groupBy("_part", *by).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    w = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1) if by else Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = first.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    first = first.select(F.col("_part").alias("_fp"), "_first", "_before", *[F.col(c).alias(f"_f_{c}") for c in by])
    on = F.col("_part") == F.col("_fp")
    for c in by:
        on &= F.col(c).eqNullSafe(F.col(f"_f_{c}"))
    return at.join(first, on, "left").select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias(name))


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) of every id in the undirected edges (a, b): the smallest id reachable.

    Each round every id hooks to its smallest neighbour if that is smaller, labels jump to the labels of their labels
    until each names a root, and the edges between roots are what the next round works on, until none is left. An id that
    stays a root over two rounds has taken in another one, so at most half are left after two: rounds grow with the
    logarithm of the number of ids, jumps in a round with that of the longest chain of hooks, whatever the shape."""
    spark, began = edges.sparkSession, mark()
    e = table(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "edges")
    lab = e.select(F.col("a").alias("id"), F.col("b").alias("comp"))  # without rows where e has none
    first = True
    while not e.isEmpty():
        up = table(e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")), "hooks")
        while True:
            jump = table(up.join(up.select(F.col("a").alias("up"), F.col("up").alias("top")), "up").select("a", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "hooks")
            up = jump.select("a", "up")
            if jump.filter("moved").isEmpty():
                break
        lab = up.toDF("id", "comp") if first else table(lab.join(up.toDF("comp", "_up"), "comp", "left").select("id", F.coalesce("_up", "comp").alias("comp")), "labels")
        first = False
        e = table(e.join(up.toDF("a", "_a"), "a").join(up.toDF("b", "_b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).filter("a <> b").distinct(), "edges")
        sweep(spark, began, (lab, e))
    return lab


def ship(spark: SparkSession) -> None:
    """Makes this package importable on executors that don't share the driver's path."""
    import os
    import zipfile

    sc = spark.sparkContext
    if _STATE.get("shipped") == sc.applicationId:
        return
    _STATE["shipped"] = sc.applicationId
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if top in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    import tempfile

    path = os.path.join(tempfile.mkdtemp(), "tarn_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(os.path.join(top, "tarn")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)


def blob(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))
