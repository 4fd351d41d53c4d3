"""Sorting, limits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.frame import Frame
from tarn.sources.catalog import keep


def sort(x: Frame, decreasing=False, indices=None, seed: int | None = None) -> Frame:
    """By one or more columns or frames, each with its direction; nulls last when ascending and first when descending.
    indices None or "random": random order."""
    if indices is None or (isinstance(indices, str) and indices == "random"):
        return x._with(order=(F.rand(seed),))
    cols = []
    for k in indices if isinstance(indices, (list, tuple)) else [indices]:
        k = x.col(k) if isinstance(k, str) else k
        x.need_lineage(k)
        cols += k.cols
    down = list(decreasing) if isinstance(decreasing, (list, tuple)) else [decreasing] * len(cols)
    seen, order = set(), []
    for c, d in zip(cols, down, strict=True):
        if c.name not in seen:
            order.append(c.expr.desc_nulls_first() if d else c.expr.asc_nulls_last())
        seen.add(c.name)
    return x._with(order=tuple(order))


def sample(x: Frame, size: int, replace: bool = False, seed: int = 0) -> Frame:
    """Exactly `size` rows. Without replacement: those of the smallest random numbers. With replacement: every draw names a
    row number; draws are counted by number and joined to numbered rows (numbers come from partition counts, not from one task)."""
    df = x.df
    if not replace:
        out = keep(df.withColumn("_r", F.rand(seed)).orderBy("_r").limit(size).drop("_r"))
        if out.count() < size:
            raise ValueError("the sample is larger than the frame")
        return Frame(out, key=x.key)
    numbered, total = number_rows(df)
    if not total:
        raise ValueError("the frame has no rows")
    spark = df.sparkSession
    draws = spark.range(size).select(F.floor(F.rand(seed) * total).cast("long").alias("_row")).groupBy("_row").agg(F.count("*").alias("_times"))
    out = numbered.join(draws, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).drop("_row", "_times", "_copy")
    return Frame(keep(out.select(*df.columns)), key=x.key)


def number_rows(df):
    """(df stored with the gapless number `_row` from 0, rows): numbers are those within a partition and the counts of those before."""
    rows = keep(df.withColumn("_at", F.monotonically_increasing_id()))
    parts = [(r.p, r.n) for r in rows.groupBy(F.shiftright("_at", 33).alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()]  # one row a partition
    first, starts = 0, []
    for p, n in parts:
        starts.append((p, first))
        first += n
    at = rows.join(F.broadcast(df.sparkSession.createDataFrame(starts or [(0, 0)], "p long, f long")), F.shiftright("_at", 33) == F.col("p"))
    return at.withColumn("_row", F.col("f") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("p", "f", "_at"), first


def indexed(x: Frame, random: bool = True, seed: int = 0, name: str = "row_num") -> Frame:
    """The rows with a gapless number from 1, in random order or that of the frame. The order comes from a distributed sort."""
    df = x.df.orderBy(F.rand(seed)) if random else x.df
    out, _ = number_rows(df)
    return Frame(out.withColumn(name, F.col("_row") + 1).drop("_row"), key=x.key)


def in_order(x: Frame) -> bool:
    """Whether the values of the first column, nulls aside, never fall over the rows as the frame has them. Tasks compare the rows
    they hold; the driver gets a row from each."""
    df = x.df.select(F.col(f"`{x.names[0]}`").alias("v"))

    def part(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        rising, first, last = True, None, None
        for b in batches:
            v = b.column(0).drop_null()
            if len(v):
                over = pa.concat_arrays([last, v]) if last is not None else v
                rising = rising and pc.all(pc.greater_equal(over[1:], over[:-1]), min_count=0).as_py()
                first, last = v[:1] if first is None else first, v[-1:]
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), first, last, pa.array([rising])], ["part", "first", "last", "rising"])

    kind = df.schema[0].dataType.simpleString()
    parts = sorted(df.mapInArrow(part, f"part int, first {kind}, last {kind}, rising boolean").collect(), key=lambda r: r.part)
    return all(r.rising for r in parts) and all(a.last <= b.first for a, b in zip(parts, parts[1:], strict=False))
