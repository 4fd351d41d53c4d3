"""Table summaries: for each column (and value of each grouping column) counts, moments, quantiles, frequent values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.frame import Frame
from tarn.sources.catalog import keep


def summary(x: Frame, target_cols: list[str] | None = None, grouping_cols: list[str] | None = None, distinct: bool = True, quartiles: bool = True, ntile: list[float] | None = None, n_mfv: int = 10, estimate: bool = False) -> Frame:
    """Text minima and maxima are lengths. Quantiles interpolate linearly. Frequent values are exact unless estimate, in ties the smaller first.

    Moments of all columns are one scan. Distinct values, frequent ones and exact quantiles come from one stored table of the values'
    counts, quantiles by their sorted running sums, so no column's values are held in memory; with estimate all is one scan of sketches."""
    d = x.df
    targets = target_cols or [c for c in d.columns if c not in (grouping_cols or [])]
    kinds = {f.name: f.dataType for f in d.schema.fields}
    return Frame(reduce(lambda a, b: a.unionByName(b), [_grouped(d, g, targets, kinds, distinct, quartiles, ntile, n_mfv, estimate) for g in grouping_cols or [None]]))


def _number(c: Column, t: T.DataType) -> Column:
    """Text by its length, booleans as 0 and 1; other types have no number."""
    if isinstance(t, T.StringType):
        return F.length(c).cast("double")
    if isinstance(t, T.BooleanType):
        return c.cast("int").cast("double")
    return c.cast("double") if isinstance(t, T.NumericType) else F.lit(None).cast("double")


def _grouped(d: DataFrame, group: str | None, targets: list[str], kinds: dict, distinct: bool, quartiles: bool, ntile: list[float] | None, n_mfv: int, estimate: bool) -> DataFrame:
    key = (F.col(f"`{group}`").cast("string") if group else F.lit(None).cast("string")).alias("group_by_value")
    base = d.select(key, *[F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(targets)], *[_number(F.col(f"`{n}`"), kinds[n]).alias(f"v{k}") for k, n in enumerate(targets)])
    points = ([0.25, 0.5, 0.75] if quartiles else []) + list(ntile or [])
    null, none = F.lit(None).cast("double"), F.lit(None).cast("long")
    cells, fields = [], []
    for k, name in enumerate(targets):
        c, v, t = F.col(f"c{k}"), F.col(f"v{k}"), kinds[name]
        text, number = isinstance(t, T.StringType), isinstance(t, (T.NumericType, T.BooleanType))
        own = {"row_count": F.count("*"), "missing_values": F.count_if(c.isNull()), "blank_values": F.count_if(F.trim(c) == "") if text else none, "mean": F.avg(v) if number else null, "variance": F.var_samp(v) if number else null, "min": F.min(v), "max": F.max(v)}
        if estimate:
            own["distinct_values"] = F.approx_count_distinct(c) if distinct else none
            own["points"] = F.percentile_approx(v, points, 10000) if number and points else F.lit(None).cast("array<double>")
            own["top"] = F.call_function("approx_top_k", c.cast("string"), F.lit(n_mfv))
        cells += [e.alias(f"{f}_{k}") for f, e in own.items()]
        fields.append(F.struct(F.lit(k).alias("k"), F.lit(name).alias("target_column"), F.lit(t.simpleString()).alias("data_type"), *[(F.col(f"{f}_{k}") if f not in ("points", "top") else F.transform(f"{f}_{k}", lambda e: e.cast("double")) if f == "points" else F.transform(f"{f}_{k}", lambda e: F.struct(e["item"].alias("s"), e["count"].cast("long").alias("n")))).alias(f) for f in own]))
    out = base.groupBy("group_by_value").agg(*cells).select("group_by_value", F.explode(F.array(*fields)).alias("r")).select("group_by_value", "r.*")
    if not estimate:
        values = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"c{k}").cast("string").alias("s"), (F.col(f"v{k}") if isinstance(kinds[n], (T.NumericType, T.BooleanType)) else null).alias("v")) for k, n in enumerate(targets)])
        counts = keep(base.select("group_by_value", F.explode(values).alias("r")).select("group_by_value", "r.*").filter("s IS NOT NULL").groupBy("group_by_value", "k", "s").agg(F.first("v").alias("v"), F.count("*").alias("n")))
        by = ["group_by_value", "k"]
        many = counts.groupBy(*by).agg(F.count("*").alias("distinct_values"), F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("_n"))
        first = counts.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "s"))).filter(F.col("_r") <= n_mfv)
        top = first.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("_r", "s", "n"))), lambda e: F.struct(e["s"].alias("s"), e["n"].alias("n"))).alias("top"))
        parts = [many.select(*by, "distinct_values" if distinct else none.alias("distinct_values")), top]
        if points:
            upto = F.sum("n").over(Window.partitionBy(*by).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
            ranked = _joined(counts.filter("v IS NOT NULL").withColumn("_upto", upto), many.select(*by, "_n"))
            at = lambda r: F.max(F.when((F.col("_upto") - F.col("n") <= r) & (r < F.col("_upto")), F.col("v")))
            low = [F.floor((F.col("_n") - 1) * p) for p in points]
            high = [F.ceil((F.col("_n") - 1) * p) for p in points]
            held = ranked.groupBy(*by, "_n").agg(*[at(r).alias(f"l{i}") for i, r in enumerate(low)], *[at(r).alias(f"h{i}") for i, r in enumerate(high)])
            parts.append(held.select(*by, F.array(*[F.col(f"l{i}") + (F.col(f"h{i}") - F.col(f"l{i}")) * ((F.col("_n") - 1) * p - low[i]) for i, p in enumerate(points)]).alias("points")))
        for p in parts:
            out = _joined(out, p, "left")
        if not points:
            out = out.withColumn("points", F.lit(None).cast("array<double>"))
        if distinct:
            out = out.withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0).cast("long")))
    q = [F.try_element_at("points", F.lit(i + 1)) if quartiles else null for i in range(3)]
    more = F.when(F.col("points").isNotNull(), F.slice("points", 1 + 3 * quartiles, len(ntile))) if ntile else F.lit(None).cast("array<double>")
    return out.select(
        F.lit(group).cast("string").alias("group_by"), "group_by_value", "target_column", (F.col("k") + 1).alias("column_number"), "data_type", "row_count", "distinct_values", "missing_values", "blank_values",
        (F.col("missing_values") / F.col("row_count")).alias("fraction_missing"), (F.col("blank_values") / F.col("row_count")).alias("fraction_blank"), "mean", "variance", "min", "max",
        q[0].alias("first_quartile"), q[1].alias("median"), q[2].alias("third_quartile"), more.alias("quantile_array"), F.col("top.s").alias("most_frequent_values"), F.col("top.n").alias("mfv_frequencies"),
    )


def _joined(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """By group value (null equals null) and column number."""
    other = b.withColumnsRenamed({"group_by_value": "_g", "k": "_k"})
    return a.join(other, F.col("group_by_value").eqNullSafe(F.col("_g")) & (F.col("k") == F.col("_k")), how).drop("_g", "_k")
