"""Exact dedup by distributed MSD radix partitioning: documents are split by their leading bytes, groups again
by the bytes that follow, until a group has one document or its documents have ended. Equality is settled by the
bytes alone; no digest takes part in it.

A digit has WIDTHS[0] bytes in the first round and more in later ones, so a text of n bytes takes about
log(n) rounds. A round counts each group (partial sums before the shuffle, so a group that holds a third of
all rows arrives as one row for each task), stores the groups of more than one document with a number of their own, and
joins them back. As the small side is a stored table, Spark splits the join wherever a group is large. Rows then carry
the bytes that are left and the number of their group. A round's state is written to the shared folder.

Texts count as equal when they are the same after each run of [\\x20\\x09-\\x0D] became one space; null counts
as empty. The smallest doc_id of a group stays; a null doc_id is smaller than none: it stays only in a group
without any other. In `groups`, rows repeated under one doc_id and text count each in group_size and share one decision.
`deduplicate` works by row: of rows repeated under the doc_id that stays (or of null doc_ids alone) one stays, and rows of
one doc_id and different texts don't touch each other. Extra columns, also of clashing names, are ignored by `groups` and
passed through by `deduplicate`; a table without rows gives one without rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm import common as C

WIDTHS = (96, 1024, 16384, 262144, 4194304, 67108864)  #: bytes of a digit, by round; the last is used from then on


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _partition(docs: DataFrame, *carried: F.col) -> DataFrame:
    """carried (the last is to order rows), group_size and least (the smallest of the last carried column) of every row."""
    names = [f"c{i}" for i in range(len(carried))]
    state = docs.select(*[c.alias(n) for c, n in zip(carried, names, strict=True)], normalised(F.col("text")).cast("binary").alias("rest"), F.lit(0).cast("long").alias("g"))
    done, k = [], 0
    while True:
        width = WIDTHS[min(k, len(WIDTHS) - 1)]
        state = state.withColumn("digit", F.substring("rest", 1, width))
        count = state.groupBy("g", "digit").agg(F.count("*").alias("n"), F.min(names[-1]).alias("least")).filter("n > 1")
        count = C.table(count.withColumn("to", F.monotonically_increasing_id()), "groups").toDF("_g", "_digit", "n", "least", "to")
        more = F.col("n").isNotNull() & (F.length("digit") >= width)  # neither single nor ended: the rest goes on
        both = state.join(count.hint("merge"), (F.col("g") == F.col("_g")) & (F.col("digit") == F.col("_digit")), "left")
        both = C.table(both.select(*names, "n", "least", F.when(more, F.expr(f"substring(rest, {width + 1})")).alias("rest"), F.col("to").alias("g")), "radix")
        done.append(both.filter("rest IS NULL").select(*names, F.coalesce("n", F.lit(1).cast("long")).alias("group_size"), F.when(F.col("n").isNull(), F.col(names[-1])).otherwise(F.col("least")).alias("least")))
        state, k = both.filter("rest IS NOT NULL").select(*names, "rest", "g"), k + 1
        if state.isEmpty():
            break
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    doc = F.col("doc_id").cast("long")
    out = _partition(docs, F.sha2(normalised(F.col("text")), 256), doc)
    return out.select(F.col("c1").alias("doc_id"), F.col("least").alias("keep_id"), "group_size", F.col("c1").eqNullSafe(F.col("least")).alias("kept"), F.col("c0").alias("text_sha256"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts: that of the smallest doc_id (null: the greatest)."""
    row = C.fresh(docs, "_row")
    rows = C.with_rows(docs, row)
    doc = F.col("doc_id").cast("long")
    out = _partition(rows, F.struct(doc.isNull().alias("none"), doc.alias("id"), F.col(row).alias("row")))
    dropped = out.filter(F.col("c0.row") != F.col("least.row")).select(F.col("c0.row").alias(row))
    return rows.join(C.table(dropped, "dropped"), row, "left_anti").select(*docs.columns)


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return groups(C.load(spark, sf_dir, "documents"))


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g ON n.t = g.t
"""
