"""Sharding by balanced label propagation under the law `rows`: shard counts differ by one at most.

Linked documents are those of equal text. Members of a group that lie in the same shard are alike to the
propagation, so its state is a row (group, shard, members) and not a row for each document. A round lets each
group move its members to the shard with room where most of their neighbours are, if that has more of them than their own;
what may move into a shard is limited to the capacity that it has left, and of larger demands the same share of each is
let in. Afterwards documents without links take the shard they began in, members of groups are
numbered and fill their group's counts exactly, and rows beyond a shard's quota, those without links first, go to shards with room. Slots come from
distributed numbering, so neither a shard nor a group is gathered in a task.

Null texts count as empty with 0 bytes, and equal the empty text. Rows repeated under one doc_id, and null
doc_ids, are rows of their own. Extra columns are ignored; a table without rows gives one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm import common as C

ROUNDS = 12


def _unit(*cols) -> F.col:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / float(1 << 30)


def assign(docs: DataFrame, shards: int = 8, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row."""
    spark, began = docs.sparkSession, C.mark()
    text = F.coalesce("text", F.lit(""))
    base = C.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("g")).withColumn("row", F.monotonically_increasing_id()), "documents")
    total = base.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    start = F.pmod(F.xxhash64("row", F.lit("start")), F.lit(shards)).cast("int")
    sizes = base.groupBy("g").agg(F.count("*").alias("members")).filter("members > 1")
    cells = C.table(base.withColumn("shard", start).groupBy("g", "shard").agg(F.count("*").alias("n")).join(sizes, "g"), "cells")
    for k in range(rounds):
        there = {r.shard: r.n for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # one row a shard
        free = [max(0, quota[s] - there.get(s, 0)) for s in range(shards)]
        full = [s for s in range(shards) if not free[s]]
        near = F.col("n") + _unit("g", "shard") * 0.5
        room = F.when(F.col("shard").isin(full), F.lit(-1e18)).otherwise(F.lit(0.0)) if full else F.lit(0.0)
        want = cells.withColumn("_w", near + room).groupBy("g").agg(F.max_by("shard", "_w").alias("target"), F.max_by(near, "_w").alias("_there"))
        moving = cells.join(want, "g").withColumn("moves", near < F.col("_there"))  # only to more neighbours than here
        moving = C.table(moving, "moving")
        demand = {r.target: r.n for r in moving.filter("moves").groupBy("target").agg(F.sum("n").alias("n")).collect()}
        if not demand:
            break
        share = F.lit(0.0)
        for s, n in demand.items():
            share = F.when(F.col("target") == s, F.lit(min(1.0, free[s] / n))).otherwise(share)
        gone = F.when(F.col("moves"), F.least(F.floor(F.col("n") * share + _unit("g", "shard", F.lit(k))), F.col("n"))).otherwise(F.lit(0)).cast("long")
        moved = moving.withColumn("_gone", gone)
        parts = moved.select("g", "shard", "members", (F.col("n") - F.col("_gone")).alias("n")).unionByName(moved.filter("_gone > 0").select("g", F.col("target").alias("shard"), "members", F.col("_gone").alias("n")))
        cells = C.table(parts.filter("n > 0").groupBy("g", "shard").agg(F.first("members").alias("members"), F.sum("n").alias("n")), "cells")
    # members of a group are numbered and fill its shards' counts in order
    plan = C.table(cells.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("cell")), "plan")  # at most a cell for each shard
    both = C.table(base.join(plan.hint("merge"), "g", "left").select("doc_id", "size", "text_crc32", "row", "g", "cell"), "linked")
    linked = C.numbered(both.filter("cell IS NOT NULL"), ["g"], ["doc_id", "row"], "_m")
    pick = F.aggregate("cell", F.struct(F.lit(0).cast("long").alias("upto"), F.lit(-1).alias("shard")), lambda a, x: F.struct((a["upto"] + x["n"]).alias("upto"), F.when((a["shard"] < 0) & (F.col("_m") < a["upto"] + x["n"]), x["shard"]).otherwise(a["shard"]).alias("shard")))["shard"]
    own = ["doc_id", "size", "text_crc32", "row"]
    placed = linked.select(*own, F.lit(0).alias("alone"), pick.cast("int").alias("_to")).unionByName(both.filter("cell IS NULL").select(*own, F.lit(1).alias("alone"), start.alias("_to")))
    num = C.table(C.numbered(placed, ["_to"], ["alone", "doc_id", "row"], "_slot"), "placed")
    have = {r._to: r.n for r in num.groupBy("_to").agg(F.count("*").alias("n")).collect()}
    limit = F.element_at(F.array(*[F.lit(q) for q in quota]), F.col("_to") + 1)
    stay = num.filter(F.col("_slot") < limit).select("doc_id", "size", "text_crc32", F.col("_to").alias("shard"), F.col("_slot").alias("slot"))
    over = C.numbered(num.filter(F.col("_slot") >= limit).drop("_slot"), [], ["_to", "doc_id", "row"], "_k")
    shard, slot, upto = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        kept = min(have.get(s, 0), quota[s])
        room = quota[s] - kept
        inside = (F.col("_k") >= upto) & (F.col("_k") < upto + room)
        shard, slot = F.when(inside, F.lit(s)).otherwise(shard), F.when(inside, F.col("_k") - upto + kept).otherwise(slot)
        upto += room
    out = C.table(stay.unionByName(over.select("doc_id", "size", "text_crc32", shard.alias("shard"), slot.cast("long").alias("slot"))), "shards")
    C.sweep(spark, began, (out,))
    return out


def op2_shards(spark, sf_dir: str) -> DataFrame:
    out = assign(C.load(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
