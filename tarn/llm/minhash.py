"""MinHash near-dedup with odd sketches.

A document's set holds its distinct runs of n words. One pass over the texts makes, for each document, the
size and a digest of the set, MinHash bands, and an odd sketch: the parity bitmap of its MinHash samples.
Documents with the same set become one class. Classes that share a band are candidates:

1. each bucket's smallest class is its pivot, and all members are compared with it; then again with the member
   that has most links. Pairs whose sketches differ in too many bits (XOR population count) are left out, the
   others are confirmed on the full sets, and links are merged into components;
2. larger buckets that still hold several components are dealt out in pairs of blocks of bounded size, where members of the bucket's
   largest component meet only those outside it; a task compares all sketches of its two blocks, confirms on the full sets, and returns a spanning forest only.

So no group is expanded into rows of pairs and none is gathered in one task. With 30 bands of 4 samples a pair at the limit
of 0.85 (0.80) shares no band with probability 3e-10 (1.4e-7); the sketch limit lies six deviations of the
estimate below the similarity asked for. Sets are compared by 64-bit hashes of the runs.

Null and empty texts have the empty set, which is linked with nothing. Every row is a document of its own: rows of one doc_id
and different texts are linked by their texts alone, and rows without doc_id take part (they name a component only where
it has no other: its component_id is then null). `kept` is whether a row bears its component's doc_id; `deduplicate` keeps
one row of each component, that of the smallest doc_id (null: the greatest; of ties the first stored). Other columns,
also of clashing names, are ignored by `clusters` and passed through by `deduplicate`; a table without rows gives one."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm import common as C

BANDS, ROWS, BITS = 30, 4, 512
SAMPLES = BANDS * ROWS
BLOCK = 1024  #: members of a bucket that a task compares with as many others
_SIGNATURE = "doc_id long, row long, n_shingles long, set_key binary, bands array<long>, sketch array<long>"


def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)


def shingle_sets(col: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of n words of each text."""
    w, a, b = C.words(*C.raw_text(col))
    return [np.unique(C.ngrams(w[i:j], n)) for i, j in zip(a.tolist(), b.tolist(), strict=True)]


def _samples(s: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    out = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(s), 2048):
            part = s[i : i + 2048, None] * mul + add
            np.minimum(out, part.min(axis=0), out=out)
    return out


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, row, size and digest of the set, band hashes, odd sketch, for every row of (doc_id, row, text)."""
    C.ship(docs.sparkSession)

    def run(batches):
        mul, add = _family()
        lanes = np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        band = np.arange(BANDS, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in C.text_chunks(batch, "text"):
                    sets = shingle_sets(part.column(2), n)
                    least = np.stack([_samples(s, mul, add) for s in sets])
                    h = np.broadcast_to(band, (len(sets), BANDS)).copy()
                    rows = least.reshape(len(sets), BANDS, ROWS)
                    for k in range(ROWS):
                        h = C.mix(h * np.uint64(0xC2B2AE3D27D4EB4F) + rows[:, :, k])
                    bit = C.mix(least + lanes) % np.uint64(BITS)
                    parity = np.zeros((len(sets), BITS), dtype=np.uint8)
                    np.add.at(parity, (np.arange(len(sets))[:, None], bit.astype(np.int64)), 1)
                    sketch = np.packbits(parity & 1, axis=1).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), _lists(h.view(np.int64)), _lists(sketch)],
                        ["doc_id", "row", "n_shingles", "set_key", "bands", "sketch"],
                    )

    return docs.select("doc_id", "row", "text").mapInArrow(run, _SIGNATURE)


def _lists(a: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, a.size + 1, a.shape[1]), pa.int32()), pa.array(np.ascontiguousarray(a).ravel(), pa.int64()))


def _sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """id and whole set of the documents whose rows ids (id, row) names."""

    def run(batches):
        for batch in batches:
            for part in C.text_chunks(batch, "text"):
                sets = shingle_sets(part.column(1), n)
                off = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate(sets).view(np.int64), pa.int64()))], ["id", "members"])

    return docs.select("row", "text").join(ids, "row").select("id", "text").mapInArrow(run, "id long, members array<long>")


def most_bits(least: float) -> int:
    """Bits that the sketches of a pair of similarity `least` or more may differ in: the expectation at six deviations below."""
    t = max(0.0, least - 6 * math.sqrt(least * (1 - least) / SAMPLES))
    return math.ceil(BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - t) / BITS)))


def _confirmed(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that the sketches allow and the full sets confirm."""
    s = reps.select("id", "sketch", "n_shingles")
    near = pairs.join(s.toDF("a", "sa", "na"), "a").join(s.toDF("b", "sb", "nb"), "b")
    bits = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    near = near.filter((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (bits <= most_bits(percent / 100))).select("a", "b")
    full = near.join(sets.toDF("a", "ma"), "a").join(sets.toDF("b", "mb"), "b")
    both = F.size(F.array_intersect("ma", "mb"))
    return full.withColumn("both", both).filter(100 * F.col("both") >= percent * (F.size("ma") + F.size("mb") - F.col("both"))).select("a", "b")


def _block_links(percent: int):
    limit = most_bits(percent / 100)

    def run(g: pd.DataFrame) -> pd.DataFrame:
        key, i, j = g["key"].iloc[0], g["i"].iloc[0], g["j"].iloc[0]
        bands = np.stack(g["bands"].to_numpy()).view(np.uint64)
        sketch = np.ascontiguousarray(np.stack(g["sketch"].to_numpy())).view(np.uint64)
        here = np.flatnonzero((bands == np.array(key, dtype=np.int64).view(np.uint64)).any(axis=0))[0]
        root = {c: c for c in g["comp"].tolist()}
        ids, comp, block = g["id"].to_numpy(), g["comp"].to_numpy(), g["block"].to_numpy()
        members = [np.asarray(m) for m in g["members"]]
        size = np.array([len(m) for m in members])

        def top(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        out = []
        for x in range(len(g) - 1):
            rest = np.arange(x + 1, len(g))
            if i != j:
                rest = rest[block[rest] != block[x]]
            rest = rest[(comp[rest] != comp[x]) & (100 * np.minimum(size[rest], size[x]) >= percent * np.maximum(size[rest], size[x]))]
            if not len(rest):
                continue
            rest = rest[(bands[rest] == bands[x]).argmax(axis=1) == here]  # a pair is the work of the first band it shares
            rest = rest[np.bitwise_count(sketch[rest] ^ sketch[x]).sum(axis=1) <= limit]
            for y in rest.tolist():
                a, b = top(comp[x]), top(comp[y])
                if a == b:
                    continue
                both = len(np.intersect1d(members[x], members[y], assume_unique=True))
                if 100 * both >= percent * (size[x] + size[y] - both):
                    root[max(a, b)] = min(a, b)
                    out.append((ids[x], ids[y]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _by_block(links):
    """Applies links to the rows of each (key, i, j) of sorted rows, whatever batches they come in."""

    def run(batches):
        held: pd.DataFrame | None = None
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            at = rows[["key", "i", "j"]].to_numpy()
            cut = np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1
            ends = np.r_[0, cut]
            for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                yield links(rows.iloc[s:e])
            held = rows.iloc[ends[-1] :]
        if held is not None:
            yield links(held)

    return run


def _open(at: DataFrame) -> DataFrame:
    """Of the members (id, key, comp): each bucket of several components (of two or three members, the pivots have seen all pairs), its
    largest component, and how many blocks hold the members outside it (few) and in it (many)."""
    one = at.groupBy("key", "comp").agg(F.count("*").alias("n"))
    own = one.groupBy("key").agg(F.sum("n").alias("m"), F.count("*").alias("_comps"), F.max(F.struct("n", "comp")).alias("_most")).filter("_comps > 1 AND m > 3")
    own = own.select("key", "m", F.col("_most.comp").alias("most"), F.col("_most.n").alias("_n"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    few, many, every = blocks(F.col("m") - F.col("_n")), blocks(F.col("_n")), blocks(F.col("m"))
    apart = F.col("_n") * few + (F.col("m") - F.col("_n")) * (few + many) < F.col("m") * every
    return own.select("key", "most", F.when(apart, few).otherwise(every).alias("few"), F.when(apart, many).otherwise(0).alias("many"))


def _dealt(rest: DataFrame) -> DataFrame:
    """A row for each pair of blocks (i, j) that a member of a bucket is in. Members of the largest component are linked already: their
    blocks, numbered after the others, meet those of the others only, unless all of the bucket is dealt alike (many is 0)."""
    of = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    main = (F.col("comp") == F.col("most")) & (F.col("many") > 0)
    rest = rest.withColumn("block", F.when(main, F.col("few") + of(F.greatest(F.col("many"), F.lit(1)))).otherwise(of(F.col("few"))))
    rest = rest.withColumn("_other", F.explode(F.sequence(F.lit(0), F.when(main, F.col("few")).otherwise(F.col("few") + F.col("many")) - 1)))
    return rest.withColumn("i", F.least("block", "_other")).withColumn("j", F.greatest("block", "_other"))


def _linked(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, row, n_shingles, cls (a number of the row's set; null for empty ones) and comp (the least cls of its component)
    of every row of the stored table (doc_id, row, text)."""
    spark, began = docs.sparkSession, C.mark()
    sig = C.table(signatures(docs, n), "signatures")
    of_set = sig.filter("n_shingles > 0").groupBy("set_key").agg(F.min("row").alias("row"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    reps = C.table(of_set.withColumn("id", F.monotonically_increasing_id()), "classes")
    bucket = reps.select("id", F.explode("bands").alias("key"))
    shared = bucket.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("_last")).filter("pivot <> _last").drop("_last")
    members = C.table(bucket.join(shared, "key"), "members")
    ids = reps.select("id", "row").join(members.select("id").distinct(), "id", "left_semi")
    sets = C.table(_sets(docs, ids, n), "sets")
    links = C.table(_confirmed(members.filter("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct(), reps, sets, percent), "links")
    comp = C.components(links)
    # once more, with the member of most links as the pivot of each bucket that isn't one component yet
    degree = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).groupBy("id").count()
    at = members.join(comp, "id", "left").join(degree, "id", "left").select("id", "key", "pivot", F.coalesce("comp", "id").alias("comp"), F.coalesce("count", F.lit(0)).alias("links"))
    at = C.table(at, "members")
    pivots = at.groupBy("key").agg(F.max_by("id", F.when(F.col("id") != F.col("pivot"), F.col("links"))).alias("second"), F.max_by("comp", F.when(F.col("id") != F.col("pivot"), F.col("links"))).alias("own"), F.min("comp").alias("_a"), F.max("comp").alias("_b"), F.count("*").alias("m")).filter("_a <> _b AND m > 2").drop("_a", "_b", "m")
    again = at.drop("pivot").join(pivots.withColumnRenamed("second", "pivot"), "key").filter("comp <> own").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    links = C.table(links.unionByName(_confirmed(again, reps, sets, percent)), "links")
    comp = C.components(links)
    # the rest, in pairs of blocks
    at = C.table(at.drop("comp", "links", "pivot").join(comp, "id", "left").select("id", "key", F.coalesce("comp", "id").alias("comp")), "members")
    rest = at.join(_open(at), "key").join(reps.select("id", "bands", "sketch"), "id").join(sets, "id")
    rest = _dealt(rest).select("id", "key", "comp", "block", "i", "j", "bands", "sketch", "members")
    found = rest.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id").mapInPandas(_by_block(_block_links(percent)), "a long, b long")
    comp = C.components(links.unionByName(found))
    named = sig.select("doc_id", "row", "n_shingles", "set_key").join(reps.select("set_key", F.col("id").alias("cls")), "set_key", "left")
    out = C.table(named.join(comp.toDF("cls", "comp"), "cls", "left").select("doc_id", "row", "n_shingles", "cls", F.coalesce("comp", "cls").alias("comp")), "clusters")
    C.sweep(spark, began, (out,))
    return out


def _stored(docs: DataFrame) -> DataFrame:
    return C.with_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "row")


def clusters(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row: documents are linked when
    100 * intersection >= percent * union of their sets; a component is named by its smallest doc_id."""
    spark, began = docs.sparkSession, C.mark()
    out = _linked(_stored(docs), n, percent)
    C.sweep(spark, began, (out,))
    names = C.table(out.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("name"), F.count("*").alias("_n")).filter("_n > 1").drop("_n"), "names")
    name = F.when(F.col("_c").isNull(), F.col("doc_id")).otherwise(F.col("name"))
    return out.join(names.withColumnRenamed("comp", "_c").hint("merge"), F.col("comp") == F.col("_c"), "left").select("doc_id", "n_shingles", name.alias("component_id"), F.col("doc_id").eqNullSafe(name).alias("kept"))


def deduplicate(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component of more than one, and all others."""
    spark, row = docs.sparkSession, C.fresh(docs, "_row")
    rows = C.with_rows(docs, row)
    began = C.mark()
    out = _linked(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("row"), "text"), n, percent).filter("comp IS NOT NULL")
    first = out.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).getField("row").alias("first"), F.count("*").alias("_n")).filter("_n > 1").select(F.col("comp").alias("_c"), "first")
    dropped = C.table(out.join(C.table(first, "first").hint("merge"), F.col("comp") == F.col("_c")).filter("row <> first").select(F.col("row").alias(row)), "dropped")
    C.sweep(spark, began, (dropped,))
    return rows.join(dropped, row, "left_anti").select(*docs.columns)


def op7_minhash(spark, sf_dir: str) -> DataFrame:
    return clusters(C.load(spark, sf_dir, "documents"), 3, 85)
