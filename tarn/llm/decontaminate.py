"""Benchmark decontamination: n-gram seeds join training passages to test items, then Smith-Waterman
alignment over words scores copies, also paraphrased or edited ones.

Words are runs of bytes other than ASCII white space and punctuation, A-Z folded. A pass over the whole texts
returns, for each text that holds a run of SEED words of any item, the word hashes around it; texts are
not shuffled. A passage is aligned with every item it shares a seed with, however frequent the seed is: a match
scores 2, a mismatch or gap -1, and the share of the item's highest possible score is compared with `least`.
Left out are only pairs that cannot reach it, as too few of the item's words are in the passage at all; equal
passages of a batch are aligned once.

Memory on the driver and in tasks is bounded by the test items: BLOCK_ITEMS of them are taken at a time, each
block in a pass of its own. Null and empty texts and items hold nothing; an item of fewer than SEED words is
its own seed; every distinct text of the items is searched, also those of one item_id or of none, and found under
its item_id (its best score where several texts have it; null for items without one). Every row is a document of its own:
rows of one doc_id, and rows without, are scanned, reported and kept or dropped each by its own text. Extra columns, also of
clashing names, are ignored by `scores` and passed through by `decontaminate`; a table without rows gives one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm import common as C

SEED, LEAST = 4, 0.5
BLOCK_ITEMS = 50_000  #: items whose seeds a task holds at a time (about 60 MB)
_APART = np.zeros(256, dtype=bool)
_APART[[c for c in range(128) if not chr(c).isalnum()]] = True


def _item_words(texts: list[str]) -> list[np.ndarray]:
    w, a, b = C.words(*C.raw_text(pa.array(texts, pa.string())), _APART)
    return [w[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)]


def align(x: np.ndarray, y: np.ndarray, match: int = 2, miss: int = -1, gap: int = -1) -> int:
    """Score of the best local alignment of two sequences (a row of the table at a time)."""
    step = -gap * np.arange(1, len(y) + 1)
    row = np.zeros(len(y) + 1, dtype=np.int64)
    best = 0
    for v in x:
        new = np.maximum(np.maximum(row[:-1] + np.where(y == v, match, miss), row[1:] + gap), 0)
        new = np.maximum(np.maximum.accumulate(new + step) - step, 0)  # a gap along the row
        row[1:] = new
        best = max(best, int(new.max()))
    return best


def _passages(docs: DataFrame, seeds: np.ndarray, reach: np.ndarray, sizes: list[int]) -> DataFrame:
    """row, no of the passage, hashes of the seeds in it, hashes of its words, for (row, text). A passage holds, about each seed,
    as many words as an alignment with the longest item of that seed can span (reach)."""

    def run(batches):
        mask = np.zeros(1 << 22, dtype=bool)
        mask[(seeds >> np.uint64(42)).astype(np.int64)] = True
        for batch in batches:
            for part in C.text_chunks(batch, "text"):
                w, a, b = C.words(*C.raw_text(part.column(1)), _APART)
                hits = []
                for n in sizes:
                    if len(w) < n:
                        continue
                    g = C.ngrams(w, n)
                    at = np.flatnonzero(mask[(g >> np.uint64(42)).astype(np.int64)])
                    k = np.minimum(np.searchsorted(seeds, g[at]), len(seeds) - 1)
                    same = seeds[k] == g[at]
                    at, k = at[same], k[same]
                    doc = np.searchsorted(b, at, side="right")
                    inside = at + n <= b[doc]
                    hits.append((at[inside], k[inside], doc[inside]))
                if not sum(len(x[0]) for x in hits):
                    continue
                at, k, doc = (np.concatenate([x[i] for x in hits]) for i in range(3))
                lo, hi = np.maximum(at - reach[k], a[doc]), np.minimum(at + reach[k], b[doc])
                order = np.lexsort((at, lo))
                k, doc, lo, hi = k[order], doc[order], lo[order], hi[order]
                upto = np.maximum.accumulate(hi)
                new = np.flatnonzero(np.r_[True, (lo[1:] >= upto[:-1]) | (doc[1:] != doc[:-1])])
                ends = np.r_[new[1:], len(lo)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc[new])), pa.array(new, pa.int64()), pa.array([np.unique(seeds[k[i:j]]).view(np.int64).tolist() for i, j in zip(new.tolist(), ends.tolist(), strict=True)], pa.list_(pa.int64())), pa.array([w[i:j].view(np.int64) for i, j in zip(lo[new].tolist(), upto[ends - 1].tolist(), strict=True)], pa.list_(pa.int64()))],
                    ["row", "passage", "seeds", "words"],
                )

    return docs.select("row", "text").mapInArrow(run, "row long, passage long, seeds array<long>, words array<long>")


def _aligned(passages: DataFrame, items: dict[int, np.ndarray], names: list[list[int | None]], of: dict[int, list[int]], least: float) -> DataFrame:
    """row, item_id and score of the passages and items that share a seed and may reach `least`.
    Items are numbered by distinct text; names: the ids of each number, of: the numbers of each seed."""

    def found(seeds: list[int], y: np.ndarray) -> list[tuple[int, float]]:
        near = sorted({i for s in seeds for i in of.get(s, ())})
        own = [items[i] for i in near]
        held = np.add.reduceat(np.isin(np.concatenate(own), y), np.cumsum([0, *map(len, own[:-1])]), dtype=np.int64)  # no more words can match
        return [(i, align(x, y) / (2 * len(x))) for i, x, n in zip(near, own, held.tolist(), strict=True) if 2 * n / (2 * len(x)) >= least]

    def run(batches):
        for batch in batches:
            ids, item, score, known = [], [], [], {}
            for d, seeds, words in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                y = np.array(words, dtype=np.int64)
                key = y.tobytes()
                if key not in known:
                    known[key] = found(seeds, y)
                for i, v in known[key]:
                    for name in names[i]:
                        ids.append(d), item.append(name), score.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(item, pa.int64()), pa.array(score, pa.float64())], ["row", "item_id", "score"])

    return passages.mapInArrow(run, "row long, item_id long, score double")


def _hits(docs: DataFrame, benchmark: DataFrame, least: float) -> DataFrame:
    """row, item_id, score of the rows of the stored table (row, text) and the items that align with `least` of the item's full score or more."""
    C.ship(docs.sparkSession)
    spark = docs.sparkSession
    found = []
    block: dict[str, list[int | None]] = {}  # the ids of each text

    def flush() -> None:
        words = {i: w for i, w in enumerate(_item_words(list(block))) if len(w)}  # by number of the text
        names = [list(v) for v in block.values()]
        block.clear()
        if not words:
            return
        of: dict[int, list[int]] = {}
        for i, w in words.items():
            for s in np.unique(C.ngrams(w, SEED)).view(np.int64).tolist():
                of.setdefault(s, []).append(i)
        seeds = np.sort(np.array(list(of), dtype=np.int64).view(np.uint64))
        longest = np.array([max(len(words[i]) for i in of[s]) for s in seeds.view(np.int64).tolist()])
        reach = np.ceil(longest * (3 - 2 * least)).astype(np.int64) + SEED  # the longest span that still scores `least`
        sizes = sorted({min(SEED, len(w)) for w in words.values()})
        passages = C.table(_passages(docs, seeds, reach, sizes), "passages")
        found.append(_aligned(passages, {i: w.view(np.int64) for i, w in words.items()}, names, of, least))

    taken = 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropDuplicates().filter("text IS NOT NULL").toLocalIterator():
        block.setdefault(r.text, []).append(r.item_id)
        taken += 1
        if taken >= BLOCK_ITEMS:
            flush()
            taken = 0
    flush()
    if not found:
        return spark.createDataFrame([], "row long, item_id long, score double")
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return C.table(out.filter(F.col("score") >= least).groupBy("row", "item_id").agg(F.max("score").alias("score")), "hits")


def _stored(docs: DataFrame) -> DataFrame:
    return C.with_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "row")


def scores(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, item_id, score of each row of docs and each item that align with `least` of the item's full score or more."""
    rows = _stored(docs)
    return rows.select("doc_id", "row").join(_hits(rows, benchmark, least), "row").select("doc_id", "item_id", "score")


def found_in(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, item_ids (ascending, null first) and the best score of every row of docs; no items and 0 for clean ones."""
    rows = _stored(docs)
    hits = _hits(rows, benchmark, least).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("item_id"))).getField("item_id").alias("item_ids"), F.max("score").alias("score"))
    return rows.select("doc_id", "row").join(C.table(hits, "hits"), "row", "left").select("doc_id", F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), F.coalesce("score", F.lit(0.0)).alias("score"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """docs without the rows that hold a copy of an item."""
    row = C.fresh(docs, "_row")
    rows = C.with_rows(docs, row)
    hit = _hits(rows.select(F.col(row).alias("row"), "text"), benchmark, least).select(F.col("row").alias(row)).distinct()
    return rows.join(hit, row, "left_anti").select(*docs.columns)


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Of every document: the items it holds a copy of, and the best score."""
    return found_in(C.load(spark, sf_dir, "documents"), C.load(spark, sf_dir, "benchmark")).select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids", "score")
