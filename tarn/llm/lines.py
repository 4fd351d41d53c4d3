"""Line dedup: lines that many documents share are dropped from all of them.

Every line becomes a row (two 64-bit hashes of its key, document, position) without its text. Rows are
range-partitioned by hashes and document and sorted within each partition by hashes, document and position. A task
streams over them; a document's first occurrence of a key counts it. A key that lies within one partition is
decided there; the first and last key of a partition may go on in others, so their rows are kept as pending
and decided by the sum of the counts of all partitions, like those of keys of more than HELD rows. Positions of dropped
lines are gathered by document and text (two 64-bit hashes) into compressed bitmaps, which are the result; texts are
not returned.

Key: the line without [\\x20\\x09-\\x0D] at both ends, A-Z folded; an empty key is never dropped. A null or
empty text is one empty line. A null doc_id counts as a document of its own. Rows repeated under one doc_id count as one
document; each row loses lines of its own text only.
Extra columns are ignored; a table without rows gives one without rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm import common as C

MIN_DOCS, MIN_CHARS = 10, 1
HELD = 200_000  #: rows of a key that a task holds before they go out as pending
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and two 64-bit hashes of the text. Rows alike in all of them lose the same lines."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return own.select("*", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("second"), "text").alias("t2"))


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """h1, h2, doc_id, pos, t1, t2 of every line whose key has at least min_chars code points."""
    lines = _keyed(docs).select("doc_id", "t1", "t2", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(C.SPACES)), _UP, _LOW)
    return lines.select("doc_id", "pos", "t1", "t2", key.alias("key")).filter(F.length("key") >= max(1, min_chars)).select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc_id", "pos", "t1", "t2")


def _stream(min_docs: int):
    """Reads sorted rows; yields (doc_id, pos, t1, t2, h1, h2, docs): docs is null for rows that are decided (dropped),
    else a number whose sum over the pending rows of a key is the number of its documents."""
    most = HELD

    def run(batches):
        import itertools

        held: list[np.ndarray] = []  # rows of the key that is not complete yet, until its fate is known
        edge_first = True
        last_doc = None  # of the held key's rows that went out as pending already, if any did

        def out(rows: np.ndarray, counts) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows["d"], pa.int64(), mask=rows["nil"]), pa.array(rows["p"], pa.int32()), *[pa.array(rows[k], pa.int64()) for k in ("t1", "t2", "h1", "h2")], counts if counts is not None else pa.nulls(len(rows), pa.int64())], ["doc_id", "pos", "t1", "t2", "h1", "h2", "docs"])

        def doc(row):
            return row["d"], row["nil"]

        def pending(rows: np.ndarray) -> pa.RecordBatch:
            new = np.r_[last_doc is None or doc(rows[0]) != last_doc, (rows["d"][1:] != rows["d"][:-1]) | (rows["nil"][1:] != rows["nil"][:-1])]
            c = np.zeros(len(rows), np.int64)
            c[0] = new.sum()
            return out(rows, pa.array(c))

        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                rows = np.zeros(batch.num_rows, dtype=[("h1", "i8"), ("h2", "i8"), ("d", "i8"), ("nil", "?"), ("p", "i4"), ("t1", "i8"), ("t2", "i8")])
                rows["h1"], rows["h2"], rows["p"], rows["t1"], rows["t2"] = (np.asarray(batch.column(k)) for k in (0, 1, 3, 4, 5))
                rows["nil"] = np.asarray(batch.column(2).is_null())
                rows["d"] = np.asarray(batch.column(2).fill_null(0))
                if held:
                    rows = np.concatenate([*held, rows])
                    held = []
            else:
                if held:
                    yield pending(np.concatenate(held))
                return
            key = np.flatnonzero(np.r_[True, (rows["h1"][1:] != rows["h1"][:-1]) | (rows["h2"][1:] != rows["h2"][:-1])])
            if len(key) > 1 and (edge_first or last_doc is not None):  # goes on in another partition, or began as pending
                yield pending(rows[: key[1]])
                rows, key, edge_first, last_doc = rows[key[1] :], key[1:] - key[1], False, None
            last = key[-1]
            held = [rows[last:].copy()]
            if last:
                # all keys of this batch but the last at once
                done, starts = rows[:last], key[:-1]
                which = np.cumsum(np.r_[True, np.diff(np.searchsorted(starts, np.arange(last), side="right")) > 0]) - 1
                new = np.r_[True, (done["d"][1:] != done["d"][:-1]) | (done["nil"][1:] != done["nil"][:-1])]
                new[starts] = True
                often = np.bincount(which, weights=new, minlength=len(starts))[which] >= min_docs
                if often.any():
                    yield out(done[often], None)
            if len(held[0]) > most:  # a very frequent key: what is known of it need not be kept in memory
                head = held[0][:-1]
                yield pending(head)
                last_doc, held = doc(head[-1]), [held[0][-1:].copy()]

    return run


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, t1, t2, pos of each line to be dropped."""
    C.ship(docs.sparkSession)
    order = [F.col(c) for c in ("h1", "h2", "doc_id")]
    rows = line_rows(docs, min_chars).repartitionByRange(C.n_parts(docs), *order).sortWithinPartitions("h1", "h2", "doc_id", "pos")
    seen = C.table(rows.mapInArrow(_stream(min_docs), "doc_id long, pos int, t1 long, t2 long, h1 long, h2 long, docs long"), "lines")
    pending = seen.filter("docs IS NOT NULL")
    often = pending.groupBy("h1", "h2").agg(F.sum("docs").alias("n")).filter(F.col("n") >= min_docs).select("h1", "h2")
    own = ["doc_id", "t1", "t2", "pos"]
    return seen.filter("docs IS NULL").select(*own).unionByName(pending.join(often, ["h1", "h2"], "left_semi").select(*own))


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, t1, t2, n_dropped, bitmap (zlib, a bit for each line up to the last dropped one: 1 keeps) of each document and text that loses lines."""

    @F.pandas_udf("binary")
    def pack(pos):
        def one(p):
            bits = np.ones((int(max(p)) // 8 + 1) * 8, dtype=np.uint8)
            bits[np.asarray(p)] = 0
            return zlib.compress(np.packbits(bits).tobytes())

        return pos.map(one)

    by = dropped_lines(docs, min_docs, min_chars).groupBy("doc_id", "t1", "t2").agg(F.collect_set("pos").alias("pos"))  # at most the lines of a text
    return by.select("doc_id", "t1", "t2", F.size("pos").cast("long").alias("n_dropped"), pack("pos").alias("bitmap"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (text) of every row of docs. The join has the same plan at every size."""
    known = bitmaps.toDF("_doc", "_t1", "_t2", "n_dropped", "bitmap").hint("merge")
    on = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2"))
    both = _keyed(docs).join(known, on, "left").select("doc_id", "text", "bitmap")

    def run(batches):
        for batch in batches:
            for part in C.text_chunks(batch, "text"):
                lines, dropped, kept = [], [], []
                for t, b in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    own = t.split("\n")
                    lines.append(len(own))
                    if b is None:
                        dropped.append(0), kept.append(t)
                        continue
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(b), np.uint8)).tolist()
                    left = [x for k, x in enumerate(own) if k >= len(bits) or bits[k]]
                    dropped.append(len(own) - len(left)), kept.append("\n".join(left))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])

    return both.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept string")


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = C.load(spark, sf_dir, "documents")
    return apply_bitmaps(docs, keep_bitmaps(docs)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
l AS (SELECT r, doc_id, unnest(a) AS line, unnest(range(1, len(a) + 1)) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY r, doc_id
"""
