"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

A document becomes FEATURES numbers (logarithms of counts and of shares). Each class has a mean and a covariance,
shrunk towards the pooled covariance and its diagonal; their Cholesky factors are computed once on the driver and
sent with the scoring function. The score is the logistic of the difference of the classes' log densities
(Mahalanobis distance and log determinant) plus log prior.

The model is fitted on at most `max_rows` labelled rows (those of smallest hash of doc_id, also where doc_ids or labels are
repeated), labels of null are not used, and held-out rows (crc32 of doc_id mod 3 is 1) never. Scoring covers all rows and whole texts in one pass
without a shuffle. Null and empty texts have a score too (all counts zero). Repeated rows are scored each, a null
doc_id is not held out. If a class has no labelled row, every score is the prior of 0.5. Extra columns are
ignored by `scores` and passed through by `keep_good`."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm import common as C

MAX_ROWS = 20_000
FEATURES = ("words", "word_length", "upper", "digits", "marks", "bangs", "pipes", "lines", "distinct", "repeats", "short_words", "sentence_ends", "other_marks")
_BYTES = np.zeros(256, dtype=np.int64)
for _k, _set in enumerate((range(65, 91), range(48, 58), b"#$%&*@^~<>=+\\/_{}[]", b"!?", b"|", b"\n", b".,;:", b" \t\x0b\x0c\r", b"\"'()-`"), 1):
    _BYTES[list(_set)] = _k


def features(col: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    raw, off = C.raw_text(col)
    w, a, b = C.words(raw, off)
    same = np.zeros(len(w), dtype=np.int64)
    if len(w):
        same[1:] = w[1:] == w[:-1]
    kind = _BYTES[raw]
    out = np.zeros((len(off) - 1, len(FEATURES)))
    for i, (s, e, p, q) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), a.tolist(), b.tolist(), strict=True)):
        n = np.bincount(kind[s:e], minlength=10)
        size, count = max(e - s, 1), max(q - p, 1)
        share = lambda x, of: np.log(x / of + 1e-3)
        own = w[p:q]
        out[i] = (
            np.log1p(q - p), np.log(max(size - n[6] - n[8], 1) / count), share(n[1], size), share(n[2], size), share(n[3], count), share(n[4], count), share(n[5], count), share(n[6], count),
            np.log(len(np.unique(own)) / count + 1e-2), share(same[p + 1 : q].sum(), count), share(n[8] + n[6], size), share(n[7], count), share(n[9], count),
        )
    return out


def held_out(doc_id) -> F.col:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(x: np.ndarray, y: np.ndarray, shrink: float = 0.1, ridge: float = 0.02) -> dict | None:
    """Means, inverse Cholesky factors, log determinants and log priors of classes 0 and 1."""
    if not len(y) or min((y == 0).sum(), (y == 1).sum()) < 1:
        return None
    scale = x.std(axis=0) + 1e-9
    centre = x.mean(axis=0)
    z = (x - centre) / scale
    means = [z[y == c].mean(axis=0) for c in (0, 1)]
    spread = [(z[y == c] - means[c]).T @ (z[y == c] - means[c]) for c in (0, 1)]
    pooled = sum(spread) / max(len(y) - 2, 1)
    model = {"centre": centre, "scale": scale, "classes": []}
    for c in (0, 1):
        n = (y == c).sum()
        s = (1 - shrink) * spread[c] / max(n - 1, 1) + shrink * pooled + ridge * np.eye(z.shape[1])
        root = np.linalg.cholesky(s)
        model["classes"].append((means[c], np.linalg.inv(root), 2 * np.log(np.diag(root)).sum(), np.log(n / len(y))))
    return model


def predict(model: dict | None, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    z = (x - model["centre"]) / model["scale"]
    d = [np.log(1.0) - 0.5 * (((z - m) @ root.T) ** 2).sum(axis=1) - 0.5 * det + prior for m, root, det, prior in model["classes"]]
    return 1 / (1 + np.exp(-np.clip(d[1] - d[0], -500, 500)))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> dict | None:
    """The model, from labelled rows that aren't held out."""
    C.ship(docs.sparkSession)
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows)  # bounded by max_rows, and so may be broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(own), "doc_id")

    def run(batches):
        for batch in batches:
            for part in C.text_chunks(batch, "text"):
                f = features(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(list(f), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    got = rows.mapInArrow(run, "doc_id long, y int, x array<double>").orderBy(F.xxhash64("doc_id"), "doc_id", "y", "x").limit(max_rows).toPandas()
    return fit(np.array(got["x"].tolist(), dtype=float).reshape(-1, len(FEATURES)), got["y"].to_numpy())


def scores(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, score of every row."""
    C.ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in C.text_chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(predict(model, features(part.column(1))), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: dict | None, least: float = 0.5) -> DataFrame:
    """The rows of docs whose score is `least` or more."""
    C.ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in C.text_chunks(batch, "text"):
                good = predict(model, features(part.column(part.schema.get_field_index("text")))) >= least
                yield part.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs = C.load(spark, sf_dir, "documents")
    out = scores(docs, train(docs, C.load(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
