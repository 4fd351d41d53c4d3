"""The pipeline's stages against brute force on the smallest tables."""

import re

import corpus_pipeline as P
from tarn.llm import bpe, decontaminate, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        rows = out.toPandas()
        seen.append((name, docs, rows))
        if name != "bpe":
            assert out.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
    kept = {n: set(r.doc_id) for n, _, r in seen}
    before = {n: d.toPandas() for n, d, _ in seen}
    model = quality.train(before_df := seen[0][1], spark.read.parquet(f"{SF}/labels.parquet"))
    assert kept["quality"] == {r.doc_id for r in quality.scores(before_df, model).collect() if r.score >= 0.5}
    d = before["exact"].assign(t=before["exact"].text.map(lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")))
    assert kept["exact"] == set(d.groupby("t").doc_id.min())
    own = {i: (lambda w: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))) for i, t in zip(before["near"].doc_id, before["near"].text, strict=True)}
    top = {i: i for i in own}
    for _ in range(4):
        for a in own:
            for b in own:
                both = len(own[a] & own[b])
                if both and 100 * both >= 80 * len(own[a] | own[b]):
                    top[a] = top[b] = min(top[a], top[b])
    assert kept["near"] == {i for i in own if top[i] == i}
    words = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    items = [words(t) for t in spark.read.parquet(f"{SF}/benchmark.parquet").toPandas().text]
    code: dict = {}
    import numpy as np

    ids = lambda w: np.array([code.setdefault(x, len(code)) for x in w])
    bad = {i for i, t in zip(before["decontaminate"].doc_id, before["decontaminate"].text, strict=True) for w in items if decontaminate.align(ids(w), ids(words(t))) >= 0.5 * 2 * len(w)}
    assert kept["decontaminate"] == set(before["decontaminate"].doc_id) - bad
    assert kept["bpe"] == kept["decontaminate"] and bpe.default_ranks()


def test_odd_tables(spark, tmp_path):
    """Nulls, repeated ids with the same and other texts, an empty table, and columns of clashing names."""
    source = spark.read.parquet(f"{SF}/documents.parquet")
    good = [r.text for r in source.limit(40).collect()]
    item = "a passage of the test set with words of its own that nobody else would write in this order ever again"
    rows = [(k, t, 1, "x") for k, t in enumerate(good)] + [(None, good[0], 2, "x"), (None, None, 3, None), (3, good[3], 4, "x"), (3, good[4] + " and more", 5, "x"), (90, "", 6, "x"), (None, good[1] + " " + item, 7, "x"), (91, good[1] + " " + item, 8, None)]
    cols = "doc_id long, text string, _row long, row string"
    spark.createDataFrame(rows, cols).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        before, docs = docs, spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), cols)
        assert set(docs.collect()) <= set(before.collect()), name
    out = P.run(spark, str(tmp_path)).collect()
    assert len(out) == docs.count() and not {r.text for r in docs.collect()} & {good[1] + " " + item}
    assert len({re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in docs.collect()}) == docs.count()
    spark.createDataFrame([], cols).write.parquet(f"{tmp_path}/none/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert P.run(spark, f"{tmp_path}/none").count() == 0
