"""Topic models. Documents are dealt into blocks of bounded size, words into chunks; neither goes to the driver.

A block holds, for its documents, (word, count) pairs as numpy arrays and the share of each topic; a chunk holds the counts of its
words by topic. In an iteration each block sends a message of sums to each chunk that has words of it, and gets a message with
the new counts of these words back, so that pairs of document and word are never rows of a shuffle and no task holds the vocabulary.
The pairs stay where they are: they are stored in buckets by block, and only messages and topics move. Words of a single document that
are there equally often have equal counts in every step, so that a block takes them as one word and nobody else hears of them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.frame import Frame
from tarn.operators.order import number_rows
from tarn.sources.catalog import drop_kept, keep, shared_path, ship

TOKENS = 3_000_000  #: words of a block's documents, more only in a single longer one; fewer where topics are many
CHUNK = 50_000  #: words of a chunk, whose places fit 16 bits
HELD = 200_000  #: numbers of a slice of pairs times topics
FOLDS = 50  #: rounds in which documents outside the fit find their topics
SENT = np.float32  #: numbers of messages between steps; the last step's counts go out in full
BUCKETS = 2_000  #: of the stored pairs, at most
_MESSAGE = "at long, part int, source long, a binary, b binary"  #: part 1: topics of a block's documents and counts of its own words, 2: messages
_PAIRS = {"off": np.int64, "code": np.int32, "n": np.uint8, "words": np.uint16, "cuts": np.int64, "rank": np.int32, "many": np.int32}
_PLAIN = {"parquet.enable.dictionary": "false"}  #: for rows of a few long binaries
_SINGLES = {"singles": np.int64, "groups": np.int32}  #: numbers of words of a single document, and of what is one with them


@dataclass
class Vocabulary:
    """The distinct words, their numbers and how many blocks have them, a stored table (word, id, blocks)."""

    table: DataFrame
    size: int

    def __len__(self) -> int:
        return self.size


def _split(texts):
    """The words of texts, a text's empty first and last word too; none of a null."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(texts)
    return pc.if_else(pc.is_valid(texts), lists, pa.scalar([], lists.type)) if texts.null_count else lists


def blocks_of(data: Frame, docid: str, words: str, topics: int = 1) -> DataFrame:
    """Stored blocks: ids of the documents, where their pairs begin, the pairs' words (places in the block's list) and counts, the list,
    frequent words first. A null list is empty, null words don't count. Instead of lists, words can be texts, which
    are cut at white space as Spark's split does by a pattern of it."""
    most = min(TOKENS, max(500_000, 9_000_000 // topics))
    column = F.col(f"`{words}`")
    text = dict(data.df.dtypes)[words] == "string"
    df = data.df.select(F.col(f"`{docid}`").alias("id"), (column if text else F.coalesce(F.filter(column, lambda w: w.isNotNull()), F.array().cast("array<string>"))).alias("words"))
    ship(df.sparkSession)

    def build(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        def block(parts, number):
            ids, lists = (pa.concat_arrays([p.column(k) for p in parts]) for k in (0, 1))
            coded = lists.flatten().dictionary_encode()
            size = len(coded.dictionary)
            doc = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
            order = np.argsort(-np.bincount(np.asarray(coded.indices), minlength=size), kind="stable")
            rank = np.empty(size, np.int64)
            rank[order] = np.arange(size)
            pairs, n = np.unique(doc * max(size, 1) + rank[np.asarray(coded.indices)], return_counts=True)
            off = np.searchsorted(pairs, np.arange(len(lists) + 1) * max(size, 1))
            one = [pa.array([(TaskContext.get().partitionId() << 33) + number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
            one += [pa.array([x.tobytes()], pa.binary()) for x in (off.astype(np.int64), (pairs % max(size, 1)).astype(np.int32), n.astype(np.int32))]
            return pa.RecordBatch.from_arrays([*one, pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), coded.dictionary.take(pa.array(order)))], ["block", "ids", "off", "code", "n", "words"])

        held, tokens, number = [], 0, 0
        for b in batches:
            if text:
                b = pa.RecordBatch.from_arrays([b.column(0), _split(b.column(1))], ["id", "words"])
            start, sizes = 0, np.asarray(b.column(1).value_lengths()).tolist()
            for i, n in enumerate(sizes):
                if tokens and tokens + n > most:
                    held += [b.slice(start, i - start)] if i > start else []
                    yield block(held, number)
                    held, tokens, number, start = [], 0, number + 1, i
                tokens += n
            if start < len(sizes):
                held.append(b.slice(start))
        if held:
            yield block(held, number)

    out = df.mapInArrow(build, f"block long, ids array<{df.schema['id'].dataType.simpleString()}>, off binary, code binary, n binary, words array<string>")
    return keep(out, maxRecordsPerFile=1, compression="zstd", **_PLAIN)  # readers take a file's rows together, and other codecs hold them outside the heap


def vocabulary_of(blocks: DataFrame) -> Vocabulary:
    numbered, size = number_rows(blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("blocks")))
    return Vocabulary(numbered.select("word", F.col("_row").alias("id"), "blocks"), size)


def _sums(off, code, n, topics, shares, words=True, likelihood=False):
    """One step over the pairs of a block: counts by topic of its documents and of its words, and the log likelihood of its tokens."""
    k, size, long = shares.shape[1], len(off) - 1, np.diff(off)
    columns, mix = np.ascontiguousarray(shares.T), np.ascontiguousarray((topics / topics.sum(axis=1, keepdims=True)).T)
    by_doc, weights, ll = np.zeros((size, k)), np.empty((k if words else 0, len(code))), 0.0
    step, s = max(1, HELD // k), 0
    while s < size:
        e = max(s + 1, int(np.searchsorted(off, off[s] + step, "right")) - 1)
        at, lens = slice(off[s], off[e]), long[s:e]
        full = np.flatnonzero(lens)
        if len(full):
            own, starts = code[at], off[s:e][full] - off[s]
            g, m = [c.take(own) for c in columns], [np.repeat(x[s:e], lens) for x in mix]
            total = g[0] * m[0]
            for x, y in zip(g[1:], m[1:], strict=True):
                total += x * y
            if likelihood:
                ll += float(n[at] @ np.log(total))
            rate = np.divide(n[at], total, out=total)
            for t, (x, y) in enumerate(zip(g, m, strict=True)):
                x *= rate
                by_doc[s + full, t] = np.add.reduceat(x, starts)
                if words:
                    np.multiply(y, rate, out=weights[t, at])
        s = e
    by_doc *= mix.T
    by_word = np.empty((len(shares) if words else 0, k))
    for t, w in enumerate(weights):
        by_word[:, t] = np.bincount(code, w, len(shares)) * columns[t]
    return by_doc, by_word, ll


def _read(row):
    off, code, n = (np.frombuffer(x, t) for x, t in zip(row, (np.int64, np.int32, np.int32), strict=True))
    return off, code.astype(np.intp), n


def _groups(batches):
    """(at, rows of it as (part, source, a, b)) of sorted rows, whatever batches they come in."""
    at, rows = None, []
    for b in batches:
        cols = [b.column(i) for i in range(5)]
        for i in range(b.num_rows):
            own = [c[i].as_py() for c in cols]
            if own[0] != at:
                if rows:
                    yield at, rows
                at, rows = own[0], []
            rows.append(own[1:])
    if rows:
        yield at, rows


def _batch(rows: list[tuple]):
    import pyarrow as pa

    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["at", "part", "source", "a", "b"])


def _dealt(df: DataFrame) -> DataFrame:
    return df.repartition("at").sortWithinPartitions("at", "part", "source")


@dataclass
class Lda:
    """Counts of each word by topic (word, id, counts), a stored table; their sums; what is added to counts of documents and words."""

    shares: DataFrame
    totals: np.ndarray
    vocabulary: Vocabulary
    counts: DataFrame
    docid: str
    a: float
    b: float

    def topics(self, words: int = 10) -> pd.DataFrame:
        """The most probable words of each topic (from 0), of ties the smaller word."""
        out = []
        for t, total in enumerate(self.totals.tolist()):
            top = self.shares.select("word", "id", F.col("counts")[t].alias("c")).orderBy(F.desc("c"), "word").limit(words).collect()
            out.append({"topic": t, "termIndices": [r.id for r in top], "termWeights": [(r.c + self.b) / (total + len(self.vocabulary) * self.b) for r in top], "words": [r.word for r in top]})
        return pd.DataFrame(out)

    def _folded(self, blocks: DataFrame, run, schema: str) -> DataFrame:
        """run(ids, words, off, code, n, shares, topics) of each block: the shares of its words and the topics its documents find with
        them. Words that the model doesn't have are left out."""
        k, a, b, low = len(self.totals), self.a, self.b, self.totals + len(self.vocabulary) * self.b
        known = blocks.select("block", F.posexplode("words").alias("place", "word")).join(self.shares.select("word", "counts"), "word")
        known = known.groupBy("block").agg(F.collect_list("place").alias("places"), F.flatten(F.collect_list("counts")).alias("counts"))
        joined = blocks.join(known, "block", "left").select("ids", "words", "off", "code", "n", "places", "counts")
        ship(joined.sparkSession)

        def part(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, words = batch.column(0)[i].values, batch.column(1)[i].values
                    off, code, n = _read([batch.column(c)[i].as_py() for c in (2, 3, 4)])
                    found = batch.column(5)[i].values
                    shares, there = np.ones((len(words), k)), np.zeros(len(words), bool)
                    if found is not None:
                        places = np.asarray(found)
                        there[places], shares[places] = True, (np.asarray(batch.column(6)[i].values).reshape(-1, k) + b) / low
                    kept = there[code]
                    off = np.r_[0, np.cumsum(kept)][off]
                    code, n = code[kept], n[kept]
                    topics = np.full((len(off) - 1, k), 1.0)
                    for _ in range(FOLDS):
                        new = _sums(off, code, n, topics, shares, False)[0] + a
                        moved = np.max(np.abs(new - topics), initial=0.0)
                        topics = new
                        if moved < 1e-6:
                            break
                    yield run(ids, words, off, code, n, shares, topics)

        return joined.mapInArrow(part, schema)

    def _rows(self, data, docid, words) -> tuple[DataFrame, str]:
        return (self.counts, self.docid) if data is None else (blocks_of(data, docid, words, len(self.totals)), docid)

    def predict(self, data: Frame, docid: str, words: str) -> Frame:
        from pyspark.ml.functions import array_to_vector

        blocks, name = self._rows(data, docid, words)

        def run(ids, words, off, code, n, shares, topics):
            import pyarrow as pa

            mix = topics / topics.sum(axis=1, keepdims=True)
            return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * mix.shape[1], pa.int32()), pa.array(mix.ravel()))], ["id", "topics"])

        out = self._folded(blocks, run, f"id {_kind(blocks)}, topics array<double>")
        return Frame(out.select(F.col("id").alias(name), array_to_vector("topics").alias("topics")))

    def assignments(self, data: Frame | None = None, docid: str | None = None, words: str | None = None) -> Frame:
        """The most probable topic (from 1) of each distinct word of each document, and how often the word is there: share of the topic in
        the document times share of the word in the topic, of ties the smaller."""
        blocks, name = self._rows(data, docid, words)

        def run(ids, words, off, code, n, shares, topics):
            import pyarrow as pa

            doc, topic = np.repeat(np.arange(len(off) - 1), np.diff(off)), np.zeros(len(code), np.int32)
            step = max(1, HELD // shares.shape[1])
            for s in range(0, len(code), step):
                at = slice(s, s + step)
                topic[at] = np.argmax(topics[doc[at]] * shares[code[at]], axis=1) + 1
            return pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), words.take(pa.array(code)), pa.array(topic), pa.array(n.astype(np.int64))], ["id", "word", "topic", "n"])

        out = self._folded(blocks, run, f"id {_kind(blocks)}, word string, topic int, n long")
        return Frame(out.withColumnRenamed("id", name).groupBy(name, "word", "topic").agg(F.sum("n").alias("n")))

    def document_sums(self, data: Frame | None = None, docid: str | None = None, words: str | None = None) -> Frame:
        """Words of each document by topic."""
        name = self.docid if data is None else docid
        return Frame(self.assignments(data, docid, words).df.groupBy(name, "topic").agg(F.sum("n").alias("n")))

    def topic_sums(self) -> Frame:
        return Frame(self.assignments().df.groupBy("topic").agg(F.sum("n").alias("n")))

    def perplexity(self, data: Frame | None = None, docid: str | None = None, words: str | None = None) -> float:
        blocks, _ = self._rows(data, docid, words)

        def run(ids, words, off, code, n, shares, topics):
            import pyarrow as pa

            return pa.RecordBatch.from_arrays([pa.array([_sums(off, code, n, topics, shares, False, True)[2]]), pa.array([float(n.sum())])], ["ll", "n"])

        r = self._folded(blocks, run, "ll double, n double").agg(F.sum("ll").alias("ll"), F.sum("n").alias("n")).first()
        return float(np.exp(-r.ll / r.n)) if r.n else float("nan")


def _kind(blocks: DataFrame) -> str:
    return blocks.schema["ids"].dataType.elementType.simpleString()


def _buckets(blocks: DataFrame) -> tuple[dict[int, int], int]:
    """A number for each block, such that Spark's hash deals them evenly to buckets; how many buckets there are."""
    spark, own = blocks.sparkSession, sorted(r.block for r in blocks.select("block").collect())
    n = max(1, min(len(own), BUCKETS))
    each, tried = -(-len(own) // n), 16 * n
    while True:
        found = [[] for _ in range(n)]
        for r in spark.range(tried).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("b")).orderBy("id").collect():
            found[r.b].append(r.id)
        if min(map(len, found)) >= each:
            return {block: found[i % n][i // n] for i, block in enumerate(own)}, n
        tried *= 2


def _linked(blocks: DataFrame, vocabulary: Vocabulary) -> tuple[DataFrame, str]:
    """The pairs of the blocks with their words by number, stored in buckets, and the table's name."""
    numbers = blocks.select("block", F.posexplode("words").alias("place", "word")).join(vocabulary.table.hint("shuffle_hash"), "word").select(F.col("block").alias("of"), "place", "id", (F.col("blocks") == 1).alias("single"))
    keys, buckets = _buckets(blocks)

    def part(block, words):
        import pyarrow as pa

        off, code, n = _read([block.column(c)[0].as_py() for c in ("off", "code", "n")])
        place, size = words.column("place").to_numpy(), len(words)
        number, single = np.empty(size, np.int64), np.empty(size, bool)
        number[place], single[place] = words.column("id").to_numpy(), words.column("single").to_numpy()
        single &= np.bincount(code, minlength=size) == 1
        alone = np.flatnonzero(single[code])
        doc, most = np.searchsorted(off, alone, "right") - 1, int(n.max(initial=0)) + 1
        same, first, group, many = np.unique(doc * most + n[alone], return_index=True, return_inverse=True, return_counts=True)
        shared, kept = np.flatnonzero(~single), ~single[code]
        order = np.argsort(number[shared])
        rank = np.empty(len(shared), np.int64)
        rank[order] = np.arange(len(shared))
        words, cuts = _dealt_words(number[shared][order], CHUNK)
        singles, first = number[code[alone]], alone[first]
        codes, counts, kept[first] = (np.cumsum(~single, dtype=np.int32) - 1)[code], n.astype(np.int64), True
        codes[first], counts[first] = len(shared) + np.arange(len(same)), counts[first] * many
        codes, counts, off = codes[kept], counts[kept], np.r_[0, np.cumsum(kept)][off]
        if counts.max(initial=0) > 255:  # such a pair becomes several
            times = -(-counts // 255)
            ends = np.cumsum(times)
            rest, counts = counts - 255 * (times - 1), np.full(ends[-1], 255)
            codes, counts[ends - 1], off = np.repeat(codes, times), rest, np.r_[0, ends][off]
        own = {"off": off, "code": codes, "n": counts, "words": words, "cuts": cuts, "rank": rank, "many": many, "singles": singles, "groups": group}
        return pa.table([pa.array([keys[block.column("block")[0].as_py()]], pa.int64()), *(pa.array([own[c].astype(t).tobytes()], pa.binary()) for c, t in (_PAIRS | _SINGLES).items())], ["at", *_PAIRS, *_SINGLES])

    found = blocks.select("block", "off", "code", "n").groupby("block").cogroup(numbers.groupby("of")).applyInArrow(part, ", ".join(["at long", *(f"{c} binary" for c in _PAIRS | _SINGLES)]))
    name = f"spark_catalog.default.tarn_{uuid.uuid4().hex}"
    found.write.bucketBy(buckets, "at").option("path", shared_path(blocks.sparkSession)).options(maxRecordsPerFile=1, compression="zstd", **_PLAIN).format("parquet").saveAsTable(name)
    return blocks.sparkSession.table(name), name


def _dealt_words(numbers, size: int):
    """Of sorted numbers of words, their places in chunks of a size; the chunks and where each begins."""
    starts = np.flatnonzero(np.r_[True, np.diff(numbers // size) > 0]) if len(numbers) else np.zeros(0, np.int64)
    return (numbers % size).astype(np.uint16), np.c_[numbers[starts] // size, starts].ravel()


def _cut(words, cuts, counts, source: int) -> list[tuple]:
    """Messages to the chunks: places of words in the chunk, and their counts."""
    chunks, starts, ends = cuts[::2].tolist(), cuts[1::2].tolist(), np.r_[cuts[3::2], len(words)].tolist()
    return [(c, 2, source, words[s:e].tobytes(), counts[s:e].tobytes()) for c, s, e in zip(chunks, starts, ends, strict=False)]


def _block_step(k: int, a: float, b: float, low: list[float] | None, seed: int, last: bool):
    """Of a block's pairs, topics and messages: its new topics, and messages to the chunks. low None: the first step, from random topics.
    last: messages have the words of single documents too."""

    def run(pairs, rows):
        import pyarrow as pa

        own = {c: np.frombuffer(pairs.column(c)[0].as_buffer(), t) for c, t in (_PAIRS | _SINGLES).items() if c in pairs.column_names}
        block, off, code, n, many, size = pairs.column("at")[0].as_py(), own["off"], own["code"].astype(np.intp), own["n"], own["many"], len(own["words"])
        shares = np.ones((size + len(many), k))
        if low is None:
            topics = np.random.default_rng([seed, block]).exponential(size=(len(off) - 1, k)) + 1e-9
        else:
            got = sorted((p, s, i) for i, (p, s) in enumerate(zip(rows.column("part").to_pylist(), rows.column("source").to_pylist(), strict=True)))
            topics = np.frombuffer(rows.column("a")[got[0][2]].as_buffer()).reshape(-1, k) + a
            shares[size:] = np.frombuffer(rows.column("b")[got[0][2]].as_buffer()).reshape(-1, k)
            if len(got) > 1:
                np.concatenate([np.frombuffer(rows.column("b")[i].as_buffer(), SENT) for _, _, i in got[1:]]).astype(float).reshape(-1, k).take(own["rank"], axis=0, out=shares[:size])
            shares += b
            shares /= low
        by_doc, by_word, _ = _sums(off, code, n, topics, shares)
        each, counts = by_word[size:] / many[:, None], np.empty((size, k), float if last else SENT)
        counts[own["rank"]] = by_word[:size]
        out = [(-1 - block, 1, 0, by_doc.tobytes(), each.tobytes()), *_cut(own["words"], own["cuts"], counts, block)]
        if last:
            order = np.argsort(own["singles"])
            out += _cut(*_dealt_words(own["singles"][order], CHUNK), each[own["groups"][order]], block)
        return pa.Table.from_batches([_batch(out)]).append_column("sums", pa.array([by_doc.sum(axis=0).tolist(), *([None] * (len(out) - 1))], pa.list_(pa.float64())))

    return run


def _chunk_step(k: int):
    """Of the messages to a chunk: a message to each block that sent one. What a block keeps goes back to it."""

    def run(batches):
        for chunk, rows in _groups(batches):
            if chunk < 0:
                yield _batch([(-1 - chunk, *r) for r in rows])
                continue
            total = np.zeros((CHUNK, k))
            for r in rows:
                total[np.frombuffer(r[2], np.uint16)] += np.frombuffer(r[3], SENT).reshape(-1, k)
            total = total.astype(SENT)
            for s in range(0, len(rows), 32):
                yield _batch([(r[1], 2, chunk, None, total[np.frombuffer(r[2], np.uint16)].tobytes()) for r in rows[s : s + 32]])

    return run


def _chunk_counts(k: int):
    """Of the messages to a chunk: the numbers of its words and their counts."""

    def run(batches):
        import pyarrow as pa

        for chunk, rows in _groups(batches):
            total, there = np.zeros((CHUNK, k)), np.zeros(CHUNK, bool)
            for r in rows:
                at = np.frombuffer(r[2], np.uint16)
                total[at] += np.frombuffer(r[3]).reshape(-1, k)
                there[at] = True
            at = np.flatnonzero(there)
            yield pa.RecordBatch.from_arrays([pa.array(at + chunk * CHUNK, pa.int64()), pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * k, pa.int32()), pa.array(total[at].ravel()))], ["id", "counts"])

    return run


def fit(blocks: DataFrame, vocabulary: Vocabulary, docid: str, k: int, alpha: float, beta: float, iterations: int, seed: int) -> Lda:
    """Expectation maximisation over every token: the mode of the posterior where alpha and beta are over 1 (they count less 1), else
    that in the logarithms of the shares (they count in full)."""
    ship(blocks.sparkSession)
    less = 1.0 if alpha > 1 and beta > 1 else 0.0
    a, b = alpha - less, beta - less
    spark = blocks.sparkSession
    first, name = _linked(blocks, vocabulary)
    state, totals = None, None
    try:
        for i in range(iterations + 1):
            if state is None:
                back, low = spark.createDataFrame([], _MESSAGE), None
            else:
                back, low = _dealt(state.drop("sums")).mapInArrow(_chunk_step(k), _MESSAGE), (totals + len(vocabulary) * b).tolist()
            last = i == iterations
            step = first.select("at", *_PAIRS, *(_SINGLES if last else [])).groupby("at").cogroup(back.groupby("at")).applyInArrow(_block_step(k, a, b, low, seed, last), f"{_MESSAGE}, sums array<double>")
            new = keep(step, **_PLAIN)
            totals = np.array([r.sums for r in sorted(new.select("at", "sums").where("sums IS NOT NULL").collect())]).reshape(-1, k).sum(axis=0)  # a row for each block
            if state is not None:
                drop_kept(state)
            state = new
        drop_kept(first)
    finally:
        spark.sql(f"DROP TABLE {name}")
    counts = _dealt(state.where("part = 2").drop("sums")).mapInArrow(_chunk_counts(k), "id long, counts array<double>")
    shares = keep(vocabulary.table.join(counts, "id").select("word", "id", "counts"))
    drop_kept(state)
    return Lda(shares, totals, vocabulary, blocks, docid, a, b)
