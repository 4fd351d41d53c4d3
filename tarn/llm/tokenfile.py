"""Token-ID files: an adaptive context-mixing range coder in independent, checksummed blocks.

Each block keeps three predictors of the next id: the one that last followed the two ids before (order 2), the one that
last followed the id before (order 1), and the sorted window of its latest ids (order 0). An id is one of four events:
order 2 is right, order 1 is right, the id is in the window (then the window's counts give its interval), or it is new
(then all 65536 ids are alike). Each order has adaptive distributions of the events, chosen by its state (how often the
candidate was right lately; for order 0 the event before); they are mixed by weights that follow how well each has
predicted, and drive a range coder with 64-bit bounds. All arithmetic is in integers, so files decode alike everywhere.
Every block of BLOCK ids starts afresh and carries a CRC-32; up to LANES blocks are coded in step with each other, as vectors.

A segment is MAGIC, a header (counts, CRC), the compressed index of its documents, and its blocks. Documents are
range-partitioned and sorted by doc_id; a task streams its partition into segments of bounded size, and
segments are stored as rows of binary values in a Parquet table, which any store that Spark reaches can hold.

Texts are encoded as the library encodes them: the text of an added token, also of a special one, has that token's id.
Null and empty texts have the end id alone. Null doc_ids come first. Repeated rows are stored each. Ids must be
below 65536. A table without rows makes a file without segments. Extra columns are ignored."""

from __future__ import annotations

import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm import bpe
from tarn.llm import common as C

MAGIC, BLOCK, LANES = b"TRN2", 2048, 4096
HASHED = 1024  #: contexts of orders 1 and 2
FIRST, WINDOW = 32, 1024  #: least and greatest window of order 0 (a place takes 10 bits)
_EVENT = np.array([3, 0, 1, 0, 2, 0, 1, 0])  #: by order 2 right, order 1 right (2), in the window (4)
_EVEN, _SUM, _FIFTHS, _GAIN = 1024 * 0x0001000100010001, np.uint64(0x0001000100010001), np.uint64(0x00FF00FF00FF00FF), np.uint64(128)
_NEXT = np.array([1, 1, 1, 1, 2, 2, 3, 3, 1, 2, 3, 4, 5, 6, 7, 7], np.uint32) << 16  #: times right after a miss, after a hit
_K1, _K2, _ID, _SIXTEEN = np.uint32(0x9E3779B1), np.uint32(0xC2B2AE35), np.uint32(0xFFFF), np.uint32(16)
_KEEP = np.uint32(33 - HASHED.bit_length())
_FULL, _WORD, _LOWER = (1 << 64) - 1, np.uint64(1 << 32), np.uint64((1 << 32) - 1)
_WORKER: dict = {}


class _Model:
    """Predictions of n blocks that are coded in step: candidates of orders 2 and 1, the sorted window of order 0,
    and adaptive distributions of the four events under the state of each order, mixed by weights.

    A distribution is four shares of 16 bits in one number; a product with _SUM gives their running sums."""

    def __init__(self, n: int):
        self.n, self.lane = n, np.arange(n)
        self.hash_base, self.state_base = self.lane * HASHED, self.lane * 8
        self.tables = [np.zeros(n * HASHED, np.uint32) for _ in range(2)]  # order 1, order 2: id, and above it how often it was right
        self.events = [np.full(n * 8, _EVEN, np.uint64) for _ in range(3)]
        self.score = [np.full(n, 1024, np.uint64) for _ in range(3)]
        self.weight = [1 + (s >> 10) for s in self.score]
        self.one, self.two, self.last = np.zeros(n, np.uint32), np.zeros(n, np.uint32), np.zeros(n, np.int64)
        self.bits = 0

    def rebuild(self, window: np.ndarray) -> None:
        """Order 0 from the last ids of the blocks (2 ** bits columns), sorted; of each, first place and count less one of its run."""
        n, m = window.shape
        s = np.sort(window, axis=1, kind="stable")
        edge = np.ones((n, m), dtype=bool)
        np.not_equal(s[:, 1:], s[:, :-1], out=edge[:, 1:])
        at = np.flatnonzero(edge)
        size = np.diff(np.append(at, n * m))
        run = (at % m | (size - 1) << 10).astype(np.uint32)
        self.sorted, self.spans, self.bits = s, np.repeat(run, size).reshape(n, m), m.bit_length() - 1

    def expect(self) -> np.ndarray:
        """The mixed distribution of events."""
        first = self.one * _K1
        self.h1, self.h2 = self.hash_base + (first >> _KEEP), self.hash_base + ((first + self.two * _K2) >> _KEEP)
        self.e1, self.e2 = self.tables[0].take(self.h1), self.tables[1].take(self.h2)
        self.c1, self.c2, self.k1, self.k2 = self.e1 & _ID, self.e2 & _ID, self.e1 >> _SIXTEEN, self.e2 >> _SIXTEEN
        self.at = (self.state_base + self.last, self.state_base + self.k1, self.state_base + self.k2)
        self.own = [t.take(a) for t, a in zip(self.events, self.at, strict=True)]
        mixed = self.own[0] * self.weight[0]
        mixed += self.own[1] * self.weight[1]
        mixed += self.own[2] * self.weight[2]
        return mixed

    def learn(self, event: np.ndarray, field: np.ndarray, ids: np.ndarray, hit1: np.ndarray, hit2: np.ndarray, weigh: bool) -> None:
        """field: 16 times the event; weigh: whether scores and weights are to follow this id."""
        gain = _GAIN << field
        for t, a, p in zip(self.events, self.at, self.own, strict=True):
            q = p >> 5
            q &= _FIFTHS
            np.subtract(gain, q, out=q)
            q += p
            t[a] = q
        if weigh:
            for k, p in enumerate(self.own):
                s = self.score[k]
                s += (((p >> field) & 0xFFFF) >> 3) - (s >> 3)
                self.weight[k] = 1 + (s >> 10)
        for table, h, c, k, hit in ((self.tables[0], self.h1, self.c1, self.k1, hit1), (self.tables[1], self.h2, self.c2, self.k2, hit2)):
            keep = hit | (k > 1)
            table[h] = _NEXT.take(k + (hit.view(np.uint8) << 3)) | (ids ^ ((ids ^ c) * keep))
        self.two, self.one, self.last = self.one, ids, event


def _frames(length: int):
    """(start, end, window) of the stretches of a block that share one order-0 window: it doubles, then slides."""
    start, window = 0, 0
    while start < length:
        end = FIRST if not start else start * 2 if start < WINDOW else start + WINDOW // 2
        yield start, min(end, length), window
        start, window = end, min(end, WINDOW)


def _places(model: _Model, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each id (a column for each block): whether the window has it, first place and count less one there; else itself and 0."""
    if not model.bits:
        return np.zeros(own.shape, bool), own.astype(np.uint64), np.zeros(own.shape, np.uint64)
    n = own.shape[1]
    got = np.empty((n, len(own)), np.uint32)
    table = np.zeros((8, 65536), np.uint32)
    for a in range(0, n, 8):
        row = np.arange(min(8, n - a))[:, None]
        at = model.sorted[a : a + 8]
        table[row, at] = model.spans[a : a + 8] | 1 << 20
        got[a : a + 8] = table[row, own[:, a : a + 8].T]
        table[row, at] = 0
    got = np.ascontiguousarray(got.T)
    seen = got > 0
    return seen, np.where(seen, got & 1023, own).astype(np.uint64), ((got >> 10) & 1023).astype(np.uint64)


def _settled(low: np.ndarray, rng: np.ndarray, move) -> None:
    """Moves the first 32 bits out wherever they are settled; a short range across a border is cut to settle them."""
    same, tight = (low ^ (low + rng)) < _WORD, rng < _WORD
    go = np.flatnonzero(same | tight)
    while len(go):
        a, b = low[go], rng[go]
        cut = (a ^ (a + b)) >= _WORD
        if cut.any():
            b = np.where(cut, (~a + 1) & _LOWER, b)
        move(go, a)
        a <<= 32
        b <<= 32
        low[go], rng[go] = a, b
        go = go[((a ^ (a + b)) < _WORD) | (b < _WORD)]


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """ids: a row for each block (padded alike). The code bytes of each block."""
    ids = ids.astype(np.uint16)
    n, length = ids.shape
    low, rng = np.zeros(n, np.uint64), np.full(n, _FULL, np.uint64)
    out, pos = np.zeros((n, length // 2 + 256), dtype=np.uint32), np.zeros(n, np.int64)
    model = _Model(n)

    def move(go, a):
        out[go, pos[go]] = a >> 32
        pos[go] += 1

    for start, end, window in _frames(length):
        own = np.ascontiguousarray(ids[:, start:end].T).astype(np.uint32)
        if window:
            model.rebuild(ids[:, start - window : start])
        seen, first, more = _places(model, own)
        width = np.where(seen, np.uint64(model.bits), np.uint64(16))
        seen = seen.view(np.uint8) << 2
        for t in range(end - start):
            sym = own[t]
            mixed = model.expect()
            hit1, hit2 = model.c1 == sym, model.c2 == sym
            event = _EVENT.take(seen[t] | hit1.view(np.uint8) << 1 | hit2.view(np.uint8))
            field = (event << 4).view(np.uint64)
            sums = mixed * _SUM
            freq = (mixed >> field) & 0xFFFF
            r = rng // (sums >> 48)
            low += (((sums >> field) & 0xFFFF) - freq) * r
            rng = freq * r
            miss = (event >> 1).view(np.uint64)
            r = rng >> (width[t] * miss)
            low += first[t] * miss * r
            rng = (more[t] * miss + 1) * r
            _settled(low, rng, move)
            model.learn(event, field, sym, hit1, hit2, t % 8 == 0)
            if t % 32 == 0 and pos.max() + 32 * 4 > out.shape[1]:
                out = np.concatenate([out, np.zeros((n, length // 2 + 256), np.uint32)], axis=1)
    for k in range(2):
        move(model.lane, low << (32 * k))
    return [out[i, :p].astype("<u4").tobytes() for i, p in enumerate(pos.tolist())]


def decode_blocks(codes: list[bytes], length: int) -> np.ndarray:
    """The ids of blocks, padded to `length` columns."""
    n = len(codes)
    width = max(map(len, codes)) // 4 + 2
    data = np.zeros((n, width), dtype=np.uint32)
    for i, c in enumerate(codes):
        data[i, : len(c) // 4] = np.frombuffer(c, "<u4", count=len(c) // 4)
    low, rng = np.zeros(n, np.uint64), np.full(n, _FULL, np.uint64)
    code = data[:, 0].astype(np.uint64) << 32 | data[:, 1]
    pos = np.full(n, 2, np.int64)
    model = _Model(n)
    ids = np.zeros((n, length), dtype=np.uint16)

    def move(go, a):
        p = pos[go]
        code[go] = code[go] << 32 | data[go, np.minimum(p, width - 1)]
        pos[go] = p + 1

    for start, end, window in _frames(length):
        if window:
            model.rebuild(ids[:, start - window : start])
            place, flat, spans = model.lane << model.bits, model.sorted.reshape(-1), model.spans.reshape(-1)
        bits = np.array([0, 0, model.bits, 16], np.uint64)
        own = np.zeros((end - start, n), np.uint16)
        for t in range(end - start):
            mixed = model.expect()
            sums = mixed * _SUM
            total = sums >> 48
            r = rng // total
            value = np.minimum((code - low) // r, total - 1)
            event = ((value >= sums & 0xFFFF).view(np.uint8) + (value >= (sums >> 16) & 0xFFFF) + (value >= (sums >> 32) & 0xFFFF)).astype(np.int64)
            field = (event << 4).view(np.uint64)
            freq = (mixed >> field) & 0xFFFF
            low += (((sums >> field) & 0xFFFF) - freq) * r
            rng = freq * r
            b = bits.take(event)
            r = rng >> b
            value = np.minimum((code - low) // r, (1 << b) - 1)
            sym = value.astype(np.uint32)
            if window:
                inside = event == 2
                at = place + value.view(np.int64) * inside
                span = spans[at] * inside
                np.copyto(value, span & 1023, where=inside)
                np.copyto(sym, flat[at], where=inside)
                low += value * r
                rng = ((span >> 10) + 1) * r
            else:
                low += value * r
                rng = r
            np.copyto(sym, model.c1, where=event == 1)
            np.copyto(sym, model.c2, where=event == 0)
            _settled(low, rng, move)
            model.learn(event, field, sym, model.c1 == sym, model.c2 == sym, t % 8 == 0)
            own[t] = sym
        ids[:, start:end] = own.T
    return ids


def pack(ids: np.ndarray, doc_ids: list[int | None], sizes: list[int]) -> bytes:
    """A segment of the documents."""
    if len(ids) and (ids.min() < 0 or ids.max() >= 65536):
        raise ValueError("ids must be from 0 to 65535")
    flat = np.asarray(ids).astype(np.uint16)
    index = zlib.compress(json.dumps([doc_ids, sizes]).encode())
    blocks = -(-len(flat) // BLOCK)
    body = [MAGIC, struct.pack("<QIII", len(flat), blocks, len(index), zlib.crc32(index)), index]
    for k in range(0, blocks, LANES):
        own = flat[k * BLOCK : (k + LANES) * BLOCK]
        lanes = -(-len(own) // BLOCK)
        part = np.pad(own, (0, lanes * BLOCK - len(own))).reshape(lanes, BLOCK)
        for i, code in enumerate(encode_blocks(part[:, : min(BLOCK, len(own))])):
            block = own[i * BLOCK : (i + 1) * BLOCK].astype("<u4")
            body.append(struct.pack("<III", len(block), len(code), zlib.crc32(block.tobytes())) + code)
    return b"".join(body)


def unpack(segment: bytes) -> tuple[np.ndarray, list[int | None], list[int]]:
    """ids, doc_ids and sizes of a segment; a damaged one is an error."""
    if segment[:4] != MAGIC:
        raise ValueError("not a token segment")
    total, blocks, size, crc = struct.unpack_from("<QIII", segment, 4)
    at = 24
    index = segment[at : at + size]
    if zlib.crc32(index) != crc:
        raise ValueError("the index is damaged")
    doc_ids, sizes = json.loads(zlib.decompress(index))
    at += size
    heads, codes = [], []
    for _ in range(blocks):
        n, length, crc = struct.unpack_from("<III", segment, at)
        heads.append((n, crc)), codes.append(segment[at + 12 : at + 12 + length])
        at += 12 + length
    out = []
    for k in range(0, blocks, LANES):
        got = decode_blocks(codes[k : k + LANES], max(n for n, _ in heads[k : k + LANES]))
        for (n, crc), row in zip(heads[k : k + LANES], got, strict=True):
            if zlib.crc32(row[:n].astype("<u4").tobytes()) != crc:
                raise ValueError("a block is damaged")
            out.append(row[:n])
    ids = np.concatenate(out) if out else np.zeros(0, np.uint16)
    if len(ids) != total:
        raise ValueError("blocks are missing")
    return ids, doc_ids, sizes


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _tokenizer(path: str):
    if path not in _WORKER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _WORKER[path] = Tokenizer.from_file(path)
    return _WORKER[path]


# The characters that byte-level tokenizers put for bytes: printable ones for themselves, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHARACTERS = {b: b if b in _PRINTABLE else 256 + b - sum(p < b for p in _PRINTABLE) for b in range(256)}


class _Words(bpe.Coder):
    """Ids of texts by the tokenizers library: it encodes each word of the split pattern that is not in the worker's
    bounded cache. The library cuts texts at its added tokens (which keep their own id, also special ones), then by that same
    pattern, and never merges across words, so ids are those of whole texts."""

    def __init__(self, path: str):
        self.library = _tokenizer(path)
        self.marks = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.marks, key=len, reverse=True))) or "(?!)")
        if type(self.library.pre_tokenizer).__name__ != "ByteLevel" or self.library.normalizer is not None:
            raise ValueError("the tokenizer must be byte-level and without a normalizer")
        self.tokens = self.library.model.tokenize
        self.forget(0)

    def merge(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words by the library's model, whose pre-tokenizer would give it each as one piece, a character for each byte."""
        mapped = b"".join(found).decode("latin-1").translate(_CHARACTERS)
        ends = np.cumsum([0, *map(len, found)]).tolist()
        ids = [[t.id for t in self.tokens(mapped[a:b])] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return np.fromiter(map(len, ids), np.int64, len(ids)), np.array([i for x in ids for i in x], np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not any(m in t for m in self.marks for t in texts):
            return super().encode(texts)
        parts, ends, marked = [], [0], []  # texts without marks, the part after each text's last, and (part, id) of marks before it
        for t in texts:
            at = 0
            for m in self.cut.finditer(t):
                parts.append(t[at : m.start()])
                marked.append((len(parts), self.marks[m[0]]))
                at = m.end()
            parts.append(t[at:])
            ends.append(len(parts))
        ids, off = super().encode(parts)
        before, own = (np.array(x, np.int64) for x in zip(*marked, strict=True))
        return np.insert(ids, off[before], own), off[ends] + np.searchsorted(before, ends, side="right") - (np.searchsorted(before, ends, side="right") - np.searchsorted(before, ends, side="left"))


def _words(path: str) -> _Words:
    if ("words", path) not in _WORKER:
        _WORKER["words", path] = _Words(path)
    return _WORKER["words", path]


def _ended(ids: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with end_id after each document, and sizes with it."""
    return np.insert(ids, off[1:], end_id), np.diff(off) + 1


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0) -> None:
    """Writes the ids of the whole texts, each document ended by end_id, as segments in ascending doc_id order."""
    C.ship(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()

    def run(batches):
        from pyspark import TaskContext

        part_no, before, seq = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        sizes: list[int] = []
        held = 0

        def segment():
            nonlocal before, seq, held
            flat = np.concatenate(ids)
            out = pa.RecordBatch.from_arrays([pa.array([part_no], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()), pa.array([len(flat)], pa.int64()), pa.array([pack(flat, names, sizes)], pa.binary())], ["part", "seq", "before", "n", "segment"])
            before, seq, held = before + len(flat), seq + 1, 0
            ids.clear(), names.clear(), sizes.clear()
            return out

        for batch in batches:
            for chunk in C.text_chunks(batch, "text", bpe.CHUNK):
                own, size = _ended(*_words(tokenizer).encode([x or "" for x in chunk.column(1).to_pylist()]), end_id)
                ids.append(own), names.extend(chunk.column(0).to_pylist()), sizes.extend(size.tolist())
                held += len(own)
                if held >= BLOCK * LANES:
                    yield segment()
        if names:
            yield segment()

    key = F.col("doc_id").asc_nulls_first()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(C.n_parts(docs), key).sortWithinPartitions(key)
    rows.mapInArrow(run, "part int, seq int, before long, n long, segment binary").write.mode("overwrite").parquet(path)


def read(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of every stored document, as the files have them."""
    C.ship(spark)
    return _read(spark, path, "ids array<int>", lambda flat, off: pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat.astype(np.int32))))


def _read(spark, path: str, column: str, make) -> DataFrame:
    files = spark.read.parquet(path)

    def run(batches):
        for batch in batches:
            for part, before, segment in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                flat, names, sizes = unpack(segment.as_py())
                off = np.cumsum([0, *sizes])
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(names), pa.int32()), pa.array(names, pa.int64()), pa.array(off[:-1] + before, pa.int64()), pa.array(sizes, pa.int64()), make(flat, off)], ["part", "doc_id", "start", "n_tokens", column.split()[0]])

    rows = files.select("part", "before", "segment").mapInArrow(run, f"part int, doc_id long, start long, n_tokens long, {column}")
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("first"))  # one row for each partition
    return rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", column.split()[0])


def op6_token_file(spark, sf_dir: str) -> DataFrame:
    path = C.new_path(spark, "tokens")
    write(C.load(spark, sf_dir, "documents"), path)

    def crcs(flat: np.ndarray, off: np.ndarray) -> pa.Array:
        raw = flat.astype("<u4")
        return pa.array([zlib.crc32(raw[a:b].tobytes()) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.int64())

    return _read(spark, path, "ids_crc32 long", crcs)
