"""Byte-level BPE encoding and decoding: DuckDB recursive queries over token-position rows.

Every text is cut by the fixed split pattern (vectorised over code points). Words unknown to the task's
bounded cache are cut into pieces wherever no token of the vocabulary has the two bytes side by side, so that none
reaches across, and become rows (piece, position, token) which a recursive query joins with the merge table: each step
contracts the leftmost pair of least rank of every piece, and with it those of the same pair that would be the next ones, up
to the first that may open a pair of lower rank. So the ids are those of single contractions, in words of any length. A query
holds a bounded number of rows and goes on with the pieces
that aren't ended; nothing spills to disk. A cached word counts only if its bytes are the same. Decoding
cuts the ids before tokens that start with a space, and joins distinct pieces with the vocabulary; an ordered
aggregation puts their bytes together.

Nulls and empty texts give no ids and decode to no bytes; repeated rows are encoded each; other columns pass
through; a table without rows gives a table without rows."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.llm import common as C

CACHE_WORDS = 1_000_000  #: bound of a worker's cache of encoded words
CACHE_BYTES = 64_000_000  #: bound of the bytes of the words that it holds
CHUNK = 1_000_000  #: bytes of text that a task encodes at a time
SLICE, ROWS, STEPS = 200_000, 2_000_000, 48  #: bytes of words in a query (a longer word is one of its own), rows and steps of its recursion
_WORKER: dict = {}


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


# ------------------------------------------------------------------ splitting


def _classes() -> np.ndarray:
    """0 white space, 1 letter, 2 number, 3 other, of every code point."""
    if "classes" not in _WORKER:
        import regex

        every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\x00" for c in range(0x110000))
        out = np.full(0x110000, 3, dtype=np.uint8)
        for k, pattern in ((0, r"\s+"), (1, r"\p{L}+"), (2, r"\p{N}+")):
            for m in regex.finditer(pattern, every):
                out[m.start() : m.end()] = k
        _WORKER["classes"] = out
    return _WORKER["classes"]


def split_starts(cp: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the matches of the split pattern start, in code points laid end to end; off: where texts start."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    cls = _classes()[cp]
    first = np.zeros(n + 1, dtype=bool)
    first[off] = True
    run = np.ones(n, dtype=bool)
    run[1:] = (cls[1:] != cls[:-1]) | first[1:-1]
    start = run.copy()
    solid_after_space = np.zeros(n, dtype=bool)
    solid_after_space[1:] = (cls[1:] != 0) & (cls[:-1] == 0) & ~first[1:-1]
    b = np.flatnonzero(solid_after_space)
    start[b - 1] = True
    start[b[cp[b - 1] == 32]] = False
    a = np.flatnonzero((cp[:-1] == 39) & start[:-1] & (cls[1:] == 1) & ~first[1:-1]) if n > 1 else np.zeros(0, np.int64)
    if len(a):
        x = cp[a + 1]
        two = np.minimum(a + 2, n - 1)
        y = np.where((a + 2 < n) & ~first[np.minimum(a + 2, n)], cp[two], 0)
        size = np.where(np.isin(x, [ord(c) for c in "stmd"]), 1, 0)
        size = np.where(((x == ord("r")) | (x == ord("v"))) & (y == ord("e")) | (x == ord("l")) & (y == ord("l")), 2, size)
        a, size = a[size > 0], size[size > 0]
        start[a + 1] = False
        end = a + 1 + size
        inside = end < n
        end = end[inside]
        start[end[cls[end] == 1]] = True
        start[off[off < n]] = True
    return np.flatnonzero(start)


# ------------------------------------------------------------------ merging


_RECURSE = """
WITH RECURSIVE state(step, k, t) AS (
  SELECT 0, k, t FROM init
  UNION ALL (
    WITH pairs AS (
      SELECT step, k, t, lead(k) OVER o AS next, lead(t) OVER o AS after FROM state WHERE step < {steps} WINDOW o AS (ORDER BY k)),
    ranked AS MATERIALIZED (
      SELECT step, k, t, k >> 32 AS w, next, after, m, wild FROM pairs LEFT JOIN merges ON l = t AND r = after AND next >> 32 = k >> 32),
    best AS (SELECT w, min(m) AS best, arg_min(k, m::BIGINT << 32 | (k & 4294967295)) AS first FROM ranked WHERE m IS NOT NULL GROUP BY w),
    least AS MATERIALIZED (SELECT k, next, w, m, wild AND k <> first AS waits FROM ranked JOIN best USING (w) WHERE m = best),
    wilds AS MATERIALIZED (SELECT k, next, w, m FROM least WHERE w IN (SELECT w FROM least WHERE waits)),
    opened AS (
      SELECT w, min(k) AS upto FROM (
        SELECT wilds.k, wilds.w FROM wilds JOIN ranked p ON p.next = wilds.k AND p.w = wilds.w JOIN lower ON l = p.t AND r = wilds.m
        UNION ALL SELECT wilds.k, wilds.w FROM wilds JOIN ranked p ON p.k = wilds.next AND p.next >> 32 = p.w JOIN lower ON l = wilds.m AND r = p.after
        UNION ALL SELECT k, w FROM wilds JOIN lower ON l = m AND r = m) GROUP BY w),
    free AS (SELECT k, next, m, lag(next, 1, -1) OVER (ORDER BY k) <> k AS apart FROM least LEFT JOIN opened USING (w) WHERE NOT waits OR upto IS NULL OR k <= upto),
    runs AS (SELECT k, next, m, sum(apart::INT) OVER (ORDER BY k) AS run FROM free),
    done AS MATERIALIZED (SELECT k, next, m FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY k) AS i FROM runs) WHERE i % 2 = 1)
    SELECT step + 1, ranked.k, coalesce(done.m, t)
    FROM ranked JOIN best USING (w) LEFT JOIN done ON done.k = ranked.k WHERE ranked.k NOT IN (SELECT next FROM done)))
SELECT w, k & 4294967295 AS p, t, last FROM state JOIN (SELECT k >> 32 AS w, max(step) AS last FROM state GROUP BY 1) ends ON k >> 32 = w AND step = last ORDER BY k
"""  #: a token's row has the key (number of its piece, position of its first byte in it)


_MASK = np.array([(1 << 8 * min(k, 8)) - 1 for k in range(9)], dtype=np.uint64)
_SHORT = 32  #: bytes of a span that are compared as numbers of eight bytes
_WORD = np.dtype([("part", "u8", _SHORT // 8), ("n", "i4"), ("size", "i4"), ("place", "i8")])


class _Cache:
    """Values of spans of bytes. Spans of up to _SHORT bytes are told apart by those bytes, taken as numbers, and their length, so a
    hash only says where to look; longer ones are keys of a dictionary. New spans lie in a small table beside the great one."""

    def __init__(self, kind):
        self.values = np.zeros(0, kind)
        self.keys = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]  # sorted: great, small
        self.rows = [np.zeros(0, _WORD), np.zeros(0, _WORD)]
        self.long: dict[bytes, np.ndarray] = {}
        self.held = 0  # bytes of the long spans and their values

    @property
    def words(self) -> int:
        return len(self.keys[0]) + len(self.keys[1]) + len(self.long)

    @property
    def bytes(self) -> int:
        return self.values.nbytes + self.held

    def _add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], rows[order]
        for level in (1, 0):
            at = np.searchsorted(self.keys[level], keys)
            keys, rows = np.insert(self.keys[level], at, keys), np.insert(self.rows[level], at, rows)
            self.keys[level], self.rows[level] = keys, rows
            if level == 0 or len(keys) < 65536:
                break
            self.keys[1], self.rows[1] = keys[:0].copy(), rows[:0].copy()

    def values_of(self, raw: np.ndarray, s: np.ndarray, e: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
        n = e - s
        padded = np.concatenate([raw, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(raw) + 1,), "<u8", padded, 0, (1,)).copy()  # the eight bytes from each place on
        parts = np.zeros((_SHORT // 8, len(s)), np.uint64)
        parts[0] = eight[s] & _MASK[np.minimum(n, 8)]
        hashes, more = C.mix(parts[0] + n.astype(np.uint64)), np.arange(len(s))
        for k in range(1, _SHORT // 8):
            more = more[n[more] > 8 * k]
            parts[k, more] = eight[s[more] + 8 * k] & _MASK[np.minimum(n[more] - 8 * k, 8)]
            hashes[more] = C.mix(hashes[more] ^ parts[k, more])
        codes, distinct = pd.factorize(hashes)
        rep = np.empty(len(distinct), np.int64)
        rep[codes[::-1]] = np.arange(len(s) - 1, -1, -1)
        row = np.zeros(len(distinct), _WORD)
        missing = np.arange(len(distinct))
        for keys, rows in zip(self.keys, self.rows, strict=True):
            if len(keys) and len(missing):
                k = np.minimum(np.searchsorted(keys, distinct[missing]), len(keys) - 1)
                found = keys[k] == distinct[missing]
                row[missing[found]] = rows[k[found]]
                missing = missing[~found]
        missing = missing[n[rep[missing]] <= _SHORT]
        if len(missing):
            at = rep[missing]
            size, new = make(at)
            own = np.zeros(len(at), _WORD)
            own["part"], own["n"], own["size"], own["place"] = parts[:, at].T, n[at], size, len(self.values) + np.cumsum(size) - size
            self.values = np.concatenate([self.values, new])
            row[missing] = own
            self._add(distinct[missing], own)
        place, size, values = row["place"][codes], row["size"].astype(np.int64)[codes], self.values
        unlike = (n > _SHORT) | (row["n"][codes] != n)
        for k in range(_SHORT // 8):
            unlike |= np.ascontiguousarray(row["part"][:, k])[codes] != parts[k]
        other = np.flatnonzero(unlike)
        if len(other):  # long ones, and short ones of a hash that another one has
            names = [raw[a:b].tobytes() for a, b in zip(s[other].tolist(), e[other].tolist(), strict=True)]
            unknown = {w: i for w, i in zip(names, other.tolist(), strict=True) if w not in self.long}
            if unknown:
                lengths, new = make(np.array(list(unknown.values())))
                for w, v in zip(unknown, np.split(new, np.cumsum(lengths)[:-1]), strict=True):
                    self.long[w] = v
                    self.held += len(w) + v.nbytes + 200
            number = {w: k for k, w in enumerate(dict.fromkeys(names))}
            found = [self.long[w] for w in number]
            width = np.array([len(v) for v in found])
            start = len(values) + np.cumsum(width) - width
            which = np.array([number[w] for w in names])
            place[other], size[other] = start[which], width[which]
            values = np.concatenate([values, *found])
        return _gather(values, place, size)


class Coder:
    """Encodes and decodes; one for a vocabulary and worker process."""

    def __init__(self, path: str):
        import duckdb

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        left, right, merged = [], [], []
        for t, r in ranks.items():
            for k in range(1, len(t)):
                a, b = ranks.get(t[:k]), ranks.get(t[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(r)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": "", "preserve_insertion_order": True})
        self._put("merges_in", l=np.array(left, np.int32), r=np.array(right, np.int32), m=np.array(merged, np.int32))
        # wild: a token that some pair of lower rank than its own has; lower: those pairs
        self.db.execute("CREATE TABLE merges AS SELECT *, m IN (SELECT r FROM merges_in WHERE m < r UNION SELECT l FROM merges_in WHERE m < l) AS wild FROM merges_in")
        self.db.execute("CREATE TABLE lower AS SELECT l, r FROM merges WHERE m < greatest(l, r)")
        self.joint = np.zeros((256, 256), dtype=bool)  # bytes that some token has side by side
        for t in ranks:
            own = np.frombuffer(t, np.uint8)
            self.joint[own[:-1], own[1:]] = True
        ids = np.array(list(ranks.values()), np.int32)
        self.db.register("vocab_in", pa.table({"id": ids, "s": [t.decode("latin-1") for t in ranks]}))
        self.db.execute("CREATE TABLE vocab AS SELECT * FROM vocab_in")
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.leads = np.zeros(int(ids.max()) + 1, dtype=bool)
        self.leads[[r for t, r in ranks.items() if t[:1] == b" "]] = True
        self.forget(0), self.forget(1)

    def _put(self, name: str, **columns: np.ndarray) -> None:
        self.db.register(name, pa.table(columns))

    def forget(self, which: int) -> None:
        """Empties cache 0 (words to ids) or 1 (pieces of ids to bytes)."""
        if not hasattr(self, "cache"):
            self.cache = [_Cache(np.int32), _Cache(np.uint8)]
        self.cache[which] = _Cache(np.int32 if which == 0 else np.uint8)

    def _known(self, which: int, raw: np.ndarray, s: np.ndarray, e: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
        """The values of the spans s to e of raw (bytes), and where each span's end. make(which spans) gives (lengths, values)."""
        c = self.cache[which]
        if c.words > CACHE_WORDS or c.bytes > CACHE_BYTES:
            self.forget(which)
            c = self.cache[which]
        return c.values_of(raw, s, e, make)

    def merge(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words: how many of each, and all in a row."""
        size = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(size)
        out, at = [], 0
        while at < len(found):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
            out.append(self._merge(b"".join(found[at:upto]), size[at:upto]))
            at = upto
        return np.concatenate([n for n, _ in out]), np.concatenate([t for _, t in out])

    def _merge(self, joined: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(joined, np.uint8)
        first = np.cumsum(size) - size
        cut = np.ones(len(raw), dtype=bool)
        cut[1:] = ~self.joint[raw[:-1], raw[1:]]
        cut[first] = True
        start = np.flatnonzero(cut)
        k = (np.cumsum(cut) - 1) << 32 | (np.arange(len(raw)) - np.repeat(start, np.diff(np.append(start, len(raw)))))
        t, pieces, ids = self.byte[raw], [], []
        while len(k):
            steps = int(min(STEPS, max(1, ROWS // len(k))))
            self._put("init", k=k, t=t)
            w, p, new, last = (np.asarray(v) for v in self.db.sql(_RECURSE.format(steps=steps)).fetchnumpy().values())
            done = last < steps
            pieces.append(w[done]), ids.append(new[done])
            k, t = w[~done] << 32 | p[~done], new[~done].astype(np.int32)
        w, ids = np.concatenate(pieces), np.concatenate(ids)
        order = np.argsort(w, kind="stable")
        per_piece = np.bincount(w, minlength=len(start))
        counts = np.add.reduceat(per_piece, np.searchsorted(start, first)) if len(size) else np.zeros(0, np.int64)
        return counts, ids[order].astype(np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's start (one more at the end)."""
        whole = "".join(texts)
        cp = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        off = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=off[1:])
        s = split_starts(cp, off)
        if not len(s):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        e = np.append(s[1:], len(cp))
        raw = np.frombuffer(whole.encode(), np.uint8)
        bs, be = (s, e) if len(raw) == len(cp) else (lambda at: (at[s], at[e]))(np.concatenate([[0], np.cumsum(1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000))]))
        ids, ends = self._known(0, raw, bs, be, lambda which: self.merge([raw[a:b].tobytes() for a, b in zip(bs[which].tolist(), be[which].tolist(), strict=True)]))
        return ids, np.concatenate([[0], ends])[np.searchsorted(s, off)]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[bytes]:
        """Bytes of each run of ids."""
        ids = np.ascontiguousarray(ids, dtype=np.int32)
        if not len(ids):
            return [b""] * (len(off) - 1)
        cut = self.leads[ids]
        cut[0] = True
        cut[off[off < len(ids)]] = True
        s = np.flatnonzero(cut)
        e = np.append(s[1:], len(ids))

        def make(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            a, n = s[which], (e - s)[which]
            row = np.repeat(np.arange(len(a)), n)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            self._put("tokens", w=row.astype(np.int32), p=pos.astype(np.int32), id=ids[np.repeat(a, n) + pos])
            got = self.db.sql("SELECT w, string_agg(s, '' ORDER BY p) AS s FROM tokens JOIN vocab USING (id) GROUP BY w ORDER BY w").to_arrow_table()
            out = [x.encode("latin-1") for x in got.column("s").to_pylist()]
            return np.fromiter(map(len, out), np.int64, len(out)), np.frombuffer(b"".join(out), np.uint8)

        raw, ends = self._known(1, ids.view(np.uint8), 4 * s, 4 * e, make)
        ends = np.concatenate([[0], ends])[np.searchsorted(s, off)]
        return [raw[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _gather(values: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(size)
    at = np.repeat(place - ends + size, size)
    at += np.arange(ends[-1])
    return values[at], ends


def coder(path: str) -> Coder:
    if ("coder", path) not in _WORKER:
        _WORKER["coder", path] = Coder(path)
    return _WORKER["coder", path]


def _strings(batch: pa.RecordBatch, column: str) -> list[str]:
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """docs with the column `ids` (array of int) of the whole texts."""
    C.ship(docs.sparkSession)
    path = path or default_ranks()

    def run(batches):
        for batch in batches:
            for part in C.text_chunks(batch, text, CHUNK):
                flat, off = coder(path).encode(_strings(part, text))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat, pa.int32()))], [*part.schema.names, ids])

    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """tokens with the column `out` (binary): the bytes of the ids."""
    C.ship(tokens.sparkSession)
    path = path or default_ranks()

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = [x or [] for x in part.column(part.schema.get_field_index(ids)).to_pylist()]
                off = np.cumsum([0, *map(len, lists)])
                flat = np.array([i for x in lists for i in x], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(coder(path).decode(flat, off), pa.binary())], [*part.schema.names, out])

    schema = T.StructType([*tokens.schema.fields, T.StructField(out, T.BinaryType())])
    return tokens.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what they decode to; ids don't leave the task."""
    C.ship(docs.sparkSession)
    path = path or default_ranks()

    def run(batches):
        for batch in batches:
            for part in C.text_chunks(batch, "text", CHUNK):
                c = coder(path)
                ids, off = c.encode(_strings(part, "text"))
                back = c.decode(ids, off)
                flat = ids.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(off), pa.int64()), pa.array([hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.string()), pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(C.load(spark, sf_dir, "documents"))
