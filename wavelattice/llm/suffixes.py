"""Removal of repeated 100-byte strings by a difference cover: sampled triples, names, remaining suffixes, neighbours.

A removed byte needs equality of 100 bytes only, so the suffix order is built to that depth and not beyond:

1. *Sampled triples.* Places of a text are sampled where their remainder by 57 lies in a difference cover of eight. Any two
   equal windows of 100 bytes then hold sampled places at the same distance, with 44 equal bytes behind them (the core). A
   sample is a triple: 56 bytes before it, its core, 56 bytes after the core. The triples of all texts are sorted by the
   numbers of their core and of the whole triple, range by range. A core that is alone has no repeat and drops out.
2. *Names.* Equal triples get one name, that of the earliest. All windows around a later sample of a name are repeats. Depth 100
   is reached with this one step from cores to triples, so there is no further recursion. Names are numbers made by hashing:
   their order is not that of the bytes, which equality does not need.
3. *Remaining suffixes.* The first samples of names that share a core meet in one task. There their bytes are sorted
   as suffixes (from the core on) and as reversed prefixes (before the core), in byte order, and neighbours are compared for
   the length of their common prefix. A suffix that starts before the core is named by both: its bytes up to the core
   and those behind. Windows with equal names at the same start are repeats, except for the earliest.
4. *Removal.* Bytes covered by repeated windows go; the rest of each text is hashed.

Windows whose starts leave the same remainder meet at several samples; only the samples of remainder 0 work for them.
A core with very many different triples does not go to one task: its windows are grouped by their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wavelattice.llm.common import free_shuffles, fresh_path, in_runs, table, text_pieces, with_rows
from wavelattice.llm.tokens import U64, mix

WINDOW = 100
#: Every remainder by 57 is a difference of two of these (perfect difference set, fixed values).
PERIOD = 57
COVER = np.array([0, 1, 3, 13, 32, 36, 43, 52])
#: Bytes before a sample that a window holding it can reach, and bytes that such windows share from the sample on.
BEFORE = PERIOD - 1
CORE = WINDOW - BEFORE
CONTEXT = BEFORE + WINDOW
#: Samples that a task gathers before it sends them off.
FLUSH = 1 << 19
#: Contexts that are sorted at a time, and contexts of one core beyond which its windows are grouped by their bytes.
CHUNK, HOT = 1 << 12, 20_000
_SEGMENT = 1 << 19
_LUT = mix(np.arange(1, 258, dtype=U64) * U64(0x9E3779B97F4A7C15))
_ODD = [U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)]


# --- 1. sampled triples ------------------------------------------------------------------------------------------

def _doubled(a: np.ndarray, s: int) -> np.ndarray:
    out = a[:len(a) - s] * _ODD[0]
    out += a[s:]
    out ^= out >> U64(31)
    return out


def samples(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text index, offset, core number and triple number of the sampled places of some texts."""
    n_docs, size = len(offsets) - 1, np.diff(offsets)
    begin = offsets[:-1] + np.arange(1, n_docs + 1) * CONTEXT
    x = np.full(len(data) + (n_docs + 1) * CONTEXT, 256, np.uint16)  # padding that equals no byte
    x[np.arange(len(data)) + np.repeat(begin - offsets[:-1], size)] = data
    h = _LUT[x]
    for s in (1, 2, 4, 8, 16):
        h = _doubled(h, s)  # 32 bytes in the end
    room = np.where(size >= WINDOW, size - CORE + 1, 0)
    count = room // PERIOD * len(COVER) + np.searchsorted(COVER, room % PERIOD)
    doc = np.repeat(np.arange(n_docs), count)
    rank = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    off = rank // len(COVER) * PERIOD + COVER[rank % len(COVER)]
    at = begin[doc] + off
    core = h[at] * _ODD[1] + h[at + CORE - 32]
    core = mix(core ^ (core >> U64(29)))
    triple = core.copy()
    for lo in (-BEFORE, 32 - BEFORE, 8, 40, WINDOW - 32):
        triple = triple * _ODD[1] + h[at + lo]
        triple ^= triple >> U64(29)
    return doc, off, core, triple


def _segments(data: np.ndarray, offsets: np.ndarray):
    """The texts of a piece; a long one in overlapping parts. Yields data, offsets, shift and kept range.

    Shifts are multiples of the period, so places keep their remainders.
    """
    size = np.diff(offsets)
    if len(size) > 1 or size[0] <= _SEGMENT:
        yield data, offsets, 0, None
        return
    for lo in range(0, int(size[0]), _SEGMENT):
        a, b = max(0, lo - 2 * CONTEXT) // PERIOD * PERIOD, min(int(size[0]), lo + _SEGMENT + 2 * CONTEXT)
        yield data[a:b], np.array([0, b - a]), a, (lo, lo + _SEGMENT)


_DEALT = pa.schema([("bucket", pa.int32()), ("core", pa.binary()), ("triple", pa.binary()), ("row", pa.binary()), ("off", pa.binary()),
                    ("done", pa.bool_())])
_FOUND = pa.schema([("row", pa.int64()), ("off", pa.int64()), ("gram", pa.int64()), ("kind", pa.int8())])
DONE, EDGE, CROWDED = 0, 1, 2


def _planes(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on: planes of zeros compress to nothing."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(raw: bytes, dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _packed_places(row: np.ndarray, off: np.ndarray) -> tuple[bytes, bytes]:
    return _planes(np.diff(row, prepend=0)), _planes(off.astype(np.uint32))


def _places(row: bytes, off: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_unplanes(row, np.int64)), _unplanes(off, np.uint32).astype(np.int64)


def _sorted_triples(core: np.ndarray, triple: np.ndarray, row: np.ndarray, off: np.ndarray):
    """The samples in order of core, triple and place, flags where core and triple begin, and of repeats that count."""
    by_place = np.lexsort((off, row))
    order = by_place[np.argsort(core[by_place], kind="stable")]
    same = np.zeros(len(order), bool)
    same[1:] = core[order[1:]] == core[order[:-1]]
    same[:-1] |= same[1:]
    shared = order[same]  # triples only matter among equal cores
    order[same] = shared[np.lexsort((triple[shared], core[shared]))]
    core, triple, row, off = core[order], triple[order], row[order], off[order]
    new_core = np.ones(len(core), bool)
    new_core[1:] = core[1:] != core[:-1]
    new_triple = new_core.copy()
    new_triple[1:] |= triple[1:] != triple[:-1]
    first = np.maximum.accumulate(np.where(new_triple, np.arange(len(core)), 0))
    rest = off % PERIOD
    repeat = ~new_triple & ((rest != rest[first]) | (rest == 0))
    return core, triple, row, off, new_core, new_triple, repeat


def _dealt(batches, bits: int):
    held, size = [], 0

    def emit():
        core, triple, row, off, _, first, repeat = _sorted_triples(*(np.concatenate(c) for c in zip(*held)))
        cols = {f.name: [] for f in _DEALT}

        def add(*values):
            for name, value in zip(cols, values):
                cols[name].append(value)

        if repeat.any():  # repeats of an earlier place among the same texts need not travel by core
            r, o = row[repeat], off[repeat]
            by = np.lexsort((o, r))
            add(int(r[0] % (1 << bits)), b"", b"", *_packed_places(r[by], o[by]), True)
        core, triple, row, off = core[first], triple[first], row[first], off[first]
        bucket = (core >> U64(64 - bits)).astype(np.int64)
        by = np.lexsort((off, row, bucket))  # differences of sorted rows compress well
        bucket, core, triple, row, off = bucket[by], core[by], triple[by], row[by], off[by]
        cut = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        for b in np.flatnonzero(np.diff(cut)):
            i, j = cut[b], cut[b + 1]
            # 32 bits within a bucket: cores that share them by chance cost a comparison, not a row
            add(int(b), core[i:j].astype(np.uint32).tobytes(), triple[i:j].tobytes(), *_packed_places(row[i:j], off[i:j]), False)
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in _DEALT], schema=_DEALT)

    for part, data, offsets in text_pieces(batches, "_t", _SEGMENT):
        rows = part.column(0).to_numpy()
        for some, offs, shift, kept in _segments(data, offsets):
            doc, off, core, triple = samples(some, offs)
            off = off + shift
            if kept is not None:
                ok = (off >= kept[0]) & (off < kept[1])
                doc, off, core, triple = doc[ok], off[ok], core[ok], triple[ok]
            held.append((core, triple, rows[doc], off))
            size += len(off)
            if size >= FLUSH:
                yield emit()
                held, size = [], 0
    if size:
        yield emit()


# --- 2. names ----------------------------------------------------------------------------------------------------

def _named(batches, hot: int):
    """Later samples of equal triples, and the first ones of triples that share a core with others."""
    for t in in_runs(batches, "bucket", 1):
        cols = t.to_pydict()
        parts, bucket = [], cols["bucket"][0]
        for core, triple, row, off, done in zip(*(cols[n] for n in ("core", "triple", "row", "off", "done"))):
            row, off = _places(row, off)
            if done:
                yield _found(row, off, np.zeros(len(row), np.int64), DONE)
            else:
                parts.append((np.frombuffer(core, np.uint32), np.frombuffer(triple, U64), row, off))
        del cols, t
        if not parts:
            continue
        core, _, row, off, new_core, first, repeat = _sorted_triples(*(np.concatenate(c) for c in zip(*parts)))
        yield _found(row[repeat], off[repeat], np.zeros(int(repeat.sum()), np.int64), DONE)
        core, row, off = core[first], row[first], off[first]
        start = np.flatnonzero(new_core[first])
        count = np.diff(np.append(start, len(core)))
        rest = off % PERIOD
        least, most = np.minimum.reduceat(rest, start), np.maximum.reduceat(rest, start)
        # windows of equal remainders also meet at their samples of remainder 0
        edge = np.repeat((count > 1) & ((least != most) | (least == 0)), count)
        kind = np.where(np.repeat(count, count)[edge] > hot, CROWDED, EDGE)
        yield _found(row[edge], off[edge], (np.int64(bucket) << np.int64(32)) | core[edge].astype(np.int64), kind)


def _found(row, off, gram, kind) -> pa.RecordBatch:
    kind = np.broadcast_to(np.asarray(kind, np.int8), (len(row),))
    return pa.RecordBatch.from_arrays([pa.array(row), pa.array(off), pa.array(gram), pa.array(np.ascontiguousarray(kind))], schema=_FOUND)


# --- 3. remaining suffixes ---------------------------------------------------------------------------------------

def _neighbours(group: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte order of strings of equal width by group, and the bytes that each shares with the one before (-1: none)."""
    width = strings.shape[1]
    keyed = np.empty((len(strings), 8 + width), np.uint8)
    keyed[:, :8] = group.astype(">i8").view(np.uint8).reshape(-1, 8)
    keyed[:, 8:] = strings
    order = np.argsort(keyed.view(f"V{8 + width}").ravel(), kind="stable")
    keyed = keyed[order]
    unlike = np.ones((len(order), 9 + width), bool)
    unlike[1:, :-1] = keyed[1:] != keyed[:-1]
    shared = np.argmax(unlike, axis=1) - 8
    shared[0] = -1
    return order, np.maximum(shared, -1)


def repeats(texts: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Flags of the windows (context, start) that an earlier context of the same group has at the same start.

    ``texts`` are contexts of equal width in order of their places, ``low`` and ``high`` the first and last start of a
    window that lies within its text.
    """
    m = len(texts)
    out = np.zeros((m, BEFORE + 1), bool)
    if m == 0:
        return out
    behind, shared = _neighbours(group, texts[:, BEFORE:])
    before, shared_back = _neighbours(group, texts[:, :BEFORE][:, ::-1])
    name = np.empty((2, m), np.int64)
    for start in range(BEFORE + 1):
        # strings of a length that share it with their neighbours are equal
        name[0, behind] = np.cumsum(shared < start + CORE)
        name[1, before] = np.cumsum(shared_back < BEFORE - start)
        at = np.flatnonzero((low <= start) & (start <= high))
        key = (name[0, at] << 32) | name[1, at]
        order = np.argsort(key, kind="stable")
        again = key[order[1:]] == key[order[:-1]]
        out[at[order[1:][again]], start] = True
    return out


_CONTEXTS = "gram bigint, row bigint, off bigint, room bigint, bytes binary"


def _binary(strings: np.ndarray) -> pa.Array:
    """Rows of a matrix of bytes."""
    n, width = strings.shape
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(strings))])


def _contexts(batches):
    """The bytes around every sample of ``_row, _t, at`` (offsets and cores), with the size of its text."""
    cols = np.arange(CONTEXT)

    def sent(held):
        gram, row, off, room, piece = (np.concatenate(c) for c in zip(*held))
        return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(row), pa.array(off), pa.array(room), _binary(piece)],
                                          names=["gram", "row", "off", "room", "bytes"])

    for batch in batches:
        held, size = [], 0
        for row, text, at in zip(*(batch.column(i) for i in range(3))):
            raw = np.frombuffer(text.as_py().encode(), np.uint8)
            offs, grams = (at.values.field(n).to_numpy() for n in ("off", "gram"))
            padded = np.zeros(len(raw) + CONTEXT, np.uint8)
            padded[BEFORE:BEFORE + len(raw)] = raw
            for i in range(0, len(offs), 10_000):
                off = offs[i:i + 10_000]
                held.append((grams[i:i + 10_000], np.full(len(off), row.as_py()), off, np.full(len(off), len(raw)), padded[off[:, None] + cols]))
                size += len(off)
                if size >= 20_000:
                    yield sent(held)
                    held, size = [], 0
        if held:
            yield sent(held)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, CONTEXT)


_RUNS = "row bigint, lo bigint, hi bigint"


def _merged(batches):
    """Runs of starts of repeated windows, from contexts that come core by core."""
    for t in in_runs(batches, "gram", CHUNK):
        gram, row, off, room = (t.column(n).to_numpy() for n in ("gram", "row", "off", "room"))
        order = np.lexsort((off, row))
        texts = _matrix(t.column("bytes"))[order]
        gram, row, off, room = gram[order], row[order], off[order], room[order]
        group = np.unique(gram, return_inverse=True)[1]
        flags = repeats(texts, group, np.maximum(0, BEFORE - off), np.minimum(BEFORE, room - WINDOW - off + BEFORE))
        edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        who, lo = np.nonzero(edge == 1)
        _, hi = np.nonzero(edge == -1)
        base = off[who] - BEFORE
        yield pa.RecordBatch.from_arrays([pa.array(row[who]), pa.array(base + lo), pa.array(base + hi - 1)], names=["row", "lo", "hi"])


def _windows(batches):
    """Every window of the contexts of crowded cores."""
    for batch in batches:
        t = pa.Table.from_batches([batch])
        texts = _matrix(t.column("bytes"))
        row, off, room = (t.column(n).to_numpy() for n in ("row", "off", "room"))
        for j in range(BEFORE + 1):
            start = off - BEFORE + j
            ok = np.flatnonzero((start >= 0) & (start + WINDOW <= room))
            yield pa.RecordBatch.from_arrays([_binary(texts[ok, j:j + WINDOW]), pa.array(row[ok]), pa.array(start[ok])],
                                             names=["w", "row", "start"])


def _crowded_runs(contexts: DataFrame) -> DataFrame:
    w = contexts.mapInArrow(_windows, "w binary, row bigint, start bigint")
    first = w.groupBy("w").agg(F.min(F.struct("row", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = w.join(first, "w").where(F.struct("row", "start") != F.col("first"))
    return again.select("row", F.col("start").alias("lo"), F.col("start").alias("hi"))


# --- 4. removal --------------------------------------------------------------------------------------------------

def spans_of(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Maximal byte runs covered by windows that start in the given ranges, as rows of start and end."""
    order = np.argsort(lo, kind="stable")
    lo, end = lo[order], np.maximum.accumulate(hi[order] + WINDOW)
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > end[:-1]
    first = np.flatnonzero(new)
    return np.stack([lo[first], end[np.append(first[1:], len(lo)) - 1]], axis=1) if len(lo) else np.zeros((0, 2), np.int64)


def _removed(batches):
    for batch in batches:
        out = ([], [], [], [], [])
        for row, text, runs in zip(*(batch.column(i) for i in range(3))):
            raw, spans = text.as_py().encode(), np.zeros((0, 2), np.int64)
            if runs.is_valid:
                lo, hi = runs.values.field("lo").to_numpy(), runs.values.field("hi").to_numpy()
                spans = spans_of(np.maximum(lo, 0), np.minimum(hi, len(raw) - WINDOW))
            kept, at = hashlib.sha256(), 0
            for a, b in spans.tolist():
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            for col, value in zip(out, (row.as_py(), len(raw), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest())):
                col.append(value)
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.string())],
                                         names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _write_named(rows: DataFrame, parts: int, bits: int, hot: int, path: str) -> None:
    dealt = rows.mapInArrow(lambda b: _dealt(b, bits), "bucket int, core binary, triple binary, row binary, off binary, done boolean")
    dealt.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(
        lambda b: _named(b, hot), "row bigint, off bigint, gram bigint, kind tinyint").write.parquet(path)


def repeated_runs(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """``row, lo, hi``: ranges of starts of windows that also start earlier, from ``_row`` (unique, in order) and ``_t``."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    finer = 4 * parts  # samples take up to twice the room of their texts
    path = fresh_path(spark, "samples")
    _write_named(rows, finer, max(6, min(20, (finer - 1).bit_length())), hot, path)
    free_shuffles(spark)
    found = spark.read.parquet(path)
    whole = found.where(F.col("kind") == DONE).select("row", (F.col("off") - BEFORE).alias("lo"), F.col("off").alias("hi"))

    def contexts(kind: int) -> DataFrame:
        at = found.where(F.col("kind") == kind).groupBy("row").agg(F.collect_list(F.struct("off", "gram")).alias("at"))
        return rows.join(at, F.col("_row") == F.col("row")).select("_row", "_t", "at").mapInArrow(_contexts, _CONTEXTS)

    edges = contexts(EDGE).repartition(parts, "gram").sortWithinPartitions("gram").mapInArrow(_merged, _RUNS)
    runs = whole.unionByName(edges)
    if not found.where(F.col("kind") == CROWDED).isEmpty():
        runs = runs.unionByName(_crowded_runs(contexts(CROWDED)))
    return runs


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` for every row.

    Texts are UTF-8; null texts are empty, and texts under 100 bytes keep everything. Keys are integers. Where keys repeat or
    are null, rows are ordered by key (nulls first) and text, and of equal rows all but one are repeats. An empty table
    gives an empty result. Other columns are not read.
    """
    src = with_rows(docs.select(F.col(key).cast("bigint").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_t")), "_key", "_t")
    names = src.select(F.col("_row").alias("row"), F.col("_key").alias(key))
    src = src.select(F.coalesce("_row", F.lit(0)).alias("_row"), "_t")  # never null, so that both joins read one shuffle
    runs = repeated_runs(src, hot).groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    out = src.join(runs, F.col("_row") == F.col("row"), "left").select("_row", "_t", "runs").mapInArrow(
        _removed, "row bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return out.join(names, "row").select(key, "n_bytes", "n_removed", "n_spans", "kept_sha256")


def query(spark, sf: str) -> DataFrame:
    return remove_repeats(table(spark, sf, "documents"))


SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
w AS (SELECT doc_id, i, b[i + 1:i + 100] AS x FROM (SELECT doc_id, b, unnest(range(n - 99)) AS i FROM d WHERE n >= 100)),
r AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, i) > 1),
f AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER o + 100 THEN 0 ELSE 1 END AS fresh FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM f),
c AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS z FROM g GROUP BY doc_id, run),
k AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM c
      UNION ALL SELECT d.doc_id, coalesce(max(c.z), 0), any_value(d.n) FROM d LEFT JOIN c ON c.doc_id = d.doc_id GROUP BY d.doc_id),
h AS (SELECT k.doc_id, string_agg(hex(b[k.a + 1:k.z]), '' ORDER BY k.a) AS kept FROM k JOIN d ON d.doc_id = k.doc_id WHERE k.a < k.z GROUP BY k.doc_id),
m AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans FROM c GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN m ON m.doc_id = d.doc_id LEFT JOIN h ON h.doc_id = d.doc_id
"""
