"""Fill-in-middle transformation by secondary-sort assembly.

A text is cut at two keyed places into prefix, middle and suffix. Its output, with marks between the parts, is emitted as
pieces of a fixed number of code points, keyed by document and place in the output. ``repartition`` by document with
``sortWithinPartitions`` by document and place (the DataFrame form of ``repartitionAndSortWithinPartitions``) brings the
pieces of a document together in order, and they stream into an incremental digest. The same pass reads the parts back out
of the output alone, finding the marks wherever they fall, and emits them keyed by their place in the text; a second sort
inside the same partitions (no second shuffle) streams them into the digest of the restored text.

No step after the cut holds more of a text than a piece. Null texts are empty. An empty text, and one that holds a mark of
its own, stays plain. Rows that repeat an id are rows of their own, a null id is hashed as the empty string, an empty table
gives an empty result, other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wavelattice.llm.common import table, with_rows

#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"
PLAIN_FROM, SPM_BELOW = 90, 20
#: Code points of a piece, and of the pieces that leave a task in one batch.
PIECE_CHARS = 1 << 13
BATCH_CHARS = 1 << 21
#: Parts of an output in order, as (mark, rank of the part in the text).
_ORDER = {"plain": (("", 0),), "psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}
#: Places of a rank start here times the rank; no text is that long.
_RANK = 1 << 40


def with_cuts(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = SEED) -> DataFrame:
    """``_row, <key>, _text, n, form, _a, _b``: form and cut places of every document, from the hash of its id."""
    rows = with_rows(docs.select(key, text), key, text)
    whole = F.coalesce(F.col(text), F.lit(""))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)

    def word(i: int) -> Column:
        return F.conv(F.substring("_sha", 8 * i + 1, 8), 16, 10).cast("bigint")

    out = rows.select("_row", key, whole.alias("_text"), F.length(whole).cast("bigint").alias("n"), hashed.alias("_sha"))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("_text", F.lit(mark))
    one, two = word(0) % (F.col("n") + 1), word(1) % (F.col("n") + 1)
    form = (F.when((F.col("n") == 0) | marked | (word(2) % 100 >= PLAIN_FROM), "plain")
            .when(word(3) % 100 < SPM_BELOW, "spm").otherwise("psm"))
    return out.select("_row", key, "_text", "n", form.alias("form"), F.least(one, two).alias("_a"), F.greatest(one, two).alias("_b"))


def _batches(rows: Iterator[tuple], schema: pa.Schema, piece: int) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``BATCH_CHARS`` code points from row tuples."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += 64 + (len(row[piece]) if row[piece] else 0)
        if chars >= BATCH_CHARS:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def output_pieces(cuts: DataFrame, key: str = "doc_id", size: int = PIECE_CHARS) -> DataFrame:
    """``_row, place, piece, form, <key>, n, prefix_chars, middle_chars``: the output of every document in pieces.

    ``place`` counts the code points of the output before the piece. The last four columns are set on place 0 only; a
    document without any output has one empty piece there.
    """
    def run(batches):
        def rows():
            for row, ident, text, n, form, a, b in _tuples(batches):
                parts = {0: text[:a], 1: text[a:b], 2: text[b:]} if form != "plain" else {0: text}
                out = "".join(mark + parts[rank] for mark, rank in _ORDER[form])
                cut = (a, b - a) if form != "plain" else (None, None)
                for at in range(0, len(out) or 1, size):
                    yield (row, at, out[at:at + size], form, *((ident, n, *cut) if at == 0 else (None,) * 4))

        return _batches(rows(), schema, 2)

    kind = cuts.schema[key].dataType
    schema = pa.schema([("_row", pa.int64()), ("place", pa.int64()), ("piece", pa.string()), ("form", pa.string()),
                        (key, to_arrow_type(kind)), ("n", pa.int64()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])
    return cuts.mapInArrow(run, f"_row bigint, place bigint, piece string, form string, `{key}` {kind.simpleString()}, "
                                "n bigint, prefix_chars bigint, middle_chars bigint")


def in_order(pieces: DataFrame) -> DataFrame:
    """Pieces dealt by document and sorted by document and place."""
    return pieces.repartition(F.col("_row")).sortWithinPartitions("_row", "place")


def parts_of(form: str, pieces: Iterator[str]) -> Iterator[tuple[int, str]]:
    """``(place in the text, part of it)`` read from the pieces of an output; marks may lie across pieces."""
    order, step, held, seen = _ORDER[form], -1, "", 0
    marks = [mark for mark, _ in order if mark]
    if not marks:
        step = 0
    for piece in pieces:
        held += piece
        while step + 1 < len(marks):
            at = held.find(marks[step + 1])
            if at < 0:
                break
            if at:
                yield order[step][1] * _RANK + seen, held[:at]
            held, step, seen = held[at + len(marks[step + 1]):], step + 1, 0
        keep = 2 if step + 1 < len(marks) else 0  # the beginning of a mark may end the piece
        ready = held[:len(held) - keep]
        if ready:
            yield order[step][1] * _RANK + seen, ready
            held, seen = held[len(ready):], seen + len(ready)
    if held:
        yield order[step][1] * _RANK + seen, held


def _documents(rows: Iterator[tuple]) -> Iterator[Iterator[tuple]]:
    """Runs of equal first field, each as an iterator that must be used up before the next."""
    first = next(rows, None)
    while first is not None:
        following = []

        def run(head=first, following=following):
            yield head
            for row in rows:
                if row[0] != head[0]:
                    following.append(row)
                    return
                yield row

        yield run()
        first = following[0] if following else None


def read_back(sorted_pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document the digest row (place -1) and the parts of the text as read from its output (by place in the text).

    ``sorted_pieces`` come from :func:`in_order`; one piece of a document is held at a time.
    """
    def run(batches):
        def rows():
            for doc in _documents(_tuples(batches)):
                digest, head = hashlib.sha256(), next(doc)

                def streamed(head=head, doc=doc, digest=digest):
                    digest.update(head[2].encode())
                    yield head[2]
                    for r in doc:
                        digest.update(r[2].encode())
                        yield r[2]

                for place, part in parts_of(head[3], streamed()):
                    yield (head[0], place, part, None, None, None, None, None, None)
                yield (head[0], -1, None, head[3], *head[4:8], digest.hexdigest())

        return _batches(rows(), schema, 2)

    kind = sorted_pieces.schema[key].dataType
    fields = [(f.name, to_arrow_type(f.dataType)) for f in sorted_pieces.schema]
    schema = pa.schema([*fields, ("output_sha256", pa.string())])
    return sorted_pieces.mapInArrow(run, f"_row bigint, place bigint, piece string, form string, `{key}` {kind.simpleString()}, "
                                         "n bigint, prefix_chars bigint, middle_chars bigint, output_sha256 string")


def digests(parts: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document; its parts are resorted by place in the text and stream into ``restored_sha256``."""
    src = parts.sortWithinPartitions("_row", "place").select(
        "_row", "place", "piece", "form", key, "n", "prefix_chars", "middle_chars", "output_sha256")

    def run(batches):
        def rows():
            for doc in _documents(_tuples(batches)):
                head, digest = next(doc), hashlib.sha256()
                for r in doc:
                    digest.update(r[2].encode())
                yield (head[4], head[5], head[3], *head[6:9], digest.hexdigest())

        return _batches(rows(), schema, 2)

    kind = parts.schema[key].dataType
    schema = pa.schema([(key, to_arrow_type(kind)), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
    return src.mapInArrow(run, f"`{key}` {kind.simpleString()}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                               "output_sha256 string, restored_sha256 string")


def infilled(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = SEED, size: int = PIECE_CHARS) -> DataFrame:
    """``<key>, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` per document."""
    return digests(read_back(in_order(output_pieces(with_cuts(docs, key, text, seed), key, size)), key), key)


def query(spark, sf: str) -> DataFrame:
    return infilled(table(spark, sf, "documents"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
w AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM w),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
         ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
