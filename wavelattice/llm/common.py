"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wavelattice.session import cut_lineage, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a numpy kernel works on at a time; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder; shuffle files that only its lineage used can go afterwards."""
    out = cut_lineage(df)
    del df
    gc.collect()
    out.sparkSession._jvm.System.gc()
    return out


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows (or fewer, if the session asks for that) for the jobs that end within the block.

    A batch is built outside the heap and copied to the Python worker, so wide rows call for short batches.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_shuffles(spark: SparkSession) -> None:
    """Lets the shuffle files go that no frame in use refers to; the last execution lets go of its plan in the second collection."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.2)


def fresh_path(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, f"{label}-{os.getpid()}-{uuid.uuid4().hex[:8]}")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with as many underscores after it as it takes to be no column of ``df`` (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def crc_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id written as text (null id: of the empty string)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def keyed_fraction(key: Column, seed: str) -> Column:
    """Uniform number in [0, 1) of a key, the same in every run."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13),
                  16, 10).cast("double") / float(16 ** 13)


def with_rows(docs: DataFrame, key: str, text: str, into: str = "_row") -> DataFrame:
    """``docs`` with a unique bigint per row that orders rows by key (nulls first), then text.

    It is the key itself where keys are unique and not null. Otherwise the rows are sorted and written once.
    """
    out = docs.withColumn(into, F.col(key).cast("bigint"))
    again = out.groupBy(into).agg(F.count(F.lit(1)).alias("_n")).where(f"_n > 1 OR {into} IS NULL")
    if again.isEmpty():
        return out
    return settled(out.orderBy(F.col(into).asc_nulls_first(), text).withColumn(into, F.monotonically_increasing_id()))


def text_pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES):
    """``(batch slice, bytes, offsets)`` of at most ``limit`` bytes of text each, or one row; null texts are empty."""
    for batch in batches:
        col = pc.fill_null(batch.column(batch.schema.get_field_index(text)), "")
        if pa.types.is_large_string(col.type):
            kind = np.int64
        else:
            kind = np.int32
        n = len(col)
        if n == 0:
            continue
        _, off_buf, data_buf = col.buffers()
        offsets = np.frombuffer(off_buf, kind)[col.offset:col.offset + n + 1].astype(np.int64)
        data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            lo, hi = offsets[at], offsets[to]
            yield batch.slice(at, to - at), data[lo:hi], offsets[at:to + 1] - lo
            at = to


def rows_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def in_runs(batches: Iterator[pa.RecordBatch], key: str, limit: int) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``key`` from batches sorted by it, cut at the first run end past ``limit`` rows."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < limit:
            continue
        k = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(k, k[-1], side="left"))
        if cut == 0 and len(held) > 1 and _last(held[-2], key) == k[-1]:
            continue  # the run goes on
        head, tail = held[:-1] + ([batch.slice(0, cut)] if cut else []), batch.slice(cut)
        if head:
            yield pa.Table.from_batches(head)
        held, count = [tail], tail.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _last(batch: pa.RecordBatch, key: str):
    return batch.column(batch.schema.get_field_index(key))[-1].as_py()
