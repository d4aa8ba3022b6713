"""Reading wide measurement files and turning them into array-typed Parquet.

A file (or a directory of files) is one environment; environments are numbered by sorted name.
"""

from __future__ import annotations

import os
import re
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wavelattice import schema as S
from wavelattice.session import scratch_path


MAX_BROADCAST_FILES = 100_000  # about 20 MB of paths


def _base(path: str) -> str:
    return unquote(os.path.basename(urlparse(path).path))


def _plain_scheme(path: str) -> str:
    """The listing writes ``file:///x``, the row metadata may write ``file:/x``."""
    return re.sub("^file:/+", "file:/", path)


def _with_environment(rows: DataFrame, raw: DataFrame, by: str) -> DataFrame:
    """Number the environments in the order of their names.

    The names come from the file listing the reader already holds; no data is scanned. Rows find theirs by the path of
    their file, written the same way on both sides; a row whose file is not in the listing fails the job. The table of paths is
    broadcast, so the waves are not shuffled, unless the listing is very long.
    """
    files = raw.inputFiles()
    name = {f: _base(f) if by == "file" else _base(os.path.dirname(f)) for f in files}
    number = {n: i for i, n in enumerate(sorted(set(name.values())))}
    env = raw.sparkSession.createDataFrame([(_plain_scheme(f), number[name[f]]) for f in files], "_listed string, _env int")
    if len(files) <= MAX_BROADCAST_FILES:
        env = F.broadcast(env)
    own = F.regexp_replace("_file", F.lit("^file:/+"), F.lit("file:/"))
    unknown = F.raise_error(F.concat(F.lit("file is not in the listing: "), F.col("_file"))).cast("int")
    out = rows.join(env, own == F.col("_listed"), "left")
    return out.withColumn("ENV_ID", F.coalesce("_env", unknown)).drop("_listed", "_env")


def scan_csv(spark: SparkSession, path: str, wave_length: int = S.WAVE_LENGTH, recursive: bool = False,
             env_by: str = "file", on_error: str = "FAILFAST") -> DataFrame:
    """Measurement files below ``path`` with an explicit schema, ``ENV_ID`` and the wave as ``cir``.

    ``env_by`` is ``"file"`` (every CSV file is one environment) or ``"directory"`` (every folder of
    files is one). Nothing is inferred from the data. A file whose header differs from the schema fails the job, and so
    does a broken line, unless ``on_error`` is ``"PERMISSIVE"`` (nulls instead) or ``"DROPMALFORMED"``.
    """
    schema = S.raw_csv_schema(wave_length)
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", on_error).option("pathGlobFilter", "*.csv")
    raw = reader.option("recursiveFileLookup", "true" if recursive or env_by == "directory" else "false").csv(path)
    waves = F.array(*[F.col(c) for c in S.wave_columns(schema.names)])
    scalars = [c for c in schema.names if c not in set(S.wave_columns(schema.names))]
    rows = raw.select(*scalars, waves.alias("cir"), F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_at"))
    return _with_environment(rows, raw, env_by)


def load_dataset(spark: SparkSession, path: str, wave_length: int = S.WAVE_LENGTH, env_by: str = "file") -> DataFrame:
    """All measurements of a directory with ``ENV_ID``."""
    return scan_csv(spark, path, wave_length, env_by=env_by).drop("_file", "_block", "_at")


def load_recursive(spark: SparkSession, path: str, wave_length: int = S.WAVE_LENGTH) -> DataFrame:
    """All measurements of a directory tree, without environments."""
    return scan_csv(spark, path, wave_length, recursive=True).drop("_file", "_block", "_at", "ENV_ID")


def ingest_csv(spark: SparkSession, source: str, target: str, wave_length: int = S.WAVE_LENGTH,
               env_by: str = "file") -> None:
    """One-off conversion of CSV files to Parquet below ``target``.

    ``rows`` holds the data, partitioned by environment, with the position each row had while it
    was written; ``blocks`` holds one line per input split, from which :func:`read_measurements`
    computes a row number that depends on the files only.
    """
    raw = scan_csv(spark, source, wave_length, env_by=env_by)
    raw.write.mode("overwrite").partitionBy("ENV_ID").parquet(f"{target}/rows")
    written = spark.read.parquet(f"{target}/rows")
    blocks = written.groupBy("ENV_ID", "_file", "_block").agg(F.min("_at").alias("first_at"), F.count("*").alias("n"))
    inside = Window.partitionBy("ENV_ID").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    envs = blocks.groupBy(F.col("ENV_ID").alias("_e")).agg(F.sum("n").alias("env_n"))
    over = Window.orderBy("_e").rowsBetween(Window.unboundedPreceding, -1)  # one row per environment
    envs = envs.withColumn("env_before", F.coalesce(F.sum("env_n").over(over), F.lit(0)))
    placed = blocks.join(envs, F.col("ENV_ID") == F.col("_e"))
    placed.select("_file", "_block", "first_at", (F.col("before") + F.col("env_before")).alias("base")).write.mode(
        "overwrite").parquet(f"{target}/blocks")


def read_measurements(spark: SparkSession, target: str) -> DataFrame:
    """Ingested measurements with ``sample_id``: the row number over environments and files in order.

    Rows of one split were written in file order, so ``_at`` counts up by one inside it.
    """
    rows = spark.read.parquet(f"{target}/rows")
    blocks = spark.read.parquet(f"{target}/blocks").select(
        F.col("_file").alias("_f"), F.col("_block").alias("_b"), "first_at", "base")
    joined = rows.join(blocks, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    number = F.col("base") + F.col("_at") - F.col("first_at")
    return joined.select(number.alias("sample_id"), *[c for c in rows.columns if not c.startswith("_")])


def union_files(frames: list[DataFrame], env: str = "ENV_ID") -> DataFrame:
    """Frames stacked by column name, each tagged with its position in the list."""
    out = None
    for i, f in enumerate(frames):
        tagged = f.withColumn(env, F.lit(i))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def wide_waves(df: DataFrame, wave: str, length: int) -> DataFrame:
    """The wave array as numbered columns, the layout of the measurement files."""
    others = [c for c in df.columns if c != wave]
    return df.select(*others, *[F.col(wave)[i].alias(f"{S.WAVE_PREFIX}{i}") for i in range(length)])


def waves_from_columns(df: DataFrame, wave: str = "cir") -> DataFrame:
    """Numbered wave columns, picked by prefix, as one array column."""
    picked = S.wave_columns(df.columns)
    return df.select(*[c for c in df.columns if c not in set(picked)], F.array(*picked).alias(wave))


def fresh_csv_export(df: DataFrame, wave: str, length: int, env: str) -> str:
    """Write a table in the measurement layout, one directory per environment; returns the path."""
    path = scratch_path(df.sparkSession, "measurements")
    order = [c for c in S.raw_csv_schema(length).names]
    wide_waves(df, wave, length).select(*order, F.col(env).alias("env")).write.option("header", True).partitionBy(
        "env").csv(path)
    return path
