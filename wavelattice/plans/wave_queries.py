"""Queries over measurements: sources, cleaning, waves, paths and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wavelattice import schema as S
from wavelattice.functions import waves as W
from wavelattice.functions import wavescan
from wavelattice.functions.scalars import rounded as r, zero_guarded_ratio
from wavelattice.operators import augment, cleaning, paths, profiling, splits
from wavelattice.plans import views as V
from wavelattice.plans.registry import query
from wavelattice.plans.views import rnd
from wavelattice.session import scratch_path
from wavelattice.sources import measurements as M
from wavelattice.sources.sinks import sink_table
from wavelattice.streaming.features import stream_features

def _digest(df: DataFrame, wave, *keys: str) -> DataFrame:
    """A wave per row as two checkable numbers: its size and its position-weighted sum."""
    weighted = F.aggregate(F.zip_with(wave, F.sequence(F.lit(1), F.size(wave)), lambda x, i: x * i),
                           F.lit(0.0), lambda a, x: a + x)
    return df.select(*keys, F.size(wave).cast("long").alias("n"), r(weighted, 4).alias("wsum"))


def _digest_sql(source: str, *keys: str, x: str = "x") -> str:
    k = ", ".join(keys)
    return f"SELECT {k}, count(*) AS n, {rnd(f'sum({x} * (i + 1))', 4)} AS wsum FROM {source} GROUP BY {k}"


# --- sources -------------------------------------------------------------------------------------

_PER_ENV = f"""SELECT dense_rank() OVER (ORDER BY env_id) - 1 AS env, count(*) AS n, sum(nlos)::BIGINT AS n_nlos,
  {rnd('sum(fp_amp1)', 4)} AS amp, {rnd('sum(list_sum(cir))', 2)} AS wave_sum FROM sig GROUP BY env_id"""


def _per_env(df: DataFrame, env: str = "ENV_ID") -> DataFrame:
    total = F.aggregate("cir", F.lit(0.0), lambda a, x: a + x)
    return df.groupBy(F.col(env).cast("long").alias("env")).agg(
        F.count("*").alias("n"), F.sum("NLOS").cast("long").alias("n_nlos"), r(F.sum("FP_AMP1"), 4).alias("amp"),
        r(F.sum(total), 2).alias("wave_sum"))


@query("scan_csv_dir", f"WITH {V.SIG} {_PER_ENV}")
def _(spark, sf):
    path = M.fresh_csv_export(V.sig(spark, sf), "cir", V.WAVE_LENGTH, "env_id")
    return _per_env(M.load_dataset(spark, path, V.WAVE_LENGTH, env_by="directory"))


@query("scan_csv_recursive", f"""WITH {V.SIG} SELECT count(*) AS n, sum(nlos)::BIGINT AS n_nlos,
  {rnd('sum(list_sum(cir))', 2)} AS wave_sum FROM sig""")
def _(spark, sf):
    path = M.fresh_csv_export(V.sig(spark, sf), "cir", V.WAVE_LENGTH, "env_id")
    rows = M.load_recursive(spark, path, V.WAVE_LENGTH)
    total = F.aggregate("cir", F.lit(0.0), lambda a, x: a + x)
    return rows.agg(F.count("*").alias("n"), F.sum("NLOS").cast("long").alias("n_nlos"), r(F.sum(total), 2).alias("wave_sum"))


@query("ingest_sample_ids", """SELECT count(*) AS n, count(*) AS n_ids, 0::BIGINT AS first_id,
  count(*) - 1 AS last_id FROM embeddings""")
def _(spark, sf):
    path = M.fresh_csv_export(V.sig(spark, sf), "cir", V.WAVE_LENGTH, "env_id")
    target = scratch_path(spark, "ingested")
    M.ingest_csv(spark, path, target, V.WAVE_LENGTH, env_by="directory")
    return M.read_measurements(spark, target).agg(
        F.count("*").alias("n"), F.countDistinct("sample_id").alias("n_ids"), F.min("sample_id").alias("first_id"),
        F.max("sample_id").alias("last_id"))


@query("union_files_env_id", """WITH u AS (
  SELECT 0 AS env, p_retailprice AS price FROM part UNION ALL SELECT 1, c_acctbal FROM customer
  UNION ALL SELECT 2, s_acctbal FROM supplier)
  SELECT env::INTEGER AS "ENV_ID", count(*) AS n, round(sum(price)::DOUBLE, 2) AS total FROM u GROUP BY env""")
def _(spark, sf):
    sources = [("part", "p_retailprice"), ("customer", "c_acctbal"), ("supplier", "s_acctbal")]
    frames = [V.table(spark, sf, t).select(F.col(c).alias("price")) for t, c in sources]
    return M.union_files(frames).groupBy("ENV_ID").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("total"))


@query("dataset_profile", f"""WITH {V.SIG} SELECT count(*) AS n_rows, count_if(nlos = 0)::BIGINT AS n_los,
  count_if(nlos = 1)::BIGINT AS n_nlos, count(DISTINCT env_id) AS n_envs, max(env_id)::INTEGER AS max_env FROM sig""")
def _(spark, sf):
    return profiling.dataset_profile(V.sig(spark, sf), "NLOS", "env_id")


@query("sink_table", f"""WITH {V.SIG} SELECT 'measured' AS stage, nlos AS label, count(*) AS n FROM sig GROUP BY nlos""")
def _(spark, sf):
    folder = scratch_path(spark, "figures")
    out = sink_table(profiling.class_distribution(V.sig(spark, sf), "NLOS", "measured"), folder, "class_distribution")
    return spark.read.parquet(out)


# --- cleaning ------------------------------------------------------------------------------------

@query("null_census", "WITH " + V.SCAL + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing FROM scal" for c in V.SCALAR_COLUMNS))
def _(spark, sf):
    return cleaning.null_census(V.scal(spark, sf), V.SCALAR_COLUMNS)


@query("median_impute", "WITH " + V.SCAL + ", m AS (SELECT " + ", ".join(
    f"median({c}) AS m_{c}" for c in V.SCALAR_COLUMNS) + " FROM scal) SELECT flag, " + ", ".join(
    f"{rnd(f'sum(coalesce({c}, m_{c}))', 2)} AS {c}" for c in V.SCALAR_COLUMNS) + " FROM scal, m GROUP BY flag")
def _(spark, sf):
    filled = cleaning.median_impute(V.scal(spark, sf), V.SCALAR_COLUMNS)
    return filled.groupBy("flag").agg(*[r(F.sum(c), 2).alias(c) for c in V.SCALAR_COLUMNS])


@query("exact_quantiles", "WITH " + V.SCAL + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS prob, {rnd(f'quantile_cont({c}, {p})')} AS q_value FROM scal"
    for c in V.SCALAR_COLUMNS for p in (0.1, 0.25, 0.5, 0.75, 0.9)))
def _(spark, sf):
    from wavelattice.operators.quantiles import exact_quantiles
    q = exact_quantiles(V.scal(spark, sf), V.SCALAR_COLUMNS, [0.1, 0.25, 0.5, 0.75, 0.9])
    return q.select("column", "prob", r(F.col("q_value")).alias("q_value"))


@query("drop_degenerate", f"WITH {V.CLEAN} SELECT sample_id, env_id::INTEGER AS env_id, nlos FROM clean")
def _(spark, sf):
    return cleaning.drop_degenerate(V.sig(spark, sf)).select("sample_id", "env_id", F.col("NLOS").alias("nlos"))


@query("dropped_count_report", f"""WITH {V.SIG} SELECT count(*) AS n_rows,
  count_if(range_m0 = 0 OR cir_pwr = 0 OR rxpacc = 0)::BIGINT AS n_removed, count_if(range_m0 = 0)::BIGINT AS n_zero_RANGE,
  count_if(cir_pwr = 0)::BIGINT AS n_zero_CIR_PWR, count_if(rxpacc = 0)::BIGINT AS n_zero_RXPACC FROM sig""")
def _(spark, sf):
    return cleaning.degenerate_report(V.sig(spark, sf))


_CANDIDATES = ["CH", "BITRATE", "PRFR", "FRAME_LEN", "PREAM_LEN", "RXPACC"]


@query("drop_constant_cols", f"WITH {V.SIG} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (min({c}) = max({c}))::INTEGER AS is_constant FROM sig" for c in _CANDIDATES))
def _(spark, sf):
    return cleaning.constant_columns(V.sig(spark, sf), _CANDIDATES)


@query("near_constant_flag", f"WITH {V.SIG}, c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS v, count(*) AS n FROM sig GROUP BY {c}"
    for c in ("FRAME_LEN", "PREAM_LEN", "RXPACC")) + f""")
  SELECT "column", v AS mode, {rnd('100.0 * n / tot')} AS mode_pct, (100.0 * n / tot > 90)::INTEGER AS near_constant FROM (
    SELECT *, sum(n) OVER (PARTITION BY "column") AS tot,
           row_number() OVER (PARTITION BY "column" ORDER BY n DESC, v) AS rn FROM c) WHERE rn = 1""")
def _(spark, sf):
    out = cleaning.near_constant(V.sig(spark, sf), ["FRAME_LEN", "PREAM_LEN", "RXPACC"])
    return out.withColumn("mode_pct", r(F.col("mode_pct")))


@query("wave_normalize", f"WITH {V.CLEAN} " + _digest_sql("wave", "sample_id"))
def _(spark, sf):
    return _digest(V.clean(spark, sf), F.col("cir"), "sample_id")


@query("nan_inf_to_zero", f"""WITH {V.SIG}, w AS (SELECT sample_id, unnest(range({V.WAVE_LENGTH})) AS i, rxpacc,
    unnest(cir) AS x FROM sig)
  SELECT sample_id, count_if(rxpacc = 0)::BIGINT AS n_inf,
         {rnd('sum(CASE WHEN rxpacc = 0 THEN 0 ELSE x / rxpacc END * (i + 1))', 4)} AS wsum FROM w GROUP BY sample_id""")
def _(spark, sf):
    divided = V.sig(spark, sf).withColumn("cir", F.transform("cir", lambda x: F.when(
        F.col("RXPACC") == 0, F.lit(float("inf"))).otherwise(F.try_divide(x, F.col("RXPACC")))))
    counted = divided.withColumn("n_inf", W.nonfinite_counts(F.col("cir"))["inf"].cast("long"))
    return _digest(counted, W.finite_or_zero(F.col("cir")), "sample_id", "n_inf").drop("n")


@query("select_by_prefix", f"WITH {V.SIG}, w AS (SELECT sample_id, unnest(range({V.WAVE_LENGTH})) AS i, "
                           f"unnest(cir) AS x FROM sig) " + _digest_sql("w", "sample_id"))
def _(spark, sf):
    wide = M.wide_waves(V.sig(spark, sf).select("sample_id", "CIR_PWR", "cir"), "cir", V.WAVE_LENGTH)
    return _digest(M.waves_from_columns(wide), F.col("cir"), "sample_id")


@query("take_n_per_class", f"""WITH {V.CLEAN} SELECT sample_id, nlos, rn AS rank FROM (
  SELECT sample_id, nlos, row_number() OVER (PARTITION BY nlos ORDER BY sample_id) AS rn FROM clean) WHERE rn <= 4""")
def _(spark, sf):
    rows = V.clean(spark, sf).select("sample_id", F.col("NLOS").alias("nlos"))
    return profiling.first_per_class(rows, "nlos", "sample_id", 4).withColumn("rank", F.col("rank").cast("long"))


# --- waves ---------------------------------------------------------------------------------------

@query("window_argmax_peak", f"WITH {V.PATH1} SELECT sample_id, idx, {rnd('amp')} AS amp FROM path1")
def _(spark, sf):
    p = V.clean(spark, sf).select("sample_id", W.argmax_near(F.col("cir"), F.col("FP_IDX").cast("int")).alias("p"))
    return p.select("sample_id", "p.idx", r(F.col("p.amp")).alias("amp"))


@query("moving_average3", f"WITH {V.SMOOTH} " + _digest_sql("smooth", "sample_id", x="s"))
def _(spark, sf):
    return _digest(V.clean(spark, sf).withColumn("s", W.moving_average3(F.col("cir"))), F.col("s"), "sample_id")


_QUANTIZED = f"""{V.CLEAN}, steps AS (SELECT sample_id, i, floor(x / 4)::DOUBLE AS q FROM wave)"""


@query("local_maxima", f"WITH {_QUANTIZED}, " + V.maxima_sql("steps", "q", "top") +
       " SELECT sample_id, count(*) AS n_peaks, sum(idx)::BIGINT AS idx_sum, min(idx) AS first_idx, max(idx) AS last_idx "
       "FROM top GROUP BY sample_id")
def _(spark, sf):
    flat = V.clean(spark, sf).select("sample_id", F.transform("cir", lambda x: F.floor(x / 4).cast("double")).alias("q"))
    p = flat.select("sample_id", W.local_maxima(F.col("q")).alias("p")).filter(F.size("p") > 0)
    return p.select("sample_id", F.size("p").cast("long").alias("n_peaks"),
                    F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x).alias("idx_sum"),
                    F.array_min("p").alias("first_idx"), F.array_max("p").alias("last_idx"))


def _peaks(spark, sf) -> DataFrame:
    rows = V.clean(spark, sf)
    rows = rows.withColumn("p1", W.argmax_near(F.col("cir"), F.col("FP_IDX").cast("int")))
    bar = F.when(F.col("p1.amp") > 0, F.col("p1.amp") * S.PEAK_FRACTION).otherwise(F.lit(float("inf")))
    found = wavescan.find_peaks(W.moving_average3(F.col("cir")), bar, S.PEAK_DISTANCE, bar)
    return rows.select("sample_id", found.alias("ks")).select("sample_id", F.explode("ks").alias("k")).select("sample_id", "k.idx", "k.prominence")


@query("find_peaks", f"WITH RECURSIVE {V.SECOND} SELECT sample_id, idx FROM peaks")
def _(spark, sf):
    return _peaks(spark, sf).select("sample_id", "idx")


@query("peak_prominence", f"WITH RECURSIVE {V.SECOND} SELECT sample_id, idx, {rnd('prominence')} AS prominence FROM peaks")
def _(spark, sf):
    return _peaks(spark, sf).withColumn("prominence", r(F.col("prominence")))


@query("second_path", f"WITH RECURSIVE {V.SECOND} SELECT sample_id, idx, {rnd('amp')} AS amp FROM path2")
def _(spark, sf):
    return paths.with_paths(V.clean(spark, sf)).select("sample_id", "path2.idx", r(F.col("path2.amp")).alias("amp"))


@query("detection_rate", f"""WITH RECURSIVE {V.SECOND} SELECT count_if(amp > 0)::BIGINT AS n_found, count(*) AS n_samples,
  {rnd('100.0 * avg((amp > 0)::INTEGER)')} AS pct_found FROM path2""")
def _(spark, sf):
    return paths.detection_rate(paths.with_paths(V.clean(spark, sf))).withColumn("pct_found", r(F.col("pct_found")))


def _at_first_path(name: str, fn, sql: str) -> None:
    """Register an operator evaluated at the first path of every measurement."""
    @query(name, f"WITH {V.PATH1}, near AS (SELECT p.sample_id, p.idx, p.amp, w.i, w.x FROM path1 p JOIN wave w "
                 f"ON w.sample_id = p.sample_id AND w.i BETWEEN p.idx - 15 AND p.idx + 15) {sql}")
    def _(spark, sf):
        p = V.clean(spark, sf).withColumn("p", W.argmax_near(F.col("cir"), F.col("FP_IDX").cast("int")))
        return p.select("sample_id", r(fn(F.col("cir"), F.col("p.idx"), F.col("p.amp"))).alias("v"))


_at_first_path("rise_time", W.rise_time, f"""SELECT sample_id,
  {rnd('idx - coalesce(max(CASE WHEN i <= idx AND x < 0.1::DOUBLE * amp THEN i END), min(i) - 1)')} AS v
  FROM near GROUP BY sample_id, idx""")
_at_first_path("decay_time", W.decay_time, f"""SELECT sample_id,
  {rnd('coalesce(min(CASE WHEN i >= idx AND x < 0.1::DOUBLE * amp THEN i END), max(i) + 1) - idx')} AS v
  FROM near GROUP BY sample_id, idx""")
_at_first_path("kurtosis_local", lambda w, i, a: W.local_kurtosis(w, i),
               f"SELECT sample_id, {rnd('kurtosis_pop(x)')} AS v FROM near GROUP BY sample_id")
_at_first_path("energy_ratio", lambda w, i, a: W.energy_ratio(w, i), f"""SELECT n.sample_id, {rnd('n.e / t.e')} AS v
  FROM (SELECT sample_id, sum(x * x) AS e FROM near GROUP BY sample_id) n
  JOIN (SELECT sample_id, sum(x * x) AS e FROM wave GROUP BY sample_id) t ON n.sample_id = t.sample_id""")
_at_first_path("tail_energy_ratio", lambda w, i, a: W.tail_energy_ratio(w, i), f"""SELECT w.sample_id,
  {rnd('sum(CASE WHEN w.i >= p.idx THEN w.x * w.x ELSE 0 END) / sum(w.x * w.x)')} AS v
  FROM wave w JOIN path1 p ON p.sample_id = w.sample_id GROUP BY w.sample_id""")
def _weighted(part):
    """The values of a stretch, each one more than it is, weighted by their places: its size and its values change it."""
    return F.aggregate(F.zip_with(part, F.sequence(F.lit(1), F.size(part)), lambda x, i: (x + 1.0) * i), F.lit(0.0), lambda a, x: a + x)


_at_first_path("zoom_window", lambda w, i, a: _weighted(W.zoom_window(w, i, 20, 30)), f"""SELECT p.sample_id,
  {rnd('sum((w.x + 1.0::DOUBLE) * (w.i - greatest(p.idx - 20, 0) + 1))')} AS v FROM path1 p JOIN wave w ON w.sample_id = p.sample_id
  AND w.i BETWEEN p.idx - 20 AND p.idx + 30 GROUP BY p.sample_id""")


def _whole_wave(name: str, fn, sql: str) -> None:
    @query(name, f"WITH {V.CLEAN} {sql}")
    def _(spark, sf):
        return V.clean(spark, sf).select("sample_id", r(fn(F.col("cir"))).alias("v"))


_whole_wave("mean_excess_delay", W.mean_excess_delay,
            f"SELECT sample_id, {rnd('sum(i * x * x) / sum(x * x)')} AS v FROM wave GROUP BY sample_id")
_whole_wave("rms_delay_spread", W.rms_delay_spread, f"""SELECT w.sample_id,
  {rnd('sqrt(sum((i - m) * (i - m) * x * x) / sum(x * x))')} AS v FROM wave w JOIN (
    SELECT sample_id, sum(i * x * x) / sum(x * x) AS m FROM wave GROUP BY sample_id) t ON w.sample_id = t.sample_id
  GROUP BY w.sample_id""")
_whole_wave("kurtosis_full", W.excess_kurtosis,
            f"SELECT sample_id, {rnd('kurtosis_pop(x)')} AS v FROM wave GROUP BY sample_id")
_whole_wave("max_to_mean", W.max_to_mean,
            f"SELECT sample_id, {rnd('max(x) / avg(x)')} AS v FROM wave GROUP BY sample_id")


@query("peak_to_noise", f"""WITH {V.PATH1} SELECT p.sample_id,
  {rnd('CASE WHEN c.stdev_noise > 0 THEN p.amp / c.stdev_noise ELSE 0 END')} AS v
  FROM path1 p JOIN clean c ON p.sample_id = c.sample_id""")
def _(spark, sf):
    p = V.clean(spark, sf).withColumn("p", W.argmax_near(F.col("cir"), F.col("FP_IDX").cast("int")))
    return p.select("sample_id", r(zero_guarded_ratio(F.col("p.amp"), F.col("STDEV_NOISE"))).alias("v"))


@query("relative_power", f"""WITH {V.CLEAN} SELECT sample_id,
  {rnd('CASE WHEN cir_pwr > 0 THEN fp_amp1 / cir_pwr ELSE 0 END', 9)} AS v FROM clean""")
def _(spark, sf):
    return V.clean(spark, sf).select("sample_id", r(zero_guarded_ratio(F.col("FP_AMP1"), F.col("CIR_PWR")), 9).alias("v"))


@query("resample_linear", f"""WITH {V.CLEAN}, pos AS (SELECT j, j * 63 / 126.0::DOUBLE AS at FROM range(127) t(j)),
  pts AS (SELECT c.sample_id, p.j, c.cir[floor(p.at)::INTEGER + 1] AS a,
                 c.cir[least(floor(p.at)::INTEGER + 1, 63) + 1] AS b, p.at - floor(p.at) AS f FROM clean c, pos p)
  SELECT sample_id, count(*) AS n, {rnd('sum((a + (b - a) * f) * (j + 1))', 4)} AS wsum FROM pts GROUP BY sample_id""")
def _(spark, sf):
    return _digest(V.clean(spark, sf).withColumn("y", W.resample_linear(F.col("cir"), 127)), F.col("y"), "sample_id")


# --- augmentation --------------------------------------------------------------------------------

@query("aug_jitter", f"""WITH {V.CLEAN}, s AS (SELECT sample_id, floor({V.sql_uniform('sample_id', '42')} * 7) - 3 AS s FROM clean)
  SELECT w.sample_id, {rnd('sum(CASE WHEN w.i + s.s BETWEEN 0 AND w.n - 1 THEN w.x * (w.i + s.s + 1) ELSE 0 END)', 4)} AS wsum
  FROM wave w JOIN s ON w.sample_id = s.sample_id GROUP BY w.sample_id""")
def _(spark, sf):
    moved = V.clean(spark, sf).withColumn("j", augment.jitter(F.col("cir"), F.col("sample_id"), 3))
    return _digest(moved, F.col("j"), "sample_id").drop("n")


@query("aug_amplitude", f"""WITH {V.CLEAN} SELECT sample_id, {rnd(
    f"sum(x * (i + 1)) * (0.8 + 0.4 * any_value({V.sql_uniform('sample_id', '42')}))", 4)} AS wsum
  FROM wave GROUP BY sample_id""")
def _(spark, sf):
    scaled = V.clean(spark, sf).withColumn("a", augment.amplitude(F.col("cir"), F.col("sample_id"), (0.8, 1.2)))
    return _digest(scaled, F.col("a"), "sample_id").drop("n")


@query("aug_noise", f"""WITH {V.CLEAN}, s AS (SELECT sample_id, count(*) AS n, stddev_pop(x) AS sd, sum(x * x) AS e FROM wave GROUP BY sample_id)
  SELECT sample_id, n, {rnd('e', 4)} AS energy, {rnd('n * (0.08 * greatest(sd, 1e-8)) * (0.08 * greatest(sd, 1e-8))', 6)} AS expected_noise,
    true AS noise_as_expected FROM s""")
def _(spark, sf):
    # the noise itself has no SQL form: its energy must follow the wave's own deviation (chi-square, six deviations wide)
    noisy = V.clean(spark, sf).withColumn("noisy", augment.noise(F.col("cir"), F.col("sample_id"), 0.08))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    n, x = F.size("cir"), F.col("cir")
    mean = total(x) / n
    spread = F.greatest(F.sqrt(total(F.transform(x, lambda v: (v - mean) * (v - mean))) / n), F.lit(1e-8)) * 0.08
    energy = total(F.transform(F.zip_with("noisy", "cir", lambda a, b: a - b), lambda d: d * d))
    ratio = energy / (n * spread * spread)
    return noisy.select("sample_id", n.cast("bigint").alias("n"), r(W.energy(x), 4).alias("energy"),
                        r(n * spread * spread, 6).alias("expected_noise"),
                        (F.abs(ratio - 1) <= 6 * F.sqrt(F.lit(2.0) / n)).alias("noise_as_expected"))


@query("augment_waveforms", f"""WITH {V.CLEAN} SELECT aug_round::INTEGER AS aug_round, nlos, count(*) AS n
  FROM clean, range(4) t(aug_round) GROUP BY aug_round, nlos""")
def _(spark, sf):
    rows = V.clean(spark, sf).withColumnRenamed("NLOS", "nlos")
    out = augment.augment_waveforms(rows, factor=3, noise_level=0.08, max_shift=4, scale=(0.8, 1.2))
    # the wave itself is read so that the count covers the whole augmentation
    return out.filter(F.size("cir") == V.WAVE_LENGTH).groupBy("aug_round", "nlos").agg(F.count("*").alias("n"))


# --- paths and features --------------------------------------------------------------------------

def features(spark, sf) -> DataFrame:
    return stream_features(V.sig(spark, sf))


_ROUNDED = {c: 9 if c == "relative_power" else 4 if c in ("CIR_PWR",) else 6 for c in S.FEATURES}


@query("two_path_expand", f"WITH RECURSIVE {V.BOTH} SELECT sample_id, path_id, env_id::INTEGER AS env_id, label, "
       f"{rnd('range_m')} AS range_m, {rnd('\"RANGE\"')} AS \"RANGE\", " +
       ", ".join(f'{rnd(chr(34) + c + chr(34), _ROUNDED[c])} AS "{c}"' for c in S.FEATURES) + " FROM feat")
def _(spark, sf):
    f = features(spark, sf)
    return f.select("sample_id", "path_id", "env_id", "label", r(F.col("range_m")).alias("range_m"),
                    r(F.col("RANGE")).alias("RANGE"), *[r(F.col(c), _ROUNDED[c]).alias(c) for c in S.FEATURES])


def _feature_query(name: str, columns: list[str]) -> None:
    @query(name, f"WITH RECURSIVE {V.BOTH} SELECT sample_id, path_id, " +
           ", ".join(f"{rnd(c)} AS {c}" for c in columns) + " FROM feat")
    def _(spark, sf):
        return features(spark, sf).select("sample_id", "path_id", *[r(F.col(c)).alias(c) for c in columns])


_feature_query("amplitude_ratio", ["p_amplitude_ratio"])
_feature_query("path_delay_separation", ["path_delay_separation"])
_feature_query("path1_to_fp_offset", ["path1_to_fp_offset"])
_feature_query("range_labels", ["range_m"])
_feature_query("concat_columns", ["p_path_idx", "p_path_amp", "relative_power"])


@query("zero_if_undetected", f"""WITH RECURSIVE {V.BOTH} SELECT path_id, (p_path_amp > 0)::INTEGER AS seen, count(*) AS n,
  {rnd('sum(abs(p_rise_time) + abs(p_decay_time) + abs(p_energy_ratio) + abs(p_amplitude_ratio))')} AS local_sum,
  {rnd('min(p_tail_energy_ratio)')} AS min_tail FROM feat GROUP BY path_id, (p_path_amp > 0)::INTEGER""")
def _(spark, sf):
    f = features(spark, sf)
    local = F.abs("p_rise_time") + F.abs("p_decay_time") + F.abs("p_energy_ratio") + F.abs("p_amplitude_ratio")
    return f.groupBy("path_id", (F.col("p_path_amp") > 0).cast("int").alias("seen")).agg(
        F.count("*").alias("n"), r(F.sum(local)).alias("local_sum"), r(F.min("p_tail_energy_ratio")).alias("min_tail"))


@query("path_valid_filter", f"""WITH RECURSIVE {V.BOTH} SELECT sample_id, {rnd('p_path_amp')} AS p_path_amp,
  {rnd('range_m')} AS range_m FROM feat WHERE path_id = 2 AND p_path_amp > 0""")
def _(spark, sf):
    return paths.valid_second_paths(features(spark, sf)).select(
        "sample_id", r(F.col("p_path_amp")).alias("p_path_amp"), r(F.col("range_m")).alias("range_m"))


@query("class_distribution", f"""WITH {V.CLEAN} SELECT 'measured' AS stage, nlos AS label, count(*) AS n FROM clean GROUP BY nlos
  UNION ALL SELECT 'expanded', label, sum(n)::BIGINT FROM (
    SELECT nlos AS label, count(*) AS n FROM clean GROUP BY nlos UNION ALL SELECT 1, count(*) FROM clean) GROUP BY label""")
def _(spark, sf):
    before = profiling.class_distribution(V.clean(spark, sf), "NLOS", "measured")
    return before.unionByName(profiling.class_distribution(features(spark, sf), "label", "expanded"))


@query("expansion_report", f"""WITH RECURSIVE {V.BOTH} SELECT count(*) AS n_rows, count_if(label = 0)::BIGINT AS n_los,
  count_if(label = 1)::BIGINT AS n_nlos, count_if(path_id = 2 AND p_path_amp = 0)::BIGINT AS n_no_second_path FROM feat""")
def _(spark, sf):
    return paths.expansion_report(features(spark, sf))


@query("expand_split_env", f"""WITH {V.CLEAN}, c AS (SELECT nlos, count(*) AS n FROM clean GROUP BY nlos),
  q AS (SELECT nlos, n, n * 1.0::DOUBLE / sum(n) OVER () * ceil(sum(n) OVER () * 0.2) AS ideal,
               ceil(sum(n) OVER () * 0.2) AS n_test FROM c),
  q2 AS (SELECT nlos, floor(ideal) + (row_number() OVER (ORDER BY round(ideal - floor(ideal), 9) DESC, nlos)
               <= n_test - sum(floor(ideal)) OVER ())::INTEGER AS quota FROM q),
  ranked AS (SELECT sample_id, env_id, nlos, row_number() OVER (PARTITION BY nlos
               ORDER BY md5(concat('42|', sample_id))) AS rn FROM clean)
  SELECT sample_id, p AS path_id, env_id::INTEGER AS env_id, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split
  FROM ranked JOIN q2 USING (nlos), (VALUES (1), (2)) v(p)""")
def _(spark, sf):
    split = splits.stratified_split(cleaning.drop_degenerate(V.sig(spark, sf)), "sample_id", "NLOS")
    rows = paths.measurement_features(split, keys=("sample_id", "env_id", "split"))
    return rows.select("sample_id", "path_id", "env_id", "split")


@query("stream_features", f"WITH RECURSIVE {V.BOTH} SELECT path_id, count(*) AS n, {rnd('sum(p_path_idx)', 2)} AS idx_sum, "
       f"{rnd('sum(p_rms_delay_spread)', 3)} AS spread_sum FROM feat GROUP BY path_id")
def _(spark, sf):
    """The feature chain on a file stream of the measurements, run to completion."""
    source = scratch_path(spark, "stream-in")
    V.sig(spark, sf).write.parquet(source)
    schema = spark.read.parquet(source).schema
    live = stream_features(spark.readStream.schema(schema).parquet(source))
    target = scratch_path(spark, "stream-out")
    run = (live.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
           .option("checkpointLocation", scratch_path(spark, "stream-state")).start(target))
    run.awaitTermination()
    return spark.read.parquet(target).groupBy("path_id").agg(
        F.count("*").alias("n"), r(F.sum("p_path_idx"), 2).alias("idx_sum"),
        r(F.sum("p_rms_delay_spread"), 3).alias("spread_sum"))


@query("wave_profile", f"""WITH {V.PATH1}, e AS (SELECT sample_id, sum(x * x) AS e, sum(i * x * x) / sum(x * x) AS m FROM wave GROUP BY sample_id),
  s AS (SELECT w.sample_id, sqrt(sum((w.i - e.m) * (w.i - e.m) * w.x * w.x) / any_value(e.e)) AS rms,
    sum(CASE WHEN w.i BETWEEN p.idx - 15 AND p.idx + 15 THEN w.x * w.x ELSE 0 END) / any_value(e.e) AS er,
    sum(CASE WHEN w.i >= p.idx THEN w.x * w.x ELSE 0 END) / any_value(e.e) AS tr, any_value(e.m) AS m
    FROM wave w JOIN e ON e.sample_id = w.sample_id JOIN path1 p ON p.sample_id = w.sample_id GROUP BY w.sample_id)
  SELECT env_id::INTEGER AS env_id, nlos, count(*) AS n, {rnd('avg(er)')} AS energy_ratio, {rnd('avg(tr)')} AS tail_energy_ratio,
    {rnd('avg(m)')} AS mean_excess_delay, {rnd('avg(rms)')} AS rms_delay_spread
  FROM clean c JOIN s ON c.sample_id = s.sample_id GROUP BY env_id, nlos""")
def wave_profile(spark, sf):
    """Flagship slice: cleaned waves, first path, energy and delay features, averaged per environment and class."""
    f = features(spark, sf).filter(F.col("path_id") == 1)
    return f.groupBy("env_id", F.col("label").alias("nlos")).agg(
        F.count("*").alias("n"), *[r(F.avg(f"p_{c}")).alias(c) for c in
                                   ("energy_ratio", "tail_energy_ratio", "mean_excess_delay", "rms_delay_spread")])
