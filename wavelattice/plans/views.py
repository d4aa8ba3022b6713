"""Study tables derived from the given tables, each as a DataFrame and as SQL text.

``sig``      measurements: the embedding vectors taken as waves, scalars derived from the id
``pred``     predictions of three pseudo-models for the labelled documents
``regp``     predictions of two pseudo-regressors for order prices
``pts``      the embeddings as points
``scal``     numeric line item columns, some values missing
``epochs``   loss traces of 50 epochs each, cut from the event stream
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wavelattice.functions.scalars import keyed_uniform, predicted_class
from wavelattice.operators.cleaning import drop_degenerate, normalize_wave

WAVE_LENGTH = 64
DIMS = 64
POINT_COLUMNS = [f"x{i}" for i in range(1, DIMS + 1)]
MODELS = ["length_linear", "length_logistic", "coin"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sql_uniform(key: str, seed: str) -> str:
    """SQL text of :func:`keyed_uniform`."""
    return f"(('0x' || substr(md5(concat('{seed}|', {key})), 1, 8))::UBIGINT / 4294967296.0)"


def rnd(expr: str, digits: int = 6) -> str:
    """SQL text of a rounded double without negative zero."""
    return f"(round(({expr})::DOUBLE, {digits}) + 0.0::DOUBLE)"


def sig(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    vid = F.col("vec_id")

    def sound(x, i):
        # some waves are silent away from the first path, so that no second path exists
        silent = (vid % 19 == 3) & (F.abs(i - (vid * 7) % WAVE_LENGTH) > 5)
        return F.when(silent, F.lit(0.0)).otherwise(F.abs(x.cast("double")) * 1000.0)

    base = e.select(
        vid.alias("sample_id"), (F.col("label") % 7).alias("env_id"), (F.col("label") >= 5).cast("int").alias("NLOS"),
        F.transform("embedding", sound).alias("cir"),
        ((vid % 97) / F.lit(4.0)).alias("RANGE"), ((vid * 7) % WAVE_LENGTH + (vid % 4) / F.lit(4.0)).alias("FP_IDX"),
        (vid % 11).cast("double").alias("STDEV_NOISE"), ((vid % 11) * 3 + vid % 5).cast("double").alias("MAX_NOISE"),
        (vid % 29).cast("double").alias("RXPACC"),
        F.when(vid % 50 == 0, 40.0).otherwise(39.0).alias("FRAME_LEN"),
        F.when(vid % 25 == 0, 128.0).otherwise(1024.0).alias("PREAM_LEN"),
        F.lit(2.0).alias("CH"), F.lit(110.0).alias("BITRATE"), F.lit(64.0).alias("PRFR"))
    fp = F.col("FP_IDX").cast("int")

    def sample(k: int):
        return F.element_at("cir", F.least(fp + k, F.lit(WAVE_LENGTH - 1)) + 1)

    return base.withColumns({
        "CIR_PWR": F.aggregate("cir", F.lit(0.0), lambda a, x: a + x * x),
        "FP_AMP1": sample(0), "FP_AMP2": sample(1), "FP_AMP3": sample(2)})


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_wave(drop_degenerate(sig(spark, sf)))


SIG = f"""sig0 AS (
  SELECT vec_id AS sample_id, label % 7 AS env_id, CAST(label >= 5 AS INTEGER) AS nlos,
         list_transform(embedding, lambda e, i: CASE WHEN vec_id % 19 = 3 AND abs(i - 1 - (vec_id * 7) % {WAVE_LENGTH}) > 5
                        THEN 0.0::DOUBLE ELSE abs(CAST(e AS DOUBLE)) * 1000.0::DOUBLE END) AS cir,
         (vec_id % 97) / 4.0::DOUBLE AS range_m0,
         (vec_id * 7) % {WAVE_LENGTH} + (vec_id % 4) / 4.0::DOUBLE AS fp_idx,
         CAST((vec_id * 7) % {WAVE_LENGTH} AS INTEGER) AS fp,
         CAST(vec_id % 11 AS DOUBLE) AS stdev_noise,
         CAST((vec_id % 11) * 3 + vec_id % 5 AS DOUBLE) AS max_noise, CAST(vec_id % 29 AS DOUBLE) AS rxpacc,
         CASE WHEN vec_id % 50 = 0 THEN 40.0::DOUBLE ELSE 39.0::DOUBLE END AS frame_len,
         CASE WHEN vec_id % 25 = 0 THEN 128.0::DOUBLE ELSE 1024.0::DOUBLE END AS pream_len,
         2.0::DOUBLE AS ch, 110.0::DOUBLE AS bitrate, 64.0::DOUBLE AS prfr
  FROM embeddings),
sig AS (
  SELECT *, list_sum(list_transform(cir, lambda x: x * x)) AS cir_pwr, cir[fp + 1] AS fp_amp1,
         cir[least(fp + 1, {WAVE_LENGTH - 1}) + 1] AS fp_amp2, cir[least(fp + 2, {WAVE_LENGTH - 1}) + 1] AS fp_amp3
  FROM sig0)"""

CLEAN = SIG + """,
clean AS (
  SELECT * REPLACE (list_transform(cir, lambda x: x / rxpacc) AS cir) FROM sig
  WHERE range_m0 <> 0 AND cir_pwr <> 0 AND rxpacc <> 0),
wave AS (SELECT sample_id, unnest(range(len(cir))) AS i, unnest(cir) AS x, len(cir) AS n FROM clean)"""

PATH1 = CLEAN + """,
path1 AS (
  SELECT sample_id, CAST(i AS INTEGER) AS idx, x AS amp FROM (
    SELECT w.sample_id, w.i, w.x, row_number() OVER (PARTITION BY w.sample_id ORDER BY w.x DESC, w.i) AS rn
    FROM wave w JOIN clean c ON w.sample_id = c.sample_id WHERE w.i BETWEEN c.fp - 10 AND c.fp + 10)
  WHERE rn = 1)"""

SMOOTH = PATH1 + """,
smooth AS (
  SELECT sample_id, i,
         coalesce(lag(x) OVER w, 0.0::DOUBLE) * (1.0::DOUBLE / 3.0::DOUBLE) + x * (1.0::DOUBLE / 3.0::DOUBLE)
         + coalesce(lead(x) OVER w, 0.0::DOUBLE) * (1.0::DOUBLE / 3.0::DOUBLE) AS s
  FROM wave WINDOW w AS (PARTITION BY sample_id ORDER BY i))"""


def maxima_sql(source: str, value: str, name: str) -> str:
    """CTEs that list local maxima (plateau middle) of ``source(sample_id, i, value)`` as ``name(sample_id, idx, h)``."""
    return f"""
{name}_step AS (
  SELECT sample_id, i, {value} AS v,
         CASE WHEN {value} = lag({value}) OVER (PARTITION BY sample_id ORDER BY i) THEN 0 ELSE 1 END AS fresh
  FROM {source}),
{name}_run AS (
  SELECT sample_id, run, min(i) AS a, max(i) AS b, any_value(v) AS v FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY sample_id ORDER BY i) AS run FROM {name}_step)
  GROUP BY sample_id, run),
{name} AS (
  SELECT sample_id, CAST((a + b) // 2 AS INTEGER) AS idx, v AS h FROM (
    SELECT *, lag(v) OVER (PARTITION BY sample_id ORDER BY run) AS before,
           lead(v) OVER (PARTITION BY sample_id ORDER BY run) AS after FROM {name}_run)
  WHERE before < v AND after < v)"""


SECOND = SMOOTH + "," + maxima_sql("smooth", "s", "top") + """,
tall AS (
  SELECT t.sample_id, t.idx, t.h FROM top t JOIN path1 p ON t.sample_id = p.sample_id
  WHERE p.amp > 0 AND t.h >= 0.02::DOUBLE * p.amp),
queue AS (
  SELECT sample_id, list({'i': idx, 'h': h} ORDER BY h DESC, idx DESC) AS rest FROM tall GROUP BY sample_id),
picked AS (
  SELECT sample_id, rest[1].i AS idx, rest[1].h AS h,
         list_filter(rest, lambda r: abs(r.i - rest[1].i) >= 15) AS rest FROM queue
  UNION ALL
  SELECT sample_id, rest[1].i, rest[1].h, list_filter(rest, lambda r: abs(r.i - rest[1].i) >= 15)
  FROM picked WHERE len(rest) > 0),
walls AS (
  SELECT k.sample_id, k.idx, k.h, coalesce(max(CASE WHEN s.i < k.idx AND s.s > k.h THEN s.i END), -1) AS lb,
         coalesce(min(CASE WHEN s.i > k.idx AND s.s > k.h THEN s.i END), 1000000) AS rb
  FROM picked k JOIN smooth s ON k.sample_id = s.sample_id GROUP BY k.sample_id, k.idx, k.h),
prom AS (
  SELECT w.sample_id, w.idx, w.h - greatest(min(CASE WHEN s.i <= w.idx THEN s.s END),
                                            min(CASE WHEN s.i >= w.idx THEN s.s END)) AS prominence
  FROM walls w JOIN smooth s ON w.sample_id = s.sample_id AND s.i > w.lb AND s.i < w.rb
  GROUP BY w.sample_id, w.idx, w.h),
peaks AS (
  SELECT p.sample_id, p.idx, p.prominence FROM prom p JOIN path1 q ON p.sample_id = q.sample_id
  WHERE p.prominence >= 0.02::DOUBLE * q.amp),
far AS (
  SELECT p.sample_id, p.idx,
         row_number() OVER (PARTITION BY p.sample_id ORDER BY p.prominence DESC, p.idx) AS rn
  FROM peaks p JOIN path1 q ON p.sample_id = q.sample_id WHERE abs(p.idx - q.idx) > 15),
path2 AS (
  SELECT q.sample_id, coalesce(f.idx, 0) AS idx, coalesce(w.x, 0.0::DOUBLE) AS amp
  FROM path1 q LEFT JOIN far f ON q.sample_id = f.sample_id AND f.rn = 1
  LEFT JOIN wave w ON w.sample_id = f.sample_id AND w.i = f.idx)"""

BOTH = SECOND + """,
both_paths AS (
  SELECT a.sample_id, 1 AS path_id, a.idx, a.amp, b.amp AS other FROM path1 a JOIN path2 b USING (sample_id)
  UNION ALL
  SELECT b.sample_id, 2, b.idx, b.amp, a.amp FROM path1 a JOIN path2 b USING (sample_id)),
near AS (
  SELECT p.sample_id, p.path_id, p.idx, p.amp, w.i, w.x, w.n FROM both_paths p
  JOIN wave w ON w.sample_id = p.sample_id AND w.i BETWEEN p.idx - 15 AND p.idx + 15),
total AS (
  SELECT sample_id, sum(x * x) AS e, sum(i * x * x) / sum(x * x) AS med, kurtosis_pop(x) AS kf,
         CASE WHEN avg(x) > 0 THEN max(x) / avg(x) ELSE 0 END AS m2m FROM wave GROUP BY sample_id),
spread AS (
  SELECT w.sample_id, sqrt(sum((w.i - t.med) * (w.i - t.med) * w.x * w.x) / any_value(t.e)) AS rms
  FROM wave w JOIN total t USING (sample_id) GROUP BY w.sample_id),
tail AS (
  SELECT p.sample_id, p.path_id, sum(CASE WHEN w.i >= p.idx THEN w.x * w.x ELSE 0 END) / sum(w.x * w.x) AS tail
  FROM both_paths p JOIN wave w ON w.sample_id = p.sample_id GROUP BY p.sample_id, p.path_id),
local AS (
  SELECT sample_id, path_id,
         idx - coalesce(max(CASE WHEN i <= idx AND x < 0.1::DOUBLE * amp THEN i END), min(i) - 1) AS rise,
         coalesce(min(CASE WHEN i >= idx AND x < 0.1::DOUBLE * amp THEN i END), max(i) + 1) - idx AS decay,
         CASE WHEN count(*) > 3 THEN kurtosis_pop(x) ELSE 0 END AS kl, sum(x * x) AS le
  FROM near GROUP BY sample_id, path_id, idx, amp),
feat AS (
  SELECT c.sample_id, c.env_id, p.path_id, CASE WHEN p.path_id = 1 THEN c.nlos ELSE 1 END AS label,
         CASE WHEN p.path_id = 1 THEN c.range_m0 ELSE c.range_m0 + (p.idx - c.fp_idx) * 0.2998::DOUBLE END AS range_m,
         c.range_m0 AS "RANGE",
         CAST(p.idx AS DOUBLE) AS p_path_idx, p.amp AS p_path_amp,
         CASE WHEN p.amp > 0 THEN l.rise ELSE 0 END AS p_rise_time,
         CASE WHEN p.amp > 0 THEN l.decay ELSE 0 END AS p_decay_time,
         CASE WHEN p.amp > 0 THEN l.kl ELSE 0 END AS p_kurtosis_local,
         CASE WHEN p.amp > 0 THEN l.le / t.e ELSE 0 END AS p_energy_ratio,
         CASE WHEN p.amp > 0 AND c.stdev_noise > 0 THEN p.amp / c.stdev_noise ELSE 0 END AS p_peak_to_noise,
         CASE WHEN p.amp > 0 AND p.other > 0 THEN p.amp / p.other ELSE 0 END AS p_amplitude_ratio,
         s.rms AS p_rms_delay_spread, t.med AS p_mean_excess_delay, t.kf AS p_kurtosis_full, t.m2m AS p_max_to_mean,
         k.tail AS p_tail_energy_ratio, c.fp_amp1 AS "FP_AMP1", c.fp_amp2 AS "FP_AMP2", c.fp_amp3 AS "FP_AMP3",
         c.stdev_noise AS "STDEV_NOISE", c.cir_pwr AS "CIR_PWR", c.max_noise AS "MAX_NOISE", c.rxpacc AS "RXPACC",
         c.frame_len AS "FRAME_LEN", c.pream_len AS "PREAM_LEN",
         q2.idx - q1.idx AS path_delay_separation, q1.idx - c.fp_idx AS path1_to_fp_offset,
         CASE WHEN c.cir_pwr > 0 THEN c.fp_amp1 / c.cir_pwr ELSE 0 END AS relative_power
  FROM both_paths p JOIN clean c USING (sample_id) JOIN total t USING (sample_id) JOIN spread s USING (sample_id)
  JOIN tail k ON k.sample_id = p.sample_id AND k.path_id = p.path_id
  JOIN local l ON l.sample_id = p.sample_id AND l.path_id = p.path_id
  JOIN path1 q1 ON q1.sample_id = p.sample_id JOIN path2 q2 ON q2.sample_id = p.sample_id)"""


def pred(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", F.col("n_chars").cast("double").alias("n_chars"))
    labels = table(spark, sf, "labels")
    rows = docs.join(labels, "doc_id")
    probs = F.array(
        F.struct(F.lit(MODELS[0]).alias("model"), F.least(F.col("n_chars") / 5000.0, F.lit(1.0)).alias("prob")),
        F.struct(F.lit(MODELS[1]).alias("model"), (1.0 / (1.0 + F.exp(-(F.col("n_chars") - 1500.0) / 800.0))).alias("prob")),
        F.struct(F.lit(MODELS[2]).alias("model"), keyed_uniform(F.col("doc_id"), "coin").alias("prob")))
    return rows.select(
        "doc_id", "source", "n_chars", (F.col("toxic") + 1).alias("path_id"),
        F.when(keyed_uniform(F.col("doc_id"), "split") < 0.5, "test").otherwise("train").alias("split"),
        F.col("quality").alias("label"), F.explode(probs).alias("m")).select(
        "m.model", "doc_id", "source", "n_chars", "path_id", "split", "label", "m.prob",
        predicted_class(F.col("m.prob")).alias("pred"))


PRED = f"""docs AS (
  SELECT d.doc_id, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars, l.toxic + 1 AS path_id, l.quality AS label,
         CASE WHEN {sql_uniform('d.doc_id', 'split')} < 0.5 THEN 'test' ELSE 'train' END AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
scored AS (
  SELECT '{MODELS[0]}' AS model, *, least(n_chars / 5000.0::DOUBLE, 1.0::DOUBLE) AS prob FROM docs
  UNION ALL
  SELECT '{MODELS[1]}', *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(n_chars - 1500.0::DOUBLE) / 800.0::DOUBLE)) FROM docs
  UNION ALL
  SELECT '{MODELS[2]}', *, {sql_uniform('doc_id', 'coin')}::DOUBLE FROM docs),
pred AS (SELECT *, CAST(prob >= 0.5 AS INTEGER) AS pred FROM scored)"""


def regp(spark: SparkSession, sf: str) -> DataFrame:
    """Order prices predicted by the customer's and by the priority's mean; a key may be hot, so means join back."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_totalprice").alias("y"))
    out = None
    for model, by in (("customer_mean", "o_custkey"), ("priority_mean", "o_orderpriority")):
        means = o.groupBy(F.col(by).alias("_g")).agg(F.avg("y").alias("yhat"))
        if by == "o_orderpriority":
            means = F.broadcast(means)  # five priorities; customers are many and join by shuffle
        part = o.join(means, F.col(by) == F.col("_g")).select(F.lit(model).alias("model"), "o_orderkey", "y", "yhat")
        out = part if out is None else out.unionByName(part)
    return out


REGP = """cust AS (SELECT o_custkey, avg(o_totalprice) AS yhat FROM orders GROUP BY o_custkey),
prio AS (SELECT o_orderpriority, avg(o_totalprice) AS yhat FROM orders GROUP BY o_orderpriority),
regp AS (
  SELECT 'customer_mean' AS model, o_orderkey, o_totalprice AS y, yhat FROM orders JOIN cust USING (o_custkey)
  UNION ALL
  SELECT 'priority_mean', o_orderkey, o_totalprice, yhat FROM orders JOIN prio USING (o_orderpriority))"""


def pts(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    vec = F.transform("embedding", lambda x: x.cast("double"))
    return e.select("vec_id", (F.col("label") >= 5).cast("int").alias("y"),
                    (F.col("label") >= 7).cast("int").alias("rare"), F.col("label").alias("digit"), vec.alias("vec"),
                    *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(POINT_COLUMNS)])


PTS = f"""pts AS (
  SELECT vec_id, CAST(label >= 5 AS INTEGER) AS y, CAST(label >= 7 AS INTEGER) AS rare, label AS digit,
         list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vec,
         {', '.join(f'CAST(embedding[{i + 1}] AS DOUBLE) AS {c}' for i, c in enumerate(POINT_COLUMNS))}
  FROM embeddings)"""

SCALAR_COLUMNS = ["quantity", "price", "discount", "tax", "line"]


def scal(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_quantity") == 50, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("discount"),
        F.col("l_tax").alias("tax"), F.col("l_linenumber").cast("double").alias("line"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"), F.col("l_returnflag").alias("flag"))


SCAL = """scal AS (
  SELECT CASE WHEN l_linenumber <> 7 THEN l_quantity END AS quantity, l_extendedprice AS price,
         CASE WHEN l_quantity <> 50 THEN l_discount END AS discount, l_tax AS tax,
         CAST(l_linenumber AS DOUBLE) AS line, CAST(l_returnflag = 'R' AS INTEGER) AS returned, l_returnflag AS flag
  FROM lineitem)"""


def epochs(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select(F.floor(F.col("event_id") / 50).alias("run"), (F.col("event_id") % 50 + 1).alias("epoch"),
                     F.col("value").alias("val_loss"))


EPOCHS = """epochs AS (SELECT event_id // 50 AS run, event_id % 50 + 1 AS epoch, value AS val_loss FROM events)"""
