"""Queries over prediction tables, loss traces and scalar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wavelattice import schema as S
from wavelattice.functions import scalars
from wavelattice.functions.scalars import rounded as r
from wavelattice.operators import metrics as M
from wavelattice.operators import profiling, splits
from wavelattice.plans import views as V
from wavelattice.plans.registry import query
from wavelattice.plans.views import rnd

P = "WITH " + V.PRED
CONF = P + """, conf AS (SELECT model, count_if(label = 0 AND pred = 0)::BIGINT AS tn, count_if(label = 0 AND pred = 1)::BIGINT AS fp,
  count_if(label = 1 AND pred = 0)::BIGINT AS fn, count_if(label = 1 AND pred = 1)::BIGINT AS tp FROM pred GROUP BY model)"""
SCORES = CONF + """, scores AS (SELECT *, tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS n,
  CASE WHEN tn + fn > 0 THEN tn / (tn + fn)::DOUBLE ELSE 0 END AS p0, CASE WHEN tn + fp > 0 THEN tn / (tn + fp)::DOUBLE ELSE 0 END AS r0,
  CASE WHEN tn > 0 THEN 2 * tn / (2 * tn + fn + fp)::DOUBLE ELSE 0 END AS f0,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS p1, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS r1,
  CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fn + fp)::DOUBLE ELSE 0 END AS f1,
  (tn + tp) / (tn + fp + fn + tp)::DOUBLE AS acc FROM conf)"""


def curves_sql(source: str, prefix: str) -> str:
    """CTE ``curve``: cumulative counts per distinct score of a prediction relation."""
    return f"""{prefix}, steps AS (SELECT model, prob, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM {source} GROUP BY model, prob),
  curve AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY prob DESC) AS tp, sum(neg) OVER (PARTITION BY model ORDER BY prob DESC) AS fp,
    sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn FROM steps),
  seg AS (SELECT *, fp / nn::DOUBLE AS fpr, tp / np::DOUBLE AS tpr, coalesce(lag(fp / nn::DOUBLE) OVER w, 0) AS fpr0,
    coalesce(lag(tp / np::DOUBLE) OVER w, 0) AS tpr0 FROM curve WINDOW w AS (PARTITION BY model ORDER BY prob DESC)),
  auc AS (SELECT model, sum((fpr - fpr0) * (tpr + tpr0) / 2) AS auc FROM seg GROUP BY model)"""


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(F.col(c), digits) for c in columns})


@query("threshold_predict", f"{P} SELECT model, doc_id, pred FROM pred")
def _(spark, sf):
    return V.pred(spark, sf).select("model", "doc_id", scalars.predicted_class(F.col("prob")).alias("pred"))


@query("confusion_matrix", f"""{CONF} SELECT model, 0 AS label, 0 AS pred, tn AS n FROM conf UNION ALL SELECT model, 0, 1, fp FROM conf
  UNION ALL SELECT model, 1, 0, fn FROM conf UNION ALL SELECT model, 1, 1, tp FROM conf""")
def _(spark, sf):
    return M.confusion_matrix(V.pred(spark, sf))


@query("confusion_row_pct", f"""{CONF} SELECT model, 0 AS label, 0 AS pred, {rnd('100.0 * tn / (tn + fp)')} AS pct FROM conf
  UNION ALL SELECT model, 0, 1, {rnd('100.0 * fp / (tn + fp)')} FROM conf
  UNION ALL SELECT model, 1, 0, {rnd('100.0 * fn / (fn + tp)')} FROM conf UNION ALL SELECT model, 1, 1, {rnd('100.0 * tp / (fn + tp)')} FROM conf""")
def _(spark, sf):
    return _r(M.confusion_row_pct(V.pred(spark, sf)), "pct")


@query("classification_report", f"""{SCORES}
  SELECT model, '0' AS row, {rnd('p0')} AS "precision", {rnd('r0')} AS recall, {rnd('f0')} AS f1, s0 AS support FROM scores
  UNION ALL SELECT model, '1', {rnd('p1')}, {rnd('r1')}, {rnd('f1')}, s1 FROM scores
  UNION ALL SELECT model, 'accuracy', {rnd('acc')}, {rnd('acc')}, {rnd('acc')}, n FROM scores
  UNION ALL SELECT model, 'macro avg', {rnd('(p0 + p1) / 2')}, {rnd('(r0 + r1) / 2')}, {rnd('(f0 + f1) / 2')}, n FROM scores
  UNION ALL SELECT model, 'weighted avg', {rnd('(p0 * s0 + p1 * s1) / n')}, {rnd('(r0 * s0 + r1 * s1) / n')},
    {rnd('(f0 * s0 + f1 * s1) / n')}, n FROM scores""")
def _(spark, sf):
    return _r(M.classification_report(V.pred(spark, sf)), "precision", "recall", "f1")


@query("roc_curve", f"""{curves_sql('pred', P)} SELECT model, {rnd('prob')} AS threshold, {rnd('fpr')} AS fpr, {rnd('tpr')} AS tpr FROM seg
  UNION ALL SELECT DISTINCT model, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM pred""")
def _(spark, sf):
    return _r(M.roc_curve(V.pred(spark, sf)), "fpr", "tpr").withColumn(
        "threshold", F.when(F.col("threshold") > 1.0, F.col("threshold")).otherwise(r(F.col("threshold"))))


@query("auc_trapezoid", f"{curves_sql('pred', P)} SELECT model, {rnd('auc')} AS auc FROM auc")
def _(spark, sf):
    return _r(M.auc_trapezoid(V.pred(spark, sf)), "auc")


@query("pr_curve", f"""{curves_sql('pred', P)} SELECT model, {rnd('prob')} AS threshold, {rnd('tp / (tp + fp)')} AS "precision",
  {rnd('tpr')} AS recall FROM seg UNION ALL SELECT DISTINCT model, 'inf'::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM pred""")
def _(spark, sf):
    return _r(M.pr_curve(V.pred(spark, sf)), "precision", "recall").withColumn(
        "threshold", F.when(F.col("threshold") > 1.0, F.col("threshold")).otherwise(r(F.col("threshold"))))


@query("average_precision", f"{curves_sql('pred', P)} SELECT model, {rnd('sum((tpr - tpr0) * tp / (tp + fp))')} AS ap FROM seg GROUP BY model")
def _(spark, sf):
    return _r(M.average_precision(V.pred(spark, sf)), "ap")


@query("no_skill_rate", f"{P} SELECT model, {rnd('avg(label)')} AS rate FROM pred GROUP BY model")
def _(spark, sf):
    return _r(M.no_skill_rate(V.pred(spark, sf)), "rate")


_SUMMARY = ["accuracy", "precision_los", "recall_los", "f1_los", "precision_nlos", "recall_nlos", "f1_nlos", "f1_macro", "auc"]


@query("model_summary_table", f"""{curves_sql('pred', SCORES)} SELECT s.model, {rnd('acc')} AS accuracy, {rnd('p0')} AS precision_los,
  {rnd('r0')} AS recall_los, {rnd('f0')} AS f1_los, {rnd('p1')} AS precision_nlos, {rnd('r1')} AS recall_nlos, {rnd('f1')} AS f1_nlos,
  {rnd('(f0 + f1) / 2')} AS f1_macro, n AS n_test, {rnd('auc')} AS auc FROM scores s JOIN auc a ON s.model = a.model""")
def _(spark, sf):
    return _r(M.model_summary_table(V.pred(spark, sf)), *_SUMMARY)


@query("accuracy_by_group", P + ", g AS (SELECT source, " + ", ".join(
    f"avg(CASE WHEN model = '{m}' THEN (label = pred)::INTEGER END) AS {m}" for m in V.MODELS) +
       " FROM pred GROUP BY source) SELECT d.source, " + ", ".join(f"{rnd(f'coalesce({m}, 0)')} AS {m}" for m in V.MODELS) +
       " FROM (SELECT DISTINCT source FROM documents) d LEFT JOIN g ON d.source = g.source")
def _(spark, sf):
    groups = V.table(spark, sf, "documents").select("source").distinct()
    return _r(M.accuracy_by_group(V.pred(spark, sf), "source", groups, V.MODELS), *V.MODELS)


@query("misclassified_rows", f"""{P} SELECT model, doc_id, label, pred, {rnd('prob')} AS prob,
  CASE WHEN pred = 1 THEN 'FP' ELSE 'FN' END AS kind FROM pred WHERE pred <> label""")
def _(spark, sf):
    return _r(M.misclassified_rows(V.pred(spark, sf)), "prob").select("model", "doc_id", "label", "pred", "prob", "kind")


@query("misclassified_counts", f"""{CONF} SELECT model, fp AS n_fp, fn AS n_fn, fp + fn AS n_wrong,
  {rnd('100.0 * (fp + fn) / (tn + fp + fn + tp)')} AS pct_wrong FROM conf""")
def _(spark, sf):
    return _r(M.misclassified_counts(V.pred(spark, sf)), "pct_wrong")


def hist_sql(prefix: str, source: str, keys: str, value: str, bins: int) -> str:
    """Histogram by comparing every value with the list of edges."""
    return f"""{prefix}, lim AS (SELECT {keys}, min({value}) AS lo0, max({value}) AS hi0, count({value}) AS n_all FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys}),
  lim2 AS (SELECT *, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM lim),
  edge AS (SELECT *, i, lo + i * ((hi - lo) / {bins}) AS left_edge, lo + (i + 1) * ((hi - lo) / {bins}) AS right_edge FROM lim2, range({bins}) t(i)),
  h AS (SELECT {', '.join('e.' + k.strip() for k in keys.split(','))}, e.i::INTEGER AS bin, {rnd('e.left_edge')} AS left_edge, count(*) AS n,
    {rnd(f'count(*) / (any_value(e.n_all) * any_value((e.hi - e.lo) / {bins}))', 9)} AS density
    FROM edge e JOIN {source} s ON {' AND '.join(f's.{k.strip()} = e.{k.strip()}' for k in keys.split(','))}
     AND s.{value} >= e.left_edge AND (s.{value} < e.right_edge OR e.i = {bins - 1})
    GROUP BY {', '.join('e.' + k.strip() for k in keys.split(','))}, e.i, e.left_edge)"""


@query("hist_probabilities", hist_sql(P, "pred", "model, label", "prob", 50) +
       " SELECT model, label, bin, left_edge, n, density FROM h")
def _(spark, sf):
    return _r(_r(M.probability_histogram(V.pred(spark, sf)), "left_edge"), "density", digits=9)


_LONG = "WITH " + V.SCAL + ", long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, returned, {c} AS value FROM scal" for c in V.SCALAR_COLUMNS) + ")"


@query("hist_by_class", hist_sql(_LONG, "long", "variable, returned", "value", 50) +
       " SELECT variable, returned, bin, left_edge, n, density FROM h")
def _(spark, sf):
    h = profiling.histogram(V.scal(spark, sf), V.SCALAR_COLUMNS, "returned", 50)
    return _r(_r(h, "left_edge"), "density", digits=9)


_CUT = """, lim AS (SELECT variable, min(value) AS lo, max(value) AS hi FROM {src} WHERE value IS NOT NULL GROUP BY variable),
  edge AS (SELECT variable, lo, hi, i, lo + i * ((hi - lo) / 10) AS a, lo + (i + 1) * ((hi - lo) / 10) AS b FROM lim, range(10) t(i)),
  cut AS (SELECT s.*, e.i::INTEGER AS bin, CASE WHEN e.i = 0 THEN e.lo - 0.001::DOUBLE * (e.hi - e.lo) ELSE e.a END AS bin_left, e.b AS bin_right
    FROM {src} s JOIN edge e ON s.variable = e.variable AND (s.value > e.a OR e.i = 0) AND (s.value <= e.b OR e.i = 9))"""


@query("equal_width_cut", _LONG + _CUT.format(src="long") + f""" SELECT variable, bin, {rnd('bin_left')} AS bin_left,
  {rnd('bin_right')} AS bin_right, count(*) AS n, {rnd('min(value)')} AS lowest, {rnd('max(value)')} AS highest
  FROM cut GROUP BY variable, bin, bin_left, bin_right""")
def _(spark, sf):
    cut = profiling.equal_width_cut(V.scal(spark, sf), V.SCALAR_COLUMNS)
    g = cut.groupBy("variable", "bin", "bin_left", "bin_right").agg(
        F.count("*").alias("n"), F.min("value").alias("lowest"), F.max("value").alias("highest"))
    return _r(g, "bin_left", "bin_right", "lowest", "highest")


@query("error_by_bin", P + """, long AS (SELECT 'n_chars' AS variable, (label = pred)::INTEGER AS ok, n_chars AS value FROM pred
  UNION ALL SELECT 'prob', (label = pred)::INTEGER, prob FROM pred UNION ALL SELECT 'doc', (label = pred)::INTEGER, doc_id::DOUBLE FROM pred)"""
       + _CUT.format(src="long") + f""" SELECT variable, bin, {rnd('(bin_left + bin_right) / 2')} AS bin_mid,
  {rnd('1 - avg(ok)')} AS error_rate, count(*) AS n FROM cut GROUP BY variable, bin, bin_left, bin_right""")
def _(spark, sf):
    rows = V.pred(spark, sf).select("n_chars", "prob", F.col("doc_id").alias("doc"),
                                    (F.col("label") == F.col("pred")).cast("int").alias("ok"))
    return _r(profiling.error_by_bin(rows, ["n_chars", "prob", "doc"], "ok"), "bin_mid", "error_rate")


@query("corr_matrix", "WITH " + V.SIG + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'corr({V_a}, {V_b})')} AS r FROM sig"
    for a, V_a in [(c, "range_m0" if c == "RANGE" else c) for c in [*S.SCALARS, "NLOS"]]
    for b, V_b in [(c, "range_m0" if c == "RANGE" else c) for c in [*S.SCALARS, "NLOS"]]))
def _(spark, sf):
    return _r(profiling.corr_matrix(V.sig(spark, sf), [*S.SCALARS, "NLOS"]), "r")


@query("iqr_outlier_report", "WITH " + V.SCAL + ", q AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}, "
    f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}"
    for c in V.SCALAR_COLUMNS) + " FROM scal), f AS (SELECT returned, " + ", ".join(
    f"coalesce({c} < lo_{c} OR {c} > hi_{c}, false) AS o_{c}, lo_{c}, hi_{c}" for c in V.SCALAR_COLUMNS) + " FROM scal, q) " +
       " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {lo} AS low, {hi} AS high, count_if({o})::BIGINT AS n_outliers, "
    f"{rnd(f'100.0 * count_if({o}) / count(*)')} AS pct_outliers, "
    f"CASE WHEN count_if({o}) > 0 THEN {rnd(f'100.0 * count_if({o} AND returned = 1) / count_if({o})')} END AS pct_positive FROM f"
    for c, lo, hi, o in [*((c, rnd(f"any_value(lo_{c})"), rnd(f"any_value(hi_{c})"), f"o_{c}") for c in V.SCALAR_COLUMNS),
                         ("any", "NULL::DOUBLE", "NULL::DOUBLE", "(" + " OR ".join(f"o_{c}" for c in V.SCALAR_COLUMNS) + ")")]))
def _(spark, sf):
    return _r(profiling.iqr_outliers(V.scal(spark, sf), V.SCALAR_COLUMNS, "returned"),
              "low", "high", "pct_outliers", "pct_positive")


@query("class_weights", f"""WITH {V.SCAL}, c AS (SELECT returned AS label, count(*) AS n_class FROM scal GROUP BY returned),
  s AS (SELECT sum(n_class) AS n, count(*) AS k, sum(CASE WHEN label = 0 THEN n_class END) AS n0, sum(CASE WHEN label = 1 THEN n_class END) AS n1 FROM c)
  SELECT label, n_class, {rnd('n / (k * n_class)')} AS balanced_weight,
    {rnd('CASE WHEN label = 0 THEN n1 / n0 ELSE 1 END / ((n1 / n0 * n0 + n1) / n)')} AS boost_weight, {rnd('n0 / n1')} AS scale_pos_weight FROM c, s""")
def _(spark, sf):
    return _r(profiling.class_weights(V.scal(spark, sf), "returned"), "balanced_weight", "boost_weight", "scale_pos_weight")


@query("predictions_column_stack", P + " SELECT doc_id, label, " + ", ".join(
    f"{rnd(f'''max(CASE WHEN model = '{m}' THEN prob END)''')} AS {m}" for m in V.MODELS) + " FROM pred GROUP BY doc_id, label")
def _(spark, sf):
    return _r(M.predictions_wide(V.pred(spark, sf), "doc_id", V.MODELS), *V.MODELS)


@query("ensemble_average", f"""{P} SELECT 'ensemble_average' AS model, doc_id, label, {rnd('avg(prob)')} AS prob,
  (avg(prob) >= 0.5)::INTEGER AS pred FROM pred GROUP BY doc_id, label""")
def _(spark, sf):
    return _r(M.ensemble_average(V.pred(spark, sf), "doc_id", V.MODELS), "prob")


_FUSED = f"""(avg(CASE WHEN model <> '{V.MODELS[2]}' THEN prob END) * 0.5 + max(CASE WHEN model = '{V.MODELS[2]}' THEN prob END) * 0.5)"""


@query("prob_fusion", f"""{P} SELECT 'fusion' AS model, doc_id, label, {rnd(_FUSED)} AS prob, ({_FUSED} >= 0.5)::INTEGER AS pred
  FROM pred GROUP BY doc_id, label""")
def _(spark, sf):
    return _r(M.prob_fusion(V.pred(spark, sf), "doc_id", V.MODELS[:2], V.MODELS[2]), "prob")


@query("eval_balanced_subset", f"""{curves_sql('sub', P + ", sub AS (SELECT * FROM pred WHERE path_id = 1 AND split = 'test')")},
  acc AS (SELECT model, avg((label = pred)::INTEGER) AS accuracy FROM sub GROUP BY model)
  SELECT acc.model, {rnd('accuracy')} AS accuracy, {rnd('auc')} AS auc FROM acc JOIN auc ON acc.model = auc.model""")
def _(spark, sf):
    return _r(M.metric_table(M.balanced_subset(V.pred(spark, sf))), "accuracy", "auc")


@query("metric_delta", f"""{P}, a AS (SELECT model, avg((label = pred)::INTEGER) AS accuracy, avg(abs(label - prob)) AS mean_error FROM pred WHERE split = 'train' GROUP BY model),
  b AS (SELECT model, avg((label = pred)::INTEGER) AS accuracy, avg(abs(label - prob)) AS mean_error FROM pred WHERE split = 'test' GROUP BY model)
  SELECT a.model, 'accuracy' AS metric, {rnd('a.accuracy')} AS original, {rnd('b.accuracy')} AS augmented, {rnd('b.accuracy - a.accuracy')} AS delta FROM a JOIN b ON a.model = b.model
  UNION ALL SELECT a.model, 'mean_error', {rnd('a.mean_error')}, {rnd('b.mean_error')}, {rnd('b.mean_error - a.mean_error')} FROM a JOIN b ON a.model = b.model""")
def _(spark, sf):
    def table(split):
        rows = V.pred(spark, sf).filter(F.col("split") == split)
        return rows.groupBy("model").agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("accuracy"),
                                         F.avg(F.abs(F.col("label") - F.col("prob"))).alias("mean_error"))
    return _r(M.metric_delta(table("train"), table("test")), "original", "augmented", "delta")


@query("best_model_max_acc", f"""{SCORES} SELECT model, {rnd('acc')} AS accuracy FROM scores ORDER BY acc DESC, model LIMIT 1""")
def _(spark, sf):
    acc = V.pred(spark, sf).groupBy("model").agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("accuracy"))
    return _r(M.best_model(acc, "accuracy"), "accuracy")


# --- regression ----------------------------------------------------------------------------------

R = "WITH " + V.REGP
REG = R + """, m AS (SELECT model, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae,
  1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS r2, count(*) AS n FROM regp GROUP BY model)"""


@query("regression_metrics", f"{REG} SELECT model, {rnd('rmse', 4)} AS rmse, {rnd('mae', 4)} AS mae, {rnd('r2')} AS r2, n FROM m")
def _(spark, sf):
    return _r(_r(M.regression_metrics(V.regp(spark, sf)), "r2"), "rmse", "mae", digits=4)


@query("sort_by_rmse", f"{REG} SELECT model, {rnd('rmse', 4)} AS rmse, row_number() OVER (ORDER BY rmse) AS place FROM m")
def _(spark, sf):
    from pyspark.sql import Window
    m = M.regression_metrics(V.regp(spark, sf)).orderBy("rmse")
    place = F.row_number().over(Window.orderBy("rmse")).cast("long")  # one row per model
    return _r(m.select("model", "rmse", place.alias("place")), "rmse", digits=4).orderBy("place")


@query("best_model_min_rmse", f"{REG} SELECT model, {rnd('rmse', 4)} AS rmse FROM m ORDER BY m.rmse, model LIMIT 1")
def _(spark, sf):
    return _r(M.best_model(M.regression_metrics(V.regp(spark, sf)), "rmse", largest=False), "rmse", digits=4)


_BEST = REG + """, best AS (SELECT model FROM m ORDER BY rmse, model LIMIT 1),
  res AS (SELECT r.model, o_orderkey, y - yhat AS residual FROM regp r JOIN best b ON r.model = b.model)"""


@query("residuals", f"{_BEST} SELECT model, o_orderkey, {rnd('residual', 7)} AS residual FROM res")
def _(spark, sf):
    return _r(M.residuals_of_best(V.regp(spark, sf)).select("model", "o_orderkey", "residual"), "residual", digits=7)


@query("hist_residuals", hist_sql(_BEST, "res", "model", "residual", 80) +
       " SELECT model, bin, round(left_edge, 3) AS left_edge, n FROM h")
def _(spark, sf):
    h = profiling.histogram(M.residuals_of_best(V.regp(spark, sf)), ["residual"], "model", 80)
    return h.select("model", "bin", F.round(r(F.col("left_edge")), 3).alias("left_edge"), "n")


@query("axis_limits", f"{R} SELECT model, {rnd('least(min(y), min(yhat))', 4)} AS lo, {rnd('greatest(max(y), max(yhat))', 4)} AS hi FROM regp GROUP BY model")
def _(spark, sf):
    return _r(M.axis_limits(V.regp(spark, sf)), "lo", "hi", digits=4)


# --- scalar functions and loss traces ------------------------------------------------------------

@query("label_smoothing", f"{P} SELECT model, doc_id, {rnd('label * 0.95 + 0.025')} AS smooth FROM pred")
def _(spark, sf):
    return V.pred(spark, sf).select("model", "doc_id", r(scalars.smoothed_label(F.col("label"))).alias("smooth"))


@query("stable_sigmoid", f"SELECT event_id, {rnd('CASE WHEN value >= 200 THEN 1 / (1 + exp(-(value - 200))) ELSE exp(value - 200) / (1 + exp(value - 200)) END', 9)} AS p FROM events")
def _(spark, sf):
    return V.table(spark, sf, "events").select("event_id", r(scalars.stable_sigmoid(F.col("value") - 200.0), 9).alias("p"))


@query("log_loss", f"""SELECT event_type, {rnd('avg(greatest(z, 0) - z * y + ln(1 + exp(-abs(z))))')} AS loss
  FROM (SELECT event_type, (value - 30) / 20.0::DOUBLE AS z, CASE WHEN user_id % 2 = 0 THEN 0.025 ELSE 0.975 END AS y FROM events) GROUP BY event_type""")
def _(spark, sf):
    ev = V.table(spark, sf, "events")
    z = (F.col("value") - 30.0) / 20.0
    y = scalars.smoothed_label(F.col("user_id") % 2)
    return ev.groupBy("event_type").agg(r(F.avg(scalars.logit_loss(z, y))).alias("loss"))


@query("plateau_early_stop", f"""WITH RECURSIVE {V.EPOCHS}, walk AS (
  SELECT run, epoch, val_loss AS best, epoch AS best_epoch, 0 AS bad, val_loss AS lr_best, 0 AS lr_bad, 0.001::DOUBLE AS lr
  FROM epochs WHERE epoch = 1
  UNION ALL
  SELECT e.run, e.epoch, least(w.best, e.val_loss), CASE WHEN e.val_loss < w.best THEN e.epoch ELSE w.best_epoch END,
    CASE WHEN e.val_loss < w.best THEN 0 ELSE w.bad + 1 END,
    CASE WHEN e.val_loss < w.lr_best * 0.9999::DOUBLE THEN e.val_loss ELSE w.lr_best END,
    CASE WHEN e.val_loss < w.lr_best * 0.9999::DOUBLE THEN 0 WHEN w.lr_bad + 1 > 2 THEN 0 ELSE w.lr_bad + 1 END,
    CASE WHEN NOT e.val_loss < w.lr_best * 0.9999::DOUBLE AND w.lr_bad + 1 > 2 THEN w.lr * 0.5 ELSE w.lr END
  FROM walk w JOIN epochs e ON e.run = w.run AND e.epoch = w.epoch + 1 WHERE w.bad < 5)
  SELECT run, CASE WHEN bad >= 5 THEN epoch END AS stop_epoch, epoch AS last_epoch, best_epoch, {rnd('best')} AS best_loss, {rnd('lr', 12)} AS final_lr
  FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY epoch DESC) AS rn FROM walk) WHERE rn = 1""")
def _(spark, sf):
    return _r(_r(M.plateau_early_stop(V.epochs(spark, sf)), "best_loss"), "final_lr", digits=12)


# --- splits, folds, samples, scaling ---------------------------------------------------------------

def _events(spark, sf) -> DataFrame:
    return V.table(spark, sf, "events").select("event_id", "event_type", "value", "user_id")


_ORDERED = """ranked AS (SELECT event_id, event_type, value, row_number() OVER (PARTITION BY event_type
  ORDER BY md5(concat('42|', event_id))) AS rn FROM events)"""
_SPLIT = f"""WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
  q AS (SELECT event_type, n * 1.0::DOUBLE / sum(n) OVER () * ceil(sum(n) OVER () * 0.2) AS ideal, ceil(sum(n) OVER () * 0.2) AS n_test FROM c),
  q2 AS (SELECT event_type, floor(ideal) + (row_number() OVER (ORDER BY round(ideal - floor(ideal), 9) DESC, event_type)
    <= n_test - sum(floor(ideal)) OVER ())::INTEGER AS quota FROM q), {_ORDERED},
  split AS (SELECT r.*, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split FROM ranked r JOIN q2 USING (event_type))"""


@query("stratified_split", f"{_SPLIT} SELECT event_id, split FROM split")
def _(spark, sf):
    return splits.stratified_split(_events(spark, sf), "event_id", "event_type").select("event_id", "split")


@query("train_test_disjoint", f"""{_SPLIT} SELECT event_type AS label, count_if(split = 'train')::BIGINT AS n_train,
  count_if(split = 'test')::BIGINT AS n_test, 0::BIGINT AS n_both FROM split GROUP BY event_type""")
def _(spark, sf):
    return splits.split_check(splits.stratified_split(_events(spark, sf), "event_id", "event_type"), "event_id", "event_type")


@query("stratified_kfold", f"WITH {_ORDERED} SELECT event_id, ((rn - 1) % 5)::INTEGER AS fold FROM ranked")
def _(spark, sf):
    return splits.stratified_folds(_events(spark, sf), "event_id", "event_type").select("event_id", "fold")


@query("contiguous_folds", """WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos, count(*) OVER () AS n FROM events)
  SELECT event_id, (CASE WHEN pos < (n % 3) * (n // 3 + 1) THEN pos // (n // 3 + 1)
    ELSE n % 3 + (pos - (n % 3) * (n // 3 + 1)) // (n // 3) END)::INTEGER AS fold FROM r""")
def _(spark, sf):
    return splits.contiguous_folds(_events(spark, sf), "event_id").select("event_id", "fold")


@query("sampled_subset", "SELECT event_id, event_type FROM events ORDER BY md5(concat('42|', event_id)) LIMIT 1000")
def _(spark, sf):
    return splits.sampled_subset(_events(spark, sf), "event_id", 1000).select("event_id", "event_type")


@query("standard_scale", f"""{_SPLIT}, s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM split WHERE split = 'train')
  SELECT event_id, {rnd('(value - m) / sd')} AS value FROM split, s""")
def _(spark, sf):
    return _r(splits.scale_and_split(_events(spark, sf), "event_id", "event_type", ["value"]).select("event_id", "value"), "value")


@query("union_all_rows", """SELECT 'l' AS side, count(*) AS n, round(sum(l_extendedprice)::DOUBLE, 2) AS total FROM lineitem
  UNION ALL SELECT 'o', count(*), round(sum(o_totalprice)::DOUBLE, 2) FROM orders""")
def _(spark, sf):
    a = V.table(spark, sf, "lineitem").select(F.lit("l").alias("side"), F.col("l_extendedprice").alias("v"))
    b = V.table(spark, sf, "orders").select(F.col("o_totalprice").alias("v"), F.lit("o").alias("side"))
    return a.unionByName(b).groupBy("side").agg(F.count("*").alias("n"), F.round(F.sum("v"), 2).alias("total"))
