"""Metrics over long prediction tables.

Input of the classification operators: ``model, label, prob, pred`` plus any id columns. Every
metric is a grouped aggregate, so all models are measured in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from wavelattice.functions.scalars import predicted_class
from wavelattice.operators.profiling import histogram
from wavelattice.operators.quantiles import prefix_sums
from wavelattice.session import cut_lineage

_CELLS = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]


def confusion_counts(pred: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """``tn, fp, fn, tp`` per model."""
    return pred.groupBy(*keys).agg(*[
        F.count_if((F.col("label") == y) & (F.col("pred") == p)).alias(name) for name, y, p in _CELLS])


def confusion_matrix(pred: DataFrame) -> DataFrame:
    """``model, label, pred, n`` with all four cells, absent ones as 0."""
    cells = F.array(*[F.struct(F.lit(y).alias("label"), F.lit(p).alias("pred"), F.col(name).alias("n"))
                      for name, y, p in _CELLS])
    return confusion_counts(pred).select("model", F.inline(cells))


def confusion_row_pct(pred: DataFrame) -> DataFrame:
    """Confusion matrix in percent of each true class."""
    row = F.sum("n").over(Window.partitionBy("model", "label"))
    return confusion_matrix(pred).select("model", "label", "pred",
                                         F.coalesce(F.try_divide(100.0 * F.col("n"), row), F.lit(0.0)).alias("pct"))


def _ratio(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _class_scores(pred: DataFrame) -> DataFrame:
    """Confusion counts with precision, recall and F1 of both classes; 0/0 counts as 0."""
    c = confusion_counts(pred)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    scores = c.withColumns({
        "p0": _ratio(tn, tn + fn), "r0": _ratio(tn, tn + fp), "f0": _ratio(2 * tn, 2 * tn + fn + fp),
        "p1": _ratio(tp, tp + fp), "r1": _ratio(tp, tp + fn), "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "s0": tn + fp, "s1": tp + fn, "n": tn + fp + fn + tp, "accuracy": _ratio(tn + tp, tn + fp + fn + tp)})
    return scores


def classification_report(pred: DataFrame) -> DataFrame:
    """``model, row, precision, recall, f1, support`` for both classes, accuracy and averages."""
    def line(name, p, r, f, s):
        return F.struct(F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.alias("support"))

    c = F.col

    def macro(x):
        return (c(f"{x}0") + c(f"{x}1")) / 2

    def weighted(x):
        return (c(f"{x}0") * c("s0") + c(f"{x}1") * c("s1")) / c("n")

    rows = F.array(
        line("0", c("p0"), c("r0"), c("f0"), c("s0")), line("1", c("p1"), c("r1"), c("f1"), c("s1")),
        line("accuracy", c("accuracy"), c("accuracy"), c("accuracy"), c("n")),
        line("macro avg", macro("p"), macro("r"), macro("f"), c("n")),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), c("n")))
    return _class_scores(pred).select("model", F.inline(rows))


def _running_counts(pred: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Positives and negatives per distinct score, and the same with running counts, highest first.

    A prediction without a probability has no place among the scores and fails the job. The distinct scores are written
    once, as cut points, running sums and totals all read them.
    """
    missing = F.raise_error(F.concat(F.lit("null probability of model "), F.col("model"))).cast("double")
    steps = pred.withColumn("prob", F.coalesce("prob", missing)).groupBy("model", "prob").agg(F.sum(F.col("label").cast("bigint")).alias("pos"),
                                              F.sum((1 - F.col("label")).cast("bigint")).alias("neg"))
    steps = cut_lineage(steps)
    return steps, prefix_sums(steps, ["model"], "prob", ["pos", "neg"], descending=True)


def _score_steps(pred: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Running counts per distinct score with the class totals of the model on every row, and the models."""
    steps, running = _running_counts(pred)
    totals = steps.groupBy(F.col("model").alias("_m")).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    # one row per model
    return running.join(F.broadcast(totals), F.col("model") == F.col("_m")).drop("_m"), totals.select(F.col("_m").alias("model"))


def roc_curve(pred: DataFrame) -> DataFrame:
    """``model, threshold, fpr, tpr``; the origin has the threshold infinity. All points are kept."""
    steps, models = _score_steps(pred)
    s = steps.select("model", F.col("prob").alias("threshold"), _ratio(F.col("cum_neg"), F.col("n_neg")).alias("fpr"),
                     _ratio(F.col("cum_pos"), F.col("n_pos")).alias("tpr"))
    origin = models.select(
        "model", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(s)


def auc_trapezoid(pred: DataFrame) -> DataFrame:
    """``model, auc``: area under the ROC curve.

    A step of ``pos`` positives and ``neg`` negatives starts at ``cum_pos - pos``, so each trapezoid
    is known from its own row and the area is a plain sum.
    """
    _, s = _running_counts(pred)
    area = F.col("neg") * (2.0 * F.col("cum_pos") - F.col("pos")) / 2.0
    return s.groupBy("model").agg(
        _ratio(F.sum(area), F.max("cum_pos").cast("double") * F.max("cum_neg")).alias("auc"))


def pr_curve(pred: DataFrame) -> DataFrame:
    """``model, threshold, precision, recall``, with the final point (1, 0) at threshold infinity."""
    steps, models = _score_steps(pred)
    s = steps.select("model", F.col("prob").alias("threshold"),
                     _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                     _ratio(F.col("cum_pos"), F.col("n_pos")).alias("recall"))
    end = models.select(
        "model", F.lit(float("inf")).alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return end.unionByName(s)


def average_precision(pred: DataFrame) -> DataFrame:
    """``model, ap``: precision at each threshold weighted by the recall gained there."""
    _, s = _running_counts(pred)
    gain = F.col("pos").cast("double") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")).cast("double")
    return s.groupBy("model").agg(_ratio(F.sum(gain), F.max("cum_pos")).alias("ap"))


def no_skill_rate(pred: DataFrame) -> DataFrame:
    """``model, rate``: share of positives, the precision of a guess."""
    return pred.groupBy("model").agg(F.avg(F.col("label").cast("double")).alias("rate"))


def model_summary_table(pred: DataFrame) -> DataFrame:
    """One row per model: accuracy, AUC, precision, recall and F1 of both classes, macro F1, size."""
    scores = _class_scores(pred).select(
        "model", "accuracy", F.col("p0").alias("precision_los"), F.col("r0").alias("recall_los"),
        F.col("f0").alias("f1_los"), F.col("p1").alias("precision_nlos"), F.col("r1").alias("recall_nlos"),
        F.col("f1").alias("f1_nlos"), ((F.col("f0") + F.col("f1")) / 2).alias("f1_macro"),
        F.col("n").alias("n_test"))
    return scores.join(auc_trapezoid(pred), "model")


def accuracy_by_group(pred: DataFrame, group: str, groups: DataFrame, models: Sequence[str]) -> DataFrame:
    """Accuracy per group and model as a matrix; 0 where a group has no rows.

    ``groups`` is the dimension table of groups (all of them appear in the result).
    """
    correct = (F.col("label") == F.col("pred")).cast("double")
    cells = pred.withColumn("_ok", correct).groupBy(group).pivot("model", list(models)).agg(F.avg("_ok"))
    return groups.join(cells, group, "left").fillna(0.0, subset=list(models))


def misclassified_rows(pred: DataFrame) -> DataFrame:
    """The rows a model gets wrong, marked as false positive or false negative."""
    return pred.filter(F.col("label") != F.col("pred")).withColumn(
        "kind", F.when(F.col("pred") == 1, "FP").otherwise("FN"))


def misclassified_counts(pred: DataFrame) -> DataFrame:
    """False positives and negatives per model with the error share in percent."""
    c = confusion_counts(pred)
    wrong = F.col("fp") + F.col("fn")
    return c.select("model", F.col("fp").alias("n_fp"), F.col("fn").alias("n_fn"), wrong.alias("n_wrong"),
                    (100.0 * wrong / (wrong + F.col("tn") + F.col("tp"))).alias("pct_wrong"))


def probability_histogram(pred: DataFrame, bins: int = 50) -> DataFrame:
    """Histogram of the predicted probabilities per model and true class."""
    keyed = pred.withColumn("series", F.concat_ws("|", "model", F.col("label").cast("string")))
    h = histogram(keyed, ["prob"], "series", bins)
    parts = F.split("series", r"\|")
    return h.select(parts[0].alias("model"), parts[1].cast("int").alias("label"), "bin", "left_edge", "n", "density")


def predictions_wide(pred: DataFrame, key: str, models: Sequence[str]) -> DataFrame:
    """One row per key with one probability column per model."""
    return pred.groupBy(key, "label").pivot("model", list(models)).agg(F.first("prob"))


def ensemble_average(pred: DataFrame, key: str, models: Sequence[str], name: str = "ensemble_average") -> DataFrame:
    """Mean probability of the base models as predictions of a new model.

    Needs at least two models; rows of other models are not read.
    """
    if len(set(models)) < 2:
        raise ValueError("an ensemble needs at least two base models")
    mean = pred.filter(F.col("model").isin(list(models))).groupBy(key, "label").agg(F.avg("prob").alias("prob"))
    return mean.select(F.lit(name).alias("model"), key, "label", "prob", predicted_class(F.col("prob")).alias("pred"))


def prob_fusion(pred: DataFrame, key: str, base_models: Sequence[str], other_model: str,
                name: str = "fusion", other_weight: float = 0.5) -> DataFrame:
    """Blend of the base models' mean probability with one other model's probability."""
    is_base = F.col("model").isin(list(base_models))
    blended = pred.filter(is_base | (F.col("model") == other_model)).groupBy(key, "label").agg(
        (F.avg(F.when(is_base, F.col("prob"))) * (1 - other_weight)
         + F.max(F.when(F.col("model") == other_model, F.col("prob"))) * other_weight).alias("prob"))
    return blended.filter(F.col("prob").isNotNull()).select(
        F.lit(name).alias("model"), key, "label", "prob", predicted_class(F.col("prob")).alias("pred"))


def balanced_subset(pred: DataFrame) -> DataFrame:
    """Test predictions of first paths only, scored with the inclusive threshold."""
    kept = pred.filter((F.col("path_id") == 1) & (F.col("split") == "test"))
    return kept.withColumn("pred", predicted_class(F.col("prob")))


def metric_table(pred: DataFrame) -> DataFrame:
    """``model, accuracy, auc``."""
    acc = pred.groupBy("model").agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("accuracy"))
    return acc.join(auc_trapezoid(pred), "model")


def metric_delta(original: DataFrame, augmented: DataFrame) -> DataFrame:
    """Long comparison of two ``model, <metrics>`` tables: ``model, metric, original, augmented, delta``."""
    names = [c for c in original.columns if c != "model"]
    a = original.unpivot(["model"], names, "metric", "original")
    b = augmented.unpivot(["model"], names, "metric", "augmented")
    return a.join(b, ["model", "metric"]).withColumn("delta", F.col("augmented") - F.col("original"))


def best_model(metrics: DataFrame, score: str, largest: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """Name and value of the best model, per key; ties go to the smallest name."""
    order = F.struct(F.col(score) if not largest else -F.col(score), F.col("model"))
    return metrics.groupBy(*keys).agg(F.min_by("model", order).alias("model"),
                                      (F.max(score) if largest else F.min(score)).alias(score))


# --- regression -------------------------------------------------------------------------------

def regression_metrics(pred: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """RMSE, MAE and R2 per model of a ``y, yhat`` table.

    The total sum of squares is ``n * var_pop(y)``, which Spark accumulates around a running mean.
    """
    e = F.col("y") - F.col("yhat")
    return pred.groupBy(*keys).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1.0 - F.try_divide(F.avg(e * e), F.var_pop("y"))).alias("r2"), F.count("*").alias("n"))


def residuals_of_best(pred: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``y - yhat`` of the model with the smallest RMSE (per key); the best table is tiny."""
    metrics = regression_metrics(pred, [*keys, "model"])
    best = best_model(metrics, "rmse", largest=False, keys=keys).select(*keys, "model")
    return pred.join(F.broadcast(best), [*keys, "model"]).withColumn("residual", F.col("y") - F.col("yhat"))


def axis_limits(pred: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Common minimum and maximum of actual and predicted values."""
    return pred.groupBy(*keys).agg(F.least(F.min("y"), F.min("yhat")).alias("lo"),
                                   F.greatest(F.max("y"), F.max("yhat")).alias("hi"))


# --- training traces --------------------------------------------------------------------------

def plateau_early_stop(epochs: DataFrame, patience: int = 5, lr: float = 0.001, lr_patience: int = 2,
                       lr_factor: float = 0.5, rel_threshold: float = 1e-4) -> DataFrame:
    """Per run of ``run, epoch, val_loss``: stop epoch, best epoch and loss, final learning rate.

    Stops after ``patience`` epochs in a row without a new minimum. The learning rate is cut after
    more than ``lr_patience`` epochs in a row that fail to beat the best loss by ``rel_threshold``.
    The fold over one run holds that run's epochs, a number the training budget bounds.
    """
    trace = epochs.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("epoch", "val_loss"))).alias("t"))
    big = F.lit(float("inf"))
    start = F.struct(big.alias("best"), F.lit(0).cast("bigint").alias("best_epoch"), F.lit(0).alias("bad"),
                     F.lit(None).cast("bigint").alias("stop"), F.lit(0).cast("bigint").alias("last"),
                     big.alias("lr_best"), F.lit(0).alias("lr_bad"), F.lit(lr).alias("lr"))

    def step(acc, x):
        loss, epoch = x["val_loss"], x["epoch"].cast("bigint")
        lr_good = loss < acc["lr_best"] * (1.0 - rel_threshold)
        lr_bad = F.when(lr_good, F.lit(0)).otherwise(acc["lr_bad"] + 1)
        cut = lr_bad > lr_patience
        better = loss < acc["best"]
        bad = F.when(better, F.lit(0)).otherwise(acc["bad"] + 1)
        after = F.struct(
            F.when(better, loss).otherwise(acc["best"]).alias("best"),
            F.when(better, epoch).otherwise(acc["best_epoch"]).alias("best_epoch"), bad.alias("bad"),
            F.when(bad >= patience, epoch).alias("stop"), epoch.alias("last"),
            F.when(lr_good, loss).otherwise(acc["lr_best"]).alias("lr_best"),
            F.when(cut, F.lit(0)).otherwise(lr_bad).alias("lr_bad"),
            F.when(cut, acc["lr"] * lr_factor).otherwise(acc["lr"]).alias("lr"))
        return F.when(acc["stop"].isNotNull(), acc).otherwise(after)

    done = trace.select("run", F.aggregate("t", start, step).alias("s"))
    return done.select("run", F.col("s.stop").alias("stop_epoch"), F.col("s.last").alias("last_epoch"),
                       F.col("s.best_epoch").alias("best_epoch"), F.col("s.best").alias("best_loss"),
                       F.col("s.lr").alias("final_lr"))
