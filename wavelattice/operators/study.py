"""One study of a measurement table: train on its train rows, judge the fitted models on its test rows, cluster, summarise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wavelattice import schema as S
from wavelattice.operators import clustering, metrics, models, splits
from wavelattice.operators.augment import augment_waveforms
from wavelattice.operators.cleaning import drop_degenerate, normalize_wave
from wavelattice.operators.paths import measurement_features
from wavelattice.session import concurrently, cut_lineage

KEYS = ["sample_id", "path_id", "env_id"]
WAVE_MODEL = "waveform_nn"


def feature_rows(measurements: DataFrame) -> DataFrame:
    """The expanded feature table with ``split`` and ``row_id``; both paths of a measurement share the split."""
    split = splits.stratified_split(drop_degenerate(measurements), "sample_id", "NLOS")
    rows = measurement_features(split, keys=("sample_id", "env_id", "split"))
    return models.dealt(rows.withColumn("row_id", F.col("sample_id") * 2 + F.col("path_id")))


def wave_rows(measurements: DataFrame) -> DataFrame:
    """Normalised waves with scaled scalars, split like :func:`feature_rows`."""
    rows = splits.scale_and_split(normalize_wave(drop_degenerate(measurements)))
    return cut_lineage(rows.select("sample_id", "env_id", F.col("NLOS").alias("label"), "split", "cir", *S.SCALARS))


def _part(rows: DataFrame, split: str) -> DataFrame:
    return rows.filter(F.col("split") == split)


def fit_feature_models(train: DataFrame, key: str = "row_id", columns: Sequence[str] = tuple(S.FEATURES), stacked: bool = True,
                       **sizes) -> list[models.Fitted]:
    """Logistic model, forest and both boosted ensembles, then the stack of the three tree ensembles.

    ``sizes`` are keyword arguments of the fits by name (``forest={"trees": 20}``); the defaults are theirs.
    """
    fits = {"logistic": models.fit_logistic, "forest": models.fit_forest, "gbt": models.fit_gbt, "boost": models.fit_boost}
    out = concurrently(train.sparkSession, lambda f: fits[f](train, columns, **sizes.get(f, {})), list(fits), len(fits))
    return out + [models.fit_stacked(out[1:], train, key)] if stacked else out


def held_out_predictions(features: DataFrame, waves: DataFrame, fitted: Sequence[models.Fitted], wave_model: models.Fitted) -> DataFrame:
    """``model, sample_id, path_id, env_id, split, label, prob, pred`` of all models on the test rows of their own table.

    The waveform model sees a measurement once, as its first path.
    """
    own = models.predict_all(fitted, _part(features, "test"), [*KEYS, "split"])
    other = wave_model.predict(_part(waves, "test").withColumn("path_id", F.lit(1)), [*KEYS, "split"])
    return own.unionByName(other.select(*own.columns))


def balanced_predictions(pred: DataFrame, base: Sequence[str], wave_model: str = WAVE_MODEL) -> DataFrame:
    """First paths of the test rows, one row per measurement and model: all models, the mean of the base models, its blend with the
    waveform model.

    A measurement that lacks the waveform model's or all base models' probabilities has no blend.
    """
    rows = metrics.balanced_subset(pred).select("model", "sample_id", "label", "prob", "pred")
    out = rows
    for extra in (metrics.ensemble_average(rows, "sample_id", list(base)), metrics.prob_fusion(rows, "sample_id", list(base), wave_model)):
        out = out.unionByName(extra.filter(F.col("prob").isNotNull()).select(*rows.columns))
    return out


def augmentation_delta(waves: DataFrame, factor: int = 1, **sizes) -> DataFrame:
    """``model, metric`` changes of the waveform model when noisy, shifted and rescaled copies of the train waves are added."""
    train, test = _part(waves, "train"), _part(waves, "test")
    more = cut_lineage(augment_waveforms(train, factor=factor).drop("aug_round"))
    plain, again = (metrics.metric_table(models.fit_waveform_nn(t, S.SCALARS, **sizes).predict(test, ["sample_id"])) for t in (train, more))
    return metrics.metric_delta(plain, again)


def feature_clusters(features: DataFrame, columns: Sequence[str] = tuple(S.FEATURES), key: str = "row_id", eps: float = 2.0,
                     min_samples: int = 10, restarts: int = 10) -> DataFrame:
    """One row: two-means on the scaled features (fitted on train rows) and density clusters of the scaled test rows.

    Cluster numbers are named by the labels of the test rows, which also give accuracy and the adjusted Rand index; silhouettes
    are those of train and test rows.
    """
    columns = list(columns)
    rows = cut_lineage(splits.standard_scale(features, columns).select(key, "split", F.col("label").cast("int").alias("label"), *columns))
    centres, _ = clustering.kmeans_fit(_part(rows, "train"), columns, 2, restarts)
    labelled = clustering.kmeans_assign(rows, columns, centres)
    mapping = clustering.cluster_label_map(_part(labelled, "test"))
    mapped = cut_lineage(clustering.apply_label_map(labelled, mapping).withColumn("vec", F.array(*columns)))
    test = _part(mapped, "test")
    hit = (F.col("cluster") == F.col("label")).cast("double")
    out = mapped.agg(*[F.avg(F.when(F.col("split") == s, hit)).alias(f"{s}_accuracy") for s in ("train", "test")])
    parts = [clustering.silhouette(_part(mapped, s), key, "vec", ["cluster"]).agg(F.max("silhouette").alias(f"{s}_silhouette"))
             for s in ("train", "test")]
    parts.append(clustering.adjusted_rand(test, "label", "cluster"))
    dense = cut_lineage(clustering.dbscan(test.select(key, "vec"), key, "vec", eps, min_samples).withColumnRenamed(key, "_k"))
    parts.append(clustering.distinct_labels(dense).select("n_clusters", "n_noise"))
    named = dense.join(test.select(key, "label"), F.col("_k") == F.col(key)).select("cluster", "label")
    parts.append(clustering.dbscan_accuracy(named, "label").select(F.col("accuracy").alias("dbscan_accuracy"), "majority_accuracy"))
    for part in parts:
        out = out.join(F.broadcast(part))  # one row each
    return out


def report(summary: DataFrame, regression: DataFrame, clusters: DataFrame) -> DataFrame:
    """``section, model, metric, value``: the numbers of a study as one long table."""
    def long(df: DataFrame, section: str, model, drop: Sequence[str] = ()) -> DataFrame:
        names = [c for c in df.columns if c not in drop]
        cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names])
        return df.select(F.lit(section).alias("section"), model.alias("model"), F.inline(cells))

    return (long(summary, "classification", F.col("model"), ["model"])
            .unionByName(long(regression, "regression", F.concat_ws(" path ", "model", F.col("path_id").cast("string")), ["model", "path_id"]))
            .unionByName(long(clusters, "clustering", F.lit("kmeans and dbscan"))))
