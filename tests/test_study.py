"""A study over fitted models: its tables against their definitions over the same predictions."""

import numpy as np
import pytest

from wavelattice import schema as S
from wavelattice.operators import metrics, models, study
from wavelattice.plans import views as V
from wavelattice.session import cut_lineage

SF = "/root/testdata/sf0.001"
SIZES = {"forest": {"trees": 10, "depth": 5}, "gbt": {"iters": 4, "depth": 3}, "boost": {"iters": 4, "depth": 3}, "logistic": {"max_iter": 50}}


@pytest.fixture(scope="module")
def ran(spark):
    features, waves = study.feature_rows(V.sig(spark, SF)), study.wave_rows(V.sig(spark, SF))
    fitted = study.fit_feature_models(features.filter("split = 'train'"), **SIZES)
    wave_model = models.fit_waveform_nn(waves.filter("split = 'train'"), S.SCALARS, parts=8, hidden=(8,), max_iter=10)
    return features, waves, cut_lineage(study.held_out_predictions(features, waves, fitted, wave_model))


def test_every_model_scores_its_test_rows_once(ran):
    features, waves, pred = ran
    rows = pred.toPandas()
    assert set(rows.model) == {"logistic", "random_forest", "gbt", "boost", "ensemble_stacked", "waveform_nn"}
    assert not rows.duplicated(["model", "sample_id", "path_id"]).any() and set(rows.split) == {"test"}
    n, m = features.filter("split = 'test'").count(), waves.filter("split = 'test'").count()
    assert all(k == (m if name == "waveform_nn" else n) for name, k in rows.groupby("model").size().items())
    assert set(rows[rows.model == "waveform_nn"].sample_id) == set(rows[(rows.model == "gbt") & (rows.path_id == 1)].sample_id)


def test_balanced_scores_follow_their_definition(ran):
    rows = ran[2].toPandas()
    first = rows[rows.path_id == 1].pivot(index="sample_id", columns="model", values="prob")
    label = rows[rows.path_id == 1].groupby("sample_id").label.first()
    base = ["random_forest", "gbt", "boost"]
    want = {m: first[m] for m in first}
    want["ensemble_average"] = first[base].mean(axis=1)
    want["fusion"] = (first[base].mean(axis=1) + first.waveform_nn) / 2
    got = metrics.metric_table(study.balanced_predictions(ran[2], base)).toPandas().set_index("model")
    assert set(got.index) == set(want)
    for name, p in want.items():
        assert got.accuracy[name] == pytest.approx(((p >= 0.5).astype(int) == label).mean())
        pos, neg = p[label == 1].to_numpy(), p[label == 0].to_numpy()
        d = pos[:, None] - neg[None, :]
        assert got.auc[name] == pytest.approx(((d > 1e-12) + 0.5 * (np.abs(d) <= 1e-12)).mean(), abs=1e-6)


def test_clusters_of_scaled_features(ran):
    got = study.feature_clusters(ran[0], restarts=3).toPandas()
    assert len(got) == 1
    rows = ran[0].toPandas()
    x = rows[S.FEATURES].astype(float)
    fit = x[rows.split == "train"]
    z = ((x - fit.mean()) / fit.std(ddof=0).where(lambda s: s > 0, 1.0))[rows.split == "test"].to_numpy()
    near = (((z[:, None] - z[None]) ** 2).sum(axis=2) <= 4.0)
    core = near.sum(axis=1) >= 10
    comp = np.arange(len(z))
    while True:  # least core row reachable over core rows
        new = np.array([comp[near[i] & core].min() if core[i] else i for i in range(len(z))])
        if (new == comp).all():
            break
        comp = new
    assert got.n_clusters[0] == len(set(comp[core]))
    assert got.n_noise[0] == (~core & ~(near & core[None]).any(axis=1)).sum()
    for c in ("train_accuracy", "test_accuracy"):
        assert 0 <= got[c][0] <= 1
    assert got.test_accuracy[0] >= 0.5 - 1e-9
    assert all(-1 <= got[c][0] <= 1 for c in ("train_silhouette", "test_silhouette"))


def test_augmentation_delta_and_report(spark, ran):
    features, waves, pred = ran
    delta = study.augmentation_delta(waves, parts=8, hidden=(8,), max_iter=5).toPandas()
    assert sorted(delta.metric) == ["accuracy", "auc"]
    assert np.allclose(delta.delta, delta.augmented - delta.original)
    from pyspark.sql import functions as F
    ridge = metrics.regression_metrics(models.path_regression(features, 1, only=["ridge"])).withColumn("path_id", F.lit(1))
    clusters = cut_lineage(study.feature_clusters(features, restarts=2))
    out = study.report(metrics.model_summary_table(pred), ridge, clusters).toPandas()
    assert set(out.section) == {"classification", "regression", "clustering"}
    assert not out.duplicated(["section", "model", "metric"]).any()
    assert (out[out.section == "classification"].groupby("model").size() > 5).all()
