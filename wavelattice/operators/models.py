"""Supervised models on Spark ML, and the model-selection operators around them.

Train and test sets are DataFrames with plain double columns; vectors exist only next to the
estimators. Predictions always come back as the long table ``model, <keys>, label, prob, pred``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from wavelattice import schema as S
from wavelattice.functions.scalars import predicted_class
from wavelattice.functions.waves import bind
from wavelattice.operators import boosting, forests
from wavelattice.operators.profiling import attach_weights
from wavelattice.operators.splits import apply_scaling, scaler_statistics, stratified_folds
from wavelattice.session import concurrently, cut_lineage


@dataclass
class Fitted:
    """A fitted classifier: ``score`` adds a ``prob`` column (probability of class 1)."""

    name: str
    columns: list[str]
    score: Callable[[DataFrame], DataFrame]
    model: Model | None = None
    params: dict = field(default_factory=dict)
    refit: Callable[[DataFrame], "Fitted"] | None = None

    def predict(self, df: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
        """Long predictions for ``df``."""
        return self.score(df).select(F.lit(self.name).alias("model"), *keys,
                                     F.col(label).cast("int").alias("label"), "prob",
                                     predicted_class(F.col("prob")).alias("pred"))


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the ``features`` vector."""
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def _probability(df: DataFrame) -> Column:
    return vector_to_array("probability")[1]


def _vector_fit(name: str, estimator, train: DataFrame, columns: Sequence[str], label: str,
                weight: str | None) -> Fitted:
    """Fit one Spark ML classifier on assembled, class-weighted rows."""
    columns = list(columns)
    data = attach_weights(train, label, weight) if weight else train
    keep = ["features", F.col(label).cast("double").alias("label")] + (["weight"] if weight else [])
    ready = assemble(data, columns).select(*keep)
    estimator = estimator.copy().setFeaturesCol("features").setLabelCol("label")
    if weight:
        estimator = estimator.setWeightCol("weight")
    model = fit_trees(estimator, ready)

    def score(df: DataFrame) -> DataFrame:
        out = model.transform(assemble(df, columns))
        return out.withColumn("prob", _probability(out)).select(*df.columns, "prob")

    return Fitted(name, columns, score, model,
                  refit=lambda rows: _vector_fit(name, estimator, rows, columns, label, weight))


def fit_logistic(train: DataFrame, columns: Sequence[str], label: str = "label", c: float = 1.0,
                 max_iter: int = 1000, balanced: bool = True) -> Fitted:
    """Standardised L2 logistic regression with balanced class weights.

    Spark averages the loss by the weight sum; dividing the penalty by it gives the usual ``C``.
    Balanced weights sum to the number of rows.
    """
    columns = list(columns)
    stats = scaler_statistics(train, columns)
    n = train.count()
    est = LogisticRegression(regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False,
                             maxIter=max_iter, tol=1e-6)
    inner = _vector_fit("logistic", est, apply_scaling(train, stats), columns, label,
                        "balanced_weight" if balanced else None)

    def score(df: DataFrame) -> DataFrame:
        raw = [F.col(c).alias(f"_raw_{c}") for c in columns]
        scored = inner.score(apply_scaling(df.select("*", *raw), stats))
        back = {c: F.col(f"_raw_{c}") for c in columns}
        return scored.withColumns(back).select(*df.columns, "prob")

    return Fitted("logistic", columns, score, inner.model, {"C": c, "scaling": stats},
                  refit=lambda rows: fit_logistic(rows, columns, label, c, max_iter, balanced))


def fourier_features(df: DataFrame, columns: Sequence[str], gamma: float, size: int = 256,
                     seed: int = S.SEED) -> DataFrame:
    """Add ``features``: seeded random Fourier features of the Gaussian kernel ``exp(-gamma d^2)``."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), (len(columns), size))
    b = rng.uniform(0.0, 2.0 * np.pi, size)

    @F.arrow_udf("array<double>")
    def lift(x: pa.Array) -> pa.Array:
        v = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(w))
        z = np.sqrt(2.0 / size) * np.cos(v @ w + b)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * size), pa.array(z.ravel()))

    return df.withColumn("features", array_to_vector(lift(F.array(*[F.col(c).cast("double") for c in columns]))))


def fit_svm_rbf(train: DataFrame, columns: Sequence[str], label: str = "label", c: float = 1.0,
                gamma: str | float = "scale", size: int = 256, max_iter: int = 50, seed: int = S.SEED) -> Fitted:
    """Gaussian-kernel SVM by random Fourier features, linear SVM and a logistic fit of its margin.

    All train rows are used: the cost is linear in the rows, unlike a kernel solver's. Rows are
    standardised, so both usual gamma rules (``scale``, ``auto``) are one over the feature count.
    """
    columns = list(columns)
    stats = scaler_statistics(train, columns)
    g = 1.0 / len(columns) if isinstance(gamma, str) else gamma
    # the scaled rows are kept, not their lifted ones: these are ten times as wide, quickly made and kept by the fit itself
    data = attach_weights(apply_scaling(train, stats), label).select(*columns, F.col(label).cast("double").alias("_label"), "weight").persist(
        StorageLevel.MEMORY_AND_DISK)
    lifted = fourier_features(data, columns, g, size, seed).select("features", F.col("_label").alias("label"), "weight")
    n = data.count()
    svm = LinearSVC(regParam=1.0 / (c * n), standardization=False, maxIter=max_iter, weightCol="weight").fit(lifted)

    def margin(df: DataFrame) -> DataFrame:
        return svm.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])

    platt = LogisticRegression(featuresCol="m", weightCol="weight", maxIter=100).fit(
        VectorAssembler(inputCols=["margin"], outputCol="m").transform(margin(lifted)).select("m", "label", "weight"))
    data.unpersist()
    a, b = float(platt.coefficients[0]), float(platt.intercept)

    def score(df: DataFrame) -> DataFrame:
        scaled = df.select("*", *[((F.col(x) - F.lit(m)) / F.lit(s)).alias(f"_s_{x}") for x, (m, s) in stats.items()])
        out = margin(fourier_features(scaled, [f"_s_{x}" for x in columns], g, size, seed))
        return out.withColumn("prob", 1.0 / (1.0 + F.exp(-(F.col("margin") * a + b)))).select(*df.columns, "prob")

    return Fitted("svm_rbf", columns, score, svm, {"C": c, "gamma": g},
                  refit=lambda rows: fit_svm_rbf(rows, columns, label, c, gamma, size, max_iter, seed))


# The parameter grids of the evaluation protocol (None depth is Spark's deepest, 30).
SVM_GRID = {"c": [0.1, 1.0, 10.0], "gamma": ["scale", "auto"]}
FOREST_GRID = {"numTrees": [300, 500], "maxDepth": [20, 30], "minInstancesPerNode": [1, 3]}
GBT_GRID = {"stepSize": [0.05, 0.1], "maxIter": [200, 500], "maxDepth": [4, 6]}
BOOST_GRID = {"maxIter": [200, 500], "maxDepth": [4, 6, 8], "stepSize": [0.01, 0.05, 0.1],
              "subsamplingRate": [0.8, 1.0]}
FOREST_REG_GRID = {"numTrees": [200, 300], "maxDepth": [20, 30], "minInstancesPerNode": [1, 3]}
GBT_REG_GRID = {"maxIter": [200, 300], "stepSize": [0.05, 0.1], "maxDepth": [5, 7]}
BOOST_REG_GRID = {"maxIter": [200, 500], "maxDepth": [4, 6, 8], "stepSize": [0.05, 0.1]}


def _param_maps(estimator, grid: dict) -> list:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


@dataclass
class Search:
    """Outcome of a grid search: refitted best model, its parameters and every mean score."""

    model: Model
    best: dict
    scores: list[tuple[dict, float]]


#: The parameter whose smaller values are prefixes of a fit with its largest one.
STAGED = {"GBTClassifier": "maxIter", "GBTRegressor": "maxIter", "RandomForestClassifier": "numTrees", "RandomForestRegressor": "numTrees"}


def _named(name: str):
    found = SparkContext._active_spark_context._jvm
    for part in name.split("."):
        found = getattr(found, part)
    return found


def _of_trees(model: Model, trees: list, weights: list | None = None) -> Model:
    """A model like ``model`` made of the given Java trees."""
    sc, java = SparkContext._active_spark_context, model._java_obj

    def packed(items, kind):
        out = sc._gateway.new_array(kind, len(items))
        for i, item in enumerate(items):
            out[i] = item
        return out

    kept = [packed(trees, _named(trees[0].getClass().getName()))]
    if weights is not None:
        kept.append(packed(weights, sc._jvm.double))
    classes = [java.numClasses()] if type(model).__name__.endswith("ClassificationModel") else []
    made = _named(java.getClass().getName())(java.uid(), *kept, java.numFeatures(), *classes)
    if made.hasParam("numTrees"):  # forests divide by it
        made.set(made.getParam("numTrees"), len(trees))
    return type(model)(made)


def prefix_model(model: Model, trees: int) -> Model:
    """The model made of the first ``trees`` trees of a fitted ensemble.

    Each boosted tree depends on those before it alone, so for boosting this is the model that a fit with fewer rounds
    gives; trees of a forest do not depend on each other, so there it is a forest of that many trees.
    """
    java = model._java_obj
    all_trees = java.trees()
    if trees >= len(all_trees):
        return model
    weights = java.treeWeights() if type(model).__name__.startswith("GBT") else None
    return _of_trees(model, [all_trees[i] for i in range(trees)], weights and [weights[i] for i in range(trees)])


#: Trees of a forest that one fit by Spark grows, such fits that run side by side, and trees from which a forest grows within tasks.
FIT_TREES, FITS, OWN_TREES = 25, 12, 50


def _grows(estimator) -> bool:
    """Whether ``estimator`` is a forest that :mod:`forests` grows."""
    return type(estimator).__name__.startswith("RandomForest") and estimator.getNumTrees() > OWN_TREES


def _tries(estimator, width: int) -> int:
    """Features that a node of a forest draws: Spark's automatic choice, the root of all or, in a regression, a third."""
    return max(1, int(np.ceil(np.sqrt(width) if "Classifier" in type(estimator).__name__ else width / 3.0)))


def _grow(estimator, rows: forests.Rows, spark, **part) -> forests.Forest:
    """The forest of ``estimator`` on written rows; ``part`` are the fold left out and the feature numbers."""
    width = len(part["columns"]) if "columns" in part else rows.width
    return forests.grow(spark, rows, estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getMinInstancesPerNode(),
                        _tries(estimator, width), estimator.getSeed(), **part)


def fit_trees(estimator, ready: DataFrame) -> Model:
    """``estimator`` fitted on ``ready``; a forest of more than ``OWN_TREES`` trees grows within tasks (see :mod:`forests`).

    A smaller one, one of more than two classes, or one on more rows than a task holds is fitted by Spark, as forests of
    ``FIT_TREES`` trees that grow side by side and are put together: a level of a forest is one job with as many tasks as
    ``ready`` has, and every task sends its statistics of every node, so that more tasks for the rows cost more than they save.
    """
    total = estimator.getNumTrees() if estimator.hasParam("numTrees") else 0
    if _grows(estimator):
        rows = forests.written(ready, "Classifier" in type(estimator).__name__)
        if forests.fits(rows):
            return _grow(estimator, rows, ready.sparkSession)
    if total <= FIT_TREES:
        return estimator.fit(ready)
    kept = dealt(ready)
    seed = estimator.getSeed()

    def grow(i):
        size = min(FIT_TREES, total - i * FIT_TREES)
        return estimator.copy({estimator.numTrees: size, estimator.seed: seed + 1_000_003 * i}).fit(kept)

    parts = concurrently(ready.sparkSession, grow, range(-(-total // FIT_TREES)), FITS)
    kept.unpersist()
    return _of_trees(parts[0], [tree for part in parts for tree in part._java_obj.trees()])


def _chains(estimator, grid: dict) -> list[list[dict]]:
    """The points of a grid, grouped by all but the staged parameter and the depth; the points of a group by rising depth."""
    staged = STAGED.get(type(estimator).__name__)
    points = [{p.name: v for p, v in m.items()} for m in _param_maps(estimator, grid)]
    chains: dict[tuple, list[dict]] = {}
    for p in points:
        fixed = tuple(sorted((k, v) for k, v in p.items() if k not in (staged, "maxDepth")))
        chains.setdefault(fixed, []).append(p)
    return [sorted(c, key=lambda p: p.get("maxDepth", 0)) for c in chains.values()]


def _fit_chain(estimator, chain: list[dict], fit_on: DataFrame, score) -> list[float]:
    """Scores of the points of a chain in order, from as few fits as give the models of separate fits.

    Fewer trees are a prefix of the fit with most. A deeper limit gives the same trees if none has reached the lower one.
    """
    staged = STAGED.get(type(estimator).__name__)
    out, model, depth = [], None, None
    most = max((p[staged] for p in chain if staged in p), default=None)
    for p in chain:
        if model is None or (p.get("maxDepth") != depth and not max(t.depth for t in model.trees) < depth):
            full = {**p, staged: most} if most is not None else p
            model = estimator.copy({estimator.getParam(k): v for k, v in full.items()}).fit(fit_on)
        depth = p.get("maxDepth")
        out.append(score(prefix_model(model, p[staged]) if most is not None else model))
    return out


#: Rows of a task of a model fit: a fit is thousands of short jobs, whose cost is tasks rather than rows. Beyond ``FIT_TASKS``
#: tasks they take more rows each, up to ``FIT_MOST_ROWS`` (some 40 MB as a fit holds them).
FIT_ROWS, FIT_TASKS, FIT_MOST_ROWS = 10_000, 12, 200_000


def fit_tasks(n: int) -> int:
    """Tasks of a fit on ``n`` rows; the cluster has no say, as bootstrap samples depend on it."""
    return max(min(1 + n // FIT_ROWS, FIT_TASKS), 1 + n // FIT_MOST_ROWS)


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` kept in as many tasks as a fit takes (see :func:`fit_tasks`)."""
    kept = cut_lineage(rows)
    return kept.coalesce(fit_tasks(kept.count())).persist(StorageLevel.MEMORY_AND_DISK)


def _in_one(ready: DataFrame) -> DataFrame:
    """Kept rows in one part, which a task of :mod:`boosting` grows a whole model on; more than ``FIT_MOST_ROWS`` stay dealt."""
    return ready.coalesce(1) if ready.count() <= FIT_MOST_ROWS else ready


def _boosted_search(estimator, grid: dict, ready: DataFrame, evaluator, folds: int, parallelism: int) -> Search:
    """A search of boosted trees: all settings grow together on the rows without each fold and on all rows, so that no refit follows."""
    points = [{p.name: v for p, v in m.items()} for m in _param_maps(estimator, grid)]
    full = [{p.name: v for p, v in estimator.extractParamMap().items()} | p for p in points]
    fits: dict[tuple, int] = {}
    for p in full:  # fewer rounds are a prefix of the fit with most
        at = (p["maxDepth"], p["stepSize"], p["subsamplingRate"])
        fits[at] = max(fits.get(at, 0), p["maxIter"])
    settings = [boosting.Setting(rounds, *at, without) for at, rounds in fits.items() for without in (*range(folds), None)]
    settings.sort(key=lambda s: -s.rounds * s.depth)  # the longest first
    grown = dict(zip([(s.depth, s.step, s.share, s.without) for s in settings],
                     boosting.grow(_in_one(ready), settings, type(estimator).__name__ == "GBTClassifier", estimator.getSeed())))

    def model(p, without):
        return grown[p["maxDepth"], p["stepSize"], p["subsamplingRate"], without].first(p["maxIter"])

    def score(task):
        p, f = task
        return evaluator.evaluate(model(p, f).transform(ready.filter(F.col("fold") == f)))

    values = concurrently(ready.sparkSession, score, [(p, f) for p in full for f in range(folds)], parallelism)
    means = [float(np.mean(sorted(v))) for v in np.array(values).reshape(len(full), folds)]
    best = int(np.argmax(means) if evaluator.isLargerBetter() else np.argmin(means))
    return Search(model(full[best], None), points[best], list(zip(points, means)))


#: Parameters that a joint growth of boosted trees knows; a search over others fits one by one.
JOINT = {"maxIter", "maxDepth", "stepSize", "subsamplingRate"}


#: The same for forests.
FOREST_JOINT = {"numTrees", "maxDepth", "minInstancesPerNode"}


def _forest_search(estimator, grid: dict, ready: DataFrame, evaluator, folds: int, parallelism: int) -> Search:
    """A search of forests: one growth to the deepest limit with most trees per leaf size and fold, as the others are parts of it."""
    spark = ready.sparkSession
    rows = forests.written(ready, "Classifier" in type(estimator).__name__)
    if not forests.fits(rows):
        return _separate_searches(spark, {"one": (estimator, grid, ready, evaluator)}, folds, parallelism)["one"]
    points = [{p.name: v for p, v in m.items()} for m in _param_maps(estimator, grid)]
    full = [{p.name: v for p, v in estimator.extractParamMap().items()} | p for p in points]
    most, leaves = {k: max(p[k] for p in full) for k in ("numTrees", "maxDepth")}, list(dict.fromkeys(p["minInstancesPerNode"] for p in full))

    def grown(p, **part):
        return _grow(estimator.copy({estimator.getParam(k): v for k, v in p.items()}), rows, spark, **part)

    def run(task):
        leaf, f = task
        model, held = grown({**most, "minInstancesPerNode": leaf}, without=f), ready.filter(F.col("fold") == f)
        out = {(p["numTrees"], p["maxDepth"], leaf, f): evaluator.evaluate(model.first(p["numTrees"]).to_depth(p["maxDepth"]).transform(held))
               for p in full if p["minInstancesPerNode"] == leaf}
        model.forget()
        return out

    values = {k: v for part in concurrently(spark, run, [(leaf, f) for leaf in leaves for f in range(folds)], parallelism) for k, v in part.items()}
    means = [float(np.mean(sorted(values[p["numTrees"], p["maxDepth"], p["minInstancesPerNode"], f] for f in range(folds)))) for p in full]
    best = int(np.argmax(means) if evaluator.isLargerBetter() else np.argmin(means))
    return Search(grown(points[best]), points[best], list(zip(points, means)))


def search_grids(jobs: dict[str, tuple], folds: int, parallelism: int = 16) -> dict[str, Search]:
    """Exhaustive searches of several ``name: (estimator, grid, ready, evaluator)`` over column ``fold``, then refits on all rows.

    Boosted trees of a search grow together, large forests within tasks. All fits of the others are independent and share one pool of driver threads, the
    longest first.
    """
    spark = next(iter(jobs.values()))[2].sparkSession
    jobs = {n: (est, grid, dealt(ready), ev) for n, (est, grid, ready, ev) in jobs.items()}
    joint = [n for n, (est, grid, _, _) in jobs.items() if type(est).__name__.startswith("GBT") and set(grid) <= JOINT]
    trees = [n for n, (est, grid, _, _) in jobs.items() if set(grid) <= FOREST_JOINT and any(
        _grows(est.copy(m)) for m in _param_maps(est, grid))]
    single = {n: job for n, job in jobs.items() if n not in joint + trees}
    searches = [(lambda n=n: {n: _boosted_search(*jobs[n], folds, parallelism)}) for n in joint]
    searches += [(lambda n=n: {n: _forest_search(*jobs[n], folds, parallelism)}) for n in trees]
    if single:
        searches.append(lambda: _separate_searches(spark, single, folds, parallelism))
    found = {n: s for part in concurrently(spark, lambda search: search(), searches, len(searches)) for n, s in part.items()}
    for _, _, ready, _ in jobs.values():
        ready.unpersist()
    return {n: found[n] for n in jobs}


def _separate_searches(spark, jobs: dict[str, tuple], folds: int, parallelism: int) -> dict[str, Search]:
    tasks = [(n, i, chain, f) for n, (est, grid, _, _) in jobs.items() for i, chain in enumerate(_chains(est, grid)) for f in range(folds)]
    trees = {"maxIter": 3.0, "numTrees": 1.0}  # a boosted tree is a round of jobs, the trees of a forest share them

    def cost(task):
        staged = STAGED.get(type(jobs[task[0]][0]).__name__)
        return max(p.get(staged, 1) * p.get("maxDepth", 5) for p in task[2]) * trees.get(staged, 1.0)

    def run(task):
        n, _, chain, f = task
        est, _, ready, evaluator = jobs[n]
        held = ready.filter(F.col("fold") == f)
        return _fit_chain(est, chain, ready.filter(F.col("fold") != f), lambda model: evaluator.evaluate(model.transform(held)))

    tasks.sort(key=cost, reverse=True)
    done = concurrently(spark, run, tasks, parallelism)
    scores: dict[str, dict[tuple, list[float]]] = {n: {} for n in jobs}
    for (n, _, chain, _), values in zip(tasks, done):
        for p, v in zip(chain, values):
            scores[n].setdefault(tuple(sorted(p.items())), []).append(v)

    def refit(n):
        est, grid, ready, evaluator = jobs[n]
        points = [{p.name: v for p, v in m.items()} for m in _param_maps(est, grid)]
        means = [float(np.mean(sorted(scores[n][tuple(sorted(p.items()))]))) for p in points]
        best = points[int(np.argmax(means) if evaluator.isLargerBetter() else np.argmin(means))]
        return Search(est.copy({est.getParam(k): v for k, v in best.items()}).fit(ready), best, list(zip(points, means)))

    return dict(zip(jobs, concurrently(spark, refit, list(jobs), parallelism)))


def grid_search(estimator, grid: dict, ready: DataFrame, evaluator, folds: int, parallelism: int = 16) -> Search:
    """Exhaustive search over the folds given by column ``fold``, then a refit on all rows (see :func:`search_grids`)."""
    return search_grids({"one": (estimator, grid, ready, evaluator)}, folds, parallelism)["one"]


def _classifier_job(estimator, grid: dict, train: DataFrame, columns: Sequence[str], key: str, label: str, weight: str | None,
                    folds: int) -> tuple:
    data = attach_weights(train, label, weight) if weight else train
    folded = stratified_folds(data, key, label, folds)
    keep = ["features", F.col(label).cast("double").alias("label"), "fold"] + (["weight"] if weight else [])
    est = estimator.copy().setFeaturesCol("features").setLabelCol("label")
    return (est.setWeightCol("weight") if weight else est), grid, assemble(folded, columns).select(*keep), \
        MulticlassClassificationEvaluator(metricName="f1")


def _searched(name: str, found: Search, est, columns: list[str], label: str, weight: str | None) -> Fitted:
    def score(df: DataFrame) -> DataFrame:
        out = found.model.transform(assemble(df, columns))
        return out.withColumn("prob", _probability(out)).select(*df.columns, "prob")

    final = est.copy({est.getParam(p): v for p, v in found.best.items()})
    return Fitted(name, columns, score, found.model, {"best": found.best, "scores": found.scores},
                  refit=lambda rows: _vector_fit(name, final, rows, columns, label, weight))


def fit_grid(name: str, estimator, grid: dict, train: DataFrame, columns: Sequence[str], key: str,
             label: str = "label", weight: str | None = "balanced_weight", folds: int = 5,
             parallelism: int = 16) -> Fitted:
    """Grid search of a Spark ML classifier by weighted F1 over stratified folds, then refit."""
    columns = list(columns)
    job = _classifier_job(estimator, grid, train, columns, key, label, weight, folds)
    return _searched(name, grid_search(*job, folds, parallelism), job[0], columns, label, weight)


def fit_svm_grid(train: DataFrame, columns: Sequence[str], key: str, label: str = "label",
                 grid: dict | None = None, folds: int = 5, size: int = 256, parallelism: int = 8) -> Fitted:
    """Grid search of :func:`fit_svm_rbf` over its own folds by weighted F1."""
    grid = grid or SVM_GRID
    folded = dealt(stratified_folds(train, key, label, folds))
    evaluator = MulticlassClassificationEvaluator(metricName="f1", labelCol="_y", predictionCol="_p")
    combos = [(c, gamma) for c in grid["c"] for gamma in grid["gamma"]]
    # on standardised rows both rules are one number, and equal numbers are fitted once
    value = {gamma: 1.0 / len(list(columns)) if isinstance(gamma, str) else float(gamma) for gamma in grid["gamma"]}
    fits = list(dict.fromkeys((c, value[gamma]) for c, gamma in combos))

    def run(task):
        (c, gamma), f = task
        fit = fit_svm_rbf(folded.filter(F.col("fold") != f), columns, label, c, gamma, size)
        out = fit.predict(folded.filter(F.col("fold") == f), [key], label)
        return evaluator.evaluate(out.select(F.col("label").cast("double").alias("_y"),
                                             F.col("pred").cast("double").alias("_p")))

    values = concurrently(train.sparkSession, run, [(c, f) for c in fits for f in range(folds)], parallelism)
    means = dict(zip(fits, np.array(values).reshape(len(fits), folds).mean(axis=1)))
    scores = [({"c": c, "gamma": g}, float(means[c, value[g]])) for c, g in combos]
    folded.unpersist()
    best = max(scores, key=lambda s: s[1])[0]
    fitted = fit_svm_rbf(train, columns, label, best["c"], best["gamma"], size)
    fitted.params.update(best=best, scores=scores)
    return fitted


#: Node statistics that a tree fit gathers in one job, so that a level of many trees is one job.
FIT_MEMORY_MB = 1024


def forest(trees: int = 300, depth: int = 20, leaf: int = 1, seed: int = S.SEED) -> RandomForestClassifier:
    """Random forest estimator; Spark's depth limit is 30.

    The rows keep the node they are in: otherwise every job takes all trees so far from the driver to the tasks. Trees are the same.
    """
    return RandomForestClassifier(numTrees=trees, maxDepth=min(depth, 30), minInstancesPerNode=leaf, seed=seed,
                                  maxMemoryInMB=FIT_MEMORY_MB, cacheNodeIds=True)


def boosted(iters: int = 200, depth: int = 4, step: float = 0.1, subsample: float = 1.0,
            seed: int = S.SEED) -> GBTClassifier:
    """Histogram gradient boosting estimator."""
    return GBTClassifier(maxIter=iters, maxDepth=depth, stepSize=step, subsamplingRate=subsample, seed=seed)


def fit_forest(train, columns, label="label", trees=300, depth=20, leaf=1, seed=S.SEED) -> Fitted:
    """Random forest with balanced weights."""
    return _vector_fit("random_forest", forest(trees, depth, leaf, seed), train, columns, label, "balanced_weight")


def _refit_boosted(name: str, estimator, rows: DataFrame, columns: Sequence[str], label: str, weight: str) -> Fitted:
    """A boosted classifier on ``rows``; grown within one task up to ``FIT_MOST_ROWS`` (see :mod:`boosting`), else by Spark's fit."""
    columns, stage = list(columns), estimator.copy()
    data = attach_weights(rows, label, weight)
    ready = dealt(assemble(data, columns).select("features", F.col(label).cast("double").alias("label"), "weight", F.lit(0).alias("fold")))
    one = _in_one(ready)
    if one.rdd.getNumPartitions() > 1:
        ready.unpersist()
        return _vector_fit(name, stage, rows, columns, label, weight)
    p = {q.name: v for q, v in stage.extractParamMap().items()}
    setting = boosting.Setting(p["maxIter"], p["maxDepth"], p["stepSize"], p["subsamplingRate"], None)
    model = boosting.grow(one, [setting], True, stage.getSeed())[0]
    ready.unpersist()

    def score(df: DataFrame) -> DataFrame:
        out = model.transform(assemble(df, columns))
        return out.withColumn("prob", _probability(out)).select(*df.columns, "prob")

    return Fitted(name, columns, score, model, refit=lambda more: _refit_boosted(name, estimator, more, columns, label, weight))


def _boosted_fit(name: str, estimator, train: DataFrame, columns: Sequence[str], label: str, weight: str) -> Fitted:
    fitted = _vector_fit(name, estimator, train, columns, label, weight)
    fitted.refit = lambda rows: _refit_boosted(name, estimator, rows, columns, label, weight)
    return fitted


def fit_gbt(train, columns, label="label", iters=200, depth=4, step=0.1, seed=S.SEED) -> Fitted:
    """Gradient boosting with the mean-one boosting weights."""
    return _boosted_fit("gbt", boosted(iters, depth, step, 1.0, seed), train, columns, label, "boost_weight")


def fit_boost(train, columns, label="label", iters=200, depth=6, step=0.1, subsample=0.8, seed=S.SEED) -> Fitted:
    """Row-subsampled gradient boosting, class 1 weighted by the negative/positive ratio."""
    return _boosted_fit("boost", boosted(iters, depth, step, subsample, seed), train, columns, label, "pos_weight")


def pooled_wave(wave: Column, parts: int) -> Column:
    """Mean amplitude of ``parts`` equal stretches of the wave."""
    def pool(w):
        n = F.size(w)

        def mean(i):
            lo = F.floor(i * n / parts).cast("int")
            hi = F.greatest(F.floor((i + 1) * n / parts).cast("int"), lo + 1)
            return F.aggregate(F.slice(w, lo + 1, hi - lo), F.lit(0.0), lambda a, x: a + x) / (hi - lo)

        return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), mean)

    return bind(wave, pool)


def fit_waveform_nn(train: DataFrame, scalars: Sequence[str], wave: str = "cir", label: str = "label",
                    parts: int = 32, hidden: Sequence[int] = (32, 16), max_iter: int = 100,
                    seed: int = S.SEED) -> Fitted:
    """Perceptron on the pooled raw wave and the scalars; standardised on the train rows."""
    scalars = list(scalars)

    def vectors(df: DataFrame) -> DataFrame:
        values = F.concat(pooled_wave(F.col(wave), parts), F.array(*[F.col(c).cast("double") for c in scalars]))
        return df.withColumn("raw", array_to_vector(values))

    ready = vectors(train.select(wave, *scalars, F.col(label).cast("double").alias("label"))).select("raw", "label")
    layers = [parts + len(scalars), *hidden, 2]
    model = Pipeline(stages=[
        StandardScaler(inputCol="raw", outputCol="features", withMean=True),
        MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed, blockSize=256)]).fit(
        ready.persist(StorageLevel.MEMORY_AND_DISK))
    ready.unpersist()

    def score(df: DataFrame) -> DataFrame:
        out = model.transform(vectors(df))
        return out.withColumn("prob", _probability(out)).select(*df.columns, "prob")

    return Fitted("waveform_nn", scalars, score, model,
                  refit=lambda rows: fit_waveform_nn(rows, scalars, wave, label, parts, hidden, max_iter, seed))


def boosting_trace(fitted: Fitted, validation: DataFrame, label: str = "label", run: str = "boosting") -> DataFrame:
    """``run, epoch, val_loss``: the loss on ``validation`` after every round of a fitted boosted model, from one scan."""
    ready = assemble(validation, fitted.columns).select("features", F.col(label).cast("double").alias("label"), F.lit(1.0).alias("weight"))
    losses = fitted.model.evaluateEachIteration(ready)
    return validation.sparkSession.createDataFrame(
        [(run, i + 1, float(v)) for i, v in enumerate(losses)], "run string, epoch long, val_loss double")  # one row per round


def stopped_at(fitted: Fitted, epoch: int) -> Fitted:
    """A boosted model cut back to its first ``epoch`` rounds."""
    model = prefix_model(fitted.model, epoch)

    def score(df: DataFrame) -> DataFrame:
        out = model.transform(assemble(df, fitted.columns))
        return out.withColumn("prob", _probability(out)).select(*df.columns, "prob")

    return Fitted(fitted.name, fitted.columns, score, model, {**fitted.params, "rounds": epoch}, fitted.refit)


def fit_waveform_nn_stopped(train: DataFrame, validation: DataFrame, scalars: Sequence[str], wave: str = "cir", label: str = "label",
                            parts: int = 32, hidden: Sequence[int] = (32, 16), steps: int = 10, max_epochs: int = 50,
                            patience: int = 5, seed: int = S.SEED) -> tuple[Fitted, DataFrame]:
    """The perceptron of :func:`fit_waveform_nn`, stopped once its validation loss has not improved for ``patience`` epochs.

    An epoch is ``steps`` optimiser steps that start from the weights of the last one. Returns the model of the best epoch and
    the trace ``run, epoch, val_loss`` (log loss), which :func:`metrics.plateau_early_stop` reads.
    """
    scalars = list(scalars)

    def vectors(df: DataFrame) -> DataFrame:
        values = F.concat(pooled_wave(F.col(wave), parts), F.array(*[F.col(c).cast("double") for c in scalars]))
        return df.withColumn("raw", array_to_vector(values))

    columns = [wave, *scalars, F.col(label).cast("double").alias("label")]
    raw = dealt(vectors(train.select(*columns)).select("raw", "label"))
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(raw)
    ready = scaler.transform(raw).persist(StorageLevel.MEMORY_AND_DISK)
    held = dealt(scaler.transform(vectors(validation.select(*columns))).select("features", "label"))
    layers = [parts + len(scalars), *hidden, 2]
    weights, trace, best, bad = None, [], None, 0
    while bad < patience and len(trace) < max_epochs:
        net = MultilayerPerceptronClassifier(layers=layers, maxIter=steps, seed=seed, blockSize=256)
        model = (net.setInitialWeights(weights) if weights is not None else net).fit(ready)
        weights = model.weights
        p = F.greatest(F.least(_probability(model.transform(held)), F.lit(1 - 1e-12)), F.lit(1e-12))
        loss = model.transform(held).agg(F.avg(-F.when(F.col("label") == 1, F.log(p)).otherwise(F.log(1 - p)))).first()[0]  # one row
        trace.append((name := "waveform_nn", len(trace) + 1, float(loss)))
        if best is None or loss < best[0]:
            best, bad = (loss, model), 0
        else:
            bad += 1
    ready.unpersist(), raw.unpersist(), held.unpersist()
    chosen = best[1]

    def score(df: DataFrame) -> DataFrame:
        out = chosen.transform(scaler.transform(vectors(df)))
        return out.withColumn("prob", _probability(out)).select(*df.columns, "prob")

    epochs = train.sparkSession.createDataFrame(trace, "run string, epoch long, val_loss double")  # one row per epoch
    return Fitted(name, scalars, score, chosen, {"epochs": len(trace)}), epochs


def cross_val_predict(fitted: Fitted, train: DataFrame, key: str, label: str = "label", folds: int = 5,
                      seed: int = S.SEED, parallelism: int = 8) -> DataFrame:
    """Out-of-fold predictions: every train row scored by a model that never saw it."""
    folded = dealt(stratified_folds(train, key, label, folds, seed))

    def run(f):
        return fitted.refit(folded.filter(F.col("fold") != f)).predict(folded.filter(F.col("fold") == f), [key], label)

    parts = concurrently(train.sparkSession, run, range(folds), parallelism)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fit_stacked(base: Sequence[Fitted], train: DataFrame, key: str, label: str = "label",
                folds: int = 5) -> Fitted:
    """Logistic meta-model over the out-of-fold probabilities of at least two base models."""
    if len(base) < 2:
        raise ValueError("stacking needs at least two base models")
    names = [b.name for b in base]
    parts = concurrently(train.sparkSession, lambda b: cross_val_predict(b, train, key, label, folds), base, len(base))
    oof = parts[0]
    for part in parts[1:]:
        oof = oof.unionByName(part)
    wide = oof.groupBy(key, "label").pivot("model", names).agg(F.first("prob"))
    n = train.count()
    ready = assemble(wide, names).select("features", F.col("label").cast("double").alias("label"))
    meta = LogisticRegression(regParam=1.0 / n, elasticNetParam=0.0, standardization=False, maxIter=1000).fit(ready)

    def score(df: DataFrame) -> DataFrame:
        # base probabilities are columns of the same row: no join
        scored = df
        for b in base:
            scored = b.score(scored).withColumnRenamed("prob", f"_base_{b.name}")
        z = F.lit(float(meta.intercept))
        for b, w in zip(base, meta.coefficients):
            z = z + F.col(f"_base_{b.name}") * F.lit(float(w))
        return scored.withColumn("prob", 1.0 / (1.0 + F.exp(-z))).select(*df.columns, "prob")

    return Fitted("ensemble_stacked", list(base[0].columns), score, meta,
                  {"weights": dict(zip(names, map(float, meta.coefficients)))})


def predict_all(models: Sequence[Fitted], df: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """Long predictions of several models with one scan: scores are columns, then one explode."""
    scored = df
    for m in models:
        scored = m.score(scored).withColumnRenamed("prob", f"_p_{m.name}")
    rows = F.array(*[F.struct(F.lit(m.name).alias("model"), F.col(f"_p_{m.name}").alias("prob")) for m in models])
    return scored.select(*keys, F.col(label).cast("int").alias("label"), F.explode(rows).alias("r")).select(
        "r.model", *keys, "label", "r.prob", predicted_class(F.col("r.prob")).alias("pred"))


def train_classifiers(train: DataFrame, columns: Sequence[str], key: str, label: str = "label",
                      grids: dict | None = None, folds: int = 5, parallelism: int = 16,
                      seed: int = S.SEED) -> dict[str, Fitted]:
    """All classifier families with their grids (overridable per family)."""
    grids = {"svm_rbf": SVM_GRID, "random_forest": FOREST_GRID, "gbt": GBT_GRID, "boost": BOOST_GRID, **(grids or {})}
    out = {"logistic": fit_logistic(train, columns, label)}
    out["svm_rbf"] = fit_svm_grid(train, columns, key, label, grids["svm_rbf"], folds)
    columns = list(columns)
    # Fixed rule: boosting weights of the histogram family, the negative/positive ratio for the other
    families = {"random_forest": (forest(seed=seed), "balanced_weight"), "gbt": (boosted(seed=seed), "boost_weight"),
                "boost": (boosted(seed=seed), "pos_weight")}
    jobs = {n: _classifier_job(est, grids[n], train, columns, key, label, w, folds) for n, (est, w) in families.items()}
    for n, found in search_grids(jobs, folds, parallelism).items():
        out[n] = _searched(n, found, jobs[n][0], columns, label, families[n][1])
    return out


def feature_importance_topk(spark, fitted: Fitted, k: int = 20) -> DataFrame:
    """``feature, importance`` of the k most important features of a tree model."""
    rows = [(c, float(v)) for c, v in zip(fitted.columns, fitted.model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature").limit(k)


def model_complexity(spark, models: Sequence[Fitted]) -> DataFrame:
    """``model, kind, size, trees, input_dim``: weights, nodes or network parameters."""
    rows = []
    for m in models:
        model = m.model.stages[-1] if hasattr(m.model, "stages") else m.model
        if hasattr(model, "totalNumNodes"):
            rows.append((m.name, "nodes", int(model.totalNumNodes), int(model.getNumTrees), int(model.numFeatures)))
        elif hasattr(model, "weights"):
            rows.append((m.name, "parameters", int(len(model.weights)), 0, int(model.numFeatures)))
        else:
            rows.append((m.name, "weights", int(len(model.coefficients)) + 1, 0, int(model.numFeatures)))
    return spark.createDataFrame(rows, "model string, kind string, size long, trees int, input_dim int")


# --- recursive feature elimination --------------------------------------------------------------

def _eliminate(fit, columns: list[str], each=None) -> list[str]:
    """Drop the least important feature until one remains; the one that remains first, then the others, last dropped first.

    ``fit`` gives the model of some columns.
    """
    left, dropped = list(columns), []
    while True:
        model = fit(left)
        if each:
            each(left, model)
        if len(left) <= 1:
            return left + dropped[::-1]
        scores = model.featureImportances.toArray()
        if isinstance(model, forests.Forest):
            model.forget()
        worst = left[int(np.argmin(scores))]
        left = [c for c in left if c != worst]
        dropped.append(worst)


def rfecv(train: DataFrame, columns: Sequence[str], key: str, label: str = "label", estimator=None,
          folds: int = 3, seed: int = S.SEED, parallelism: int = 8) -> dict:
    """Recursive feature elimination with cross-validated accuracy.

    Returns the curve (``n_features -> mean accuracy``), the best size (smallest on ties), the
    selected features and the ranking. The folds and the elimination on all rows run side by side; every fit is distributed.
    """
    columns = list(columns)
    estimator = (estimator or forest(seed=seed)).copy().setFeaturesCol("features").setLabelCol("label")
    data = dealt(stratified_folds(train.select(key, *columns, F.col(label).cast("double").alias("label")), key, "label", folds, seed))
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy")
    rows = forests.written(assemble(data, columns).select("features", "label", "fold"), True) if _grows(estimator) else None

    def fit(f):
        if rows is not None and forests.fits(rows):
            return lambda left: _grow(estimator, rows, train.sparkSession, without=f, columns=[columns.index(c) for c in left])
        learn = data if f is None else data.filter(F.col("fold") != f)
        return lambda left: estimator.fit(assemble(learn, left).select("features", "label"))

    def run(f):
        if f is None:
            return _eliminate(fit(f), columns)
        held = data.filter(F.col("fold") == f)
        reached = {}

        def each(left, model):
            reached[len(left)] = evaluator.evaluate(model.transform(assemble(held, left)))

        _eliminate(fit(f), columns, each)
        return reached

    order, *curves = concurrently(train.sparkSession, run, [None, *range(folds)], parallelism)
    data.unpersist()
    curve = {n: sum(c[n] for c in curves) / folds for n in range(1, len(columns) + 1)}
    best = min(curve, key=lambda n: (-round(curve[n], 12), n))
    ranking = {c: 1 for c in order[:best]} | {c: i + 2 for i, c in enumerate(order[best:])}
    return {"curve": curve, "best": best, "selected": [c for c in columns if ranking[c] == 1], "ranking": ranking}


def optimal_size(curve: DataFrame) -> DataFrame:
    """First ``n_features`` with the highest score of a ``n_features, score`` table."""
    order = F.struct((-F.col("score")).alias("s"), F.col("n_features").alias("n"))
    return curve.agg(F.min_by("n_features", order).alias("n_features"), F.max("score").alias("score"))


# --- regression ---------------------------------------------------------------------------------

def fit_ridge(train: DataFrame, columns: Sequence[str], target: str, alpha: float = 1.0) -> dict:
    """Standardised ridge regression in closed form from one distributed covariance aggregate.

    Only ``(d+1)^2`` sums reach the driver. Returns coefficients in the original units.
    """
    from wavelattice.operators.clustering import covariance_matrix
    columns = list(columns)
    cov = covariance_matrix(train, [*columns, target])
    row = train.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate([*columns, target])]).first()
    d, n = len(columns), row["n"]
    mean = np.array([row[f"m{i}"] for i in range(d)])
    sd = np.sqrt(np.diag(cov)[:d])
    sd[sd == 0] = 1.0
    gram = n * cov[:d, :d] / np.outer(sd, sd)
    w = np.linalg.solve(gram + alpha * np.eye(d), n * cov[:d, d] / sd) / sd
    return {"columns": columns, "coef": w, "intercept": row[f"m{d}"] - float(mean @ w)}


def linear_score(df: DataFrame, model: dict, name: str = "yhat") -> DataFrame:
    """Add the prediction of a linear model as column arithmetic."""
    z = F.lit(float(model["intercept"]))
    for c, w in zip(model["columns"], model["coef"]):
        z = z + F.col(c) * F.lit(float(w))
    return df.withColumn(name, z)


def train_regressors(train: DataFrame, test: DataFrame, columns: Sequence[str], key: str, target: str = "range_m",
                     grids: dict | None = None, folds: int = 3, parallelism: int = 16, seed: int = S.SEED,
                     only: Sequence[str] = ("ridge", "random_forest", "gbt", "boost")) -> DataFrame:
    """Ridge, forest and two boosted regressors; returns ``model, <key>, y, yhat`` for the test rows.

    ``only`` names the ones to fit. Trees search their grids by mean squared error over unshuffled folds.
    """
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    from wavelattice.operators.splits import contiguous_folds
    columns = list(columns)
    grids = {"random_forest": FOREST_REG_GRID, "gbt": GBT_REG_GRID, "boost": BOOST_REG_GRID, **(grids or {})}
    y = F.col(target).cast("double").alias("y")
    train = train.select(key, *columns, y).persist(StorageLevel.MEMORY_AND_DISK)
    scored = test.select(key, *columns, y)
    if "ridge" in only:
        scored = linear_score(scored, fit_ridge(train, columns, "y"), "_p_ridge")
    ready = assemble(contiguous_folds(train, key, folds), columns).select(
        "features", F.col("y").alias("label"), "fold")
    memory = {"seed": seed, "maxMemoryInMB": FIT_MEMORY_MB}
    estimators = {"random_forest": RandomForestRegressor(cacheNodeIds=True, **memory), "gbt": GBTRegressor(**memory),
                  "boost": GBTRegressor(subsamplingRate=0.8, **memory)}
    estimators = {name: est for name, est in estimators.items() if name in only}
    scored = assemble(scored, columns)
    jobs = {name: (est, grids[name], ready, RegressionEvaluator(metricName="mse")) for name, est in estimators.items()}
    for name, found in (search_grids(jobs, folds, parallelism) if jobs else {}).items():
        scored = found.model.setPredictionCol(f"_p_{name}").transform(scored)
    train.unpersist()
    names = [m for m in ("ridge", *estimators) if m in only]
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"_p_{m}").alias("yhat")) for m in names])
    return scored.select(key, "y", F.explode(rows).alias("r")).select("r.model", key, "y", "r.yhat")


def path_regression(features: DataFrame, path_id: int, key: str = "sample_id", **options) -> DataFrame:
    """Distance regression of one path of the expanded feature table.

    The first path uses the 25 features; the second adds the measured range and keeps only rows
    whose second path was detected.
    """
    from wavelattice.operators.paths import valid_second_paths
    rows = features.filter(F.col("path_id") == 1) if path_id == 1 else valid_second_paths(features)
    columns = S.FEATURES + (["RANGE"] if path_id == 2 else [])
    return train_regressors(rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "test"),
                            columns, key, **options)
