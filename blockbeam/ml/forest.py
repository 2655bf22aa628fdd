"""Random-forest training, scoring, tuning and reports on the block features
(ML-1 ... ML-7, JOB-8), with ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import MODEL_INPUTS_TUNER as FEATURES_TUNER, MODEL_INPUTS_V1 as FEATURES_V1, MODEL_INPUTS_V2 as FEATURES_V2
from ..operators.metrics import classification_metrics
from .store import load_model, stored

# Tuned forest and tuning grid of the reference.
TUNED = dict(impurity="gini", maxDepth=10, numTrees=500, featureSubsetStrategy="auto", seed=1000)
GRID_TREES = (100, 200, 500)
GRID_DEPTHS = (4, 10, 20)
FOLDS = 5
PARALLELISM = len(GRID_TREES) * len(GRID_DEPTHS)  # a fold fits all its settings at once
__all__ = ["FEATURES_TUNER", "FEATURES_V1", "FEATURES_V2", "load_model"]


def prepare(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Empty coverage shares are NULL (quirk Q6); the assembler needs numbers, so 0.0."""
    return df.fillna(0.0, subset=[c for c in features if c.startswith("proportionOf")])


def assembler(features: Sequence[str]) -> VectorAssembler:
    """ML-1."""
    return VectorAssembler(inputCols=list(features), outputCol="features")


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return assembler(features).transform(prepare(df, features))


FIT_PARTITIONS = 8
# Node-id caching (cacheNodeIds) changes only how instances find their tree nodes, not
# the forest: same predictions, ~3x faster for the depth-20 trees of the tuning grid.


def fit_frame(df: DataFrame, partitions: int = FIT_PARTITIONS) -> DataFrame:
    """Rows dealt by block id into ``partitions`` parts, each in block order. Bagging seeds
    depend on the partition index and the order of rows, so a fixed count (a parameter, the same at
    every size and on every cluster) gives the same forest for a fixed seed; the training sets
    are thousands of rows by the reference's cuts. Raise it for larger ones."""
    return df.repartition(partitions, "blockId").sortWithinPartitions("blockFloorTime", "blockId")


def train_forest(train: DataFrame, features: Sequence[str], partitions: int = FIT_PARTITIONS,
                 **params) -> RandomForestClassificationModel:
    """ML-2 (defaults) / ML-3 (``**TUNED``)."""
    data = fit_frame(assemble(train, features), partitions).select("features", "label")
    params = {"cacheNodeIds": True, **params}
    return RandomForestClassifier(labelCol="label", featuresCol="features", **params).fit(data)


def stored_forest(train: DataFrame, features: Sequence[str], partitions: int = FIT_PARTITIONS,
                  **params) -> RandomForestClassificationModel:
    """``train_forest`` by way of the model store: the same training rows and parameters are fitted once, and the
    model always comes from its saved files."""
    return stored(train, ["blockId", "blockFloorTime", *features, "label"], {**params, "features": list(features), "partitions": partitions},
                  lambda: train_forest(train, features, partitions, **params))


def score(model: RandomForestClassificationModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """ML-4."""
    return model.transform(assemble(df, features)).select("blockId", "blockFloorTime", "prediction",
                                                         F.col("label").cast("double").alias("label"))


def importances(spark: SparkSession, model: RandomForestClassificationModel, features: Sequence[str]) -> DataFrame:
    """ML-6: (feature, importance) rows from the fitted model's importance vector."""
    vals = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, vals)), "feature string, importance double")


def assembled_arrays(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """ML-1 output with the vector as an array (a stable, comparable schema)."""
    return assemble(df, features).select("blockId", vector_to_array("features").alias("features"))


SCORED_SETS = {"valid": "split = 'valid'", "test": "split = 'test'", "valid_test": "split <> 'train'"}


def model_report(model: RandomForestClassificationModel, splits: DataFrame, features: Sequence[str],
                 sets: Sequence[str] = tuple(SCORED_SETS), with_importances: bool = False) -> DataFrame:
    """Score the named sets; rows (scored_set, metric, label, value, feature). ``with_importances`` adds a row per
    feature with the metric ``importance``."""
    out = None
    for name in sets:
        m = classification_metrics(score(model, splits.filter(SCORED_SETS[name]), features)).select(
            F.lit(name).alias("scored_set"), "metric", "label", "value", F.lit(None).cast("string").alias("feature"))
        out = m if out is None else out.unionByName(m)
    if with_importances:
        imp = importances(splits.sparkSession, model, features)
        out = out.unionByName(imp.select(
            F.lit("train").alias("scored_set"), F.lit("importance").alias("metric"),
            F.lit(None).cast("double").alias("label"), F.col("importance").alias("value"), "feature"))
    return out


def train_report(splits: DataFrame, features: Sequence[str], sets: Sequence[str] = tuple(SCORED_SETS),
                 with_importances: bool = False, partitions: int = FIT_PARTITIONS, **params) -> DataFrame:
    """JOB-8: fit on train (or take the stored forest), then ``model_report``."""
    model = stored_forest(splits.filter(F.col("split") == "train"), features, partitions, **params)
    return model_report(model, splits, features, sets, with_importances)


def with_time_folds(df: DataFrame, order: Sequence[str], folds: int, name: str = "fold") -> DataFrame:
    """Add the fold of each row: ``folds`` contiguous slices of about equal size in the order of ``order``."""
    from ..operators.windows import row_index
    idx = row_index(df, list(order), "_idx")
    n = idx.select(F.count(F.lit(1))).scalar()
    return idx.withColumn(name, F.floor(F.col("_idx") * folds / n).cast("int")).drop("_idx")


def time_fold_validate(estimator: Estimator, grid: Sequence[dict], evaluator: Evaluator, data: DataFrame, *, folds: int = FOLDS,
                       fold_col: str = "fold", time_col: str = "blockFloorTime", embargo: int = 0,
                       parallelism: int = PARALLELISM, frame=lambda df: df) -> list[float]:
    """Mean metric of each setting over the folds of ``fold_col``. A setting is fitted on the other folds without the
    rows closer than ``embargo`` seconds to the held-out one: a label that looks ahead so far can't
    tell a training row what happens in the held-out fold, nor the other way round. ``frame`` deals out the training rows."""
    total = [0.0] * len(grid)
    for k in range(folds):
        held = data.filter(F.col(fold_col) == k)
        rest = data.filter(F.col(fold_col) != k)
        if embargo:
            span = held.agg(F.min(time_col).alias("a"), F.max(time_col).alias("b")).first()
            if span["a"] is not None:
                rest = rest.filter((F.col(time_col) <= span["a"] - embargo) | (F.col(time_col) >= span["b"] + embargo))
        rest = frame(rest).cache()
        held = held.cache()
        try:
            models = estimator.fitMultiple(rest, list(grid))

            def measured(_):
                i, model = next(models)
                return i, evaluator.evaluate(model.transform(held, grid[i]))
            with ThreadPool(min(parallelism, len(grid))) as pool:
                for i, metric in pool.imap_unordered(inheritable_thread_target(measured), range(len(grid))):
                    total[i] += metric
        finally:
            rest.unpersist()
            held.unpersist()
    return [t / folds for t in total]


def tune_forest(splits: DataFrame, features: Sequence[str] = FEATURES_TUNER, trees=GRID_TREES, depths=GRID_DEPTHS,
                folds: int = FOLDS, parallelism: int = PARALLELISM, seed: int = 1000, time_folds: bool = False,
                embargo: int = 0, partitions: int = FIT_PARTITIONS):
    """ML-7: assembler + forest pipeline, 3 x 3 grid, k-fold cross validation on
    accuracy. ``time_folds`` uses contiguous time slices as folds (quirk Q17)
    instead of random ones, with an ``embargo`` in seconds around the held-out one.
    Returns (model refitted with the best setting, grid table, validation accuracy)."""
    rf = RandomForestClassifier(labelCol="label", featuresCol="features", seed=seed, cacheNodeIds=True)
    grid = ParamGridBuilder().addGrid(rf.numTrees, list(trees)).addGrid(rf.maxDepth, list(depths)).build()
    model, metrics, acc = tune(rf, grid, splits, features, folds, parallelism, seed, time_folds, embargo, partitions)
    rows = [(int(pm[rf.numTrees]), int(pm[rf.maxDepth]), float(m)) for pm, m in zip(grid, metrics)]
    return model, splits.sparkSession.createDataFrame(rows, "num_trees int, max_depth int, avg_accuracy double"), acc


def tune(rf: RandomForestClassifier, grid: Sequence[dict], splits: DataFrame, features: Sequence[str], folds: int = FOLDS,
         parallelism: int = PARALLELISM, seed: int = 1000, time_folds: bool = False, embargo: int = 0,
         partitions: int = FIT_PARTITIONS):
    """Cross validation of any grid of ``rf`` on the training split; (refitted model, mean metric by setting, validation
    accuracy). Of equal settings the first of the grid is refitted."""
    train = prepare(splits.filter(F.col("split") == "train"), features)
    valid = prepare(splits.filter(F.col("split") == "valid"), features)
    pipe = Pipeline(stages=[assembler(features), rf])
    ev = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    data = train.withColumn("label", F.col("label").cast("double"))
    if time_folds:
        order = ["blockFloorTime", "blockId"]
        metrics = time_fold_validate(pipe, grid, ev, with_time_folds(data, order, folds), folds=folds, embargo=embargo,
                                     parallelism=parallelism, frame=lambda df: fit_frame(df, partitions))
        best = max(range(len(grid)), key=lambda i: (metrics[i], -i))
        model = pipe.fit(fit_frame(data, partitions), grid[best])
    else:
        cv = CrossValidator(estimator=pipe, estimatorParamMaps=list(grid), evaluator=ev, numFolds=folds,
                            parallelism=parallelism, seed=seed)
        fitted = cv.fit(fit_frame(data, partitions))
        model, metrics = fitted.bestModel, fitted.avgMetrics
    return model, metrics, ev.evaluate(model.transform(valid.withColumn("label", F.col("label").cast("double"))))


def best_params(grid_table: DataFrame) -> DataFrame:
    """SRT-6: the parameter set with the best mean metric; of equal ones the first of the grid
    (fewest trees, then least depth)."""
    rank = F.struct("avg_accuracy", -F.col("num_trees"), -F.col("max_depth"))
    return grid_table.agg(F.max_by(F.struct("num_trees", "max_depth"), rank).alias("b"),
                          F.max("avg_accuracy").alias("avg_accuracy")).select(
        F.col("b.num_trees").alias("num_trees"), F.col("b.max_depth").alias("max_depth"), "avg_accuracy")
