"""Registered queries: classification metrics and the forest jobs (AGG-15,
ML-1 ... ML-7, SRT-6, JOB-8). Inputs are the stand-in block features and their
chronological split; the model queries are rows-only checks plus unit tests."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from ..ml import forest as M
from ..sinks.staging import staged
from ..operators.metrics import classification_metrics
from . import jobs as J, standins as S
from .catalog import query
from .q_receivers import features
from .sqlviews import BLOCKS, CANDLES, FEATURES, FIRSTS, HITS, OUTS, POP, RAW, split_sql, with_

_FEAT = with_(OUTS, CANDLES, RAW, POP, HITS, FIRSTS, BLOCKS, FEATURES)

# A fixed rule stands in for a model when checking the metric arithmetic against SQL:
# predict a rise when the price rose over the last hour.
_RULE_SQL = "CASE WHEN changeInBtcPriceBtwCurrAnd1HrAgo > 0 THEN 1.0 ELSE 0.0 END"

_SPLITTED = _FEAT + ", " + split_sql(S.TRAIN_BLOCKS_V2, S.VALID_BLOCKS)

_RULE_PREDS = f"""
, preds AS (SELECT {_RULE_SQL} AS p, CAST(label AS DOUBLE) AS l FROM splitted WHERE split <> 'train')"""

# metrics of the predictions p and labels l in ``preds``
_METRICS_SQL = """,
cm AS (SELECT p, l, count(*) AS n FROM preds GROUP BY p, l),
tot AS (SELECT sum(n) AS total FROM cm),
per AS (
  SELECT b.l, b.cnt, b.tp, coalesce(f.fp, 0) AS fp FROM
    (SELECT l, sum(n) AS cnt, sum(CASE WHEN p = l THEN n ELSE 0 END) AS tp FROM cm GROUP BY l) b
    LEFT JOIN (SELECT p AS l, sum(n) AS fp FROM cm WHERE p <> l GROUP BY p) f USING (l)),
m AS (
  SELECT l, cnt, tp,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS precision,
         CAST(tp AS DOUBLE) / CAST(cnt AS DOUBLE) AS recall,
         CAST(fp AS DOUBLE) / CAST((SELECT total FROM tot) - cnt AS DOUBLE) AS fpr FROM per),
m2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2.0 * precision * recall / (precision + recall) END AS f1
       FROM m)
SELECT metric, l AS label, value FROM m2
  UNPIVOT (value FOR metric IN (precision, recall, fpr, f1))
UNION ALL
SELECT 'accuracy', NULL, CAST(sum(tp) AS DOUBLE) / CAST((SELECT total FROM tot) AS DOUBLE) FROM m2
UNION ALL
SELECT 'weighted_' || names.k, NULL, w.v FROM (VALUES ('precision'), ('recall'), ('fpr'), ('f1')) names(k)
LEFT JOIN (
  SELECT k, list_reduce(list_prepend(0.0, list(v ORDER BY l)), lambda a, b: a + b) AS v FROM (
    SELECT l, k, v * CAST(cnt AS DOUBLE) / CAST((SELECT total FROM tot) AS DOUBLE) AS v
    FROM m2 UNPIVOT (v FOR k IN (precision, recall, fpr, f1))) GROUP BY k) w ON w.k = names.k"""


@query("classification_metrics", _SPLITTED + _RULE_PREDS + _METRICS_SQL)
def q_classification_metrics(spark, sf):
    """AGG-15: metrics of the last-hour-rise rule on the valid + test blocks."""
    f = features(spark, sf, 2).filter(F.col("split") != "train")
    preds = f.select(F.when(F.col("changeInBtcPriceBtwCurrAnd1HrAgo") > 0, 1.0).otherwise(0.0).alias("prediction"),
                     F.col("label").cast("double").alias("label"))
    return classification_metrics(preds)


def _splits(spark, sf, version):
    """The split feature table, staged once per key."""
    return staged(features(spark, sf, version), "splits")


def _assembled_sql() -> str:
    vals = ", ".join(f"coalesce({c}, 0.0)" if c.startswith("proportionOf") else f"CAST({c} AS DOUBLE)"
                     for c in M.FEATURES_V1)
    return (_FEAT + ", " + split_sql(S.TRAIN_BLOCKS_V1, S.VALID_BLOCKS) + f"""
SELECT blockId, CAST(i - 1 AS INTEGER) AS feature_idx, v AS value FROM (
  SELECT blockId, unnest(list_value({vals})) AS v, unnest(range(1, {len(M.FEATURES_V1) + 1})) AS i
  FROM splitted)""")


@query("ml_assembled", _assembled_sql())
def q_ml_assembled(spark, sf):
    """ML-1: the 17 V1 features of each block (train, valid and test) assembled into one vector
    (VectorAssembler), listed as (block, feature index, value)."""
    f = features(spark, sf, 1)
    arr = M.assembled_arrays(f, M.FEATURES_V1)
    return arr.select("blockId", F.posexplode("features").alias("feature_idx", "value"))


@query("ml_rf_default")
def q_ml_rf_default(spark, sf):
    """ML-2: default forest on the V1 training blocks, scored on the validation blocks."""
    sp = _splits(spark, sf, 1)
    model = M.stored_forest(sp.filter(F.col("split") == "train"), M.FEATURES_V1, seed=1000)
    return M.score(model, sp.filter(F.col("split") == "valid"), M.FEATURES_V1)


def _tuned(spark, sf):
    sp = _splits(spark, sf, 2)
    return sp, M.stored_forest(sp.filter(F.col("split") == "train"), M.FEATURES_V2, **M.TUNED)


@query("ml_rf_tuned")
def q_ml_rf_tuned(spark, sf):
    """ML-3: gini, depth 10, 500 trees, seed 1000 on the V2 training blocks; valid scores."""
    sp, model = _tuned(spark, sf)
    return M.score(model, sp.filter(F.col("split") == "valid"), M.FEATURES_V2)


@query("ml_predictions")
def q_ml_predictions(spark, sf):
    """ML-4: the tuned forest's predictions on valid, test and valid+test."""
    sp, model = _tuned(spark, sf)
    out = None
    for name, cond in M.SCORED_SETS.items():
        s = M.score(model, sp.filter(cond), M.FEATURES_V2).withColumn("scored_set", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out


@query("ml_metrics")
def q_ml_metrics(spark, sf):
    """ML-5: metrics per scored set for the tuned forest."""
    return M.train_report(_splits(spark, sf, 2), M.FEATURES_V2, **M.TUNED)


@query("ml_importances")
def q_ml_importances(spark, sf):
    """ML-6: feature importances of the tuned forest."""
    _, model = _tuned(spark, sf)
    return M.importances(spark, model, M.FEATURES_V2)


# A forest of one tree of one split on four 0/1 flags, without sampling, is deterministic and
# small enough for SQL: the flag whose split leaves the least gini impurity, the first on a tie.
STUMP = dict(impurity="gini", numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", seed=1000)
_FLAGS = {f"rise{k}": c for k, c in enumerate(J.FEATURES_V2_EXTRA)}

_STUMP_SQL = _SPLITTED + f"""
, flagged AS (SELECT blockId, split, label, {", ".join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END AS {n}" for n, c in _FLAGS.items())}
              FROM splitted),
sides AS (
  SELECT name, count(*) FILTER (WHERE flag = 0 AND label = 0) AS l0, count(*) FILTER (WHERE flag = 0 AND label = 1) AS l1,
         count(*) FILTER (WHERE flag = 1 AND label = 0) AS r0, count(*) FILTER (WHERE flag = 1 AND label = 1) AS r1
  FROM (SELECT * FROM flagged WHERE split = 'train') UNPIVOT (flag FOR name IN ({", ".join(_FLAGS)})) GROUP BY name),
best AS (
  SELECT name, l1 > l0 AS low, r1 > r0 AS high FROM sides WHERE l0 + l1 > 0 AND r0 + r1 > 0
  ORDER BY CAST(l0 * l0 + l1 * l1 AS DOUBLE) / (l0 + l1) + CAST(r0 * r0 + r1 * r1 AS DOUBLE) / (r0 + r1) DESC, name LIMIT 1),
root AS (SELECT sum(label) * 2 > count(*) AS most FROM flagged WHERE split = 'train'),
scored AS (
  SELECT blockId, split, CAST(label AS DOUBLE) AS label, CAST(CASE
         {" ".join(f"WHEN (SELECT name FROM best) = '{n}' THEN CASE WHEN {n} = 1 THEN (SELECT high FROM best) ELSE (SELECT low FROM best) END" for n in _FLAGS)}
         ELSE (SELECT most FROM root) END AS DOUBLE) AS prediction FROM flagged)"""


def _stump(spark, sf):
    sp = _splits(spark, sf, 2).select("blockId", "blockFloorTime", "split", "label", *[
        F.when(F.col(c) > 0, 1.0).otherwise(0.0).alias(n) for n, c in _FLAGS.items()])
    return sp, M.stored_forest(sp.filter(F.col("split") == "train"), list(_FLAGS), **STUMP)


@query("ml_stump_predictions", _STUMP_SQL + "SELECT blockId, label, prediction FROM scored")
def q_ml_stump_predictions(spark, sf):
    """ML-2...ML-4 on the one-split forest: fitted on train, every block scored."""
    sp, model = _stump(spark, sf)
    return M.score(model, sp, list(_FLAGS)).select("blockId", "label", "prediction")


@query("ml_stump_metrics", _STUMP_SQL + """
, preds AS (SELECT prediction AS p, label AS l FROM scored WHERE split <> 'train')""" + _METRICS_SQL)
def q_ml_stump_metrics(spark, sf):
    """ML-5 on the one-split forest: metrics on valid + test."""
    sp, model = _stump(spark, sf)
    return classification_metrics(M.score(model, sp.filter(F.col("split") != "train"), list(_FLAGS)))


@query("ml_stump_importances", _STUMP_SQL + f"""
SELECT f.name AS feature, CASE WHEN f.name = b.name AND b.low <> b.high THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance
FROM (VALUES {", ".join(f"('{n}')" for n in _FLAGS)}) f(name) LEFT JOIN best b ON true""")
def q_ml_stump_importances(spark, sf):
    """ML-6 on the one-split forest; a split whose sides predict the same class is pruned."""
    _, model = _stump(spark, sf)
    return M.importances(spark, model, list(_FLAGS))


@query("ml_cv_grid")
def q_ml_cv_grid(spark, sf):
    """ML-7: 3 x 3 grid, 5-fold cross validation; mean accuracy per setting plus the
    validation accuracy of the refitted best model."""
    _, table, acc = M.tune_forest(_splits(spark, sf, 1))
    return table.withColumn("valid_accuracy", F.lit(acc))


# Cross validation that SQL can follow: one-split trees on the four flags, with a grid of the rows that a side of
# a split needs, over five slices of time with an embargo of four hours (the label's look-ahead) around the held-out one.
CV_LEAST, CV_EMBARGO = (1, 300, 600, 1_000_000), 4 * S.HOUR

_CV_SQL = _STUMP_SQL.split("sides AS (")[0].rstrip().rstrip(",") + f""",
timed AS (SELECT f.*, s.blockFloorTime AS t FROM flagged f JOIN splitted s USING (blockId)),
slices AS (SELECT *, CAST(((row_number() OVER (ORDER BY t, blockId) - 1) * 5) // count(*) OVER () AS INTEGER) AS fold
           FROM timed WHERE split = 'train'),
spans AS (SELECT fold, min(t) AS a, max(t) AS b FROM slices GROUP BY fold),
fits AS (
  SELECT h.fold AS k, s.blockId, s.label, {", ".join(_FLAGS)} FROM slices s JOIN spans h
    ON s.fold <> h.fold AND (s.t <= h.a - {CV_EMBARGO} OR s.t >= h.b + {CV_EMBARGO})
  UNION ALL SELECT -1, blockId, label, {", ".join(_FLAGS)} FROM slices),
sides AS (
  SELECT k, name, count(*) FILTER (WHERE flag = 0 AND label = 0) AS l0, count(*) FILTER (WHERE flag = 0 AND label = 1) AS l1,
         count(*) FILTER (WHERE flag = 1 AND label = 0) AS r0, count(*) FILTER (WHERE flag = 1 AND label = 1) AS r1
  FROM fits UNPIVOT (flag FOR name IN ({", ".join(_FLAGS)})) GROUP BY k, name),
least(m) AS (VALUES {", ".join(f"({m})" for m in CV_LEAST)}),
best AS (
  SELECT k, m, arg_min(s, (-score, name)) AS s FROM (
    SELECT s.k, l.m, s, name, CAST(l0 * l0 + l1 * l1 AS DOUBLE) / (l0 + l1) + CAST(r0 * r0 + r1 * r1 AS DOUBLE) / (r0 + r1) AS score
    FROM sides s, least l WHERE l0 + l1 >= l.m AND r0 + r1 >= l.m) GROUP BY k, m),
roots AS (SELECT k, sum(label) * 2 > count(*) AS most FROM fits GROUP BY k),
asked AS (SELECT fold AS k, label, {", ".join(_FLAGS)} FROM slices
          UNION ALL SELECT -1, label, {", ".join(_FLAGS)} FROM timed WHERE split = 'valid'),
told AS (
  SELECT a.k, l.m, a.label, CAST(CASE
         {" ".join(f"WHEN b.s.name = '{n}' THEN CASE WHEN a.{n} = 1 THEN b.s.r1 > b.s.r0 ELSE b.s.l1 > b.s.l0 END" for n in _FLAGS)}
         ELSE r.most END AS INTEGER) AS p
  FROM asked a CROSS JOIN least l JOIN roots r ON r.k = a.k LEFT JOIN best b ON b.k = a.k AND b.m = l.m),
folds AS (SELECT k, m, CAST(count(*) FILTER (WHERE p = label) AS DOUBLE) / count(*) AS accuracy FROM told GROUP BY k, m),
means AS (SELECT m, round(sum(accuracy) / 5, 12) AS avg_accuracy FROM folds WHERE k >= 0 GROUP BY m),
chosen AS (SELECT m FROM means ORDER BY avg_accuracy DESC, m LIMIT 1)
SELECT CAST(m AS INTEGER) AS min_rows, avg_accuracy, m = (SELECT m FROM chosen) AS best,
       (SELECT round(accuracy, 12) FROM folds WHERE k = -1 AND m = (SELECT m FROM chosen)) AS valid_accuracy FROM means"""


@query("ml_cv_stump_grid", _CV_SQL)
def q_ml_cv_stump_grid(spark, sf):
    """ML-7 on one-split trees: a grid of least rows a side, mean accuracies over five time folds with an embargo, and the
    validation accuracy of the tree refitted with the best setting."""
    flags = list(_FLAGS)
    sp = _splits(spark, sf, 2).select("blockId", "blockFloorTime", "split", "label", *[
        F.when(F.col(c) > 0, 1.0).otherwise(0.0).alias(n) for n, c in _FLAGS.items()])
    rf = RandomForestClassifier(labelCol="label", featuresCol="features", cacheNodeIds=True, **STUMP)
    grid = ParamGridBuilder().addGrid(rf.minInstancesPerNode, list(CV_LEAST)).build()
    _, metrics, acc = M.tune(rf, grid, staged(sp, "flags"), flags, time_folds=True, embargo=CV_EMBARGO)
    metrics = [round(m, 12) for m in metrics]
    best = max(range(len(grid)), key=lambda i: (metrics[i], -i))
    rows = [(m, v, i == best, round(acc, 12)) for i, (m, v) in enumerate(zip(CV_LEAST, metrics))]
    return spark.createDataFrame(rows, "min_rows int, avg_accuracy double, best boolean, valid_accuracy double")


_GRID_SQL = """
SELECT t AS num_trees, d AS max_depth, round(avg(accuracy), 12) AS avg_accuracy FROM (
  SELECT t, d, o_orderkey % 5 AS fold,
         CAST(count(*) FILTER (WHERE (o_totalprice > 300 * t + 10000 * (d % 3)) = (o_orderpriority < '3')) AS DOUBLE) / count(*) AS accuracy
  FROM orders, (VALUES (100), (250), (500)) tt(t), (VALUES (4), (10), (20), (22)) dd(d) GROUP BY ALL) GROUP BY ALL"""


@query("best_params", f"""
SELECT num_trees, max_depth, avg_accuracy FROM ({_GRID_SQL})
ORDER BY avg_accuracy DESC, num_trees, max_depth LIMIT 1""")
def q_best_params(spark, sf):
    """SRT-6: best setting by mean accuracy over five folds, for a grid of price rules on the
    orders instead of forests (the fits are ``ml_cv_grid``); depths 4, 10 and 22 give equal
    rules, so the best setting is a tie."""
    grid = F.explode(F.array(*[F.struct(F.lit(t).alias("num_trees"), F.lit(d).alias("max_depth"))
                               for t in (100, 250, 500) for d in (4, 10, 20, 22)]))
    rows = S.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", grid.alias("g"))
    limit = F.lit(300) * F.col("g.num_trees") + F.lit(10000) * (F.col("g.max_depth") % 3)
    hit = (F.col("o_totalprice") > limit) == (F.col("o_orderpriority") < "3")
    folds = rows.groupBy("g.num_trees", "g.max_depth", (F.col("o_orderkey") % 5).alias("fold")).agg(
        (F.count_if(hit).cast("double") / F.count(F.lit(1))).alias("accuracy"))
    return M.best_params(folds.groupBy("num_trees", "max_depth").agg(F.round(F.avg("accuracy"), 12).alias("avg_accuracy")))


@query("job_train_report_v1")
def q_job_train_report_v1(spark, sf):
    """JOB-8 (V1): default forest on the 17 V1 features; metrics on valid and test."""
    return M.train_report(_splits(spark, sf, 1), M.FEATURES_V1, sets=("valid", "test"), seed=1000)


@query("job_train_report_v2")
def q_job_train_report_v2(spark, sf):
    """JOB-8 (V2): tuned forest on the 19 V2 features; metrics on valid, test, valid+test, and the importances."""
    return M.train_report(_splits(spark, sf, 2), M.FEATURES_V2, with_importances=True, **M.TUNED)
