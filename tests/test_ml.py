import random


from blockbeam.ml import forest as M


def _frame(spark, n=240):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        vals = {c: rnd.random() * 10 for c in M.FEATURES_V2}
        vals["proportionOfReceiversWith90AccInBlock"] = None  # empty scored set (Q6)
        label = int(vals["changeInBtcPriceBtwCurrAnd1HrAgo"] > 5)
        split = "train" if i < 160 else ("valid" if i < 200 else "test")
        rows.append((f"b{i:04d}", i * 60, label, split, *[vals[c] for c in M.FEATURES_V2]))
    schema = "blockId string, blockFloorTime long, label int, split string, " + ", ".join(
        f"{c} double" for c in M.FEATURES_V2)
    return spark.createDataFrame(rows, schema)


def test_fixed_seed_is_deterministic(spark):
    df = _frame(spark)
    train = df.filter("split = 'train'")
    a = M.score(M.train_forest(train, M.FEATURES_V2, numTrees=5, maxDepth=3, seed=1), df, M.FEATURES_V2)
    b = M.score(M.train_forest(train, M.FEATURES_V2, numTrees=5, maxDepth=3, seed=1), df, M.FEATURES_V2)
    pa = [r.prediction for r in a.orderBy("blockId").collect()]
    pb = [r.prediction for r in b.orderBy("blockId").collect()]
    assert pa == pb and len(pa) == 240


def test_report_and_importances(spark):
    df = _frame(spark)
    rep = M.train_report(df, M.FEATURES_V2, numTrees=5, maxDepth=3, seed=1)
    sets = {r.scored_set for r in rep.select("scored_set").distinct().collect()}
    assert sets == {"valid", "test", "valid_test"}
    both = M.train_report(df, M.FEATURES_V2, ("valid", "test"), with_importances=True, numTrees=5, maxDepth=3, seed=1)
    per = {r.scored_set: r["count"] for r in both.groupBy("scored_set").count().collect()}
    assert per == {"valid": 13, "test": 13, "train": len(M.FEATURES_V2)}
    assert abs(both.filter("metric = 'importance'").agg({"value": "sum"}).first()[0] - 1.0) < 1e-9
    acc = rep.filter("metric = 'accuracy' AND scored_set = 'valid'").first().value
    assert 0.0 <= acc <= 1.0
    model = M.train_forest(df.filter("split = 'train'"), M.FEATURES_V2, numTrees=5, maxDepth=3, seed=1)
    imp = M.importances(spark, model, M.FEATURES_V2).collect()
    assert len(imp) == len(M.FEATURES_V2) and abs(sum(r.importance for r in imp) - 1.0) < 1e-9


def test_tuning_grid_and_best(spark):
    df = _frame(spark)
    _, table, acc = M.tune_forest(df, M.FEATURES_V2, trees=(2, 3), depths=(2, 3), folds=2, parallelism=2,
                                  time_folds=True)
    rows = table.collect()
    assert len(rows) == 4 and 0.0 <= acc <= 1.0
    best = M.best_params(table).first()
    assert best.avg_accuracy == max(r.avg_accuracy for r in rows)


def test_stored_forest_is_fitted_once_and_reloaded(spark, monkeypatch):
    df = _frame(spark)
    train = df.filter("split = 'train'")
    fits = []
    real = M.train_forest
    monkeypatch.setattr(M, "train_forest", lambda *a, **k: fits.append(1) or real(*a, **k))
    args = dict(numTrees=4, maxDepth=3, seed=5)
    a = M.stored_forest(train, M.FEATURES_V2, **args)
    b = M.stored_forest(train.repartition(7), M.FEATURES_V2, **args)
    assert fits == [1]  # the same rows in another order and layout
    fresh = M.score(real(train, M.FEATURES_V2, **args), df, M.FEATURES_V2)
    for m in (a, b):
        assert sorted(map(tuple, M.score(m, df, M.FEATURES_V2).collect())) == sorted(map(tuple, fresh.collect()))
    M.stored_forest(train, M.FEATURES_V2, numTrees=4, maxDepth=2, seed=5)
    M.stored_forest(train.filter("blockId <> 'b0003'"), M.FEATURES_V2, **args)
    M.stored_forest(train, M.FEATURES_V2, partitions=3, **args)
    assert len(fits) == 4  # other parameters, rows or partitions are another forest


def test_saved_forest_reloads(spark, tmp_out):
    df = _frame(spark)
    model = M.train_forest(df.filter("split = 'train'"), M.FEATURES_V2, numTrees=3, maxDepth=3, seed=2)
    path = tmp_out("forest")
    model.save(path)
    back = M.load_model(path)
    assert back.toDebugString == model.toDebugString
    assert sorted(map(tuple, M.importances(spark, back, M.FEATURES_V2).collect())) == sorted(map(tuple, M.importances(spark, model, M.FEATURES_V2).collect()))


def test_time_folds_and_embargo(spark):
    """Folds are slices of time of equal size; near the held-out slice no training row is used."""
    from pyspark.ml import Estimator, Model
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(f"b{i:03d}", 60 * i, i % 2) for i in range(100)], "blockId string, blockFloorTime long, label int")
    folds = M.with_time_folds(df.repartition(5), ["blockFloorTime", "blockId"], 4)
    by = {r.fold: (r.a, r.b, r.n) for r in folds.groupBy("fold").agg(F.min("blockFloorTime").alias("a"), F.max("blockFloorTime").alias("b"), F.count("*").alias("n")).collect()}
    assert by == {k: (1500 * k, 1500 * k + 1440, 25) for k in range(4)}
    seen = []

    class Always(Model):
        def _transform(self, data):
            return data.withColumn("prediction", F.lit(0.0))

    class Spy(Estimator):
        def _fit(self, data):
            seen.append({r.blockFloorTime for r in data.select("blockFloorTime").collect()})
            return Always()

    ev = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    data = folds.withColumn("label", F.col("label").cast("double"))
    got = M.time_fold_validate(Spy(), [{}, {}], ev, data, folds=4, embargo=600, parallelism=1)
    assert len(got) == 2 and all(abs(g - (13 + 12 + 13 + 12) / 100) < 0.02 for g in got)
    for k, times in enumerate(seen[::2]):
        a, b = 1500 * k, 1500 * k + 1440
        assert times == {60 * i for i in range(100) if 60 * i <= a - 600 or 60 * i >= b + 600}
