from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from blockbeam.operators.metrics import classification_metrics


def test_matches_spark_evaluator(spark):
    # three labels, label 2.0 is never predicted
    pairs = [(0.0, 0.0)] * 5 + [(1.0, 0.0)] * 2 + [(1.0, 1.0)] * 4 + [(0.0, 1.0)] + [(0.0, 2.0)] * 2 + [(1.0, 2.0)]
    df = spark.createDataFrame(pairs, "prediction double, label double")
    got = {(r.metric, r.label): r.value for r in classification_metrics(df).collect()}
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    checks = {("accuracy", None): "accuracy", ("weighted_precision", None): "weightedPrecision",
              ("weighted_recall", None): "weightedRecall", ("weighted_f1", None): "f1",
              ("weighted_fpr", None): "weightedFalsePositiveRate"}
    for k, name in checks.items():
        assert abs(got[k] - ev.setMetricName(name).evaluate(df)) < 1e-12, k
    for lab in (0.0, 1.0, 2.0):
        for mine, name in (("precision", "precisionByLabel"), ("recall", "recallByLabel"),
                           ("fpr", "falsePositiveRateByLabel"), ("f1", "fMeasureByLabel")):
            want = ev.setMetricName(name).setMetricLabel(lab).evaluate(df)
            assert abs(got[(mine, lab)] - want) < 1e-12, (mine, lab)
    assert got[("precision", 2.0)] == 0.0
