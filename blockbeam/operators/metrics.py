"""AGG-15: multi-class metrics from (prediction, label) rows.

The confusion counts are one ``groupBy(prediction, label).count()`` (partial
aggregation; at most labels x predictions rows); everything after that works on
that small table. Weighted figures add the per-label terms in label order so the
result does not depend on partitioning. Definitions follow Spark's
``MulticlassMetrics``: precision(l) = tp / (tp + fp) (0 when nothing is predicted
as l), recall(l) = tp / count(l), fpr(l) = fp / (total - count(l)) (NULL when every row has label l),
F1 = 2pr / (p + r) (0 when p + r = 0); weights are count(l) / total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sinks.staging import staged


def classification_metrics(preds: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Rows (metric, label, value); ``label`` is NULL for the overall figures."""
    cm = preds.select(F.col(prediction).cast("double").alias("p"), F.col(label).cast("double").alias("l")) \
        .groupBy("p", "l").agg(F.count(F.lit(1)).alias("n"))
    cm = staged(cm, "confusion")  # labels x predictions rows, read by every branch below
    by_label = cm.groupBy("l").agg(F.sum("n").alias("cnt"), F.sum(F.when(F.col("p") == F.col("l"), F.col("n"))
                                                                   .otherwise(0)).alias("tp"))
    fp = cm.filter(F.col("p") != F.col("l")).groupBy(F.col("p").alias("l")).agg(F.sum("n").alias("fp"))
    per = by_label.join(fp, "l", "left").fillna(0, subset=["fp"])
    total = cm.select(F.sum("n")).scalar()
    per = per.withColumns({
        "precision": F.when(F.col("tp") + F.col("fp") == 0, F.lit(0.0))
        .otherwise(F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")),
        "recall": F.col("tp").cast("double") / F.col("cnt").cast("double"),
        "fpr": F.try_divide(F.col("fp").cast("double"), (total - F.col("cnt")).cast("double")),
    })
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))))
    names = ("precision", "recall", "fpr", "f1")
    long = per.select("l", F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value"))
                                                for n in names])).alias("m"))
    per_rows = long.select(F.col("m.metric").alias("metric"), F.col("l").alias("label"), F.col("m.value").alias("value"))
    terms = per.select(F.struct("l", *[(F.col(n) * F.col("cnt").cast("double") / total.cast("double")).alias(n)
                                       for n in names], "tp").alias("s"))
    folded = terms.agg(F.array_sort(F.collect_list("s")).alias("a"))

    def ordered_sum(field):  # NULL when nothing was scored
        return F.when(F.size("a") > 0, F.aggregate("a", F.lit(0.0), lambda acc, s: acc + s[field].cast("double")))

    overall = folded.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("metric"), (ordered_sum("tp") / total.cast("double")).alias("value")),
        *[F.struct(F.lit(f"weighted_{n}").alias("metric"), ordered_sum(n).alias("value")) for n in names],
    )).alias("m")).select(F.col("m.metric").alias("metric"), F.lit(None).cast("double").alias("label"),
                          F.col("m.value").alias("value"))
    return per_rows.unionByName(overall)
