"""Binary classification metrics as aggregates over (truth, prediction, score), for any number of models at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vitalsieve.functions.columns import col, quoted
from vitalsieve.functions.ordering import linear_bucket, order_bucket

_PER_OCTAVE = 65_536
_CROWDED = 50_000  # distinct scores in a bucket from which it may be cut further
_PIECES = 10_000  # no piece need hold more than this fraction of all distinct scores

METRICS = ("accuracy", "balanced_accuracy", "precision", "recall", "specificity", "f1", "roc_auc", "avg_precision", "pr_trapezoid")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion(df: DataFrame, truth: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp; cells without rows are zero."""
    y, p = col(truth), col(prediction)
    return df.groupBy(*map(quoted, by)).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def threshold_metrics(df: DataFrame, truth: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion cells with accuracy, balanced accuracy, precision, recall, specificity and F1; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return (
        confusion(df, truth, prediction, by)
        .withColumn("accuracy", _ratio(tp + tn, tp + tn + fp + fn))
        .withColumn("precision", _ratio(tp, tp + fp))
        .withColumn("recall", _ratio(tp, tp + fn))
        .withColumn("specificity", _ratio(tn, tn + fp))
        .withColumn("balanced_accuracy", (F.col("recall") + F.col("specificity")) / 2)
        .withColumn("f1", _ratio(tp * 2, tp * 2 + fp + fn))
    )


def score_curve(df: DataFrame, truth: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: (by..., score, pos, neg, tp, fp, n_pos, n_neg), tp and fp counted from the top score.

    Ties are counted together before anything is ordered. Running sums are formed inside score buckets; a small
    table of bucket totals gives each bucket its start, so no task orders all scores. Buckets with more than a
    ten-thousandth of all distinct scores, of which there are at most ten thousand, are cut further.
    """
    keys = list(by)
    ids = ["_k"] if keys else []
    kept = [F.struct(*[col(k).alias(k) for k in keys]).alias("_k")] if keys else []
    tied = (
        df.filter(col(score).isNotNull())
        .select(*kept, col(score).cast("double").alias("score"), col(truth).alias("_y"))
        .groupBy(*ids, "score")
        .agg(F.sum((F.col("_y") == 1).cast("long")).alias("pos"), F.sum((F.col("_y") == 0).cast("long")).alias("neg"))
        .withColumn("bucket", F.coalesce(order_bucket(F.col("score"), _PER_OCTAVE), F.lit(0).cast("long")))
    )
    # Every use of the tied counts below reads all its columns, so that one shuffle serves them all.
    spans = tied.groupBy(*ids, "bucket").agg(F.count(F.col("pos") + F.col("neg")).alias("d"), F.min("score").alias("lo"), F.max("score").alias("hi"))
    limit = F.greatest(F.lit(_CROWDED), spans.agg(F.sum("d") / _PIECES).scalar())
    crowded = spans.filter(F.col("d") > limit).withColumn("parts", F.ceil(F.col("d") / limit))
    tied = tied.join(F.broadcast(crowded), [*ids, "bucket"], "left").withColumn(
        "piece", F.coalesce(linear_bucket(F.col("score"), F.col("lo"), F.col("hi"), F.col("parts")), F.lit(0).cast("long"))
    ).select(*ids, "score", "pos", "neg", "bucket", "piece")

    totals = tied.groupBy(*ids, "bucket", "piece").agg(F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    whole = W.partitionBy(*ids) if ids else W.partitionBy(F.lit(1))
    above = whole.orderBy(F.desc("bucket"), F.desc("piece")).rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = totals.select(
        *ids, "bucket", "piece",
        F.coalesce(F.sum("p").over(above), zero).alias("p_start"),
        F.coalesce(F.sum("q").over(above), zero).alias("q_start"),
        F.sum("p").over(whole).alias("n_pos"),
        F.sum("q").over(whole).alias("n_neg"),
    )
    inside = W.partitionBy(*ids, "bucket", "piece").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    return tied.join(starts, [*ids, "bucket", "piece"]).select(
        *[F.col("_k")[k].alias(k) for k in keys],
        "score", "pos", "neg",
        (F.col("p_start") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("q_start") + F.sum("neg").over(inside)).alias("fp"),
        "n_pos", "n_neg",
    )


def ranking_metrics(df: DataFrame, truth: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC area, average precision (step sum) and trapezoid PR area, ties counted as half; NULL without both classes."""
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    tp0, fp0 = tp - pos, fp - neg
    here, there = tp / (tp + fp), F.coalesce(F.try_divide(tp0, tp0 + fp0), F.lit(1.0))
    n_pos, n_neg = F.max("n_pos"), F.max("n_neg")
    return (
        score_curve(df, truth, score, by)
        .groupBy(*map(quoted, by))
        .agg(
            F.when(n_pos > 0, F.try_divide(F.sum(neg * (tp0 + pos / 2)), n_pos * n_neg)).alias("roc_auc"),
            F.when(n_neg > 0, F.try_divide(F.sum(pos * here), n_pos)).alias("avg_precision"),
            F.when(n_neg > 0, F.try_divide(F.sum(pos * (here + there) / 2), n_pos)).alias("pr_trapezoid"),
        )
    )


def roc_points(df: DataFrame, truth: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, with (0, 0) at an infinite threshold."""
    curve = score_curve(df, truth, score, by)
    keys = list(map(quoted, by))
    points = curve.select(
        *keys, F.col("score").alias("threshold"),
        F.try_divide(F.col("fp"), F.col("n_neg")).alias("fpr"), F.try_divide(F.col("tp"), F.col("n_pos")).alias("tpr"),
    )
    origin = (df.select(*keys).distinct() if by else df.sparkSession.range(1)).select(
        *keys, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def pr_points(df: DataFrame, truth: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) per distinct score, with precision 1 at recall 0 without a threshold."""
    keys = list(map(quoted, by))
    points = score_curve(df, truth, score, by).select(
        *keys, F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.try_divide(F.col("tp"), F.col("n_pos")).alias("recall"),
    )
    start = (df.select(*keys).distinct() if by else df.sparkSession.range(1)).select(
        *keys, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(start)


def all_metrics(df: DataFrame, truth: str, prediction: str, score: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Every metric of every (model, fold, ...) in ``by`` from two aggregations of the scored rows."""
    base = threshold_metrics(df, truth, prediction, by)
    if score is None:
        return base.withColumns({m: F.lit(None).cast("double") for m in ("roc_auc", "avg_precision", "pr_trapezoid")})
    ranks = ranking_metrics(df, truth, score, by)
    names = ("roc_auc", "avg_precision", "pr_trapezoid")
    if not by:
        row = ranks.select(F.struct(*names).alias("r")).scalar()
        return base.withColumn("_r", row).withColumns({m: F.col("_r")[m] for m in names}).drop("_r")
    keys = {k: f"_of{i}" for i, k in enumerate(by)}
    ranks = ranks.withColumnsRenamed(keys)
    same = [col(k).eqNullSafe(F.col(own)) for k, own in keys.items()]
    return base.join(ranks, reduce(and_, same), "left").drop(*keys.values())


def class_report(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Per class and macro/weighted average: precision, recall, f1, support; accuracy in its own row."""
    cells = confusion(df, truth, prediction)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def one(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), _ratio(hit, hit + wrong).alias("precision"), _ratio(hit, hit + missed).alias("recall"),
            _ratio(hit * 2, hit * 2 + wrong + missed).alias("f1"), (hit + missed).alias("support"),
        )

    classes = cells.select(F.inline(F.array(one("0", tn, fn, fp), one("1", tp, fp, fn))))

    def mean(name: str, weight: Column) -> DataFrame:
        return classes.agg(
            F.lit(name).alias("class"),
            *[_ratio(F.sum(F.col(m) * weight), F.sum(weight)).alias(m) for m in ("precision", "recall", "f1")],
            F.sum("support").alias("support"),
        )

    total = tp + tn + fp + fn
    right = _ratio(tp + tn, total)
    accuracy = cells.select(
        F.lit("accuracy").alias("class"), right.alias("precision"), right.alias("recall"), right.alias("f1"), total.alias("support")
    )
    return classes.unionByName(accuracy).unionByName(mean("macro avg", F.lit(1.0))).unionByName(mean("weighted avg", F.col("support")))


def fold_summary(metrics: DataFrame, model: str = "model", names: Sequence[str] = METRICS) -> DataFrame:
    """Mean and population deviation of each metric over the folds of a model."""
    return metrics.groupBy(quoted(model)).agg(
        *[agg for m in names for agg in (F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"))]
    )


def metric_defects(metrics: DataFrame, names: Sequence[str] = METRICS) -> DataFrame:
    """(metric, defects): values that are NaN or outside [0, 1]."""
    wide = metrics.agg(*[F.count_if(F.isnan(m) | ~F.col(m).between(0.0, 1.0)).alias(m) for m in names])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("defects")) for m in names])))


def champion(summary: DataFrame, order: Sequence[str] = ("roc_auc_mean", "avg_precision_mean", "balanced_accuracy_mean", "specificity_mean"), top: int = 1) -> DataFrame:
    """Best models by the first measure; the next ones, then the name, break ties. Unrounded values are compared."""
    return summary.orderBy(*[F.desc_nulls_last(c) for c in order], F.asc("model")).limit(top)
