"""Evaluation of predictions as aggregates; every function returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.functions.scalar import safe_ratio
from tallyforge.operators.running import running_totals


def binary_confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``tp, tn, fp, fn`` in one pass."""
    is_pos, said_pos = F.col(label) == 1, F.col(prediction) == 1
    is_neg, said_neg = F.col(label) == 0, F.col(prediction) == 0
    return df.agg(
        F.count_if(is_pos & said_pos).alias("tp"),
        F.count_if(is_neg & said_neg).alias("tn"),
        F.count_if(is_neg & said_pos).alias("fp"),
        F.count_if(is_pos & said_neg).alias("fn"),
    )


def binary_rates(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, accuracy and the mean accuracy of the two classes."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    recall, specificity = safe_ratio(tp, tp + fn), safe_ratio(tn, tn + fp)
    return binary_confusion(df, label, prediction).select(
        "tp", "tn", "fp", "fn",
        safe_ratio(tp, tp + fp).alias("precision"),
        recall.alias("recall"),
        F.try_divide((tp + tn).cast("double"), tp + tn + fp + fn).alias("accuracy"),
        ((recall + specificity) / 2).alias("class_accuracy"),
    )


def binary_auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Areas under the ROC and precision-recall curves, equal scores as one point.

    Without positives both areas are 0.0, without negatives 1.0.
    """
    return binary_auc_by(df, [], score, label)


def binary_auc_by(
    df: DataFrame, by: list[str], score: str = "score", label: str = "label", weight: str | None = None
) -> DataFrame:
    """The same per group, all groups in one pass; ``weight`` counts a row as that many.

    Rows are first reduced to one for every distinct score of a group, then ranged by
    group and score, so one group may hold all rows.
    """
    count = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    is_pos = F.col(label) == 1
    zero = F.lit(0).cast("bigint")
    by_score = df.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.when(is_pos, count).otherwise(zero)).alias("pos"),
        F.sum(F.when(F.col(label) != 1, count).otherwise(zero)).alias("neg"),
    )
    run = running_totals(by_score, [F.col("score").desc()], ["pos", "neg"], "auc", by)
    tp, fp, pos, neg = (F.col(c) for c in ("run_pos", "run_neg", "pos", "neg"))
    seen_before = tp - pos + fp - neg
    precision = F.try_divide(tp, tp + fp)
    earlier = F.when(seen_before > 0, (tp - pos) / seen_before).otherwise(precision)
    sums = run.groupBy(*by).agg(
        F.sum(pos).alias("n_pos"),
        F.sum(neg).alias("n_neg"),
        F.sum(neg * (tp + tp - pos) / 2).alias("_roc"),
        F.sum(pos * (precision + earlier) / 2).alias("_pr"),
    )
    n_pos, n_neg = F.col("n_pos"), F.col("n_neg")

    def area(value: Column) -> Column:
        return (
            F.when(n_pos == 0, F.lit(0.0)).when(n_neg == 0, F.lit(1.0)).otherwise(value)
        )

    return sums.select(
        *by,
        area(F.col("_roc") / (n_pos.cast("double") * n_neg)).alias("roc_auc"),
        area(F.col("_pr") / n_pos).alias("pr_auc"),
        "n_pos",
        "n_neg",
    )


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion matrix in long form."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_rates(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall and F1 per class, for labels and predictions alike."""
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    agree = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)

    def entry(cls: str, actual: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(cls).alias("cls"), actual.alias("actual"),
            predicted.alias("predicted"), hits.alias("hits"),
        )

    both = F.array(entry("label", n, zero, agree), entry("prediction", zero, n, zero))
    per_class = (
        confusion_counts(df, label, prediction)
        .select(F.inline(both))
        .groupBy("cls")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
    )
    precision = safe_ratio(F.col("hits"), F.col("predicted"))
    recall = safe_ratio(F.col("hits"), F.col("actual"))
    return per_class.select(
        "cls", "actual", "predicted", "hits",
        precision.alias("precision"),
        recall.alias("recall"),
        safe_ratio(2 * precision * recall, precision + recall).alias("f1"),
    )


def multiclass_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, weighted F1, precision and recall, and mean class accuracy."""
    actual, total = F.col("actual"), F.sum("actual")

    def weighted(name: str, alias: str) -> Column:
        return (F.sum(F.col(name) * actual) / total).alias(alias)

    return class_rates(df, label, prediction).agg(
        (F.sum("hits") / total).alias("accuracy"),
        weighted("f1", "f1"),
        weighted("precision", "weighted_precision"),
        weighted("recall", "weighted_recall"),
        F.avg(F.when(actual > 0, F.col("recall"))).alias("class_accuracy"),
    )


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """MSE, RMSE, MAE and R2 in one pass."""
    return regression_metrics_by(df, [], label, prediction)


def regression_metrics_by(
    df: DataFrame, by: list[str], label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """The same per group."""
    y = F.col(label).cast("double")
    err = y - F.col(prediction)
    mse = F.avg(err * err)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.try_divide(mse, F.var_pop(y))).alias("r2"),
    )


def feature_correlation(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Correlation of each feature with the target, in one pass, strongest first."""
    wide = df.agg(*[F.corr(f, target).alias(f) for f in features])
    long = wide.unpivot([], features, "feature", "correlation")
    return long.orderBy(F.abs("correlation").desc(), "feature")


def metric_rows(metrics: DataFrame) -> DataFrame:
    """A one-row metrics table as ``(metric, value)`` rows, for writing as a report."""
    cast = metrics.select([F.col(c).cast("double").alias(c) for c in metrics.columns])
    return cast.unpivot([], metrics.columns, "metric", "value")
