"""Metrics of classifiers and regressors, losses and sample selection, as expressions and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weights of the heads color_cast, blurriness, watermark and noise in the overall quality.
OVERALL_WEIGHTS = (0.2, 0.3, 0.25, 0.25)
#: Weights of the four heads in the multi-task loss.
LOSS_WEIGHTS = (1.0, 1.0, 1.5, 1.0)


def confusion(df: DataFrame, label: str = "label", predicted: str = "predicted", *by: str) -> DataFrame:
    y, p = F.col(label), F.col(predicted)
    cells = {"tp": (y == 1) & (p == 1), "fp": (y == 0) & (p == 1), "fn": (y == 1) & (p == 0), "tn": (y == 0) & (p == 0)}
    return df.groupBy(*by).agg(*(F.count_if(c).alias(n) for n, c in cells.items()))


def binary_metrics(df: DataFrame, label: str = "label", predicted: str = "predicted", *by: str) -> DataFrame:
    """Accuracy, precision, recall and F1; 0 where there is nothing to divide by."""
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double") if isinstance(a, str) else a, b), F.lit(0.0))
    c = confusion(df, label, predicted, *by)
    c = c.withColumns({"accuracy": share(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")), "precision": share("tp", F.col("tp") + F.col("fp")), "recall": share("tp", F.col("tp") + F.col("fn"))})
    return c.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def predict(probability: Column, threshold: float = 0.5) -> Column:
    return (probability > threshold).cast("int")


def hard_negatives(df: DataFrame, label: str = "label", probability: str = "probability", low: float = 0.3, high: float = 0.7) -> DataFrame:
    """Rows that are surely wrong, or unsure."""
    y, p = F.col(label), F.col(probability)
    return df.where(((y == 0) & (p > high)) | ((y == 1) & (p < low)) | ((p > low) & (p < high)))


def focal_loss(label: Column, probability: Column, alpha: float = 0.25, gamma: float = 2.0) -> Column:
    right = F.when(label == 1, probability).otherwise(1 - probability)
    return F.lit(alpha) * F.pow(1 - right, F.lit(gamma)) * F.abs(F.log(F.greatest(right, F.lit(1e-12))))


def overall_quality(*heads: Column) -> Column:
    out = F.lit(1.0)
    for head, weight in zip(heads, OVERALL_WEIGHTS, strict=True):
        out = out - head * weight
    return out


def errors(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """<name>_mse and <name>_mae for each (label, prediction)."""
    out = []
    for name, (y, p) in pairs.items():
        d = F.col(p) - F.col(y)
        out += [F.avg(d * d).alias(f"{name}_mse"), F.avg(F.abs(d)).alias(f"{name}_mae")]
    return df.agg(*out)


def hash_split(df: DataFrame, id_field: str, part: float, salt: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, validation): a row's side depends on its id only."""
    held = F.pmod(F.xxhash64(F.lit(salt), F.col(id_field)), F.lit(10_000)) < int(part * 10_000)
    return df.where(~held), df.where(held)


def balance(df: DataFrame, label: str, id_field: str, ratio: float = 1.0, salt: int = 0) -> DataFrame:
    """All rows of the smaller class and about ratio times as many of the larger, by hashed id."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    if len(counts) < 2:
        return df
    small = min(counts, key=lambda k: (counts[k], str(k)))
    keep = min(1.0, ratio * counts[small] / max(v for k, v in counts.items() if k != small))
    chosen = F.pmod(F.xxhash64(F.lit(salt), F.col(id_field)), F.lit(1_000_000)) < int(keep * 1_000_000)
    return df.where((F.col(label) == F.lit(small)) | chosen)
