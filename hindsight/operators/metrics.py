"""Evaluation of class predictions as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: probabilities are kept this far from 0 and 1 (double precision).
EPSILON = 2.220446049250313e-16


def arg_max(probabilities: str) -> Column:
    """Index of the likeliest class, the first of equals."""
    return (F.array_position(F.col(probabilities), F.array_max(probabilities)) - 1).cast("int")


def log_loss(df: DataFrame, label: str, probabilities: str, by: list[str] | None = None) -> DataFrame:
    """Mean negative log of the probability given to the true class, overall or per group (fold)."""
    p = F.try_element_at(F.col(probabilities), F.col(label).cast("int") + 1)
    kept = F.greatest(F.lit(EPSILON), F.least(F.lit(1 - EPSILON), p))
    return df.groupBy(*(by or [])).agg((-F.avg(F.ln(kept))).alias("log_loss"), F.count("*").alias("rows"))


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Share of right predictions."""
    right = F.count_if(F.col(label) == F.col(predicted))
    return df.agg((right / F.count("*")).alias("accuracy"), F.count("*").alias("rows"))


def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    """Accuracy of always naming the most frequent class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("majority_share"))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Rows per (label, predicted)."""
    return df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("rows"))


def confusion_matrix(df: DataFrame, label: str, predicted: str, classes: list) -> DataFrame:
    """The same with one column per predicted class."""
    counts = confusion(df, label, predicted).groupBy("label").pivot("predicted", classes).agg(F.sum("rows"))
    return counts.select("label", *[F.coalesce(F.col(str(c)), F.lit(0)).alias(f"predicted_{c}") for c in classes])


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then their macro and weighted means.

    A ratio without denominator is 0. Everything after the first aggregation
    works on at most classes × classes counts.
    """
    label_side = F.struct(F.col("label").alias("class"), F.col("rows").alias("support"), F.lit(0).alias("named"))
    named_side = F.struct(F.col("predicted").alias("class"), F.lit(0).alias("support"), F.col("rows").alias("named"))
    right = F.when(F.col("label") == F.col("predicted"), F.col("rows")).otherwise(0)
    sides = confusion(df, label, predicted).select(right.alias("right"), F.inline(F.array(label_side, named_side)))
    # a right cell is unfolded twice to the same class, hence the half
    per_class = sides.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("named").alias("named"), (F.sum("right") / 2).alias("right")
    )

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))

    scored = per_class.select(
        F.col("class").cast("string").alias("class"),
        ratio("right", "named").alias("precision"),
        ratio("right", "support").alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("right"), F.col("named") + F.col("support")), F.lit(0.0)).alias("f1"),
        "support",
    )
    names = ["precision", "recall", "f1"]
    macro = scored.agg(*[F.avg(n).alias(n) for n in names], F.sum("support").alias("support"))
    weighted = scored.agg(
        *[(F.sum(F.col(n) * F.col("support")) / F.sum("support")).alias(n) for n in names],
        F.sum("support").alias("support"),
    )
    return scored.unionByName(macro.select(F.lit("macro").alias("class"), *names, "support")).unionByName(
        weighted.select(F.lit("weighted").alias("class"), *names, "support")
    )
