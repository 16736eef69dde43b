"""Scores against gold annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import NO_RELATION



def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def match_sets(gold: DataFrame, predicted: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct rows of either side with status TP, FP or FN."""
    sides = gold.select(*keys).distinct().withColumn("_g", F.lit(1)).join(predicted.select(*keys).distinct().withColumn("_p", F.lit(1)), keys, "full")
    return sides.select(*keys, F.when(F.col("_g").isNull(), "FP").when(F.col("_p").isNull(), "FN").otherwise("TP").alias("status"))


def precision_recall(gold: DataFrame, predicted: DataFrame, keys: list[str], label: str) -> DataFrame:
    """label (null: overall), tp, fp, fn, precision, recall and f1 of two sets."""
    status = match_sets(gold, predicted, keys)
    counts = [F.count_if(F.col("status") == s).alias(s.lower()) for s in ("TP", "FP", "FN")]
    out = status.rollup(label).agg(*counts)
    return (
        out.withColumns({"precision": _ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": _ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
        .withColumnRenamed(label, "label")
    )


def match_gold(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """gold (gold_id, pmcid, subject, object, alt_names, actual) with predicted: the predicate of the pair under the
    object's name, or else under the first of its alternative names (divided by ";") that has one.

    Of several predictions of a pair the last (row_idx) counts; without any it is No_Relationship.
    """
    names = F.concat(F.array("object"), F.transform(F.split(F.coalesce("alt_names", F.lit("")), ";"), lambda x: F.trim(x)))
    tries = gold.select("gold_id", "pmcid", "subject", F.posexplode(names).alias("turn", "name")).where("name <> ''")
    last = predicted.groupBy("pmcid", "subject", F.col("object").alias("name")).agg(F.max_by("predicate", "row_idx").alias("found"))
    best = tries.join(last, ["pmcid", "subject", "name"]).groupBy("gold_id").agg(F.min_by("found", "turn").alias("found"))
    return gold.join(best, "gold_id", "left").withColumn("predicted", F.coalesce("found", F.lit(NO_RELATION))).drop("found")


def invented(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Distinct predicted pairs, of articles that gold has, that no gold row names: pmcid, subject, object, predicted."""
    names = F.concat(F.array("object"), F.transform(F.split(F.coalesce("alt_names", F.lit("")), ";"), lambda x: F.trim(x)))
    known = gold.select("pmcid", "subject", F.explode(names).alias("object")).distinct()
    scored = predicted.join(gold.select("pmcid").distinct(), "pmcid", "left_semi")
    last = scored.groupBy("pmcid", "subject", "object").agg(F.max_by("predicate", "row_idx").alias("predicted"))
    return last.join(known, ["pmcid", "subject", "object"], "left_anti")


def confusion(outcomes: DataFrame) -> DataFrame:
    """actual, predicted and n for each pair of labels that occur on either side, zeros included; outcomes: actual, predicted.

    The result has as many rows as labels squared.  Each label is dealt the list of all of them, of which the driver has none.
    """
    counts = outcomes.groupBy("actual", "predicted").agg(F.count("*").alias("n"))
    found = counts.select(F.col("actual").alias("label")).union(counts.select("predicted")).distinct()
    listed = found.agg(F.collect_set(F.struct("label")).alias("all"))
    none = found.join(F.broadcast(listed)).select(F.col("label").alias("actual"), F.explode("all.label").alias("predicted"), F.lit(0).cast("long").alias("n"))
    return counts.unionByName(none).groupBy("actual", "predicted").agg(F.sum("n").alias("n"))


def class_metrics(matrix: DataFrame) -> DataFrame:
    """label, tp, fp, fn, tn, precision, recall, f1 and support from a confusion matrix."""
    rows = matrix.groupBy(F.col("actual").alias("label")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("tp"))
    columns = matrix.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("named"))
    total = matrix.agg(F.sum("n").alias("total"))
    out = rows.join(columns, "label").crossJoin(F.broadcast(total))
    out = out.withColumns({"fp": F.col("named") - F.col("tp"), "fn": F.col("support") - F.col("tp")}).withColumn("tn", F.col("total") - F.col("tp") - F.col("fp") - F.col("fn"))
    out = out.withColumns({"precision": _ratio(F.col("tp"), F.col("named")), "recall": _ratio(F.col("tp"), F.col("support"))})
    return out.withColumn("f1", _f1(F.col("precision"), F.col("recall"))).select("label", "tp", "fp", "fn", "tn", "precision", "recall", "f1", "support")


def report(metrics: DataFrame) -> DataFrame:
    """row, precision, recall, f1 and support of each class, then accuracy, macro avg and weighted avg."""
    classes = metrics.select(F.col("label").alias("row"), "precision", "recall", "f1", "support")
    total = F.sum("support")
    means = metrics.agg(
        (F.sum("tp") / total).alias("accuracy"), total.alias("support"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
    )
    lines = means.select(
        F.explode(
            F.array(
                F.struct(F.lit("accuracy").alias("row"), F.col("accuracy").alias("precision"), F.col("accuracy").alias("recall"), F.col("accuracy").alias("f1"), "support"),
                F.struct(F.lit("macro avg").alias("row"), F.col("macro_precision").alias("precision"), F.col("macro_recall").alias("recall"), F.col("macro_f1").alias("f1"), "support"),
                F.struct(F.lit("weighted avg").alias("row"), F.col("weighted_precision").alias("precision"), F.col("weighted_recall").alias("recall"), F.col("weighted_f1").alias("f1"), "support"),
            )
        ).alias("x")
    )
    return classes.unionByName(lines.select("x.*"))
