"""Feedback monitoring: verdicts per feedback row and counters at four levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import event_day, first_non_empty
from ..functions.numbers import flag, ratio, round_to

HIGH_CONFIDENCE = 0.90  # fixed value: logged confidence from which an override counts as high-confidence

LOGGED = ["created_at", "predicted_class", "quality_grade", "model_name", "confidence", "manual_review_required"]


def latest_predictions(predictions: DataFrame, seq: str = "seq") -> DataFrame:
    """One logged prediction per id: the last in log order. Rows without an id are no use here."""
    named = predictions.filter(F.coalesce(F.col("prediction_id") != "", F.lit(False)))
    return named.groupBy("prediction_id").agg(F.max_by(F.struct(*LOGGED), F.col(seq)).alias("logged"))


def prediction_feedback(feedback: DataFrame, predictions: DataFrame, seq: str = "seq") -> DataFrame:
    """Feedback with the logged prediction, or null.

    Feedback without an id can match nothing; it goes around the join, so those rows never pile up
    on one null key.
    """
    has_id = F.coalesce(F.col("prediction_id") != "", F.lit(False))
    logged = latest_predictions(predictions, seq)
    matched = feedback.filter(has_id).join(logged, "prediction_id", "left")
    return matched.unionByName(feedback.filter(~has_id), allowMissingColumns=True)


def verdict(accepted: Column, predicted: Column, corrected: Column) -> Column:
    """True when accepted; else whether the correction equals the prediction; else false when
    rejected; null when nothing can be said."""
    return (
        F.when(accepted, F.lit(True))
        .when(corrected.isNotNull() & predicted.isNotNull(), corrected == predicted)
        .when(~accepted & predicted.isNotNull(), F.lit(False))
    )


def with_verdicts(joined: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Day, class and model keys, verdicts and the flags that are counted; ``keep`` passes columns on."""
    col = F.col
    accepted = col("accepted_ai_recommendation")
    predicted = first_non_empty(col("predicted_class"), col("logged.predicted_class"))
    grade = first_non_empty(col("predicted_grade"), col("logged.quality_grade"))
    corrected = first_non_empty(col("corrected_class"), col("producer_override_class"))
    override_grade = F.nullif("producer_override_grade", F.lit(""))
    any_override = corrected.isNotNull() | override_grade.isNotNull()
    return joined.select(
        *(keep or []),
        event_day(first_non_empty(col("created_at"), col("logged.created_at"))).alias("day"),
        F.coalesce(predicted, F.lit("unknown")).alias("predicted_class"),
        F.coalesce(first_non_empty(col("model_name"), col("logged.model_name")), F.lit("unknown")).alias("model_name"),
        F.coalesce(accepted, F.lit(False)).alias("accepted"),
        (~F.coalesce(accepted, F.lit(False)) & (F.coalesce(~accepted, F.lit(False)) | any_override)).alias("overridden"),
        verdict(accepted, predicted, corrected).alias("class_ok"),
        verdict(accepted, grade, override_grade).alias("grade_ok"),
        col("logged.confidence").alias("confidence"),
        F.coalesce(col("logged.manual_review_required"), F.lit(False)).alias("manual_review"),
    )


COUNTERS = [
    "feedback_count", "accepted_count", "override_count", "class_labelled_count", "class_correct_count",
    "class_override_count", "grade_labelled_count", "grade_correct_count", "high_confidence_override_count",
    "manual_review_feedback_count",
]


def counted_flags() -> list[Column]:
    """What makes a row of ``with_verdicts`` count, in the order of COUNTERS."""
    col = F.col
    return [
        F.lit(True), col("accepted"), col("overridden"), col("class_ok").isNotNull(), col("class_ok"), ~col("class_ok"),
        col("grade_ok").isNotNull(), col("grade_ok"), ~col("class_ok") & (col("confidence") >= HIGH_CONFIDENCE), col("manual_review"),
    ]


def counters() -> list[Column]:
    return [F.sum(flag(f)).alias(name) for f, name in zip(counted_flags(), COUNTERS)]


def ratios() -> list[Column]:
    part = lambda a, b, out: round_to(ratio(F.col(a), F.col(b), None), 4).alias(out)
    return [
        part("class_correct_count", "class_labelled_count", "class_accuracy_proxy"),
        part("grade_correct_count", "grade_labelled_count", "grade_accuracy_proxy"),
        part("accepted_count", "feedback_count", "acceptance_rate"),
        part("override_count", "feedback_count", "override_rate"),
    ]


def feedback_metrics(feedback: DataFrame, predictions: DataFrame, seq: str = "seq") -> DataFrame:
    """Counters and ratios in total, per day, per predicted class and per model.

    One joined row set feeds all levels through grouping sets. Class and model rows appear only for
    keys that have a class verdict.
    """
    rows = with_verdicts(prediction_feedback(feedback, predictions, seq))
    # A null key on the summary row of another level is told apart by the grouping id.
    levels = rows.groupingSets(
        [[], [F.col("day")], [F.col("predicted_class")], [F.col("model_name")]],
        F.col("day"), F.col("predicted_class"), F.col("model_name"),
    ).agg(F.grouping_id().alias("_level"), *counters())
    level = F.when(F.col("_level") == 7, F.lit("total")).when(F.col("_level") == 3, F.lit("day")).when(
        F.col("_level") == 5, F.lit("predicted_class")
    ).otherwise(F.lit("model"))
    named = levels.withColumn("level", level).withColumn("key", F.coalesce("day", "predicted_class", "model_name", F.lit("all")))
    shown = F.col("level").isin("total", "day") | (F.col("class_labelled_count") > 0)
    return named.filter(shown).select("level", "key", *COUNTERS, *ratios())
