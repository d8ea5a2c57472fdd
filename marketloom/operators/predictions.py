"""Classifier output: business mapping, audits, cost thresholds, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import left_join_keyed
from ..functions.business import (
    freshness_score,
    legacy_action,
    legacy_grade,
    legacy_reasons,
    legacy_review,
    list_margin,
)
from ..functions.classes import condition_of, file_name, file_stem, produce_of, status_of
from ..functions.numbers import flag, ratio, round6
from ..functions.reasons import joined
from .ranking import top_k

# Cost of each outcome and the threshold grid.
COSTS = {
    "correct_auto_decision": 0,
    "manual_review": 1,
    "wrong_produce_same_condition": 2,
    "healthy_predicted_rotten": 3,
    "rotten_predicted_healthy": 10,
}
CONFIDENCE_THRESHOLDS = [0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80]
MARGIN_THRESHOLDS = [0.00, 0.05, 0.10, 0.15, 0.20, 0.25]
ROTTEN_THRESHOLDS = [0.70, 0.75, 0.80, 0.85, 0.90]

# Suitability wording and the decision it stands for.
SELECTED_DECISION = "Selected final deployment candidate"
SUITABILITY_SELECTED = "Selected: strong grouped metrics, fewer high-confidence errors, and lower serving risk."
SUITABILITY_CHALLENGER = (
    "Main challenger: stronger macro F1, but higher high-confidence error count increases deployment risk."
)
SUITABILITY_OTHER = "Comparison/ablation evidence; not selected for final demo."

# Columns of the risky-case listing.
RISKY_COLUMNS = [
    "image_id", "image_path", "expected_class", "model", "predicted_class", "confidence", "top1_top2_margin",
    "full_class_correct", "quality_grade", "manual_review_required", "recommended_action", "reason_codes", "warnings",
]
# Validation columns that are passed on when present.
OPTIONAL_VALIDATION_COLUMNS = [
    "quality_grade", "overall_quality_score", "component_scores", "recommended_action",
    "inventory_status", "discount_percentage", "warnings",
]
# Metadata fields reported for the selected model.
METRIC_FIELDS = [
    "model_name", "selected_as_final", "base_model_family", "split_strategy", "split_dir", "metrics", "risk_audit",
    "quality_grading_layer", "inference_safeguards", "selection_reason", "selection_caveats", "artifacts",
]


def business_prediction(preds: DataFrame) -> DataFrame:
    """Adds produce, status, margin, freshness score, grade, action, reasons and review flag.

    A missing margin is taken from ``top_k`` when that column exists.
    """
    if "top_k" in preds.columns:
        preds = preds.withColumn("top1_top2_margin", F.coalesce("top1_top2_margin", list_margin(F.col("top_k"))))
    with_status = preds.withColumn("produce_type", produce_of(F.col("predicted_class"))).withColumn(
        "freshness_status", status_of(F.col("predicted_class"))
    )
    status, confidence, margin = F.col("freshness_status"), F.col("confidence"), F.col("top1_top2_margin")
    return with_status.select(
        "*",
        freshness_score(status, confidence).alias("freshness_score"),
        legacy_grade(status, confidence).alias("quality_grade"),
        legacy_action(status, confidence, margin).alias("recommended_action"),
        legacy_reasons(status, confidence, margin).alias("reason_codes"),
        legacy_review(status, confidence, margin).alias("manual_review_required"),
    )


# --- audits --------------------------------------------------------------------------------------


def confusion_matrix(preds: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts per (group, true class, predicted class): the only pass over the predictions."""
    return preds.groupBy(*(by or []), "class_name", "predicted_class").agg(F.count("*").alias("n"))


def class_metrics(matrix: DataFrame, by: list[str]) -> DataFrame:
    """Precision, recall, F1 and support per class from a confusion matrix (K^2 rows at most)."""
    # Each cell feeds the row of its true class and the row of its predicted class.
    cell = F.array(
        F.struct(F.col("class_name").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("class_name") == F.col("predicted_class"), F.col("n")).otherwise(F.lit(0)).alias("hit")),
        F.struct(F.col("predicted_class").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("hit")),
    )
    sides = matrix.select(*by, F.explode(cell).alias("e")).select(*by, "e.*")
    sums = sides.groupBy(*by, F.col("c").alias("class_name")).agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("_predicted"), F.sum("hit").alias("_hit")
    )
    precision, recall = ratio(F.col("_hit"), F.col("_predicted")), ratio(F.col("_hit"), F.col("support"))
    rated = sums.withColumn("precision", precision).withColumn("recall", recall)
    f1 = ratio(2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rated.withColumn("f1_score", f1)


def report_totals(classes: DataFrame, by: list[str]) -> DataFrame:
    """Accuracy, macro and weighted averages per group from per-class metrics."""
    weighted = lambda c: F.sum(F.col(c) * F.col("support"))
    names = ["precision", "recall", "f1_score"]
    sums = classes.groupBy(*by).agg(
        F.sum("support").alias("support"),
        F.sum("_hit").alias("_hit"),
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[weighted(c).alias(f"_weighted_{c}") for c in names],
    )
    return sums.select(
        *by, "support",
        ratio(F.col("_hit"), F.col("support")).alias("accuracy"),
        *[F.col(f"macro_{c}") for c in names],
        *[ratio(F.col(f"_weighted_{c}"), F.col("support")).alias(f"weighted_{c}") for c in names],
    )


def classification_report(preds: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per-class rows and the rows accuracy, macro avg and weighted avg, per group."""
    by = by or []
    classes = class_metrics(confusion_matrix(preds, by), by)
    totals = report_totals(classes, by)
    rows = classes.select(*by, "class_name", "precision", "recall", "f1_score", "support")
    summary = F.array(
        F.struct(F.lit("accuracy").alias("class_name"), F.col("accuracy").alias("precision"), F.col("accuracy").alias("recall"),
                 F.col("accuracy").alias("f1_score")),
        F.struct(F.lit("macro avg").alias("class_name"), F.col("macro_precision").alias("precision"),
                 F.col("macro_recall").alias("recall"), F.col("macro_f1_score").alias("f1_score")),
        F.struct(F.lit("weighted avg").alias("class_name"), F.col("weighted_precision").alias("precision"),
                 F.col("weighted_recall").alias("recall"), F.col("weighted_f1_score").alias("f1_score")),
    )
    extra = totals.select(*by, "support", F.explode(summary).alias("s")).select(
        *by, "s.class_name", "s.precision", "s.recall", "s.f1_score", "support"
    )
    rounded = [round6(F.col(c)).alias(c) for c in ("precision", "recall", "f1_score")]
    return rows.unionByName(extra).select(*by, "class_name", *rounded, "support")


def confidence_audit(preds: DataFrame, by: str = "model", threshold: float = 0.95) -> DataFrame:
    """Per model: accuracy, F1 scores, errors, high-confidence errors, mean confidence on errors."""
    totals = report_totals(class_metrics(confusion_matrix(preds, [by]), [by]), [by])
    wrong = F.col("class_name") != F.col("predicted_class")
    errors = preds.groupBy(by).agg(
        F.count("*").alias("rows"),
        F.sum(flag(wrong)).alias("errors"),
        F.sum(flag(wrong & (F.col("confidence") >= threshold))).alias("high_confidence_errors"),
        F.avg(F.when(wrong, F.col("confidence"))).alias("_mean"),
    )
    return totals.join(errors, by).select(
        by, "rows", round6(F.col("accuracy")).alias("accuracy"),
        round6(F.col("macro_f1_score")).alias("macro_f1"), round6(F.col("weighted_f1_score")).alias("weighted_f1"),
        "errors", "high_confidence_errors",
        round6(F.coalesce("_mean", F.lit(0.0))).alias("mean_error_confidence"),
    )


def high_confidence_errors(preds: DataFrame, threshold: float = 0.95) -> DataFrame:
    return preds.filter((F.col("class_name") != F.col("predicted_class")) & (F.col("confidence") >= threshold))


def model_comparison(preds: DataFrame, by: str = "model") -> DataFrame:
    """Accuracy and F1 averages of each experiment; a result table, best accuracy first."""
    totals = report_totals(class_metrics(confusion_matrix(preds, [by]), [by]), [by])
    rounded = [round6(F.col(a)).alias(b) for a, b in (("accuracy", "accuracy"), ("macro_f1_score", "macro_f1"), ("weighted_f1_score", "weighted_f1"))]
    return totals.select(by, *rounded).orderBy(F.desc("accuracy"), by)


def weakest_classes(report: DataFrame, by: list[str], n: int = 5) -> DataFrame:
    """The n classes with the lowest F1 per model; summary rows are left out by name."""
    classes = report.filter(F.col("class_name").contains("__"))
    return top_k(classes, by, [F.asc("f1_score"), F.asc("class_name")], n)


def weak_class_watchlist(report: DataFrame, watched: list[str]) -> DataFrame:
    """Report rows of the listed classes with their list position; absent classes drop."""
    position = F.array_position(F.array(*[F.lit(c) for c in watched]), F.col("class_name"))
    return report.withColumn("position", position.cast("int")).filter(F.col("position") > 0)


def suitability_label(decision: Column) -> Column:
    return (
        F.when(decision == SELECTED_DECISION, F.lit(SUITABILITY_SELECTED))
        .when(F.lower(decision).contains("challenger"), F.lit(SUITABILITY_CHALLENGER))
        .otherwise(F.lit(SUITABILITY_OTHER))
    )


def final_metrics_pick(metadata: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Chosen fields of model metadata texts (column ``text``), as text; absent ones are null."""
    return metadata.select(*(keep or []), *[F.get_json_object("text", f"$.{name}").alias(name) for name in METRIC_FIELDS])


def experiment_filter(preds: DataFrame, experiment: str, column: str = "experiment_slug") -> DataFrame:
    return preds.filter(F.col(column) == experiment)


def risky_cases(validation: DataFrame) -> DataFrame:
    """Rows that are wrong, unsure, flagged or graded low. Conditions on absent columns do not apply."""
    conditions = {
        "full_class_correct": lambda c: c == F.lit(False),
        "confidence": lambda c: c < 0.60,
        "top1_top2_margin": lambda c: c < 0.15,
        "manual_review_required": lambda c: c,
        "quality_grade": lambda c: c.isin("C", "Review"),
    }
    risky = F.lit(False)
    for column, condition in conditions.items():
        if column in validation.columns:
            risky = risky | F.coalesce(condition(F.col(column)), F.lit(False))
    return validation.filter(risky).select(*[c for c in RISKY_COLUMNS if c in validation.columns])


# --- cost thresholds -----------------------------------------------------------------------------


def cost_reason(true_class: Column, predicted: Column) -> Column:
    actual, seen = condition_of(true_class), condition_of(predicted)
    return (
        F.when(true_class == predicted, F.lit("correct_auto_decision"))
        .when((actual == "rotten") & (seen == "healthy"), F.lit("rotten_predicted_healthy"))
        .when((actual == "healthy") & (seen == "rotten"), F.lit("healthy_predicted_rotten"))
        .otherwise(F.lit("wrong_produce_same_condition"))
    )


def cost_of(reason: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in COSTS.items() for x in pair])
    return F.element_at(table, reason)


def prediction_cost(preds: DataFrame) -> DataFrame:
    return preds.withColumn("cost_reason", cost_reason(F.col("class_name"), F.col("predicted_class"))).withColumn(
        "cost", cost_of(F.col("cost_reason"))
    )


def manual_review_rule(confidence: Column, margin: Column, rotten: Column, t1: Column, t2: Column, t3: Column) -> Column:
    """Review when confidence is low, a known margin is small, or a rotten call is not sure enough."""
    return (confidence < t1) | F.coalesce(margin < t2, F.lit(False)) | (rotten & (confidence < t3))


def _bin(value: Column, edges: list[float]) -> Column:
    """The largest edge not above the value, or -1. Comparing it with an edge gives what comparing
    the value would give, so a histogram over bins loses nothing."""
    steps = sorted(set(edges), reverse=True)
    bins = F.when(value >= steps[0], F.lit(steps[0]))
    for edge in steps[1:]:
        bins = bins.when(value >= edge, F.lit(edge))
    return F.when(value.isNotNull(), bins.otherwise(F.lit(-1.0)))


def threshold_histogram(preds: DataFrame, t1: list[float], t2: list[float], t3: list[float], by: list[str]) -> DataFrame:
    """Predictions counted by (confidence bin, margin bin, rotten call, outcome): a few hundred rows."""
    return preds.select(
        *by,
        _bin(F.col("confidence"), t1 + t3).alias("confidence"),
        _bin(F.col("top1_top2_margin"), t2).alias("margin"),
        (condition_of(F.col("predicted_class")) == "rotten").alias("rotten"),
        cost_reason(F.col("class_name"), F.col("predicted_class")).alias("outcome"),
    ).groupBy(*by, "confidence", "margin", "rotten", "outcome").agg(F.count("*").alias("n"))


def threshold_grid(
    preds: DataFrame,
    t1: list[float] | None = None,
    t2: list[float] | None = None,
    t3: list[float] | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Cost, outcome counts and rates of every threshold setting.

    The predictions are read once into an exact histogram; each histogram row meets every setting
    of a literal array, so the work beyond the scan does not grow with the predictions.
    """
    t1, t2, t3, by = t1 or CONFIDENCE_THRESHOLDS, t2 or MARGIN_THRESHOLDS, t3 or ROTTEN_THRESHOLDS, by or []
    doubles = lambda values: F.array(*[F.lit(float(v)) for v in values])
    hist = threshold_histogram(preds, t1, t2, t3, by)
    rows = (
        hist.withColumn("confidence_review_threshold", F.explode(doubles(t1)))
        .withColumn("margin_review_threshold", F.explode(doubles(t2)))
        .withColumn("rotten_auto_block_threshold", F.explode(doubles(t3)))
    )
    settings = ["confidence_review_threshold", "margin_review_threshold", "rotten_auto_block_threshold"]
    review = manual_review_rule(F.col("confidence"), F.col("margin"), F.col("rotten"), *[F.col(s) for s in settings])
    decided = rows.withColumn("outcome", F.when(review, F.lit("manual_review")).otherwise(F.col("outcome")))
    count = lambda outcome: F.sum(F.when(F.col("outcome") == outcome, F.col("n")).otherwise(F.lit(0)))
    sums = decided.groupBy(*by, *settings).agg(
        F.sum(F.col("n") * cost_of(F.col("outcome"))).alias("total_operational_cost"),
        count("rotten_predicted_healthy").alias("false_fresh_count"),
        count("healthy_predicted_rotten").alias("false_rotten_count"),
        count("wrong_produce_same_condition").alias("wrong_produce_count"),
        count("correct_auto_decision").alias("correct_auto_count"),
        count("manual_review").alias("manual_review_count"),
        F.sum("n").alias("evaluated_rows"),
    )
    total = F.col("evaluated_rows")
    return sums.select(
        "*",
        round6(ratio(F.col("total_operational_cost"), total)).alias("expected_operational_cost"),
        round6(ratio(F.col("manual_review_count"), total)).alias("manual_review_rate"),
        round6(ratio(total - F.col("manual_review_count"), total)).alias("auto_decision_rate"),
    )


def select_operating_point(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Lowest expected cost, then fewer false-fresh, then lower review rate, then grid order."""
    order = [
        "expected_operational_cost", "false_fresh_count", "manual_review_rate",
        "confidence_review_threshold", "margin_review_threshold", "rotten_auto_block_threshold",
    ]
    if not by:
        return results.orderBy(*order).limit(1)
    return top_k(results, by, [F.asc(c) for c in order], 1, "_at").drop("_at")


# --- validation against expected labels ----------------------------------------------------------


def manifest_join(preds: DataFrame, manifest: DataFrame) -> DataFrame:
    """Predictions with the expected label of the same file name (left; repeated names fan out, a
    null or blank name matches nothing)."""
    expected = manifest.select(file_name(F.col("image_path")).alias("image_filename"), "expected_class", "notes")
    named = preds.withColumn("image_filename", file_name(F.col("image_path")))
    plain = [f.name for f in preds.schema.fields if f.dataType.typeName() != "map"]
    return left_join_keyed(named, expected, "image_filename", plain)


def _same_or_missing(actual: Column, expected: Column) -> Column:
    return F.when(expected.isNotNull() & (expected != ""), F.coalesce(actual == expected, F.lit(False)))


def validation_table(preds: DataFrame, manifest: DataFrame) -> DataFrame:
    """Predictions against expected labels; correctness flags are null where there is no label."""
    if "top1_top2_margin" not in preds.columns:
        preds = preds.withColumn("top1_top2_margin", F.lit(None).cast("double"))
    known = manifest_join(preds, manifest).withColumn("image_id", file_stem(F.col("image_path")))
    label = F.nullif("expected_class", F.lit(""))
    predicted = F.coalesce("predicted_class", F.lit(""))
    parts = (
        known.withColumn("expected_produce_type", F.coalesce(produce_of(label), F.lit("")))
        .withColumn("expected_freshness_status", F.when(label.isNull(), F.lit("")).otherwise(status_of(label)))
        .withColumn("predicted_produce_type", produce_of(predicted))
        .withColumn("predicted_freshness_status", status_of(predicted))
    )
    checked = (
        parts.withColumn("produce_correct", _same_or_missing(F.col("predicted_produce_type"), F.col("expected_produce_type")))
        .withColumn("freshness_correct", _same_or_missing(F.col("predicted_freshness_status"), F.col("expected_freshness_status")))
        .withColumn("full_class_correct", _same_or_missing(F.col("predicted_class"), F.col("expected_class")))
    )
    if not {"manual_review_required", "reason_codes"} <= set(preds.columns):
        status, confidence, margin = F.col("predicted_freshness_status"), F.col("confidence"), F.col("top1_top2_margin")
        checked = checked.withColumn("manual_review_required", legacy_review(status, confidence, margin)).withColumn(
            "reason_codes", joined(legacy_reasons(status, confidence, margin))
        )
    return checked.select(
        "image_id", "image_path", "expected_class", "expected_produce_type", "expected_freshness_status", "model",
        "predicted_class", "predicted_produce_type", "predicted_freshness_status", "confidence", "top1_top2_margin",
        "produce_correct", "freshness_correct", "full_class_correct", "manual_review_required", "reason_codes",
        *[c for c in OPTIONAL_VALIDATION_COLUMNS if c in checked.columns],
        "notes",
    )


def validation_summary(validation: DataFrame) -> DataFrame:
    """Labelled rows per model: count, three accuracies, review rate, mean confidence."""
    named = {
        "full_class_accuracy": "full_class_correct",
        "produce_accuracy": "produce_correct",
        "freshness_accuracy": "freshness_correct",
        "manual_review_rate": "manual_review_required",
    }
    return validation.filter(F.col("expected_class").isNotNull()).groupBy("model").agg(
        F.count("image_id").alias("labeled_predictions"),
        *[round6(F.avg(F.col(c).cast("int"))).alias(out) for out, c in named.items()],
        round6(F.avg("confidence")).alias("mean_confidence"),
    )
