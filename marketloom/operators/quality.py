"""Rule-based quality grading and its sensitivity studies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import flag, ratio, round6, round_to
from ..functions.reasons import code, reason_codes

# Thresholds of the quality rules.
LOW_CONFIDENCE = 0.60
SURE_ROTTEN = 0.80
LOW_MARGIN = 0.15
CONFLICT_MARGIN = 0.15
VERY_POOR_IMAGE = 15.0
POOR_IMAGE = 35.0
GRADE_C = {"dark_ratio": 0.32, "ripeness": 60.0, "color": 65.0, "overall": 65.0}
GRADE_A = {"condition": 85.0, "color": 85.0, "size": 80.0, "ripeness": 80.0, "overall": 85.0}
RIPENESS = {"condition": 0.50, "color": 0.35, "defect_absence": 0.15}

# Component weights, in the order the weighted sum is taken.
COMPONENTS = ["model_condition", "color", "defect_absence", "image_quality", "size_proxy"]
DEFAULT_WEIGHTS = [0.45, 0.25, 0.15, 0.10, 0.05]
WEIGHT_SETS = {
    "default_balanced": DEFAULT_WEIGHTS,
    "more_visual_colour": [0.35, 0.30, 0.20, 0.10, 0.05],
    "safer_model_led": [0.55, 0.20, 0.10, 0.10, 0.05],
}
ABLATION_SETS = {
    "full_default": DEFAULT_WEIGHTS,
    "model_only": [1.00, 0.00, 0.00, 0.00, 0.00],
    "visual_only": [0.00, 0.40, 0.30, 0.20, 0.10],
    "no_color": [0.55, 0.00, 0.25, 0.15, 0.05],
    "no_defect_absence": [0.55, 0.30, 0.00, 0.10, 0.05],
    "no_image_quality": [0.50, 0.30, 0.15, 0.00, 0.05],
    "no_size_proxy": [0.45, 0.25, 0.15, 0.15, 0.00],
    "more_visual_colour": WEIGHT_SETS["more_visual_colour"],
    "safer_model_led": WEIGHT_SETS["safer_model_led"],
}

# Action, inventory status and discount by grade.
GRADE_TABLE = {
    "A": ("normal_sale", "available", 0),
    "B": ("discount_or_quick_sale", "surplus_or_lower_grade", 20),
    "C": ("manual_review_or_discard", "blocked_pending_review", None),
    "Review": ("manual_review_required", "pending_review", None),
}
C_UNDER_REVIEW = "manual_review_before_listing"
RULE_WARNING = "quality_grade_is_rule_based_not_supervised_model_output"
UNKNOWN_PROFILE = "unknown_produce_profile_used"


def condition_score(condition: Column, confidence: Column) -> Column:
    return (
        F.when(condition == "healthy", confidence * 100.0)
        .when(condition == "rotten", (F.lit(1.0) - confidence) * 100.0)
        .otherwise(F.lit(0.0))
    )


def quality_components(rows: DataFrame) -> DataFrame:
    """Adds the six component scores (4 places) as ``c_*``; needs condition, confidence and features."""
    condition = condition_score(F.col("condition"), F.col("confidence"))
    defect = F.when(F.col("condition") == "rotten", F.least(F.col("defect_absence_score"), condition)).otherwise(
        F.col("defect_absence_score")
    )
    ripeness = (
        condition * RIPENESS["condition"] + F.col("color_score") * RIPENESS["color"] + defect * RIPENESS["defect_absence"]
    )
    return rows.select(
        "*",
        round_to(condition, 4).alias("c_model_condition"),
        round_to(F.col("color_score"), 4).alias("c_color"),
        round_to(defect, 4).alias("c_defect_absence"),
        round_to(F.col("image_quality_score"), 4).alias("c_image_quality"),
        round_to(F.col("size_proxy_score"), 4).alias("c_size_proxy"),
        round_to(ripeness, 4).alias("c_ripeness"),
    )


def overall_score(weights: Column) -> Column:
    """Weighted sum of the five components (4 places); ``weights`` is an array in component order."""
    total = F.lit(0.0)
    for i, name in enumerate(COMPONENTS):
        total = total + F.col(f"c_{name}") * F.get(weights, F.lit(i))
    return round_to(total, 4)


def condition_conflict(rows: DataFrame) -> Column:
    """The first top-k entry of the same produce with the opposite condition is nearly as probable."""
    opposite = F.when(F.col("condition") == "healthy", F.lit("rotten")).otherwise(F.lit("healthy"))
    prefix = F.lower(F.concat(F.col("product_type"), F.lit("__")))
    same = F.filter(
        "top_k",
        lambda e: F.startswith(F.lower(e["class_name"]), prefix) & F.endswith(F.lower(e["class_name"]), opposite),
    )
    probability = F.get(same, F.lit(0))["probability"]
    return F.coalesce(F.col("confidence") - probability < CONFLICT_MARGIN, F.lit(False))


def quality_decision(rows: DataFrame, weights: Column | None = None) -> DataFrame:
    """Grade, action and reasons of every row.

    Needs product_type, condition, confidence, top1_top2_margin, top_k, the image features and
    ``feature_warnings``; ``profile_known`` tells whether the product has its own quality profile.
    """
    weights = F.array(*[F.lit(w) for w in DEFAULT_WEIGHTS]) if weights is None else weights
    return _decided(_scored(rows).withColumn("overall_quality_score", overall_score(weights)))


def _scored(rows: DataFrame) -> DataFrame:
    """What does not depend on weights: components, warnings and the top-k conflict."""
    profile = F.when(~F.col("profile_known"), F.lit(UNKNOWN_PROFILE))
    warnings = F.array_distinct(
        F.concat(F.array_compact(F.array(profile)), F.coalesce("feature_warnings", F.array().cast("array<string>")), F.array(F.lit(RULE_WARNING)))
    )
    return quality_components(rows).withColumn("warnings", warnings).withColumn("_conflict", condition_conflict(rows))


def _decided(scored: DataFrame) -> DataFrame:
    """Grade, action and reasons from the components and the overall score."""
    col = F.col
    healthy, rotten = col("condition") == "healthy", col("condition") == "rotten"
    unknown = F.coalesce(~(healthy | rotten), F.lit(True))
    unsure = col("confidence") < LOW_CONFIDENCE
    sure_rotten = rotten & (col("confidence") >= SURE_ROTTEN)
    poor, very_poor = col("image_quality_score") < POOR_IMAGE, col("image_quality_score") < VERY_POOR_IMAGE
    is_c = (
        (col("dark_ratio") >= GRADE_C["dark_ratio"]) | (col("c_ripeness") < GRADE_C["ripeness"])
        | (col("color_score") < GRADE_C["color"]) | (col("overall_quality_score") < GRADE_C["overall"])
    )
    is_a = (
        (col("c_model_condition") >= GRADE_A["condition"]) & (col("color_score") >= GRADE_A["color"])
        & (col("size_proxy_score") >= GRADE_A["size"]) & (col("c_ripeness") >= GRADE_A["ripeness"])
        & (col("overall_quality_score") >= GRADE_A["overall"])
        & ~F.exists("warnings", lambda w: w.startswith("critical_"))
    )
    # The rules in order; the first that holds names the branch.
    branch = (
        F.when(unsure, F.lit("unsure")).when(sure_rotten, F.lit("sure_rotten")).when(rotten, F.lit("maybe_rotten"))
        .when(very_poor, F.lit("very_poor")).when(is_c, F.lit("c")).when(is_a, F.lit("a")).otherwise(F.lit("b"))
    )
    decided = scored.withColumn("_branch", branch)
    at = lambda *names: col("_branch").isin(*names)
    poor_healthy = healthy & poor & ~at("very_poor")
    small = F.coalesce(col("top1_top2_margin") < LOW_MARGIN, F.lit(False))
    rotten_poor = at("sure_rotten") & poor
    codes = reason_codes(
        F.when(healthy, F.lit("classified_as_healthy")).when(rotten, F.lit("classified_as_rotten")).otherwise(F.lit("unknown_condition")),
        code("low_model_confidence", at("unsure")),
        code("high_confidence_rotten_prediction", at("sure_rotten")),
        code("possible_rotten_prediction_manual_review", at("maybe_rotten")),
        code("very_poor_image_quality", at("very_poor")),
        code("one_or_more_grade_c_thresholds_triggered", at("c")),
        code("all_grade_a_thresholds_met", at("a")),
        code("acceptable_quality_but_not_grade_a", at("b")),
        code("image_quality_warning", rotten_poor),
        code("manual_review_required", at("unsure", "maybe_rotten", "very_poor") | rotten_poor),
        code("image_quality_warning", (at("maybe_rotten") & poor) | poor_healthy),
        code("manual_review_recommended", poor_healthy),
        code("low_top1_top2_margin", small),
        code("manual_review_required", small),
        code("opposite_condition_conflict", col("_conflict")),
        code("manual_review_required", col("_conflict")),
        code("default_quality_profile_used", F.array_contains("warnings", UNKNOWN_PROFILE)),
    )
    review = unknown | at("unsure", "maybe_rotten", "very_poor") | rotten_poor | poor_healthy | small | col("_conflict")
    grade = (
        F.when(at("unsure", "very_poor"), F.lit("Review")).when(at("sure_rotten", "maybe_rotten", "c"), F.lit("C"))
        .when(at("a"), F.lit("A")).otherwise(F.lit("B"))
    )
    graded = decided.withColumn("grade", grade).withColumn("manual_review", review).withColumn("quality_reason_codes", codes)
    pick = lambda i, kind: F.element_at(F.create_map(*[F.lit(x) for g, v in GRADE_TABLE.items() for x in (g, v[i])]).cast(f"map<string,{kind}>"), col("grade"))
    action = F.when((col("grade") == "C") & col("manual_review"), F.lit(C_UNDER_REVIEW)).otherwise(pick(0, "string"))
    return (
        graded.withColumn("action", action).withColumn("inventory_status", pick(1, "string"))
        .withColumn("discount_percentage", pick(2, "int")).drop("_branch", "_conflict")
    )


def prediction_enrich(business: DataFrame, decision: DataFrame, key: str, model_name: Column, trained_at: Column, selected_at: Column) -> DataFrame:
    """The served prediction row: quality grade and action replace the first mapping's, review flags
    are OR-ed, reason codes joined without repeats, component scores, stock advice, warnings, model name and version added.

    A row without a decision (its image gave no features) keeps its first mapping, and ``quality_missing`` marks it.
    """
    added = ["overall_quality_score", "inventory_status", "discount_percentage", "warnings", *[c for c in decision.columns if c.startswith("c_")]]
    quality = decision.select(key, "grade", "action", "manual_review", "quality_reason_codes", *added)
    none = F.array().cast("array<string>")
    return business.join(quality, key, "left").select(
        *[c for c in business.columns if c not in ("quality_grade", "recommended_action", "manual_review_required", "reason_codes")],
        F.coalesce("grade", "quality_grade").alias("quality_grade"),
        F.coalesce("action", "recommended_action").alias("recommended_action"),
        (F.col("manual_review_required") | F.coalesce("manual_review", F.lit(False))).alias("manual_review_required"),
        F.array_distinct(F.concat("reason_codes", F.coalesce("quality_reason_codes", none))).alias("reason_codes"),
        *added,
        F.col("grade").isNull().alias("quality_missing"),
        model_name.alias("model_name"),
        F.coalesce(trained_at, selected_at).alias("model_version"),
    )


def missing_images(rows: DataFrame, features: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose image gave no features; a weight study leaves these out, so they are listed before it."""
    return rows.join(features.select(*keys).distinct(), keys, "left_anti")


def evaluate_weight_sets(rows: DataFrame, weight_sets: dict[str, list[float]] | None = None) -> DataFrame:
    """Per weight set: grade counts, review rate, rotten and risky counts, mean score, actions.

    Features are joined once before this; every row meets the few weight sets of a literal array and
    is aggregated at once, so no wider table is ever shuffled.
    """
    sets = weight_sets or WEIGHT_SETS
    literal = F.array(*[F.struct(F.lit(n).alias("name"), F.array(*[F.lit(float(w)) for w in ws]).alias("w")) for n, ws in sets.items()])
    spread = _scored(rows).withColumn("_set", F.explode(literal))
    decided = _decided(spread.withColumn("overall_quality_score", overall_score(F.col("_set.w")))).withColumn("weight_set", F.col("_set.name"))
    uncertain = (F.col("confidence") < LOW_CONFIDENCE) | F.coalesce(F.col("top1_top2_margin") < LOW_MARGIN, F.lit(False))
    rotten, good = F.col("condition") == "rotten", F.col("grade").isin("A", "B")
    per_action = decided.groupBy("weight_set", "action").agg(
        F.count("*").alias("n"),
        *[F.sum(flag(F.col("grade") == g)).alias(f"n_{g}") for g in GRADE_TABLE],
        F.sum(flag(F.col("manual_review"))).alias("reviews"),
        F.sum(flag(rotten)).alias("rotten"),
        F.sum(flag(rotten & ~good)).alias("rotten_held"),
        F.sum(flag(good & (rotten | uncertain))).alias("risky"),
        F.sum("overall_quality_score").alias("score"),
    )
    actions = F.array_sort(F.collect_list(F.struct("action", "n")))
    text = F.array_join(F.transform(actions, lambda a: F.concat(a["action"], F.lit(":"), a["n"].cast("string"))), "|")
    sums = per_action.groupBy("weight_set").agg(
        *[F.sum(f"n_{g}").alias(f"n_{g}") for g in GRADE_TABLE],
        *[F.sum(c).alias(c) for c in ("n", "reviews", "rotten", "rotten_held", "risky", "score")],
        text.alias("action_distribution"),
    )
    return sums.select(
        "weight_set",
        F.col("n_A").alias("grade_a_count"), F.col("n_B").alias("grade_b_count"),
        F.col("n_C").alias("grade_c_count"), F.col("n_Review").alias("review_count"),
        round6(ratio(F.col("reviews"), F.col("n"))).alias("manual_review_rate"),
        round6(ratio(F.col("rotten_held"), F.col("rotten"))).alias("rotten_to_c_or_review_rate"),
        F.col("risky").alias("risky_a_b_decisions"),
        round6(ratio(F.col("score"), F.col("n"))).alias("mean_overall_quality_score"),
        "action_distribution",
    )


# --- distributions -------------------------------------------------------------------------------


def grade_distribution(rows: DataFrame) -> DataFrame:
    """Rows per (model, grade); rows without a grade are a group of their own."""
    return rows.groupBy("model", "quality_grade").agg(F.count("*").alias("count"))


def action_distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy("model", "recommended_action").agg(F.count("*").alias("count"))


def manual_review_rate(rows: DataFrame) -> DataFrame:
    return rows.groupBy("model").agg(round6(F.avg(F.col("manual_review_required").cast("int"))).alias("manual_review_rate"))


def entity_union_distinct(key: str, *tables: DataFrame) -> DataFrame:
    """Distinct keys found in any of the tables."""
    out = tables[0].select(key)
    for table in tables[1:]:
        out = out.unionByName(table.select(key))
    return out.distinct()


def quality_rule_summary(grades: DataFrame, actions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per model: ``grade:count; ...`` and ``action:count; ...`` texts and the review rate."""

    def text(df: DataFrame, name: str, out: str) -> DataFrame:
        pairs = F.array_sort(F.collect_list(F.struct(F.coalesce(name, F.lit("nan")).alias("k"), F.col("count").alias("v"))))
        parts = F.transform(pairs, lambda p: F.concat(p["k"], F.lit(":"), p["v"].cast("string")))
        return df.groupBy("model").agg(F.array_join(parts, "; ").alias(out))

    models = entity_union_distinct("model", grades, actions, reviews)
    filled = models.join(text(grades, "quality_grade", "grade_distribution"), "model", "left").join(
        text(actions, "recommended_action", "action_distribution"), "model", "left"
    )
    empty = {"grade_distribution": "", "action_distribution": ""}
    return filled.na.fill(empty).join(reviews.select("model", "manual_review_rate"), "model", "left")
