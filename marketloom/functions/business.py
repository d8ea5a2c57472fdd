"""Mapping of a classifier prediction to grade, action, reasons and review flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .reasons import code, reason_codes

# Thresholds of the first mapping layer.
LOW_CONFIDENCE = 0.60
GOOD_CONFIDENCE = 0.90
HIGH_CONFIDENCE = 0.95
AMBIGUOUS_MARGIN = 0.15

# Action wording.
ACTION_INSPECT = "Manual inspection recommended before taking action."
ACTION_ACCEPT = "Accept for marketplace listing or normal handling."
ACTION_REJECT = "Reject from sale and route for disposal or supplier review."


def low_margin(margin: Column) -> Column:
    """True when a margin is known and small."""
    return F.coalesce(margin < AMBIGUOUS_MARGIN, F.lit(False))


def legacy_grade(status: Column, confidence: Column) -> Column:
    sure, likely = confidence >= GOOD_CONFIDENCE, confidence >= LOW_CONFIDENCE
    healthy, rotten = status == "healthy", status == "rotten"
    return (
        F.when(healthy & sure, F.lit("A"))
        .when(healthy & likely, F.lit("B"))
        .when(rotten & sure, F.lit("Reject"))
        .when(rotten & likely, F.lit("Likely reject"))
        .otherwise(F.lit("Review"))
    )


def legacy_action(status: Column, confidence: Column, margin: Column) -> Column:
    inspect = (confidence < LOW_CONFIDENCE) | low_margin(margin)
    return (
        F.when(inspect, F.lit(ACTION_INSPECT))
        .when(status == "healthy", F.lit(ACTION_ACCEPT))
        .when(status == "rotten", F.lit(ACTION_REJECT))
        .otherwise(F.lit(ACTION_INSPECT))
    )


def legacy_reasons(status: Column, confidence: Column, margin: Column) -> Column:
    low, small = confidence < LOW_CONFIDENCE, low_margin(margin)
    return reason_codes(
        F.when(status == "rotten", F.lit("ROTTEN_PREDICTION"))
        .when(status == "healthy", F.lit("HEALTHY_PREDICTION"))
        .otherwise(F.lit("UNKNOWN_FRESHNESS_STATUS")),
        F.when(low, F.lit("LOW_CONFIDENCE"))
        .when(confidence < GOOD_CONFIDENCE, F.lit("MEDIUM_CONFIDENCE"))
        .otherwise(F.lit("HIGH_CONFIDENCE")),
        code("MANUAL_REVIEW_REQUIRED", low),
        code("HIGH_CONFIDENCE_PREDICTION", confidence >= HIGH_CONFIDENCE),
        code("AMBIGUOUS_PREDICTION", small),
        code("MANUAL_REVIEW_REQUIRED", small),
        code("HIGH_CONFIDENCE_REJECTION", (status == "rotten") & (confidence >= GOOD_CONFIDENCE)),
    )


def legacy_review(status: Column, confidence: Column, margin: Column) -> Column:
    known = F.coalesce(status.isin("healthy", "rotten"), F.lit(False))
    return (confidence < LOW_CONFIDENCE) | ~known | low_margin(margin)


def freshness_score(status: Column, confidence: Column) -> Column:
    return F.when(status == "healthy", confidence).when(status == "rotten", F.lit(1.0) - confidence).otherwise(F.lit(0.0))


# --- top-k lists ---------------------------------------------------------------------------------

TOP_K_JSON = "array<struct<class_name:string,class:string,confidence:double,probability:double>>"


def parse_top_k(text: Column) -> Column:
    """JSON list to structs (class_name, probability); either spelling of both keys; incomplete entries drop."""
    entries = F.from_json(text, TOP_K_JSON)
    named = F.transform(
        entries,
        lambda e: F.struct(
            F.coalesce(F.nullif(e["class_name"], F.lit("")), e["class"]).alias("class_name"),
            F.coalesce(e["confidence"], e["probability"]).alias("probability"),
        ),
    )
    return F.filter(named, lambda e: e["class_name"].isNotNull() & e["probability"].isNotNull())


def top_k_from_vector(probabilities: Column, class_names: list[str], k: int = 3) -> Column:
    """The k most probable classes, best first; equal values keep the lower index first."""
    names = F.array(*[F.lit(n) for n in class_names])
    entries = F.transform(
        probabilities,
        lambda p, i: F.struct((-p).alias("order"), i.alias("index"), F.get(names, i).alias("class_name"), p.alias("probability")),
    )
    k = max(1, min(k, len(class_names)))
    best = F.slice(F.array_sort(entries), 1, k)
    return F.transform(best, lambda e: F.struct(e["class_name"].alias("class_name"), e["probability"].alias("probability")))


def list_margin(top_k: Column) -> Column:
    """First minus second probability when there are at least two entries."""
    return F.when(F.size(top_k) >= 2, F.get(top_k, F.lit(0))["probability"] - F.get(top_k, F.lit(1))["probability"])
