"""Reason codes and the sentences made from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reason code -> wording, reorder lists.
REORDER_WORDING = {
    "globally_popular_product": "popular across the marketplace",
    "cold_start_fallback": "used as a fallback where customer history is sparse",
    "frequently_ordered_by_customer": "ordered repeatedly by this customer",
    "ordered_recently": "ordered recently by this customer",
    "common_for_customer_type": "common for this customer segment",
    "seasonally_available": "currently in season",
}
REORDER_DEFAULT = "Recommended by the quick-reorder scoring method."

# Reason code -> wording, discovery lists.
DISCOVERY_WORDING = {
    "commonly_bought_together": "commonly bought with products this customer purchased",
    "similar_basket_pattern": "found in similar baskets",
    "new_to_customer": "not previously purchased by this customer",
    "seasonally_available": "currently in season",
    "popular_with_similar_customers": "popular with similar customers",
    "globally_popular_product": "popular across the marketplace",
    "cold_start_discovery_fallback": "used as a discovery fallback where history is sparse",
    "producer_diversity_applied": "selected to improve producer diversity",
    "limited_diversity_candidates": "included because diverse alternatives were limited",
    "insufficient_new_discovery_candidates": "included because there were not enough new discovery candidates",
}
DISCOVERY_DEFAULT = "Recommended by the discovery scoring method."


def reason_codes(*codes: Column) -> Column:
    """The codes that apply, in order and without repeats. A code that does not apply is null."""
    return F.array_distinct(F.array_compact(F.array(*codes)))


def code(name: str, condition: Column | None = None) -> Column:
    return F.lit(name) if condition is None else F.when(condition, F.lit(name))


def reason_text(codes: Column, wording: dict[str, str], default: str) -> Column:
    """One sentence from the known codes, or the default when none is known."""
    table = F.create_map(*[F.lit(x) for pair in wording.items() for x in pair])
    words = F.array_compact(F.transform(codes, lambda c: F.try_element_at(table, c)))
    sentence = F.concat(F.lit("Recommended because it is "), F.array_join(words, ", "), F.lit("."))
    return F.when(F.size(words) > 0, sentence).otherwise(F.lit(default))


def joined(codes: Column) -> Column:
    return F.array_join(codes, "|")
