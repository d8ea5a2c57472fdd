"""Class-name, path and event-time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import round_to

# File-name prefixes written by offline augmentation, tried once each in this order,
# and the suffix written before the extension.
AUGMENTATION_PREFIXES = (
    "rotated_by_\\d+_",
    "vertical_flip_",
    "horizontal_flip_",
    "translation_",
    "saltandpepper_",
    "noise_",
    "brightness_",
    "contrast_",
)
AUGMENTATION_SUFFIX = "_augmented_\\d+(?=\\.)"

# Caption lines.
CAPTION_HIGH_CONFIDENCE = "Risk: high-confidence error, manual review needed."
CAPTION_ERROR = "Risk: incorrect prediction, inspect the attention map."
CAPTION_PLAIN = "Interpretation: highlighted regions influenced the decision most."


def produce_of(class_name: Column) -> Column:
    return F.substring_index(class_name, "__", 1)


def status_of(class_name: Column) -> Column:
    """What follows the first ``__`` in lower case, or ``unknown``."""
    rest = F.split(class_name, "__", 2)
    return F.when(F.size(rest) > 1, F.lower(rest[1])).otherwise(F.lit("unknown"))


def condition_of(class_name: Column) -> Column:
    """Condition by the end of the name; differs from ``status_of`` when the name has two ``__``."""
    text = F.lower(class_name)
    return (
        F.when(text.endswith("__healthy"), F.lit("healthy"))
        .when(text.endswith("__rotten"), F.lit("rotten"))
        .otherwise(F.lit("unknown"))
    )


def business_name(class_name: Column) -> Column:
    plain = F.lower(F.trim(F.replace(produce_of(class_name), F.lit("_"), F.lit(" "))))
    status = status_of(class_name)
    whole = F.lower(F.trim(F.replace(F.replace(class_name, F.lit("__"), F.lit(" ")), F.lit("_"), F.lit(" "))))
    return F.when(status.isin("healthy", "rotten"), F.concat(status, F.lit(" "), plain)).otherwise(whole)


def class_caption(predicted: Column, confidence: Column, actual: Column, correct: Column) -> Column:
    """Caption lines: label if known, prediction, confidence, risk or interpretation."""
    percent = F.format_string("Confidence: %.1f%%", round_to(confidence * 100.0, 1))
    risk = (
        F.when((correct == F.lit(False)) & (confidence >= 0.95), F.lit(CAPTION_HIGH_CONFIDENCE))
        .when(correct == F.lit(False), F.lit(CAPTION_ERROR))
        .otherwise(F.lit(CAPTION_PLAIN))
    )
    truth = F.when(actual.isNotNull(), F.concat(F.lit("Actual label: "), business_name(actual)))
    return F.concat_ws("\n", truth, F.concat(F.lit("Model prediction: "), business_name(predicted)), percent, risk)


def forward_slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def source_image_id(relative_path: Column) -> Column:
    """Identity of the image an offline variant was made from; the class folder stays."""
    path = forward_slashes(relative_path)
    has_folder = F.instr(path, "/") > 0
    folder = F.when(has_folder, F.concat(F.substring_index(path, "/", 1), F.lit("/"))).otherwise(F.lit(""))
    name = F.when(has_folder, F.regexp_replace(path, "^[^/]*/", "")).otherwise(path)
    for prefix in AUGMENTATION_PREFIXES:
        name = F.regexp_replace(name, f"(?i)^{prefix}", "")
    return F.concat(folder, F.regexp_replace(name, f"(?i){AUGMENTATION_SUFFIX}", ""))


def file_name(path: Column) -> Column:
    return F.substring_index(forward_slashes(path), "/", -1)


def file_stem(path: Column) -> Column:
    """File name without its last extension; a leading dot does not start an extension."""
    return F.regexp_replace(file_name(path), "(?<=.)\\.[^.]+$", "")


def drive_to_mount(path: Column) -> Column:
    """``D:\\x`` or ``D:/x`` to ``/mnt/d/x``; other paths stay."""
    is_drive = path.rlike("^[A-Za-z]:[\\\\/]")
    rest = forward_slashes(F.regexp_replace(path, "^[A-Za-z]:[\\\\/]", ""))
    mounted = F.concat(F.lit("/mnt/"), F.lower(F.substring(path, 1, 1)), F.lit("/"), rest)
    return F.when(is_drive, mounted).otherwise(path)


def mount_to_drive(path: Column) -> Column:
    """``/mnt/d/x`` to ``d:/x``; other paths stay."""
    return F.regexp_replace(path, "^/mnt/([^/])/", "$1:/")


def first_non_empty(*values: Column) -> Column:
    """First value that is neither null nor an empty text."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def event_time(text: Column) -> Column:
    return F.try_to_timestamp(text)


def event_day(text: Column) -> Column:
    """The day as it is written: the first ten characters, whatever the time's offset; ``unknown`` for none."""
    return F.coalesce(F.substring(F.nullif(text, F.lit("")), 1, 10), F.lit("unknown"))
