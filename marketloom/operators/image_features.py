"""Colour and quality features of images, computed on Arrow batches where the images are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import clamp

# Quality profiles - accepted hue ranges in degrees (start > end wraps), dark-ratio
# thresholds and the foreground mask.
PROFILES = {
    "default": dict(hues=[(0, 20), (340, 360), (20, 45), (35, 80), (70, 165)], dark_warn=0.18, dark_fail=0.32, min_saturation=0.18, min_value=0.12, max_value=0.97),
    "apple": dict(hues=[(0, 18), (340, 360), (70, 160), (35, 70)], dark_warn=0.18, dark_fail=0.32, min_saturation=0.20, min_value=0.12, max_value=0.97),
    "banana": dict(hues=[(35, 75), (75, 140)], dark_warn=0.12, dark_fail=0.25, min_saturation=0.18, min_value=0.12, max_value=0.97),
    "tomato": dict(hues=[(0, 20), (340, 360), (20, 38)], dark_warn=0.15, dark_fail=0.30, min_saturation=0.22, min_value=0.12, max_value=0.97),
    "potato": dict(hues=[(35, 80), (20, 55)], dark_warn=0.20, dark_fail=0.35, min_saturation=0.12, min_value=0.12, max_value=0.97),
    "bellpepper": dict(hues=[(0, 20), (340, 360), (35, 75), (70, 165)], dark_warn=0.16, dark_fail=0.30, min_saturation=0.20, min_value=0.12, max_value=0.97),
    "carrot": dict(hues=[(18, 45), (35, 70)], dark_warn=0.16, dark_fail=0.30, min_saturation=0.20, min_value=0.12, max_value=0.97),
    "cucumber": dict(hues=[(70, 165), (35, 75)], dark_warn=0.16, dark_fail=0.30, min_saturation=0.18, min_value=0.12, max_value=0.97),
    "grape": dict(hues=[(70, 165), (0, 20), (340, 360), (250, 330)], dark_warn=0.22, dark_fail=0.40, min_saturation=0.16, min_value=0.10, max_value=0.97),
    "guava": dict(hues=[(70, 165), (35, 80), (330, 360), (0, 15)], dark_warn=0.18, dark_fail=0.32, min_saturation=0.16, min_value=0.12, max_value=0.97),
    "jujube": dict(hues=[(70, 165), (35, 80), (15, 55), (0, 20), (340, 360)], dark_warn=0.22, dark_fail=0.38, min_saturation=0.14, min_value=0.10, max_value=0.97),
    "mango": dict(hues=[(70, 165), (35, 80), (20, 45), (0, 18), (340, 360)], dark_warn=0.18, dark_fail=0.32, min_saturation=0.18, min_value=0.12, max_value=0.97),
    "orange": dict(hues=[(18, 45), (35, 70)], dark_warn=0.16, dark_fail=0.30, min_saturation=0.18, min_value=0.12, max_value=0.97),
    "pomegranate": dict(hues=[(0, 25), (335, 360), (35, 75)], dark_warn=0.20, dark_fail=0.35, min_saturation=0.18, min_value=0.10, max_value=0.97),
    "strawberry": dict(hues=[(0, 25), (335, 360), (75, 160)], dark_warn=0.16, dark_fail=0.30, min_saturation=0.20, min_value=0.12, max_value=0.97),
}
# Warnings.
WARN_PROFILE = "unknown_produce_profile_used"
WARN_MASK = "foreground_mask_low_confidence"
WARN_DARK_FAIL = "dark_ratio_fail_threshold_reached"
WARN_DARK = "dark_ratio_warn_threshold_reached"
WARN_SIZE = "size_proxy_is_relative_to_image_area_not_physical_size"
WARN_COLOUR = "colour_score_is_lighting_sensitive_proxy"
WARN_SMALL = "low_foreground_coverage"
WARN_LARGE = "high_foreground_coverage_or_background_mask_noise"

PROFILE_SCHEMA = (
    "profile string, hue_ranges array<struct<lo:double,hi:double>>, dark_ratio_warn double,"
    " dark_ratio_fail double, min_saturation double, min_value double, max_value double"
)
MEASURES = "foreground_area_ratio double, accepted_color_ratio double, dark_ratio double, blur_score double, brightness_score double"


def quality_profiles(spark: SparkSession) -> DataFrame:
    rows = [
        (name, [(float(a), float(b)) for a, b in p["hues"]], p["dark_warn"], p["dark_fail"], p["min_saturation"], p["min_value"], p["max_value"])
        for name, p in PROFILES.items()
    ]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def profile_key(product_type: Column) -> Column:
    return F.replace(F.replace(F.lower(product_type), F.lit("__"), F.lit("_")), F.lit(" "), F.lit("_"))


def quality_profile_join(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """Adds the profile of each product type, or the default one, and ``profile_known``.

    The default row comes from a scalar subquery, so there is no second join.
    """
    values = [c for c in profiles.columns if c != "profile"]
    default = profiles.filter("profile = 'default'").select(F.struct(*values)).scalar()
    table = profiles.select(F.col("profile").alias("_key"), F.struct(*values).alias("_own"))
    joined = rows.join(table, profile_key(F.col("product_type")) == F.col("_key"), "left")
    joined = joined.withColumn("profile_known", F.col("_key").isNotNull()).withColumn("_used", F.coalesce("_own", default))
    return joined.select(*rows.columns, "profile_known", *[F.col(f"_used.{v}").alias(v) for v in values])


def hue_accepted(hue: Column, ranges: Column) -> Column:
    """The hue lies in one of the ranges; a range whose start is above its end wraps."""
    inside = lambda r: F.when(r["lo"] <= r["hi"], (hue >= r["lo"]) & (hue <= r["hi"])).otherwise((hue >= r["lo"]) | (hue <= r["hi"]))
    return F.exists(ranges, inside)


def merged_ranges(ranges: Column) -> Column:
    """Hue ranges as disjoint ones in ascending order; one whose start is above its end wraps and becomes two."""
    open_end = lambda r: F.array(F.struct(r["lo"].alias("lo"), F.lit(float("inf")).alias("hi")), F.struct(F.lit(float("-inf")).alias("lo"), r["hi"].alias("hi")))
    plain = lambda r: F.array(F.struct(r["lo"].alias("lo"), r["hi"].alias("hi")))
    ordered = F.array_sort(F.flatten(F.transform(ranges, lambda r: F.when(r["lo"] <= r["hi"], plain(r)).otherwise(open_end(r)))))

    def put(done: Column, r: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.array(F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], r["hi"]).alias("hi")))
        return F.when(F.coalesce(r["lo"] <= last["hi"], F.lit(False)), F.concat(F.slice(done, 1, F.size(done) - 1), longer)).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(ordered, F.array().cast("array<struct<lo:double,hi:double>>"), put)


def _place(ordered: Column, limit: Column, inclusive: bool) -> Column:
    """How many values of an ascending array lie below ``limit`` (or at it), by binary search."""
    span = F.struct(F.lit(0).alias("a"), F.size(ordered).alias("b"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["a"] + at["b"]) / 2).cast("int")
        value = F.get(ordered, middle)
        below = value <= limit if inclusive else value < limit
        step = F.when(below, F.struct((middle + 1).alias("a"), at["b"].alias("b"))).otherwise(F.struct(at["a"].alias("a"), middle.alias("b")))
        return F.when(at["a"] < at["b"], step).otherwise(at)

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(ordered) + 1)).cast("int"))
    return F.aggregate(steps, span, halve, lambda at: at["a"])


def hues_accepted(ordered: Column, ranges: Column) -> Column:
    """How many of an image's hues (ascending) lie in one of the ranges (``merged_ranges``): two searches a range."""
    return F.aggregate(ranges, F.lit(0).cast("bigint"), lambda n, r: n + _place(ordered, r["hi"], True) - _place(ordered, r["lo"], False))


def hsv(red: Column, green: Column, blue: Column) -> Column:
    """Hue in degrees, saturation and value as a struct. On channel ties blue wins over green over red."""
    high, low = F.greatest(red, green, blue), F.least(red, green, blue)
    delta = high - low
    base = (
        F.when(blue == high, (red - green) / delta * 60.0 + 240.0)
        .when(green == high, (blue - red) / delta * 60.0 + 120.0)
        .otherwise(F.pmod((green - blue) / delta * 60.0, F.lit(360.0)))
    )
    hue = F.when(delta > 1e-8, base).otherwise(F.lit(0.0))
    saturation = F.when(high > 1e-8, delta / high).otherwise(F.lit(0.0))
    return F.struct(hue.alias("hue"), saturation.alias("saturation"), high.alias("value"))


#: Pixels that are measured in one tensor.
TENSOR_PIXELS = 1_000_000
#: Largest table of profiles; it goes to the tasks with the function.
MOST_PROFILES = 1_000


def _disjoint(ranges: list) -> list[tuple[float, float]]:
    """Hue ranges as disjoint ones; one whose start is above its end wraps and becomes two."""
    spans = []
    for lo, hi in ranges:
        spans += [(lo, hi)] if lo <= hi else [(lo, np.inf), (-np.inf, hi)]
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _colours(rgb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hue, saturation and value of (images, pixels, 3)."""
    red, green, blue = rgb[..., 0], rgb[..., 1], rgb[..., 2]
    value = rgb.max(axis=-1)
    delta = value - rgb.min(axis=-1)
    grey = delta <= 1e-8
    step = np.where(grey, 1.0, delta)
    hue = np.select(
        [grey, blue == value, green == value],
        [0.0, (red - green) / step * 60.0 + 240.0, (blue - red) / step * 60.0 + 120.0],
        np.mod((green - blue) / step * 60.0, 360.0),
    )
    return hue, np.where(value > 1e-8, delta / np.where(value > 1e-8, value, 1.0), 0.0), value


def _sharpness(rgb: np.ndarray, height: int, width: int) -> np.ndarray:
    """Blur scores of images of one shape: the variance of their Laplacian."""
    if min(height, width) < 3:
        return np.zeros(len(rgb))
    grey = (rgb[..., 0] * 0.299 + rgb[..., 1] * 0.587 + rgb[..., 2] * 0.114).reshape(-1, height, width)
    edges = grey[:, :-2, 1:-1] + grey[:, 2:, 1:-1] + grey[:, 1:-1, :-2] + grey[:, 1:-1, 2:] - grey[:, 1:-1, 1:-1] * 4.0
    return np.clip(edges.reshape(len(rgb), -1).var(axis=1) * 1000.0, 0.0, 100.0)


def _spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, start, length) of a column of lists or bytes; null has length -1."""
    if pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
        _, ends, data = column.buffers()
        at = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        values = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    else:
        at = column.offsets.to_numpy().astype(np.int64)
        values = column.values.to_numpy(zero_copy_only=False)
    return values, at[:-1], np.where(column.is_null().to_numpy(zero_copy_only=False), -1, np.diff(at))


def _measure_batch(batch: pa.RecordBatch, profiles: dict, tensor_pixels: int) -> pa.RecordBatch:
    """One row for each readable image and product type of it. Images of one shape are one tensor: colours, blur and brightness
    are computed once an image, foreground and hues for all images of a profile at once."""
    size = [np.nan_to_num(batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64) for c in ("height", "width")]
    area = size[0] * size[1]
    spans = [_spans(batch.column(c)) for c in (["data"] if "data" in batch.schema.names else ["red", "green", "blue"])]
    depth = spans[0][2] // np.maximum(area, 1)
    fits = (area > 0) & (depth >= 1) & np.logical_and.reduce([s[2] == area * depth for s in spans])
    fits &= np.isin(depth, (1, 3, 4)) if len(spans) == 1 else depth == 1
    kinds = batch.column("product_types")
    images = pa.ListArray.flatten(kinds), np.repeat(np.arange(len(kinds)), np.where(kinds.is_null(), 0, np.diff(kinds.offsets.to_numpy())))
    names = images[0].dictionary_encode()
    codes = names.indices.to_numpy(zero_copy_only=False) if len(names) else np.zeros(0, dtype=np.int64)
    of_name = [(n or "").lower().replace("__", "_").replace(" ", "_") for n in names.dictionary.to_pylist()]
    used = sorted({n if n in profiles else "default" for n in of_name})
    kind = np.array([used.index(n if n in profiles else "default") for n in of_name], dtype=np.int64)[codes] if len(names) else codes
    out = np.zeros((len(codes), 5))
    shapes = np.stack([size[0], size[1], depth], axis=1)
    for shape in np.unique(shapes[fits], axis=0):
        same = np.flatnonzero(fits & (shapes == shape).all(axis=1))
        pixels, per = int(shape[0] * shape[1]), max(1, tensor_pixels // int(shape[0] * shape[1]))
        for begin in range(0, len(same), per):
            chosen = same[begin : begin + per]
            if len(spans) == 3:
                rgb = np.stack([v[a[chosen][:, None] + np.arange(pixels)] for v, a, _ in spans], axis=-1).astype(np.float64)
            else:
                flat = spans[0][0][spans[0][1][chosen][:, None] + np.arange(pixels * shape[2])].reshape(len(chosen), pixels, -1)
                rgb = (np.repeat(flat, 3, axis=2) if shape[2] == 1 else flat[..., 2::-1]).astype(np.float64) / 255.0
            hue, saturation, value = _colours(rgb)
            blur = _sharpness(rgb, int(shape[0]), int(shape[1]))
            brightness = np.clip(100.0 - np.abs(value.mean(axis=1) - 0.55) * 180.0, 0.0, 100.0)
            rows = np.flatnonzero((images[1] >= chosen[0]) & (images[1] <= chosen[-1]))
            rows = rows[np.isin(images[1][rows], chosen)]
            local = np.searchsorted(chosen, images[1][rows])
            for k in np.unique(kind[rows]):
                mine = kind[rows] == k
                which, p = local[mine], profiles[used[k]]
                h, s, v = hue[which], saturation[which], value[which]
                front = (s >= p["min_saturation"]) & (v >= p["min_value"]) & (v <= p["max_value"])
                total = front.sum(axis=1)
                inside = np.zeros(front.shape, dtype=bool)
                for lo, hi in p["ranges"]:
                    inside |= (h >= lo) & (h <= hi)
                part = lambda m: (m & front).sum(axis=1) / np.maximum(total, 1)
                dark = np.where(total > 0, part(v < p["dark_ratio_warn"]), 1.0)
                out[rows[mine]] = np.stack([total / pixels, part(inside), dark, blur[which], brightness[which]], axis=1)
    kept = fits[images[1]] if len(codes) else np.zeros(0, dtype=bool)
    keys = [batch.column("image_id").take(pa.array(images[1][kept])), images[0].filter(pa.array(kept))]
    columns = [part.split()[0] for part in MEASURES.split(", ")]
    return pa.RecordBatch.from_arrays(
        [*keys, *[pa.array(out[kept, i]) for i in range(5)]], names=["image_id", "product_type", *columns],
    )


def _profiles_of(profiles: DataFrame) -> dict:
    """The profiles as values; a table over MOST_PROFILES is refused."""
    rows = profiles.limit(MOST_PROFILES + 1).collect()
    if len(rows) > MOST_PROFILES:
        raise ValueError(f"more than {MOST_PROFILES} quality profiles")
    return {
        r["profile"]: {**{c: r[c] for c in ("dark_ratio_warn", "min_saturation", "min_value", "max_value")}, "ranges": _disjoint([tuple(h) for h in r["hue_ranges"]])}
        for r in rows
    }


def from_image_source(images: DataFrame) -> DataFrame:
    """Rows of Spark's image source as (image_id, height, width, data)."""
    return images.select(
        F.col("image.origin").alias("image_id"), F.col("image.height").alias("height"),
        F.col("image.width").alias("width"), F.col("image.data").alias("data"),
    )


def image_features(images: DataFrame, profiles: DataFrame, tensor_pixels: int = TENSOR_PIXELS) -> DataFrame:
    """Nine scores and the warnings per (image_id, product_type).

    ``images`` holds image_id, height, width, either red/green/blue arrays (0..1) or ``data``, and product_type, or
    product_types (an array) for images that are to be measured for several types. Pixels never leave the task that read
    them and are read once an image: only five numbers per type come back, and the scores made from those stay in
    generated code. An image without pixels, or with another number of them than its size says, gives no row
    (``quality.missing_images``).
    """
    pixels = ["data"] if "data" in images.columns else ["red", "green", "blue"]
    types = F.col("product_types") if "product_types" in images.columns else F.array("product_type")
    ready = images.select("image_id", types.alias("product_types"), "height", "width", *pixels)
    id_type = images.schema["image_id"].dataType.simpleString()
    table = _profiles_of(profiles)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _measure_batch(batch, table, tensor_pixels)

    measured = ready.mapInArrow(measure, f"image_id {id_type}, product_type string, {MEASURES}")
    named = quality_profile_join(measured, profiles)
    col = F.col
    failed, warned = col("dark_ratio") >= col("dark_ratio_fail"), col("dark_ratio") >= col("dark_ratio_warn")
    colour = (
        col("accepted_color_ratio") * 100.0
        - F.when(failed, F.lit(40.0)).when(warned, F.lit(20.0)).otherwise(F.lit(0.0))
        - F.when(col("profile_known"), F.lit(0.0)).otherwise(F.lit(10.0))
    )
    area = col("foreground_area_ratio")
    size = (
        F.when(area.between(0.25, 0.75), F.lit(90.0))
        .when(((area >= 0.15) & (area < 0.25)) | ((area > 0.75) & (area <= 0.85)), F.lit(75.0))
        .otherwise(F.lit(60.0))
    )
    no_front = area == 0
    warnings = F.array_compact(F.array(
        F.when(~col("profile_known"), F.lit(WARN_PROFILE)),
        F.when(no_front, F.lit(WARN_MASK)),
        F.when(failed, F.lit(WARN_DARK_FAIL)).when(warned, F.lit(WARN_DARK)),
        F.lit(WARN_SIZE),
        F.lit(WARN_COLOUR),
        F.when(area < 0.15, F.lit(WARN_SMALL)).when(area > 0.85, F.lit(WARN_LARGE)),
    ))
    return named.select(
        "image_id", "product_type", "profile_known",
        clamp(col("blur_score") * 0.60 + col("brightness_score") * 0.40, 0, 100).alias("image_quality_score"),
        clamp(colour, 0, 100).alias("color_score"),
        clamp(F.lit(100.0) - col("dark_ratio") * 100.0, 0, 100).alias("defect_absence_score"),
        size.alias("size_proxy_score"),
        "dark_ratio", "accepted_color_ratio", "blur_score", "brightness_score", "foreground_area_ratio",
        warnings.alias("feature_warnings"),
    )
