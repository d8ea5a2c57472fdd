"""Image folders: listing and choice of the dataset root."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classes import forward_slashes

# Accepted file extensions (lower and upper case).
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png"]


def list_paths(spark: SparkSession, root: str) -> DataFrame:
    """Paths below ``root``; the file contents are pruned away and never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.regexp_replace("path", "^file:", "").alias("path"))


def _is_image(path):
    endings = "|".join(e.replace(".", "\\.") for e in IMAGE_EXTENSIONS)
    upper = "|".join(e.upper().replace(".", "\\.") for e in IMAGE_EXTENSIONS)
    return path.rlike(f"({endings}|{upper})$")


def image_listing(paths: DataFrame, root: str) -> DataFrame:
    """Images in the class folders directly below ``root``: path, relative path, class."""
    base = root.rstrip("/") + "/"
    path = forward_slashes(F.col("path"))
    relative = F.substring(path, len(base) + 1, 2**30)
    return (
        paths.filter(path.startswith(base) & _is_image(path))
        .select(path.alias("image_path"), relative.alias("relative_path"))
        .filter(F.size(F.split("relative_path", "/")) == 2)
        .withColumn("class_name", F.substring_index("relative_path", "/", 1))
    )


def require_images(listing: DataFrame) -> DataFrame:
    if listing.isEmpty():
        raise ValueError("no images found in class folders")
    return listing


def dataset_root_pick(paths: DataFrame, expected_classes: int | None = None) -> DataFrame:
    """One row: the folder whose direct children are class folders.

    A folder with exactly the expected number of class folders wins, else the one with most;
    ties go to the first path.
    """
    path = forward_slashes(F.col("path"))
    folder = F.regexp_replace(path, "/[^/]*$", "")
    classes = (
        paths.filter(_is_image(path))
        .select(F.regexp_replace(folder, "/[^/]*$", "").alias("root"), folder.alias("folder"))
        .distinct()
        .groupBy("root")
        .agg(F.count("*").alias("class_folders"))
    )
    exact = F.lit(False) if expected_classes is None else F.col("class_folders") == expected_classes
    # Among exact matches the first path wins whatever its size, and their sizes are all equal.
    return classes.orderBy(exact.desc(), F.col("class_folders").desc(), F.col("root")).limit(1)
