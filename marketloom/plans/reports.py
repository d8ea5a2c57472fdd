"""Report sinks and the evaluation pack."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import predictions as P
from ..operators import quality as Q


#: CSV as other tools read it: quotes doubled, blanks at the ends of a text kept.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_report(df: DataFrame, path: str, fmt: str = "csv", order: list[str] | None = None, seen: Observation | None = None) -> None:
    """Write a result table; nested columns become JSON text for CSV. Nothing passes the driver.

    ``seen`` observes ``rows``, the number written. JSON keeps null fields.
    """
    if fmt == "csv":
        nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")]
        for name in nested:
            df = df.withColumn(name, F.to_json(name))
    out = df.orderBy(*order) if order else df
    if seen is not None:
        # After the sort: its sampling pass reads the rows before it once more.
        out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.options(**CSV).csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.parquet(path)


def evaluation_pack(spark: SparkSession, preds: DataFrame, validation: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write the evaluation tables and return the manifest (file, rows).

    ``preds`` holds model, class_name, predicted_class, confidence and the business mapping. A table
    without rows is neither written nor listed.
    """
    report = P.classification_report(preds, ["model"])
    grades, actions, reviews = Q.grade_distribution(preds), Q.action_distribution(preds), Q.manual_review_rate(preds)
    tables = {
        "model_comparison_summary": P.model_comparison(preds),
        "weak_class_summary": P.weakest_classes(report, ["model"]),
        "grade_distribution": grades,
        "action_distribution": actions,
        "manual_review_rate": reviews,
        "quality_rule_summary": Q.quality_rule_summary(grades, actions, reviews),
        "external_image_validation": validation,
        "risky_case_examples": P.risky_cases(validation),
    }
    listed = []
    for name, table in tables.items():
        location = f"{path.rstrip('/')}/{name}"
        write_report(table, location, fmt)
        written = spark.read.schema(table.schema).format(fmt).load(location) if fmt != "csv" else spark.read.options(**CSV).csv(location)
        listed.append(written.agg(F.count("*").alias("rows")).select(F.lit(name).alias("file"), "rows"))
    manifest = reduce(DataFrame.unionByName, listed).filter("rows > 0")
    manifest.write.mode("overwrite").json(f"{path.rstrip('/')}/manifest")
    return manifest
