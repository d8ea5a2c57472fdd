"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "marketloom", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names for checkpoints; where none is named, one in the warehouse, which is shared too."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return spark.sparkContext.getCheckpointDir()


#: Rows of a large input that one shuffle partition should hold, at most about.
PARTITION_ROWS = 250_000


#: Stored megabytes up to which adaptive execution may merge the partitions of such an input's shuffles.
PARTITION_MB = 8
ADVISORY_CONF = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _megabytes(size: str) -> float:
    """A size as Spark writes it (``64MB``, ``8m``, ``1048576b``; a bare number is bytes)."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]?)[a-z]*\s*", size.lower()).groups()
    return int(number) * 1024.0 ** (" bkmgtp".index(unit or "b") - 3)


def spread(df: DataFrame) -> DataFrame:
    """``df``, with as many shuffle partitions in its session as its rows need, so a task's share does not grow with the input.

    The number is only raised, and adaptive execution merges partitions that turn out small. It would merge them up to one for
    each core or 64 MB, which is some million rows, so for an input of several partitions its size is lowered to PARTITION_MB
    where it is higher. Counting a stored table reads no column.
    """
    spark, key = df.sparkSession, "spark.sql.shuffle.partitions"
    wanted = math.ceil(df.count() / PARTITION_ROWS)
    if wanted > int(spark.conf.get(key)):
        spark.conf.set(key, str(wanted))
    if wanted > 1 and _megabytes(spark.conf.get(ADVISORY_CONF)) > PARTITION_MB:
        spark.conf.set(ADVISORY_CONF, f"{PARTITION_MB}m")
    return df


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the shared one, for tables and logs a job writes."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Unlike a cached copy it survives the loss of executors, and unlike a recomputation it is
    read as a columnar file with known size, so later joins can be planned from that size.
    """
    path = fresh_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
