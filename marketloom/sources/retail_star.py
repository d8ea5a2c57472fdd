"""Marketplace views over a retail star schema (region, nation, customer, ..., embeddings).

Each view is a projection of the given tables; nothing is made up and nothing is subset beyond
what defines the view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import flag
from .tables import Tables

# Produce names given to the prediction views, in index order. The last has no profile.
PRODUCE = [
    "Apple", "Banana", "Tomato", "Potato", "Bellpepper", "Carrot", "Cucumber",
    "Grape", "Guava", "Jujube", "Mango", "Orange", "Strawberry", "Dragonfruit",
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def market_tables(spark: SparkSession, sf_dir: str) -> Tables:
    nation = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("postcode_area"))
    supplier = read(spark, sf_dir, "supplier")
    size = F.col("p_size")
    return Tables(
        customers=read(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("customer_type"), "postcode_area"),
        producers=supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("s_suppkey").alias("producer_id"), F.col("s_name").alias("producer_name"), "postcode_area"
        ),
        products=read(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("category"),
            (F.col("p_partkey") % supplier.select(F.count("*")).scalar()).alias("producer_id"),
            (size % 12 + 1).cast("int").alias("seasonal_start_month"),
            ((size * 7) % 12 + 1).cast("int").alias("seasonal_end_month"),
            F.col("p_retailprice").alias("base_price"),
            F.when(size % 10 == 0, F.lit("unavailable")).otherwise(F.lit("available")).alias("availability_status"),
        ),
        orders=read(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("o_totalprice").alias("total_amount"),
        ),
        order_items=read(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        ),
    )


def _produce(index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(p) for p in PRODUCE]), (index % len(PRODUCE) + 1).cast("int"))


def _hour() -> Column:
    """The hour as ISO text; two of three with a fraction of a second, so that events of an hour differ by it."""
    n = F.col("event_id")
    fraction = F.when(n % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("."), (n % 9 + 1).cast("string"), F.lit("00000")))
    return F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:00:00"), fraction)


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier output rows with the true class, derived from view, click and signup events."""
    n, user = F.col("event_id"), F.col("user_id")
    healthy, rotten = F.lit("__Healthy"), F.lit("__Rotten")
    condition = F.when(n % 2 == 0, healthy).otherwise(rotten)
    flipped = F.when(n % 2 == 0, rotten).otherwise(healthy)
    seen_condition = F.when(n % 7 == 0, flipped).otherwise(condition)
    seen_produce = F.when(n % 11 == 0, _produce(user + 1)).otherwise(_produce(user))
    confidence = (_k().cast("double") + 0.5) / 100.0
    margin = F.when(n % 5 != 0, ((n * 37) % 100).cast("double") / 100.0)
    rows = events(spark, sf_dir).filter(F.col("event_type").isin("view", "click", "signup"))
    return rows.select(
        n.alias("event_id"),
        n.cast("string").alias("prediction_id"),
        _iso(F.col("ts")).alias("created_at"),
        F.col("ts").alias("created_ts"),
        F.col("event_type").alias("model"),
        F.concat(_produce(user), condition).alias("class_name"),
        F.concat(seen_produce, seen_condition).alias("predicted_class"),
        confidence.alias("confidence"),
        margin.alias("top1_top2_margin"),
        F.concat(
            F.when(n % 4 == 0, F.lit("D:\\images\\")).otherwise(F.lit("/mnt/d/images/")),
            F.lit("img"), n.cast("string"), F.lit(".jpg"),
        ).alias("image_path"),
    )


def top_predictions_json(preds: DataFrame) -> DataFrame:
    """Adds ``top_predictions``: JSON text with the predicted class and the opposite condition."""
    opposite = F.when(
        F.col("predicted_class").endswith("__Healthy"), F.replace("predicted_class", F.lit("__Healthy"), F.lit("__Rotten"))
    ).otherwise(F.replace("predicted_class", F.lit("__Rotten"), F.lit("__Healthy")))
    second = F.greatest(F.lit(0.0), F.col("confidence") - F.coalesce(F.col("top1_top2_margin"), F.lit(0.3)))
    entry = lambda key, name, part, value: F.concat(
        F.lit(f'{{"{key}": "'), name, F.lit(f'", "{part}": '), value.cast("decimal(6,3)").cast("string"), F.lit("}")
    )
    text = F.concat(
        F.lit("["), entry("class_name", F.col("predicted_class"), "confidence", F.col("confidence")),
        F.lit(", "), entry("class", opposite, "probability", second),
        F.lit(', {"class_name": "incomplete"}]'),
    )
    return preds.withColumn("top_predictions", text)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected labels for all events; a fourth of the rows carry no label."""
    n = F.col("event_id")
    condition = F.when(n % 2 == 0, F.lit("__Healthy")).otherwise(F.lit("__Rotten"))
    return events(spark, sf_dir).select(
        F.concat(F.lit("data/raw/external/img"), n.cast("string"), F.lit(".jpg")).alias("image_path"),
        F.when(n % 4 != 3, F.concat(_produce(F.col("user_id")), condition)).alias("expected_class"),
        F.concat(F.lit("note "), n.cast("string")).alias("notes"),
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human feedback rows, derived from purchase and error events."""
    n, k = F.col("event_id"), _k()
    produce = _produce(F.col("user_id"))
    rows = events(spark, sf_dir).filter(F.col("event_type").isin("purchase", "error"))
    return rows.select(
        n.alias("seq"),
        F.when(n % 10 != 0, (n - 1).cast("string")).otherwise(F.lit("")).alias("prediction_id"),
        F.when(n % 6 == 0, F.concat(produce, F.lit("__Healthy"))).alias("predicted_class"),
        F.when(n % 8 == 0, F.lit("B")).alias("predicted_grade"),
        F.when(n % 9 == 0, F.concat(produce, F.lit("__Rotten"))).when(n % 9 == 1, F.lit("")).alias("corrected_class"),
        F.when(n % 4 == 0, F.concat(produce, F.lit("__Healthy"))).alias("producer_override_class"),
        F.when(n % 4 == 1, F.lit("A")).alias("producer_override_grade"),
        F.when(k % 3 == 0, F.lit(True)).when(k % 3 == 1, F.lit(False)).alias("accepted_ai_recommendation"),
        F.when(n % 12 == 0, F.lit("manual")).alias("model_name"),
        F.when(n % 7 == 0, F.lit("")).when(n % 7 == 1, F.lit("someday soon")).when(n % 7 == 2, F.concat(_iso(F.col("ts")), F.lit("+09:00"))).otherwise(_iso(F.col("ts"))).alias("created_at"),
        F.col("ts").alias("feedback_ts"),
    )


def producer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer upserts from view events; every 13th is invalid in one of four ways."""
    n, user = F.col("event_id"), F.col("user_id")
    fault = F.when(n % 13 == 0, n % 4)
    return events(spark, sf_dir).filter(F.col("event_type") == "view").select(
        n.alias("seq"),
        F.when(fault == 0, F.lit("producer_removed")).otherwise(F.lit("producer_upserted")).alias("event_type"),
        user.alias("producer_id"),
        F.when(fault == 1, F.lit("  ")).otherwise(F.concat(F.lit(" Farm "), n.cast("string"), F.lit(" "))).alias("producer_name"),
        F.when(fault == 2, F.lit("")).otherwise(F.concat(F.lit("AREA"), (user % 9).cast("string"))).alias("postcode_area"),
        F.array(F.lit(" fruit "), F.lit(""), F.concat(F.lit("c"), (n % 3).cast("string"))).alias("categories"),
        (n % 2 == 0).alias("organic_certified"),
        F.when(fault == 3, F.lit("not a time")).otherwise(_hour()).alias("created_at"),
        F.lit("feed").alias("source"),
    )


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product upserts from click events; faults, unknown producers and seasonal ranges included."""
    n, user, k = F.col("event_id"), F.col("user_id"), _k()
    fault = F.when(n % 13 == 0, n % 5)
    seasonal = n % 3 == 0
    return events(spark, sf_dir).filter(F.col("event_type") == "click").select(
        n.alias("seq"),
        F.when(fault == 0, F.lit("product_removed")).otherwise(F.lit("product_upserted")).alias("event_type"),
        (user * 20).alias("product_id"),
        (user % 120).alias("producer_id"),
        F.concat(F.lit(" item "), (user % 50).cast("string")).alias("product_name"),
        F.concat(F.lit("Brand#"), (user % 25 + 1).cast("string")).alias("category"),
        F.lit("kg").alias("unit"),
        F.when(fault == 1, F.lit(-1.0)).otherwise(F.col("value")).alias("price"),
        seasonal.alias("seasonal"),
        F.when(fault == 2, F.lit(13)).when(seasonal, k % 12 + 1).cast("int").alias("seasonal_start_month"),
        F.when(seasonal, (k * 5) % 12 + 1).cast("int").alias("seasonal_end_month"),
        (n % 6 != 0).alias("available"),
        F.when(fault == 3, F.lit("not a time")).otherwise(_hour()).alias("created_at"),
        F.lit("feed").alias("source"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events from purchases: duplicates, unknown ids, empty baskets and bad dates included."""
    n, user, k = F.col("event_id"), F.col("user_id"), _k()
    fault = F.when(n % 13 == 0, n % 7)
    line = lambda i, product, quantity: F.struct(
        product.alias("product_id"), quantity.alias("quantity"), (F.col("value") + i).alias("unit_price")
    )
    # Even the smallest catalogue holds the first 200 ids.
    product = lambda i: (n * 31 + i * 17) % 200
    quantity = lambda i: (k % 5 + 1 + i).cast("double")
    first = line(
        0,
        F.when(fault == 0, F.lit(-5).cast("bigint")).otherwise(product(0)),
        F.when(fault == 6, F.lit(0.0)).otherwise(quantity(0)),
    )
    second, third = (line(i, product(i), quantity(i)) for i in (1, 2))
    basket = F.when(n % 2 == 0, F.array(first, second)).otherwise(F.array(first, second, third))
    return events(spark, sf_dir).filter(F.col("event_type") == "purchase").select(
        n.alias("seq"),
        F.when(fault == 1, F.lit(None)).when(n % 17 == 0, F.col("event_id") % 1000).otherwise(F.lit(10_000_000) + F.floor(n / 3)).cast("bigint").alias("order_id"),
        F.when(fault == 2, F.lit(None)).when(n % 5 == 0, F.lit(1_000_000) + user).otherwise(user).cast("bigint").alias("customer_id"),
        F.when(n % 10 == 0, F.lit("NEWCOMER")).alias("customer_type"),
        F.when(n % 20 == 0, F.lit("AREA0")).alias("postcode_area"),
        F.when(fault == 3, F.lit("not a date")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("order_date"),
        F.when(n % 4 == 0, F.col("value") * 3).alias("total_amount"),
        F.when(fault == 4, F.slice(basket, 1, 0)).otherwise(basket).alias("items"),
        F.when(n % 3 == 0, F.lit("app")).alias("source"),
        F.col("ts").alias("event_ts"),
    )


def history_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History batches from signups: two orders each; some batches carry one bad order, some share orders in chains."""
    n, user, k = F.col("event_id"), F.col("user_id"), _k()
    order = lambda i: F.struct(
        F.when((n % 19 == 0) & F.lit(i == 1), n % 1000).when(n % 4 == 0, F.lit(30_000_000) + n % 50 + F.lit(i)).otherwise(F.lit(20_000_000) + n * 2 + F.lit(i) * flag(n % 23 != 0)).cast("bigint").alias("order_id"),
        F.when((n % 29 == 0) & F.lit(i == 0), F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("order_date"),
        F.when(n % 2 == 0, F.col("value")).alias("total_amount"),
        F.array(
            F.struct(
                F.when((n % 31 == 0) & F.lit(i == 1), F.lit(-7)).otherwise((n * 13 + i) % 200).cast("bigint").alias("product_id"),
                (k % 4 + 1).cast("double").alias("quantity"),
                F.lit(2.5).alias("unit_price"),
            )
        ).alias("items"),
    )
    return events(spark, sf_dir).filter(F.col("event_type") == "signup").select(
        n.alias("seq"),
        F.concat(F.lit("HIST-"), n.cast("string")).alias("history_batch_id"),
        F.when(n % 9 == 0, F.lit(2_000_000) + user).otherwise(user).cast("bigint").alias("customer_id"),
        F.when(n % 18 == 0, F.lit("BACKFILL")).alias("customer_type"),
        F.lit(None).cast("string").alias("postcode_area"),
        F.lit(None).cast("string").alias("source"),
        F.array(order(0), order(1)).alias("orders"),
    )


def image_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One path per document: class folder from the language, offline-augmentation file names."""
    n = F.col("doc_id")
    prefix = (
        F.when(n % 4 == 0, F.lit("")).when(n % 4 == 1, F.lit("rotated_by_45_"))
        .when(n % 4 == 2, F.lit("vertical_flip_")).otherwise(F.lit("Noise_"))
    )
    suffix = F.when(n % 6 == 0, F.concat(F.lit("_augmented_"), (n % 5).cast("string"))).otherwise(F.lit(""))
    extension = F.when(n % 97 == 0, F.lit(".txt")).when(n % 5 == 0, F.lit(".JPG")).otherwise(F.lit(".jpg"))
    name = F.concat(prefix, F.lit("img"), F.floor(n / 4).cast("string"), suffix, extension)
    folder = F.when(n % 101 == 0, F.lit("/data/extra/")).otherwise(F.lit("/data/fruit/"))
    return read(spark, sf_dir, "documents").select(n.alias("doc_id"), F.concat(folder, F.col("lang"), F.lit("/"), name).alias("path"))


def probability_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One class probability for each value of a vector (softmax of the values, times 20)."""
    scaled = F.transform("embedding", lambda v: F.exp(v.cast("double") * 20.0))
    total = F.aggregate(scaled, F.lit(0.0), lambda acc, v: acc + v)
    return read(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("int").alias("label"), scaled.alias("_e"), total.alias("_t")
    ).select(
        "vec_id",
        F.concat(F.lit("C"), F.col("label").cast("string")).alias("class_name"),
        F.transform("_e", lambda v: v / F.col("_t")).alias("probabilities"),
    )


def pixel_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as an 8 x 8 image with red, green and blue taken at different offsets."""
    value = lambda i: F.greatest(
        F.lit(0.0), F.least(F.lit(1.0), (F.get("embedding", i % 64).cast("double") + 0.6) / 1.2)
    )
    channel = lambda offset: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: value(i + offset))
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("image_id"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        channel(0).alias("red"),
        channel(21).alias("green"),
        channel(42).alias("blue"),
    )


def some_unreadable(images: DataFrame) -> DataFrame:
    """The images with some that have no pixels."""
    return images.withColumns({c: F.when(F.col("image_id") % 41 != 0, F.col(c)) for c in ("red", "green", "blue")})
